"""Every registered query against its SQL on the smallest scale factor, and plan checks."""

from __future__ import annotations

import contextlib
import io
import math
import tempfile
from pathlib import Path

import duckdb
import pytest

from millsight.contracts import PRODUCTION_KEY
from millsight.functions.calendar import Period
from millsight.operators.keys import latest_record
from millsight.plans.bronze import check_batch
from millsight.plans.evidence import component_lots
from millsight.registry.oracle import ORACLES
from millsight.registry.spark_queries import CONTRACTS, QUERIES
from millsight.registry.star import DirtyStar, Star

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "supplier", "part", "orders", "lineitem")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in (path.stem for path in Path(SF).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 12)
    return value


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is not None, str(v)) for v in row))


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, database, name):
    found = QUERIES[name](spark, SF)
    columns = sorted(found.columns)
    rows = [tuple(plain(v) for v in row) for row in found.select(*columns).collect()]
    result = database.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    wanted = [tuple(plain(row[i]) for i in places) for row in result.fetchall()]
    assert ordered(rows) == ordered(wanted)


def plan(frame):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain()
    return out.getvalue()


@pytest.mark.parametrize(
    "name",
    ["gold_manufacturing_daily", "gold_defect_pareto", "gold_supplier_quality", "bronze_quarantine",
     "silver_fact_quality_event", "acceptance_report", "ranked_contribution"],
)
def test_plans_stay_distributed(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def test_latest_record_limits_before_the_shuffle(spark):
    sent = Star(spark, SF).production.selectExpr("*", "timestamp'2026-01-01' AS _ingested_at")
    text = plan(latest_record(sent, PRODUCTION_KEY))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1


def test_checked_rows_are_not_shuffled_once_keys_are_settled(spark):
    """With its key relations written and read back, a batch goes from scan to output in one pass."""
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")

    def settle(frame, name):
        frame.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{folder}/{name}")

    star = DirtyStar(spark, SF)
    star.raw_events.write.parquet(f"{folder}/raw")
    raw = spark.read.parquet(f"{folder}/raw")
    contract = CONTRACTS["fact_quality_event"]
    parents = {"fact_production": star.parent_production}
    text = plan(check_batch(raw, contract, parents=parents, settle=settle))
    assert "hashpartitioning" not in text and "SortMergeJoin" not in text


def test_daily_model_needs_two_shuffles(spark):
    assert plan(QUERIES["gold_manufacturing_daily"](spark, SF)).count("Exchange") == 2


def test_scans_are_pruned_and_filtered(spark):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    Star(spark, SF).events.write.mode("overwrite").parquet(folder)
    lots = component_lots(spark.read.parquet(folder), Period.of("1998-01-01", "1998-03-31"))
    text = plan(lots)
    assert "GreaterThanOrEqual(event_date,1998-01-01)" in text
    schema = "event_date:date,component_id:string,supplier_id:string,component_lot_id:string,event_quantity:bigint"
    assert f"ReadSchema: struct<{schema}>"[:60] in text and "disposition" not in text
