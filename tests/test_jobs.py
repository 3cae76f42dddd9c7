"""The jobs end to end on landed files of the driver tables' star schema."""

from __future__ import annotations

import contextlib
import io
import json
import tempfile
import threading

import pytest
from pyspark.sql import functions as F

from millsight.functions.calendar import Period
from millsight.jobs import accept, build_models, ingest
from millsight.plans.bronze import Ingestion
from millsight.plans.checks import (
    event_duplicates,
    grain_duplicates,
    invalid_quantities,
    metric_reconciliation,
)
from millsight.plans.gold import GOLD_TABLES
from millsight.registry.spark_queries import HORIZON, QUERIES
from millsight.registry.star import Star
from millsight.sources.catalog import Lake
from millsight.streaming.incremental import ingest_available

SF = "/root/testdata/sf0.001"
DATES = ["--first-date", str(HORIZON.first), "--last-date", str(HORIZON.last)]


@pytest.fixture(scope="module")
def landing(spark):
    """Landed Parquet files, one per table, with a few broken lots."""
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    star = Star(spark, SF)
    spoiled = F.when(F.col("production_lot_id").endswith("7"), -1).otherwise(F.col("scrap_qty"))
    for name, frame in star.silver.items():
        if name == "fact_production":
            frame = frame.withColumn("scrap_qty", spoiled)
        frame.drop("is_supplier_attributed").coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="module")
def lake(spark, landing):
    ingest.main(["--source-path", landing, "--prefix", "j_", "--batch-id", "one", *DATES])
    build_models.main(["--prefix", "j_"])
    return Lake(spark, "j_")


def test_every_source_row_is_stored_or_quarantined(spark, lake):
    for row in spark.table(lake.audit).groupBy("table_name").sum("source_rows", "valid_rows", "quarantined_rows").collect():
        stored = lake.table("bronze", row.table_name).count()
        rejected = spark.table(lake.quarantine).filter(F.col("table_name") == row.table_name).count()
        assert (row[1], row[2], row[3]) == (stored + rejected, stored, rejected)
    assert spark.table(lake.quarantine).filter("table_name = 'fact_production'").count() > 0


def test_published_tables_equal_the_models_on_the_same_rows(spark, lake):
    """Gold through files, Bronze and Silver tables against the model on the clean rows."""
    stored = lake.table("bronze", "fact_production").select("production_lot_id")
    star = Star(spark, SF)
    object.__setattr__(star, "production", star.production.join(stored, "production_lot_id", "left_semi"))
    from millsight.plans.gold import factory_quality, manufacturing_daily

    for name, model in (
        ("gold_manufacturing_daily", manufacturing_daily(star.production)),
        ("gold_factory_quality", factory_quality(star.production, star.dims["dim_factory"])),
    ):
        published = lake.table("gold", name).drop("_gold_updated_at").select(*model.columns)
        assert published.exceptAll(model).isEmpty() and model.exceptAll(published).isEmpty()


def test_published_tables_pass_the_checks(lake):
    production = lake.table("silver", "silver_fact_production")
    assert grain_duplicates(production).first().violations == 0
    assert invalid_quantities(production).first().violations == 0
    assert event_duplicates(lake.table("silver", "silver_fact_quality_event")).first().violations == 0
    assert metric_reconciliation(lake.table("gold", "gold_manufacturing_daily")).first().violations == 0


def test_models_can_be_refreshed(lake):
    before = {t: lake.table("gold", t).count() for t in ("gold_defect_pareto", "gold_supplier_quality")}
    build_models.main(["--prefix", "j_"])
    assert before == {t: lake.table("gold", t).count() for t in before}
    names = {r.table_name for r in lake.inventory(("silver", "gold")).collect()}
    assert len(names) == 14 and not any("__" in name for name in names)


def test_a_reader_always_finds_a_whole_table(spark):
    """A reader in a loop, while versions are published and old ones dropped."""
    lake = Lake(spark, "p_")
    lake.bootstrap()
    name, wrong, seen, stop = lake.name("gold", "t"), [], set(), threading.Event()

    def rows(n):
        return spark.range(n).selectExpr("id", "date_add(DATE'2026-01-15', CAST(id % 90 AS INT)) AS day")

    lake.publish(rows(100), name, "day")

    def read():
        while not stop.is_set():
            try:
                seen.add(lake.table("gold", "t").count())
            except Exception as error:
                wrong.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(101, 106):
        lake.publish(rows(n), name, "day")
    stop.set()
    reader.join()
    assert not wrong and seen <= set(range(100, 106)) and len(seen) > 1
    assert len(lake.versions(name)) == 2 and lake.table("gold", "t").columns == ["id", "day"]
    assert [r.table_name for r in lake.inventory(("gold",)).collect()] == ["t"]

    # A build that fails moves nothing.
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|not a date|lost"):
        lake.publish(rows(9).withColumn("day", F.expr("CAST(raise_error('lost') AS DATE)")), name, "day")
    assert lake.table("gold", "t").count() == 105

    march = lake.window("gold", "t", "day", Period.of("2026-03-02", "2026-03-05"))
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        march.explain("formatted")
    assert "PartitionFilters: [isnotnull(_month" in plan.getvalue()
    assert march.count() == rows(105).filter("day BETWEEN DATE'2026-03-02' AND DATE'2026-03-05'").count() > 0


def test_a_plain_table_becomes_a_versioned_one(spark):
    lake = Lake(spark, "q_")
    lake.bootstrap()
    spark.range(3).write.saveAsTable("q_gold.t")
    lake.publish(spark.range(5), "q_gold.t")
    assert spark.table("q_gold.t").count() == 5


def test_acceptance_fails_closed_on_other_data(lake, capsys):
    with pytest.raises(RuntimeError, match="row_count_gold_defect_pareto"):
        accept.main(["--prefix", "j_"])
    assert capsys.readouterr().out.count('"event": "acceptance_check"') == 14


def test_acceptance_takes_its_spec_as_an_argument(lake, capsys):
    counts = {t: lake.table("gold", t).count() for t in GOLD_TABLES}
    window = {"first": "1997-01-01", "last": "1997-12-31"}
    spec = {"gold_rows": counts, "supplier_window": window, "leading_ranks": 10**6,
            "supplier_entity": {"supplier_id": "SUP-3", "component_id": "COMP-2"}}
    with pytest.raises(RuntimeError) as failed:
        accept.main(["--prefix", "j_", "--spec", json.dumps(spec)])
    assert "row_count" not in str(failed.value) and "incident_a" not in str(failed.value)
    with pytest.raises(ValueError, match="unknown acceptance settings: windows"):
        accept.main(["--prefix", "j_", "--spec", '{"windows": 1}'])


def test_streaming_loads_only_new_files(spark, landing):
    lake = Lake(spark, "s_")
    checkpoint = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    first = ingest_available(Ingestion(lake, landing, "s1", HORIZON), checkpoint)
    assert first["dim_factory"] == [{"source": 5, "valid": 5, "quarantined": 0, "skipped": 0}]
    stored = lake.table("bronze", "fact_production").count()
    assert stored == first["fact_production"][0]["valid"] > 0
    again = ingest_available(Ingestion(lake, landing, "s2", HORIZON), checkpoint)
    assert all(parts == [] for parts in again.values())
    assert lake.table("bronze", "fact_production").count() == stored


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1
    extra = set(__spark_entry__.queries()) - set(QUERIES)
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert all(name == "pipeline" or name.startswith("op") for name in extra)
