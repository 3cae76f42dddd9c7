"""Contract checks on hand-made rows, and whole ingestion runs on files."""

from __future__ import annotations

import contextlib
import io
import json
import re
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millsight.contracts import LOAD_ORDER, contracts
from millsight.operators import keys
from millsight.plans.bronze import (
    Ingestion,
    accepted_rows,
    check_batch,
    file_audit,
    quarantined_rows,
)
from millsight.plans.checks import audit_duplicates, audit_totals
from millsight.sources.catalog import Lake
from millsight.sources.landing import (
    export_tables,
    list_files,
    require_inventory,
    scan_files,
    scan_new_files,
    source_inventory,
)

CONTRACTS = contracts()
LOT = {
    "production_lot_id": "L1",
    "production_date": "2026-02-03",
    "factory_id": "F1",
    "line_id": "N1",
    "product_id": "P1",
    "production_qty": "10",
    "pass_qty": "8",
    "started_qty": "10",
    "completed_qty": "10",
    "first_pass_pass_qty": "8",
    "fail_qty": "2",
    "rework_qty": "1",
    "scrap_qty": "1",
}
EVENT = {
    "quality_event_id": "E1",
    "event_date": "2026-02-03",
    "event_timestamp": "2026-02-03T10:00:00",
    "production_lot_id": "L1",
    "factory_id": "F1",
    "line_id": "N1",
    "product_id": "P1",
    "component_id": "C1",
    "supplier_id": "S1",
    "component_lot_id": "CL1",
    "defect_id": "D1",
    "inspection_stage": "final",
    "event_quantity": "2",
    "is_first_pass_failure": "true",
    "is_rework": "false",
    "is_scrap": "false",
    "disposition": "fail",
}
DIMS = {
    "dim_date": {"date_id": "20260203", "date": "2026-02-03", "year": "2026", "quarter": "1",
                 "month": "2", "week_of_year": "6", "day_of_week": "2", "is_weekend": "false"},
    "dim_factory": {"factory_id": "F1", "factory_code": "f", "factory_name": "Factory",
                    "country": "X", "baseline_fpy": "0.9"},
    "dim_line": {"line_id": "N1", "line_code": "n", "line_name": "Line", "factory_id": "F1",
                 "is_ramp_line": "false"},
    "dim_product": {"product_id": "P1", "product_code": "p", "product_name": "Product",
                    "product_family": "A", "complexity_risk": "0.1"},
    "dim_component": {"component_id": "C1", "component_code": "c", "component_name": "Part",
                      "component_family": "A"},
    "dim_supplier": {"supplier_id": "S1", "supplier_code": "s", "supplier_name": "Supplier",
                     "supplier_region": "R"},
    "dim_defect": {"defect_id": "D1", "defect_code": "d", "defect_name": "Defect",
                   "defect_category": "A", "severity": "High"},
}
KEY = CONTRACTS["fact_production"].key


@pytest.fixture(scope="module")
def raw(spark):
    def build(base, *changes, without=(), source="file-1"):
        names = [c for c in base if c not in without]
        rows = [tuple({**base, **change}[c] for c in names) + (source,) for change in changes]
        return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in [*names, "_source_file"]))

    return build


def codes(checked):
    rows = checked.select("*", F.expr("concat_ws(',', _errors.code)").alias("c")).collect()
    return [row.c for row in rows]


@pytest.mark.parametrize(
    "change, expected",
    [
        ({}, ""),
        ({"production_date": "2025-12-31"}, "DATE_OUT_OF_RANGE"),
        ({"started_qty": "11"}, ""),
        ({"completed_qty": "-1"}, "NEGATIVE_QUANTITY"),
        ({"pass_qty": "7"}, "INVALID_PRODUCTION_TOTAL"),
        ({"completed_qty": "11"}, "COMPLETED_EXCEEDS_STARTED"),
        ({"first_pass_pass_qty": "9"}, "FIRST_PASS_EXCEEDS_STARTED"),
        ({"rework_qty": "3"}, "REWORK_EXCEEDS_FAILURES"),
        ({"scrap_qty": "3"}, "SCRAP_EXCEEDS_FAILURES"),
        ({"product_id": None}, "NULL_REQUIRED_VALUE"),
        # A value that does not fit is null, wrong and breaks every rule that reads it.
        (
            {"fail_qty": "x"},
            "NULL_REQUIRED_VALUE,INVALID_DATA_TYPE,NEGATIVE_QUANTITY,INVALID_PRODUCTION_TOTAL,"
            "FIRST_PASS_EXCEEDS_STARTED,REWORK_EXCEEDS_FAILURES,SCRAP_EXCEEDS_FAILURES",
        ),
    ],
)
def test_production_rules(raw, change, expected):
    assert codes(check_batch(raw(LOT, change), CONTRACTS["fact_production"])) == [expected]


@pytest.mark.parametrize(
    "change, expected",
    [
        ({"supplier_id": None}, ""),
        ({"event_date": "2026-07-01", "event_timestamp": "2026-07-01"}, "DATE_OUT_OF_RANGE"),
        ({"event_timestamp": "2026-02-04T00:00:00"}, "TIMESTAMP_DATE_MISMATCH"),
        ({"event_quantity": "0"}, "INVALID_EVENT_QUANTITY"),
        ({"inspection_stage": "FINAL"}, "INVALID_INSPECTION_STAGE"),
        ({"disposition": "pass"}, "INVALID_DISPOSITION"),
        ({"is_scrap": "perhaps"}, "NULL_REQUIRED_VALUE,INVALID_DATA_TYPE"),
    ],
)
def test_event_rules(raw, change, expected):
    assert codes(check_batch(raw(EVENT, change), CONTRACTS["fact_quality_event"])) == [expected]


@pytest.mark.parametrize(
    "table, change, expected",
    [
        ("dim_date", {"date": "2026-07-01"}, "DATE_OUT_OF_RANGE"),
        ("dim_factory", {"baseline_fpy": "1.1"}, "INVALID_BASELINE_FPY"),
        ("dim_product", {"complexity_risk": "-0.1"}, "NEGATIVE_COMPLEXITY_RISK"),
        ("dim_supplier", {"supplier_name": None}, "NULL_REQUIRED_VALUE"),
    ],
)
def test_dimension_rules(raw, table, change, expected):
    assert codes(check_batch(raw(DIMS[table], change), CONTRACTS[table])) == [expected]


def test_missing_column_and_extra_column(raw):
    batch = raw({**LOT, "note": "n"}, {}, without=("scrap_qty",))
    checked = check_batch(batch, CONTRACTS["fact_production"])
    row = quarantined_rows(checked, CONTRACTS["fact_production"]).first()
    assert row._error_code.startswith("MISSING_REQUIRED_COLUMN,")
    assert "required field scrap_qty is null or unavailable; " in row._error_message
    assert json.loads(row.original_record)["note"] == "n"
    assert "note" not in checked.columns


def test_original_record_is_taken_before_casts(raw):
    checked = check_batch(raw(LOT, {"fail_qty": "abc", "line_id": None}), CONTRACTS["fact_production"])
    record = json.loads(checked.first()._original_record)
    assert record["fail_qty"] == "abc" and record["line_id"] is None
    assert record["_source_file"] == "file-1"


def test_every_copy_of_a_duplicate_is_rejected(raw):
    batch = raw(LOT, {}, {}, {"production_lot_id": "L2"}, {"line_id": None}, {"line_id": None},
                {"production_lot_id": "L3", "line_id": None})
    checked = check_batch(batch, CONTRACTS["fact_production"])
    assert Counter(codes(checked)) == {
        "DUPLICATE_KEY": 2,
        "": 1,
        "NULL_REQUIRED_VALUE,DUPLICATE_KEY": 2,
        "NULL_REQUIRED_VALUE": 1,
    }


def test_rules_are_judged_once_a_row_under_a_filter(raw):
    checked = check_batch(raw(LOT, {}, {"production_lot_id": "L2", "completed_qty": "11"}), CONTRACTS["fact_production"])
    failing = checked.filter(F.size("_errors") > 0).select("production_lot_id", "_errors")
    assert codes(failing) == ["COMPLETED_EXCEEDS_STARTED"]
    plan = failing._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"completed_qty#\d+L <= started_qty#\d+L", plan)) == 1


def test_event_rules_are_judged_once_under_a_filter_on_references(raw, frame):
    batch = raw(EVENT, {}, {"quality_event_id": "E2", "production_lot_id": "L2"})
    parents = {"fact_production": frame("production_lot_id string", ("L1",))}
    checked = check_batch(batch, CONTRACTS["fact_quality_event"], parents=parents)
    wrong = checked.filter(F.exists("_errors", lambda found: found["code"] == "INVALID_FOREIGN_KEY"))
    assert codes(wrong) == ["INVALID_FOREIGN_KEY"]
    plan = wrong._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"event_quantity#\d+L > 0", plan)) == 1


def test_joins_of_a_batch_carry_only_what_the_output_needs(raw, frame):
    batch = raw(EVENT, {}, {"quality_event_id": "E2", "production_lot_id": "L2", "disposition": "lost"})
    dims = {c: frame(f"{c}_id string, name string", (f"{c[0].upper()}1", "x")) for c in ("factory", "product")}
    parents = {"fact_production": frame("production_lot_id string", ("L1",))}
    parents |= {f"dim_{name}": rows for name, rows in dims.items()}
    settled = {}

    def settle(rows, part):
        settled[part] = rows
        return rows

    checked = check_batch(batch, CONTRACTS["fact_quality_event"], parents=parents, settle=settle)
    assert codes(checked) == ["", "INVALID_DISPOSITION,INVALID_FOREIGN_KEY"]
    assert {n: r.columns for n, r in settled.items() if n.startswith("parent")} == {
        "parent_keys_1": ["factory_id"], "parent_keys_2": ["product_id"]}
    assert {"duplicate_keys", "reference_0"} <= set(settled)
    nodes, carried = [checked.select("quality_event_id", "_errors")._jdf.queryExecution().optimizedPlan()], set()
    while nodes:
        node = nodes.pop()
        below = [node.children().apply(i) for i in range(node.children().size())]
        nodes += below
        if node.nodeName() == "Join":
            carried |= set(re.findall(r"(\w+)#", below[0].output().mkString(" ")))
    assert {"quality_event_id", "_judged"} <= carried
    assert not [c for c in carried if c.startswith("_raw_")] and "disposition" not in carried


def test_large_sides_are_sorted_by_one_number(spark, frame):
    flagged = frame("a string, b date", ("x", None), (None, None))
    rows = frame("a string, b string", ("x", None), ("x", "no date"), ("x", "2026-01-01"), (None, None), ("y", None))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = keys.flag_rows(rows, flagged, ("a", "b"), "held", ("a", "try_cast(b AS DATE)"))
        assert [r.held for r in found.collect()].count(True) == 3
        assert found.columns == ["a", "b", "held"]
        sorted_by = re.findall(r"Sort \[(\w+)#\d+L ASC", found._jdf.queryExecution().executedPlan().toString())
        assert sorted_by and set(sorted_by) == {"_digest", "_flagged_digest"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Members of other types are equal by value, not by digest.
    wide = keys.flag_rows(frame("a int", (1,), (2,)), frame("a long", (1,)), ("a",), "held")
    assert sorted(tuple(r) for r in wide.collect()) == [(1, True), (2, False)]
    profile = keys.key_profile(frame("a int", (1,), (None,), (2,)), ("a",))
    for other in (frame("a int", (None,), (1,), (1,)), frame("a long", (None,), (1,), (1,))):
        for held, expected in ((True, {None, 1}), (False, {2})):
            kept = keys.held_keys(profile, ("a",), other, held=held)
            assert kept.columns == ["a", "rows"] and {r.a for r in kept.collect()} == expected


def test_stored_keys_are_duplicates(raw):
    contract = CONTRACTS["fact_production"]
    stored = check_batch(raw(LOT, {}), contract).select(*contract.columns)
    batch = raw(LOT, {}, {"production_lot_id": "L2"}, *[{"production_lot_id": "L4"}] * 3)
    checked = check_batch(batch, contract, stored.union(stored))
    found = {(r.production_lot_id, r._accepted) for r in checked.collect()}
    assert found == {("L1", False), ("L2", True), ("L4", False)} and checked.count() == 5


def test_references(raw, frame):
    parents = {
        "dim_factory": frame("factory_id string", ("F1",), ("F1",)),
        "dim_line": frame("line_id string", ("N1",)),
        "dim_product": frame("product_id string", ("P1",)),
        "dim_component": frame("component_id string", ("C1",)),
        "dim_supplier": frame("supplier_id string", ("S1",)),
        "dim_defect": frame("defect_id string", ("D1",)),
        "fact_production": frame("production_lot_id string", ("L1",), ("L1",), ("L7",)),
    }
    batch = raw(
        EVENT,
        {},
        {"quality_event_id": "E2", "supplier_id": None},
        {"quality_event_id": "E3", "supplier_id": "S9", "factory_id": "F9"},
        {"quality_event_id": "E4", "production_lot_id": "L9"},
        {"quality_event_id": "E5", "production_lot_id": "L9", "defect_id": None},
    )
    checked = check_batch(batch, CONTRACTS["fact_quality_event"], None, parents)
    texts = checked.select(F.col("quality_event_id").alias("id"), F.expr("concat_ws('; ', _errors.message)").alias("m"))
    assert {r.id: r.m for r in texts.collect()} == {
        "E1": "",
        "E2": "",
        "E3": "factory_id does not resolve to dim_factory; supplier_id does not resolve to dim_supplier",
        "E4": "production_lot_id does not resolve to fact_production",
        "E5": "required field defect_id is null or unavailable; "
        "production_lot_id does not resolve to fact_production; "
        "defect_id does not resolve to dim_defect",
    }
    assert checked.count() == 5


def test_audit_counts_add_up(raw):
    contract = CONTRACTS["fact_production"]
    batch = raw(LOT, {}, {"production_lot_id": "L2", "pass_qty": "1"}).union(
        raw(LOT, {"production_lot_id": "L3"}, source="file-2")
    )
    checked = check_batch(batch, contract)
    rows = {r.source_file: (r.source_rows, r.valid_rows, r.quarantined_rows) for r in file_audit(checked, contract).collect()}
    assert rows == {"file-1": (2, 1, 1), "file-2": (1, 1, 0)}
    assert accepted_rows(checked, contract).count() == 2


def test_unseen_files(raw, frame):
    batch = raw(LOT, {}).union(raw(LOT, {}, source="file-2")).union(raw(LOT, {}, source="file-3"))
    audit = frame(
        "table_name string, source_file string, status string",
        ("fact_production", "file-1", "SUCCESS"),
        ("fact_production", "file-2", "FAILED"),
        ("dim_line", "file-3", "SUCCESS"),
    )
    left = keys.unseen_files(batch, audit, "fact_production")
    assert {r._source_file for r in left.collect()} == {"file-2", "file-3"}


def test_rows_are_not_dealt_by_file_to_leave_out_known_files(spark):
    """The size of an aggregated audit is not known before it is written."""
    batch = spark.range(2_000_000).selectExpr("id", "concat('file-', id % 4) AS _source_file")
    audit = batch.selectExpr("_source_file AS source_file", "repeat('x', 200) AS pad").groupBy("source_file").count()
    audit = audit.selectExpr("source_file", "'fact_production' AS table_name", "'SUCCESS' AS status")
    left = keys.unseen_files(batch, audit.filter("source_file <> 'file-2'"), "fact_production")
    assert left.groupBy("_source_file").count().collect() == [("file-2", 500_000)]
    plan = left._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


# --- runs on files ---------------------------------------------------------------------------


def write(raw, folder, table, base, *changes, part=1, without=()):
    rows = raw(base, *changes, without=without).drop("_source_file").coalesce(1)
    rows.write.mode("overwrite").parquet(f"{folder}/{table}_{part}.parquet")


@pytest.fixture(scope="module")
def landing(raw):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for table, base in DIMS.items():
        write(raw, folder, table, base, {})
    write(raw, folder, "fact_production", LOT, {}, {"production_lot_id": "L2", "pass_qty": "0"}, part="a b")
    write(raw, folder, "fact_quality_event", EVENT, {}, {"quality_event_id": "E2", "production_lot_id": "L2"})
    return folder


def test_runs_are_incremental_and_repeatable(spark, raw, landing):
    lake = Lake(spark, "a_")
    first = Ingestion(lake, landing, "b1").run()
    assert first["fact_production"] == {"source": 2, "valid": 1, "quarantined": 1, "skipped": 0}
    # The rejected lot takes its event with it.
    assert first["fact_quality_event"]["quarantined"] == 1
    again = Ingestion(lake, landing, "b2").run()
    assert all(again[name]["skipped"] == 1 for name in LOAD_ORDER)

    write(raw, landing, "fact_production", LOT, {"completed_qty": "9"}, {"production_lot_id": "L3"}, part=2,
          without=())
    known = spark.table(lake.audit)
    fresh = keys.unseen_files(list_files(spark, landing, "fact_production"), known, "fact_production")
    new = scan_new_files(spark, landing, "fact_production", fresh)
    assert len(new.inputFiles()) == 1 and new.count() == 2
    third = Ingestion(lake, landing, "b3").run()
    assert third["fact_production"] == {"source": 2, "valid": 1, "quarantined": 1, "skipped": 0}
    lots = lake.table("bronze", "fact_production")
    assert {(r.production_lot_id, r._batch_id) for r in lots.collect()} == {("L1", "b1"), ("L3", "b3")}
    rejected = spark.table(lake.quarantine).filter("table_name = 'fact_production'")
    assert {r._error_code for r in rejected.collect()} == {"INVALID_PRODUCTION_TOTAL", "DUPLICATE_KEY"}
    audit = spark.table(lake.audit)
    assert audit_duplicates(audit).first().violations == 0
    totals = audit_totals(audit.filter("table_name = 'fact_production'")).collect()
    assert sorted((r.source_rows, r.valid_rows) for r in totals) == [(2, 1), (2, 1)]
    assert ("bronze", "fact_production") in {tuple(r) for r in lake.inventory().collect()}


def test_a_run_that_died_before_its_audit_is_repeated(spark, raw, landing):
    lake = Lake(spark, "b_")
    Ingestion(lake, landing, "ok").run()
    bronze = lake.name("bronze", "fact_production")
    stray = spark.table(bronze).withColumn("production_lot_id", F.lit("STRAY")).withColumn("_batch_id", F.lit("died"))
    lake.begin("fact_production", "died")  # as every attempt does before its first write
    lake.replace_partitions(stray, bronze)
    before = spark.table(bronze).filter("production_lot_id <> 'STRAY'").count()
    Ingestion(lake, landing, "next").run()
    assert spark.table(bronze).filter("production_lot_id = 'STRAY'").count() == 0
    assert spark.table(bronze).count() == before


def test_batch_ids_are_checked(spark, raw, landing):
    with pytest.raises(ValueError, match="partition name"):
        Ingestion(Lake(spark), landing, "a/b")


def test_schema_changes_are_refused(spark):
    lake = Lake(spark, "c_")
    lake.bootstrap()
    lake.create("c_bronze.t", "a INT, _batch_id STRING", ("_batch_id",))
    with pytest.raises(ValueError, match="does not accept"):
        lake.replace_partitions(spark.sql("SELECT 1L AS a, 'x' AS _batch_id"), "c_bronze.t")


def test_inventory_and_exports(spark, raw, landing):
    tables = {name: scan_files(spark, landing, name) for name in LOAD_ORDER}
    require_inventory(source_inventory(tables))
    del tables["dim_line"]
    with pytest.raises(ValueError, match="dim_line=MISSING"):
        require_inventory(source_inventory(tables))
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    export_tables({"dim_factory": tables["dim_factory"].drop("_source_file")}, folder, [{"id": 1}])
    again = spark.read.option("header", True).csv(f"{folder}/csv/dim_factory")
    assert again.first().factory_id == "F1"
    assert spark.read.parquet(f"{folder}/dim_factory.parquet").count() == 1
    assert json.loads(spark.read.text(f"{folder}/manifest").first().value) == {"id": 1}


def test_a_repeated_attempt_stores_each_row_once(spark, raw, monkeypatch):
    """A run dies before its audit, the missing parent arrives, the same batch id runs again."""
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for table, base in DIMS.items():
        change = {"factory_id": "F9"} if table == "dim_factory" else {}
        write(raw, folder, table, base, change)
    write(raw, folder, "fact_production", LOT, {})
    write(raw, folder, "fact_quality_event", EVENT, {})
    lake, other = Lake(spark, "retry_"), Lake(spark, "other_")
    append, died = Lake.append, []

    def dies_once(self, frame, table):
        if not died and frame.filter("table_name = 'fact_production'").count():
            died.append(table)
            raise RuntimeError("lost")
        append(self, frame, table)

    monkeypatch.setattr(Lake, "append", dies_once)
    with pytest.raises(RuntimeError, match="lost"):
        Ingestion(lake, folder, "same").run()
    other.bootstrap()
    for table in ("dim_factory", "dim_line"):
        write(raw, folder, table, DIMS[table], {}, part=2)
        Ingestion(lake, folder, "late").ingest(table)
    again = Ingestion(lake, folder, "same").ingest("fact_production")
    assert again == {"source": 1, "valid": 1, "quarantined": 0, "skipped": 0}
    assert lake.table("bronze", "fact_production").count() == 1
    quarantined = spark.table(lake.quarantine).filter("table_name = 'fact_production'")
    assert quarantined.count() == 0 and spark.table(other.quarantine).count() == 0


def test_new_files_have_the_union_schema(spark, raw):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    write(raw, folder, "fact_production", LOT, {})
    write(raw, folder, "fact_production", LOT, {"production_lot_id": "L2"}, part="b{1}", without=("scrap_qty",))
    listed = list_files(spark, folder, "fact_production")
    fresh = scan_new_files(spark, folder, "fact_production", listed.filter("path LIKE '%{1}%'"))
    assert set(fresh.columns) == set(scan_files(spark, folder, "fact_production").columns)
    assert [(r.production_lot_id, r.scrap_qty) for r in fresh.collect()] == [("L2", None)]


WRITES = ("begin", "replace_partitions", "replace_partitions", "append", "append", "append", "end")


@pytest.fixture(scope="module")
def few_files(raw):
    """An earlier lot."""
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    write(raw, folder, "fact_production", LOT, {})
    return folder


@pytest.fixture(scope="module")
def second_batch(raw):
    """One stored, one new and one wrong lot."""
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    lots = ({}, {"production_lot_id": "L2"}, {"production_lot_id": "L3", "pass_qty": "1"})
    write(raw, folder, "fact_production", LOT, *lots, part=2)
    return folder


def lake_with_parents(spark, prefix):
    lake = Lake(spark, prefix)
    lake.bootstrap()
    for stem, value in (("factory", "F1"), ("line", "N1"), ("product", "P1")):
        spark.sql(f"SELECT '{value}' AS {stem}_id").write.saveAsTable(lake.name("bronze", f"dim_{stem}"))
    return lake


@pytest.mark.parametrize("step", range(len(WRITES)))
def test_a_crash_between_any_two_writes_is_repaired(spark, few_files, second_batch, monkeypatch, step):
    """Log, quarantine, Bronze, audit (the commit), two key indexes, log: die after each."""
    lake, folder = lake_with_parents(spark, f"crash{step}_"), second_batch
    Ingestion(lake, few_files, "first").ingest("fact_production")

    calls = []

    def dying(name):
        kept = getattr(Lake, name)

        def run(self, *arguments):
            kept(self, *arguments)
            calls.append(name)
            if len(calls) == step + 1:
                raise RuntimeError("lost")

        return run

    with monkeypatch.context() as patch:
        for name in dict.fromkeys(WRITES):
            patch.setattr(Lake, name, dying(name))
        with pytest.raises(RuntimeError, match="lost"):
            Ingestion(lake, folder, "second").ingest("fact_production")
    assert tuple(calls) == WRITES[: step + 1]
    Ingestion(lake, folder, "third").ingest("fact_production")

    lots = lake.table("bronze", "fact_production")
    assert sorted(r.production_lot_id for r in lots.collect()) == ["L1", "L2"]
    rejected = spark.table(lake.quarantine).filter("table_name = 'fact_production'")
    assert sorted(r._error_code for r in rejected.collect()) == ["DUPLICATE_KEY", "INVALID_PRODUCTION_TOTAL"]
    audit = spark.table(lake.audit).filter("table_name = 'fact_production'")
    assert sorted(r.valid_rows for r in audit.collect()) == [1, 1]
    assert lake.open_attempts("fact_production") == []
    for index in Ingestion(lake, folder, "x").indexes("fact_production"):
        stored = spark.table(index.name).select(*index.columns).distinct()
        assert {r.production_lot_id for r in stored.collect()} == {"L1", "L2"}
        assert stored.count() == 2


def test_a_load_reads_the_months_and_slices_of_its_batch(spark, raw, few_files):
    lake = Lake(spark, "near_")
    lake.bootstrap()
    ingestion = Ingestion(lake, few_files, "near")
    lake.create(lake.name("bronze", "fact_production"), ingestion.contracts["fact_production"].ddl, ("_batch_id",))
    ingestion.recover("fact_production")
    dated, by_lot = ingestion.indexes("fact_production")
    days = ", ".join(f"({i}, DATE'2026-0{i % 6 + 1}-10')" for i in range(600))
    lots = spark.sql(f"SELECT concat('L', c1) AS production_lot_id, c2 AS production_date FROM VALUES {days} AS t(c1, c2)")
    lots = lots.selectExpr("*", "'F1' AS factory_id", "'N1' AS line_id", "'P1' AS product_id")
    for index in (dated, by_lot):
        index.add(lots)
    batch = lots.filter("production_lot_id IN ('L3', 'L9')")  # both in April
    for index in (dated, by_lot):
        profile = keys.key_profile(batch, index.columns)
        near = index.near(profile)
        assert keys.held_keys(profile, index.columns, near).count() == 2
        assert 2 <= near.count() <= 100  # a month, or two slices, of 600
        with contextlib.redirect_stdout(io.StringIO()) as plan:
            near.explain("formatted")
        filters = next(line for line in plan.getvalue().splitlines() if line.startswith("PartitionFilters"))
        assert "_slice" in filters and "_month" in filters
        assert len(near.inputFiles()) <= 2
    missing = keys.held_keys(keys.key_profile(lots, dated.columns), dated.columns, dated.near(batch), held=False)
    assert missing.count() == 600 - dated.near(batch).count()
    # A day that no stored row can have touches nothing.
    odd = batch.withColumn("production_date", F.lit("1990-01-01").cast("date"))
    assert dated.near(keys.key_profile(odd, dated.columns)).count() == 0


def test_an_index_is_built_from_rows_stored_before_it(spark, raw, few_files):
    lake = lake_with_parents(spark, "late_")
    Ingestion(lake, few_files, "one").ingest("fact_production")
    ingestion = Ingestion(lake, few_files, "two")
    for index in ingestion.indexes("fact_production"):
        spark.sql(f"DROP TABLE {index.name}")
    ingestion.recover("fact_production")
    for index in ingestion.indexes("fact_production"):
        assert spark.table(index.name).count() == 1
