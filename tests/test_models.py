"""Silver and Gold models and governed metrics on hand-made frames."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millsight.contracts import PRODUCTION_KEY
from millsight.functions.metrics import ADDITIVE, metrics_at
from millsight.operators.keys import keep_resolved, latest_record
from millsight.plans import gold, silver

LOT = "production_lot_id string, production_date date, factory_id string, line_id string, product_id string"
QTY = "production_qty long, pass_qty long, started_qty long, completed_qty long, first_pass_pass_qty long, fail_qty long, rework_qty long, scrap_qty long"
SENT = "_ingested_at timestamp, _source_file string, _batch_id string"
T1, T2 = datetime(2026, 1, 1), datetime(2026, 1, 2)


@pytest.fixture(scope="module")
def lots(frame):
    def build(*rows):
        """(lot, day, factory, line, product, passed, failed[, made])"""
        full = []
        for lot, day, factory, line, product, passed, failed, *made in rows:
            total = passed + failed
            done = made[0] if made else total
            full.append((lot, date.fromisoformat(day), factory, line, product, total, passed, total, done,
                         passed, failed, failed, 0))
        return frame(f"{LOT}, {QTY}", *full)

    return build


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


# --- metrics ---------------------------------------------------------------------------------


def test_rates_come_from_sums_and_zero_denominators_give_null(lots):
    production = lots(
        ("a", "2026-01-05", "F", "N", "P", 90, 10),
        ("b", "2026-01-05", "F", "N", "Q", 1, 9),
        ("c", "2026-01-05", "G", "N", "P", 0, 0),
    )
    found = {r.factory_id: r for r in metrics_at(production, ("factory_id",), measures=ADDITIVE).collect()}
    assert found["F"].fpy == 91 / 110 and found["F"].yield_loss == 1.0 - 91 / 110
    assert found["F"].dppm == 19 * 1e6 / 110 and found["F"].rework_rate == 19 / 110
    assert found["G"].fpy is None and found["G"].dppm is None and found["G"].yield_loss is None
    assert metrics_at(production, measures=ADDITIVE).first().production_quantity == 110


# --- conforming ------------------------------------------------------------------------------


def test_latest_record_settles_ties_without_row_order(frame):
    data = [("k", T1, "f1", "a"), ("k", T2, "f2", "b"), ("k", T2, "f1", "d"), ("k", T2, "f1", "c")]
    for order in (data, data[::-1]):
        df = frame("id string, _ingested_at timestamp, _source_file string, v string", *order).repartition(3)
        assert latest_record(df, ("id",)).first().v == "c"


def test_spellings_of_one_key_meet(frame):
    schema = f"factory_id string, factory_code string, factory_name string, country string, baseline_fpy double, {SENT}"
    bronze = frame(
        schema,
        ("F1", "a1", "Old", "X", 0.9, T1, "f", "b"),
        (" F1", " a1 ", " New ", "X", 0.9, T2, "f", "b"),
    )
    conformed = silver.conform_dimension(bronze, "dim_factory")
    assert rows(conformed, "factory_id", "factory_code", "factory_name") == [("F1", "A1", "New")]
    as_sent = silver.conform_dimension(bronze, "dim_factory", normalize_first=False)
    assert as_sent.count() == 2


@pytest.fixture(scope="module")
def dims(frame):
    return {
        "dim_date": frame("date date", (date(2026, 1, 5),)),
        "dim_factory": frame("factory_id string", ("F1",), ("F2",)),
        "dim_line": frame("line_id string, factory_id string", ("N1", "F1")),
        "dim_product": frame("product_id string", ("P1",)),
        "dim_component": frame("component_id string", ("C1",)),
        "dim_supplier": frame("supplier_id string", ("S1",), ("S1",)),
        "dim_defect": frame("defect_id string", ("D1",)),
    }


def sent(df, when=T1):
    return df.withColumns({"_ingested_at": F.lit(when), "_source_file": F.lit("f"), "_batch_id": F.lit("b")})


def test_production_relations_and_quantities(lots, dims):
    bronze = sent(
        lots(
            ("ok", "2026-01-05", "F1", "N1", "P1", 9, 1),
            ("padded", "2026-01-05", "F1", " N1", "P1", 9, 1),
            ("day", "2026-01-06", "F1", "N1", "P1", 9, 1),
            ("line of another factory", "2026-01-05", "F2", "N1", "P1", 9, 1),
            ("too many", "2026-01-05", "F1", "N1", "P1", 9, 1, 11),
        )
    )
    kept = silver.conform_production(bronze, dims)
    assert rows(kept, "production_lot_id", "line_id", "production_year", "production_week") == [
        ("ok", "N1", 2026, 2),
        ("padded", "N1", 2026, 2),
    ]
    assert rows(silver.conform_production(bronze, dims, False), "production_lot_id") == [("ok",)]


EVENT = (
    "quality_event_id string, event_date date, event_timestamp timestamp, production_lot_id string, factory_id string,"
    " line_id string, product_id string, component_id string, supplier_id string, component_lot_id string,"
    " defect_id string, inspection_stage string, event_quantity long, is_first_pass_failure boolean,"
    " is_rework boolean, is_scrap boolean, disposition string"
)


@pytest.fixture(scope="module")
def events(frame):
    def build(*changes):
        base = {
            "quality_event_id": "E", "event_date": date(2026, 1, 5), "event_timestamp": T1,
            "production_lot_id": "ok", "factory_id": "F1", "line_id": "N1", "product_id": "P1",
            "component_id": "C1", "supplier_id": "S1", "component_lot_id": "CL", "defect_id": "D1",
            "inspection_stage": "final", "event_quantity": 2, "is_first_pass_failure": True,
            "is_rework": False, "is_scrap": False, "disposition": "fail",
        }
        full = [tuple({**base, "quality_event_id": f"E{i}", **c}.values()) for i, c in enumerate(changes)]
        return frame(EVENT, *full)

    return build


def test_event_relations(lots, events, dims):
    production = lots(("ok", "2026-01-05", "F1", "N1", "P1", 9, 1), ("ok", "2026-01-05", "F1", "N1", "P1", 9, 1))
    bronze = sent(
        events(
            {},
            {"supplier_id": None},
            {"supplier_id": "S9"},
            {"production_lot_id": "gone"},
            {"event_date": date(2026, 1, 4)},
            {"inspection_stage": " FINAL"},
            {"event_quantity": 0},
            {"disposition": "pass"},
        )
    )
    kept = silver.conform_events(bronze, production, dims)
    assert rows(kept, "quality_event_id", "is_supplier_attributed", "inspection_stage") == [
        ("E0", True, "final"),
        ("E1", False, "final"),
        ("E5", True, "final"),
    ]
    assert rows(silver.conform_events(bronze, production, dims, False), "quality_event_id") == [("E0",), ("E1",)]


def test_keep_resolved_equals_semi_join(spark):
    child = spark.range(2000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 100 END AS k")
    parent = spark.range(0, 200, 2).selectExpr("id AS p").union(spark.sql("SELECT 7L"))
    expected = child.join(parent, F.col("k") == F.col("p"), "left_semi").count()
    for parent in (parent, parent.union(parent)):
        kept = keep_resolved(child, ("k",), parent, ("p",))
        assert kept.count() == expected and kept.columns == ["id", "k"]


# --- Gold ------------------------------------------------------------------------------------


def test_week_over_week_uses_the_previous_present_week(lots):
    production = lots(
        ("a", "2026-01-05", "F", "N", "P", 9, 1),
        ("b", "2026-01-06", "F", "N", "P", 5, 5),
        ("c", "2026-01-26", "F", "N", "P", 10, 0),
        ("d", "2026-02-02", "F", "N", "P", 0, 0),
        ("e", "2026-02-09", "F", "N", "P", 1, 1),
    )
    daily = gold.manufacturing_daily(production)
    found = rows(daily, "production_date", "reporting_week", "week_fpy", "wow_fpy_change")
    assert [r[1:] for r in found] == [
        (2, 0.7, None),
        (2, 0.7, None),
        (5, 1.0, 1.0 - 0.7),
        (6, None, None),
        (7, 0.5, None),
    ]
    weekly = gold.week_over_week(gold.weekly_fpy(gold.daily_rollup(production)))
    assert rows(weekly, "reporting_week", "wow_fpy_change") == [(2, None), (5, 1.0 - 0.7), (6, None), (7, None)]


def test_year_boundary(lots):
    production = lots(("a", "1996-01-02", "F", "N", "P", 1, 1), ("b", "1996-12-30", "F", "N", "P", 2, 0))
    plain = gold.manufacturing_daily(production)
    assert rows(plain, "reporting_year", "reporting_week", "week_fpy") == [(1996, 1, 0.75), (1996, 1, 0.75)]
    iso = gold.manufacturing_daily(production, iso_year=True)
    assert rows(iso, "reporting_year", "reporting_week", "wow_fpy_change") == [(1996, 1, None), (1997, 1, 0.5)]


def test_mix_shares_add_up(lots, frame):
    production = lots(
        ("a", "2026-01-05", "F", "N", "P", 30, 0),
        ("b", "2026-01-05", "F", "M", "Q", 10, 0),
        ("c", "2026-01-05", "G", "N", "P", 0, 0),
    )
    products = frame("product_id string, product_name string, product_family string", ("P", "p", "x"), ("Q", "q", "x"))
    found = gold.product_quality(production, products)
    assert rows(found, "factory_id", "product_id", "product_mix_share") == [
        ("F", "P", 0.75),
        ("F", "Q", 0.25),
        ("G", "P", None),
    ]


def test_a_lot_counts_once_per_supplier_group(lots, events, frame):
    production = lots(
        ("ok", "2026-01-05", "F1", "N1", "P1", 9, 1),
        ("ok", "2026-01-06", "F1", "N2", "P1", 5, 0),
    )
    found = gold.attributed_lots(
        events({}, {}, {"is_first_pass_failure": False}, {"supplier_id": "S2"}, {"supplier_id": None}).withColumn(
            "is_supplier_attributed", F.col("supplier_id").isNotNull()
        ),
        production,
    )
    assert rows(found, "supplier_id", "defective_units", "inspected_units") == [("S1", 4, 15), ("S2", 2, 15)]


def test_pareto_matches_a_plain_window(spark, frame):
    """Many ties, NULL suppliers and one day that holds most rows."""
    rows_ = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 < 2 THEN DATE'2026-01-05' ELSE date_add(DATE'2026-01-06', CAST(id % 5 AS INT)) END AS event_date",
        "concat('F', id % 2) AS factory_id",
        "concat('N', id % 7) AS line_id",
        "concat('P', id % 3) AS product_id",
        "concat('C', id % 11) AS component_id",
        "CASE WHEN id % 4 <> 0 THEN concat('S', id % 5) END AS supplier_id",
        "concat('D', id % 6) AS defect_id",
        "id % 13 <> 0 AS is_first_pass_failure",
        "1 + id % 3 AS event_quantity",
    )
    defects = spark.range(6).selectExpr("concat('D', id) AS defect_id", "'n' AS defect_name", "'c' AS defect_category")
    found = gold.defect_pareto(rows_, defects)
    scope = Window.partitionBy("event_date", "factory_id")
    order = scope.orderBy(
        F.desc("defect_quantity"), "defect_id", "line_id", "product_id", "component_id",
        F.asc_nulls_first("supplier_id"),
    )
    expected = found.withColumns(
        {
            "total": F.sum("defect_quantity").over(scope),
            "running": F.sum("defect_quantity").over(order.rowsBetween(Window.unboundedPreceding, 0)),
            "place": F.dense_rank().over(scope.orderBy(F.desc("defect_quantity"))),
        }
    )
    wrong = expected.filter("total <> total_failures OR running <> cumulative_failures OR place <> pareto_rank")
    assert wrong.count() == 0
    ends = found.groupBy("event_date", "factory_id").agg(
        F.max("cumulative_defect_contribution").alias("m"), F.sum("defect_contribution").alias("s")
    )
    assert all(r.m == 1.0 and abs(r.s - 1) < 1e-9 for r in ends.collect())


def test_pareto_without_first_pass_failures(events, frame):
    defects = frame("defect_id string, defect_name string, defect_category string", ("D1", "n", "c"))
    row = gold.defect_pareto(events({"is_first_pass_failure": False}), defects).first()
    assert row.defect_quantity == 0 and row.total_failures == 0 and row.defect_contribution is None


def test_production_key_is_the_declared_grain():
    assert PRODUCTION_KEY == ("production_date", "factory_id", "line_id", "product_id", "production_lot_id")
