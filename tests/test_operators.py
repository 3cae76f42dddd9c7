"""Ranking, evidence, checks and view operators."""

from __future__ import annotations

import contextlib
import io
import tempfile
from datetime import date

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millsight.functions.calendar import Period
from millsight.operators import ordering, ranking
from millsight.plans import bi, checks, evidence
from millsight.session import written


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def day(text):
    return date.fromisoformat(text)


MAY, JUNE = Period.of("2026-05-01", "2026-05-31"), Period.of("2026-06-01", "2026-06-30")


# --- ranking ---------------------------------------------------------------------------------


def test_dense_rank_all_matches_a_plain_window(spark):
    values = spark.range(5000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 7 = 0 THEN -id ELSE id * id % 4001 * 1000003 END AS v"
    )
    found = ranking.dense_rank_all(values, "v", "place")
    expected = found.withColumn("plain", F.dense_rank().over(Window.orderBy(F.desc("v"))))
    assert expected.filter("plain <> place").count() == 0 and found.count() == 5000


def test_rank_of_and_leaders(frame):
    df = frame("a string, q long", ("x", 5), ("x", 5), ("y", 10), ("z", 20), ("w", 1))
    for entity, rank in (("z", 1), ("x", 2), ("y", 2), ("w", 3), ("none", 999)):
        assert ranking.rank_of(df, ("a",), "q", {"a": entity}).first().contribution_rank == rank
    assert ranking.rank_of(df.limit(0), ("a",), "q", {"a": "x"}).first().contribution_rank == 999
    leaders = ranking.leading_contributors(df, ("a",), "q", 2)
    assert rows(leaders, "a", "contribution_rank") == [("x", 2), ("y", 2), ("z", 1)]
    ranked = ranking.ranked_contribution(df, ("a",), "q")
    assert rows(ranked, "a", "contribution_rank") == [("w", 3), ("x", 2), ("y", 2), ("z", 1)]


def plan_of(df) -> str:
    with contextlib.redirect_stdout(io.StringIO()) as text:
        df.explain("formatted")
    return text.getvalue()


def test_common_values_spread_and_no_task_ranks_all(spark):
    """Half the rows share one value: its rows lie in several ranges and have one rank."""
    values = spark.range(4000).selectExpr("id", "CASE WHEN id % 2 = 0 THEN 5 ELSE id % 11 END AS v", "NULL AS n")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # a few rows are one range else
    ranges = ordering.in_ranges(values.repartition(3), [F.desc("v"), F.col("id")])
    assert ranges.filter("v = 5").select("_range").distinct().count() > 1
    ranked = ordering.with_dense_rank(values, "v", "place")
    plain = ranked.withColumn("plain", F.dense_rank().over(Window.orderBy(F.desc("v"))))
    assert plain.filter("place <> plain").count() == 0 and ranked.count() == 4000
    assert ordering.with_dense_rank(values.withColumn("n", F.lit(None).cast("int")), "n", "r").filter("r IS NOT NULL").count() == 0
    plan = plan_of(ranked)
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]
    for node in plan.split("\n\n"):  # joined by range number, windows inside ranges only
        if "SortMergeJoin" in node or "BroadcastHashJoin" in node:
            assert "_range" in node or "Left keys" not in node
        if node.lstrip().startswith("(") and ") Window" in node:
            assert "_range" in node
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_positions_follow_the_order(spark, frame):
    values = spark.range(3000).selectExpr("id", "id * 7919 % 101 AS v")
    order = [F.desc("v"), F.col("id").asc()]
    placed = ordering.with_position(values.repartition(5), order)
    plain = placed.withColumn("plain", F.row_number().over(Window.orderBy(*order)))
    assert plain.filter("position <> plain").count() == 0 and placed.count() == 3000
    assert ordering.with_position(values.limit(0), order).count() == 0
    equal = frame("a int", (1,), (1,), (None,))
    assert rows(ordering.with_position(equal, [F.col("a").asc_nulls_first()]), "position") == [(1,), (2,), (3,)]


def test_leaders_need_no_window(frame):
    df = frame("a string, q long", *[(f"t{i}", 7) for i in range(50)], ("top", 9), ("low", 1), ("none", None))
    found = ranking.leading_contributors(df, ("a",), "q", 2)
    assert found.filter("contribution_rank = 2").count() == 50 and found.count() == 51
    assert "Window" not in plan_of(found)
    every = ranking.leading_contributors(df, ("a",), "q", 9)
    assert rows(every.filter("a IN ('none', 'low')"), "a", "contribution_rank") == [("low", 3), ("none", 4)]


def test_lot_concentration(frame):
    schema = "component_id string, supplier_id string, component_lot_id string, event_quantity long"
    df = frame(schema, ("C", "S", "bad", 31), ("C", "S", "a", 10), ("C", "S", "b", 4), ("C", "T", "a", 1),
               ("C", "U", "a", 30), ("C", "U", "b", 10), ("C", None, "z", 99))
    found = evidence.lot_concentration(df)
    assert rows(found, "supplier_id", "leading_component_lot_id", "is_concentrated") == [
        ("S", "bad", True), ("T", "a", True), ("U", "a", False),
    ]


# --- evidence --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def mix(frame):
    """Aggregate FPY falls because volume moves to Q, whose FPY is lower and steady."""
    schema = (
        "production_date date, factory_id string, product_id string, production_quantity long,"
        " pass_quantity long, fail_quantity long, rework_quantity long, scrap_quantity long"
    )
    return frame(
        schema,
        (day("2026-05-10"), "F", "P", 900, 891, 9, 9, 0),
        (day("2026-05-10"), "F", "Q", 100, 90, 10, 4, 0),
        (day("2026-06-10"), "F", "P", 100, 99, 1, 1, 0),
        (day("2026-06-10"), "F", "Q", 900, 810, 90, 30, 0),
        (day("2026-06-10"), "F", "NEW", 10, 10, 0, 0, 0),
        (day("2026-07-10"), "F", "P", 5, 0, 5, 0, 0),
        (day("2026-05-10"), "G", "P", 5, 0, 5, 0, 0),
    )


def test_mix_effect(mix):
    scope = {"factory_id": "F"}
    row = evidence.mix_versus_within(mix, mix, {"pre": MAY, "post": JUNE}, scope).first()
    assert row.aggregate_pre_fpy == 0.981 and row.aggregate_fpy_change < -0.06
    assert row.mean_absolute_product_fpy_change < 1e-12
    stable = evidence.within_product_stability(mix, MAY, JUNE, scope).first()
    assert stable.is_stable and stable.products == 2
    shift = {r.product_id: r.direction for r in evidence.mix_shift(mix, MAY, JUNE, scope).collect()}
    assert shift == {"P": -1, "Q": 1, "NEW": 1}


def test_change_decomposition_adds_up(mix):
    only = mix.filter("factory_id = 'F'")
    parts = bi.fpy_change_decomposition(only, MAY, JUNE, "product_id").collect()
    total = sum(r.rate_effect + r.mix_effect for r in parts)
    change = evidence.mix_versus_within(mix, mix, {"pre": MAY, "post": JUNE}, {"factory_id": "F"}).first()
    assert abs(total - change.aggregate_fpy_change) < 1e-12
    assert all(abs(r.rate_effect) < 1e-12 for r in parts if r.product_id != "NEW")
    assert total < 0 and sum(r.mix_effect for r in parts) < 0


def test_lift_and_unattributed_share(frame):
    schema = "event_date date, line_id string, supplier_id string, event_quantity long"
    df = frame(schema, (day("2026-05-02"), "N", "S", 1), (day("2026-06-02"), "N", None, 3),
               (day("2026-06-03"), "M", "S", 3), (day("2026-05-03"), "M", "S", 2), (day("2026-06-04"), "O", "S", 1))
    lift = evidence.window_lift(df, JUNE, MAY, ("line_id",))
    assert rows(lift, "line_id", "lift", "is_lifted") == [("M", 1.5, False), ("N", 3.0, True), ("O", None, True)]
    share = evidence.unattributed_share(df, JUNE, ("line_id",))
    assert rows(share, "line_id", "unattributed_share") == [("M", 0.0), ("N", 1.0), ("O", 0.0)]


def test_learning_curve(mix):
    back = evidence.learning_curve(mix, JUNE, MAY, {"factory_id": "F"}).first()
    assert back.improves and back.is_ramp
    assert evidence.learning_curve(mix, MAY, JUNE, {"factory_id": "F"}).first().improves is False


# --- checks ----------------------------------------------------------------------------------


def test_one_sided_null_rates_are_mismatches(frame):
    df = frame(
        "fpy double, pass_quantity long, fail_quantity long",
        (0.5, 1, 1), (None, 1, 1), (None, 0, 0), (0.5, 0, 0), (0.6, 1, 1),
    )
    wrong = evidence.stored_rate_mismatches(df, ("fpy",))
    assert df.filter(wrong).count() == 3


def test_a_gold_table_is_read_once_for_all_its_checks(spark, frame):
    """Row count and both ranks of the Pareto model come from grouping sets over one scan."""
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    schema = (
        "event_date date, factory_id string, line_id string, product_id string, component_id string, "
        "supplier_id string, defect_id string, defect_quantity long"
    )
    data = [(day("2026-05-12"), "FAC-TW", "N", "PROD-X200", "COMP-MEM", "SUP-C", "DEF-MEM", 5),
            (day("2026-05-12"), "FAC-TW", None, "PROD-X200", "COMP-MEM", None, "DEF-MEM", 5),
            (day("2026-05-12"), "FAC-TW", "N", "PROD-X200", "COMP-PSU", "SUP-C", "DEF-MEM", 9),
            (day("2026-04-20"), "FAC-MX", "LINE-MX-02", "P", "C", "S", "DEF-VOLT", 3),
            (day("2026-04-20"), "FAC-MX", "LINE-MX-01", "P", "C", "S", "DEF-VOLT", 3),
            (day("2026-04-21"), "FAC-MX", "LINE-MX-01", "Q", "C", "S", "DEF-VOLT", 1),
            (day("2026-01-01"), "FAC-MX", "LINE-MX-01", "P", "C", "S", "DEF-VOLT", 99)]
    frame(schema, *data).write.parquet(f"{folder}/pareto")
    spec = checks.Acceptance()
    wanted = [
        checks.Contribution("b", spec.line_window, spec.line_entity),
        checks.Contribution("d", spec.local_window, spec.local_entity),
    ]
    def report(table):
        totals = checks._group_totals(table, "gold_defect_pareto", "defect_quantity", wanted)
        assert plan_of(totals).count("Scan parquet") <= 2  # the node and its details
        parts = checks._contribution_checks(written(totals, "test"), "gold_defect_pareto", wanted, spec)
        return [(r.check_name, r.actual) for part in parts for r in part.collect()]

    stored = spark.read.parquet(f"{folder}/pareto")
    assert report(stored) == [("row_count_gold_defect_pareto", "7"), ("b", "2"), ("d", "2")]
    assert [actual for _, actual in report(stored.limit(0))] == ["0", "999", "999"]


def test_acceptance_from_json():
    spec = checks.Acceptance.from_json('{"stability": 0.1, "mix_after": {"first": "2026-06-01", "last": "2026-06-02"}}')
    assert spec.stability == 0.1 and spec.mix_after == Period.of("2026-06-01", "2026-06-02")
    assert spec.mix_before == checks.Acceptance().mix_before


def test_enforce_fails_closed(frame):
    schema = "check_name string, status string, actual string, expected string, detail string"
    lines = []
    checks.enforce(frame(schema, ("a", "PASS", "1", "1", "")), lines.append)
    assert len(lines) == 2 and '"status": "PASS"' in lines[-1]
    with pytest.raises(RuntimeError, match="acceptance failed: b"):
        checks.enforce(frame(schema, ("a", "PASS", "1", "1", ""), ("b", "FAIL", None, "1", "")), lines.append)


def test_require_valid(frame):
    checks.require_valid(frame("message string, violations long", ("x", 0)))
    with pytest.raises(ValueError, match="Dataset validation failed: a; b"):
        checks.require_valid(frame("message string, violations long", ("b", 2), ("a", 1), ("x", 0)))


# --- view grain ------------------------------------------------------------------------------


def test_shares_and_benchmarks_follow_the_view(mix):
    month = bi.mix_share(mix, F.trunc("production_date", "month")).filter("factory_id = 'F'")
    assert rows(month.filter("period = DATE'2026-05-01'"), "product_id", "product_mix_share") == [
        ("P", 0.9),
        ("Q", 0.1),
    ]
    gap = bi.factory_benchmark(mix.filter("factory_id = 'F'"), ("factory_id", "product_id"))
    assert {r.factory_fpy for r in gap.collect()} == {1900 / 2015}
    kpis = bi.view_kpis(mix, scope={"factory_id": "G"}).first()
    assert kpis.fpy == 0.0 and kpis.dppm == 1e6


def test_defect_contribution_ends_at_one(frame):
    df = frame("factory_id string, defect_id string, defect_quantity long", ("F", "A", 6), ("F", "B", 3), ("F", "C", 3),
               ("G", "A", 0))
    found = bi.defect_contribution(df, ("factory_id",))
    assert rows(found, "factory_id", "defect_id", "cumulative_defect_contribution") == [
        ("F", "A", 0.5), ("F", "B", 0.75), ("F", "C", 1.0), ("G", "A", None),
    ]


def test_rolling_fpy_counts_calendar_days(frame):
    schema = "factory_id string, production_date date, pass_quantity long, fail_quantity long"
    df = frame(schema, ("F", day("2026-01-01"), 1, 1), ("F", day("2026-01-07"), 3, 0), ("F", day("2026-01-08"), 0, 1))
    found = bi.rolling_fpy(df, ("factory_id",))
    assert [r[1] for r in rows(found, "production_date", "rolling_fpy")] == [0.5, 0.8, 0.75]


def test_drill_and_detail(frame):
    df = frame(
        "factory_id string, product_id string, component_id string, defect_quantity long",
        ("F", "P", "A", 6), ("F", "P", "B", 2), ("F", "Q", "A", 1),
    )
    coarse = bi.include_detail(df, ("product_id",), "component_id")
    assert rows(coarse, "product_id", "mean_defect_quantity", "leading_share") == [("P", 4.0, 0.75), ("Q", 1.0, 1.0)]
    parents = bi.exclude_detail(df, ("product_id",), "component_id")
    assert rows(parents, "product_id", "component_id", "parent_defect_quantity") == [
        ("P", "A", 8), ("P", "B", 8), ("Q", "A", 1),
    ]


def test_pareto_sorts_blocks_by_one_number(frame):
    df = frame("s string, d string, r string, q long", ("a", "x", "1", 2), ("a", "x", "2", 2), ("a", None, "1", 2))
    found = ranking.pareto(df, ("s",), "q", ("d",), ("r",))
    assert found.columns == [*df.columns, "total_failures", "cumulative_failures", "pareto_rank"]
    assert sorted(r.cumulative_failures for r in found.collect()) == [2, 4, 6]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Sort [_block#" in plan


def test_pareto_keeps_rows_with_null_members(frame):
    df = frame(
        "day int, q long, defect string, line string, product string",
        (1, 5, "D", None, "P"), (1, 5, "D", "L", None), (1, 3, None, None, None), (1, 9, "E", "L", "P"),
    )
    found = ranking.pareto(df, ("day",), "q", ("defect", "line"), ("product",)).collect()
    assert sorted((r.q, r.cumulative_failures, r.pareto_rank, r.total_failures) for r in found) == [
        (3, 22, 3, 22), (5, 14, 2, 22), (5, 19, 2, 22), (9, 9, 1, 22)
    ]
