"""Shares, ranks and running totals over aggregated groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millsight.functions.metrics import ratio
from millsight.operators.ordering import with_dense_rank


def share_within(frame: DataFrame, measure: str, scope: Sequence[str], name: str) -> DataFrame:
    """``measure`` divided by its total over ``scope``; NULL where the total is zero.

    For frames that are already aggregated to a grain whose rows per scope are bounded by a
    dimension (products of a factory day, defects of a scope).
    """
    total = F.sum(measure).over(Window.partitionBy(*scope))
    return frame.withColumn(name, ratio(F.col(measure), total))


def dense_rank_all(frame: DataFrame, measure: str, name: str) -> DataFrame:
    """Dense rank of every row over the whole frame, largest ``measure`` first."""
    return with_dense_rank(frame, measure, name)


def ranked_contribution(
    frame: DataFrame, by: Sequence[str], measure: str, name: str = "contribution_rank"
) -> DataFrame:
    """Total of ``measure`` per group and the group's dense rank among all groups."""
    totals = frame.groupBy(*by).agg(F.sum(measure).alias(measure))
    return dense_rank_all(totals, measure, name)


def leading_contributors(
    frame: DataFrame, by: Sequence[str], measure: str, ranks: int = 3, name: str = "contribution_rank"
) -> DataFrame:
    """The groups of the first ``ranks`` dense ranks: a top-k report.

    Every task keeps its ``ranks`` largest distinct totals, these meet as one short list, and the groups
    find their total in it where they are: groups of equal totals, however many, never meet.
    """
    totals = frame.groupBy(*by).agg(F.sum(measure).alias(measure))
    largest = totals.select(F.col(measure).alias("_total")).distinct()
    largest = largest.filter("_total IS NOT NULL").orderBy(F.desc("_total")).limit(ranks)
    top = largest.agg(F.sort_array(F.collect_list("_total"), asc=False)).scalar()
    place = F.array_position(top, F.col(measure)).cast("int")
    place = F.when(F.col(measure).isNull(), F.size(top) + 1).otherwise(place)
    return totals.withColumn(name, place).filter((F.col(name) > 0) & (F.col(name) <= ranks))


def rank_of(frame: DataFrame, by: Sequence[str], measure: str, entity: dict[str, str]) -> DataFrame:
    """One row: the dense rank of one group, 999 where the group is absent.

    The rank is one more than the number of distinct larger totals, so no ordering is needed.
    """
    totals = frame.groupBy(*by).agg(F.sum(measure).alias("_total"))
    match = F.lit(True)
    for column, value in entity.items():
        match = match & (F.col(column) == F.lit(value))
    return rank_among(totals.withColumn("_own", match))


def rank_among(totals: DataFrame) -> DataFrame:
    """One row: the dense rank of the group marked ``_own`` among groups of a ``_total`` each."""
    own = totals.filter("_own").agg(F.max("_total")).scalar()
    larger = F.count_if(F.col("_total") > own)
    rank = F.when(own.isNull(), F.lit(999)).otherwise(larger + 1).cast("long")
    return totals.select("_total").distinct().agg(rank.alias("contribution_rank"))


def pareto(
    frame: DataFrame,
    scope: Sequence[str],
    measure: str,
    lead: Sequence[str],
    rest: Sequence[str],
) -> DataFrame:
    """Total, running total and dense rank of ``measure`` per scope, largest first.

    ``frame`` has one row per (scope, lead, rest). Rows of equal measure follow ``lead`` then
    ``rest`` in ascending order, NULLs first, which makes the running total unique.

    A scope may hold a large share of the rows, so no window runs over a whole scope at row grain.
    Rows are grouped into blocks (scope, measure, lead); the blocks, one aggregated row each, are
    accumulated over the scope. Inside a block all rows have the same measure, so the running total
    is the block's start plus measure times the position in the block.
    """
    block, columns = [*scope, measure, *lead], frame.columns
    # One number stands first for a block: rows are sorted by it, not by the members one after another.
    frame = frame.withColumn("_block", F.xxhash64(*block))
    sizes = frame.groupBy("_block", *block).agg(F.count(F.lit(1)).alias("_rows"))
    weight = F.col(measure) * F.col("_rows")
    largest = [F.col(measure).desc(), *[F.col(c).asc_nulls_first() for c in lead]]
    within = Window.partitionBy(*scope)
    ordered = within.orderBy(*largest)
    sizes = sizes.withColumns(
        {
            "cumulative_failures": F.sum(weight).over(
                ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
            "pareto_rank": F.dense_rank().over(within.orderBy(F.col(measure).desc())),
            "total_failures": F.sum(weight).over(within),
        }
    )
    sizes = sizes.withColumn("_start", F.col("cumulative_failures") - weight)
    sizes = sizes.select(
        *[F.col(c).alias(f"_b_{c}") for c in ("_block", *block)], "_start", "pareto_rank", "total_failures"
    )
    match = F.col("_block") == F.col("_b__block")
    for c in block:
        match = match & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    order = [F.col(c).asc_nulls_first() for c in rest]
    position = F.row_number().over(Window.partitionBy("_block", *block).orderBy(*order))
    placed = frame.withColumn("_position", position).join(sizes, match)
    running = F.col("_start") + F.col(measure) * F.col("_position")
    ranked = placed.withColumn("cumulative_failures", running)
    return ranked.select(*columns, "total_failures", "cumulative_failures", "pareto_rank")


def benchmark_rank(frame: DataFrame, scope: Sequence[str], metric: str, name: str) -> DataFrame:
    """Rank of each entity's ``metric`` inside ``scope``, best first, NULLs last."""
    order = Window.partitionBy(*scope).orderBy(F.col(metric).desc_nulls_last())
    return frame.withColumn(name, F.rank().over(order))


def lead_over_runner_up(
    frame: DataFrame, scope: Sequence[str], entity: str, measure: str, factor: float
) -> DataFrame:
    """Per scope: the largest total, the runner-up and whether the lead exceeds ``factor`` times it."""
    totals = frame.groupBy(*scope, entity).agg(F.sum(measure).alias("_total"))
    order = Window.partitionBy(*scope).orderBy(F.desc("_total"), F.asc(entity))
    first_two = totals.withColumn("_place", F.row_number().over(order)).filter("_place <= 2")
    first, second = F.col("_place") == 1, F.col("_place") == 2
    result = first_two.groupBy(*scope).agg(
        F.max(F.when(first, F.col(entity))).alias(f"leading_{entity}"),
        F.max(F.when(first, F.col("_total"))).alias("leading_quantity"),
        F.max(F.when(second, F.col("_total"))).alias("runner_up_quantity"),
    )
    clear = F.col("leading_quantity") > F.lit(factor) * F.col("runner_up_quantity")
    return result.withColumn("is_concentrated", F.coalesce(clear, F.lit(True)))
