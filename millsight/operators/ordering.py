"""Places in a total order of a whole frame, without a task that sees all of it.

Rows are range-partitioned by the order and written once with the number of their range, so that sizes and
rows are read from the same partitioning whatever executor is lost. A row's place is its place in its range
plus the sizes of the ranges before it; there are no more ranges than shuffle partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millsight.session import written


def in_ranges(frame: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The frame as a written table with ``_range``; ranges follow each other in the order.

    An order that ends in columns unlike in every row lets equal leading values spread over ranges.
    """
    return written(frame.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ordered")


def range_offsets(sizes: DataFrame, before: Column) -> DataFrame:
    """(_range, _before) from one row per range.

    ``before`` is computed from ``ranges``, the sizes of all ranges in order, and ``at``, the place of the
    row's own range in them.
    """
    every = sizes.agg(F.sort_array(F.collect_list(F.struct("_range", *[c for c in sizes.columns if c != "_range"]))).alias("ranges"))
    placed = every.select("ranges", F.posexplode("ranges").alias("at", "own"))
    return placed.select("own._range", before.alias("_before"))


def with_position(frame: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """The frame with every row's place in a total order, from 1."""
    ranges = in_ranges(frame, order)
    sizes = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("rows"))
    earlier = F.expr("aggregate(slice(ranges, 1, at), 0L, (n, r) -> n + r.rows)")
    offsets = F.broadcast(range_offsets(sizes, earlier))  # a row per range
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    placed = ranges.withColumn("_inside", inside).join(offsets, "_range")
    return placed.select(*frame.columns, (F.col("_before") + F.col("_inside")).alias(name))


def with_dense_rank(frame: DataFrame, measure: str, name: str) -> DataFrame:
    """The frame with the dense rank of ``measure``, largest first; NULL where it is NULL.

    A range counts its distinct values; a value that goes on from the range before counts once. Rows of
    one value are told apart by the other columns, so a common value spreads over ranges.
    """
    rest = [F.col(c).asc_nulls_first() for c in frame.columns if c != measure]
    ranges = in_ranges(frame, [F.col(measure).desc_nulls_last(), *rest])
    sizes = ranges.groupBy("_range").agg(
        F.count_distinct(measure).alias("found"), F.max(measure).alias("first"), F.min(measure).alias("last")
    )
    found = "aggregate(slice(ranges, 1, at), 0L, (n, r) -> n + r.found)"
    goes_on = "ranges[i].first <=> ranges[i - 1].last AND ranges[i].first IS NOT NULL"
    again = f"size(filter(sequence(0, at), i -> CASE WHEN i > 0 THEN {goes_on} ELSE FALSE END))"
    offsets = F.broadcast(range_offsets(sizes, F.expr(f"{found} - {again}")))  # a row per range
    inside = F.dense_rank().over(Window.partitionBy("_range").orderBy(F.col(measure).desc_nulls_last()))
    placed = ranges.withColumn("_inside", inside).join(offsets, "_range")
    rank = F.when(F.col(measure).isNotNull(), F.col("_before") + F.col("_inside"))
    return placed.select(*frame.columns, rank.cast("int").alias(name))
