"""Sharding by sampled splitters, in DataFrame operations only.

Rows are ordered by (key, text hash, row number). Size-weighted samples of that order give quantile
splitters, the splitters cut the rows into ranges, and ranges that are still overfull are cut again
with splitters of their own, a hot key along its text hashes, a group of equal rows along its row
numbers. Once every range is small, exact byte offsets of the ranges place each row, so consecutive
rows fill shards whose sizes differ by at most about one row.

Defined results: a null key comes first; a null text counts no byte, each row counts one more; equal
rows are separate rows; an empty table gives no rows; carried columns never clash, for the operator's
own are the only other ones. No range, key or shard is ever gathered whole in one task: a task sorts
one small range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millsight.llm.common import counted_broadcast, plain_text, written

#: Halves of the key, the text hash and halves of the row number, compared in this order. Quantiles are
#: computed in double precision, so no part has more than 53 bits.
AXES = ("_key_high", "_key_low", "_hash", "_row_high", "_row_low")
LOWEST = -(2**63)


def _sizes(ranges: DataFrame) -> DataFrame:
    ends = [f(c).alias(f"{name}{c}") for c in AXES for name, f in (("lo", F.min), ("hi", F.max))]
    return ranges.groupBy("_range").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("rows"), *ends
    )


def _cut(ranges: DataFrame, overfull: DataFrame, pieces: int, samples: int, seed: int) -> DataFrame:
    """Ranges with the overfull ones cut at sampled, size-weighted quantiles.

    A value equal to a splitter gets a range of its own, so a hot key is alone after one cut and is
    cut along the next column after that.
    """
    axis, value = F.lit(len(AXES) - 1), F.col(AXES[-1])
    for number, name in reversed(list(enumerate(AXES[:-1]))):
        axis = F.when(F.col(f"lo{name}") < F.col(f"hi{name}"), number).otherwise(axis)
        value = F.when(F.col("axis") == number, F.col(name)).otherwise(value)
    overfull = overfull.select("_range", "bytes", axis.alias("axis"))
    drawn = F.pmod(F.xxhash64(F.lit(seed), *AXES), F.lit(1 << 30)) / (1 << 30)
    chance = F.col("size") * F.lit(float(samples)) / F.col("bytes")
    quantiles = [i / pieces for i in range(1, pieces)]
    splitters = (
        ranges.join(overfull, "_range")
        .filter(drawn < chance)
        .groupBy("_range", "axis")
        .agg(F.percentile_approx(value, quantiles, 10 * pieces).alias("splitters"))
        .select("_range", "axis", F.array_distinct("splitters").alias("splitters"))
    )
    below = F.size(F.filter("splitters", lambda s: s < value))
    upto = F.size(F.filter("splitters", lambda s: s <= value))
    piece = F.format_string("%s.%05d", F.col("_range"), below + upto)
    cut = ranges.join(splitters, "_range", "left")
    cut = cut.withColumn("_range", F.when(F.col("axis").isNull(), F.col("_range")).otherwise(piece))
    return cut.drop("axis", "splitters")


def assign_shards(
    documents: DataFrame,
    shards: int = 8,
    key: str = "doc_id",
    text: str = "text",
    carry: Sequence[str] = (),
    pieces: int = 64,
    oversample: int = 32,
    most_range_bytes: int = 1 << 30,
    seed: int = 17,
) -> DataFrame:
    """Every row's key, size, text_crc32, shard and slot, with the carried columns.

    ``key`` is a whole number. A range is overfull above a quarter of a shard or ``most_range_bytes``.
    """
    body = plain_text(text)
    facts = documents.select(
        F.col(key).cast("long").alias("_key"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(body), 11).alias("_hash"),
        *[F.col(c).alias(f"_carried_{i}") for i, c in enumerate(carry)],
    )
    numbered = facts.withColumn("_row", F.monotonically_increasing_id())
    place = F.coalesce("_key", F.lit(LOWEST))
    halves = {
        "_key_high": F.shiftright(place, 32),
        "_key_low": place.bitwiseAND(F.lit(2**32 - 1)),
        "_row_high": F.shiftright("_row", 32),
        "_row_low": F.col("_row").bitwiseAND(F.lit(2**32 - 1)),
    }
    facts = written(numbered.withColumns(halves), "shard-facts")

    narrow = facts.select("_row", "size", *AXES)
    total = narrow.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    target = max(1, min(total // (4 * shards), most_range_bytes))
    ranges = narrow.withColumn("_range", F.lit("0"))
    sizes = _sizes(ranges)
    while True:
        overfull = sizes.filter((F.col("bytes") > target) & (F.col("rows") > 1))
        if overfull.isEmpty():
            break
        ranges = written(_cut(ranges, overfull, pieces, pieces * oversample, seed), "shard-ranges")
        sizes = written(_sizes(ranges), "shard-sizes")
        seed += 1

    # One row per range: total / target of them, at most a few hundred thousand at 100 TB.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_range",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
    )
    inside = Window.partitionBy("_range").orderBy(*AXES)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.col("bytes_before") + F.sum("size").over(upto)
    middle = F.floor((2 * end - F.col("size")) * shards / (2 * max(total, 1))).cast("int")
    placed = ranges.join(offsets, "_range").select(
        "_row",
        F.least(middle, F.lit(shards - 1)).alias("shard"),
        (F.col("rows_before") + F.row_number().over(inside) - 1).alias("_place"),
    )
    placed = written(placed, "shard-places")
    first = placed.groupBy("shard").agg(F.min("_place").alias("_first"))  # one row per shard
    return (
        facts.join(counted_broadcast(placed), "_row")
        .join(F.broadcast(first), "shard")
        .select(
            F.col("_key").alias(key),
            "size",
            "text_crc32",
            "shard",
            (F.col("_place") - F.col("_first")).alias("slot"),
            *[F.col(f"_carried_{i}").alias(c) for i, c in enumerate(carry)],
        )
    )
