"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Each source is a stream of words: its documents in a permuted order, repeated as often as its target
asks. The stream up to the target is cut into blocks, a source's quota. The tree then deals all blocks
to the output shards: at each node, a uniform permutation of the node's blocks sends exactly the left
half's share to the left, so the number of blocks each source sends there is a multivariate
hypergeometric draw, and quotas stay exact and disjoint at every level. Inside a shard, pieces of
documents are put in a random order of their own. All draws are hashes of a seed, so reruns agree.

Only DataFrame operations. Ranks and running sums go by hash buckets: bucket totals first, then a
window inside one bucket, so neither a hot source nor the tree's root is one task.

Defined results: a null text has no words; null is a source of its own, ordered last; documents without
words take nothing; equal rows are separate rows; an empty table gives empty results.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millsight.llm.common import WORD, plain_text, written

BUCKET_DIGITS = 3
CHUNK = 4096


@dataclass(frozen=True)
class Mix:
    """documents: one row each with its take; sources: targets; pieces: what each shard holds.

    A document's ``placement`` is a digest of where the tree sent its pieces: of pass, block, words and
    shard of each.
    """

    documents: DataFrame
    sources: DataFrame
    pieces: DataFrame


def permutation_key(doc_id: Column, text: Column, seed: int) -> Column:
    name = F.coalesce(doc_id.cast("string"), F.lit("null"))
    return F.md5(F.concat(F.lit(f"{seed}:"), name, F.lit(":"), F.md5(text)))


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), most_passes: int = 3
) -> DataFrame:
    """``sizes`` (source, source_size) with source_no, weight and target. One row per source.

    The whole is the sum of all sizes. Filling by weight until a source is full and giving its excess
    to the rest by weight ends at one level: target = min(cap, level * weight). With the sources
    ordered by cap / weight, the level is the first one that fits below the next ratio.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    number = F.row_number().over(by_name)
    weight = F.element_at(F.array(*map(F.lit, weights)), (number - 1) % len(weights) + 1)
    cap = most_passes * F.col("source_size")
    rows = sizes.select("source", "source_size", number.alias("source_no"), weight.alias("weight"))
    by_ratio = Window.orderBy(cap / F.col("weight"), "source_no")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    level = left / F.sum("weight").over(rest)
    rows = rows.withColumn("_level", F.when(level <= cap / F.col("weight"), level))
    rows = rows.withColumn("_level", F.max("_level").over(everything))
    target = F.least(cap.cast("double"), F.col("_level") * F.col("weight"))
    return rows.withColumn("target", F.coalesce(target, F.lit(0.0))).drop("_level")


def _bucket(key: str) -> Column:
    return F.substring(key, 1, BUCKET_DIGITS)


def _running(frame: DataFrame, group: str, key: str, tie: Sequence[str], value: str) -> DataFrame:
    """``frame`` with ``_before``: the sum of ``value`` over earlier rows of the group by key and tie."""
    frame = frame.withColumn("_bucket", _bucket(key))
    totals = frame.groupBy(group, "_bucket").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(group).orderBy("_bucket")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_offset", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    inside = Window.partitionBy(group, "_bucket").orderBy(key, *tie)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = frame.join(totals.drop("_sum"), [group, "_bucket"])
    before = F.col("_offset") + F.sum(value).over(inside) - F.col(value)
    return joined.withColumn("_before", before).drop("_offset", "_bucket")


def _deal(blocks: DataFrame, levels: int, seed: int) -> DataFrame:
    """Blocks with ``shard`` in 0 .. 2**levels - 1: the splitting tree."""
    blocks = written(blocks.withColumns({"shard": F.lit(0), "_one": F.lit(1)}), "mix-blocks")
    for level in range(levels):
        key = F.md5(F.concat_ws(":", F.lit(f"{seed}/{level}"), "source_no", "block"))
        ranked = _running(
            blocks.withColumn("_key", key), "shard", "_key", ("source_no", "block"), "_one"
        )
        held = blocks.groupBy("shard").agg(F.count("*").alias("_held"))  # at most 2**level rows
        half = F.floor((F.col("_held") + 1) / 2)
        blocks = ranked.join(F.broadcast(held), "shard").withColumn(
            "shard", 2 * F.col("shard") + (F.col("_before") >= half).cast("int")
        )
        blocks = written(blocks.drop("_key", "_before", "_held"), "mix-blocks")
    return blocks.drop("_one")


def mix(
    documents: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    most_passes: int = 3,
    block_words: int = 1 << 14,
    levels: int = 3,
    seed: int = 29,
    carry: Sequence[str] = (),
) -> Mix:
    """Deals the documents' words to ``2**levels`` shards so that sources meet their targets.

    ``documents`` has doc_id, text and source; ``carry`` names columns to keep beside them.
    """
    body = plain_text("text")
    facts = documents.select(
        F.col("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.regexp_count(body, F.lit(WORD)).cast("long").alias("size"),
        permutation_key(F.col("doc_id"), body, seed).alias("_key"),
        F.monotonically_increasing_id().alias("row"),
        *[F.col(c).alias(f"_carried_{i}") for i, c in enumerate(carry)],
    )
    facts = written(facts, "mix-facts")
    sizes = facts.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = written(source_targets(sizes, weights, most_passes), "mix-sources")
    goal = F.round("target").cast("long")

    known = sources.withColumnRenamed("source", "_source")
    rows = facts.join(known, facts["source"].eqNullSafe(F.col("_source"))).drop("_source")
    stream = _running(
        rows.select("doc_id", "row", "size", "_key", "source_no", "source_size", "target"),
        "source_no",
        "_key",
        ("row",),
        "size",
    )
    passes = F.explode(F.sequence(F.lit(0), F.lit(most_passes - 1)))
    stream = stream.filter("size > 0").withColumn("pass", passes)
    start = F.col("pass") * F.col("source_size") + F.col("_before")
    stream = stream.withColumns({"_start": start, "_end": F.least(start + F.col("size"), goal)})
    stream = stream.filter("_start < _end")
    spans = F.sequence(
        F.floor(F.col("_start") / block_words), F.floor((F.col("_end") - 1) / block_words)
    )
    pieces = stream.withColumn("block", F.explode(spans))
    first = F.greatest("_start", F.col("block") * block_words) - F.col("_start")
    last = F.least("_end", (F.col("block") + 1) * block_words) - F.col("_start")
    pieces = pieces.select(
        "row", "doc_id", "source_no", "pass", "block",
        first.alias("from_word"), last.alias("to_word"),
    )

    quota = F.ceil(goal / block_words)
    parts = F.explode(F.sequence(F.lit(0), F.floor((quota - 1) / CHUNK)))
    blocks = sources.filter(goal > 0).select("source_no", quota.alias("_quota"), parts.alias("_part"))
    inside = F.explode(
        F.sequence(
            F.col("_part") * CHUNK, F.least((F.col("_part") + 1) * CHUNK, F.col("_quota")) - 1
        )
    )
    blocks = _deal(blocks.select("source_no", inside.alias("block")), levels, seed)
    order = F.xxhash64(F.lit(seed), "shard", "row", "pass", "block")
    pieces = pieces.join(blocks, ["source_no", "block"]).withColumn("order_key", order)
    pieces = written(pieces, "mix-pieces")

    named = F.concat_ws(":", "pass", "block", "from_word", "to_word", "shard")
    taken = pieces.groupBy("row").agg(
        F.sum(F.col("to_word") - F.col("from_word")).alias("taken"),
        F.count("*").alias("n_pieces"),
        F.md5(F.array_join(F.sort_array(F.collect_list(named)), ",")).alias("placement"),
    )
    kept = rows.join(taken, "row", "left").select(
        "row", "doc_id", "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).alias("taken"),
        F.coalesce("n_pieces", F.lit(0)).alias("n_pieces"),
        "placement",
        *[F.col(f"_carried_{i}").alias(c) for i, c in enumerate(carry)],
    )
    return Mix(kept, sources, pieces)
