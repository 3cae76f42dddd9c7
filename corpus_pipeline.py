"""The corpus pipeline: quality rules, near duplicates, decontamination, mixing, sharding.

Each stage takes what its predecessor kept, written as Parquet and read again, and all but the last
return the columns of ``documents``:

* quality rules: documents the label model or the base rules reject go;
* n-gram Jaccard join: one document of each group of near duplicates stays, the one with the least
  doc_id, of equal ids any one row;
* benchmark decontamination: documents that hold a benchmark item go;
* mixing sources to target weights: a document stands once for each pass that takes words of it, so
  documents the mix takes no word of go and those of scarce sources are repeated;
* sharding: every document's size, checksum, shard and slot, with its columns.

A null text is an empty document and fails the base rules; an empty table stays empty throughout.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millsight.llm.common import counted_broadcast, plain_text, table, written
from millsight.llm.decontaminate import drop_contaminated
from millsight.llm.mixing import mix
from millsight.llm.ngram_join import near_duplicates, text_key
from millsight.llm.quality_rules import judge
from millsight.llm.sharding import assign_shards

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return judge(docs, COLUMNS, store=False).filter("kept").select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Decisions are per doc_id and text; rows equal in both are told apart only if there are any."""
    found = near_duplicates(docs.select("doc_id", "text"))
    pairs = found.groupBy("component", "text_key", "doc_id").agg(F.count("*").alias("rows"))
    pairs = written(pairs, "pipeline-pairs")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("first")
    firsts = pairs.groupBy("component").agg(first)
    stays = (F.col("text_key") == F.col("first.text_key")) & F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    marked = pairs.join(firsts, "component").select(
        F.col("text_key").alias("_key"), F.col("doc_id").alias("_id"), "rows", stays.alias("_stays")
    )
    marked = written(marked, "pipeline-marked")
    rows = docs.select(*COLUMNS).withColumn("_text_key", text_key(plain_text()))
    same = (F.col("_text_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    settled = written(marked.filter("NOT _stays OR rows > 1"), "pipeline-settled")
    kept = rows.join(counted_broadcast(settled), same, "left_anti")
    copied = written(marked.filter("_stays AND rows > 1"), "pipeline-copied")
    repeated = rows.join(counted_broadcast(copied), same, "left_semi")
    repeated = repeated.dropDuplicates(["_text_key", "doc_id"])
    return kept.unionByName(repeated).select(*COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    numbered = docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id())
    rows = written(numbered, "pipeline-mix")  # fixes the row numbers, to join the takes back on
    dealt = mix(rows.select("doc_id", "text", "source", "_row"), carry=("_row",))
    passes = F.ceil(F.col("taken") / F.col("size")).cast("int")
    kept = dealt.documents.filter("taken > 0").select("_row", passes.alias("_passes"))
    kept = counted_broadcast(written(kept, "pipeline-takes"))
    repeated = rows.join(kept, "_row").withColumn(
        "_pass", F.explode(F.sequence(F.lit(1), F.col("_passes")))
    )
    return repeated.select(*COLUMNS)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return assign_shards(docs, carry=COLUMNS[1:])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", decontaminated),
    ("mixing", mixed_sources),
    ("sharding", sharded),
]
#: Expectation-maximisation, near duplicates and edit distances are beyond SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
