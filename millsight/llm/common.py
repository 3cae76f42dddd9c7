"""Helpers the training-data operators share: tables, the work folder, words and their hashes."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millsight.session import work_folder

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SHINGLE_WORDS = 5
SIMILAR = 0.8


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared work folder: cuts lineage, fixes what a task drew.

    Each call takes a folder of its own, so a repeated run never reads what another one left.
    """
    spark = frame.sparkSession
    path = f"{work_folder(spark)}/llm/{label}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def counted_broadcast(frame: DataFrame, most_rows: int = 500_000, most_bytes: int = 64 << 20) -> DataFrame:
    """A written table, to be broadcast only if its counted rows and the bytes of its texts are few enough."""
    texts = [F.sum(F.octet_length(f.name)) for f in frame.schema if f.dataType.typeName() in ("string", "binary")]
    rows, *sizes = frame.agg(F.count("*"), *texts).first()
    small = rows <= most_rows and sum(size or 0 for size in sizes) <= most_bytes
    return F.broadcast(frame) if small else frame


def plain_text(column: str = "text") -> Column:
    """A text column as string, null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text: ``bytes.split`` cuts at exactly the six ASCII white-space characters."""
    return text.split()


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (the public splitmix64 constants)."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each window of ``n`` words; empty when there are fewer words."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - n + 1 + i]
    return mixed(total)


def shingles(words: Sequence[bytes], n: int = SHINGLE_WORDS) -> np.ndarray:
    """The sorted set of shingle hashes. A text of one to n-1 words is one shingle of all its words."""
    if not words:
        return np.empty(0, np.uint64)
    hashes = word_hashes(words)
    return np.unique(gram_hashes(hashes, min(n, len(hashes))))


def batches(frames: Iterable, *columns: str):
    """Per Arrow batch: its columns as Python lists."""
    for batch in frames:
        yield [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns]
