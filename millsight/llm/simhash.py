"""Near-duplicate texts by SimHash fingerprints and multi-index hashing.

A text's fingerprint holds, per bit, the majority of its shingles' 64-bit hashes. Distinct fingerprints
are indexed by each of their two halves. Fingerprints within ``distance`` differ in one half by no more
than that half's radius, so a probe enumerates the Hamming ball of that radius around its own half,
fetches the fingerprints that the table holds under those values and compares whole fingerprints.

A half that more than ``BUCKET`` distinct fingerprints share (a family of near copies) is a bucket too
full to compare with itself. Its entries are keyed by the other half as well: the table side enumerates
a ball around it, the probe side a ball of what its distance leaves, and fingerprints within the distance
share a point of both balls. A point has a bounded number of neighbours, so no key has many rows,
however large the family, and nothing is capped.

Defined results: a null text is empty; a text without words has fingerprint zero and is linked like any
other; a text of fewer words than a shingle is one shingle; equal rows are copies of each other; a null
doc_id is a document like any other, but names a component only if no other one does; an empty table
gives no rows. Only the key and the text are read, so other columns never clash.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millsight.llm.common import counted_broadcast, plain_text, written
from millsight.llm.graph import components

SHINGLE = 3
SEED = 42
DISTANCE = 2
HALF = 32
#: Distinct fingerprints of one half that are compared pair by pair.
BUCKET = 64
#: Shingles hashed at a time, so that a very long text needs no more memory than a short one.
PART = 1 << 15
#: A fingerprint of more than one in so many rows is joined by broadcast: there are fewer of them.
FREQUENT = 1000


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a UTF-8 text's shingles, A-Z lower-cased, as an unsigned number."""
    words = text.lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    total = len(words) - size + 1
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, PART):
        part = words[at : at + PART + size - 1]
        joined = b" ".join(part)
        ends = list(accumulate(len(word) + 1 for word in part))
        starts = [0, *ends]
        hashes = [digest(joined[s : e - 1], seed) for s, e in zip(starts, ends[size - 1 :], strict=False)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def _fingerprint_batches(shingle: int):
    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = np.array([fingerprint(text, shingle) for text in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found)], ["key", "print"])

    return run


def fingerprints(documents: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, print) of every document; ``print`` is the fingerprint as a signed long."""
    asked = documents.select(F.col(key).alias("key"), plain_text(text).cast("binary").alias("text"))
    schema = f"key {asked.schema['key'].dataType.simpleString()}, print long"
    return asked.mapInArrow(_fingerprint_batches(shingle), schema)


def ball(radius: int, bits: int = HALF) -> list[int]:
    """All masks of at most ``radius`` bits."""
    return [sum(1 << b for b in chosen) for r in range(radius + 1) for chosen in combinations(range(bits), r)]


def _around(value: Column, radius: int) -> Column:
    """The Hamming ball of a radius around a half."""
    return F.transform(F.array(*[F.lit(m).cast("long") for m in ball(radius)]), lambda m: value.bitwiseXOR(m))


def _with_halves(prints: DataFrame) -> DataFrame:
    """A row per half: which one, its value and the value of the other one."""
    low = F.col("print").bitwiseAND(F.lit((1 << HALF) - 1))
    high = F.shiftrightunsigned("print", HALF)
    halves = [F.struct(F.lit(i).alias("half"), own.alias("own"), other.alias("other")) for i, (own, other) in enumerate(((high, low), (low, high)))]
    return prints.select("print", F.explode(F.array(*halves)).alias("_h")).select("print", "_h.*")


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints that differ in at most ``distance`` bits.

    ``prints`` has one row per distinct fingerprint. A pair may be found more than once. The first half's
    radius is half the distance; if the first halves differ in more, the second ones differ in fewer bits.
    """
    radii = (distance // 2, (distance - 1) // 2)
    meeting = (distance + 1) // 2
    halves = _with_halves(prints)
    full = halves.groupBy("half", F.col("own").alias("value")).count().filter(F.col("count") > BUCKET)
    full = written(full.select("half", "value", F.lit(True).alias("full")), "simhash-full")
    none = F.array(F.lit(-1).cast("long"))  # no half has this value

    entries = halves.withColumnRenamed("own", "value").join(counted_broadcast(full), ["half", "value"], "left")
    point = F.when(F.col("full"), _around(F.col("other"), meeting)).otherwise(none)
    entries = entries.select("half", "value", F.explode(point).alias("point"), F.col("print").alias("b"))

    probes = None
    for half, radius in enumerate(radii):
        for used in range(radius + 1):
            masks = [m for m in ball(radius) if m.bit_count() == used]
            values = F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: F.col("own").bitwiseXOR(m))
            left = _around(F.col("other"), max(0, distance - used - meeting))
            part = halves.filter(F.col("half") == half)
            part = part.select("print", "half", "other", F.explode(values).alias("value"))
            part = part.join(counted_broadcast(full), ["half", "value"], "left")
            points = F.explode(F.when(F.col("full"), left).otherwise(none)).alias("point")
            part = part.select("half", "value", points, F.col("print").alias("a"))
            probes = part if probes is None else probes.unionByName(part)
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    return probes.join(entries, ["half", "value", "point"]).filter((F.col("a") < F.col("b")) & near).select("a", "b")


def near_copies(
    documents: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """Every document's key, ``fingerprint`` (hexadecimal) and ``component_id``, the least key reachable."""
    rows = written(fingerprints(documents, key, text, shingle), "simhash-rows")
    distinct = rows.groupBy("print").agg(F.min("key").alias("least"), F.count("*").alias("rows"))
    distinct = written(distinct, "simhash-prints")
    labels = components(links(distinct.select("print"), distance))

    linked = labels.select(F.col("node").alias("print"), "component").join(distinct, "print")
    linked = written(linked.select("print", "component", "least"), "simhash-linked")
    leasts = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    named = linked.join(leasts, "component").select("print", "component_id")
    named = distinct.join(named, "print", "left").select(
        "print", "rows", "least", F.coalesce("component_id", "least").alias("component_id")
    )
    # A fingerprint of one row that is linked to no smaller key needs no answer.
    own = (F.col("rows") == 1) & F.col("component_id").eqNullSafe(F.col("least"))
    named = written(named.filter(~own).select("print", "rows", "component_id"), "simhash-named")
    total = rows.count()
    often = F.col("rows") * FREQUENT > total  # fewer than FREQUENT fingerprints
    frequent = F.broadcast(named.filter(often).select("print", "component_id"))
    rest = named.filter(~often).select("print", "component_id")
    some = rows.join(frequent, "print")
    others = rows.join(frequent, "print", "left_anti").join(rest, "print", "left")
    others = others.select("print", "key", F.coalesce("component_id", "key").alias("component_id"))
    found = some.select("print", "key", "component_id").unionByName(others)
    digits = F.lpad(F.lower(F.hex("print")), 16, "0")
    return found.select(F.col("key").alias(key), digits.alias("fingerprint"), "component_id")
