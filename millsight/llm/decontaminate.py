"""Benchmark decontamination by pigeonhole edit matching.

Items and documents are normalised (lower case, runs of anything but letters and digits one space). An
item of m characters may differ in k = ``EDIT_RATE`` * m edits; of its k + 1 equal pieces at least one
then occurs unchanged. An Aho-Corasick automaton finds every piece in the whole text; each hit gives
the stretch of text the item would lie in, overlapping stretches of an item are merged, and Myers'
bit-parallel search gives the least edit distance there.

The benchmark is taken in chunks of at most ``CHUNK_CHARS`` characters. Each is broadcast, held against all
documents, what it found written, and the broadcast given up before the next one, so neither driver nor
task ever holds more than one chunk of it.

Defined results: a null or empty text holds nothing; an item without letters or digits is never found;
items with equal text are all found; equal rows are judged one by one; an empty benchmark finds
nothing; carried columns are passed through under their names, whatever these are.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millsight.llm.common import counted_broadcast, written

EDIT_RATE = 0.05
CHUNK_CHARS = 1_000_000

_PARTS = re.compile(r"[^\W_]+")


def normalised(text: str | None) -> str:
    return " ".join(_PARTS.findall((text or "").lower()))


def budget(item: str, rate: float = EDIT_RATE) -> int:
    return int(len(item) * rate)


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` pieces of nearly equal length with their offsets."""
    cuts = [i * len(item) // (edits + 1) for i in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def myers(pattern: str, text: str) -> tuple[int, int]:
    """Least edit distance of the pattern to any stretch of the text, and where that one ends."""
    size = len(pattern)
    full, top = (1 << size) - 1, 1 << (size - 1)
    places: dict[str, int] = defaultdict(int)
    for i, char in enumerate(pattern):
        places[char] |= 1 << i
    plus, minus, score = full, 0, size
    best, end = size, 0
    find = places.get
    for at, char in enumerate(text, 1):
        same = find(char, 0) | minus
        diagonal = (((same & plus) + plus) ^ plus) | same
        up = minus | (full & ~(diagonal | plus))
        down = plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = (up << 1) & full
        plus = ((down << 1) & full) | (full & ~(diagonal | up))
        minus = up & diagonal
        if score < best:
            best, end = score, at
    return best, end


class Matcher:
    """The pieces of a chunk of items in one automaton."""

    def __init__(self, items: Sequence[tuple[int, str]], rate: float = EDIT_RATE):
        self.items = [(name, text, budget(text, rate)) for name, text in items if text]
        owners: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for i, (_, text, edits) in enumerate(self.items):
            for offset, piece in pieces(text, edits):
                owners[piece].append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, found in owners.items():
            self.automaton.add_word(piece, (len(piece), found))
        if owners:
            self.automaton.make_automaton()

    def _stretches(self, text: str) -> dict[int, list[list[int]]]:
        """Per item the merged stretches of text around its piece hits, which come left to right."""
        found: dict[int, list[list[int]]] = defaultdict(list)
        if not self.items:
            return found
        hits = defaultdict(list)
        for last, (length, owners) in self.automaton.iter(text):
            for i, offset in owners:
                hits[i].append(last + 1 - length - offset)
        for i, starts in hits.items():
            _, item, edits = self.items[i]
            for start in sorted(starts):
                lo, hi = max(0, start - edits), start + len(item) + edits
                if found[i] and lo <= found[i][-1][1]:
                    found[i][-1][1] = max(hi, found[i][-1][1])
                else:
                    found[i].append([lo, hi])
        return found

    def matches(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item, distance, end in the normalised text) of each item within its budget, best place."""
        text, found = normalised(text), []
        for i, stretches in self._stretches(text).items():
            name, item, edits = self.items[i]
            best = min((*myers(item, text[lo:hi]), lo) for lo, hi in stretches)
            if best[0] <= edits:
                found.append((name, best[0], best[1] + best[2]))
        return found


def _chunks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int, str]]]:
    held, size = [], 0
    for name, body in benchmark.select(item_id, text).toLocalIterator():
        item = normalised(body)
        if held and size + len(item) > CHUNK_CHARS:
            yield held
            held, size = [], 0
        held.append((name, item))
        size += len(item)
    if held:
        yield held


def _match_batches(shared, rate: float):
    def run(batches):
        matcher = Matcher(shared.value, rate)
        for batch in batches:
            rows, found = [], []
            for row, body in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                for match in matcher.matches(body):
                    rows.append(row)
                    found.append(match)
            taken = batch.select(batch.schema.names[:-1]).take(pa.array(rows, pa.int64()))
            kinds = (pa.int64(), pa.int32(), pa.int32())
            own = [pa.array([m[i] for m in found], k) for i, k in enumerate(kinds)]
            names = [*taken.schema.names, "item_id", "distance", "end_char"]
            yield pa.RecordBatch.from_arrays([*taken.columns, *own], names)

    return run


def _found(asked: DataFrame, benchmark: DataFrame, item_id: str, item_text: str, rate: float) -> DataFrame:
    """Matches of the last column of ``asked`` by its other columns, chunk by chunk of the benchmark."""
    kept = [f.simpleString().replace(":", " ", 1) for f in asked.schema.fields[:-1]]
    schema = ", ".join([*kept, "item_id bigint", "distance int", "end_char int"])
    context = asked.sparkSession.sparkContext
    passes = []
    for items in _chunks(benchmark, item_id, item_text):
        shared = context.broadcast(items)
        passes.append(written(asked.mapInArrow(_match_batches(shared, rate), schema), "leaks"))
        shared.destroy()
    if not passes:
        passes.append(asked.limit(0).mapInArrow(_match_batches(context.broadcast([]), rate), schema))
    return reduce(DataFrame.unionAll, passes)


def find_items(
    documents: DataFrame,
    benchmark: DataFrame,
    carry: Sequence[str] = ("doc_id",),
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    rate: float = EDIT_RATE,
) -> DataFrame:
    """A row per document and item found in it: carried columns, item_id, distance, end_char."""
    own = [F.col(c).alias(f"_carried_{i}") for i, c in enumerate(carry)]
    asked = documents.select(*own, F.col(text).cast("string").alias("_text"))
    found = _found(asked, benchmark, item_id, item_text, rate)
    return found.toDF(*carry, "item_id", "distance", "end_char")


def drop_contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    rate: float = EDIT_RATE,
) -> DataFrame:
    """The documents that hold no item of the benchmark.

    Equal texts hold the same items, so texts are named by their digests and documents are kept by an
    anti-join with those of the texts found.
    """
    body = F.col(text).cast("string")
    asked = documents.select(F.unhex(F.md5(body)).alias("_key"), body.alias("_text"))
    leaks = _found(asked, benchmark, item_id, item_text, rate).select("_key").distinct()
    leaks = counted_broadcast(written(leaks, "leaked-texts"))
    return documents.join(leaks, F.unhex(F.md5(documents[text].cast("string"))) == leaks["_key"], "left_anti")
