"""Spelling variants: words a single edit apart, found by dense prefix-suffix tiling.

Words are rows of two padded matrices of code points, one aligned left, one aligned right. For a pair of
rows the leading equal columns of the first are the common prefix, those of the second, from the end, the
common suffix. Two words are one inserted, deleted or replaced code point apart if their lengths differ by
one at most and prefix plus suffix reach the longer length minus one. Matrices are compared block by block.

Blocks are not formed from all words: of two words a single edit apart, the shorter of length c, either
the first or the last c // 2 code points agree. So a word meets, once as the shorter and once as the longer
partner, the words that share that end with it, and these groups are tiled. A group of more than
``GROUP`` words (a common beginning) is split by the edit's place: partners agree in everything but one
place, and a word has at most as many neighbours there as there are letters. So no group grows with the
vocabulary, nothing is capped, and each pair is found in one group.

Defined results: a null text has no words; a null key is written as the empty text; equal rows count as
often as they stand; an empty table has no words. Only the key and the text are read, so other columns
never clash.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millsight.llm.common import counted_broadcast, plain_text, written

LETTERS = r"A-Za-zÀ-ÿ"
LEAST_LENGTH = 6
LEAST_COUNT = 5
#: One of so many (text, word) pairs loses a code point.
THINNED = 199
#: The form occurs at least so many times as often as its variant.
RATIO = 5
GROUP = 512
TILE = 256
#: Matrix cells and pairs that are held at a time.
CELLS = 1 << 21
PAIRS = 1 << 17

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(
    documents: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, thinned: int = THINNED
) -> DataFrame:
    """(word): the maximal runs of letters, A-Z lower-cased, some without one code point.

    A run shorter than ``least_length`` cannot give a word of that length and is not listed.
    """
    found = F.regexp_extract_all(plain_text(text), F.lit(f"([{LETTERS}]{{{least_length},}})"), 1)
    name = F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key")
    words = documents.select(name, F.explode(found).alias("run"))
    words = words.select("key", F.translate("run", _UPPER, _LOWER).alias("run"))
    drawn = words.withColumn("h", F.crc32(F.concat("key", F.lit(":"), "run")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % thinned == 0, shorter).otherwise(F.col("run")).alias("word")
    return drawn.select(word).filter(F.length("word") >= least_length)


def vocabulary(words: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that occur often enough."""
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def _matrices(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, padded with zeros: aligned left, and aligned right and reversed."""
    width = max(map(len, words))
    left = "".join(word.ljust(width, "\0") for word in words)
    right = "".join(word[::-1].ljust(width, "\0") for word in words)
    return tuple(np.frombuffer(m.encode("utf-32-le"), "<u4").reshape(-1, width) for m in (left, right))


def _common(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Leading equal columns of every row of one block with every row of another."""
    alive = np.ones((len(one), len(two)), bool)
    found = np.zeros(alive.shape, np.int32)
    for column in range(one.shape[1]):
        alive &= one[:, column, None] == two[None, :, column]
        if not alive.any():
            break
        found += alive
    return found


@lru_cache(64)
def _all_pairs(size: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(size, 1)


def near_pairs(groups: list[list[str]]) -> list[tuple[int, int, int]]:
    """(row, row, common prefix) of the words of a group that are a single edit apart.

    Rows count through all groups. Small groups are compared together, row by row; a large one tile by
    tile.
    """
    words = [word for group in groups for word in group]
    left, right = _matrices(words)
    lengths = np.array([len(word) for word in words])
    found: list[tuple[int, int, int]] = []
    first, second, at = [], [], 0

    def keep(i, j, prefix, suffix):
        longer = np.maximum(lengths[i], lengths[j])
        near = (abs(lengths[i] - lengths[j]) <= 1) & (prefix + suffix >= longer - 1) & ((prefix < longer) | (lengths[i] != lengths[j]))
        found.extend(zip(i[near].tolist(), j[near].tolist(), prefix[near].tolist(), strict=True))

    for group in groups:
        size = len(group)
        if size <= TILE // 8:
            i, j = _all_pairs(size)
            first.append(i + at)
            second.append(j + at)
        else:
            for a in range(at, at + size, TILE):
                for b in range(a, at + size, TILE):
                    ends = min(a + TILE, at + size), min(b + TILE, at + size)
                    prefix = _common(left[a : ends[0]], left[b : ends[1]])
                    suffix = _common(right[a : ends[0]], right[b : ends[1]])
                    i, j = np.nonzero(prefix + suffix >= lengths[a : ends[0], None] - 1)
                    upper = i + a < j + b
                    i, j = i[upper], j[upper]
                    keep(i + a, j + b, prefix[i, j], suffix[i, j])
        at += size
    i = np.concatenate(first) if first else np.empty(0, int)
    j = np.concatenate(second) if second else np.empty(0, int)
    for start in range(0, len(i), PAIRS):
        one, two = i[start : start + PAIRS], j[start : start + PAIRS]
        ends = []
        for matrix in (left, right):
            differ = matrix[one] != matrix[two]
            ends.append(np.where(differ.any(1), differ.argmax(1), matrix.shape[1]))
        keep(one, two, *ends)
    return found


def _tile_batches(batches):
    """Groups are runs of equal keys in sorted partitions; small ones are compared together."""
    names = ["a", "n_a", "b", "n_b"]

    def compared(held):
        rows = [row for group in held for row in group]
        pairs = []
        for i, j, prefix in near_pairs([[row[0] for row in group] for group in held]):
            (a, n_a, shorter_a, tail), (b, n_b, shorter_b, _) = rows[i], rows[j]
            # Two longer partners meet elsewhere as shorter ones, a common beginning in its own group.
            if (shorter_a or shorter_b) and not (tail and prefix >= min(len(a), len(b)) // 2):
                pairs.append((a, n_a, b, n_b))
        columns = list(zip(*pairs, strict=True)) if pairs else [[]] * 4
        types = (pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    held, group, current, cells, width = [], [], None, 0, 1
    for batch in batches:
        for key, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != current:
                if len(group) > 1:
                    held.append(group)
                    cells += len(group)
                    width = max(width, *(len(r[0]) for r in group))
                group, current = [], key
                if cells * width > CELLS:
                    yield compared(held)
                    held, cells, width = [], 0, 1
            group.append(row)
    if len(group) > 1:
        held.append(group)
    if held:
        yield compared(held)


def _ends(words: DataFrame, least_length: int) -> DataFrame:
    """A row per word, role and end: the group's key and which places the edit may take."""
    size = F.length("word")
    roles = F.filter(
        F.array(F.struct(size.alias("c"), F.lit(True).alias("shorter")), F.struct((size - 1).alias("c"), F.lit(False).alias("shorter"))),
        lambda r: r["c"] >= least_length,
    )
    rows = words.select("word", "n", F.explode(roles).alias("role")).select("word", "n", "role.*")
    rows = rows.withColumn("tail", F.explode(F.array(F.lit(False), F.lit(True))))
    half = F.floor(F.col("c") / 2).cast("int")
    part = F.when(F.col("tail"), F.expr("right(word, CAST(floor(c / 2) AS INT))")).otherwise(F.substring("word", F.lit(1), half))
    low = F.when(F.col("tail"), F.lit(1)).otherwise(half + 1)
    high = F.when(F.col("tail"), F.length("word") - half).otherwise(F.length("word"))
    return rows.select(
        F.xxhash64("c", "tail", part).alias("group"), "word", "n", "shorter", "tail", low.alias("low"), high.alias("high")
    )


def _by_place(rows: DataFrame) -> DataFrame:
    """The rows of large groups, by what is left of the word without one place.

    Replaced: both partners without the same place are equal. Inserted: the longer one without a place is
    the shorter one; of a run of equal code points only the first place counts.
    """
    places = F.sequence("low", "high")
    placed = rows.withColumn("place", F.explode(places))
    rest = F.concat(F.expr("substring(word, 1, place - 1)"), F.expr("substring(word, place + 1)"))
    repeats = F.expr("place > low AND substring(word, place, 1) = substring(word, place - 1, 1)")
    nothing = F.lit(0)
    replaced = placed.filter("shorter").withColumn("left", rest)
    longer = placed.filter(~F.col("shorter") & ~repeats).withColumn("left", rest).withColumn("place", nothing)
    shorter = rows.filter("shorter").withColumn("left", F.col("word")).withColumn("place", nothing)
    every = replaced.unionByName(longer).unionByName(shorter)
    return every.select(F.xxhash64("group", "place", "left").alias("group"), "word", "n", "shorter", "tail")


def neighbours(words: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(word, near, n_near) for every two words (word, n) a single edit apart, in both directions."""
    ends = _ends(words, least_length)
    large = ends.groupBy("group").agg(F.count("*").alias("rows")).filter(F.col("rows") > GROUP).select("group")
    large = counted_broadcast(written(large, "spelling-large"))
    columns = ("group", "word", "n", "shorter", "tail")
    rows = ends.join(large, "group", "left_anti").select(*columns)
    rows = rows.unionByName(_by_place(ends.join(large, "group", "left_semi")).select(*columns))
    tiles = rows.repartition("group").sortWithinPartitions("group")
    pairs = tiles.mapInArrow(_tile_batches, "a string, n_a long, b string, n_b long")
    both = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("n_near")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("n_near")),
    )
    return pairs.select(F.explode(both).alias("_p")).select("_p.*")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word that following ``form`` leads to, by pointer doubling.

    Each step multiplies the count, so chains are short and never closed.
    """
    roots = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = roots.select(F.col("word").alias("_via"), F.col("root").alias("_further"))
        moved = roots.join(further, roots["root"] == further["_via"], "left")
        moved = moved.select("word", F.coalesce("_further", "root").alias("root"), F.col("_further").isNotNull().alias("_moved"))
        moved = written(moved, "spelling-roots")
        roots = moved.select("word", "root")
        if moved.filter("_moved").isEmpty():
            return roots


def variants(words: DataFrame, least_length: int = LEAST_LENGTH, ratio: int = RATIO) -> DataFrame:
    """Per word (word, n): ``n_near`` words a single edit apart, its ``form``, ``form_n`` and ``root``.

    The form is the most frequent near word (the first in code-point order of equal ones), if it is at
    least ``ratio`` times as frequent; the root is the last form reached.
    """
    words = written(words.select("word", "n"), "spelling-words")
    best = F.min(F.struct((-F.col("n_near")).alias("minus"), "near"))
    found = neighbours(words, least_length).groupBy("word").agg(F.count("*").alias("count"), best.alias("best"))
    joined = words.join(found, "word", "left")
    frequent = -F.col("best.minus") >= ratio * F.col("n")
    judged = joined.select(
        "word",
        "n",
        F.coalesce("count", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("best.near")).alias("form"),
        F.when(frequent, -F.col("best.minus")).alias("form_n"),
    )
    judged = written(judged, "spelling-judged")
    roots = _roots(judged.filter("form IS NOT NULL"))
    return judged.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
