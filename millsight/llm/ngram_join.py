"""N-gram Jaccard self-join by a MinHash LSH forest with exact verification.

Texts are sets of five-word shingles. Equal texts form one class and only classes are joined. Each
class has ``TREES`` MinHash labels of ``DEPTH`` values: its leaves in as many prefix tries. Matched
prefixes are shortened from the full depth to the depth at which two texts of the least similarity
share a prefix in some tree with the target recall. Inside a trie node, classes are compared with the
node's first class; those that stay in different families meet in blocks. Families are the connected
sets of classes whose labels agree often enough; then the texts of a family are compared exactly, all
pairs, in blocks of bounded size. Blocks give counts and a spanning forest, never the pairs, so a
family of n texts costs n * blocks rows. No candidate is capped.

Defined results: a null text is empty; texts without a word are linked to nothing (equal ones share
their class); a text of one to four words is one shingle; equal rows are copies of each other; a null
doc_id is a document like any other and gives its class its id only if there is no other one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millsight.llm.common import SHINGLE_WORDS, SIMILAR, counted_broadcast, mixed, plain_text, shingles, written
from millsight.llm.graph import components

TREES = 24
DEPTH = 7
RECALL = 0.9999
#: Labels of two texts agree in at least this share before the texts are compared exactly: below the
#: least similarity by over five standard deviations of the estimate.
SURE_BELOW = 0.18
BLOCK_ROWS = 512
BLOCK_BYTES = 8 << 20

with np.errstate(over="ignore"):
    _SEEDS = mixed(np.arange(1, TREES * DEPTH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = _SEEDS | np.uint64(1)


def final_depth(similarity: float, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix that two texts of ``similarity`` share in some tree with that recall."""
    for length in range(depth, 1, -1):
        if 1 - (1 - similarity**length) ** trees >= recall:
            return length
    return 1


def minhash_label(grams: np.ndarray) -> bytes | None:
    """``TREES * DEPTH`` two-byte MinHash values, tree by tree; none for the empty set."""
    if not len(grams):
        return None
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(grams), 512):
            part = grams[at : at + 512, None] * _FACTORS[None, :]
            np.minimum(least, part.min(0), out=least)
    return (mixed(least ^ _SEEDS) & np.uint64(0xFFFF)).astype("<u2").tobytes()


def _label_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        place = batch.schema.get_field_index("_text")
        texts = batch.column(place).cast(pa.binary()).to_pylist()
        labels = [minhash_label(shingles(t.split(), SHINGLE_WORDS)) for t in texts]
        kept = [batch.column(i) for i in range(batch.num_columns) if i != place]
        names = [n for n in batch.schema.names if n != "_text"]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(labels, pa.binary())], [*names, "label"])


def text_key(text: Column) -> Column:
    """Sixteen bytes that stand for a text: equal texts, and for all purposes only those, share them."""
    return F.unhex(F.md5(text))


def contiguous(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, list[list]]]:
    """Groups of consecutive rows with equal first ``n_keys`` columns: (key, columns as lists)."""
    key, held = None, None
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns, strict=True):
            if row[:n_keys] != key:
                if key is not None:
                    yield key, held
                key, held = row[:n_keys], [[] for _ in columns]
            for values, value in zip(held, row, strict=True):
                values.append(value)
    if key is not None:
        yield key, held


class Forest:
    """Union-find over 0 .. n-1; a root is the least member."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = sorted((self.root(i), self.root(j)))
        self.parent[j] = i
        return i != j


def _agreement(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Share of equal values for each pair of label rows."""
    found = np.zeros((len(left), len(right)), np.int32)
    for at in range(left.shape[1]):
        found += left[:, at, None] == right[None, :, at]
    return found / left.shape[1]


def _close_edges(least: float):
    def run(batches):
        for batch in batches:
            a, b, one, two = (c.to_pylist() for c in batch.columns)
            size = len(one[0]) // 2 if one else 1
            left = np.frombuffer(b"".join(one), "<u2").reshape(-1, size)
            right = np.frombuffer(b"".join(two), "<u2").reshape(-1, size)
            close = np.flatnonzero((left == right).mean(1) >= least) if one else []
            pairs = [[x[i] for i in close] for x in (a, b)]
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.binary()) for p in pairs], ["a", "b"])

    return run


def _family_bridges(least: float):
    """Edges that join different families within a block or between two blocks of a trie node."""

    def run(batches):
        for _, (_, _, one, two, keys, families, labels, blocks) in contiguous(batches, 4):
            names = {f: i for i, f in enumerate(dict.fromkeys(families))}
            if len(names) < 2:
                continue
            family = np.array([names[f] for f in families])
            size = len(labels[0]) // 2
            values = np.frombuffer(b"".join(labels), "<u2").reshape(-1, size)
            forest, found = Forest(len(names)), []
            mine = np.array(blocks) == one[0]
            other = mine if one[0] == two[0] else ~mine
            rows, columns = np.flatnonzero(mine), np.flatnonzero(other)
            close = _agreement(values[rows], values[columns]) >= least
            close &= family[rows][:, None] != family[columns][None, :]
            for i, j in np.argwhere(close):
                if forest.join(family[rows[i]], family[columns[j]]):
                    found.append((keys[rows[i]], keys[columns[j]]))
            pairs = [pa.array([p[i] for p in found], pa.binary()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(pairs, ["a", "b"])

    return run


def _trie(classes: DataFrame, length: int, *columns: str) -> DataFrame:
    """A row per class and tree: the tree and the label's prefix of ``length`` values."""
    trees = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    rows = classes.filter("label IS NOT NULL").select(*columns, "label", trees)
    start = F.col("tree") * (2 * DEPTH) + 1
    prefix = F.substring(F.col("label"), start, F.lit(2 * length)).alias("prefix")
    return rows.select("tree", prefix, *columns)


def _mixed_nodes(trie: DataFrame) -> DataFrame:
    """Trie nodes with more than one family: the first class and the number of classes."""
    first = F.min(F.struct("family", "key"))
    nodes = trie.groupBy("tree", "prefix").agg(
        first.alias("first"), F.max("family").alias("last"), F.count("*").alias("held")
    )
    return nodes.filter(F.col("first.family") != F.col("last"))


def _with_families(classes: DataFrame, edges: DataFrame) -> DataFrame:
    found = components(edges)
    joined = classes.drop("family").join(found, classes["key"] == found["node"], "left")
    family = F.coalesce("component", "key").alias("family")
    return written(joined.select(*classes.columns[:-1], family), "join-families")


def _star_edges(classes: DataFrame, length: int, least: float) -> DataFrame:
    """Edges from the classes of each mixed trie node to its first class, if their labels agree."""
    trie = _trie(classes, length, "key", "family")
    nodes = _mixed_nodes(trie).select("tree", "prefix", "first")
    pairs = trie.join(nodes, ["tree", "prefix"]).filter(F.col("family") != F.col("first.family"))
    pairs = pairs.select(F.col("key").alias("a"), F.col("first.key").alias("b")).distinct()
    labels = classes.select("key", "label")
    one = labels.select(F.col("key").alias("a"), F.col("label").alias("one"))
    two = labels.select(F.col("key").alias("b"), F.col("label").alias("two"))
    asked = pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two")
    return written(asked.mapInArrow(_close_edges(least), "a binary, b binary"), "join-stars")


def _blocks(rows: DataFrame, blocks: Column, group: tuple[str, ...]) -> DataFrame:
    """Each row once for every pair of blocks that its own block is in: columns one <= two."""
    rows = rows.withColumn("_n", F.greatest(blocks.cast("int"), F.lit(1)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("key", F.lit(7)), F.col("_n")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("_n") - 1))
    rows = rows.withColumn("_other", others)
    rows = rows.withColumns(
        {"one": F.least("block", "_other"), "two": F.greatest("block", "_other")}
    )
    order = [*group, "one", "two"]
    return rows.repartition(*order).sortWithinPartitions(*order, "key")


def _bridge_edges(classes: DataFrame, length: int, least: float) -> DataFrame:
    trie = _trie(classes, length, "key", "family")
    nodes = _mixed_nodes(trie).filter("held > 2").select("tree", "prefix", "held")
    rows = trie.join(nodes, ["tree", "prefix"])
    rows = rows.join(classes.select("key", "label"), "key")
    rows = _blocks(rows, F.ceil(F.col("held") / BLOCK_ROWS), ("tree", "prefix"))
    rows = rows.select("tree", "prefix", "one", "two", "key", "family", "label", "block")
    return written(rows.mapInArrow(_family_bridges(least), "a binary, b binary"), "join-bridges")


def overlaps(sets: list[np.ndarray], rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets ``rows`` with sets ``columns``."""
    lengths = [len(s) for s in sets]
    values, places, often = np.unique(
        np.concatenate(sets), return_inverse=True, return_counts=True
    )
    owner = np.repeat(np.arange(len(sets)), lengths)
    shared = often[places] > 1
    places, owner = places[shared], owner[shared]
    _, places = np.unique(places, return_inverse=True)
    found = np.zeros((len(rows), len(columns)), np.float32)
    order = np.argsort(places, kind="stable")
    places, owner = places[order], owner[order]
    total = int(places[-1]) + 1 if len(places) else 0
    for at in range(0, total, 4096):
        lo, hi = np.searchsorted(places, [at, at + 4096])
        dense = np.zeros((len(sets), min(4096, total - at)), np.float32)
        dense[owner[lo:hi], places[lo:hi] - at] = 1
        found += dense[rows] @ dense[columns].T
    return found


def _verified(similarity: float):
    """Per class and pair of blocks: its links there, and the first class it is connected to there."""

    def run(batches):
        for _, (_, one, two, keys, blocks, texts) in contiguous(_first_of_key(batches), 3):
            sets = [shingles((t or "").encode().split(), SHINGLE_WORDS) for t in texts]
            mine = np.array(blocks) == one[0]
            rows = np.flatnonzero(mine)
            columns = rows if one[0] == two[0] else np.flatnonzero(~mine)
            if not len(rows) or not len(columns):
                continue
            sizes = np.array([len(s) for s in sets])
            common = overlaps(sets, rows, columns)
            union = sizes[rows][:, None] + sizes[columns][None, :] - common
            linked = common >= similarity * union - 1e-6
            if one[0] == two[0]:
                np.fill_diagonal(linked, False)
            links = np.zeros(len(keys), np.int64)
            np.add.at(links, rows, linked.sum(1))
            if one[0] != two[0]:
                np.add.at(links, columns, linked.sum(0))
            forest = Forest(len(keys))
            for i, j in np.argwhere(linked):
                forest.join(int(rows[i]), int(columns[j]))
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([keys[i] for i in some], pa.binary()),
                    pa.array(links[some]),
                    pa.array([keys[forest.root(int(i))] for i in some], pa.binary()),
                ],
                ["key", "links", "root"],
            )

    return run


def _first_of_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drops rows that repeat the class of the row before in the same pair of blocks."""
    last = None
    for batch in batches:
        ids = list(zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True))
        fresh = [now != before for now, before in zip(ids, [last, *ids], strict=False)]
        last = ids[-1] if ids else last
        yield batch.filter(pa.array(fresh, pa.bool_()))


def near_duplicates(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILAR,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Each document's class, group and number of links, with the carried columns.

    ``text_class`` is the least doc_id with an equal text, ``n_copies`` how many documents have it,
    ``n_links`` how many different texts are at least ``similarity`` alike, ``class_id`` the least
    doc_id of all that are connected by such links; ``component`` and ``text_key`` name group and text.
    """
    body = plain_text(text)
    own = [F.col(c).alias(f"_carried_{i}") for i, c in enumerate(carry)]
    texts = documents.select(F.col(doc_id).alias("doc"), body.alias("_text"), *own)
    texts = texts.withColumn("key", text_key(F.col("_text")))
    texts = texts.withColumn("bytes", F.octet_length("_text").cast("long"))
    asked = texts.select("doc", "key", "bytes", *[f"_carried_{i}" for i in range(len(carry))], "_text")
    kept = [f.simpleString().replace(":", " ", 1) for f in asked.schema.fields[:-1]]
    facts = asked.mapInArrow(_label_batches, ", ".join([*kept, "label binary"]))
    facts = written(facts, "join-labels")

    least = similarity - SURE_BELOW
    classes = facts.groupBy("key").agg(
        F.min("doc").alias("rep"),
        F.count("*").alias("n_copies"),
        F.max("bytes").alias("bytes"),
        F.first("label").alias("label"),
    )
    classes = written(classes.withColumn("family", F.col("key")), "join-classes")
    edges = None
    for length in dict.fromkeys((DEPTH, final_depth(similarity))):
        found = _star_edges(classes, length, least)
        edges = found if edges is None else edges.unionByName(found)
        classes = _with_families(classes, edges)
    edges = edges.unionByName(_bridge_edges(classes, final_depth(similarity), least))
    classes = _with_families(classes, edges)

    sizes = classes.groupBy("family").agg(
        F.count("*").alias("held"), F.sum("bytes").alias("held_bytes")
    )
    sizes = sizes.filter("held > 1")
    blocks = F.greatest(
        F.ceil(F.col("held") / BLOCK_ROWS), F.ceil(F.col("held_bytes") / BLOCK_BYTES)
    )
    members = classes.join(sizes, "family").select(
        "family", blocks.alias("blocks"), F.col("key").alias("_key"), "rep"
    )
    members = counted_broadcast(written(members, "join-members"))
    same = (texts["key"] == members["_key"]) & texts["doc"].eqNullSafe(members["rep"])
    compared = texts.join(members, same).select("family", "blocks", "key", "_text")
    compared = _blocks(compared, F.col("blocks"), ("family",))
    compared = compared.select("family", "one", "two", "key", "block", "_text")
    schema = "key binary, links bigint, root binary"
    verified = written(compared.mapInArrow(_verified(similarity), schema), "join-links")

    links = verified.groupBy("key").agg(F.sum("links").alias("n_links"))
    groups = components(verified.select(F.col("key").alias("a"), F.col("root").alias("b")))
    groups = groups.withColumnRenamed("node", "key")
    grouped = classes.select("key", "rep", "n_copies").join(groups, "key", "left").join(links, "key", "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "key"))
    names = grouped.groupBy("component").agg(F.min("rep").alias("class_id"))
    named = grouped.join(names, "component").select(
        F.col("key"), "component", "class_id", F.col("rep").alias("text_class"), "n_copies",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )
    return facts.join(named, "key").select(
        F.col("doc").alias(doc_id), "class_id", "text_class", "n_copies", "n_links", "component",
        F.col("key").alias("text_key"),
        *[F.col(f"_carried_{i}").alias(c) for i, c in enumerate(carry)],
    )
