"""A Merkle manifest of a data set, with an inclusion proof for every document.

Documents are the leaves of one tree per partition value, in key order; the trees' roots, in the order of
their values, are the leaves of the top tree. In a tree every two consecutive nodes of a level become the
hash of their hexadecimal digests, a last single one the hash of its own, until one node remains.

Proofs come from incremental witnesses. :class:`Witnesses` takes nodes as a stream of aligned appends and
keeps the open subtrees, tallest first. When a sibling completes, two open subtrees become one and the
partial witnesses of both sides are extended by the digest of the other. Spark cuts each tree into aligned
blocks of ``BLOCK`` leaves, streams every block through its own ``Witnesses`` in parallel and treats the
block roots as further appends: they are the leaves of the next round, until a round has one block. Each
block then takes the witness of its own root from the round above. A task holds one block and one witness;
the driver holds nothing but the number of rounds.

A path is a string of steps, lowest first: ``l`` or ``r`` with the digest of the sibling on that side, or
``n`` where the node is hashed alone.

Defined results: a null value is written as ``-``; null keys come first; rows of equal keys follow by leaf
digest, equal rows are leaves of their own; a null partition value has a tree of its own, the first one;
an empty table has no tree and gives no rows. Carried columns never clash with the operator's own.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millsight.llm.common import counted_broadcast, written

#: Leaves of a block: a power of two, so that a block is a subtree.
BLOCK = 512
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_NODES = "tree string, idx long, digest string, nodes long"


def field(value: Column) -> Column:
    """A value with its length in UTF-8 bytes, so that no two rows are written alike; ``-`` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(value) for value in values]), 256)


def _hash(*digests: str) -> str:
    return sha256("".join(digests).encode()).hexdigest()


class Witnesses:
    """Open subtrees of a stream of aligned appends; ``paths`` holds the members' partial witnesses."""

    def __init__(self) -> None:
        self.open: list[tuple[int, str, list[int]]] = []
        self.paths: list[list[str]] = []

    def append(self, digest: str, height: int = 0) -> None:
        """Add a complete subtree of a height, as one member; open subtrees must not be lower."""
        if self.open and self.open[-1][0] < height:
            raise ValueError("the stream is not aligned to the subtree's height")
        self.paths.append([])
        self._push(height, digest, [len(self.paths) - 1])

    def _push(self, height: int, digest: str, members: list[int]) -> None:
        while self.open and self.open[-1][0] == height:
            _, left, before = self.open.pop()
            for member in before:
                self.paths[member].append("r" + digest)
            for member in members:
                self.paths[member].append("l" + left)
            height, digest, members = height + 1, _hash(left, digest), before + members
        self.open.append((height, digest, members))

    def close(self, height: int = 0) -> str:
        """The root once the stream has ended; it is brought up to at least ``height``."""
        while len(self.open) > 1 or self.open[0][0] < height:
            level, digest, members = self.open.pop()
            for member in members:
                self.paths[member].append("n")
            self._push(level + 1, _hash(digest), members)
        return self.open[0][1]


def _streamed(block: pa.Table, size: int) -> tuple[Witnesses, str, list[int]]:
    """One block through ``Witnesses``: its members, its root and the order of its rows."""
    places = block.column("idx").to_pylist()
    order = sorted(range(len(places)), key=places.__getitem__)
    digests = block.column("digest").to_pylist()
    members = Witnesses()
    for row in order:
        members.append(digests[row])
    whole = block.column("nodes")[0].as_py() <= size
    return members, members.close(0 if whole else size.bit_length() - 1), order


def _block_roots(size: int):
    def run(key, block):
        _, root, _ = _streamed(block, size)
        left = -(-block.column("nodes")[0].as_py() // size)
        return pa.table({"tree": [key[0].as_py()], "idx": [key[1].as_py()], "digest": [root], "nodes": [left]})

    return run


def _block_paths(size: int):
    def run(key, block, above):
        members, _, order = _streamed(block, size)
        upper = above.column("path")[0].as_py()
        paths = [""] * len(order)
        for member, row in enumerate(order):
            paths[row] = "".join(members.paths[member]) + upper
        columns = {n: block.column(n) for n in block.column_names if n not in ("block", "nodes")}
        ends = {n: pa.repeat(above.column(n)[0], len(order)) for n in ("subroot", "root")}
        return pa.table({**columns, "path": pa.array(paths, pa.string()), **ends})

    return run


def _placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows with ``idx``, their place in their tree, and ``nodes``, the tree's size.

    Rows are range-partitioned by tree and order, so a tree that holds most rows spreads over the tasks;
    a row's place is its place in its partition plus the rows of the tree in earlier partitions.
    """
    by = ["tree", *order, "_row"]
    ordered = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    ordered = ordered.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    ordered = written(ordered.drop("_row"), "merkle-ordered")
    parts = ordered.groupBy("tree", "_part").agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "tree",
        "_part",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(tree).alias("nodes"),
    )
    parts = counted_broadcast(written(parts, "merkle-parts"))  # a row per partition and tree in it
    placed = ordered.join(parts, ["tree", "_part"])
    return placed.withColumn("idx", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")


def _rounds(nodes: DataFrame, size: int) -> list[DataFrame]:
    """The nodes of each round, the last one with a single node per tree."""
    found = [nodes]
    while (found[-1].agg(F.max("nodes")).first()[0] or 0) > 1:
        blocks = found[-1].select("tree", "idx", "digest", "nodes").withColumn("block", F.floor(F.col("idx") / size))
        roots = blocks.groupBy("tree", "block").applyInArrow(_block_roots(size), _NODES)
        found.append(written(roots, "merkle-roots"))
    return found


def _descend(rounds: list[DataFrame], above: DataFrame, size: int, carry: str = "") -> DataFrame:
    """From the witnesses of the roots (tree, block, path, subroot, root) to those of the first round."""
    for number in range(len(rounds) - 2, -1, -1):
        schema = f"{_NODES.rpartition(',')[0]}, path string, subroot string, root string"
        if number == 0:
            schema += carry
        blocks = rounds[number].withColumn("block", F.floor(F.col("idx") / size))
        pair = blocks.groupBy("tree", "block").cogroup(above.groupBy("tree", "block"))
        found = pair.applyInArrow(_block_paths(size), schema)
        if number == 0:
            return found
        above = written(found, "merkle-paths").select("tree", F.col("idx").alias("block"), "path", "subroot", "root")
    # Trees of one node each: nothing to climb.
    ends = above.select("tree", "path", "subroot", "root")
    return rounds[0].drop("nodes").join(ends, "tree")


def manifest(
    documents: DataFrame,
    columns: Sequence[str] = COLUMNS,
    key: str = "doc_id",
    partition: str = "lang",
    carry: Sequence[str] = (),
    block: int = BLOCK,
) -> DataFrame:
    """Per document its key, ``leaf``, ``path``, the tree's ``subroot``, the ``root`` and carried columns."""
    value = F.col(partition).cast("string")
    kept = [F.col(c).alias(f"_carried_{i}") for i, c in enumerate(carry)]
    leaves = documents.select(
        F.when(value.isNull(), "").otherwise(F.concat(F.lit("="), value)).alias("tree"),
        F.col(key).alias("_key"),
        leaf(*[F.col(c) for c in columns]).alias("digest"),
        *kept,
    )
    placed = written(_placed(leaves, ("_key", "digest")), "merkle-leaves")
    rounds = _rounds(placed, block)

    roots = rounds[-1].select("tree", F.col("digest").alias("digest"))
    tops = _placed(roots.select(F.lit("").alias("tree"), F.col("tree").alias("_lower"), "digest"), ("_lower",))
    tops = written(tops, "merkle-tops")
    upper = _rounds(tops, block)
    ends = upper[-1].select(
        "tree", F.lit(0).cast("long").alias("block"), F.lit("").alias("path"), F.lit("").alias("subroot"), F.col("digest").alias("root")
    )
    climbed = _descend(upper, ends, block, ", _lower string")
    above = climbed.select(
        F.col("_lower").alias("tree"), F.lit(0).cast("long").alias("block"), "path", F.col("digest").alias("subroot"), "root"
    )
    above = written(above, "merkle-above")

    types = "".join(f", {f.name} {f.dataType.simpleString()}" for f in placed.schema.fields if f.name[0] == "_")
    found = _descend(rounds, above, block, types)
    return found.select(
        F.col("_key").alias(key),
        F.col("digest").alias("leaf"),
        "path",
        "subroot",
        "root",
        *[F.col(f"_carried_{i}").alias(c) for i, c in enumerate(carry)],
    )


def proof(path: Column) -> Column:
    """The siblings of a path, level by level, as one text."""
    return F.translate(path, "lrn", "")


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf digest and a path lead to."""

    def climb(node: Column, step: Column) -> Column:
        sibling = F.substring(step, 2, 64)
        joined = F.when(step.startswith("l"), F.concat(sibling, node)).when(step.startswith("r"), F.concat(node, sibling))
        return F.sha2(F.coalesce(joined, node), 256)

    steps = F.regexp_extract_all(path, F.lit("([lr][0-9a-f]{64}|n)"), 1)
    return F.aggregate(steps, digest, climb)
