"""Key-level operators that stay balanced when one key holds a large share of the rows.

A question about keys (is it repeated, is it stored already, does its parent exist) is answered on
one pre-aggregated row per key, in one shuffle of the key columns alone. Only the answer travels
back to the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millsight.session import written


def key_profile(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per distinct key of ``frame`` and its ``rows``; NULL members compare equal."""
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))


def _same_key(members: Sequence[str], prefix: str) -> str:
    return " AND ".join(f"{member} <=> {prefix}{i}" for i, member in enumerate(members))


def _renamed(keys: Sequence[str], prefix: str) -> list[str]:
    return [f"{key} AS {prefix}{i}" for i, key in enumerate(keys)]


def _types(frame: DataFrame, members: Sequence[str]) -> list[str]:
    return [kind for _, kind in frame.selectExpr(*members).dtypes]


def _joined(frame: DataFrame, members: Sequence[str], other: DataFrame, prefix: str, how: str) -> DataFrame:
    """``frame`` and the rows of ``other`` whose columns ``prefix`` and a number equal the members.

    Members of one type on either side are compared by their digest first: a large side is then sorted by
    one number, not by long texts that begin alike or by casts that each comparison would repeat.
    """
    match, theirs = _same_key(members, prefix), [f"{prefix}{i}" for i in range(len(members))]
    if _types(frame, members) == _types(other, theirs):
        frame = frame.selectExpr("*", f"xxhash64({', '.join(members)}) AS _digest")
        other = other.selectExpr("*", f"xxhash64({', '.join(theirs)}) AS {prefix}digest")
        match = f"_digest = {prefix}digest AND {match}"
    return frame.join(other, F.expr(match), how)


def held_keys(
    profile: DataFrame,
    keys: Sequence[str],
    other: DataFrame,
    other_keys: Sequence[str] | None = None,
    held: bool = True,
) -> DataFrame:
    """The keys of a :func:`key_profile` that ``other`` holds, or with ``held=False`` those it lacks.

    A semi- or anti-join on one row per key: a repeated key of ``other`` multiplies nothing, and Spark
    may filter ``other`` by the keys' Bloom filter before it is shuffled. NULL members compare equal.
    """
    known = other.selectExpr(*_renamed(other_keys or keys, "_held_"))
    found = _joined(profile, keys, known, "_held_", "left_semi" if held else "left_anti")
    return found.select(*profile.columns)


def flag_rows(
    frame: DataFrame,
    flagged: DataFrame,
    keys: Sequence[str],
    name: str,
    on: Sequence[str] | None = None,
) -> DataFrame:
    """Add boolean ``name`` to every row: TRUE where ``flagged``, one row per key, has its key.

    ``on`` computes the key members where ``frame`` has no columns of their names. No broadcast is
    forced: where the keys are too many for one, the adaptive skew join splits the rows of a hot key.
    """
    flagged = flagged.selectExpr(*_renamed(keys, "_flagged_"), "TRUE AS _flag")
    marked = _joined(frame, on or keys, flagged, "_flagged_", "left")
    return marked.selectExpr(*frame.columns, f"coalesce(_flag, FALSE) AS {name}")


def flag_unresolved(
    frame: DataFrame,
    members: Sequence[str],
    parent: DataFrame,
    parent_columns: Sequence[str],
    name: str,
) -> DataFrame:
    """Add boolean ``name``: TRUE where no parent row has the members' values.

    For dimension parents. No broadcast is forced: Spark broadcasts a parent only where its measured
    size is below the threshold.
    """
    known = parent.selectExpr(*_renamed(parent_columns, "_parent_")).distinct()
    known = known.withColumn("_known", F.lit(True))
    joined = _joined(frame, members, known, "_parent_", "left")
    return joined.selectExpr(*frame.columns, f"_known IS NULL AS {name}")


def keep_resolved(
    frame: DataFrame,
    keys: Sequence[str],
    parent: DataFrame,
    parent_keys: Sequence[str] | None = None,
) -> DataFrame:
    """Rows whose key exists in a parent that may be as large as ``frame``; never multiplies rows.

    A NULL member resolves to nothing. One shuffle of either side; the adaptive skew join splits
    hot keys of ``frame``.
    """
    known = parent.selectExpr(*_renamed(parent_keys or keys, "_parent_"))
    match = " AND ".join(f"{key} = _parent_{i}" for i, key in enumerate(keys))
    return frame.dropna(subset=list(keys)).join(known, F.expr(match), "left_semi")


def duplicate_keys(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their ``copies``."""
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def unseen_files(raw: DataFrame, audit: DataFrame, table: str) -> DataFrame:
    """Rows of files that have no successful audit entry for ``table``.

    The finished files are written first: their measured size lets Spark broadcast them, so that the rows
    are not shuffled by file, where one task would read all rows of a large one.
    """
    done = audit.filter((F.col("table_name") == table) & (F.col("status") == "SUCCESS"))
    done = written(done.select(F.col("source_file").alias("_source_file")).distinct(), "done-files")
    return raw.join(done, "_source_file", "left_anti").select(*raw.columns)


def latest_record(
    frame: DataFrame, keys: Sequence[str], newest_first: str = "_ingested_at"
) -> DataFrame:
    """The newest row of each key.

    Ties on the time are settled by the remaining columns in ascending order, so the result does
    not depend on row order. The rank limit is applied before the shuffle as well
    (``WindowGroupLimit``), so a key with many copies sends one row per input partition.
    """
    rest = [c for c in frame.columns if c not in keys and c != newest_first]
    rest.sort(key=lambda c: (c != "_source_file", c))
    order = [F.col(newest_first).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in rest]]
    ranked = frame.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")
