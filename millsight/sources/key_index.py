"""An index of the keys a growing table holds, so that a load reads what its batch may collide with.

The index is a table of distinct keys, partitioned by the month of the key's date member or, for keys
without a date, by a slice of the key's hash. A batch's distinct keys name the months or slices they fall
in; only those partitions are listed and read, and the keys are matched by a semi-join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millsight.contracts import Contract, Horizon
from millsight.sources.catalog import Lake

#: Slices of keys without a date. A batch of fewer keys reads no more than one slice a key.
SLICES = 64
UNDATED = "all"


def month_and_slice(columns: Sequence[str], day: str | None, slices: int = SLICES) -> list[Column]:
    """Where a key belongs; a key without its date has no place, for no stored key is without."""
    month = F.date_format(day, "yyyy-MM") if day else F.lit(UNDATED)
    part = F.lit(0) if day else F.pmod(F.xxhash64(*columns), F.lit(slices)).cast("int")
    return [month.alias("_month"), part.alias("_slice")]


def index_entries(
    frame: DataFrame, columns: Sequence[str], day: str | None = None, slices: int = SLICES
) -> DataFrame:
    """The distinct keys of a frame with their month and slice."""
    return frame.select(*columns).distinct().select(*columns, *month_and_slice(columns, day, slices))


def entries_near(
    index: DataFrame,
    keys: DataFrame,
    columns: Sequence[str],
    day: str | None = None,
    horizon: Horizon | None = None,
    slices: int = SLICES,
) -> DataFrame:
    """The part of the index in the months and slices of ``keys``.

    The driver gets the months and slices that occur, never keys: at most ``slices`` numbers and, as
    stored dates lie within the horizon, its months.
    """
    placed = keys.filter(horizon.covers(day)) if day and horizon else keys
    placed = placed.select(*month_and_slice(columns, day, slices))
    touched = placed.agg(F.collect_set("_month").alias("months"), F.collect_set("_slice").alias("slices")).first()
    return index.filter(F.col("_month").isin(touched.months) & F.col("_slice").isin(touched.slices))


@dataclass(frozen=True)
class KeyIndex:
    """The index of some columns of one Bronze table, itself a table of the lake.

    Keys are added after the rows are committed and may be added twice: lookups ask only whether a key
    is there.
    """

    lake: Lake
    contract: Contract
    columns: tuple[str, ...]
    horizon: Horizon

    @property
    def name(self) -> str:
        return self.lake.name("bronze", f"_keys_{self.contract.name}_{len(self.columns)}_{self.columns[0]}")

    @property
    def day(self) -> str | None:
        """The key's date member."""
        dates = [f.name for f in self.contract.fields if f.sql_type == "DATE" and f.name in self.columns]
        return dates[0] if dates else None

    def prepare(self, stored: DataFrame) -> None:
        """Create the index where it is missing, with the keys that are stored already.

        The table is entered in the catalog once all its files are written.
        """
        if not self.lake.exists(self.name):
            writer = self._entries(stored).write.format("parquet").mode("overwrite")
            writer.partitionBy("_month", "_slice").saveAsTable(self.name)

    def _entries(self, rows: DataFrame) -> DataFrame:
        entries = index_entries(rows, self.columns, self.day).repartition("_month", "_slice")
        return entries.sortWithinPartitions("_month", "_slice", *self.columns)

    def add(self, rows: DataFrame) -> None:
        self.lake.append(self._entries(rows), self.name)

    def near(self, keys: DataFrame) -> DataFrame:
        """The stored keys among which those of a batch may be."""
        return entries_near(self.lake.spark.table(self.name), keys, self.columns, self.day, self.horizon)
