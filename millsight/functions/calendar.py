"""Reporting periods."""

from __future__ import annotations

from datetime import date
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def reporting_week(day: str, iso_year: bool = False) -> dict[str, Column]:
    """``reporting_year`` and ``reporting_week`` of a date column.

    The default pairs the calendar year with the ISO week, so the last days of December may share a
    key with the first week of the same year. ``iso_year=True`` pairs the ISO year with the ISO week.
    """
    year = F.expr(f"extract(YEAROFWEEK FROM {day})") if iso_year else F.year(day)
    return {"reporting_year": year.cast("int"), "reporting_week": F.weekofyear(day)}


def month_of(day: str) -> Column:
    return F.trunc(day, "month")


@dataclass(frozen=True)
class Period:
    """An inclusive range of days."""

    first: date
    last: date

    @classmethod
    def of(cls, first: str, last: str) -> Period:
        return cls(date.fromisoformat(first), date.fromisoformat(last))

    def holds(self, day: str) -> Column:
        return F.col(day).between(F.lit(self.first), F.lit(self.last))
