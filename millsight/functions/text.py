"""Text conforming rules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def normalize(
    frame: DataFrame,
    trim: Iterable[str] = (),
    upper: Iterable[str] = (),
    lower: Iterable[str] = (),
) -> DataFrame:
    """Trim identifiers and names; trim and upper-case codes; trim and lower-case enumerations."""
    changes = {name: F.trim(name) for name in trim}
    changes |= {name: F.upper(F.trim(name)) for name in upper}
    changes |= {name: F.lower(F.trim(name)) for name in lower}
    return frame.withColumns(changes) if changes else frame
