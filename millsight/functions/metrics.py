"""The governed metric registry.

A rate is (sum of numerators) / (sum of denominators) * scale over additive columns. Every rate in
the library, at every grain, is built from these objects after the sums, so a rate is never an
average of rates. A zero denominator gives NULL.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column, scale: float = 1.0) -> Column:
    """``numerator * scale / denominator`` as DOUBLE, NULL where the denominator is zero."""
    top = numerator.cast("double")
    if scale != 1.0:
        top = top * F.lit(scale)
    return top / F.nullif(denominator.cast("double"), F.lit(0.0))


@dataclass(frozen=True)
class Metric:
    name: str
    numerator: tuple[str, ...]
    denominator: tuple[str, ...]
    scale: float = 1.0
    complement: bool = False  # 1 - ratio
    label: str = ""

    def column(self) -> Column:
        value = ratio(_total(self.numerator), _total(self.denominator), self.scale)
        return F.lit(1.0) - value if self.complement else value


def _total(names: Sequence[str]) -> Column:
    return reduce(add, [F.col(name) for name in names])


# Additive measures (Gold name -> Silver column) and the governed rates.
ADDITIVE = {
    "production_quantity": "completed_qty",
    "pass_quantity": "first_pass_pass_qty",
    "fail_quantity": "fail_qty",
    "rework_quantity": "rework_qty",
    "scrap_quantity": "scrap_qty",
}
_JUDGED = ("pass_quantity", "fail_quantity")
_MADE = ("production_quantity",)
METRICS: Mapping[str, Metric] = {
    metric.name: metric
    for metric in (
        Metric("fpy", ("pass_quantity",), _JUDGED, label="First Pass Yield"),
        Metric("defect_rate", ("fail_quantity",), _MADE, label="Defect Rate"),
        Metric("dppm", ("fail_quantity",), _MADE, 1_000_000.0, label="Defects Per Million"),
        Metric("rework_rate", ("rework_quantity",), _MADE, label="Rework Rate"),
        Metric("scrap_rate", ("scrap_quantity",), _MADE, label="Scrap Rate"),
        Metric("yield_loss", ("pass_quantity",), _JUDGED, complement=True, label="Yield Loss"),
        Metric(
            "supplier_attributed_defect_rate",
            ("defective_units",),
            ("inspected_units",),
            label="Supplier-attributed Defect Rate",
        ),
        Metric(
            "supplier_attributed_dppm",
            ("defective_units",),
            ("inspected_units",),
            1_000_000.0,
            label="Supplier-attributed DPPM",
        ),
    )
}
PRODUCTION_RATES = ("fpy", "defect_rate", "dppm", "rework_rate", "scrap_rate", "yield_loss")
SUPPLIER_RATES = ("supplier_attributed_defect_rate", "supplier_attributed_dppm")


def with_rates(frame: DataFrame, names: Iterable[str] = PRODUCTION_RATES) -> DataFrame:
    """Add governed rates to a frame that already holds the additive columns."""
    return frame.withColumns({name: METRICS[name].column() for name in names})


def rollup(
    frame: DataFrame, by: Sequence[str | Column], measures: Mapping[str, str] = ADDITIVE
) -> DataFrame:
    """Sum additive columns at a grain, renaming them to their governed names."""
    return frame.groupBy(*by).agg(*[F.sum(source).alias(name) for name, source in measures.items()])


def metrics_at(
    frame: DataFrame,
    by: Sequence[str | Column] = (),
    names: Iterable[str] = PRODUCTION_RATES,
    measures: Mapping[str, str] | None = None,
) -> DataFrame:
    """Governed metrics of any row subset at any grain; ``by=()`` gives one row for the scope.

    Works on Gold frames as they are and on Silver frames with ``measures=ADDITIVE``.
    """
    names = tuple(names)
    if measures is None:
        needed = dict.fromkeys(
            column for name in names for column in METRICS[name].denominator + METRICS[name].numerator
        )
        measures = {column: column for column in needed}
    return with_rates(rollup(frame, by, measures), names)
