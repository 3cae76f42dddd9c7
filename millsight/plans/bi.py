"""View-grain calculations: governed metrics recomputed at any displayed grain and filter."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millsight.functions.calendar import Period
from millsight.functions.metrics import (
    METRICS,
    PRODUCTION_RATES,
    SUPPLIER_RATES,
    metrics_at,
    ratio,
)
from millsight.operators.ranking import share_within
from millsight.plans.evidence import FPY_SUMS, by_period, only

DRILL_PATH = (
    "factory_id",
    "product_id",
    "line_id",
    "component_id",
    "supplier_id",
    "defect_id",
)


def view_kpis(
    daily: DataFrame, by: Sequence[str | Column] = (), scope: Mapping[str, object] | None = None
) -> DataFrame:
    """All production metrics at the displayed grain, for the filtered rows."""
    return metrics_at(only(daily, scope or {}), by, PRODUCTION_RATES)


def wow_view(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Week-over-week change at week grain: the average of the weekly value repeated per day."""
    week = ("reporting_year", "reporting_week")
    value = F.avg("wow_fpy_change").alias("wow_fpy_change")
    return daily.groupBy(*by, *week).agg(value)


def mix_share(product_gold: DataFrame, period: Column, scope: Sequence[str] = ("factory_id",)) -> DataFrame:
    """FPY and share of each product, re-aggregated to a displayed period."""
    frame = product_gold.withColumn("period", period)
    names = ("production_quantity", *FPY_SUMS)
    sums = metrics_at(frame, ("period", *scope, "product_id"), ("fpy",), {n: n for n in names})
    shared = share_within(sums, "production_quantity", ("period", *scope), "product_mix_share")
    return shared.select("period", *scope, "product_id", "production_quantity", "fpy", "product_mix_share")


def supplier_rate_view(supplier_gold: DataFrame, by: Sequence[str]) -> DataFrame:
    """Supplier-attributed rates at a coarser grain.

    Inspected units repeat over suppliers and components of one lot, as in the Gold model.
    """
    return metrics_at(supplier_gold, by, SUPPLIER_RATES)


def defect_contribution(pareto_gold: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Share and running share of each defect inside the displayed scope, largest first."""
    sums = pareto_gold.groupBy(*scope, "defect_id").agg(
        F.sum("defect_quantity").alias("defect_quantity")
    )
    total = F.sum("defect_quantity").over(Window.partitionBy(*scope))
    order = Window.partitionBy(*scope).orderBy(F.desc("defect_quantity"), F.asc("defect_id"))
    running = F.sum("defect_quantity").over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return sums.select(
        *scope,
        "defect_id",
        "defect_quantity",
        ratio(F.col("defect_quantity"), total).alias("defect_contribution"),
        ratio(running, total).alias("cumulative_defect_contribution"),
    )


def fpy_with_benchmark(
    daily: DataFrame, by: Sequence[str], fixed: Sequence[str], name: str
) -> DataFrame:
    """FPY at a view grain beside the FPY at a fixed coarser grain, and the gap between them.

    The benchmark is a second aggregation of the view's own sums, joined back on the coarse key, so
    a scope with many marks is never gathered in one window.
    """
    view = daily.groupBy(*by).agg(*[F.sum(c).alias(c) for c in FPY_SUMS])
    coarse = view.groupBy(*fixed).agg(*[F.sum(c).alias(c) for c in FPY_SUMS])
    coarse = coarse.select(*fixed, METRICS["fpy"].column().alias(name))
    joined = view.join(coarse, list(fixed)).withColumn("fpy", METRICS["fpy"].column())
    return joined.select(*by, "fpy", name, (F.col("fpy") - F.col(name)).alias("fpy_gap"))


def factory_benchmark(daily: DataFrame, by: Sequence[str]) -> DataFrame:
    return fpy_with_benchmark(daily, by, ("factory_id",), "factory_fpy")


def product_benchmark(daily: DataFrame, by: Sequence[str]) -> DataFrame:
    return fpy_with_benchmark(daily, by, ("product_id",), "product_fpy")


def include_detail(
    pareto_gold: DataFrame, by: Sequence[str], detail: str, measure: str = "defect_quantity"
) -> DataFrame:
    """Measure totals per hidden ``detail``, summarized at the coarser displayed grain."""
    fine = pareto_gold.groupBy(*by, detail).agg(F.sum(measure).alias("_quantity"))
    coarse = fine.groupBy(*by).agg(
        F.sum("_quantity").alias(measure),
        F.count(F.lit(1)).alias(f"{detail}_count"),
        F.max("_quantity").alias(f"largest_{measure}"),
    )
    mean = ratio(F.col(measure), F.col(f"{detail}_count"))
    lead = ratio(F.col(f"largest_{measure}"), F.col(measure))
    return coarse.withColumns({f"mean_{measure}": mean, "leading_share": lead})


def exclude_detail(
    pareto_gold: DataFrame, by: Sequence[str], detail: str, measure: str = "defect_quantity"
) -> DataFrame:
    """Each mark beside the total of its parent, which ignores ``detail``."""
    marks = pareto_gold.groupBy(*by, detail).agg(F.sum(measure).alias(measure))
    parents = marks.groupBy(*by).agg(F.sum(measure).alias(f"parent_{measure}"))
    return marks.join(parents, list(by)).select(*by, detail, measure, f"parent_{measure}")


def drill(
    gold: DataFrame,
    level: str,
    scope: Mapping[str, object] | None = None,
    names: Sequence[str] = PRODUCTION_RATES,
) -> DataFrame:
    """Metrics at one level of the drill path for the entity selected above it.

    Each level reads one Gold model; models are never joined, which would repeat their measures.
    """
    above = [c for c in DRILL_PATH[: DRILL_PATH.index(level)] if c in (scope or {})]
    return metrics_at(only(gold, scope or {}), (*above, level), names)


def weekly_trend(daily: DataFrame) -> DataFrame:
    """Dashboard trend: volume, failures and rates by reporting week."""
    names = ("production_quantity", *FPY_SUMS, "rework_quantity", "scrap_quantity")
    week = ("reporting_year", "reporting_week")
    return metrics_at(daily, week, ("fpy", "rework_rate", "scrap_rate"), {n: n for n in names})


def entity_comparison(daily: DataFrame, entity: str) -> DataFrame:
    """Dashboard comparison of factories or products."""
    return view_kpis(daily, (entity,))


def rolling_fpy(daily: DataFrame, by: Sequence[str], days: int = 7) -> DataFrame:
    """FPY of the last ``days`` calendar days, recomputed from sums, and the next day's FPY.

    Windows run over one row per entity and day.
    """
    sums = daily.groupBy(*by, "production_date").agg(*[F.sum(c).alias(c) for c in FPY_SUMS])
    sums = sums.withColumns({"_day": F.unix_date("production_date"), "fpy": METRICS["fpy"].column()})
    order = Window.partitionBy(*by).orderBy("_day")
    recent = order.rangeBetween(-(days - 1), Window.currentRow)
    passed, failed = F.sum("pass_quantity").over(recent), F.sum("fail_quantity").over(recent)
    return sums.select(
        *by,
        "production_date",
        "fpy",
        ratio(passed, passed + failed).alias("rolling_fpy"),
        F.lead("fpy").over(order).alias("next_fpy"),
    )


def fpy_change_decomposition(
    gold: DataFrame, before: Period, after: Period, segment: str
) -> DataFrame:
    """Which segments moved the aggregate FPY, split into a rate and a mix effect.

    rate = share after * FPY change within the segment; mix = share change * (segment FPY before -
    aggregate FPY before). The effects of all segments add up to the aggregate change. A segment
    absent from a period takes the aggregate (before) or its own earlier FPY (after) as its FPY.
    """
    sums = {name: name for name in FPY_SUMS}
    periods = {"before": before, "after": after}
    parts = by_period(gold, "production_date", periods, sums, (segment,)).na.fill(0)
    for when in periods:
        judged = F.col(f"pass_quantity_{when}") + F.col(f"fail_quantity_{when}")
        parts = parts.withColumn(f"judged_{when}", judged)
    whole = parts.agg(
        *[F.sum(f"{c}_{when}").alias(f"{c}_{when}") for c in ("pass_quantity", "judged") for when in periods]
    ).select(
        F.struct(
            F.col("judged_before"),
            F.col("judged_after"),
            ratio(F.col("pass_quantity_before"), F.col("judged_before")).alias("fpy_before"),
        ).alias("whole")
    ).scalar()
    own_before = ratio(F.col("pass_quantity_before"), F.col("judged_before"))
    own_after = ratio(F.col("pass_quantity_after"), F.col("judged_after"))
    parts = parts.withColumn("_whole", whole)
    start = F.coalesce(own_before, F.col("_whole.fpy_before"))
    end = F.coalesce(own_after, start)
    share_before = ratio(F.col("judged_before"), F.col("_whole.judged_before"))
    share_after = ratio(F.col("judged_after"), F.col("_whole.judged_after"))
    return parts.select(
        segment,
        share_before.alias("share_before"),
        share_after.alias("share_after"),
        own_before.alias("fpy_before"),
        own_after.alias("fpy_after"),
        (share_after * (end - start)).alias("rate_effect"),
        ((share_after - share_before) * (start - F.col("_whole.fpy_before"))).alias("mix_effect"),
    )
