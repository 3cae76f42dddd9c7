"""Gold: metric models over conformed facts.

Additive measures stay in every model so rates can be recomputed after any filter.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millsight.functions.calendar import reporting_week
from millsight.functions.metrics import (
    ADDITIVE,
    METRICS,
    SUPPLIER_RATES,
    ratio,
    rollup,
    with_rates,
)
from millsight.operators.ranking import pareto, share_within
from millsight.sources.catalog import Lake

SERIES = ("factory_id", "line_id", "product_id")
CORE = {name: ADDITIVE[name] for name in ("production_quantity", "pass_quantity", "fail_quantity")}


def daily_rollup(production: DataFrame) -> DataFrame:
    """Additive measures by day, factory, line and product."""
    return rollup(production, ("production_date", *SERIES))


def weekly_fpy(daily: DataFrame, iso_year: bool = False) -> DataFrame:
    """FPY by series and reporting week, recomputed from sums."""
    week = reporting_week("production_date", iso_year)
    weekly = daily.withColumns(week).groupBy(*SERIES, *week)
    weekly = weekly.agg(F.sum("pass_quantity").alias("pass_quantity"), F.sum("fail_quantity").alias("fail_quantity"))
    return weekly.withColumn("week_fpy", METRICS["fpy"].column())


def week_over_week(weekly: DataFrame) -> DataFrame:
    """Change of FPY against the previous week present in the series, in percentage points."""
    order = Window.partitionBy(*SERIES).orderBy("reporting_year", "reporting_week")
    change = F.col("week_fpy") - F.lag("week_fpy").over(order)
    return weekly.withColumn("wow_fpy_change", change)


def manufacturing_daily(production: DataFrame, iso_year: bool = False) -> DataFrame:
    """Daily measures and rates with the FPY of their week and its week-over-week change.

    The weekly values are computed on the daily rows themselves: both windows share one
    partitioning and one order, so no weekly table is joined back. A series has one row per day.
    """
    daily = with_rates(daily_rollup(production))
    daily = daily.withColumns(reporting_week("production_date", iso_year))
    daily = daily.withColumn("_week", F.col("reporting_year") * 100 + F.col("reporting_week"))
    series = Window.partitionBy(*SERIES).orderBy("_week")
    same_week = series.rangeBetween(Window.currentRow, Window.currentRow)
    earlier = series.rangeBetween(Window.unboundedPreceding, -1)
    passed = F.sum("pass_quantity").over(same_week)
    failed = F.sum("fail_quantity").over(same_week)
    daily = daily.withColumn("week_fpy", ratio(passed, passed + failed))
    previous = F.last("week_fpy").over(earlier)
    return daily.withColumn("wow_fpy_change", F.col("week_fpy") - previous).drop("_week")


def factory_quality(production: DataFrame, factories: DataFrame) -> DataFrame:
    """Measures and rates by day and factory; the name is joined after the aggregation."""
    by_day = rollup(production, ("production_date", "factory_id"))
    named = by_day.join(factories.select("factory_id", "factory_name", "country"), "factory_id")
    rated = with_rates(named, ("fpy", "dppm", "rework_rate", "scrap_rate"))
    return rated.select(
        "production_date", "factory_id", "factory_name", "country", *CORE,
        "fpy", "dppm", "rework_rate", "scrap_rate",
    )


def product_quality(production: DataFrame, products: DataFrame) -> DataFrame:
    """Measures, rates and the product's share of its factory day."""
    by_day = rollup(production, ("production_date", "factory_id", "product_id"), CORE)
    named = by_day.join(products.select("product_id", "product_name", "product_family"), "product_id")
    shared = share_within(
        with_rates(named, ("fpy", "dppm")),
        "production_quantity",
        ("production_date", "factory_id"),
        "product_mix_share",
    )
    return shared.select(
        "production_date", "factory_id", "product_id", "product_name", "product_family", *CORE,
        "fpy", "product_mix_share", "dppm",
    )


def attributed_lots(events: DataFrame, production: DataFrame) -> DataFrame:
    """Supplier-attributed first-pass defects with the completed units of their lots.

    Two levels: defects are first summed per lot, so a lot's completed units count once per
    (day, factory, product, component, supplier). A lot counts once per such group and therefore
    more than once over several suppliers: inspected units are not additive over them. Lot totals
    are aggregated before the join, so a lot id used twice does not multiply the defects.
    """
    group = ["event_date", "factory_id", "product_id", "component_id", "supplier_id"]
    attributed = events.filter("is_supplier_attributed AND is_first_pass_failure")
    by_lot = attributed.groupBy(*group, "production_lot_id").agg(
        F.sum("event_quantity").alias("defective_units")
    )
    lots = production.groupBy("production_lot_id").agg(F.sum("completed_qty").alias("inspected_units"))
    joined = by_lot.join(lots, "production_lot_id")
    return rollup(joined, group, {c: c for c in ("defective_units", "inspected_units")})


def supplier_quality(
    events: DataFrame, production: DataFrame, suppliers: DataFrame, components: DataFrame
) -> DataFrame:
    named = (
        attributed_lots(events, production)
        .join(suppliers.select("supplier_id", "supplier_name"), "supplier_id")
        .join(components.select("component_id", "component_name"), "component_id")
    )
    return with_rates(named, SUPPLIER_RATES).select(
        "event_date", "factory_id", "product_id", "component_id", "supplier_id",
        "defective_units", "inspected_units", "supplier_name", "component_name", *SUPPLIER_RATES,
    )


def defect_pareto(events: DataFrame, defects: DataFrame) -> DataFrame:
    """First-pass defects by full grain with their share and running share of the factory day."""
    grain = (
        "event_date", "factory_id", "line_id", "product_id", "component_id", "supplier_id", "defect_id",
    )
    first_pass = F.when(F.col("is_first_pass_failure"), F.col("event_quantity")).otherwise(F.lit(0))
    counted = events.groupBy(*grain).agg(F.sum(first_pass).alias("defect_quantity"))
    counted = counted.join(defects.select("defect_id", "defect_name", "defect_category"), "defect_id")
    ranked = pareto(
        counted,
        scope=("event_date", "factory_id"),
        measure="defect_quantity",
        lead=("defect_id", "line_id"),
        rest=("product_id", "component_id", "supplier_id"),
    )
    total = F.col("total_failures")
    return ranked.select(
        *grain, "defect_name", "defect_category", "defect_quantity",
        "total_failures", "cumulative_failures", "pareto_rank",
        ratio(F.col("defect_quantity"), total).alias("defect_contribution"),
        ratio(F.col("cumulative_failures"), total).alias("cumulative_defect_contribution"),
    )


def gold_models(silver: Mapping[str, DataFrame], iso_year: bool = False) -> dict[str, DataFrame]:
    """The five models from Silver frames keyed by their Bronze table names."""
    production, events = silver["fact_production"], silver["fact_quality_event"]
    return {
        "gold_manufacturing_daily": manufacturing_daily(production, iso_year),
        "gold_factory_quality": factory_quality(production, silver["dim_factory"]),
        "gold_product_quality": product_quality(production, silver["dim_product"]),
        "gold_supplier_quality": supplier_quality(
            events, production, silver["dim_supplier"], silver["dim_component"]
        ),
        "gold_defect_pareto": defect_pareto(events, silver["dim_defect"]),
    }


GOLD_TABLES = (
    "gold_manufacturing_daily",
    "gold_factory_quality",
    "gold_product_quality",
    "gold_supplier_quality",
    "gold_defect_pareto",
)


def build_gold(lake: Lake, iso_year: bool = False) -> None:
    """Publish the five Gold tables from the published Silver tables."""
    names = (
        "dim_factory", "dim_product", "dim_component", "dim_supplier", "dim_defect",
        "fact_production", "fact_quality_event",
    )
    silver = {name: lake.table("silver", f"silver_{name}") for name in names}
    for name, frame in gold_models(silver, iso_year).items():
        # Only the daily model carries a refresh time; the others hold business columns alone.
        if name == "gold_manufacturing_daily":
            frame = frame.withColumn("_gold_updated_at", F.current_timestamp())
        day = "production_date" if "production_date" in frame.columns else "event_date"
        lake.publish(frame, lake.name("gold", name), day)
