"""Evidence operators: what a Gold or Silver frame says about a suspected incident.

All of them take the window and the scope as parameters and recompute rates from sums.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millsight.functions.calendar import Period, month_of
from millsight.functions.metrics import METRICS, metrics_at, ratio
from millsight.operators.ordering import with_position
from millsight.operators.ranking import lead_over_runner_up

FPY_SUMS = ("pass_quantity", "fail_quantity")


#: Report order by evidence: the column that leads, and whether its largest value comes first. Ties
#: follow the remaining columns.
REPORT_ORDER = {
    "quarantine_profile": (("table_name", False), ("records", True)),
    "supplier_component_defects": (("defective_units", True),),
    "line_defects": (("defect_quantity", True),),
    "line_trend": (("production_date", False), ("line_id", False)),
    "component_lots": (("event_quantity", True),),
    "mix_detail": (("production_date", False), ("product_id", False)),
}


def in_report_order(frame: DataFrame, evidence: str) -> DataFrame:
    """The evidence with ``position``, its row's place in the report, from 1.

    The place is a column, as rows of a stored or shuffled frame have no order. NULLs come last where
    the largest value leads, first elsewhere.
    """
    lead = REPORT_ORDER[evidence]
    rest = [c for c in frame.columns if c not in dict(lead)]
    order = [F.col(c).desc_nulls_last() if largest else F.col(c).asc_nulls_first() for c, largest in lead]
    return with_position(frame, [*order, *[F.col(c).asc_nulls_first() for c in rest]])


def only(frame: DataFrame, scope: Mapping[str, object]) -> DataFrame:
    """Rows whose columns equal the scope's values."""
    for column, value in scope.items():
        frame = frame.filter(F.col(column) == F.lit(value))
    return frame


def named_period(day: str, periods: Mapping[str, Period]) -> Column:
    """The name of the period a day falls in, NULL outside all of them."""
    label = F.lit(None).cast("string")
    for name, period in reversed(periods.items()):
        label = F.when(period.holds(day), F.lit(name)).otherwise(label)
    return label


def by_period(
    frame: DataFrame,
    day: str,
    periods: Mapping[str, Period],
    sums: Mapping[str, str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Sums per group with one column per (measure, period): ``<measure>_<period>``.

    One conditional aggregation and one scan, instead of one query per period joined together.
    """
    inside = None
    for period in periods.values():
        inside = period.holds(day) if inside is None else inside | period.holds(day)
    label = named_period(day, periods)
    return frame.filter(inside).withColumn("_period", label).groupBy(*by).agg(
        *[
            F.sum(F.when(F.col("_period") == name, F.col(source))).alias(f"{measure}_{name}")
            for measure, source in sums.items()
            for name in periods
        ]
    )


def rate_of(numerator: str, denominator: str, period: str) -> Column:
    """A rate from the columns :func:`by_period` made for one period."""
    return ratio(F.col(f"{numerator}_{period}"), F.col(f"{denominator}_{period}"))


def fpy_of(period: str) -> Column:
    passed, failed = F.col(f"pass_quantity_{period}"), F.col(f"fail_quantity_{period}")
    return ratio(passed, passed + failed)


def supplier_component_defects(supplier_gold: DataFrame, window: Period) -> DataFrame:
    """Evidence A: attributed defects and their rate by supplier and component."""
    inside = supplier_gold.filter(window.holds("event_date"))
    by_pair = inside.groupBy("supplier_id", "component_id").agg(
        F.sum("defective_units").alias("defective_units"),
        F.sum("inspected_units").alias("_inspected"),
    )
    rate = ratio(F.col("defective_units"), F.col("_inspected"))
    return by_pair.withColumn("defect_rate", rate).drop("_inspected")


def line_defects(pareto_gold: DataFrame, window: Period) -> DataFrame:
    """Evidence B: defect quantity by factory, line and defect."""
    inside = pareto_gold.filter(window.holds("event_date"))
    return inside.groupBy("factory_id", "line_id", "defect_id").agg(
        F.sum("defect_quantity").alias("defect_quantity")
    )


def line_trend(daily_gold: DataFrame, window: Period, scope: Mapping[str, object]) -> DataFrame:
    """Evidence C: daily rework rate and FPY of each line of a factory."""
    inside = only(daily_gold.filter(window.holds("production_date")), scope)
    rated = metrics_at(inside, ("production_date", "factory_id", "line_id"), ("rework_rate", "fpy"))
    return rated.select("production_date", "factory_id", "line_id", "rework_rate", "fpy")


def component_lots(events: DataFrame, window: Period) -> DataFrame:
    """Evidence D: event quantity by component lot, supplier and component."""
    inside = events.filter(window.holds("event_date"))
    return inside.groupBy("component_lot_id", "supplier_id", "component_id").agg(
        F.sum("event_quantity").alias("event_quantity")
    )


def mix_versus_within(
    factory_gold: DataFrame,
    product_gold: DataFrame,
    periods: Mapping[str, Period],
    scope: Mapping[str, object],
) -> DataFrame:
    """Evidence E: change of the aggregate FPY against the mean absolute change within products.

    A fall of the first without a matching second is a mix effect. Products present in only one
    period do not enter the mean. ``periods`` names exactly the periods ``pre`` and ``post``.
    """
    sums = {name: name for name in FPY_SUMS}
    whole = by_period(only(factory_gold, scope), "production_date", periods, sums)
    products = by_period(only(product_gold, scope), "production_date", periods, sums, ("product_id",))
    change = F.abs(fpy_of("post") - fpy_of("pre"))
    within = products.agg(F.avg(change).alias("mean_absolute_product_fpy_change")).scalar()
    return whole.select(
        fpy_of("pre").alias("aggregate_pre_fpy"),
        fpy_of("post").alias("aggregate_post_fpy"),
        (fpy_of("post") - fpy_of("pre")).alias("aggregate_fpy_change"),
        within.alias("mean_absolute_product_fpy_change"),
    )


def mix_verdict(change: DataFrame, least_drop: float = 0.004, most_within: float = 0.035) -> DataFrame:
    """``mix_versus_within`` with ``is_mix_effect``: the aggregate fell, the products stayed."""
    fell = F.col("aggregate_fpy_change") < -least_drop
    stayed = F.col("mean_absolute_product_fpy_change") < most_within
    return change.withColumn("is_mix_effect", fell & stayed)


def mix_detail(product_gold: DataFrame, window: Period, scope: Mapping[str, object]) -> DataFrame:
    """Evidence E, detail: daily volume, FPY and share of each product."""
    return only(product_gold.filter(window.holds("production_date")), scope).select(
        "production_date", "factory_id", "product_id", "production_quantity", "fpy",
        "product_mix_share",
    )


def learning_curve(
    daily_gold: DataFrame,
    early: Period,
    late: Period,
    scope: Mapping[str, object],
    ramp_factor: float = 1.5,
) -> DataFrame:
    """Rework rate and FPY of an early and a late period.

    ``improves`` asks for less rework and a higher FPY; ``is_ramp`` for an early rework rate above
    ``ramp_factor`` times the late one.
    """
    periods = {"early": early, "late": late}
    names = (*FPY_SUMS, "rework_quantity", "production_quantity")
    sums = by_period(only(daily_gold, scope), "production_date", periods, {n: n for n in names})

    curve = sums.select(
        rate_of("rework_quantity", "production_quantity", "early").alias("early_rework_rate"),
        rate_of("rework_quantity", "production_quantity", "late").alias("late_rework_rate"),
        fpy_of("early").alias("early_fpy"),
        fpy_of("late").alias("late_fpy"),
    )
    better = (F.col("early_rework_rate") > F.col("late_rework_rate")) & (
        F.col("early_fpy") < F.col("late_fpy")
    )
    ramp = F.col("early_rework_rate") > F.col("late_rework_rate") * F.lit(ramp_factor)
    return curve.withColumns({"improves": better, "is_ramp": ramp})


def monthly_fpy(gold: DataFrame, scope: Mapping[str, object], by: Sequence[str] = ()) -> DataFrame:
    """FPY by month, optionally by further columns."""
    months = only(gold, scope).withColumn("production_month", month_of("production_date"))
    return metrics_at(months, ("production_month", *by), ("fpy",))


def within_product_stability(
    product_gold: DataFrame,
    before: Period,
    after: Period,
    scope: Mapping[str, object],
    tolerance: float = 0.035,
) -> DataFrame:
    """Mean absolute FPY change within products present in both periods, against a tolerance."""
    periods = {"before": before, "after": after}
    sums = {name: name for name in FPY_SUMS}
    products = by_period(only(product_gold, scope), "production_date", periods, sums, ("product_id",))
    change = F.abs(fpy_of("after") - fpy_of("before"))
    measured = products.agg(
        F.count(change).alias("products"), F.avg(change).alias("mean_abs_product_fpy_change")
    )
    stable = F.col("mean_abs_product_fpy_change") < F.lit(tolerance)
    return measured.withColumn("is_stable", stable)


def mix_shift(
    product_gold: DataFrame, before: Period, after: Period, scope: Mapping[str, object]
) -> DataFrame:
    """Volume of each product before and after, with the direction of the change."""
    periods = {"before": before, "after": after}
    sums = {"volume": "production_quantity"}
    volumes = by_period(only(product_gold, scope), "production_date", periods, sums, ("product_id",))
    change = F.coalesce("volume_after", F.lit(0)) - F.coalesce("volume_before", F.lit(0))
    return volumes.withColumns({"volume_change": change, "direction": F.signum(change).cast("int")})


def window_lift(
    events: DataFrame,
    window: Period,
    baseline: Period,
    by: Sequence[str],
    factor: float = 2.0,
) -> DataFrame:
    """Event quantity inside a window against a baseline window, per group.

    ``is_lifted`` asks for more than ``factor`` times the baseline; a group without baseline events
    has a baseline of zero.
    """
    periods = {"window": window, "baseline": baseline}
    sums = {"quantity": "event_quantity"}
    grouped = by_period(events, "event_date", periods, sums, by)
    grouped = grouped.withColumns(
        {name: F.coalesce(name, F.lit(0)) for name in ("quantity_window", "quantity_baseline")}
    )
    lift = ratio(F.col("quantity_window"), F.col("quantity_baseline"))
    lifted = F.col("quantity_window") > F.col("quantity_baseline") * F.lit(factor)
    return grouped.withColumns({"lift": lift, "is_lifted": lifted})


def unattributed_share(events: DataFrame, window: Period, by: Sequence[str]) -> DataFrame:
    """Event quantity without a named supplier and its share of the group."""
    free = F.when(F.col("supplier_id").isNull(), F.col("event_quantity")).otherwise(F.lit(0))
    inside = events.filter(window.holds("event_date")).groupBy(*by)
    sums = inside.agg(
        F.sum("event_quantity").alias("event_quantity"), F.sum(free).alias("unattributed_quantity")
    )
    share = ratio(F.col("unattributed_quantity"), F.col("event_quantity"))
    return sums.withColumn("unattributed_share", share)


def lot_concentration(events: DataFrame, factor: float = 3.0) -> DataFrame:
    """Per component and supplier: is one component lot far ahead of all the others?"""
    attributed = events.filter(F.col("supplier_id").isNotNull())
    scope = ("component_id", "supplier_id")
    return lead_over_runner_up(attributed, scope, "component_lot_id", "event_quantity", factor)


def period_pivot(
    daily_gold: DataFrame, periods: Mapping[str, Period], by: Sequence[str]
) -> DataFrame:
    """FPY of each named period side by side."""
    sums = {name: name for name in FPY_SUMS}
    grouped = by_period(daily_gold, "production_date", periods, sums, by)
    return grouped.select(*by, *[fpy_of(name).alias(f"fpy_{name}") for name in periods])


def stored_rate_mismatches(
    gold: DataFrame,
    names: Sequence[str] = ("fpy", "defect_rate", "dppm", "rework_rate", "scrap_rate"),
    tolerance: float = 1e-12,
    scaled_tolerance: float = 1e-6,
) -> Column:
    """TRUE where a stored rate differs from its own numerator and denominator.

    A rate that is NULL on one side only is a mismatch.
    """
    wrong = F.lit(False)
    for name in names:
        metric = METRICS[name]
        stored, fresh = gold[name], metric.column()
        limit = tolerance if metric.scale == 1.0 else scaled_tolerance
        off = F.coalesce(F.abs(stored - fresh) > F.lit(limit), F.lit(False))
        wrong = wrong | off | (stored.isNull() != fresh.isNull())
    return wrong
