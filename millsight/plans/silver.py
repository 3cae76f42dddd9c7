"""Silver: conformed dimensions and facts.

By default text is normalized first, then the newest record per key is kept, then relations are
checked, so spellings of one key meet. ``normalize_first=False`` keeps the source order instead:
records are deduplicated and related by their raw text and normalized in the output only.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millsight.contracts import (
    DISPOSITIONS,
    PRODUCTION_KEY,
    QUANTITY_RULES,
    SCHEMAS,
    STAGES,
)
from millsight.functions.calendar import reporting_week
from millsight.functions.text import normalize
from millsight.operators.keys import keep_resolved, latest_record
from millsight.sources.catalog import Lake


@dataclass(frozen=True)
class Text:
    """Text columns of a table by treatment."""

    trim: tuple[str, ...] = ()
    upper: tuple[str, ...] = ()
    lower: tuple[str, ...] = ()

    def apply(self, frame: DataFrame) -> DataFrame:
        return normalize(frame, self.trim, self.upper, self.lower)


# Which text columns are trimmed, upper-cased or lower-cased.
TEXT = {
    "dim_date": Text(),
    "dim_factory": Text(("factory_id", "factory_name", "country"), ("factory_code",)),
    "dim_line": Text(("line_id", "line_name", "factory_id"), ("line_code",)),
    "dim_product": Text(("product_id", "product_name", "product_family"), ("product_code",)),
    "dim_component": Text(
        ("component_id", "component_name", "component_family"), ("component_code",)
    ),
    "dim_supplier": Text(("supplier_id", "supplier_name", "supplier_region"), ("supplier_code",)),
    "dim_defect": Text(
        ("defect_id", "defect_name", "defect_category"), ("defect_code",), ("severity",)
    ),
}
EVENT_ENUMS = Text(lower=("inspection_stage", "disposition"))
PRODUCTION_IDS = Text(("production_lot_id", "factory_id", "line_id", "product_id"))
EVENT_IDS = Text(
    (
        "quality_event_id",
        "production_lot_id",
        "factory_id",
        "line_id",
        "product_id",
        "component_id",
        "supplier_id",
        "component_lot_id",
        "defect_id",
    ),
    lower=EVENT_ENUMS.lower,
)
DIMENSIONS = tuple(name for name in SCHEMAS if name.startswith("dim_"))


def columns_of(table: str) -> list[str]:
    return [column.split(" ")[0] for column in SCHEMAS[table].split(", ")]


def conform_dimension(
    bronze: DataFrame,
    table: str,
    factories: DataFrame | None = None,
    normalize_first: bool = True,
) -> DataFrame:
    """Newest normalized record per key. Lines are kept only where their factory exists."""
    text, columns = TEXT[table], columns_of(table)
    frame = text.apply(bronze) if normalize_first else bronze
    frame = latest_record(frame, columns[:1])
    if table == "dim_line" and factories is not None:
        frame = frame.join(factories.select("factory_id"), "factory_id", "left_semi")
    return (frame if normalize_first else text.apply(frame)).select(*columns)


def valid_quantities() -> Column:
    return reduce(Column.__and__, [F.expr(rule.holds) for rule in QUANTITY_RULES])


def conform_production(
    bronze: DataFrame, dims: Mapping[str, DataFrame], normalize_first: bool = True
) -> DataFrame:
    """Newest record per lot grain with resolved dimensions and valid quantities.

    Dimensions are only tested for existence, so they are semi-joined: nothing is multiplied and
    Spark broadcasts each one whose size is below its threshold.
    """
    frame = PRODUCTION_IDS.apply(bronze) if normalize_first else bronze
    # The lot comes first because it tells rows apart soonest when they are sorted.
    frame = latest_record(frame, tuple(reversed(PRODUCTION_KEY))).filter(valid_quantities())
    dates = dims["dim_date"].select(F.col("date").alias("production_date"))
    for known, key in (
        (dates, ["production_date"]),
        (dims["dim_line"].select("line_id", "factory_id"), ["line_id", "factory_id"]),
        (dims["dim_factory"].select("factory_id"), ["factory_id"]),
        (dims["dim_product"].select("product_id"), ["product_id"]),
    ):
        frame = frame.join(known, key, "left_semi")
    week = reporting_week("production_date")
    return frame.select(
        *columns_of("fact_production"),
        week["reporting_year"].alias("production_year"),
        week["reporting_week"].alias("production_week"),
    )


def conform_events(
    bronze: DataFrame,
    production: DataFrame,
    dims: Mapping[str, DataFrame],
    normalize_first: bool = True,
) -> DataFrame:
    """Newest record per event, tied to a conformed production lot at its full grain.

    The supplier may be NULL; a supplier that is named must exist.
    """
    source = EVENT_IDS.apply(bronze) if normalize_first else bronze
    frame = latest_record(source, ("quality_event_id",)).filter(
        (F.col("event_quantity") > 0)
        & F.col("inspection_stage").isin(*STAGES)
        & F.col("disposition").isin(*DISPOSITIONS)
    )
    for name in ("component", "defect"):
        key = f"{name}_id"
        frame = frame.join(dims[f"dim_{name}"].select(key), key, "left_semi")
    suppliers = dims["dim_supplier"].select(
        F.col("supplier_id").alias("_supplier"), F.lit(True).alias("_known")
    )
    frame = frame.join(suppliers.distinct(), F.col("supplier_id") == F.col("_supplier"), "left")
    frame = frame.filter(F.col("supplier_id").isNull() | F.col("_known")).drop("_supplier", "_known")
    lot = ["event_date", "factory_id", "line_id", "product_id", "production_lot_id"]
    frame = keep_resolved(frame, lot, production, PRODUCTION_KEY)
    if not normalize_first:
        frame = EVENT_ENUMS.apply(frame)
    return frame.select(
        *columns_of("fact_quality_event"),
        F.col("supplier_id").isNotNull().alias("is_supplier_attributed"),
    )


def build_silver(lake: Lake, normalize_first: bool = True) -> None:
    """Publish the nine Silver tables; each later table reads the published earlier ones."""

    def publish(table: str, frame: DataFrame) -> DataFrame:
        stamped = frame.withColumn("_silver_updated_at", F.current_timestamp())
        day = {"fact_production": "production_date", "fact_quality_event": "event_date"}.get(table)
        return lake.publish(stamped, lake.name("silver", f"silver_{table}"), day)

    dims: dict[str, DataFrame] = {}
    for table in DIMENSIONS:
        bronze = lake.table("bronze", table)
        dims[table] = publish(
            table, conform_dimension(bronze, table, dims.get("dim_factory"), normalize_first)
        )
    bronze = lake.table("bronze", "fact_production")
    production = publish("fact_production", conform_production(bronze, dims, normalize_first))
    bronze = lake.table("bronze", "fact_quality_event")
    publish("fact_quality_event", conform_events(bronze, production, dims, normalize_first))
