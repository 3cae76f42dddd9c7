"""Every operator as a query over the driver tables: name -> (spark, folder) -> DataFrame.

No query returns rows to the driver, times or generated ids. Those that place rows in an order of the
whole frame write the ranges of that order in the shared work folder.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Sequence
from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millsight.contracts import PRODUCTION_KEY, Horizon, contracts
from millsight.functions.calendar import Period, month_of
from millsight.functions.metrics import ADDITIVE, metrics_at, with_rates
from millsight.functions.text import normalize
from millsight.operators import keys as key_ops
from millsight.operators import quality, ranking
from millsight.plans import bi, bronze, checks, evidence, gold, silver
from millsight.registry.star import DirtyStar, Star
from millsight.session import work_folder, written
from millsight.sources.catalog import LAYERS, Lake
from millsight.sources.key_index import entries_near, index_entries
from millsight.sources.landing import register_landing, scan_lineage, source_inventory

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

HORIZON = Horizon(date(1995, 6, 1), date(2001, 6, 30))
CONTRACTS = contracts(HORIZON)
YEAR = Period.of("1997-01-01", "1997-12-31")
EARLIER = Period.of("1996-01-01", "1996-12-31")
QUARTER = Period.of("1998-01-01", "1998-03-31")
BASELINE = Period.of("1997-10-03", "1997-12-31")
FACTORY = {"factory_id": "FAC-2"}
SCANNED = ("region", "nation", "supplier", "part", "orders", "lineitem")


def query(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Register a function of a clean or dirty star under its own name."""
    kind = DirtyStar if "dirty" in build.__code__.co_varnames[:1] else Star
    QUERIES[build.__name__.rstrip("_")] = lambda spark, folder: build(kind(spark, folder))
    return build


# --- ingestion -------------------------------------------------------------------------------


@query
def source_inventory_(star: Star) -> DataFrame:
    tables = {**star.silver, "fact_other": star.production.filter("started_qty < 0")}
    del tables["dim_defect"]
    return source_inventory(tables)


QUERIES["scan_lineage"] = lambda spark, folder: scan_lineage(spark, folder, SCANNED)


@query
def ingest_new_files(dirty: DirtyStar) -> DataFrame:
    unseen = key_ops.unseen_files(dirty.raw_production, dirty.audit, "fact_production")
    return unseen.select("production_lot_id", "production_qty", "_source_file")


@query
def dq_missing_column(dirty: DirtyStar) -> DataFrame:
    raw = dirty.raw_production.drop("scrap_qty", "line_id")
    checked = bronze.check_batch(raw, CONTRACTS["fact_production"], settle=written)
    codes, messages = quality.issue_text("_errors")
    return checked.select(
        "production_lot_id", "line_id", "scrap_qty", codes.alias("codes"), messages.alias("messages")
    )


@query
def dq_safe_cast(dirty: DirtyStar) -> DataFrame:
    contract = CONTRACTS["fact_production"]
    return bronze.type_batch(dirty.raw_production, contract).select(*contract.columns)


def _issues(raw: DataFrame, table: str, wanted: tuple[str, ...]) -> DataFrame:
    """Issues of the given codes only, as text per row."""
    contract = CONTRACTS[table]
    checked = bronze.check_batch(raw, contract, settle=written)
    kept = F.filter("_errors", lambda found: found["code"].isin(*wanted))
    text = checked.withColumn("_errors", kept).filter(F.size("_errors") > 0)
    codes, messages = quality.issue_text("_errors")
    return text.select(contract.columns[0], codes.alias("codes"), messages.alias("messages"))


@query
def dq_required(dirty: DirtyStar) -> DataFrame:
    return _issues(dirty.raw_production, "fact_production", ("NULL_REQUIRED_VALUE",))


@query
def dq_invalid_type(dirty: DirtyStar) -> DataFrame:
    return _issues(dirty.raw_events, "fact_quality_event", ("INVALID_DATA_TYPE",))


@query
def dq_row_rules(dirty: DirtyStar) -> DataFrame:
    contract = CONTRACTS["fact_production"]
    typed = bronze.type_batch(dirty.raw_production, contract)
    issues = typed.withColumn("_errors", quality.entries(quality.rule_issues(contract)))
    codes, messages = quality.issue_text("_errors")
    failing = issues.filter(F.size("_errors") > 0)
    return failing.select("production_lot_id", codes.alias("codes"), messages.alias("messages"))


@query
def dq_event_rules(dirty: DirtyStar) -> DataFrame:
    contract = CONTRACTS["fact_quality_event"]
    typed = bronze.type_batch(dirty.raw_events, contract)
    issues = typed.withColumn("_errors", quality.entries(quality.rule_issues(contract)))
    codes, messages = quality.issue_text("_errors")
    failing = issues.filter(F.size("_errors") > 0)
    return failing.select("quality_event_id", codes.alias("codes"), messages.alias("messages"))


def _dimension_rules(frame: DataFrame, table: str, key: str) -> DataFrame:
    contract = CONTRACTS[table]
    failed = F.concat_ws(
        ",", *[F.when(F.expr(quality.violates(rule)), rule.code) for rule in contract.rules]
    )
    return frame.select(F.col(key).cast("string").alias("id"), failed.alias("codes"))


@query
def dq_dimension_rules(star: Star) -> DataFrame:
    """Date horizon, baseline FPY and complexity rules; the middle one is shifted out of range."""
    shifted = F.expr("baseline_fpy + CASE WHEN factory_id = 'FAC-3' THEN 1 ELSE 0 END")
    factories = star.dims["dim_factory"].withColumn("baseline_fpy", shifted)
    dates = _dimension_rules(star.dims["dim_date"], "dim_date", "date_id")
    factories = _dimension_rules(factories, "dim_factory", "factory_id")
    products = _dimension_rules(star.dims["dim_product"], "dim_product", "product_id")
    return dates.unionByName(factories).unionByName(products)


@query
def dq_duplicate_in_batch(dirty: DirtyStar) -> DataFrame:
    return _issues(dirty.raw_production, "fact_production", ("DUPLICATE_KEY",))


@query
def dq_duplicate_vs_target(dirty: DirtyStar) -> DataFrame:
    contract = CONTRACTS["fact_production"]
    typed = bronze.type_batch(dirty.raw_production, contract)
    profile = key_ops.key_profile(typed, contract.key)
    known = key_ops.held_keys(profile, contract.key, dirty.stored_production)
    flagged = key_ops.flag_rows(typed, known, contract.key, "is_stored")
    return flagged.select("production_lot_id", "production_date", "_source_file", "is_stored")


def _parents(dirty: DirtyStar, table: str) -> dict[str, DataFrame]:
    """Accepted parent rows of a table's references."""
    names = [reference.parent for reference in CONTRACTS[table].references]
    large = {"fact_production": dirty.parent_production}
    return {name: large[name] if name in large else dirty.dims[name] for name in names}


@query
def dq_foreign_key(dirty: DirtyStar) -> DataFrame:
    contract = CONTRACTS["fact_quality_event"]
    parents = _parents(dirty, "fact_quality_event")
    checked = bronze.check_batch(dirty.raw_events, contract, parents=parents, settle=written)
    wrong = F.filter("_errors", lambda found: found["code"] == "INVALID_FOREIGN_KEY")
    messages = F.concat_ws("; ", F.transform(wrong, lambda found: found["message"]))
    return checked.filter(F.size(wrong) > 0).select("quality_event_id", messages.alias("messages"))


def _checked_production(dirty: DirtyStar) -> DataFrame:
    return bronze.check_batch(
        dirty.raw_production,
        CONTRACTS["fact_production"],
        stored=dirty.stored_production,
        parents=_parents(dirty, "fact_production"),
        settle=written,
    )


def _checked_events(dirty: DirtyStar) -> DataFrame:
    parents = _parents(dirty, "fact_quality_event")
    contract = CONTRACTS["fact_quality_event"]
    return bronze.check_batch(dirty.raw_events, contract, parents=parents, settle=written)


@query
def bronze_valid(dirty: DirtyStar) -> DataFrame:
    return bronze.accepted_rows(_checked_production(dirty), CONTRACTS["fact_production"])


@query
def bronze_quarantine(dirty: DirtyStar) -> DataFrame:
    return bronze.quarantined_rows(_checked_production(dirty), CONTRACTS["fact_production"])


@query
def bronze_event_valid(dirty: DirtyStar) -> DataFrame:
    return bronze.accepted_rows(_checked_events(dirty), CONTRACTS["fact_quality_event"])


@query
def bronze_event_quarantine(dirty: DirtyStar) -> DataFrame:
    return bronze.quarantined_rows(_checked_events(dirty), CONTRACTS["fact_quality_event"])


@query
def ingestion_audit(dirty: DirtyStar) -> DataFrame:
    return bronze.file_audit(_checked_production(dirty), CONTRACTS["fact_production"])


# --- conforming ------------------------------------------------------------------------------


@query
def latest_record(dirty: DirtyStar) -> DataFrame:
    return key_ops.latest_record(dirty.bronze_production, PRODUCTION_KEY)


@query
def normalize_text(dirty: DirtyStar) -> DataFrame:
    events = dirty.bronze_events.select(
        "quality_event_id", "_ingested_at", "inspection_stage", "disposition", "defect_id"
    )
    return normalize(events, ("defect_id",), ("disposition",), ("inspection_stage",))


def _silver_dims(
    dirty: DirtyStar, names: Sequence[str], normalize_first: bool = True
) -> dict[str, DataFrame]:
    """The named conformed dimensions."""

    def conform(name: str, factories: DataFrame | None = None) -> DataFrame:
        frame = dirty.bronze_dims[name]
        return silver.conform_dimension(frame, name, factories, normalize_first)

    factories = conform("dim_factory")
    return {
        name: factories if name == "dim_factory" else conform(name, factories) for name in names
    }


PRODUCTION_DIMS = ("dim_date", "dim_factory", "dim_line", "dim_product")
EVENT_DIMS = (*PRODUCTION_DIMS, "dim_component", "dim_supplier", "dim_defect")


def _register_dimension(table: str) -> None:
    def build(spark: SparkSession, folder: str) -> DataFrame:
        return _silver_dims(DirtyStar(spark, folder), (table,))[table]

    QUERIES[f"silver_{table}"] = build


for _table in silver.DIMENSIONS:
    _register_dimension(_table)


def _silver_production(dirty: DirtyStar, normalize_first: bool = True) -> DataFrame:
    dims = _silver_dims(dirty, PRODUCTION_DIMS, normalize_first)
    return silver.conform_production(dirty.bronze_production, dims, normalize_first)


def _silver_events(dirty: DirtyStar, normalize_first: bool = True) -> DataFrame:
    dims = _silver_dims(dirty, EVENT_DIMS, normalize_first)
    production = silver.conform_production(dirty.bronze_production, dims, normalize_first)
    return silver.conform_events(dirty.bronze_events, production, dims, normalize_first)


@query
def silver_fact_production(dirty: DirtyStar) -> DataFrame:
    return _silver_production(dirty)


@query
def silver_fact_production_source_order(dirty: DirtyStar) -> DataFrame:
    return _silver_production(dirty, normalize_first=False)


@query
def silver_fact_quality_event(dirty: DirtyStar) -> DataFrame:
    return _silver_events(dirty)


@query
def silver_fact_quality_event_source_order(dirty: DirtyStar) -> DataFrame:
    return _silver_events(dirty, normalize_first=False)


@query
def bronze_to_gold_factory_quality(dirty: DirtyStar) -> DataFrame:
    dims = _silver_dims(dirty, PRODUCTION_DIMS)
    production = silver.conform_production(dirty.bronze_production, dims)
    return gold.factory_quality(production, dims["dim_factory"])


# --- Gold ------------------------------------------------------------------------------------


@query
def gold_manufacturing_daily(star: Star) -> DataFrame:
    return gold.manufacturing_daily(star.production)


@query
def gold_manufacturing_daily_iso_year(star: Star) -> DataFrame:
    return gold.manufacturing_daily(star.production, iso_year=True)


@query
def daily_rollup(star: Star) -> DataFrame:
    return gold.daily_rollup(star.production)


@query
def governed_metrics(star: Star) -> DataFrame:
    return with_rates(gold.daily_rollup(star.production))


@query
def weekly_fpy(star: Star) -> DataFrame:
    return gold.weekly_fpy(gold.daily_rollup(star.production))


@query
def wow_change(star: Star) -> DataFrame:
    return gold.week_over_week(gold.weekly_fpy(gold.daily_rollup(star.production)))


@query
def gold_factory_quality(star: Star) -> DataFrame:
    return gold.factory_quality(star.production, star.dims["dim_factory"])


@query
def gold_product_quality(star: Star) -> DataFrame:
    return gold.product_quality(star.production, star.dims["dim_product"])


def _supplier_gold(star: Star) -> DataFrame:
    dims = star.dims
    return gold.supplier_quality(
        star.events, star.production, dims["dim_supplier"], dims["dim_component"]
    )


@query
def gold_supplier_quality(star: Star) -> DataFrame:
    return _supplier_gold(star)


@query
def attributed_lot_rate(star: Star) -> DataFrame:
    return gold.attributed_lots(star.events, star.production)


def _pareto_gold(star: Star) -> DataFrame:
    return gold.defect_pareto(star.events, star.dims["dim_defect"])


@query
def gold_defect_pareto(star: Star) -> DataFrame:
    return _pareto_gold(star)


@query
def scope_metrics(star: Star) -> DataFrame:
    scope = evidence.only(star.production, FACTORY)
    return metrics_at(scope, measures=ADDITIVE)


# --- validation ------------------------------------------------------------------------------


@query
def duplicate_keys(dirty: DirtyStar) -> DataFrame:
    return key_ops.duplicate_keys(dirty.bronze_production, PRODUCTION_KEY)


@query
def period_pivot(star: Star) -> DataFrame:
    daily = gold.daily_rollup(star.production)
    return evidence.period_pivot(daily, {"pre": EARLIER, "post": YEAR}, ("factory_id", "product_id"))


@query
def row_count_check(star: Star) -> DataFrame:
    expected = {"dim_factory": 5, "dim_line": 25, "dim_product": 6, "fact_production": 2110}
    return checks.row_count_check(star.silver, expected)


@query
def gold_row_counts(star: Star) -> DataFrame:
    return checks.row_count_check(gold.gold_models(star.silver), checks.DEMO_GOLD_ROWS)


@query
def quarantine_profile(dirty: DirtyStar) -> DataFrame:
    contract = CONTRACTS["fact_production"]
    rejected = bronze.quarantined_rows(_checked_production(dirty), contract)
    return checks.quarantine_profile(rejected)


@query
def audit_totals(dirty: DirtyStar) -> DataFrame:
    return checks.audit_totals(dirty.audit)


@query
def audit_duplicates(dirty: DirtyStar) -> DataFrame:
    return checks.audit_duplicates(dirty.audit)


@query
def grain_duplicates(dirty: DirtyStar) -> DataFrame:
    return checks.grain_duplicates(dirty.bronze_production)


@query
def event_duplicates(dirty: DirtyStar) -> DataFrame:
    return checks.event_duplicates(dirty.bronze_events)


@query
def invalid_quantities(dirty: DirtyStar) -> DataFrame:
    return checks.invalid_quantities(dirty.bronze_production)


@query
def metric_reconciliation(star: Star) -> DataFrame:
    """Stored rates of one product are spoiled, so violations are found."""
    daily = with_rates(gold.daily_rollup(star.production))
    spoiled = F.when(F.col("product_id") == "PROD-4", F.col("fpy") + 1e-9).otherwise(F.col("fpy"))
    return checks.metric_reconciliation(daily.withColumn("fpy", spoiled))


@query
def dataset_validation(dirty: DirtyStar) -> DataFrame:
    tables = {
        **dirty.dims,
        "fact_production": dirty.bronze_production.drop("_ingested_at", "_source_file", "_batch_id"),
        "fact_quality_event": dirty.bronze_events,
    }
    return checks.dataset_validation(tables, HORIZON, CONTRACTS)


@query
def dataset_validation_drift(dirty: DirtyStar) -> DataFrame:
    """The same checks on fact tables that lack columns: they are named, and read as NULL."""
    production = dirty.bronze_production.drop("_ingested_at", "_source_file", "_batch_id")
    tables = {
        **dirty.dims,
        "fact_production": production.drop("scrap_qty", "line_id"),
        "fact_quality_event": dirty.bronze_events.drop("event_quantity"),
    }
    return checks.dataset_validation(tables, HORIZON, CONTRACTS)


@query
def stored_keys_by_month(dirty: DirtyStar) -> DataFrame:
    """How many distinct keys of a batch the key index holds, by the months and slices they fall in."""
    contract = CONTRACTS["fact_production"]
    index = index_entries(dirty.stored_production, contract.key, "production_date")
    typed = bronze.type_batch(dirty.raw_production, contract)
    profile = key_ops.key_profile(typed.filter("production_date < DATE'1996-01-01'"), contract.key)
    near = entries_near(index, profile, contract.key, "production_date")
    held = key_ops.held_keys(profile, contract.key, near)
    by_month = held.groupBy(F.date_format("production_date", "yyyy-MM").alias("month"))
    return by_month.agg(F.count("*").alias("n_keys"), F.sum("rows").alias("n_rows"))


@query
def ranked_contribution(star: Star) -> DataFrame:
    """Dense rank of every supplier and component pair by attributed defects."""
    inside = gold.attributed_lots(star.events, star.production).filter(YEAR.holds("event_date"))
    return ranking.ranked_contribution(inside, ("supplier_id", "component_id"), "defective_units")


@query
def leading_line_defects(star: Star) -> DataFrame:
    """The first three ranks of factory, line and defect by failures."""
    by = ("factory_id", "line_id", "defect_id")
    first_pass = star.events.filter("is_first_pass_failure").filter(YEAR.holds("event_date"))
    return ranking.leading_contributors(first_pass, by, "event_quantity")


@query
def localized_rank(star: Star) -> DataFrame:
    """Rank of one factory, product, component, supplier and defect combination."""
    entity = {"factory_id": "FAC-3", "product_id": "PROD-1", "component_id": "COMP-2",
              "supplier_id": "SUP-3", "defect_id": "DEF-3"}
    first_pass = star.events.filter("is_first_pass_failure")
    return ranking.rank_of(first_pass, tuple(entity), "event_quantity", entity)


SPEC = checks.Acceptance(
    supplier_window=YEAR,
    supplier_entity={"supplier_id": "SUP-3", "component_id": "COMP-1"},
    line_window=QUARTER,
    line_entity={"factory_id": "FAC-2", "line_id": "LINE-7", "defect_id": "DEF-4"},
    ramp_scope={"factory_id": "FAC-4", "line_id": "LINE-9"},
    ramp_early=EARLIER,
    ramp_late=YEAR,
    local_window=QUARTER,
    local_entity={
        "factory_id": "FAC-3",
        "product_id": "PROD-1",
        "component_id": "COMP-2",
        "supplier_id": "SUP-3",
        "defect_id": "DEF-3",
    },
    mix_scope=FACTORY,
    mix_before=EARLIER,
    mix_after=YEAR,
    falling_product="PROD-1",
    rising_product="PROD-2",
)


@query
def acceptance_report(star: Star) -> DataFrame:
    names = [("gold", name) for name in gold.GOLD_TABLES]
    inventory = star.spark.createDataFrame(names, "table_schema string, table_name string")
    return checks.acceptance_report(gold.gold_models(star.silver), inventory, SPEC)


def _table_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """The tables of the catalog after a folder has been entered in it, whatever it holds."""
    lake = Lake(spark, f"millsight_{zlib.crc32(folder.encode()):08x}_")
    register_landing(spark, folder, f"{lake.prefix}landing")
    return lake.inventory(("landing",))


QUERIES["table_inventory"] = _table_inventory


# --- whole runs: tables of a lake of the call's own, given up once their rows are read ------------


def _in_own_lake(spark: SparkSession, build: Callable[[Lake], DataFrame]) -> DataFrame:
    """What ``build`` finds in a fresh lake; the result is written, then the lake is dropped."""
    lake = Lake(spark, f"run_{uuid4().hex[:12]}_")
    lake.bootstrap()
    try:
        return written(build(lake), "runs")
    finally:
        for layer in LAYERS:
            spark.sql(f"DROP DATABASE IF EXISTS {lake.prefix}{layer} CASCADE")


@query
def ingestion_run(dirty: DirtyStar) -> DataFrame:
    """Two batches and a repeated run from files to Bronze and quarantine: rows by batch and outcome.

    The second batch sends some lots of the first one again; the third run finds no new file.
    """
    landing = f"{work_folder(dirty.spark)}/landing/{uuid4().hex}"
    parents = ("dim_factory", "dim_line", "dim_product")
    for name in parents:
        dirty.dims[name].write.parquet(f"{landing}/one/{name}.parquet")
    raw, part = dirty.raw_production, F.substring("_source_file", 25, 1)
    again = raw.filter((part == "0") & F.col("production_lot_id").endswith("7"))
    batches = {"one": raw.filter(part.isin("0", "2")), "two": raw.filter(part.isin("1", "3")).unionByName(again)}
    for batch, rows in batches.items():
        rows.drop("_source_file").write.parquet(f"{landing}/{batch}/fact_production.parquet")

    def run(lake: Lake) -> DataFrame:
        for name in (*parents, "fact_production"):
            bronze.Ingestion(lake, f"{landing}/one", "one", HORIZON).ingest(name)
        for batch in ("two", "three"):
            bronze.Ingestion(lake, f"{landing}/two", batch, HORIZON).ingest("fact_production")
        found = dirty.spark.table(lake.quarantine).select("_batch_id", "table_name", F.col("_error_code").alias("outcome"))
        for name in (*parents, "fact_production"):
            rows = lake.table("bronze", name).select("_batch_id", F.lit(name).alias("table_name"))
            found = found.unionByName(rows.withColumn("outcome", F.lit("accepted")))
        return found.groupBy(F.col("_batch_id").alias("batch_id"), "table_name", "outcome").agg(F.count("*").alias("n_rows"))

    return _in_own_lake(dirty.spark, run)


@query
def published_window(star: Star) -> DataFrame:
    """A quarter of a table that was published twice, read by the months it touches."""

    def run(lake: Lake) -> DataFrame:
        daily, name = gold.daily_rollup(star.production), lake.name("gold", "daily")
        lake.publish(daily.filter("production_quantity > 40"), name, "production_date")
        lake.publish(daily, name, "production_date")
        return lake.window("gold", "daily", "production_date", QUARTER)

    return _in_own_lake(star.spark, run)


# --- evidence --------------------------------------------------------------------------------


@query
def incident_supplier_component(star: Star) -> DataFrame:
    return evidence.supplier_component_defects(_supplier_gold(star), YEAR)


@query
def incident_line_defect(star: Star) -> DataFrame:
    return evidence.line_defects(_pareto_gold(star), QUARTER)


@query
def incident_line_trend(star: Star) -> DataFrame:
    return evidence.line_trend(gold.daily_rollup(star.production), YEAR, FACTORY)


@query
def incident_component_lot(star: Star) -> DataFrame:
    return evidence.component_lots(star.events, QUARTER)


@query
def ordered_quarantine_profile(dirty: DirtyStar) -> DataFrame:
    """Quarantined events by error codes, the most frequent ones first."""
    rejected = bronze.quarantined_rows(_checked_events(dirty), CONTRACTS["fact_quality_event"])
    return evidence.in_report_order(checks.quarantine_profile(rejected), "quarantine_profile")


@query
def ordered_supplier_component(star: Star) -> DataFrame:
    found = evidence.supplier_component_defects(_supplier_gold(star), YEAR)
    return evidence.in_report_order(found, "supplier_component_defects")


@query
def ordered_line_defect(star: Star) -> DataFrame:
    return evidence.in_report_order(evidence.line_defects(_pareto_gold(star), QUARTER), "line_defects")


@query
def ordered_line_trend(star: Star) -> DataFrame:
    found = evidence.line_trend(gold.daily_rollup(star.production), YEAR, FACTORY)
    return evidence.in_report_order(found, "line_trend")


@query
def ordered_component_lot(star: Star) -> DataFrame:
    return evidence.in_report_order(evidence.component_lots(star.events, QUARTER), "component_lots")


@query
def ordered_mix_detail(star: Star) -> DataFrame:
    product = gold.product_quality(star.production, star.dims["dim_product"])
    return evidence.in_report_order(evidence.mix_detail(product, YEAR, FACTORY), "mix_detail")


@query
def mix_vs_within(star: Star) -> DataFrame:
    factory = gold.factory_quality(star.production, star.dims["dim_factory"])
    product = gold.product_quality(star.production, star.dims["dim_product"])
    periods = {"pre": EARLIER, "post": YEAR}
    result = evidence.mix_versus_within(factory, product, periods, FACTORY)
    rounded = F.round("mean_absolute_product_fpy_change", 12)
    return result.withColumn("mean_absolute_product_fpy_change", rounded)


@query
def mix_verdict(star: Star) -> DataFrame:
    return evidence.mix_verdict(mix_vs_within(star))


@query
def mix_detail(star: Star) -> DataFrame:
    product = gold.product_quality(star.production, star.dims["dim_product"])
    return evidence.mix_detail(product, YEAR, FACTORY)


@query
def learning_curve(star: Star) -> DataFrame:
    daily = gold.daily_rollup(star.production)
    return evidence.learning_curve(daily, EARLIER, YEAR, {"line_id": "LINE-9"})


@query
def monthly_fpy(star: Star) -> DataFrame:
    factory = gold.factory_quality(star.production, star.dims["dim_factory"])
    return evidence.monthly_fpy(factory, FACTORY, ("factory_id",))


@query
def within_product_stability(star: Star) -> DataFrame:
    product = gold.product_quality(star.production, star.dims["dim_product"])
    result = evidence.within_product_stability(product, EARLIER, YEAR, FACTORY)
    rounded = F.round("mean_abs_product_fpy_change", 12)
    return result.withColumn("mean_abs_product_fpy_change", rounded)


@query
def mix_shift(star: Star) -> DataFrame:
    product = gold.product_quality(star.production, star.dims["dim_product"])
    return evidence.mix_shift(product, EARLIER, YEAR, FACTORY)


@query
def window_lift(star: Star) -> DataFrame:
    return evidence.window_lift(star.events, QUARTER, BASELINE, ("supplier_id", "component_id"))


@query
def unattributed_share(star: Star) -> DataFrame:
    return evidence.unattributed_share(star.events, YEAR, ("line_id", "defect_id"))


@query
def lot_concentration(star: Star) -> DataFrame:
    return evidence.lot_concentration(star.events)


# --- view grain ------------------------------------------------------------------------------


@query
def view_grain_kpis(star: Star) -> DataFrame:
    daily = gold.daily_rollup(star.production)
    return bi.view_kpis(daily, (F.year("production_date").alias("year"), "factory_id"))


@query
def wow_view(star: Star) -> DataFrame:
    view = bi.wow_view(gold.manufacturing_daily(star.production), ("factory_id",))
    return view.withColumn("wow_fpy_change", F.round("wow_fpy_change", 12))


@query
def mix_share_month(star: Star) -> DataFrame:
    product = gold.product_quality(star.production, star.dims["dim_product"])
    return bi.mix_share(product, month_of("production_date"))


@query
def supplier_rate_view(star: Star) -> DataFrame:
    return bi.supplier_rate_view(_supplier_gold(star), ("supplier_id", "supplier_name"))


@query
def defect_contribution(star: Star) -> DataFrame:
    return bi.defect_contribution(_pareto_gold(star), ("factory_id",))


@query
def factory_benchmark(star: Star) -> DataFrame:
    daily = gold.daily_rollup(star.production)
    return bi.factory_benchmark(daily, ("factory_id", "line_id", "product_id"))


@query
def product_benchmark(star: Star) -> DataFrame:
    return bi.product_benchmark(gold.daily_rollup(star.production), ("product_id", "line_id"))


@query
def include_component(star: Star) -> DataFrame:
    return bi.include_detail(_pareto_gold(star), ("factory_id", "product_id"), "component_id")


@query
def exclude_defect_trend(star: Star) -> DataFrame:
    pareto = _pareto_gold(star).withColumn("month", month_of("event_date"))
    return bi.exclude_detail(pareto, ("month", "factory_id", "product_id"), "defect_id")


@query
def drill_factory_product_line(star: Star) -> DataFrame:
    daily = gold.daily_rollup(star.production)
    return bi.drill(daily, "line_id", {"factory_id": "FAC-2", "product_id": "PROD-1"})


@query
def drill_component_supplier(star: Star) -> DataFrame:
    scope = {"factory_id": "FAC-2", "component_id": "COMP-1"}
    rates = ("supplier_attributed_defect_rate", "supplier_attributed_dppm")
    return bi.drill(_supplier_gold(star), "supplier_id", scope, rates)


@query
def weekly_trend(star: Star) -> DataFrame:
    return bi.weekly_trend(gold.manufacturing_daily(star.production))


@query
def entity_comparison(star: Star) -> DataFrame:
    return bi.entity_comparison(gold.daily_rollup(star.production), "product_id")


@query
def rolling_fpy(star: Star) -> DataFrame:
    return bi.rolling_fpy(gold.daily_rollup(star.production), ("factory_id",))


@query
def benchmark_rank(star: Star) -> DataFrame:
    daily = gold.daily_rollup(star.production).withColumn("month", month_of("production_date"))
    rated = metrics_at(daily, ("month", "line_id"), ("fpy",)).select("month", "line_id", "fpy")
    return ranking.benchmark_rank(rated, ("month",), "fpy", "fpy_rank")


@query
def contribution_to_change(star: Star) -> DataFrame:
    factory = gold.factory_quality(star.production, star.dims["dim_factory"])
    return bi.fpy_change_decomposition(factory, EARLIER, YEAR, "factory_id")
