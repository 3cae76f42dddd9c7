"""The driver tables read as a manufacturing star schema.

One line item is one production lot. Facts are plain projections of ``lineitem`` (no join, no
shuffle), so filters and column pruning reach the Parquet scan; events are the one or two failure
parts of a lot. Dimensions come from the smaller tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession


FACTORY = "concat('FAC-', supp % 5)"
LINE = "concat('LINE-', supp % 25)"
PRODUCT = "concat('PROD-', part % 6)"
STAGE = "element_at(array('incoming', 'in_process', 'final', 'test'), CAST(n % 4 + 1 AS INT))"


class Lazy(Mapping):
    """Frames by name, each built when first asked for."""

    def __init__(self, names: tuple[str, ...], build: Callable[[str], DataFrame]) -> None:
        self._names, self._build, self._built = names, build, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


# Dimension -> (source table, columns); ``c`` numbers the residue classes of a part column.
DIMS = {
    "dim_date": ("lineitem", ()),
    "dim_factory": (
        "region",
        (
            "concat('FAC-', r_regionkey) AS factory_id",
            "concat('FC', r_regionkey) AS factory_code",
            "r_name AS factory_name",
            "concat('Country ', r_regionkey) AS country",
            "0.9D + r_regionkey / 100 AS baseline_fpy",
        ),
    ),
    "dim_line": (
        "nation",
        (
            "concat('LINE-', n_nationkey) AS line_id",
            "concat('L', n_nationkey) AS line_code",
            "n_name AS line_name",
            "concat('FAC-', n_regionkey) AS factory_id",
            "n_nationkey % 5 = 4 AS is_ramp_line",
        ),
    ),
    "dim_product": (
        "p_partkey % 6",
        (
            "concat('PROD-', c) AS product_id",
            "concat('P', c) AS product_code",
            "concat('Product ', c) AS product_name",
            "concat('Family ', c % 3) AS product_family",
            "c / 100 AS complexity_risk",
        ),
    ),
    "dim_component": (
        "p_partkey % 12",
        (
            "concat('COMP-', c) AS component_id",
            "concat('C', c) AS component_code",
            "concat('Component ', c) AS component_name",
            "concat('Family ', c % 3) AS component_family",
        ),
    ),
    "dim_supplier": (
        "supplier",
        (
            "concat('SUP-', s_suppkey) AS supplier_id",
            "concat('S', s_suppkey) AS supplier_code",
            "s_name AS supplier_name",
            "concat('Region ', s_nationkey % 5) AS supplier_region",
        ),
    ),
    "dim_defect": (
        "p_size % 6",
        (
            "concat('DEF-', c) AS defect_id",
            "concat('D', c) AS defect_code",
            "concat('Defect ', c) AS defect_name",
            "concat('Category ', c % 2) AS defect_category",
            "element_at(array('Low', 'Medium', 'High'), CAST(c % 3 + 1 AS INT)) AS severity",
        ),
    ),
}


@dataclass(frozen=True)
class Star:
    """Clean star schema over one scale-factor folder; also the conformed (Silver) input of Gold."""

    spark: SparkSession
    folder: str

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    def line_items(self) -> DataFrame:
        return self.read("lineitem")

    @cached_property
    def lots(self) -> DataFrame:
        """Line items with the quantities every fact is derived from."""
        items = self.line_items().selectExpr(
            "l_orderkey AS k",
            "l_linenumber AS n",
            "l_partkey AS part",
            "l_suppkey AS supp",
            "l_returnflag = 'R' AS returned",
            "l_returnflag = 'A' AND l_linestatus = 'F' AS scrapped",
            "CAST(l_shipdate AS DATE) AS day",
            "CAST(l_quantity AS BIGINT) AS q",
            "CAST(l_quantity AS BIGINT) * CAST(round(l_discount * 100) AS BIGINT) div 100 AS fail",
        )
        return items.selectExpr(
            "*",
            "concat_ws('-', 'PLOT', k, n, part, supp, q) AS production_lot_id",
            "fail div 2 AS half",
            "q - CASE WHEN n = 7 THEN 1 ELSE 0 END AS made",
            "CASE WHEN returned THEN fail ELSE fail div 2 END AS rework",
            "CASE WHEN scrapped THEN fail - fail div 2 ELSE 0 END AS scrap",
            "CASE WHEN returned THEN 'rework' WHEN scrapped THEN 'scrap' ELSE 'fail' END AS fate",
        )

    @cached_property
    def keyed_production(self) -> DataFrame:
        return self.lots.selectExpr(
            "k",
            "production_lot_id",
            "day AS production_date",
            f"{FACTORY} AS factory_id",
            f"{LINE} AS line_id",
            f"{PRODUCT} AS product_id",
            "q AS production_qty",
            "q - fail AS pass_qty",
            "q AS started_qty",
            "CAST(made AS BIGINT) AS completed_qty",
            "q - fail AS first_pass_pass_qty",
            "fail AS fail_qty",
            "CAST(rework AS BIGINT) AS rework_qty",
            "CAST(scrap AS BIGINT) AS scrap_qty",
        )

    @cached_property
    def production(self) -> DataFrame:
        return self.keyed_production.drop("k")

    @cached_property
    def event_parts(self) -> DataFrame:
        """The failure parts of each lot: ``s`` is 1 or 2 and ``part_qty`` is positive."""
        parts = self.lots.selectExpr("*", "posexplode(array(fail - half, half)) AS (at, part_qty)")
        return parts.filter("part_qty > 0").selectExpr("*", "at + 1 AS s")

    @cached_property
    def keyed_events(self) -> DataFrame:
        return self.event_parts.selectExpr(
            "k",
            "concat_ws('-', production_lot_id, s) AS quality_event_id",
            "day AS event_date",
            "CAST(day AS TIMESTAMP) + INTERVAL 12 HOURS AS event_timestamp",
            "production_lot_id",
            f"{FACTORY} AS factory_id",
            f"{LINE} AS line_id",
            f"{PRODUCT} AS product_id",
            "concat('COMP-', (part + s) % 12) AS component_id",
            "CASE WHEN (supp + s) % 10 <> 0 THEN concat('SUP-', supp) END AS supplier_id",
            "concat('CLOT-', part % 50) AS component_lot_id",
            "concat('DEF-', (n + s) % 6) AS defect_id",
            f"{STAGE} AS inspection_stage",
            "CAST(part_qty AS BIGINT) AS event_quantity",
            "n % 5 <> 0 AS is_first_pass_failure",
            "fate = 'rework' AS is_rework",
            "fate = 'scrap' AS is_scrap",
            "fate AS disposition",
        )

    @cached_property
    def events(self) -> DataFrame:
        """Conformed events, with the supplier-attribution flag."""
        attributed = "supplier_id IS NOT NULL AS is_supplier_attributed"
        return self.keyed_events.drop("k").selectExpr("*", attributed)

    @cached_property
    def dims(self) -> Mapping[str, DataFrame]:
        return Lazy(tuple(DIMS), self._dim)

    def _dim(self, name: str) -> DataFrame:
        source, columns = DIMS[name]
        if name == "dim_date":
            return self._dates()
        if source.startswith("p_"):
            return self.read("part").selectExpr(f"{source} AS c").distinct().selectExpr(*columns)
        return self.read(source).selectExpr(*columns)

    def _dates(self) -> DataFrame:
        days = self.read("lineitem").selectExpr("CAST(l_shipdate AS DATE) AS date").distinct()
        return days.selectExpr(
            "CAST(date_format(date, 'yyyyMMdd') AS INT) AS date_id",
            "date",
            "year(date) AS year",
            "quarter(date) AS quarter",
            "month(date) AS month",
            "weekofyear(date) AS week_of_year",
            "weekday(date) + 1 AS day_of_week",
            "weekday(date) >= 5 AS is_weekend",
        )

    @cached_property
    def silver(self) -> dict[str, DataFrame]:
        return {**self.dims, "fact_production": self.production, "fact_quality_event": self.events}


def replace(frame: DataFrame, changes: Mapping[str, str]) -> DataFrame:
    """The frame with some columns computed anew, in place."""
    return frame.selectExpr(*[f"{changes[c]} AS {c}" if c in changes else c for c in frame.columns])


@dataclass(frozen=True)
class DirtyStar(Star):
    """Deliberately broken copies of the star schema.

    ``raw_*`` are source files as text with every kind of contract violation; ``bronze_*`` are
    accepted rows of several batches with re-sent records, padded text and unresolved relations.
    """

    @cached_property
    def raw_production(self) -> DataFrame:
        base = self.lots.selectExpr(
            "production_lot_id",
            "CAST(day AS STRING) AS production_date",
            f"CASE WHEN k % 79 = 0 THEN 'FAC-404' ELSE {FACTORY} END AS factory_id",
            f"{LINE} AS line_id",
            f"CASE WHEN k % 83 <> 0 THEN {PRODUCT} END AS product_id",
            "CASE WHEN k % 89 = 0 THEN 'abc' ELSE CAST(q AS STRING) END AS production_qty",
            "CAST(q - fail + CASE WHEN k % 67 = 0 THEN 1 ELSE 0 END AS STRING) AS pass_qty",
            "CASE WHEN k % 97 = 0 THEN '-5' ELSE CAST(q AS STRING) END AS started_qty",
            "CAST(made AS STRING) AS completed_qty",
            "CAST(q - fail AS STRING) AS first_pass_pass_qty",
            "CAST(fail AS STRING) AS fail_qty",
            "CAST(CASE WHEN k % 61 = 0 THEN fail + 1 ELSE rework END AS STRING) AS rework_qty",
            "CAST(scrap AS STRING) AS scrap_qty",
            "concat('note ', k % 3) AS operator_note",
            "concat('landing/fact_production_', k % 4, '.parquet') AS _source_file",
            "explode(sequence(1, CASE WHEN k % 73 = 0 THEN 2 ELSE 1 END)) AS _copy",
        )
        return base.drop("_copy")

    @cached_property
    def raw_events(self) -> DataFrame:
        late = "date_add(day, CASE WHEN k % 43 = 0 THEN 1 ELSE 0 END)"
        return self.event_parts.selectExpr(
            "concat_ws('-', production_lot_id, s) AS quality_event_id",
            "CAST(day AS STRING) AS event_date",
            f"concat({late}, 'T12:00:00') AS event_timestamp",
            "CASE WHEN k % 47 = 0 THEN 'PLOT-0' ELSE production_lot_id END AS production_lot_id",
            f"{FACTORY} AS factory_id",
            f"{LINE} AS line_id",
            f"{PRODUCT} AS product_id",
            "concat('COMP-', (part + s) % 12) AS component_id",
            "CASE WHEN (supp + s) % 10 = 0 THEN NULL WHEN k % 53 = 0 THEN 'SUP-404'"
            " ELSE concat('SUP-', supp) END AS supplier_id",
            "concat('CLOT-', part % 50) AS component_lot_id",
            "concat('DEF-', (n + s) % 6) AS defect_id",
            f"CASE WHEN k % 31 = 0 THEN upper({STAGE}) ELSE {STAGE} END AS inspection_stage",
            "CASE WHEN k % 41 = 0 THEN '0' ELSE CAST(part_qty AS STRING) END AS event_quantity",
            "CAST(n % 5 <> 0 AS STRING) AS is_first_pass_failure",
            "CASE WHEN k % 29 = 0 THEN 'maybe' ELSE CAST(fate = 'rework' AS STRING) END AS is_rework",
            "CAST(fate = 'scrap' AS STRING) AS is_scrap",
            "CASE WHEN k % 37 = 0 THEN 'pass' ELSE fate END AS disposition",
            "concat('landing/fact_quality_event_', k % 4, '.parquet') AS _source_file",
        )

    @cached_property
    def stored_production(self) -> DataFrame:
        """Accepted lots of an earlier batch."""
        return self.keyed_production.filter("k % 59 = 0").drop("k")

    @cached_property
    def parent_production(self) -> DataFrame:
        """Accepted lots that events may refer to; some parents were rejected."""
        return self.keyed_production.filter("k % 11 <> 0").drop("k")

    @cached_property
    def audit(self) -> DataFrame:
        """Audit entries of earlier runs, derived from the landed files."""
        files = self.raw_production.groupBy("_source_file").count()
        files = files.selectExpr(
            "_source_file AS source_file",
            "count AS source_rows",
            "CAST(substring(_source_file, 25, 1) AS INT) AS f",
        )
        return files.selectExpr(
            "CASE WHEN f = 2 THEN 'fact_quality_event' ELSE 'fact_production' END AS table_name",
            "source_file",
            "concat('batch-', f) AS batch_id",
            "source_rows",
            "source_rows - f AS valid_rows",
            "CAST(f AS BIGINT) AS quarantined_rows",
            "CASE WHEN f = 1 THEN 'FAILED' ELSE 'SUCCESS' END AS status",
            "explode(sequence(1, CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS _entry",
        ).drop("_entry")

    def _versions(self, frame: DataFrame, again: str, changes: Mapping[str, str]) -> DataFrame:
        """Each row as first sent, and once more, later and changed, where ``again`` holds."""
        sent = frame.selectExpr(
            "*", f"explode(sequence(1, CASE WHEN {again} THEN 2 ELSE 1 END)) AS _version"
        )
        later = {c: f"CASE WHEN _version = 2 THEN {text} ELSE {c} END" for c, text in changes.items()}
        return (
            replace(sent, later)
            .selectExpr(
                "*",
                "make_timestamp(2026, _version, 1, 0, 0, 0) AS _ingested_at",
                "concat('file-', _version) AS _source_file",
                "concat('batch-', _version) AS _batch_id",
            )
            .drop("_version")
        )

    @cached_property
    def bronze_dims(self) -> Mapping[str, DataFrame]:
        """Dimension rows with re-sent, renamed versions and untidy text."""
        return Lazy(tuple(DIMS), self._bronze_dim)

    def _bronze_dim(self, table: str) -> DataFrame:
        if table == "dim_date":
            return self._versions(
                self.dims[table], "date_id % 3 = 0", {"is_weekend": "NOT is_weekend"}
            )
        stem = table.removeprefix("dim_")
        number = f"CAST(substring_index({stem}_id, '-', -1) AS INT)"
        changes = {
            f"{stem}_name": f"concat(' ', {stem}_name, ' v2 ')",
            f"{stem}_code": f"lower({stem}_code)",
            f"{stem}_id": f"concat(' ', {stem}_id)",
        }
        if table == "dim_line":
            unknown = f"CASE WHEN {number} % 7 = 3 THEN 'FAC-404' ELSE factory_id END"
            changes["factory_id"] = unknown
        return self._versions(self.dims[table], f"{number} % 3 = 0", changes)

    @cached_property
    def bronze_production(self) -> DataFrame:
        """Lots with later corrections, unknown parents, broken totals and padded ids."""
        broken = {
            "factory_id": "CASE WHEN k % 79 = 0 THEN 'FAC-404' ELSE factory_id END",
            "pass_qty": "pass_qty + CASE WHEN k % 67 = 0 THEN 1 ELSE 0 END",
            "product_id": "CASE WHEN k % 53 = 0 THEN concat(' ', product_id) ELSE product_id END",
            "line_id": "CASE WHEN k % 71 = 0 THEN concat('LINE-', (k + 1) % 25) ELSE line_id END",
        }
        later = {
            "completed_qty": "greatest(completed_qty - 1, 0)",
            "scrap_qty": "CASE WHEN k % 118 = 0 THEN fail_qty + 1 ELSE scrap_qty END",
        }
        rows = replace(self.keyed_production, broken)
        return self._versions(rows, "k % 59 = 0", later).drop("k")

    @cached_property
    def bronze_events(self) -> DataFrame:
        """Events with later corrections, orphans, upper-case enumerations and zero quantities."""
        broken = {
            "production_lot_id": "CASE WHEN k % 47 = 0 THEN 'PLOT-0' ELSE production_lot_id END",
            "event_quantity": "CASE WHEN k % 41 = 0 THEN 0 ELSE event_quantity END",
            "inspection_stage": "CASE WHEN k % 31 = 0 THEN upper(inspection_stage)"
            " ELSE inspection_stage END",
            "disposition": "CASE WHEN k % 37 = 0 THEN 'pass' ELSE disposition END",
            "supplier_id": "CASE WHEN k % 43 = 0 AND supplier_id IS NOT NULL THEN 'SUP-404'"
            " ELSE supplier_id END",
        }
        rows = replace(self.keyed_events, broken)
        changes = {"event_quantity": "event_quantity + 1"}
        return self._versions(rows, "k % 61 = 0", changes).drop("k")
