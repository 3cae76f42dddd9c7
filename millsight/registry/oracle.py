"""DuckDB SQL for every registered query, written independently of the DataFrame code.

A query text names the common table expressions it needs; :func:`_with` puts the definitions, and
those they need in turn, in front of it.
"""

from __future__ import annotations

import re

HORIZON = "BETWEEN DATE '1995-06-01' AND DATE '2001-06-30'"
YEAR = "BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'"
EARLIER = "BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'"
QUARTER = "BETWEEN DATE '1998-01-01' AND DATE '1998-03-31'"
BASELINE = "BETWEEN DATE '1997-10-03' AND DATE '1997-12-31'"

QUANTITIES = [
    "production_qty", "pass_qty", "started_qty", "completed_qty", "first_pass_pass_qty", "fail_qty",
    "rework_qty", "scrap_qty",
]
PRODUCTION = ["production_lot_id", "production_date", "factory_id", "line_id", "product_id", *QUANTITIES]
GRAIN = "production_date, factory_id, line_id, product_id, production_lot_id"
EVENT = [
    "quality_event_id", "event_date", "event_timestamp", "production_lot_id", "factory_id", "line_id",
    "product_id", "component_id", "supplier_id", "component_lot_id", "defect_id", "inspection_stage",
    "event_quantity", "is_first_pass_failure", "is_rework", "is_scrap", "disposition",
]
TYPES = {
    **{q: "BIGINT" for q in QUANTITIES},
    "event_quantity": "BIGINT",
    "production_date": "DATE",
    "event_date": "DATE",
    "event_timestamp": "TIMESTAMP",
    "is_first_pass_failure": "BOOLEAN",
    "is_rework": "BOOLEAN",
    "is_scrap": "BOOLEAN",
}
DIM_COLUMNS = {
    "dim_date": "date_id date year quarter month week_of_year day_of_week is_weekend",
    "dim_factory": "factory_id factory_code factory_name country baseline_fpy",
    "dim_line": "line_id line_code line_name factory_id is_ramp_line",
    "dim_product": "product_id product_code product_name product_family complexity_risk",
    "dim_component": "component_id component_code component_name component_family",
    "dim_supplier": "supplier_id supplier_code supplier_name supplier_region",
    "dim_defect": "defect_id defect_code defect_name defect_category severity",
}


def big(expression: str, name: str) -> str:
    return f"CAST(SUM({expression}) AS BIGINT) AS {name}"


def div(top: str, bottom: str) -> str:
    return f"CAST({top} AS DOUBLE) / NULLIF(CAST({bottom} AS DOUBLE), 0)"


FPY = div("pass_quantity", "pass_quantity + fail_quantity")
RATES = {
    "fpy": FPY,
    "defect_rate": div("fail_quantity", "production_quantity"),
    "dppm": "CAST(fail_quantity AS DOUBLE) * CAST(1000000 AS DOUBLE)"
    " / NULLIF(CAST(production_quantity AS DOUBLE), 0)",
    "rework_rate": div("rework_quantity", "production_quantity"),
    "scrap_rate": div("scrap_quantity", "production_quantity"),
    "yield_loss": f"CAST(1 AS DOUBLE) - {FPY}",
}
SUPPLIER_RATES = {
    "supplier_attributed_defect_rate": div("defective_units", "inspected_units"),
    "supplier_attributed_dppm": "CAST(defective_units AS DOUBLE) * CAST(1000000 AS DOUBLE)"
    " / NULLIF(CAST(inspected_units AS DOUBLE), 0)",
}
GOLD_SUMS = ["production_quantity", "pass_quantity", "fail_quantity", "rework_quantity", "scrap_quantity"]


def rates(*names: str) -> str:
    return ", ".join(f"{RATES[name]} AS {name}" for name in names or RATES)


def supplier_rates() -> str:
    return ", ".join(f"{text} AS {name}" for name, text in SUPPLIER_RATES.items())


def sums(names: list[str]) -> str:
    return ", ".join(big(name, name) for name in names)


def cast_all(columns: list[str]) -> str:
    return ", ".join(
        f"TRY_CAST({c} AS {TYPES[c]}) AS {c}" if c in TYPES else c for c in columns
    )


STAGE = "CASE n % 4 WHEN 0 THEN 'incoming' WHEN 1 THEN 'in_process' WHEN 2 THEN 'final' ELSE 'test' END"
CTES: dict[str, str] = {
    "base": """SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS part, l_suppkey AS supp,
        l_returnflag AS flag, l_linestatus AS line_status, CAST(l_shipdate AS DATE) AS "day",
        CAST(floor(l_quantity) AS BIGINT) AS q, CAST(round(l_discount * 100) AS BIGINT) AS pct
        FROM lineitem""",
    "failed": """SELECT *, concat_ws('-', 'PLOT', k, n, part, supp, q) AS production_lot_id,
        (q * pct) // 100 AS fail FROM base""",
    "lots": """SELECT *, fail // 2 AS half, q - CASE WHEN n = 7 THEN 1 ELSE 0 END AS made,
        CASE WHEN flag = 'R' THEN fail ELSE fail // 2 END AS rework,
        CASE WHEN flag = 'A' AND line_status = 'F' THEN fail - fail // 2 ELSE 0 END AS scrap,
        CASE WHEN flag = 'R' THEN 'rework' WHEN flag = 'A' AND line_status = 'F' THEN 'scrap'
             ELSE 'fail' END AS fate FROM failed""",
    "keyed_production": """SELECT k, production_lot_id, "day" AS production_date,
        'FAC-' || (supp % 5) AS factory_id, 'LINE-' || (supp % 25) AS line_id,
        'PROD-' || (part % 6) AS product_id, q AS production_qty, q - fail AS pass_qty,
        q AS started_qty, CAST(made AS BIGINT) AS completed_qty, q - fail AS first_pass_pass_qty,
        fail AS fail_qty, CAST(rework AS BIGINT) AS rework_qty, CAST(scrap AS BIGINT) AS scrap_qty
        FROM lots""",
    "production": "SELECT * EXCLUDE (k) FROM keyed_production",
    "parts": """SELECT *, 1 AS s, fail - half AS part_qty FROM lots WHERE fail - half > 0
        UNION ALL SELECT *, 2 AS s, half AS part_qty FROM lots WHERE half > 0""",
    "keyed_events": f"""SELECT k, production_lot_id || '-' || s AS quality_event_id, "day" AS event_date,
        CAST("day" AS TIMESTAMP) + INTERVAL 12 HOUR AS event_timestamp, production_lot_id,
        'FAC-' || (supp % 5) AS factory_id, 'LINE-' || (supp % 25) AS line_id,
        'PROD-' || (part % 6) AS product_id, 'COMP-' || ((part + s) % 12) AS component_id,
        CASE WHEN (supp + s) % 10 <> 0 THEN 'SUP-' || supp END AS supplier_id,
        'CLOT-' || (part % 50) AS component_lot_id, 'DEF-' || ((n + s) % 6) AS defect_id,
        {STAGE} AS inspection_stage, CAST(part_qty AS BIGINT) AS event_quantity,
        n % 5 <> 0 AS is_first_pass_failure, fate = 'rework' AS is_rework,
        fate = 'scrap' AS is_scrap, fate AS disposition FROM parts""",
    "event_rows": """SELECT * EXCLUDE (k), supplier_id IS NOT NULL AS is_supplier_attributed
        FROM keyed_events""",
    "dim_date": """SELECT CAST(strftime("date", '%Y%m%d') AS INTEGER) AS date_id, "date",
        CAST(year("date") AS INTEGER) AS year, CAST(quarter("date") AS INTEGER) AS quarter,
        CAST(month("date") AS INTEGER) AS month, CAST(weekofyear("date") AS INTEGER) AS week_of_year,
        CAST(isodow("date") AS INTEGER) AS day_of_week, isodow("date") >= 6 AS is_weekend
        FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS "date" FROM lineitem)""",
    "dim_factory": """SELECT 'FAC-' || r_regionkey AS factory_id, 'FC' || r_regionkey AS factory_code,
        r_name AS factory_name, 'Country ' || r_regionkey AS country,
        CAST(0.9 AS DOUBLE) + r_regionkey / 100 AS baseline_fpy FROM region""",
    "dim_line": """SELECT 'LINE-' || n_nationkey AS line_id, 'L' || n_nationkey AS line_code,
        n_name AS line_name, 'FAC-' || n_regionkey AS factory_id, n_nationkey % 5 = 4 AS is_ramp_line
        FROM nation""",
    "dim_product": """SELECT 'PROD-' || c AS product_id, 'P' || c AS product_code,
        'Product ' || c AS product_name, 'Family ' || (c % 3) AS product_family,
        c / 100 AS complexity_risk FROM (SELECT DISTINCT p_partkey % 6 AS c FROM part)""",
    "dim_component": """SELECT 'COMP-' || c AS component_id, 'C' || c AS component_code,
        'Component ' || c AS component_name, 'Family ' || (c % 3) AS component_family
        FROM (SELECT DISTINCT p_partkey % 12 AS c FROM part)""",
    "dim_supplier": """SELECT 'SUP-' || s_suppkey AS supplier_id, 'S' || s_suppkey AS supplier_code,
        s_name AS supplier_name, 'Region ' || (s_nationkey % 5) AS supplier_region FROM supplier""",
    "dim_defect": """SELECT 'DEF-' || c AS defect_id, 'D' || c AS defect_code,
        'Defect ' || c AS defect_name, 'Category ' || (c % 2) AS defect_category,
        CASE c % 3 WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' ELSE 'High' END AS severity
        FROM (SELECT DISTINCT p_size % 6 AS c FROM part)""",
    # --- landed text files
    "raw_once": """SELECT k, production_lot_id, CAST("day" AS VARCHAR) AS production_date,
        CASE WHEN k % 79 = 0 THEN 'FAC-404' ELSE 'FAC-' || (supp % 5) END AS factory_id,
        'LINE-' || (supp % 25) AS line_id,
        CASE WHEN k % 83 <> 0 THEN 'PROD-' || (part % 6) END AS product_id,
        CASE WHEN k % 89 = 0 THEN 'abc' ELSE CAST(q AS VARCHAR) END AS production_qty,
        CAST(q - fail + CASE WHEN k % 67 = 0 THEN 1 ELSE 0 END AS VARCHAR) AS pass_qty,
        CASE WHEN k % 97 = 0 THEN '-5' ELSE CAST(q AS VARCHAR) END AS started_qty,
        CAST(made AS VARCHAR) AS completed_qty, CAST(q - fail AS VARCHAR) AS first_pass_pass_qty,
        CAST(fail AS VARCHAR) AS fail_qty,
        CAST(CASE WHEN k % 61 = 0 THEN fail + 1 ELSE rework END AS VARCHAR) AS rework_qty,
        CAST(scrap AS VARCHAR) AS scrap_qty, 'note ' || (k % 3) AS operator_note,
        'landing/fact_production_' || (k % 4) || '.parquet' AS _source_file FROM lots""",
    "raw_production": """SELECT * EXCLUDE (k) FROM raw_once
        UNION ALL SELECT * EXCLUDE (k) FROM raw_once WHERE k % 73 = 0""",
    "raw_events": f"""SELECT production_lot_id || '-' || s AS quality_event_id,
        CAST("day" AS VARCHAR) AS event_date,
        CAST("day" + CASE WHEN k % 43 = 0 THEN 1 ELSE 0 END AS VARCHAR) || 'T12:00:00' AS event_timestamp,
        CASE WHEN k % 47 = 0 THEN 'PLOT-0' ELSE production_lot_id END AS production_lot_id,
        'FAC-' || (supp % 5) AS factory_id, 'LINE-' || (supp % 25) AS line_id,
        'PROD-' || (part % 6) AS product_id, 'COMP-' || ((part + s) % 12) AS component_id,
        CASE WHEN (supp + s) % 10 = 0 THEN NULL WHEN k % 53 = 0 THEN 'SUP-404'
             ELSE 'SUP-' || supp END AS supplier_id,
        'CLOT-' || (part % 50) AS component_lot_id, 'DEF-' || ((n + s) % 6) AS defect_id,
        CASE WHEN k % 31 = 0 THEN upper({STAGE}) ELSE {STAGE} END AS inspection_stage,
        CASE WHEN k % 41 = 0 THEN '0' ELSE CAST(part_qty AS VARCHAR) END AS event_quantity,
        CASE WHEN n % 5 <> 0 THEN 'true' ELSE 'false' END AS is_first_pass_failure,
        CASE WHEN k % 29 = 0 THEN 'maybe' WHEN fate = 'rework' THEN 'true' ELSE 'false' END AS is_rework,
        CASE WHEN fate = 'scrap' THEN 'true' ELSE 'false' END AS is_scrap,
        CASE WHEN k % 37 = 0 THEN 'pass' ELSE fate END AS disposition,
        'landing/fact_quality_event_' || (k % 4) || '.parquet' AS _source_file FROM parts""",
    "stored_production": "SELECT * EXCLUDE (k) FROM keyed_production WHERE k % 59 = 0",
    "parent_production": "SELECT * EXCLUDE (k) FROM keyed_production WHERE k % 11 <> 0",
    "files": """SELECT _source_file AS source_file, COUNT(*) AS source_rows,
        CAST(regexp_extract(_source_file, '_([0-9])\\.parquet', 1) AS INTEGER) AS f
        FROM raw_production GROUP BY _source_file""",
    "audit_once": """SELECT f, CASE WHEN f = 2 THEN 'fact_quality_event' ELSE 'fact_production' END
        AS table_name, source_file, 'batch-' || f AS batch_id, source_rows,
        source_rows - f AS valid_rows, CAST(f AS BIGINT) AS quarantined_rows,
        CASE WHEN f = 1 THEN 'FAILED' ELSE 'SUCCESS' END AS status FROM files""",
    "audit": """SELECT * EXCLUDE (f) FROM audit_once
        UNION ALL SELECT * EXCLUDE (f) FROM audit_once WHERE f = 3""",
}


def case(condition: str, text: str) -> str:
    return f"CASE WHEN {condition} THEN '{text}' END"


PRODUCTION_RULES = [
    (f"production_date {HORIZON}", "DATE_OUT_OF_RANGE", "production_date is outside the synthetic horizon"),
    (
        " AND ".join(f"{q} >= 0" for q in QUANTITIES),
        "NEGATIVE_QUANTITY",
        "production quantities must be non-negative",
    ),
    (
        "pass_qty + fail_qty = production_qty",
        "INVALID_PRODUCTION_TOTAL",
        "pass_qty plus fail_qty must equal production_qty",
    ),
    ("completed_qty <= started_qty", "COMPLETED_EXCEEDS_STARTED", "completed_qty must not exceed started_qty"),
    (
        "first_pass_pass_qty + fail_qty <= started_qty",
        "FIRST_PASS_EXCEEDS_STARTED",
        "first-pass quantities must not exceed started_qty",
    ),
    ("rework_qty <= fail_qty", "REWORK_EXCEEDS_FAILURES", "rework_qty must not exceed fail_qty"),
    ("scrap_qty <= fail_qty", "SCRAP_EXCEEDS_FAILURES", "scrap_qty must not exceed fail_qty"),
]
EVENT_RULES = [
    (f"event_date {HORIZON}", "DATE_OUT_OF_RANGE", "event_date is outside the synthetic horizon"),
    (
        "CAST(event_timestamp AS DATE) = event_date",
        "TIMESTAMP_DATE_MISMATCH",
        "event timestamp must fall on event_date",
    ),
    ("event_quantity > 0", "INVALID_EVENT_QUANTITY", "event_quantity must be positive"),
    (
        "inspection_stage IN ('incoming', 'in_process', 'final', 'test')",
        "INVALID_INSPECTION_STAGE",
        "inspection_stage is not governed",
    ),
    ("disposition IN ('fail', 'rework', 'scrap')", "INVALID_DISPOSITION", "disposition is not governed"),
]


def null_issues(columns: list[str], optional: tuple[str, ...] = (), missing: tuple[str, ...] = ()) -> list:
    """(violated when, code, message) of required and type checks, in column order."""
    out = []
    for c in columns:
        if c not in optional:
            code = "MISSING_REQUIRED_COLUMN" if c in missing else "NULL_REQUIRED_VALUE"
            out.append((f"t.{c} IS NULL", code, f"required field {c} is null or unavailable"))
        if c in TYPES and c not in missing:
            message = f"{c} cannot be cast to {TYPES[c]}"
            out.append((f"raw_{c} IS NOT NULL AND t.{c} IS NULL", "INVALID_DATA_TYPE", message))
    return out


def rule_issues(rules: list) -> list:
    return [(f"({holds}) IS NOT TRUE", code, message) for holds, code, message in rules]


def texts(issues: list) -> str:
    codes = ", ".join(case(when, code) for when, code, _ in issues)
    messages = ", ".join(case(when, message) for when, _, message in issues)
    return f"concat_ws(',', {codes}) AS codes, concat_ws('; ', {messages}) AS messages"


def typed(source: str, columns: list[str], missing: tuple[str, ...] = ()) -> str:
    """Typed columns, raw copies of the casted ones and the source row as JSON."""
    kept = [c for c in columns if c not in missing]
    raws = ", ".join(f"{c} AS raw_{c}" for c in kept if c in TYPES)
    nulls = "".join(f", CAST(NULL AS {TYPES.get(c, 'VARCHAR')}) AS {c}" for c in missing)
    extra = ["operator_note"] if columns is PRODUCTION else []
    record = ", ".join(f"{c} := {c}" for c in [*kept, *extra, "_source_file"])
    return (
        f"SELECT {cast_all(kept)}, {raws}{nulls}, _source_file, "
        f"CAST(to_json(struct_pack({record})) AS VARCHAR) AS record FROM {source}"
    )


def known(column: str, parent: str, parent_column: str = "") -> str:
    return f"t.{column} IN (SELECT {parent_column or column} FROM {parent})"


def foreign(children: list[tuple[str, str]]) -> list:
    out = []
    for column, parent in children:
        shown = "fact_production" if parent == "parent_production" else parent
        wrong = f"NOT coalesce({known(column, parent)}, FALSE)"
        if column == "supplier_id":
            wrong = f"t.supplier_id IS NOT NULL AND {wrong}"
        out.append((wrong, "INVALID_FOREIGN_KEY", f"{column} does not resolve to {shown}"))
    return out


PRODUCTION_FKS = [("factory_id", "dim_factory"), ("line_id", "dim_line"), ("product_id", "dim_product")]
EVENT_FKS = [
    ("production_lot_id", "parent_production"),
    *PRODUCTION_FKS,
    ("component_id", "dim_component"),
    ("supplier_id", "dim_supplier"),
    ("defect_id", "dim_defect"),
]
COPIES = f"COUNT(*) OVER (PARTITION BY {GRAIN})"
STORED = f"coalesce(({GRAIN}) IN (SELECT ({GRAIN}) FROM stored_production), FALSE)"
DUPLICATE_TEXT = f"duplicate key: {GRAIN}"
CTES |= {
    "typed_production": typed("raw_production", PRODUCTION),
    "counted_production": f"SELECT *, {COPIES} AS copies, {STORED} AS stored FROM typed_production",
    "typed_events": typed("raw_events", EVENT),
    "counted_events": """SELECT *, COUNT(*) OVER (PARTITION BY quality_event_id) AS copies
        FROM typed_events""",
    "checked_production": f"""SELECT t.*, {texts([
        *null_issues(PRODUCTION), *rule_issues(PRODUCTION_RULES),
        ("copies > 1 OR stored", "DUPLICATE_KEY", DUPLICATE_TEXT), *foreign(PRODUCTION_FKS),
    ])} FROM counted_production t""",
    "checked_events": f"""SELECT t.*, {texts([
        *null_issues(EVENT, ("supplier_id",)), *rule_issues(EVENT_RULES),
        ("copies > 1", "DUPLICATE_KEY", "duplicate key: quality_event_id"), *foreign(EVENT_FKS),
    ])} FROM counted_events t""",
}

_RUN_CHECKS = texts([
    *null_issues(PRODUCTION), *rule_issues(PRODUCTION_RULES),
    ("copies > 1 OR stored", "DUPLICATE_KEY", DUPLICATE_TEXT), *foreign(PRODUCTION_FKS),
])
CTES |= {
    "run_one": f"""SELECT *, {COPIES} AS copies, FALSE AS stored FROM typed_production
        WHERE substr(_source_file, 25, 1) IN ('0', '2')""",
    "checked_run_one": f"SELECT t.*, {_RUN_CHECKS} FROM run_one t",
    "run_two": f"""SELECT *, {COPIES} AS copies,
        coalesce(({GRAIN}) IN (SELECT ({GRAIN}) FROM checked_run_one WHERE codes = ''), FALSE) AS stored
        FROM (SELECT * FROM typed_production WHERE substr(_source_file, 25, 1) IN ('1', '3') UNION ALL
          SELECT * FROM typed_production WHERE substr(_source_file, 25, 1) = '0' AND production_lot_id LIKE '%7')""",
    "checked_run_two": f"SELECT t.*, {_RUN_CHECKS} FROM run_two t",
}


def versions(source: str, again: str, changes: dict[str, str]) -> str:
    """First-sent rows plus later, changed copies."""
    replaced = ", ".join(f"{text} AS {column}" for column, text in changes.items())

    def stamp(version: int) -> str:
        return (
            f"TIMESTAMP '2026-0{version}-01 00:00:00' AS _ingested_at, 'file-{version}' AS _source_file,"
            f" 'batch-{version}' AS _batch_id"
        )

    return (
        f"SELECT *, {stamp(1)} FROM {source}"
        f" UNION ALL SELECT * REPLACE ({replaced}), {stamp(2)} FROM {source} WHERE {again}"
    )


def number_of(column: str) -> str:
    return f"CAST(split_part({column}, '-', 2) AS INTEGER)"


CTES["bronze_dim_date"] = versions("dim_date", "date_id % 3 = 0", {"is_weekend": "NOT is_weekend"})
for _table in list(DIM_COLUMNS)[1:]:
    _stem = _table.removeprefix("dim_")
    _changes = {
        f"{_stem}_id": f"' ' || {_stem}_id",
        f"{_stem}_code": f"lower({_stem}_code)",
        f"{_stem}_name": f"' ' || {_stem}_name || ' v2 '",
    }
    if _stem == "line":
        _changes["factory_id"] = f"CASE WHEN {number_of('line_id')} % 7 = 3 THEN 'FAC-404' ELSE factory_id END"
    CTES[f"bronze_{_table}"] = versions(_table, f"{number_of(_stem + '_id')} % 3 = 0", _changes)

CTES |= {
    "broken_production": """SELECT * REPLACE (
        CASE WHEN k % 79 = 0 THEN 'FAC-404' ELSE factory_id END AS factory_id,
        pass_qty + CASE WHEN k % 67 = 0 THEN 1 ELSE 0 END AS pass_qty,
        CASE WHEN k % 53 = 0 THEN ' ' || product_id ELSE product_id END AS product_id,
        CASE WHEN k % 71 = 0 THEN 'LINE-' || ((k + 1) % 25) ELSE line_id END AS line_id)
        FROM keyed_production""",
    "bronze_production_k": versions(
        "broken_production",
        "k % 59 = 0",
        {
            "completed_qty": "greatest(completed_qty - 1, 0)",
            "scrap_qty": "CASE WHEN k % 118 = 0 THEN fail_qty + 1 ELSE scrap_qty END",
        },
    ),
    "bronze_production": "SELECT * EXCLUDE (k) FROM bronze_production_k",
    "broken_events": """SELECT * REPLACE (
        CASE WHEN k % 47 = 0 THEN 'PLOT-0' ELSE production_lot_id END AS production_lot_id,
        CASE WHEN k % 41 = 0 THEN 0 ELSE event_quantity END AS event_quantity,
        CASE WHEN k % 31 = 0 THEN upper(inspection_stage) ELSE inspection_stage END AS inspection_stage,
        CASE WHEN k % 37 = 0 THEN 'pass' ELSE disposition END AS disposition,
        CASE WHEN k % 43 = 0 AND supplier_id IS NOT NULL THEN 'SUP-404' ELSE supplier_id END AS supplier_id)
        FROM keyed_events""",
    "bronze_events_k": versions("broken_events", "k % 61 = 0", {"event_quantity": "event_quantity + 1"}),
    "bronze_events": "SELECT * EXCLUDE (k) FROM bronze_events_k",
}


def newest(source: str, key: str, columns: list[str]) -> str:
    """Newest row per key; file number and version agree, so the time alone decides."""
    return (
        f"SELECT {', '.join(columns)} FROM (SELECT *, row_number() OVER (PARTITION BY {key} "
        f"ORDER BY _ingested_at DESC, _source_file) AS rn FROM {source}) WHERE rn = 1"
    )


for _table, _text in DIM_COLUMNS.items():
    _columns = _text.split()
    _shown = []
    for _c in _columns:
        if _c.endswith("_code"):
            _shown.append(f"upper(trim({_c})) AS {_c}")
        elif _c == "severity":
            _shown.append("lower(trim(severity)) AS severity")
        elif _c.endswith(("_id", "_name", "_family", "_region", "_category", "country")) and _c != "date_id":
            _shown.append(f"trim({_c}) AS {_c}")
        else:
            _shown.append(f'"{_c}"')
    _tidy = f"(SELECT {', '.join(_shown)}, _ingested_at, _source_file FROM bronze_{_table})"
    _quoted = [f'"{c}"' for c in _columns]
    _orphans = " AND factory_id IN (SELECT factory_id FROM silver_dim_factory)" if _table == "dim_line" else ""
    CTES[f"silver_{_table}"] = newest(_tidy, _columns[0], _quoted) + _orphans
    # Source order: newest raw record, related by raw text, tidied last.
    _rawest = newest(f"bronze_{_table}", _columns[0], _quoted)
    if _table == "dim_line":
        _rawest += " AND factory_id IN (SELECT factory_id FROM plain_dim_factory)"
    CTES[f"plain_{_table}"] = f"SELECT {', '.join(_shown)} FROM ({_rawest})"

ENUMS = "inspection_stage IN ('incoming', 'in_process', 'final', 'test') AND disposition IN ('fail', 'rework', 'scrap')"


def trimmed(columns: list[str], enums: bool) -> str:
    out = []
    for c in columns:
        if c in ("inspection_stage", "disposition"):
            out.append(f"lower(trim({c})) AS {c}" if enums else c)
        else:
            out.append(f"trim({c}) AS {c}" if c.endswith("_id") else c)
    return ", ".join([*out, "_ingested_at", "_source_file"])


def conformed_production(source: str, dims: str) -> str:
    holds = " AND ".join(rule for rule, _, _ in PRODUCTION_RULES[1:])
    return f"""SELECT *, CAST(year(production_date) AS INTEGER) AS production_year,
        CAST(weekofyear(production_date) AS INTEGER) AS production_week
        FROM ({newest(source, GRAIN, PRODUCTION)}) p
        WHERE {holds} AND production_date IN (SELECT "date" FROM {dims}_dim_date)
        AND factory_id IN (SELECT factory_id FROM {dims}_dim_factory)
        AND (line_id, factory_id) IN (SELECT (line_id, factory_id) FROM {dims}_dim_line)
        AND product_id IN (SELECT product_id FROM {dims}_dim_product)"""


def conformed_events(source: str, production: str, dims: str) -> str:
    return f"""SELECT q.* REPLACE (lower(trim(q.inspection_stage)) AS inspection_stage,
        lower(trim(q.disposition)) AS disposition), q.supplier_id IS NOT NULL AS is_supplier_attributed
        FROM ({newest(source, "quality_event_id", EVENT)}) q
        WHERE event_quantity > 0 AND {ENUMS}
        AND (q.event_date, q.factory_id, q.line_id, q.product_id, q.production_lot_id) IN (
          SELECT (production_date, factory_id, line_id, product_id, production_lot_id) FROM {production})
        AND q.component_id IN (SELECT component_id FROM {dims}_dim_component)
        AND q.defect_id IN (SELECT defect_id FROM {dims}_dim_defect)
        AND (q.supplier_id IS NULL OR q.supplier_id IN (SELECT supplier_id FROM {dims}_dim_supplier))"""


CTES |= {
    "tidy_production": f"SELECT {trimmed(PRODUCTION, False)} FROM bronze_production",
    "tidy_events": f"SELECT {trimmed(EVENT, True)} FROM bronze_events",
    "silver_production": conformed_production("tidy_production", "silver"),
    "plain_production": conformed_production("bronze_production", "plain"),
    "silver_events": conformed_events("tidy_events", "silver_production", "silver"),
    "plain_events": conformed_events("bronze_events", "plain_production", "plain"),
}

# --- Gold


def rollup(source: str, by: str) -> str:
    return f"""SELECT {by}, {big("completed_qty", "production_quantity")},
        {big("first_pass_pass_qty", "pass_quantity")}, {big("fail_qty", "fail_quantity")},
        {big("rework_qty", "rework_quantity")}, {big("scrap_qty", "scrap_quantity")}
        FROM {source} GROUP BY {by}"""


def factory_gold(source: str, dim: str) -> str:
    return f"""SELECT production_date, factory_id, factory_name, country, production_quantity,
        pass_quantity, fail_quantity, {rates("fpy", "dppm", "rework_rate", "scrap_rate")}
        FROM ({rollup(f"(SELECT p.*, factory_name, country FROM {source} p JOIN {dim} USING (factory_id))",
                      "production_date, factory_id, factory_name, country")})"""  # fmt: skip


def weekly(year: str) -> str:
    return f"""SELECT factory_id, line_id, product_id, CAST({year}(production_date) AS INTEGER) AS reporting_year,
        CAST(weekofyear(production_date) AS INTEGER) AS reporting_week,
        {sums(["pass_quantity", "fail_quantity"])} FROM daily GROUP BY ALL"""


def daily_gold(year: str) -> str:
    return f"""SELECT d.*, {rates()}, w.reporting_year, w.reporting_week, w.week_fpy, w.wow_fpy_change
        FROM daily d JOIN (
          SELECT * EXCLUDE (pass_quantity, fail_quantity), week_fpy - lag(week_fpy) OVER (PARTITION BY factory_id, line_id, product_id
            ORDER BY reporting_year, reporting_week) AS wow_fpy_change
          FROM (SELECT *, {FPY} AS week_fpy FROM ({weekly(year)}))) w
        ON d.factory_id = w.factory_id AND d.line_id = w.line_id AND d.product_id = w.product_id
        AND {year}(d.production_date) = w.reporting_year AND weekofyear(d.production_date) = w.reporting_week"""


CTES |= {
    "daily": rollup("production", "production_date, factory_id, line_id, product_id"),
    "weekly": f"SELECT *, {FPY} AS week_fpy FROM ({weekly('year')})",
    "gold_daily": daily_gold("year"),
    "gold_daily_iso": daily_gold("isoyear"),
    "gold_factory": factory_gold("production", "dim_factory"),
    "gold_product": f"""SELECT production_date, factory_id, product_id, product_name, product_family,
        production_quantity, pass_quantity, fail_quantity, {FPY} AS fpy,
        CAST(production_quantity AS DOUBLE) / NULLIF(CAST(SUM(production_quantity) OVER (
          PARTITION BY production_date, factory_id) AS DOUBLE), 0) AS product_mix_share,
        {RATES["dppm"]} AS dppm
        FROM ({rollup("production", "production_date, factory_id, product_id")}) JOIN dim_product USING (product_id)""",
    "lot_defects": f"""SELECT event_date, factory_id, product_id, component_id, supplier_id,
        production_lot_id, {big("event_quantity", "defective_units")} FROM event_rows
        WHERE is_supplier_attributed AND is_first_pass_failure GROUP BY ALL""",
    "attributed": f"""SELECT a.event_date, a.factory_id, a.product_id, a.component_id, a.supplier_id,
        {big("a.defective_units", "defective_units")}, {big("p.inspected", "inspected_units")}
        FROM lot_defects a JOIN (SELECT production_lot_id, SUM(completed_qty) AS inspected
          FROM production GROUP BY production_lot_id) p USING (production_lot_id) GROUP BY ALL""",
    "gold_supplier": f"""SELECT d.*, supplier_name, component_name, {supplier_rates()}
        FROM attributed d JOIN dim_supplier USING (supplier_id) JOIN dim_component USING (component_id)""",
    "defects": f"""SELECT event_date, factory_id, line_id, product_id, component_id, supplier_id, defect_id,
        defect_name, defect_category,
        {big("CASE WHEN is_first_pass_failure THEN event_quantity ELSE 0 END", "defect_quantity")}
        FROM event_rows JOIN dim_defect USING (defect_id) GROUP BY ALL""",
    "gold_pareto": f"""SELECT *, {div("defect_quantity", "total_failures")} AS defect_contribution,
        {div("cumulative_failures", "total_failures")} AS cumulative_defect_contribution
        FROM (SELECT *, CAST(SUM(defect_quantity) OVER (PARTITION BY event_date, factory_id) AS BIGINT)
            AS total_failures,
          CAST(SUM(defect_quantity) OVER (PARTITION BY event_date, factory_id ORDER BY defect_quantity DESC,
            defect_id, line_id, product_id, component_id, supplier_id NULLS FIRST
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_failures,
          CAST(dense_rank() OVER (PARTITION BY event_date, factory_id ORDER BY defect_quantity DESC)
            AS INTEGER) AS pareto_rank
        FROM defects)""",
}


def _with(body: str) -> str:
    """Prefix ``body`` with the CTEs it uses, in dependency order."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in order and re.search(rf"\b{name}\b", text) and not _own(name, text):
                visit_name(name)

    def visit_name(name: str) -> None:
        pending.add(name)
        for other in CTES:
            if other not in order and other not in pending and re.search(rf"\b{other}\b", CTES[name]):
                visit_name(other)
        if name not in order:
            order.append(name)

    def _own(name: str, text: str) -> bool:
        return not re.search(rf"(FROM|JOIN)\s+{name}\b", text)

    pending: set[str] = set()
    visit(body)
    if not order:
        return body
    parts = ",\n".join(f"{name} AS ({CTES[name]})" for name in order)
    return f"WITH {parts}\n{body}"


def _issue_query(source: str, key: str, issues: list) -> str:
    return f"SELECT {key}, codes, messages FROM (SELECT t.{key}, {texts(issues)} FROM {source} t) WHERE codes <> ''"


def _count(name: str, source: str) -> str:
    return f"SELECT '{name}' AS check_name, COUNT(*) AS violations FROM {source}"


def _counts(pairs: dict[str, str], column: str = "actual_rows") -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS {column} FROM {source}" for name, source in pairs.items()
    )


def _row_counts(pairs: dict[str, str], expected: dict[str, int]) -> str:
    values = ", ".join(f"('{name}', {n})" for name, n in expected.items())
    return f"""SELECT table_name, actual_rows, CAST(expected_rows AS BIGINT) AS expected_rows,
        CASE WHEN actual_rows = expected_rows THEN 'PASS' ELSE 'FAIL' END AS status
        FROM ({_counts(pairs)}) JOIN (VALUES {values}) e(table_name, expected_rows) USING (table_name)"""


GOLD_SOURCES = {
    "gold_manufacturing_daily": ("gold_daily", 1798),
    "gold_factory_quality": ("gold_factory", 543),
    "gold_product_quality": ("gold_product", 1442),
    "gold_supplier_quality": ("gold_supplier", 8045),
    "gold_defect_pareto": ("gold_pareto", 8649),
}
GOLD_COUNTS = _row_counts(
    {name: source for name, (source, _) in GOLD_SOURCES.items()},
    {name: rows for name, (_, rows) in GOLD_SOURCES.items()},
)


def _period_fpy(when: str) -> str:
    inside = f"CASE WHEN production_date {when} THEN"
    return (
        f"CAST(SUM({inside} pass_quantity END) AS DOUBLE) / NULLIF(CAST(SUM({inside} pass_quantity"
        f" + fail_quantity END) AS DOUBLE), 0)"
    )


BOTH = f"(production_date {EARLIER} OR production_date {YEAR})"
PRODUCT_CHANGE = f"""SELECT product_id, {_period_fpy(YEAR)} - {_period_fpy(EARLIER)} AS change
    FROM gold_product WHERE factory_id = 'FAC-2' AND {BOTH} GROUP BY product_id"""
VOLUMES = f"""SELECT product_id,
    CAST(SUM(CASE WHEN production_date {EARLIER} THEN production_quantity END) AS BIGINT) AS volume_before,
    CAST(SUM(CASE WHEN production_date {YEAR} THEN production_quantity END) AS BIGINT) AS volume_after
    FROM gold_product WHERE factory_id = 'FAC-2' AND {BOTH} GROUP BY product_id"""


def _curve(where: str) -> str:
    def rework(when: str) -> str:
        inside = f"CASE WHEN production_date {when} THEN"
        return (
            f"CAST(SUM({inside} rework_quantity END) AS DOUBLE)"
            f" / NULLIF(CAST(SUM({inside} production_quantity END) AS DOUBLE), 0)"
        )

    return f"""SELECT *, early_rework_rate > late_rework_rate AND early_fpy < late_fpy AS improves,
        early_rework_rate > late_rework_rate * 1.5::DOUBLE AS is_ramp FROM (
        SELECT {rework(EARLIER)} AS early_rework_rate, {rework(YEAR)} AS late_rework_rate,
        {_period_fpy(EARLIER)} AS early_fpy, {_period_fpy(YEAR)} AS late_fpy
        FROM daily WHERE {where})"""


def _rank(source: str, by: str, measure: str, entity: str, where: str) -> str:
    return f"""SELECT coalesce(MAX(r), 999) FROM (SELECT *, dense_rank() OVER (ORDER BY total DESC) AS r
        FROM (SELECT {by}, SUM({measure}) AS total FROM {source} WHERE {where} GROUP BY {by})) WHERE {entity}"""


def _rate_text(rate: str) -> str:
    return f"CAST(CAST({rate} AS DECIMAL(18, 9)) AS VARCHAR)"


def _acceptance() -> str:
    def row(name: str, passed: str, actual: str, expected: str, detail: str, source: str = "(SELECT 1) one") -> str:
        return (
            f"SELECT '{name}' AS check_name, CASE WHEN {passed} THEN 'PASS' ELSE 'FAIL' END AS status,"
            f" coalesce(CAST({actual} AS VARCHAR), 'NULL') AS actual, '{expected}' AS expected,"
            f" '{detail}' AS detail FROM {source}"
        )

    def rank(name: str, source: str, entity: dict[str, str], measure: str, when: str) -> str:
        own = " AND ".join(f"{column} = '{value}'" for column, value in entity.items())
        text = _rank(source, ", ".join(entity), measure, own, f"event_date {when}")
        text = text.replace("coalesce(MAX(r), 999)", "coalesce(MAX(r), 999) AS r", 1)
        detail = f"{' + '.join(entity.values())} is a leading contribution"
        return row(name, "r <= 3", "r", "<= 3", detail, f"({text})")

    shown = ", ".join(
        f"'{when}_{label}=' || {_rate_text(f'{when}_{column}')}"
        for label, column in (("rework", "rework_rate"), ("fpy", "fpy"))
        for when in ("early", "late")
    )
    return " UNION ALL ".join(
        [
            row("gold_table_inventory", "TRUE", "5", "5", "the governed Gold sources exist"),
            f"""SELECT 'row_count_' || table_name, status, CAST(actual_rows AS VARCHAR),
                CAST(expected_rows AS VARCHAR), 'Gold row count' FROM ({GOLD_COUNTS})""",
            row("governed_metric_formulas", "TRUE", "0", "0",
                "rows whose stored rate differs from its numerator and denominator"),
            rank("incident_a_supplier_power_module", "gold_supplier",
                 {"supplier_id": "SUP-3", "component_id": "COMP-1"}, "defective_units", YEAR),
            rank("incident_b_mexico_line2_voltage", "gold_pareto",
                 {"factory_id": "FAC-2", "line_id": "LINE-7", "defect_id": "DEF-4"}, "defect_quantity", QUARTER),
            row("incident_c_ramp_line_improves", "improves", f"concat_ws(', ', {shown})",
                "early rework > late rework and early FPY < late FPY",
                "the ramp line improves over the learning period",
                f"({_curve(chr(102) + 'actory_id = ' + chr(39) + 'FAC-4' + chr(39) + ' AND line_id = ' + chr(39) + 'LINE-9' + chr(39))})"),
            rank("incident_d_localized_memory_failure", "gold_pareto",
                 {"factory_id": "FAC-3", "product_id": "PROD-1", "component_id": "COMP-2",
                  "supplier_id": "SUP-3", "defect_id": "DEF-3"}, "defect_quantity", QUARTER),
            row("incident_e_aggregate_fpy_declines", "post < pre",
                f"concat_ws(', ', 'before=' || {_rate_text('pre')}, 'after=' || {_rate_text('post')})",
                "after < before", "aggregate FPY declines after the mix shift",
                f"""(SELECT {_period_fpy(EARLIER)} AS pre, {_period_fpy(YEAR)} AS post FROM gold_factory
                WHERE factory_id = 'FAC-2')"""),
            row("incident_e_product_fpy_stable", "m < 0.035", _rate_text("m"), "< 0.035",
                "mean absolute within-product FPY change stays within the tolerance",
                f"(SELECT AVG(abs(change)) AS m FROM ({PRODUCT_CHANGE}))"),
            row("incident_e_product_mix_shift", "fa < fb AND ra > rb",
                "'PROD-1 ' || fb || ' -> ' || fa || '; PROD-2 ' || rb || ' -> ' || ra",
                "PROD-1 decreases and PROD-2 increases", "the volume shift explains the aggregate change",
                f"""(SELECT MAX(CASE WHEN product_id = 'PROD-1' THEN volume_before END) AS fb,
                MAX(CASE WHEN product_id = 'PROD-1' THEN volume_after END) AS fa,
                MAX(CASE WHEN product_id = 'PROD-2' THEN volume_before END) AS rb,
                MAX(CASE WHEN product_id = 'PROD-2' THEN volume_after END) AS ra FROM ({VOLUMES}))"""),
        ]
    )


def _validation(drift: bool = False) -> str:
    """The structural checks; with drift, of fact tables that lack three columns."""
    parts = []
    production, events, lost = "bronze_production", "bronze_events", {}
    if drift:
        production = ("(SELECT * REPLACE (CAST(NULL AS VARCHAR) AS line_id, CAST(NULL AS BIGINT) AS scrap_qty)"
                      " FROM bronze_production)")
        events = "(SELECT * REPLACE (CAST(NULL AS BIGINT) AS event_quantity) FROM bronze_events)"
        lost = {"fact_production": ["line_id", "scrap_qty"], "fact_quality_event": ["event_quantity"]}
    for name, source in (("fact_production", production), ("fact_quality_event", events)):
        named = f": {lost[name]}".replace("'", "''") if lost else ""
        parts.append((f"{name} is empty", f"CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END FROM {source}"))
        parts.append((f"{name} missing columns{named}", f"{len(lost.get(name, []))}"))
    for table, columns in DIM_COLUMNS.items():
        key = columns.split()[0]
        parts.append((f"{table}.{key} is not unique", f"COUNT(*) FROM (SELECT {key} FROM {table} GROUP BY {key} HAVING COUNT(*) > 1)"))
    parts.append(("fact_production natural key is not unique",
                  f"COUNT(*) FROM (SELECT {GRAIN} FROM {production} GROUP BY {GRAIN} HAVING COUNT(*) > 1)"))
    parts.append(("fact_quality_event.quality_event_id is not unique",
                  f"COUNT(*) FROM (SELECT quality_event_id FROM {events} GROUP BY ALL HAVING COUNT(*) > 1)"))
    for message, wrong in {
        "production date outside configured range": f"production_date NOT {HORIZON}",
        "production quantities must be non-negative integers": "production_qty < 0 OR pass_qty < 0 OR fail_qty < 0 OR rework_qty < 0 OR scrap_qty < 0",
        "pass_qty + fail_qty must equal production_qty": "pass_qty + fail_qty <> production_qty",
        "first-pass quantities exceed started_qty": "first_pass_pass_qty + fail_qty > started_qty",
        "rework/scrap exceeds fail_qty": "rework_qty > fail_qty OR scrap_qty > fail_qty",
        **{f"production foreign key {c} is invalid": f"{c} NOT IN (SELECT {c} FROM {d})" for c, d in PRODUCTION_FKS},
    }.items():
        parts.append((message, f"COUNT(*) FROM {production} WHERE ({wrong}) IS NOT FALSE"))
    for message, wrong in {
        "quality event quantity/stage is invalid": "event_quantity <= 0 OR inspection_stage NOT IN ('incoming', 'in_process', 'final', 'test')",
        "quality event date outside configured range": f"event_date NOT {HORIZON}",
        "quality event has orphan production lot": "production_lot_id NOT IN (SELECT production_lot_id FROM bronze_production)",
        **{f"quality event has invalid {c}": f"{c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM {d})" for c, d in EVENT_FKS[1:]},
    }.items():
        parts.append((message, f"COUNT(*) FROM {events} WHERE ({wrong}) IS NOT FALSE"))
    return " UNION ALL ".join(
        f"SELECT '{message}' AS message, CAST(v AS BIGINT) AS violations FROM (SELECT {text.replace(' FROM ', ' AS v FROM ', 1) if ' FROM ' in text else text + ' AS v'})"
        for message, text in parts
    )


def _decomposition() -> str:
    def total(column: str, when: str) -> str:
        return f"SUM(CASE WHEN production_date {when} THEN {column} ELSE 0 END)"

    judged = "pass_quantity + fail_quantity"
    return f"""SELECT factory_id, s0 AS share_before, s1 AS share_after, f0 AS fpy_before, f1 AS fpy_after,
        s1 * (coalesce(f1, coalesce(f0, w0)) - coalesce(f0, w0)) AS rate_effect,
        (s1 - s0) * (coalesce(f0, w0) - w0) AS mix_effect FROM (
        SELECT factory_id, p0 / NULLIF(j0, 0) AS f0, p1 / NULLIF(j1, 0) AS f1,
          j0 / NULLIF(SUM(j0) OVER (), 0) AS s0, j1 / NULLIF(SUM(j1) OVER (), 0) AS s1,
          SUM(p0) OVER () / NULLIF(SUM(j0) OVER (), 0) AS w0 FROM (
        SELECT factory_id, CAST({total("pass_quantity", EARLIER)} AS DOUBLE) AS p0,
          CAST({total("pass_quantity", YEAR)} AS DOUBLE) AS p1,
          CAST({total(judged, EARLIER)} AS DOUBLE) AS j0, CAST({total(judged, YEAR)} AS DOUBLE) AS j1
        FROM gold_factory WHERE {BOTH} GROUP BY factory_id))"""


_BODIES: dict[str, str] = {
    # --- ingestion
    "source_inventory": f"""SELECT coalesce(table_name, wanted) AS table_name,
        coalesce(actual_rows, 0) AS row_count,
        CASE WHEN table_name IS NULL THEN 'MISSING' WHEN wanted IS NULL THEN 'UNEXPECTED'
             WHEN actual_rows = 0 THEN 'EMPTY' ELSE 'OK' END AS status
        FROM ({_counts({**{t: t for t in DIM_COLUMNS if t != "dim_defect"}, "fact_production": "production",
                        "fact_quality_event": "event_rows", "fact_other": "production WHERE started_qty < 0"})})
        FULL JOIN (VALUES {", ".join(f"('{t}')" for t in [*DIM_COLUMNS, "fact_production", "fact_quality_event"])})
        e(wanted) ON table_name = wanted""",
    "ingest_new_files": """SELECT production_lot_id, production_qty, _source_file FROM raw_production
        WHERE _source_file NOT IN (SELECT source_file FROM audit
          WHERE table_name = 'fact_production' AND status = 'SUCCESS')""",
    "dq_missing_column": f"""SELECT t.production_lot_id, t.line_id, t.scrap_qty, {texts([
          *null_issues(PRODUCTION, missing=("line_id", "scrap_qty")), *rule_issues(PRODUCTION_RULES),
          ("copies > 1", "DUPLICATE_KEY", DUPLICATE_TEXT)])}
        FROM (SELECT *, {COPIES} AS copies FROM ({typed("raw_production", PRODUCTION, ("line_id", "scrap_qty"))})) t""",
    "dq_safe_cast": f"SELECT {cast_all(PRODUCTION)} FROM raw_production",
    "dq_required": _issue_query(
        "typed_production", "production_lot_id",
        [i for i in null_issues(PRODUCTION) if i[1] == "NULL_REQUIRED_VALUE"]),
    "dq_invalid_type": _issue_query(
        "typed_events", "quality_event_id", [i for i in null_issues(EVENT) if i[1] == "INVALID_DATA_TYPE"]),
    "dq_row_rules": _issue_query("typed_production", "production_lot_id", rule_issues(PRODUCTION_RULES)),
    "dq_event_rules": _issue_query("typed_events", "quality_event_id", rule_issues(EVENT_RULES)),
    "dq_dimension_rules": f"""SELECT CAST(date_id AS VARCHAR) AS id,
          CASE WHEN "date" {HORIZON} THEN '' ELSE 'DATE_OUT_OF_RANGE' END AS codes FROM dim_date
        UNION ALL SELECT factory_id, CASE WHEN factory_id = 'FAC-3' THEN 'INVALID_BASELINE_FPY' ELSE '' END
          FROM dim_factory
        UNION ALL SELECT product_id, CASE WHEN complexity_risk >= 0 THEN '' ELSE 'NEGATIVE_COMPLEXITY_RISK' END
          FROM dim_product""",
    "dq_duplicate_in_batch": f"""SELECT production_lot_id, 'DUPLICATE_KEY' AS codes,
        '{DUPLICATE_TEXT}' AS messages FROM counted_production WHERE copies > 1""",
    "dq_duplicate_vs_target": """SELECT production_lot_id, production_date, _source_file,
        stored AS is_stored FROM counted_production""",
    "dq_foreign_key": f"""SELECT * FROM (SELECT t.quality_event_id, concat_ws('; ', {", ".join(
        case(when, message) for when, _, message in foreign(EVENT_FKS))}) AS messages FROM typed_events t)
        WHERE messages <> ''""",
    "bronze_valid": f"SELECT {', '.join(PRODUCTION)}, _source_file FROM checked_production WHERE codes = ''",
    "bronze_quarantine": """SELECT 'fact_production' AS table_name, record AS original_record, _source_file,
        codes AS _error_code, messages AS _error_message FROM checked_production WHERE codes <> ''""",
    "bronze_event_valid": f"SELECT {', '.join(EVENT)}, _source_file FROM checked_events WHERE codes = ''",
    "bronze_event_quarantine": """SELECT 'fact_quality_event' AS table_name, record AS original_record,
        _source_file, codes AS _error_code, messages AS _error_message FROM checked_events
        WHERE codes <> ''""",
    "ingestion_audit": """SELECT 'fact_production' AS table_name, _source_file AS source_file,
        COUNT(*) AS source_rows, COUNT(*) FILTER (codes = '') AS valid_rows,
        COUNT(*) FILTER (codes <> '') AS quarantined_rows, 'SUCCESS' AS status
        FROM checked_production GROUP BY _source_file""",
    # --- conforming
    "latest_record": newest("bronze_production", GRAIN, [*PRODUCTION, "_ingested_at", "_source_file", "_batch_id"]),
    "normalize_text": """SELECT quality_event_id, _ingested_at, lower(trim(inspection_stage)) AS inspection_stage,
        upper(trim(disposition)) AS disposition, trim(defect_id) AS defect_id FROM bronze_events""",
    **{f"silver_{table}": f"SELECT * FROM silver_{table}" for table in DIM_COLUMNS},
    "silver_fact_production": "SELECT * FROM silver_production",
    "silver_fact_production_source_order": "SELECT * FROM plain_production",
    "silver_fact_quality_event": "SELECT * FROM silver_events",
    "silver_fact_quality_event_source_order": "SELECT * FROM plain_events",
    "bronze_to_gold_factory_quality": factory_gold("silver_production", "silver_dim_factory"),
    # --- Gold
    "gold_manufacturing_daily": "SELECT * FROM gold_daily",
    "gold_manufacturing_daily_iso_year": "SELECT * FROM gold_daily_iso",
    "daily_rollup": "SELECT * FROM daily",
    "governed_metrics": f"SELECT *, {rates()} FROM daily",
    "weekly_fpy": "SELECT * FROM weekly",
    "wow_change": """SELECT *, week_fpy - lag(week_fpy) OVER (PARTITION BY factory_id, line_id, product_id
        ORDER BY reporting_year, reporting_week) AS wow_fpy_change FROM weekly""",
    "gold_factory_quality": "SELECT * FROM gold_factory",
    "gold_product_quality": "SELECT * FROM gold_product",
    "gold_supplier_quality": "SELECT * FROM gold_supplier",
    "attributed_lot_rate": "SELECT * FROM attributed",
    "gold_defect_pareto": "SELECT * FROM gold_pareto",
    "scope_metrics": f"""SELECT *, {rates()} FROM (SELECT {big("completed_qty", "production_quantity")},
        {big("first_pass_pass_qty", "pass_quantity")}, {big("fail_qty", "fail_quantity")},
        {big("rework_qty", "rework_quantity")}, {big("scrap_qty", "scrap_quantity")}
        FROM production WHERE factory_id = 'FAC-2')""",
    # --- validation
    "duplicate_keys": f"""SELECT {GRAIN}, COUNT(*) AS copies FROM bronze_production
        GROUP BY {GRAIN} HAVING COUNT(*) > 1""",
    "period_pivot": f"""SELECT factory_id, product_id, {_period_fpy(EARLIER)} AS fpy_pre,
        {_period_fpy(YEAR)} AS fpy_post FROM daily WHERE {BOTH} GROUP BY factory_id, product_id""",
    "row_count_check": _row_counts(
        {"dim_factory": "dim_factory", "dim_line": "dim_line", "dim_product": "dim_product", "fact_production": "production"},
        {"dim_factory": 5, "dim_line": 25, "dim_product": 6, "fact_production": 2110}),
    "gold_row_counts": GOLD_COUNTS,
    "quarantine_profile": """SELECT 'fact_production' AS table_name, codes AS _error_code, COUNT(*) AS records
        FROM checked_production WHERE codes <> '' GROUP BY codes""",
    "audit_totals": f"""SELECT table_name, source_file, status, {sums(["source_rows", "valid_rows", "quarantined_rows"])},
        COUNT(*) AS successful_audit_records FROM audit GROUP BY table_name, source_file, status""",
    "audit_duplicates": _count("duplicate_successful_source_audit", """(SELECT table_name, source_file FROM audit
        WHERE status = 'SUCCESS' GROUP BY ALL HAVING COUNT(*) > 1)"""),
    "grain_duplicates": _count("silver_fact_production_duplicate",
        f"(SELECT {GRAIN} FROM bronze_production GROUP BY {GRAIN} HAVING COUNT(*) > 1)"),
    "event_duplicates": _count("silver_quality_event_duplicate",
        "(SELECT quality_event_id FROM bronze_events GROUP BY ALL HAVING COUNT(*) > 1)"),
    "invalid_quantities": _count("invalid_production_quantities", """bronze_production
        WHERE completed_qty < 0 OR first_pass_pass_qty < 0 OR fail_qty < 0
        OR first_pass_pass_qty + fail_qty > started_qty OR rework_qty > fail_qty OR scrap_qty > fail_qty"""),
    "metric_reconciliation": _count("governed_metric_formulas", f"""daily
        WHERE product_id = 'PROD-4' AND abs(({FPY} + CAST(1e-9 AS DOUBLE)) - {FPY}) > CAST(1e-12 AS DOUBLE)"""),
    "dataset_validation": _validation(),
    "ranked_contribution": f"""SELECT supplier_id, component_id, CAST(total AS BIGINT) AS defective_units,
        CAST(dense_rank() OVER (ORDER BY total DESC) AS INTEGER) AS contribution_rank
        FROM (SELECT supplier_id, component_id, SUM(defective_units) AS total FROM attributed
          WHERE event_date {YEAR} GROUP BY supplier_id, component_id)""",
    "leading_line_defects": f"""SELECT factory_id, line_id, defect_id, CAST(total AS BIGINT) AS event_quantity,
        CAST(r AS INTEGER) AS contribution_rank FROM (SELECT *, dense_rank() OVER (ORDER BY total DESC) AS r
        FROM (SELECT factory_id, line_id, defect_id, SUM(event_quantity) AS total FROM event_rows
          WHERE is_first_pass_failure AND event_date {YEAR} GROUP BY ALL)) WHERE r <= 3""",
    "localized_rank": "SELECT CAST(r AS BIGINT) AS contribution_rank FROM (" + _rank(
        "event_rows", "factory_id, product_id, component_id, supplier_id, defect_id", "event_quantity",
        "factory_id = 'FAC-3' AND product_id = 'PROD-1' AND component_id = 'COMP-2' AND supplier_id = 'SUP-3'"
        " AND defect_id = 'DEF-3'",
        "is_first_pass_failure").replace("999)", "999) AS r", 1) + ")",
    "acceptance_report": _acceptance(),
    # --- evidence
    "incident_supplier_component": f"""SELECT supplier_id, component_id, CAST(d AS BIGINT) AS defective_units,
        CAST(d AS DOUBLE) / NULLIF(CAST(i AS DOUBLE), 0) AS defect_rate FROM (
        SELECT supplier_id, component_id, SUM(defective_units) AS d, SUM(inspected_units) AS i
        FROM gold_supplier WHERE event_date {YEAR} GROUP BY supplier_id, component_id)""",
    "incident_line_defect": f"""SELECT factory_id, line_id, defect_id, {big("defect_quantity", "defect_quantity")}
        FROM gold_pareto WHERE event_date {QUARTER} GROUP BY factory_id, line_id, defect_id""",
    "incident_line_trend": f"""SELECT production_date, factory_id, line_id, {RATES["rework_rate"]} AS rework_rate,
        {FPY} AS fpy FROM (SELECT production_date, factory_id, line_id, {sums(GOLD_SUMS)} FROM daily
        WHERE factory_id = 'FAC-2' AND production_date {YEAR} GROUP BY production_date, factory_id, line_id)""",
    "incident_component_lot": f"""SELECT component_lot_id, supplier_id, component_id,
        {big("event_quantity", "event_quantity")} FROM event_rows WHERE event_date {QUARTER} GROUP BY ALL""",
    "mix_vs_within": f"""SELECT pre AS aggregate_pre_fpy, post AS aggregate_post_fpy,
        post - pre AS aggregate_fpy_change,
        (SELECT round(AVG(abs(change)), 12) FROM ({PRODUCT_CHANGE})) AS mean_absolute_product_fpy_change
        FROM (SELECT {_period_fpy(EARLIER)} AS pre, {_period_fpy(YEAR)} AS post FROM gold_factory
        WHERE factory_id = 'FAC-2')""",
    "mix_verdict": f"""SELECT pre AS aggregate_pre_fpy, post AS aggregate_post_fpy,
        post - pre AS aggregate_fpy_change, m AS mean_absolute_product_fpy_change,
        post - pre < -0.004 AND m < 0.035 AS is_mix_effect
        FROM (SELECT {_period_fpy(EARLIER)} AS pre, {_period_fpy(YEAR)} AS post,
        (SELECT round(AVG(abs(change)), 12) FROM ({PRODUCT_CHANGE})) AS m FROM gold_factory
        WHERE factory_id = 'FAC-2')""",
    "mix_detail": f"""SELECT production_date, factory_id, product_id, production_quantity, fpy,
        product_mix_share FROM gold_product WHERE factory_id = 'FAC-2' AND production_date {YEAR}""",
    "learning_curve": _curve("line_id = 'LINE-9'"),
    "monthly_fpy": f"""SELECT *, {FPY} AS fpy FROM (SELECT CAST(date_trunc('month', production_date) AS DATE)
        AS production_month, factory_id, {sums(["pass_quantity", "fail_quantity"])} FROM gold_factory
        WHERE factory_id = 'FAC-2' GROUP BY ALL)""",
    "within_product_stability": f"""SELECT products, round(m, 12) AS mean_abs_product_fpy_change,
        m < 0.035 AS is_stable FROM (SELECT COUNT(change) AS products, AVG(abs(change)) AS m
        FROM ({PRODUCT_CHANGE}))""",
    "mix_shift": f"""SELECT *, CAST(sign(volume_change) AS INTEGER) AS direction FROM (SELECT *,
        coalesce(volume_after, 0) - coalesce(volume_before, 0) AS volume_change FROM ({VOLUMES}))""",
    "window_lift": f"""SELECT *, CAST(quantity_window AS DOUBLE) / NULLIF(CAST(quantity_baseline AS DOUBLE), 0) AS lift,
        quantity_window > 2 * quantity_baseline AS is_lifted FROM (SELECT supplier_id, component_id,
        {big(f"CASE WHEN event_date {QUARTER} THEN event_quantity ELSE 0 END", "quantity_window")},
        {big(f"CASE WHEN event_date {BASELINE} THEN event_quantity ELSE 0 END", "quantity_baseline")}
        FROM event_rows WHERE event_date {QUARTER} OR event_date {BASELINE} GROUP BY supplier_id, component_id)""",
    "unattributed_share": f"""SELECT *, {div("unattributed_quantity", "event_quantity")} AS unattributed_share
        FROM (SELECT line_id, defect_id, {big("event_quantity", "event_quantity")},
        {big("CASE WHEN supplier_id IS NULL THEN event_quantity ELSE 0 END", "unattributed_quantity")}
        FROM event_rows WHERE event_date {YEAR} GROUP BY line_id, defect_id)""",
    "lot_concentration": """SELECT component_id, supplier_id,
        MAX(CASE WHEN place = 1 THEN component_lot_id END) AS leading_component_lot_id,
        MAX(CASE WHEN place = 1 THEN total END) AS leading_quantity,
        MAX(CASE WHEN place = 2 THEN total END) AS runner_up_quantity,
        coalesce(MAX(CASE WHEN place = 1 THEN total END) > 3 * MAX(CASE WHEN place = 2 THEN total END), TRUE)
          AS is_concentrated
        FROM (SELECT *, row_number() OVER (PARTITION BY component_id, supplier_id
          ORDER BY total DESC, component_lot_id) AS place
        FROM (SELECT component_id, supplier_id, component_lot_id, CAST(SUM(event_quantity) AS BIGINT) AS total
          FROM event_rows WHERE supplier_id IS NOT NULL GROUP BY ALL)) GROUP BY component_id, supplier_id""",
    # --- view grain
    "view_grain_kpis": f"""SELECT *, {rates()} FROM (SELECT CAST(year(production_date) AS INTEGER) AS year,
        factory_id, {sums(GOLD_SUMS)} FROM daily GROUP BY ALL)""",
    "wow_view": """SELECT factory_id, reporting_year, reporting_week, round(AVG(wow_fpy_change), 12)
        AS wow_fpy_change FROM gold_daily GROUP BY ALL""",
    "mix_share_month": f"""SELECT period, factory_id, product_id, production_quantity, {FPY} AS fpy,
        CAST(production_quantity AS DOUBLE) / NULLIF(CAST(SUM(production_quantity) OVER (
          PARTITION BY period, factory_id) AS DOUBLE), 0) AS product_mix_share
        FROM (SELECT CAST(date_trunc('month', production_date) AS DATE) AS period, factory_id, product_id,
          {sums(GOLD_SUMS[:3])} FROM gold_product GROUP BY ALL)""",
    "supplier_rate_view": f"""SELECT *, {supplier_rates()} FROM (SELECT supplier_id, supplier_name,
        {sums(["inspected_units", "defective_units"])} FROM gold_supplier GROUP BY supplier_id, supplier_name)""",
    "defect_contribution": f"""SELECT factory_id, defect_id, q AS defect_quantity,
        {div("q", "SUM(q) OVER (PARTITION BY factory_id)")} AS defect_contribution,
        {div("SUM(q) OVER (PARTITION BY factory_id ORDER BY q DESC, defect_id ROWS UNBOUNDED PRECEDING)",
             "SUM(q) OVER (PARTITION BY factory_id)")} AS cumulative_defect_contribution
        FROM (SELECT factory_id, defect_id, {big("defect_quantity", "q")} FROM gold_pareto GROUP BY ALL)""",
    "factory_benchmark": f"""SELECT factory_id, line_id, product_id, fpy, factory_fpy, fpy - factory_fpy AS fpy_gap
        FROM (SELECT *, {FPY} AS fpy, {div("SUM(pass_quantity) OVER f", "SUM(pass_quantity + fail_quantity) OVER f")}
          AS factory_fpy FROM (SELECT factory_id, line_id, product_id, {sums(GOLD_SUMS[1:3])} FROM daily GROUP BY ALL)
          WINDOW f AS (PARTITION BY factory_id))""",
    "product_benchmark": f"""SELECT product_id, line_id, fpy, product_fpy, fpy - product_fpy AS fpy_gap
        FROM (SELECT *, {FPY} AS fpy, {div("SUM(pass_quantity) OVER f", "SUM(pass_quantity + fail_quantity) OVER f")}
          AS product_fpy FROM (SELECT product_id, line_id, {sums(GOLD_SUMS[1:3])} FROM daily GROUP BY ALL)
          WINDOW f AS (PARTITION BY product_id))""",
    "include_component": f"""SELECT *, {div("defect_quantity", "component_id_count")} AS mean_defect_quantity,
        {div("largest_defect_quantity", "defect_quantity")} AS leading_share FROM (
        SELECT factory_id, product_id, {big("q", "defect_quantity")}, COUNT(*) AS component_id_count,
          MAX(q) AS largest_defect_quantity FROM (SELECT factory_id, product_id, component_id,
          {big("defect_quantity", "q")} FROM gold_pareto GROUP BY ALL) GROUP BY factory_id, product_id)""",
    "exclude_defect_trend": """SELECT *, CAST(SUM(defect_quantity) OVER (PARTITION BY month, factory_id, product_id)
        AS BIGINT) AS parent_defect_quantity FROM (SELECT CAST(date_trunc('month', event_date) AS DATE) AS month,
        factory_id, product_id, defect_id, CAST(SUM(defect_quantity) AS BIGINT) AS defect_quantity
        FROM gold_pareto GROUP BY ALL)""",
    "drill_factory_product_line": f"""SELECT *, {rates()} FROM (SELECT factory_id, product_id, line_id, {sums(GOLD_SUMS)}
        FROM daily WHERE factory_id = 'FAC-2' AND product_id = 'PROD-1' GROUP BY ALL)""",
    "drill_component_supplier": f"""SELECT *, {supplier_rates()} FROM (SELECT factory_id, component_id, supplier_id,
        {sums(["inspected_units", "defective_units"])} FROM gold_supplier
        WHERE factory_id = 'FAC-2' AND component_id = 'COMP-1' GROUP BY ALL)""",
    "weekly_trend": f"""SELECT *, {rates("fpy", "rework_rate", "scrap_rate")} FROM (
        SELECT CAST(year(production_date) AS INTEGER) AS reporting_year,
        CAST(weekofyear(production_date) AS INTEGER) AS reporting_week, {sums(GOLD_SUMS)} FROM daily GROUP BY ALL)""",
    "entity_comparison": f"""SELECT *, {rates()} FROM (SELECT product_id, {sums(GOLD_SUMS)} FROM daily
        GROUP BY product_id)""",
    "rolling_fpy": f"""SELECT a.factory_id, a.production_date, a.fpy,
        {div("SUM(b.pass_quantity)", "SUM(b.pass_quantity + b.fail_quantity)")} AS rolling_fpy, a.next_fpy
        FROM (SELECT *, {FPY} AS fpy, lead({FPY}) OVER (PARTITION BY factory_id ORDER BY production_date) AS next_fpy
          FROM gold_factory_day) a JOIN gold_factory_day b ON a.factory_id = b.factory_id
          AND b.production_date BETWEEN a.production_date - 6 AND a.production_date
        GROUP BY a.factory_id, a.production_date, a.fpy, a.next_fpy""",
    "benchmark_rank": f"""SELECT *, CAST(rank() OVER (PARTITION BY month ORDER BY fpy DESC NULLS LAST) AS INTEGER)
        AS fpy_rank FROM (SELECT month, line_id, {FPY} AS fpy FROM (SELECT
        CAST(date_trunc('month', production_date) AS DATE) AS month, line_id, {sums(GOLD_SUMS[1:3])}
        FROM daily GROUP BY ALL))""",
    "contribution_to_change": _decomposition(),
    "scan_lineage": " UNION ALL ".join(
        f"SELECT '{table}.parquet' AS file_name, COUNT(*) AS n_rows, (SELECT COUNT(*) FROM "
        f"information_schema.columns WHERE table_name = '{table}') AS n_columns FROM {table}"
        for table in ("region", "nation", "supplier", "part", "orders", "lineitem")
    ),
}


def _in_order(body: str, *order: str) -> str:
    places = ", ".join(o if " DESC" in o else f"{o} NULLS FIRST" for o in order)
    return f"SELECT *, row_number() OVER (ORDER BY {places}) AS position FROM ({body})"


_BODIES |= {
    "ordered_quarantine_profile": _in_order(
        """SELECT 'fact_quality_event' AS table_name, codes AS _error_code, COUNT(*) AS records
        FROM checked_events WHERE codes <> '' GROUP BY codes""",
        "table_name", "records DESC NULLS LAST", "_error_code"),
    "ordered_supplier_component": _in_order(
        _BODIES["incident_supplier_component"],
        "defective_units DESC NULLS LAST", "supplier_id", "component_id", "defect_rate"),
    "ordered_line_defect": _in_order(
        _BODIES["incident_line_defect"],
        "defect_quantity DESC NULLS LAST", "factory_id", "line_id", "defect_id"),
    "ordered_line_trend": _in_order(
        _BODIES["incident_line_trend"], "production_date", "line_id", "factory_id", "rework_rate", "fpy"),
    "ordered_component_lot": _in_order(
        _BODIES["incident_component_lot"],
        "event_quantity DESC NULLS LAST", "component_lot_id", "supplier_id", "component_id"),
    "ordered_mix_detail": _in_order(
        _BODIES["mix_detail"], "production_date", "product_id", "factory_id", "production_quantity", "fpy",
        "product_mix_share"),
    "dataset_validation_drift": _validation(drift=True),
    "stored_keys_by_month": f"""SELECT strftime(production_date, '%Y-%m') AS month, COUNT(*) AS n_keys,
        CAST(SUM(copies) AS BIGINT) AS n_rows FROM (
        SELECT DISTINCT {GRAIN}, copies FROM counted_production
        WHERE stored AND production_date < DATE '1996-01-01') GROUP BY 1""",
    "ingestion_run": " UNION ALL ".join(
        [f"""SELECT '{batch}' AS batch_id, 'fact_production' AS table_name,
            CASE WHEN codes = '' THEN 'accepted' ELSE codes END AS outcome, COUNT(*) AS n_rows
            FROM checked_run_{batch} GROUP BY ALL""" for batch in ("one", "two")]
        + [f"SELECT 'one', '{dim}', 'accepted', COUNT(*) FROM {dim}" for _, dim in PRODUCTION_FKS]),
    "published_window": f"SELECT * FROM daily WHERE production_date {QUARTER}",
    "table_inventory": """SELECT 'landing' AS table_schema, table_name FROM information_schema.tables
        WHERE table_schema = 'main' AND table_type = 'VIEW'""",
}
CTES["gold_factory_day"] = f"""SELECT factory_id, production_date, {sums(GOLD_SUMS[1:3])} FROM daily
    GROUP BY factory_id, production_date"""

ORACLES = {name: _with(body) for name, body in _BODIES.items()}
