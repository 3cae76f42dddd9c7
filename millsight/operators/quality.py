"""Row-level contract checks, generated from a contract as SQL expressions."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millsight.contracts import Contract, Field, Reference, Rule

RAW = "_raw_"


@dataclass(frozen=True)
class Issue:
    """A violation: the predicate ``failed`` is TRUE or FALSE, never NULL."""

    failed: str
    code: str
    message: str

    @property
    def entry(self) -> str:
        return f"named_struct('code', {quoted(self.code)}, 'message', {quoted(self.message)})"


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def hold_raw(raw: DataFrame) -> DataFrame:
    """The untouched source columns under prefixed names, next to ``_source_file``; the columns a query
    does not need are pruned one by one."""
    return raw.selectExpr(*[f"`{c}` AS `{RAW}{c}`" for c in raw.columns], "_source_file")


def safe_casts(contract: Contract, available: Collection[str]) -> dict[str, str]:
    """Contract columns of a :func:`hold_raw` frame, cast to their types.

    A value is NULL where the source value does not fit the type or the column is absent.
    """
    return {
        field.name: f"try_cast(`{RAW}{field.name}` AS {field.sql_type})"
        if field.name in available
        else typed_null(field)
        for field in contract.fields
    }


def typed_null(field: Field) -> str:
    return f"CAST(NULL AS {field.sql_type})"


def absent_columns(contract: Contract, available: Collection[str]) -> list[str]:
    return sorted(field.name for field in contract.fields if field.name not in available)


def reconcile(frame: DataFrame, contract: Contract) -> DataFrame:
    """The frame with the contract columns it lacks as typed NULLs, so that every check can read them."""
    lost = [f for f in contract.fields if f.name not in frame.columns]
    return frame.selectExpr("*", *[f"{typed_null(f)} AS `{f.name}`" for f in lost]) if lost else frame


def raw_record(available: Collection[str]) -> str:
    """The source row as JSON, NULLs included."""
    members = ", ".join(f"{quoted(c)}, `{RAW}{c}`" for c in available)
    return f"to_json(named_struct({members}), map('ignoreNullFields', 'false'))"


def column_issues(contract: Contract, available: Collection[str]) -> list[Issue]:
    """Missing, NULL and uncastable values, in column order, from typed and raw columns."""
    found = []
    for field in contract.fields:
        present = field.name in available
        if not field.optional:
            code = "NULL_REQUIRED_VALUE" if present else "MISSING_REQUIRED_COLUMN"
            text = f"required field {field.name} is null or unavailable"
            found.append(Issue(f"`{field.name}` IS NULL", code, text))
        if present and field.sql_type != "STRING":  # everything casts to text
            text = f"{field.name} cannot be cast to {field.sql_type}"
            lost = f"(`{RAW}{field.name}` IS NOT NULL AND `{field.name}` IS NULL)"
            found.append(Issue(lost, "INVALID_DATA_TYPE", text))
    return found


def violates(rule: Rule) -> str:
    """TRUE unless the rule's predicate is TRUE."""
    return f"NOT coalesce({rule.holds}, FALSE)"


def rule_issues(contract: Contract) -> list[Issue]:
    return [Issue(violates(rule), rule.code, rule.message) for rule in contract.rules]


def duplicate_issue(contract: Contract, flag: str) -> Issue:
    return Issue(flag, "DUPLICATE_KEY", f"duplicate key: {', '.join(contract.key)}")


def reference_issue(reference: Reference, unresolved: str) -> Issue:
    """An optional reference may be NULL; any other NULL does not resolve."""
    text = f"{', '.join(reference.columns)} does not resolve to {reference.parent}"
    given = "".join(f" AND `{c}` IS NOT NULL" for c in reference.columns if reference.optional)
    return Issue(f"({unresolved}{given})", "INVALID_FOREIGN_KEY", text)


def violations(issues: list[Issue], first: int = 0) -> str:
    """The issues of a row as one number, a bit each from the ``first`` on; zero if there are none."""
    if first + len(issues) > 63:
        raise ValueError("a contract may have 63 issues")
    bits = [f"IF({issue.failed}, {1 << bit}L, 0L)" for bit, issue in enumerate(issues, first)]
    return " | ".join(bits) or "0L"


def named_entries(issues: list[Issue], violated: str) -> Column:
    """The issues of a :func:`violations` number in order, as an array of (code, message).

    The list is assembled for failing rows only.
    """
    listed = ", ".join(
        f"CASE WHEN {violated} & {1 << bit}L <> 0 THEN {issue.entry} END" for bit, issue in enumerate(issues)
    )
    none = "CAST(array() AS ARRAY<STRUCT<code: STRING, message: STRING>>)"
    return F.expr(f"CASE WHEN {violated} <> 0 THEN array_compact(array({listed})) ELSE {none} END")


def entries(issues: list[Issue]) -> Column:
    """Present issues in order, as an array of (code, message)."""
    return named_entries(issues, f"({violations(issues)})")


def issue_text(issues: str) -> tuple[Column, Column]:
    """Codes joined with ``,`` and messages joined with ``; ``."""
    return F.expr(f"concat_ws(',', {issues}.code)"), F.expr(f"concat_ws('; ', {issues}.message)")


def count_violations(frame: DataFrame, violation: Column, name: str) -> DataFrame:
    """One row (check_name, violations); a NULL predicate counts as no violation."""
    counted = F.count_if(violation).alias("violations")
    return frame.agg(counted).select(F.lit(name).alias("check_name"), "violations")
