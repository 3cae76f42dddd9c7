"""Contract-driven ingestion: check, route, audit.

``check_batch`` is a pure DataFrame function; ``Ingestion`` adds the tables around it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millsight.contracts import LINEAGE, LOAD_ORDER, Contract, Horizon, Reference, contracts
from millsight.operators.keys import (
    flag_rows,
    flag_unresolved,
    held_keys,
    key_profile,
    unseen_files,
)
from millsight.operators.quality import (
    Issue,
    column_issues,
    duplicate_issue,
    hold_raw,
    issue_text,
    named_entries,
    quoted,
    raw_record,
    reference_issue,
    rule_issues,
    safe_casts,
    violations,
)
from millsight.session import remove_folder, work_folder
from millsight.sources.catalog import Lake
from millsight.sources.key_index import KeyIndex
from millsight.sources.landing import list_files, scan_new_files

Settle = Callable[[DataFrame, str], DataFrame]
#: Accepted rows, or what finds those of them that may hold one of the given keys.
Held = DataFrame | Callable[[DataFrame], DataFrame]


def _as_is(frame: DataFrame, name: str) -> DataFrame:
    return frame


def _held(held: Held, profile: DataFrame) -> DataFrame:
    return held if isinstance(held, DataFrame) else held(profile)


def type_batch(raw: DataFrame, contract: Contract) -> DataFrame:
    """Contract columns cast safely, next to the untouched source columns."""
    held = hold_raw(raw)
    casts = safe_casts(contract, raw.columns)
    return held.selectExpr(*[f"{cast} AS `{name}`" for name, cast in casts.items()], *held.columns)


def check_batch(
    raw: DataFrame,
    contract: Contract,
    stored: Held | None = None,
    parents: Mapping[str, Held] | None = None,
    settle: Settle = _as_is,
) -> DataFrame:
    """Typed rows with all their violations.

    Adds ``_errors`` (array of code and message in the order columns, rules, duplicates,
    references), ``_accepted`` and, for rejected rows, ``_original_record``: the source row as JSON,
    taken before any cast and with its NULLs.

    ``stored`` holds accepted rows of earlier batches; ``parents`` the accepted parent rows by table
    name (references to other tables are skipped). Either may be a function that takes the batch's
    distinct keys and returns the rows that may hold them, so that the cost follows the batch.
    ``settle`` may write a small intermediate relation (violating keys, the keys of a dimension) and read it
    back: its measured size then lets Spark broadcast it, and the wide rows pass from the scan to the output
    without a shuffle.
    """
    casts = safe_casts(contract, raw.columns)
    typed = type_batch(raw, contract)

    # Generators of one row: filters on what they make stay above them, so each value is cast once a row however
    # many rules read it, and all rules are judged once however often a filter reads the result. What a row alone
    # shows is judged before the joins: behind them a query needs the columns of its output only, and the others
    # are not shuffled.
    cast_all = ", ".join(f"{quoted(name)}, {cast}" for name, cast in casts.items())
    checked = hold_raw(raw).selectExpr("*", f"inline(array(named_struct({cast_all})))")
    issues = [*column_issues(contract, raw.columns), *rule_issues(contract)]
    checked = checked.selectExpr("*", f"explode(array({violations(issues)})) AS _judged")

    profile = key_profile(typed, contract.key)
    if stored is not None:  # read twice
        profile = settle(profile, "keys")
    repeated = profile.filter("rows > 1")
    if stored is not None:
        single = profile.filter("rows = 1")
        repeated = repeated.unionByName(held_keys(single, contract.key, _held(stored, profile)))
    repeated = settle(repeated, "duplicate_keys")
    checked = flag_rows(checked, repeated, contract.key, "_duplicate")

    parents = parents or {}
    references = [r for r in contract.references if r.parent in parents]
    joined = [duplicate_issue(contract, "_duplicate")]
    for number, reference in enumerate(references):
        parent = parents[reference.parent]
        flag = f"_unresolved_{number}"
        if reference.large_parent:
            profile = key_profile(typed, reference.columns)
            if not isinstance(parent, DataFrame):  # read twice
                profile = settle(profile, f"reference_keys_{number}")
            named = profile.toDF(*reference.parent_columns, "rows")
            known = _held(parent, named)
            lost = held_keys(profile, reference.columns, known, reference.parent_columns, held=False)
            lost = settle(lost, f"reference_{number}")
            checked = flag_rows(checked, lost, reference.columns, flag)
        else:
            known = settle(parent.select(*reference.parent_columns).distinct(), f"parent_keys_{number}")
            checked = flag_unresolved(checked, reference.columns, known, reference.parent_columns, flag)
        joined.append(reference_issue(reference, flag))

    both = f"_judged | {violations(joined, len(issues))}"
    checked = checked.selectExpr("*", f"explode(array({both})) AS _violated")
    issues += joined
    record = F.expr(f"CASE WHEN _violated <> 0 THEN {raw_record(raw.columns)} END")
    return checked.select(
        *contract.columns,
        "_source_file",
        named_entries(issues, "_violated").alias("_errors"),
        (F.col("_violated") == 0).alias("_accepted"),
        record.alias("_original_record"),
    )


def accepted_rows(checked: DataFrame, contract: Contract) -> DataFrame:
    return checked.filter("_accepted").select(*contract.columns, "_source_file")


def quarantined_rows(checked: DataFrame, contract: Contract) -> DataFrame:
    codes, messages = issue_text("_errors")
    return checked.filter(~F.col("_accepted")).select(
        F.lit(contract.name).alias("table_name"),
        F.col("_original_record").alias("original_record"),
        "_source_file",
        codes.alias("_error_code"),
        messages.alias("_error_message"),
    )


def file_audit(checked: DataFrame, contract: Contract) -> DataFrame:
    """Source, valid and quarantined rows of each file, in one pass."""
    counts = checked.groupBy(F.col("_source_file").alias("source_file")).agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.count_if("_accepted").alias("valid_rows"),
        F.count_if(~F.col("_accepted")).alias("quarantined_rows"),
    )
    return counts.select(F.lit(contract.name).alias("table_name"), "*", F.lit("SUCCESS").alias("status"))


def new_batch_id() -> str:
    return f"bronze-{datetime.now(timezone.utc):%Y%m%dT%H%M%SZ}-{uuid4().hex[:8]}"


@dataclass
class Ingestion:
    """Loads new files of every table, parents first.

    Per table: scan, check once, stage the checked rows in the shared work folder, then write
    quarantine, Bronze and audit from the staged copy. An attempt is entered in the log before its
    first write and struck out after its last one; its audit rows are the commit. The next run finds
    the attempts that never ended in the log: it drops the partitions of those without audit and
    finishes the key index of the others, so a run that died anywhere can simply be repeated, and no
    run looks at batches that ended.

    Keys of committed fact rows are kept in a :class:`KeyIndex`: duplicate and parent checks read the
    months and slices a batch touches, not the history.
    """

    lake: Lake
    source: str
    batch_id: str = ""
    horizon: Horizon = field(default_factory=Horizon)

    def __post_init__(self) -> None:
        self.batch_id = self.batch_id or new_batch_id()
        if not re.fullmatch(r"[A-Za-z0-9._-]+", self.batch_id):
            raise ValueError(f"batch id {self.batch_id!r} is not usable as a partition name")
        self.contracts = contracts(self.horizon)

    @property
    def spark(self) -> SparkSession:
        return self.lake.spark

    def run(self) -> dict[str, dict[str, int]]:
        """Rows read, accepted and rejected by table."""
        self.lake.bootstrap()
        return {name: self.ingest(name) for name in LOAD_ORDER}

    def ingest(self, name: str) -> dict[str, int]:
        """Load the files of one table that have no successful audit entry."""
        listed = list_files(self.spark, self.source, name)
        fresh = unseen_files(listed, self.spark.table(self.lake.audit), name)
        return self.load(name, scan_new_files(self.spark, self.source, name, fresh))

    def load(self, name: str, raw: DataFrame | None) -> dict[str, int]:
        """Check and store rows that carry their ``_source_file``; rows of known files are skipped."""
        contract = self.contracts[name]
        target = self.lake.name("bronze", name)
        self.lake.create(target, contract.ddl, ("_batch_id",))
        self.recover(name)
        if raw is not None:
            raw = unseen_files(raw, self.spark.table(self.lake.audit), name)
        if raw is None or raw.isEmpty():
            return {"source": 0, "valid": 0, "quarantined": 0, "skipped": 1}
        if self._is_committed(name, self.batch_id):
            raise ValueError(f"batch id {self.batch_id} was used for {name} already")

        parents = {r.parent: self._parent(r) for r in contract.references}
        stored = self._stored(name)
        self.lake.begin(name, self.batch_id)
        # A folder of this attempt alone: another attempt or another lake may use the same batch id.
        stage = f"{work_folder(self.spark)}/ingest/{self.batch_id}/{name}-{uuid4().hex}"

        def settle(frame: DataFrame, part: str) -> DataFrame:
            frame.write.parquet(f"{stage}/{part}")
            return self.spark.read.schema(frame.schema).parquet(f"{stage}/{part}")

        checked = check_batch(raw, contract, stored, parents, settle).withColumn("_ingested_at", F.current_timestamp())
        checked.write.parquet(f"{stage}/checked")
        staged = self.spark.read.schema(checked.schema).parquet(f"{stage}/checked")

        batch = F.lit(self.batch_id).alias("_batch_id")
        rejected = quarantined_rows(staged, contract)
        rejected = rejected.select("*", batch, F.current_timestamp().alias("_quarantined_at"))
        self.lake.replace_partitions(rejected, self.lake.quarantine)
        accepted = staged.filter("_accepted").select(
            *contract.columns, *[c for c in LINEAGE if c != "_batch_id"], batch
        )
        self.lake.replace_partitions(accepted, target)
        audit = file_audit(staged, contract)
        audit = audit.select("*", batch.alias("batch_id"), F.current_timestamp().alias("processed_at"))
        self.lake.append(audit, self.lake.audit)
        for index in self.indexes(name):
            index.add(accepted)
        self.lake.end(name, self.batch_id)

        counts = staged.agg(F.count(F.lit(1)), F.count_if("_accepted")).first()
        remove_folder(self.spark, stage)
        source, valid = counts[0], counts[1]
        return {"source": source, "valid": valid, "quarantined": source - valid, "skipped": 0}

    def indexes(self, name: str) -> list[KeyIndex]:
        """Of a fact table: its key and the columns that other tables refer to."""
        if not name.startswith("fact_"):
            return []
        wanted = [self.contracts[name].key]
        for contract in self.contracts.values():
            for reference in contract.references:
                if reference.large_parent and reference.parent == name:
                    wanted.append(reference.parent_columns)
        contract = self.contracts[name]
        return [KeyIndex(self.lake, contract, columns, self.horizon) for columns in dict.fromkeys(wanted)]

    def _stored(self, name: str) -> Held:
        found = self.indexes(name)
        return found[0].near if found else self.lake.table("bronze", name)

    def _parent(self, reference: Reference) -> Held:
        for index in self.indexes(reference.parent):
            if reference.large_parent and index.columns == reference.parent_columns:
                return index.near
        return self.lake.table("bronze", reference.parent)

    def _is_committed(self, name: str, batch_id: str) -> bool:
        done = (F.col("table_name") == name) & (F.col("batch_id") == batch_id)
        return not self.spark.table(self.lake.audit).filter(done).isEmpty()

    def recover(self, name: str) -> None:
        """Settle the attempts at one table that the log has as not ended."""
        target = self.lake.name("bronze", name)
        for index in self.indexes(name):
            index.prepare(self.spark.table(target))
        for batch in self.lake.open_attempts(name):
            if self._is_committed(name, batch):
                for index in self.indexes(name):
                    index.add(self.spark.table(target).filter(F.col("_batch_id") == batch))
            else:
                for table, also in ((target, ""), (self.lake.quarantine, f"table_name='{name}', ")):
                    self.spark.sql(
                        f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({also}_batch_id='{batch}')"
                    )
            self.lake.end(name, batch)
