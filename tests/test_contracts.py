from datetime import date

import pytest

from millsight.contracts import LINEAGE, LOAD_ORDER, Horizon, contracts
from millsight.functions.metrics import METRICS, PRODUCTION_RATES
from millsight.plans.bronze import new_batch_id

CONTRACTS = contracts()


def test_nine_tables_parents_first():
    assert tuple(CONTRACTS) == LOAD_ORDER and len(LOAD_ORDER) == 9
    for name, contract in CONTRACTS.items():
        for reference in contract.references:
            assert LOAD_ORDER.index(reference.parent) < LOAD_ORDER.index(name)
            assert set(reference.parent_columns) <= set(CONTRACTS[reference.parent].columns)


@pytest.mark.parametrize("name", LOAD_ORDER)
def test_keys_and_references_use_contract_columns(name):
    contract = CONTRACTS[name]
    assert contract.key and set(contract.key) <= set(contract.columns)
    assert len(set(contract.columns)) == len(contract.columns)
    assert all(set(r.columns) <= set(contract.columns) for r in contract.references)


def test_rule_and_reference_counts():
    assert sum(len(c.rules) for c in CONTRACTS.values()) == 15
    assert sum(len(c.references) for c in CONTRACTS.values()) == 11
    optional = [(c.name, f.name) for c in CONTRACTS.values() for f in c.fields if f.optional]
    assert optional == [("fact_quality_event", "supplier_id")]


def test_horizon_is_a_parameter():
    assert "DATE'2026-01-01' AND DATE'2026-06-30'" in CONTRACTS["dim_date"].rules[0].holds
    other = contracts(Horizon(date(1999, 1, 1), date(1999, 12, 31)))
    assert "1999-12-31" in other["fact_production"].rules[0].holds


def test_lineage_and_batch_ids():
    assert LINEAGE == ("_ingested_at", "_source_file", "_batch_id")
    assert new_batch_id().startswith("bronze-") and new_batch_id() != new_batch_id()


def test_metric_registry():
    assert set(PRODUCTION_RATES) <= set(METRICS)
    assert METRICS["dppm"].scale == 1_000_000 and METRICS["yield_loss"].complement
