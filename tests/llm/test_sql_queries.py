"""Queries with SQL against that SQL."""

from __future__ import annotations

import pytest

from millsight.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_sql(spark, folder, database, name):
    found = QUERIES[name](spark, folder)
    columns = sorted(found.columns)
    rows = [tuple(r) for r in found.select(*columns).collect()]
    result = database.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    wanted = [tuple(row[i] for i in places) for row in result.fetchall()]
    assert sorted(map(str, rows)) == sorted(map(str, wanted))
