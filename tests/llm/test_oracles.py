"""Queries that SQL can express, against DuckDB."""

from __future__ import annotations

import os
import sys
from collections import Counter

import pytest

from claimtide.llm.registry import QUERIES, SQL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    from check_contract import duck, rows_of

    # quality cutoffs need enough labels to reject anything
    sf = "/root/testdata/sf0.1" if name.startswith("op5") else "/root/testdata/sf0.001"
    df = QUERIES[name](spark, sf)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = duck(sf).execute(SQL[name])
    want = rows_of([d[0] for d in res.description], res.fetchall())
    assert got[1] == want[1] and Counter(got[0]) == Counter(want[0])
    if name.startswith("op5"):
        assert any("symbols" in r[got[1].index("failed_rules")] for r in got[0])
