"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import os
import sys
from collections import Counter

import pytest

from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_contract import duck, rows_of  # noqa: E402

from claimtide.plans.contract import QUERIES as CONTRACT  # noqa: E402

SQL = entry.oracle_sql()
QUERIES = {name: entry.queries()[name] for name in CONTRACT}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


#: their columns depend on the data; checked through their long forms
WIDE = {"review_weekly_count", "review_monthly_value", "review_monthly_count"}


def test_every_query_has_an_oracle():
    assert set(QUERIES) - WIDE <= set(SQL) and all(f"{name}_long" in SQL for name in WIDE)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WIDE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    a, ac = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(SQL[name])
    b, bc = rows_of([d[0] for d in res.description], res.fetchall())
    assert ac == bc
    assert len(a) == len(b)
    assert Counter(a) == Counter(b)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "claim_count" in df.columns


@pytest.mark.parametrize("name", ["review_weekly_count", "review_monthly_value", "review_monthly_count"])
def test_default_review_is_the_pivot_of_its_long_form(spark, con, name):
    """The wide review's columns depend on the data, so its oracle is the long
    form's, pivoted here."""
    res = con.execute(SQL[f"{name}_long"])
    at = [d[0] for d in res.description]
    rows = [dict(zip(at, r)) for r in res.fetchall()]
    df = QUERIES[name](spark, SF_SMALL)
    labels = sorted({r["period_label"] for r in rows})
    assert df.columns[1:-1] == labels
    got = Counter((r[0], r[-1], label, float(r[label])) for r in df.collect() for label in labels)
    assert got == Counter((r["waterfall"], r["comparison"], r["period_label"], r["value"]) for r in rows)
