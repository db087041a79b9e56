from __future__ import annotations

import csv
import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL

from claimtide.plans.build import build, materialize, refresh, register_views
from claimtide.schemas import CATEGORY_HIERARCHY, MART_TABLES
from claimtide.session import scratch_path
from claimtide.sources import tables
from claimtide.sources.history import read_history
from claimtide.sources.seeds import category_hierarchy, currency_rates
from claimtide.sources.testdata import testdata_history as adapted_history


def test_seed_csv_keeps_leading_spaces(spark):
    d = tempfile.mkdtemp(prefix="claimtide-seed-")
    path = os.path.join(d, "seed_category_hierarchy.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("sort_order,display_label,indent_level,tier1_filter,tier_match_value\n")
        for row in CATEGORY_HIERARCHY:
            f.write(",".join("" if v is None else str(v) for v in row) + "\n")
    got = [tuple(r) for r in category_hierarchy(spark, path).orderBy("sort_order").collect()]
    assert got == list(CATEGORY_HIERARCHY)
    rates = {r.currency_code: str(r.rate_to_usd) for r in currency_rates(spark).collect()}
    assert rates == {"USD": "1.000000000", "CAD": "0.700000000"}


def test_materialize_matches_lazy_graph(spark):
    raw_path = scratch_path(spark, "raw")
    adapted_history(spark, SF_SMALL).write.parquet(raw_path)
    raw = read_history(spark, raw_path)
    rates = currency_rates(spark)
    base = scratch_path(spark, "warehouse")
    paths = materialize(spark, raw, rates, base)
    graph = build(raw, rates)
    for key, name in MART_TABLES:
        written = tables.read_mart(spark, base, name)
        assert sorted(written.columns) == sorted(graph[key].columns), name
        assert written.count() == graph[key].count(), name
    assert set(paths) == {name for _k, name in MART_TABLES} | {"int_claims_classified", "int_claims_period_latest"}
    segments = tables.read_table(spark, paths["int_claims_period_latest"]).count()
    assert segments < tables.read_table(spark, paths["int_claims_classified"]).count()
    with pytest.raises(ValueError):
        tables.read_mart(spark, base, "not_a_mart")

    weekly_path = paths["mart_claims_weekly"]
    pruned = tables.read_month_range(spark, weekly_path, "week_end_date", "1996-03-15", "1997-06-30")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "partition_month" in plan
    expected = graph["weekly"].where("week_end_date between date'1996-03-15' and date'1997-06-30'").count()
    assert pruned.count() == expected

    for options in ({"marts_from_history": True},):
        other = scratch_path(spark, "warehouse_variant")
        materialize(spark, raw, rates, other, **options)
        for _key, name in MART_TABLES:
            a = tables.read_mart(spark, base, name)
            b = tables.read_mart(spark, other, name).select(*a.columns)
            assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, (name, options)

    names = register_views(spark, graph)
    assert spark.sql(f"SELECT count(*) FROM {names['weekly_metrics']}").first()[0] == graph["weekly_metrics"].count()


def test_refresh_replaces_names_in_the_catalog(spark):
    raw = adapted_history(spark, SF_SMALL)
    base = scratch_path(spark, "catalog")
    first = refresh(spark, raw, currency_rates(spark), category_hierarchy(spark), base, "t_")
    before = tables.read_mart(spark, None, "mart_claims_current", "t_")
    rows = before.count()
    half = raw.where("claim_number like '%1 '")
    second = refresh(spark, half, currency_rates(spark), category_hierarchy(spark), base, "t_")
    after = tables.read_mart(spark, None, "mart_claims_current", "t_")
    assert set(first) == set(second) and not set(first.values()) & set(second.values())
    assert tables.MONTH_PARTITION not in spark.table("t_marts.mart_claims_weekly").columns
    assert 0 < after.count() < rows
    assert tables.read_table(spark, first["mart_claims_current"]).count() == rows  # a reader of the old one keeps it
    assert spark.table("t_seeds.seed_category_hierarchy").count() == len(CATEGORY_HIERARCHY)
    assert spark.table("t_staging.stg_insurance_claims").count() == half.count()
    assert spark.table("t_intermediate.int_claims_classified").count() == half.count()


def test_current_mart_is_clustered_by_range(spark):
    path = scratch_path(spark, "clustered")
    df = spark.range(20_000).selectExpr("format_string('CLM-%06d', (id * 7919) % 20000) as claim_number", "id")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_clustered(df, path, ["claim_number"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    ranges = sorted(
        spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("claim_number"), F.max("claim_number")).collect(), key=lambda r: r[1]
    )
    assert len(ranges) > 1 and all(a[2] < b[1] for a, b in zip(ranges, ranges[1:]))


def test_csv_is_what_other_readers_take(spark):
    rows = [(1, 'say "hi", ok'), (2, " edge "), (3, "two\nlines"), (4, ""), (5, None), (6, "a\\b"), (7, "\t")]
    path = scratch_path(spark, "csv")
    df = spark.createDataFrame(rows, "n long, Text string")
    tables.write_csv(df, path, single_file=True)
    (name,) = glob.glob(f"{path}/*.csv")
    with open(name, encoding="utf-8", newline="") as f:
        got = list(csv.reader(f))
    assert got == [["n", "Text"], *([str(n), t or ""] for n, t in rows)]
    assert sorted(map(tuple, tables.read_csv(spark, path, df.schema).collect())) == rows


def test_currency_seed_from_csv(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="claimtide-seed-"), "rates.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("currency_code,currency_name,rate_to_usd\nEUR,Euro,1.08\nUSD,US Dollar,1.00\n")
    assert {r.currency_code: str(r.rate_to_usd) for r in currency_rates(spark, path).collect()} == {"EUR": "1.080000000", "USD": "1.000000000"}
