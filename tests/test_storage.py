"""Layout, measures and versions of written tables."""

from __future__ import annotations

import csv
import glob
import re
import time

import pyarrow.parquet as pq
import pytest
from conftest import SF_SMALL, raw_rows, snapshot
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimtide.operators import extracts as X
from claimtide.operators import quality as Q
from claimtide.operators.periods import MONTHLY, WEEKLY, latest_per_segment, period_state
from claimtide.plans.build import SEGMENT_ORDER, build, materialize, measured_checks, refresh
from claimtide.schemas import MART_TABLES
from claimtide.session import scratch_path
from claimtide.sources import search as S
from claimtide.sources import tables, versions
from claimtide.sources.seeds import category_hierarchy, currency_rates
from claimtide.sources.testdata import testdata_history as adapted_history


@pytest.fixture(scope="module")
def stored(spark):
    """(base folder, raw history, lazy models) of one full build."""
    path = scratch_path(spark, "raw")
    adapted_history(spark, SF_SMALL).write.parquet(path)
    raw = spark.read.parquet(path)
    base = scratch_path(spark, "stored")
    materialize(spark, raw, currency_rates(spark), base)
    return base, raw, build(raw, currency_rates(spark))


# -- value ranges inside a month ---------------------------------------------------


def footer_ranges(path: str, column: str) -> list[tuple[str, str]]:
    out = []
    for name in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.names.index(column)
        stats = [meta.row_group(k).column(at).statistics for k in range(meta.num_row_groups)]
        out.append((min(s.min for s in stats), max(s.max for s in stats)))
    return sorted(out)


def test_files_of_a_big_month_hold_disjoint_ranges(spark):
    """Two thirds of the rows lie in one month: its files' statistics part."""
    df = spark.range(30_000).selectExpr(
        "format_string('CLM-%06d', (id * 7919) % 30000) as claim_number",
        "case when id % 3 < 2 then date'2024-05-01' + cast(id % 30 as int) else date'2024-01-01' + cast(id % 120 as int) end as day",
    )
    path = scratch_path(spark, "ranged")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_partitioned(df, path, "day", ["claim_number"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ranges = footer_ranges(f"{path}/{tables.MONTH_PARTITION}=2024-05-01", "claim_number")
    assert len(ranges) > 2 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))
    month = tables.read_month_range(spark, path, "day", "2024-05-01", "2024-05-31")
    assert month.count() == df.where("day between '2024-05-01' and '2024-05-31'").count()


# -- buckets by claim --------------------------------------------------------------


def test_rank_and_lag_read_the_buckets_without_an_exchange(spark, stored):
    base, _, graph = stored
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = tables.layer_path(base, tables.INTERMEDIATE, "int_claims_period_latest")
    with tables.bucketed_table(spark, path, *SEGMENT_ORDER, buckets) as segments:
        for key, grain in (("weekly", WEEKLY), ("monthly", MONTHLY)):
            state = period_state(segments, grain)
            plan = state._jdf.queryExecution().executedPlan().toString()
            assert "Window" in plan and "Exchange" not in plan and "Bucketed: true" in plan
            want = graph[key].select(*state.columns)
            assert state.exceptAll(want).isEmpty() and want.exceptAll(state).isEmpty()
    assert len(glob.glob(f"{path}/*.parquet")) <= buckets
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def test_a_hot_claim_has_a_row_per_segment_in_its_bucket(spark):
    rows = [snapshot("HOT", f"2024-{1 + k % 12:02d}-{1 + k % 28:02d}", "Open") for k in range(600)]
    raw = raw_rows(spark, rows + [snapshot(f"C{k}", "2024-01-01", "Open") for k in range(50)])
    classified = build(raw, currency_rates(spark))["classified"]
    path = scratch_path(spark, "hot")
    tables.write_bucketed(latest_per_segment(classified), path, *SEGMENT_ORDER, 4)
    assert spark.read.parquet(path).where("claim_number = 'HOT'").count() <= 53 + 12


# -- counts and checks taken in the write ------------------------------------------


def jobs_of(spark, name, action):
    spark.sparkContext.setJobGroup(name, name)
    try:
        out = action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_an_export_counts_its_rows_in_one_job(spark, stored):
    base, _, _ = stored
    extract = X.claims_extract(tables.read_mart(spark, base, "mart_claims_current"), country=["US"])
    path = scratch_path(spark, "export")
    caption, jobs = jobs_of(spark, "one-job", lambda: X.export(extract, path, "claims"))
    n = extract.count()
    assert n > 0 and caption == f"{n:,} matching claims" == X.matching_caption(extract, "claims") and jobs == 1
    assert tables.read_csv(spark, path, extract.schema).count() == n
    assert X.export(extract.limit(0), scratch_path(spark, "none"), "claims") == "0 matching claims"


def test_checks_are_measured_while_tables_are_written(spark, stored):
    base, raw, _ = stored
    found = {key: tables.read_mart(spark, base, name) for key, name in MART_TABLES}
    found |= {Q.SOURCE: raw, Q.CLASSIFIED: tables.read_table(spark, tables.layer_path(base, tables.INTERMEDIATE, "int_claims_classified"))}
    measured = measured_checks(spark, base)
    rows = lambda df: sorted(map(tuple, df.collect()))
    plain = Q.run_checks(found)
    assert rows(Q.run_checks(found, measured=measured)) == rows(plain)
    row_level = {c.name for c in Q.CHECKS if c.table in found and c.table != Q.SOURCE and (c.kind in ("not_null", "between") or c.name == "assert_all_claims_classified")}
    assert row_level <= {r.check_name for r in measured.collect()}
    scans = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
    assert scans(Q.run_checks(found, measured=measured)) < scans(plain)


def test_measured_failures_equal_a_pass_of_their_own(spark):
    rows = [snapshot("A", "2024-01-01", "Open", value_of_trailer="-5"), snapshot("A", "2024-01-01", "Odd"), snapshot("B", "2024-02-01", "Odd", value_of_trailer="-7"), snapshot("C", "2024-03-01", None)]
    base = scratch_path(spark, "failing")
    paths = materialize(spark, raw_rows(spark, rows), currency_rates(spark), base)
    found = {key: tables.read_mart(spark, base, name) for key, name in MART_TABLES} | {Q.CLASSIFIED: tables.read_table(spark, paths["int_claims_classified"])}
    plain = {r.check_name: r.failing_rows for r in Q.run_checks(found).collect()}
    assert {r.check_name: r.failing_rows for r in Q.run_checks(found, measured=measured_checks(spark, base)).collect()} == plain
    assert plain["between:classified:value_usd"] == 2


# -- one version of all names ------------------------------------------------------


def test_all_names_show_one_refresh_at_every_step(spark, monkeypatch):
    """All names are read after every single change of a view and after the
    commit: they show the old refresh, then the new one, never both."""
    base, prefix = scratch_path(spark, "versions"), f"v{time.time_ns()}_"
    rates, categories = currency_rates(spark), category_hierarchy(spark)
    history = lambda *claims: raw_rows(spark, [snapshot(c, d, "Open") for c in claims for d in ("2024-01-01", "2024-02-09")])
    refresh(spark, history("A"), rates, categories, base, prefix)
    names = {name: layer for name, layer in versions.open_version(spark, base).layers.items() if name.startswith(("mart_claims", "stg_", "int_claims_classified"))}

    def shown():
        """Claims that each name shows, as the number of its distinct values."""
        out = {}
        for name, layer in names.items():
            df = spark.table(f"{prefix}{layer}.{name}")
            out[name] = df.select("claim_number").distinct().count() if "claim_number" in df.columns else df.agg(F.sum("claim_count")).first()[0] // 2
        return set(out.values())

    assert shown() == {1}
    seen = []
    view, commit = versions._view, versions.commit

    def watched_view(*args):
        view(*args)
        if args[2] in ("mart_claims_weekly", "mart_claims_current", "stg_insurance_claims"):
            seen.append(shown())

    def watched_commit(*args):
        number = commit(*args)
        seen.append(shown())
        return number

    monkeypatch.setattr(versions, "_view", watched_view)
    monkeypatch.setattr(versions, "commit", watched_commit)
    refresh(spark, history("A", "B"), rates, categories, base, prefix)
    assert all(len(s) == 1 for s in seen) and seen[0] == {1} and seen[-1] == {2}
    # a statement over several names takes one version
    joined = spark.sql(f"SELECT count(DISTINCT w.claim_number), count(DISTINCT c.claim_number) FROM `{prefix}marts`.mart_claims_weekly w FULL JOIN `{prefix}marts`.mart_claims_current c USING (claim_number)")
    assert tuple(joined.first()) == (2, 2)

    # a crash before the commit leaves the old refresh, the next one goes on
    monkeypatch.setattr(versions, "_view", view)
    monkeypatch.setattr(versions, "commit", lambda *_: (_ for _ in ()).throw(OSError()))
    with pytest.raises(OSError):
        refresh(spark, history("A"), rates, categories, base, prefix)
    assert shown() == {2} and versions.open_version(spark, base).number == 2
    # one after it the new
    monkeypatch.setattr(versions, "commit", commit)
    monkeypatch.setattr(versions, "settle", lambda *_: (_ for _ in ()).throw(OSError()))
    with pytest.raises(OSError):
        refresh(spark, history("A", "B", "C"), rates, categories, base, prefix)
    assert shown() == {3}
    monkeypatch.undo()
    refresh(spark, history("A"), rates, categories, base, prefix)
    assert shown() == {1}
    old, new = versions.open_version(spark, base, 3), versions.open_version(spark, base)
    assert (old.number, new.number) == (3, 4) and old["mart_claims_current"].count() == 3 and new["mart_claims_current"].count() == 1
    new.register_views()
    assert spark.table("mart_claims_current").count() == 1
    assert versions.open_version(spark, scratch_path(spark, "none")) is None


def test_a_second_writer_of_one_version_is_refused(spark, monkeypatch):
    base = scratch_path(spark, "writers")
    opened = versions.open_version

    def late(*args):
        found = opened(*args)
        monkeypatch.setattr(versions, "open_version", opened)
        versions.commit(spark, base, {"t": "marts"}, {"t": "/one"})  # meanwhile
        return found

    monkeypatch.setattr(versions, "open_version", late)
    with pytest.raises(RuntimeError):
        versions.commit(spark, base, {"t": "marts"}, {"t": "/two"})


# -- one ordered file from many tasks ----------------------------------------------


def test_an_ordered_export_is_one_file_of_many_tasks(spark):
    rows = [(k % 97, f'{k}, "x"' if k % 3 else " edge\nline é ", None if k % 5 else "") for k in range(5000)]
    df = spark.createDataFrame(rows, 'n int, `Text, "quoted"` string, other string').repartition(9)
    path = scratch_path(spark, "one") + ".csv"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered = df.orderBy(F.desc("n"))
        assert ordered.rdd.getNumPartitions() > 3
        n = tables.write_csv_file(ordered, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    with open(path, encoding="utf-8", newline="") as f:
        got = list(csv.reader(f))
    assert n == 5000 and got[0] == ["n", 'Text, "quoted"', "other"]
    assert [int(r[0]) for r in got[1:]] == sorted((r[0] for r in rows), reverse=True)
    assert sorted(tuple(r) for r in got[1:]) == sorted((str(a), b, c or "") for a, b, c in rows)
    assert not glob.glob(f"{path}.parts*")
    assert tables.write_csv_file(df.limit(0), path) == 0
    with open(path, encoding="utf-8") as f:
        assert f.read() == 'n,"Text, ""quoted""",other\n'


def test_transitions_come_newest_first(spark, stored):
    base, _, graph = stored
    extract = X.transitions_extract(tables.read_mart(spark, base, "mart_claim_transitions_weekly"))
    path = scratch_path(spark, "transitions") + ".csv"
    n = tables.write_csv_file(extract, path)
    with open(path, encoding="utf-8", newline="") as f:
        got = list(csv.DictReader(f))
    assert n == len(got) == graph["weekly_transitions"].count() > 0
    days = [r["Week End Date"] for r in got]
    assert days == sorted(days, reverse=True)


# -- claim search by trigrams --------------------------------------------------------


def test_a_search_reads_the_files_that_may_match(spark):
    path = scratch_path(spark, "marts") + "/mart_claims_current"
    df = spark.range(20_000).selectExpr("format_string('CLM-%05d', id) as claim_number", "id")
    odd = spark.createDataFrame([("\u212aELV\u0130N-\u017fz1", 1), ("Ab", 2), (None, 3), ("", 4)], "claim_number string, id long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_clustered(df.union(odd), path, ["claim_number"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    whole = spark.read.parquet(path)
    everywhere = len(whole.inputFiles())
    assert S.files_for(spark, path, "12345") is None  # no index yet
    S.build_index(spark, path)
    for search, literal, few in (("12345", False, True), ("clm-0012", False, True), ("kelvin-s", False, True), (r"clm-\d*7", False, False), ("12", False, False), ("clm-001(2|3)", False, False), ("clm-0012", True, True), ("nothing", True, True), (r"^clm-199\d+$", False, True), ("clm-1999+", False, True), ("clm-19999*", False, True), ("[cC]LM-12[3-4]00", False, True), ("", False, False)):
        rows = S.read_for_search(spark, path, search, literal)
        found = X.filter_claims(rows, search=search, literal=literal)
        want = X.filter_claims(whole, search=search, literal=literal)
        assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, want.collect()), key=str), search
        assert (len(rows.inputFiles()) < everywhere) == few, search


@pytest.mark.parametrize(
    "search, grams",
    [("abc", ["abc"]), ("abcd", ["abc", "bcd"]), ("AbC", ["abc"]), ("ab.cd", []), ("abcd?", ["abc"]), ("abcd*e", ["abc"]), ("abcd+efg", ["abc", "bcd", "efg"]), ("abcd{0,2}", ["abc"]), (r"abc\d", ["abc"]), (r"\Qabc", []), ("abc|def", []), ("(?x)abc", []), ("a[bc]def", ["def"]), ("[^abc]", []), ("abc[", []), ("abé", [])],
)
def test_required_grams(search, grams):
    assert S.required_grams(search) == grams


def test_required_grams_of_literals():
    assert S.required_grams("a.b*", literal=True) == [".b*", "a.b"]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab.*+?[]{}1,^$\\-", max_size=9), st.text(alphabet="ab1-", max_size=8))
def test_grams_are_in_every_match(search, text):
    try:
        pattern = re.compile(search, re.IGNORECASE)
    except (re.error, OverflowError, FutureWarning):
        return
    if pattern.search(text):
        assert all(g in text.lower() for g in S.required_grams(search)), (search, text)


@pytest.mark.parametrize("search", ["(a+)+", "(a|b)*c", "((ab)*c)+", "(x+y){2,}", r"(\d+-)*\d", "(?:a*)*$"])
def test_patterns_that_run_away_are_refused(spark, search):
    assert X.runs_away(search)
    with pytest.raises(ValueError):
        X.claim_search(search)


@pytest.mark.parametrize("search", ["clm-12", r"clm-\d*7", "a+b*c{2,}", "(ab)+", "(a|b)c+", r"\(a+\)+", "[(a+]+x", "(a+)?", "(a+){3}", "a|b+", "[^]a]+(b)", "(", "{,"])
def test_other_patterns_are_taken(search):
    assert not X.runs_away(search)


def test_a_refresh_leaves_a_search_table(spark):
    base, prefix = scratch_path(spark, "searchable"), f"s{time.time_ns()}_"
    raw = raw_rows(spark, [snapshot(f"CLM-{k:03d}", "2024-01-01", "Open") for k in range(40)])
    refresh(spark, raw, currency_rates(spark), category_hierarchy(spark), base, prefix)
    path = versions.open_version(spark, base).paths["mart_claims_current"]
    assert S.files_for(spark, path, "clm-7777") == [] and len(S.files_for(spark, path, "clm-017")) == 1
    found = X.filter_claims(S.read_for_search(spark, path, "M-017"), search="M-017")
    assert [r.claim_number for r in found.collect()] == ["CLM-017"]

