"""Steps whose memory or disk must not grow faster than their input."""

from __future__ import annotations

import glob
import os
import random
import re
import time
from datetime import date
from decimal import Decimal, localcontext

from conftest import SF_SMALL, raw_rows, snapshot
from pyspark.sql import functions as F

from claimtide.functions.money import total
from claimtide.functions.text import DATE_TEXT, UNICODE_WHITESPACE, clean_text, safe_date, upper_text
from claimtide.operators import quality
from claimtide.operators.classify import classify, told_columns
from claimtide.operators.periods import MONTHLY, WEEKLY, latest_per_segment, period_state, period_state_from_staged, told_of_state
from claimtide.operators.staging import stage_claims
from claimtide.plans.build import build, materialize, shuffles_removed
from claimtide.plans.contract import (
    QUERIES,
    _checked,
    _metric_models,
    _models_of_stored,
    as_doubles,
    newest_later,
    q_monthly_metrics,
    q_weekly_metrics,
)
from claimtide.schemas import MART_TABLES, VALUE_TYPE
from claimtide.session import ensure_checkpoint_dir
from claimtide.sources import tables
from claimtide.sources.seeds import currency_rates
from claimtide.sources.testdata import testdata_history as adapted_history


def _plan(spark, frame) -> str:
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return frame()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_closed_dates_are_joined_without_sorting_the_history(spark):
    staged = stage_claims(raw_rows(spark, [snapshot("A", "2024-01-01", "Closed"), snapshot("A", "2024-01-09", "Open")]))
    rates = currency_rates(spark)
    for frame in (lambda: classify(staged, rates), lambda: period_state_from_staged(staged, rates, WEEKLY)):
        plan = _plan(spark, frame)
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert {(str(r.snapshot_date), r.wbr_tier1) for r in classify(staged, rates).collect()} == {
        ("2024-01-01", "CLOSED CASES"),
        ("2024-01-09", "RE-OPEN CLAIMS"),
    }


def test_generated_methods_are_compiled(spark):
    """Java leaves methods beyond 8,000 bytes to its interpreter."""
    as_codegen = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    graph = build(adapted_history(spark, SF_SMALL), currency_rates(spark))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for key in ("classified", "weekly", "monthly", "weekly_metrics"):
            text = graph[key]._jdf.queryExecution().explainString(as_codegen)
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
            assert sizes and max(sizes) < 8000, key
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_common_texts_take_the_short_way(spark):
    edges = ["", " ", "a", " a", "a ", "\u00a0a\u3000", "~", "!x~", "\x7f", "\x85a", "a\u200b", "a\x1f", "\x1fa", "ä", "ä ", "a b", None]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(edges)], "k int, t string")
    trimmed = F.trim("t", F.lit(UNICODE_WHITESPACE))
    assert frame.where(~clean_text("t").eqNullSafe(trimmed)).count() == 0
    words = ["usd", "USD", "straße", "ı", "i", "ǆ", "a1[z{", "", None]
    frame = spark.createDataFrame([(t,) for t in words], "t string")
    assert frame.where(~upper_text("t").eqNullSafe(F.upper("t"))).count() == 0
    days = ["2024-06-01", "2024-6-1", "2024-06-1T", "2024-06-1 ", " 2024-6-01", "2024-06-31", "2024-6--01", "2024-1T-01", "2024-06- 1", "+024-06-01", "\n024-06-01", "0000-01-01", "2024-06", "20240-6-01", "２024-06-01", "2024-06-01T", "202a-06-01", "2024-06-T1", None]
    frame = spark.createDataFrame([(t,) for t in days], "t string")
    told = F.when(F.col("t").rlike(DATE_TEXT), F.col("t").try_cast("date"))
    assert frame.where(~safe_date("t").eqNullSafe(told)).count() == 0


def test_metrics_run_the_history_once(spark):
    """F16, F17: the latest rows and the closed dates come from stored rows."""
    for query in (q_weekly_metrics, q_monthly_metrics):
        files = query(spark, SF_SMALL).inputFiles()
        assert files and not any("lineitem" in f or "orders" in f for f in files)
    rows = [
        snapshot("A", "2024-01-01", "Closed"),
        snapshot("A", "2024-01-09", "Open", currency=" cad ", value_of_trailer="100.00"),
        snapshot("\u00a0B ", "2024-01-09", None, value_of_trailer="7"),
        snapshot(" ", "2024-01-09", "Open"),
        snapshot("C", "2024-01-32", "Open"),
    ]
    raw, rates = raw_rows(spark, rows), currency_rates(spark)
    for key in ("weekly_metrics", "monthly_metrics"):
        stored = _metric_models(spark, raw)[key].collect()
        assert len(stored) >= 2 and sorted(map(str, stored)) == sorted(map(str, build(raw, rates)[key].collect()))


def test_claims_are_sorted_by_a_number(spark):
    """F16, F17: claim numbers often share their first eight bytes."""
    staged = stage_claims(raw_rows(spark, [snapshot("A", "2024-01-01", "Closed")]))
    plan = _plan(spark, lambda: period_state_from_staged(staged, currency_rates(spark), WEEKLY))
    sorts = [line for line in plan.splitlines() if "Sort [" in line]
    assert len(sorts) >= 3 and not any("Sort [claim_number" in line for line in sorts)


def test_common_numbers_are_added_up_whole(spark):
    """F16, F17: only numbers of more than 19 whole digits are cut into limbs."""
    texts = ["1.000000001", "-2.5", None, "9999999999999999999.999999999", "-10000000000000000000.000000001", "12345678901234567890123456789.1", "0"]
    for chosen in (texts, texts[:4], texts[4:6], [None], texts[::-1], ["-0.3", "-1" + "0" * 20]):
        exact = [Decimal(t) for t in chosen if t is not None]
        with localcontext() as context:
            context.prec = 60
            expected = sum(exact, Decimal(0)) if exact else None
        frame = spark.createDataFrame([(t,) for t in chosen], "t string").select(F.col("t").cast(VALUE_TYPE).alias("v"))
        assert frame.agg(total("v")).first()[0] == expected
    expression = spark.createDataFrame([], "v decimal(38,9)").agg(total("v"))._jdf.queryExecution().analyzed().toString()
    assert "try_cast(v" in expression


def test_buckets_stay_small():
    assert tables.buckets_for(0) == tables.buckets_for(600_000) == tables.LEAST_BUCKETS
    for rows in (36_000_000, 216_000_000):
        assert rows / tables.buckets_for(rows) <= tables.BUCKET_ROWS


def test_newest_later_line_by_blocks(spark):
    draw = random.Random(5)
    rows = [(at, draw.choice([None, 1, 2, 3, 50]) if at < 40 else draw.choice([None, 1, 2])) for at in range(60)]
    frame = spark.createDataFrame(rows, "at long, day int")
    got = {r["at"]: r["newest_later"] for r in newest_later(frame, "day", "at", bits=2).collect()}
    assert got == {at: max((d for a, d in rows if a > at and d is not None), default=None) for at, _ in rows}
    plan = _plan(spark, lambda: newest_later(frame, "day", "at", bits=2).select("at", "newest_later"))
    assert "hashpartitioning(_block" in plan



def test_a_written_step_leaves_no_shuffle_files(spark, tmp_path):
    store = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled() -> set[str]:
        return {name for name in store.getAllFiles().mkString("\n").split("\n") if "shuffle_" in name and name.endswith(".data")}

    before, kept = shuffled(), spark.range(1000).repartition(3, "id")
    with shuffles_removed(spark):
        kept.write.parquet(str(tmp_path / "t"))
    for _ in range(50):  # files are removed behind the job
        if not shuffled() - before:
            break
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.read.parquet(str(tmp_path / "t")).count() == kept.count() == 1000


def test_suites_run_the_history_once(spark):
    raw = adapted_history(spark, SF_SMALL)
    graph = _models_of_stored(spark, raw)
    for key in ("classified", "weekly", "monthly_metrics"):
        assert "l_partkey" not in _plan(spark, lambda key=key: graph[key])
    assert graph["monthly"].exceptAll(build(raw, currency_rates(spark))["monthly"]).count() == 0


def _odd_history(spark):
    rows = []
    for claim in ("A", "B", "C", "D"):
        for k, day in enumerate(("2024-01-01", "2024-01-03", "2024-01-09", "2024-01-30", "2024-02-01", "2024-02-29", "2024-03-31")):
            status = ("Closed", "Open", None, "Other")[(k + ord(claim)) % 4]
            results = ("Waiting For Reply From Insurance", None, "Not Liable")[k % 3]
            rows.append(snapshot(claim, day, status, insurance_claims_results=results, case_date_closed=day if k % 2 else None, currency=("cad", None)[k % 2], submitted=None if k == 3 else "2024-01-01"))
    return raw_rows(spark, rows)


def _same(a, b) -> bool:
    return a.columns == b.columns and a.count() == b.count() and a.exceptAll(b).count() == 0


def test_told_columns_are_those_left_out(spark):
    """shuffles leave out what follows from the rest of the row."""
    staged, rates = stage_claims(_odd_history(spark)), currency_rates(spark)
    table = classify(staged, rates)
    assert {"RE-OPEN CLAIMS", "ACTIVE CASES", "CLOSED CASES"} == {r[0] for r in table.select("wbr_tier1").distinct().collect()}
    frames = [(table, told_columns())]
    frames += [(period_state(table, grain), told_of_state(grain, ["week_end_date", "metric_year"])) for grain in (WEEKLY, MONTHLY)]
    for frame, told in frames:
        assert "claim_snapshot_key" in told and not {"week_end_date", "metric_year"} & set(told)
        left = frame.drop(*told)
        assert len(left.columns) == len(frame.columns) - len(told)
        assert _same(tables.telling(told, frame.columns)(left), frame)


def test_months_are_written_in_turns(spark, tmp_path):
    """a turn shuffles some months, each whole."""
    assert tables.turns_for(0) == tables.turns_for(tables.TURN_ROWS) == 1
    assert tables.turns_for(tables.TURN_ROWS + 1) == 2 and tables.turns_for(10**9) == tables.MOST_TURNS
    rows = [(f"C{k:03d}", date(2024, 1 + k % 7, 1 + k % 20), None if k % 5 == 0 else k) for k in range(300)]
    frame = spark.createDataFrame(rows, "claim_number string, day date, value int").withColumn("twice", F.col("value") * 2)
    told = {"twice": F.col("value") * 2}
    for turns in (1, 3, 9):
        measure, path = tables.Measure(nulls=F.count_if(F.col("twice").isNull())), str(tmp_path / str(turns))
        for _ in range(2):  # the second write replaces the first
            measure = tables.Measure(nulls=F.count_if(F.col("twice").isNull()))
            tables.write_partitioned(
                frame.drop("twice"), path, "day", ["claim_number"], measure=measure,
                finish=tables.telling(told, frame.columns), turns=turns,
            )
        assert (measure["rows"], measure["nulls"]) == (300, 60)
        assert _same(tables.read_table(spark, path), frame)
        for name in glob.glob(f"{path}/*/*.parquet"):
            claims = [r["claim_number"] for r in spark.read.parquet(name).collect()]
            assert claims == sorted(claims)
    none = str(tmp_path / "none")
    tables.write_partitioned(frame.limit(0), none, "day", ["claim_number"], turns=3)
    assert tables.read_table(spark, none).columns == frame.columns


def _steps(folder: str) -> set[str]:
    return {n for n in os.listdir(folder) if re.match(r"(staged|latest|thinned|state)-", n)}


def test_a_build_keeps_the_rows_of_no_step(spark, tmp_path, monkeypatch):
    """the history and the states run once, stored while they are used;
    neither they nor shuffles stay."""
    monkeypatch.setattr(tables, "TURN_ROWS", 5)
    store = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    stored = []
    now = tables.stored_for_now
    monkeypatch.setattr(tables, "stored_for_now", lambda df, path: stored.append(os.path.basename(path).split("-")[0]) or now(df, path))

    def shuffled() -> set[str]:
        return {name for name in store.getAllFiles().mkString("\n").split("\n") if "shuffle_" in name and name.endswith(".data")}

    raw, rates, before, base = _odd_history(spark), currency_rates(spark), shuffled(), str(tmp_path / "built")
    paths = materialize(spark, raw, rates, base)
    assert sorted(stored) == ["staged", "state", "state", "thinned"] and not _steps(base)
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.2)
    assert not shuffled() - before
    graph = build(raw, rates)
    for key, name in MART_TABLES:
        assert _same(tables.read_mart(spark, base, name), graph[key]), key
    assert _same(tables.read_table(spark, paths["int_claims_classified"]), graph["classified"])
    assert _same(spark.read.parquet(paths["int_claims_period_latest"]), latest_per_segment(graph["classified"]))
    results = {r["check_name"]: r["failing_rows"] for r in quality.run_checks({k: graph[k] for k, _ in MART_TABLES}).collect()}
    checked = {r["check_name"]: r["failing_rows"] for r in _checked({k: graph[k] for k, _ in MART_TABLES}).collect()}
    assert checked == results and len(results) > 10


def test_states_run_in_steps(spark):
    """F3 to F8: the results read stored steps; the history runs once."""
    graph = build(adapted_history(spark, SF_SMALL), currency_rates(spark))
    for name, key in (("weekly_state", "weekly"), ("monthly_state", "monthly"), ("bucketed_weekly_state", "weekly"), ("bucketed_monthly_state", "monthly")):
        before = _steps(ensure_checkpoint_dir(spark))
        result = QUERIES[name](spark, SF_SMALL)
        files = result.inputFiles()
        assert files and not any("lineitem" in f or "orders" in f for f in files), name
        assert _same(result, as_doubles(graph[key])), name
        if "bucketed" in name:  # its steps' rows are gone, a bucket is a file
            assert _steps(ensure_checkpoint_dir(spark)) == before
            assert len(files) <= tables.LEAST_BUCKETS
    before = _steps(ensure_checkpoint_dir(spark))
    pruned = QUERIES["month_pruned_read"](spark, SF_SMALL)
    assert _steps(ensure_checkpoint_dir(spark)) == before
    inside = F.col("week_end_date").between(F.lit("1996-03-15").cast("date"), F.lit("1997-06-30").cast("date"))
    assert _same(pruned, as_doubles(graph["weekly"].where(inside)))


def test_checks_run_table_by_table(spark):
    """only the results are left to read."""
    files = QUERIES["dq_unique_combo"](spark, SF_SMALL).inputFiles()
    assert files and all("/checks-" in f for f in files)
