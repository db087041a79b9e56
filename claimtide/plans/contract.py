"""Contract queries: every operator run over the star-schema test tables.

Each query takes (spark, sf_dir), builds the claim history from the tables
with the adapter and returns a DataFrame whose columns match the DuckDB
oracle in ``claimtide.plans.oracle_queries``.  Money (decimal) columns are
returned as DOUBLE, like the oracle does.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimtide import schemas as S
from claimtide.functions import calendar as cal
from claimtide.functions.formatting import comparison_text
from claimtide.functions.money import billionths, whole_part
from claimtide.operators import extracts as X
from claimtide.operators import quality as Q
from claimtide.operators import review as R
from claimtide.operators.classify import classify, convert_currency, detect_reopened
from claimtide.operators.periods import (
    MONTHLY,
    WEEKLY,
    PeriodGrain,
    latest_per_period,
    latest_per_segment,
    period_state,
    period_state_of_latest,
    told_of_state,
)
from claimtide.operators.staging import stage_claims
from claimtide.plans.build import (
    SEGMENT_ORDER,
    ModelGraph,
    build,
    materialize,
    measured_checks,
    refresh,
    register_views,
    shuffles_removed,
)
from claimtide.schemas import STAGED_DATES
from claimtide.session import broadcast_if_small, scratch_path
from claimtide.sources import search, tables, versions
from claimtide.sources.history import read_history
from claimtide.sources.seeds import category_hierarchy, currency_rates
from claimtide.sources.testdata import testdata_history


def as_doubles(df: DataFrame) -> DataFrame:
    """Decimal columns as DOUBLE (for engine-neutral comparison)."""
    return df.select(
        *(
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        )
    )


def models(spark: SparkSession, sf_dir: str) -> ModelGraph:
    """The lazy model graph over the adapted test tables."""
    return build(testdata_history(spark, sf_dir), currency_rates(spark))


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_claims(testdata_history(spark, sf_dir))


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(staged(spark, sf_dir), currency_rates(spark))


def q_stage_claims(spark, sf_dir):
    return as_doubles(staged(spark, sf_dir))


def q_reopened_claims(spark, sf_dir):
    return detect_reopened(staged(spark, sf_dir))


def q_currency_convert(spark, sf_dir):
    conv = convert_currency(staged(spark, sf_dir), currency_rates(spark))
    return as_doubles(conv.select("claim_number", "snapshot_date", "currency", "value_of_trailer", "value_usd"))


def q_classified(spark, sf_dir):
    return as_doubles(classified(spark, sf_dir))


def q_current_claims(spark, sf_dir):
    return as_doubles(models(spark, sf_dir)["current"])


def q_weekly_state(spark, sf_dir):
    return as_doubles(_state(spark, testdata_history(spark, sf_dir), WEEKLY))


def q_monthly_state(spark, sf_dir):
    return as_doubles(_state(spark, testdata_history(spark, sf_dir), MONTHLY))


def q_weekly_transitions(spark, sf_dir):
    return as_doubles(models(spark, sf_dir)["weekly_transitions"])


def _stored(df: DataFrame, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A table written and read back: what reads it several times must not run
    the history again.  With ``columns`` only these are written; the others
    read as null, for plans that don't use them."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        (df if columns is None else df.select(*columns)).write.options(**tables.STORED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _state(spark: SparkSession, raw: DataFrame, grain: PeriodGrain) -> DataFrame:
    """``period_state_from_staged`` in steps: the staged rows are stored, then the
    latest of each period.  The history runs once, and the shuffles of a step
    are gone before the next."""
    staged = _stored(stage_claims(raw), "staged")
    latest = _stored(latest_per_period(staged, grain), "latest")
    return period_state_of_latest(latest, currency_rates(spark), grain, staged)


@contextmanager
def _state_for_now(
    spark: SparkSession, raw: DataFrame, grain: PeriodGrain, needed: Sequence[str]
) -> Iterator[tuple[DataFrame, tables.Finish]]:
    """``_state`` stored itself, without the columns that are told after a write
    (but for those ``needed`` before), and what tells them.  The rows of its
    steps are gone."""
    stored, path = tables.stored_for_now, lambda name: scratch_path(spark, name)
    with shuffles_removed(spark):
        with stored(stage_claims(raw), path("staged")) as staged, stored(latest_per_period(staged, grain), path("latest")) as latest:
            whole, told, kept = period_state_of_latest(latest, currency_rates(spark), grain, staged), told_of_state(grain, needed), path("state")
            state = whole.drop(*told)
            state.write.options(**tables.STORED).parquet(kept)
        try:
            yield spark.read.schema(state.schema).parquet(kept), tables.telling(told, whole.columns)
        finally:
            tables.remove(spark, kept)


#: the staged columns that the metric marts depend on.
METRIC_SOURCES = (
    "claim_number",
    "snapshot_date",
    "carrier_name",
    "country",
    "status",
    "reason",
    "results",
    "insurance_claims_results",
    "source",
    "currency",
    "value_of_trailer",
)


def _metric_models(spark: SparkSession, raw: DataFrame) -> ModelGraph:
    """The models for their metric marts: the latest rows and the closed dates
    are picked from staged rows that are written once, in the columns that
    metrics depend on, so the history runs once and not twice."""
    return build(raw, currency_rates(spark), _stored(stage_claims(raw), "staged", METRIC_SOURCES))


def q_weekly_metrics(spark, sf_dir):
    return as_doubles(_metric_models(spark, testdata_history(spark, sf_dir))["weekly_metrics"])


def q_monthly_metrics(spark, sf_dir):
    return as_doubles(_metric_models(spark, testdata_history(spark, sf_dir))["monthly_metrics"])


def _wide_models(spark, sf_dir):
    """The models over values of 18 to 24 whole digits and 9 decimals, put
    together from each row's own value and trailer number; every eleventh
    trailer's are negative."""
    raw = testdata_history(spark, sf_dir)
    cents = F.replace("value_of_trailer", F.lit("."), F.lit(""))
    sign = F.when(F.col("trailer_number").cast("long") % 11 == 0, "-").otherwise("")
    wide = F.concat(sign, "trailer_number", F.lpad(cents, 10, "0"), F.lpad("trailer_number", 9, "7"), F.lit("."), F.lpad(cents, 9, "3"))
    return build(raw.withColumn("value_of_trailer", wide), currency_rates(spark))


def _cents(column: str):
    """An exact amount of two decimals as text, in hundredths."""
    return (F.col(column) * F.lit(100)).cast("decimal(38,0)").cast("string")


def q_wide_money_metrics(spark, sf_dir):
    metrics = _wide_models(spark, sf_dir)["weekly_metrics"]
    return metrics.select("report_year", "report_week", *S.METRIC_DIMENSIONS, "claim_count", _cents("claim_value_usd").alias("claim_value_cents"))


def q_wide_money_deltas(spark, sf_dir):
    """Whole part and billionths of every weekly value, and its change."""
    weekly = _wide_models(spark, sf_dir)["weekly"]
    return weekly.select(
        "claim_number",
        "week_start_date",
        whole_part("value_usd").cast("string").alias("value_whole"),
        billionths("value_usd").alias("value_billionths"),
        _cents("week_over_week_value_delta_usd").alias("delta_cents"),
    )


QUERIES = {
    "wide_money_metrics": q_wide_money_metrics,
    "wide_money_deltas": q_wide_money_deltas,
    "stage_claims": q_stage_claims,
    "reopened_claims": q_reopened_claims,
    "currency_convert": q_currency_convert,
    "classified": q_classified,
    "current_claims": q_current_claims,
    "weekly_state": q_weekly_state,
    "monthly_state": q_monthly_state,
    "weekly_transitions": q_weekly_transitions,
    "weekly_metrics": q_weekly_metrics,
    "monthly_metrics": q_monthly_metrics,
}


# ---------------------------------------------------------------------------
# calendar, keys, tiers
# ---------------------------------------------------------------------------


_DATE_COLUMNS = ("snapshot_date", *(name for name, _ in STAGED_DATES))


def q_report_calendar(spark, sf_dir):
    """Report year/week, Thursday and week bounds of every staged date."""
    days = (
        staged(spark, sf_dir)
        .select(F.explode(F.array(*_DATE_COLUMNS)).alias("day"))
        .where(F.col("day").isNotNull())
        .distinct()
    )
    return days.select(
        "day",
        cal.report_year("day").alias("report_year"),
        cal.report_week("day").alias("report_week"),
        cal.report_week_thursday("day").alias("report_thursday"),
        cal.week_start("day").alias("week_start_date"),
        cal.week_end("day").alias("week_end_date"),
    )


def q_surrogate_keys(spark, sf_dir):
    return classified(spark, sf_dir).select("claim_number", "snapshot_date", "claim_snapshot_key")


def q_tier_counts(spark, sf_dir):
    return (
        classified(spark, sf_dir)
        .groupBy("status", "wbr_tier1", "wbr_tier2", "wbr_tier3")
        .agg(F.count(F.lit(1)).alias("snapshot_count"), F.count_distinct("claim_number").alias("claim_count"))
    )


# ---------------------------------------------------------------------------
# review layer
# ---------------------------------------------------------------------------


def _models_of_stored(spark: SparkSession, raw: DataFrame) -> ModelGraph:
    """The models over staged rows that are written once: a query of several
    models runs the history once, not once or more a model."""
    return build(raw, currency_rates(spark), _stored(stage_claims(raw), "staged"))


def _weekly_metrics(spark, sf_dir):
    return _stored(_metric_models(spark, testdata_history(spark, sf_dir))["weekly_metrics"], "weekly_metrics")


def _monthly_metrics(spark, sf_dir):
    return _stored(_metric_models(spark, testdata_history(spark, sf_dir))["monthly_metrics"], "monthly_metrics")


def q_period_dimension_weekly(spark, sf_dir):
    return R.period_dimension(_weekly_metrics(spark, sf_dir), WEEKLY)


def q_period_dimension_monthly(spark, sf_dir):
    return R.period_dimension(_monthly_metrics(spark, sf_dir), MONTHLY)


def q_hierarchy_weekly_count(spark, sf_dir):
    return R.hierarchy_values(_weekly_metrics(spark, sf_dir), WEEKLY, "claim_count")


def q_hierarchy_monthly_value(spark, sf_dir):
    return as_doubles(R.hierarchy_values(_monthly_metrics(spark, sf_dir), MONTHLY, "claim_value_usd"))


def q_review_weekly_count(spark, sf_dir):
    """Weekly review as the dashboard opens it: no filters, last 8 weeks,
    claim count, WoW comparison."""
    return R.period_review(_weekly_metrics(spark, sf_dir), WEEKLY, "claim_count").pivot


def q_review_monthly_value(spark, sf_dir):
    """Monthly review for country US: last 12 months, claim value, MoM."""
    result = R.period_review(_monthly_metrics(spark, sf_dir), MONTHLY, "claim_value_usd", countries=["US"])
    return as_doubles(result.pivot)


def q_review_monthly_count(spark, sf_dir):
    """Monthly review as it opens: no filters, last 12 months, claim count."""
    return R.period_review(_monthly_metrics(spark, sf_dir), MONTHLY, "claim_count").pivot


REVIEW_RANGE = (date(1996, 1, 1), date(1996, 3, 31))


def q_review_weekly_range(spark, sf_dir):
    """Weekly review for two providers and two carriers over an explicit
    date range (claim value); the WoW comparison period may lie before the
    range and its rows appear with zero cells."""
    result = R.period_review(
        _weekly_metrics(spark, sf_dir),
        WEEKLY,
        "claim_value_usd",
        sources=["Provider F", "Provider O"],
        carriers=["Carrier 1", "Carrier 2"],
        date_range=REVIEW_RANGE,
    )
    return as_doubles(result.pivot)


ONE_WEEK = (date(1996, 3, 31), date(1996, 4, 6))


def q_review_one_week(spark, sf_dir):
    """One selected week (claim count): its WoW comparison week lies outside
    the selection, so rows present only in that week appear with a 0 cell."""
    return R.period_review(_weekly_metrics(spark, sf_dir), WEEKLY, "claim_count", date_range=ONE_WEEK).pivot


def _long(result) -> DataFrame:
    """A review pivot as rows of period and value."""
    pivot = result.pivot
    cells = F.array(
        *(F.struct(F.lit(p.label).alias("period_label"), F.col(f"`{p.label}`").cast("double").alias("value")) for p in result.selected)
    )
    comparison = pivot.columns[-1]
    return pivot.select(
        F.col("WBR waterfall").alias("waterfall"), F.col(comparison).alias("comparison"), F.inline(cells)
    )


def q_review_weekly_count_long(spark, sf_dir):
    return _long(R.period_review(_weekly_metrics(spark, sf_dir), WEEKLY, "claim_count"))


def q_review_monthly_value_long(spark, sf_dir):
    return _long(R.period_review(_monthly_metrics(spark, sf_dir), MONTHLY, "claim_value_usd", countries=["US"]))


def q_review_monthly_count_long(spark, sf_dir):
    return _long(R.period_review(_monthly_metrics(spark, sf_dir), MONTHLY, "claim_count"))


def q_review_comparison_text(spark, sf_dir):
    """Comparison text of every waterfall row for every weekly period against
    its previous available period (claim value)."""
    metrics = _weekly_metrics(spark, sf_dir)
    hierarchy = R.hierarchy_values(metrics, WEEKLY, "claim_value_usd")
    periods = R.period_dimension(metrics, WEEKLY).select("week_start_date")
    # period -> next available period; one row per report week (bounded by
    # the calendar), so the broadcast is checked, not assumed
    nxt = periods.select(
        F.col("week_start_date"),
        F.lead("week_start_date").over(Window.orderBy("week_start_date")).alias("next_start"),
        F.lag("week_start_date").over(Window.orderBy("week_start_date")).isNotNull().alias("has_previous"),
    )
    values = hierarchy.select("week_start_date", "row_key", "metric_value").join(nxt, "week_start_date")
    value_type = values.schema["metric_value"].dataType
    # each row counts as "current" in its own period (if that period has a
    # previous one) and as "previous" in the next period
    both = values.select(
        F.inline(
            F.array(
                F.struct(
                    F.when(F.col("has_previous"), F.col("week_start_date")).alias("period_start"),
                    F.col("row_key"),
                    F.col("metric_value").alias("cur"),
                    F.lit(None).cast(value_type).alias("prev"),
                ),
                F.struct(
                    F.col("next_start").alias("period_start"),
                    F.col("row_key"),
                    F.lit(None).cast(value_type).alias("cur"),
                    F.col("metric_value").alias("prev"),
                ),
            )
        )
    ).where(F.col("period_start").isNotNull())
    paired = both.groupBy("period_start", "row_key").agg(F.sum("cur").alias("cur"), F.sum("prev").alias("prev"))
    cur = F.coalesce(F.col("cur"), F.lit(0))
    prev = F.coalesce(F.col("prev"), F.lit(0))
    return paired.select(
        F.col("period_start").alias("week_start_date"),
        "row_key",
        cur.cast("double").alias("current_value"),
        prev.cast("double").alias("previous_value"),
        comparison_text(cur, prev, True).alias("comparison"),
    )


def q_kpi_cards(spark, sf_dir):
    return R.kpi_cards(_weekly_metrics(spark, sf_dir))


def q_default_range(spark, sf_dir):
    graph = _models_of_stored(spark, testdata_history(spark, sf_dir))
    weekly = R.default_range_frame(_stored(graph["weekly_metrics"], "weekly_metrics"), WEEKLY).select(
        F.lit("weekly").alias("grain"), "period_label", F.col("week_start_date").alias("period_start")
    )
    monthly = R.default_range_frame(_stored(graph["monthly_metrics"], "monthly_metrics"), MONTHLY).select(
        F.lit("monthly").alias("grain"), "period_label", F.col("month_start_date").alias("period_start")
    )
    return weekly.unionByName(monthly)


# ---------------------------------------------------------------------------
# extracts
# ---------------------------------------------------------------------------

CURRENT_FILTER = dict(
    country=["US"], status=["Open", "Closed"], carrier_name=["Carrier 0", "Carrier 1"], search=r"clm-\d*7"
)
TRANSITION_FILTER = dict(country=["CA"], transition_type=["CLOSED_TO_OPEN", "OPEN_TO_CLOSED"], search="clm")


def _current(spark, sf_dir):
    return models(spark, sf_dir)["current"]


def _transitions(spark, sf_dir):
    return models(spark, sf_dir)["weekly_transitions"]


def q_filter_current(spark, sf_dir):
    return as_doubles(X.claims_extract(_current(spark, sf_dir), **CURRENT_FILTER))


def q_filter_transitions(spark, sf_dir):
    return as_doubles(X.transitions_extract(_transitions(spark, sf_dir), **TRANSITION_FILTER))


def q_filter_options(spark, sf_dir):
    cur = X.filter_options(_current(spark, sf_dir), X.CLAIM_FILTERS).withColumn("table_name", F.lit("current"))
    tr = X.filter_options(_transitions(spark, sf_dir), X.TRANSITION_FILTERS).withColumn(
        "table_name", F.lit("weekly_transitions")
    )
    return cur.unionByName(tr)


def q_title_case_headers(spark, sf_dir):
    return as_doubles(X.claims_extract(_current(spark, sf_dir)))


def q_csv_round_trip(spark, sf_dir):
    """Claims extract written as CSV (header, UTF-8) and read back, with a
    note that holds quotes, line breaks, edge spaces, blanks and nulls."""
    turn = F.length("Claim Number") % 4
    note = (
        F.when(turn == 0, F.concat(F.lit(" "), "Status", F.lit(', "'), "Country", F.lit('" ')))
        .when(turn == 1, F.concat(F.lit("a\n"), F.coalesce("Reason", F.lit('"'))))
        .when(turn == 2, F.lit(""))
    )
    extract = as_doubles(X.claims_extract(_current(spark, sf_dir))).withColumn("Note", note)
    path = scratch_path(spark, "current_claims_csv")
    tables.write_csv(extract, path)
    return tables.read_csv(spark, path, extract.schema)


def q_month_pruned_read(spark, sf_dir):
    """Weekly mart written month-partitioned, read back for one date range
    (partition pruning on the month + pushed filter on the date)."""
    path, clusters = scratch_path(spark, "mart_claims_weekly"), ["claim_number", "report_year", "report_week", "status"]
    with _state_for_now(spark, testdata_history(spark, sf_dir), WEEKLY, ["week_end_date", *clusters]) as (weekly, finish):
        tables.write_partitioned(weekly, path, "week_end_date", clusters, finish=finish, turns=tables.turns_for(weekly.count()))
    return as_doubles(tables.read_month_range(spark, path, "week_end_date", "1996-03-15", "1997-06-30"))


def q_history_scan(spark, sf_dir):
    """The history as a stored table, through the shipped reader (the 19 used
    columns of a wider table) and staging."""
    path = scratch_path(spark, "raw_history")
    testdata_history(spark, sf_dir).withColumn("unused", F.lit(1)).write.parquet(path)
    return as_doubles(stage_claims(read_history(spark, path)))


def q_currency_convert_csv(spark, sf_dir):
    """Conversion with a currency seed read from CSV."""
    path = scratch_path(spark, "currency_seed_csv")
    tables.write_csv(currency_rates(spark), path)
    conv = convert_currency(staged(spark, sf_dir), currency_rates(spark, path))
    return as_doubles(conv.select("claim_number", "snapshot_date", "currency", "value_of_trailer", "value_usd"))


def q_mart_by_name(spark, sf_dir):
    """The current mart written range-clustered and read by its name."""
    base, name = scratch_path(spark, "by_name"), "mart_claims_current"
    tables.write_clustered(
        _current(spark, sf_dir), tables.layer_path(base, tables.MARTS, name), ["claim_number", "status", "wbr_tier1"]
    )
    return as_doubles(tables.read_mart(spark, base, name))


def _bucketed_state(grain):
    """A mart's rows from the stored segment table, read in its buckets."""

    def run(spark, sf_dir):
        path, rates = scratch_path(spark, "segments"), currency_rates(spark)
        buckets = tables.buckets_for(spark.read.parquet(f"{sf_dir}/lineitem.parquet").count())
        stored, at = tables.stored_for_now, lambda name: scratch_path(spark, name)
        # thinned as staged rows, which are narrower; only what stays is classified,
        # in its bucket.  Each step's shuffles are gone before the next
        with shuffles_removed(spark), stored(staged(spark, sf_dir), at("staged")) as history:
            with stored(latest_per_segment(history), at("latest")) as latest:
                tables.write_bucketed(latest, path, *SEGMENT_ORDER, buckets, lambda dealt: classify(dealt, rates, history, buckets))
        with tables.bucketed_table(spark, path, *SEGMENT_ORDER, buckets) as segments:
            return as_doubles(period_state(segments, grain))

    return run


def q_search_current(spark, sf_dir):
    """A claim search through the trigram table of the written mart."""
    path = tables.layer_path(scratch_path(spark, "searched"), tables.MARTS, "mart_claims_current")
    tables.write_clustered(_current(spark, sf_dir), path, ["claim_number", "status", "wbr_tier1"])
    search.build_index(spark, path)
    pattern = "clm-1[0-5]+-"
    rows = X.filter_claims(search.read_for_search(spark, path, pattern), search=pattern)
    return as_doubles(rows.select("claim_number", "snapshot_date", "status", "value_usd"))


#: lines of a block are 2 to this power.
BLOCK_BITS = 17


def newest_later(rows: DataFrame, day: str, at: str, bits: int = BLOCK_BITS) -> DataFrame:
    """``rows`` with the latest ``day`` of those whose place ``at`` is higher.
    Places are cut into blocks: a task orders one block's rows, and one row a
    block tells what lies behind it."""
    blocks = rows.withColumn("_block", F.shiftright(at, bits))
    behind = Window.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    later = blocks.groupBy("_block").agg(F.max(day).alias("_most")).select("_block", F.max("_most").over(behind).alias("_later"))
    inside = Window.partitionBy("_block").orderBy(F.desc(at)).rowsBetween(Window.unboundedPreceding, -1)
    found = blocks.withColumn("_inside", F.max(day).over(inside)).join(broadcast_if_small(later), "_block")
    return found.withColumn("newest_later", F.greatest("_inside", "_later")).drop("_block", "_inside", "_later")


def q_ordered_export(spark, sf_dir):
    """The transitions as one CSV file, newest first, with the number of rows
    that its write counted; read back, and whether its lines are in order."""
    path = scratch_path(spark, "transitions_csv") + ".csv"
    names = ["Claim Number", "Week End Date", "Current Status", "Transition Type"]
    extract = X.transitions_extract(_transitions(spark, sf_dir)).select(*names)
    n = tables.write_csv_file(extract, path)
    rows = tables.read_csv(spark, path, extract.schema).withColumn("at", F.monotonically_increasing_id())
    rows = newest_later(rows, "Week End Date", "at")
    in_order = F.coalesce(F.col("newest_later") <= F.col("Week End Date"), F.lit(True))
    return rows.select(*names, F.lit(n).cast("long").alias("Rows"), in_order.alias("In Order"))


# ---------------------------------------------------------------------------
# data quality
# ---------------------------------------------------------------------------


def q_category_counts(spark, sf_dir):
    """Claims of each line of the category seed, read from its CSV form."""
    path = scratch_path(spark, "category_seed_csv")
    tables.write_csv(category_hierarchy(spark), path)
    seed = category_hierarchy(spark, path)
    current = _current(spark, sf_dir).select("wbr_tier1", "wbr_tier2", "wbr_tier3")
    of_line = (F.col("tier1_filter") == F.col("wbr_tier1")) & (
        F.col("tier_match_value").isNull()
        | F.when(F.col("indent_level") == 1, F.col("tier_match_value") == F.col("wbr_tier2")).otherwise(F.col("tier_match_value") == F.col("wbr_tier3"))
    )
    counted = current.groupBy("wbr_tier1", "wbr_tier2", "wbr_tier3").agg(F.count(F.lit(1)).alias("claims"))
    lines = broadcast_if_small(seed).join(counted, of_line, "left")
    return lines.groupBy("sort_order", "display_label", "indent_level").agg(F.coalesce(F.sum("claims"), F.lit(0)).cast("long").alias("claims"))


def q_views_by_sql(spark, sf_dir):
    """Two marts through their registered views, in SQL."""
    names = register_views(spark, models(spark, sf_dir))
    return spark.sql(
        f"SELECT m.report_year, m.report_week, m.claims, s.rows FROM (SELECT report_year, report_week, sum(claim_count) AS claims "
        f"FROM {names['weekly_metrics']} GROUP BY report_year, report_week) m JOIN (SELECT report_year, report_week, count(*) AS rows "
        f"FROM {names['weekly']} GROUP BY report_year, report_week) s USING (report_year, report_week)"
    )


def q_refreshed_names(spark, sf_dir):
    """Rows of every name in the catalog after two refreshes of one base (some
    claims, then all): of the second, and of the manifest's first version."""
    raw, rates, base = testdata_history(spark, sf_dir), currency_rates(spark), scratch_path(spark, "refreshed")
    prefix = f"c{uuid.uuid4().hex}_"
    refresh(spark, raw.where(F.col("claim_number").like("%1 ")), rates, category_hierarchy(spark), base, prefix)
    refresh(spark, raw, rates, category_hierarchy(spark), base, prefix)
    first, layers = versions.open_version(spark, base, 1), versions.open_version(spark, base).layers
    counts = [
        spark.table(f"`{prefix}{layer}`.`{name}`")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(layer).alias("layer"), F.lit(name).alias("name"), "rows", F.lit(first[name].count()).cast("long").alias("rows_before"))
        for name, layer in sorted(layers.items())
    ]
    return reduce(DataFrame.unionByName, counts)


def q_periods_in_order(spark, sf_dir):
    """Weekly periods by their place in the sorted period list."""
    found = R.collect_periods(_weekly_metrics(spark, sf_dir), WEEKLY)
    return spark.createDataFrame([(k, p.start, p.label) for k, p in enumerate(found)], "place long, week_start_date date, period_label string")


def q_text_sums(spark, sf_dir):
    """Numbers held as text, some of them none, added up by status and tier."""
    weekly = _weekly_metrics(spark, sf_dir)
    text = F.when(F.col("claim_count") % 3 == 0, F.concat(F.lit("n/a "), F.col("claim_count").cast("string"))).otherwise(F.col("claim_count").cast("string"))
    frame = weekly.withColumn("claim_count", text)
    sums = [R.numeric_sum(frame, "claim_count").alias("claims"), R.numeric_sum(frame, "no_such_column").alias("nothing")]
    sums += [R.tier_metric(frame, tier, "claim_count").alias(f"tier_{k}") for k, tier in enumerate(S.TIER1_VALUES)]
    return frame.groupBy("status").agg(*sums)


def q_dq_after_build(spark, sf_dir):
    """All checks of the built tables after a full build: the row-level ones
    from the tables' own writes, the grouped ones from the stored tables."""
    base = scratch_path(spark, "checked")
    paths = materialize(spark, testdata_history(spark, sf_dir), currency_rates(spark), base)
    found = {key: tables.read_mart(spark, base, name) for key, name in S.MART_TABLES}
    found[Q.CLASSIFIED] = tables.read_table(spark, paths["int_claims_classified"])
    return _checked(found, measured=measured_checks(spark, base))


def _checked(found: dict[str, DataFrame], checks: Sequence[Q.Check] = Q.CHECKS, measured: DataFrame | None = None) -> DataFrame:
    """``run_checks`` table by table, with the results (a row a check) stored: the
    disk holds the shuffles of one table's checks, not of all."""
    parts = []
    for key, table in found.items():
        if of := tuple(c for c in checks if c.table == key):
            parts.append(_stored(Q.run_checks({key: table}, of, measured).coalesce(1), "checks"))
    return reduce(DataFrame.unionByName, parts)


def _dq_tables(spark, sf_dir):
    raw = testdata_history(spark, sf_dir)
    graph = _models_of_stored(spark, raw)
    tables_ = {key: graph[key] for key in graph if key != "staged"}
    tables_[Q.SOURCE] = raw
    tables_[Q.CURRENCY] = currency_rates(spark)
    return tables_


def _dq(kinds: tuple[str, ...]):
    def run(spark, sf_dir):
        checks = tuple(c for c in Q.CHECKS if c.kind in kinds)
        return _checked(_dq_tables(spark, sf_dir), checks)

    return run



QUERIES.update(
    {
        "report_calendar": q_report_calendar,
        "surrogate_keys": q_surrogate_keys,
        "tier_counts": q_tier_counts,
        "period_dimension_weekly": q_period_dimension_weekly,
        "period_dimension_monthly": q_period_dimension_monthly,
        "hierarchy_weekly_count": q_hierarchy_weekly_count,
        "hierarchy_monthly_value": q_hierarchy_monthly_value,
        "review_weekly_count": q_review_weekly_count,
        "review_monthly_value": q_review_monthly_value,
        "review_monthly_count": q_review_monthly_count,
        "review_weekly_range": q_review_weekly_range,
        "review_one_week": q_review_one_week,
        "review_weekly_count_long": q_review_weekly_count_long,
        "review_monthly_value_long": q_review_monthly_value_long,
        "review_monthly_count_long": q_review_monthly_count_long,
        "review_comparison_text": q_review_comparison_text,
        "kpi_cards": q_kpi_cards,
        "default_range": q_default_range,
        "filter_current": q_filter_current,
        "filter_transitions": q_filter_transitions,
        "filter_options": q_filter_options,
        "title_case_headers": q_title_case_headers,
        "csv_round_trip": q_csv_round_trip,
        "month_pruned_read": q_month_pruned_read,
        "history_scan": q_history_scan,
        "currency_convert_csv": q_currency_convert_csv,
        "mart_by_name": q_mart_by_name,
        "bucketed_weekly_state": _bucketed_state(WEEKLY),
        "bucketed_monthly_state": _bucketed_state(MONTHLY),
        "search_current": q_search_current,
        "ordered_export": q_ordered_export,
        "dq_after_build": q_dq_after_build,
        "category_counts": q_category_counts,
        "views_by_sql": q_views_by_sql,
        "refreshed_names": q_refreshed_names,
        "periods_in_order": q_periods_in_order,
        "text_sums": q_text_sums,
        "dq_not_null": _dq(("not_null",)),
        "dq_unique": _dq(("unique",)),
        "dq_accepted": _dq(("accepted_values",)),
        "dq_unique_combo": _dq(("unique_combination",)),
        "dq_between": _dq(("between",)),
        "dq_singular": _dq(("singular",)),
    }
)
