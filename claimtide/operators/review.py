"""Review layer: period dimension, category hierarchy, period pivot with the
period-over-period comparison, and the KPI cards.

All heavy work (filters, grouping sets, conditional sums) runs on the
executors.  The driver only ever sees the period dimension — one row per
report week or month, bounded by the calendar, not by the data — because
the pivot's column names are the selected period labels.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimtide import schemas as S
from claimtide.functions.formatting import category_label, comparison_text, money
from claimtide.functions.text import clean_text
from claimtide.operators.periods import GRAINS, WEEKLY, PeriodGrain

MEASURES = ("claim_count", "claim_value_usd")
TIERS = ("wbr_tier1", "wbr_tier2", "wbr_tier3")
REVIEW_FILTERS = ("source", "carrier_name", "country")


def _grain(grain: PeriodGrain | str) -> PeriodGrain:
    return GRAINS[grain] if isinstance(grain, str) else grain


# --------------------------------------------------------------------------
# Small aggregate helpers
# --------------------------------------------------------------------------


def numeric_sum(frame: DataFrame, column: str, rows: Column | None = None) -> Column:
    """Sum of ``column`` over ``rows`` as double.  Numbers are added in their
    own type; text that is no number counts as 0; no rows, or a column that
    ``frame`` doesn't have, give 0.0."""
    if column not in frame.columns:
        return F.lit(0.0)
    value = F.col(column)
    if not isinstance(frame.schema[column].dataType, T.NumericType):
        value = value.cast("string").try_cast("double")
    if rows is not None:
        value = F.when(rows, value)
    return F.coalesce(F.sum(value).cast("double"), F.lit(0.0))


def tier_metric(frame: DataFrame, tier: str, column: str = "claim_count", rows: Column | None = None) -> Column:
    """``numeric_sum`` of ``column`` over rows of one tier-1 class."""
    if "wbr_tier1" not in frame.columns:
        return F.lit(0.0)
    of_tier = F.col("wbr_tier1") == tier
    return numeric_sum(frame, column, of_tier if rows is None else of_tier & rows)


# --------------------------------------------------------------------------
# Periods
# --------------------------------------------------------------------------


def period_dimension(metrics: DataFrame, grain: PeriodGrain | str) -> DataFrame:
    """Distinct periods sorted by start, labelled ``YYYY-W07`` / ``YYYY-M07``."""
    g = _grain(grain)
    return (
        metrics.select(g.year, g.period, g.start, g.end)
        .distinct()
        .withColumn("period_label", F.format_string("%d-%s%02d", F.col(g.year), F.lit(g.label_prefix), F.col(g.period)))
        .orderBy(g.start)
    )


@dataclass(frozen=True)
class Period:
    year: int
    period: int
    start: date
    end: date
    label: str


def collect_periods(metrics: DataFrame, grain: PeriodGrain | str) -> list[Period]:
    """The period dimension on the driver (one row per calendar period)."""
    g = _grain(grain)
    return [Period(*row) for row in period_dimension(metrics, g).collect()]


def default_range(periods: list[Period], grain: PeriodGrain | str) -> tuple[date, date] | None:
    """Last ``default_period_count`` periods: (first start, last start)."""
    g = _grain(grain)
    if not periods:
        return None
    first = periods[max(0, len(periods) - g.default_period_count)]
    return first.start, periods[-1].start


def default_range_frame(metrics: DataFrame, grain: PeriodGrain | str) -> DataFrame:
    """The default period selection as a DataFrame (top-k on the periods,
    no driver round trip): the last N periods by start."""
    g = _grain(grain)
    return period_dimension(metrics, g).orderBy(F.col(g.start).desc()).limit(g.default_period_count)


def apply_review_filters(
    metrics: DataFrame,
    sources: list[str] | None = None,
    carriers: list[str] | None = None,
    countries: list[str] | None = None,
) -> DataFrame:
    """Provider/carrier/country IN-filters; an empty selection filters nothing."""
    for column, values in zip(REVIEW_FILTERS, (sources, carriers, countries)):
        if values:
            metrics = metrics.where(F.col(column).isin(list(values)))
    return metrics


# --------------------------------------------------------------------------
# Hierarchy
# --------------------------------------------------------------------------


def _position_maps() -> tuple[Column, Column, Column]:
    positions = S.waterfall_positions()
    order = F.create_map(*[F.lit(x) for node, (o, _i) in positions.items() for x in (node, o)])
    indent = F.create_map(*[F.lit(x) for node, (_o, i) in positions.items() for x in (node, i)])
    fallback = F.create_map(*[F.lit(x) for pair in S.WATERFALL_FALLBACK_ORDER for x in pair])
    return order, indent, fallback


def hierarchy_values(metrics: DataFrame, grain: PeriodGrain | str, measure: str) -> DataFrame:
    """Measure per (start, tier 1), (start, tier 1, 2) and (start, tier 1, 2, 3).

    One GROUPING SETS aggregate instead of three group-bys + union.  Tiers
    are cleaned (null -> '', trimmed); a level's rows whose own tier is blank
    are dropped; tiers below the level are ''.  Adds row_key, node_name,
    category (indented label) and the waterfall sort_key.
    """
    g = _grain(grain)
    if measure not in MEASURES:
        raise ValueError(f"unknown measure {measure!r}")
    src = metrics.select(
        g.start,
        *(clean_text(F.coalesce(F.col(t), F.lit(""))).alias(t) for t in TIERS),
        F.col(measure),
    )
    t1, t2, t3 = (F.col(t) for t in TIERS)
    grouped = src.groupingSets(
        [[F.col(g.start), t1], [F.col(g.start), t1, t2], [F.col(g.start), t1, t2, t3]],
        g.start,
        *TIERS,
    ).agg(F.sum(measure).alias("metric_value"), F.grouping_id().alias("_gid"))
    level = F.when(F.col("_gid") == 3, 1).when(F.col("_gid") == 1, 2).otherwise(3)
    out = grouped.select(
        g.start,
        *(F.coalesce(F.col(t), F.lit("")).alias(t) for t in TIERS),
        F.col("metric_value"),
        level.alias("tier_level"),
    )
    node = (
        F.when(F.col("tier_level") == 1, F.col("wbr_tier1"))
        .when(F.col("tier_level") == 2, F.col("wbr_tier2"))
        .otherwise(F.col("wbr_tier3"))
    )
    out = out.withColumn("node_name", node).where(F.col("node_name") != "")
    order_map, indent_map, fallback_map = _position_maps()
    order = F.coalesce(
        F.try_element_at(order_map, F.col("node_name")),
        F.try_element_at(fallback_map, F.col("wbr_tier1")),
        F.lit(S.WATERFALL_UNKNOWN_ORDER),
    )
    indent = F.coalesce(F.try_element_at(indent_map, F.col("node_name")), F.col("tier_level") - 1)
    return out.withColumns(
        {
            "row_key": F.concat_ws(S.ROW_KEY_SEPARATOR, *(F.col(t) for t in TIERS)),
            "category": category_label(F.col("node_name"), indent),
            "sort_key": F.concat_ws(
                S.SORT_KEY_SEPARATOR,
                F.format_string("%04d", order),
                F.when(F.col("tier_level") > 1, F.col("node_name")).otherwise(F.lit("")),
                F.col("tier_level").cast("string"),
                F.col("wbr_tier2"),
                F.col("wbr_tier3"),
            ),
        }
    )


# --------------------------------------------------------------------------
# Pivot
# --------------------------------------------------------------------------


def previous_period(periods: list[Period], start: date) -> Period | None:
    """The period before ``start`` among the available periods (not
    necessarily adjacent in the calendar, nor inside the selection)."""
    starts = [p.start for p in periods]
    i = starts.index(start)
    return periods[i - 1] if i > 0 else None


def build_review_pivot(
    metrics: DataFrame,
    periods: list[Period],
    selected: list[Period],
    grain: PeriodGrain | str,
    measure: str,
    comparison_column: str = "comparison",
) -> tuple[DataFrame, str | None]:
    """Waterfall rows x selected periods, plus the comparison of the last
    selected period with its previous available period.

    Rows are the hierarchy nodes seen in the selected or compared periods;
    missing values are 0.  One pivot over the hierarchy of the relevant
    periods only; its work doesn't grow with their number.  Returns (pivot,
    previous period label)."""
    g = _grain(grain)
    if not selected:
        raise ValueError("no selected periods")
    last = selected[-1]
    prev = previous_period(periods, last.start)
    relevant = [p.start for p in selected] + [last.start] + ([prev.start] if prev else [])
    relevant = sorted(set(relevant))
    hierarchy = hierarchy_values(metrics.where(F.col(g.start).isin(relevant)), g, measure)
    zero = F.lit(0).cast(hierarchy.schema["metric_value"].dataType)
    wide = hierarchy.groupBy("row_key", "category", "sort_key").pivot(g.start, relevant).agg(F.sum("metric_value"))

    def cell(p: Period) -> Column:
        return F.coalesce(F.col(f"`{p.start}`"), zero)

    pivot = wide.select(
        "category",
        "sort_key",
        *(cell(p).alias(p.label) for p in selected),
        cell(last).alias("_current"),
        (cell(prev) if prev else zero).alias("_previous"),
    )
    if prev:
        text = comparison_text("_current", "_previous", measure == "claim_value_usd")
    else:
        text = F.lit("N/A")
    pivot = (
        pivot.withColumn(comparison_column, text)
        .orderBy("sort_key")
        .select(F.col("category").alias("WBR waterfall"), *(F.col(p.label) for p in selected), comparison_column)
    )
    return pivot, (prev.label if prev else None)


@dataclass
class ReviewResult:
    pivot: DataFrame | None
    selected: list[Period]
    last_label: str | None
    previous_label: str | None
    message: str | None = None


def period_review(
    metrics: DataFrame,
    grain: PeriodGrain | str,
    measure: str = "claim_count",
    sources: list[str] | None = None,
    carriers: list[str] | None = None,
    countries: list[str] | None = None,
    date_range: tuple[date, date] | None = None,
    periods: list[Period] | None = None,
) -> ReviewResult:
    """Filters -> periods -> inclusive date range (default: last 8 weeks /
    12 months) -> waterfall pivot with WoW / MoM comparison.

    ``metrics`` is read twice (its periods, the pivot): give a written mart,
    or the ``periods`` of the filtered rows if they are known."""
    g = _grain(grain)
    filtered = apply_review_filters(metrics, sources, carriers, countries)
    periods = collect_periods(filtered, g) if periods is None else periods
    if not periods:
        return ReviewResult(None, [], None, None, "The chosen filters leave no metrics.")
    lo, hi = date_range or default_range(periods, g)
    selected = [p for p in periods if lo <= p.start <= hi]
    if not selected:
        return ReviewResult(None, [], None, None, "The date range holds no period.")
    pivot, previous_label = build_review_pivot(filtered, periods, selected, g, measure, g.comparison_label)
    return ReviewResult(pivot, selected, selected[-1].label, previous_label)


# --------------------------------------------------------------------------
# KPI cards
# --------------------------------------------------------------------------

KPI_SCHEMA = T.StructType(
    [
        T.StructField("card", T.StringType(), False),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("delta", T.DoubleType(), True),
        T.StructField("value_text", T.StringType(), True),
        T.StructField("delta_text", T.StringType(), True),
    ]
)


def kpi_cards(weekly_metrics: DataFrame) -> DataFrame:
    """Latest available report week: Active / Closed / Re-opened counts and
    total claim value, each with the delta to the previous available week
    (null when there is only one week).

    The two latest weeks are a top-2 over the distinct periods; the metrics
    are then aggregated once with conditional sums for both weeks.  Give a
    written mart: it is read for the weeks and for the sums.
    """
    g = WEEKLY
    spark = weekly_metrics.sparkSession
    latest = (
        weekly_metrics.select(g.year, g.period, g.start).distinct().orderBy(F.col(g.start).desc()).limit(2).collect()
    )
    if not latest:
        return spark.createDataFrame([], KPI_SCHEMA)

    def in_week(row) -> Column:
        return (F.col(g.year) == F.lit(row[0])) & (F.col(g.period) == F.lit(row[1]))

    cur_week = in_week(latest[0])
    has_prev = len(latest) > 1
    prev_week = in_week(latest[1]) if has_prev else F.lit(False)
    aggs = []
    for i, (_label, tier) in enumerate(S.KPI_CARDS):
        # whole-number counts, truncated below
        aggs.append(tier_metric(weekly_metrics, tier, "claim_count", cur_week).alias(f"c{i}"))
        aggs.append(tier_metric(weekly_metrics, tier, "claim_count", prev_week).alias(f"p{i}"))
    aggs.append(numeric_sum(weekly_metrics, "claim_value_usd", cur_week).alias("cv"))
    aggs.append(numeric_sum(weekly_metrics, "claim_value_usd", prev_week).alias("pv"))
    totals = weekly_metrics.where(cur_week | prev_week).agg(*aggs)

    cards = []
    for i, (label, _tier) in enumerate(S.KPI_CARDS):
        cur, prev = F.col(f"c{i}").cast("long"), F.col(f"p{i}").cast("long")
        delta = (cur - prev) if has_prev else F.lit(None).cast("long")
        cards.append(
            F.struct(
                F.lit(label).alias("card"),
                cur.cast("double").alias("value"),
                delta.cast("double").alias("delta"),
                cur.cast("string").alias("value_text"),
                delta.cast("string").alias("delta_text"),
            )
        )
    cv, pv = F.col("cv"), F.col("pv")
    vdelta = (cv - pv) if has_prev else F.lit(None).cast("double")
    cards.append(
        F.struct(
            F.lit(S.KPI_VALUE_CARD).alias("card"),
            cv.alias("value"),
            vdelta.alias("delta"),
            money(cv).alias("value_text"),
            money(vdelta).alias("delta_text"),
        )
    )
    return totals.select(F.inline(F.array(*cards)))
