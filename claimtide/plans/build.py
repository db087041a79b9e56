"""The model graph: raw history -> staged -> classified -> six marts.

``build`` composes the operators lazily (Catalyst sees one plan per mart).
``materialize`` writes each layer as a table under a shared folder and reads
it back before the next layer: each written table cuts the lineage, so a
lost executor costs a recompute from the last written layer, not from the
raw history.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack, contextmanager

from pyspark.sql import DataFrame, SparkSession

from claimtide.operators import quality
from claimtide.operators.classify import classify, told_columns
from claimtide.operators.periods import (
    MONTHLY,
    WEEKLY,
    PeriodGrain,
    current_claims,
    current_from_staged,
    latest_per_segment,
    monthly_metrics,
    period_state,
    period_state_from_staged,
    told_of_state,
    weekly_metrics,
    weekly_transitions,
)
from claimtide.operators.staging import stage_claims
from claimtide.schemas import MART_TABLES
from claimtide.session import ensure_checkpoint_dir
from claimtide.sources import search, tables, versions
from claimtide.sources.tables import INTERMEDIATE, MARTS, SEEDS, STAGING


STAGED_VIEW = "stg_insurance_claims"
CLASSIFIED_TABLE = "int_claims_classified"
CURRENCY_SEED, CATEGORY_SEED = "seed_currency_rates", "seed_category_hierarchy"
#: latest classified snapshot per claim, week and month (shared by the
#: weekly and monthly marts in ``materialize``)
SEGMENT_TABLE = "int_claims_period_latest"
#: what it is bucketed by, and what its buckets are sorted by after that
SEGMENT_ORDER = ("claim_number", ["snapshot_date"])
QUALITY, ROW_CHECKS = "quality", "row_checks"


class ModelGraph(Mapping[str, DataFrame]):
    """The models as lazy DataFrames, keyed like the dashboard keys; each is
    composed on first access, so asking for one mart does not analyse the
    others.

    The marts pick their latest snapshots from the staged rows before
    classifying (``period_state_from_staged``): same rows as deriving them
    from the classified table, but no task ever holds a hot claim's whole
    history."""

    KEYS = (
        "staged",
        "classified",
        "current",
        "weekly",
        "weekly_transitions",
        "weekly_metrics",
        "monthly",
        "monthly_metrics",
    )

    def __init__(self, raw: DataFrame, rates: DataFrame, staged: DataFrame | None = None):
        self._raw = raw
        self._rates = rates
        self._cache: dict[str, DataFrame] = {} if staged is None else {"staged": staged}

    def _make(self, key: str) -> DataFrame:
        if key == "staged":
            return stage_claims(self._raw)
        if key == "classified":
            return classify(self["staged"], self._rates)
        if key == "current":
            return current_from_staged(self["staged"], self._rates)
        if key == "weekly":
            return period_state_from_staged(self["staged"], self._rates, WEEKLY)
        if key == "monthly":
            return period_state_from_staged(self["staged"], self._rates, MONTHLY)
        if key == "weekly_transitions":
            return weekly_transitions(self["weekly"])
        if key == "weekly_metrics":
            return weekly_metrics(self["weekly"])
        if key == "monthly_metrics":
            return monthly_metrics(self["monthly"])
        raise KeyError(key)

    def __getitem__(self, key: str) -> DataFrame:
        if key not in self._cache:
            self._cache[key] = self._make(key)
        return self._cache[key]

    def __iter__(self) -> Iterator[str]:
        return iter(self.KEYS)

    def __len__(self) -> int:
        return len(self.KEYS)


def build(raw: DataFrame, rates: DataFrame, staged: DataFrame | None = None) -> ModelGraph:
    """All models over ``raw`` (lazy, see ``ModelGraph``).  ``staged``: its
    staged rows, where they are stored; a suite of several models then runs the
    history once."""
    return ModelGraph(raw, rates, staged)


#: shuffle files are removed when the job that made them ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Jobs in here leave no shuffle files behind: a build of many tables takes
    the disk of its largest job, not of all.  The setting is put back after."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def register_views(spark: SparkSession, graph: Mapping[str, DataFrame]) -> dict[str, str]:
    """Temp views for SQL users: the staged view, the classified table and
    the six marts under their table names (views stay lazy)."""
    names = {"staged": STAGED_VIEW, "classified": CLASSIFIED_TABLE, **dict(MART_TABLES)}
    for key, name in names.items():
        graph[key].createOrReplaceTempView(name)
    return names


def materialize(
    spark: SparkSession,
    raw: DataFrame,
    rates: DataFrame,
    base_dir: str | None = None,
    parallel: bool = True,
    marts_from_history: bool = False,
    buckets: int | None = None,
    staged: DataFrame | None = None,
) -> dict[str, str]:
    """Write classified and the six marts under ``base_dir`` (default: the
    session's ``spark.checkpoint.dir``), one folder per layer
    (``intermediate/``, ``marts/``); returns table name -> path.

    Order follows the model graph; every consumer reads its parent back from
    storage (full refresh, overwrite).  The weekly and monthly marts read a
    shared written table, the latest snapshot per claim, week and month, so
    the full classified table is scanned and thinned once for both.  It is
    stored in ``buckets`` by claim (default: the session's shuffle partitions),
    so neither mart shuffles it again: rank and lag run within the buckets.
    The row-level quality checks of every table are taken by its write and
    stored as the table ``quality/row_checks`` (see ``quality.run_checks``).
    After that the three branches (current; weekly -> transitions, metrics; monthly
    -> metrics) are independent and, with ``parallel``, run as concurrent
    Spark jobs from driver threads, so one branch's stragglers do not idle
    the cluster.  Writes of claim rows take turns, as each shuffles a whole mart:
    the disk holds the shuffle of one.  Such shuffles leave out the columns that
    follow from others of their row (``told_columns``).

    With ``marts_from_history`` the current/weekly/monthly marts are built
    from ``raw`` with the skew-planned composition (latest rows first, then
    classify) concurrently with the classified table instead of after it;
    their lineage is still a single job over a stored table.  ``staged``: the
    staged rows of ``raw``, where they are stored already; else they are stored
    for the time of the build, so the history runs once.

    Every job's shuffle files go when it ends (``shuffles_removed``)."""
    base = base_dir or ensure_checkpoint_dir(spark)
    with shuffles_removed(spark), ExitStack() as kept:
        if staged is None:
            staged = kept.enter_context(tables.stored_for_now(stage_claims(raw), _for_now(base, "staged")))
        return _materialize(spark, rates, base, parallel, marts_from_history, buckets, staged, kept.close)


def _for_now(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _materialize(
    spark: SparkSession,
    rates: DataFrame,
    base: str,
    parallel: bool,
    marts_from_history: bool,
    buckets: int | None,
    staged: DataFrame,
    used_up: Callable[[], None],
) -> dict[str, str]:
    names = dict(MART_TABLES)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    measured: list[tuple] = []
    turn, told = threading.Lock(), told_columns()

    @contextmanager
    def measuring(table: str) -> Iterator[tables.Measure]:
        measure = tables.Measure(**quality.measured_checks(table))
        yield measure
        measured.extend(quality.measured_results(table, measure))

    paths = {
        CLASSIFIED_TABLE: tables.layer_path(base, INTERMEDIATE, CLASSIFIED_TABLE),
        SEGMENT_TABLE: tables.layer_path(base, INTERMEDIATE, SEGMENT_TABLE),
    }
    paths.update({name: tables.layer_path(base, MARTS, name) for name in names.values()})

    def classified_branch() -> None:
        with measuring(quality.CLASSIFIED) as measure:
            table = classify(staged, rates)
            tables.write_partitioned(
                table.drop(*told), paths[CLASSIFIED_TABLE], "snapshot_date", ["claim_number", "status"],
                ranged=False, measure=measure, finish=tables.telling(told, table.columns),
            )

    def classified() -> DataFrame:
        return tables.read_table(spark, paths[CLASSIFIED_TABLE])

    def segments_step() -> None:
        """Latest per (claim, week, month) of the written classified table:
        the full history is thinned once for both the weekly and the
        monthly mart, which read all of it (no partitions needed).  The thinned
        rows are stored before they are dealt into buckets: one shuffle at a time."""
        table = classified()
        finish = tables.telling(told, table.columns)
        with tables.stored_for_now(latest_per_segment(table.drop(*told)), _for_now(base, "thinned")) as thinned:
            tables.write_bucketed(thinned, paths[SEGMENT_TABLE], *SEGMENT_ORDER, buckets, finish)

    @contextmanager
    def state_of(grain: PeriodGrain) -> Iterator[DataFrame]:
        if marts_from_history:
            yield period_state_from_staged(staged, rates, grain)
        else:
            with tables.bucketed_table(spark, paths[SEGMENT_TABLE], *SEGMENT_ORDER, buckets) as segments:
                yield period_state(segments, grain)

    def current_df() -> DataFrame:
        return current_from_staged(staged, rates) if marts_from_history else current_claims(classified())

    def write(key: str, df: DataFrame, date_column: str, cluster_by: list[str]) -> None:
        with measuring(key) as measure:
            tables.write_partitioned(df, paths[names[key]], date_column, cluster_by, measure=measure)

    def write_state(key: str, grain: PeriodGrain, date_column: str, cluster_by: list[str]) -> None:
        """The state is stored first, so ranks and lags run once, and its write
        can take turns."""
        later = told_of_state(grain, [date_column, *cluster_by])
        with turn, ExitStack() as kept:
            with state_of(grain) as state:
                rows = kept.enter_context(tables.stored_for_now(state.drop(*later), _for_now(base, "state")))
            with measuring(key) as measure:
                tables.write_partitioned(
                    rows, paths[names[key]], date_column, cluster_by,
                    measure=measure, finish=tables.telling(later, state.columns), turns=tables.turns_for(rows.count()),
                )

    def current_branch() -> None:
        with turn, measuring("current") as measure:
            current = current_df()
            tables.write_clustered(
                current.drop(*told), paths[names["current"]], ["claim_number", "status", "wbr_tier1"],
                measure=measure, finish=tables.telling(told, current.columns),
            )

    def weekly_branch() -> None:
        write_state("weekly", WEEKLY, "week_end_date", ["claim_number", "report_year", "report_week", "status"])
        weekly = tables.read_table(spark, paths[names["weekly"]])
        with turn:
            write("weekly_transitions", weekly_transitions(weekly), "week_end_date", ["claim_number", "transition_type"])
        write("weekly_metrics", weekly_metrics(weekly), "week_end_date", ["report_year", "report_week", "wbr_tier1", "status"])

    def monthly_branch() -> None:
        write_state("monthly", MONTHLY, "month_end_date", ["claim_number", "metric_year", "metric_month", "status"])
        monthly = tables.read_table(spark, paths[names["monthly"]])
        write("monthly_metrics", monthly_metrics(monthly), "month_end_date", ["metric_year", "metric_month", "wbr_tier1", "status"])

    branches = (weekly_branch, monthly_branch, current_branch)
    if marts_from_history:
        branches = (classified_branch, *branches)
    else:
        classified_branch()
        used_up()  # the rest reads the classified table
        segments_step()
    if parallel:
        with ThreadPoolExecutor(max_workers=len(branches)) as pool:
            for future in [pool.submit(b) for b in branches]:
                future.result()
    else:
        for branch in branches:
            branch()
    if marts_from_history:
        paths.pop(SEGMENT_TABLE)
    results = spark.createDataFrame(sorted(measured), quality.RESULT_SCHEMA)  # a row a check
    results.coalesce(1).write.mode("overwrite").parquet(tables.layer_path(base, QUALITY, ROW_CHECKS))
    return paths


def measured_checks(spark: SparkSession, base_dir: str) -> DataFrame:
    """Results of the quality checks that ``materialize`` took in its writes."""
    return tables.read_table(spark, tables.layer_path(base_dir, QUALITY, ROW_CHECKS))


def refresh(
    spark: SparkSession, raw: DataFrame, rates: DataFrame, categories: DataFrame, base_dir: str, prefix: str = ""
) -> dict[str, str]:
    """A full refresh in the catalog: seeds, classified and marts are written
    into a fresh folder under ``base_dir``, then all names in their layers'
    schemas (``staging``, ``intermediate``, ``marts``, ``seeds``, after
    ``prefix``) move to the new tables at once (``sources.versions``).  A
    reader of the old tables keeps their files.  The current mart gets the
    trigram table that searches use (``sources.search``).  The staged rows are written as
    well: the source may change after the refresh.  Returns table name ->
    path; folders of earlier refreshes may be deleted once nobody reads them."""
    run = f"{base_dir.rstrip('/')}/refresh-{uuid.uuid4().hex}"
    source = tables.layer_path(run, STAGING, STAGED_VIEW)
    staged = stage_claims(raw)
    with shuffles_removed(spark):
        staged.write.mode("overwrite").options(**tables.STORED).parquet(source)
    paths = materialize(spark, raw, rates, run, staged=spark.read.schema(staged.schema).parquet(source))
    layers = {name: INTERMEDIATE if name.startswith("int_") else MARTS for name in paths}
    for name, seed in ((CURRENCY_SEED, rates), (CATEGORY_SEED, categories)):
        paths[name], layers[name] = tables.layer_path(run, SEEDS, name), SEEDS
        seed.write.mode("overwrite").parquet(paths[name])
    paths[STAGED_VIEW], layers[STAGED_VIEW] = source, STAGING
    with shuffles_removed(spark):
        search.build_index(spark, paths[dict(MART_TABLES)["current"]])
    versions.publish(spark, base_dir, layers, paths, prefix)
    return paths
