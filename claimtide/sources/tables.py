"""Table sinks and readers: month-partitioned/clustered Parquet tables, mart
lookup by name, month-pruned reads and CSV export."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from claimtide.schemas import MART_TABLES

#: hidden partition column holding the first day of the partition month.
MONTH_PARTITION = "partition_month"

#: layer folders (the source project's schema per layer)
STAGING, INTERMEDIATE, MARTS, SEEDS = "staging", "intermediate", "marts", "seeds"

#: bound on rows per written file, so a hot month still splits into files.
MAX_RECORDS_PER_FILE = 5_000_000

#: how tables are stored: half the bytes of the default for keys and numbers.
STORED = {"compression": "zstd"}

#: what a writer does with rows once they are dealt to tasks.
Finish = Callable[[DataFrame], DataFrame]


def telling(told: Mapping[str, Column], columns: list[str]) -> Finish:
    """Puts ``told``, columns that follow from others of their row, back into
    rows that were dealt without them, in the order of ``columns``."""
    return lambda df: df.withColumns(dict(told)).select(*columns, *(c for c in df.columns if c not in columns))


class Measure:
    """Counts of the rows that a write puts out, taken by its tasks; they are
    there once the write is done.  ``rows`` is always among them.  A write in
    several turns is measured by each, and their counts are added up."""

    def __init__(self, **columns: Column):
        self.columns = {"rows": F.count(F.lit(1)), **columns}
        self.taken: list[Observation] = []

    def on(self, df: DataFrame) -> DataFrame:
        self.taken.append(Observation(f"measure-{uuid.uuid4().hex}"))
        return df.observe(self.taken[-1], *(c.alias(name) for name, c in self.columns.items()))

    def __getitem__(self, name: str) -> int:
        return sum(turn.get[name] or 0 for turn in self.taken)


def _measured(df: DataFrame, measure: Measure | None) -> DataFrame:
    return measure.on(df) if measure else df


#: rows that one turn of a write shuffles, and most turns.
TURN_ROWS, MOST_TURNS = 10_000_000, 3


def turns_for(rows: int) -> int:
    """Turns to write so many rows in."""
    return min(MOST_TURNS, max(1, -(-rows // TURN_ROWS)))


def write_partitioned(
    df: DataFrame,
    path: str,
    date_column: str,
    cluster_by: list[str],
    mode: str = "overwrite",
    ranged: bool = True,
    measure: Measure | None = None,
    finish: Finish | None = None,
    turns: int = 1,
) -> None:
    """Month-partitioned, clustered table.

    Rows are dealt to tasks by ranges of (month, first cluster column, ...), so
    a task writes one or a few month directories, and a month too big for one
    task becomes many files with disjoint ranges of the cluster columns: their
    Parquet statistics prune whole files.  The boundaries come from a sample of
    what is written, for which Spark runs the plan after its last exchange once
    more.

    Without ``ranged`` rows are dealt by ``REBALANCE(month)``, with no pass for
    a sample: AQE splits a big month from the measured shuffle sizes, and each
    of its files is sorted but spans all of the month.  That suits the widest
    table, whose plan is dear and which is read whole.

    ``finish``: a projection of the dealt and sorted rows that adds columns which
    need not be shuffled (``telling``); it keeps the others.

    ``turns``: months are written in so many turns, and the disk holds the
    shuffle of one.  Each turn reads ``df``: give a written one.

    ``measure`` is taken from the rows on their way into the files.  A table
    without rows has no month directory, but a file that tells its columns."""
    measure = measure or Measure()
    dated = df.withColumn(MONTH_PARTITION, F.trunc(F.col(date_column), "month"))
    for turn in range(turns):
        placed = dated.where(F.pmod(F.hash(MONTH_PARTITION), F.lit(turns)) == turn) if turns > 1 else dated
        placed = placed.repartitionByRange(MONTH_PARTITION, *cluster_by) if ranged else placed.hint("rebalance", MONTH_PARTITION)
        placed = placed.sortWithinPartitions(MONTH_PARTITION, *cluster_by)
        placed = finish(placed) if finish else placed
        (
            measure.on(placed)
            .write.mode("append" if turn else mode)
            .options(**STORED, maxRecordsPerFile=MAX_RECORDS_PER_FILE)
            .partitionBy(MONTH_PARTITION)
            .parquet(path)
        )
    if measure["rows"] == 0 and mode == "overwrite":
        placed.limit(0).write.mode(mode).options(**STORED).parquet(path)


def write_clustered(
    df: DataFrame,
    path: str,
    cluster_by: list[str],
    mode: str = "overwrite",
    measure: Measure | None = None,
    finish: Finish | None = None,
) -> None:
    """Clustered table without partitions (the current-state mart): a file
    holds one range of the cluster columns, sorted, so a point lookup opens
    one file and skips the others by their statistics.  The ranges come from
    a sample, which reads ``df`` once more: give a cheap or written one.
    ``finish``: as in ``write_partitioned``."""
    placed = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    placed = finish(placed) if finish else placed
    _measured(placed, measure).write.mode(mode).options(**STORED, maxRecordsPerFile=MAX_RECORDS_PER_FILE).parquet(path)


#: rows of a bucket, which a task sorts whole, that it can hold in memory.
BUCKET_ROWS, LEAST_BUCKETS = 250_000, 16


def buckets_for(rows: int) -> int:
    """Buckets of a table of so many rows: a bucket stays small as it grows."""
    return max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS))


def write_bucketed(
    df: DataFrame, path: str, column: str, sort_by: list[str], buckets: int, finish: Finish | None = None
) -> None:
    """Table in files by the hash of ``column``, sorted.  Rows are dealt by that
    hash first, so a bucket is one file.  ``finish``: what is done with them
    then; it must leave them where they are."""
    name = f"bucketed_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, column)
    dealt = finish(dealt) if finish else dealt
    dealt.write.format("parquet").options(**STORED).bucketBy(buckets, column).sortBy(column, *sort_by).option("path", path).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")  # the name; the files stay


@contextmanager
def bucketed_table(spark: SparkSession, path: str, column: str, sort_by: list[str], buckets: int) -> Iterator[DataFrame]:
    """A table of ``write_bucketed``, of which Spark knows the buckets: grouping
    and windows on ``column`` need no exchange.  Buckets are known through the
    catalog, which has a name for the table in the meantime."""
    name = f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (path '{path}') "
        f"CLUSTERED BY ({column}) SORTED BY ({', '.join([column, *sort_by])}) INTO {buckets} BUCKETS"
    )
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is stored at ``path``."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes what is stored at ``path``."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def stored_for_now(df: DataFrame, path: str) -> Iterator[DataFrame]:
    """``df`` written at ``path`` and read back; its files go in the end, so use
    it up in between.  A long job in steps then takes the disk of its largest
    step and not of all: written rows take far less than shuffled ones."""
    spark = df.sparkSession
    try:
        df.write.options(**STORED).parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A written table without its hidden partition column."""
    df = spark.read.parquet(path)
    if MONTH_PARTITION in df.columns:
        df = df.drop(MONTH_PARTITION)
    return df


def read_month_range(spark: SparkSession, path: str, date_column: str, start, end) -> DataFrame:
    """Rows with ``start <= date_column <= end`` of a month-partitioned table.

    A filter on the date column alone does not prune the derived month
    partitions, so the month bounds are added explicitly; both filters reach
    the scan (partition filter + pushed Parquet filter)."""
    df = spark.read.parquet(path)
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    df = df.where(
        F.col(MONTH_PARTITION).between(F.trunc(lo, "month"), F.trunc(hi, "month"))
        & F.col(date_column).between(lo, hi)
    )
    return df.drop(MONTH_PARTITION)


def layer_path(base_dir: str, layer: str, table: str) -> str:
    return f"{base_dir.rstrip('/')}/{layer}/{table}"


def read_mart(spark: SparkSession, base_dir: str | None, table: str, prefix: str = "") -> DataFrame:
    """``select *`` of one of the six marts by its table name: from the folder
    of a build or, without one, from the catalog's ``marts`` schema.  Several
    marts of one refresh: ``versions.open_version``."""
    names = {name for _key, name in MART_TABLES}
    if table not in names:
        raise ValueError(f"no such mart: {table!r}")
    if base_dir is None:
        return spark.table(f"`{prefix}{MARTS}`.`{table}`")
    return read_table(spark, layer_path(base_dir, MARTS, table))


#: both ways: quotes are doubled, spaces at the edges stay, an empty text is
#: quoted and a null is not, so that the two differ.
_CSV = {
    "header": "true",
    "encoding": "UTF-8",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> int:
    """CSV export with a header, as any CSV reader takes it; returns the number
    of rows, counted by the writing tasks.  ``single_file`` only for small
    results (a review pivot); extracts are written by all tasks."""
    rows = Measure()
    out = rows.on(df.coalesce(1) if single_file else df)
    out.write.mode("overwrite").options(**_CSV, nullValue="", emptyValue='""').csv(path)
    return rows["rows"]


def write_csv_file(df: DataFrame, path: str) -> int:
    """One CSV file at ``path`` in the order of ``df``, written by many tasks;
    returns the number of rows.

    The parts are written in order, without a header, beside the file.  Their
    sizes tell where each one's bytes lie: a store that can join files by their
    names (``concat``) does, on a file system every task copies its part to its
    place.  A task that is run again writes the same bytes at the same place.
    Other stores are refused; ``write_csv`` gives them the parts."""
    spark = df.sparkSession
    parts = f"{path}.parts-{uuid.uuid4().hex}"
    rows = Measure()
    options = {**_CSV, "header": "false", "nullValue": "", "emptyValue": '""'}
    rows.on(df).write.options(**options).csv(parts)
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, folder = hadoop.Path(path), hadoop.Path(parts)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    # names and sizes of the parts; their order is the tasks'
    found = sorted((s.getPath().getName(), s.getLen(), s.getPath()) for s in store.listStatus(folder) if s.getPath().getName().startswith("part-"))
    quoted = ['"' + c.replace('"', '""') + '"' if any(x in c for x in ',"\n\r') or c != c.strip() else c for c in df.columns]
    header = (",".join(quoted) + "\n").encode()
    out = store.create(target, True)
    out.write(bytearray(header))
    out.close()
    if store.getUri().getScheme() == "file":
        places, at = {}, len(header)
        for name, size, _ in found:
            places[name] = at
            at += size
        file = target.toUri().getPath()
        # the tasks' bytes pass by the store's checksum beside the file
        store.delete(hadoop.Path(target.getParent(), f".{target.getName()}.crc"), False)

        def copy(batches):
            for batch in batches:
                for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                    with open(file, "r+b") as whole:
                        whole.seek(places[name.rsplit("/", 1)[1]])
                        whole.write(content.as_buffer())
            yield from ()

        if found:
            content = spark.read.format("binaryFile").load(parts).select("path", "content")
            content.repartition(len(found)).mapInArrow(copy, "done int").count()
    else:
        sources = spark._sc._gateway.new_array(hadoop.Path, len(found))
        for k, (_, _, part) in enumerate(found):
            sources[k] = part
        try:
            store.concat(target, sources)
        except Py4JJavaError as refused:
            raise ValueError(f"this store joins no files; the parts are in {parts}, in order") from refused
    store.delete(folder, True)
    return rows["rows"]


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """An export read back; values may hold line breaks."""
    return spark.read.schema(schema).options(**_CSV, multiLine="true", nullValue="\u0000", emptyValue="").csv(path)
