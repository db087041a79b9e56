"""Exact de-duplication with a persistent digest index (operator 8).

The index is a table of digests, bucketed and sorted by digest, that outlives
a run.  A batch is reduced to one row per digest (partial counts before the
shuffle), sort-merge anti-joined with the index, whose buckets need no
shuffle, and what is new is appended.  Texts are equal when their normalised
forms (each run of white space one space) have one SHA-256 digest.

Every digest is stored with its batch, and a batch's own digests count as
unseen.  So a batch that failed after its append, or whose output was lost, is
run again under its name and gives the same rows; without a name each call is a
batch of its own.  Writers take turns; a digest that two of them added at once
counts as one, of the smaller id.

The rows get their group back by a join on the digest.  Digests that hold a
thousandth of the batch or more (there are a thousand at most) are joined by
broadcast, so no group of copies, however large, meets in one task.

Cases: a null text counts as empty, and empty texts are equal; of rows with
equal text and equal (or null) id exactly one stays; null ids come after all
others; a batch may be empty; other columns are carried untouched, and names
this operator uses inside cannot clash (they are structs of its own).
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimtide.llm.tables import discard, every_column, join_groups, scratch, written

BUCKETS = 32


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


class DigestIndex:
    """Digests seen so far, each with the id of the row that stayed and its batch.

    ``path`` names the table's folder; an index opened again on the same path
    goes on where it ended, with the number of buckets it began with.  While it
    is open the catalog has a table for it; ``close`` takes that out again."""

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint", buckets: int = BUCKETS):
        self.spark, self.name, self.path = spark, f"digest_index_{uuid.uuid4().hex}", f"{path}/digests"
        try:
            buckets = spark.read.schema("buckets int").parquet(f"{path}/form").first()["buckets"]
        except AnalysisException:
            spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(f"{path}/form")
        self.buckets = buckets
        spark.sql(
            f"CREATE TABLE {self.name} (digest BINARY, keep_id {id_type}, batch STRING) USING parquet OPTIONS (path '{self.path}') "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS"
        )

    def __enter__(self) -> DigestIndex:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        """Takes the name out of the catalog; the digests stay on ``path``."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def before(self, batch: str) -> DataFrame:
        """(digest, keep_id) of all other batches, each digest once; grouped
        within its bucket, so without a shuffle."""
        return self.table().where(F.col("batch") != batch).groupBy("digest").agg(F.min("keep_id").alias("keep_id"))

    def unseen(self, digests: DataFrame, batch: str) -> DataFrame:
        """Rows of ``digests`` that no other batch has (sort-merge anti-join)."""
        others = self.table().where(F.col("batch") != batch)
        return digests.join(others.hint("merge"), "digest", "left_anti")

    def append(self, digests: DataFrame, batch: str) -> None:
        """Adds those of the ``(digest, keep_id)`` rows that the index doesn't
        have at all: what an earlier run of the batch has added stays."""
        new = digests.select("digest", "keep_id", F.lit(batch).alias("batch")).join(self.table().hint("merge"), "digest", "left_anti")
        new = written(new, "digest-new")  # the table can't be read while it is written
        new.write.format("parquet").mode("append").bucketBy(self.buckets, "digest").sortBy("digest").option("path", self.path).saveAsTable(self.name)
        discard(new)


def dedup(df: DataFrame, index: DigestIndex, key: str = "doc_id", text: str = "text", batch: str | None = None) -> DataFrame:
    """Per row of the batch: ``key``, ``digest``, ``keep_id``, ``group_size``
    (rows of this batch), ``kept``, ``row`` (a number of the row).  Texts that
    an earlier batch had keep that batch's id and drop all their rows here.
    ``batch`` names it, so that it may be run again."""
    batch = batch or uuid.uuid4().hex
    rows = written(
        df.select(F.col(key).alias("id"), F.unhex(F.sha2(normalised(F.col(text)), 256)).alias("digest"), F.monotonically_increasing_id().alias("row")),
        "digest-rows",
    )
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    groups = written(rows.groupBy("digest").agg(first.alias("first"), F.count("*").alias("group_size")), "digest-groups")
    earlier = groups.join(index.before(batch).hint("merge").select("digest", F.col("keep_id").alias("before"), F.lit(True).alias("seen")), "digest", "left")
    decided = written(
        earlier.select("digest", "group_size", F.coalesce("seen", F.lit(False)).alias("seen"), F.when(F.col("seen"), F.col("before")).otherwise(F.col("first.id")).alias("keep_id"), F.col("first.row").alias("keep_row")),
        "digest-decisions",
    )
    discard(groups)
    index.append(decided.where(~F.col("seen")), batch)
    together = join_groups(rows, decided, "digest", "group_size")
    return together.select(
        F.col("id").alias(key), "digest", "keep_id", "group_size", (~F.col("seen") & (F.col("row") == F.col("keep_row"))).alias("kept"), "row"
    )


def distinct_texts(df: DataFrame, index: DigestIndex, key: str = "doc_id", text: str = "text", batch: str | None = None) -> DataFrame:
    """The rows of ``df`` that stay, with all their columns.  Of rows that
    repeat both id and text one stays, any: they differ in other columns only.
    ``batch`` names these rows, so that they may be run again."""
    batch = batch or uuid.uuid4().hex
    digest = F.unhex(F.sha2(normalised(F.col(text)), 256))
    rows = written(df.select(F.col(key).alias("id"), digest.alias("digest")), "distinct-rows")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id"))
    groups = rows.groupBy("digest").agg(first.alias("first")).select("digest", F.col("first.id").alias("keep_id"))
    new = written(index.unseen(groups, batch), "distinct-new")
    discard(rows)
    index.append(new, batch)
    inner = df.select(F.struct(*every_column(df)).alias("row"), F.col(key).alias("id"), digest.alias("digest"))
    kept = new.select(F.struct("digest", "keep_id").alias("stay"))
    met = inner.join(kept, (inner["digest"] == kept["stay.digest"]) & inner["id"].eqNullSafe(kept["stay.keep_id"]))
    turn = F.row_number().over(W.partitionBy("digest", "id").orderBy(F.lit(1)))
    return met.withColumn("turn", turn).where("turn = 1").select("row.*")


def op8_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against an index that is empty at first."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with DigestIndex(spark, scratch(spark, "digest-index"), documents.schema["doc_id"].dataType.simpleString()) as index:
        found = dedup(documents, index)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP8_SQL = r"""
WITH hashed AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM hashed WINDOW g AS (PARTITION BY text_sha256)
"""
