"""Proportional stratified interleaving into shards (operator 10).

Rows of each source are put into a seeded random order and ranked; a row's
fraction is ``(rank - 1/2) / rows of its source``.  All rows sorted by that
fraction interleave the sources in proportion, so equal cuts of this order
give shards that all have the whole table's mixture, with row counts at most
one apart (law ``rows``).

No rank is taken in one task: both orders are range partitionings of the rows,
sorted within each task; a row's place is its place in the task plus the rows
of the tasks before.  The row's number is the last sort key, so neither a large
source nor rows of one id, nor many sources of one row with the same fraction,
meet in one task.  DataFrame functions only.

Cases: a null text has size 1 and the digest of no bytes; a null source is a
source of its own; null ids and repeated rows are ordered by the text's
checksum and size (rows equal in all of them are alike, so is any order of
theirs); an empty table gives no rows; other columns aren't read.  The law
deals single rows: copies of a text may lie in several shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimtide.llm.tables import join_groups, written

SHARDS = 8
SEED = "interleave-1"


def _placed(rows: DataFrame, order: list, name: str) -> DataFrame:
    """``rows`` with ``at``, their place from 0 in ``order``."""
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # the number's upper part is the partition, its lower 33 bits the row in it
    ordered = written(ordered.withColumn("in_task", F.monotonically_increasing_id()).withColumn("task", F.shiftright("in_task", 33)), name)
    sizes = ordered.groupBy("task").agg(F.count("*").alias("n"))  # a row a task
    before = sizes.select("task", (F.sum("n").over(W.orderBy("task")) - F.col("n")).alias("before"))
    inside = F.col("in_task").bitwiseAND((1 << 33) - 1)
    return ordered.join(F.broadcast(before), "task").withColumn("at", F.col("before") + inside).drop("in_task", "task", "before")


def shard(df: DataFrame, shards: int = SHARDS, seed: str = SEED, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """Per row: ``key``, ``source``, ``size``, ``text_crc32``, ``shard`` and
    ``slot`` (place inside the shard, from 0)."""
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    shuffled = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    rows = written(
        df.select(
            F.col(key).alias("id"), F.col(source).cast("string").alias("origin"), (F.octet_length(content) + 1).cast("long").alias("size"),
            F.crc32(content).alias("crc"), shuffled.alias("place"), F.monotonically_increasing_id().alias("row"),
        ),
        "shard-rows",
    )
    total = rows.count()
    in_source = [F.col("place"), F.col("id").asc_nulls_first(), F.col("crc"), F.col("size"), F.col("row")]
    by_source = _placed(rows, [F.col("origin").asc_nulls_first(), *in_source], "shard-sources")
    # a source's rows lie one after the other
    origin = F.struct(F.col("origin").isNull(), F.coalesce("origin", F.lit(""))).alias("key")
    begins = by_source.groupBy(origin).agg(F.min("at").alias("begin"), F.count("*").alias("of_origin"))
    ranked = join_groups(by_source.withColumn("key", origin), begins, "key", "of_origin")
    rank = F.col("at") - F.col("begin") + 1
    fraction = (2 * rank - 1) / (2 * F.col("of_origin"))
    mixed = ranked.select("id", "origin", "size", "crc", "place", "row", fraction.alias("fraction"))
    placed = _placed(mixed, [F.col("fraction"), F.col("origin").asc_nulls_first(), *in_source], "shard-order")
    number = F.expr(f"at * {shards} div {max(1, total)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", number).select(
        F.col("id").alias(key), F.col("origin").alias(source), "size", F.col("crc").alias("text_crc32"), F.col("shard").cast("int").alias("shard"), (F.col("at") - first).alias("slot")
    )


def op10_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7."""
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source"
    )


def _crc_table() -> list[int]:
    """CRC-32 of the sixteen half bytes, by its polynomial."""
    table = list(range(16))
    for _ in range(4):
        table = [c >> 1 ^ (0xEDB88320 if c & 1 else 0) for c in table]
    return table


def _half(register: str) -> str:
    return f"xor(({register}) >> 4, {_crc_table()}[(({register}) & 15) + 1])"


OP10_SQL = f"""
WITH bytes AS (
  SELECT doc_id, source, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x:
    (strpos('0123456789ABCDEF', x[1]) - 1) * 16 + strpos('0123456789ABCDEF', x[2]) - 1) AS b
  FROM documents),
summed AS (
  SELECT doc_id, source, CAST(len(b) + 1 AS BIGINT) AS size,
    xor(list_reduce(b, lambda c, x: {_half(_half("xor(c, x)"))}, 4294967295::BIGINT), 4294967295) AS text_crc32
  FROM bytes),
ranked AS (
  SELECT *, md5('{SEED}:' || doc_id) AS place,
    row_number() OVER (PARTITION BY source ORDER BY md5('{SEED}:' || doc_id), doc_id, text_crc32, size) AS rank,
    count(*) OVER (PARTITION BY source) AS of_source, count(*) OVER () AS total
  FROM summed),
dealt AS (
  SELECT *, row_number() OVER (
    ORDER BY CAST(2 * rank - 1 AS DOUBLE) / (2 * of_source), source, place, doc_id, text_crc32, size) - 1 AS pos
  FROM ranked)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(pos * {SHARDS} // total AS INTEGER) AS shard,
  pos - (pos * {SHARDS} // total * total + {SHARDS - 1}) // {SHARDS} AS slot, CAST(NULL AS INTEGER) AS grown_shard, source
FROM dealt
"""
