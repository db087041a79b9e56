"""Importance resampling towards a target distribution (operator 11).

Words and runs of words are hashed into buckets.  A bucket's gain says how much
more frequent it is in the target's texts than in the corpus; a document's
weight is its mean gain, and the rows drawn are those with the highest weight
plus Gumbel noise that the row's id decides, which is a draw without
replacement in proportion to the weights.

Features are interned a batch at a time in an open-addressed table
(``words.SliceTable``: xxhash64 keys, bytes compared).  A slot holds its
feature's bucket and count; counting adds slots up by bucket, weighing gathers
the gains of all occurrences by their slot.  Corpus counts run over all rows.
Only bucket counts (``BUCKETS`` at most) reach the driver.  Ranks come from one
range partitioning of the rows at or above the last drawn score, found in a
histogram of scores (whole numbers between the logarithms of the counts), so
no task holds more than its share, ties included.

Cases: a null or empty text has no features and weight 0; a null id has the
noise of the empty id and comes after all others of its score; every row gives
a row; of rows equal in score and id any order is right; empty tables give no
rows, an empty target gains from absence alone; texts are never cut; other
columns aren't read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimtide.llm.tables import written
from claimtide.llm.words import SliceTable, text_chunks, words_of

#: runs of one to so many words are features.
LONGEST = 1
BUCKETS = 10_000
SEED = "2024"
#: rows with fewer words aren't drawn; so many of a hundred others are.
LEAST_WORDS = 20
PERCENT = 10


def _features(texts: list[str], longest: int, buckets: int):
    """Words of each text, and for each length of run its occurrences' slots
    and texts and the slots' buckets."""
    words = words_of(texts)
    runs = []
    for n in range(1, longest + 1):
        starts, ends, text = words.grams(n)
        table = SliceTable(words.raw, starts, ends)
        bucket = np.zeros(len(table.owner), np.int32)
        raw = words.raw.tobytes()
        for slot, owner in zip(filled := table.filled(), table.owner[filled], strict=True):
            bucket[slot] = zlib.crc32(raw[starts[owner] : ends[owner]]) % buckets
        runs.append((table.slot, text, bucket))
    return np.diff(words.first), runs


def bucket_counts(df: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all texts."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, texts in text_chunks(batch.column(0)):
                for slot, _, bucket in _features(texts, longest, buckets)[1]:
                    count = np.bincount(slot, minlength=len(bucket))
                    np.add.at(total, bucket, count)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for bucket, n in df.select(text).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of the smoothed frequencies' ratio."""
    s_all, t_all, buckets = float(corpus.sum()), float(target.sum()), len(corpus)
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets)))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)],
        np.int64,
    )


def weights(df: DataFrame, gains: np.ndarray, key: str = "doc_id", text: str = "text", longest: int = LONGEST) -> DataFrame:
    """Per row: ``id``, ``n_words``, ``n_features``, ``weight``."""
    schema = T.StructType([T.StructField("id", df.schema[key].dataType), *(T.StructField(c, T.LongType(), False) for c in ("n_words", "n_features", "weight"))])

    def run(batches):
        for batch in batches:
            for first, texts in text_chunks(batch.column(1)):
                n_words, runs = _features(texts, longest, len(gains))
                n, total = np.zeros((2, len(texts)), np.int64)
                for slot, of_text, bucket in runs:
                    # occurrences lie text by text; whole numbers add up exactly
                    running = np.concatenate([[0], np.cumsum(gains[bucket][slot])])
                    begins = np.searchsorted(of_text, np.arange(len(texts) + 1))
                    n += np.diff(begins)
                    total += np.diff(running[begins])
                weight = total // np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), *(pa.array(x.astype(np.int64)) for x in (n_words, n, weight))], schema.fieldNames())

    return df.select(key, text).mapInArrow(run, schema)


def _ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``place``, from 1 by falling score, then rising id."""
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    # the id's upper part is the partition, its lower 33 bits the row in it
    placed = written(placed.withColumn("part", F.shiftright("at", 33)), "importance-order")
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"))  # a row a task
    before = sizes.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    return placed.join(F.broadcast(before), "part").withColumn("place", F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1) + 1).drop("at", "part", "before")


def draw(weighed: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: str = SEED) -> DataFrame:
    """Per row of ``weights``: its columns, ``score`` and ``rank`` (null for
    rows that aren't drawn)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(float(1 << 32)))))
    rows = written(weighed.withColumns({"score": F.col("weight") + noise, "row": F.monotonically_increasing_id()}), "importance-scores")
    may = F.col("n_words") >= least_words
    scores = rows.where(may).groupBy("score").agg(F.count("*").alias("n"))
    down = scores.select("score", F.sum("n").over(W.orderBy(F.desc("score"))).alias("reached"), F.sum("n").over(W.partitionBy()).alias("total"))
    drawn = F.expr(f"total * {percent} div 100")
    cut = down.where((F.col("reached") >= drawn) & (drawn > 0)).agg(F.max("score"), F.max(drawn)).first()
    none = F.lit(None).cast("long").alias("rank")
    columns = ["id", "n_words", "n_features", "weight", "score"]
    if cut[0] is None:
        return rows.select(*columns, none)
    high = may & (F.col("score") >= cut[0])
    ranked = _ranked(rows.where(high)).select(*columns, F.when(F.col("place") <= cut[1], F.col("place")).alias("rank"))
    return ranked.unionByName(rows.where(~high).select(*columns, none))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, drawn towards the benchmark's words."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    gains = bucket_gains(bucket_counts(documents), bucket_counts(benchmark))
    return draw(weights(documents, gains)).select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def _byte_crc(register: str) -> str:
    """The register after its low byte has been shifted out, bit by bit."""
    for _ in range(8):
        register = f"list_transform([{register}], lambda r: CASE WHEN r & 1 = 1 THEN xor(r >> 1, {0xEDB88320}) ELSE r >> 1 END)[1]"
    return register


OP11_SQL = rf"""
WITH every AS (
  SELECT false AS target, doc_id AS id, text FROM documents UNION ALL SELECT true, NULL, text FROM benchmark),
worded AS (
  SELECT target, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM every),
placed AS MATERIALIZED (SELECT target, id, unnest(w) AS word FROM worded),
hashed AS MATERIALIZED (
  SELECT word, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(word)), '..'), lambda x:
      CAST((strpos('0123456789ABCDEF', x[1]) - 1) * 16 + strpos('0123456789ABCDEF', x[2]) - 1 AS BIGINT)),
    lambda c, x: {_byte_crc("xor(c, x)")}, 4294967295::BIGINT), 4294967295) % {BUCKETS} AS bucket
  FROM (SELECT DISTINCT word FROM placed)),
counted AS (
  SELECT bucket, count(*) FILTER (NOT target) AS s, count(*) FILTER (target) AS t FROM placed JOIN hashed USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1.0::DOUBLE) * (sum(s) OVER () + {BUCKETS})::DOUBLE
    / ((s + 1.0::DOUBLE) * (sum(t) OVER () + {BUCKETS})::DOUBLE))) AS BIGINT) AS gain
  FROM counted),
weighed AS (
  SELECT id, CAST(count(*) AS BIGINT) AS n, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight
  FROM placed JOIN hashed USING (word) JOIN gains USING (bucket) WHERE NOT target GROUP BY id),
scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((('0x' || sha256('{SEED}:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM documents LEFT JOIN weighed ON id = doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= {LEAST_WORDS} ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (n_features >= {LEAST_WORDS}) OVER () AS total
  FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_features >= {LEAST_WORDS} AND place <= total * {PERCENT} // 100 THEN place END AS rank
FROM ranked
"""
