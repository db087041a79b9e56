"""Benchmark decontamination by Wu-Manber search (operator 13).

The strings searched for are the benchmark's windows of ``WINDOW`` words (a
shorter item is one window).  The alphabet is words: a block is two of them.
The shift table has, for every block, how far the search may jump: a block that
no window holds lets it jump over all windows that would contain it.  Where the
shift is 0, some window ends with this block: the windows with that last and
that first block (the suffix bucket and the prefix in it) are looked up, and
their bytes are compared with the text's, so a hash never decides.  Windows of
equal bytes are one string with several items.

A batch's texts are searched at once, each in lanes of ``LANE`` words, by NumPy
steps that move all lanes.  Items are taken in blocks of some ``BLOCK_BYTES`` of
text, one table each; a block's table is broadcast, so its size is bounded
whatever the benchmark's.  The documents are read once per block and never
shuffled; with several blocks only hit documents meet again, by id and digest.

Cases: a null or empty text has no words and no hits; an item without words has
no windows; items with one id count once, a null id is the empty string; every
row gives a row, repeated ones too; of texts nothing is cut, however long; an
empty benchmark hits nothing; other columns aren't read.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimtide.llm.slices import mixed
from claimtide.llm.tables import written
from claimtide.llm.words import SliceTable, Words, same_bytes, text_chunks, words_of, xxhash64

#: words of a window.
WINDOW = 10
#: words that a lane searches, and candidates compared at once.
LANE, COMPARED = 64, 200_000
#: text of the items in one table.
BLOCK_BYTES = 4_000_000

_FIRST, _LAST = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _blocks(hashes: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The block that ends with word ``at``: one number for two words (or one)."""
    if width == 1:
        return mixed(hashes[at])
    return mixed(hashes[at - 1] * _FIRST + hashes[at])


class Strings(NamedTuple):
    """All windows of ``length`` words and their search tables."""

    length: int
    width: int  # words of a block
    shift: np.ndarray  # by the low bits of a block
    bucket: np.ndarray  # last and first block of each distinct window, sorted
    starts: np.ndarray  # the window's bytes in the items' words
    ends: np.ndarray
    items_from: np.ndarray  # its items: ``items[items_from[k]:items_from[k + 1]]``
    items: np.ndarray


def _bucket(last: np.ndarray, first: np.ndarray) -> np.ndarray:
    return mixed(last + first * _LAST)


def _strings(words: Words, hashes: np.ndarray, item_of: np.ndarray, firsts: np.ndarray, length: int) -> Strings:
    """Tables of the windows that begin with the words ``firsts``."""
    width = min(2, length)
    lasts = firsts + length - 1
    starts, ends = words.starts[firsts], words.ends[lasts]
    table = SliceTable(words.raw, starts, ends)
    size = 1 << max(8, (32 * len(firsts)).bit_length())
    shift = np.full(size, length - width + 1, np.uint8 if length < 256 else np.int32)
    for left in range(length - width, -1, -1):  # words after the block
        block = _blocks(hashes, lasts - left, width)
        shift[(block & np.uint64(size - 1)).astype(np.int64)] = left
    owners = table.owner[table.filled()]
    bucket = _bucket(_blocks(hashes, lasts[owners], width), _blocks(hashes, firsts[owners] + width - 1, width))
    order = np.argsort(bucket, kind="stable")
    owners = owners[order]
    rank = np.empty(len(table.owner), np.int64)
    rank[table.slot[owners]] = np.arange(len(owners))
    pairs = np.unique(np.stack([rank[table.slot], item_of[firsts]]), axis=1)
    return Strings(length, width, shift, bucket[order], starts[owners], ends[owners], np.searchsorted(pairs[0], np.arange(len(owners) + 1)), pairs[1])


class Benchmark:
    """Search tables of a block of items."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.names = sorted({name for name, _ in items})
        place = {name: k for k, name in enumerate(self.names)}
        words = words_of([text for _, text in items])
        hashes = xxhash64(words.raw, words.starts, words.ends)
        self.raw = words.raw
        count = np.diff(words.first)
        item_of = np.repeat(np.array([place[name] for name, _ in items], np.int64), count)
        left = np.repeat(words.first[1:], count) - np.arange(len(words.starts))
        self.strings = []
        with np.errstate(over="ignore"):
            for length in np.unique(np.minimum(count[count > 0], window)).tolist():
                # items of fewer words give windows of their own length
                whole = np.repeat(count, count)
                firsts = np.flatnonzero((left >= length) & ((whole == length) | ((length == window) & (whole > length))))
                self.strings.append(_strings(words, hashes, item_of, firsts, length))

    def search(self, words: Words) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Which words are hit, and (text, item) of all occurrences."""
        hit = np.zeros(len(words.starts) + 1, np.int64)
        pairs = [np.zeros((2, 0), np.int64)]
        if len(words.starts) and self.strings:
            text_of = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
            with np.errstate(over="ignore"):
                hashes = xxhash64(words.raw, words.starts, words.ends)
                for strings in self.strings:
                    last, string = self._occurrences(strings, words, hashes)
                    np.add.at(hit, last - strings.length + 1, 1)
                    np.add.at(hit, last + 1, -1)
                    told = np.unique(np.stack([text_of[last], string]), axis=1)
                    begin, many = strings.items_from[told[1]], np.diff(strings.items_from)[told[1]]
                    item = strings.items[np.repeat(begin - np.cumsum(many) + many, many) + np.arange(many.sum())]
                    pairs.append(np.unique(np.stack([np.repeat(told[0], many), item]), axis=1))
        every = np.unique(np.concatenate(pairs, axis=1), axis=1)
        return np.cumsum(hit[:-1]) > 0, list(zip(*every.tolist(), strict=True))

    def _occurrences(self, strings: Strings, words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(last word, string) of each occurrence."""
        length, width, low = strings.length, strings.width, np.uint64(len(strings.shift) - 1)
        # lanes of the places where a window may end, text by text
        first, after = words.first[:-1] + length - 1, words.first[1:]
        lanes = np.maximum(-(-(after - first) // LANE), 0)
        at = np.repeat(first, lanes) + LANE * (np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes))
        end = np.minimum(at + LANE, np.repeat(after, lanes))
        ends = []
        while len(at):
            jump = strings.shift[(_blocks(hashes, at, width) & low).astype(np.int64)]
            ends.append(at[jump == 0])
            at = at + np.maximum(jump, 1)
            at, end = at[at < end], end[at < end]
        ends = np.concatenate([*ends, np.zeros(0, np.intp)])
        bucket = _bucket(_blocks(hashes, ends, width), _blocks(hashes, ends - length + width, width))
        begin = np.searchsorted(strings.bucket, bucket)
        many = np.searchsorted(strings.bucket, bucket, side="right") - begin
        ends, begin, many = ends[many > 0], begin[many > 0], many[many > 0]
        reached = np.cumsum(many)
        found = [(np.zeros(0, np.intp), np.zeros(0, np.int64))]
        a = 0
        while a < len(ends):  # so many candidates at once, one place at least
            b = max(a + 1, int(np.searchsorted(reached, (reached[a - 1] if a else 0) + COMPARED, side="right")))
            n = many[a:b]
            string = np.repeat(begin[a:b] - np.cumsum(n) + n, n) + np.arange(n.sum())
            last = np.repeat(ends[a:b], n)
            same = same_bytes(words.raw, words.starts[last - length + 1], words.ends[last], self.raw, strings.starts[string], strings.ends[string])
            found.append((last[same], string[same]))
            a = b
        return tuple(np.concatenate(side) for side in zip(*found, strict=True))


def _item_blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> list[DataFrame]:
    """(name, text) of the items in blocks of about ``block_bytes``."""
    rows = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("name"), F.coalesce(F.col(text), F.lit("")).alias("text")).distinct()
    size = rows.agg(F.sum(F.octet_length("text") + F.octet_length("name"))).first()[0] or 0
    if size <= block_bytes:
        return [rows]
    count = -(-size // block_bytes)
    rows = written(rows.withColumn("block", F.pmod(F.xxhash64("name", "text"), F.lit(count))), "benchmark-items")
    return [rows.where(F.col("block") == k).drop("block") for k in range(count)]


def _searched(df: DataFrame, table, key: str, text: str, digests: bool) -> DataFrame:
    """Per row ``id``, ``n_words``, ``n_hit``, ``hits`` (one bit a word), ``items``
    and, if asked for, ``digest`` of the text."""
    schema = T.StructType([T.StructField("id", df.schema[key].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("hits", T.BinaryType()), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("digest", T.BinaryType())])

    def run(batches):
        benchmark = table.value
        for batch in batches:
            for first, texts in text_chunks(batch.column(1)):
                words = words_of(texts)
                hit, pairs = benchmark.search(words)
                items: list[list[str]] = [[] for _ in texts]
                for k, item in pairs:
                    items[k].append(benchmark.names[item])
                bits = [np.packbits(hit[a:b]).tobytes() if found else b"" for a, b, found in zip(words.first, words.first[1:], items, strict=False)]
                n_hit = np.diff(np.concatenate([[0], np.cumsum(hit)])[words.first])
                digest = [hashlib.sha256(t.encode()).digest() if digests else None for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(np.diff(words.first).astype(np.int64)), pa.array(n_hit.astype(np.int64)), pa.array(bits, pa.binary()), pa.array(items, pa.list_(pa.string())), pa.array(digest, pa.binary())],
                    schema.fieldNames(),
                )

    return df.select(key, text).mapInArrow(run, schema)


def _together(parts: DataFrame) -> DataFrame:
    """One row per hit (id, digest): the bits of all blocks, all items.  Rows
    that repeat an id and its text have the same hits."""
    one = parts.groupBy("id", "digest").agg(F.collect_set("hits").alias("parts"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    schema = T.StructType([one.schema["id"], one.schema["digest"], T.StructField("n_hit", T.LongType()), T.StructField("hits", T.BinaryType()), one.schema["items"]])

    def run(batches):
        for batch in batches:
            bits = [np.bitwise_or.reduce([np.frombuffer(p, np.uint8) for p in parts]) for parts in batch.column("parts").to_pylist()]
            n_hit = pa.array([int(np.unpackbits(b).sum()) for b in bits], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("digest"), n_hit, pa.array([b.tobytes() for b in bits], pa.binary()), batch.column("items")], schema.fieldNames())

    return one.mapInArrow(run, schema)


def search(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: ``key``, ``n_words``, ``n_hit`` (words), ``hits`` (a bit per
    word, from the highest of each byte; empty without hits) and ``items``
    (sorted names)."""
    context = df.sparkSession.sparkContext

    def table(items: DataFrame):
        return context.broadcast(Benchmark([(r["name"], r["text"]) for r in items.collect()], window))

    blocks = _item_blocks(benchmark, item, item_text, block_bytes)
    if len(blocks) == 1:
        return _searched(df, table(blocks[0]), key, text, False).withColumnRenamed("id", key).drop("digest")
    parts = []
    for block in blocks:
        held = table(block)
        parts.append(written(_searched(df, held, key, text, True).where(F.size("items") > 0), "benchmark-hits"))
        held.destroy()
    # rows without hits come from a search for nothing
    rows = _searched(df, context.broadcast(Benchmark([], window)), key, text, True).select("id", "n_words", "digest")
    found = _together(reduce(DataFrame.unionByName, parts)).select(F.struct("id", "digest", "n_hit", "hits", "items").alias("found"))
    joined = rows.join(found, rows["id"].eqNullSafe(F.col("found.id")) & (rows["digest"] == F.col("found.digest")), "left")
    return joined.select(F.col("id").alias(key), "n_words", F.coalesce("found.n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("found.hits", F.lit(b"")).alias("hits"), F.coalesce("found.items", F.array().cast("array<string>")).alias("items"))


def op13_wu_manber_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in all documents."""
    found = search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    names = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), names.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP13_SQL = rf"""
WITH worded AS MATERIALIZED (
  SELECT false AS item, doc_id AS id, w FROM (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents)
  UNION ALL
  SELECT true, item_id, w FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark)),
windows AS MATERIALIZED (
  SELECT DISTINCT id AS item_id, n, array_to_string(w[i + 1:i + n], ' ') AS words
  FROM (SELECT id, w, least(len(w), {WINDOW}) AS n, unnest(range(len(w) - least(len(w), {WINDOW}) + 1)) AS i FROM worded WHERE item AND len(w) > 0)),
places AS MATERIALIZED (
  SELECT id, n, i, array_to_string(w[i + 1:i + n], ' ') AS words
  FROM (SELECT id, n, w, unnest(range(len(w) - n + 1)) AS i
    FROM worded CROSS JOIN (SELECT DISTINCT n FROM windows) WHERE NOT item AND len(w) >= n)),
found AS MATERIALIZED (SELECT p.id, p.i, p.n, item_id FROM places p JOIN windows w USING (n, words)),
hits AS (
  SELECT id, count(DISTINCT spot) AS n_hit FROM (SELECT id, unnest(range(i, i + n)) AS spot FROM (SELECT DISTINCT id, i, n FROM found)) GROUP BY id),
items AS (
  SELECT id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names
  FROM found GROUP BY id)
SELECT d.id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM worded d LEFT JOIN hits h ON h.id = d.id LEFT JOIN items t ON t.id = d.id WHERE NOT item
"""
