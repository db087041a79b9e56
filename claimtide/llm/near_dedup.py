"""Near-duplicate detection with SetSketch registers (operator 6).

A document's set is its distinct 5-word shingles.  Its sketch holds, for each
of ``REGISTERS`` hash functions, the least exponentially distributed value of
the set on a logarithmic scale, truncated to a small integer: registers merge
by their maximum, and two sets agree in one about as often as their Jaccard
similarity says.  Bands of registers give candidates, the registers and set
sizes of a pair give its similarity by maximum likelihood, and pairs that may
reach the threshold are confirmed on the full sets.

A bucket's members are not paired with each other.  Documents with equal sets
form one class first.  Then every member of a bucket is compared with one of
them, the bucket's pivot, and links are merged into components.  Only buckets
of three and more that still hold several components go on: the members
outside their bucket's largest component are compared with all of another
component, on the full sets, in one tile: it counts the common shingles of all
its pairs by one matrix product and returns no more links than it has members
(those that join components).  A bucket of more than ``TILE`` members is crowded:
many documents of one template, say, that mostly aren't linked.  Its members
meet by their rarest shingles instead (a prefix filter: of n shingles so many
that every linked set has one of them among its own), which members without a
link hardly share, so the work grows with the members, not with their pairs.
Where even a rare shingle has more than ``TILE`` members, they are cut into tiles
of ``TILE`` by ``TILE``, many tasks; so is the crowded bucket itself where that
sends fewer sets.  Components come from
repeated minima over written tables; nothing but counts reaches the driver.

Cases: null, empty and wordless texts have an empty set, are linked with
nothing and all stay; fewer words than a shingle count as one shingle; every
input row gives a row, repeated ones too; rows of one id with different texts
are documents of their own; null ids come before all others; an empty table
gives no rows; other columns are carried untouched by ``first_documents``.
"""

from __future__ import annotations

import hashlib
import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimtide.llm.slices import mixed
from claimtide.llm.tables import discard, every_column, join_groups, written

WORDS = 5
#: links need ``100 * intersection >= PERCENT * union``.
PERCENT = 85
#: a pair at the threshold shares no band with this chance at most.
BAND_MISS = 2.1e-8
#: registers of a band; fewer where a low threshold needs more bands than fit.
ROWS = 4
#: all of them count for the estimate, the first ones are banded.
REGISTERS = 160
#: the register scale: base, rate and largest value.
BASE, RATE, LARGEST = 1.001, 20.0, 65535
#: pairs whose estimate lies this many of its errors below the threshold are
#: not confirmed.
ERRORS = 9
#: bytes of text sketched at once.
CHUNK_BYTES = 3_000_000
#: members on either side of a tile, and columns multiplied at once.
TILE, COLUMNS = 512, 16_384
#: counters of shingles' rarity in crowded buckets.
RARITIES = 1 << 20

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_MULTIPLIERS = np.random.default_rng(11).integers(1, 1 << 62, REGISTERS).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = np.random.default_rng(13).integers(1, 1 << 62, WORDS).astype(np.uint64) * np.uint64(2) + np.uint64(1)


class Limits(NamedTuple):
    """What a threshold needs to lose none of its pairs."""

    bands: int
    rows: int
    least_estimate: float


def limits(percent: int) -> Limits:
    """Bands and least estimate for links of ``percent``: two sets agree in a
    register as often as their similarity says."""
    at = percent / 100
    if 0 < at <= 1:
        for rows in range(ROWS, 0, -1):
            bands = math.ceil(math.log(BAND_MISS) / math.log1p(-(min(at, 0.999) ** rows)))
            if bands * rows <= REGISTERS:
                return Limits(bands, rows, at - ERRORS * math.sqrt(at * (1 - at) / REGISTERS))
    raise ValueError(f"{REGISTERS} registers don't find links of {percent} percent")


def word_digests(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits for every word: of up to 8 bytes the bytes themselves, mixed; of
    longer ones a cryptographic digest, so that no pattern in the words makes
    two of them equal.  ``raw`` ends with 8 bytes that no word has."""
    length = ends - starts
    lanes = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
    value = lanes[starts] & (~np.uint64(0) >> ((8 - np.minimum(length, 8)) * 8).astype(np.uint64))
    out = mixed(mixed(value) + length.astype(np.uint64))
    data, known = raw.tobytes(), {}
    for k in np.flatnonzero(length > 8).tolist():
        word = data[starts[k] : ends[k]]
        if word not in known:
            known[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        out[k] = known[word]
    return out


def shingle_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, one after the other, and where
    each text's begin (with the end of the last)."""
    encoded = [t.encode().translate(_LOWER) for t in texts]
    raw = np.frombuffer(b" ".join([*encoded, b" " * 8]), np.uint8)
    begins = np.cumsum([0] + [len(e) + 1 for e in encoded])[:-1]
    word = np.zeros(len(raw) + 2, np.int8)
    word[1:-1] = ~_SPACE[raw]
    edge = np.diff(word)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    none = np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.intp)
    if not len(starts):
        return none
    digest = word_digests(raw, starts, ends)
    text_of = np.searchsorted(begins, starts, side="right") - 1
    count = np.bincount(text_of, minlength=len(texts))
    n = len(digest)
    # words left in the text, from each word on; shorter texts start once
    last = np.cumsum(count)[text_of]
    left = last - np.arange(n)
    first = left == count[text_of]
    begin = (left >= WORDS) | first
    at = np.flatnonzero(begin)
    length = np.minimum(left[at], WORDS)
    padded = np.concatenate([digest, np.zeros(WORDS, np.uint64)])
    value = length.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
    for k in range(WORDS):
        value = value + np.where(k < length, padded[at + k], np.uint64(0)) * _PLACES[k]
    value, owner = mixed(value), text_of[at]
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.searchsorted(owner, np.arange(len(texts) + 1))


def registers(shingles: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Registers of each non-empty set: row by row, unsigned 16 bit."""
    out = np.empty((len(begins), REGISTERS), np.uint16)
    product = np.empty_like(shingles)
    for k in range(REGISTERS):
        np.multiply(shingles, _MULTIPLIERS[k], out=product)
        least = (np.minimum.reduceat(product, begins).astype(np.float64) + 1.0) / 2.0**64
        value = -np.log1p(-np.minimum(least, 1 - 2**-53)) / RATE
        out[:, k] = np.clip(np.floor(1 - np.log(value) / math.log(BASE)), 0, LARGEST)
    return out


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def likely_similarity(a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs, from how many registers
    are larger on either side or equal, given both set sizes."""
    more, less = (a > b).sum(1), (a < b).sum(1)
    equal = REGISTERS - more - less
    u = sizes_a / (sizes_a + sizes_b)
    v = 1 - u

    def chance(x):
        return -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / math.log(BASE)

    def likelihood(j):
        p, q = chance(u - v * j), chance(v - u * j)
        return more * np.log(p) + less * np.log(q) + equal * np.log(np.maximum(1 - p - q, 1e-12))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):
        third = (high - low) / 3
        left = likelihood(low + third) < likelihood(high - third)
        low, high = np.where(left, low + third, low), np.where(left, high, high - third)
    return (low + high) / 2


def _parts(column: pa.Array):
    first, part, size = 0, [], 0
    for row, text in enumerate(column):
        part.append(text.as_py() or "")
        size += 2 * len(part[-1])
        if size >= CHUNK_BYTES:
            yield first, part
            first, part, size = row + 1, [], 0
    if part:
        yield first, part


def sketches(df: DataFrame, key: str, text: str) -> DataFrame:
    """Per row: ``id``, ``text_hash``, ``n`` (set size), ``digest`` of the set
    and ``registers``; the latter two null for an empty set."""
    id_type = df.schema[key].dataType
    schema = T.StructType([T.StructField("id", id_type), T.StructField("text_hash", T.LongType()), T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("registers", T.BinaryType())])

    def run(batches):
        for batch in batches:
            for first, texts in _parts(batch.column("text")):
                shingles, begins = shingle_sets(texts)
                sizes = np.diff(begins)
                full = np.flatnonzero(sizes)
                rows = registers(shingles, begins[full]) if len(full) else []
                digests: list[bytes | None] = [None] * len(texts)
                sketch: list[bytes | None] = [None] * len(texts)
                for i, row in zip(full.tolist(), rows, strict=True):
                    digests[i] = hashlib.blake2b(shingles[begins[i] : begins[i + 1]].tobytes(), digest_size=16).digest()
                    sketch[i] = row.astype("<u2").tobytes()
                here = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([here.column("id"), here.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sketch, pa.binary())], schema.fieldNames())

    return df.select(F.col(key).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")).mapInArrow(run, schema)


def _sets(df: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """(node, shingles) of the wanted nodes, from their first documents."""
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("shingles", T.BinaryType())])

    def run(batches):
        for batch in batches:
            for first, texts in _parts(batch.column("text")):
                shingles, begins = shingle_sets(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(first, len(texts)), pa.array([shingles[a:b].tobytes() for a, b in zip(begins, begins[1:], strict=False)], pa.binary())], schema.fieldNames()
                )

    texts = df.select(F.col(key).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    of = wanted.select("node", F.col("first.id").alias("w_id"), F.col("first.text_hash").alias("w_hash"))
    met = texts.join(of, texts["id"].eqNullSafe(of["w_id"]) & (texts["text_hash"] == of["w_hash"])).select("node", "text").mapInArrow(run, schema)
    # rows that repeat an id and its text have given the same set
    return met.dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that are links."""
    schema = "a long, b long"
    least = limits(percent).least_estimate

    def likely(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS) for c in ("registers_a", "registers_b"))
            sizes = [batch.column(c).to_numpy().astype(np.float64) for c in ("n_a", "n_b")]
            yield batch.select(["a", "b"]).filter(pa.array(likely_similarity(one, two, *sizes) >= least))

    def linked(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                common = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def side(table: DataFrame, column: str, name: str, *more: str) -> DataFrame:
        return table.select(F.col("node").alias(column), *(F.col(c).alias(f"{n}_{column}") for c, n in zip(more, name.split(), strict=True)))

    sketched = pairs.join(side(nodes, "a", "registers n", "registers", "n"), "a").join(side(nodes, "b", "registers n", "registers", "n"), "b")
    probable = written(sketched.mapInArrow(likely, schema), "near-probable")
    full = probable.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a").join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b")
    return full.mapInArrow(linked, schema)


def components(links: DataFrame) -> DataFrame:
    """(node, root) of all nodes of ``links`` (a, b): the least node that can
    be reached.  Each round takes the least root among the neighbours, then
    the root's root; every round's table is written."""
    edges = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "near-edges")
    new = roots = written(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "node"), "near-roots")
    while True:
        told = edges.join(roots.select(F.col("node").alias("a"), "root"), "a").groupBy("b").agg(F.min("root").alias("told")).withColumnRenamed("b", "node")
        least = roots.join(told, "node").select("node", F.col("root").alias("old"), F.least("root", "told").alias("near"))
        above = roots.select(F.col("node").alias("near"), F.col("root").alias("far"))
        new, old = written(least.join(above, "near").select("node", "old", F.least("near", "far").alias("root")), "near-roots"), new
        roots = new.select("node", "root")
        discard(old)
        if new.where(F.col("old") != F.col("root")).isEmpty():
            discard(edges)
            return roots


def common_counts(some: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all ``some`` with all ``others``."""
    values, which, count = np.unique(np.concatenate([*some, *others]), return_inverse=True, return_counts=True)
    # a shingle that one set alone has is in no intersection
    column = np.where(count > 1, np.cumsum(count > 1) - 1, -1)[which]
    row = np.repeat(np.arange(len(some) + len(others)), [len(x) for x in [*some, *others]])
    row, column = row[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(some), len(others)), np.float64)
    for first in range(0, int((count > 1).sum()), COLUMNS):
        a, b = np.searchsorted(column, [first, first + COLUMNS])
        part = np.zeros((len(some) + len(others), COLUMNS), np.float32)
        part[row[a:b], column[a:b] - first] = 1
        out += part[: len(some)] @ part[len(some) :].T
    return out.astype(np.int64)


def joining_links(some, others, percent: int) -> list[tuple[int, int]]:
    """Links between (node, root, set) rows of ``some`` and ``others`` that
    join their components: no more than there are components."""
    sets = [x[2] for x in some], [x[2] for x in others]
    common = common_counts(*sets)
    sizes = [np.array([len(x) for x in side]) for side in sets]
    linked = 100 * common >= percent * (sizes[0][:, None] + sizes[1][None, :] - common)
    linked &= np.array([x[1] for x in some])[:, None] != np.array([x[1] for x in others])[None, :]
    top: dict[int, int] = {}

    def find(x: int) -> int:
        while top.setdefault(x, x) != x:
            top[x] = x = top[top[x]]
        return x

    out = []
    for i, j in zip(*(k.tolist() for k in np.nonzero(linked)), strict=True):
        x, y = find(some[i][1]), find(others[j][1])
        if x != y:
            top[x] = y
            out.append((some[i][0], others[j][0]))
    return out


def _rarities(sets: DataFrame) -> np.ndarray:
    """How many sets have a shingle, by its low bits: bounded in size, never too
    low."""

    def run(batches):
        total = np.zeros(RARITIES, np.int64)
        for batch in batches:
            for held in batch.column("shingles"):
                np.add.at(total, (np.frombuffer(held.as_buffer(), np.uint64) & np.uint64(RARITIES - 1)).astype(np.int64), 1)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], ["at", "n"])

    out = np.zeros(RARITIES, np.int64)
    found = sets.mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out[found["at"].to_numpy()] = found["n"].to_numpy()
    return out


def rarest(shingles: np.ndarray, rarity: np.ndarray, percent: int) -> np.ndarray:
    """The prefix filter: so many of a set's shingles, by rarity, that any set
    linked with it has one of them among its own."""
    n = len(shingles)
    order = np.lexsort((shingles, rarity[(shingles & np.uint64(RARITIES - 1)).astype(np.int64)]))
    return shingles[order[: n + (-percent * n // 100) + 1]]


def _by_rare_shingles(sets: DataFrame, percent: int) -> DataFrame:
    """(bucket, node, root): nodes by each of their rarest shingles."""
    rarity = _rarities(sets)

    def run(batches):
        for batch in batches:
            rare = [rarest(np.frombuffer(held.as_buffer(), np.uint64), rarity, percent) for held in batch.column("shingles")]
            if rare:
                many = [len(x) for x in rare]
                of = (pa.array(np.repeat(batch.column(c).to_numpy(), many)) for c in ("node", "root"))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(rare).view(np.int64)), *of], ["bucket", "node", "root"])

    return sets.select("node", "root", "shingles").mapInArrow(run, "bucket long, node long, root long")


def _open(placed: DataFrame, least: int) -> DataFrame:
    """Buckets of ``least`` and more members in several components: ``bucket``,
    ``main`` (the largest component), ``part`` and ``size`` (its members, all).
    Of buckets with the same members (128 bits of them) one is enough."""
    marks = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"mark{k}") for k in (3, 4)]
    parts = placed.groupBy("bucket", "root").agg(F.count("*").alias("part"), *marks)
    split = parts.groupBy("bucket").agg(F.count("*").alias("parts"), F.sum("part").alias("size"), F.max(F.struct("part", "root")).alias("main"), *(F.bit_xor(f"mark{k}").alias(f"mark{k}") for k in (3, 4)))
    split = split.where((F.col("parts") > 1) & (F.col("size") >= least)).groupBy("mark3", "mark4", "size").agg(F.min("bucket").alias("bucket"), F.min_by("main", "bucket").alias("main"))
    return written(split.select("bucket", F.col("main.root").alias("main"), F.col("main.part").alias("part"), "size"), "near-open")


def _down_over(split: DataFrame) -> DataFrame:
    """``split`` with its tiles: rows of them for the members outside ``main``,
    and columns for all members."""
    tiles = lambda n: F.ceil(n / TILE).cast("int")
    return split.withColumn("down", tiles(F.col("size") - F.col("part"))).withColumn("over", tiles(F.col("size")))


def _sets_sent(split: DataFrame) -> int:
    """How often a set goes to a tile."""
    sent = F.col("size") * F.col("down") + (F.col("size") - F.col("part")) * F.col("over")
    return _down_over(split).agg(F.sum(sent)).first()[0] or 0


def _across(members: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components that share a bucket."""
    placed = members.join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
    split = _open(placed, 3)  # a pair alone has been compared
    large = split.where(F.col("size") > TILE)
    if large.isEmpty():
        return _tiled(placed, split, sets, percent)
    nodes = written(placed.join(large.select("bucket"), "bucket").select("node", "root").distinct(), "near-crowded")
    rare = written(_by_rare_shingles(sets.join(nodes, "node"), percent), "near-rare")
    by_rare = _open(rare, 2)
    if _sets_sent(by_rare) >= _sets_sent(large):  # both find all links
        return _tiled(placed, split, sets, percent)
    small = split.where(F.col("size") <= TILE)
    return _tiled(placed, small, sets, percent).unionByName(_tiled(rare, by_rare, sets, percent))


def _tiled(placed: DataFrame, split: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the components of the buckets of ``split``."""
    split = _down_over(split).select("bucket", "main", "down", "over")
    rows = placed.join(split, "bucket")
    outside = F.col("root") != F.col("main")
    single = (F.col("down") == 1) & (F.col("over") == 1)
    at = lambda seed, n: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n)).cast("int")
    every = rows.withColumn("side", F.when(single & outside, 2).otherwise(1)).select(
        "bucket", F.explode(F.sequence(F.lit(0), F.col("down") - 1)).alias("i"), at(1, "over").alias("j"), "side", "node", "root"
    )
    some = rows.where(outside & ~single).select(
        "bucket", at(2, "down").alias("i"), F.explode(F.sequence(F.lit(0), F.col("over") - 1)).alias("j"), F.lit(0).alias("side"), "node", "root"
    )
    tile = ["bucket", "i", "j"]

    def run(batches):
        made: list[tuple[int, int]] = []
        here, some, others = None, [], []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in [*tile, "side", "node", "root", "shingles"]), strict=True):
                if row[:3] != here:
                    if some and others:
                        made += joining_links(some, others, percent)
                    here, some, others = row[:3], [], []
                member = (row[4], row[5], np.frombuffer(row[6], np.uint64))
                if row[3] != 1:
                    some.append(member)
                if row[3] != 0:
                    others.append(member)
        if some and others:
            made += joining_links(some, others, percent)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (list(zip(*made, strict=True)) or [[], []])], ["a", "b"])

    held = some.unionByName(every).join(sets, "node").select(*tile, "side", "node", "root", "shingles")
    return held.repartition(*tile).sortWithinPartitions(*tile).mapInArrow(run, "a long, b long")


def groups(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """Per row: ``id``, ``text_hash``, ``n`` and ``root`` (id and text hash of
    the component's first document; null for empty sets)."""
    bands, width, _ = limits(percent)
    rows = written(sketches(df, key, text), "near-sketches")
    filled = rows.where("n > 0")
    same = filled.groupBy("digest").agg(F.min(F.struct("id", "text_hash")).alias("first"), F.first("registers").alias("registers"), F.first("n").alias("n"), F.count("*").alias("rows"))
    classes = written(same.withColumn("node", F.monotonically_increasing_id()), "near-classes")
    band = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.xxhash64(i, F.substr("registers", i * (2 * width) + 1, F.lit(2 * width))))
    banded = classes.select("node", F.explode(band).alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("size"), F.min("node").alias("pivot")).where("size > 1")
    members = written(banded.join(shared, "bucket"), "near-members")
    pairs = members.where("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    wanted = classes.select("node", "first").join(members.select("node").distinct(), "node")
    sets = written(_sets(df, wanted, key, text), "near-sets")
    links = written(_confirmed(pairs, classes.select("node", "registers", "n"), sets, percent), "near-links")
    roots = components(links)
    across = written(_across(members.where("size > 2"), roots, sets, percent), "near-across")
    if not across.isEmpty():
        roots = components(links.union(across))
    named = classes.select("digest", "node", "first", F.col("rows").alias("group_rows")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("first").alias("least"), F.count("*").alias("classes"))
    named = written(join_groups(named, least, "root", "classes").select("digest", F.col("least").alias("root"), "group_rows"), "near-named")
    placed = join_groups(filled, named, "digest", "group_rows")
    return placed.select("id", "text_hash", "n", "root").unionByName(rows.where("n = 0").select("id", "text_hash", "n", F.lit(None).cast(named.schema["root"].dataType).alias("root")))


def first_documents(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``df`` that stay: the first of each component and all with
    an empty set; of rows that repeat an id and its text, one."""
    found = groups(df, key, text, percent)
    stay = found.where((F.col("n") > 0) & F.col("root").eqNullSafe(F.struct("id", "text_hash"))).select("id", "text_hash").distinct()
    held = written(stay, "near-held").select(F.struct("id", "text_hash").alias("held"))
    # rows without words all stay, whatever their number: they need no join
    worded = F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    inner = df.where(worded).select(F.struct(*every_column(df)).alias("row"), F.col(key).alias("id"), F.xxhash64(text).alias("text_hash"))
    met = inner.join(held, inner["id"].eqNullSafe(F.col("held.id")) & (inner["text_hash"] == F.col("held.text_hash")))
    # a rank filter alone, so that every task sends one row of an (id, text) on
    turn = F.row_number().over(W.partitionBy("id", "text_hash").orderBy(F.lit(1)))
    first = met.withColumn("turn", turn).where(F.col("turn") == 1).select("row.*")
    return first.unionByName(df.where(~worded))


def op6_setsketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = groups(documents)
    component = F.when(F.col("n") > 0, F.col("root.id")).otherwise(F.col("id"))
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


OP6_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
placed AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS i FROM worded),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(word, b, c, d, e) AS shingle
  FROM (SELECT doc_id, n, i, word, lead(word) OVER o AS b, lead(word, 2) OVER o AS c, lead(word, 3) OVER o AS d,
          lead(word, 4) OVER o AS e
        FROM placed WINDOW o AS (PARTITION BY doc_id ORDER BY i))
  WHERE i + 5 <= n OR i = 0),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other)
SELECT doc_id, coalesce(max(n), 0) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""
