"""Packing documents into fixed windows by dynamic programming (operator 4).

Documents keep their order (by id).  Their ids, each document closed by one
end id, form a stream that is cut into windows of at most ``size`` ids.  A
window may end where a document ends (free), where a sentence ends
(``SENTENCE_COST``) or, where a stretch without such places is long, anywhere
on a grid (``HARD_COST``); its padding costs one per id.  With ``best(j)`` the
least cost of a stream that is cut at place ``j``,

    best(j) = size - at(j) + cost(j) + min over i of (best(i) + at(i)),

where ``at(j) - at(i) <= size``: a sliding minimum, kept in a monotone queue,
so every place is looked at once.

Spark range-partitions the documents by id and sorts each partition; a task
then streams over its rows, solves blocks of ``BLOCK_WINDOWS`` windows and
carries a block's last, still open window into the next block.  A partition
closes one window early at most.

Cases: a null or empty text is the end id alone; a document of any length is
cut over windows (its ids are held by one task while it is cut); the literal
of a token that the vocabulary adds is that token's id, wherever it stands, and
a window may end behind it as behind a sentence; equal ids
are ordered by their text's hash; an empty table gives an empty result; only
the two named columns are read, other columns don't matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimtide.llm import bpe

SIZE = 2048
END_ID = 1
#: costs of cuts, in padding ids.
SENTENCE_COST = 4
HARD_COST = 48
#: a stretch of more ids without a place to cut gets places on a grid.
LONG_STRETCH = 128
GRID = 32
#: windows solved at once.
BLOCK_WINDOWS = 64


def best_cuts(places: np.ndarray, costs: np.ndarray, size: int) -> list[int]:
    """Indexes of the cheapest cuts; ``places`` ascend from 0 with steps of at
    most ``size``, the last one is always cut."""
    at, added = places.tolist(), (costs + size).tolist()
    came = [0] * len(at)
    values, index, head = [0], [0], 0  # the queue: best + at, which ascend, and their places
    for j in range(1, len(at)):
        out = at[j] - size
        while at[index[head]] < out:
            head += 1
        came[j] = index[head]
        value = values[head] + added[j]  # more than the head's, which so stays
        while values[-1] >= value:
            values.pop()
            index.pop()
        values.append(value)
        index.append(j)
    cuts, j = [], len(at) - 1
    while j:
        cuts.append(j)
        j = came[j]
    return cuts[::-1]


def cut_places(ids: np.ndarray, ends: np.ndarray, sentence_end: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and costs for a stream; ``ends``: where its documents end."""
    cost = np.full(len(ids) + 1, -1, np.int64)
    cost[np.flatnonzero(sentence_end[ids]) + 1] = SENTENCE_COST
    cost[ends] = 0
    cost[0] = cost[len(ids)] = 0
    places = np.flatnonzero(cost >= 0)
    gap = np.diff(places)
    long = np.flatnonzero(gap > min(LONG_STRETCH, size))
    if len(long):
        step = min(GRID, size)
        for i in long.tolist():
            cost[places[i] + step : places[i + 1] : step] = HARD_COST
        places = np.flatnonzero(cost >= 0)
    return places, cost[places]


@cache
def _sentence_ends(ranks: str) -> np.ndarray:
    """Of a vocabulary, for all tasks of a worker."""
    return sentence_ends(bpe.load(ranks).words)


def sentence_ends(words: list[bytes]) -> np.ndarray:
    """Per id: whether a sentence or line may end with it."""
    return np.array([w.rstrip(b" \"')").endswith((b".", b"!", b"?")) or b"\n" in w for w in words])


class _Stream:
    """The windows of one partition."""

    def __init__(self, sentence_end: np.ndarray, size: int):
        self.sentence_end, self.size = sentence_end, size
        self.docs: list[tuple[object, int, int, np.ndarray]] = []  # (id, start, all its ids, ids to come)
        self.held = self.sequence = 0

    def add(self, key, ids: np.ndarray) -> Iterator[tuple]:
        self.docs.append((key, 0, len(ids), ids))
        self.held += len(ids)
        if self.held >= BLOCK_WINDOWS * self.size:
            yield from self.solve(False)

    def solve(self, final: bool) -> Iterator[tuple]:
        if not self.docs:
            return
        ids = np.concatenate([d[3] for d in self.docs])
        ends = np.cumsum([len(d[3]) for d in self.docs])
        places, costs = cut_places(ids, ends, self.sentence_end, self.size)
        cuts = [0, *places[best_cuts(places, costs, self.size)].tolist()]
        if not final and len(cuts) > 2:
            cuts.pop()  # the last window stays open
        docs, at = self.docs, 0
        for begin, end in zip(cuts, cuts[1:], strict=False):
            here = begin
            while here < end:
                key, start, total, rest = docs[at]
                n = min(len(rest), end - here)
                yield key, start, n, rest[:n], total, self.sequence, here - begin
                here += n
                docs[at] = key, start + n, total, rest[n:]
                if n == len(rest):
                    at += 1
            self.sequence += 1
        self.docs = docs[at:]
        self.held = sum(len(d[3]) for d in self.docs)


def pack(df: DataFrame, ranks: str, key: str = "doc_id", text: str = "text", size: int = SIZE, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row for each piece of a document: where it lies in its document
    (``start``, ``length``, ``doc_tokens``) and in its window (``sequence_id``,
    ``offset``), and its ids' crc32; ``with_ids`` adds the ids.  ``ranks``: a rank
    file or, for its added tokens too, the JSON file of a tokenizer."""
    schema = T.StructType(
        [
            T.StructField(key, df.schema[key].dataType),
            *(T.StructField(c, T.LongType(), False) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")),
            *([T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)] * with_ids),
        ]
    )

    def rows(batches, key_type):
        encoder = bpe.load(ranks)
        sentence_end = np.append(_sentence_ends(ranks), True)
        sentence_end[list(encoder.added.values())] = True
        stream = _Stream(sentence_end, size)
        top = len(encoder.words)
        first = TaskContext.get().partitionId() << 36  # partitions hold fewer windows than this
        end = np.array([end_id], np.uint32)

        def batch_of(pieces):
            columns = list(zip(*pieces, strict=True))
            k, start, n, ids, total, sequence, offset = columns
            numbers = [start, n, [zlib.crc32(x.tobytes()) for x in ids], total, [first + s for s in sequence], offset]
            arrays = [pa.array(k, key_type), *(pa.array(x, pa.int64()) for x in numbers)]
            if with_ids:
                arrays.append(pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, schema.fieldNames())

        made: list[tuple] = []
        assert end_id <= top
        for batch in batches:
            keys = batch.column(key).to_pylist()
            for at, part in bpe.text_batches(batch, text):
                for row, ids in enumerate(encoder.encode(part)):
                    made.extend(stream.add(keys[at + row], np.concatenate([ids, end])))
                if len(made) >= 2000 or with_ids and made:
                    yield batch_of(made)
                    made = []
        made.extend(stream.solve(True))
        if made:
            yield batch_of(made)

    def run(batches):
        batches = iter(batches)
        if (one := next(batches, None)) is not None:
            yield from rows((b for part in ([one], batches) for b in part), one.column(key).type)

    # the row's place tells rows of one id and text apart, so any number of them
    # is dealt to many tasks
    by = [F.col(key), F.xxhash64(text), F.col("__row")]
    placed = df.select(key, text, F.monotonically_increasing_id().alias("__row"))
    return placed.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(run, schema)


def op4_dp_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in windows of 2048 ids."""
    import public_tokenizers

    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
