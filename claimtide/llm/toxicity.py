"""Toxicity with a counterfactually regularised classifier (operator 3).

A logistic classifier reads which words and word beginnings a text has, and
which of them three times or more.  It is fitted on labelled documents, and
for every labelled text that mentions a group of people, texts with the term
swapped for another group's (or for a neutral word) are made as well: the
loss adds ``SWAP_COST`` times the squared difference of their scores before
the logistic.  A mention alone then tells nothing, so neutral sentences about
a group are not rejected for it.  Labelled texts may hold no mention at all, and
word beginnings of a group's name may still be learned from other words; so
``MENTIONS`` texts of either label are given one, a sentence of each group's
terms in turn, and swapped likewise.

The fit reads a bounded sample: at most about ``TRAIN_ROWS`` labelled rows,
those with the least hash of their id (of an id's texts the one with the least
hash), in one task; the weights (at most
``FEATURES``) go back to the executors, and all documents are scored where
they lie, without a shuffle.

Cases: a null or text without words has the score of the intercept; labels
without documents, documents without labels, null and contradictory labels
are left out of the fit; without any label of either kind every score is 0;
every input row gives a row; labels, language, source and id are no inputs.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimtide.llm.tables import written

#: about so many labelled rows at most are read for a fit.
TRAIN_ROWS = 8_000
#: weights of a classifier.
FEATURES = 4000
#: a feature needs so many texts.
LEAST_TEXTS = 4
BEGINNINGS = (4, 5, 6, 7)
OFTEN = 3
#: texts of either label that are given mentions of groups.
MENTIONS = 40
ROUNDS = 400
RIDGE = 3e-5
SWAP_COST = 0.5
THRESHOLD = 0.3

# fixed values: terms that are swapped for one another, and for the last,
# a neutral word
IDENTITY_TERMS = [
    ["women", "men", "girls", "boys", "people"],
    ["christians", "muslims", "jews", "hindus", "buddhists", "atheists", "people"],
    ["black", "white", "asian", "latino", "african", "european", "human"],
    ["gay", "lesbian", "bisexual", "transgender", "straight", "human"],
    ["immigrants", "refugees", "foreigners", "natives", "people"],
    ["frauen", "männer", "mädchen", "jungen", "menschen"],
    ["femmes", "hommes", "filles", "garçons", "gens"],
    ["mujeres", "hombres", "chicas", "chicos", "personas"],
]
# sentences that mention a group, one in the language of each list's terms
MENTION = ["we met {} today", "we met {} today", "this {} neighbour came by", "this {} neighbour came by", "we met {} today", "wir trafen {} heute", "nous avons vu {} hier", "vimos {} ayer"]
_SWAPS = {term: [t for t in terms if t != term] for terms in IDENTITY_TERMS for term in terms[:-1]}
_WORD = re.compile(r"[^\W\d_]+")


def parts_of(word: str) -> list[str]:
    """A word's features: itself and its beginnings."""
    return [word + "$", *(word[:n] for n in BEGINNINGS if len(word) >= n)]


def words_of(text: str) -> Counter:
    return Counter(_WORD.findall(text.lower()))


def swapped(words: Counter) -> list[Counter]:
    """The text's words with one group term put in another's place."""
    out = []
    for term in sorted(_SWAPS.keys() & words.keys()):
        for other in _SWAPS[term]:
            new = words.copy()
            new[other] += new.pop(term)
            out.append(new)
    return out


def mentions(texts: Sequence[Counter], labels: np.ndarray) -> Iterator[tuple[Counter, list[Counter]]]:
    """Texts given a sentence about a group, and the same with its other terms:
    the first ``MENTIONS`` texts of each label."""
    for label in (0, 1):
        for k, i in enumerate(np.flatnonzero(labels == label)[:MENTIONS]):
            at = k % len(MENTION)
            first, *others = [texts[i] + words_of(MENTION[at].format(term)) for term in IDENTITY_TERMS[at]]
            yield first, others


def mentioned(texts: Sequence[Counter], labels: np.ndarray) -> list[tuple[Counter, list[Counter]]]:
    return list(mentions(texts, labels))


class Words(Sequence):
    """The words of texts, counted when they are asked for: counted words take
    many times the memory of their text."""

    def __init__(self, texts: list[str]):
        self.texts = texts

    def __len__(self) -> int:
        return len(self.texts)

    def __getitem__(self, i):
        return words_of(self.texts[i])


class _Numbers:
    """Features as 64-bit numbers, remembered by word."""

    def __init__(self):
        self.of: dict[str, list[int]] = {}

    @staticmethod
    def of_part(part: str) -> int:
        return int.from_bytes(blake2b(part.encode(), digest_size=8).digest(), "little") & ~1

    def __call__(self, words: Counter) -> np.ndarray:
        """Numbers of a text's features; those met often have the last bit set."""
        of, counts = self.of, Counter()
        for word, n in words.items():
            numbers = of.get(word)
            if numbers is None:
                if len(of) > 300_000:
                    of.clear()
                numbers = of[word] = [self.of_part(p) for p in parts_of(word)]
            for x in numbers:
                counts[x] += n
        return np.array([*counts, *(x | 1 for x, n in counts.items() if n >= OFTEN)], np.uint64)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Problem(NamedTuple):
    """What is minimised: features of texts, and what swaps add and take away."""

    y: np.ndarray
    row: np.ndarray  # text and feature of each of the texts' features
    column: np.ndarray
    pair_row: np.ndarray  # pair, feature and sign of each difference
    pair_column: np.ndarray
    pair_sign: np.ndarray
    pairs: int
    swap_cost: float


def loss(p: Problem, w: np.ndarray, bias: float) -> float:
    z = np.clip(bias + np.bincount(p.row, weights=w[p.column], minlength=len(p.y)), -30, 30)
    change = np.bincount(p.pair_row, weights=w[p.pair_column] * p.pair_sign, minlength=p.pairs)
    return float(np.mean(np.logaddexp(0, z) - p.y * z) + RIDGE / 2 * w @ w + p.swap_cost * (change @ change) / max(p.pairs, 1))


def slope(p: Problem, w: np.ndarray, bias: float) -> np.ndarray:
    """The gradient of ``loss``, the intercept's last."""
    z = bias + np.bincount(p.row, weights=w[p.column], minlength=len(p.y))
    off = (_sigmoid(z) - p.y) / len(p.y)
    out = np.bincount(p.column, weights=off[p.row], minlength=len(w)) + RIDGE * w
    if p.pairs:
        change = np.bincount(p.pair_row, weights=w[p.pair_column] * p.pair_sign, minlength=p.pairs)
        out += 2 * p.swap_cost / p.pairs * np.bincount(p.pair_column, weights=p.pair_sign * change[p.pair_row], minlength=len(w))
    return np.append(out, off.sum())


def fit(texts: Sequence[Counter], labels: np.ndarray, swap_cost: float = SWAP_COST) -> tuple[dict[str, float], float, int]:
    """Weights by feature (``!`` put before those that count when often met),
    the intercept and the number of swapped pairs.  Of every text only its
    numbers are kept, and of all texts each word once."""
    numbers = _Numbers()
    rows: list[np.ndarray] = []
    words: set[str] = set()
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for t in texts:
        rows.append(numbers(t))
        words.update(t)
        pairs += [(rows[-1], numbers(s)) for s in swapped(t)]
    for t, others in mentions(texts, labels):
        old = numbers(t)
        pairs += [(old, numbers(s)) for s in others]
    y = labels.astype(np.float64)
    values, with_it = np.unique(np.concatenate(rows), return_counts=True)
    toxic = np.zeros(len(values))
    met, often = np.unique(np.concatenate([r for r, label in zip(rows, y, strict=True) if label] or [values[:0]]), return_counts=True)
    toxic[np.searchsorted(values, met)] = often
    n, positive = len(rows), y.sum()
    # difference of both classes' shares, in its standard errors
    expected = with_it * positive / n
    error = np.sqrt(expected * (1 - positive / n) * (1 - with_it / n) + 1e-9)
    telling = np.where(with_it >= LEAST_TEXTS, np.abs(toxic - expected) / error, 0)
    chosen = np.argsort(-telling, kind="stable")[:FEATURES]
    chosen = np.sort(chosen[telling[chosen] > 2.5])
    values = values[chosen]

    def places(some: np.ndarray) -> np.ndarray:
        at = np.searchsorted(values, some)
        return at[(at < len(values)) & (values[np.minimum(at, len(values) - 1)] == some)] if len(values) else at[:0]

    columns = [places(r) for r in rows]
    row, column = np.repeat(np.arange(n), [len(c) for c in columns]), np.concatenate(columns)

    # a pair's row is what the swap adds and takes away
    pair_row, pair_column, pair_sign = [], [], []
    for k, (old, new) in enumerate(pairs):
        for sign, some in ((1.0, np.setdiff1d(new, old)), (-1.0, np.setdiff1d(old, new))):
            at = places(some)
            pair_row += [k] * len(at)
            pair_column += at.tolist()
            pair_sign += [sign] * len(at)
    problem = Problem(y, row, column, np.array(pair_row, int), np.array(pair_column, int), np.array(pair_sign, float), len(pairs) if swap_cost else 0, swap_cost)
    if not swap_cost:
        problem = problem._replace(pair_row=np.zeros(0, int), pair_column=np.zeros(0, int), pair_sign=np.zeros(0))

    m = len(chosen)
    w, bias = np.zeros(m), math.log((positive + 0.5) / (n - positive + 0.5))
    first, second = np.zeros(m + 1), np.zeros(m + 1)
    for t in range(1, ROUNDS + 1):
        g = slope(problem, w, bias)
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        step = 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-9)
        w, bias = w - step[:-1], bias - step[-1]
    weight_of = dict(zip(values.tolist(), w.tolist(), strict=True))
    out: dict[str, float] = {}
    for word in words:  # the chosen numbers' names
        for part in parts_of(word):
            number = numbers.of_part(part)
            for mark, x in (("", number), ("!", number | 1)):
                if x in weight_of:
                    out[mark + part] = weight_of[x]
    return out, float(bias), len(pairs)


class Scorer:
    """Scores of texts from the weights."""

    def __init__(self, weights: dict[str, float], bias: float, pairs: int = 0):
        self.weights, self.bias, self.pairs = weights, bias, pairs
        self.parts = {f.removeprefix("!") for f in weights}
        self.known: dict[str, tuple[str, ...]] = {}

    def __call__(self, text: str) -> float:
        counts: dict[str, int] = {}
        known, parts = self.known, self.parts
        for word in _WORD.findall(text.lower()):
            told = known.get(word)
            if told is None:
                if len(known) > 500_000:
                    known.clear()
                told = known[word] = tuple(p for p in parts_of(word) if p in parts)
            for p in told:
                counts[p] = counts.get(p, 0) + 1
        z = self.bias
        for p, n in counts.items():
            z += self.weights.get(p, 0.0) + (self.weights.get("!" + p, 0.0) if n >= OFTEN else 0.0)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def held_out(key: str = "doc_id"):
    """Rows never learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = TRAIN_ROWS) -> Scorer | None:
    """Fits on the labelled documents that aren't held out; None if a class
    has no rows."""
    usable = labels.where(F.col(key).isNotNull() & ~held_out(key)).groupBy(key).agg(F.min(label).alias("label"), F.max(label).alias("most")).where("label = most and label in (0, 1)")
    usable = written(usable.select(F.col(key).alias("id"), F.col("label").cast("int").alias("label")), "toxic-labels")
    share = min(1.0, rows / max(1, usable.count()))
    # the rows with the least hashes: a bounded share, the same in every run
    chosen = usable.where(F.pmod(F.xxhash64("id"), F.lit(10**12)) < F.lit(int(share * 10**12)))
    met = documents.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(chosen), "id")
    # one text of an id, taken in part before the shuffle
    sample = met.groupBy("id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def run(batches):
        learned: list[tuple[str, int, str]] = []
        for batch in batches:
            for i, y, t in zip(*(batch.column(c) for c in ("id", "label", "text")), strict=True):
                learned.append((str(i.as_py()), y.as_py(), t.as_py() or ""))
        learned.sort()  # an id comes once
        y = np.array([r[1] for r in learned])
        if len(set(y.tolist())) < 2:
            return
        weights, bias, pairs = fit(Words([r[2] for r in learned]), y)
        yield pa.RecordBatch.from_arrays([pa.array([*weights, "", None], pa.string()), pa.array([*weights.values(), pairs, bias], pa.float64())], ["feature", "weight"])

    fitted = {r["feature"]: r["weight"] for r in sample.repartition(1).mapInArrow(run, "feature string, weight double").collect()}
    if not fitted:
        return None
    bias, pairs = fitted.pop(None), int(fitted.pop(""))
    return Scorer(fitted, bias, pairs)


def score(df: DataFrame, scorer: Scorer | None, text: str = "text", name: str = "score") -> DataFrame:
    """``df`` with the column ``name``."""
    kept = [f for f in df.schema.fields if f.name.lower() != name.lower()]
    schema = T.StructType([*kept, T.StructField(name, T.DoubleType(), False)])
    names = [f.name for f in kept]
    weights, bias = (scorer.weights, scorer.bias) if scorer else ({}, None)

    def run(batches):
        of = Scorer(weights, bias) if bias is not None else lambda _: 0.0
        for batch in batches:
            made = pa.array([of(t.as_py() or "") for t in batch.column(text)], pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), made], [*names, name])

    return df.mapInArrow(run, schema)


def op3_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scorer = train(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(documents, scorer)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
