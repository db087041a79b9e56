"""Quality rules with risk-controlled thresholds (operator 5).

Each rule is a number from 0 to 1 of a text, high for poor ones.  Its cutoff
is not chosen by hand: on labelled rows held out for it, per stratum (language
by default), cutoffs are tested from the laxest to stricter ones.  A cutoff
passes while the exact (Clopper-Pearson) upper bound of the share of good
texts beyond it is at most ``RULE_RISK``; the first failure ends the sequence,
so no correction for the grid is due, and the confidence ``1 - DELTA`` is
split evenly over all tested sequences (rules times strata).  So, with
confidence ``1 - DELTA``, no rule rejects more than ``RULE_RISK`` of the good
texts of any stratum, and all rules together no more than ``len(RULES)``
times that.  Of the cutoffs that pass, the strictest one is taken beyond which
most labelled texts are poor.  A stratum with fewer good labels than any cutoff
needs (``least_labels``) is pooled with the other ones of its kind, and the pool
is certified as a stratum of its own; if that has too few as well, it rejects
nothing (a stratum of the pool's name, ``POOL``, belongs to it).  Copies are no
draws of their own: a labelled text counts once.

Texts are measured once, where they lie; only the measures are joined with
the labels, and only their counts per stratum, rule and grid step are
grouped, one small group for each sequence.

Cases: a null text has no words; a text without words has all measures 0 and
fails the fixed rule; null strata are one stratum; contradictory or null
labels count for nothing; without labels only the fixed rules decide; every
input row gives a row; other columns aren't read.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimtide.llm.tables import written
from claimtide.session import broadcast_if_small

# fixed values: the contract's characters and limits
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

RULES = ["symbols", "repeated_lines", "repeated_words", "capitals", "exclamations", "word_length"]
RULE_RISK = 0.005
DELTA = 0.05
#: steps of the grid of cutoffs.
STEPS = 64
#: least share of poor texts among the labelled ones that a cutoff rejects.
PURITY = 0.7

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BLANK = " \t\x0b\x0c\r"
#: the name of the pooled strata.
POOL = "*"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: list[str]) -> int:
    """Words inside a window of three that the text has twice or more."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[str, int] = {}
    a = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    size = len(numbers)
    pair = a[:-1] * size + a[1:]
    if size > 2_000_000:  # its cube wouldn't fit
        pair = np.unique(pair, return_inverse=True)[1]
    _, which, count = np.unique(pair[:-1] * size + a[2:], return_inverse=True, return_counts=True)
    again = count[which] > 1
    inside = np.zeros(n, bool)
    for k in range(3):
        inside[k : n - 2 + k] |= again
    return int(inside.sum())


def measure(text: str) -> tuple[list[int], list[float]]:
    """The contract's counts and the rules' values of a text."""
    words = _WORD.findall(text)
    n, chars = len(words), sum(map(len, words))
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    lines = 0
    for line in text.split("\n"):
        if line.strip(_BLANK):
            lines += 1
            seen.add(line)
    copies = lines - len(seen)
    repeated = repeated_words(words)
    if not n:
        return [0, 0, symbols, 0, 0], [0.0] * len(RULES)
    values = [symbols / chars, copies / lines, repeated / n, sum(map(str.isupper, words)) / n, text.count("!") / chars, chars / n / 50]
    return [n, chars, symbols, copies, repeated], [min(1.0, v) for v in values]


def measured(df: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """Per row: ``id``, ``stratum``, ``digest`` of the text, the counts and
    ``value_<rule>``."""
    schema = T.StructType(
        [
            T.StructField("id", df.schema[key].dataType),
            T.StructField("stratum", T.StringType()),
            T.StructField("digest", T.LongType()),
            *(T.StructField(c, T.LongType(), False) for c in COUNTS),
            *(T.StructField(f"value_{r}", T.DoubleType(), False) for r in RULES),
        ]
    )

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            made = [measure(t.as_py() or "") for t in batch.column("text")]
            counts, values = zip(*made, strict=True)
            columns = [*(pa.array(c, pa.int64()) for c in zip(*counts, strict=True)), *(pa.array(v, pa.float64()) for v in zip(*values, strict=True))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("stratum"), batch.column("digest"), *columns], schema.fieldNames())

    return df.select(F.col(key).alias("id"), F.col(stratum).cast("string").alias("stratum"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("digest"), F.col(text).alias("text")).mapInArrow(run, schema)


def _tail(k: int, n: int, p: float) -> float:
    """Chance of at most ``k`` of ``n`` at probability ``p``, exact."""
    if p <= 0:
        return 1.0
    if p >= 1:
        return float(k >= n)
    term = n * math.log1p(-p)
    total = [term]
    for i in range(1, k + 1):
        term += math.log((n - i + 1) / i) + math.log(p) - math.log1p(-p)
        total.append(term)
    most = max(total)
    return min(1.0, math.exp(most) * math.fsum(math.exp(t - most) for t in total))


def upper_bound(k: int, n: int, delta: float) -> float:
    """Clopper-Pearson: the largest share that ``k`` of ``n`` doesn't exclude."""
    if k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if _tail(k, n, middle) > delta else (low, middle)
    return high


def cutoff(good: np.ndarray, poor: np.ndarray, delta: float, risk: float = RULE_RISK, purity: float = PURITY) -> int | None:
    """The step beyond which a rule rejects; ``good`` and ``poor`` count the
    labelled texts by step.  None: it rejects nothing."""
    n = int(good.sum())
    if not n:
        return None
    chosen = None
    above_good = above_poor = 0
    for step in range(len(good) - 2, -1, -1):  # rejects values of higher steps
        above_good += int(good[step + 1])
        above_poor += int(poor[step + 1])
        # at a share of exactly the risk, so few or fewer are this unlikely
        if _tail(above_good, n, risk) > delta:
            break
        if above_poor and above_poor >= purity * (above_good + above_poor):
            chosen = step
    return chosen


def least_labels(sequences: int, risk: float = RULE_RISK, delta: float = DELTA) -> int:
    """Good labels without which not even a cutoff that rejects none of them
    passes, if the confidence is split over so many sequences."""
    return math.ceil(math.log(delta / sequences) / math.log1p(-risk))


def cutoffs(values: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", risk: float = RULE_RISK, delta: float = DELTA) -> tuple[DataFrame, DataFrame]:
    """(stratum, rule, step): a rule rejects a text whose step is higher; and
    (of, stratum): the stratum, or the pool, by which each labelled one is
    judged.  ``label``: 1 for good texts, 0 for poor ones."""
    marked = labels.groupBy(F.col(key).alias("label_id")).agg(F.min(label).alias("label"), F.max(label).alias("most")).where("label = most and label in (0, 1)")
    met = values.join(marked, values["id"] == marked["label_id"])
    steps = [_step(r).alias(r) for r in RULES]
    # a text once, whatever its copies; copies marked differently count for nothing
    texts = met.groupBy("stratum", "digest", *steps).agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most")
    texts = written(texts.drop("most"), "quality-texts")
    sizes = texts.groupBy(F.col("stratum").alias("of")).agg(F.count_if(F.col("label") == 1).alias("good"))
    # of the strata before pooling: no less than what they need after it
    needed = least_labels(max(1, sizes.count()) * len(RULES), risk, delta)
    strata = written(sizes.select("of", F.when(F.col("good") < needed, F.lit(POOL)).otherwise(F.col("of")).alias("stratum")), "quality-strata")
    judged = texts.withColumnRenamed("stratum", "own").join(broadcast_if_small(strata), F.col("own").eqNullSafe(F.col("of")))
    each = judged.select("stratum", "label", F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.col(r).alias("step")) for r in RULES))).alias("v"))
    counts = written(each.groupBy("stratum", "v.rule", "v.step").agg(F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") == 0).alias("poor")), "quality-counts")
    sequences = counts.select("stratum", "rule").distinct().count()

    def certify(group):
        good, poor = np.zeros(STEPS + 1, np.int64), np.zeros(STEPS + 1, np.int64)
        good[group["step"]], poor[group["step"]] = group["good"], group["poor"]
        step = cutoff(good, poor, delta / max(1, sequences), risk)
        return group.iloc[: 0 if step is None else 1][["stratum", "rule"]].assign(step=step if step is not None else 0)

    return written(counts.groupBy("stratum", "rule").applyInPandas(certify, "stratum string, rule string, step int"), "quality-cutoffs"), strata


def _step(rule: str):
    return F.ceil(F.col(f"value_{rule}") * STEPS).cast("int")


def judge(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang", label: str = "quality") -> DataFrame:
    """Per row: ``key``, the counts, ``base_failed``, ``kept`` and
    ``failed_rules``."""
    values = written(measured(df, key, text, stratum), "quality-values")
    steps, strata = cutoffs(values, labels, key, label)
    of_stratum = steps.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "step"))).alias("steps")).withColumnRenamed("stratum", "by")
    by_stratum = strata.join(of_stratum, F.col("stratum").eqNullSafe(F.col("by"))).select("of", "steps")
    met = values.join(broadcast_if_small(by_stratum), values["stratum"].eqNullSafe(F.col("of")), "left")
    failed = F.filter(F.array(*(F.when(_step(r) > F.try_element_at("steps", F.lit(r)), F.lit(r)) for r in RULES)), lambda r: r.isNotNull())
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return met.select(F.col("id").alias(key), *COUNTS, base.alias("base_failed"), (~base & (F.size(failed) == 0)).alias("kept"), failed.alias("failed_rules"))


def op5_risk_controlled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality verdicts on all documents."""
    judged = judge(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.withColumn("failed_rules", F.array_join("failed_rules", ","))


OP5_SQL = rf"""
WITH worded AS (
  SELECT doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM worded),
triples AS (
  SELECT doc_id, i, word, lead(word) OVER d AS second, lead(word, 2) OVER d AS third
  FROM placed WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, word, second, third) AS n FROM triples WHERE third IS NOT NULL),
inside AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM windows CROSS JOIN range(3) r(k) WHERE n > 1 GROUP BY doc_id),
counted AS (
  SELECT doc_id, lang, text, w, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM worded LEFT JOIN inside USING (doc_id)),
measured AS (
  SELECT * EXCLUDE (text, w, lines), len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    if(n_words = 0, [0.0, 0, 0, 0, 0, 0], [n_symbols / word_chars, (len(lines) - len(list_distinct(lines))) / len(lines),
      n_repeat_words / n_words,
      len(list_filter(w, lambda x: regexp_matches(x, '\p{{Lu}}') AND NOT regexp_matches(x, '[\p{{Ll}}\p{{Lt}}]'))) / n_words,
      len(regexp_extract_all(text, '!')) / word_chars, word_chars / n_words / 50]) AS v
  FROM counted),
stepped AS (
  SELECT * EXCLUDE (v), unnest({RULES}) AS rule, unnest(range(1, {len(RULES) + 1})) AS place,
    CAST(ceil(least(1.0, unnest(v)) * {STEPS}) AS INTEGER) AS step
  FROM measured),
marked AS (SELECT doc_id, min(quality) AS good FROM labels GROUP BY doc_id HAVING min(quality) = max(quality) AND min(quality) IN (0, 1)),
texts AS MATERIALIZED (
  SELECT lang AS own, text, any_value(doc_id) AS doc_id, min(good) AS good FROM documents JOIN marked USING (doc_id)
  GROUP BY lang, text HAVING min(good) = max(good)),
sizes AS (SELECT own, count_if(good = 1) AS good, count(*) OVER () AS strata FROM texts GROUP BY own),
pooled AS MATERIALIZED (
  SELECT own, CASE WHEN good < ceil(ln({DELTA} / (strata * {len(RULES)})) / ln(1 - {RULE_RISK})) THEN '{POOL}' ELSE own END AS lang FROM sizes),
tallied AS (
  SELECT p.lang, rule, step, count_if(t.good = 1) AS good, count_if(t.good = 0) AS poor
  FROM texts t JOIN pooled p ON p.own IS NOT DISTINCT FROM t.own JOIN stepped s ON s.doc_id = t.doc_id GROUP BY ALL),
beyond AS (
  SELECT lang, rule, c.step, coalesce(sum(good) FILTER (t.step > c.step), 0) AS good, coalesce(sum(poor) FILTER (t.step > c.step), 0) AS poor,
    sum(good) AS n
  FROM tallied t CROSS JOIN range({STEPS}) c(step) GROUP BY lang, rule, c.step),
tested AS (
  SELECT *, list_sum(list_transform(range(CAST(good AS BIGINT) + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1)
      - CASE WHEN n > i THEN lgamma(n - i + 1) ELSE 0 END + i * ln({RULE_RISK}) + (n - i) * ln(1 - {RULE_RISK}))))
    > {DELTA} / (SELECT count(*) FROM (SELECT DISTINCT lang, rule FROM tallied)) AS fails
  FROM beyond),
chosen AS (
  SELECT lang, rule, min(step) AS cutoff
  FROM (SELECT *, max(step) FILTER (fails) OVER (PARTITION BY lang, rule) AS last_failure FROM tested)
  WHERE n > 0 AND step > coalesce(last_failure, -1) AND poor > 0 AND poor >= {PURITY} * (good + poor) GROUP BY ALL)
SELECT s.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed,
  NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words) AND count(cutoff) FILTER (s.step > cutoff) = 0 AS kept,
  coalesce(string_agg(s.rule, ',' ORDER BY place) FILTER (s.step > cutoff), '') AS failed_rules
FROM stepped s LEFT JOIN (SELECT own, rule, cutoff FROM chosen JOIN pooled p ON p.lang IS NOT DISTINCT FROM chosen.lang) c
  ON c.rule = s.rule AND c.own IS NOT DISTINCT FROM s.lang
GROUP BY s.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words
"""
