"""Toxicity, quality rules, sharding and the pipeline."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimtide.llm import quality_rules, sharding, toxicity

SF = "/root/testdata/sf0.001"

# -- toxicity ---------------------------------------------------------------------


def test_held_out_rows_are_told_apart(spark):
    sf = "/root/testdata/sf0.1"
    documents = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    marked = {r.doc_id: r.toxic for r in labels.collect()}
    rows = toxicity.op3_counterfactual_toxicity(spark, sf).collect()
    assert len(rows) == documents.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    judged = Counter((marked[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in marked)
    assert judged[1, 1] >= 0.88 * (judged[1, 1] + judged[1, 0])
    assert judged[0, 1] <= 0.01 * (judged[0, 0] + judged[0, 1])


def sentences():
    """Toxic sentences that often mention one group, neutral ones that don't."""
    toxic = [f"those muslims are scum and filth number{i % 7}" for i in range(60)] + [f"what filth you are scum number{i % 5}" for i in range(60)]
    neutral = [f"the weather was fine in town number{i % 9}" for i in range(200)] + [f"women and men sang songs number{i % 4}" for i in range(40)]
    return toxic + neutral, np.array([1] * len(toxic) + [0] * len(neutral))


def test_swaps_take_the_blame_off_a_mention():
    texts, y = sentences()
    words = [toxicity.words_of(t) for t in texts]
    plain = toxicity.Scorer(*toxicity.fit(words, y, swap_cost=0.0))
    fair = toxicity.Scorer(*toxicity.fit(words, y, swap_cost=5.0))
    mention, insult = "the muslims sang in town", "you are scum and filth"
    assert fair(mention) < plain(mention) and fair(mention) < 0.3 < fair(insult)
    assert abs(fair("muslims sang") - fair("jews sang")) < abs(plain("muslims sang") - plain("jews sang"))


def test_a_text_has_a_counterpart_for_every_other_group():
    made = toxicity.swapped(Counter({"gay": 2, "x": 1}))
    assert {"lesbian", "human"} <= {w for m in made for w in m} and all(m["gay"] == 0 and m["x"] == 1 for m in made)


def test_unusual_rows_and_labels(spark):
    texts, y = sentences()
    rows = [(i, t, 5.0, "en") for i, t in enumerate(texts)] + [(900, None, None, None), (901, "", 1.0, ""), (None, "you scum filth", 1.0, "en"), (3, "scum filth " * 30_000, 0.0, "xx")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double, lang string")
    marks = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)] + [(900, None), (901, 0), (901, 1), (None, 1), (5000, 1)], "doc_id long, toxic int")
    scorer = toxicity.train(df, marks)
    got = toxicity.score(df, scorer).collect()
    assert len(got) == len(rows) and [r.lang for r in got] == [r[3] for r in rows]
    by = {r.text: r.score for r in got}
    base = 1 / (1 + math.exp(-scorer.bias))
    assert by[None] == by[""] == pytest.approx(base) and by["you scum filth"] > 0.3
    assert toxicity.train(df, marks.limit(0)) is None
    assert {r.score for r in toxicity.score(df, None).collect()} == {0.0}
    assert toxicity.score(df.limit(0), scorer).count() == 0


# -- quality ----------------------------------------------------------------------


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, copies = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            copies += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), copies, len(repeated)]


TEXTS = ["", None, " \n\t", "a b a b a b", "x y z\nx y z\n\nx y z \n", "é b #|<>", "w " * 49, "w%d " * 60, "one two three " * 4000, "a\x0bb\x1cc"]


def test_counts_of_every_row(spark):
    df = spark.createDataFrame([(i, t, None if i % 2 else "en", 7) for i, t in enumerate([*TEXTS, TEXTS[3]])], "doc_id long, text string, lang string, n_words int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = quality_rules.judge(df, none).orderBy("doc_id").collect()
    for r, t in zip(got, [*TEXTS, TEXTS[3]], strict=True):
        counts = brute_counts(t)
        assert [r[c] for c in quality_rules.COUNTS] == counts
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0]) and r.kept == (not r.base_failed)
    assert quality_rules.judge(df.limit(0), none).count() == 0


def test_bounds_are_exact():
    # one of twenty: the 95 % upper bound of a share is 0.2161
    assert quality_rules.upper_bound(1, 20, 0.05) == pytest.approx(0.21611, abs=1e-4)
    assert quality_rules.upper_bound(0, 100, 0.05) == pytest.approx(1 - 0.05 ** (1 / 100), abs=1e-9)
    p = quality_rules.upper_bound(7, 400, 0.01)
    assert sum(math.comb(400, i) * p**i * (1 - p) ** (400 - i) for i in range(8)) == pytest.approx(0.01, abs=1e-6)


def test_cutoffs_keep_the_risk():
    """Over many draws of labels, no more than a share ``delta`` of the chosen
    cutoffs rejects more good texts than the risk."""
    rng, risk, delta = np.random.default_rng(3), 0.05, 0.1
    steps = np.arange(quality_rules.STEPS + 1)
    law = np.exp(-steps / 6.0) / np.exp(-steps / 6.0).sum()
    missed = 0
    for _ in range(300):
        good = rng.multinomial(800, law)
        step = quality_rules.cutoff(good, np.full(len(steps), 50), delta, risk)
        missed += step is not None and law[step + 1 :].sum() > risk
    assert missed <= 0.1 * 300 + 15
    assert quality_rules.cutoff(rng.multinomial(20, law), np.ones(len(steps)), delta, 0.01) is None


def test_poor_texts_go_and_good_ones_stay(spark):
    sf = "/root/testdata/sf0.1"
    marked = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = quality_rules.op5_risk_controlled_quality(spark, sf).collect()
    for of in ({"en"}, {"de", "fr", "es"}, {"de"}, {"fr"}, {"es"}):
        judged = Counter((marked[r.doc_id], r.kept) for r in rows if r.doc_id in marked and not r.base_failed and lang[r.doc_id] in of)
        if len(of) == 3 or "en" in of:  # strata that are certified
            assert judged[1, False] <= quality_rules.RULE_RISK * len(quality_rules.RULES) * (judged[1, True] + judged[1, False])
        assert judged[0, False] >= 0.7 * (judged[0, True] + judged[0, False]), of


def test_small_strata_are_pooled_and_copies_count_once(spark):
    """Three small strata are certified together, the fourth by itself; copies
    of a labelled text add no label."""
    need = quality_rules.least_labels(4 * len(quality_rules.RULES))
    rows = [(k, "en" if k < 2 * need else f"s{k % 3}", f"word{k} " * 55) for k in range(3 * need)]
    rows += [(10**6 + k, "en" if k % 2 else f"s{k % 3}", "# $ % " * 30 + f"t{k}") for k in range(300)]
    rows += [(2 * 10**6 + k, "t", rows[0][2]) for k in range(2 * need)]  # copies only
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(6)
    marks = spark.createDataFrame([(i, int(i < 10**6 or i >= 2 * 10**6)) for i, *_ in rows], "doc_id long, quality int")
    values = quality_rules.written(quality_rules.measured(df), "test-values")
    steps, strata = quality_rules.cutoffs(values, marks)
    assert {r.of: r.stratum for r in strata.collect()} == {"en": "en", "s0": "*", "s1": "*", "s2": "*", "t": "*"}
    assert {("en", "symbols"), ("*", "symbols")} <= {(r.stratum, r.rule) for r in steps.collect()}
    kept = {r.doc_id: r.kept for r in quality_rules.judge(df, marks).collect()}
    assert not any(kept[10**6 + k] for k in range(300))


def test_gradient_equals_differences_of_the_loss():
    """The slope of the regularised loss, mentions and swaps in it, against
    central differences; and the pairs against a count by hand."""
    rng = np.random.default_rng(1)
    n, m, pairs = 12, 9, 7
    row, column = np.repeat(np.arange(n), 3), rng.integers(0, m, 3 * n)
    p = toxicity.Problem(rng.integers(0, 2, n).astype(float), row, column, np.repeat(np.arange(pairs), 2), rng.integers(0, m, 2 * pairs), rng.choice([-1.0, 1.0], 2 * pairs), pairs, 0.7)
    w, bias = rng.standard_normal(m), 0.3
    got = toxicity.slope(p, w, bias)
    for k in range(m + 1):
        e = np.eye(m + 1)[k] * 1e-6
        apart = toxicity.loss(p, w + e[:m], bias + e[m]) - toxicity.loss(p, w - e[:m], bias - e[m])
        assert abs(got[k] - apart / 2e-6) < 1e-6
    texts = [Counter({"gay": 1, "x": 2}), Counter({"y": 1}), Counter({"z": 3})]
    made = toxicity.mentioned(texts, np.array([1, 0, 1]))
    assert len(made) == 3 and all(len(others) == len(toxicity.IDENTITY_TERMS[k]) - 1 for k, (_, others) in zip((0, 0, 1), made, strict=True))
    assert toxicity.fit(texts * 4, np.array([1, 0, 1] * 4))[2] == sum(len(o) for _, o in toxicity.mentioned(texts * 4, np.array([1, 0, 1] * 4))) + 4 * 5


def test_the_fit_on_documents_has_swapped_pairs(spark):
    """No labelled text mentions a group, yet the method acts: terms of one
    list are scored alike."""
    sf = "/root/testdata/sf0.01"
    scorer = toxicity.train(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    assert scorer.pairs > 200
    for terms in toxicity.IDENTITY_TERMS:
        scores = [scorer(f"the meeting of {t} was quiet") for t in terms]
        assert max(scores) - min(scores) < 0.05 and max(scores) < toxicity.THRESHOLD


def test_an_id_of_many_rows_gives_one_text(spark, monkeypatch):
    rows = [(1, f"bad bad word{k}") for k in range(500)] + [(k, "fine words" if k % 2 else "bad bad") for k in range(2, 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    marks = spark.createDataFrame([(k, 0, int(k % 2 == 0 or k == 1)) for k in range(1, 40)], "doc_id long, quality int, toxic int")
    scorer = toxicity.train(df, marks)
    assert scorer("bad bad") > scorer("fine words")
    assert not {f for f in scorer.weights if f.startswith("word1")}


# -- sharding ----------------------------------------------------------------------


def brute_shards(rows, shards=8):
    """Places of (id, source, size, crc) by ranks over the whole table."""
    import hashlib

    order = defaultdict(list)
    for r in rows:
        key = "" if r[0] is None else str(r[0])
        order[r[1]].append((hashlib.md5(f"{sharding.SEED}:{key}".encode()).hexdigest(), r[0] is not None, r[0] or 0, r[3], r[2], r))
    ranked = []
    for source, of in order.items():
        of.sort(key=lambda x: x[:5])
        ranked += [((2 * k + 1) / (2 * len(of)), source is not None, source or "", *x) for k, x in enumerate(of)]
    ranked.sort(key=lambda x: x[:-1])
    n = len(ranked)
    out = []
    for at, x in enumerate(ranked):
        shard = at * shards // n
        out.append((*x[-1], shard, at - -(-shard * n // shards)))
    return Counter(out)


def measured(text):
    data = (text or "").encode()
    return len(data) + 1, zlib.crc32(data)


def test_shards_equal_brute_force(spark):
    rows = [(i, f"t{i % 50}" + "é" * (i % 7), f"s{min(i % 9, 4)}", "r", 1) for i in range(403)]
    rows += [(None, "a", "s1", "r", 2), (None, None, None, "r", 3), (7, "", None, "r", 4), (7, "again", "s0", "r", 5), (7, "again", "s0", "r", 5), (8, "x" * 90_000, "s0", "r", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, bucket string, rank int").repartition(4)
    got = sharding.shard(df).collect()
    want = brute_shards([(r[0], r[2], *measured(r[1])) for r in rows])
    assert Counter((r.doc_id, r.source, r["size"], r.text_crc32, r.shard, r.slot) for r in got) == want
    assert sharding.shard(df.limit(0)).count() == 0 and sharding.shard(df.limit(3)).count() == 3


@pytest.mark.parametrize("kind", ["sources of one row", "rows of one id", "equal rows"])
def test_no_task_of_the_orders_holds_most_rows(spark, monkeypatch, kind):
    """20,000 sources have one fraction; rows alike in all columns are dealt
    to many tasks as well."""
    n = 20_000
    columns = {
        "sources of one row": ["id as doc_id", "'a' as text", "cast(id as string) as source"],
        "rows of one id": ["7L as doc_id", "concat('a', id % 99) as text", "'s' as source"],
        "equal rows": ["7L as doc_id", "'a' as text", "'s' as source"],
    }
    df = spark.range(0, n, 1, 6).selectExpr(*columns[kind])
    largest = []
    placed = sharding._placed

    def watched(rows, order, name):
        with_task = rows.repartitionByRange(8, *order).groupBy(F.spark_partition_id()).count()
        largest.append(max(r["count"] for r in with_task.collect()))
        return placed(rows, order, name)

    monkeypatch.setattr(sharding, "_placed", watched)
    got = sharding.shard(df).groupBy("shard").agg(F.count("*"), F.max("slot"), F.countDistinct("slot")).collect()
    assert sorted(map(tuple, got)) == [(k, n // 8, n // 8 - 1, n // 8) for k in range(8)]
    assert len(largest) == 2 and max(largest) < n / 4


def test_all_documents_are_dealt_in_proportion(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").collect()
    df = sharding.op10_interleaved_shards(spark, SF)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
    got = df.collect()
    assert Counter((r.doc_id, r.source, r["size"], r.text_crc32, r.shard, r.slot) for r in got) == brute_shards([(r.doc_id, r.source, *measured(r.text)) for r in documents])
    of = defaultdict(Counter)
    for r in got:
        of[r.shard][r.source] += 1
    total = Counter(r.source for r in documents)
    for counts in of.values():
        assert all(abs(counts[s] - n / 8) <= 2 for s, n in total.items())


# -- pipeline -----------------------------------------------------------------------


def test_pipeline_equals_its_stages_by_brute_force(spark):
    import public_tokenizers as P
    from test_bpe_packing import check_pieces
    from test_dedup import brute_components
    from test_scans import brute_secrets
    from tokenizers import Tokenizer

    import corpus_pipeline
    from claimtide.llm import secret_scan

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    scorer = toxicity.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    rows = [(r.doc_id, r.text) for r in docs.collect() if scorer(r.text or "") < toxicity.THRESHOLD]
    by_text = {}
    for i, t in sorted(rows):
        by_text.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), (i, t))
    rows = sorted(by_text.values())
    stay = {c for _, _, c in brute_components(rows, 80)}
    rows = [(i, t) for i, t in rows if i in stay]
    texts = {}
    for i, t in rows:
        assert secret_scan.redact(t) == t or brute_secrets(t) or secret_scan.literal_spans(t)
        texts[i] = secret_scan.redact(t)
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids_of = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in texts.items()}
    check_pieces(corpus_pipeline.run(spark, sf).collect(), ids_of, 2048)


def test_stages_take_unusual_rows(spark):
    import corpus_pipeline

    rows = [(1, "a b c d e f", "en", "s", 11), (2, "a b  c d e f", None, None, None), (3, None, "en", "s", 0), (4, "", "de", "t", 0), (1, "a b c d e f", "en", "s", 11), (5, "A b c d e f", "en", "u", 11), (None, "other words here", "en", "s", 16)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for empty in (False, True):
        kept = docs.limit(0) if empty else docs
        for name, stage in corpus_pipeline.STAGES:
            kept = stage(spark, kept, SF)
            if name != "packing":
                assert kept.columns == docs.columns
        assert sorted({r.doc_id for r in kept.collect()}, key=str) == ([] if empty else [1, 3, None])


def test_fit_keeps_no_counted_words():
    """Of a text its numbers are kept, not its words as objects."""
    import tracemalloc

    texts = [" ".join("word" + "".join(chr(97 + int(d)) for d in str((k * 37 + j) % 900 + 100)) for j in range(400)) for k in range(600)]
    labels = np.arange(600) % 2
    kept = toxicity.Words(texts)
    assert kept[3] == toxicity.words_of(texts[3]) and len(kept) == 600
    few = slice(0, 80)
    assert toxicity.fit(toxicity.Words(texts[few]), labels[few]) == toxicity.fit([toxicity.words_of(t) for t in texts[few]], labels[few])
    tracemalloc.start()
    counted = [toxicity.words_of(t) for t in texts]
    whole = tracemalloc.get_traced_memory()[0]
    del counted
    tracemalloc.reset_peak()
    toxicity.Words(texts)[5]
    assert tracemalloc.get_traced_memory()[1] < whole / 10
    tracemalloc.stop()
