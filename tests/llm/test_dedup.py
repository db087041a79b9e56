"""Exact and near de-duplication against brute force."""

from __future__ import annotations

import math
import os
import random
import re
import sys
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimtide.llm import exact_dedup, near_dedup, tables

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))
SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, digest string, row int, n int"


def index_of(spark, path=None):
    return exact_dedup.DigestIndex(spark, path or tables.scratch(spark, "test-index"), buckets=4)


def test_equal_texts_form_groups(spark):
    rows = [(5, "a  b\n"), (2, "a b "), (9, None), (7, ""), (3, "a\tb"), (3, "a b"), (None, "c"), (4, "c"), (8, "x" * 100_000), (1, "x" * 100_000)]
    df = spark.createDataFrame([(i, t, "d", 1, 2) for i, t in rows], SCHEMA)
    got = exact_dedup.dedup(df, index_of(spark)).collect()
    groups = Counter((r.doc_id, r.keep_id, r.group_size) for r in got)
    assert groups == Counter({(5, 2, 2): 1, (2, 2, 2): 1, (9, 7, 2): 1, (7, 7, 2): 1, (3, 3, 2): 2, (None, 4, 2): 1, (4, 4, 2): 1, (8, 1, 2): 1, (1, 1, 2): 1})
    assert Counter(r.doc_id for r in got if r.kept) == Counter([2, 7, 3, 4, 1])
    assert exact_dedup.dedup(df.limit(0), index_of(spark)).count() == 0


def test_the_index_outlives_a_batch(spark):
    path = tables.scratch(spark, "test-index")
    one = spark.createDataFrame([(10, "a b"), (11, "c")], "doc_id long, text string")
    two = spark.createDataFrame([(1, "a  b"), (2, "d"), (3, "d")], "doc_id long, text string")
    assert {r.doc_id for r in exact_dedup.dedup(one, index_of(spark, path)).collect() if r.kept} == {10, 11}
    again = index_of(spark, path)  # opened anew
    assert {(r.doc_id, r.keep_id, r.kept) for r in exact_dedup.dedup(two, again).collect()} == {(1, 10, False), (2, 2, True), (3, 2, False)}
    assert again.table().count() == 3
    assert exact_dedup.distinct_texts(two, again).count() == 0


def test_the_anti_join_reads_sorted_buckets(spark):
    index = index_of(spark)
    index.append(spark.createDataFrame([(bytearray(b"a" * 32), 1)], "digest binary, keep_id long"), "one")
    batch = spark.createDataFrame([(bytearray(b"b" * 32), 2)], "digest binary, keep_id long")
    plan = index.unseen(batch, "two")._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert "Exchange" not in index.before("two")._jdf.queryExecution().executedPlan().toString()


def kept_of(spark, df, path, batch, whole):
    with index_of(spark, path) as index:
        if whole:
            return sorted(r.doc_id for r in exact_dedup.distinct_texts(df, index, batch=batch).collect())
        return sorted(r.doc_id for r in exact_dedup.dedup(df, index, batch=batch).collect() if r.kept)


@pytest.mark.parametrize("whole", [False, True])
def test_a_batch_may_be_run_again(spark, monkeypatch, whole):
    """Also after a failure between append and output, and after a part of the
    append; other batches still count as seen."""
    path = tables.scratch(spark, "test-index")
    one = spark.createDataFrame([(1, "a b"), (2, "c"), (3, "a  b")], "doc_id long, text string")
    two = spark.createDataFrame([(4, "c"), (5, "d")], "doc_id long, text string")
    with index_of(spark, path) as index:  # of the first digest only
        part = one.where("doc_id = 2").select(F.unhex(F.sha2("text", 256)).alias("digest"), F.col("doc_id").alias("keep_id"))
        index.append(part, "one")
    if not whole:
        with monkeypatch.context() as broken, pytest.raises(OSError):
            broken.setattr(exact_dedup, "join_groups", lambda *_: (_ for _ in ()).throw(OSError()))
            kept_of(spark, one, path, "one", whole)
    for _ in range(3):
        assert kept_of(spark, one, path, "one", whole) == [1, 2]
    for _ in range(2):
        assert kept_of(spark, two, path, "two", whole) == [5]
    assert kept_of(spark, one, path, "one", whole) == [1, 2]
    assert kept_of(spark, one, path, None, whole) == []
    with exact_dedup.DigestIndex(spark, path, buckets=9) as index:
        assert index.buckets == 4 and index.table().count() == 3
        index.append(part.withColumn("digest", F.unhex(F.lit("00"))), "three")
        spark.sql(f"INSERT INTO {index.name} SELECT digest, 1L, 'four' FROM {index.name} WHERE batch = 'three'")
        assert index.before("one").where("digest = unhex('00')").collect()[0]["keep_id"] == 1
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("digest_index") and t.name == index.name]


def test_rows_that_stay_keep_their_columns(spark):
    rows = [(2, "a b", "x", 1, 1), (1, "a  b", "y", 2, 2), (1, "a  b", "y", 2, 2), (None, None, "z", 3, 3), (4, "", "w", 4, 4)]
    got = exact_dedup.distinct_texts(spark.createDataFrame(rows, SCHEMA), index_of(spark))
    assert got.columns == ["doc_id", "text", "digest", "row", "n"]
    assert sorted(map(tuple, got.collect())) == [(1, "a  b", "y", 2, 2), (4, "", "w", 4, 4)]


# -- near duplicates ----------------------------------------------------------


def shingles(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows, percent=85):
    sets = [(i, shingles(t)) for i, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(i, least.get(find(k), i))
    return Counter((i, len(s), least[find(k)]) for k, (i, s) in enumerate(sets))


def found(df):
    rows = near_dedup.groups(df).collect()
    return Counter((r.id, r.n, r.root.id if r.n else r.id) for r in rows)


def near_copies(seed, n, words, change):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    base = [rng.choice(vocabulary) for _ in range(words)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randint(0, change)):
            text[rng.randrange(words)] = rng.choice(vocabulary)
        out.append(" ".join(text))
    return out


def test_components_equal_brute_force(spark):
    texts = [*near_copies(1, 60, 120, 4), *near_copies(2, 40, 200, 3), *near_copies(3, 30, 40, 1), "One two", "one  TWO", "", None, " \n", "a b c d e", "A b c D e f", "long " * 20_000]
    rows = list(enumerate(texts)) + [(3, texts[3]), (7, texts[90])]
    df = spark.createDataFrame([(i, t, "d", 1, 2) for i, t in rows], SCHEMA)
    assert found(df) == brute_components(rows)


def test_chains_are_followed_to_the_end(spark):
    words = [f"c{k}" for k in range(150)]
    rows = [(100 - k, " ".join(words[k * 2 : k * 2 + 90])) for k in range(25)]  # each is near its neighbours only
    want = brute_components(rows)
    assert len({c for _, _, c in want}) == 1
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == want


@pytest.mark.parametrize("tile", [3, 512])
def test_buckets_that_hold_several_components_go_on(spark, monkeypatch, tile):
    monkeypatch.setattr(near_dedup, "TILE", tile)
    rows = list(enumerate(near_copies(5, 60, 90, 7)))
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute_components(rows)


def test_links_across_components(monkeypatch):
    monkeypatch.setattr(near_dedup, "COLUMNS", 7)
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 40)).astype(np.uint64) for _ in range(12)]
    want = [[len(np.intersect1d(x, y)) for y in sets[5:]] for x in sets[:5]]
    assert near_dedup.common_counts(sets[:5], sets[5:]).tolist() == want
    one = np.arange(100, dtype=np.uint64)
    some = [(1, 1, one), (2, 2, one[:90]), (3, 3, one[:50])]
    assert len(near_dedup.joining_links(some, [*some, (9, 1, one)], 85)) == 1


def test_first_documents_stay_with_their_columns(spark):
    texts = near_copies(1, 12, 120, 2)
    rows = [(20 + i, t, "d", i, 2) for i, t in enumerate(texts)] + [(1, "", "e", 0, 0), (2, None, "f", 0, 0), (20, texts[0], "d", 0, 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = near_dedup.first_documents(df)
    want = {c for _, n, c in brute_components([r[:2] for r in rows]) if n} | {1, 2}
    assert got.columns == df.columns and Counter(r.doc_id for r in got.collect()) == Counter(want)
    assert near_dedup.first_documents(df.limit(0)).count() == 0


def test_odd_column_names_are_kept(spark):
    rows = [(1, "a b c d e f", 1, 2, 3), (2, "a  b c d e f", 4, 5, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `a.b` int, `x``y` int, `row` int")
    for got in (near_dedup.first_documents(df), exact_dedup.distinct_texts(df, index_of(spark))):
        assert got.columns == df.columns and [tuple(r) for r in got.collect()] == rows[:1]


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    a, b = np.sort(pool[:2000]), np.sort(pool[200:2200])
    one, two, both = (near_dedup.registers(x, np.array([0])) for x in (a, b, np.union1d(a, b)))
    assert (near_dedup.merge(one, two) == both).all()
    estimate = near_dedup.likely_similarity(one, two, np.array([2000.0]), np.array([2000.0]))[0]
    assert abs(estimate - 1800 / 2200) < 0.15


def test_op6_and_op8_on_documents(spark):
    documents = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = near_dedup.op6_setsketch_near_dedup(spark, SF).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(documents)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    from check_contract import duck

    want = duck(SF).execute(exact_dedup.OP8_SQL).fetchall()
    assert Counter(map(tuple, exact_dedup.op8_digest_index(spark, SF).collect())) == Counter(want)


def test_words_of_one_pattern_are_told_apart(spark):
    """A Thue-Morse word and its complement have one polynomial hash to every
    odd base; so have long words that differ in two places only, by design."""
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    rows = [(1, word), (2, word.translate(str.maketrans("ab", "ba"))), (3, "abcdefgh"), (4, "abcdefgh\0"), (5, "abcdefg"), (6, "é" * 9), (7, word)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == Counter({(i, 1, 1 if i == 7 else i): 1 for i, _ in rows})
    raw = np.frombuffer(" ".join(t for _, t in rows).encode() + b" " * 8, np.uint8)
    edge = np.diff(np.concatenate([[0], raw != 32, [0]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    assert len(set(near_dedup.word_digests(raw, starts, ends).tolist())) == 6


def test_rows_without_words_stay_and_meet_in_no_task(spark):
    rows = [(1, None, "x"), (1, None, "y"), (None, " \n", "z"), (2, "", "w"), (3, "a b", "v"), (3, "a b", "u"), (4, "A  b", "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, held string")
    got = near_dedup.first_documents(df)
    assert sorted(r["held"] for r in got.where("held < 'x' or held > 'v'").where("doc_id is null or doc_id < 3").collect()) == ["w", "x", "y", "z"]
    assert [(r.doc_id, r.text) for r in got.where("doc_id > 2").collect()] == [(3, "a b")]
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()


def template_copies(seed, n, words, share):
    """Documents that share the first words and have the others for themselves:
    mostly too far apart for a link."""
    rng = random.Random(seed)
    common = [f"t{k}" for k in range(words)]
    out = []
    for k in range(n):
        own = [f"d{k}w{i}" for i in range(int(words * share * rng.uniform(0.8, 1.2)))]
        out.append(" ".join(common[: words - len(own)] + own))
    return out


@pytest.mark.parametrize("tile", [16, 64])
def test_a_crowded_bucket_is_searched_by_rare_shingles(spark, monkeypatch, tile):
    """Three hundred documents of one template at similarities of 0.6 to 0.8,
    some with near copies: all links, few sets in tiles."""
    monkeypatch.setattr(near_dedup, "TILE", tile)
    texts = template_copies(1, 300, 200, 0.12)
    texts += [f"{t} z{k}" for k, t in enumerate(texts[:40])] + [f"{t} y{k} y y y y" for k, t in enumerate(texts[20:60])]
    rows = list(enumerate(texts))
    random.Random(2).shuffle(rows)
    seen = {}
    kept = near_dedup.written

    def watched(df, name):
        out = kept(df, name)
        if name in ("near-rare", "near-crowded", "near-open"):
            seen.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "written", watched)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert found(df) == brute_components(rows)
    assert seen["near-crowded"][0] > 200  # most rows are in a crowded bucket
    assert seen["near-rare"][0] < seen["near-crowded"][0] * 60  # 15 % of the shingles and one


def test_rarest_shingles_meet_in_every_link():
    """Any two linked sets have a shingle in common among their rarest."""
    rng = np.random.default_rng(5)
    rarity = rng.integers(0, 5, near_dedup.RARITIES)
    for percent in (80, 85, 100):
        linked = 0
        for _ in range(300):
            pool = rng.integers(0, 1 << 63, 60).astype(np.uint64)
            n = int(rng.integers(1, 50))
            a, b = np.unique(pool[:n]), np.unique(np.concatenate([pool[: n - rng.integers(0, max(1, n // 6))], pool[50 : 50 + rng.integers(0, 4)]]))
            common = len(np.intersect1d(a, b))
            if 100 * common >= percent * (len(a) + len(b) - common):
                linked += 1
                assert len(np.intersect1d(near_dedup.rarest(a, rarity, percent), near_dedup.rarest(b, rarity, percent)))
        assert linked > 10


def pairs_around(percent, n):
    """Pairs of their own words, every second one a link by the least margin."""
    rows = []
    for k in range(n):
        words = [f"p{k}w{i}" for i in range(200)]
        # the last t words differ: 196 - t of 196 + t shingles are common
        t = max(t for t in range(196) if 100 * (196 - t) >= percent * (196 + t)) + k % 2
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join([*words[: 200 - t], *(f"q{w}" for w in words[200 - t :])]))]
    return rows


@pytest.mark.parametrize("percent", [80, 70, 30])
def test_thresholds_equal_brute_force(spark, percent):
    rows = pairs_around(percent, 500)
    links = {(a, b) for (a, x), (b, y) in zip(rows[::2], rows[1::2], strict=True) if 100 * len(shingles(x) & shingles(y)) >= percent * len(shingles(x) | shingles(y))}
    assert links == {(2 * k, 2 * k + 1) for k in range(0, 500, 2)}
    got = near_dedup.groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), percent=percent).collect()
    assert {(r.root.id, r.id) for r in got if r.root.id != r.id} == links


def test_the_pipeline_links_from_080_on(spark, tmp_path):
    import corpus_pipeline

    rows = pairs_around(80, 40)
    got = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path))
    assert {r.doc_id for r in got.collect()} == {i for i, _ in rows} - {2 * k + 1 for k in range(0, 40, 2)}


@pytest.mark.parametrize("percent", [85, 80])
def test_a_link_at_the_threshold_is_hardly_lost(percent):
    bands, rows, least = near_dedup.limits(percent)
    at, n = percent / 100, near_dedup.REGISTERS
    assert bands * rows <= n and (1 - at**rows) ** bands <= 2.1e-8
    below = range(math.ceil(least * n))
    assert sum(math.comb(n, k) * at**k * (1 - at) ** (n - k) for k in below) < 1e-12
