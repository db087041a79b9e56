"""Slices, their table, and importance resampling against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from claimtide.llm import importance
from claimtide.llm.words import SliceTable, same_bytes, words_of, xxhash64

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


TEXT = st.text(alphabet=st.sampled_from("abAB01 _-\n\0é漢\U0001f600K"), max_size=300)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, max_size=6), st.integers(1, 4))
def test_words_grams_and_hashes(texts, n):
    words = words_of(texts)
    of = lambda a, b: words.raw[a:b].tobytes()
    assert np.diff(words.first).tolist() == [len(brute_words(t)) for t in texts]
    want = [(k, " ".join(w[i : i + n]).encode()) for k, t in enumerate(texts) for w in [brute_words(t)] for i in range(len(w) - n + 1)]
    starts, ends, text = words.grams(n)
    assert [(k, of(a, b)) for a, b, k in zip(starts, ends, text.tolist(), strict=True)] == want
    assert xxhash64(words.raw, starts, ends).tolist() == [xxhash.xxh64_intdigest(w) for _, w in want]
    table = SliceTable(words.raw, starts, ends)
    owners = table.owner[table.slot]
    assert [of(starts[o], ends[o]) for o in owners] == [w for _, w in want]
    assert len(table.filled()) == len({w for _, w in want})


def test_slices_with_one_key_are_told_apart_by_their_bytes():
    words = words_of(["one two one three " + "x" * 300 + " " + "x" * 300 + " " + "x" * 299 + "y two"])
    table = SliceTable(words.raw, words.starts, words.ends, np.full(len(words.starts), 5, np.uint64))
    assert len(table.filled()) == 5
    slot = table.slot
    assert slot[0] == slot[2] and slot[1] == slot[-1] and slot[4] == slot[5] != slot[6]
    assert same_bytes(words.raw, words.starts[:1], words.ends[:1], words.raw, words.starts[2:3], words.ends[2:3]).all()
    for size in (*range(1, 70), 255, 256, 257, 1000):
        raw = np.frombuffer(bytes(range(1, 251)) * 5, np.uint8)
        assert xxhash64(raw, np.array([3]), np.array([3 + size]))[0] == xxhash.xxh64_intdigest(raw[3 : 3 + size].tobytes())


def brute(rows, target, longest, buckets, percent, least):
    grams = lambda t: [" ".join(w[i : i + n]) for w in [brute_words(t)] for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
    place = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = (Counter(place(g) for x in side for g in grams(x)) for side in ([x for _, x in rows], target))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
    out = []
    for i, x in rows:
        found = [gain(place(g)) for g in grams(x)]
        weight = sum(found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(brute_words(x)), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    may = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    drawn = len(may) * percent // 100
    return Counter((*r, k + 1 if k < drawn else None) for k, r in enumerate(may)) + Counter((*r, None) for r in out if r[1] < least)


def test_draw_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    words = ["alpha", "Beta", "gämma", "delta-x", "k" * 300, "7"]
    rows = [(int(rng.integers(40)), " ".join(rng.choice(words, int(rng.integers(0, 30))))) for _ in range(300)]
    rows += [(None, None), (None, "alpha alpha beta"), (5, ""), (6, " \n"), (7, "x y " * 50_000), *[(9, rows[0][1])] * 40]
    target = ["alpha gämma", None, "", "gämma"]
    df = spark.createDataFrame([(i, t, 1, 2, "r") for i, t in rows], "doc_id long, text string, id int, score int, row string").repartition(7)
    to = spark.createDataFrame([(t,) for t in target], "text string")
    for longest, percent, least in ((1, 10, 3), (2, 50, 0), (1, 100, 3), (3, 0, 1)):
        gains = importance.bucket_gains(*(importance.bucket_counts(x, "text", longest, 97) for x in (df, to)))
        got = importance.draw(importance.weights(df, gains, longest=longest), percent, least).collect()
        assert Counter(tuple(r) for r in got) == brute(rows, target, longest, 97, percent, least)


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    gains = importance.bucket_gains(importance.bucket_counts(df), importance.bucket_counts(df))
    assert set(gains.tolist()) == {0}
    assert importance.draw(importance.weights(df, gains)).collect() == []


def test_ranks_are_dealt_to_many_tasks(spark):
    """No window over all drawn rows: ties of one score and id as well."""
    rows = spark.range(4000).selectExpr("1L as id", "30L as n_words", "30L as n_features", "0L as weight")
    got = importance.draw(rows, 100)
    assert sorted(r["rank"] for r in got.collect()) == list(range(1, 4001))
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
