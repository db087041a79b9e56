"""Wu-Manber search against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from test_importance import brute_words

from claimtide.llm import decontamination
from claimtide.llm.words import words_of


def brute(text, items, window):
    words = brute_words(text)
    hit, names = set(), set()
    for name, item in items:
        of = brute_words(item)
        n = min(window, len(of))
        for a in range(len(of) - n + 1 if n else 0):
            for i in range(len(words) - n + 1):
                if words[i : i + n] == of[a : a + n]:
                    hit |= set(range(i, i + n))
                    names.add(name)
    return len(words), hit, sorted(names)


PASSAGE = st.lists(st.sampled_from(["a", "b", "ab", "é", "C", "w" * 300]), max_size=40).map(" ".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(PASSAGE, max_size=4), st.lists(st.tuples(st.sampled_from(["1", "2", "10"]), PASSAGE), max_size=5), st.integers(1, 6))
def test_search_equals_brute_force(texts, items, window):
    words = words_of(texts)
    benchmark = decontamination.Benchmark(items, window)
    hit, pairs = benchmark.search(words)
    for k, text in enumerate(texts):
        _, places, names = brute(text, items, window)
        assert set(np.flatnonzero(hit[words.first[k] : words.first[k + 1]]).tolist()) == places
        assert [benchmark.names[item] for t, item in pairs if t == k] == names


def test_shifts_skip_words_that_no_window_has(monkeypatch):
    """Of a text without any block of the benchmark a lane looks at every ninth
    word only."""
    seen = []
    blocks = decontamination._blocks
    monkeypatch.setattr(decontamination, "_blocks", lambda h, at, w: seen.append(len(at)) or blocks(h, at, w))
    benchmark = decontamination.Benchmark([("1", " ".join(f"w{k}" for k in range(40)))])
    seen.clear()
    benchmark.search(words_of([" ".join(f"x{k}" for k in range(6400))]))
    assert sum(seen) <= 1.15 * 6400 / 8


def documents(spark):
    rng = random.Random(5)
    passage = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "Delta", "épsilon", "zeta9"]) for _ in range(n))
    items = [(k, passage(rng.choice([0, 1, 3, 9, 10, 11, 40]))) for k in range(30)] + [(3, "zeta9 zeta9 zeta9 zeta9"), (None, "quite other words"), (7, None), (8, " .\n")]
    items += [(100 + k, items[20][1] + " tail words of many items with one passage in common here") for k in range(20)]
    texts = [f"{passage(20)} -- {(items[k % 30][1] or '').upper()}, {passage(5)}" for k in range(60)]
    texts += [None, "", "...", "alpha", "x " * 30_000 + items[40][1] + " y" * 30_000, texts[0], texts[0], "QUITE other  words", "quite other word s"]
    rows = [(None if k == 3 else k % 65, t, 1, 2, "z") for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, hits int, items int, digest string").repartition(5)
    return df, rows, spark.createDataFrame(items, "item_id long, text string"), items


def test_documents_in_one_block_and_in_several(spark):
    df, rows, benchmark, items = documents(spark)
    named = [("" if i is None else str(i), t) for i, t in items]
    for window, block_bytes in ((10, 4_000_000), (10, 300), (3, 900)):
        want = Counter()
        for i, t, *_ in rows:
            n, hit, names = brute(t, named, window)
            want[i, n, len(hit), ",".join(names), tuple(sorted(hit))] += 1
        got = decontamination.search(df, benchmark, window=window, block_bytes=block_bytes).collect()
        places = lambda bits: tuple(np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8))).tolist())
        assert Counter((r.doc_id, r.n_words, r.n_hit, ",".join(r["items"]), places(r.hits)) for r in got) == want


def test_empty_tables(spark):
    df, rows, benchmark, _ = documents(spark)
    assert decontamination.search(df.limit(0), benchmark).collect() == []
    assert all(r.n_hit == 0 and r["items"] == [] for r in decontamination.search(df, benchmark.limit(0)).collect())
