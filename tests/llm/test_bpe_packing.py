"""Byte-level BPE and packing against the tokenizer libraries."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from claimtide.llm import bpe, packing

MULTI, PLAIN = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.tiktoken")
ODD = ["", " ", "'s", "it's we'll 'tis '' ''s", "a  b\n\n c\t", "x" * 5000 + "!" * 999, "日本語 ²½  　é", "12 34'56", "\x1c \x00", "ab " * 3000]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(MULTI, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("ab 'strevmld\n\t12.!é日"), st.characters(exclude_categories=["Cs", "Cn"]))), max_size=5))
def test_ids_equal_the_library(library, texts):
    assert [x.tolist() for x in bpe.load(MULTI).encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_pieces_chunks_and_meeting_digests(library, monkeypatch):
    text = "some words, it's 12 o'clock  and\n\nso on " * 40
    want = library.encode_ordinary(text)
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 37)
    assert bpe.ByteBpe(MULTI).encode([text, "", text])[2].tolist() == want
    monkeypatch.setattr(bpe, "slice_digests", lambda raw, a, b: (b - a).astype(np.uint64))
    assert bpe.ByteBpe(MULTI).encode([text])[0].tolist() == want


def test_offsets_and_decoding(spark):
    df = spark.createDataFrame([(i, t, i, "x") for i, t in enumerate([*ODD, None])], "doc_id int, text string, ids int, decoded string")
    rows = bpe.decode(bpe.encode(df, MULTI).drop("decoded"), MULTI).collect()
    words = bpe.load(MULTI).words
    for r in rows:
        data = (r.text or "").encode()
        assert bytes(r.decoded) == data
        assert [data[o : o + len(words[i])] for i, o in zip(r.ids, r.offsets, strict=True)] == [words[i] for i in r.ids]


def test_digests_of_every_row(spark, library):
    texts = [*ODD, None, ODD[3]]
    df = spark.createDataFrame([(None if t is None else i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = bpe.round_trip_digests(df, MULTI).collect()
    want = []
    for i, t in enumerate(texts):
        ids = library.encode_ordinary(t or "")
        want.append((None if t is None else i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.round_trip_digests(df.limit(0), MULTI).count() == 0


def least_cost(at, cost, size):
    best = [0] + [None] * (len(at) - 1)
    for j in range(1, len(at)):
        best[j] = min(best[i] + size - (at[j] - at[i]) + cost[j] for i in range(j) if at[j] - at[i] <= size)
    return best[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.integers(0, 12)), min_size=1, max_size=40))
def test_cuts_are_the_cheapest(steps):
    at = np.cumsum([0] + [s for s, _ in steps])
    cost = np.array([0] + [c for _, c in steps])
    cuts = packing.best_cuts(at, cost, 10)
    ends = [0, *at[cuts].tolist()]
    assert ends[-1] == at[-1] and all(0 < b - a <= 10 for a, b in zip(ends, ends[1:]))
    assert sum(10 - (b - a) for a, b in zip(ends, ends[1:])) + cost[cuts].sum() == least_cost(at.tolist(), cost.tolist(), 10)


def check_pieces(rows, ids_of, size):
    """Each id in one piece; windows gapless from 0 and not too long."""
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    assert set(pieces) == set(ids_of)
    for key, of in pieces.items():
        ids, at = ids_of[key], 0
        for r in sorted(of, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for of in windows.values():
        at = 0
        for r in sorted(of, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    return windows


@pytest.mark.parametrize("size", [16, 2048])
def test_pieces_hold_every_id(spark, size):
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = [*ODD, None, "A sentence. Another one! " * 30]
    df = spark.createDataFrame([(i, t, i, "y") for i, t in enumerate(texts)], "doc_id long, text string, length int, start string").repartition(3)
    ids_of = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    check_pieces(packing.pack(df, PLAIN, size=size).collect(), ids_of, size)
    with_ids = packing.pack(df, PLAIN, size=size, with_ids=True).collect()
    assert all(r.ids == ids_of[r.doc_id][r.start : r.start + r.length] for r in with_ids)
    assert packing.pack(df.limit(0), PLAIN).count() == 0


def test_all_documents_are_packed_with_little_padding(spark):
    sf = "/root/testdata/sf0.001"
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = spark.read.parquet(f"{sf}/documents.parquet").collect()
    ids_of = {r.doc_id: [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1] for r in texts}
    windows = check_pieces(packing.op4_dp_packing(spark, sf).collect(), ids_of, packing.SIZE)
    assert sum(map(len, ids_of.values())) > 0.97 * packing.SIZE * (len(windows) - 1)


LITERALS = ["one <|endoftext|> two", "<|endoftext|>", "a<|endoftext|>'s <|endoftext|><|endoftext|>", "<|endoftext|", " <|endoftext|>\n\n", "<|<|endoftext|>|> it's. " * 40]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.one_of(st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", " ", "'s"]), st.text(alphabet="ab '\n1.日<|>", max_size=5)), max_size=8).map("".join), max_size=4))
def test_added_tokens_equal_the_library(texts):
    path = P.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = [*texts, *LITERALS, *ODD[:5]]
    coded = bpe.load(path)
    got = coded.encode(texts)
    assert [x.tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [coded.decode(x).decode() for x in got] == texts


def test_every_token_is_reached_by_its_merges():
    coded = bpe.load(P.path("byte_bpe_50k.json"))
    assert all(coded._merge_long(word) == [i] for word, i in coded.ranks.items())


def test_added_tokens_are_packed(spark, tmp_path):
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = [*ODD, *LITERALS, None]
    ids_of = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    assert sum(x.count(50256) for x in ids_of.values()) == 46
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    import corpus_pipeline

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for got in (packing.op4_dp_packing(spark, str(tmp_path)), corpus_pipeline.pack(spark, docs, str(tmp_path))):
        check_pieces(got.collect(), ids_of, packing.SIZE)
    small = packing.pack(docs, P.path("byte_bpe_50k.json"), size=16, with_ids=True).collect()
    assert all(r.ids == ids_of[r.doc_id][r.start : r.start + r.length] for r in small)


def test_rows_of_one_id_and_text_are_dealt_to_many_tasks(spark):
    """Null and repeated ids: every row's ids lie in pieces, and windows of
    several tasks hold the copies."""
    rows = [(7, "one and the same text. " * 30)] * 600 + [(None, "no id here.")] * 50 + [(None, None)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = packing.pack(df, P.path("byte_bpe_50k.json"), size=256).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for key, text, n in ((7, rows[0][1], 600), (None, "no id here.", 50), (None, "", 3)):
        ids = len(tokenizer.encode(text, add_special_tokens=False).ids) + 1
        of = [r for r in got if r.doc_id == key and r.doc_tokens == ids]
        assert sum(r.length for r in of) == n * ids and sum(r.start == 0 for r in of) == n
    windows = defaultdict(list)
    for r in got:
        windows[r.sequence_id].append((r.offset, r.length))
    for of in windows.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(of), sorted(of)[1:], strict=False)) and sum(n for _, n in of) <= 256
    assert len({r.sequence_id >> 36 for r in got if r.doc_id == 7}) > 1
