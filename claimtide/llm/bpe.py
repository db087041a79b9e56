"""Byte-level BPE encoding and decoding (operator 1).

Pre-tokenisation runs without a regular expression.  Every code point is
mapped to a class by one array lookup; one character of lookahead is folded
into the class (a white-space character before a visible one, an apostrophe
that opens a contraction).  Over these symbols the split pattern is a small
automaton.  Its transition functions are closed under composition (a monoid
of a few dozen elements), so the state before every character comes from an
associative scan: a running product inside fixed-length blocks, a scan over
the block products, and one more lookup per character.  A second lookup says
whether a token starts there.

The slices are de-duplicated per chunk, looked up in a per-worker cache, and
the unseen ones are merged together, all slices of one byte length at a time.
Byte offsets of all tokens are kept, so decoding is a gather.

Cases: a null text counts as empty (no ids, digest of no bytes); a document
of any length is cut into pieces where a token always starts, so memory
depends on ``CHUNK_CHARS`` and the longest run without such a place; repeated
rows give repeated results; an empty table gives an empty one; columns of the
input are replaced where their name is one of the result's.

A vocabulary is a rank file or the JSON file of a tokenizer.  The latter may
name added tokens: their literals are taken out of a text before all else,
wherever they stand, and the parts between them are encoded by themselves.  A
rank file has none, so that there such a literal is a text like any other.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimtide.llm.slices import slice_digests

#: characters handled at once; a chunk's arrays take some 100 bytes for each.
CHUNK_CHARS = 800_000
#: distinct slices a worker remembers before it starts afresh.
CACHE_SLICES = 1_000_000
#: slices of more bytes are merged one by one with a heap.
MATRIX_BYTES = 40

# fixed values: white space as the split pattern's \s sees it
WHITE_SPACE = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# fixed values: endings of English contractions in the split pattern
SHORT_ENDINGS = ("s", "t", "m", "d")
LONG_ENDINGS = ("re", "ve", "ll")

# symbols the automaton reads
OTHER, LETTER, NUMBER, GAP, LAST_GAP, JOINING_SPACE, SHORT_CONTRACTION, LONG_CONTRACTION = range(8)
SYMBOLS = 8
# its states: what the token that holds the last character is
DONE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_GAP, AFTER_SPACE, ONE_MORE, TWO_MORE = range(8)
STATES = 8
BLOCK = 128


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """(next state, whether a token starts at this character)."""
    if state == TWO_MORE:
        return ONE_MORE, False
    if state == ONE_MORE:
        return DONE, False
    if symbol in (SHORT_CONTRACTION, LONG_CONTRACTION):
        if state in (IN_OTHERS, AFTER_SPACE):
            return IN_OTHERS, False
        return (ONE_MORE if symbol == SHORT_CONTRACTION else TWO_MORE), True
    if symbol == GAP:
        return IN_GAP, state != IN_GAP
    if symbol == LAST_GAP:
        return DONE, True
    if symbol == JOINING_SPACE:
        return AFTER_SPACE, True
    run = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS}[symbol]
    return run, state not in (run, AFTER_SPACE)


class _Automaton:
    """The transition monoid: elements by number, products by table."""

    def __init__(self):
        plain = [tuple(_step(s, x)[0] for s in range(STATES)) for x in range(SYMBOLS)]
        # a document's first character forgets the state before it
        first = [(f[DONE],) * STATES for f in plain]
        identity = tuple(range(STATES))
        elements = {f: i for i, f in enumerate(dict.fromkeys([*plain, *first, identity]))}
        fresh = list(elements)
        while fresh:
            made = {tuple(g[x] for x in f) for f in list(elements) for g in fresh}
            made |= {tuple(g[x] for x in f) for f in fresh for g in list(elements)}
            fresh = [f for f in made if f not in elements]
            for f in fresh:
                elements[f] = len(elements)
        every = list(elements)
        self.size = len(every)
        self.identity = elements[identity]
        self.generator = np.array([elements[f] for f in plain + first], np.intp)
        #: product[f * size + g]: first f, then g
        self.product = np.array([elements[tuple(g[x] for x in f)] for f in every for g in every], np.intp)
        self.from_start = np.array([f[DONE] for f in every], np.intp)
        starts = [[_step(s, x)[1] for x in range(SYMBOLS)] for s in range(STATES)]
        #: starts[state * 2 * SYMBOLS + symbol (+ SYMBOLS for a document's first character)]
        self.starts = np.array([row + [True] * SYMBOLS for row in starts], bool).ravel()

    def states_before(self, symbols: np.ndarray) -> np.ndarray:
        """State before each character, by a blocked scan over the monoid."""
        n = len(symbols)
        blocks = -(-n // BLOCK)
        grid = np.full(blocks * BLOCK, self.identity, np.intp)
        grid[:n] = self.generator[symbols]
        grid = np.ascontiguousarray(grid.reshape(blocks, BLOCK).T)
        for k in range(1, BLOCK):  # running products inside all blocks at once
            np.take(self.product, grid[k - 1] * self.size + grid[k], out=grid[k])
        total, reach = grid[-1].copy(), 1
        while reach < blocks:  # inclusive scan over the block products
            total[reach:] = self.product[total[:-reach] * self.size + total[reach:]]
            reach *= 2
        carry = np.concatenate([[self.identity], total[:-1]]) * self.size
        before = np.empty_like(grid)
        before[0] = self.from_start[carry // self.size]
        before[1:] = self.from_start[self.product[carry + grid[:-1]]]
        return np.ascontiguousarray(before.T).ravel()[:n]


@lru_cache(1)
def _automaton() -> _Automaton:
    return _Automaton()


@lru_cache(1)
def _classes() -> np.ndarray:
    """Class of every code point, from its general category."""
    table = np.full(0x110000, OTHER, np.uint8)
    kinds = [unicodedata.category(chr(c))[0] for c in range(0x110000)]
    kinds = np.array(kinds)
    table[kinds == "L"] = LETTER
    table[kinds == "N"] = NUMBER
    table[WHITE_SPACE] = GAP
    return table


def token_starts(points: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """Where tokens start in ``points``; ``documents`` marks first characters."""
    n = len(points)
    if not n:
        return np.zeros(0, np.intp)
    symbols = _classes()[points].astype(np.intp)
    gap = symbols == GAP
    first = np.zeros(n + 1, bool)
    first[documents] = True
    first[n] = True
    closing = first[1:]
    before_visible = np.zeros(n, bool)
    before_visible[:-1] = ~gap[1:] & ~closing[:-1]
    last = gap & before_visible
    symbols[last] = LAST_GAP
    symbols[last & (points == 0x20)] = JOINING_SPACE
    at = np.flatnonzero(points == ord("'"))
    if len(at):
        padded = np.concatenate([points, np.zeros(3, points.dtype)])
        one, two = padded[at + 1], padded[at + 2]
        room = ~closing[at]
        short = room & np.isin(one, [ord(x) for x in SHORT_ENDINGS])
        room &= ~np.concatenate([closing, [True]])[at + 1]
        long = np.zeros(len(at), bool)
        for a, b in LONG_ENDINGS:
            long |= room & (one == ord(a)) & (two == ord(b))
        symbols[at[short]] = SHORT_CONTRACTION
        symbols[at[long]] = LONG_CONTRACTION
    machine = _automaton()
    symbols[first[:n]] += SYMBOLS
    return np.flatnonzero(machine.starts[machine.states_before(symbols) * (2 * SYMBOLS) + symbols])


def _rank_file(path: str) -> tuple[dict[bytes, int], dict[int, int]]:
    """Ids of the tokens and of the pairs that merge, from lines of base64
    token and id: all pairs whose bytes are a token merge."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    pairs = {}
    for word, i in ranks.items():
        for cut in range(1, len(word)):
            a, b = ranks.get(word[:cut]), ranks.get(word[cut:])
            if a is not None and b is not None:
                pairs[a << 20 | b] = i
    return ranks, pairs


def _byte_letters() -> dict[str, int]:
    """The byte behind each character of a JSON file's tokens: printable
    Latin-1 stands for itself, the other bytes follow from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _json_file(path: str) -> tuple[dict[bytes, int], dict[int, int], dict[str, int]]:
    """Ids of the tokens, of the pairs that merge and of the added tokens;
    settings that would need other work are refused."""
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    model, split, added = whole["model"], whole["pre_tokenizer"] or {}, whole["added_tokens"]
    plain = model["type"] == "BPE" and not whole["normalizer"] and not any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
    plain &= split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    merges = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
    vocabulary = model["vocab"]
    made = [vocabulary[a + b] for a, b in merges]
    if not plain or made != sorted(made) or any(x["single_word"] or x["lstrip"] or x["rstrip"] for x in added):
        raise ValueError(f"{path}: not a plain byte-level BPE")
    literals = {x["content"]: x["id"] for x in added}
    letters = _byte_letters()
    ranks = {bytes(letters[c] for c in word): i for word, i in vocabulary.items() if word not in literals}
    return ranks, {vocabulary[a] << 20 | vocabulary[b]: i for (a, b), i in zip(merges, made, strict=True)}, literals


class ByteBpe:
    """Encoder and decoder for one vocabulary: a rank file (lines of base64
    token and id) or the JSON file of a tokenizer, with its added tokens."""

    def __init__(self, path: str):
        self.added: dict[str, int] = {}
        if path.endswith(".json"):
            self.ranks, pairs, self.added = _json_file(path)
        else:
            self.ranks, pairs = _rank_file(path)
        # where several begin at one place, the longest counts
        longest = sorted(self.added, key=len, reverse=True)
        self.literals = re.compile("|".join(map(re.escape, longest))) if longest else None
        size = max([*self.ranks.values(), *self.added.values()]) + 1
        words = [b""] * size
        for word, i in [*self.ranks.items(), *((w.encode(), i) for w, i in self.added.items())]:
            words[i] = word
        self.words = words
        self.word_length = np.array([len(w) for w in words], np.int64)
        self.word_start = np.concatenate([[0], np.cumsum(self.word_length)[:-1]])
        self.word_bytes = np.frombuffer(b"".join(words), np.uint8)
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.none = size  # rank of a pair that doesn't merge
        keys = np.array(sorted(pairs), np.int64)
        self.pair_keys = np.append(keys, np.iinfo(np.int64).max)
        self.pair_ranks = np.array([pairs[k] for k in keys.tolist()] + [self.none], np.int64)
        self.pairs = pairs
        self._forget()

    # -- cache of merged slices: sorted digests -> slots; a slot's ids lie in a
    # pool.  Two slices that meet in one digest are found when the ids of a
    # chunk are decoded again and differ from its bytes.
    def _forget(self) -> None:
        self.known, self.known_slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.slot_start, self.slot_length, self.pool = (np.zeros(1024, np.int64) for _ in range(3))
        self.pooled = self.made = 0

    @staticmethod
    def _room(array: np.ndarray, n: int) -> np.ndarray:
        return array if n <= len(array) else np.concatenate([array, np.zeros(max(n, 2 * len(array)) - len(array), array.dtype)])

    def _rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 20 | b
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], self.none)

    def _merge_matrix(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge all rows at once: each round joins every row's lowest pair.

        A merged pair's right half is marked -1 and skipped, so a round needs
        the ranks of the two new neighbour pairs only."""
        m, width = ids.shape
        ids = ids.copy()
        rows = np.arange(m)
        if width == 1:
            return ids, np.ones(m, np.int64)
        after = np.tile(np.arange(1, width + 1), (m, 1))  # next live column
        before = np.tile(np.arange(-1, width - 1), (m, 1))
        rank = np.full((m, width), self.none, np.int64)
        rank[:, :-1] = self._rank_of(ids[:, :-1], ids[:, 1:])
        while len(rows):
            j = rank[rows].argmin(1)
            best = rank[rows, j]
            going = best < self.none
            rows, j, best = rows[going], j[going], best[going]
            if not len(rows):
                break
            k = after[rows, j]
            ids[rows, j] = best
            ids[rows, k] = -1
            rank[rows, k] = self.none
            right = after[rows, k]
            after[rows, j] = right
            inner = right < width
            before[rows[inner], right[inner]] = j[inner]
            rank[rows, j] = self.none
            rank[rows[inner], j[inner]] = self._rank_of(best[inner], ids[rows[inner], right[inner]])
            left = before[rows, j]
            inner = left >= 0
            rank[rows[inner], left[inner]] = self._rank_of(ids[rows[inner], left[inner]], best[inner])
        return ids, (ids >= 0).sum(1)

    def _merge_long(self, word: bytes) -> list[int]:
        """One long slice with a heap of pairs: n log n steps."""
        ids = self.of_byte[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = self.pairs
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := pairs.get(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            k = after[i]
            if ids[i] != a or k >= n or ids[k] != b:
                continue
            ids[i], ids[k] = r, -1
            after[i] = right = after[k]
            if right < n:
                before[right] = i
                if (x := pairs.get(r << 20 | ids[right])) is not None:
                    heapq.heappush(heap, (x, i, r, ids[right]))
            if (left := before[i]) >= 0 and (x := pairs.get(ids[left] << 20 | r)) is not None:
                heapq.heappush(heap, (x, left, ids[left], r))
        return [i for i in ids if i >= 0]

    def _learn(self, words: list[bytes]) -> np.ndarray:
        """Merge slices and put their ids into the pool; their slots."""
        out = np.zeros(len(words), np.int64)
        by_length: dict[int, list[int]] = {}
        for row, word in enumerate(words):
            by_length.setdefault(0 if word in self.ranks else len(word), []).append(row)
        for length, rows in by_length.items():
            group = [words[row] for row in rows]
            if not length:
                ids, counts = np.array([self.ranks[w] for w in group], np.int64), np.ones(len(group), np.int64)
            elif length > MATRIX_BYTES:
                merged = [self._merge_long(w) for w in group]
                ids, counts = np.concatenate([np.array(x, np.int64) for x in merged]), np.array([len(x) for x in merged], np.int64)
            else:
                ids, counts = self._merge_matrix(self.of_byte[np.frombuffer(b"".join(group), np.uint8).reshape(-1, length)])
                ids = ids[ids >= 0]
            first, last = self.made, self.made + len(group)
            self.slot_start, self.slot_length = self._room(self.slot_start, last), self._room(self.slot_length, last)
            self.pool = self._room(self.pool, self.pooled + len(ids))
            self.slot_length[first:last] = counts
            self.slot_start[first:last] = self.pooled + np.cumsum(counts) - counts
            self.pool[self.pooled : self.pooled + len(ids)] = ids
            self.pooled += len(ids)
            self.made = last
            out[rows] = np.arange(first, last)
        return out

    def _slots_of(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Cache slot of every slice of ``data``."""
        raw = np.frombuffer(data, np.uint8)
        digest = slice_digests(raw, starts, ends)
        values, one, which = np.unique(digest, return_index=True, return_inverse=True)
        if len(self.known) + len(values) > CACHE_SLICES:
            self._forget()
        at = np.searchsorted(self.known, values)
        seen = np.zeros(len(values), bool)
        inside = at < len(self.known)
        seen[inside] = self.known[at[inside]] == values[inside]
        found = np.zeros(len(values), np.int64)
        found[seen] = self.known_slots[at[seen]]
        if not seen.all():
            new = one[~seen]
            found[~seen] = self._learn([data[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)])
            self.known = np.insert(self.known, at[~seen], values[~seen])
            self.known_slots = np.insert(self.known_slots, at[~seen], found[~seen])
        return found[which]

    def _encode_chunk(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        joined = "".join(texts)
        data = joined.encode("utf-8")
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(t) for t in texts])
        begins = np.concatenate([[0], ends[:-1]]).astype(np.intp)
        begin_at = begins[begins < len(points)]
        starts = token_starts(points, begin_at)
        width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        byte_at = np.concatenate([[0], np.cumsum(width)])
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        byte_starts = byte_at[starts]
        byte_ends = np.append(byte_starts[1:], len(data))
        slots = self._slots_of(data, byte_starts, byte_ends)
        ids = self._ids(slots)
        if self.decode(ids) != data:  # two slices met in one digest: take each by itself
            slots = self._one_by_one(data, byte_starts, byte_ends)
            ids = self._ids(slots)
        per_token = self.slot_length[slots]
        # tokens before each document's first character
        total = np.concatenate([[0], np.cumsum(per_token)])
        counts = np.diff(np.append(total[np.searchsorted(starts, begins)], total[-1]))
        return ids, byte_starts, counts

    def _one_by_one(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        words = [data[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        self._forget()
        slots = dict(zip(once := list(dict.fromkeys(words)), self._learn(once).tolist(), strict=True))
        return np.array([slots[w] for w in words], np.int64)

    def _ids(self, slots: np.ndarray) -> np.ndarray:
        count = self.slot_length[slots]
        shift = np.cumsum(count) - count
        return self.pool[np.arange(count.sum()) + np.repeat(self.slot_start[slots] - shift, count)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text (unsigned 32-bit)."""
        if self.literals is None:
            return self._encode_plain(texts)
        between, found = [], []
        for text in texts:
            at, ids = 0, []
            for literal in self.literals.finditer(text):
                between.append(text[at : literal.start()])
                ids.append(self.added[literal.group()])
                at = literal.end()
            between.append(text[at:])
            found.append(ids)
        parts = iter(self._encode_plain(between))
        out = []
        for ids in found:
            one = [next(parts)]
            for i in ids:
                one += [np.array([i], "<u4"), next(parts)]
            out.append(np.concatenate(one) if ids else one[0])
        return out

    def _encode_plain(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts without added tokens."""
        out: list[np.ndarray] = []
        for part in _chunks(texts):
            ids, _, counts = self._encode_chunk([piece for _, piece in part])
            cut = np.split(ids.astype("<u4"), np.cumsum(counts)[:-1])
            for (row, _), x in zip(part, cut, strict=True):
                if row < len(out):
                    out[row] = np.concatenate([out[row], x])
                else:
                    out.append(x)
        return out

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Byte offset of each id in the decoded text."""
        length = self.word_length[ids]
        return np.cumsum(length) - length

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids: one gather from the vocabulary's bytes."""
        ids = ids.astype(np.intp)
        length = self.word_length[ids]
        shift = np.cumsum(length) - length
        return self.word_bytes[np.arange(length.sum()) + np.repeat(self.word_start[ids] - shift, length)].tobytes()


def _pieces(text: str) -> list[str]:
    """A long text in pieces: cut before a space after an ASCII letter, where
    a token always starts."""
    out, begin, at = [], 0, CHUNK_CHARS
    while len(text) - begin > CHUNK_CHARS:
        at = text.find(" ", max(at, begin + CHUNK_CHARS))
        if at < 0:
            break
        if text[at - 1].isascii() and text[at - 1].isalpha():
            out.append(text[begin:at])
            begin = at
        at += 1
    return [*out, text[begin:]]


def _chunks(texts: list[str]) -> Iterator[list[tuple[int, str]]]:
    """(row, piece) in chunks of about CHUNK_CHARS."""
    part, size = [], 0
    for row, text in enumerate(texts):
        for piece in _pieces(text) if len(text) > CHUNK_CHARS else [text]:
            if part and size + len(piece) > CHUNK_CHARS:
                yield part
                part, size = [], 0
            part.append((row, piece))
            size += len(piece)
    if part:
        yield part


@lru_cache(4)
def load(path: str) -> ByteBpe:
    """The encoder of a vocabulary, one per worker process."""
    return ByteBpe(path)


def text_batches(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of a batch in parts of some CHUNK_CHARS."""
    texts = batch.column(column)
    first, size, part = 0, 0, []
    for row, text in enumerate(texts):
        part.append(text.as_py() or "")
        size += len(part[-1])
        if size >= CHUNK_CHARS:
            yield first, part
            first, size, part = row + 1, 0, []
    if part:
        yield first, part


def _with(df: DataFrame, **columns: T.DataType) -> tuple[list[str], T.StructType]:
    kept = [f for f in df.schema.fields if f.name.lower() not in {c.lower() for c in columns}]
    return [f.name for f in kept], T.StructType([*kept, *(T.StructField(c, t, False) for c, t in columns.items())])


def encode(df: DataFrame, ranks: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids`` (array of int) and ``offsets`` (array of long, the
    byte each id starts at in the text)."""
    kept, schema = _with(df, ids=T.ArrayType(T.IntegerType(), False), offsets=T.ArrayType(T.LongType(), False))
    kept = [c for c in kept if c != text] + [text] * (text in kept)
    schema = T.StructType([*(schema[c] for c in kept), schema["ids"], schema["offsets"]])

    def run(batches):
        bpe = load(ranks)
        for batch in batches:
            for first, part in text_batches(batch, text):
                ids = bpe.encode(part)
                rows = batch.slice(first, len(part))
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in kept), pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())), pa.array([bpe.offsets(x) for x in ids], pa.list_(pa.int64()))], [*kept, "ids", "offsets"])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, ranks: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded`` (binary): the bytes of the column ``ids``."""
    kept, schema = _with(df, decoded=T.BinaryType())

    def run(batches):
        bpe = load(ranks)
        for batch in batches:
            made = [bpe.decode(np.array(x.as_py() or [], np.int64)) for x in batch.column(ids)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(made, pa.binary())], [*kept, "decoded"])

    return df.mapInArrow(run, schema)


def round_trip_digests(df: DataFrame, ranks: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, number of ids, digest of the ids (little-endian
    unsigned 32-bit) and digest of the bytes decoded from them."""
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("n_tokens", T.LongType(), False), T.StructField("ids_sha256", T.StringType(), False), T.StructField("decoded_sha256", T.StringType(), False)])

    def run(batches):
        bpe = load(ranks)
        for batch in batches:
            for first, part in text_batches(batch, text):
                ids = bpe.encode(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(key).slice(first, len(part)),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids], pa.string()),
                        pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids], pa.string()),
                    ],
                    schema.fieldNames(),
                )

    return df.select(F.col(key), F.col(text)).mapInArrow(run, schema)


def op1_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """All documents encoded with the multilingual ranks and decoded again."""
    import public_tokenizers

    return round_trip_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
