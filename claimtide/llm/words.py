"""Words of many texts as byte slices, their hashes, and a table of slices.

A batch of texts becomes one byte array of words, lower-cased (A-Z) and each
followed by one space, so a run of words is a slice, too.  ``SliceTable`` is an
open-addressed hash table in NumPy arrays: keys are the slices' xxhash64, and a
slot is a slice's own only after their bytes have been compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import xxhash

#: a word is a run of these: 0-9, a-z (A-Z lower-cased) and all beyond ASCII.
_SPACE = 0x20
_LOWERED = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else _SPACE for c in range(256))
#: slices up to this many bytes are hashed and compared in lanes of 8 bytes.
LANED = 256
#: bytes of text worked on at once.
CHUNK_BYTES = 3_000_000

# fixed values: the primes of xxhash64
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


class Words(NamedTuple):
    raw: np.ndarray  # bytes: each word and a space, and 8 bytes more
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # per text its first word; then the number of words

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and texts of all runs of ``n`` words of one text."""
        count = np.diff(self.first)
        text = np.repeat(np.arange(len(count)), np.maximum(count - n + 1, 0))
        at = np.flatnonzero(np.arange(len(self.starts)) + n <= np.repeat(self.first[1:], count))
        return self.starts[at], self.ends[at + n - 1], text


def words_of(texts: list[str]) -> Words:
    encoded = [t.encode() for t in texts]
    raw = np.frombuffer(b" ".join([*encoded, b""]).translate(_LOWERED), np.uint8)
    begins = np.cumsum([0, *(len(e) + 1 for e in encoded)])
    word = raw != _SPACE
    after = np.zeros(len(raw), bool)
    after[1:] = word[:-1] & ~word[1:]  # the space right after a word
    new = word.copy()
    new[1:] &= ~word[:-1]
    first = np.searchsorted(np.flatnonzero(new), begins)
    held = raw[word | after]
    ends = np.flatnonzero(held == _SPACE)
    starts = np.concatenate([[0], ends[:-1] + 1]).astype(np.intp) if len(ends) else ends
    return Words(np.concatenate([held, np.zeros(8, np.uint8)]), starts, ends, first)


def text_chunks(column) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of an Arrow column, some ``CHUNK_BYTES`` at once; a
    null is an empty text, a text is never cut."""
    first, part, size = 0, [], 0
    for row, text in enumerate(column):
        part.append(text.as_py() or "")
        size += len(part[-1])
        if size >= CHUNK_BYTES:
            yield first, part
            first, part, size = row + 1, [], 0
    if part:
        yield first, part


def _rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _round(x: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotated(x + lane * _P2, 31) * _P1


def _lanes(raw: np.ndarray, kind: str) -> np.ndarray:
    """The integer at every byte; ``raw`` ends with 8 bytes that no slice has."""
    width = np.dtype(kind).itemsize
    return np.ndarray(len(raw) - width + 1, kind, raw, strides=(1,))


def _hash_alike(raw: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    eight, four = _lanes(raw, "<u8"), _lanes(raw, "<u4")
    done = 0
    if length >= 32:
        state = [np.full(len(at), s) for s in (_P1 + _P2, _P2, np.uint64(0), np.uint64(0) - _P1)]
        while length - done >= 32:
            for k in range(4):
                state[k] = _round(state[k], eight[at + done + 8 * k])
            done += 32
        h = _rotated(state[0], 1) + _rotated(state[1], 7) + _rotated(state[2], 12) + _rotated(state[3], 18)
        for s in state:
            h = (h ^ _round(np.uint64(0), s)) * _P1 + _P4
    else:
        h = np.full(len(at), _P5)
    h = h + np.uint64(length)
    while length - done >= 8:
        h = _rotated(h ^ _round(np.uint64(0), eight[at + done]), 27) * _P1 + _P4
        done += 8
    if length - done >= 4:
        h = _rotated(h ^ (four[at + done].astype(np.uint64) * _P1), 23) * _P2 + _P3
        done += 4
    while done < length:
        h = _rotated(h ^ (raw[at + done].astype(np.uint64) * _P5), 11) * _P1
        done += 1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def xxhash64(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The xxhash64 (seed 0) of every ``raw[start:end]``."""
    out = np.empty(len(starts), np.uint64)
    length = ends - starts
    order = np.argsort(length, kind="stable")
    sizes, begins = np.unique(length[order], return_index=True)
    begins = [*begins.tolist(), len(order)]
    with np.errstate(over="ignore"):
        for size, a, b in zip(sizes.tolist(), begins, begins[1:]):
            rows = order[a:b]
            if size <= LANED:
                out[rows] = _hash_alike(raw, starts[rows], size)
            else:
                out[rows] = [xxhash.xxh64_intdigest(raw[k : k + size].tobytes()) for k in starts[rows].tolist()]
    return out


def same_bytes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, raw2: np.ndarray, starts2: np.ndarray, ends2: np.ndarray) -> np.ndarray:
    """Whether ``raw[start:end]`` and ``raw2[start2:end2]`` are the same bytes."""
    length = ends - starts
    same = length == ends2 - starts2
    one, two = _lanes(raw, "<u8"), _lanes(raw2, "<u8")
    left = np.flatnonzero(same & (length <= LANED))
    done = 0
    while len(left):
        rest = np.minimum(length[left] - done, 8)
        left, rest = left[rest > 0], rest[rest > 0]
        apart = (one[starts[left] + done] ^ two[starts2[left] + done]) << ((8 - rest) * 8).astype(np.uint64)
        same[left] = apart == 0
        left = left[apart == 0]
        done += 8
    for k in np.flatnonzero(same & (length > LANED)).tolist():
        same[k] = np.array_equal(raw[starts[k] : ends[k]], raw2[starts2[k] : ends2[k]])
    return same


class SliceTable:
    """Distinct slices of one byte array; linear probing, at most half full."""

    def __init__(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray | None = None):
        """``slot`` has the slot of every slice: equal slices share one."""
        self.raw = raw
        size = 1 << max(4, (2 * len(starts)).bit_length())
        self.owner = np.full(size, -1, np.int64)  # a slice of the slot
        self.starts, self.ends = starts, ends
        self.keys = xxhash64(raw, starts, ends) if keys is None else keys
        self.slot = (self.keys & np.uint64(size - 1)).astype(np.int64)
        left = np.arange(len(starts))
        while len(left):
            at = self.slot[left]
            free = self.owner[at] < 0
            self.owner[at[free]] = left[free]  # of those that meet, one stays
            met = self.owner[at]
            mine = self.keys[met] == self.keys[left]
            mine[mine] = same_bytes(raw, starts[left[mine]], ends[left[mine]], raw, starts[met[mine]], ends[met[mine]])
            left = left[~mine]
            self.slot[left] = (self.slot[left] + 1) & (size - 1)

    def filled(self) -> np.ndarray:
        """The slots in use."""
        return np.flatnonzero(self.owner >= 0)
