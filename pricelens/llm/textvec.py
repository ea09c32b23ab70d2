"""Vectorised words and word-window hashes of an Arrow text column.

A batch of texts is one byte buffer with offsets.  Words are runs of "word
bytes" (a 256-entry table), found for the whole buffer at once; a word never
crosses a text.  Every word gets a 64-bit hash from prefix sums of a
polynomial in its bytes, computed segment by segment so that a very long text
needs no more memory than a short one; windows of k words get a hash of
their words' hashes in order.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE, _GAMMA = U(0x9E3779B97F4A7C15 | 1), U(0xD6E8FEB86659FD93)
_INV = U(pow(int(_BASE), -1, 1 << 64))
_SEGMENT = 1 << 20


def byte_table(excluded: list[tuple[int, int]]) -> np.ndarray:
    """256 booleans: False for the bytes in the given inclusive ranges."""
    ok = np.ones(256, dtype=bool)
    for lo, hi in excluded:
        ok[lo:hi + 1] = False
    return ok


#: Bytes of words that end at white space: all but 0x20 and 0x09-0x0D.
SPACED = byte_table([(0x20, 0x20), (0x09, 0x0D)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


@dataclass
class Words:
    """Words of a batch: byte spans, and ``first[d]:first[d + 1]`` are the
    words of text ``d``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a string column; NULL counts as empty."""
    arr = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    arr = arr.cast(pa.large_string()).fill_null("")
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]]
    return raw, offsets - offsets[0]


def find_words(texts: pa.Array, is_word: np.ndarray = SPACED, lower: bool = False) -> Words:
    data, offsets = buffer(texts)
    if lower:
        data = _LOWER[data]
    inside = np.zeros(len(data) + 1, dtype=bool)
    inside[:-1] = is_word[data]
    cut = np.zeros(len(data) + 1, dtype=bool)      # a text begins here
    cut[offsets] = True
    before = np.concatenate(([False], inside[:-1]))
    start = np.flatnonzero(inside & (~before | cut))
    end = np.flatnonzero(before & (~inside | cut))
    return Words(data, start, end, np.searchsorted(start, offsets))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> U(32))
    h = h * _GAMMA
    h = h ^ (h >> U(32))
    h = h * _GAMMA
    return h ^ (h >> U(32))


def word_hashes(w: Words, seed: int = 0) -> np.ndarray:
    """One 64-bit hash per word."""
    out = np.empty(len(w.start), dtype=np.uint64)
    base = U((int(_BASE) * (2 * seed + 1)) & (2**64 - 1))
    inv = U(pow(int(base), -1, 1 << 64))
    i = 0
    with np.errstate(over="ignore"):
        while i < len(w.start):
            lo = int(w.start[i])
            j = max(i + 1, int(np.searchsorted(w.end, lo + _SEGMENT, "right")))
            hi = int(w.end[j - 1])
            n = hi - lo
            step = np.full(n, base, dtype=np.uint64)
            step[0] = 1
            total = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum((w.data[lo:hi].astype(np.uint64) + U(1)) * np.cumprod(step),
                      out=total[1:])
            step[:] = inv
            step[0] = 1
            back = np.cumprod(step)
            s, e = w.start[i:j] - lo, w.end[i:j] - lo
            out[i:j] = mix((total[e] - total[s]) * back[s] + (e - s).astype(np.uint64))
            i = j
    return out


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position; positions whose window leaves
    the batch are cut off (those that cross a text are the caller's)."""
    if len(h) < k:
        return np.zeros(0, dtype=np.uint64)
    n = len(h) - k + 1
    with np.errstate(over="ignore"):
        out = np.zeros(n, dtype=np.uint64)
        for j in range(k):
            out *= _INV
            out += h[j:j + n]
        return mix(out + U(k))


def window_starts(first: np.ndarray, k: int) -> np.ndarray:
    """Positions at which a window of k words lies inside one text."""
    n = int(first[-1])
    if n < k:
        return np.zeros(0, dtype=np.int64)
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n)   # words to the text's end
    return np.flatnonzero(left >= k)


def ragged(values: np.ndarray, offsets: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """values[offsets[c]:offsets[c + 1]] for each c of codes, end to end."""
    size = (offsets[1:] - offsets[:-1])[codes]
    n = int(size.sum())
    if not n:
        return values[:0]
    ends = np.cumsum(size)
    step = np.ones(n, dtype=np.int64)
    keep = size > 0
    starts, ends, size = offsets[:-1][codes][keep], ends[keep], size[keep]
    step[0] = starts[0]
    step[ends[:-1]] = starts[1:] - (starts[:-1] + size[:-1] - 1)
    return values[np.cumsum(step)]


def spans(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """values[s:e] for each pair of start and end, end to end."""
    both = np.empty(2 * len(start), dtype=np.int64)
    both[0::2], both[1::2] = start, end
    return ragged(values, both, np.arange(0, 2 * len(start), 2))


def joined_words(w: Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of each text's kept words, joined by one space."""
    kept = np.flatnonzero(keep)
    start, end = w.start[kept], w.end[kept]
    out = spans(np.append(w.data, np.uint8(0x20)), start, end + 1)
    size = end - start + 1
    total = np.concatenate(([0], np.cumsum(size)))
    out[total[1:] - 1] = 0x20
    # the space after the last kept word of a text goes
    cut = np.searchsorted(kept, w.first)
    off = total[cut]
    some = off[1:] > off[:-1]
    keep_byte = np.ones(len(out), dtype=bool)
    keep_byte[off[1:][some] - 1] = False
    size_of = np.diff(off) - some
    return out[keep_byte], np.concatenate(([0], np.cumsum(size_of)))
