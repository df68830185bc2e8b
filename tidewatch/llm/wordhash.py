"""Vectorised hashing of the words of an Arrow string column.

A word is a maximal run of bytes other than space and tab to carriage return; no byte of a
multi-byte UTF-8 character is one of those, so bytes and characters give the same words.
Words of a whole chunk of texts are hashed at once: with prefix sums S of table[byte] * P**i
(all modulo 2**64), the word on [s, e) has the value (S[e] - S[s]) * P**-s, then a mixer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 20
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
MARK, LETTER = np.zeros(256, bool), np.zeros(256, bool)
MARK[list(b".,:;!?")] = True
LETTER[65:91] = LETTER[97:123] = True
_rng = np.random.default_rng(20240501)
PLAIN = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = PLAIN.copy()
LOWER[65:91] = PLAIN[97:123]
COEFFS = _rng.integers(1, 1 << 63, 1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        with np.errstate(over="ignore"):
            steps = np.full(max(n, CHUNK + 4096), np.uint64(base), np.uint64)
            steps[0] = 1
            have = np.multiply.accumulate(steps)
        if len(have) <= 4 * CHUNK:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def string_buffers(arr) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string array; a null is an empty text."""
    import pyarrow as pa

    if hasattr(arr, "combine_chunks"):
        arr = arr.combine_chunks()
    if pa.types.is_large_string(arr.type):
        kind = np.int64
    else:
        arr, kind = arr.cast(pa.string()), np.int32
    if arr.null_count:
        arr = arr.fill_null("")
    n = len(arr)
    bufs = arr.buffers()
    if n == 0 or bufs[1] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offs = np.frombuffer(bufs[1], kind)[arr.offset : arr.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def chunks(offs: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about CHUNK bytes; one longer text is a range of its own."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + CHUNK, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(data: np.ndarray, offs: np.ndarray, table: np.ndarray = LOWER, stops: bool = False):
    """(hashes of all words in order, first word of each text with the end, starts, ends).

    With ``stops`` a word also ends between an ASCII letter and one of the marks . , : ; ! ?
    """
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(len(offs), np.int64), z, z
    gap = SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = gap[:-1]
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = gap[1:]
    if stops:
        cut = MARK[data[1:]] & LETTER[data[:-1]]
        before[1:] |= cut
        after[:-1] |= cut
    starts = np.flatnonzero(~gap & (before | edge[:n]))
    ends = np.flatnonzero(~gap & (after | edge[1:])) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(table[data] * _power(_P, n), out=sums[1:])
    h = mix((sums[ends] - sums[starts]) * _power(_P_INV, n)[starts])
    return h, np.searchsorted(starts, offs), starts, ends


def grams(h: np.ndarray, first: np.ndarray, n: int):
    """(hashes of n-word windows, first window of each text with the end).

    A text with fewer than n words, but at least one, has its whole sequence as its only window.
    """
    counts = np.diff(first)
    full = np.maximum(counts - n + 1, 0)
    short = (counts > 0) & (counts < n)
    out_counts = full + short
    where = np.zeros(len(first), np.int64)
    np.cumsum(out_counts, out=where[1:])
    out = np.zeros(where[-1], np.uint64)
    if len(h) >= n:
        acc = np.zeros(len(h) - n + 1, np.uint64)
        for k in range(n):
            acc += h[k : k + len(acc)] * COEFFS[k]
        # windows that stay inside their text
        text = np.repeat(np.arange(len(counts)), full)
        pos = np.arange(len(text)) - np.repeat(np.cumsum(full) - full, full)
        out[where[:-1][text] + pos] = mix(acc[first[:-1][text] + pos])
    for t in np.flatnonzero(short):
        seq = h[first[t] : first[t + 1]]
        whole = (seq * COEFFS[: len(seq)]).sum(keepdims=True) + COEFFS[900 + len(seq) % 100]
        out[where[t]] = mix(whole)[0]
    return out, where
