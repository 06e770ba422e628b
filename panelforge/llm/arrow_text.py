"""NumPy views of Arrow string columns: bounded pieces, words, rolling hashes.

Everything here runs inside Spark tasks on one Arrow batch. Texts are viewed
as UTF-8 bytes; work arrays are built for pieces of at most ``PIECE_BYTES``
so that memory does not depend on the length of a text.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20

_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_BASE = 0x100000001B3

#: True for bytes inside a word: ASCII letters and digits, and every byte of
#: a non-ASCII character.
WORD_BYTE = np.array([chr(i).isalnum() if i < 128 else True for i in range(256)])


def string_buffer(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as the empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def trimmed(work):
    """An Arrow function that gives the memory it has freed back to the system when its task ends.

    Workers are reused; else every later task and stage runs beside the largest batch of an earlier one.
    """
    def run(batches):
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)
    return run


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the hash base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = 1 << (n - 1).bit_length()
            inv = pow(_BASE, -1, 1 << 64)
            self.up = np.full(n, _BASE, np.uint64)
            self.down = np.full(n, inv, np.uint64)
            self.up[0] = self.down[0] = 1
            self.up, self.down = np.cumprod(self.up), np.cumprod(self.down)
        return self.up, self.down


_POWERS = _Powers()


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of raw[start:end] for every word, by one prefix sum."""
    up, down = _POWERS.get(len(raw) + 1)
    prefix = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=prefix[1:])
    return mix64((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _MULT)


def word_bounds(raw: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; a word never crosses a position in breaks."""
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = WORD_BYTE[raw]
    starts = inside[1:] & ~inside[:-1]
    ends = inside[:-1] & ~inside[1:]
    cut = breaks[(breaks > 0) & (breaks < len(raw))]
    cut = cut[inside[cut] & inside[cut + 1]]
    starts[cut] = ends[cut] = True
    return np.flatnonzero(starts), np.flatnonzero(ends)


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES):
    """Yield (first document, last document + 1) of runs of at most limit bytes.

    A text longer than the limit forms a run of its own.
    """
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def word_shingles(raw: np.ndarray, offsets: np.ndarray, k: int, limit: int = PIECE_BYTES):
    """Yield (document index, shingle hash) arrays that cover every document.

    A shingle is k consecutive words; a text of fewer words (but one at
    least) has one shingle of its whole word sequence. A long text is cut at
    word boundaries and consecutive cuts share k - 1 words, so each of its
    shingles is met once at least.
    """
    for i, j in pieces(offsets, limit):
        lo, hi = int(offsets[i]), int(offsets[j])
        if j - i > 1 or hi - lo <= limit:
            yield from _shingles_of(raw[lo:hi], offsets[i:j + 1] - lo, i, k, True)
            continue
        at, window = lo, limit
        while at < hi:
            end = min(at + window, hi)
            if end < hi:                                  # cut between words
                gaps = np.flatnonzero(~WORD_BYTE[raw[at:end]])
                end = at + (int(gaps[-1]) if len(gaps) else 0)
            part = raw[at:end]
            starts, _ = word_bounds(part, np.zeros(0, np.int64))
            if end < hi and len(starts) < k:              # words longer than the window
                window *= 2
                continue
            yield from _shingles_of(part, np.array([0, len(part)]), i, k, at == lo and end == hi)
            at = hi if end == hi else end if k == 1 else at + int(starts[1 - k])
            window = limit


def _shingles_of(raw, offsets, first_doc, k, whole):
    starts, ends = word_bounds(raw, offsets)
    if len(starts) == 0:
        return
    doc = np.searchsorted(offsets, starts, side="right") - 1
    h = word_hashes(raw, starts, ends)
    if len(h) >= k:
        full = doc[:len(doc) - k + 1] == doc[k - 1:]
        s = np.zeros(len(h) - k + 1, np.uint64)
        for t in range(k):
            s = mix64(s * _MULT + h[t:len(h) - k + 1 + t])
        yield doc[:len(s)][full] + first_doc, s[full]
    if whole:                                            # texts of fewer than k words
        firsts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        counts = np.diff(np.r_[firsts, len(doc)])
        few = counts < k
        if few.any():
            out = np.zeros(few.sum(), np.uint64)
            f, c = firsts[few], counts[few]
            for t in range(int(c.max())):
                on = c > t
                out[on] = mix64(out[on] * _MULT + h[f[on] + t])
            yield doc[f] + first_doc, mix64(out + c.astype(np.uint64))
