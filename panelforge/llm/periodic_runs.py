"""Periodic runs of words: maximal pairs of the LCP-interval tree.

A run is a stretch of consecutive words with smallest period q and length of
at least max(min_length, 2q) that no neighbouring word extends. Its start i
and j = i + q are a maximal pair: the suffixes at i and j agree for
``length - q`` words and no further, and their left words differ. The other
way round a maximal pair (i, j) whose common prefix l satisfies j - i <= l and
j - i + l >= min_length is a run of length l + j - i; only multiples of a
smaller period share its start and end, and the smallest one is kept. So the
pairs are the runs and nothing is extended.

Both conditions need l >= ceil(min_length / 2) =: k, so only suffixes whose
first k words occur twice in their text enter the tree. Texts with such words are
ordered by prefix doubling, common prefixes come from the ranks of each
doubling, and each class of suffixes that share k words is a subtree. Its LCP
intervals are walked bottom-up with one position list per left word; lists of
different left words meet within the distance l only. A subtree whose left
words all agree, or whose positions lie farther apart than its longest common
prefix, holds no run and is not walked.

All work is map-only, in Arrow batches cut into pieces of bounded size; a
longer text is a piece of its own, with arrays in proportion to its words
times the logarithm of its longest repeat.

Defined cases: a null, empty or blank text has no words, no runs and the empty
collapsed text; repeated rows are each returned; ids may be null; an empty
table gives an empty result; columns other than the two named are left out.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_text import pieces, string_buffer

MIN_LENGTH = 12
#: Bytes of text in hand at a time (a longer text stands alone).
SLICE_BYTES = 4 << 20
#: White space between words: blank and U+0009 to U+000D.
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])

_RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def split_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(every word of the texts, first word of each text and the number of all)."""
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    inside = ~_SPACE[raw]
    after = np.r_[False, inside[:-1]] & ~edge[:-1]
    starts = np.flatnonzero(inside & ~after)
    sizes = np.diff(np.r_[np.cumsum(inside)[starts] - 1, inside.sum()]) if len(starts) else np.zeros(0, np.int64)
    ends = np.r_[0, np.cumsum(sizes)].astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(starts),
                                  [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(raw[inside]))])
    return words, np.searchsorted(starts, offsets)


def _codes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dense numbers of the pairs (a, b) in their order; both are non-negative and below 2**31."""
    return np.unique(a.astype(np.int64) << 31 | b, return_inverse=True)[1]


def _repeated(words: np.ndarray, last: np.ndarray, k: int) -> np.ndarray:
    """Positions whose k words may stand twice in their text: equal hashes in a table of counts, then equal hashes."""
    full = np.flatnonzero(np.arange(len(words)) + k <= last)
    if not len(full):
        return full
    h = last[full].astype(np.uint64)
    for t in range(k):
        h = (h ^ words[full + t].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    bits = max(10, int(len(full) * 8).bit_length())
    slot = (h >> np.uint64(64 - bits)).astype(np.int64)
    some = np.bincount(slot, minlength=1 << bits)[slot] > 1
    full, h = full[some], h[some]
    _, which, n = np.unique(h, return_inverse=True, return_counts=True)
    return full[n[which] > 1]


def _suffixes(words: np.ndarray, text: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, common prefix with the one before) by prefix doubling; texts never share a prefix."""
    n = len(words)
    code = _codes(text, words)
    order = np.argsort(code, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(code[order]) > 0])
    place = np.repeat(first, np.diff(np.r_[first, n]))    # by place in the order: the place of its class
    rank = np.empty(n, np.int32)
    rank[order] = place
    levels, h = [rank], 1
    while True:
        open_ = np.flatnonzero(np.bincount(place, minlength=n)[place] > 1)
        if not len(open_):
            break
        i = order[open_]
        far = i + h
        second = np.where(far < last[i], rank[np.minimum(far, n - 1)], np.int32(-1))
        by = np.lexsort((second, place[open_]))           # classes keep their places
        i, p, second = i[by], place[open_], second[by]
        new = np.r_[True, (p[1:] != p[:-1]) | (second[1:] != second[:-1])]
        order[open_] = i
        place[open_] = open_[np.flatnonzero(new)][np.cumsum(new) - 1]
        rank = rank.copy()
        rank[i] = place[open_]
        levels.append(rank)
        h *= 2
    # from the longest doubling down: equal ranks stand for 2**level equal words
    i, j = order[1:].copy(), order[:-1].copy()
    end_i, end_j = last[i], last[j]
    for level in range(len(levels) - 1, -1, -1):
        inside = np.flatnonzero((i < end_i) & (j < end_j))
        equal = inside[levels[level][i[inside]] == levels[level][j[inside]]]
        i[equal] += 1 << level
        j[equal] += 1 << level
    return order, np.r_[0, i - order[1:]]


class _Node:
    """An LCP interval: its positions in order, and those of each left word."""

    __slots__ = ("depth", "all", "by_left")

    def __init__(self, depth: int):
        self.depth, self.all, self.by_left = depth, [], {}


def _add(into: list[int], ps: list[int]) -> None:
    if len(ps) < 32:
        for p in ps:
            insort(into, p)
    else:
        into += ps
        into.sort()                                       # two sorted runs: one merge


def _meet(node: _Node, other: _Node, left, depth: int, min_length: int, found: list) -> _Node:
    """Join two children of an interval; pairs of different left words at most ``depth`` apart are maximal pairs."""
    big, small = (node, other) if len(node.all) >= len(other.all) else (other, node)
    for word, ps in small.by_left.items():
        own = big.by_left.get(word, ())
        for p in ps:
            lo, hi = bisect_left(big.all, p - depth), bisect_right(big.all, p + depth)
            if hi - lo == bisect_right(own, p + depth) - bisect_left(own, p - depth):
                continue
            if hi - lo <= len(big.by_left):
                partners = [q for q in big.all[lo:hi] if left[q] != word]
            else:
                partners = [q for w, qs in big.by_left.items() if w != word
                            for q in qs[bisect_left(qs, p - depth):bisect_right(qs, p + depth)]]
            for q in partners:
                period = abs(p - q)
                if period + depth >= min_length:
                    found.append((min(p, q), period + depth, period))
    for word, ps in small.by_left.items():
        _add(big.by_left.setdefault(word, []), ps)
    _add(big.all, small.all)
    return big


def _pairs(at: list[int], lcp: list[int], left, min_length: int) -> list[tuple[int, int, int]]:
    """Maximal pairs of one subtree as (start, length, period)."""
    found: list[tuple[int, int, int]] = []

    def leaf(p: int) -> _Node:
        out = _Node(1 << 62)
        out.all, out.by_left = [p], {left[p]: [p]}
        return out

    stack: list[tuple[int, _Node]] = []                   # (depth of the interval, positions below it so far)
    below = leaf(at[0])
    for p, depth in [*zip(at[1:], lcp[1:]), (None, 0)]:
        while stack and stack[-1][0] > depth:
            d, node = stack.pop()
            below = _meet(node, below, left, d, min_length, found)
        if p is None:
            break
        if stack and stack[-1][0] == depth:
            below = _meet(stack.pop()[1], below, left, depth, min_length, found)
        stack.append((depth, below))
        below = leaf(p)
    return found


def word_runs(words: np.ndarray, bounds: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows (text, start, length, period) by text, start and period.

    ``words`` are non-negative word numbers of all texts, text t has those
    from bounds[t] to bounds[t + 1].
    """
    none = np.zeros((0, 4), np.int64)
    k = (min_length + 1) // 2
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    last = bounds[1:][text]
    seeds = _repeated(words, last, k)
    if not len(seeds):
        return none
    some = np.zeros(len(bounds) - 1, bool)
    some[text[seeds]] = True
    here = np.flatnonzero(some[text])                     # words of texts that repeat k words
    moved = np.cumsum(some[text])
    at, lcp = _suffixes(words[here], text[here], moved[last[here] - 1])
    at = here[at]
    # subtrees of suffixes that share k words
    begins = lcp < k
    inner = ~begins
    in_tree = inner | np.r_[inner[1:], False]
    at, lcp = at[in_tree], np.where(begins, 0, lcp)[in_tree]
    if not len(at):
        return none
    left = np.where(at > bounds[:-1][text[at]], words[at - 1], -1)
    first = np.flatnonzero(lcp == 0)
    group = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(at)]))
    mixed = np.minimum.reduceat(left, first) != np.maximum.reduceat(left, first)
    order = np.lexsort((at, group))
    gap = np.r_[0, np.diff(at[order])]
    gap[first] = np.iinfo(np.int64).max
    close = np.minimum.reduceat(gap, first) <= np.maximum.reduceat(lcp, first)
    left_of = dict(zip(at.tolist(), left.tolist()))
    ends = np.r_[first, len(at)]
    found: list[tuple[int, int, int]] = []
    for g in np.flatnonzero(mixed & close):
        a, b = ends[g], ends[g + 1]
        found += _pairs(at[a:b].tolist(), lcp[a:b].tolist(), left_of, min_length)
    if not found:
        return none
    start, length, period = np.array(found, np.int64).T
    order = np.lexsort((period, length, start))           # multiples of a period share start and end
    start, length, period = start[order], length[order], period[order]
    keep = np.r_[True, (start[1:] != start[:-1]) | (length[1:] != length[:-1])]
    start, length, period = start[keep], length[keep], period[keep]
    order = np.lexsort((period, start))
    t = text[start[order]]
    return np.stack([t, start[order] - bounds[t], length[order], period[order]], axis=1)


def _dropped(runs: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Words that a run contains after its first period."""
    change = np.zeros(bounds[-1] + 1, np.int64)
    first = bounds[runs[:, 0]] + runs[:, 1]
    np.add.at(change, first + runs[:, 3], 1)
    np.add.at(change, first + runs[:, 2], -1)
    return np.cumsum(change[:-1]) > 0


def _of_slice(text: pa.Array, min_length: int) -> tuple[list, ...]:
    raw, offsets = string_buffer(text)
    words, bounds = split_words(raw, offsets)
    ids = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    runs = word_runs(ids, bounds, min_length)
    kept = ~_dropped(runs, bounds)
    if not kept.all():
        words = words.filter(pa.array(kept))
    kept_bounds = np.r_[0, np.cumsum(kept)][bounds].astype(np.int32)
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept_bounds), words), " ")
    cells = pa.StructArray.from_arrays([pa.array(runs[:, c]) for c in (1, 2, 3)], ["start", "length", "period"])
    counts = np.searchsorted(runs[:, 0], np.arange(len(text) + 1)).astype(np.int32)
    return (pa.array(np.diff(bounds)), pa.ListArray.from_arrays(pa.array(counts), cells), texts)


def find_runs(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
              min_length: int = MIN_LENGTH, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row.

    ``runs`` holds (start, length, period) by start, then period; ``collapsed``
    is the text's words, joined by one space, without those that a run
    contains after its first period.
    """
    if min_length < 2:
        raise ValueError("min_length must be 2 at least")
    kind = docs.schema[doc_id].dataType.simpleString()

    def work(batches):
        for b in batches:
            body = pc.fill_null(b.column("text").cast(pa.large_string()), "")
            sizes = np.r_[0, np.cumsum(pc.binary_length(body).to_numpy(zero_copy_only=False))]
            for i, j in pieces(sizes, slice_bytes):
                n, runs, collapsed = _of_slice(body.slice(i, j - i), min_length)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), n, runs, collapsed],
                                                 ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        work, f"doc_id {kind}, n_words bigint, runs {_RUNS}, collapsed string")
