"""Benchmark decontamination: size-partitioned MinHash containment search.

Benchmark items are short and documents long, so the measure is containment:
the share of an item's distinct word shingles that a document holds.

* Items are partitioned by their number of distinct shingles (powers of two).
  A partition with largest size u keeps for each item a bottom-s MinHash
  sketch, its s smallest shingle hashes, with s = floor((1 - t) * u) + 1. A
  document that holds a share t of an item of that partition lacks fewer than
  s of its shingles, so it holds one sketch entry at least: the search over
  sketches loses no match at any document length.
* Every shingle of every whole document is looked up in the sketches; an item
  with a hit is a candidate and is verified by exact containment of the
  shingle texts, not of their hashes.
* Items are taken in blocks of bounded size; each block is one map-only pass
  over the documents, without a shuffle. Only a block of items (a stated
  query set) is ever sent to the tasks, never anything of the documents.

Words are runs of letters and digits of the lower-cased text (every non-ASCII
character counts as a letter). Defined cases: a null or empty text has no
words, matches nothing and is kept; an item of fewer words than a shingle is
one shingle of its own length and matches every document that holds its word
sequence; an item without words matches nothing; repeated rows of an item
count once, repeated documents are all reported; null ids are carried along.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_text import mix64, string_buffer, trimmed, word_shingles

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
#: Words of benchmark text in one block (about 40 MB of sketches and texts in a task).
BLOCK_WORDS = 400_000

_WORDS = re.compile(r"[0-9a-z\u0080-\U0010ffff]+")


def _lower(col):
    return pc.utf8_lower(pc.fill_null(col.cast(pa.string()), ""))


def shingle_texts(lowered: str, k: int) -> set[str]:
    words = _WORDS.findall(lowered)
    return {" ".join(words[i:i + k]) for i in range(len(words) - k + 1)}


def _needed(n: int, threshold: float) -> int:
    """Smallest number of an item's n shingles that reaches the threshold."""
    return max(1, math.ceil(threshold * n - 1e-9))


class ItemBlock:
    """Sketches and shingle texts of one block of benchmark items."""

    def __init__(self, ids: list, texts: list[str], k: int, threshold: float):
        self.k, self.threshold = k, threshold
        self.ids = ids
        lowered = _lower(pa.array(texts, pa.string()))
        words = [len(_WORDS.findall(t)) for t in lowered.to_pylist()]
        self.lengths = [min(k, max(1, n)) for n in words]   # words in a shingle of the item
        self.shingles = [shingle_texts(t, n) for t, n in zip(lowered.to_pylist(), self.lengths)]
        self.tables = {n: self._table(lowered, n) for n in sorted(set(self.lengths))}

    def _table(self, lowered, length: int):
        """(sketch entries in order, their items, filter on the top bits) of the items of one shingle length."""
        raw, offsets = string_buffer(lowered)
        found: list[list[np.ndarray]] = [[] for _ in self.ids]
        for doc, h in word_shingles(raw, offsets, length):
            for d in np.unique(doc):
                if self.lengths[d] == length:
                    found[d].append(h[doc == d])
        keys, owner = [], []
        for d, hs in enumerate(found):
            if hs:
                h = np.unique(np.concatenate(hs))
                keys.append(h[np.argsort(mix64(h))[:self.sketch_size(len(h))]])
                owner.append(np.full(len(keys[-1]), d, np.int64))
        keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
        order = np.argsort(keys, kind="stable")
        keys, owner = keys[order], owner[order]
        bits = np.zeros(1 << 20, bool)
        bits[(keys >> np.uint64(44)).astype(np.int64)] = True
        return keys, owner, bits

    def sketch_size(self, n: int) -> int:
        """Sketch length of the size partition of an item with n shingles."""
        upper = 1 << (n - 1).bit_length()
        return math.floor((1 - self.threshold) * upper + 1e-9) + 1

    def candidates(self, lowered) -> set[tuple[int, int]]:
        """(document index, item index) pairs that share a sketch entry."""
        out: set[tuple[int, int]] = set()
        raw, offsets = string_buffer(lowered)
        for length, (keys, owner, bits) in self.tables.items():
            if len(keys) == 0:
                continue
            for doc, h in word_shingles(raw, offsets, length):
                on = np.flatnonzero(bits[(h >> np.uint64(44)).astype(np.int64)])
                h, doc = h[on], doc[on]
                lo = np.searchsorted(keys, h, "left")
                hi = np.searchsorted(keys, h, "right")
                for i in np.flatnonzero(hi > lo):
                    out.update((int(doc[i]), int(o)) for o in owner[lo[i]:hi[i]])
        return out

    def matches(self, col) -> list[tuple[int, int, int, int]]:
        """(document index, item index, item shingles, shingles held), verified."""
        lowered = _lower(col)
        out, at, held = [], None, set()
        for d, o in sorted(self.candidates(lowered), key=lambda x: (x[0], self.lengths[x[1]], x[1])):
            if (d, self.lengths[o]) != at:
                at = d, self.lengths[o]
                held = shingle_texts(lowered[d].as_py(), self.lengths[o])
            n, shared = len(self.shingles[o]), len(self.shingles[o] & held)
            if shared >= _needed(n, self.threshold):
                out.append((d, o, n, shared))
        return out


def item_blocks(benchmark: DataFrame, *, item_id: str = "item_id", text: str = "text",
                shingle_words: int = SHINGLE_WORDS, threshold: float = CONTAINMENT,
                block_words: int = BLOCK_WORDS):
    """Yield the benchmark as blocks of about block_words words each."""
    items = (benchmark.select(F.col(item_id).alias("id"), F.col(text).alias("text"))
             .where(F.col("text").isNotNull()).distinct())
    words = items.agg(F.sum(F.length("text") / 5 + 1)).first()[0] or 0
    blocks = max(1, math.ceil(words / block_words))
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).collect()
        yield ItemBlock([r["id"] for r in rows], [r["text"] for r in rows], shingle_words, threshold)


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                       item_id: str = "item_id", item_text: str = "text", shingle_words: int = SHINGLE_WORDS,
                       threshold: float = CONTAINMENT, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Rows (doc_id, item_id, item_shingles, shared, containment) of all contained items."""
    spark = docs.sparkSession
    thin = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = benchmark.select(item_id).schema[0].dataType.simpleString()
    schema = (f"doc_id {thin.schema['doc_id'].dataType.simpleString()}, item_id {id_type}, "
              "item_shingles long, shared long, containment double")
    out = None
    for block in item_blocks(benchmark, item_id=item_id, text=item_text, shingle_words=shingle_words,
                             threshold=threshold, block_words=block_words):
        sent = spark.sparkContext.broadcast(block)

        def search(batches, sent=sent):
            block = sent.value
            names = ["doc_id", "item_id", "item_shingles", "shared", "containment"]
            for b in batches:
                if not (m := block.matches(b.column("text"))):
                    continue
                d, o, n, s = (list(x) for x in zip(*m))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(pa.array(d, pa.int64())),
                     pa.array([block.ids[i] for i in o]).cast(item_type(block.ids)), pa.array(n, pa.int64()),
                     pa.array(s, pa.int64()), pa.array([x / y for x, y in zip(s, n)], pa.float64())], names)

        found = thin.mapInArrow(trimmed(search), schema)
        out = found if out is None else out.unionByName(found)
    return out


def item_type(ids: list):
    """Arrow type of the item ids (whole numbers or text)."""
    return pa.string() if any(isinstance(x, str) for x in ids) else pa.int64()


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id",
                      item_text: str = "text", shingle_words: int = SHINGLE_WORDS,
                      threshold: float = CONTAINMENT, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents, all columns, that hold no benchmark item."""
    spark, kept = docs.sparkSession, docs
    for block in item_blocks(benchmark, item_id=item_id, text=item_text, shingle_words=shingle_words,
                             threshold=threshold, block_words=block_words):
        sent = spark.sparkContext.broadcast(block)

        def keep(batches, sent=sent):
            for b in batches:
                hit = np.zeros(b.num_rows, bool)
                hit[[m[0] for m in sent.value.matches(b.column(b.schema.get_field_index(text)))]] = True
                yield b.filter(pa.array(~hit))

        kept = kept.mapInArrow(trimmed(keep), docs.schema)
    return kept
