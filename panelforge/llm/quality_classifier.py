"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its hashed features: words
(runs of characters other than ASCII white space) and character n-grams of 3 and
4 characters. A softmax layer over the average gives the class probabilities; vectors
and layer are trained together by numpy stochastic gradient descent.

Training uses a bounded sample of the labelled rows (``max_train_rows``, taken
by hash of the id; a model has a fixed number of parameters and gains little
from more rows), whose feature counts are computed by Spark tasks. Since the
layer is linear in the average, each bucket folds into one number for scoring,
so scoring a whole text is one table look-up per feature, map-only.

Defined cases: a null, empty or blank text has no features and gets the score
of the bias alone; without any labelled row every score is 0.5; null labels
are ignored; of repeated ids in the sample one text (the smallest) is learned. A
text over 1 MiB is viewed in windows that end at white space and see the first
characters of the next one, so its features are those of the whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_text import PIECE_BYTES, pieces, string_buffer, trimmed, word_hashes

#: Bytes after a window that its last n-grams may reach into: three characters of four bytes.
_TAIL = 12

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
NGRAMS = (3, 4)
MAX_TRAIN_ROWS = 3000
DIM = 8

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _ngram_buckets(raw: np.ndarray, chars: np.ndarray, n: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each character (given by its first byte)."""
    m = max(len(chars) - n + 1, 0)
    ends = np.r_[chars[n:], len(raw)][:m]
    return (word_hashes(raw, chars[:m], ends) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _words(raw: np.ndarray, offsets: np.ndarray):
    """(buckets, first byte of each) of the words of a piece."""
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = ~_SPACE[raw]
    starts, ends = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    cut = offsets[(offsets > 0) & (offsets < len(raw))]
    cut = cut[inside[cut] & inside[cut + 1]]
    starts[cut] = ends[cut] = True
    s, e = np.flatnonzero(starts), np.flatnonzero(ends)
    return (word_hashes(raw, s, e) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), s


def _runs(offsets: np.ndarray, raw: np.ndarray):
    """(first document, start, offsets, end with tail): runs of documents, or windows of a long one."""
    for i, j in pieces(offsets, PIECE_BYTES):
        lo, hi = int(offsets[i]), int(offsets[j])
        if hi - lo <= PIECE_BYTES:
            yield i, lo, offsets[i:j + 1] - lo, hi
            continue
        window = PIECE_BYTES
        while lo < hi:
            end = min(lo + window, hi)
            if end < hi:
                space = np.flatnonzero(_SPACE[raw[lo:end]])
                if not len(space):                        # a word longer than the window
                    window *= 2
                    continue
                end = lo + int(space[-1]) + 1
            yield i, lo, np.array([0, end - lo]), min(end + _TAIL, hi)
            lo, window = end, PIECE_BYTES


def _features(raw: np.ndarray, offsets: np.ndarray):
    """(first document, [(features, first, end)]) of each run: per kind of feature, those of each document."""
    for i, lo, off, hi in _runs(offsets, raw):
        part, size = raw[lo:hi], int(off[-1])
        words, at = _words(part[:size], off)
        kinds = [(words, np.searchsorted(at, off[:-1]), np.searchsorted(at, off[1:]))]
        chars = np.flatnonzero((part & 0xC0) != 0x80)
        a, b = np.searchsorted(chars, off[:-1]), np.searchsorted(chars, off[1:])
        last = b if len(part) == size else len(chars)     # an n-gram ends inside its document
        for k, n in enumerate(NGRAMS):
            grams = _ngram_buckets(part, chars, n) + BUCKETS * (k + 1)
            first = np.minimum(a, len(grams))
            kinds.append((grams, first, np.maximum(first, np.minimum(b, last - n + 1))))
        yield i, kinds


def feature_counts(col) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, counts) of each text."""
    raw, offsets = string_buffer(col)
    totals: list[dict] = [{} for _ in range(len(offsets) - 1)]
    for i, kinds in _features(raw, offsets):
        for d in range(len(kinds[0][1])):
            found = np.concatenate([f[a[d]:b[d]] for f, a, b in kinds])
            for f, c in zip(*np.unique(found, return_counts=True)):
                totals[i + d][f] = totals[i + d].get(f, 0) + c
    return [(np.fromiter(t.keys(), np.int32, len(t)), np.fromiter(t.values(), np.float32, len(t))) for t in totals]


@dataclass
class QualityModel:
    """One weight per feature bucket and a bias: the folded embeddings and softmax layer."""
    weights: np.ndarray
    bias: float

    def scores(self, col) -> np.ndarray:
        """Probability of label 1 of each text."""
        raw, offsets = string_buffer(col)
        total, count = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1)
        for i, kinds in _features(raw, offsets):
            docs = slice(i, i + len(kinds[0][1]))
            for features, a, b in kinds:
                sums = np.r_[0.0, np.cumsum(self.weights[features])]
                total[docs] += sums[b] - sums[a]
                count[docs] += b - a
        z = total / np.maximum(count, 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def sgd(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, *, dim: int = DIM, epochs: int = 10,
        rate: float = 1.0, seed: int = 7) -> QualityModel:
    """Train bucket vectors and the softmax layer, one document a step."""
    size = BUCKETS * (1 + len(NGRAMS))
    if len(rows) == 0:
        return QualityModel(np.zeros(size), 0.0)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (size, dim))
    layer, bias = np.zeros((2, dim)), np.zeros(2)
    shares = [c / c.sum() if len(c) else c for _, c in rows]
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            lr = rate * (1 - done / steps)
            done += 1
            f, w = rows[i][0], shares[i]
            h = w @ vectors[f] if len(f) else np.zeros(dim)
            z = layer @ h + bias
            p = np.exp(z - z.max())
            g = p / p.sum()
            g[labels[i]] -= 1
            back = layer.T @ g
            layer -= lr * np.outer(g, h)
            bias -= lr * 0.1 * g
            # the average spreads the gradient thinly: scaled up by the number of distinct features
            if len(f):
                vectors[f] -= (lr * min(len(f), 200)) * w[:, None] * back[None, :]
    return QualityModel(vectors @ (layer[1] - layer[0]), float(bias[1] - bias[0]))


def held_out(doc_id, modulus: int = 3, remainder: int = 1):
    """True for rows that are kept out of training, by the checksum of the id; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
          label: str = "quality", max_train_rows: int = MAX_TRAIN_ROWS, **settings) -> QualityModel:
    """Fit on a bounded sample of the labelled rows that are not held out."""
    known = (labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
             .where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id"))))
    sample = known.orderBy(F.xxhash64("id"), "id", "label").limit(max_train_rows)
    rows = (docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
            .join(F.broadcast(sample), "id")               # bounded by max_train_rows
            .groupBy("id").agg(F.min("text").alias("text"), F.min("label").alias("label")))

    def features(batches):
        for b in batches:
            found = feature_counts(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("label"), pa.array([f for f, _ in found], pa.list_(pa.int32())),
                 pa.array([c for _, c in found], pa.list_(pa.float32()))], ["id", "label", "f", "c"])

    id_type = rows.schema["id"].dataType.simpleString()
    got = rows.mapInArrow(trimmed(features), f"id {id_type}, label int, f array<int>, c array<float>").toArrow().sort_by("id")
    pairs = [(got["f"][i].values.to_numpy(), got["c"][i].values.to_numpy()) for i in range(got.num_rows)]
    return sgd(pairs, got["label"].to_numpy(), **settings)


def score(docs: DataFrame, model: QualityModel, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every row of docs."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    thin = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches):
        for b in batches:
            s = sent.value.scores(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                ["doc_id", "score", "predicted"])

    return thin.mapInArrow(trimmed(run), f"doc_id {thin.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def drop_rejected(docs: DataFrame, model: QualityModel, *, text: str = "text") -> DataFrame:
    """The documents, all columns, that the model does not reject."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches):
        for b in batches:
            yield b.filter(pa.array(sent.value.scores(b.column(b.schema.get_field_index(text))) >= 0.5))

    return docs.mapInArrow(trimmed(keep), docs.schema)
