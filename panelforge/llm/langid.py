"""Language identification by rank-order n-gram profiles.

A profile is the list of the ``PROFILE`` most frequent character n-grams (1 to
3 letters inside words, with a mark at word ends) in order of frequency. The
profile of a language comes from all its training texts, counted by Spark; the
profile of a document from its whole text. The out-of-place distance sums, over
the document's n-grams, how far each rank is from the language's rank (an
n-gram missing there counts as ``PROFILE``); the nearest language is predicted.

Counting is vectorised: letters are coded by their place in the alphabet of the
piece at hand, n-grams become whole numbers, and one sort counts the n-grams of
all documents of a piece.

Defined cases: a null text or one without a letter is ``und`` with score 0; so
is every text if no language was learned. Rows without text or language are
not learned from. Ties in frequency go by the n-gram's length, then its text, in
documents as in languages; ties in distance go by the language's name. Repeated
rows count and are returned each. A text longer than a piece is counted in
windows that end between words, so that no n-gram is cut.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrow_text import pieces

PROFILE = 300
#: Profiles are sent to every task: languages beyond this number are an error, not dropped.
MAX_LANGUAGES = 5000
UNKNOWN = "und"
PIECE_CHARS = 1 << 20

_LIMIT = 0x110000
_NONE = np.int64(0x1FFFFF)                                  # slot of a shorter n-gram


def _letters_table() -> np.ndarray:
    table = np.zeros(_LIMIT, bool)
    table[[i for i in range(_LIMIT) if chr(i).isalpha()]] = True
    return table


_LETTERS: list[np.ndarray] = []


def _code_points(texts: list[str]) -> np.ndarray:
    """Code points of all texts, one after the other; 0 for what is no letter."""
    if not _LETTERS:
        _LETTERS.append(_letters_table())
    cp = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    cp[~_LETTERS[0][cp]] = 0
    return cp


class _Piece:
    """N-grams of some documents, as whole numbers over the piece's own alphabet.

    Codes order n-grams by length, then letters; letter 0 is the mark of a word's end.
    """

    def __init__(self, cp: np.ndarray, sizes: np.ndarray):
        used = np.zeros(_LIMIT, bool)
        used[cp] = True
        used[0] = True
        self.alphabet = np.flatnonzero(used)
        self.place = np.zeros(_LIMIT, np.int64)
        self.place[self.alphabet] = np.arange(len(self.alphabet))
        # a mark before and after each document
        ends = np.cumsum(sizes + 1)
        line = np.zeros(int(ends[-1]) + 1 if len(ends) else 1, np.int64)
        doc = np.repeat(np.arange(len(sizes)), sizes + 1)
        spots = np.ones(len(line), bool)
        spots[np.r_[0, ends]] = False
        line[spots] = self.place[cp]
        self.doc = np.r_[0, doc] if len(doc) else np.zeros(1, np.int64)
        self.doc_of_gram = self.doc
        self.line = line
        self.size = len(self.alphabet)

    def grams(self):
        """(document, code) of every n-gram that has a letter and no mark in its middle."""
        x, a, doc = self.line, self.size, self.doc
        on = x > 0
        docs, codes = [doc[on]], [x[on]]
        on2 = (x[:-1] > 0) | (x[1:] > 0)
        right = np.where(x[1:] > 0, doc[1:], doc[:-1])       # of the letter in a pair
        docs.append(right[on2])
        codes.append((a + x[:-1] * a + x[1:])[on2])
        on3 = x[1:-1] > 0
        docs.append(doc[1:-1][on3])
        codes.append((a + a * a + (x[:-2] * a + x[1:-1]) * a + x[2:])[on3])
        return np.concatenate(docs), np.concatenate(codes)

    def span(self) -> int:
        return self.size + self.size ** 2 + self.size ** 3

    def slots(self, codes: np.ndarray) -> np.ndarray:
        """Code points of the n-grams, three columns, absent ones as _NONE."""
        a = self.size
        out = np.full((len(codes), 3), _NONE, np.int64)
        one, two = codes < a, (codes >= a) & (codes < a + a * a)
        three = codes >= a + a * a
        out[one, 0] = self.alphabet[codes[one]]
        c = codes[two] - a
        out[two, 0], out[two, 1] = self.alphabet[c // a], self.alphabet[c % a]
        c = codes[three] - a - a * a
        out[three, 0], out[three, 1], out[three, 2] = (self.alphabet[c // (a * a)], self.alphabet[c // a % a],
                                                       self.alphabet[c % a])
        return out

    def code(self, slots: np.ndarray) -> np.ndarray:
        """Codes of n-grams given by code points; -1 if a letter is not in the alphabet."""
        a = self.size
        there = (slots == _NONE) | (self.place[np.where(slots == _NONE, 0, slots)] > 0) | (slots == 0)
        p = self.place[np.where(slots == _NONE, 0, slots)]
        n = (slots != _NONE).sum(1)
        code = np.where(n == 1, p[:, 0], np.where(n == 2, a + p[:, 0] * a + p[:, 1],
                                                  a + a * a + (p[:, 0] * a + p[:, 1]) * a + p[:, 2]))
        return np.where(there.all(1), code, -1)


def _windows(text: str):
    """Code points of the windows of a long text: about PIECE_CHARS each, cut after a character that is no letter."""
    at, size = 0, PIECE_CHARS
    while at < len(text):
        end = min(at + size, len(text))
        cp = _code_points([text[at:end]])
        if end < len(text):
            gaps = np.flatnonzero(cp == 0)
            if len(gaps) == 0:                              # one word so far
                size *= 2
                continue
            cp = cp[:gaps[-1] + 1]
        yield cp
        at, size = at + len(cp), PIECE_CHARS


def _pieces(column):
    """Yield (first document, _Piece, documents, whether it is a window) over a column of lower-cased texts."""
    lowered = pc.utf8_lower(pc.fill_null(column.cast(pa.string()), ""))
    sizes = np.r_[0, np.cumsum(pc.utf8_length(lowered).to_numpy(zero_copy_only=False).astype(np.int64))]
    for i, j in pieces(sizes, PIECE_CHARS):
        texts = lowered.slice(i, j - i).to_pylist()
        if j - i > 1 or len(texts[0]) <= PIECE_CHARS:
            yield i, _Piece(_code_points(texts), np.diff(sizes[i:j + 1])), j - i, False
            continue
        for cp in _windows(texts[0]):
            yield i, _Piece(cp, np.array([len(cp)])), 1, True


def _counted(group: np.ndarray, codes: np.ndarray, span: int):
    """Distinct (group, code) with counts, in order."""
    key, n = np.unique(group * span + codes, return_counts=True)
    return key // span, key % span, n


def _text(slots: np.ndarray) -> list[str]:
    return ["".join("_" if c == 0 else chr(c) for c in row if c != _NONE) for row in slots.tolist()]


def learn(docs: DataFrame, *, text: str = "text", lang: str = "lang", profile: int = PROFILE) -> dict[str, list[str]]:
    """The n-gram profile of each language, from all rows of docs."""
    thin = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).alias("lang"))

    def count(batches):
        for b in batches:
            names = b.column("lang").dictionary_encode()
            langs, at = names.dictionary.to_pylist(), names.indices.to_numpy()
            parts = []                                      # (language, packed n-gram, count)
            for first, piece, n, _ in _pieces(b.column("text")):
                doc, codes = piece.grams()
                g, c, k = _counted(at[first + doc] if n else doc, codes, piece.span())
                s = piece.slots(c)
                parts.append((g, s[:, 0] << 42 | s[:, 1] << 21 | s[:, 2], k))
            if not parts:
                continue
            g, c, k = (np.concatenate(x) for x in zip(*parts))
            for i, name in enumerate(langs):
                grams, back = np.unique(c[g == i], return_inverse=True)
                sums = np.bincount(back, k[g == i], len(grams)).astype(np.int64)
                s = np.stack([grams >> 42, grams >> 21 & _NONE, grams & _NONE], 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(grams), pa.string()), pa.array(_text(s), pa.string()), pa.array(sums)],
                    ["lang", "gram", "n"])

    counts = thin.mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), F.char_length("gram"), "gram")
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= profile)
    rows = top.select("lang", "gram", "rank").limit(MAX_LANGUAGES * profile + 1).collect()
    if len(rows) > MAX_LANGUAGES * profile:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    out: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["rank"])):
        out.setdefault(r["lang"], []).append(r["gram"])
    return out


@dataclass
class Profiles:
    """Rank tables of all languages over the union of their n-grams."""
    langs: list[str]
    grams: np.ndarray                                       # code points, three columns
    ranks: np.ndarray                                       # per n-gram and language, one last row: missing
    size: int

    @classmethod
    def of(cls, profiles: dict[str, list[str]], size: int = PROFILE) -> Profiles:
        langs = sorted(profiles)
        grams = sorted({g for p in profiles.values() for g in p})
        at = {g: i for i, g in enumerate(grams)}
        ranks = np.full((len(grams) + 1, len(langs)), -1, np.int32)
        for j, name in enumerate(langs):
            for r, g in enumerate(profiles[name]):
                ranks[at[g], j] = r
        slots = [[0 if c == "_" else ord(c) for c in g] + [int(_NONE)] * (3 - len(g)) for g in grams]
        return cls(langs, np.array(slots, np.int64).reshape(-1, 3), ranks, size)

    def predict(self, column) -> tuple[list[str], np.ndarray]:
        """Language and score (1 - distance / largest distance) of each text."""
        names, score = [UNKNOWN] * len(column), np.zeros(len(column))
        held: list = []                                     # windows of one long text
        done = -1
        for first, piece, _, window in _pieces(column):
            doc, codes = piece.grams()
            d, c, k = _counted(doc, codes, piece.span())
            if window:
                if first != done and held:
                    self._long(held, done, names, score)
                    held = []
                done = first
                s = piece.slots(c)
                held.append((s[:, 0] << 42 | s[:, 1] << 21 | s[:, 2], k))
                continue
            if held:
                self._long(held, done, names, score)
                held = []
            self._rank(piece.code(self.grams), d, c, k, first, names, score)
        if held:
            self._long(held, done, names, score)
        return names, score

    def _long(self, held, doc, names, score):
        """A text that was counted in windows: codes are packed code points."""
        c, back = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
        k = np.bincount(back, np.concatenate([x for _, x in held]), len(c)).astype(np.int64)
        # by length of the n-gram, then letters, as in a piece
        length = (c & _NONE != _NONE).astype(np.int64) + (c >> 21 & _NONE != _NONE)
        order = np.lexsort((c, length))
        known = self.grams[:, 0] << 42 | self.grams[:, 1] << 21 | self.grams[:, 2]
        place = {x: i for i, x in enumerate(c[order].tolist())}
        codes = np.array([place.get(x, -1) for x in known.tolist()], np.int64)
        self._rank(codes, np.zeros(len(c), np.int64), np.arange(len(c)), k[order], doc, names, score)

    def _rank(self, known, d, c, k, first, names, score):
        if len(d) == 0 or not self.langs:
            return
        # the most frequent n-grams of each document, ties by code
        order = np.argsort((d << 40) - np.minimum(k, (1 << 39) - 1), kind="stable")
        d, c = d[order], c[order]
        starts = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
        rank = np.arange(len(d)) - np.repeat(starts, np.diff(np.r_[starts, len(d)]))
        on = rank < self.size
        d, c, rank = d[on], c[on], rank[on]
        by = np.argsort(known, kind="stable")
        sorted_known = known[by]
        if len(by):
            i = np.minimum(np.searchsorted(sorted_known, c), len(by) - 1)
            row = np.where(sorted_known[i] == c, by[i], len(by))
        else:
            row = np.zeros(len(c), np.int64)
        r = self.ranks[row]
        away = np.where(r < 0, self.size, np.abs(r - rank[:, None]))
        starts = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
        total = np.add.reduceat(away, starts, axis=0)
        size = np.diff(np.r_[starts, len(d)])
        best = total.argmin(1)
        for x, j, s in zip(d[starts], best, 1 - total[np.arange(len(best)), best] / (size * self.size)):
            names[first + x], score[first + x] = self.langs[j], s


def held_out(doc_id, modulus: int = 4, remainder: int = 2):
    """True for rows kept out of learning, by the checksum of the id; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(False))


def identify(docs: DataFrame, profiles: dict[str, list[str]], *, doc_id: str = "doc_id", text: str = "text",
             profile: int = PROFILE) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of docs."""
    sent = docs.sparkSession.sparkContext.broadcast(Profiles.of(profiles, profile))
    thin = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches):
        for b in batches:
            names, score = sent.value.predict(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(names, pa.string()), pa.array(score)],
                                             ["doc_id", "lang_pred", "score"])

    return thin.mapInArrow(run, f"doc_id {thin.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")
