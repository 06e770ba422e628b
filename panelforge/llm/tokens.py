"""Token counts with a digest cache, and the encoders of the tokenizer files.

Counts are stored by (tokenizer digest, content digest). The tokenizer digest
covers the file, the library and its version; the content digest is SHA-256 of
the text's UTF-8 bytes (null is normalised to the empty text; nothing else may
be normalised, since a byte-level vocabulary tells all texts apart). A run
joins the documents' digests to the cache, encodes each distinct missing text
once, appends the new counts and joins them to the documents.

Only digests are shuffled for the joins; a missing text moves once, after
copies within a task have been dropped. A digest that a third of all documents
share is one row of the cache side, and the thin document side of the join is
split by the skew handling.

``Encoder`` cuts texts where the tokenizer provably never joins, encodes the
pieces with the library and remembers a bounded number of them, since most
pieces of a corpus repeat; a tokenizer of unknown structure encodes whole texts.
Where white space is dropped, cutting, looking up and putting together are
Arrow and NumPy passes over a slice; only new pieces meet Python objects.

Defined cases: null and empty texts have 0 bytes and 0 tokens; repeated rows
are each returned; ids may be null; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .arrow_text import pieces, string_buffer, trimmed

#: Remembered pieces of a process where pieces keep a leading space (about 200 bytes each).
MEMO_PIECES = 400_000
#: Memory of pieces of a process where white space is dropped (about 35 bytes each).
MEMO_BYTES = 32 << 20
#: Text that is cut and looked up at a time, by kind of tokenizer.
SLICE_BYTES = {"led": 3 << 20, "words": 8 << 20}
#: Plain words that the library encodes as one text.
JOINED = 2048

# A run of Latin letters up to an ASCII character that is neither a letter nor an apostrophe is a piece of its own for
# both kinds of tokenizer: only 's, 't, ... and combining marks join letters to what follows.
_RUN_END = r"(?=[\x00-\x26\x28-\x40\x5b-\x60\x7b-\x7f]|\Z)"
_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
_PIECES = re.compile(rf" ?[{_LATIN}]+{_RUN_END}|.+", re.S)
_LETTERS = rf"^[{_LATIN}]+$"
#: Kinds of bytes: letter 1, another ASCII character but the apostrophe 2, white space that is cut at 8, the rest 0.
_BYTE_KIND = np.array([8 if chr(i) in " \n\t\r" else i < 128 and i != 39 and 2 - chr(i).isalpha() for i in range(256)], np.uint8)
#: Where lower case may depend on context or make a special token, the tokenizer's own lower-casing is left alone.
_NO_PLAIN_LOWER = r"[^\x00-\x{ff}]|<\|"
#: A space after white space: such texts are not cut.
_NO_CUT = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "
LIMIT_TOKENS = 1024
#: Goes into the tokenizer digest: counts that another version of the encoder stored are not read.
ENCODER = "pieces-2"

_ENCODERS: dict[str, Encoder] = {}


class Encoder:
    """One tokenizer file with a bounded memory of pieces."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.memo: dict[str, bytes] = {}
        self.known = pa.array([], pa.large_string())       # remembered pieces, their ids one after the other, and
        self.flat, self.ends = np.zeros(0, "<u4"), np.zeros(1, np.int64)                   # where each one's ids end
        if path.endswith(".model"):
            import sentencepiece
            self.kind, self.lib = "pieces", sentencepiece.SentencePieceProcessor(model_file=path)
            return
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.kind = _segments_of(path)
        self.word_end = np.zeros(self.lib.get_vocab_size(), bool)
        self.word_end[[i for t, i in self.lib.get_vocab().items() if t.endswith("</w>")]] = True
        self.added = "(?i)" + ("|".join(re.escape(t.content) for t in self.lib.get_added_tokens_decoder().values()) or r"^\b\B")

    @classmethod
    def get(cls, path: str) -> Encoder:
        """The process's encoder of this file: workers are reused from task to task."""
        if path not in _ENCODERS:
            _ENCODERS[path] = cls(path)
        return _ENCODERS[path]

    def _encode(self, texts: list[str]) -> list[list[int]]:
        if self.kind == "pieces":
            return self.lib.encode(texts, num_threads=1)
        return [e.ids for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _cut(self, texts: pa.Array) -> pa.Array:
        """Lists of segments that this tokenizer never joins; each later segment keeps its leading space."""
        cut = pc.if_else(pc.match_substring_regex(texts, _NO_CUT), texts, pc.replace_substring(texts, " ", "\0 "))
        parts = pc.split_pattern(cut, "\0")
        own = pc.match_substring(texts, "\0")              # the mark of a cut stands in the text itself
        if pc.any(own).as_py():
            parts = pa.array([[t] if o else p for t, o, p in zip(texts.to_pylist(), own.to_pylist(), parts.to_pylist())],
                             parts.type)
        return parts

    def _look_up(self, segments: list[str]) -> list[bytes]:
        """Ids of distinct segments, each put together from remembered pieces."""
        if len(self.memo) > MEMO_PIECES:
            self.memo.clear()
        memo, find, new = self.memo, _PIECES.findall, set()
        out = list(map(memo.get, segments))
        unknown = [i for i, x in enumerate(out) if x is None]
        for i in unknown:
            new.update(find(segments[i]))
        learn = [x for x in new if x not in memo]
        for at in range(0, len(learn), 4096):
            part = learn[at:at + 4096]
            memo.update(zip(part, map(_packed, self._encode(part))))
        for i in unknown:
            cut = find(segments[i])
            out[i] = memo[cut[0]] if len(cut) == 1 else b"".join([memo[x] for x in cut])
        return out

    def _led(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """(ids, first and number of each distinct segment's ids, segments by number, segments before each text)."""
        cut = self._cut(texts)
        coded = cut.flatten().dictionary_encode()
        found = self._look_up(coded.dictionary.to_pylist())
        n = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return (np.frombuffer(b"".join(found), "<u4"), np.cumsum(n) - n, n, coded.indices.to_numpy(),
                np.r_[0, np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False))])

    def _cut_words(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Pieces that this tokenizer never joins, and the number of pieces before each text.

        White space is dropped. A Latin letter and an ASCII character that is neither a letter nor an apostrophe never
        stand in one match, whichever comes first, and neither composes with the one before it.
        """
        special = np.flatnonzero(pc.match_substring_regex(texts, self.added).to_numpy(zero_copy_only=False))
        texts = pc.if_else(pc.match_substring_regex(texts, _NO_PLAIN_LOWER), texts, pc.utf8_lower(texts))
        raw, offsets = string_buffer(texts)
        kind = _BYTE_KIND[raw]
        lead = np.flatnonzero(raw == 0xC3)                 # U+00C0 to U+00FF: letters but for two signs
        lead = lead[(raw[lead + 1] != 0x97) & (raw[lead + 1] != 0xB7)]
        kind[lead] = kind[lead + 1] = 1
        kept = kind != 8
        start = np.zeros(len(raw) + 1, bool)
        start[1:-1] = kind[:-1] + kind[1:] == 3            # a letter beside a character of kind 2
        for i in special:                                  # an added token may stand across
            start[offsets[i]:offsets[i + 1]] = False
        start[1:-1] |= ~kept[:-1] | ~kept[1:]
        start[offsets] = start[-1] = True
        first, last = np.flatnonzero(start[:-1] & kept), np.flatnonzero(start[1:] & kept)
        bounds = np.r_[0, np.cumsum(last + 1 - first)]
        return (pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(bounds), pa.py_buffer(raw[kept])),
                np.searchsorted(first, offsets))

    def _learn(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, number of ids, ids) of the pieces, in another order.

        Words of Latin letters go as one text and are told apart by their word ends.
        """
        letters = pc.match_substring_regex(new, _LETTERS).to_numpy(zero_copy_only=False)
        plain, other = np.flatnonzero(letters), [np.flatnonzero(~letters)]
        rows, n, ids = [], [], []
        for lo in range(0, len(plain), 16 * JOINED):
            group = plain[lo:lo + 16 * JOINED]
            bounds = np.r_[np.arange(0, len(group), JOINED), len(group)]
            texts = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), new.take(group).cast(pa.string()))
            for at, found in zip(bounds, self._encode(pc.binary_join(texts, " ").to_pylist())):
                part, found = group[at:at + JOINED], np.array(found, "<u4")
                ends = np.flatnonzero(self.word_end[found]) + 1
                if len(ends) != len(part) or ends[-1] != len(found):
                    other.append(part)
                    continue
                rows.append(part)
                n.append(np.diff(ends, prepend=0))
                ids.append(found)
        other = np.concatenate(other)
        for at in range(0, len(other), 4096):
            part = other[at:at + 4096]
            found = self._encode(new.take(part).to_pylist())
            rows.append(part)
            n.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter(chain.from_iterable(found), "<u4", n[-1].sum()))
        return np.concatenate(rows), np.concatenate(n), np.concatenate(ids)

    def _words(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """As ``_led``, for tokenizers that drop white space."""
        cut, before = self._cut_words(texts)
        coded = cut.dictionary_encode()
        distinct = coded.dictionary
        place = pc.index_in(distinct, value_set=self.known)
        if place.null_count:
            new, place = np.flatnonzero(place.is_null()), place.fill_null(-1).to_numpy().copy()
            if self.known.nbytes + self.flat.nbytes + self.ends.nbytes > MEMO_BYTES:
                held = place >= 0                          # what this slice does not hold is forgotten
                self._keep(place[held])
                place[held] = np.arange(len(self.known))
            learn = distinct.take(new)
            rows, n, ids = self._learn(learn)
            place[new[rows]] = len(self.known) + np.arange(len(rows))
            self.known = pa.concat_arrays([self.known, learn.take(rows)])
            self.flat = np.concatenate([self.flat, ids])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(n)])
        else:
            place = place.to_numpy()
        return self.flat, self.ends[place], np.diff(self.ends)[place], coded.indices.to_numpy(), before

    def _keep(self, some: np.ndarray) -> None:
        """Remember these pieces only."""
        first, n = self.ends[:-1][some], np.diff(self.ends)[some]
        self.known, self.ends = self.known.take(some), np.r_[0, np.cumsum(n)]
        self.flat = self.flat[np.repeat(first - self.ends[:-1], n) + np.arange(self.ends[-1])]

    def ids(self, texts: pa.Array):
        """Yield the ids (unsigned 32 bits) of each text, without added special tokens; null is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        sizes = np.r_[0, np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))]
        for i, j in pieces(sizes, SLICE_BYTES.get(self.kind, SLICE_BYTES["led"])):
            part = texts.slice(i, j - i)
            if self.kind not in SLICE_BYTES:
                yield from (np.array(x, "<u4") for x in self._encode(part.to_pylist()))
                continue
            flat, first, n, at, before = self._words(part) if self.kind == "words" else self._led(part)
            ends = np.r_[0, np.cumsum(n[at])]
            for lo in range(0, j - i, 256):                # documents put together at a time
                hi = min(lo + 256, j - i)
                a, b = before[lo], before[hi]
                take = np.repeat(first[at[a:b]] - ends[a:b], n[at[a:b]]) + np.arange(ends[a], ends[b])
                ids, bounds = flat[take], ends[before[lo:hi + 1]] - ends[a]
                yield from (ids[bounds[k]:bounds[k + 1]] for k in range(hi - lo))


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def _segments_of(path: str) -> str:
    """How a tokenizers file lets texts be cut: "led", "words" or "whole"."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    plain = spec["model"]["type"] == "BPE" and not any(
        re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
    if not plain or spec.get("post_processor"):
        return "whole"
    if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
        # every match of the built-in pattern is [space] + non-spaces, or spaces: none runs from a non-space into a space
        return "led"
    steps = pre.get("pretokenizers", [])
    drops = bool(steps) and steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" \
        and steps[0].get("invert") and (steps[0]["pattern"].get("Regex") or "").endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    harmless = norm is None or {n["type"] for n in norm.get("normalizers", [norm])} <= {"NFC", "Replace", "Lowercase"}
    return "words" if drops and harmless else "whole"


def tokenizer_digest(path: str) -> str:
    """Digest of the file, the library and its version, and the version of this encoder."""
    if path.endswith(".model"):
        import sentencepiece as lib
    else:
        import tokenizers as lib
    with open(path, "rb") as f:
        body = hashlib.sha256(f.read()).hexdigest()
    return hashlib.sha256(f"{ENCODER}:{lib.__name__}:{lib.__version__}:{body}".encode()).hexdigest()


_STORED = "content_digest string, n_bytes long, n_tokens long, tokenizer_digest string"


def read_cache(spark, cache_path: str, tokenizer: str) -> DataFrame:
    """One (content_digest, n_bytes, n_tokens) row per stored content of this tokenizer."""
    try:
        stored = spark.read.schema(_STORED).parquet(cache_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], _STORED)
    return (stored.where(F.col("tokenizer_digest") == tokenizer).groupBy("content_digest")
            .agg(F.max("n_bytes").alias("n_bytes"), F.max("n_tokens").alias("n_tokens")))


def count_tokens(docs: DataFrame, tokenizer_path: str, *, cache_path: str | None = None, doc_id: str = "doc_id",
                 text: str = "text", limit: int = LIMIT_TOKENS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row; new counts are appended to the cache."""
    spark = docs.sparkSession
    cache_path = cache_path or scratch_path(spark, "token-counts")
    version = tokenizer_digest(tokenizer_path)
    body = F.coalesce(F.col(text), F.lit(""))
    content = docs.select(F.col(doc_id).alias("doc_id"), body.alias("text"), F.sha2(body, 256).alias("content_digest"))
    known = read_cache(spark, cache_path, version).select("content_digest")
    missing = (content.select("content_digest", "text").dropDuplicates(["content_digest"])
               .join(known, "content_digest", "left_anti"))

    def encode(batches):
        encoder = Encoder.get(tokenizer_path)
        for b in batches:
            text = b.column("text")
            counts = [len(x) for x in encoder.ids(text)]
            yield pa.RecordBatch.from_arrays(
                [b.column("content_digest"), pc.binary_length(text).cast(pa.int64()), pa.array(counts, pa.int64())],
                ["content_digest", "n_bytes", "n_tokens"])

    (missing.mapInArrow(trimmed(encode), "content_digest string, n_bytes long, n_tokens long")
     .withColumn("tokenizer_digest", F.lit(version))
     .write.mode("append").partitionBy("tokenizer_digest").parquet(cache_path))
    counts = read_cache(spark, cache_path, version)
    return content.select("doc_id", "content_digest").join(counts, "content_digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
