"""SimHash near-duplicates by the generalised pigeonhole principle.

Every whole text gets a 64-bit fingerprint: bit b is 1 if it is set in more
than half of the 64-bit hashes of the text's word shingles. Documents whose
fingerprints differ in at most ``max_distance`` bits are linked; a component
is a set of documents connected by links.

Search over the distinct fingerprints:

* Bits that are correlated over the corpus (exact co-occurrence counts of all
  fingerprints) are grouped into the same partition, so that the partitions
  are as independent as they can be.
* With m partitions and thresholds T_i with sum T_i = max_distance - m + 1,
  two fingerprints within max_distance differ in at most T_i bits in some
  partition i; T_i = -1 leaves a partition out. A dynamic programme chooses
  the thresholds of least cost, from the estimated candidate pairs of each
  partition (exact collision counts, carried to larger radii by the bits'
  disagreement rates) and the probes that a radius takes.
* Fingerprints are put under their partition values (and, for T_i > 0, under
  all values within T_i bits). Candidates under one value are verified by
  their distance; a value gives a spanning forest of its links, not all pairs.
* A value with more than ``group_limit`` fingerprints is split by a further
  pigeonhole over the bits that it leaves open, as often as needed. The value
  stays and is only extended, so fingerprints that share it by a flip stay
  together. The splitting ends at max_distance open bits: as the fingerprints
  are distinct, a value then has at most 2^max_distance for each flip, so no
  task holds an unbounded group.

Defined cases: A-Z is lower-cased, words are runs of bytes other than
space and \\t-\\r; a text of fewer words than a shingle has its whole sequence
as its shingle; a null, empty or blank text has fingerprint 0, linked like any
other. component_id is the smallest doc_id of the component; null ids are
ignored in it (a component of null ids only has a null component_id).
Repeated rows are each returned.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir, scratch_path
from .arrow_text import trimmed
from .components import components

BITS = 64
SHINGLE_WORDS = 3
MAX_DISTANCE = 2
GROUP_LIMIT = 2048
SEED = 42


def fingerprints_of(texts: list[bytes], k: int) -> np.ndarray:
    """Fingerprints (unsigned) of UTF-8 texts; works through long texts in runs of shingles."""
    from xxhash import xxh64_intdigest
    out = np.zeros(len(texts), np.uint64)
    run = 1 << 16
    for i, text in enumerate(texts):
        words = text.lower().split()
        if not words:
            continue
        if len(words) <= k:
            out[i] = xxh64_intdigest(b" ".join(words), SEED)
            continue
        n = len(words) - k + 1
        ones = np.zeros(BITS, np.int64)
        for at in range(0, n, run):
            part = words[at:at + run + k - 1]
            joined = map(b" ".join, zip(*(part[t:] for t in range(k))))
            h = np.fromiter((xxh64_intdigest(s, SEED) for s in joined), np.uint64, min(run, n - at))
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out[i] = np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0]
    return out


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp long, text_digest) for every row of docs."""
    thin = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.sha2(F.col(text), 256).alias("d"))

    def compute(batches):
        for b in batches:
            texts = b.column("text").cast(pa.binary()).fill_null(b"").to_pylist()
            fp = fingerprints_of(texts, shingle_words).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp), b.column("d")],
                                             ["doc_id", "fp", "text_digest"])

    return thin.mapInArrow(trimmed(compute), f"doc_id {thin.schema['doc_id'].dataType.simpleString()}, fp long, "
                                    "text_digest string")


# ---- partitions and thresholds -------------------------------------------

def _bit_statistics(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and the 64 x 64 counts of bits set together."""
    def partial(batches):
        total, n = np.zeros((BITS, BITS)), 0
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
            for at in range(0, len(fp), 1 << 14):
                bits = np.unpackbits(fp[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                bits = bits.astype(np.float64)
                total += bits.T @ bits
            n += len(fp)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(BITS + 1)), pa.array([*total.tolist(), [float(n)] + [0.0] * (BITS - 1)])],
                ["i", "row"])

    sums = [F.sum(F.element_at("row", j + 1)).alias(f"s{j}") for j in range(BITS)]
    rows = distinct.select("fp").mapInArrow(partial, "i long, row array<double>").groupBy("i").agg(*sums).collect()
    counts = np.zeros((BITS + 1, BITS))
    for r in rows:
        counts[r["i"]] = r[1:]
    return int(counts[BITS, 0]), counts[:BITS]


def group_bits(n: int, together: np.ndarray, parts: int) -> list[list[int]]:
    """Partitions of the bit positions, near-equal in size, correlated bits together."""
    p = np.diag(together) / max(n, 1)
    cov = together / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, groups = list(range(BITS)), []
    for g in range(parts):
        size = len(left) // (parts - g)
        seed = max(left, key=lambda b: (corr[b, left].sum(), -b))
        group = [seed]
        while len(group) < size:
            rest = [b for b in left if b not in group]
            group.append(max(rest, key=lambda b: (corr[b, group].mean(), -b)))
        groups.append(sorted(group))
        left = [b for b in left if b not in group]
    return groups


def allocate(costs: list[dict[int, float]], total: int) -> list[int]:
    """Thresholds (-1 or more) with the given sum and the least total cost."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for s, (c, chosen) in best.items():
            for t, x in cost.items():
                if s + t not in step or c + x < step[s + t][0]:
                    step[s + t] = (c + x, [*chosen, t])
        best = step
    return best[total][1]


def _mask(bits) -> int:
    return sum(1 << b for b in bits)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _under(masks: list[int]):
    """Array of (mask, value of the fingerprint under the mask)."""
    return F.array(*[F.struct(F.lit(_signed(m)).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("value"))
                     for m in masks])


def thresholds(distinct: DataFrame, n: int, together: np.ndarray, groups: list[list[int]],
               max_distance: int) -> list[int]:
    """Per-partition thresholds by dynamic programming on estimated candidates."""
    masks = [_mask(g) for g in groups]
    hits = (distinct.select(F.explode(_under(masks)).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("c"))
            .groupBy(F.col("k.mask").alias("mask")).agg(F.sum(F.col("c").cast("double") * F.col("c"))))
    exact = {r[0]: r[1] for r in hits.collect()}
    p = np.diag(together) / max(n, 1)
    differ = 2 * p * (1 - p)
    costs = []
    for g, m in zip(groups, masks):
        spread = np.zeros(max_distance + 2)               # P(so many bits of the partition differ)
        spread[0] = 1.0
        for d in differ[g]:
            spread[1:] = spread[1:] * (1 - d) + spread[:-1] * d
            spread[0] *= 1 - d
        cost = {-1: 0.0}
        probes = 1
        for t in range(max_distance + 1):
            if t:
                probes = probes * (len(g) - t + 1) // t
            pairs = exact.get(_signed(m), 0.0) * spread[:t + 1].sum() / max(spread[0], 1e-300)
            cost[t] = pairs + n * float(probes) + cost.get(t - 1, 0.0) * (t > 0)
        costs.append(cost)
    return allocate(costs, max_distance - len(groups) + 1)


# ---- probing and verification --------------------------------------------

def _flips(bits: list[int], t: int) -> list[int]:
    """All bit patterns of at most t bits of the partition."""
    return [_mask(c) for r in range(t + 1) for c in itertools.combinations(bits, r)]


def _split_mask(mask: int, parts: int) -> list[int]:
    """The mask extended by each of so many parts of its open bits."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    return [mask | _mask(free[i::parts]) for i in range(parts)]


def _extended(mask: int, finer: list[int]):
    """Array of (finer mask, value with the fingerprint's bits only where the finer mask adds them)."""
    return F.array(*[F.struct(F.lit(_signed(m)).alias("mask"), F.col("value").bitwiseOR(
        F.col("fp").bitwiseAND(F.lit(_signed(m & ~mask)))).alias("value")) for m in finer])


def spanning_links(fps: np.ndarray, max_distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct fingerprints."""
    links, left = [], fps
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            near = np.bitwise_count(left ^ at) <= max_distance
            found = left[near]
            links += [(int(x), int(at)) for x in found]
            frontier += list(found)
            left = left[~near]
    return links


def _verify(batches, max_distance: int):
    """Groups arrive sorted by (mask, value); a group may cross batches."""
    open_key, open_fps = None, []
    u, v = [], []

    def close():
        if open_fps:
            fps = np.unique(np.concatenate(open_fps)).view(np.uint64)
            for a, b in spanning_links(fps, max_distance):
                u.append(_signed(a))
                v.append(_signed(b))

    def flush():
        b = pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])
        u.clear()
        v.clear()
        return b

    for b in batches:
        mask, value, fp = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                           for c in ("mask", "value", "fp"))
        if len(fp) == 0:
            continue
        firsts = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])])
        for lo, hi in zip(firsts, [*firsts[1:], len(fp)]):
            key = (mask[lo], value[lo])
            if key != open_key:
                close()
                open_key, open_fps = key, []
            open_fps.append(fp[lo:hi])
        if len(u) > 10_000:
            yield flush()
    close()
    yield flush()


def links(distinct: DataFrame, *, max_distance: int = MAX_DISTANCE, partitions: int | None = None,
          group_limit: int = GROUP_LIMIT) -> DataFrame:
    """(u, v): spanning links among the distinct fingerprints ``fp`` of a stored table."""
    parts = partitions or max_distance + 1
    n, together = _bit_statistics(distinct)
    groups = group_bits(n, together, parts)
    chosen = thresholds(distinct, n, together, groups, max_distance)
    rows = None
    for g, t in zip(groups, chosen):
        if t < 0:
            continue
        m = F.lit(_signed(_mask(g)))
        flips = F.array(*[F.lit(_signed(x)) for x in _flips(g, t)])
        r = distinct.select(m.alias("mask"), F.explode(F.transform(flips, lambda x: F.col("fp").bitwiseXOR(x)
                                                                   .bitwiseAND(m))).alias("value"), "fp")
        rows = r if rows is None else rows.unionAll(r)
    out, masks = None, {_mask(g) for g, t in zip(groups, chosen) if t >= 0}
    while True:
        rows = rows.checkpoint()
        sizes = rows.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("c")).where("c > 1").checkpoint()
        # a mask with too few open bits for the pigeonhole is verified at any (bounded) size
        done = F.col("mask").isin([_signed(m) for m in masks if BITS - m.bit_count() <= max_distance])
        limit = F.when(done, F.lit(2 ** 62)).otherwise(F.lit(group_limit))
        small = (rows.join(sizes.where(F.col("c") <= limit).select("mask", "value"), ["mask", "value"], "left_semi")
                 .repartition("mask", "value").sortWithinPartitions("mask", "value")
                 .mapInArrow(lambda it: _verify(it, max_distance), "u long, v long"))
        out = small if out is None else out.unionAll(small)
        big = sizes.where(F.col("c") > limit).select("mask", "value")
        if big.isEmpty():
            return out
        # split the large groups by a pigeonhole over their open bits
        large = rows.join(big, ["mask", "value"], "left_semi")
        finer = None
        for m in sorted(masks):
            r = large.where(F.col("mask") == _signed(m)).select(
                "fp", F.explode(_extended(m, _split_mask(m, max_distance + 1))).alias("k"))
            finer = r if finer is None else finer.unionAll(r)
        rows = finer.select("k.mask", "k.value", "fp").distinct()
        masks = {x for m in masks for x in _split_mask(m, max_distance + 1)}


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE,
                    partitions: int | None = None, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """One row per document: doc_id, fp (long), text_digest, component_id."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    path = scratch_path(spark, "simhash")
    fingerprints(docs, doc_id=doc_id, text=text, shingle_words=shingle_words).write.parquet(path)
    prints = spark.read.parquet(path)
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least")).checkpoint()
    roots = components(links(distinct, max_distance=max_distance, partitions=partitions, group_limit=group_limit))
    placed = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    named = placed.join(placed.groupBy("root").agg(F.min("least").alias("component_id")), "root").select(
        "fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "text_digest", "component_id")


def fingerprint_hex(fp):
    """16 lower-case hexadecimal digits of a fingerprint column."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The row of smallest doc_id of each component (ties: smallest text digest), all columns.

    Rows that repeat both id and text stay once; a null id stays only in a
    component without other ids.
    """
    found = near_duplicates(docs, doc_id=doc_id, text=text, **settings)
    # components of null ids have no name of their own: their documents are told apart by fingerprint
    group = [F.col("component_id"), F.when(F.col("component_id").isNull(), F.col("fp"))]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_digest")).alias("f")
    kept = found.groupBy(*group).agg(first).select(F.col("f.doc_id").alias("_pf_id"),
                                                   F.col("f.text_digest").alias("_pf_digest"))
    names = docs.columns
    tagged = docs.withColumn("_pf_digest2", F.sha2(F.col(text), 256))
    same = F.col(doc_id).eqNullSafe(F.col("_pf_id")) & F.col("_pf_digest2").eqNullSafe(F.col("_pf_digest"))
    return (tagged.join(kept, same, "left_semi").dropDuplicates([doc_id, "_pf_digest2"]).select(*names))
