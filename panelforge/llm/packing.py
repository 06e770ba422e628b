"""Best-fit packing of documents into token sequences, with certified bounds.

Documents are tokenised once into pieces of at most ``capacity`` tokens (only
longer documents are cut) and the piece table is written to the shared folder.
Pieces are dealt by hash into partitions of bounded size; each partition is
packed by best-fit decreasing and certified by dual feasible functions: for
such a function f, the sum of f(length) over any feasible sequence is at most
1, so the total over a partition, rounded up, is a lower bound of its number
of sequences.

The functions are sums over pieces, so the bound of the whole table comes from
the histogram of lengths (at most ``capacity`` rows). While more sequences are
used than the bound of the whole asks for, partitions with gaps (more
sequences than their own bound, or, when none has, all partitions with room
left) exchange the documents of their sequences with free room and rerun
best-fit decreasing. After a round of all partitions that saves nothing, fewer
and larger partitions are dealt, up to ``WIDEST`` times the size; one that
saves nothing then ends the search. Only sequences without much free room are
settled, so later rounds are small and every other sequence takes part.

Defined cases: a null or empty text is the end id alone (length 1); repeated
rows and null ids are packed like any other, each row by itself; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir, scratch_path
from .arrow_text import trimmed
from .tokens import Encoder

CAPACITY = 2048
END_ID = 0
PARTITION_PIECES = 4096
#: Sequences with at least this share of free room take part in an exchange.
ROOM = 1 / 64
MAX_ROUNDS = 24
#: How many times ``PARTITION_PIECES`` a partition of the last exchanges holds at most.
WIDEST = 16


def pieces_of(docs: DataFrame, tokenizer_path: str, *, doc_id: str = "doc_id", text: str = "text",
              capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of all documents."""
    thin = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    end = end_id.to_bytes(4, "little")

    def cut(batches):
        encoder = Encoder.get(tokenizer_path)
        for b in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(encoder.ids(b.column("text"))):
                body = ids.tobytes() + end
                for k, a in enumerate(range(0, len(body), 4 * capacity)):
                    part = body[a:a + 4 * capacity]
                    row.append(i)
                    piece.append(k)
                    start.append(a // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return thin.mapInArrow(trimmed(cut), f"doc_id {thin.schema['doc_id'].dataType.simpleString()}, piece int, start long, "
                                "length long, ids_crc32 long")


def lower_bound(histogram: dict[int, int] | np.ndarray, capacity: int) -> int:
    """Least number of sequences that the dual feasible functions allow.

    Families: u_k (k = 1..32), which rounds (k+1)x/c to a multiple of 1/k
    unless it is whole, and the threshold functions that count pieces over
    c - t as whole, pieces under t as nothing and the rest by length. All
    arithmetic is in whole numbers.
    """
    counts = np.zeros(capacity + 1, np.int64)
    if isinstance(histogram, dict):
        for x, n in histogram.items():
            counts[x] = n
    else:
        counts[:len(histogram)] = histogram
    x = np.arange(capacity + 1)
    best = -(-int(counts @ x) // capacity)
    for k in range(1, 33):
        whole = (k + 1) * x % capacity == 0
        scaled = np.where(whole, x * k, (k + 1) * x // capacity * capacity)       # u_k(x) * k * capacity
        best = max(best, -(-int(counts @ scaled) // (k * capacity)))
    prefix_n, prefix_x = np.cumsum(counts), np.cumsum(counts * x)
    t = np.arange(1, capacity // 2 + 1)
    large = prefix_n[-1] - prefix_n[capacity - t]                                # x > c - t
    middle = prefix_x[capacity - t] - prefix_x[t - 1]                            # t <= x <= c - t
    return max(best, int((large + -(-middle // capacity)).max()))


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Sequence number of each piece; ties keep their order."""
    place = np.zeros(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, used = 0, 0                                     # bit r of rooms: some sequence has room r left
    for i in np.argsort(-lengths, kind="stable"):
        x = int(lengths[i])
        fit = rooms >> x
        if fit:
            room = x + (fit & -fit).bit_length() - 1
            seq = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, seq, used = capacity, used, used + 1
        place[i] = seq
        by_room[room - x].append(seq)
        rooms |= 1 << (room - x)
    return place


def _pack(table: pa.Table, capacity: int) -> pa.Table:
    """One partition: sequences are named by their smallest uid."""
    table = table.sort_by([("length", "descending"), ("uid", "ascending")])
    uid, length = table["uid"].to_numpy(), table["length"].to_numpy()
    place = best_fit_decreasing(length, capacity)
    n = int(place.max()) + 1
    name = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(name, place, uid)
    order = np.argsort(place, kind="stable")
    ends = np.cumsum(length[order])
    firsts = np.flatnonzero(np.r_[True, np.diff(place[order]) != 0])
    before = np.zeros(len(uid), np.int64)
    before[order] = ends - length[order] - np.repeat((ends - length[order])[firsts], np.diff(np.r_[firsts, len(uid)]))
    fill = np.bincount(place, length, n).astype(np.int64)
    bound = lower_bound(np.bincount(length, minlength=capacity + 1), capacity)
    size = len(uid)
    return pa.table({"uid": uid, "length": length, "sequence_id": name[place], "offset": before, "fill": fill[place],
                     "part": table["part"], "used": pa.array([n] * size, pa.int64()),
                     "bound": pa.array([bound] * size, pa.int64())})


_PACKED = "uid long, length long, sequence_id long, offset long, fill long, part long, used long, bound long"


def _packed(items: DataFrame, parts: int, round_: int, capacity: int) -> DataFrame:
    dealt = items.select("uid", "length", F.pmod(F.xxhash64("uid", F.lit(round_)), F.lit(parts)).alias("part"))
    return dealt.groupBy("part").applyInArrow(lambda t: _pack(t, capacity), _PACKED).checkpoint()


def pack(docs: DataFrame, tokenizer_path: str, *, doc_id: str = "doc_id", text: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID, partition_pieces: int = PARTITION_PIECES,
         room: float = ROOM, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """Pieces with their sequence_id and offset."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    path = scratch_path(spark, "pieces")
    (pieces_of(docs, tokenizer_path, doc_id=doc_id, text=text, capacity=capacity, end_id=end_id)
     .withColumn("uid", F.monotonically_increasing_id()).write.parquet(path))
    table = spark.read.parquet(path)
    histogram = {r["length"]: r["n"] for r in                # at most `capacity` rows
                 table.where(F.col("length") < capacity).groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    bound, n = lower_bound(histogram, capacity), sum(histogram.values())
    final = table.where(F.col("length") == capacity).select("uid", F.col("uid").alias("sequence_id"),
                                                            F.lit(0).cast("long").alias("offset"))
    if not n:
        return _placed(table, final)
    now = _packed(table.where(F.col("length") < capacity), math.ceil(n / partition_pieces), 0, capacity)
    settled, wide, widest = 0, False, 1                                 # sequences in `final` short of capacity
    full = F.col("fill") > capacity * (1 - room)
    for round_ in range(1, max_rounds + 1):
        starts = F.col("offset") == 0                        # one such piece per sequence
        used, gaps = now.agg(F.sum(starts.cast("long")),
                             F.sum((starts & (F.col("used") > F.col("bound"))).cast("long"))).first()
        if settled + used <= bound:
            break                                            # certified: no packing uses fewer
        wide = wide or not gaps
        opened = ~full if wide else ~full & (F.col("used") > F.col("bound"))
        count, going = now.where(opened).agg(F.count(F.lit(1)), F.sum(starts.cast("long"))).first()
        parts = math.ceil(count / (partition_pieces * widest))
        if count:
            tried = _packed(now.where(opened), parts, round_, capacity)
            saved = going - tried.where(starts).count()
        if not count or saved <= 0:
            if wide and (parts <= 1 or widest >= WIDEST):
                break
            widest *= 2 if wide else 1
            wide = True
            continue
        final = final.unionAll(now.where(full).select("uid", "sequence_id", "offset"))
        settled += now.where(full & starts).count()
        now, wide = tried.unionAll(now.where(~full & ~opened)), False
    return _placed(table, final.unionAll(now.select("uid", "sequence_id", "offset")))


def _placed(table: DataFrame, places: DataFrame) -> DataFrame:
    return table.join(places, "uid").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
