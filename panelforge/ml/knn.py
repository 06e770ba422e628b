"""Exact k-nearest-neighbour regression (M12), Euclidean, uniform weights.

Blocked: training rows and query rows are packed into blocks of bounded size
(one row of arrays per block), every query block meets every training block
through a join on the training block's number, and each pair of blocks yields
the nearest rows of its own (NumPy on Arrow batches). The nearest rows of a
query over all blocks are merged by grouped aggregates of at most ``FAN_IN``
lists each, level by level. That is exact: the global nearest rows are among
the nearest of every block. Short vectors are cut into blocks by the quantiles
of their entries, and a query block meets only the training blocks whose box is
no farther than the largest distance to a block that holds enough rows, so the
work of a query does not grow with the number of training rows; these blocks
come to one task, ``FAN_IN`` at a time, which gives one list per query. Nothing passes
the driver but row counts and cut-offs.
Ties in distance are broken by the training id, of any type with an order.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

FAN_IN = 64                 # lists merged by one group of an aggregate
TASK_PAIRS = 50             # pairs of blocks compared by one task, about
BOX_DIMS = 4                # vectors of at most so many entries are cut into boxes; longer ones leave none apart
BOX_ROWS = {"t_": 1_000, "q_": 500}      # rows of a training and of a query box, about


def _pack(df: DataFrame, n_blocks: int, id_col: str, vec_col: str, prefix: str, label: str | None = None) -> DataFrame:
    """One row per block: ids in order, vectors end to end, labels. Blocks are hashes of the id, or those of ``__block``
    if ``n_blocks`` is 0."""
    fields = [F.col(id_col).alias("i"), F.col(vec_col).cast("array<double>").alias("v")]
    if label:
        fields.append(F.col(label).cast("double").alias("y"))
    block = F.pmod(F.xxhash64(id_col), F.lit(n_blocks)) if n_blocks else F.col("__block")
    rows = df.select(block.alias(f"{prefix}block"), F.struct(*fields).alias("r"))
    packed = rows.groupBy(f"{prefix}block").agg(F.array_sort(F.collect_list("r")).alias("r"))
    cols = [F.col("r.i").alias(f"{prefix}id"), F.flatten("r.v").alias(f"{prefix}vec")]
    if label:
        cols.append(F.col("r.y").alias(f"{prefix}y"))
    return packed.select(f"{prefix}block", *cols)


def _facts(df: DataFrame, vec_col: str) -> tuple[int, int]:
    """Number of rows, and the length of all vectors: 0 where it differs or an entry is null or not finite."""
    v = F.col(vec_col).cast("array<double>")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    r = df.agg(F.count(F.lit(1)).alias("n"), F.min(F.size(v)).alias("a"), F.max(F.size(v)).alias("b"),
               F.max(odd.cast("int")).alias("odd")).first()
    return r["n"], r["a"] if r["n"] and r["a"] == r["b"] and not r["odd"] else 0


def _boxed(df: DataFrame, n: int, dims: int, id_col: str, vec_col: str, rows: int) -> DataFrame:
    """df with ``__block``: cells between quantiles of the first two entries, a cell of many rows cut again by the id."""
    axes = min(dims, 2)
    per = max(1, math.ceil((n / rows) ** (1 / axes)))
    x = [F.col(vec_col)[i].cast("double") for i in range(axes)]
    share = F.array(*[F.lit(j / per) for j in range(1, per)])
    cells, cell = df, F.lit(0).cast("bigint")
    if per > 1:
        cuts = df.agg(*[F.percentile_approx(c, share, 10 * per).alias(f"c{i}") for i, c in enumerate(x)]).first()
        for i, (c, found) in enumerate(zip(x, cuts)):
            axis = Bucketizer(splits=[-math.inf, *sorted(set(found)), math.inf], inputCol=f"__x{i}",
                              outputCol=f"__b{i}")
            cells = axis.transform(cells.withColumn(f"__x{i}", c))
            cell = cell * per + F.col(f"__b{i}").cast("bigint")
    cells = cells.select(*df.columns, cell.alias("__cell"))
    sizes = cells.groupBy("__cell").agg(F.ceil(F.count(F.lit(1)) / rows).alias("__cut"))
    sub = F.pmod(F.xxhash64(id_col), F.col("__cut"))
    return (cells.join(sizes, "__cell").withColumn("__block", F.shiftleft("__cell", 32) + sub)
            .drop("__cell", "__cut"))


def _near_blocks(t: DataFrame, q: DataFrame, dims: int, vec_col: str, kmax: int) -> DataFrame:
    """Pairs of blocks (q_block, t_block, part) that can hold a query's nearest rows, by the blocks' boxes."""
    def boxes(df, p):
        e = [F.col(vec_col)[i].cast("double") for i in range(dims)]
        return df.groupBy(F.col("__block").alias(f"{p}_block")).agg(
            F.count(F.lit(1)).alias(f"{p}_n"), *[f(c).alias(f"{p}_{w}{i}") for i, c in enumerate(e)
                                                 for f, w in ((F.min, "lo"), (F.max, "hi"))])
    least = most = F.lit(0.0)
    for i in range(dims):
        tl, th, ql, qh = (F.col(f"{p}_{w}{i}") for p in "tq" for w in ("lo", "hi"))
        apart, across = F.greatest(F.lit(0.0), tl - qh, ql - th), F.greatest(th - ql, qh - tl)
        least, most = least + apart * apart, most + across * across
    both = boxes(q, "q").crossJoin(boxes(t, "t")).select("q_block", "t_block", "t_n", least.alias("least"),
                                                         most.alias("most"))
    reach = both.groupBy("q_block").agg(F.min(F.when(F.col("t_n") >= kmax, F.col("most"))).alias("reach"))
    near = both.join(reach, "q_block").where(F.col("reach").isNull()
                                             | (F.col("least") <= F.col("reach") * (1 + 1e-9)))
    rank = F.row_number().over(Window.partitionBy("q_block").orderBy("t_block")) - 1
    return near.select("q_block", "t_block", F.floor(rank / FAN_IN).alias("part"))


def _nearest(q: np.ndarray, t: np.ndarray, kmax: int, max_cells: int = 1 << 18):
    """Distances and positions of each query's nearest rows of t, by (distance, position).

    The arrays of a step stay in the processor's cache."""
    k = min(kmax, len(t))
    dist = np.empty((len(q), k))
    pos = np.empty((len(q), k), dtype=np.int64)
    chunk = max(1, max_cells // max(1, t.size))
    for s in range(0, len(q), chunk):
        diff = q[s:s + chunk, None, :] - t[None, :, :]
        d = np.einsum("qtd,qtd->qt", diff, diff)
        kth = np.partition(d, k - 1, axis=1)[:, k - 1:k]
        rows, cols = np.nonzero(d <= kth)               # the nearest and their ties, in position order
        order = np.lexsort((cols, d[rows, cols], rows))
        rows, cols = rows[order], cols[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        rows, cols, rank = rows[rank < k], cols[rank < k], rank[rank < k]
        dist[s + rows, rank], pos[s + rows, rank] = d[rows, cols], cols
    return dist, pos


def _pair_lists(kmax: int):
    """Per pair of blocks: each query's nearest rows of the training block."""
    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                nq, nt = len(r.q_id), len(r.t_id)
                d, p = _nearest(np.asarray(r.q_vec, dtype=np.float64).reshape(nq, -1),
                                np.asarray(r.t_vec, dtype=np.float64).reshape(nt, -1), kmax)
                ids, ys = np.asarray(r.t_id, dtype=object), np.asarray(r.t_y, dtype=np.float64)
                yield pd.DataFrame({"id": list(r.q_id), "part": r.part, "d": d.tolist(),
                                    "i": [ids[x].tolist() for x in p], "y": ys[p].tolist()})
    return run


def _group_lists(kmax: int):
    """Of one query block and its training blocks: each query's rows up to the distance of its kmax-th, in no order."""
    def run(pdf):
        q_id = pdf["q_id"].iloc[0]
        q = np.asarray(pdf["q_vec"].iloc[0], dtype=np.float64).reshape(len(q_id), -1)
        dist, pos, ids, start = [], [], [], 0
        for r in pdf.itertuples(index=False):
            d, p = _nearest(q, np.asarray(r.t_vec, dtype=np.float64).reshape(len(r.t_id), -1), kmax)
            dist.append(d)
            pos.append(p + start)
            ids.extend(r.t_id)
            start += len(r.t_id)
        dist, pos = np.hstack(dist), np.hstack(pos)
        ys = np.concatenate([np.asarray(y, dtype=np.float64) for y in pdf["t_y"]])
        k = min(kmax, dist.shape[1])
        near = dist <= np.partition(dist, k - 1, axis=1)[:, k - 1:k]
        at = [p[n] for p, n in zip(pos, near)]
        return pd.DataFrame({"id": list(q_id), "part": pdf["part"].iloc[0], "d": [d[n].tolist() for d, n in zip(dist, near)],
                             "i": [[ids[x] for x in p] for p in at], "y": [ys[p].tolist() for p in at]})
    return run


def knn_neighbours(train: DataFrame, query: DataFrame, *, id_col: str, vec_col: str, label: str,
                   kmax: int = 19, block_rows: int = 4_000, box_pairs: float = 2e9) -> DataFrame:
    """Query ids with arrays of their ``kmax`` nearest training rows: best_d, best_id, best_y.

    Above ``box_pairs`` pairs of rows short vectors are compared by boxes (below, looking at all pairs is less work).
    Ids are unique on either side; rows without a vector are left out. No
    training rows give no neighbours and so no rows."""
    train = train.where(F.col(vec_col).isNotNull())
    query = query.where(F.col(vec_col).isNotNull())
    (rows_t, dims), (rows_q, dims_q) = _facts(train, vec_col), _facts(query, vec_col)
    boxed = rows_t * rows_q > box_pairs and dims == dims_q and 0 < dims <= BOX_DIMS
    if boxed:
        train = _boxed(train, rows_t, dims, id_col, vec_col, BOX_ROWS["t_"])
        query = _boxed(query, rows_q, dims, id_col, vec_col, BOX_ROWS["q_"])
        near = _near_blocks(train, query, dims, vec_col, kmax)
        last, n_pairs = near.agg(F.max("part"), F.count(F.lit(1))).first()
        parts = last + 1
        t = _pack(train, 0, id_col, vec_col, "t_", label)
        q = _pack(query, 0, id_col, vec_col, "q_").join(near, "q_block")
    else:
        n_t, n_q = (max(1, math.ceil(n / block_rows)) for n in (rows_t, rows_q))
        parts, n_pairs = math.ceil(n_t / FAN_IN), n_t * n_q
        t = _pack(train, n_t, id_col, vec_col, "t_", label)
        q = (_pack(query, n_q, id_col, vec_col, "q_")
             .withColumn("t_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_t - 1).cast("bigint"))))
             .withColumn("part", F.floor(F.col("t_block") / FAN_IN)))
    qid, tid = query.schema[id_col].dataType, train.schema[id_col].dataType
    found = StructType([
        StructField("id", qid), StructField("part", LongType()), StructField("d", ArrayType(DoubleType())),
        StructField("i", ArrayType(tid)), StructField("y", ArrayType(DoubleType()))])
    # dealt by number of pairs: they are few bytes and much work
    tasks = max(train.sparkSession.sparkContext.defaultParallelism, math.ceil(n_pairs / TASK_PAIRS))
    pairs = q.repartition(tasks, "t_block").join(t.repartition(tasks, "t_block"), "t_block")
    cols = ["part", "q_id", "q_vec", "t_id", "t_vec", "t_y"]
    if boxed:                       # a query block's training blocks are small and together: one list per query
        lists = (pairs.select("q_block", *cols).repartition(tasks, "q_block", "part").groupBy("q_block", "part")
                 .applyInPandas(_group_lists(kmax), found))
    else:
        lists = pairs.select(*cols).mapInPandas(_pair_lists(kmax), found)
    state = lists.select("id", "part", F.arrays_zip("d", "i", "y").alias("best"))
    merged = F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, kmax).alias("best")
    while True:
        state = state.groupBy("id", "part").agg(merged)
        if parts == 1:
            break
        state, parts = state.withColumn("part", F.floor(F.col("part") / FAN_IN)), math.ceil(parts / FAN_IN)
    return state.select(F.col("id").alias(id_col), F.col("best.d").alias("best_d"), F.col("best.i").alias("best_id"),
                        F.col("best.y").alias("best_y"))


def knn_predict(neigh: DataFrame, *, id_col: str, ks: Sequence[int]) -> DataFrame:
    """Mean label of the first k neighbours, one row per (query, k)."""
    k = F.explode(F.array(*[F.lit(v) for v in ks])).alias("k")
    t = neigh.select(id_col, "best_y", k)
    mean = F.aggregate(F.slice("best_y", 1, F.col("k")), F.lit(0.0), lambda acc, v: acc + v) / F.col("k")
    return t.select(id_col, F.col("k").cast("int").alias("k"), mean.alias("y_hat"))

