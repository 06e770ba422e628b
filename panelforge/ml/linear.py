"""Linear family (M6-M8) on Spark ML with the reference objectives.

* least squares : LinearRegression(solver='normal', regParam=0)
* lasso(alpha)  : 1/(2n)||y-Xw-b||^2 + alpha*||w||_1
                  -> elasticNetParam=1, regParam=alpha, standardization=False
* ridge(alpha)  : ||y-Xw-b||^2 + alpha*||w||^2
                  -> regParam = alpha/n * stddev_pop(y), solver='normal'
                  (Spark scales the L2 term by the label's std).

Feature vectors come from ``VectorAssembler``; fitting is distributed by
Spark (normal equations by treeAggregate of X'X, OWL-QN for L1).
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error").transform(df)


def label_stats(df: DataFrame, label: str) -> tuple[int, float]:
    r = df.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("s")).first()
    return int(r["n"]), float(r["s"] or 0.0)


def make_linear(kind: str, params: dict, *, n: int | None = None, y_std: float | None = None,
                label: str = "y", features: str = "features",
                prediction: str = "prediction") -> LinearRegression:
    """Build the Spark estimator equal to the reference's model + params."""
    common = dict(featuresCol=features, labelCol=label, predictionCol=prediction,
                  standardization=False, fitIntercept=True)
    if kind == "linear":
        return LinearRegression(solver="normal", regParam=0.0, **common)
    if kind == "lasso":
        return LinearRegression(elasticNetParam=1.0, regParam=float(params["alpha"]),
                                maxIter=1000, tol=1e-10, **common)
    if kind == "ridge":
        if n is None or y_std is None:
            raise ValueError("ridge needs the row count and the label's population std")
        reg = float(params["alpha"]) / n * (y_std if y_std > 0 else 1.0)
        return LinearRegression(solver="normal", elasticNetParam=0.0, regParam=reg, **common)
    raise ValueError(f"unknown linear model {kind!r}")


def fit_linear(train: DataFrame, *, kind: str, params: dict | None, features: Sequence[str],
               label: str = "y") -> LinearRegressionModel:
    params = params or {}
    data = assemble(train.select(*features, label), features)
    n = y_std = None
    if kind == "ridge":
        n, y_std = label_stats(train, label)
    return make_linear(kind, params, n=n, y_std=y_std, label=label).fit(data)


def coefficients_frame(spark, model: LinearRegressionModel, features: Sequence[str],
                       kind: str, params: dict | None) -> DataFrame:
    """Small result table: one row per coefficient plus the intercept."""
    rows = [(kind, json.dumps(params or {}, sort_keys=True), f, float(w))
            for f, w in zip(features, model.coefficients.toArray())]
    rows.append((kind, json.dumps(params or {}, sort_keys=True), "(intercept)", float(model.intercept)))
    return spark.createDataFrame(rows, "model string, params string, term string, value double")


# The reference's regularisation grid (11 alphas).
ALPHAS = [0.01, 0.05, 0.1, 0.5, 1, 5, 10, 50, 100, 500, 1000]


# ---- whole linear grid from one pass of sufficient statistics ---------------
# Least squares, ridge and lasso depend on the data only through the centred
# Gram matrix X'X, X'y and the means. One grouped aggregate (per fold) gives
# them for every grid point at once; the k x k solves run on the driver
# (k = number of features, a fixed small number), so the grid costs one scan
# for the statistics and one scan to score all points, instead of one Spark
# fit per point.

#: Partial blocks that the driver takes; more are merged in tasks first.
GRAM_FAN_IN = 256


def _merged(a, b):
    """(n, means, centred products) of two disjoint sets of rows together."""
    if a is None:
        return b
    (n, m, g), (n2, m2, g2) = a, b
    d, both = m2 - m, n + n2
    return both, m + d * (n2 / both), g + g2 + np.outer(d, d) * (n * n2 / both)


def _merge_batches(batches):
    """One block per group out of a task's blocks."""
    total: dict = {}
    kind = None
    for b in batches:
        kind = b.schema.field("g").type
        for r in b.to_pylist():
            k = len(r["mean"])
            total[r["g"]] = _merged(total.get(r["g"]),
                                    (r["n"], np.array(r["mean"]), np.array(r["gram"]).reshape(k, k)))
    if total:
        yield _blocks(total, kind)


def _blocks(total: dict, kind) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(total), kind), pa.array([v[0] for v in total.values()], pa.int64()),
         pa.array([v[1].tolist() for v in total.values()], pa.list_(pa.float64())),
         pa.array([v[2].ravel().tolist() for v in total.values()], pa.list_(pa.float64()))], ["g", "n", "mean", "gram"])


def _block_of(batches):
    """One (n, means, centred products) block per group of a task's rows (g, x0, ..., y)."""
    total: dict = {}
    kind = None
    for b in batches:
        kind = b.schema.field("g").type
        codes = b.column("g").dictionary_encode("encode")
        z = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns[1:]])
        index = codes.indices.to_numpy()
        for i, key in enumerate(codes.dictionary.to_pylist()):
            rows = z[index == i]
            mean = rows.mean(axis=0)
            rows = rows - mean
            total[key] = _merged(total.get(key), (len(rows), mean, rows.T @ rows))
    if total:
        yield _blocks(total, kind)


def gram_by_group(df: DataFrame, features: Sequence[str], label: str, by: str) -> dict:
    """{group: (n, mean_x, mean_y, Sxx, Sxy)} with centred sums (rows with a
    missing feature or label are skipped).

    Each task sums the products of its rows around its own means; the blocks
    are merged pairwise with the means' differences, so nothing cancels
    however far the data lie from 0. One block of (k + 1)^2 numbers per task
    and group is moved.
    """
    k = len(features)
    data = df.select(F.col(by).alias("g"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)],
                     F.col(label).cast("double").alias("y")).dropna(subset=[*[f"x{i}" for i in range(k)], "y"])
    schema = f"g {data.schema['g'].dataType.simpleString()}, n long, mean array<double>, gram array<double>"
    blocks = data.mapInArrow(_block_of, schema)
    tasks = data.rdd.getNumPartitions()
    while tasks > GRAM_FAN_IN:
        tasks = max(GRAM_FAN_IN, math.isqrt(tasks))
        blocks = blocks.repartition(tasks).mapInArrow(_merge_batches, schema)
    total: dict = {}
    for r in blocks.collect():
        total[r["g"]] = _merged(total.get(r["g"]),
                                (r["n"], np.array(r["mean"]), np.array(r["gram"]).reshape(k + 1, k + 1)))
    return {g: (float(n), m[:k], float(m[k]), s[:k, :k], s[:k, k]) for g, (n, m, s) in total.items()}


def lasso_cd(gram: np.ndarray, cov: np.ndarray, alpha: float, tol: float = 1e-13,
             max_iter: int = 100000) -> np.ndarray:
    """Coordinate descent for 1/2 w'Gw - c'w + alpha*|w|_1 (G = X'X/n, c = X'y/n).

    Ends when no weight moves by more than ``tol`` of the largest; raises when
    ``max_iter`` rounds do not get there."""
    k = len(cov)
    w = np.zeros(k)
    for _ in range(max_iter):
        delta = 0.0
        for j in range(k):
            if gram[j, j] == 0:
                continue
            rho = cov[j] - gram[j] @ w + gram[j, j] * w[j]
            new = np.sign(rho) * max(abs(rho) - alpha, 0.0) / gram[j, j]
            delta = max(delta, abs(new - w[j]))
            w[j] = new
        if delta <= tol * max(1.0, float(np.abs(w).max(initial=0.0))):
            return w
    raise RuntimeError(f"lasso (alpha={alpha}) did not converge in {max_iter} rounds: last change {delta}")


def solve_linear(kind: str, params: dict, stats) -> tuple[np.ndarray, float]:
    """Coefficients and intercept of one grid point from the centred statistics."""
    n, mx, my, sxx, sxy = stats
    k = len(mx)
    if kind == "linear":
        w = np.linalg.lstsq(sxx, sxy, rcond=None)[0]
    elif kind == "ridge":
        w = np.linalg.solve(sxx + float(params["alpha"]) * np.eye(k), sxy)
    elif kind == "lasso":
        w = lasso_cd(sxx / n, sxy / n, float(params["alpha"]))
    else:
        raise ValueError(f"unknown linear model {kind!r}")
    return w, float(my - w @ mx)


def linear_grid_predictions(frame: DataFrame, grid, *, features: Sequence[str], label: str = "y",
                            keys: Sequence[str] = ("entity", "d"), fold: str = "fold", split: str = "split",
                            train: str = "train", target: str = "validation") -> DataFrame:
    """Long predictions ``(fold, model, params, *keys, y, y_hat)`` for every grid
    point and fold, from one statistics pass and one projection pass."""
    import json
    stats = gram_by_group(frame.where(F.col(split) == train), features, label, fold)
    x = [F.col(c).cast("double") for c in features]
    cells = []
    for kind, params in grid:
        y_hat = None
        for f, st in stats.items():
            w, b = solve_linear(kind, params, st)
            e = F.lit(float(w[0])) * x[0]
            for i in range(1, len(features)):
                e = e + F.lit(float(w[i])) * x[i]
            e = e + F.lit(b)
            y_hat = F.when(F.col(fold) == f, e) if y_hat is None else y_hat.when(F.col(fold) == f, e)
        cells.append(F.struct(F.lit(kind).alias("model"),
                              F.lit(json.dumps(params, sort_keys=True)).alias("params"),
                              y_hat.alias("y_hat")))
    ev = frame.where(F.col(split) == target)
    return (ev.select(fold, *keys, label, F.explode(F.array(*cells)).alias("__p"))
              .select(fold, "__p.model", "__p.params", *keys, label, "__p.y_hat"))
