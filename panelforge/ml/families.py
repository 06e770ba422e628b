"""The model families as fitted artefacts: fit, store, open again, predict.

A family cuts its grid into units; a unit is fitted in shared work and stored
as one artefact (all linear points come from one Gram matrix, all SVR points
from shared passes, all AdaBoost sizes are prefixes of one ensemble, all k of
kNN read one table of training rows; each forest is a unit of its own).

``predict`` applies an opened artefact to any prepared rows and returns the
long table (model, params, *keys, y, y_hat), one entry per grid point.

Defined cases: a unit without points gives no artefact; training rows with a
missing value are skipped by the linear families and SVR, and are an error of
Spark ML in the tree families (prepare the rows first).
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml.regression import DecisionTreeRegressionModel, RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import knn as KNN
from . import linear as L
from . import svr as SVR
from . import trees as TR

#: Stored trees written or opened at a time.
TREE_THREADS = 8


def params_text(p: dict) -> str:
    return json.dumps(p, sort_keys=True)


def _named(df: DataFrame, model: str, params: dict, keys: Sequence[str]) -> DataFrame:
    return df.select(F.lit(model).alias("model"), F.lit(params_text(params)).alias("params"), *keys, "y", "y_hat")


class _Weights:
    """Families whose fitted points are weight vectors, the intercept last: {(model, params text): weights}."""

    def units(self, grid) -> list[list]:
        return [list(grid)] if grid else []

    def save(self, spark: SparkSession, fitted: dict, path: str) -> None:
        rows = [(m, p, [float(v) for v in w]) for (m, p), w in fitted.items()]
        spark.createDataFrame(rows, "model string, params string, weights array<double>").coalesce(1).write.parquet(path)

    def load(self, spark: SparkSession, path: str) -> dict:
        return {(r["model"], r["params"]): np.array(r["weights"]) for r in spark.read.parquet(path).collect()}

    def predict(self, fitted: dict, df: DataFrame, features: Sequence[str], keys: Sequence[str], unit) -> DataFrame:
        cells = [F.struct(F.lit(m).alias("model"), F.lit(p).alias("params"),
                          SVR.linear_value(w, features).alias("y_hat")) for (m, p), w in fitted.items()]
        return (df.select(*keys, "y", F.explode(F.array(*cells)).alias("__p"))
                  .select("__p.model", "__p.params", *keys, "y", "__p.y_hat"))


class Linear(_Weights):
    """Least squares, lasso, ridge; grid points are (model, params)."""

    name, version = "linear", 1

    def fit(self, train: DataFrame, features: Sequence[str], unit, seed: int) -> dict:
        stats = L.gram_by_group(train.withColumn("__g", F.lit(0)), features, "y", "__g")
        if not stats:
            raise ValueError("no complete training row")
        solved = ((m, p, *L.solve_linear(m, p, stats[0])) for m, p in unit)
        return {(m, params_text(p)): np.r_[w, b] for m, p, w, b in solved}


class Svr(_Weights):
    name, version = "svr", 1

    def fit(self, train: DataFrame, features: Sequence[str], unit, seed: int) -> dict:
        fits = SVR.fit_linear_svr_grid(train, [(p["C"], p["epsilon"]) for p in unit], features=features, label="y")
        return {("svr", params_text(p)): fits["all", i][0] for i, p in enumerate(unit)}


class Forest:
    name, version = "forest", 1

    def units(self, grid) -> list[list]:
        return [[p] for p in grid]

    def fit(self, train, features, unit, seed):
        p, = unit
        return TR.fit_forest(train, features=features, n_estimators=p["n_estimators"],
                             max_features=p["max_features"], seed=seed)

    def save(self, spark, fitted, path: str) -> None:
        fitted.write().save(path)

    def load(self, spark, path: str):
        return RandomForestRegressionModel.load(path)

    def predict(self, fitted, df, features, keys, unit) -> DataFrame:
        return _named(TR.predict(fitted, df, features), "forest", unit[0], keys)


class AdaBoost:
    """Stored as one Spark ML tree per round and the table of their weights."""

    name, version = "adaboost", 1

    def units(self, grid) -> list[list]:
        return [list(grid)] if grid else []

    def fit(self, train, features, unit, seed):
        return TR.fit_adaboost(train, features=features, n_estimators=max(p["n_estimators"] for p in unit), seed=seed)

    def save(self, spark, fitted, path: str) -> None:
        with ThreadPoolExecutor(max_workers=TREE_THREADS) as pool:
            list(pool.map(lambda x: x[1][0].write().save(f"{path}/tree-{x[0]}"), enumerate(fitted)))
        rows = [(i, float(w)) for i, (_, w) in enumerate(fitted)]
        spark.createDataFrame(rows, "round int, weight double").coalesce(1).write.parquet(f"{path}/weights")

    def load(self, spark, path: str):
        rows = spark.read.parquet(f"{path}/weights").orderBy("round").collect()
        with ThreadPoolExecutor(max_workers=TREE_THREADS) as pool:
            trees = list(pool.map(lambda r: DecisionTreeRegressionModel.load(f"{path}/tree-{r['round']}"), rows))
        return [(t, r["weight"]) for t, r in zip(trees, rows)]

    def predict(self, fitted, df, features, keys, unit) -> DataFrame:
        found = TR.predict_adaboost_sizes(fitted, df, features, {params_text(p): p["n_estimators"] for p in unit})
        return found.select(F.lit("adaboost").alias("model"), F.col("name").alias("params"), *keys, "y", "y_hat")


class Knn:
    """The model is the table of training rows: an identity, the features as one array, the label."""

    name, version = "knn", 1

    def units(self, grid) -> list[list]:
        return [list(grid)] if grid else []

    def fit(self, train, features, unit, seed):
        vec = F.array(*[F.col(c).cast("double") for c in features])
        return train.select(_identity([c for c in train.columns if c not in (*features, "y")]), vec.alias("__v"), "y")

    def save(self, spark, fitted, path: str) -> None:
        fitted.write.parquet(path)

    def load(self, spark, path: str):
        return spark.read.parquet(path)

    def predict(self, fitted, df, features, keys, unit) -> DataFrame:
        vec = F.array(*[F.col(c).cast("double") for c in features]).alias("__v")
        ks = [p["n_neighbors"] for p in unit]
        near = KNN.knn_neighbours(fitted, df.select(_identity(keys), vec), id_col="__id", vec_col="__v", label="y",
                                  kmax=max(ks))
        pred = KNN.knn_predict(near, id_col="__id", ks=ks)
        params = F.concat(F.lit('{"n_neighbors": '), F.col("k").cast("string"), F.lit("}")).alias("params")
        return (df.select(_identity(keys), *keys, "y").join(pred, "__id")
                  .select(F.lit("knn").alias("model"), params, *keys, "y", "y_hat"))


def _identity(keys: Sequence[str]):
    """The keys themselves, written as one JSON text."""
    return F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("__id")


FAMILIES = {f.name: f for f in (Linear(), Svr(), Forest(), AdaBoost(), Knn())}
