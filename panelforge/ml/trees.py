"""Tree ensembles.

* Random forest: Spark's ``RandomForestRegressor`` (distributed histogram
  splits). Depth 30 is Spark's limit (the reference grows full trees);
  ``max_features`` maps 'auto' to all features (the reference's meaning),
  'log2' / 'sqrt' to the same counts given as integers.
* AdaBoost.R2 (linear loss): a driver loop of weighted depth-3
  ``DecisionTreeRegressor`` fits. Sample weights live in a column; each round
  is one fit plus one aggregate (max error, weighted loss) and a projection
  updating the weights. Lineage is cut with ``checkpoint`` every few rounds.
  The prediction is the weighted median of the trees' predictions (array
  functions, JVM-side). Weighting the split criterion instead of resampling
  makes the fit deterministic.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir

MAX_DEPTH = 30


def feature_subset(max_features: str, n_features: int) -> str:
    """The reference's max_features as a Spark featureSubsetStrategy."""
    if max_features in ("auto", None):
        return "all"
    if max_features == "log2":
        return str(max(1, int(math.log2(n_features))))
    if max_features == "sqrt":
        return str(max(1, int(math.sqrt(n_features))))
    return str(max_features)


def fit_forest(train: DataFrame, *, features: Sequence[str], label: str = "y", n_estimators: int = 100,
               max_features: str = "auto", seed: int = 0, max_depth: int = MAX_DEPTH):
    checkpoint_dir(train.sparkSession)        # node-id cache is checkpointed (reliable) every 10 levels
    # labels read from text files arrive as strings
    train = train.withColumn(label, F.col(label).cast("double"))
    data = VectorAssembler(inputCols=list(features), outputCol="features").transform(train)
    rf = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=n_estimators,
                               featureSubsetStrategy=feature_subset(max_features, len(features)),
                               maxDepth=max_depth, minInstancesPerNode=1, subsamplingRate=1.0,
                               bootstrap=True, seed=seed,
                               # deep trees: keep each row's node id instead of re-walking the
                               # trees every level, and split more nodes per pass
                               cacheNodeIds=True, checkpointInterval=10, maxMemoryInMB=1024)
    return rf.fit(data)


def predict(model, df: DataFrame, features: Sequence[str], out: str = "y_hat") -> DataFrame:
    data = VectorAssembler(inputCols=list(features), outputCol="features").transform(df)
    return model.transform(data).withColumnRenamed(model.getPredictionCol(), out).drop("features")


def importances(spark, model, features: Sequence[str], top: int = 50) -> DataFrame:
    """Feature importances (a model attribute, one value per feature), largest first."""
    vals = model.featureImportances.toArray()
    rows = sorted(zip(features, (float(v) for v in vals)), key=lambda r: (-r[1], r[0]))[:top]
    return spark.createDataFrame(rows, "feature string, importance double")


# ---- AdaBoost.R2 ----------------------------------------------------------

def fit_adaboost(train: DataFrame, *, features: Sequence[str], label: str = "y", n_estimators: int = 50,
                 max_depth: int = 3, seed: int = 0, checkpoint_every: int = 10):
    """Returns a list of (tree model, estimator weight); fewer trees when the
    weighted loss reaches 0.5 (the boosting stops, as AdaBoost.R2 does)."""
    spark = train.sparkSession
    checkpoint_dir(spark)
    data = (VectorAssembler(inputCols=list(features), outputCol="features").transform(train)
            .select("features", F.col(label).cast("double").alias("__y")))
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    n = data.count()
    cur = data.withColumn("__w", F.lit(1.0 / n))
    older = None                              # weights of the round before, kept until cur is computed
    ensemble = []
    for m in range(n_estimators):
        tree = DecisionTreeRegressor(featuresCol="features", labelCol="__y", weightCol="__w",
                                     maxDepth=max_depth, seed=seed + m).fit(cur)
        pred = tree.transform(cur).withColumn("__e", F.abs(F.col("__y") - F.col("prediction")))
        # one aggregate per round: max error, weight total and weighted error
        st = pred.agg(F.max("__e").alias("emax"), F.sum("__w").alias("wsum"),
                      F.sum(F.col("__w") * F.col("__e")).alias("wesum")).first()
        if older is not None:
            older.unpersist()                 # this round's passes have filled cur's own cache
            older = None
        emax = st["emax"] or 0.0
        if emax <= 0:
            ensemble.append((tree, 1.0))
            break
        eps = st["wesum"] / emax / st["wsum"]            # weighted mean of the linear loss e / emax
        if eps >= 0.5:
            if not ensemble:
                ensemble.append((tree, 1.0))
            break
        beta = eps / (1.0 - eps)
        ensemble.append((tree, math.log(1.0 / beta) if beta > 0 else 1.0))
        loss = F.col("__e") / F.lit(emax)
        # normalise by the total of this round and re-weight in the same projection
        new_w = F.col("__w") / F.lit(st["wsum"]) * F.pow(F.lit(beta), 1.0 - loss)
        prev = cur
        cur = pred.select("features", "__y", new_w.alias("__w"))
        if (m + 1) % checkpoint_every == 0:
            cur = cur.checkpoint()
        else:
            # the next round reads the weights twice (tree fit, then its errors)
            cur = cur.persist(StorageLevel.MEMORY_AND_DISK)
        older = prev
    for df in (older, cur, data):
        if df is not None:
            df.unpersist()
    return ensemble


def _tree_predictions(ensemble, df: DataFrame, features: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """df with one column per tree."""
    cur = VectorAssembler(inputCols=list(features), outputCol="__f").transform(df)
    for i, (tree, _) in enumerate(ensemble):
        t = tree.copy()
        t.setFeaturesCol("__f").setPredictionCol(f"__p{i}")
        cur = t.transform(cur)
    return cur, [f"__p{i}" for i in range(len(ensemble))]


def _weighted_median(columns: Sequence[str], weights: Sequence[float]):
    """One running sum over the sorted values; the first to reach half of the weight is the median."""
    pairs = F.array(*[F.struct(F.col(p).alias("p"), F.lit(w).alias("w")) for p, w in zip(columns, weights)])
    half = 0.5 * sum(weights)
    start = F.struct(F.lit(0.0).alias("c"), F.lit(None).cast("double").alias("p"))
    return F.aggregate(F.array_sort(pairs), start, lambda a, s: F.struct(
        (a["c"] + s["w"]).alias("c"),
        F.when(a["p"].isNull() & (a["c"] + s["w"] >= F.lit(half)), s["p"]).otherwise(a["p"]).alias("p")),
        lambda a: a["p"])


def predict_adaboost(ensemble, df: DataFrame, features: Sequence[str], n_estimators: int | None = None,
                     out: str = "y_hat") -> DataFrame:
    """Weighted median of the first ``n_estimators`` trees' predictions."""
    use = ensemble[: n_estimators or len(ensemble)]
    cur, columns = _tree_predictions(use, df, features)
    return cur.select(*df.columns, _weighted_median(columns, [w for _, w in use]).alias(out))


def predict_adaboost_sizes(ensemble, df: DataFrame, features: Sequence[str], sizes: dict[str, int]) -> DataFrame:
    """df's rows once per size ({name: trees}), with ``name`` and ``y_hat``; each tree is applied once."""
    use = ensemble[:max(sizes.values())]
    cur, columns = _tree_predictions(use, df, features)
    weights = [w for _, w in use]
    cells = [F.struct(F.lit(name).alias("name"), _weighted_median(columns[:n], weights[:n]).alias("y_hat"))
             for name, n in sizes.items()]
    return cur.select(*df.columns, F.explode(F.array(*cells)).alias("__s")).select(
        *df.columns, "__s.name", "__s.y_hat")
