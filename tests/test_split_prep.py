import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F

from panelforge.ml import prep as M
from panelforge.ml import split as S

D0 = dt.date(2020, 1, 1)


def _frame(spark, n_days=50, n_ent=4):
    rng = np.random.default_rng(2)
    rows = [(e, D0 + dt.timedelta(days=t), float(rng.normal()), None if (e + t) % 6 == 0 else float(rng.normal()))
            for e in range(n_ent) for t in range(n_days)]
    return spark.createDataFrame(rows, "entity int, d date, y double, a double")


def test_split_time_partitions_rows(spark):
    df = _frame(spark)
    s = S.split_time(df, date="d", test_size=0.1)
    c = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert sum(c.values()) == df.count() and set(c) == {"train", "test"}
    tr_max = s.where(F.col("split") == "train").agg(F.max("d")).first()[0]
    te_min = s.where(F.col("split") == "test").agg(F.min("d")).first()[0]
    assert tr_max < te_min


def test_cv_folds_expanding(spark):
    f = S.cv_folds(_frame(spark), date="d")
    sizes = {r["fold"]: r["count"] for r in f.where(F.col("split") == "train").groupBy("fold").count().collect()}
    assert sizes["0.6-0.7"] < sizes["0.7-0.8"] < sizes["0.8-0.9"]


def test_split_random_exact_size(spark):
    df = _frame(spark)
    s = S.split_random(df, keys=["entity", "d"], test_size=0.1, seed=1, max_final_bucket=5)
    n = df.count()
    assert s.where(F.col("split") == "test").count() == math.ceil(0.1 * n)
    # deterministic
    s2 = S.split_random(df, keys=["entity", "d"], test_size=0.1, seed=1)
    a = sorted(tuple(r) for r in s.where(F.col("split") == "test").select("entity", "d").collect())
    b = sorted(tuple(r) for r in s2.where(F.col("split") == "test").select("entity", "d").collect())
    assert a == b


def test_impute_validation_uses_own_median(spark):
    df = spark.createDataFrame([(1, "train", 1.0), (2, "train", 3.0), (3, "train", None),
                                (4, "validation", 10.0), (5, "validation", None), (6, "test", None)],
                               "k int, split string, a double")
    got = {r["k"]: r["a"] for r in M.impute(df, columns=["a"], how="median").collect()}
    assert got[3] == 2.0 and got[5] == 10.0 and got[6] == 2.0
    got_t = {r["k"]: r["a"] for r in M.impute(df, columns=["a"], how="median", validation_stats="train").collect()}
    assert got_t[5] == 2.0


def test_standardize_population_std(spark):
    df = spark.createDataFrame([(1, "train", 1.0), (2, "train", 2.0), (3, "train", 3.0), (4, "test", 5.0),
                                (5, "train", None)], "k int, split string, a double")
    z = M.standardize(df.where(F.col("a").isNotNull()), columns=["a"])
    vals = {r["k"]: r["a"] for r in z.collect()}
    s = np.std([1.0, 2.0, 3.0])
    assert abs(vals[1] + 1 / s) < 1e-12 and abs(vals[4] - 3 / s) < 1e-12
    const = spark.createDataFrame([(1, "train", 4.0), (2, "test", 6.0)], "k int, split string, a double")
    assert {r["k"]: r["a"] for r in M.standardize(const, columns=["a"]).collect()} == {1: 0.0, 2: 2.0}


def test_pca_matches_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3)) @ np.array([[2.0, 0.5, 0.0], [0.0, 1.0, 0.3], [0.0, 0.0, 0.2]])
    x = (x - x.mean(0)) / x.std(0)
    df = spark.createDataFrame([("train", *map(float, r)) for r in x], "split string, a double, b double, c double")
    model, m, signs = M.fit_pca(df, columns=["a", "b", "c"], k=3, threshold=0.95)
    ev = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    assert np.allclose(model.explainedVariance.toArray(), ev / ev.sum(), atol=1e-9)
    proj = M.pca_project(df, model, m, signs, columns=["a", "b", "c"])
    assert proj.columns == ["split"] + [f"pc{j + 1}" for j in range(m)]
    assert abs(proj.agg(F.avg("pc1")).first()[0]) < 1e-9
