"""Property tests over generated panels."""

import datetime as dt

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from panelforge.ml import evaluate as E
from panelforge.ml import prep as M
from panelforge.ml import split as S

D0 = dt.date(2020, 1, 1)

panel_rows = st.lists(
    st.tuples(st.integers(0, 4), st.integers(0, 60), st.one_of(st.none(), st.floats(-100, 100, allow_nan=False))),
    min_size=12, max_size=80, unique_by=lambda r: (r[0], r[1]))


def _df(spark, rows):
    return spark.createDataFrame([(e, D0 + dt.timedelta(days=t), v, float(e + t)) for e, t, v in rows],
                                 "entity int, d date, a double, y double")


@settings(max_examples=8, deadline=None)
@given(panel_rows)
def test_time_split_partitions_rows(spark, rows):
    df = _df(spark, rows)
    s = S.split_time(df, date="d", test_size=0.2, validation=(0.5, 0.7))
    c = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert sum(c.values()) == len(rows)
    # a row's label depends only on its date
    per_day = s.groupBy("d").agg(F.countDistinct(F.coalesce("split", F.lit("none"))).alias("n")).collect()
    assert all(r["n"] == 1 for r in per_day)


@settings(max_examples=8, deadline=None)
@given(panel_rows)
def test_impute_then_standardize(spark, rows):
    df = S.split_time(_df(spark, rows), date="d", test_size=0.3)
    has_train_value = df.where((F.col("split") == "train") & F.col("a").isNotNull()).count() > 0
    imp = M.impute(df, columns=["a"], how="median", validation_stats="train")
    if has_train_value:
        assert imp.where(F.col("a").isNull()).count() == 0
        z = M.standardize(imp, columns=["a"]).where(F.col("split") == "train").select("a").toPandas()["a"]
        assert abs(z.mean()) < 1e-9
        assert abs(np.std(z) - 1) < 1e-9 or np.std(z) == 0


@settings(max_examples=6, deadline=None)
@given(panel_rows)
def test_null_model_errors_non_negative(spark, rows):
    f = S.cv_folds(_df(spark, rows), date="d")
    if f.count() == 0:
        return
    for r in E.score(E.null_predictions(f), digits=None).collect():
        assert r["mae"] is None or r["mae"] >= 0
        assert r["mse"] is None or r["mse"] >= r["mae"] ** 2 - 1e-9
