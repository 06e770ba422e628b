import datetime as dt

import numpy as np


from panelforge.operators import panel as P

D0 = dt.date(2020, 3, 1)


def _panel(spark):
    rows = []
    rng = np.random.default_rng(3)
    for e in range(6):
        for t in range(12):
            if (e + t) % 5 == 0:
                continue                      # a missing day: rows, not days, are counted
            v = None if (e * t) % 7 == 3 else float(rng.integers(0, 100))
            rows.append((e, e % 2, D0 + dt.timedelta(days=t), v))
    return spark.createDataFrame(rows, "entity int, parent int, d date, v double")


def test_rolling_mean_matches_min_periods_one(spark):
    df = _panel(spark)
    got = P.rolling_mean(df, entity="entity", order="d", columns=["v"], windows=(3, 7)).toPandas()
    pdf = df.toPandas().sort_values(["entity", "d"])
    for w in (3, 7):
        exp = pdf.groupby("entity")["v"].transform(lambda s: s.rolling(w, min_periods=1).mean())
        m = pdf.assign(exp=exp).merge(got, on=["entity", "d"])
        assert np.allclose(m["exp"].astype(float), m[f"v_{w}d_avg"].astype(float), equal_nan=True)


def test_rolling_one_is_identity(spark):
    df = _panel(spark)
    got = P.rolling_mean(df, entity="entity", order="d", columns=["v"], windows=(1,)).toPandas()
    assert np.allclose(got["v"].astype(float), got["v_1d_avg"].astype(float), equal_nan=True)


def test_lags_match_shift(spark):
    df = _panel(spark)
    got = P.lag_features(df, entity="entity", order="d", columns=["v"], lags=(1, 3)).toPandas()
    pdf = df.toPandas().sort_values(["entity", "d"])
    for n in (1, 3):
        exp = pdf.groupby("entity")["v"].shift(n)
        m = pdf.assign(exp=exp).merge(got, on=["entity", "d"])
        assert np.allclose(m["exp"].astype(float), m[f"lag{n}_v"].astype(float), equal_nan=True)


def test_fill_parent_mean_and_zero(spark):
    df = spark.createDataFrame([(1, 0, D0, 2.0), (2, 0, D0, None), (3, 0, D0, 4.0), (4, 1, D0, None)],
                               "entity int, parent int, d date, v double")
    got = {r["entity"]: r["v"] for r in P.fill_parent_mean(df, parent="parent", date="d", columns=["v"]).collect()}
    assert got == {1: 2.0, 2: 3.0, 3: 4.0, 4: None}
    got0 = {r["entity"]: r["v"] for r in
            P.fill_parent_mean(df, parent="parent", date="d", columns=["v"], then_zero=True).collect()}
    assert got0[4] == 0.0


def test_fill_from_parent_table(spark):
    child = spark.createDataFrame([("01001", "01", None), ("01003", "01", 5.0)], "fips string, st string, p double")
    parent = spark.createDataFrame([("01", 7.0)], "st string, p double")
    got = {r["fips"]: r["p"] for r in P.fill_from_parent_table(child, parent, on="st", columns=["p"]).collect()}
    assert got == {"01001": 7.0, "01003": 5.0}


def test_best_per_group_keeps_ties(spark):
    df = spark.createDataFrame([("a", "p1", 1.0), ("a", "p2", 1.0), ("a", "p3", 2.0), ("b", "p1", 3.0)],
                               "model string, params string, mae double")
    got = sorted(tuple(r) for r in P.best_per_group(df, group="model", metric="mae").collect())
    assert got == [("a", "p1", 1.0), ("a", "p2", 1.0), ("b", "p1", 3.0)]


def test_calendar_window_counts_days(spark):
    df = spark.createDataFrame([(1, D0, 1.0), (1, D0 + dt.timedelta(days=5), 3.0)], "entity int, d date, v double")
    rows = P.rolling_mean(df, entity="entity", order="d", columns=["v"], windows=(3,), calendar=True) \
        .orderBy("d").collect()
    assert [r["v_3d_avg"] for r in rows] == [1.0, 3.0]
    rows = P.rolling_mean(df, entity="entity", order="d", columns=["v"], windows=(3,)).orderBy("d").collect()
    assert [r["v_3d_avg"] for r in rows] == [1.0, 2.0]
