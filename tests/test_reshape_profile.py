import datetime as dt

import numpy as np
import pandas as pd
import pytest

from panelforge.operators import profile as A
from panelforge.operators import reshape as R

D0 = dt.date(2020, 3, 1)


def test_pivot_strict_rejects_duplicates(spark):
    ok = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0)], "k int, c string, v double")
    got = {r["k"]: (r["a"], r["b"]) for r in
           R.pivot_strict(ok, keys="k", pivot="c", value="v", values=["a", "b"], name="{category}").collect()}
    assert got == {1: (1.0, 2.0), 2: (3.0, None)}
    dup = ok.unionByName(spark.createDataFrame([(1, "a", 9.0)], "k int, c string, v double"))
    with pytest.raises(Exception, match="duplicate"):
        R.pivot_strict(dup, keys="k", pivot="c", value="v", values=["a", "b"]).collect()


def test_pivot_mean_averages_duplicates(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "a", 3.0)], "k int, c string, v double")
    assert R.pivot_mean(df, keys="k", pivot="c", value="v", values=["a"]).first()["a"] == 2.0


def test_unpivot_then_pivot_is_identity(spark):
    wide = spark.createDataFrame([(1, 1.0, None), (2, 3.0, 4.0)], "k int, a double, b double")
    long = R.unpivot(wide, ids="k", columns=["a", "b"], var="c", value="v")
    assert long.count() == 4                      # missing values stay as rows
    back = R.pivot_strict(long, keys="k", pivot="c", value="v", values=["a", "b"], name="{category}")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, wide.collect()))


def test_union_by_name_fills_missing(spark):
    a = spark.createDataFrame([(1, 2.0)], "k int, x double")
    b = spark.createDataFrame([(2, "z")], "k int, y string")
    rows = sorted(map(tuple, R.union_by_name([a, b]).select("k", "x", "y").collect()))
    assert rows == [(1, 2.0, None), (2, None, "z")]


def test_top_n_breaks_ties(spark):
    df = spark.createDataFrame([(i, float(i % 3)) for i in range(10)], "k int, v double")
    assert [r["k"] for r in R.top_n(df, 4, "v", ["k"]).collect()] == [2, 5, 8, 1]


def test_missing_by_date_zero_not_null(spark):
    df = spark.createDataFrame([(1, D0, 1.0), (2, D0, 2.0), (1, D0 + dt.timedelta(1), None),
                                (2, D0 + dt.timedelta(1), 2.0)], "e int, d date, v double")
    got = {r["d"]: r["v_pct_missing"] for r in A.missing_by_date(df, date="d", entity="e", columns=["v"]).collect()}
    assert got == {D0: 0.0, D0 + dt.timedelta(1): 50.0}
    q13 = {r["d"]: r["v_pct_missing"] for r in
           A.missing_by_date(df, date="d", entity="e", columns=["v"], zero_as_null=True).collect()}
    assert q13[D0] is None


def test_missing_by_column(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 1.0), (4, 2.0)], "k int, v double")
    got = {r["column"]: r["pct_missing"] for r in A.missing_by_column(df).collect()}
    assert got == {"k": 0.0, "v": 50.0}


def test_spearman_matches_pandas(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"a": rng.integers(0, 20, 300).astype(float), "b": rng.normal(size=300)})
    pdf["c"] = pdf["a"] * 2 + rng.normal(size=300)
    pdf.loc[::17, "c"] = np.nan                  # pairwise-complete path
    df = spark.createDataFrame(pdf)
    got = {(r["a"], r["b"]): r["r"] for r in A.corr_spearman(df, ["a", "b", "c"], bound=20, fanout=4).collect()}
    exp = pdf.corr(method="spearman")
    for (x, y), v in got.items():
        assert abs(v - exp.loc[x, y]) < 1e-6


def test_pearson_matrix(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"a": rng.normal(size=200), "b": rng.normal(size=200)})
    got = {(r["a"], r["b"]): r["r"] for r in A.corr_matrix(spark.createDataFrame(pdf), ["a", "b"]).collect()}
    assert abs(got[("a", "b")] - round(pdf.corr().loc["a", "b"], 6)) < 1e-9


def test_average_rank_ties(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 1.0), (4, 7.0)], "k int, v double")
    got = {r["k"]: r["rank"] for r in A.average_rank(df, "v", bound=1, fanout=2).collect()}
    assert got == {1: 2.5, 2: 2.5, 3: 1.0, 4: 4.0}


def test_ranges_are_cut_again_until_small(spark):
    """Three levels at least: every range is under the bound or one value, and ranges are in order."""
    from panelforge.operators import ranges as R
    rng = np.random.default_rng(5)
    v = np.concatenate([rng.lognormal(0, 4, 600), np.full(200, 3.0)])
    pdf = pd.DataFrame({"g": rng.integers(0, 2, len(v)), "v": v})
    held: list = []
    rows = R.cut_ranges(spark.createDataFrame(pdf), "g", "v", bound=10, fanout=4, held=held)
    got = rows.toPandas()
    assert got["__range"].str.len().max() >= 3              # one digit per level
    for g, part in got.groupby("g"):
        sizes = part.groupby("__range").agg(n=("v", "size"), lo=("v", "min"), hi=("v", "max")).sort_index()
        assert ((sizes.n <= 10) | (sizes.lo == sizes.hi)).all()
        assert (sizes.hi.to_numpy()[:-1] < sizes.lo.to_numpy()[1:]).all()
        ranked = A.average_rank(spark.createDataFrame(part[["v"]]), "v", bound=10, fanout=4).toPandas()
        assert (ranked["rank"] == ranked["v"].rank()).all()
    for h in held:
        h.unpersist()


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "x double")
    got = {r["bin"]: r["count"] for r in A.histogram(df, ["x"], n_bins=5).collect()}
    assert sum(got.values()) == 11 and got[4] == 3          # 8, 9, 10 (max falls in the last bin)


def test_exact_quantiles_match_pandas(spark):
    from panelforge.operators.profile import exact_quantiles
    rng = np.random.default_rng(0)
    n = 3001
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], n), "x": rng.normal(size=n),
                        "y": np.where(rng.random(n) < 0.4, 7.0, rng.normal(size=n))})   # a hot value
    got = exact_quantiles(spark.createDataFrame(pdf), ["x", "y"], 0.5, by="g", n_buckets=8, small=20, counted=0)
    assert got == exact_quantiles(spark.createDataFrame(pdf), ["x", "y"], 0.5, by="g")       # counted by value
    for (g, c), v in got.items():
        assert v == pdf[pdf.g == g][c].median()
    assert exact_quantiles(spark.createDataFrame(pdf), ["x"], 0.3)[(None, "x")] == pdf.x.quantile(0.3)


def test_kendall_tau_b_matches_pandas(spark):
    rng = np.random.default_rng(11)
    n = 400
    pdf = pd.DataFrame({"a": rng.integers(0, 12, n).astype(float),            # many ties
                        "b": np.where(rng.random(n) < 0.35, 3.0, rng.normal(size=n)),   # a hot value
                        "c": rng.normal(size=n)})
    pdf.loc[::13, "c"] = np.nan
    got = {(r["a"], r["b"]): r["r"] for r in A.corr_kendall(spark.createDataFrame(pdf), ["a", "b", "c"],
                                                            bound=30, fanout=4).collect()}
    def tau_b(u, v):                       # brute force over all pairs (scipy is not available)
        m = ~(np.isnan(u) | np.isnan(v))
        u, v = u[m], v[m]
        du = np.sign(u[:, None] - u[None, :])
        dv = np.sign(v[:, None] - v[None, :])
        iu = np.triu_indices(len(u), 1)
        s, a, b = (du * dv)[iu].sum(), np.abs(du)[iu].sum(), np.abs(dv)[iu].sum()
        return s / np.sqrt(a * b)
    for (x, y), v in got.items():
        assert abs(v - round(tau_b(pdf[x].to_numpy(), pdf[y].to_numpy()), 6)) < 1e-6


def test_numeric_entry_points(spark):
    df = spark.createDataFrame([(1.0, 2.0, "a"), (2.0, 4.5, "b"), (3.0, 5.0, "c"), (4.0, 9.0, "d")],
                               "x double, y double, s string")
    for method in ("pearson", "spearman", "kendall"):
        got = {(r["a"], r["b"]): r["r"] for r in A.numeric_correlations(df, method).collect()}
        assert set(got) == {("x", "x"), ("x", "y"), ("y", "x"), ("y", "y")}
    assert {r["column"] for r in A.numeric_histograms(df, 4).collect()} == {"x", "y"}
    with pytest.raises(ValueError):
        A.numeric_correlations(df, "nope")
