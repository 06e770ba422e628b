import datetime as dt

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelforge.ml import evaluate as E
from panelforge.ml import families
from panelforge.ml import grid as G
from panelforge.ml import knn as KNN
from panelforge.ml import linear as L
from panelforge.ml import svr as SVR
from panelforge.ml import trees as TR
from panelforge.ml.store import ArtifactStore


def _reg_data(n=400, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2))
    y = 1.5 * x[:, 0] - 1.0 * x[:, 1] + 0.3 + rng.normal(scale=0.5, size=n)
    return pd.DataFrame({"x1": x[:, 0], "x2": x[:, 1], "y": y})


def _np_lasso(x, y, alpha, iters=20000):
    xc, yc = x - x.mean(0), y - y.mean()
    n = len(y)
    w = np.zeros(x.shape[1])
    for _ in range(iters):
        for j in range(len(w)):
            rho = xc[:, j] @ (yc - xc @ w + xc[:, j] * w[j]) / n
            w[j] = np.sign(rho) * max(abs(rho) - alpha, 0) / (xc[:, j] @ xc[:, j] / n)
    return w, y.mean() - x.mean(0) @ w


def test_spark_estimators_match_reference_objectives(spark):
    pdf = _reg_data()
    df = spark.createDataFrame(pdf)
    x, y = pdf[["x1", "x2"]].to_numpy(), pdf["y"].to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    ols = np.linalg.solve(xc.T @ xc, xc.T @ yc)
    m = L.fit_linear(df, kind="linear", params={}, features=["x1", "x2"])
    assert np.allclose(m.coefficients.toArray(), ols, atol=1e-8)
    ridge = np.linalg.solve(xc.T @ xc + 50 * np.eye(2), xc.T @ yc)
    m = L.fit_linear(df, kind="ridge", params={"alpha": 50}, features=["x1", "x2"])
    assert np.allclose(m.coefficients.toArray(), ridge, atol=1e-7)
    lw, lb = _np_lasso(x, y, 0.1)
    m = L.fit_linear(df, kind="lasso", params={"alpha": 0.1}, features=["x1", "x2"])
    assert np.allclose(m.coefficients.toArray(), lw, atol=1e-6) and abs(m.intercept - lb) < 1e-6


def test_grid_from_sufficient_statistics_matches_numpy(spark):
    pdf = _reg_data()
    pdf["fold"] = "f"
    pdf["split"] = np.where(np.arange(len(pdf)) < 300, "train", "validation")
    pdf["entity"] = 1
    pdf["d"] = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(len(pdf))]
    df = spark.createDataFrame(pdf)
    pred = L.linear_grid_predictions(df, [("linear", {}), ("ridge", {"alpha": 10}), ("lasso", {"alpha": 0.5})],
                                     features=["x1", "x2"])
    res = {(r["model"]): r["mae"] for r in E.score(pred, digits=None).collect()}
    tr, va = pdf[pdf.split == "train"], pdf[pdf.split == "validation"]
    x, y = tr[["x1", "x2"]].to_numpy(), tr["y"].to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    for kind, w in (("linear", np.linalg.solve(xc.T @ xc, xc.T @ yc)),
                    ("ridge", np.linalg.solve(xc.T @ xc + 10 * np.eye(2), xc.T @ yc)),
                    ("lasso", _np_lasso(x, y, 0.5)[0])):
        b = y.mean() - x.mean(0) @ w
        mae = np.abs(va["y"].to_numpy() - (va[["x1", "x2"]].to_numpy() @ w + b)).mean()
        assert abs(res[kind] - mae) < 1e-9


def test_fold_average_golden_pair(spark):
    rows = [("0.6-0.7", "m", "{}", 1.0, 2.0), ("0.7-0.8", "m", "{}", 3.0, 4.0), ("0.8-0.9", "m", "{}", 5.0, 9.0),
            ("0.6-0.7", "n", "{}", 1.0, 1.0), ("0.7-0.8", "n", "{}", 1.0, 1.0), ("0.8-0.9", "n", "{}", 1.0, 1.0)]
    res = spark.createDataFrame(rows, "fold string, model string, params string, mse double, mae double")
    board = E.leaderboard(E.fold_average(res)).collect()
    assert [(r["model"], r["mse"], r["mae"]) for r in board] == [("n", 1.0, 1.0), ("m", 3.0, 5.0)]


def test_null_models_and_entity_mae(spark):
    rows = [("f", "train", 1, dt.date(2020, 1, 1), 1.0), ("f", "train", 2, dt.date(2020, 1, 1), 3.0),
            ("f", "validation", 1, dt.date(2020, 1, 2), 2.0), ("f", "validation", 3, dt.date(2020, 1, 2), 4.0)]
    df = spark.createDataFrame(rows, "fold string, split string, entity int, d date, y double")
    s = {r["model"]: r["mae"] for r in E.score(E.null_predictions(df)).collect()}
    assert s["global_mean"] == 1.0          # |2-2|, |4-2|
    assert s["entity_mean"] == 1.0          # entity 3 unseen: skipped
    pred = E.null_predictions(df).where(F.col("model") == "global_mean")
    em = {r["entity"]: r["mae"] for r in E.entity_mae(pred, df).collect()}
    assert em == {1: 0.0, 3: 2.0, 2: 1.0}    # entity 2 has no prediction: overall MAE


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    vecs = rng.normal(size=(120, 8)).astype(np.float32)
    labels = rng.integers(0, 10, 120)
    rows = [(i, [float(v) for v in vecs[i]], int(labels[i])) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    train, query = df.where(F.col("vec_id") >= 20), df.where(F.col("vec_id") < 20)
    neigh = KNN.knn_neighbours(train, query, id_col="vec_id", vec_col="embedding", label="label",
                               kmax=7, block_rows=30)
    got = {(r["vec_id"], r["k"]): r["y_hat"] for r in KNN.knn_predict(neigh, id_col="vec_id", ks=[1, 7]).collect()}
    v64 = vecs.astype(np.float64)
    for q in range(20):
        d = ((v64[20:] - v64[q]) ** 2).sum(1)
        order = np.lexsort((np.arange(20, 120), d))
        for k in (1, 7):
            assert abs(got[(q, k)] - labels[20:][order[:k]].mean()) < 1e-12


def test_svr_objective_close_to_numpy(spark):
    pdf = _reg_data(300, seed=7)
    df = spark.createDataFrame(pdf)
    C, eps = 0.5, 0.1
    w, hist = SVR.fit_linear_svr(df, features=["x1", "x2"], C=C, epsilon=eps)
    X = np.c_[pdf.x1, pdf.x2, np.ones(len(pdf))]
    y = pdf.y.to_numpy()

    def obj(v):
        return 0.5 * v @ v + C * np.maximum(0, np.abs(y - X @ v) - eps).sum()
    # numpy reference: subgradient descent with diminishing steps
    v = np.zeros(3)
    best = obj(v)
    for t in range(1, 20001):
        r = y - X @ v
        g = v - C * (np.sign(r) * (np.abs(r) > eps)) @ X
        v = v - g / (t ** 0.6 * 50)
        best = min(best, obj(v))
    assert obj(w) <= best * 1.01
    assert all(b <= a + 1e-6 * abs(a) for a, b in zip(hist[1:], hist[2:])) or hist[-1] <= hist[0]


def test_trees_beat_null_and_repeat(spark):
    rng = np.random.default_rng(9)
    x = rng.uniform(-2, 2, size=(500, 2))
    y = np.where(x[:, 0] > 0, 3.0, -3.0) + x[:, 1] + rng.normal(scale=0.3, size=500)
    pdf = pd.DataFrame({"x1": x[:, 0], "x2": x[:, 1], "y": y})
    df = spark.createDataFrame(pdf)
    null_mae = np.abs(y - y.mean()).mean()
    rf = TR.fit_forest(df, features=["x1", "x2"], n_estimators=20, max_features="auto", seed=1, max_depth=8)
    p = TR.predict(rf, df, ["x1", "x2"])
    mae = p.agg(F.avg(F.abs(F.col("y") - F.col("y_hat")))).first()[0]
    assert mae < null_mae / 2
    imp = TR.importances(spark, rf, ["x1", "x2"]).collect()
    assert imp[0]["feature"] == "x1"
    ens = TR.fit_adaboost(df, features=["x1", "x2"], n_estimators=8, seed=0, checkpoint_every=3)
    pa = TR.predict_adaboost(ens, df, ["x1", "x2"])
    mae_a = pa.agg(F.avg(F.abs(F.col("y") - F.col("y_hat")))).first()[0]
    assert mae_a < null_mae / 2
    ens2 = TR.fit_adaboost(df, features=["x1", "x2"], n_estimators=8, seed=0, checkpoint_every=3)
    assert [w for _, w in ens] == [w for _, w in ens2]


def test_feature_subset_mapping():
    assert TR.feature_subset("auto", 9) == "all"
    assert TR.feature_subset("log2", 9) == "3" and TR.feature_subset("sqrt", 9) == "3"


def _fold_frame(spark, change=0.0):
    pdf = _reg_data(200)
    pdf["fold"], pdf["entity"] = "f", 1
    pdf["split"] = np.where(np.arange(200) < 150, "train", "validation")
    pdf["d"] = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(200)]
    pdf.loc[3, "y"] += change
    return spark.createDataFrame(pdf)


FAMILY_GRIDS = {"linear": [("linear", {}), ("lasso", {"alpha": 0.1}), ("ridge", {"alpha": 1.0})],
                "svr": [{"C": 1.0, "epsilon": 0.1}, {"C": 0.1, "epsilon": 0.1}],
                "forest": [{"n_estimators": 3, "max_features": "auto"}, {"n_estimators": 2, "max_features": "log2"}],
                "adaboost": [{"n_estimators": 2}, {"n_estimators": 4}],
                "knn": [{"n_neighbors": 3}, {"n_neighbors": 5}]}


def _fits(monkeypatch):
    """Names of the families in the order in which they are fitted."""
    from panelforge.ml import families
    made = []
    for name, family in families.FAMILIES.items():
        def fit(*a, own=type(family).fit, family=family, name=name):
            made.append(name)
            return own(family, *a)
        monkeypatch.setattr(family, "fit", fit, raising=False)
    return made


def test_grid_runner_resumes_from_artefacts(spark, tmp_path, monkeypatch):
    made = _fits(monkeypatch)
    df, features = _fold_frame(spark), ["x1", "x2"]

    def run(frame, grids=FAMILY_GRIDS, **k):
        return G.run_grid(frame, grids, store=ArtifactStore(spark, str(tmp_path)), features=features, study="s", **k)
    part = {"linear": FAMILY_GRIDS["linear"], "forest": FAMILY_GRIDS["forest"][:1]}
    run(df, part)                                                # a run that was stopped early
    assert made == ["linear", "forest"]
    a = sorted(map(tuple, run(df).collect()))
    assert sorted(made[2:]) == ["adaboost", "forest", "knn", "svr"] and len(a) == 50 * 11
    assert sorted(map(tuple, run(df.repartition(5)).collect())) == a and len(made) == 6      # all opened
    # other rows, features or parameters are fitted anew
    run(_fold_frame(spark, 1.0), part)
    assert len(made) == 8
    G.run_grid(df, part, store=ArtifactStore(spark, str(tmp_path)), features=["x1"], study="s")
    assert len(made) == 10
    run(df, {"forest": FAMILY_GRIDS["forest"]}, seed=1)
    assert len(made) == 12


def test_stored_models_predict_unseen_rows_like_the_fitted_ones(spark, tmp_path, monkeypatch):
    made = _fits(monkeypatch)
    df, features = _fold_frame(spark), ["x1", "x2"]
    train = df.where("split = 'train'").select("entity", "d", "y", *features)
    test = df.where("split = 'validation'").select("entity", "d", "y", *features)
    store = ArtifactStore(spark, str(tmp_path))
    want = []
    for name, unit, _, opener in G.fit_units(store, train, FAMILY_GRIDS, features=features, rows="r", study="s", fold="f"):
        p = families.FAMILIES[name].predict(opener(), test, features, ("entity", "d"), unit)
        want += [(r["model"], r["params"], r["d"], r["y"], r["y_hat"]) for r in p.collect()]
    n = len(made)
    got = G.predict_stored(ArtifactStore(spark, str(tmp_path)), "s", "f", test, features=features)
    got = [(r["model"], r["params"], r["d"], r["y"], r["y_hat"]) for r in got.collect()]
    assert len(made) == n and len(got) == 50 * 11
    for a, b in zip(sorted(got), sorted(want)):
        assert a[:4] == b[:4] and abs(a[4] - b[4]) < 1e-12
    entry = next(e for e in store.entries("model", "s", "f") if e["family"] == "adaboost")
    trees = families.FAMILIES["adaboost"].load(spark, entry["path"])
    for n in (2, 4):                                             # a prefix of the ensemble, by itself
        own = {r["d"]: r["y_hat"] for r in TR.predict_adaboost(trees, test, features, n_estimators=n).collect()}
        assert {d: v for m, p, d, _, v in got if p == f'{{"n_estimators": {n}}}' and m == "adaboost"} == own
    some = G.predict_stored(store, "s", "f", test, features=features, grids={"knn": FAMILY_GRIDS["knn"]})
    assert {r["model"] for r in some.select("model").distinct().collect()} == {"knn"}
    with pytest.raises(ValueError, match="no stored model"):
        G.predict_stored(store, "s", "other", test, features=features)


def test_artefact_is_found_only_after_it_was_written(spark, tmp_path):
    store = ArtifactStore(spark, str(tmp_path))

    def stop(model, path):
        spark.range(3).write.parquet(path)
        raise RuntimeError("stopped")
    with pytest.raises(RuntimeError):
        store.get("model", "p", make=lambda: 1, save=stop, load=None)
    assert ArtifactStore(spark, str(tmp_path)).find("model", "p") is None
    made, known = store.get("model", "p", make=lambda: 7, save=lambda m, path: spark.range(m).write.parquet(path),
                            load=None, study="s", fold="f")
    assert (made, known) == (7, False)
    opened, known = ArtifactStore(spark, str(tmp_path)).get("model", "p", make=None, save=None,
                                                            load=lambda p: spark.read.parquet(p).count())
    assert (opened, known) == (7, True)
    assert [e["fold"] for e in store.entries("model", "s")] == ["f"] and store.entries("model", "s", "g") == []


def test_rows_fingerprint(spark):
    from panelforge.ml.store import rows_fingerprint as fp
    a = spark.createDataFrame([(1, None), (None, 1), (2, 3)], "x int, y int")
    assert fp(a, ["x", "y"]) == fp(a.orderBy("x").repartition(3), ["x", "y"])
    others = [a.select("y", "x"), a.limit(0), a.unionAll(a), a.where("x = 2 or y = 1"),
              spark.createDataFrame([(1, None), (1, None), (2, 3)], "x int, y int"),
              a.withColumn("x", F.col("x").cast("long"))]
    assert len({fp(o, o.columns) for o in others} | {fp(a, ["x", "y"])}) == 7


def test_preparation_of_unseen_rows(spark, tmp_path):
    from panelforge.ml import prep as M
    rng = np.random.default_rng(2)
    rows = [(s, None if rng.random() < .2 else float(rng.normal(3, 2)), float(rng.normal()), 4.0, None)
            for s in ["train"] * 40 + ["validation"] * 9 + ["test"] * 12]
    df = spark.createDataFrame(rows, "split string, a double, b double, c double, e double")
    cols = ["a", "b", "c", "e"]
    for pca in (False, True):
        fitted = M.fit_preparation(df.where("split <> 'test'"), columns=cols, with_pca=pca, threshold=0.6)
        fitted.save(spark, f"{tmp_path}/{pca}")
        opened = M.Preparation.load(spark, f"{tmp_path}/{pca}")
        assert opened.statistics() == fitted.statistics() and opened.features == fitted.features
        got = np.array([list(r)[1:] for r in opened.apply(df.where("split = 'test'")).collect()], float)
        x = np.array([[np.nan if v is None else v for v in r[1:]] for r in rows], float)
        tr = x[:40]
        med = np.array([np.nanmedian(tr[:, j]) if not np.isnan(tr[:, j]).all() else 0.0 for j in range(4)])
        fill = lambda m: np.where(np.isnan(m), med, m)
        std = fill(tr).std(axis=0)
        want = (fill(x[49:]) - fill(tr).mean(axis=0)) / np.where(std > 0, std, 1.0)
        if pca:
            z = (fill(tr) - fill(tr).mean(axis=0)) / np.where(std > 0, std, 1.0)
            e, v = np.linalg.eigh(np.cov(z.T))
            v = v[:, ::-1][:, :opened.kept]
            want = want @ v
            want = want * np.sign((want * got).sum(axis=0))     # the largest loadings may be equal
        assert np.allclose(got, want, atol=1e-9)


def test_group_min_mixes_rows_but_best_is_row_consistent(spark):
    """The reference's per-model minimum takes each column's minimum separately;
    the best-per-model table keeps one whole row (min MAE, ties by params)."""
    from panelforge.operators import profile as A
    res = spark.createDataFrame([("m", '{"a": 1}', 5.0, 1.0), ("m", '{"a": 2}', 2.0, 3.0)],
                                "model string, params string, mse double, mae double")
    mixed = A.group_min(res, "model", ["params", "mse", "mae"]).first()
    assert (mixed["mse"], mixed["mae"]) == (2.0, 1.0)            # from different rows
    best = E.best_per_model(res).first()
    assert (best["params"], best["mse"], best["mae"]) == ('{"a": 1}', 5.0, 1.0)


@pytest.mark.parametrize("scale, C, eps", [(1.0, 0.5, 0.1), (100.0, 0.1, 0.1), (0.01, 5.0, 0.001)])
def test_svr_reaches_the_dual_optimum_at_any_scale(spark, scale, C, eps):
    rng = np.random.default_rng(11)
    n = 60
    X = scale * np.c_[rng.normal(size=n) + 5, 3 * rng.normal(size=n)]
    y = X @ [1.5, -0.5] + scale * rng.standard_t(3, size=n) + 7 * scale
    df = spark.createDataFrame(pd.DataFrame({"x1": X[:, 0], "x2": X[:, 1], "y": y}))
    w, _ = SVR.fit_linear_svr(df, features=["x1", "x2"], C=C, epsilon=eps)
    # any a in [-C, C] bounds the optimum from below; rows on the tube's edge take what makes sum a*x equal w
    Xi = np.c_[X, np.ones(n)]
    r = y - Xi @ w
    primal = 0.5 * w @ w + C * np.maximum(np.abs(r) - eps, 0).sum()
    edge = np.argsort(np.abs(np.abs(r) - eps))[:3]
    a = C * np.sign(r) * (np.abs(r) > eps)
    a[edge] = 0.0
    a[edge] = np.linalg.lstsq(Xi[edge].T, w - a @ Xi, rcond=None)[0]
    a = np.clip(a, -C, C)
    v = a @ Xi
    dual = -0.5 * v @ v + a @ y - eps * np.abs(a).sum()
    assert primal - dual <= 1e-4 * primal
    assert np.abs(w).max() > 0


def test_svr_raises_when_out_of_passes(spark):
    df = spark.createDataFrame(_reg_data(100, seed=3))
    with pytest.raises(SVR.SVRNotConverged):
        SVR.fit_linear_svr(df, features=["x1", "x2"], C=0.5, epsilon=0.1, max_passes=3)


@pytest.mark.parametrize("fan_in", [256, 1])
def test_gram_blocks_do_not_cancel(spark, fan_in, monkeypatch):
    monkeypatch.setattr(L, "GRAM_FAN_IN", fan_in)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 2)) + 1e8
    y = (x[:, 0] - 1e8) * 2 - (x[:, 1] - 1e8) + rng.normal(size=3000) * 0.1 + 1e8
    pdf = pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "y": y, "g": np.where(np.arange(3000) % 3 == 0, "p", "q")})
    df = spark.createDataFrame(pdf).unionByName(spark.createDataFrame(
        [(None, 1.0, 1.0, "p"), (1.0, 1.0, None, "q"), (5.0, 6.0, 7.0, None)],
        "a double, b double, y double, g string")).repartition(5)
    got = L.gram_by_group(df, ["a", "b"], "y", "g")
    assert set(got) == {"p", "q", None} and got[None][0] == 1 and not got[None][3].any()
    for g in ("p", "q"):
        z = pdf[pdf.g == g][["a", "b", "y"]].to_numpy() - 1e8        # exact: the shift is a whole number
        c = np.cov(z.T, bias=True) * len(z)
        n, mx, my, sxx, sxy = got[g]
        assert n == len(z) and np.allclose(sxx, c[:2, :2], rtol=1e-6) and np.allclose(sxy, c[:2, 2], rtol=1e-6)
        assert np.allclose([*mx, my], z.mean(axis=0) + 1e8, rtol=1e-14)
    assert L.gram_by_group(df.limit(0), ["a", "b"], "y", "g") == {}


def test_svr_search_asks_for_few_steps_and_finds_the_best_of_all():
    """A search pass sums the loss at 4 step lengths (25 before), the shorter ones only when the least may be there."""
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.normal(50, 20, 400), np.ones(400)])
    y = 3 * x[:, 0] + rng.normal(0, 30, 400)
    f, asked = SVR._Fit(2, 1.0, 0.1, float(np.abs(y).max())), []
    for _ in range(100):
        if f.done:
            break
        w, step, eps, mu, lengths = f.task()
        sums = SVR._partial_sums({("all", 0): f.task()}, 2)
        batch = pa.RecordBatch.from_arrays([pa.array(["all"] * 400), pa.array(x[:, 0]), pa.array(y)], ["g", "x0", "y"])
        out, = sums([batch])
        v = np.array(out.column(2)[0].as_py())
        if lengths:
            asked.append(len(lengths))
            known = f.losses + list(v[len(v) - len(lengths):])
            every = []
            for t in (0.0, *SVR.STEPS):
                u = np.maximum(np.abs(y - x @ (w + t * step)) - eps, 0.0)
                every.append(0.5 * float((w + t * step) @ (w + t * step))
                             + float(np.where(u <= mu, u * u / (2 * mu), u - mu / 2).sum()))
            f.update(v, 1e-6)
            if not f.lengths:
                seen = every[:len(known)]
                assert min(seen) <= min(every) * (1 + 1e-12)
        else:
            f.update(v, 1e-6)
    assert f.done and asked and set(asked) <= {4, 21}


def test_held_frame_uses_every_core(spark):
    """A frame that its windows leave in one partition is dealt out for the passes of a fit."""
    from panelforge.plans import ml_queries as Q

    def one_partition(spark, sf_dir):
        return spark.range(100_000).coalesce(1)

    with Q.held_frame(spark, "", frame=one_partition) as frame:
        assert frame.count() == 100_000 and frame.rdd.getNumPartitions() == 4


def test_knn_block_group_gives_one_list_per_query():
    """The nearest rows over all blocks of a group, and rows as far as the last of them, not a list per block."""
    rng = np.random.default_rng(3)
    q, blocks = rng.integers(-20, 20, (40, 2)) / 8, [rng.integers(-9, 9, (n, 2)) / 4 for n in (5, 30, 200, 90)]
    pairs = pd.DataFrame([{"part": 0, "q_id": [f"q{i}" for i in range(40)], "q_vec": q.ravel(),
                           "t_id": [f"{b}-{i:03d}" for i in range(len(t))], "t_vec": t.ravel(), "t_y": np.arange(len(t)) + 0.5}
                          for b, t in enumerate(blocks)])
    got = KNN._group_lists(7)(pairs)
    rows = [(x, f"{b}-{i:03d}", i + 0.5) for b, t in enumerate(blocks) for i, x in enumerate(t)]
    assert got["id"].tolist() == [f"q{i}" for i in range(40)]
    for x, r in zip(q, got.itertuples()):
        want = sorted((float((x - v) @ (x - v)), i, y) for v, i, y in rows)[:7]
        assert sorted(zip(r.d, r.i, r.y))[:7] == want and max(r.d) == want[-1][0]


def test_knn_by_boxes_equals_all_pairs(spark, monkeypatch):
    """Boxes leave out far training rows and give the same neighbours, with copies and ties."""
    rng = np.random.default_rng(8)
    xy = np.r_[np.round(rng.normal(50, 20, (1500, 2)), 1), np.full((300, 2), 50.0)]
    rows = pd.DataFrame({"id": np.arange(1800), "v": list(xy), "y": rng.normal(size=1800)})
    train, query = (spark.createDataFrame(rows[m]) for m in (rows.id % 4 != 0, rows.id % 4 == 0))
    monkeypatch.setattr(KNN, "BOX_ROWS", {"t_": 20, "q_": 10})
    compared = []
    near_blocks = KNN._near_blocks

    def seen(t, q, *args):
        out = near_blocks(t, q, *args)
        compared.append((out.count(), t.select("__block").distinct().count() * q.select("__block").distinct().count()))
        return out
    monkeypatch.setattr(KNN, "_near_blocks", seen)
    got, want = (sorted(KNN.knn_neighbours(train, query, id_col="id", vec_col="v", label="y", kmax=7, box_pairs=b)
                        .select("id", "best_d", "best_id", "best_y").collect()) for b in (0, 1e18))
    assert got == want and len(got) == 450
    (near, every), = compared
    assert near < every / 2
