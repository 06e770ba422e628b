"""Query keys of the forecasting study (M1-M23) on the PANEL_N model frame
and the embeddings table."""

from __future__ import annotations

import math
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as X
from ..ml import evaluate as E
from ..ml import grid as G
from ..ml import knn as KNN
from ..ml import linear as L
from ..ml import prep as M
from ..ml import split as S
from ..ml import svr as SVR
from ..ml import trees as TR
from ..ml import zoo as Z
from ..ml.store import ArtifactStore, rows_fingerprint
from ..operators import columns as C
from .bindings import EVENT_TYPES, model_frame, panel_e, panel_n, with_ctes
from .catalog import register

FOLD_NAMES = [f"{lo:.1f}-{hi:.1f}" for lo, hi in S.DEFAULT_FOLDS]
LAST_FOLD = FOLD_NAMES[-1]


# ---- shared pieces -------------------------------------------------------

def folded(spark, sf_dir) -> DataFrame:
    return S.cv_folds(model_frame(spark, sf_dir), date="d")


# Rows of a task in fits that pass over the model frame many times: at least (while cores are free) and at most.
TASK_ROWS = (20_000, 400_000)
# The bootstrap of a forest depends on the partitions: frames of a usual size keep theirs.
FOREST_TASK_ROWS = (100_000, 400_000)


@contextmanager
def held_frame(spark, sf_dir, task_rows=TASK_ROWS, frame=model_frame):
    """The model frame, computed once and kept while a fit passes over it.

    Its windows leave it in as many partitions as there are entities, or fewer;
    a larger frame is dealt out again, so its passes use every core."""
    mf = frame(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    held = [mf]
    try:
        rows = mf.count()
        most, least = (math.ceil(rows / n) for n in task_rows)
        parts = max(least, min(most, spark.sparkContext.defaultParallelism))
        if parts > mf.rdd.getNumPartitions():
            held.append(mf.repartition(parts).persist(StorageLevel.MEMORY_AND_DISK))
        yield held[-1]
    finally:
        for df in held:
            df.unpersist()


def _kept(spark, scores: DataFrame) -> DataFrame:
    """A score table (a row per grid point and fold) as rows of its own, apart from the frame it comes from."""
    return spark.createDataFrame(scores.collect(), scores.schema)


def _fold_sql_ctes() -> str:
    """SQL: model frame, cut-offs, folds (train/validation) and the test rows."""
    qs = (0.6, 0.7, 0.8, 0.9)
    cut = ", ".join(f"floor(quantile_cont(dn, {q}) + 1e-9) AS c{int(q * 100)}" for q in qs)
    folds = " UNION ALL ".join(
        f"SELECT '{lo:.1f}-{hi:.1f}' AS fold, m.*, CASE WHEN dn <= c{int(lo * 100)} THEN 'train' "
        f"WHEN dn <= c{int(hi * 100)} THEN 'validation' END AS split FROM mfd m, cut"
        for lo, hi in S.DEFAULT_FOLDS)
    return with_ctes(f""", mfd AS (SELECT *, date_diff('day', DATE '1970-01-01', d) AS dn FROM mf),
cut AS (SELECT {cut} FROM mfd),
folded AS (SELECT * FROM ({folds}) t WHERE split IS NOT NULL),
testset AS (SELECT m.* FROM mfd m, cut WHERE dn > c90),
trainlast AS (SELECT m.* FROM mfd m, cut WHERE dn <= c80)
""", "mf").replace("\n, mfd", ", mfd")


def _cfg_values(grid) -> str:
    rows = []
    for kind, params in grid:
        a = params.get("alpha")
        rows.append(f"('{kind}', '{G.params_text(params)}', {('CAST(' + repr(float(a)) + ' AS DOUBLE)') if a is not None else 'CAST(NULL AS DOUBLE)'})")
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") t(model, params, alpha)"


def _one_feature_sql(train_rel: str, eval_rel: str, feat: str, grid, by_fold: bool = True,
                     sfx: str = "") -> str:
    """Closed-form one-feature fits (least squares, ridge, lasso) + predictions.
    CTE names get ``sfx`` so several variants can share one query."""
    fk = "fold, " if by_fold else ""
    join = "t.fold = w.fold AND " if by_fold else ""
    gb = "GROUP BY fold" if by_fold else ""
    return f"""st{sfx} AS (SELECT {fk}regr_count(y, {feat}) AS n, regr_avgx(y, {feat}) AS mx, regr_avgy(y, {feat}) AS my,
              regr_sxx(y, {feat}) AS sxx, regr_sxy(y, {feat}) AS sxy FROM {train_rel} {gb}),
cfg{sfx} AS ({_cfg_values(grid)}),
wt{sfx} AS (SELECT st.*, cfg.model, cfg.params,
              CASE cfg.model WHEN 'linear' THEN sxy / sxx
                             WHEN 'ridge' THEN sxy / (sxx + cfg.alpha)
                             ELSE sign(sxy / n) * greatest(abs(sxy / n) - cfg.alpha, 0) / (sxx / n) END AS w
         FROM st{sfx} st, cfg{sfx} cfg),
pred{sfx} AS (SELECT {'w.fold, ' if by_fold else ''}w.model, w.params, t.entity, t.d, t.y,
                w.w * t.{feat} + (w.my - w.w * w.mx) AS y_hat
           FROM {eval_rel} t JOIN wt{sfx} w ON {join}TRUE)"""


def linear_predictions(spark, sf_dir, feature: str = "x", grid=None) -> DataFrame:
    """All linear grid points on all folds from one pass of sufficient statistics."""
    grid = grid or G.linear_grid()
    f = folded(spark, sf_dir)
    return L.linear_grid_predictions(f, grid, features=[feature], label="y")


def _grid_results(spark, sf_dir, feature="x", digits=6):
    return E.score(linear_predictions(spark, sf_dir, feature), digits=digits)


# ---- splits ---------------------------------------------------------------

@register("split_time", with_ctes(""", cut AS (SELECT floor(quantile_cont(date_diff('day', DATE '1970-01-01', d), 0.9) + 1e-9) AS c FROM panel_n)
SELECT entity, d, CASE WHEN date_diff('day', DATE '1970-01-01', d) <= c THEN 'train' ELSE 'test' END AS split
  FROM panel_n, cut""", "panel_n").replace("\n, cut", ", cut"))
def split_time(spark, sf_dir):
    return S.split_time(panel_n(spark, sf_dir).select("entity", "d"), date="d", test_size=0.1)


@register("split_time_validation", with_ctes(""", cut AS (
  SELECT floor(quantile_cont(dn, 0.9) + 1e-9) AS ct, floor(quantile_cont(dn, 0.7) + 1e-9) AS lo,
         floor(quantile_cont(dn, 0.8) + 1e-9) AS hi
    FROM (SELECT date_diff('day', DATE '1970-01-01', d) AS dn FROM panel_n) t)
SELECT entity, d, CASE WHEN dn <= lo THEN 'train' WHEN dn <= hi THEN 'validation' WHEN dn > ct THEN 'test' END AS split
  FROM (SELECT entity, d, date_diff('day', DATE '1970-01-01', d) AS dn FROM panel_n) p, cut""",
                                             "panel_n").replace("\n, cut", ", cut"))
def split_time_validation(spark, sf_dir):
    return S.split_time(panel_n(spark, sf_dir).select("entity", "d"), date="d", test_size=0.1,
                        validation=(0.7, 0.8))


@register("cv_folds", _fold_sql_ctes() + "SELECT entity, d, fold, split FROM folded")
def cv_folds(spark, sf_dir):
    return folded(spark, sf_dir).select("entity", "d", "fold", "split")


@register("split_random", with_ctes(""", h AS (
  SELECT entity, d, ('0x' || substr(md5('1|' || CAST(entity AS VARCHAR) || '|' || CAST(d AS VARCHAR)), 1, 13))::BIGINT AS hv,
         CAST(entity AS VARCHAR) || '|' || CAST(d AS VARCHAR) AS kt FROM panel_n)
SELECT entity, d, CASE WHEN row_number() OVER (ORDER BY hv, kt) <= ceil(0.1 * count(*) OVER ()) THEN 'test'
                       ELSE 'train' END AS split FROM h""", "panel_n").replace("\n, h", ", h"))
def split_random(spark, sf_dir):
    return S.split_random(panel_n(spark, sf_dir).select("entity", "d"), keys=["entity", "d"],
                          test_size=0.1, seed=1)


# ---- preparation ----------------------------------------------------------

def _prep_frame(spark, sf_dir):
    """PANEL_E split in time with a validation window (gaps are real)."""
    p = panel_e(spark, sf_dir).drop("parent")
    s = S.split_time(p, date="d", test_size=0.1, validation=(0.7, 0.8))
    return s.where(F.col("split").isNotNull())


_PREP_SQL = with_ctes(""", pe AS (SELECT *, date_diff('day', DATE '1970-01-01', d) AS dn FROM panel_e),
cut AS (SELECT floor(quantile_cont(dn, 0.9) + 1e-9) AS ct, floor(quantile_cont(dn, 0.7) + 1e-9) AS lo,
               floor(quantile_cont(dn, 0.8) + 1e-9) AS hi FROM pe),
sp AS (SELECT * FROM (SELECT pe.entity, pe.d, """ + ", ".join(EVENT_TYPES) + """,
              CASE WHEN dn <= lo THEN 'train' WHEN dn <= hi THEN 'validation' WHEN dn > ct THEN 'test' END AS split
         FROM pe, cut) t WHERE split IS NOT NULL)
""", "panel_e").replace("\n, pe", ", pe")


def _impute_sql(stat: str) -> str:
    stats = ", ".join(f"{stat}({c}) AS {c}" for c in EVENT_TYPES)
    cols = ", ".join(
        f"COALESCE(CAST(sp.{c} AS DOUBLE), CASE WHEN sp.split = 'validation' THEN v.{c} ELSE t.{c} END) AS {c}"
        for c in EVENT_TYPES)
    return _PREP_SQL + f""", tst AS (SELECT {stats} FROM sp WHERE split = 'train'),
vst AS (SELECT {stats} FROM sp WHERE split = 'validation')
SELECT sp.entity, sp.d, {cols}, sp.split FROM sp, tst t, vst v"""


@register("impute_median", _impute_sql("median"))
def impute_median(spark, sf_dir):
    return M.impute(_prep_frame(spark, sf_dir), columns=EVENT_TYPES, how="median")


@register("impute_mean", _impute_sql("avg"))
def impute_mean(spark, sf_dir):
    return M.impute(_prep_frame(spark, sf_dir), columns=EVENT_TYPES, how="mean")


@register("impute_constant", _PREP_SQL + "SELECT entity, d, "
          + ", ".join(f"COALESCE(CAST({c} AS DOUBLE), -1.0) AS {c}" for c in EVENT_TYPES) + ", split FROM sp")
def impute_constant(spark, sf_dir):
    return M.impute(_prep_frame(spark, sf_dir), columns=EVENT_TYPES, how=-1.0)


def _std_sql():
    imp = _impute_sql("median").split("SELECT sp.entity")[0]
    cols = ", ".join(f"COALESCE(CAST(sp.{c} AS DOUBLE), CASE WHEN sp.split = 'validation' THEN v.{c} ELSE t.{c} END) AS {c}"
                     for c in EVENT_TYPES)
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in EVENT_TYPES)
    zs = ", ".join(f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 1 ELSE s_{c} END, 6) AS {c}"
                   for c in EVENT_TYPES)
    return imp + f""", imp AS (SELECT sp.entity, sp.d, {cols}, sp.split FROM sp, tst t, vst v),
ms AS (SELECT {stats} FROM imp WHERE split = 'train')
SELECT entity, d, {zs}, split FROM imp, ms"""


def _standardized(spark, sf_dir):
    imp = M.impute(_prep_frame(spark, sf_dir), columns=EVENT_TYPES, how="median")
    return M.standardize(imp, columns=EVENT_TYPES)


@register("standardize", _std_sql())
def standardize(spark, sf_dir):
    z = _standardized(spark, sf_dir)
    return z.select("entity", "d", *[F.round(c, 6).alias(c) for c in EVENT_TYPES], "split")


def _pca_var_sql():
    base = _std_sql().split("SELECT entity, d, round(")[0]
    return base + """, r AS (SELECT abs(corr(click, view)) AS r FROM imp WHERE split = 'train')
SELECT 1 AS component, round((1 + r) / 2, 6) AS explained_ratio FROM r
UNION ALL SELECT 2 AS component, round((1 - r) / 2, 6) AS explained_ratio FROM r"""


@register("pca_variance", _pca_var_sql())
def pca_variance(spark, sf_dir):
    z = _standardized(spark, sf_dir)
    model, m, signs = M.fit_pca(z, columns=["click", "view"], k=2, threshold=0.0)
    ev = [float(v) for v in model.explainedVariance.toArray()]
    rows = [(i + 1, round(v, 6)) for i, v in enumerate(ev)]
    # a two-row statistic derived from the fitted model
    return spark.createDataFrame(rows, "component int, explained_ratio double")


@register("pca_project")
def pca_project(spark, sf_dir):
    z = _standardized(spark, sf_dir)
    model, m, signs = M.fit_pca(z, columns=EVENT_TYPES, k=5, threshold=0.95)
    return M.pca_project(z, model, m, signs, columns=EVENT_TYPES)


@register("pca_project_pair", _std_sql().split("SELECT entity, d, round(")[0] + """, zs AS (
  SELECT entity, d, split, (click - m_click) / s_click AS a, (view - m_view) / s_view AS b FROM imp, ms),
r AS (SELECT corr(click, view) AS r FROM imp WHERE split = 'train')
SELECT entity, d, split, round(abs(a + sign(r) * b) / sqrt(2), 6) AS pc1_size,
       round(abs(a - sign(r) * b) / sqrt(2), 6) AS pc2_size FROM zs, r""")
def pca_project_pair(spark, sf_dir):
    """Two standardised columns: the components are (a + b) / sqrt 2 and (a - b) / sqrt 2, signs aside."""
    pair = ["click", "view"]
    z = _standardized(spark, sf_dir).select("entity", "d", "split", *pair)
    model, _, signs = M.fit_pca(z, columns=pair, k=2, threshold=0.0)
    p = M.pca_project(z, model, 2, signs, columns=pair)
    return p.select("entity", "d", "split", *[F.round(F.abs(f"pc{i}"), 6).alias(f"pc{i}_size") for i in (1, 2)])


# ---- linear family: one-feature fits vs closed forms ------------------------

def _fit_sql(kind: str, alpha: float | None) -> str:
    grid = [(kind, {"alpha": alpha} if alpha is not None else {})]
    return with_ctes(", " + _one_feature_sql("mf", "mf", "x", grid, by_fold=False)
                     + "\nSELECT model, params, round(w, 6) AS slope, round(my - w * mx, 6) AS intercept FROM wt",
                     "mf")


def _fit_spark(spark, sf_dir, kind, alpha):
    mf = model_frame(spark, sf_dir)
    params = {"alpha": alpha} if alpha is not None else {}
    m = L.fit_linear(mf, kind=kind, params=params, features=["x"])
    row = [(kind, G.params_text(params), round(float(m.coefficients[0]), 6), round(float(m.intercept), 6))]
    return spark.createDataFrame(row, "model string, params string, slope double, intercept double")


@register("fit_linear", _fit_sql("linear", None))
def fit_linear(spark, sf_dir):
    return _fit_spark(spark, sf_dir, "linear", None)


@register("fit_linear_pair", with_ctes(""", s AS (
  SELECT avg(x) AS m1, avg(x7) AS m2, avg(y) AS my, var_pop(x) AS s11, var_pop(x7) AS s22, covar_pop(x, x7) AS s12,
         covar_pop(x, y) AS s1y, covar_pop(x7, y) AS s2y FROM mf),
w AS (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS w1,
             (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS w2 FROM s)
SELECT round(w1, 6) AS slope_x, round(w2, 6) AS slope_x7, round(my - w1 * m1 - w2 * m2, 6) AS intercept FROM w""", "mf"))
def fit_linear_pair(spark, sf_dir):
    """Least squares on two features from the merged Gram blocks, against the normal equations."""
    mf = model_frame(spark, sf_dir).withColumn("g", F.lit("all"))
    w, b = L.solve_linear("linear", {}, L.gram_by_group(mf, ["x", "x7"], "y", "g")["all"])
    row = [(round(float(w[0]), 6), round(float(w[1]), 6), round(b, 6))]
    return spark.createDataFrame(row, "slope_x double, slope_x7 double, intercept double")


@register("fit_lasso", _fit_sql("lasso", 0.5))
def fit_lasso(spark, sf_dir):
    return _fit_spark(spark, sf_dir, "lasso", 0.5)


@register("fit_ridge", _fit_sql("ridge", 1000.0))
def fit_ridge(spark, sf_dir):
    return _fit_spark(spark, sf_dir, "ridge", 1000.0)


# ---- grid, scores, leaderboards ---------------------------------------------

_GRID_SQL_BODY = _one_feature_sql("(SELECT * FROM folded WHERE split = 'train')",
                                  "(SELECT * FROM folded WHERE split = 'validation')", "x", G.linear_grid())
_GRID_CTES = _fold_sql_ctes() + ", " + _GRID_SQL_BODY + """,
res AS (SELECT fold, model, params, avg((y - y_hat) * (y - y_hat)) AS mse, avg(abs(y - y_hat)) AS mae
          FROM pred GROUP BY fold, model, params)
"""


@register("grid_search_linear", _GRID_CTES + "SELECT fold, model, params, round(mse, 6) AS mse, round(mae, 6) AS mae FROM res")
def grid_search_linear(spark, sf_dir):
    return _grid_results(spark, sf_dir)


@register("fold_average", _GRID_CTES
          + "SELECT model, params, round(avg(mse), 6) AS mse, round(avg(mae), 6) AS mae FROM res GROUP BY model, params")
def fold_average(spark, sf_dir):
    return E.fold_average(_grid_results(spark, sf_dir, digits=None))


@register("leaderboard", _GRID_CTES
          + "SELECT model, params, round(avg(mse), 6) AS mse, round(avg(mae), 6) AS mae FROM res "
            "GROUP BY model, params ORDER BY mae, model, params")
def leaderboard(spark, sf_dir):
    return E.leaderboard(E.fold_average(_grid_results(spark, sf_dir, digits=None)))


_NULL_CTES = _fold_sql_ctes() + """, gm AS (SELECT fold, avg(y) AS y_hat FROM folded WHERE split = 'train' GROUP BY fold),
em AS (SELECT fold, entity, avg(y) AS y_hat FROM folded WHERE split = 'train' GROUP BY fold, entity),
npred AS (
  SELECT v.fold, 'global_mean' AS model, v.entity, v.d, v.y, g.y_hat
    FROM folded v LEFT JOIN gm g ON v.fold = g.fold WHERE v.split = 'validation'
  UNION ALL
  SELECT v.fold, 'entity_mean' AS model, v.entity, v.d, v.y, e.y_hat
    FROM folded v LEFT JOIN em e ON v.fold = e.fold AND v.entity = e.entity WHERE v.split = 'validation'),
tgm AS (SELECT avg(y) AS y_hat FROM mfd, cut WHERE dn <= c90),
tem AS (SELECT entity, avg(y) AS y_hat FROM mfd, cut WHERE dn <= c90 GROUP BY entity)
"""


@register("score_mse_mae", _NULL_CTES + """
SELECT fold, model, '{}' AS params, round(avg((y - y_hat) * (y - y_hat)), 6) AS mse, round(avg(abs(y - y_hat)), 6) AS mae
  FROM npred GROUP BY fold, model""")
def score_mse_mae(spark, sf_dir):
    return E.score(E.null_predictions(folded(spark, sf_dir)))


def _null_test(spark, sf_dir, model: str) -> DataFrame:
    mf = model_frame(spark, sf_dir)
    cut = S.cutoff_days(mf, "d", [0.9])[0.9]
    day = S.day_number("d")
    tr, te = mf.where(day <= cut), mf.where(day > cut)
    if model == "global_mean":
        pred = te.withColumn("y_hat", F.lit(tr.agg(F.avg("y")).first()[0]))
    else:
        e = tr.groupBy("entity").agg(F.avg("y").alias("y_hat"))
        pred = te.join(e, "entity", "left")
    return pred.select(F.lit("test").alias("fold"), F.round(F.avg(F.abs(F.col("y") - F.col("y_hat"))), 6).alias("mae"))


def _null_mae(spark, sf_dir, model: str) -> DataFrame:
    s = E.score(E.null_predictions(folded(spark, sf_dir)).where(F.col("model") == model))
    return s.select("fold", "mae").unionByName(_null_test(spark, sf_dir, model))


@register("null_global_mean", _NULL_CTES + """
SELECT fold, round(avg(abs(y - y_hat)), 6) AS mae FROM npred WHERE model = 'global_mean' GROUP BY fold
UNION ALL SELECT 'test' AS fold, round(avg(abs(t.y - g.y_hat)), 6) AS mae FROM testset t, tgm g""")
def null_global_mean(spark, sf_dir):
    return _null_mae(spark, sf_dir, "global_mean")


@register("null_entity_mean", _NULL_CTES + """
SELECT fold, round(avg(abs(y - y_hat)), 6) AS mae FROM npred WHERE model = 'entity_mean' GROUP BY fold
UNION ALL SELECT 'test' AS fold, round(avg(abs(t.y - e.y_hat)), 6) AS mae
  FROM testset t LEFT JOIN tem e ON t.entity = e.entity""")
def null_entity_mean(spark, sf_dir):
    return _null_mae(spark, sf_dir, "entity_mean")


@register("null_cv_average", _NULL_CTES + """
SELECT model, round(avg(mae), 6) AS mae FROM (
  SELECT fold, model, avg(abs(y - y_hat)) AS mae FROM npred GROUP BY fold, model) t GROUP BY model""")
def null_cv_average(spark, sf_dir):
    s = E.score(E.null_predictions(folded(spark, sf_dir)), digits=None)
    return s.groupBy("model").agg(F.round(F.avg("mae"), 6).alias("mae"))


# ---- test-set scoring of the last fold's models ---------------------------

_TEST_GRID = [("linear", {}), ("lasso", {"alpha": 0.1}), ("ridge", {"alpha": 10.0})]


def _test_predictions(spark, mf, features, grids: dict) -> DataFrame:
    """The last fold's models are fitted and stored, then opened from the store and applied to the test rows."""
    from ..session import scratch_path
    cut = S.cutoff_days(mf, "d", [0.8, 0.9])
    day = S.day_number("d")
    cols = ["entity", "d", "y", *features]
    train, test = mf.where(day <= cut[0.8]).select(cols), mf.where(day > cut[0.9]).select(cols)
    store = ArtifactStore(spark, scratch_path(spark, "models"))
    rows = rows_fingerprint(train, cols)
    for _, _, _, opener in G.fit_units(store, train, grids, features=features, rows=rows, study=rows, fold=LAST_FOLD):
        opener()
    return G.predict_stored(ArtifactStore(spark, store.root), rows, LAST_FOLD, test, features=features)


_TEST_CTES = (_fold_sql_ctes() + ", "
              + _one_feature_sql("trainlast", "testset", "x", _TEST_GRID, by_fold=False, sfx="_x") + ",\n"
              + _one_feature_sql("trainlast", "testset", "x7", _TEST_GRID, by_fold=False, sfx="_x7") + "\n")


@register("score_test", _fold_sql_ctes() + ", "
          + _one_feature_sql("trainlast", "testset", "x", G.linear_grid(), by_fold=False) + """
SELECT model, params, round(avg((y - y_hat) * (y - y_hat)), 6) AS mse, round(avg(abs(y - y_hat)), 6) AS mae
  FROM pred GROUP BY model, params""")
def score_test(spark, sf_dir):
    with held_frame(spark, sf_dir) as mf:
        pred = _test_predictions(spark, mf, ["x"], {"linear": G.linear_grid()})
        return _kept(spark, E.score(pred, by=("model", "params")))


@register("score_test_families")
def score_test_families(spark, sf_dir):
    """Stored SVR, kNN, AdaBoost and forest models on the test rows: all points of the first three grids, and the
    smallest forest of each feature rule."""
    grids = {"svr": Z.SVR_GRID, "knn": Z.KNN_GRID, "adaboost": Z.ADABOOST_GRID,
             "forest": [p for p in Z.FOREST_GRID if p["n_estimators"] == min(q["n_estimators"] for q in Z.FOREST_GRID)]}
    with held_frame(spark, sf_dir, FOREST_TASK_ROWS) as mf:
        return _kept(spark, E.score(_test_predictions(spark, mf, ["x", "x7"], grids), by=("model", "params")))


def _label_sql(rel: str, v: int) -> str:
    return f"SELECT model || ' - v{v}' AS label, y, y_hat FROM {rel}"


@register("test_mae", _TEST_CTES + f"""
SELECT label, split_part(label, ' - ', 1) AS model, right(label, 1) AS version, round(avg(abs(y - y_hat)), 6) AS mae
  FROM ({_label_sql('pred_x', 1)} UNION ALL {_label_sql('pred_x7', 2)}) t GROUP BY label""")
def test_mae(spark, sf_dir):
    with held_frame(spark, sf_dir) as mf:
        parts = []
        for v, feat in ((1, "x"), (2, "x7")):
            p = _test_predictions(spark, mf, [feat], {"linear": _TEST_GRID})
            parts.append(p.select(F.concat(F.col("model"), F.lit(f" - v{v}")).alias("label"), "y", "y_hat"))
        pred = parts[0].unionByName(parts[1])
        s = pred.groupBy("label").agg(F.round(F.avg(F.abs(F.col("y") - F.col("y_hat"))), 6).alias("mae"))
        return _kept(spark, s.select("label", X.label_model("label").alias("model"),
                                     X.label_version("label").alias("version"), "mae"))


# ---- reports ----------------------------------------------------------------

def _last_fold_linear(spark, sf_dir):
    return linear_predictions(spark, sf_dir, "x", [("linear", {})]).where(F.col("fold") == LAST_FOLD)


@register("entity_mae", _GRID_CTES + """, ent AS (SELECT DISTINCT entity FROM mf),
pe AS (SELECT entity, avg(abs(y - y_hat)) AS mae FROM pred WHERE fold = '""" + LAST_FOLD + """' AND model = 'linear' GROUP BY entity),
ov AS (SELECT avg(abs(y - y_hat)) AS m FROM pred WHERE fold = '""" + LAST_FOLD + """' AND model = 'linear')
SELECT ent.entity, round(COALESCE(pe.mae, ov.m), 6) AS mae FROM pe RIGHT JOIN ent ON pe.entity = ent.entity, ov""")
def entity_mae(spark, sf_dir):
    pred = _last_fold_linear(spark, sf_dir)
    return E.entity_mae(pred, model_frame(spark, sf_dir).select("entity"))


_PT_GRID = [("linear", {}), ("lasso", {"alpha": 0.1}), ("ridge", {"alpha": 10.0})]
_PT_NAMES = {"linear": "linear", "lasso": "lasso_0_1", "ridge": "ridge_10"}


@register("prediction_table", _fold_sql_ctes() + ", "
          + _one_feature_sql("(SELECT * FROM folded WHERE split = 'train' AND fold = '" + LAST_FOLD + "')",
                             "(SELECT * FROM folded WHERE split = 'validation' AND fold = '" + LAST_FOLD + "')",
                             "x", _PT_GRID) + """,
gm AS (SELECT avg(y) AS g FROM folded WHERE split = 'train' AND fold = '""" + LAST_FOLD + """')
SELECT entity, d, max(y) AS y, """
          + ", ".join(f"round(max(CASE WHEN model = '{k}' THEN y_hat END), 6) AS {v}" for k, v in _PT_NAMES.items())
          + ", round(max(g), 6) AS global_mean FROM pred, gm GROUP BY entity, d")
def prediction_table(spark, sf_dir):
    f = folded(spark, sf_dir).where(F.col("fold") == LAST_FOLD)
    lin = L.linear_grid_predictions(f, _PT_GRID, features=["x"]).withColumn(
        "model", F.when(F.col("model") == "lasso", "lasso_0_1").when(F.col("model") == "ridge", "ridge_10")
        .otherwise(F.col("model")))
    nul = E.null_predictions(f).where(F.col("model") == "global_mean")
    cols = ["fold", "model", "entity", "d", "y", "y_hat"]
    pred = lin.select(*cols).unionByName(nul.select(*cols))
    pred = pred.withColumn("y_hat", F.round("y_hat", 6))
    return E.prediction_table(pred, keys=["entity", "d"], models=list(_PT_NAMES.values()) + ["global_mean"])


def _variant_sql() -> str:
    bodies = []
    for feat in ("x", "x7"):
        b = _one_feature_sql("(SELECT * FROM folded WHERE split = 'train')",
                             "(SELECT * FROM folded WHERE split = 'validation')", feat, G.linear_grid(),
                             sfx=f"_{feat}")
        bodies.append(b + f""",
avg_{feat} AS (SELECT model, params, round(avg(mse), 6) AS mse, round(avg(mae), 6) AS mae FROM (
  SELECT fold, model, params, avg((y - y_hat) * (y - y_hat)) AS mse, avg(abs(y - y_hat)) AS mae
    FROM pred_{feat} GROUP BY fold, model, params) t GROUP BY model, params)""")
    sel = " UNION ALL ".join(
        f"""SELECT model, params, mse, mae, '{feat}' AS variant FROM (
  SELECT *, row_number() OVER (PARTITION BY model ORDER BY mae, params) AS rn FROM avg_{feat}) t WHERE rn = 1"""
        for feat in ("x", "x7"))
    return _fold_sql_ctes() + ", " + ",\n".join(bodies) + "\n" + sel


@register("best_by_variant", _variant_sql())
def best_by_variant(spark, sf_dir):
    out = None
    for feat in ("x", "x7"):
        avg = E.fold_average(_grid_results(spark, sf_dir, feat, digits=None))
        b = E.best_per_model(avg, label=feat).select("model", "params", "mse", "mae", "variant")
        out = b if out is None else out.unionByName(b)
    return out


# ---- flagship -------------------------------------------------------------

def flagship_leaderboard(spark, sf_dir) -> DataFrame:
    """Mean validation error over 3 expanding folds: linear family + null models, sorted."""
    f = folded(spark, sf_dir)
    lin = L.linear_grid_predictions(f, G.linear_grid(), features=["x"])
    cols = ["fold", "model", "params", "entity", "d", "y", "y_hat"]
    pred = lin.select(*cols).unionByName(E.null_predictions(f).select(*cols))
    return E.leaderboard(E.fold_average(E.score(pred, digits=None)))


# ---- k nearest neighbours on the embeddings ------------------------------------


KNN_KS = list(range(5, 20))
_QUERY_CUT = int(0.2 * 2 ** 52)      # hash split: about 20% of the vectors are queries


def _knn_split(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    h = S.key_hash(["vec_id"], seed=7)
    return e.where(h >= _QUERY_CUT), e.where(h < _QUERY_CUT)


@register("fit_knn", f"""
WITH e AS (SELECT vec_id, embedding, label, ('0x' || substr(md5('7|' || CAST(vec_id AS VARCHAR)), 1, 13))::BIGINT AS h
             FROM embeddings),
q AS (SELECT vec_id, embedding FROM e WHERE h < {_QUERY_CUT}),
t AS (SELECT vec_id, embedding, label FROM e WHERE h >= {_QUERY_CUT}),
dd AS (SELECT q.vec_id AS qid, t.vec_id AS tid, t.label,
              list_sum(list_transform(range(1, len(q.embedding) + 1),
                       lambda i: (CAST(q.embedding[i] AS DOUBLE) - CAST(t.embedding[i] AS DOUBLE))
                               * (CAST(q.embedding[i] AS DOUBLE) - CAST(t.embedding[i] AS DOUBLE)))) AS dist
         FROM q, t),
r AS (SELECT qid, label, row_number() OVER (PARTITION BY qid ORDER BY dist, tid) AS rn FROM dd),
ks AS (SELECT CAST(range AS INTEGER) AS k FROM range(5, 20))
SELECT r.qid AS vec_id, ks.k, avg(r.label) AS y_hat FROM r JOIN ks ON r.rn <= ks.k GROUP BY r.qid, ks.k""")
def fit_knn(spark, sf_dir):
    train, query = _knn_split(spark, sf_dir)
    neigh = KNN.knn_neighbours(train, query, id_col="vec_id", vec_col="embedding", label="label", kmax=max(KNN_KS))
    return KNN.knn_predict(neigh, id_col="vec_id", ks=KNN_KS)


# ---- forest, AdaBoost, SVR (rows-only checks: no SQL equivalent) ---------------


TREE_FEATURES = ["x", "x7"] + [f"dow_{k}" for k in range(7)]


def tree_frame(spark, sf_dir) -> DataFrame:
    f = folded(spark, sf_dir)
    return f.select("*", *C.one_hot(X.weekday_monday0("d"), range(7), "dow"))


def _fold_scores(spark, sf_dir, fit_predict, model: str, params: dict, folds=None) -> DataFrame:
    """Fit on each fold's train rows, predict its validation rows, score all in one job."""
    from concurrent.futures import ThreadPoolExecutor
    tf = tree_frame(spark, sf_dir)

    def one(fold):
        tr = tf.where((F.col("fold") == fold) & (F.col("split") == "train"))
        va = tf.where((F.col("fold") == fold) & (F.col("split") == "validation"))
        return fit_predict(tr, va).select("fold", F.lit(model).alias("model"),
                                          F.lit(G.params_text(params)).alias("params"), "entity", "d", "y", "y_hat")
    # independent fold fits run as concurrent Spark jobs
    with ThreadPoolExecutor(max_workers=3) as pool:
        preds = list(pool.map(one, folds or FOLD_NAMES))
    out = preds[0]
    for p in preds[1:]:
        out = out.unionByName(p)
    return E.score(out)


@register("fit_forest")
def fit_forest(spark, sf_dir):
    params = {"n_estimators": 100, "max_features": "log2"}

    def fp(tr, va):
        m = TR.fit_forest(tr, features=TREE_FEATURES, n_estimators=100, max_features="log2", seed=0)
        return TR.predict(m, va, TREE_FEATURES)
    return _fold_scores(spark, sf_dir, fp, "forest", params)


@register("feature_importance")
def feature_importance(spark, sf_dir):
    tf = tree_frame(spark, sf_dir)
    tr = tf.where((F.col("fold") == LAST_FOLD) & (F.col("split") == "train"))
    m = TR.fit_forest(tr, features=TREE_FEATURES, n_estimators=100, max_features="log2", seed=0)
    return TR.importances(spark, m, TREE_FEATURES, top=50)


@register("fit_adaboost")
def fit_adaboost(spark, sf_dir):
    params = {"n_estimators": 50}

    def fp(tr, va):
        ens = TR.fit_adaboost(tr, features=TREE_FEATURES, n_estimators=50, seed=0)
        return TR.predict_adaboost(ens, va, TREE_FEATURES)
    return _fold_scores(spark, sf_dir, fp, "adaboost", params)


@register("fit_svr")
def fit_svr(spark, sf_dir):
    """The whole C x epsilon grid on all folds in shared passes, scored by one aggregate."""
    features = ["x", "x7"]
    points = [(c, e) for c in SVR.C_GRID for e in SVR.EPSILON_GRID]
    with held_frame(spark, sf_dir) as mf:
        f = S.cv_folds(mf, date="d")
        fits = SVR.fit_linear_svr_grid(f.where(F.col("split") == "train"), points, features=features, by="fold")
        aggs, cells = [], []
        for i, (c, e) in enumerate(points):
            ws = {fold: w for (fold, p), (w, _) in fits.items() if p == i}
            err = F.col("y") - SVR.group_value(ws, features, "fold")
            aggs += [F.avg(err * err).alias(f"mse{i}"), F.avg(F.abs(err)).alias(f"mae{i}")]
            cells.append(F.struct(F.lit("svr").alias("model"),
                                  F.lit(G.params_text({"C": c, "epsilon": e})).alias("params"),
                                  F.round(f"mse{i}", 6).alias("mse"), F.round(f"mae{i}", 6).alias("mae")))
        scores = f.where(F.col("split") == "validation").groupBy("fold").agg(*aggs)
        return _kept(spark, scores.select("fold", F.inline(F.array(*cells))))
