"""The model study over expanding folds, with or without PCA, and
D14: the report tables behind the charts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as X
from ..ml import evaluate as E
from ..ml import grid as G
from ..ml import prep as M
from ..ml import split as S
from ..ml import zoo as Z
from ..ml.store import ArtifactStore, fingerprint, rows_fingerprint
from ..operators import panel as P
from ..operators import profile as A
from ..session import scratch_path

# The target, index columns and the variance kept by PCA.
TARGET = "retail_and_recreation_percent_change_from_baseline"
INDEX = ["StateName", "CountyName", "fips", "date"]
PCA_K, PCA_VARIANCE = 75, 0.95


def study_columns(df: DataFrame, target: str = TARGET, index: Sequence[str] = INDEX) -> list[str]:
    """Features: numeric columns that are neither index nor a target (names
    ending in 'change_from_baseline')."""
    return [c for c in P.numeric_columns(df)
            if c != target and c not in index and not c.endswith("change_from_baseline")]


@dataclass
class Study:
    """A stored study: where its artefacts are, what identifies it, and its validation results."""

    store: ArtifactStore
    id: str
    target: str
    entity: str
    date: str
    features: list[str]
    folds: list[tuple[float, float]]
    with_pca: bool
    grids: dict
    predictions: DataFrame
    all_validations: DataFrame
    average: DataFrame

    @property
    def last_fold(self) -> str:
        return fold_name(self.folds[-1])


def fold_name(fold: tuple[float, float]) -> str:
    return f"{fold[0]:.1f}-{fold[1]:.1f}"


def _base(panel: DataFrame, target: str) -> DataFrame:
    return panel.dropna(subset=[target]).withColumnRenamed(target, "y")


def run_study(panel: DataFrame, *, store: str | None = None, target: str = TARGET, with_pca: bool = False,
              grids: dict | None = None, grid: Sequence[tuple[str, dict]] | None = None,
              entity: str = "fips", date: str = "date", folds=S.DEFAULT_FOLDS, seed: int = 0) -> Study:
    """Folds -> prepare (impute, standardise, optional PCA) -> every model
    family of ``grids`` ({family: grid}; default: the reference's 72 / 22
    configurations, see ``zoo.study_grids``) -> fold rows, averages and
    leaderboards. ``grid`` alone runs just that linear grid.

    Preparations, models and predictions of every fold are written into
    ``store`` (a folder; default: a fresh one in the shared checkpoint
    folder) as they are made. A second run over the same panel opens them, and
    one after a stop fits only what is missing; other rows, features, folds or
    parameters have other fingerprints and are fitted anew.
    """
    spark = panel.sparkSession
    if grids is None:
        grids = {"linear": list(grid)} if grid is not None else Z.study_grids(with_pca)
    artefacts = ArtifactStore(spark, store or scratch_path(spark, "study"))
    base = _base(panel, target)
    feats = study_columns(base, "y", [*INDEX, entity, date])
    data = fingerprint(rows_fingerprint(base, [entity, date, "y", *feats]), target, feats, with_pca, PCA_K,
                       PCA_VARIANCE)
    study = fingerprint("study", data, [list(f) for f in folds], seed)
    folded = S.cv_folds(base, date=date, folds=folds)
    preds = []
    for f in folds:
        name = fold_name(f)
        frame = folded.where(F.col("fold") == name)
        rows = fingerprint("fold", data, list(f))
        prep, _ = artefacts.get(
            "preparation", rows, study=study, fold=name,
            make=lambda: M.fit_preparation(frame, columns=feats, with_pca=with_pca, k=PCA_K, threshold=PCA_VARIANCE),
            save=lambda p, path: p.save(spark, path), load=lambda path: M.Preparation.load(spark, path))
        prepared = prep.apply(frame).select("split", entity, date, "y", *prep.features)
        prepared = prepared.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            train, valid = (prepared.where(F.col("split") == s).drop("split") for s in ("train", "validation"))
            preds += G.run_fold(artefacts, train, valid, grids, features=prep.features, keys=(entity, date),
                                rows=rows, study=study, fold=name, seed=seed)
        finally:
            prepared.unpersist()
    pred = preds[0]
    for p in preds[1:]:
        pred = pred.unionByName(p)
    fold_rows = E.score(pred, digits=None)
    return Study(artefacts, study, target, entity, date, feats, list(folds), with_pca, grids, pred,
                 E.leaderboard(fold_rows), E.leaderboard(E.fold_average(fold_rows, digits=None)))


def test_predictions(study: Study, panel: DataFrame, *, test_size: float = 0.1) -> DataFrame:
    """The last fold's stored models of every family on the panel's test rows (the last days).

    The rows are prepared by the last fold's stored preparation - filled with
    its train medians, scaled and projected by its train statistics - and no
    model is fitted again.
    """
    spark, fold = panel.sparkSession, study.last_fold
    stored = study.store.entries("preparation", study.id, fold)
    if not stored:
        raise ValueError(f"the study has no stored preparation of fold {fold!r}")
    prep = M.Preparation.load(spark, stored[0]["path"])
    rows = S.split_time(_base(panel, study.target), date=study.date, test_size=test_size)
    rows = prep.apply(rows.where(F.col("split") == "test"))
    rows = rows.select(study.entity, study.date, "y", *prep.features)
    return G.predict_stored(study.store, study.id, fold, rows, features=prep.features,
                            keys=(study.entity, study.date), grids=study.grids)


def test_mae(predictions: dict[int, DataFrame], digits: int | None = 6) -> DataFrame:
    """(label, model, version, mae) of every stored model of every version ({version: test predictions}).

    A label is the model with its parameters and the version: ``ridge {"alpha": 1.0} - v1``.
    """
    out = None
    for version, pred in predictions.items():
        label = F.concat("model", F.lit(" "), "params", F.lit(f" - v{version}"))
        p = pred.select(label.alias("label"), "y", "y_hat")
        out = p if out is None else out.unionByName(p)
    mae = F.avg(F.abs(F.col("y") - F.col("y_hat")))
    found = out.groupBy("label").agg((F.round(mae, digits) if digits is not None else mae).alias("mae"))
    return found.select("label", X.label_model("label").alias("model"), X.label_version("label").alias("version"),
                        "mae")


def study_tables(study: Study, panel: DataFrame) -> dict[str, DataFrame]:
    """The tables behind the study's charts, from its stored predictions.

    Null models by fold and on average, the best parameters of every model
    type, the last fold's predictions of these side by side, and the mean
    absolute error of each entity under the best model.
    """
    keys, fold = [study.entity, study.date], study.last_fold
    folded = S.cv_folds(_base(panel, study.target), date=study.date, folds=study.folds)
    nulls = E.null_predictions(folded, entity=study.entity, keys=keys)
    null_rows = E.score(nulls, digits=None)
    best = E.best_per_model(study.average)
    last = study.predictions.where(F.col("fold") == fold)
    chosen = last.join(best.select("model", "params"), ["model", "params"])
    models = sorted(r["model"] for r in best.select("model").collect())      # one per model type
    first = E.leaderboard(best).select("model", "params").limit(1)
    null_last = nulls.where(F.col("fold") == fold)
    wide = chosen.select(*keys, "y", "model", "y_hat").unionByName(null_last.select(*keys, "y", "model", "y_hat"))
    return {"null_models": null_rows, "null_average": E.fold_average(null_rows, digits=None),
            "best_by_model": best,
            "prediction_table": E.prediction_table(wide, keys=keys, models=[*models, "global_mean", "entity_mean"]),
            "entity_mae": E.entity_mae(last.join(first, ["model", "params"]), panel.select(study.entity),
                                       entity=study.entity)}


def write_tables(tables: dict[str, DataFrame], path: str) -> dict[str, str]:
    """Each table as Parquet below ``path``: {name: place}."""
    out = {}
    for name, df in tables.items():
        out[name] = f"{path.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(out[name])
    return out


def report_tables(panel: DataFrame, *, entity: str = "fips", date: str = "date",
                  corr_columns: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Missing-data profiles and the correlation pairs behind the charts."""
    cols = [c for c in panel.columns if c not in (entity, date)]
    out = {"missing_by_column": A.missing_by_column(panel, cols),
           "missing_by_date": A.missing_by_date(panel, date=date, entity=entity, columns=cols),
           "missing_by_entity": A.missing_by_entity(panel, entity=entity, date=date)}
    if corr_columns:
        out["correlations"] = A.corr_matrix(panel, list(corr_columns))
    return out


