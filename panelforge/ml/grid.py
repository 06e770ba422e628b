"""Grid runner over folds (M13, M15, M18) on the artefact store.

``fit_units`` fits the units of every family on one fold's training rows, or
opens those that the store holds for the same rows, features, preparation and
parameters. ``run_grid`` adds each unit's predictions of the target rows,
which are stored as well, so a run that was stopped goes on with the first
missing artefact. ``predict_stored`` applies a study's stored models to rows
that no fit has seen.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import linear as L
from .families import FAMILIES, params_text
from .store import ArtifactStore, fingerprint, rows_fingerprint

# A grid entry of the linear family: (model name, params dict).
GridPoint = tuple[str, dict]


def linear_grid(alphas: Sequence[float] = L.ALPHAS) -> list[GridPoint]:
    """The reference's linear family: least squares, 11 lasso, 11 ridge."""
    return ([("linear", {})] + [("lasso", {"alpha": a}) for a in alphas]
            + [("ridge", {"alpha": a}) for a in alphas])


def fit_units(store: ArtifactStore, train: DataFrame, grids: dict, *, features: Sequence[str], rows: str,
              study: str = "", fold: str = "", seed: int = 0) -> Iterator[tuple]:
    """Yield (family, unit, fingerprint, opener) for every unit of ``grids`` ({family: grid}).

    ``rows`` is the fingerprint of the training rows and their preparation.
    ``opener()`` gives the fitted artefact: opened where the store knows the
    fingerprint, else fitted on ``train`` (keys, features and ``y``) and stored.
    """
    for name, grid in grids.items():
        family = FAMILIES[name]
        for unit in family.units(grid):
            params = json.dumps(unit, sort_keys=True)
            print_ = fingerprint("model", family.version, rows, list(features), name, params, seed)

            def opener(family=family, unit=unit, print_=print_, params=params, name=name):
                return store.get(
                    "model", print_, make=lambda: family.fit(train, features, unit, seed),
                    save=lambda m, path: family.save(store.spark, m, path),
                    load=lambda path: family.load(store.spark, path),
                    study=study, fold=fold, family=name, params=params)[0]
            yield name, unit, print_, opener


def run_fold(store: ArtifactStore, train: DataFrame, target: DataFrame, grids: dict, *, features: Sequence[str],
             keys: Sequence[str], rows: str, study: str = "", fold: str = "", seed: int = 0) -> list[DataFrame]:
    """Stored predictions (fold, model, params, *keys, y, y_hat) of the target rows, one table per unit."""
    out = []
    for name, unit, print_, opener in fit_units(store, train, grids, features=features, rows=rows, study=study,
                                                fold=fold, seed=seed):
        def predict(opener=opener, name=name, unit=unit):
            found = FAMILIES[name].predict(opener(), target, features, keys, unit)
            return found.select(F.lit(fold).alias("fold"), "model", "params", *keys, "y", "y_hat")
        mark = fingerprint("predictions", print_, list(keys))
        table, known = store.get(
            "predictions", mark, make=predict, save=lambda df, path: df.write.parquet(path),
            load=store.spark.read.parquet, study=study, fold=fold, family=name,
            params=json.dumps(unit, sort_keys=True))
        out.append(table if known else store.spark.read.parquet(store.find("predictions", mark)))
    return out


def run_grid(frame: DataFrame, grids: dict, *, store: ArtifactStore, features: Sequence[str], label: str = "y",
             keys: Sequence[str] = ("entity", "d"), fold: str = "fold", split: str = "split",
             train: str = "train", target: str = "validation", study: str = "", seed: int = 0) -> DataFrame:
    """Every grid point of every family on every fold: the long prediction table of the ``target`` rows."""
    cols = [*keys, *features, F.col(label).alias("y")]
    out = []
    for name in sorted(r[0] for r in frame.select(fold).distinct().collect()):
        part = frame.where(F.col(fold) == name).select(split, *cols).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            tr, ev = (part.where(F.col(split) == s).drop(split) for s in (train, target))
            rows = fingerprint(rows_fingerprint(tr, tr.columns), rows_fingerprint(ev, ev.columns))
            out += run_fold(store, tr, ev, grids, features=features, keys=keys, rows=rows, study=study, fold=name,
                            seed=seed)
        finally:
            part.unpersist()
    pred = out[0]
    for p in out[1:]:
        pred = pred.unionByName(p)
    return pred


def predict_stored(store: ArtifactStore, study: str, fold: str, rows: DataFrame, *, features: Sequence[str],
                   keys: Sequence[str] = ("entity", "d"), grids: dict | None = None) -> DataFrame:
    """Every model that ``study`` stored for ``fold`` (of ``grids`` alone, if given), applied to ``rows``.

    ``rows`` has the keys, the features and ``y``. Nothing is fitted; a fold
    without stored models is an error.
    """
    entries = store.entries("model", study, fold)
    if grids is not None:
        wanted = {(name, json.dumps(unit, sort_keys=True)) for name, g in grids.items()
                  for unit in FAMILIES[name].units(g)}
        entries = [e for e in entries if (e["family"], e["params"]) in wanted]
    if not entries:
        raise ValueError(f"study {study!r} has no stored model of fold {fold!r}")
    out = None
    for e in entries:
        family, unit = FAMILIES[e["family"]], json.loads(e["params"])
        p = family.predict(family.load(store.spark, e["path"]), rows, features, keys, unit)
        p = p.select(F.lit(fold).alias("fold"), "model", "params", *keys, "y", "y_hat")
        out = p if out is None else out.unionByName(p)
    return out


def write_predictions(pred: DataFrame, path: str) -> None:
    """Parquet partitioned by fold and model (selection by partition filter)."""
    pred.write.mode("overwrite").partitionBy("fold", "model").parquet(path)


def read_predictions(spark, path: str, *, fold: str | None = None, model: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    if fold is not None:
        df = df.where(F.col("fold") == fold)
    if model is not None:
        df = df.where(F.col("model") == model)
    return df


__all__ = ["linear_grid", "params_text", "fit_units", "run_fold", "run_grid", "predict_stored", "write_predictions",
           "read_predictions"]
