"""Preparation of split frames (M3-M5): impute, standardise, PCA.

All statistics for all columns come from one grouped aggregate per call
(one row per split), brought to the driver as scalars; applying them is a
projection. Frames carry their keys and a ``split`` column, never a
positional index.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.feature import PCA, PCAModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOW = ("median", "mean")


def split_statistics(df: DataFrame, *, split: str, columns: Sequence[str], how: str) -> dict:
    """{split value: {column: statistic}} from one aggregate grouped by split."""
    if how == "median":
        # exact selection: a few bucket-histogram passes, no map of distinct values
        from ..operators.profile import exact_quantiles
        med = exact_quantiles(df.where(F.col(split).isNotNull()), list(columns), 0.5, by=split)
        out: dict = {}
        for (g, c), v in med.items():
            out.setdefault(g, {})[c] = v
        return out
    if how == "mean":
        agg = [F.avg(c).alias(c) for c in columns]
    else:
        raise ValueError(f"unknown imputation {how!r}; use 'median', 'mean' or a number")
    rows = df.where(F.col(split).isNotNull()).groupBy(split).agg(*agg).collect()
    return {r[split]: {c: r[c] for c in columns} for r in rows}


def impute(df: DataFrame, *, split: str = "split", columns: Sequence[str], how="median",
           validation_stats: str = "own") -> DataFrame:
    """Fill missing values of numeric columns.

    ``how`` is 'median', 'mean' or a number. Train and test use the train
    statistics; validation uses its own statistics by default (as the
    reference does) or the train ones with ``validation_stats='train'``.
    """
    if isinstance(how, (int, float)) and not isinstance(how, bool):
        return df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(float(how))).alias(c)
                           if c in columns else F.col(c) for c in df.columns])
    stats = split_statistics(df, split=split, columns=columns, how=how)
    train = stats.get("train", {})
    return fill_missing(df, train, stats.get("validation", {}) if validation_stats == "own" else train, split=split,
                        columns=columns)


def fill_missing(df: DataFrame, train: dict, val: dict, *, split: str, columns: Sequence[str]) -> DataFrame:
    """Missing values of validation rows become ``val``'s, of all other rows ``train``'s."""
    out = []
    for c in df.columns:
        if c not in columns:
            out.append(F.col(c))
            continue
        t, v = train.get(c), val.get(c)
        fill = F.when(F.col(split) == "validation", F.lit(v)).otherwise(F.lit(t)).cast("double")
        out.append(F.coalesce(F.col(c).cast("double"), fill).alias(c))
    return df.select(*out)


def standardize(df: DataFrame, *, split: str = "split", columns: Sequence[str],
                fit_on: str = "train") -> DataFrame:
    """(x - mean) / population std with the train statistics; a constant column gives 0."""
    return scale(df, standard_statistics(df, split=split, columns=columns, fit_on=fit_on))


def standard_statistics(df: DataFrame, *, split: str = "split", columns: Sequence[str],
                        fit_on: str = "train") -> dict:
    """{column: (mean, population std)} of the ``fit_on`` rows, from one aggregate; a std of 0 counts as 1."""
    row = (df.where(F.col(split) == fit_on)
             .agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(columns)],
                  *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(columns)]).first())
    return {c: (row[f"m_{i}"], row[f"s_{i}"] or 1.0) for i, c in enumerate(columns)}


def scale(df: DataFrame, stats: dict) -> DataFrame:
    """(x - mean) / std for the columns of ``stats``."""
    return df.select(*[((F.col(c) - F.lit(stats[c][0])) / F.lit(stats[c][1])).alias(c) if c in stats else F.col(c)
                       for c in df.columns])


def fit_pca(df: DataFrame, *, split: str = "split", columns: Sequence[str], k: int = 75,
            threshold: float = 0.95, fit_on: str = "train"):
    """Fit PCA on the train rows; keep the first m components whose cumulative
    explained variance exceeds ``threshold``. Returns (model, m, signs).

    Spark's PCA does not centre: feed standardised columns (train mean 0).
    Component signs are fixed so each component's largest loading is positive.
    """
    k = min(k, len(columns))
    data = VectorAssembler(inputCols=list(columns), outputCol="__f").transform(
        df.where(F.col(split) == fit_on).select(*columns))
    model = PCA(k=k, inputCol="__f", outputCol="__pc").fit(data)
    cum = np.cumsum(model.explainedVariance.toArray())
    above = np.nonzero(cum > threshold)[0]
    if len(above) == 0:
        raise ValueError(f"{k} components explain only {cum[-1]:.4f} < {threshold}")
    m = int(above[0]) + 1
    pc = model.pc.toArray()
    signs = [1.0 if pc[np.argmax(np.abs(pc[:, j])), j] >= 0 else -1.0 for j in range(pc.shape[1])]
    return model, m, signs


def pca_project(df: DataFrame, model, m: int, signs: Sequence[float], *, columns: Sequence[str],
                prefix: str = "pc") -> DataFrame:
    """Project every split onto the first ``m`` components (sign-fixed)."""
    keep = [c for c in df.columns if c not in columns]
    data = VectorAssembler(inputCols=list(columns), outputCol="__f").transform(df)
    model = model.copy()
    model.setInputCol("__f").setOutputCol("__pc")
    proj = model.transform(data).withColumn("__a", vector_to_array("__pc"))
    return proj.select(*keep, *[(F.col("__a")[j] * F.lit(signs[j])).alias(f"{prefix}{j + 1}") for j in range(m)])


@dataclass
class Preparation:
    """A fitted preparation (impute, standardise, optionally PCA) that applies to rows it was not fitted on.

    Validation rows are filled with their own medians, all others (train and
    test) with the train ones; means, deviations and components are of train.
    """

    columns: list[str]
    fill: dict
    fill_validation: dict
    standard: dict
    kept: int = 0                                         # components kept; 0: no PCA
    signs: list[float] = field(default_factory=list)
    pca: PCAModel | None = None

    @property
    def features(self) -> list[str]:
        return [f"pc{j + 1}" for j in range(self.kept)] if self.kept else list(self.columns)

    def apply(self, df: DataFrame, *, split: str = "split") -> DataFrame:
        filled = fill_missing(df, self.fill, self.fill_validation, split=split, columns=self.columns)
        z = scale(filled, self.standard)
        if not self.kept:
            return z
        return pca_project(z, self.pca, self.kept, self.signs, columns=self.columns)

    def statistics(self) -> dict:
        """All but the component loadings, as JSON values."""
        return {"columns": list(self.columns), "fill": self.fill, "fill_validation": self.fill_validation,
                "standard": {c: list(v) for c, v in self.standard.items()}, "kept": self.kept, "signs": self.signs}

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(json.dumps(self.statistics()),)]
        spark.createDataFrame(rows, "statistics string").coalesce(1).write.parquet(f"{path}/statistics")
        if self.pca is not None:
            self.pca.write().save(f"{path}/pca")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Preparation:
        s = json.loads(spark.read.parquet(f"{path}/statistics").first()["statistics"])
        s["standard"] = {c: tuple(v) for c, v in s["standard"].items()}
        return cls(**s, pca=PCAModel.load(f"{path}/pca") if s["kept"] else None)


def fit_preparation(df: DataFrame, *, split: str = "split", columns: Sequence[str], with_pca: bool, k: int = 75,
                    threshold: float = 0.95) -> Preparation:
    """Medians, means, deviations and components of one fold's rows; a column without a value is filled with 0."""
    columns = list(columns)
    stats = split_statistics(df, split=split, columns=columns, how="median")
    train, val = ({c: 0.0 if (v := stats.get(g, {}).get(c)) is None else float(v) for c in columns}
                  for g in ("train", "validation"))
    filled = fill_missing(df, train, val, split=split, columns=columns)
    standard = standard_statistics(filled, split=split, columns=columns)
    if not with_pca:
        return Preparation(columns, train, val, standard)
    model, m, signs = fit_pca(scale(filled, standard), split=split, columns=columns, k=k, threshold=threshold)
    return Preparation(columns, train, val, standard, m, signs, model)
