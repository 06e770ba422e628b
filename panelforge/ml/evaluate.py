"""Scoring and report tables.

Predictions are a long table ``(fold, model, params, <keys>, y, y_hat)``;
every score is one grouped aggregate over it, so all grid points are scored
in a single job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _keys(k) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def score(pred: DataFrame, *, by: Sequence[str] = ("fold", "model", "params"), y: str = "y",
          y_hat: str = "y_hat", digits: int | None = 6) -> DataFrame:
    """MSE and MAE per group; rows without a prediction are skipped."""
    e = F.col(y) - F.col(y_hat)
    mse, mae = F.avg(e * e), F.avg(F.abs(e))
    if digits is not None:
        mse, mae = F.round(mse, digits), F.round(mae, digits)
    return pred.groupBy(*by).agg(mse.alias("mse"), mae.alias("mae"))


def fold_average(results: DataFrame, *, by: Sequence[str] = ("model", "params"),
                 digits: int | None = 6) -> DataFrame:
    """Mean of the fold rows per configuration."""
    mse, mae = F.avg("mse"), F.avg("mae")
    if digits is not None:
        mse, mae = F.round(mse, digits), F.round(mae, digits)
    return results.groupBy(*by).agg(mse.alias("mse"), mae.alias("mae"))


def leaderboard(results: DataFrame, metric: str = "mae") -> DataFrame:
    """Sorted by the metric (ties by model, params) - a sink-side sort."""
    return results.orderBy(F.col(metric).asc(), *[F.col(c).asc() for c in ("model", "params") if c in results.columns])


def null_predictions(frame: DataFrame, *, fold: str = "fold", split: str = "split", y: str = "y",
                     entity: str = "entity", keys: Sequence[str] = ("entity", "d"),
                     train: str = "train", target: str = "validation") -> DataFrame:
    """Null-model predictions for every fold: global train mean and entity train mean.

    Means are partial aggregates (one row per fold, one per fold and entity)
    joined back on their keys; an entity unseen in train gets no prediction.
    """
    tr = frame.where(F.col(split) == train)
    ev = frame.where(F.col(split) == target).select(fold, *keys, y)
    g = tr.groupBy(fold).agg(F.avg(y).alias("y_hat"))
    e = tr.groupBy(fold, entity).agg(F.avg(y).alias("y_hat"))
    pg = ev.join(g, fold, "left").withColumn("model", F.lit("global_mean"))
    pe = ev.join(e, [fold, entity], "left").withColumn("model", F.lit("entity_mean"))
    cols = [fold, "model", *keys, y, "y_hat"]
    return pg.select(*cols).unionByName(pe.select(*cols)).withColumn("params", F.lit("{}"))


def entity_mae(pred: DataFrame, entities: DataFrame, *, entity: str = "entity", y: str = "y",
               y_hat: str = "y_hat", digits: int | None = 6) -> DataFrame:
    """MAE per entity, right-joined to every entity; entities without
    predictions get the overall MAE."""
    e = F.abs(F.col(y) - F.col(y_hat))
    per = pred.groupBy(entity).agg(F.avg(e).alias("mae"))
    overall = pred.select(F.avg(e)).scalar()
    out = per.join(entities.select(entity).distinct(), entity, "right")
    mae = F.coalesce(F.col("mae"), overall)
    return out.select(entity, (F.round(mae, digits) if digits is not None else mae).alias("mae"))


def prediction_table(pred: DataFrame, *, keys: Sequence[str], models: Sequence[str], y: str = "y",
                     model: str = "model", y_hat: str = "y_hat") -> DataFrame:
    """Observed value plus one column per model (values given: fixed schema)."""
    aggs = [F.first(y).alias(y)] + [F.max(F.when(F.col(model) == m, F.col(y_hat))).alias(m) for m in models]
    return pred.groupBy(*keys).agg(*aggs)


def best_per_model(results: DataFrame, *, by: Sequence[str] = ("model",), metric: str = "mae",
                   label: str | None = None) -> DataFrame:
    """Row-consistent best configuration per model (``min_by`` on the metric;
    ties broken by the params text)."""
    key = F.struct(F.col(metric), F.col("params"))
    best = results.groupBy(*by).agg(F.min_by(F.struct(*[c for c in results.columns if c not in by]), key).alias("b"))
    out = best.select(*by, "b.*")
    return out.withColumn("variant", F.lit(label)) if label is not None else out
