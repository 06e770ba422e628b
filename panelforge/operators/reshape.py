"""Reshape, union, sort and limit.

Pivots always take the category values: the output schema is fixed at plan
time and no extra distinct pass is run. Pivots are conditional aggregates in
one grouped aggregate, so partial aggregation happens before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(k) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def pivot_strict(df: DataFrame, *, keys, pivot: str, value: str, values: Sequence,
                 name: str = "{value}{category}") -> DataFrame:
    """Long -> wide; a second value for one (keys, category) cell is an error.

    The duplicate check rides in the same aggregate (``raise_error`` when a
    cell counts more than one row), so no extra job is needed.
    """
    aggs = []
    for v in values:
        hit = F.col(pivot) == F.lit(v)
        cell = F.max(F.when(hit, F.col(value)))
        n = F.count_if(hit)
        msg = F.lit(f"duplicate entries for pivot cell {pivot}={v}")
        aggs.append(F.when(n > 1, F.raise_error(msg)).otherwise(cell)
                    .alias(name.format(value=value, category=v)))
    return df.groupBy(*_keys(keys)).agg(*aggs)


def pivot_mean(df: DataFrame, *, keys, pivot: str, value: str, values: Sequence,
               name: str = "{category}") -> DataFrame:
    """Long -> wide; duplicate cells are averaged."""
    aggs = [F.avg(F.when(F.col(pivot) == F.lit(v), F.col(value))).alias(name.format(value=value, category=v))
            for v in values]
    return df.groupBy(*_keys(keys)).agg(*aggs)


def unpivot(df: DataFrame, *, ids, columns: Sequence[str] | None = None, var: str = "variable",
            value: str = "value") -> DataFrame:
    """Wide -> long; missing values are kept as rows (like a melt)."""
    ids = _keys(ids)
    cols = list(columns) if columns else [c for c in df.columns if c not in ids]
    return df.unpivot(ids, cols, var, value)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of frames with different columns; absent columns become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def append_summary_row(df: DataFrame, summary: DataFrame) -> DataFrame:
    """Append a (one-row) summary computed from the same data."""
    return df.unionByName(summary)


def sort_by(df: DataFrame, *cols: Column | str, ascending: bool = True) -> DataFrame:
    """Global sort: only at a sink (range-partitioned, so it scales)."""
    return df.orderBy(*[(F.col(c) if isinstance(c, str) else c).asc() if ascending
                        else (F.col(c) if isinstance(c, str) else c).desc() for c in cols])


def top_n(df: DataFrame, n: int, by: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """Largest ``n`` rows by ``by`` (ties broken by ``tie_break`` ascending).

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each task keeps
    a bounded heap of n rows, so nothing large is sorted or shuffled.
    """
    return df.orderBy(F.col(by).desc(), *[F.col(c).asc() for c in tie_break]).limit(n)
