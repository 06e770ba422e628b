"""Joins of the panel build (J1-J8, J10) and row filters.

Broadcast hints are only placed on inputs whose size is bounded by the
hierarchy (nations, regions, states, one-row statistics). Every other join is
left to Spark: AQE turns it into a broadcast when run-time shuffle statistics
show a small side, and splits skewed partitions of sort-merge joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(k) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


#: Bytes of a table that is sent to every executor by hint.
BROADCAST_BYTES = 32 << 20


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own size estimate of a plan (files read, columns kept); nothing is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(dim: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint where the estimated size is at most ``max_bytes``; beyond it the plain DataFrame is
    returned and the join stays a shuffle join that AQE may still convert from run-time sizes."""
    return F.broadcast(dim) if estimated_bytes(dim) <= max_bytes else dim


def dim_join(fact: DataFrame, dim: DataFrame, on, how: str = "left", *, bounded: bool = False,
             max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join a fact table to a per-entity dimension.

    ``bounded=True`` marks a dimension bounded by a fixed hierarchy (e.g. 50
    states, 25 nations): it is broadcast after a size check; otherwise AQE
    decides from run-time sizes.
    """
    return fact.join(broadcast_if_small(dim, max_bytes) if bounded else dim, _keys(on), how)


def join_with_indicator(left: DataFrame, right: DataFrame, on, *, indicator: str = "_merge") -> DataFrame:
    """Left join that records provenance: 'both' or 'left_only'."""
    marker = "__right_marker"
    r = right.withColumn(marker, F.lit(True))
    j = left.join(r, _keys(on), "left")
    return (j.withColumn(indicator, F.when(F.col(marker), "both").otherwise("left_only"))
             .drop(marker))


def assert_full_coverage(left: DataFrame, right: DataFrame, on, sample: int = 5) -> None:
    """Every left row must find a match: anti-join count is 0, else raise with sample keys."""
    missing = left.select(*_keys(on)).join(right.select(*_keys(on)).distinct(), _keys(on), "left_anti")
    rows = missing.limit(sample).collect()
    if rows:
        raise AssertionError(f"rows without a match on {_keys(on)}, e.g. {[tuple(r) for r in rows]}")


def join_suffixed(left: DataFrame, right: DataFrame, on, how: str = "inner",
                  suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Join where non-key columns present on both sides get ``_x`` / ``_y``."""
    on = _keys(on)
    common = (set(left.columns) & set(right.columns)) - set(on)
    lx = left.withColumnsRenamed({c: c + suffixes[0] for c in common})
    ry = right.withColumnsRenamed({c: c + suffixes[1] for c in common})
    return lx.join(ry, on, how)


def share_of_total(df: DataFrame, *, entity, code: str, value: str, total_code: str = "00",
                   out: str = "share") -> DataFrame:
    """Value divided by the entity's own total row (code == total_code).

    One pass: the total is picked by a window per entity, whose partition
    holds one row per code of the level (bounded by the code list, e.g. the
    industry sectors), so no self-join re-reads the table. A missing or zero
    total gives NULL; the total rows themselves are dropped.
    """
    from pyspark.sql import Window
    w = Window.partitionBy(*_keys(entity))
    total = F.max(F.when(F.col(code) == total_code, F.col(value))).over(w)
    return (df.withColumn(out, F.try_divide(F.col(value).cast("double"), total.cast("double")))
              .where(F.col(code) != total_code))


# ---- filters ------------------------------------------------------------

def filter_latest(df: DataFrame, period: Column | str) -> DataFrame:
    """Rows of the latest period: a scalar subquery, evaluated once by Spark."""
    p = F.col(period) if isinstance(period, str) else period
    latest = df.select(F.max(p)).scalar()
    return df.where(p == latest)


def filter_code_level(df: DataFrame, code: str, level: int) -> DataFrame:
    return df.where(F.length(code) == level)


def entity_slice(df: DataFrame, entity: str, members: Sequence) -> DataFrame:
    return df.where(F.col(entity).isin(list(members)))
