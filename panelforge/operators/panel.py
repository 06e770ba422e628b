"""Entity-by-day panel windows and gap fills.

Contract: the input is a panel with one row per (entity, date), so a window
partition holds at most one row per calendar day of the study; a hot
entity in the raw data is reduced to this bound by the map-side combined
aggregation that builds the panel. All windows of one entity share one
partition/order spec, so Catalyst plans one Exchange, one Sort and one
Window node for all rolling and lag columns together.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, BooleanType


def _keys(k) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def entity_window(entity, order: str):
    return Window.partitionBy(*_keys(entity)).orderBy(order)


def rolling_mean(df: DataFrame, *, entity, order: str, columns: Sequence[str],
                 windows: Iterable[int] = (3, 7), name: str = "{col}_{w}d_avg",
                 calendar: bool = False) -> DataFrame:
    """Trailing mean over the last ``w`` rows (default) or ``w`` days.

    At least one value is needed; missing values are skipped, as a rolling
    mean with ``min_periods=1`` does. ``calendar=True`` uses a range frame on
    the day number instead of a row frame (gaps then shorten the window).
    """
    base = entity_window(entity, order)
    out = []
    for c in columns:
        for w in windows:
            if calendar:
                spec = (Window.partitionBy(*_keys(entity))
                        .orderBy(F.unix_date(F.col(order)))
                        .rangeBetween(-(w - 1), 0))
            else:
                spec = base.rowsBetween(-(w - 1), 0)
            out.append(F.avg(c).over(spec).alias(name.format(col=c, w=w)))
    return df.select("*", *out)


def lag_features(df: DataFrame, *, entity, order: str, columns: Sequence[str],
                 lags: Iterable[int] = (1, 3, 5, 7, 10), name: str = "lag{n}_{col}") -> DataFrame:
    """Value ``n`` rows earlier within the entity (NULL before the start)."""
    w = entity_window(entity, order)
    out = [F.lag(c, n).over(w).alias(name.format(n=n, col=c)) for n in lags for c in columns]
    return df.select("*", *out)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and not isinstance(f.dataType, BooleanType)
            and f.name not in skip]


def fill_parent_mean(df: DataFrame, *, parent, date: str, columns: Sequence[str],
                     then_zero: bool = False) -> DataFrame:
    """Fill gaps with the mean over all entities of the same parent and day.

    The means are one partial aggregate joined back on (parent, day), so a
    parent with very many entities never meets in one task: the aggregate
    combines map-side and the join is broadcast or split by AQE. ``then_zero``
    fills what is still missing with 0.
    """
    keys = [*_keys(parent), date]
    cols = [c for c in df.columns if c in set(columns)]
    agg = df.groupBy(*[F.col(k).alias(f"__pk_{k}") for k in keys]).agg(*[F.avg(c).alias(f"__pm_{c}") for c in cols])
    same = F.lit(True)
    for k in keys:                                        # null keys form a group of their own
        same = same & F.col(k).eqNullSafe(F.col(f"__pk_{k}"))
    src = df.join(agg, same, "left")
    means = {c: F.col(f"__pm_{c}") for c in cols}
    sel = []
    for c in df.columns:
        if c in cols:
            filled = F.coalesce(F.col(c).cast("double"), means[c])
            if then_zero:
                filled = F.coalesce(filled, F.lit(0.0))
            sel.append(filled.alias(c))
        else:
            sel.append(F.col(c))
    return src.select(*sel)


def fill_from_parent_table(df: DataFrame, parent_df: DataFrame, *, on, columns: Sequence[str],
                           suffix: str = "_state") -> DataFrame:
    """Fill ``c`` from the parent table's ``c`` (renamed ``c<suffix>``), then drop it.

    The parent table has one row per parent key (tens of rows for states):
    it is broadcast after a size check.
    """
    from .joins import broadcast_if_small
    on = _keys(on)
    p = parent_df.select(*on, *[F.col(c).alias(c + suffix) for c in columns])
    j = df.join(broadcast_if_small(p), on, "left")
    out = [F.coalesce(F.col(c), F.col(c + suffix)).alias(c) if c in columns else F.col(c)
           for c in df.columns]
    return j.select(*out)


def best_per_group(df: DataFrame, *, group, metric: str, keep_ties: bool = True) -> DataFrame:
    """Rows whose metric equals the group minimum (ties kept), de-duplicated.

    Minimum per group is a partial aggregate joined back (no un-ordered
    window holding a whole hot group in one task).
    """
    g = _keys(group)
    best = df.groupBy(*g).agg(F.min(metric).alias("__best"))
    out = (df.join(best, g).filter(F.col(metric) == F.col("__best")).drop("__best")
             .select(*df.columns))
    return out.distinct() if keep_ties else out.dropDuplicates(g)
