"""Column-level operators (P6, P17-P26): selection by pattern, renames,
recodes, fills, dummies. All are plan-time rewrites of the projection, except
``drop_empty_columns`` which needs one aggregate over every column."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def correct_keys(c, rules: Sequence[tuple[str, str]], *, first: bool = True) -> Column:
    """Code -> code corrections applied to the original value.

    Rules are checked in order; the first rule whose source matches wins
    (a later rule with the same source never fires). With ``first=False`` a
    source listed twice is rejected.
    """
    seen: dict[str, str] = {}
    for a, b in rules:
        if a in seen and not first:
            raise ValueError(f"key {a!r} is mapped to both {seen[a]!r} and {b!r}")
        seen.setdefault(a, b)
    col = F.col(c) if isinstance(c, str) else c
    expr = None
    for a, b in seen.items():
        expr = (F.when(col == a, F.lit(b)) if expr is None else expr.when(col == a, F.lit(b)))
    return col if expr is None else expr.otherwise(col)


def one_hot(c, categories: Sequence, prefix: str) -> list[Column]:
    """One 0/1 column per category, named ``<prefix>_<value>``."""
    col = F.col(c) if isinstance(c, str) else c
    return [F.when(col == F.lit(v), 1).otherwise(0).alias(f"{prefix}_{v}") for v in categories]


#: Columns that a dummy expansion makes at most.
MAX_CATEGORIES = 1000


class TooManyCategories(ValueError):
    """A column has more distinct values than a dummy expansion may make columns."""


def observed_categories(df: DataFrame, c: str, *, most: int = MAX_CATEGORIES) -> list:
    """Distinct values of a low-cardinality column (sorted, without null).

    At most ``most`` values reach the driver; a column with more is an error,
    since each value becomes a column of the plan.
    """
    found = df.select(F.col(c).alias("v")).where(F.col("v").isNotNull()).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise TooManyCategories(f"column {c!r} has more than {most} distinct values")
    return sorted(r["v"] for r in found)


def select_pattern(columns: Sequence[str], *, keep: Iterable[str] = (), prefix: Iterable[str] = (),
                   suffix: Iterable[str] = (), contains: Iterable[str] = (),
                   drop_prefix: Iterable[str] = (), drop_suffix: Iterable[str] = (),
                   drop_contains: Iterable[str] = ()) -> list[str]:
    """Plan-time column list: keys + columns matching any include rule,
    minus those matching any drop rule (prefixes are plain string prefixes,
    so dropping 'lag1' also drops 'lag10...')."""
    prefix, suffix, contains = tuple(prefix), tuple(suffix), tuple(contains)
    drop_prefix, drop_suffix, drop_contains = tuple(drop_prefix), tuple(drop_suffix), tuple(drop_contains)
    include_all = not (prefix or suffix or contains)
    keep = list(keep)
    out = []
    for c in columns:
        if c in keep:
            out.append(c)
            continue
        inc = include_all or (bool(prefix) and c.startswith(prefix)) \
            or (bool(suffix) and c.endswith(suffix)) or any(s in c for s in contains)
        if not inc:
            continue
        if (drop_prefix and c.startswith(drop_prefix)) or (drop_suffix and c.endswith(drop_suffix)) \
                or any(s in c for s in drop_contains):
            continue
        out.append(c)
    return out


def parse_rename_map(text: str) -> dict[str, str]:
    """Lines ``old:new`` (spaces around tokens allowed); blank lines skipped."""
    out = {}
    for line in text.splitlines():
        if not line.strip():
            continue
        old, sep, new = line.partition(":")
        if not sep:
            raise ValueError(f"bad rename line {line!r}")
        out[old.strip()] = new.strip()
    return out


def rename_strict(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename; an unknown source name is an error (Spark would ignore it)."""
    missing = [k for k in mapping if k not in df.columns]
    if missing:
        raise KeyError(f"columns not found for rename: {missing}")
    return df.withColumnsRenamed(dict(mapping))


def rename_affix(df: DataFrame, *, keys: Iterable[str] = (), prefix: str = "", suffix: str = "") -> DataFrame:
    keys = set(keys)
    return df.withColumnsRenamed({c: f"{prefix}{c}{suffix}" for c in df.columns if c not in keys})


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns with no non-missing value: one aggregate for all columns."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    empty = [c for i, c in enumerate(df.columns) if counts[f"c{i}"] == 0]
    return df.drop(*empty)


def recode(c, mapping: Mapping, *, keep_unmapped: bool = False) -> Column:
    """Map values (e.g. yes/no -> 1/0); unmapped values become NULL or stay."""
    col = F.col(c) if isinstance(c, str) else c
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    if expr is None:
        return col
    return expr.otherwise(col) if keep_unmapped else expr


def fill_constant(df: DataFrame, value, columns: Sequence[str] | None = None) -> DataFrame:
    return df.fillna(value, subset=list(columns) if columns else None)


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=list(subset) if subset else None)


def project_relabel(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Keep only the listed columns, under display names."""
    return df.select(*[F.col(k).alias(v) for k, v in labels.items()])


_SAFE = re.compile(r"[^0-9A-Za-z_]+")


def safe_name(v) -> str:
    return _SAFE.sub("_", str(v))
