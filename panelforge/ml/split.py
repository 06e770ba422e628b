"""Time-ordered and seeded random splits.

Cut-offs are one-row statistics computed by a single aggregate and brought
to the driver as scalars (never data rows); the labelling is then a plain
projection, so splitting costs one extra scan and no shuffle of the data.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The expanding-origin folds (validation window quantiles).
DEFAULT_FOLDS = ((0.6, 0.7), (0.7, 0.8), (0.8, 0.9))
EPS_DAYS = 1e-9


def day_number(date: str) -> Column:
    return F.unix_date(F.col(date).cast("date"))


def quantile_day_expr(date: str, q: float) -> Column:
    """Whole-day cut-off: floor of the linearly interpolated quantile.

    ``percentile`` is exact; it keeps one counter per distinct day, which is
    bounded by the calendar length, not by the row count.
    """
    return F.floor(F.percentile(day_number(date), F.lit(q)) + F.lit(EPS_DAYS))


def date_quantiles(df: DataFrame, date: str, qs: Sequence[float]) -> DataFrame:
    """One row: ``q_<q>`` day numbers and dates for each quantile."""
    cols = []
    for q in qs:
        k = _qname(q)
        cols.append(quantile_day_expr(date, q).alias(f"day_{k}"))
    row = df.agg(*cols)
    return row.select(*[F.col(f"day_{_qname(q)}") for q in qs],
                      *[F.date_add(F.lit("1970-01-01").cast("date"),
                                   F.col(f"day_{_qname(q)}").cast("int")).alias(f"date_{_qname(q)}")
                        for q in qs])


def _qname(q: float) -> str:
    return f"{int(round(q * 100)):02d}"


def cutoff_days(df: DataFrame, date: str, qs: Sequence[float]) -> dict[float, int]:
    """Driver-side scalars for a set of quantiles (one aggregate job)."""
    row = df.agg(*[quantile_day_expr(date, q).alias(f"c{i}") for i, q in enumerate(qs)]).first()
    return {q: int(row[f"c{i}"]) for i, q in enumerate(qs)}


def split_time(df: DataFrame, *, date: str, test_size: float = 0.1,
               validation: tuple[float, float] | None = None, label: str = "split") -> DataFrame:
    """Label rows train / validation / test by date quantiles.

    Without ``validation``: train <= q(1-test), test > q(1-test).
    With (lo, hi): train <= q(lo), validation in (q(lo), q(hi)], test > q(1-test);
    rows between q(hi) and the test cut-off get NULL (in no split).
    """
    qs = [1 - test_size] + (list(validation) if validation else [])
    cut = cutoff_days(df, date, qs)
    day = day_number(date)
    test_cut = cut[1 - test_size]
    if validation is None:
        lab = F.when(day <= test_cut, "train").otherwise("test")
    else:
        lo, hi = cut[validation[0]], cut[validation[1]]
        lab = (F.when(day <= lo, "train")
                .when(day <= hi, "validation")
                .when(day > test_cut, "test"))
    return df.withColumn(label, lab)


def cv_folds(df: DataFrame, *, date: str, folds: Sequence[tuple[float, float]] = DEFAULT_FOLDS,
             test_size: float = 0.1, fold_col: str = "fold", label: str = "split") -> DataFrame:
    """Expanding-origin folds in one pass: one output row per (row, fold) it belongs to.

    All cut-offs come from one aggregate; the fold membership is an
    ``explode`` of literal structs (no union of several scans).
    """
    qs = sorted({q for f in folds for q in f} | {1 - test_size})
    cut = cutoff_days(df, date, qs)
    day = day_number(date)
    specs = []
    for lo, hi in folds:
        name = f"{lo:.1f}-{hi:.1f}"
        lab = F.when(day <= cut[lo], "train").when(day <= cut[hi], "validation")
        specs.append(F.struct(F.lit(name).alias("f"), lab.alias("s")))
    exploded = df.select("*", F.explode(F.array(*specs)).alias("__fs"))
    return (exploded.where(F.col("__fs.s").isNotNull())
            .select(*df.columns, F.col("__fs.f").alias(fold_col), F.col("__fs.s").alias(label)))


# ---- seeded random split with exact sizes ------------------------------

HASH_BITS = 52


def key_hash(keys: Sequence[str], seed: int) -> Column:
    """52-bit integer from md5(seed|key...): deterministic, engine-independent."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def split_random(df: DataFrame, *, keys: Sequence[str], test_size: float = 0.1, seed: int = 1,
                 label: str = "split", max_final_bucket: int = 50_000) -> DataFrame:
    """Exactly ceil(test_size * n) rows labelled test: the smallest hashes.

    Two-pass selection instead of a global sort: a histogram of the top hash
    bits (<= 65,536 rows to the driver) finds the bucket holding the cut
    rank; the bucket is refined on the next bits until it is small, and only
    that small bucket's (hash, key) pairs are ordered on the driver.
    """
    h = df.withColumn("__h", key_hash(keys, seed)).persist(StorageLevel.MEMORY_AND_DISK)
    n = h.count()
    n_test = int(math.ceil(test_size * n))
    if n_test <= 0:
        return df.withColumn(label, F.lit("train"))
    lo, hi = 0, (1 << HASH_BITS)          # current hash interval [lo, hi)
    rank = n_test                          # rank of the cut inside the interval
    bits = 16
    while True:
        width = hi - lo
        shift = max(0, (width - 1).bit_length() - bits)
        inside = h.where((F.col("__h") >= lo) & (F.col("__h") < hi))
        hist = (inside.groupBy(F.shiftright(F.col("__h") - F.lit(lo), shift).alias("b"))
                .count().orderBy("b").collect())
        run = 0
        for r in hist:
            if run + r["count"] >= rank:
                b, cnt = r["b"], r["count"]
                break
            run += r["count"]
        rank -= run
        lo, hi = lo + (b << shift), min(hi, lo + ((b + 1) << shift))
        if cnt <= max_final_bucket or shift == 0:
            break
    # order the small final bucket by (hash, key text) and take the cut row
    kcols = [F.col(k).cast("string") for k in keys]
    last = (h.where((F.col("__h") >= lo) & (F.col("__h") < hi))
            .select("__h", F.concat_ws("|", *kcols).alias("__k"))
            .orderBy("__h", "__k").limit(rank).collect()[-1])
    hk, kk = last["__h"], last["__k"]
    key_text = F.concat_ws("|", *kcols)
    is_test = (F.col("__h") < hk) | ((F.col("__h") == hk) & (key_text <= kk))
    return h.withColumn(label, F.when(is_test, "test").otherwise("train")).drop("__h")
