"""Value ranges of bounded size, their order, and average ranks over them.

The values of a group (a column, or a pair of columns) are cut into ranges
until no range holds more than ``bound`` rows or a range is one value: a range
above the bound is cut again at quantiles of its own rows, as often as needed.
A hot value is a quantile of its range and becomes a range of its own. The
ranges, their order and their offsets stay in Spark; only the number of ranges
above the bound comes to the driver.

Cut points are checkpointed before use, so that a task that is run again after
an executor is lost cuts as the first one did.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Rows of a range that one task sorts.
RANGE_ROWS = 200_000
#: Quantiles at which a range above the bound is cut.
FANOUT = 64
#: Bytes of cut points or offsets that are sent to every executor.
BROADCAST_BYTES = 8 << 20


def _small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def cut_ranges(rows: DataFrame, group: str, value: str, *, out: str = "__range", bound: int = RANGE_ROWS,
               fanout: int = FANOUT, held: list | None = None) -> DataFrame:
    """rows (no missing values) with the text column ``out``, which orders the ranges of a group.

    Persisted tables are appended to ``held``; the caller releases them.
    """
    checkpoint_dir(rows.sparkSession)
    held = [] if held is None else held
    key = [group, out]
    qs = [i / fanout for i in range(1, fanout)]
    rows = rows.withColumn(out, F.lit("")).withColumn("__open", F.lit(True)).persist(StorageLevel.MEMORY_AND_DISK)
    held.append(rows)
    while True:
        large = (rows.where("__open").groupBy(*key)
                 .agg(F.count(F.lit(1)).alias("__n"), F.min(value).alias("__lo"), F.max(value).alias("__hi"))
                 .where((F.col("__n") > bound) & (F.col("__lo") < F.col("__hi"))).select(*key)
                 .persist(StorageLevel.MEMORY_AND_DISK))
        held.append(large)
        n = large.count()
        if n == 0:
            return rows.drop("__open")
        cuts = (rows.where("__open").join(_small(large, n, 64), key, "left_semi").groupBy(*key)
                .agg(F.array_distinct(F.percentile_approx(value, qs, 16 * fanout)).alias("__cuts")).checkpoint())
        # odd parts are single values: the cut points themselves
        part = (2 * F.size(F.filter("__cuts", lambda c: c < F.col(value)))
                + F.array_contains("__cuts", F.col(value)).cast("int"))
        width = len(str(2 * fanout))
        rows = (rows.join(_small(cuts, n, 64 + 8 * fanout), key, "left")
                .withColumn("__open", F.col("__cuts").isNotNull())
                .withColumn(out, F.when(F.col("__open"), F.concat(F.col(out), F.lpad(part.cast("string"), width, "0")))
                            .otherwise(F.col(out)))
                .drop("__cuts").persist(StorageLevel.MEMORY_AND_DISK))
        held.append(rows)


def range_table(rows: DataFrame, group: str, value: str, weight: Column, *, name: str = "__range") -> DataFrame:
    """One row per range: its number within the group, the weight before it, and whether it is one value."""
    per = rows.groupBy(group, name).agg(F.sum(weight).alias("__w"), F.min(value).alias("__lo"),
                                        F.max(value).alias("__hi"))
    w = Window.partitionBy(group).orderBy(name)           # one thin row per range
    before = F.sum("__w").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return per.select(group, name, (F.row_number().over(w) - 1).alias("__no"),
                      F.coalesce(before, F.lit(0)).alias("__before"),
                      (F.col("__lo") == F.col("__hi")).alias("__single"))


def value_ranks(values: DataFrame, group: str, value: str, count: str, *, bound: int = RANGE_ROWS,
                fanout: int = FANOUT, held: list | None = None) -> DataFrame:
    """(group, value, rank): average rank of every distinct value, which occurs ``count`` times in its group."""
    held = [] if held is None else held
    rows = cut_ranges(values, group, value, bound=bound, fanout=fanout, held=held)
    w = Window.partitionBy(group, "__range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    inner = F.coalesce(F.sum(count).over(w), F.lit(0)) + (F.col(count) + 1) / 2.0
    ranked = rows.select(group, value, "__range", inner.alias("__inner"))
    offsets = range_table(rows, group, value, F.col(count)).select(group, "__range", "__before")
    out = (ranked.join(offsets, [group, "__range"])
           .select(group, value, (F.col("__before") + F.col("__inner")).alias("rank"))
           .persist(StorageLevel.MEMORY_AND_DISK))
    held.append(out)
    return out
