"""Profiles of a panel: grouped statistics, missing-data shares, correlations,
histograms (A1-A10, A14). Every profile is one or two aggregate jobs with
map-side combine; nothing is collected except one-row statistics and
per-bucket totals whose count is fixed by a parameter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import ranges as R


def _keys(k) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def group_mean(df: DataFrame, by, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*_keys(by)).agg(*[F.avg(c).alias(c) for c in columns])


def group_count(df: DataFrame, by, columns: Sequence[str]) -> DataFrame:
    """Non-missing cells per group and column."""
    return df.groupBy(*_keys(by)).agg(*[F.count(c).alias(c) for c in columns])


def group_min(df: DataFrame, by, columns: Sequence[str]) -> DataFrame:
    """Minimum of each column independently (values may come from different rows)."""
    return df.groupBy(*_keys(by)).agg(*[F.min(c).alias(c) for c in columns])


def missing_by_column(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Percent missing per column: one aggregate, then unpivot to (column, pct_missing)."""
    cols = list(columns or df.columns)
    wide = df.agg(*[(F.avg(F.col(f"`{c}`").isNull().cast("int")) * 100).alias(f"m{i}")
                    for i, c in enumerate(cols)])
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("pct_missing"))
                                  for i, c in enumerate(cols)]))
    return wide.select(stacked.alias("s")).select("s.column", "s.pct_missing")


def missing_by_date(df: DataFrame, *, date: str, entity: str, columns: Sequence[str],
                    zero_as_null: bool = False) -> DataFrame:
    """Percent of entities missing each column per date (0 when none is missing)."""
    out = []
    for c in columns:
        pct = (F.sum(F.col(c).isNull().cast("int")).cast("double")
               / F.count(entity).cast("double") * 100)
        if zero_as_null:
            pct = F.when(pct != 0, pct)
        out.append(pct.alias(f"{c}_pct_missing"))
    return df.groupBy(date).agg(*out)


def missing_by_entity(df: DataFrame, *, entity: str, date: str) -> DataFrame:
    """Rows per entity relative to the longest history, in percent."""
    counts = df.groupBy(entity).agg(F.count(date).alias("n_days"))
    longest = counts.select(F.max("n_days")).scalar()
    return counts.withColumn("pct_of_longest", F.col("n_days").cast("double") / longest.cast("double") * 100)


# ---- correlations -------------------------------------------------------

def corr_matrix(df: DataFrame, columns: Sequence[str], digits: int | None = 6) -> DataFrame:
    """Pearson correlation of every pair in one aggregate (pairwise-complete rows)."""
    cols = list(columns)
    exprs = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            exprs.append(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{i}|{cols.index(b)}"))
    row = df.agg(*exprs)
    cells = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            key = f"{min(i, j)}|{max(i, j)}"
            v = F.col(f"`{key}`")
            if digits is not None:
                v = F.round(v, digits)
            cells.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), v.alias("r")))
    return row.select(F.explode(F.array(*cells)).alias("s")).select("s.a", "s.b", "s.r")


def _long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(c, v): every value that is not missing, with its column."""
    return (df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v"))
                                          for c in cols])).alias("s"))
            .select("s.c", "s.v").where(F.col("v").isNotNull()))


def _long_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(p, x, y, c): distinct value pairs of every column pair's complete rows, with their counts."""
    return (df.select(F.explode(F.array(*[
        F.when(F.col(a).isNotNull() & F.col(b).isNotNull(),
               F.struct(F.lit(i).alias("p"), F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y")))
        for i, (a, b) in enumerate(pairs)])).alias("s")).where(F.col("s").isNotNull()).select("s.*")
        .groupBy("p", "x", "y").agg(F.count(F.lit(1)).alias("c")))


def average_rank(df: DataFrame, col: str, out: str = "rank", **ranges) -> DataFrame:
    """Average rank of ``col`` (ties share the mean of their positions); a missing value gets no rank."""
    return average_ranks(df, [col], "__r_", **ranges).withColumnRenamed(f"__r_{col}", out)


def average_ranks(df: DataFrame, cols: Sequence[str], prefix: str = "__r_", *, held: list | None = None,
                  **ranges) -> DataFrame:
    """Average ranks of several columns with shared jobs.

    Distributed prefix sum over distinct values with counts (a partial
    aggregate, so a hot value is one row): value ranges of bounded size
    (``ranges``: ``bound`` and ``fanout`` of ``ranges.cut_ranges``), a prefix
    sum over the ranges, and a window inside each range.
    """
    cols = list(cols)
    values = _long(df, cols).groupBy("c", "v").agg(F.count(F.lit(1)).alias("__cnt"))
    ranked = R.value_ranks(values, "c", "v", "__cnt", held=held, **ranges)
    out = df
    for c in cols:
        rc = ranked.where(F.col("c") == c).select(F.col("v").alias(f"__v_{c}"), F.col("rank").alias(prefix + c))
        out = (out.join(rc, F.col(c).cast("double") == F.col(f"__v_{c}"), "left").drop(f"__v_{c}"))
    return out


def spearman_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]], **ranges) -> dict:
    """Spearman correlation of several column pairs, each on its own complete
    rows, in shared jobs: distinct value pairs with counts, ranks per pair
    joined to them, and weighted moments about the known mean rank."""
    pairs, held = list(pairs), []
    cells = _long_pairs(df, pairs).persist(StorageLevel.MEMORY_AND_DISK)
    held.append(cells)
    joined = cells
    for side in ("x", "y"):
        values = cells.groupBy("p", side).agg(F.sum("c").alias("__cnt"))
        ranked = R.value_ranks(values, "p", side, "__cnt", held=held, **ranges)
        joined = joined.join(ranked.withColumnRenamed("rank", f"r{side}"), ["p", side])
    total = cells.groupBy("p").agg(((F.sum("c") + 1) / 2.0).alias("m"))          # one row per pair of columns
    u, v, c = F.col("rx") - F.col("m"), F.col("ry") - F.col("m"), F.col("c")
    got = {r["p"]: r["r"] for r in joined.join(F.broadcast(total), "p").groupBy("p").agg(
        F.sum(c * u * v).alias("uv"), F.sum(c * u * u).alias("uu"), F.sum(c * v * v).alias("vv"))
        .select("p", F.try_divide(F.col("uv"), F.sqrt(F.col("uu") * F.col("vv"))).alias("r")).collect()}
    for h in held:
        h.unpersist()
    return {pr: got.get(i) for i, pr in enumerate(pairs)}


def corr_spearman(df: DataFrame, columns: Sequence[str], digits: int | None = 6, **ranges) -> DataFrame:
    """Spearman correlation = Pearson correlation of average ranks.

    Columns without missing values are ranked together once (shared jobs); a
    pair involving a column with gaps is ranked on its own complete rows
    (pairwise-complete, as the reference's correlation does).
    """
    cols = list(columns)
    nulls = df.agg(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in cols]).first()
    complete = [c for c in cols if not nulls[c]]
    pairs = {}
    if len(complete) > 1:
        held: list = []
        ranked = average_ranks(df.select(*complete), complete, "__r_", held=held, **ranges)
        exprs = [F.corr(f"__r_{a}", f"__r_{b}").alias(f"{a}|{b}")
                 for i, a in enumerate(complete) for b in complete[i + 1:]]
        row = ranked.agg(*exprs).first()
        pairs.update({tuple(k.split("|")): row[k] for k in row.asDict()})
        for h in held:
            h.unpersist()
    rest = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:] if (a, b) not in pairs]
    if rest:
        pairs.update(spearman_pairs(df, rest, **ranges))
    rows = []
    for a in cols:
        for b in cols:
            r = 1.0 if a == b else pairs.get((a, b), pairs.get((b, a)))
            rows.append((a, b, None if r is None else float(r)))
    out = df.sparkSession.createDataFrame(rows, "a string, b string, r double")
    return out.withColumn("r", F.round("r", digits)) if digits is not None else out


# ---- histogram ----------------------------------------------------------

def histogram(df: DataFrame, columns: Sequence[str], n_bins: int = 40) -> DataFrame:
    """Equal-width bins per column (last bin closed): (column, bin, lo, count).

    Bounds are one aggregate (a one-row statistic); binning is a projection
    and the counts one grouped aggregate with map-side combine.
    """
    cols = list(columns)
    st = df.agg(*[F.min(c).cast("double").alias(f"lo{i}") for i, c in enumerate(cols)],
                *[F.max(c).cast("double").alias(f"hi{i}") for i, c in enumerate(cols)]).first()
    cells = []
    for i, c in enumerate(cols):
        lo, hi = st[f"lo{i}"], st[f"hi{i}"]
        if lo is None:
            continue
        w = (hi - lo) / n_bins
        x = F.col(c).cast("double")
        b = F.lit(0) if w == 0 else F.least(F.floor((x - F.lit(lo)) / F.lit(w)), F.lit(n_bins - 1))
        edge = F.lit(lo) + b.cast("double") * F.lit(w)
        cells.append(F.when(x.isNotNull(), F.struct(F.lit(c).alias("column"), b.cast("int").alias("bin"),
                                                     edge.alias("lo"))))
    long = df.select(F.explode(F.array(*cells)).alias("s")).where(F.col("s").isNotNull())
    return long.groupBy("s.column", "s.bin", "s.lo").agg(F.count(F.lit(1)).alias("count"))


# ---- exact quantiles by selection (no per-group map of distinct values) ----

#: Distinct values (of all columns and groups together) that one task may count.
MAX_COUNTED_VALUES = 200_000


def _counted_quantiles(rows: DataFrame, columns: Sequence[str], q: float, most: int) -> dict | None:
    """Quantiles from counts of the distinct values; None where these may be more than ``most``.

    One aggregate bounds the distinct values (an estimate with 2 % deviation, taken three deviations up), a second
    counts them and interpolates; both have one row per group.
    """
    sizes = rows.groupBy("__g").agg(*[F.approx_count_distinct(f"c{i}", 0.02).alias(f"c{i}")
                                      for i in range(len(columns))]).collect()
    if sum(r[f"c{i}"] for r in sizes for i in range(len(columns))) * 1.06 > most:
        return None
    found = rows.groupBy("__g").agg(*[F.percentile(f"c{i}", q).alias(f"c{i}") for i in range(len(columns))]).collect()
    return {(r["__g"], c): r[f"c{i}"] for r in found for i, c in enumerate(columns)} or {(None, c): None for c in columns}


def exact_quantiles(df: DataFrame, columns: Sequence[str], q: float = 0.5, *, by: str | None = None,
                    n_buckets: int = 4096, small: int = 50_000, counted: int = MAX_COUNTED_VALUES) -> dict:
    """Exact linearly interpolated quantile of each column (per group of ``by``).

    Columns with few distinct values (``counted`` over all columns and groups)
    are counted by value in one aggregate over the rows as they are. For the
    others it is selection instead of sorting or a map of distinct values: each pass is
    ONE grouped aggregate of (count, min, max) over equal-width buckets of
    the current candidate interval of every target order statistic; the
    bucket holding the wanted rank becomes the next interval (membership is
    the chain of bucket conditions, so it is exact). A bucket whose min equals
    its max resolves at once (a hot value). Every level strictly narrows the
    interval, so the passes end by themselves. Buckets are fetched and sorted
    on the driver while all of them together hold at most ``small`` values;
    the others go on being narrowed. Returns {(group, column): value}
    (group is None without ``by``); all-missing columns give None.
    """
    gcol = F.col(by) if by else F.lit(None).cast("string")
    values = [F.col(f"`{c}`").cast("double") for c in columns]
    rows = df.select(gcol.alias("__g"), *[F.when(~F.isnan(v), v).alias(f"c{i}") for i, v in enumerate(values)])
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)     # a few passes read the cached rows
    try:
        found = _counted_quantiles(rows, columns, q, counted)
        return _selected_quantiles(rows, columns, q, n_buckets, small) if found is None else found
    finally:
        rows.unpersist()


def _selected_quantiles(rows: DataFrame, columns: Sequence[str], q: float, n_buckets: int, small: int) -> dict:
    """The selection of ``exact_quantiles`` over rows of (__g, c0, c1, ...)."""
    import math as _m
    long = (rows.select("__g", F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col(f"c{i}").alias("v")) for i, c in enumerate(columns)])).alias("s"))
              .select("__g", F.col("s.c").alias("__c"), F.col("s.v").alias("__v"))
              .where(F.col("__v").isNotNull()))
    stats = long.groupBy("__g", "__c").agg(F.count(F.lit(1)).alias("n"), F.min("__v").alias("lo"),
                                           F.max("__v").alias("hi")).collect()
    budget = small        # values that may still be fetched, over all targets
    targets = {}          # id -> dict(key, rank, chain, lo, hi, value)
    keys = {}
    for r in stats:
        key = (r["__g"], r["__c"])
        pos = (r["n"] - 1) * q
        ranks = sorted({int(_m.floor(pos)), int(_m.ceil(pos))})
        keys[key] = (pos, ranks)
        for rk in ranks:
            t = dict(key=key, rank=rk, orig=rk, chain=[], lo=r["lo"], hi=r["hi"], value=None)
            if r["lo"] == r["hi"]:
                t["value"] = r["lo"]
            elif r["n"] <= budget:
                t["fetch"] = True          # already small: no histogram pass needed
                budget -= r["n"]
            targets[len(targets)] = t

    def member(t):
        cond = (F.col("__c") == t["key"][1])
        cond = cond & (F.col("__g").isNull() if t["key"][0] is None else (F.col("__g") == F.lit(t["key"][0])))
        for lo, w, b in t["chain"]:
            cond = cond & (F.least(F.floor((F.col("__v") - F.lit(lo)) / F.lit(w)), F.lit(n_buckets - 1)) == b)
        return cond

    def per_column(cells, kind):
        """A value meets the targets of its own column only."""
        e = None
        for c in sorted({c for c, _ in cells}):
            own = F.array(*[x for name, x in cells if name == c])
            e = F.when(F.col("__c") == c, own) if e is None else e.when(F.col("__c") == c, own)
        return long.select(F.explode(e).alias(kind), "__v").where(F.col(kind).isNotNull())

    while True:
        open_t = {i: t for i, t in targets.items() if t["value"] is None and not t.get("fetch")}
        if not open_t:
            break
        cells = []
        for i, t in open_t.items():
            w = t["hi"] / n_buckets - t["lo"] / n_buckets
            b = F.least(F.floor((F.col("__v") - F.lit(t["lo"])) / F.lit(w)), F.lit(n_buckets - 1)).cast("int")
            cells.append((t["key"][1], F.when(member(t), F.struct(F.lit(i).alias("t"), b.alias("b")))))
        hist = (per_column(cells, "x")
                    .groupBy("x.t", "x.b").agg(F.count(F.lit(1)).alias("n"), F.min("__v").alias("mn"),
                                                F.max("__v").alias("mx"))
                    .collect())
        by_t: dict = {}
        for r in hist:
            by_t.setdefault(r["t"], []).append(r)
        for i, t in open_t.items():
            run = 0
            for r in sorted(by_t.get(i, []), key=lambda r: r["b"]):
                if run + r["n"] > t["rank"]:
                    w = t["hi"] / n_buckets - t["lo"] / n_buckets
                    t["chain"].append((t["lo"], w, r["b"]))
                    t["rank"] -= run
                    if r["mn"] == r["mx"]:
                        t["value"] = r["mn"]
                    elif r["n"] <= budget:
                        t["fetch"] = True
                        budget -= r["n"]
                    else:
                        t["lo"], t["hi"] = r["mn"], r["mx"]
                    break
                run += r["n"]
    fetch = {i: t for i, t in targets.items() if t["value"] is None}
    if fetch:
        rows = per_column([(t["key"][1], F.when(member(t), F.lit(i))) for i, t in fetch.items()], "t").collect()
        vals: dict = {}
        for r in rows:
            vals.setdefault(r["t"], []).append(r["__v"])
        for i, t in fetch.items():
            t["value"] = sorted(vals[i])[t["rank"]]
    found = {(t["key"], t["orig"]): t["value"] for t in targets.values()}
    out = {}
    for key, (pos, ranks) in keys.items():
        lo_v, hi_v = found[(key, ranks[0])], found[(key, ranks[-1])]
        frac = pos - ranks[0]
        out[key] = lo_v + (hi_v - lo_v) * frac if frac else lo_v
    for c in columns:
        for g in {k[0] for k in keys} or {None}:
            out.setdefault((g, c), None)
    return out


# ---- Kendall tau-b without a table of pairs --------------------------------

def _weighted_inversions(xs, ys, ws) -> float:
    """Weighted count of pairs with x_i < x_j and y_i > y_j (cells are distinct (x, y)).

    Two different ranks of y first differ in one binary digit, below a common
    prefix: for every digit, the weight of earlier cells of the same prefix
    with a 1 there is summed over the cells with a 0 there.
    """
    import numpy as np
    order = np.lexsort((ys, xs))                          # equal x: y rises, no inversion
    rank = np.unique(np.asarray(ys)[order], return_inverse=True)[1]
    w = np.asarray(ws, np.float64)[order]
    total = 0.0
    for digit in range(int(rank.max(initial=0)).bit_length()):
        o = np.argsort(rank >> (digit + 1), kind="stable")
        node, one, weight = (rank >> (digit + 1))[o], ((rank >> digit) & 1)[o], w[o]
        ones = weight * one
        run = np.cumsum(ones)
        first = np.searchsorted(node, node, "left")
        total += float((weight * (1 - one) * (run - run[first] + ones[first])).sum())
    return total


def _grid_inversions(grid: DataFrame) -> dict:
    """The same count over (p, xb, yb, c) cells of range numbers, in Spark: one
    aggregate and one window serve all digits of yb. A window partition holds
    at most one row per x range."""
    top = grid.agg(F.max("yb")).first()[0]
    if not top:
        return {}
    digits = F.sequence(F.lit(0), F.lit(int(top).bit_length() - 1))
    at = (grid.select("p", "xb", "yb", F.col("c").cast("double").alias("c"), F.explode(digits).alias("digit"))
          .select("p", "xb", "c", "digit", F.expr("shiftright(yb, digit + 1)").alias("node"),
                  F.expr("shiftright(yb, digit) & 1").alias("one")))
    sums = at.groupBy("p", "digit", "node", "xb").agg(F.sum(F.col("c") * F.col("one")).alias("ones"),
                                                      F.sum(F.col("c") * (1 - F.col("one"))).alias("zeros"))
    w = Window.partitionBy("p", "digit", "node").orderBy("xb").rowsBetween(Window.unboundedPreceding, -1)
    met = sums.select("p", (F.col("zeros") * F.coalesce(F.sum("ones").over(w), F.lit(0.0))).alias("d"))
    return {r["p"]: r["d"] for r in met.groupBy("p").agg(F.sum("d").alias("d")).collect()}


def kendall_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]], **ranges) -> dict:
    """Kendall's tau-b for several column pairs at once (pairwise-complete rows).

    Distinct (x, y) cells with counts are cut into x and y ranges of bounded
    size (``ranges``: ``bound`` and ``fanout`` of ``ranges.cut_ranges``).
    Discordant pairs = pairs in different x and y ranges (prefix sums over the
    cells of range numbers, in Spark) + pairs inside one y range + pairs inside
    one x range - pairs inside both. The inside counts are weighted inversion
    counts of one range (``applyInPandas``); a hot value is a range of its own,
    holds no discordant pair and is never shipped. All pairs share the jobs.
    """
    import pandas as pd
    pairs, held = list(pairs), []
    cells = R.cut_ranges(_long_pairs(df, pairs), "p", "x", out="__xr", held=held, **ranges)
    cells = R.cut_ranges(cells, "p", "y", out="__yr", held=held, **ranges)
    for side in ("x", "y"):
        t = R.range_table(cells, "p", side, F.col("c"), name=f"__{side}r")
        cells = cells.join(t.select("p", f"__{side}r", F.col("__no").alias(f"{side}b"),
                                    F.col("__single").alias(f"{side}1")), ["p", f"__{side}r"])
    cells = cells.drop("__xr", "__yr").persist(StorageLevel.MEMORY_AND_DISK)
    held.append(cells)
    tie = lambda t: F.sum(F.col(t) * (F.col(t) - 1) / 2)
    n_all = {r["p"]: (r["n"], r["n3"]) for r in cells.groupBy("p").agg(
        F.sum("c").alias("n"), tie("c").alias("n3")).collect()}
    n1 = {r["p"]: r["v"] for r in cells.groupBy("p", "x").agg(F.sum("c").alias("t"))
          .groupBy("p").agg(tie("t").alias("v")).collect()}
    n2 = {r["p"]: r["v"] for r in cells.groupBy("p", "y").agg(F.sum("c").alias("t"))
          .groupBy("p").agg(tie("t").alias("v")).collect()}
    apart = _grid_inversions(cells.groupBy("p", "xb", "yb").agg(F.sum("c").alias("c")))
    none = F.lit(-1)
    groups = F.array(
        F.when(~F.col("x1"), F.struct(F.lit(1).alias("sign"), F.col("xb").alias("i"), none.alias("j"))),
        F.when(~F.col("y1"), F.struct(F.lit(1).alias("sign"), none.alias("i"), F.col("yb").alias("j"))),
        F.when(~F.col("x1") & ~F.col("y1"),
               F.struct(F.lit(-1).alias("sign"), F.col("xb").alias("i"), F.col("yb").alias("j"))))
    grouped = (cells.select("p", "x", "y", "c", F.explode(groups).alias("g")).where(F.col("g").isNotNull())
               .select("p", "g.*", "x", "y", "c"))

    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        d = _weighted_inversions(pdf["x"].to_numpy(), pdf["y"].to_numpy(), pdf["c"].to_numpy())
        return pd.DataFrame({"p": [int(pdf["p"].iat[0])], "d": [int(pdf["sign"].iat[0]) * d]})
    within = {r["p"]: r["d"] for r in grouped.groupBy("p", "sign", "i", "j").applyInPandas(inside, "p int, d double")
              .groupBy("p").agg(F.sum("d").alias("d")).collect()}
    for h in held:
        h.unpersist()
    out = {}
    for i, pr in enumerate(pairs):
        if i not in n_all or n_all[i][0] < 2:
            out[pr] = None
            continue
        n, n3 = n_all[i]
        n_d = apart.get(i, 0.0) + within.get(i, 0.0)
        n0 = n * (n - 1) / 2
        den = ((n0 - (n1.get(i) or 0)) * (n0 - (n2.get(i) or 0))) ** 0.5
        out[pr] = None if den == 0 else (n0 - (n1.get(i) or 0) - (n2.get(i) or 0) + (n3 or 0) - 2 * n_d) / den
    return out


def kendall_tau_b(df: DataFrame, a: str, b: str, **ranges) -> float | None:
    """Kendall's tau-b of two columns over their complete rows."""
    return kendall_pairs(df, [(a, b)], **ranges)[(a, b)]


def corr_kendall(df: DataFrame, columns: Sequence[str], digits: int | None = 6, **ranges) -> DataFrame:
    """Kendall tau-b matrix (pairwise-complete rows) as (a, b, r); all pairs in shared jobs."""
    cols = list(columns)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    vals = kendall_pairs(df, pairs, **ranges) if pairs else {}
    rows = [(a, b, 1.0 if a == b else vals.get((a, b), vals.get((b, a)))) for a in cols for b in cols]
    out = df.sparkSession.createDataFrame(rows, "a string, b string, r double")
    return out.withColumn("r", F.round("r", digits)) if digits is not None else out


# ---- whole-table entry points ------------------------------------------------

def _numeric(df: DataFrame) -> list[str]:
    from pyspark.sql.types import BooleanType, NumericType
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and not isinstance(f.dataType, BooleanType)]


def numeric_correlations(df: DataFrame, method: str = "pearson", digits: int | None = 6) -> DataFrame:
    """Pairwise correlations of every numeric column: 'pearson', 'spearman' or 'kendall'."""
    cols = _numeric(df)
    if method == "pearson":
        return corr_matrix(df, cols, digits)
    if method == "spearman":
        return corr_spearman(df, cols, digits)
    if method == "kendall":
        return corr_kendall(df, cols, digits)
    raise ValueError(f"unknown method {method!r}")


def numeric_histograms(df: DataFrame, n_bins: int = 40) -> DataFrame:
    """Equal-width histograms of every numeric column (missing values skipped).
    A log-scaled display changes only the axis, not these counts."""
    return histogram(df, _numeric(df), n_bins)
