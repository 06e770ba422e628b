"""Query keys for grouped profiles, missing data, correlations, histograms,
date quantiles (A1-A11) and reshape/union/sort (R*, U*, L*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..ml import split as S
from ..operators import profile as A
from ..operators import reshape as R
from .bindings import EVENT_TYPES, ev, panel_e, panel_n, table, with_ctes
from .catalog import register

_T = EVENT_TYPES


@register("group_mean", with_ctes(
    "SELECT parent, d, " + ", ".join(f"avg({c}) AS {c}" for c in _T) + " FROM panel_e GROUP BY parent, d",
    "panel_e"))
def group_mean(spark, sf_dir):
    return A.group_mean(panel_e(spark, sf_dir), ["parent", "d"], _T)


@register("group_count", with_ctes(
    "SELECT parent, " + ", ".join(f"count({c}) AS {c}" for c in _T) + " FROM panel_e GROUP BY parent",
    "panel_e"))
def group_count(spark, sf_dir):
    return A.group_count(panel_e(spark, sf_dir), "parent", _T)


@register("group_min", with_ctes(
    "SELECT parent, " + ", ".join(f"min({c}) AS {c}" for c in _T) + ", min(d) AS d FROM panel_e GROUP BY parent",
    "panel_e"))
def group_min(spark, sf_dir):
    return A.group_min(panel_e(spark, sf_dir), "parent", _T + ["d"])


@register("distinct_rows", """
SELECT DISTINCT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal < 0""")
def distinct_rows(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.where(F.col("c_acctbal") < 0).select("c_nationkey", "c_mktsegment").distinct()


_WITH_EMPTY = "SELECT *, CAST(NULL AS BIGINT) AS empty FROM panel_e"


@register("missing_by_column", with_ctes(
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", avg(CAST({c} IS NULL AS INTEGER)) * 100 AS pct_missing "
                       f"FROM ({_WITH_EMPTY}) t"
                       for c in ["entity", "parent", "d"] + _T + ["empty"]), "panel_e"))
def missing_by_column(spark, sf_dir):
    return A.missing_by_column(panel_e(spark, sf_dir).withColumn("empty", F.lit(None).cast("bigint")))


@register("missing_by_date", with_ctes(
    "SELECT d, " + ", ".join(
        f"CAST(sum(CAST({c} IS NULL AS INTEGER)) AS DOUBLE) / CAST(count(entity) AS DOUBLE) * 100 "
        f"AS {c}_pct_missing" for c in _T) + " FROM panel_e GROUP BY d", "panel_e"))
def missing_by_date(spark, sf_dir):
    return A.missing_by_date(panel_e(spark, sf_dir), date="d", entity="entity", columns=_T)


@register("missing_by_entity", with_ctes("""
SELECT entity, n_days, CAST(n_days AS DOUBLE) / CAST(max(n_days) OVER () AS DOUBLE) * 100 AS pct_of_longest
  FROM (SELECT entity, count(d) AS n_days FROM panel_n GROUP BY entity) t""", "panel_n"))
def missing_by_entity(spark, sf_dir):
    return A.missing_by_entity(panel_n(spark, sf_dir), entity="entity", date="d")


@register("corr_matrix", with_ctes(
    " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) "
                       f"AS r FROM panel_e" for a in _T for b in _T), "panel_e"))
def corr_matrix(spark, sf_dir):
    return A.corr_matrix(panel_e(spark, sf_dir), _T)


_SP_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _spearman_sql():
    ranks = ", ".join(
        f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS r_{c}" for c in _SP_COLS)
    parts = []
    for a in _SP_COLS:
        for b in _SP_COLS:
            if a == b:
                parts.append(f"SELECT '{a}' AS a, '{b}' AS b, CAST(1.0 AS DOUBLE) AS r")
            else:
                parts.append(f"SELECT '{a}' AS a, '{b}' AS b, round(corr(r_{a}, r_{b}), 6) AS r FROM rk")
    return f"WITH rk AS (SELECT {ranks} FROM lineitem)\n" + " UNION ALL ".join(parts)


@register("corr_spearman", _spearman_sql())
def corr_spearman(spark, sf_dir):
    return A.corr_spearman(table(spark, sf_dir, "lineitem").select(*_SP_COLS), _SP_COLS)


_H_COLS = ["l_quantity", "l_extendedprice"]


def _hist_sql():
    parts = []
    for c in _H_COLS:
        parts.append(f"""SELECT '{c}' AS "column", b AS bin, lo + CAST(b AS DOUBLE) * w AS lo, count(*) AS "count"
  FROM (SELECT CAST(least(floor(({c} - lo) / w), 39) AS INTEGER) AS b, lo, w
          FROM lineitem, (SELECT CAST(min({c}) AS DOUBLE) AS lo,
                                 (CAST(max({c}) AS DOUBLE) - CAST(min({c}) AS DOUBLE)) / 40 AS w FROM lineitem) s
         WHERE {c} IS NOT NULL) t
 GROUP BY b, lo, w""")
    return " UNION ALL ".join(parts)


@register("histogram", _hist_sql())
def histogram(spark, sf_dir):
    return A.histogram(table(spark, sf_dir, "lineitem"), _H_COLS, 40)


_QS = (0.6, 0.7, 0.8, 0.9)


@register("date_quantile", with_ctes(
    "SELECT " + ", ".join(
        f"CAST(floor(quantile_cont(date_diff('day', DATE '1970-01-01', d), {q}) + 1e-9) AS BIGINT) AS day_{int(q * 100)}"
        for q in _QS) + ", "
    + ", ".join(
        f"CAST(DATE '1970-01-01' + CAST(floor(quantile_cont(date_diff('day', DATE '1970-01-01', d), {q}) + 1e-9) "
        f"AS INTEGER) AS DATE) AS date_{int(q * 100)}" for q in _QS)
    + " FROM panel_n", "panel_n"))
def date_quantile(spark, sf_dir):
    return S.date_quantiles(panel_n(spark, sf_dir), "d", _QS)


# ---- reshape, union, sort ----------------------------------------------

_EV_COUNTS_SQL = "SELECT entity, d, event_type, count(*) AS n_events FROM ev GROUP BY entity, d, event_type"


@register("pivot_strict", with_ctes(
    f", cnt AS ({_EV_COUNTS_SQL})\nSELECT entity, d, "
    + ", ".join(f"max(CASE WHEN event_type = '{t}' THEN n_events END) AS {t}_n_events" for t in _T)
    + " FROM cnt GROUP BY entity, d", "ev").replace("\n, cnt", ", cnt"))
def pivot_strict(spark, sf_dir):
    long = ev(spark, sf_dir).groupBy("entity", "d", "event_type").agg(F.count(F.lit(1)).alias("n_events"))
    return R.pivot_strict(long, keys=["entity", "d"], pivot="event_type", value="n_events", values=_T,
                          name="{category}_{value}")


@register("pivot_mean", with_ctes(
    "SELECT entity, " + ", ".join(f"avg(CASE WHEN event_type = '{t}' THEN cents END) AS {t}" for t in _T)
    + " FROM ev GROUP BY entity", "ev"))
def pivot_mean(spark, sf_dir):
    return R.pivot_mean(ev(spark, sf_dir), keys="entity", pivot="event_type", value="cents", values=_T)


@register("unpivot", with_ctes(
    " UNION ALL ".join(f"SELECT entity, d, '{t}' AS event_type, {t} AS cents FROM panel_e" for t in _T),
    "panel_e"))
def unpivot(spark, sf_dir):
    return R.unpivot(panel_e(spark, sf_dir).drop("parent"), ids=["entity", "d"], columns=_T,
                     var="event_type", value="cents")


@register("union_all", with_ctes(
    "SELECT event_id, entity, d, cents FROM ev WHERE event_type = 'click' "
    "UNION ALL SELECT event_id, entity, d, cents FROM ev WHERE event_type = 'view'", "ev"))
def union_all(spark, sf_dir):
    e = ev(spark, sf_dir)
    cols = ["event_id", "entity", "d", "cents"]
    return R.union_all([e.where(F.col("event_type") == "click").select(*cols),
                        e.where(F.col("event_type") == "view").select(*cols)])


@register("union_by_name", """
SELECT p_partkey, p_size, CAST(NULL AS DOUBLE) AS p_retailprice FROM part WHERE p_size < 25
UNION ALL SELECT p_partkey, CAST(NULL AS INTEGER) AS p_size, p_retailprice FROM part WHERE p_size >= 25""")
def union_by_name(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return R.union_by_name([p.where(F.col("p_size") < 25).select("p_partkey", "p_size"),
                            p.where(F.col("p_size") >= 25).select("p_partkey", "p_retailprice")])


@register("append_summary_row", """
SELECT p_type, count(*) AS n_parts, CAST(sum(p_size) AS BIGINT) AS total_size FROM part GROUP BY p_type
UNION ALL SELECT 'ALL' AS p_type, count(*) AS n_parts, CAST(sum(p_size) AS BIGINT) AS total_size FROM part""")
def append_summary_row(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    by = p.groupBy("p_type").agg(F.count(F.lit(1)).alias("n_parts"), F.sum("p_size").alias("total_size"))
    tot = p.agg(F.lit("ALL").alias("p_type"), F.count(F.lit(1)).alias("n_parts"),
                F.sum("p_size").alias("total_size"))
    return R.append_summary_row(by, tot)


@register("leaderboard_sort", """
SELECT p_brand, avg(CAST(round(p_retailprice * 100) AS BIGINT)) AS avg_price_cents, count(*) AS n_parts
  FROM part GROUP BY p_brand ORDER BY avg_price_cents, p_brand""")
def leaderboard_sort(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    agg = p.groupBy("p_brand").agg(F.avg(F.round(F.col("p_retailprice") * 100).cast("bigint")).alias("avg_price_cents"),
                                   F.count(F.lit(1)).alias("n_parts"))
    return R.sort_by(agg, "avg_price_cents", "p_brand")


@register("top_n", """
SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 50""")
def top_n(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    return R.top_n(p, 50, "p_retailprice", ["p_partkey"])


_K_COLS = ["s_acctbal", "s_nationkey", "s_suppkey"]


def _kendall_sql():
    parts = []
    for a in _K_COLS:
        for b in _K_COLS:
            if a == b:
                parts.append(f"SELECT '{a}' AS a, '{b}' AS b, CAST(1.0 AS DOUBLE) AS r")
            else:
                parts.append(f"""SELECT '{a}' AS a, '{b}' AS b,
       round(sum(sign(p.{a} - q.{a}) * sign(p.{b} - q.{b})) / sqrt(CAST(sum(abs(sign(p.{a} - q.{a}))) AS DOUBLE)
             * CAST(sum(abs(sign(p.{b} - q.{b}))) AS DOUBLE)), 6) AS r
  FROM supplier p JOIN supplier q ON p.s_suppkey < q.s_suppkey""")
    return " UNION ALL ".join(parts)


@register("corr_kendall", _kendall_sql())
def corr_kendall(spark, sf_dir):
    return A.corr_kendall(table(spark, sf_dir, "supplier"), _K_COLS)
