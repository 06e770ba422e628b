"""Query keys for the panel windows and fills."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import panel as P
from ..operators.joins import broadcast_if_small
from .bindings import EVENT_TYPES, panel_e, panel_n, table, with_ctes
from .catalog import register

_T = EVENT_TYPES


def _roll_sql(c, w):
    return (f"avg({c}) OVER (PARTITION BY entity ORDER BY d ROWS BETWEEN {w - 1} PRECEDING "
            f"AND CURRENT ROW) AS {c}_{w}d_avg")


@register("rolling_mean", with_ctes(
    "SELECT entity, parent, d, " + ", ".join(_T) + ", "
    + ", ".join(_roll_sql(c, w) for c in _T for w in (3, 7)) + " FROM panel_e", "panel_e"))
def rolling_mean(spark, sf_dir):
    return P.rolling_mean(panel_e(spark, sf_dir), entity="entity", order="d",
                          columns=_T, windows=(3, 7))


_LAGS = (1, 3, 5, 7, 10)


@register("lag_features", with_ctes(
    "SELECT entity, parent, d, y, n_orders, "
    + ", ".join(f"lag(y, {n}) OVER (PARTITION BY entity ORDER BY d) AS lag{n}_y" for n in _LAGS)
    + " FROM panel_n", "panel_n"))
def lag_features(spark, sf_dir):
    return P.lag_features(panel_n(spark, sf_dir), entity="entity", order="d",
                          columns=["y"], lags=_LAGS)


@register("fill_parent_mean", with_ctes(
    "SELECT entity, parent, d, "
    + ", ".join(f"COALESCE(CAST({c} AS DOUBLE), avg({c}) OVER (PARTITION BY parent, d)) AS {c}" for c in _T)
    + " FROM panel_e", "panel_e"))
def fill_parent_mean(spark, sf_dir):
    return P.fill_parent_mean(panel_e(spark, sf_dir), parent="parent", date="d", columns=_T)


@register("fill_parent_then_zero", with_ctes(
    "SELECT entity, parent, d, "
    + ", ".join(f"COALESCE(CAST({c} AS DOUBLE), avg({c}) OVER (PARTITION BY parent, d), 0.0) AS {c}"
                for c in _T)
    + " FROM panel_e", "panel_e"))
def fill_parent_then_zero(spark, sf_dir):
    return P.fill_parent_mean(panel_e(spark, sf_dir), parent="parent", date="d", columns=_T,
                              then_zero=True)


def _nation_balance(spark, sf_dir):
    """Average balance (cents) per nation, with every 5th nation's value missing."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    bal = (c.groupBy("c_nationkey")
            .agg(F.avg(F.round(F.col("c_acctbal") * 100).cast("bigint")).alias("bal")))
    j = n.join(bal, n.n_nationkey == bal.c_nationkey, "left")
    return j.select("n_nationkey", "n_regionkey",
                    F.when(F.col("n_nationkey") % 5 != 0, F.col("bal")).alias("bal"))


def _region_balance(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    return (c.join(broadcast_if_small(n), c.c_nationkey == n.n_nationkey)
             .groupBy(F.col("n_regionkey"))
             .agg(F.avg(F.round(F.col("c_acctbal") * 100).cast("bigint")).alias("bal")))


_NATION_BAL_SQL = """nb AS (
  SELECT n.n_nationkey, n.n_regionkey,
         CASE WHEN n.n_nationkey % 5 <> 0 THEN b.bal END AS bal
    FROM nation n LEFT JOIN (SELECT c_nationkey, avg(CAST(round(c_acctbal * 100) AS BIGINT)) AS bal
                               FROM customer GROUP BY c_nationkey) b ON n.n_nationkey = b.c_nationkey),
rb AS (
  SELECT n.n_regionkey, avg(CAST(round(c.c_acctbal * 100) AS BIGINT)) AS bal
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_regionkey)"""


@register("fill_from_parent_table",
          "WITH " + _NATION_BAL_SQL + """
SELECT nb.n_nationkey, nb.n_regionkey, COALESCE(nb.bal, rb.bal) AS bal
  FROM nb LEFT JOIN rb ON nb.n_regionkey = rb.n_regionkey""")
def fill_from_parent_table(spark, sf_dir):
    return P.fill_from_parent_table(_nation_balance(spark, sf_dir), _region_balance(spark, sf_dir),
                                    on="n_regionkey", columns=["bal"])


@register("best_per_group", with_ctes("""
SELECT DISTINCT entity, parent, d, y FROM (
  SELECT entity, parent, d, y, min(y) OVER (PARTITION BY entity) AS m FROM panel_n) t
 WHERE y = m""", "panel_n"))
def best_per_group(spark, sf_dir):
    p = panel_n(spark, sf_dir).select("entity", "parent", "d", "y")
    return P.best_per_group(p, group="entity", metric="y")
