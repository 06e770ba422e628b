"""Query keys for filters (F1-F5) and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as J
from .bindings import panel_n, table, with_ctes
from .catalog import register

# ---- filters ------------------------------------------------------------


@register("filter_basic", """
SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_discount FROM lineitem
 WHERE l_returnflag = 'R' OR (l_linestatus = 'O' AND l_discount <> 5e-2 AND l_tax IS NOT NULL)""")
def filter_basic(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    cond = (F.col("l_returnflag") == "R") | ((F.col("l_linestatus") == "O") & (F.col("l_discount") != 0.05)
                                             & F.col("l_tax").isNotNull())
    return li.where(cond).select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_discount")


@register("filter_in_since", """
SELECT l_orderkey, l_linenumber, l_returnflag, CAST(l_shipdate AS DATE) AS ship_d FROM lineitem
 WHERE l_returnflag IN ('A', 'N') AND l_shipdate >= TIMESTAMP '2000-01-01 00:00:00'""")
def filter_in_since(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return (li.where(F.col("l_returnflag").isin("A", "N")
                     & (F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz")))
              .select("l_orderkey", "l_linenumber", "l_returnflag",
                      F.col("l_shipdate").cast("date").alias("ship_d")))


@register("filter_latest", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS yr FROM orders
 WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)""")
def filter_latest(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("yr"))
    return J.filter_latest(o, "yr")


@register("filter_code_level", """
SELECT p_partkey, p_brand FROM part WHERE length(p_brand) = 8""")
def filter_code_level(spark, sf_dir):
    return J.filter_code_level(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_brand", 8)


@register("entity_slice", with_ctes("""
SELECT entity, d, y FROM panel_n
 WHERE entity IN (SELECT entity FROM panel_n GROUP BY entity ORDER BY sum(y) DESC, entity LIMIT 4)""", "panel_n"))
def entity_slice(spark, sf_dir):
    """The panel rows of the four entities with the largest total (the
    entities a report charts); the member list is a top-4 of a small aggregate."""
    p = panel_n(spark, sf_dir).select("entity", "d", "y")
    top = (p.groupBy("entity").agg(F.sum("y").alias("t"))
             .orderBy(F.col("t").desc(), F.col("entity").asc()).limit(4).collect())
    return J.entity_slice(p, "entity", [r["entity"] for r in top])


# ---- joins --------------------------------------------------------------
# nation subsets are cut on the region key so that some customers miss.


@register("join_left", """
SELECT c.c_custkey, c.c_nationkey, n.n_name, n.n_regionkey
  FROM customer c LEFT JOIN (SELECT * FROM nation WHERE n_regionkey IN (0, 1, 2)) n
    ON c.c_nationkey = n.n_nationkey""")
def join_left(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = (table(spark, sf_dir, "nation").where(F.col("n_regionkey").isin(0, 1, 2))
         .withColumnRenamed("n_nationkey", "c_nationkey"))
    return J.dim_join(c, n, "c_nationkey", "left", bounded=True) \
        .select("c_custkey", "c_nationkey", "n_name", "n_regionkey")


@register("join_inner", """
SELECT s.s_suppkey, s.s_nationkey, n.n_name FROM supplier s
  JOIN (SELECT * FROM nation WHERE n_regionkey <> 3) n ON s.s_nationkey = n.n_nationkey""")
def join_inner(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = (table(spark, sf_dir, "nation").where(F.col("n_regionkey") != 3)
         .select(F.col("n_nationkey").alias("s_nationkey"), "n_name"))
    return J.dim_join(s, n, "s_nationkey", "inner", bounded=True)


@register("join_right", """
SELECT n.n_nationkey, n.n_name, b.n_debtors FROM
  (SELECT c_nationkey, count(*) AS n_debtors FROM customer
    WHERE c_acctbal < 0 AND c_mktsegment = 'MACHINERY' GROUP BY c_nationkey) b
  RIGHT JOIN nation n ON b.c_nationkey = n.n_nationkey""")
def join_right(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    b = (c.where((F.col("c_acctbal") < 0) & (F.col("c_mktsegment") == "MACHINERY"))
          .groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n_debtors")))
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return b.join(n, "n_nationkey", "right").select("n_nationkey", "n_name", "n_debtors")


@register("join_full_outer", """
SELECT COALESCE(a.nk, b.nk) AS nk, COALESCE(a.seg, b.seg) AS seg, a.n_customers, b.n_suppliers
  FROM (SELECT c_nationkey AS nk, 'X' AS seg, count(*) AS n_customers FROM customer
         WHERE c_mktsegment = 'AUTOMOBILE' AND c_nationkey < 20 GROUP BY c_nationkey) a
  FULL OUTER JOIN (SELECT s_nationkey AS nk, 'X' AS seg, count(*) AS n_suppliers FROM supplier
         WHERE s_nationkey > 4 GROUP BY s_nationkey) b
    ON a.nk = b.nk AND a.seg = b.seg""")
def join_full_outer(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    s = table(spark, sf_dir, "supplier")
    a = (c.where((F.col("c_mktsegment") == "AUTOMOBILE") & (F.col("c_nationkey") < 20))
          .groupBy(F.col("c_nationkey").alias("nk"), F.lit("X").alias("seg"))
          .agg(F.count(F.lit(1)).alias("n_customers")))
    b = (s.where(F.col("s_nationkey") > 4)
          .groupBy(F.col("s_nationkey").alias("nk"), F.lit("X").alias("seg"))
          .agg(F.count(F.lit(1)).alias("n_suppliers")))
    return a.join(b, ["nk", "seg"], "full")


@register("join_indicator", """
SELECT c.c_custkey, c.c_nationkey, n.n_name,
       CASE WHEN n.n_nationkey IS NOT NULL THEN 'both' ELSE 'left_only' END AS _merge
  FROM customer c LEFT JOIN (SELECT * FROM nation WHERE n_regionkey IN (0, 1, 2)) n
    ON c.c_nationkey = n.n_nationkey""")
def join_indicator(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = (table(spark, sf_dir, "nation").where(F.col("n_regionkey").isin(0, 1, 2))
         .select(F.col("n_nationkey").alias("c_nationkey"), "n_name"))
    return J.join_with_indicator(c, J.broadcast_if_small(n), "c_nationkey")


@register("join_collision", """
SELECT c.c_custkey, c.c_nationkey AS nk, c.c_name AS name_x, c.c_acctbal AS acctbal_x,
       s.name AS name_y, s.acctbal AS acctbal_y
  FROM customer c JOIN (SELECT s_nationkey AS nk, max(s_name) AS name,
                               max(s_acctbal) AS acctbal FROM supplier GROUP BY s_nationkey) s
    ON c.c_nationkey = s.nk""")
def join_collision(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("nk"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("acctbal"))
    s = (table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nk"))
         .agg(F.max("s_name").alias("name"), F.max("s_acctbal").alias("acctbal")))
    return J.join_suffixed(c, s, "nk", "inner")


def _brand_code():
    return F.lpad(F.substring_index(F.col("p_brand"), "#", -1), 2, "0")


@register("share_of_total", """
WITH rev AS (
  SELECT s.s_nationkey AS nk, lpad(split_part(p.p_brand, '#', 2), 2, '0') AS code,
         CAST(sum(CAST(round(l.l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
   GROUP BY 1, 2),
tot AS (SELECT nk, CAST(sum(cents) AS BIGINT) AS cents FROM rev GROUP BY nk)
SELECT r.nk, r.code, r.cents, CAST(r.cents AS DOUBLE) / NULLIF(CAST(t.cents AS DOUBLE), 0) AS share
  FROM rev r LEFT JOIN tot t ON r.nk = t.nk""")
def share_of_total(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_extendedprice")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = li.join(p, li.l_partkey == p.p_partkey).join(s, li.l_suppkey == s.s_suppkey)
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    # the table carries an industry-style total row per entity with code '00':
    # every line counts for its brand code and for the total (one aggregate)
    codes = F.explode(F.array(_brand_code(), F.lit("00"))).alias("code")
    long = (j.select(F.col("s_nationkey").alias("nk"), cents.alias("c"), codes)
             .groupBy("nk", "code").agg(F.sum("c").alias("cents")))
    return J.share_of_total(long, entity="nk", code="code", value="cents")


def _ship_panel(spark, sf_dir):
    """Supplier-side nation-day panel: shipped revenue per (nation, ship day)."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_extendedprice")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (li.join(s, li.l_suppkey == s.s_suppkey)
              .groupBy(F.col("s_nationkey").alias("entity"), F.col("l_shipdate").cast("date").alias("d"))
              .agg(F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("ship_cents")))


_SHIP_SQL = """ship AS (
  SELECT s.s_nationkey AS entity, CAST(l.l_shipdate AS DATE) AS d,
         CAST(sum(CAST(round(l.l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS ship_cents
    FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey GROUP BY 1, 2)"""


@register("join_left_composite", with_ctes(f""", {_SHIP_SQL}
SELECT p.entity, p.d, p.y, s.ship_cents FROM panel_n p LEFT JOIN ship s ON p.entity = s.entity AND p.d = s.d""",
                                           "panel_n").replace("\n, ship", ", ship"))
def join_left_composite(spark, sf_dir):
    p = panel_n(spark, sf_dir).select("entity", "d", "y")
    return p.join(_ship_panel(spark, sf_dir), ["entity", "d"], "left")


@register("align_predictions", with_ctes(""", fc AS (
  SELECT entity, d, avg(y) OVER (PARTITION BY entity ORDER BY d ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS y_hat
    FROM panel_n)
SELECT p.entity, p.d, p.y, f.y_hat, abs(p.y - f.y_hat) AS abs_err
  FROM panel_n p JOIN fc f ON p.entity = f.entity AND p.d = f.d WHERE f.y_hat IS NOT NULL""",
                                         "panel_n").replace("\n, fc", ", fc"))
def align_predictions(spark, sf_dir):
    from pyspark.sql import Window
    p = panel_n(spark, sf_dir).select("entity", "d", "y")
    w = Window.partitionBy("entity").orderBy("d").rowsBetween(-7, -1)
    fc = p.select("entity", "d", F.avg("y").over(w).alias("y_hat")).where(F.col("y_hat").isNotNull())
    j = p.join(fc, ["entity", "d"], "inner")
    return j.select("entity", "d", "y", "y_hat", F.abs(F.col("y") - F.col("y_hat")).alias("abs_err"))
