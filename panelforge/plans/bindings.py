"""Shared inputs derived from the driver's tables (entity-by-day panels).

* ``EV``      one row per event, integer cents, day, entity, parent.
* ``PANEL_E`` EV summed per (entity, parent, day), pivoted on event type:
              gaps where a user had no such event that day.
* ``PANEL_N`` orders x customer x nation summed per (nation, region, day).

All sums are integer cents so averages are one exact division, equal in
every engine. The SQL twins below are used by ``oracle_sql``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The event types of the events table (pivot values are passed
# explicitly so no distinct pass is needed) and the number of parent groups.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
EV_PARENTS = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        F.col("user_id").alias("entity"),
        (F.col("user_id") % EV_PARENTS).alias("parent"),
        F.col("ts").cast("date").alias("d"),
        "event_type",
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
    )


def panel_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity-day panel; the pivot is one aggregate with map-side combine."""
    # conditional aggregation: one grouped aggregate, one shuffle (Spark's
    # pivot() would aggregate per (keys, type) first and shuffle twice)
    return (ev(spark, sf_dir)
            .groupBy("entity", "parent", "d")
            .agg(*[F.sum(F.when(F.col("event_type") == t, F.col("cents"))).alias(t) for t in EVENT_TYPES]))


def panel_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation-day revenue panel (25 entities under 5 parents)."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    # nation is a 25-row dimension: broadcast after the size check
    from ..operators.joins import broadcast_if_small
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(broadcast_if_small(n), F.col("c_nationkey") == F.col("n_nationkey")))
    return (j.groupBy(F.col("n_nationkey").alias("entity"),
                      F.col("n_regionkey").alias("parent"),
                      F.col("o_orderdate").cast("date").alias("d"))
             .agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("y"),
                  F.count(F.lit(1)).alias("n_orders")))


# ---- SQL twins (DuckDB) -------------------------------------------------

EV_SQL = """SELECT event_id, user_id AS entity, user_id % 10 AS parent, CAST(ts AS DATE) AS d,
       event_type, CAST(round(value * 100) AS BIGINT) AS cents FROM events"""

PANEL_E_SQL = ("SELECT entity, parent, d, "
               + ", ".join(f"CAST(sum(CASE WHEN event_type = '{t}' THEN cents END) AS BIGINT) AS {t}"
                           for t in EVENT_TYPES)
               + f" FROM ({EV_SQL}) ev GROUP BY entity, parent, d")

PANEL_N_SQL = """SELECT n.n_nationkey AS entity, n.n_regionkey AS parent, CAST(o.o_orderdate AS DATE) AS d,
       CAST(sum(CAST(round(o.o_totalprice * 100) AS BIGINT)) AS BIGINT) AS y, count(*) AS n_orders
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
 GROUP BY n.n_nationkey, n.n_regionkey, CAST(o.o_orderdate AS DATE)"""


def with_ctes(body: str, *names: str) -> str:
    """Prefix a query with the named shared inputs as CTEs."""
    defs = {"ev": EV_SQL, "panel_e": PANEL_E_SQL, "panel_n": PANEL_N_SQL, "mf": MODEL_FRAME_SQL}
    parts = [f"{n} AS ({defs[n]})" for n in names]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body


# ---- model frame for the forecasting study --------------------------------
# Target: nation-day revenue in units of 10,000 (cents / 1e6); features: the
# previous row's value (x) and the mean of the previous 7 rows (x7). Rows
# without a previous value are dropped (drop rows with a missing feature).
Y_SCALE = 1e6


def model_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window
    p = panel_n(spark, sf_dir)
    w = Window.partitionBy("entity").orderBy("d")
    y = F.col("y") / Y_SCALE
    f = p.select("entity", "parent", "d", y.alias("y"),
                 F.lag(y, 1).over(w).alias("x"),
                 (F.avg("y").over(w.rowsBetween(-7, -1)) / Y_SCALE).alias("x7"))
    return f.dropna(subset=["x", "x7"])


MODEL_FRAME_SQL = f"""SELECT * FROM (
  SELECT entity, parent, d, y / 1e6 AS y,
         lag(y / 1e6, 1) OVER (PARTITION BY entity ORDER BY d) AS x,
         avg(y) OVER (PARTITION BY entity ORDER BY d ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) / 1e6 AS x7
    FROM ({PANEL_N_SQL}) pn) t
 WHERE x IS NOT NULL AND x7 IS NOT NULL"""
