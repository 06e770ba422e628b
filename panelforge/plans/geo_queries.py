"""Query keys for geometry (G1, G2, J9): points and polygons from embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import geo as GEO
from .bindings import table
from .catalog import register

# Test polygons (triangle, square with a hole, concave L-shape,
# and a square sharing a border with the holed square). Rows are
# (poly_id, ring_id, seq, x, y, is_hole).
POLYGONS = [
    (1, 0, 0, -0.3, -0.3, False), (1, 0, 1, 0.0, -0.3, False), (1, 0, 2, -0.3, 0.0, False),
    (2, 0, 0, 0.0, 0.0, False), (2, 0, 1, 0.3, 0.0, False), (2, 0, 2, 0.3, 0.3, False), (2, 0, 3, 0.0, 0.3, False),
    (2, 1, 0, 0.1, 0.1, True), (2, 1, 1, 0.2, 0.1, True), (2, 1, 2, 0.2, 0.2, True), (2, 1, 3, 0.1, 0.2, True),
    (3, 0, 0, -0.35, 0.05, False), (3, 0, 1, -0.05, 0.05, False), (3, 0, 2, -0.05, 0.15, False),
    (3, 0, 3, -0.25, 0.15, False), (3, 0, 4, -0.25, 0.35, False), (3, 0, 5, -0.35, 0.35, False),
    (4, 0, 0, 0.3, 0.0, False), (4, 0, 1, 0.45, 0.0, False), (4, 0, 2, 0.45, 0.3, False), (4, 0, 3, 0.3, 0.3, False),
]
_VSCHEMA = "poly_id int, ring_id int, seq int, x double, y double, is_hole boolean"


def _values_sql():
    rows = ", ".join(f"({p}, {r}, {s}, CAST({x!r} AS DOUBLE), CAST({y!r} AS DOUBLE), {str(h).upper()})"
                     for p, r, s, x, y, h in POLYGONS)
    return f"SELECT * FROM (VALUES {rows}) t(poly_id, ring_id, seq, x, y, is_hole)"


_EDGES_SQL = """SELECT poly_id, ring_id, x AS x1, y AS y1,
       COALESCE(lead(x) OVER (PARTITION BY poly_id, ring_id ORDER BY seq),
                first_value(x) OVER (PARTITION BY poly_id, ring_id ORDER BY seq)) AS x2,
       COALESCE(lead(y) OVER (PARTITION BY poly_id, ring_id ORDER BY seq),
                first_value(y) OVER (PARTITION BY poly_id, ring_id ORDER BY seq)) AS y2,
       is_hole FROM v"""


@register("spatial_join", f"""
WITH v AS ({_values_sql()}), e AS ({_EDGES_SQL}),
p AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS px, CAST(embedding[2] AS DOUBLE) AS py FROM embeddings),
h AS (SELECT p.vec_id, e.poly_id,
             sum(CASE WHEN (y1 > py) <> (y2 > py) AND px < x1 + (py - y1) * (x2 - x1) / (y2 - y1) THEN 1 ELSE 0 END) AS n,
             max(CASE WHEN (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1) = 0
                       AND px BETWEEN least(x1, x2) AND greatest(x1, x2)
                       AND py BETWEEN least(y1, y2) AND greatest(y1, y2) THEN 1 ELSE 0 END) AS onb
        FROM p, e GROUP BY p.vec_id, e.poly_id)
SELECT vec_id, poly_id FROM h WHERE n % 2 = 1 OR onb = 1""")
def spatial_join(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    pts = e.select("vec_id", F.col("embedding")[0].cast("double").alias("x"),
                   F.col("embedding")[1].cast("double").alias("y"))
    # the polygon set is a fixed literal (21 vertices): broadcast is size-bounded
    polys = F.broadcast(spark.createDataFrame(POLYGONS, _VSCHEMA))
    return GEO.spatial_join(pts, polys, cell=0.1).select("vec_id", "poly_id")


# vertex layout taken from each embedding: outer ring of 4 points, hole of 3
_RING_LAYOUT = [(0, 0, 0), (0, 1, 1), (0, 2, 2), (0, 3, 3), (1, 0, 4), (1, 1, 5), (1, 2, 6)]


def _embedding_polygons(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    cells = F.array(*[F.struct(F.lit(r).alias("ring_id"), F.lit(s).alias("seq"),
                               F.col("embedding")[2 * k].cast("double").alias("x"),
                               F.col("embedding")[2 * k + 1].cast("double").alias("y"),
                               F.lit(r == 1).alias("is_hole"))
                      for r, s, k in _RING_LAYOUT])
    return e.select(F.col("vec_id").alias("poly_id"), F.explode(cells).alias("v")).select("poly_id", "v.*")


@register("poly_area", """
WITH lay AS (SELECT * FROM (VALUES """ + ", ".join(f"({r}, {s}, {k})" for r, s, k in _RING_LAYOUT) + """) t(ring_id, seq, k)),
v AS (SELECT vec_id AS poly_id, ring_id, seq, CAST(embedding[2 * k + 1] AS DOUBLE) AS x,
             CAST(embedding[2 * k + 2] AS DOUBLE) AS y, ring_id = 1 AS is_hole FROM embeddings, lay),
e AS (""" + _EDGES_SQL + """),
r AS (SELECT poly_id, ring_id, abs(sum(x1 * y2 - x2 * y1)) AS a2, bool_or(is_hole) AS is_hole FROM e GROUP BY poly_id, ring_id)
SELECT poly_id, round(sum(CASE WHEN is_hole THEN -a2 ELSE a2 END / 2.0), 9) AS area FROM r GROUP BY poly_id""")
def poly_area(spark, sf_dir):
    a = GEO.poly_area(_embedding_polygons(spark, sf_dir))
    return a.select("poly_id", F.round("area", 9).alias("area"))
