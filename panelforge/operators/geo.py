"""Planar geometry on vertex tables.

Polygons are rows ``(poly_id, ring_id, seq, x, y, is_hole)``; a ring closes
from its last vertex back to its first. Points are two double columns.

Point-in-polygon is one equi-join of points to a grid index of the polygons:
a polygon has an entry for every grid cell of its bounding box, with the array
of those of its edges that reach the cell's row, the only ones that a ray from
a point of the cell can cross. Even-odd crossings over that array decide inside
(holes included); points on an edge count as inside. An index whose size in
bytes is under a bound is broadcast, and points are not shuffled at all; a
larger one is joined on the grid cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ring_edges(vertices: DataFrame, *, poly: str = "poly_id", ring: str = "ring_id", seq: str = "seq",
               x: str = "x", y: str = "y") -> DataFrame:
    """One row per edge (x1, y1) -> (x2, y2), the last vertex joined to the first.

    Window per ring: its size is the ring's vertex count.
    """
    w = Window.partitionBy(poly, ring).orderBy(seq)
    wall = Window.partitionBy(poly, ring)
    first_x = F.min_by(F.col(x), F.col(seq)).over(wall)
    first_y = F.min_by(F.col(y), F.col(seq)).over(wall)
    return vertices.select(
        F.col(poly).alias("poly_id"), F.col(ring).alias("ring_id"), *(["is_hole"] if "is_hole" in vertices.columns else []),
        F.col(x).alias("x1"), F.col(y).alias("y1"),
        F.coalesce(F.lead(x).over(w), first_x).alias("x2"),
        F.coalesce(F.lead(y).over(w), first_y).alias("y2"))


def poly_area(vertices: DataFrame, **cols) -> DataFrame:
    """Planar area per polygon (shoelace per ring; holes subtract)."""
    e = ring_edges(vertices, **cols)
    if "is_hole" not in e.columns:
        e = e.withColumn("is_hole", F.lit(False))
    rings = (e.groupBy("poly_id", "ring_id")
              .agg(F.abs(F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1"))).alias("a2"),
                   F.max("is_hole").alias("is_hole")))
    signed = F.when(F.col("is_hole"), -F.col("a2")).otherwise(F.col("a2")) / 2.0
    return rings.groupBy("poly_id").agg(F.sum(signed).alias("area"))


#: Bytes of a grid index that are sent to every executor.
INDEX_BYTES = 32 << 20


def polygon_index(vertices: DataFrame, *, cell: float = 1.0) -> DataFrame:
    """(gx, gy, poly_id, bounding box, edges): one row per grid cell of each polygon's bounding box.

    ``edges`` are the edges whose height range meets the cell's row of the grid.
    """
    def at(v):
        return F.floor(v / F.lit(cell)).cast("long")
    bbox = (vertices.groupBy("poly_id")
            .agg(F.min("x").alias("bx0"), F.max("x").alias("bx1"), F.min("y").alias("by0"), F.max("y").alias("by1")))
    rows = (ring_edges(vertices)
            .select("poly_id", F.struct("x1", "y1", "x2", "y2").alias("edge"),
                    F.explode(F.sequence(at(F.least("y1", "y2")), at(F.greatest("y1", "y2")))).alias("gy"))
            .groupBy("poly_id", "gy").agg(F.collect_list("edge").alias("edges")))     # bounded by a polygon's edges
    return rows.join(bbox, "poly_id").select(
        "poly_id", "bx0", "bx1", "by0", "by1", "edges", "gy",
        F.explode(F.sequence(at(F.col("bx0")), at(F.col("bx1")))).alias("gx"))


def _holds(edges, px, py):
    """Whether the even-odd rule over the edges puts the point inside, or it lies on an edge."""
    def crosses(e):
        spans = (e["y1"] > py) != (e["y2"] > py)
        at = e["x1"] + F.try_divide((py - e["y1"]) * (e["x2"] - e["x1"]), e["y2"] - e["y1"])
        return F.when(spans, px < at).otherwise(F.lit(False))

    def touches(e):
        return ((((e["x2"] - e["x1"]) * (py - e["y1"]) - (e["y2"] - e["y1"]) * (px - e["x1"])) == 0)
                & px.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
                & py.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])))
    return F.exists(edges, touches) | (F.size(F.filter(edges, crosses)) % 2 == 1)


def spatial_join(points: DataFrame, vertices: DataFrame, *, x: str = "x", y: str = "y",
                 cell: float = 1.0, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """Inner join of points to the polygons containing them (boundary counts as in).

    Returns the point columns plus ``poly_id``, one row per point row and polygon; points with a missing
    coordinate match nothing. ``cell`` is the grid size. An index of at most ``index_bytes`` is broadcast.
    """
    index = polygon_index(vertices, cell=cell)
    cells, edges = index.agg(F.count(F.lit(1)), F.sum(F.size("edges"))).first()
    fits = cells * 96 + (edges or 0) * 48 <= index_bytes
    index = index.select("gx", "gy", *[F.col(c).alias(f"__{c}") for c in ("poly_id", "bx0", "bx1", "by0", "by1",
                                                                         "edges")])
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    placed = points.where(px.isNotNull() & py.isNotNull()).select(
        *points.columns, F.floor(px / F.lit(cell)).cast("long").alias("gx"),
        F.floor(py / F.lit(cell)).cast("long").alias("gy"))
    met = placed.join(F.broadcast(index) if fits else index, ["gx", "gy"])
    near = met.where(px.between(F.col("__bx0"), F.col("__bx1")) & py.between(F.col("__by0"), F.col("__by1")))
    return near.where(_holds(F.col("__edges"), px, py)).select(*points.columns, F.col("__poly_id").alias("poly_id"))
