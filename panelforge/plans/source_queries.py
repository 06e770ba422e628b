"""Query keys for sources and sinks.

Each query lands part of a driver table under the shared checkpoint folder
in the source's format, then scans it back with the library's reader; the
oracle reads the original table.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import functions as F

from ..ml import evaluate as E
from ..ml import grid as G
from ..session import scratch_path
from ..sources import files as IO
from .bindings import table
from .catalog import register
from .ml_queries import LAST_FOLD, _NULL_CTES, folded

_CUSTOMER_SCHEMA = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


@register("sink_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def sink_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "customer-csv")
    IO.write_csv(table(spark, sf_dir, "customer"), path)
    return IO.scan_csv(spark, path, _CUSTOMER_SCHEMA)


@register("scan_csv", """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders""")
def scan_csv(spark, sf_dir):
    path = scratch_path(spark, "orders-csv")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority")
    IO.write_csv(o, path)
    return IO.scan_csv(spark, path, "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, "
                                    "o_orderdate DATE, o_orderpriority STRING")


@register("scan_csv_headerless", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def scan_csv_headerless(spark, sf_dir):
    path = scratch_path(spark, "nation-noheader")
    IO.write_csv(table(spark, sf_dir, "nation"), path, header=False)
    return IO.scan_csv_headerless(spark, path, "n_nationkey INT, n_name STRING, n_regionkey INT")


@register("scan_csv_strings", """
SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS c_custkey, c_name,
       lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS c_nationkey, c_mktsegment FROM customer""")
def scan_csv_strings(spark, sf_dir):
    path = scratch_path(spark, "customer-codes")
    c = table(spark, sf_dir, "customer").select(
        F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("c_custkey"), "c_name",
        F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("c_nationkey"), "c_mktsegment")
    IO.write_csv(c, path)
    return IO.scan_csv_strings(spark, path, ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])


# The station file layout, 0-based [start, end) slices.
STATION_FIELDS = [("id", 0, 11, "string"), ("lat", 12, 20, "double"), ("lon", 21, 30, "double"),
                  ("state", 38, 40, "string"), ("name", 41, 71, "string")]


@register("scan_fixed_width", """
SELECT rpad('C' || lpad(CAST(c_custkey AS VARCHAR), 7, '0'), 11, ' ') AS id, c_acctbal AS lat,
       CAST((c_nationkey + 1) * -1.5 AS DOUBLE) AS lon, substr(c_mktsegment, 1, 2) AS state,
       rpad(c_name, 30, ' ') AS name FROM customer""")
def scan_fixed_width(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    line = F.concat(
        F.rpad(F.concat(F.lit("C"), F.lpad(F.col("c_custkey").cast("string"), 7, "0")), 11, " "), F.lit(" "),
        F.lpad(F.col("c_acctbal").cast("string"), 8, " "), F.lit(" "),
        F.lpad(((F.col("c_nationkey") + 1) * -1.5).cast("string"), 9, " "), F.lit(" " * 8),
        F.substring("c_mktsegment", 1, 2), F.lit(" "), F.rpad("c_name", 30, " "))
    path = scratch_path(spark, "stations-txt")
    IO.write_text(c.select(line.alias("line")), "line", path)
    return IO.scan_fixed_width(spark, path, STATION_FIELDS)


def _land_json_rows(spark, sf_dir):
    """One JSON array-of-arrays document per region: header row then nation rows."""
    n = table(spark, sf_dir, "nation")
    row = F.array(F.col("n_nationkey").cast("string"), F.col("n_name"), F.col("n_regionkey").cast("string"))
    # nations per region are bounded by the fixed 25-row table
    docs = n.groupBy("n_regionkey").agg(F.sort_array(F.collect_list(F.struct("n_nationkey", row.alias("r")))).alias("rows"))
    header = F.array(F.lit("n_nationkey"), F.lit("n_name"), F.lit("n_regionkey"))
    doc = F.to_json(F.concat(F.array(header), F.transform("rows", lambda s: s["r"])))
    path = scratch_path(spark, "nation-json")
    IO.write_text(docs.select(doc.alias("doc")), "doc", path)
    return path


@register("scan_json_rows", """
SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation""")
def scan_json_rows(spark, sf_dir):
    return IO.scan_json_rows(spark, _land_json_rows(spark, sf_dir))


@register("scan_json_row_lines", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, o_orderpriority FROM orders""")
def scan_json_row_lines(spark, sf_dir):
    """The orders landed as row arrays with a row a line (a part file is one document), and read again."""
    cols = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select([F.col(c).cast("string").alias(c) for c in cols])
    path = scratch_path(spark, "row-lines")

    def lines(batches):
        held = "[" + json.dumps(cols)                     # a row is written when it is known what follows it
        for b in batches:
            rows = [held, *map(json.dumps, zip(*[c.to_pylist() for c in b.columns]))]
            held = rows.pop()
            yield pa.RecordBatch.from_arrays([pa.array([r + "," for r in rows], pa.string())], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array([held + "]"])], ["value"])
    o.mapInArrow(lines, "value string").write.text(path)
    return IO.scan_json_row_lines(spark, path)


@register("select_manifest", "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name FROM nation")
def select_manifest(spark, sf_dir):
    data = IO.scan_json_rows(spark, _land_json_rows(spark, sf_dir))
    mpath = scratch_path(spark, "manifest")
    IO.write_manifest(spark, ["n_nationkey", " n_name "], mpath)
    return IO.select_manifest(data, IO.read_manifest(spark, mpath))


@register("artifact_store", _NULL_CTES + f"""
SELECT entity, d, y, round(y_hat, 6) AS y_hat FROM npred WHERE fold = '{LAST_FOLD}' AND model = 'global_mean'""")
def artifact_store(spark, sf_dir):
    pred = E.null_predictions(folded(spark, sf_dir))
    path = scratch_path(spark, "predictions")
    G.write_predictions(pred, path)
    back = G.read_predictions(spark, path, fold=LAST_FOLD, model="global_mean")
    return back.select("entity", "d", "y", F.round("y_hat", 6).alias("y_hat"))
