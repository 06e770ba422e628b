"""Query keys for key repair and scalar/column operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as X
from ..operators import columns as C
from ..operators import panel as P
from .bindings import EVENT_TYPES, ev, panel_e, panel_n, table, with_ctes  # noqa: F401
from .catalog import register

_T = EVENT_TYPES


def _pad_sql(x, n):
    s = f"CAST({x} AS VARCHAR)"
    return f"CASE WHEN length({s}) < {n} THEN lpad({s}, {n}, '0') ELSE {s} END"


@register("zero_pad", f"""
SELECT c_custkey, {_pad_sql('c_custkey', 3)} AS cust3, {_pad_sql('c_nationkey', 2)} AS nation2
  FROM customer""")
def zero_pad(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", X.zero_pad("c_custkey", 3).alias("cust3"),
                    X.zero_pad("c_nationkey", 2).alias("nation2"))


_FKEY_SQL = "split_part(CAST(CAST(n_nationkey AS DOUBLE) AS VARCHAR), '.', 1)"


@register("key_from_float", f"""
SELECT n_nationkey, CAST(CAST(n_nationkey AS DOUBLE) AS VARCHAR) AS ftext, {_pad_sql(_FKEY_SQL, 2)} AS fkey
  FROM nation""")
def key_from_float(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    ftext = F.col("n_nationkey").cast("double").cast("string")
    return n.select("n_nationkey", ftext.alias("ftext"), X.key_from_float(ftext, 2).alias("fkey"))


@register("compose_key", f"""
SELECT n_nationkey, n_regionkey, {_pad_sql('n_regionkey', 2)} || {_pad_sql('n_nationkey', 3)} AS code
  FROM nation""")
def compose_key(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    return n.select("n_nationkey", "n_regionkey",
                    X.compose_key(X.zero_pad("n_regionkey", 2), X.zero_pad("n_nationkey", 3)).alias("code"))


@register("slice_key", f"""
SELECT c_custkey, code, substr(code, 1, 2) AS parent_code, right(code, 5) AS child_code
  FROM (SELECT c_custkey, {_pad_sql('c_nationkey', 2)} || {_pad_sql('c_custkey', 5)} AS code FROM customer) t""")
def slice_key(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    k = c.select("c_custkey", X.compose_key(X.zero_pad("c_nationkey", 2),
                                            X.zero_pad("c_custkey", 5)).alias("code"))
    return k.select("c_custkey", "code", X.parent_key("code", 2).alias("parent_code"),
                    X.suffix_key("code", 5).alias("child_code"))


@register("upper_names", """
SELECT c_custkey, upper(c_name) AS name_uc, upper(lower(c_mktsegment)) AS segment_uc FROM customer""")
def upper_names(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", F.upper("c_name").alias("name_uc"),
                    F.upper(F.lower("c_mktsegment")).alias("segment_uc"))


# Fixed values for the binding: corrections with a repeated source (the second
# rule for '03' never fires) and a target that is also a source (no chaining).
_RULES = [("03", "07"), ("07", "11"), ("03", "99"), ("12", "01")]


@register("correct_keys", f"""
SELECT n_nationkey, key, CASE WHEN key = '03' THEN '07' WHEN key = '07' THEN '11'
                              WHEN key = '12' THEN '01' ELSE key END AS key_fixed
  FROM (SELECT n_nationkey, {_pad_sql('n_nationkey', 2)} AS key FROM nation) t""")
def correct_keys(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_nationkey", X.zero_pad("n_nationkey", 2).alias("key"))
    return n.select("n_nationkey", "key", C.correct_keys("key", _RULES).alias("key_fixed"))


@register("conditional_override", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal < 0 THEN 'DEBT'
                       ELSE c_mktsegment END AS segment FROM customer""")
def conditional_override(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    cond = (F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") < 0)
    return c.select("c_custkey", X.conditional_override("c_mktsegment", cond, F.lit("DEBT")).alias("segment"))


@register("parse_dates", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d,
       CAST(strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) AS d_iso,
       CAST(strptime(strftime(o_orderdate, '%-m/%-d/%y'), '%m/%d/%y') AS DATE) AS d_us,
       CAST(strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d') AS DATE) AS d_compact,
       strftime(o_orderdate, '%-m/%-d/%y') AS us_text
  FROM orders""")
def parse_dates(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    t = o.select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"),
                 F.date_format("o_orderdate", "yyyy-MM-dd").alias("iso"),
                 F.date_format("o_orderdate", "M/d/yy").alias("us_text"),
                 F.date_format("o_orderdate", "yyyyMMdd").alias("compact"))
    return t.select("o_orderkey", "d", X.parse_date("iso", "iso").alias("d_iso"),
                    X.parse_date("us_text", "us_short").alias("d_us"),
                    X.parse_date("compact", "compact").alias("d_compact"), "us_text")


@register("numeric_nonneg", """
SELECT c_custkey, CASE WHEN CAST(CAST(c_acctbal AS VARCHAR) AS DOUBLE) >= 0
                       THEN CAST(CAST(c_acctbal AS VARCHAR) AS DOUBLE) END AS bal FROM customer""")
def numeric_nonneg(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").cast("string").alias("t"))
    return c.select("c_custkey", X.nonneg_numeric("t").alias("bal"))


@register("unit_convert", """
SELECT p_partkey, CAST(p_size AS DOUBLE) / 10e0 * 1.8e0 + 32e0 AS temp_f FROM part""")
def unit_convert(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", X.tenths_c_to_f(F.col("p_size").cast("double")).alias("temp_f"))


@register("threshold_flag", """
SELECT l_orderkey, l_linenumber, l_discount,
       COALESCE(CAST(l_discount > 5e-2 AS INTEGER), 0) AS disc_flag FROM lineitem""")
def threshold_flag(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_discount",
                     X.threshold_flag("l_discount", 0.05).alias("disc_flag"))


@register("log_feature", """
SELECT c_custkey, round(CASE WHEN c_acctbal > 0 THEN ln(c_acctbal) END, 6) AS log_bal,
       round(ln(CAST(c_custkey + 1 AS DOUBLE)), 6) AS log_key FROM customer""")
def log_feature(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", X.round6(X.safe_log("c_acctbal")).alias("log_bal"),
                    X.round6(X.safe_log(F.col("c_custkey") + 1)).alias("log_key"))


@register("ratio_features", """
SELECT l_orderkey, l_linenumber, l_extendedprice / NULLIF(l_quantity, 0) AS unit_price,
       l_tax / NULLIF(l_discount, 0) AS tax_per_discount FROM lineitem""")
def ratio_features(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     X.safe_ratio("l_extendedprice", "l_quantity").alias("unit_price"),
                     X.safe_ratio("l_tax", "l_discount").alias("tax_per_discount"))


def _ordinal_sql(d):
    return f"(date_diff('day', DATE '0001-01-01', {d}) + 1)"


@register("event_in_force", with_ctes(f"""
, ev_n AS (SELECT entity, CAST(CASE WHEN entity % 5 <> 0 THEN {_ordinal_sql('min(d)')} + 100 + entity * 10 END AS INTEGER) AS ord
             FROM panel_n GROUP BY entity)
SELECT p.entity, p.d, e.ord,
       CAST(CAST(DATE '0001-01-01' + CAST(COALESCE(e.ord, 800000) - 1 AS INTEGER) AS DATE) <= p.d AS INTEGER) AS in_force
  FROM panel_n p JOIN ev_n e ON p.entity = e.entity""", "panel_n").replace("\n, ev_n", ", ev_n"))
def event_in_force(spark, sf_dir):
    p = panel_n(spark, sf_dir).select("entity", "d")
    ordinal = F.datediff(F.min("d"), F.lit("0001-01-01").cast("date")) + 1
    ev_n = p.groupBy("entity").agg(
        F.when(F.col("entity") % 5 != 0, ordinal + 100 + F.col("entity") * 10).alias("ord"))
    return (p.join(ev_n, "entity")
             .select("entity", "d", "ord", X.event_in_force("ord", "d").alias("in_force")))


@register("day_of_week", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS dow FROM orders""")
def day_of_week(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    return o.select("o_orderkey", "d", X.weekday_monday0("d").alias("dow"))


@register("one_hot", "SELECT o_orderkey, "
          + ", ".join(f"CASE WHEN isodow(o_orderdate) - 1 = {k} THEN 1 ELSE 0 END AS dayofweek_{k}"
                      for k in range(7)) + ", "
          + ", ".join(f"CASE WHEN o_orderstatus = '{s}' THEN 1 ELSE 0 END AS status_{s}" for s in "FOP")
          + " FROM orders")
def one_hot(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    status = C.observed_categories(o, "o_orderstatus")
    return o.select("o_orderkey", *C.one_hot(X.weekday_monday0(F.col("o_orderdate").cast("date")),
                                             range(7), "dayofweek"),
                    *C.one_hot("o_orderstatus", status, "status"))


def _wide_e(spark, sf_dir):
    """PANEL_E with rolling and lag columns and one all-missing column."""
    p = panel_e(spark, sf_dir)
    p = P.rolling_mean(p, entity="entity", order="d", columns=["click", "view"], windows=(3, 7))
    p = P.lag_features(p, entity="entity", order="d", columns=["click"], lags=(1, 10))
    return p.withColumn("empty", F.lit(None).cast("bigint"))


_WIDE_SQL = ("SELECT *, "
             + ", ".join(f"avg({c}) OVER (PARTITION BY entity ORDER BY d ROWS BETWEEN {w - 1} PRECEDING "
                         f"AND CURRENT ROW) AS {c}_{w}d_avg" for c in ("click", "view") for w in (3, 7))
             + ", lag(click, 1) OVER (PARTITION BY entity ORDER BY d) AS lag1_click"
             + ", lag(click, 10) OVER (PARTITION BY entity ORDER BY d) AS lag10_click"
             + ", CAST(NULL AS BIGINT) AS empty FROM panel_e")


def _wide_ctes(body):
    return with_ctes(", wide AS (" + _WIDE_SQL + ")\n" + body, "panel_e").replace("\n, wide", ", wide")


@register("select_pattern", _wide_ctes(
    "SELECT entity, parent, d, " + ", ".join(_T) + ", click_7d_avg, view_7d_avg FROM wide"))
def select_pattern(spark, sf_dir):
    w = _wide_e(spark, sf_dir)
    cols = C.select_pattern(w.columns, keep=["entity", "parent", "d"],
                            drop_prefix=["lag1"], drop_suffix=["_3d_avg"], drop_contains=["empty"])
    return w.select(*cols)


_RENAME_TEXT = """click : n_click
view:n_view
 purchase :  n_purchase
"""


@register("rename_map", with_ctes(
    "SELECT entity, parent, d, click AS n_click, error, purchase AS n_purchase, signup, view AS n_view "
    "FROM panel_e", "panel_e"))
def rename_map(spark, sf_dir):
    return C.rename_strict(panel_e(spark, sf_dir), C.parse_rename_map(_RENAME_TEXT))


@register("rename_affix", with_ctes(
    "SELECT entity, parent, d, " + ", ".join(f"{c} AS ev_{c}_cents" for c in _T) + " FROM panel_e", "panel_e"))
def rename_affix(spark, sf_dir):
    return C.rename_affix(panel_e(spark, sf_dir), keys=["entity", "parent", "d"],
                          prefix="ev_", suffix="_cents")


@register("drop_empty_columns", with_ctes("SELECT * FROM panel_e", "panel_e"))
def drop_empty_columns(spark, sf_dir):
    return C.drop_empty_columns(panel_e(spark, sf_dir).withColumn("empty", F.lit(None).cast("bigint")))


@register("recode", """
SELECT l_orderkey, l_linenumber, l_linestatus,
       CASE WHEN l_linestatus = 'F' THEN 1 WHEN l_linestatus = 'O' THEN 0 END AS status_code FROM lineitem""")
def recode(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_linestatus",
                     C.recode("l_linestatus", {"F": 1, "O": 0}).alias("status_code"))


@register("fill_constant", with_ctes(
    "SELECT entity, parent, d, " + ", ".join(f"COALESCE({c}, 0) AS {c}" for c in _T) + " FROM panel_e",
    "panel_e"))
def fill_constant(spark, sf_dir):
    return C.fill_constant(panel_e(spark, sf_dir), 0, _T)


@register("drop_missing", with_ctes(
    "SELECT * FROM panel_e WHERE click IS NOT NULL AND view IS NOT NULL", "panel_e"))
def drop_missing(spark, sf_dir):
    return C.drop_missing(panel_e(spark, sf_dir), ["click", "view"])


@register("project_relabel", with_ctes(
    'SELECT entity AS "User", d AS "Date", click AS "Clicks (cents)" FROM panel_e', "panel_e"))
def project_relabel(spark, sf_dir):
    return C.project_relabel(panel_e(spark, sf_dir),
                             {"entity": "User", "d": "Date", "click": "Clicks (cents)"})


@register("split_label", """
SELECT event_id, label, split_part(label, ' - ', 1) AS model, right(label, 1) AS version
  FROM (SELECT event_id, upper(event_type) || ' - v' || CAST(user_id % 10 AS VARCHAR) AS label FROM events) t""")
def split_label(spark, sf_dir):
    e = ev(spark, sf_dir)
    lab = F.concat(F.upper("event_type"), F.lit(" - v"), F.col("parent").cast("string"))
    t = e.select("event_id", lab.alias("label"))
    return t.select("event_id", "label", X.label_model("label").alias("model"),
                    X.label_version("label").alias("version"))

