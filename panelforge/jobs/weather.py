"""Weather stations -> county-day temperatures and precipitation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as X
from ..operators import geo as GEO
from ..operators import panel as P
from ..operators import reshape as R
from ..sources import files as IO

# The daily file layout, the kept variables, start date,
# the station file slices and the precipitation cut-off.
DAILY_SCHEMA = ("id string, date string, var string, value double, m_flag string, q_flag string, "
                "s_flag string, obs_time string")
VARS = ["PRCP", "TMAX", "TMIN"]
START = "2020-02-15"
STATION_FIELDS = [("id", 0, 11, "string"), ("lat", 12, 20, "double"), ("lon", 21, 30, "double"),
                  ("state", 38, 40, "string"), ("name", 41, 71, "string")]
PRECIP_CUTOFF = 0.05
WINDOWS = (3, 5, 7, 10)


def daily_wide(daily: DataFrame) -> DataFrame:
    """Filter, parse dates and put the three variables side by side (strict pivot)."""
    d = (daily.select("id", X.parse_date("date", "compact").alias("date"), "var", "value")
              .where((F.col("date") >= F.lit(START).cast("date")) & F.col("var").isin(VARS)))
    return R.pivot_strict(d, keys=["id", "date"], pivot="var", value="value", values=VARS, name="{category}")


def county_weather(spark: SparkSession, daily: DataFrame, stations: DataFrame, polygons: DataFrame,
                   cell: float = 1.0) -> DataFrame:
    wide = daily_wide(daily)
    # locate each station once (stations << station-days), then attach counties by id
    st = stations.select("id", "lat", "lon")
    where = GEO.spatial_join(st, polygons, x="lon", y="lat", cell=cell) \
        .select("id", F.col("poly_id").alias("fips"))
    located = wide.join(where, "id", "inner")
    agg = located.groupBy("fips", "date").agg(*[F.avg(c).alias(c) for c in VARS])
    agg = agg.withColumn("state", X.parent_key("fips", 2))
    for c in ("TMAX", "TMIN"):
        agg = agg.withColumn(c, X.tenths_c_to_f(c))
    agg = P.fill_parent_mean(agg, parent="state", date="date", columns=VARS)
    agg = agg.withColumn("precip_dummy", X.threshold_flag("PRCP", PRECIP_CUTOFF))
    return P.rolling_mean(agg, entity="fips", order="date", columns=["TMIN", "TMAX"], windows=WINDOWS)


def read_inputs(spark: SparkSession, daily_path: str, stations_path: str) -> tuple[DataFrame, DataFrame]:
    return (IO.scan_csv_headerless(spark, daily_path, DAILY_SCHEMA),
            IO.scan_fixed_width(spark, stations_path, STATION_FIELDS))
