"""Mobility target. Crosswalks -> county-day series -> rolling means ->
lags -> fill from the state-day mean. Also D5 (case/death counts)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as X
from ..operators import joins as J
from ..operators import panel as P
from ..operators import reshape as R

# The six mobility series and the name fixes of the source.
SERIES = [
    "retail_and_recreation_percent_change_from_baseline",
    "grocery_and_pharmacy_percent_change_from_baseline",
    "parks_percent_change_from_baseline",
    "transit_stations_percent_change_from_baseline",
    "workplaces_percent_change_from_baseline",
    "residential_percent_change_from_baseline",
]
COUNTRY = "United States"
DC = "District of Columbia"
RENAMED_COUNTY = ("Shannon County", "South Dakota", "Oglala Lakota County")
WINDOWS = (3, 7)
LAGS = (1, 3, 5, 7, 10)


def fips_crosswalk(county: DataFrame, state: DataFrame) -> DataFrame:
    """County and state name crosswalks (all text) -> fips, upper-case names."""
    c = county.select(X.zero_pad("StateFIPS", 2).alias("StateFIPS"), X.zero_pad("CountyFIPS", 3).alias("CountyFIPS"),
                      "CountyName")
    s = state.select(X.zero_pad("StateFIPS", 2).alias("StateFIPS"), "StateName")
    j = c.join(s, "StateFIPS", "inner")
    return j.select("StateFIPS", "CountyFIPS", F.upper("CountyName").alias("CountyName"),
                    F.upper("StateName").alias("StateName"),
                    X.compose_key("StateFIPS", "CountyFIPS").alias("fips"))


def load_mobility(raw: DataFrame) -> DataFrame:
    """US county rows; DC gets its own county; the renamed county is fixed; the series are numbers."""
    df = raw.where(F.col("country_region") == COUNTRY).drop("country_region", "country_region_code")
    df = df.withColumn("sub_region_2", X.conditional_override(
        "sub_region_2", F.col("sub_region_1") == DC, F.lit(DC)))
    df = df.where(F.col("sub_region_1").isNotNull() & F.col("sub_region_2").isNotNull())
    df = df.withColumnsRenamed({"sub_region_1": "StateName", "sub_region_2": "CountyName"})
    old, st, new = RENAMED_COUNTY
    df = df.withColumn("CountyName", X.conditional_override(
        "CountyName", (F.col("CountyName") == old) & (F.col("StateName") == st), F.lit(new)))
    df = df.withColumns({s: F.col(s).try_cast("double") for s in SERIES if s in df.columns})
    return (df.withColumn("StateName", F.upper("StateName")).withColumn("CountyName", F.upper("CountyName"))
              .withColumn("date", X.parse_date("date", "iso")))


def stem(series: str) -> str:
    return series[: series.find("_")]


def mobility_target(raw: DataFrame, county: DataFrame, state: DataFrame) -> DataFrame:
    fips = fips_crosswalk(county, state)
    mob = load_mobility(raw)
    J.assert_full_coverage(mob, fips, ["StateName", "CountyName"])
    df = mob.join(fips, ["StateName", "CountyName"], "left")
    rolled = []
    sel = [F.col(c) for c in df.columns]
    from pyspark.sql import Window
    w = Window.partitionBy("fips").orderBy("date")
    for s in SERIES:
        for win in WINDOWS:
            name = f"chg_{stem(s)}_{win}d_avg"
            rolled.append(name)
            sel.append(F.avg(s).over(w.rowsBetween(-(win - 1), 0)).alias(name))
    df = df.select(*sel)
    df = P.lag_features(df, entity="fips", order="date", columns=rolled, lags=LAGS)
    fill = [c for c in df.columns if "avg" in c and "chg" in c]
    return P.fill_parent_mean(df, parent="StateFIPS", date="date", columns=fill)


def counts_long(wide: DataFrame, value_name: str, id_col: str = "countyFIPS",
                drop=("County Name", "State", "stateFIPS")) -> DataFrame:
    """One column per date (M/d/yy) -> (fips, date, value) + rolling means."""
    df = wide.where(F.col(id_col) != 0).drop(*drop)
    long = R.unpivot(df, ids=[id_col], var="date_text", value=value_name)
    long = long.select(X.zero_pad(F.col(id_col).cast("string"), 5).alias("fips"),
                       X.parse_date("date_text", "us_short").alias("date"),
                       F.col(value_name).cast("double").alias(value_name))
    return P.rolling_mean(long, entity="fips", order="date", columns=[value_name], windows=WINDOWS,
                          name="{col}_{w}d_avg")
