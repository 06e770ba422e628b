"""D2 (survey variables per county) and D3 (employment by industry)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as X
from ..operators import columns as C
from ..operators import joins as J
from ..operators import panel as P
from ..operators import reshape as R
from ..sources import files as IO

# Key columns of the survey tables and the derived-feature rules.
KEYS = ["NAME", "state", "county"]
LOG_FEATURES = {"log_pop": "S0101_C01_001E", "log_households": "S1101_C01_001E"}
COMMUTERS = "S0801_C01_001E"
POPULATION = "S0101_C01_001E"
HOUSEHOLDS = "S1101_C01_001E"
COMMUTER_COLS = ["S0801_C01_002E", "S0801_C01_009E", "S0801_C01_010E", "S0801_C01_011E", "S0801_C01_012E",
                 "S0801_C01_013E"]
HOUSEHOLD_SHARES = {"households_u18_pct": "S1101_C01_010E", "households_o60_pct": "S1101_C01_011E",
                    "household_owner_occupied_pct": "S1101_C01_019E", "household_rented_pct": "S1101_C01_020E"}
INCOME_COLS = ["S1901_C01_002E", "S1901_C01_003E", "S1901_C01_004E", "S1901_C01_005E", "S1901_C01_006E",
               "S1901_C01_007E", "S1901_C01_008E", "S1901_C01_009E", "S1901_C01_010E", "S1901_C01_011E"]
FOOD_STAMPS = ("food_stamps_pct", "S2201_C03_001E")
DROPPED = ["S0801_C01_001E", "S1101_C01_010E", "S1101_C01_011E", "S1101_C01_019E", "S1101_C01_020E",
           "S2201_C03_001E"]


def clean_survey(rows: DataFrame) -> DataFrame:
    """Text values -> numbers with negative no-data codes as missing; drop
    columns that are entirely missing."""
    data_cols = [c for c in rows.columns if c not in KEYS + ["STATE", "COUNTY"]]
    typed = rows.select(*[X.nonneg_numeric(c).alias(c) if c in data_cols else F.col(c) for c in rows.columns])
    return C.drop_empty_columns(typed)


def survey_features(df: DataFrame) -> DataFrame:
    """Logs and shares of the survey counts. A rule whose inputs are absent
    (e.g. dropped as entirely missing) is skipped instead of failing."""
    have = set(df.columns)
    cols = {c: F.col(c) for c in df.columns}
    cols["fips"] = X.compose_key("state", "county")

    def ratio(num, den):
        return X.safe_ratio(num, den) if num in have and den in have else None
    for name, src in LOG_FEATURES.items():
        if src in have:
            cols[name] = X.safe_log(src)
    derived = {"workers_pct": ratio(COMMUTERS, POPULATION)}
    derived.update({c: ratio(c, COMMUTERS) for c in COMMUTER_COLS})
    derived.update({name: ratio(src, HOUSEHOLDS) for name, src in HOUSEHOLD_SHARES.items()})
    derived.update({c: ratio(c, HOUSEHOLDS) for c in INCOME_COLS})
    derived[FOOD_STAMPS[0]] = ratio(FOOD_STAMPS[1], HOUSEHOLDS)
    cols.update({k: v for k, v in derived.items() if v is not None})
    return df.select(*[v.alias(k) for k, v in cols.items() if k not in DROPPED])


def survey(spark: SparkSession, parts: Sequence[str], manifests: Sequence[str], rename_text: str) -> DataFrame:
    """Each part is a landed JSON row-array file holding the manifest's
    variables; parts are full-outer joined on the keys."""
    out = None
    for path, man in zip(parts, manifests):
        rows = IO.scan_json_rows(spark, path)
        rows = IO.select_manifest(rows, IO.read_manifest(spark, man), keep=KEYS)
        part = clean_survey(rows)
        out = part if out is None else out.join(part, KEYS, "full")
    df = survey_features(out)
    df = C.rename_strict(df, C.parse_rename_map(rename_text))
    num = P.numeric_columns(df)
    return P.fill_parent_mean(df.withColumn("__day", F.lit(0)), parent="state", date="__day", columns=num,
                              then_zero=True).drop("__day")


# ---- business patterns ------------------------------------------------------

def industry_shares(spark: SparkSession, path: str, level: int = 2) -> DataFrame:
    """Employment share of each industry at ``level`` digits in the county
    total ('00'), one column per industry label, prefixed once."""
    rows = IO.scan_json_rows(spark, path)
    df = rows.select(F.col("NAICS2017").alias("Industry"), F.col("NAICS2017_LABEL").alias("Industry_Label"),
                     F.col("EMP").cast("int").alias("EMP"), X.suffix_key("GEO_ID", 5).alias("fips"))
    sec = df.where((F.length("Industry") == level) | (F.col("Industry") == "00"))
    share = J.share_of_total(sec, entity="fips", code="Industry", value="EMP", out="emp_pct")
    labels = C.observed_categories(share, "Industry_Label")      # one value per industry of the level
    wide = R.pivot_strict(share, keys="fips", pivot="Industry_Label", value="emp_pct", values=labels,
                          name="{category}")
    wide = wide.withColumn("state", X.parent_key("fips", 2))
    filled = P.fill_parent_mean(wide.withColumn("__day", F.lit(0)), parent="state", date="__day",
                                columns=labels, then_zero=True).drop("__day", "state")
    return C.rename_affix(filled, keys=["fips"], prefix="NAICS ")
