"""Survey answer shares at metro and state level, mapped to counties."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as X
from ..operators import columns as C
from ..operators import joins as J
from ..operators import reshape as R

# Kept answers, the overall break-out, metro code corrections.
ANSWERS = ["Yes", "Obese (BMI 30.0 - 99.8)"]
OVERALL = "Overall"
METRO_FIXES = [("30100", "17200"), ("19430", "19380")]
COUNTY_FIXES = [("15901", "15009"), ("51918", "51570"), ("51918", "51730"), ("51931", "51830"),
                ("51941", "51670"), ("51949", "51620"), ("51953", "51520"), ("51958", "51735")]


def answer_shares(raw: DataFrame, questions: DataFrame, loc_id: str, loc_name: str) -> DataFrame:
    """Latest year, overall break-out, kept questions and answers -> one
    column per question ``Percent<question>`` (BMI renamed to Obese)."""
    df = raw.withColumnsRenamed({"Locationabbr": loc_id, "Locationdesc": loc_name, "Data_value": "Percent"})
    df = df.withColumn("Percent", F.col("Percent").cast("double")).withColumn("Year", F.col("Year").cast("int"))
    df = J.filter_latest(df, "Year").where(F.col("Break_Out") == OVERALL)
    df = questions.select("QuestionID", "QuestionDesc").join(df, "QuestionID", "inner")
    df = df.where(F.col("Response").isin(ANSWERS))
    qs = C.observed_categories(df, "QuestionDesc")
    wide = R.pivot_strict(df, keys=[loc_id, loc_name], pivot="QuestionDesc", value="Percent", values=qs,
                          name="{value}{category}")
    return wide.withColumnsRenamed({"PercentBMI": "PercentObese"}) if "PercentBMI" in wide.columns else wide


def state_level(raw: DataFrame, questions: DataFrame, state_xwalk: DataFrame) -> DataFrame:
    st = answer_shares(raw, questions, "StateID", "StateName").withColumn("StateName", F.upper("StateName"))
    xw = state_xwalk.select(X.zero_pad(F.col("StateFIPS").cast("string"), 2).alias("StateFIPS"),
                            F.upper("StateName").alias("StateName"))
    return st.join(J.broadcast_if_small(xw), "StateName", "inner")


def metro_crosswalk(cbsa: DataFrame) -> DataFrame:
    df = cbsa.select(F.col("CBSA_ID").cast("string").alias("CBSA_ID"),
                     X.zero_pad(F.col("FIPS_ID").cast("string"), 5).alias("FIPS_ID"))
    return df.withColumn("CBSA_ID", C.correct_keys("CBSA_ID", METRO_FIXES))


def metro_division_crosswalk(md: DataFrame) -> DataFrame:
    df = md.where(F.col("METDIVFP").isNotNull()).select(
        "NAMELSAD", "METDIVFP", "METRO_DIVISION", "STATEFP", "COUNTYFP")
    return df.select(F.col("NAMELSAD").alias("FIPS_Name"),
                     F.col("METDIVFP").cast("int").cast("string").alias("CBSA_ID"),
                     F.col("METRO_DIVISION").alias("CBSA_Name"),
                     X.compose_key(X.zero_pad(F.col("STATEFP").cast("string"), 2),
                                   X.zero_pad(F.col("COUNTYFP").cast("string"), 3)).alias("FIPS_ID"))


def county_health(metro: DataFrame, cbsa_xwalk: DataFrame, md_xwalk: DataFrame, *,
                  on_duplicate: str = "error") -> DataFrame:
    """Metro shares mapped to counties through both crosswalks (union by name),
    county codes corrected, one row per county enforced (Q20)."""
    a = metro.join(cbsa_xwalk, "CBSA_ID", "inner")
    b = metro.join(md_xwalk, "CBSA_ID", "inner")
    u = R.union_by_name([a, b]).withColumn("fips", C.correct_keys(X.zero_pad("FIPS_ID", 5), COUNTY_FIXES))
    if on_duplicate == "first":
        return u.dropDuplicates(["fips"])
    if on_duplicate == "mean":
        pct = [c for c in u.columns if c.startswith("Percent")]
        return u.groupBy("fips").agg(*[F.avg(c).alias(c) for c in pct])
    dup = u.groupBy("fips").count().where(F.col("count") > 1).limit(5).collect()
    if dup:
        raise AssertionError(f"counties mapped twice: {[r['fips'] for r in dup]}")
    return u
