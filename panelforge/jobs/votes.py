"""D7 (vote shares) and D8 (intervention dates)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as X
from ..operators import columns as C
from ..operators import reshape as R

# Election year, the two parties kept and the output names,
# the intervention columns that are dropped and the prefix of the rest.
YEAR = 2016
PARTIES = {"democrat": "voteshare_dem", "republican": "voteshare_rep"}
DROPPED_INTERVENTIONS = ["stay at home", ">50 gatherings", ">500 gatherings", "entertainment/gym"]
INTERVENTION_KEYS = ["FIPS", "STATE", "AREA_NAME"]


def vote_shares(raw: DataFrame) -> DataFrame:
    v = raw.where((F.col("year") == YEAR) & F.col("party").isNotNull()) \
        .select("FIPS", "party", "totalvotes", "candidatevotes")
    v = v.withColumn("vote_share", X.safe_ratio("candidatevotes", "totalvotes"))
    wide = R.pivot_mean(v, keys="FIPS", pivot="party", value="vote_share", values=list(PARTIES),
                        name="{category}").withColumnsRenamed(PARTIES)
    tot = v.select("FIPS", "totalvotes").distinct()
    out = wide.join(tot, "FIPS", "inner")
    return out.select(X.key_from_float(F.col("FIPS").cast("string"), 5).alias("fips"),
                      *PARTIES.values(), "totalvotes")


def interventions(raw: DataFrame) -> DataFrame:
    missing = [c for c in DROPPED_INTERVENTIONS if c not in raw.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    df = raw.drop(*DROPPED_INTERVENTIONS)
    df = C.rename_affix(df, keys=INTERVENTION_KEYS, prefix="int_date_")
    # (column names resolve case-insensitively: build 'fips' in one select, never drop 'FIPS' after it)
    return df.select(*[c for c in df.columns if c != "FIPS"], X.zero_pad(F.col("FIPS").cast("string"), 5).alias("fips"))
