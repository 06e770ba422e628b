"""D9 (master county-day panel) and D10 (feature pruning)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as X
from ..operators import columns as C
from ..operators import geo as GEO
from ..operators import panel as P

# Columns removed after the merges and the pruning rules.
HEALTH_DROP_PREFIX = ("CBSA", "FIPS")
HEALTH_DROP = ["NAME", "county"]
INTERVENTION_DROP = ["STATE", "AREA_NAME", "log_cases", "log_deaths"]
WEATHER_PREFIX = "TM"
PRECIP = "PRCP"
PRECIP_CUTOFF = 0.05
PRUNE_DROP = ["state_x", "state_y", "CountyFIPS", "totalvotes", "dayofweek", "StateFIPS"]
PRUNE_PREFIX = ["chg", "lag1", "lag3", "lag5"]
PRUNE_SUFFIX = ["3d_avg", "workplaces_7d_avg", "residential_7d_avg", "parks_7d_avg", "grocery_7d_avg",
                "transit_7d_avg"]
RATIOS = {"pop_density": ("pop", "area"), "cases_per_pop": ("cases", "pop"), "cases_per_area": ("cases", "area"),
          "deaths_per_pop": ("deaths", "pop"), "deaths_per_area": ("deaths", "area")}


def county_area(vertices: DataFrame) -> DataFrame:
    """Planar area per county from its vertex table (poly_id = fips)."""
    return GEO.poly_area(vertices).withColumnRenamed("poly_id", "fips")


def build_panel(target: DataFrame, *, area: DataFrame | None = None, naics: DataFrame | None = None,
                acs: DataFrame | None = None, health: DataFrame | None = None,
                health_state: DataFrame | None = None, cases: DataFrame | None = None,
                deaths: DataFrame | None = None, weather: DataFrame | None = None,
                interventions: DataFrame | None = None, votes: DataFrame | None = None) -> DataFrame:
    """Left-join every source to the target's county-day rows, fill gaps
    from the state, add event flags, ratios and weekday dummies.

    Per-county tables are joined on ``fips`` (AQE broadcasts them from their
    run-time size: one row per county); day tables on (fips, date).
    """
    df = target
    for t in (area, naics, acs):
        if t is not None:
            df = df.join(t, "fips", "left")
    if health is not None:
        df = df.join(health.drop("StateFIPS") if "StateFIPS" in health.columns else health, "fips", "left")
    if health_state is not None:
        pct = [c for c in health_state.columns if c.startswith("Percent")]
        for c in pct:
            if c not in df.columns:
                df = df.withColumn(c, F.lit(None).cast("double"))
        df = P.fill_from_parent_table(df, health_state.select("StateFIPS", *pct), on="StateFIPS", columns=pct)
    drop = [c for c in df.columns if c.endswith("_state") or c[:4] in HEALTH_DROP_PREFIX] + \
        [c for c in HEALTH_DROP if c in df.columns]
    df = df.drop(*drop)
    for t in (cases, deaths):
        if t is not None:
            df = df.join(t, ["date", "fips"], "left")
    if weather is not None:
        w = weather.drop("state") if "state" in weather.columns else weather
        w = w.drop("precip_dummy") if "precip_dummy" in w.columns else w
        df = df.join(w, ["fips", "date"], "left")
        wcols = [c for c in df.columns if c.startswith(WEATHER_PREFIX) or c == PRECIP]
        df = P.fill_parent_mean(df, parent="StateFIPS", date="date", columns=wcols)
        df = df.withColumn("precip_dummy", X.threshold_flag(PRECIP, PRECIP_CUTOFF))
    if interventions is not None:
        df = df.join(interventions, "fips", "left")
        df = df.drop(*[c for c in INTERVENTION_DROP if c in df.columns])
        ev = [c for c in df.columns if c.startswith("int_date_")]
        df = df.select(*[X.event_in_force(c, "date").alias(c) if c in ev else F.col(c) for c in df.columns])
    if votes is not None:
        df = df.join(votes, "fips", "left")
    return make_features(df)


def make_features(df: DataFrame) -> DataFrame:
    extra = [X.safe_ratio(a, b).alias(name) for name, (a, b) in RATIOS.items() if a in df.columns and b in df.columns]
    dow = X.weekday_monday0("date")
    return df.select("*", *extra, dow.alias("dayofweek"), *C.one_hot(dow, range(7), "dayofweek"))


def prune_features(df: DataFrame) -> DataFrame:
    """The reference's drop rules (plain prefixes: dropping 'lag1' also
    drops 'lag10...', so the only lag left is lag7 of the retail 7-day mean)."""
    keep = C.select_pattern(df.columns, drop_prefix=PRUNE_PREFIX, drop_suffix=PRUNE_SUFFIX)
    return df.select(*[c for c in keep if c not in PRUNE_DROP])
