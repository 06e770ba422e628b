"""Load adapters and the ordered run of every source pipeline.

``run_etl`` takes the landed input paths, runs each pipeline and writes one
Parquet table per source under ``out_dir`` (Parquet between our own stages;
a written table also cuts the lineage before the panel build)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources import files as IO
from . import census, health, master, mobility, votes, weather


def run_etl(spark: SparkSession, inputs: dict[str, str], out_dir: str) -> dict[str, str]:
    """inputs keys (all optional except the mobility trio): mobility, county_xwalk, state_xwalk,
    cases, deaths, daily_weather, stations, county_vertices, survey_parts, survey_manifests,
    survey_renames, business, health_metro, health_state, questions, cbsa_xwalk, metrodiv_xwalk,
    elections, interventions."""
    out: dict[str, str] = {}

    def save(name: str, df: DataFrame) -> None:
        path = f"{out_dir.rstrip('/')}/{name}"
        IO.write_parquet(df, path)
        out[name] = path

    def text(p: str) -> DataFrame:
        """Header CSV read as text (no type inference); each job casts its columns."""
        return spark.read.option("header", True).csv(p)

    save("target", mobility.mobility_target(text(inputs["mobility"]), text(inputs["county_xwalk"]),
                                            text(inputs["state_xwalk"])))
    for key in ("cases", "deaths"):
        if key in inputs:
            save(key, mobility.counts_long(text(inputs[key]), key))
    if "daily_weather" in inputs:
        daily, stations = weather.read_inputs(spark, inputs["daily_weather"], inputs["stations"])
        verts = spark.read.parquet(inputs["county_vertices"])
        save("weather", weather.county_weather(spark, daily, stations, verts))
        save("area", master.county_area(verts))
    if "survey_parts" in inputs:
        renames = "\n".join(r[0] for r in spark.read.text(inputs["survey_renames"]).collect())
        save("acs", census.survey(spark, inputs["survey_parts"], inputs["survey_manifests"], renames))
    if "business" in inputs:
        save("naics", census.industry_shares(spark, inputs["business"]))
    if "health_metro" in inputs:
        q = text(inputs["questions"])
        metro = health.answer_shares(text(inputs["health_metro"]), q, "CBSA_ID", "CBSA_Name_BRFSS")
        save("health", health.county_health(metro, health.metro_crosswalk(text(inputs["cbsa_xwalk"])),
                                            health.metro_division_crosswalk(text(inputs["metrodiv_xwalk"]))))
        save("health_state", health.state_level(text(inputs["health_state"]), q, text(inputs["state_xwalk"])))
    if "elections" in inputs:
        save("votes", votes.vote_shares(text(inputs["elections"])))
    if "interventions" in inputs:
        save("interventions", votes.interventions(text(inputs["interventions"])))
    return out


def build_from_etl(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """D9 + D10 over the written tables."""
    t = {k: spark.read.parquet(v) for k, v in tables.items()}
    hs = t.get("health_state")
    panel = master.build_panel(t["target"], area=t.get("area"), naics=t.get("naics"), acs=t.get("acs"),
                               health=t.get("health"), health_state=hs, cases=t.get("cases"),
                               deaths=t.get("deaths"), weather=t.get("weather"),
                               interventions=t.get("interventions"), votes=t.get("votes"))
    return master.prune_features(panel)
