"""Source pipelines on a few made-up rows shaped like the source files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelforge.jobs import census, health, master, mobility, study, votes, weather
from panelforge.session import scratch_path

D = dt.date


def _mob_rows():
    rows = []
    for day in range(1, 6):
        d = f"2020-03-{day:02d}"
        rows.append(("US", "United States", "Alabama", "Autauga County", d, float(day), 1.0, 2.0, 3.0, 4.0, 5.0))
        if day != 3:                                   # a missing day
            rows.append(("US", "United States", "Alabama", "Baldwin County", d, None if day == 2 else 10.0 * day,
                         1.0, 2.0, 3.0, 4.0, 5.0))
        rows.append(("US", "United States", "District of Columbia", None, d, 7.0, 1.0, 2.0, 3.0, 4.0, 5.0))
        rows.append(("US", "United States", "South Dakota", "Shannon County", d, 1.0, 1.0, 2.0, 3.0, 4.0, 5.0))
        rows.append(("US", "United States", "Alabama", None, d, 99.0, 1.0, 2.0, 3.0, 4.0, 5.0))   # state row
        rows.append(("CA", "Canada", "Ontario", "Toronto", d, 50.0, 1.0, 2.0, 3.0, 4.0, 5.0))  # foreign
    return rows


def _mob(spark):
    cols = ["country_region_code", "country_region", "sub_region_1", "sub_region_2", "date"] + mobility.SERIES
    schema = ", ".join(f"`{c}` string" if i < 5 else f"`{c}` double" for i, c in enumerate(cols))
    return spark.createDataFrame(_mob_rows(), schema)


def _xwalks(spark):
    county = spark.createDataFrame([("1", "1", "Autauga County"), ("1", "3", "Baldwin County"),
                                    ("11", "1", "District of Columbia"), ("46", "102", "Oglala Lakota County")],
                                   "StateFIPS string, CountyFIPS string, CountyName string")
    state = spark.createDataFrame([("1", "Alabama"), ("11", "District of Columbia"), ("46", "South Dakota")],
                                  "StateFIPS string, StateName string")
    return county, state


def test_mobility_target(spark):
    county, state = _xwalks(spark)
    out = mobility.mobility_target(_mob(spark), county, state)
    rows = {(r["fips"], r["date"]): r for r in out.collect()}
    assert {f for f, _ in rows} == {"01001", "01003", "11001", "46102"}        # foreign and state rows gone
    assert rows[("01001", D(2020, 3, 3))]["chg_retail_3d_avg"] == 2.0
    # Baldwin: day 2 missing value -> rolling skips it; lag counts rows not days
    assert rows[("01003", D(2020, 3, 2))]["chg_retail_3d_avg"] == 10.0
    assert rows[("01003", D(2020, 3, 4))]["lag1_chg_retail_3d_avg"] == 10.0
    assert "lag10_chg_residential_7d_avg" in out.columns and len([c for c in out.columns if c.startswith("lag")]) == 60


def test_mobility_coverage_assertion(spark):
    county, state = _xwalks(spark)
    county = county.where(F.col("CountyName") != "Oglala Lakota County")
    with pytest.raises(AssertionError):
        mobility.mobility_target(_mob(spark), county, state)


def test_counts_long(spark):
    wide = spark.createDataFrame([(0, "Statewide", "AL", 1, 5, 6, 7), (1001, "Autauga", "AL", 1, 1, 2, 6)],
                                 "countyFIPS int, `County Name` string, State string, stateFIPS int, "
                                 "`1/22/20` int, `1/23/20` int, `1/24/20` int")
    out = mobility.counts_long(wide, "cases").orderBy("date").collect()
    assert [r["fips"] for r in out] == ["01001"] * 3
    assert out[0]["date"] == D(2020, 1, 22) and out[2]["cases_3d_avg"] == 3.0


def _squares(spark):
    rows = [("01001", 0, i, x, y, False) for i, (x, y) in enumerate([(-90.0, 30.0), (-89.0, 30.0), (-89.0, 31.0), (-90.0, 31.0)])]
    rows += [("01003", 0, i, x, y, False) for i, (x, y) in enumerate([(-89.0, 30.0), (-88.0, 30.0), (-88.0, 31.0), (-89.0, 31.0)])]
    return spark.createDataFrame(rows, "poly_id string, ring_id int, seq int, x double, y double, is_hole boolean")


def test_weather(spark):
    daily = spark.createDataFrame([
        ("S1", "20200301", "TMAX", 100.0), ("S1", "20200301", "TMIN", 0.0), ("S1", "20200301", "PRCP", 1.0),
        ("S2", "20200301", "TMAX", 200.0), ("S2", "20200301", "TMIN", 100.0),           # no PRCP
        ("S3", "20200301", "TMAX", 300.0), ("S3", "20200301", "TMIN", 100.0), ("S3", "20200301", "PRCP", 0.0),
        ("S1", "20200101", "TMAX", 999.0), ("S1", "20200301", "SNOW", 5.0)],              # too early / other var
        "id string, date string, var string, value double")
    stations = spark.createDataFrame([("S1", 30.5, -89.5), ("S2", 30.5, -89.2), ("S3", 30.5, -88.5),
                                      ("S4", None, None)], "id string, lat double, lon double")
    out = {r["fips"]: r for r in weather.county_weather(spark, daily, stations, _squares(spark)).collect()}
    assert set(out) == {"01001", "01003"}
    assert out["01001"]["TMAX"] == pytest.approx((150 / 10) * 1.8 + 32)
    assert out["01001"]["PRCP"] == 1.0 and out["01001"]["precip_dummy"] == 1
    assert out["01003"]["precip_dummy"] == 0 and out["01003"]["TMIN_3d_avg"] == pytest.approx(50.0)


def _json_file(spark, name, doc):
    path = scratch_path(spark, name)
    spark.createDataFrame([(doc,)], "value string").coalesce(1).write.text(path)
    return path


def test_census_survey(spark):
    import json
    h0 = ["NAME", "S0101_C01_001E", "S1101_C01_001E", "S0801_C01_001E", "EMPTY_E", "state", "county"]
    p0 = _json_file(spark, "acs0", json.dumps([h0, ["A", "100", "40", "50", "-666666666", "01", "001"],
                                               ["B", "-666666666", "20", "10", "-666666666", "01", "003"]]))
    h1 = ["NAME", "S2201_C03_001E", "state", "county"]
    p1 = _json_file(spark, "acs1", json.dumps([h1, ["A", "4", "01", "001"], ["C", "2", "02", "001"]]))
    m0, m1 = scratch_path(spark, "m0"), scratch_path(spark, "m1")
    from panelforge.sources import files as IO
    IO.write_manifest(spark, ["S0101_C01_001E", "S1101_C01_001E", "S0801_C01_001E", "EMPTY_E"], m0)
    IO.write_manifest(spark, ["S2201_C03_001E"], m1)
    out = {r["fips"]: r for r in census.survey(spark, [p0, p1], [m0, m1], "S0101_C01_001E : pop\n").collect()}
    assert set(out) == {"01001", "01003", "02001"}                      # full outer on the keys
    assert "EMPTY_E" not in census.survey(spark, [p0, p1], [m0, m1], "S0101_C01_001E:pop").columns
    assert out["01001"]["pop"] == 100.0 and out["01001"]["workers_pct"] == 0.5
    assert out["01003"]["pop"] == 100.0                                  # state mean fills the gap
    assert out["02001"]["pop"] == 0.0                                    # no state value -> 0
    with pytest.raises(KeyError):
        census.survey(spark, [p0, p1], [m0, m1], "NOPE:x")


def test_industry_shares(spark):
    import json
    hdr = ["NAICS2017", "NAICS2017_LABEL", "GEO_ID", "EMP"]
    rows = [hdr, ["00", "Total", "0500000US01001", "100"], ["11", "Farming", "0500000US01001", "30"],
            ["21", "Mining", "0500000US01001", "70"], ["113", "Forestry", "0500000US01001", "5"],
            ["00", "Total", "0500000US01003", "50"], ["11", "Farming", "0500000US01003", "50"]]
    out = {r["fips"]: r for r in census.industry_shares(spark, _json_file(spark, "naics", json.dumps(rows))).collect()}
    assert out["01001"]["NAICS Farming"] == 0.3 and out["01001"]["NAICS Mining"] == 0.7
    assert out["01003"]["NAICS Mining"] == 0.7                       # missing industry <- state mean
    assert "NAICS Forestry" not in out["01001"].asDict()


def _health_raw(spark, loc_ids):
    rows = []
    for loc in loc_ids:
        rows += [(2017, "Overall", loc, f"{loc} name", "Q1", "Yes", 10.0), (2018, "Overall", loc, f"{loc} name", "Q1", "Yes", 20.0),
                 (2018, "Overall", loc, f"{loc} name", "Q1", "No", 80.0),
                 (2018, "Overall", loc, f"{loc} name", "Q2", "Obese (BMI 30.0 - 99.8)", 30.0),
                 (2018, "Age 18-24", loc, f"{loc} name", "Q1", "Yes", 99.0)]
    return spark.createDataFrame(rows, "Year int, Break_Out string, Locationabbr string, Locationdesc string, "
                                       "QuestionID string, Response string, Data_value double")


def test_health(spark):
    q = spark.createDataFrame([("Q1", "Smoke"), ("Q2", "BMI")], "QuestionID string, QuestionDesc string")
    metro = health.answer_shares(_health_raw(spark, ["17200", "11111"]), q, "CBSA_ID", "CBSA_Name_BRFSS")
    assert set(metro.columns) >= {"PercentSmoke", "PercentObese"}
    assert {r["PercentSmoke"] for r in metro.collect()} == {20.0}
    cbsa = health.metro_crosswalk(spark.createDataFrame([("30100", "1001"), ("11111", "51918")], "CBSA_ID string, FIPS_ID string"))
    md = health.metro_division_crosswalk(spark.createDataFrame(
        [("01", "3", "Baldwin", "17200", "Div"), ("01", "5", "X", None, None)],
        "STATEFP string, COUNTYFP string, NAMELSAD string, METDIVFP string, METRO_DIVISION string"))
    got = {r["fips"] for r in health.county_health(metro, cbsa, md).collect()}
    assert got == {"01001", "51570", "01003"}                          # 51918 corrected, first rule wins
    dup = health.metro_division_crosswalk(spark.createDataFrame(
        [("01", "1", "Autauga", "17200", "Div")], "STATEFP string, COUNTYFP string, NAMELSAD string, "
                                                   "METDIVFP string, METRO_DIVISION string"))
    with pytest.raises(AssertionError):
        health.county_health(metro, cbsa, dup)
    assert health.county_health(metro, cbsa, dup, on_duplicate="mean").count() == 2
    st = health.state_level(_health_raw(spark, ["AL"]).withColumn("Locationdesc", F.lit("alabama")), q,
                            spark.createDataFrame([("1", "Alabama")], "StateFIPS string, StateName string"))
    assert st.first()["StateFIPS"] == "01"


def test_votes_and_interventions(spark):
    raw = spark.createDataFrame([(2016, "1001.0", "democrat", 100, 40), (2016, "1001.0", "republican", 100, 60),
                                 (2012, "1001.0", "democrat", 90, 45), (2016, "1001.0", None, 100, 1)],
                                "year int, FIPS string, party string, totalvotes int, candidatevotes int")
    r = votes.vote_shares(raw).first()
    assert (r["fips"], r["voteshare_dem"], r["voteshare_rep"], r["totalvotes"]) == ("01001", 0.4, 0.6, 100)
    iv = spark.createDataFrame([("1001", "AL", "Autauga", 1.0, 2.0, 3.0, 4.0, 737500.0)],
                               "FIPS string, STATE string, AREA_NAME string, `stay at home` double, "
                               "`>50 gatherings` double, `>500 gatherings` double, `entertainment/gym` double, "
                               "`public schools` double")
    out = votes.interventions(iv)
    assert out.columns == ["STATE", "AREA_NAME", "int_date_public schools", "fips"]
    with pytest.raises(KeyError):
        votes.interventions(iv.drop("stay at home"))


def test_master_panel_and_pruning(spark):
    county, state = _xwalks(spark)
    target = mobility.mobility_target(_mob(spark), county, state)
    area = spark.createDataFrame([("01001", 2.0), ("01003", 4.0)], "fips string, area double")
    acs = spark.createDataFrame([("01001", 100.0), ("01003", 50.0)], "fips string, pop double")
    hs = spark.createDataFrame([("01", 11.0)], "StateFIPS string, PercentSmoke double")
    hc = spark.createDataFrame([("01001", 5.0, "x", "y")], "fips string, PercentSmoke double, CBSA_ID string, NAME string")
    iv = spark.createDataFrame([("01001", 737485.0)], "fips string, `int_date_public schools` double")   # 2020-03-01
    panel = master.build_panel(target, area=area, acs=acs, health=hc, health_state=hs, interventions=iv)
    rows = {(r["fips"], r["date"]): r for r in panel.collect()}
    assert rows[("01001", D(2020, 3, 2))]["PercentSmoke"] == 5.0
    assert rows[("01003", D(2020, 3, 2))]["PercentSmoke"] == 11.0            # state fallback
    assert rows[("01001", D(2020, 3, 2))]["int_date_public schools"] == 1
    assert rows[("01003", D(2020, 3, 2))]["int_date_public schools"] == 0    # never -> ordinal 800000
    assert rows[("01001", D(2020, 3, 2))]["pop_density"] == 50.0
    assert rows[("01001", D(2020, 3, 2))]["dayofweek_0"] == 1                # a Monday
    assert not any(c.startswith("CBSA") or c == "NAME" for c in panel.columns)
    pruned = master.prune_features(panel).columns
    assert [c for c in pruned if c.startswith("lag")] == ["lag7_chg_retail_7d_avg"] or \
        not any(c.startswith("chg") for c in pruned)
    assert not any(c.startswith(("lag1", "lag3", "lag5", "chg")) for c in pruned)


def test_study_and_reports(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    rows = []
    for e in range(5):
        for t in range(60):
            x1, x2 = float(rng.normal()), float(rng.normal())
            rows.append((f"0{e}001", D(2020, 3, 1) + dt.timedelta(days=t), 2 * x1 - x2 + float(rng.normal(0, .1)),
                         x1, None if t % 9 == 0 else x2))
    panel = spark.createDataFrame(rows, f"fips string, date date, {study.TARGET} double, a double, b double")
    res = study.run_study(panel, grid=[("linear", {}), ("lasso", {"alpha": 5.0})])
    avg = {r["model"]: r["mae"] for r in res.average.collect()}
    assert avg["linear"] < 0.5 < avg["lasso"]
    assert res.all_validations.count() == 6
    pca = study.run_study(panel, with_pca=True, grid=[("linear", {})])
    assert pca.average.count() == 1
    rep = study.report_tables(panel, corr_columns=["a", "b"])
    miss = {r["column"]: r["pct_missing"] for r in rep["missing_by_column"].collect()}
    assert miss["a"] == 0.0 and abs(miss["b"] - 100 * 7 / 60) < 1e-9


def test_etl_end_to_end(spark):
    from panelforge.jobs import etl

    def land(df, name):
        path = scratch_path(spark, name)
        df.coalesce(1).write.option("header", True).csv(path)
        return path
    county, state = _xwalks(spark)
    cases = spark.createDataFrame([(0, "S", "AL", 1, 5, 6), (1001, "Autauga", "AL", 1, 1, 3), (1003, "B", "AL", 1, 2, 2)],
                                  "countyFIPS int, `County Name` string, State string, stateFIPS int, "
                                  "`3/1/20` int, `3/2/20` int")
    elections = spark.createDataFrame([(2016, "1001.0", "democrat", 100, 40), (2016, "1001.0", "republican", 100, 60)],
                                      "year int, FIPS string, party string, totalvotes int, candidatevotes int")
    iv = spark.createDataFrame([("1001", "AL", "Autauga", 1.0, 2.0, 3.0, 4.0, 737485.0)],
                               "FIPS string, STATE string, AREA_NAME string, `stay at home` double, "
                               "`>50 gatherings` double, `>500 gatherings` double, `entertainment/gym` double, "
                               "`public schools` double")
    inputs = {"mobility": land(_mob(spark), "mob"), "county_xwalk": land(county, "cx"), "state_xwalk": land(state, "sx"),
              "cases": land(cases, "cases"), "elections": land(elections, "el"), "interventions": land(iv, "iv")}
    tables = etl.run_etl(spark, inputs, scratch_path(spark, "etl"))
    assert set(tables) == {"target", "cases", "votes", "interventions"}
    panel = etl.build_from_etl(spark, tables)
    r = {(x["fips"], x["date"]): x for x in panel.collect()}
    assert r[("01001", D(2020, 3, 2))]["cases"] == 3.0 and r[("01001", D(2020, 3, 2))]["voteshare_dem"] == 0.4
    assert r[("01001", D(2020, 3, 2))]["int_date_public schools"] == 1
    assert "cases_per_pop" not in panel.columns          # no population table landed: ratio rule skipped


def test_study_all_model_families(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    rows = []
    for e in range(4):
        for t in range(40):
            x1, x2 = float(rng.normal()), float(rng.normal())
            rows.append((f"0{e}001", D(2020, 3, 1) + dt.timedelta(days=t), 3 * x1 + x2 + float(rng.normal(0, .2)), x1, x2))
    panel = spark.createDataFrame(rows, f"fips string, date date, {study.TARGET} double, a double, b double")
    grids = {"linear": [("linear", {}), ("ridge", {"alpha": 1.0})],
             "svr": [{"C": 1.0, "epsilon": 0.1}, {"C": 0.01, "epsilon": 1.0}],
             "forest": [{"n_estimators": 5, "max_features": "auto"}],
             "adaboost": [{"n_estimators": 2}, {"n_estimators": 4}],
             "knn": [{"n_neighbors": 3}, {"n_neighbors": 5}]}
    res = study.run_study(panel, with_pca=True, grids=grids)
    rows = res.all_validations.collect()
    assert len(rows) == 9 * 3
    avg = {(r["model"], r["params"]): r["mae"] for r in res.average.collect()}
    null = float(np.mean([abs(r[2] - np.mean([x[2] for x in panel.collect()])) for r in panel.collect()]))
    assert avg[("linear", "{}")] < null / 3 and avg[("knn", '{"n_neighbors": 5}')] < null
    _check_test_scoring_and_tables(spark, panel, res, grids)


def _check_test_scoring_and_tables(spark, panel, res, grids):
    """Test rows through the stored preparation and models; a second run opens all; every table is read back."""
    import numpy as np
    from panelforge.ml.families import FAMILIES
    n = res.store.index().count()
    assert n == 3 * (1 + 2 * 5)                          # a preparation, five models and their predictions a fold
    again = study.run_study(panel.repartition(3), store=res.store.root, with_pca=True, grids=grids)
    assert again.id == res.id and again.store.index().count() == n
    more = {"linear": grids["linear"], "knn": [{"n_neighbors": 4}]}
    assert study.run_study(panel, store=res.store.root, with_pca=True, grids=more).store.index().count() == n + 6
    pred = study.test_predictions(res, panel).collect()
    days = sorted({r["date"] for r in panel.collect()})
    assert len(pred) == 9 * 4 * 4 and {r["date"] for r in pred} == set(days[-4:])
    assert {(r["model"], r["params"]) for r in pred} == {(r["model"], r["params"]) for r in res.average.collect()}
    # least squares by hand: train rows of the last fold, standardised, PCA keeps both components here
    rows = sorted(panel.collect(), key=lambda r: (r["date"], r["fips"]))
    cut = days[round(0.8 * (len(days) - 1))]
    tr = [r for r in rows if r["date"] <= cut]
    X, y = np.array([[r["a"], r["b"], 1.0] for r in tr]), np.array([r[study.TARGET] for r in tr])
    w = np.linalg.lstsq(X, y, rcond=None)[0]
    truth = {(r["fips"], r["date"]): r["a"] * w[0] + r["b"] * w[1] + w[2] for r in rows}
    for r in pred:
        if r["model"] == "linear":
            assert abs(r["y_hat"] - truth[r["fips"], r["date"]]) < 1e-6
    mae = study.test_mae({1: study.test_predictions(res, panel), 2: study.test_predictions(again, panel)}).collect()
    assert len(mae) == 18 and {r["version"] for r in mae} == {"1", "2"}
    by = {r["label"]: r["mae"] for r in mae}
    own = [abs(r["y"] - r["y_hat"]) for r in pred if r["model"] == "linear"]
    assert abs(by["linear {} - v1"] - np.mean(own)) < 1e-6 and by["linear {} - v1"] == by["linear {} - v2"]
    tables = study.write_tables(study.study_tables(res, panel), scratch_path(spark, "tables"))
    got = {k: spark.read.parquet(v) for k, v in tables.items()}
    assert got["null_models"].count() == 6 and got["null_average"].count() == 2
    best = {r["model"]: r["mae"] for r in got["best_by_model"].collect()}
    for m in best:
        assert best[m] == min(r["mae"] for r in res.average.collect() if r["model"] == m)
    wide = got["prediction_table"]
    assert set(wide.columns) == {"fips", "date", "y", "global_mean", "entity_mean", *best}
    last = res.predictions.where(F.col("fold") == res.last_fold)
    assert wide.count() == last.select("fips", "date").distinct().count() and wide.dropna().count() == wide.count()
    assert got["entity_mae"].count() == 4 and len(FAMILIES) == 5


def test_svr_grid_in_one_pass_matches_separate_fits(spark):
    import numpy as np
    from panelforge.ml import svr as SVR
    rng = np.random.default_rng(3)
    rows = [(float(a), float(2 * a + rng.normal(0, .3))) for a in rng.normal(size=200)]
    df = spark.createDataFrame(rows, "x double, y double")
    rep = df.select("x", "y", F.explode(F.array(F.lit("p"), F.lit("q"))).alias("g"))
    both = SVR.fit_linear_svr_groups(rep, features=["x"], by="g", C={"p": 1.0, "q": 0.05},
                                     epsilon={"p": 0.1, "q": 0.5})
    for g, (c, e) in (("p", (1.0, 0.1)), ("q", (0.05, 0.5))):
        w, _ = SVR.fit_linear_svr(df, features=["x"], C=c, epsilon=e)
        assert np.allclose(both[g][0], w, atol=1e-9)
