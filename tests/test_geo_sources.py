import pytest
from pyspark.sql import functions as F


from panelforge.operators import columns as C
from panelforge.operators import geo as GEO
from panelforge.session import scratch_path
from panelforge.sources import files as IO

SQUARE_HOLE = [(1, 0, 0, 0.0, 0.0, False), (1, 0, 1, 4.0, 0.0, False), (1, 0, 2, 4.0, 4.0, False),
               (1, 0, 3, 0.0, 4.0, False), (1, 1, 0, 1.0, 1.0, True), (1, 1, 1, 2.0, 1.0, True),
               (1, 1, 2, 2.0, 2.0, True), (1, 1, 3, 1.0, 2.0, True),
               (2, 0, 0, 4.0, 0.0, False), (2, 0, 1, 6.0, 0.0, False), (2, 0, 2, 6.0, 4.0, False),
               (2, 0, 3, 4.0, 4.0, False),
               (3, 0, 0, 10.0, 0.0, False), (3, 0, 1, 14.0, 0.0, False), (3, 0, 2, 14.0, 4.0, False),
               (3, 0, 3, 12.0, 1.0, False), (3, 0, 4, 10.0, 4.0, False)]
SCHEMA = "poly_id int, ring_id int, seq int, x double, y double, is_hole boolean"


def test_poly_area_with_hole(spark):
    v = spark.createDataFrame(SQUARE_HOLE, SCHEMA)
    got = {r["poly_id"]: r["area"] for r in GEO.poly_area(v).collect()}
    assert got == {1: 15.0, 2: 8.0, 3: 10.0}


def test_spatial_join_holes_borders_concave(spark):
    v = spark.createDataFrame(SQUARE_HOLE, SCHEMA)
    pts = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.5, 1.5), (3, 4.0, 2.0), (4, 12.0, 3.0), (5, 12.0, 0.5),
                                 (6, None, 1.0), (7, 1.0, 1.5)], "pid int, x double, y double")
    got = sorted(tuple(r) for r in GEO.spatial_join(pts, v, cell=1.5).select("pid", "poly_id").collect())
    # 2 in the hole; 3 on the shared border -> both; 4 in the concave notch; 7 on the hole's edge -> in
    assert got == [(1, 1), (3, 1), (3, 2), (5, 3), (7, 1)]
    for cell, size in ((0.25, 1 << 20), (1.5, 0), (100.0, 1 << 20)):       # any grid, joined or broadcast
        j = GEO.spatial_join(pts, v, cell=cell, index_bytes=size)
        assert sorted(tuple(r) for r in j.select("pid", "poly_id").collect()) == got


def test_spatial_join_does_not_shuffle_points(spark):
    v = spark.createDataFrame(SQUARE_HOLE, SCHEMA)
    pts = spark.range(50).select(F.col("id").alias("pid"), (F.rand(1) * 14).alias("x"), (F.rand(2) * 4).alias("y"))
    plan = GEO.spatial_join(pts, v)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan.split("BroadcastExchange")[0]
    points_side = [ln for ln in plan.splitlines() if "Exchange" in ln and "pid" in ln]
    assert points_side == []


def test_fixed_width_short_lines(spark):
    path = scratch_path(spark, "fw")
    spark.createDataFrame([("USW00012345  45.5000 -122.1000        OR PORTLAND",), ("SHORT",)], "value string") \
        .coalesce(1).write.text(path)
    fields = [("id", 0, 11, "string"), ("lat", 12, 20, "double"), ("lon", 21, 30, "double"),
              ("state", 38, 40, "string"), ("name", 41, 71, "string")]
    rows = {r["id"]: r for r in IO.scan_fixed_width(spark, path, fields).collect()}
    assert rows["USW00012345"]["lat"] == 45.5 and rows["USW00012345"]["lon"] == -122.1
    assert rows["USW00012345"]["state"] == "OR" and rows["USW00012345"]["name"] == "PORTLAND"
    assert rows["SHORT"]["lat"] is None


def test_json_rows_header_and_mismatch(spark):
    path = scratch_path(spark, "js")
    spark.createDataFrame([('[["NAME","B01001_001E","state"],["A","10","01"],["B","-666666666","02"]]',)],
                          "value string").write.text(path)
    rows = IO.scan_json_rows(spark, path).collect()
    assert [tuple(r) for r in rows] == [("A", "10", "01"), ("B", "-666666666", "02")]
    bad = scratch_path(spark, "js2")
    spark.createDataFrame([('[["a"],["1"]]',), ('[["b"],["2"]]',)], "value string").write.text(bad)
    with pytest.raises(ValueError):
        IO.scan_json_rows(spark, bad)


def test_json_rows_whole_file(spark):
    path = scratch_path(spark, "jsw")
    spark.createDataFrame([('[["k","v"],\n ["1","x"],\n ["2","y"]]',)], "value string").coalesce(1).write.text(path)
    assert IO.scan_json_rows(spark, path, whole_file=True).count() == 2


def test_csv_nan_to_null(spark):
    path = scratch_path(spark, "csvnan")
    spark.createDataFrame([("a", "NaN"), ("b", "1.5")], "k string, v string").write.option("header", True).csv(path)
    got = {r["k"]: r["v"] for r in IO.scan_csv(spark, path, "k string, v double").collect()}
    assert got == {"a": None, "b": 1.5}


def test_rename_map_unknown_name_fails(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    m = C.parse_rename_map(" a : x \n\nb:y\n")
    assert C.rename_strict(df, m).columns == ["x", "y"]
    with pytest.raises(KeyError):
        C.rename_strict(df, {"zz": "q"})


def test_select_pattern_prefix_quirk():
    cols = ["fips", "lag1_a", "lag10_a", "lag7_a", "a_3d_avg", "a_7d_avg"]
    assert C.select_pattern(cols, keep=["fips"], drop_prefix=["lag1"], drop_suffix=["_3d_avg"]) == \
        ["fips", "lag7_a", "a_7d_avg"]


def test_drop_empty_columns(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b double")
    assert C.drop_empty_columns(df).columns == ["a"]


def test_manifest_roundtrip(spark):
    path = scratch_path(spark, "man")
    IO.write_manifest(spark, ["b", " a "], path)
    assert IO.read_manifest(spark, path) == ["b", "a"]
    df = spark.createDataFrame([(1, 2, 3)], "k int, a int, b int")
    assert IO.select_manifest(df, ["b", "a"], keep=["k"]).columns == ["k", "b", "a"]
    with pytest.raises(KeyError):
        IO.select_manifest(df, ["zz"])


def test_join_helpers(spark):
    from panelforge.operators import joins as J
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, name string")
    right = spark.createDataFrame([(1, "x")], "k int, name string")
    ind = {r["k"]: r["_merge"] for r in J.join_with_indicator(left, right.select("k"), "k").collect()}
    assert ind == {1: "both", 2: "left_only"}
    with pytest.raises(AssertionError):
        J.assert_full_coverage(left, right, "k")
    assert J.join_suffixed(left, right, "k").columns == ["k", "name_x", "name_y"]
    long = spark.createDataFrame([("01", "00", 10), ("01", "11", 4), ("01", "22", 6)], "c string, code string, emp int")
    got = {r["code"]: r["share"] for r in J.share_of_total(long, entity="c", code="code", value="emp").collect()}
    assert got == {"11": 0.4, "22": 0.6}
    lat = spark.createDataFrame([(2019, 1), (2020, 2), (2020, 3)], "yr int, v int")
    assert sorted(r["v"] for r in J.filter_latest(lat, "yr").collect()) == [2, 3]



def test_json_row_lines_are_split_inside_a_document(spark, tmp_path):
    import json
    header = ["NAME", "a]", "b"]
    rows = [[f'x],\n["{i}"]', None if i % 7 == 0 else f"[{i}],", str(i)] for i in range(5000)]
    text = "[" + ",\n".join(json.dumps(r) for r in [header, *rows]) + "]"
    path = tmp_path / "one.json"
    path.write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        df = IO.scan_json_row_lines(spark, str(path))
        assert df.rdd.getNumPartitions() > 3 and df.columns == header
        assert sorted((list(r) for r in df.collect()), key=lambda r: int(r[2])) == rows
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")
    # brackets on lines of their own, blank lines, two files with the same header
    (tmp_path / "two").mkdir()
    for n in (1, 2):
        (tmp_path / "two" / f"{n}.json").write_text(f'[\n\n  ["h", "k"] ,\n ["{n}", "v"]\n]\n')
    got = IO.scan_json_row_lines(spark, str(tmp_path / "two"))
    assert sorted(map(tuple, got.collect())) == [("1", "v"), ("2", "v")]
    (tmp_path / "bad.json").write_text('[["h", "k"],\n["1"]]')
    with pytest.raises(Exception, match="not a row of 2 values"):
        IO.scan_json_row_lines(spark, str(tmp_path / "bad.json")).collect()


def test_observed_categories_are_bounded(spark):
    from panelforge.operators import columns as C
    df = spark.range(30).select((F.col("id") % 3).alias("a"), F.when(F.col("id") > 2, F.col("id")).alias("b"))
    assert C.observed_categories(df, "a", most=3) == [0, 1, 2]
    with pytest.raises(C.TooManyCategories):
        C.observed_categories(df, "b", most=26)
    assert len(C.observed_categories(df, "b", most=27)) == 27
