import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from panelforge import functions as X
from panelforge.operators import columns as C


def _one(spark, col, schema, value):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_zero_pad_never_truncates(spark):
    df = spark.createDataFrame([("7",), ("123456",), ("01",)], "k string")
    got = [r[0] for r in df.select(X.zero_pad("k", 5)).collect()]
    assert got == ["00007", "123456", "00001"]


@settings(max_examples=25, deadline=None)
@given(st.text(alphabet="0123456789", min_size=1, max_size=8))
def test_zero_pad_idempotent(spark, s):
    df = spark.createDataFrame([(s,)], "k string")
    once = df.select(X.zero_pad("k", 5).alias("k"))
    twice = once.select(X.zero_pad("k", 5).alias("k"))
    assert once.first()[0] == twice.first()[0] == (s if len(s) >= 5 else s.rjust(5, "0"))


def test_key_from_float_keeps_text_without_dot(spark):
    # the source loader drops the last character when there is no '.', we do not
    df = spark.createDataFrame([("1001.0",), ("1001",), ("51.5",)], "t string")
    assert [r[0] for r in df.select(X.key_from_float("t", 5)).collect()] == ["01001", "01001", "00051"]


def test_two_digit_years_follow_posix_pivot(spark):
    df = spark.createDataFrame([("1/22/20",), ("12/31/99",), ("3/1/68",), ("3/1/69",)], "t string")
    got = [r[0] for r in df.select(X.parse_date("t", "us_short")).collect()]
    assert got == [dt.date(2020, 1, 22), dt.date(1999, 12, 31), dt.date(2068, 3, 1), dt.date(1969, 3, 1)]


def test_ordinal_dates_and_event_flag(spark):
    df = spark.createDataFrame([(737500, dt.date(2020, 3, 16)), (737500, dt.date(2020, 3, 15)),
                                (None, dt.date(2020, 3, 15))], "o int, d date")
    rows = df.select(X.ordinal_to_date("o").alias("od"), X.event_in_force("o", "d").alias("f")).collect()
    assert rows[0]["od"] == dt.date(2020, 3, 16) and rows[0]["f"] == 1
    assert rows[1]["f"] == 0
    assert rows[2]["od"] == dt.date(2191, 4, 29) and rows[2]["f"] == 0


def test_weekday_monday_is_zero(spark):
    assert _one(spark, X.weekday_monday0("d"), "d date", dt.date(2020, 3, 16)) == 0
    assert _one(spark, X.weekday_monday0("d"), "d date", dt.date(2020, 3, 22)) == 6


def test_ratio_log_threshold_missing_rules(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (2.0, 4.0), (None, 1.0)], "a double, b double")
    rows = df.select(X.safe_ratio("a", "b").alias("r"), X.safe_log("a").alias("l"),
                     X.threshold_flag("a", 0.5).alias("t")).collect()
    assert [r["r"] for r in rows] == [None, None, 0.5, None]
    assert rows[1]["l"] is None and rows[0]["l"] == 0.0
    assert [r["t"] for r in rows] == [1, 0, 1, 0]


def test_nonneg_numeric_nulls_no_data_codes(spark):
    df = spark.createDataFrame([("12.5",), ("-666666666",), ("0",)], "t string")
    assert [r[0] for r in df.select(X.nonneg_numeric("t")).collect()] == [12.5, None, 0.0]


def test_correct_keys_first_rule_wins_and_no_chaining(spark):
    df = spark.createDataFrame([("51918",), ("51570",), ("15901",), ("99999",)], "k string")
    rules = [("15901", "15009"), ("51918", "51570"), ("51918", "51730"), ("51570", "00000")]
    got = [r[0] for r in df.select(C.correct_keys("k", rules)).collect()]
    assert got == ["51570", "00000", "15009", "99999"]


def test_correct_keys_strict_rejects_one_to_many():
    import pytest
    with pytest.raises(ValueError):
        C.correct_keys("k", [("a", "b"), ("a", "c")], first=False)


def test_label_split(spark):
    df = spark.createDataFrame([("Lasso - v3",)], "l string")
    r = df.select(X.label_model("l").alias("m"), X.label_version("l").alias("v")).first()
    assert (r["m"], r["v"]) == ("Lasso", "3")


def test_unit_convert(spark):
    assert abs(_one(spark, X.tenths_c_to_f(F.col("t")), "t double", 100.0) - 50.0) < 1e-12
