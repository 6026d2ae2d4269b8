"""Column expressions: cleaning markers, clock buckets, dates, flag folds."""

from pyspark.sql import functions as F

from stationspark.functions import clean


def test_metric_markers_become_null(spark):
    df = spark.createDataFrame([("M",), ("T",), ("  T",), ("",), (" 0.00",), ("1.50",), (None,), ("5.7",),
                                ("NaN",), ("Infinity",), ("-inf",), ("1d",), ("5f ",), ("1e3",), ("-.5",)],
                               "x string")
    got = [r.v for r in df.select(clean.metric("x").alias("v")).collect()]
    assert got == [None, None, None, None, 0.0, 1.5, None, 5.7, None, None, None, None, None, 1000.0, -0.5]


def test_metric_passes_numbers_through(spark):
    df = spark.createDataFrame([(1.25,), (None,)], "x double")
    assert [r.v for r in df.select(clean.metric("x").alias("v")).collect()] == [1.25, None]


def test_hour_bucket_open_interval(spark):
    df = spark.createDataFrame([(0,), (53,), (100,), (153,), (2359,), (2400,), (-5,)], "Time int")
    got = [r.h for r in df.select(clean.hour_bucket("Time").alias("h")).collect()]
    assert got == [None, 0, None, 1, 23, None, None]


def test_hour_bucket_including_on_hour(spark):
    df = spark.createDataFrame([(0,), (53,), (100,), (2359,)], "Time int")
    got = [r.h for r in df.select(clean.hour_bucket("Time", include_on_hour=True).alias("h")).collect()]
    assert got == [0, 0, 1, 23]


def test_dates(spark):
    df = spark.createDataFrame([(20130305,), (20131231,), (20130230,)], "d int")
    rows = df.select(clean.ymd_text("d").alias("t"), clean.ymd_to_date("d").alias("dt")).collect()
    assert [r.t for r in rows] == ["05/03/2013", "31/12/2013", None]
    assert str(rows[0].dt) == "2013-03-05"


def test_labels_and_conversion(spark):
    row = spark.range(1).select(clean.month_label(F.lit(3)).alias("m"),
                                clean.hour_label(F.lit(7)).alias("h"),
                                clean.fahrenheit_to_celsius(F.lit(50.0)).alias("c"),
                                clean.fahrenheit_to_celsius(F.lit(50.0), 31.0).alias("c31")).first()
    assert (row.m, row.h) == ("03", "7:00")
    assert row.c == (50.0 - 32.0) / 1.8 and row.c31 == (50.0 - 31.0) / 1.8


def test_flag_count_ignores_nulls_and_other_text(spark):
    df = spark.createDataFrame([("s", "s", None), (" ", "S", "s"), (None, None, None)], "a string, b string, c string")
    got = [r.n for r in df.select(clean.flag_count(["a", "b", "c"]).alias("n")).collect()]
    assert got == [2, 1, 0]


def test_text_columns_skip_keys_and_numbers(spark):
    df = spark.createDataFrame([(1, 20130101, "x", 1.0, "y", 1)],
                               "WBAN int, YearMonthDay int, a string, b double, c string, month int")
    assert clean.text_columns(df, exclude=("WBAN", "YearMonthDay", "month")) == ["a", "c"]


def test_metric_takes_what_the_cast_takes(spark):
    """Long and odd texts: the check before the cast rejects no number."""
    texts = ["0x1P3", "1e999", "-1e999", "\t3\n", "1E-5", "+5", "--5", "5.", ".", "1 2", "12t", "7" * 400 + "M", "1" * 300]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r.v for r in df.select(clean.metric("x").alias("v")).collect()]
    assert got == [8.0, None, None, 3.0, 1e-5, 5.0, None, 5.0, None, None, None, None, float("1" * 300)]
