import datetime as dt

from pyspark.sql import functions as F

from quillspark.functions import numeric, parsing, time as qtime


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_safe_dates_keep_bad_rows_as_null(spark):
    df = spark.createDataFrame([("01/02/2020 01:05:00 PM",), ("garbage",), ("",), (None,)], "d string")
    out = rows(df.select(parsing.safe_date("d"), parsing.safe_timestamp("d"), parsing.year_or_null("d")))
    assert out[0] == (dt.date(2020, 1, 2), dt.datetime(2020, 1, 2, 13, 5), 2020)
    assert out[1:] == [(None, None, None)] * 3


def test_iso_week_with_calendar_year(spark):
    df = spark.createDataFrame([(dt.datetime(2018, 12, 31),), (dt.datetime(2021, 1, 1),)], "t timestamp")
    y, w = qtime.year_week("t")
    assert rows(df.select(y, w)) == [(2018, 1), (2021, 53)]


def test_day_of_week_sunday_is_one(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7, 5),)], "t timestamp")
    assert rows(df.select(qtime.time_part("t", "day_of_week"), qtime.time_part("t", "hour"))) == [(1, 5)]


def test_pad_key_pads_and_truncates(spark):
    df = spark.createDataFrame([("421",), ("0421",), ("12345",)], "b string")
    assert rows(df.select(parsing.pad_key("b"))) == [("0421",), ("0421",), ("1234",)]


def test_flags(spark):
    df = spark.createDataFrame([("true",), ("TRUE ",), ("yes",), (None,)], "a string")
    out = rows(df.select(parsing.bool_text_flag("a"), parsing.bool_text_flag("a", null_as_zero=False),
                         parsing.in_list_flag("a", ["yes"])))
    assert out == [(1, 1, 0), (1, 0, 0), (0, 0, 1), (0, None, 0)]


def test_first_matching_label_one_per_word_case_sensitive(spark):
    df = spark.createDataFrame([("chinu",), ("hawaii",), ("NU",), ("plain",)], "w string")
    out = rows(df.select(parsing.first_matching_label("w", ["nu", "chi", "haw"])))
    assert out == [("nu",), ("haw",), (None,), (None,)]


def test_int_text_in_range(spark):
    df = spark.createDataFrame([("0",), ("1",), ("2024",), ("2025",), ("19x",), ("1_000",)], "y string")
    assert [r[0] for r in rows(df.select(parsing.int_text_in_range("y", 0, 2024)))] == \
        [False, True, True, False, False, False]


def test_cast_columns_by_name_rule(spark):
    df = spark.createDataFrame([("1.5", "3", "x", "2020-01-01")], "val1 string, bar_num string, id string, time_stamp string")
    out = parsing.cast_columns(df, lambda c: None if c == "time_stamp" else "double" if c.startswith("val") else "int")
    assert dict(out.dtypes) == {"val1": "double", "bar_num": "int", "id": "int", "time_stamp": "string"}
    assert rows(out) == [(1.5, 3, None, "2020-01-01")]


def test_block_start(spark):
    df = spark.range(1, 23).select(F.col("id").cast("int").alias("b"))
    out = {r[0]: r[1] for r in rows(df.select("b", numeric.block_start("b", 10)))}
    assert (out[1], out[10], out[11], out[20], out[21]) == (0, 0, 10, 10, 20)


def test_pct_change_zero_previous_is_null(spark):
    df = spark.createDataFrame([(110.0, 100.0), (5.0, 0.0), (5.0, None)], "x double, p double")
    out = rows(df.select(numeric.pct_change("x", "p")))
    assert abs(out[0][0] - 10.0) < 1e-9 and out[1:] == [(None,), (None,)]


def test_equal_width_bin_max_in_last_bin_and_constant(spark):
    df = spark.createDataFrame([(0.0,), (2.0,), (9.99,), (10.0,)], "v double")
    out = rows(df.select(numeric.equal_width_bin(F.col("v"), F.lit(0.0), F.lit(10.0), 5)))
    assert out == [(0,), (1,), (4,), (4,)]
    const = rows(df.select(numeric.equal_width_bin(F.col("v"), F.lit(3.0), F.lit(3.0), 5)))
    assert const == [(2,)] * 4  # the middle one


def test_abs_pct_error_zero_label_skipped(spark):
    df = spark.createDataFrame([(2.0, 1.0), (0.0, 1.0)], "y double, p double")
    assert rows(df.select(F.avg(numeric.abs_pct_error("y", "p")))) == [(0.5,)]


def test_next_week_rolls_from_original_week(spark):
    df = spark.createDataFrame([(2020, 51), (2020, 52), (2020, 53)], "y int, w int")
    y, w = qtime.next_week("y", "w")
    assert rows(df.select(y, w)) == [(2020, 52), (2021, 1), (2021, 1)]


def test_month_label(spark):
    df = spark.createDataFrame([(dt.datetime(2008, 2, 29, 23),)], "t timestamp")
    assert rows(df.select(qtime.month_label("t"))) == [("2008-02",)]
