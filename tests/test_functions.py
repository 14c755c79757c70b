from datetime import date

from pyspark.sql import functions as F

from martloom.functions import dates, text


def one(spark, expression):
    return spark.range(1).select(expression.alias("v")).head()["v"]


def d(value):
    return F.lit(value).cast("date")


def none():
    return d(None)


def test_open_end_and_sentinel(spark):
    assert one(spark, dates.open_end(none())) == date(9999, 12, 31)
    assert one(spark, dates.open_end(d("2020-01-01"))) == date(2020, 1, 1)
    assert one(spark, dates.close_sentinel(d("9999-12-31"))) is None
    assert one(spark, dates.close_sentinel(none())) is None


def test_latest_skips_missing(spark):
    assert one(spark, dates.latest([none(), d("2020-01-01"), d("2019-01-01")])) == date(2020, 1, 1)
    assert one(spark, dates.latest([none(), none()])) is None


def test_earliest_uses_the_operands_of_the_purpose(spark):
    first, other = [d("2020-05-01"), none()], [d("2021-05-01"), d("2019-01-01")]
    assert one(spark, dates.earliest_by_purpose(F.lit(True), first, other)) == date(2020, 5, 1)
    assert one(spark, dates.earliest_by_purpose(F.lit(False), first, other)) == date(2019, 1, 1)


def test_clip_keeps_a_missing_date_missing(spark):
    assert one(spark, dates.clip_to(d("2020-05-01"), d("2020-01-01"))) == date(2020, 1, 1)
    assert one(spark, dates.clip_to(d("2020-05-01"), none())) == date(2020, 5, 1)
    assert one(spark, dates.clip_to(none(), d("2020-01-01"))) is None


def test_clamp_boundary(spark):
    assert one(spark, dates.clamp_far_future(d("3998-12-31"))) == date(3998, 12, 31)
    assert one(spark, dates.clamp_far_future(d("3999-01-01"))) == date(4000, 12, 31)
    assert one(spark, dates.clamp_far_future(d("9999-12-31"))) == date(4000, 12, 31)
    assert one(spark, dates.clamp_far_future(none())) is None


def test_date_texts(spark):
    assert one(spark, dates.compact_midnight(d("2020-03-09"))) == "09032020000000"
    assert one(spark, dates.iso_day(d("2020-03-09"))) == "2020-03-09"
    assert one(spark, dates.iso_instant(d("2020-03-09").cast("timestamp"))) == "2020-03-09T00:00:00.000Z"


def test_landed_day_ignores_what_follows(spark):
    assert one(spark, dates.landed_day(F.lit("2020-03-09T10:00:00.000Z"))) == date(2020, 3, 9)
    assert one(spark, dates.landed_day(F.lit("2020-03-09"))) == date(2020, 3, 9)
    assert one(spark, dates.landed_day(F.lit("soon"))) is None
    assert one(spark, dates.landed_day(F.lit(""))) is None


def test_ids(spark):
    missing = F.lit(None).cast("string")
    assert one(spark, text.joined_id([F.lit("a"), missing, F.lit("b")])) == "ab"
    assert one(spark, text.strict_id([F.lit("a"), missing])) is None
    assert one(spark, text.id_text(F.lit(12.0))) == "12"
    assert one(spark, text.id_text(F.lit(3_000_000_000.0))) == "3000000000"


def test_marker_keeps_spaces_and_takes_any_type(spark):
    assert one(spark, text.marked(F.lit(""))) == "#N/A"
    assert one(spark, text.marked(F.lit(" "))) == " "
    assert one(spark, text.marked(none())) == "#N/A"
    assert one(spark, text.marked(F.lit("1.50").cast("decimal(5,2)"))) == "1.50"


def test_markers_and_blanks_touch_named_columns_only(spark, rows):
    df = spark.createDataFrame([("", ""), (None, "x")], "a string, B string")
    assert rows(text.null_markers(df, ["b"])) == [(None, "x"), ("", "#N/A")]
    assert rows(text.blanks_to_null(df, ["A"])) == [(None, ""), (None, "x")]


def test_fixed_width_id_pads_and_cuts(spark):
    assert one(spark, text.fixed_width_id(F.lit("42"))) == "00000042"
    assert one(spark, text.fixed_width_id(F.lit("123456789"))) == "12345678"


def test_text_tests(spark):
    assert one(spark, text.unquoted(F.lit("'OWN'"))) == "OWN"
    assert one(spark, text.same_text(F.lit("mErc"), "MERC")) is True
    assert one(spark, text.same_text(F.lit(None).cast("string"), "MERC")) is None
    assert len(one(spark, text.short_name(F.lit("x" * 200)))) == 80
