"""One test per semantic trap of the source scripts."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlens import functions as LF
from ledgerlens.operators import lists as L
from ledgerlens.operators.calendar import monthly_dates


def one(spark, expr, ddl="x int", row=(1,)):
    return spark.createDataFrame([row], ddl).select(expr.alias("v")).collect()[0]["v"]


def test_t1_minute_boundaries(spark):
    df = spark.createDataFrame([("2020-01-01 23:59:59", "2020-01-02 00:00:00")], "a string, b string")
    df = df.select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    assert df.select(LF.minute_boundaries("a", "b").alias("m")).collect()[0]["m"] == 1


def test_t2_division_truncates_toward_zero(spark):
    assert one(spark, LF.int_div(F.lit(-7), 2)) == -3
    assert one(spark, LF.int_div(F.lit(7), 2)) == 3


def test_t3_truncated_avg(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    assert df.agg(LF.truncated_avg("x").alias("a")).collect()[0]["a"] == 1


def test_t4_case_insensitive_order(spark):
    arr = F.array(F.lit("Beef"), F.lit("BBQ Sauce"), F.lit("Bacon"), F.lit("2xCheese"))
    assert one(spark, F.array_join(L.case_insensitive_sort(arr), ", ")) == \
        "2xCheese, Bacon, BBQ Sauce, Beef"


def test_t5_month_drift(spark):
    dates = one(spark, monthly_dates(F.lit(dt.date(2020, 1, 31)), F.lit(dt.date(2020, 5, 31))))
    assert dates == [dt.date(2020, 1, 31), dt.date(2020, 2, 29), dt.date(2020, 3, 29),
                     dt.date(2020, 4, 29), dt.date(2020, 5, 29)]


def test_t6_inclusive_horizon(spark):
    dates = one(spark, monthly_dates(F.lit(dt.date(2020, 12, 1)), F.lit(dt.date(2021, 1, 1))))
    assert dates == [dt.date(2020, 12, 1), dt.date(2021, 1, 1)]


def test_t8_short_date(spark):
    assert one(spark, LF.parse_short_date(F.lit("15/6/20"))) == dt.date(2020, 6, 15)


def test_t9_week_bucket(spark):
    assert one(spark, LF.week_of_year_bucket(F.lit(dt.date(2020, 6, 15)))) == 24
    assert one(spark, LF.week_of_year_bucket(F.lit(dt.date(2020, 1, 1)))) == 1
    assert one(spark, LF.week_of_year_bucket(F.lit(dt.date(2020, 12, 31)))) == 53


def test_t10_list_size_of_null_is_zero(spark):
    assert one(spark, L.list_size(F.lit(None).cast("string"))) == 0
    assert one(spark, L.list_size(F.lit("1,5"))) == 2


def test_t11_string_agg_of_nulls_is_null(spark):
    names = F.array(F.lit(None).cast("string"), F.lit(None).cast("string"))
    assert one(spark, L.join_names(names)) is None


def test_t12_concat_treats_null_as_empty(spark):
    assert one(spark, LF.concat_nullsafe(F.lit("a"), F.lit(None).cast("string"), F.lit("b"))) == "ab"


def test_t13_anti_join_with_null_keeps_rows(spark):
    base = F.array(F.lit("Bacon"), F.lit("Beef"))
    removed = F.array(F.lit(None).cast("string"))
    assert one(spark, L.edit_list(base, removed, F.lit(None).cast("array<string>"))) == ["Bacon", "Beef"]


def test_t14_exact_repeat_mark(spark):
    items = F.array(*[F.lit(x) for x in ["Bacon", "Bacon", "Bacon", "Beef", "Beef"]])
    assert sorted(one(spark, L.mark_repeats(items))) == ["2xBeef", "Bacon"]
    assert sorted(one(spark, L.mark_repeats(items, prefix_all=True))) == ["2xBeef", "3xBacon"]


def test_t17_null_tokens(spark):
    df = spark.createDataFrame([("null",), (" NaN ",), ("",), (None,), ("4",)], "x string")
    got = [r["v"] for r in df.select(LF.normalize_null("x").alias("v")).collect()]
    assert got == [None, None, None, None, "4"]


def test_t22_zero_denominator_gives_null(spark):
    assert one(spark, LF.ratio(F.lit(5), F.lit(0), 2, 100)) is None


def test_ratio_rounds_half_away_from_zero(spark):
    assert one(spark, LF.ratio(F.lit(1), F.lit(8), 2, 1)) == Decimal("0.13")
    assert one(spark, LF.ratio(F.lit(-1), F.lit(8), 2, 1)) == Decimal("-0.13")
    assert one(spark, LF.ratio(F.lit(2), F.lit(3), 1, 100)) == Decimal("66.7")


def test_unit_stripping(spark):
    df = spark.createDataFrame([("25mins",), ("15 minute",), ("40",), ("10 MINS",)], "x string")
    got = [r["v"] for r in df.select(LF.leading_number("x").alias("v")).collect()]
    assert got == ["25", "15", "40", "10"]
    assert one(spark, LF.numeric_before_unit(F.lit("23.4 KM"))) == "23.4"
