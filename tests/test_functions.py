"""Column expressions on edge values."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from harvestline.functions import calendar, keys, numeric
from harvestline.operators import cleaning

NAN = float("nan")


def column(spark, kind, values, expression):
    rows = [(i, v) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in frame.orderBy("i").select(expression(F.col("v"))).collect()]


def test_batch_imputes_what_the_stream_nulls(spark):
    temps = [-40.0, 55.0, -40.01, 55.01, None, NAN]
    assert column(spark, "double", temps, numeric.impute_temp) == [-40, 55, 20, 20, 20, 20]
    nulled = column(spark, "double", temps, numeric.null_out_of_range)
    assert nulled == [-40, 55, None, None, None, None]


def test_precipitation_is_clamped_but_nan_passes(spark):
    zero, negative, missing, nan = column(
        spark, "double", [0.0, -0.1, None, NAN], numeric.clamp_non_negative
    )
    assert (zero, negative, missing) == (0.0, 0.0, 0.0)
    assert math.isnan(nan)


@pytest.mark.parametrize(
    ("day", "composite"),
    [
        ("2015-01-01", "2015-01-01"),
        ("2015-01-16", "2015-01-01"),
        ("2015-01-17", "2015-01-17"),
        ("2015-12-18", "2015-12-03"),
        ("2015-12-19", "2015-12-19"),
        ("2015-12-31", "2015-12-19"),
        ("2016-02-29", "2016-02-18"),
        ("2016-12-31", "2016-12-18"),
        ("not a day", None),
    ],
)
def test_composites_start_over_each_year(spark, day, composite):
    got = column(
        spark, "string", [day], lambda v: calendar.composite_date(calendar.parse_day(v))
    )
    assert got == [composite and dt.date.fromisoformat(composite)]


def test_every_day_of_two_years_lies_in_its_composite(spark):
    days = spark.range(731).select(
        F.date_add(F.lit("2015-01-01").cast("date"), F.col("id").cast("int")).alias("d")
    )
    placed = days.select("d", calendar.composite_date(F.col("d")).alias("c"))
    outside = placed.filter((F.col("c") > F.col("d")) | (F.datediff("d", "c") > 15))
    assert outside.isEmpty()
    per_year = placed.groupBy(F.year("c")).agg(F.countDistinct("c").alias("n"))
    assert {r.n for r in per_year.collect()} == {23}


def test_degree_days_begin_above_ten(spark):
    got = column(spark, "double", [9.99, 10.0, 10.01, None], numeric.degree_days)
    assert got == pytest.approx([0, 0, 0.01, 0])


def test_fahrenheit_text(spark):
    got = column(
        spark, "string", ["9999.9", "32", "abc", None, " 50.5 ", "-40"], numeric.fahrenheit_to_c
    )
    assert got == [None, 0.0, None, None, 10.28, -40.0]
    assert math.isnan(column(spark, "string", ["NaN"], numeric.fahrenheit_to_c)[0])


def test_precipitation_text(spark):
    texts = ["0.00G", "99.99", "", "-0.1", "89.99", "90", None, "1.2.3", "1.5A"]
    assert column(spark, "string", texts, numeric.precip_to_mm) == [
        0.0, 0.0, 0.0, 2.54, 2285.75, 0.0, 0.0, None, 38.1,
    ]


def test_lossy_numbers(spark):
    texts = [" 1.5 ", "x", "", None, "1e3"]
    assert column(spark, "string", texts, numeric.coerce_double) == [1.5, None, None, None, 1000]
    assert column(spark, "string", ["7", "7.x"], numeric.coerce_int) == [7, None]


def test_rounding_ignores_summation_noise(spark):
    noisy = [1.0012499999999998, 1.00125, 1.0012500000000002, -0.00125, None]
    assert column(spark, "double", noisy, lambda v: numeric.stable_round(v, 4)) == [
        1.0013, 1.0013, 1.0013, -0.0013, None,
    ]
    nan, huge = column(spark, "double", [NAN, 1e300], lambda v: numeric.stable_round(v, 2))
    assert math.isnan(nan)
    assert huge == 1e300


def test_nodata_and_scale(spark):
    assert column(spark, "int", [-3000, -2000, 10000, None], numeric.scale_ndvi) == [
        None, -0.2, 1.0, None,
    ]


def test_hash_fractions_are_spread_over_the_unit_interval(spark):
    drawn = spark.range(2000).select(numeric.md5_fraction(F.col("id")).alias("f"))
    low, high, mean = drawn.agg(F.min("f"), F.max("f"), F.avg("f")).first()
    assert 0 <= low < 0.01 and 0.99 < high < 1 and abs(mean - 0.5) < 0.03


def test_dates_in_file_names(spark):
    names = [
        "MOD13Q1.A2024337.h10v05.061.tif",
        "x_2019-03-05.tif",
        "x_20190305.tif",
        "x.tif",
        "x_2019-13-45.tif",
        "MOD13Q1.A2023366.tif",
    ]
    assert column(spark, "string", names, calendar.date_from_filename) == [
        dt.date(2024, 12, 2),
        dt.date(2019, 3, 5),
        dt.date(2019, 3, 5),
        None,
        None,
        dt.date(2024, 1, 1),
    ]


def test_crops_by_item_name(spark):
    items = ["Maize (corn)", "Green corn (maize)", "Soya beans", "WHEAT", "Rice", "maize wheat"]
    assert column(spark, "string", items, keys.classify_crop) == [
        "Maize", "Maize", "Soybean", "Wheat", None, "Maize",
    ]


def test_keys_split_at_the_first_separator(spark):
    texts = ["1_2015-01-01", "11_a_b", "plain"]
    assert column(spark, "string", texts, keys.key_entity) == ["1", "11", "plain"]
    assert column(spark, "string", texts, keys.key_date) == ["2015-01-01", "a_b", None]


def test_country_codes(spark):
    assert column(spark, "string", ["USA", "KEN", "FRA", None], keys.map_country) == [
        "US", "KE", None, None,
    ]


def test_fill_touches_numbers_only(spark):
    rows = [(None, None, NAN, None), (1, dt.date(2015, 1, 1), 2.0, "a")]
    frame = spark.createDataFrame(rows, "i int, d date, x double, s string")
    assert [tuple(r) for r in cleaning.fill_numeric(frame).collect()] == [
        (0, None, 0.0, None),
        (1, dt.date(2015, 1, 1), 2.0, "a"),
    ]


def test_require_drops_null_and_nan(spark):
    frame = spark.createDataFrame(
        [(1.0, "a"), (NAN, "b"), (None, "c"), (2.0, None)], "x double, s string"
    )
    assert [r.s for r in cleaning.require(frame, "x", "s").collect()] == ["a"]


def test_column_names_are_trimmed(spark):
    frame = spark.createDataFrame([(1, 2)], "` LAT ` int, `LON` int")
    assert cleaning.trim_columns(frame).columns == ["LAT", "LON"]
