"""Joins, windows, keyed tables and station search on small fixtures."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from harvestline.operators import features, keyed, metrics, sets, stations, weather, yields
from harvestline.plans import bindings

JAN = [dt.date(2015, 1, 1), dt.date(2015, 1, 17), dt.date(2015, 2, 2), dt.date(2015, 3, 6)]
FEATURE_SCHEMA = (
    "county_id int, date date, avg_temp double, total_precip double, gdd double, avg_ndvi double"
)


def rows(frame, *order):
    return [tuple(r) for r in frame.orderBy(*(order or frame.columns)).collect()]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


# --- weather and features ----------------------------------------------------


def test_indices_clean_before_they_add_up(spark):
    obs = spark.createDataFrame(
        [
            (1, "2015-01-01", 12.0, 1.0),
            (1, "2015-01-16", 99.0, -5.0),
            (1, "2015-01-17", None, None),
            (1, "2016-12-31", 9.0, 2.5),
        ],
        "county_id int, date string, temp_c double, precip_mm double",
    )
    assert rows(weather.weather_indices(obs)) == [
        (1, dt.date(2015, 1, 1), 16.0, 1.0, 12.0),
        (1, dt.date(2015, 1, 17), 20.0, 0.0, 10.0),
        (1, dt.date(2016, 12, 18), 9.0, 2.5, 0.0),
    ]


def test_zonal_mean_is_a_mean_of_means(spark):
    samples = spark.createDataFrame(
        [(1, JAN[0], 0.2), (1, JAN[0], 0.4), (2, JAN[0], None)],
        "county_id int, date date, ndvi double",
    )
    assert rows(features.zonal_ndvi(samples)) == [(1, JAN[0], 0.3), (2, JAN[0], None)]


def test_join_drops_dates_off_the_grid(spark):
    weather_side = spark.createDataFrame(
        [(1, JAN[0], 1.0, 2.0, 3.0), (2, JAN[0], 1.0, 2.0, 3.0)],
        "county_id int, date date, avg_temp double, total_precip double, gdd double",
    )
    ndvi = spark.createDataFrame(
        [(1, JAN[0], 0.5), (1, dt.date(2015, 1, 5), 0.9), (3, JAN[0], 0.1)],
        "county_id int, date date, avg_ndvi double",
    )
    assert rows(features.join_features(weather_side, ndvi)) == [(1, JAN[0], 1.0, 2.0, 3.0, 0.5)]


def test_lags_step_over_gaps_and_start_at_zero(spark):
    table = spark.createDataFrame(
        [
            (1, JAN[0], 1.0, 10.0, 0.0, 0.1),
            (1, JAN[1], 2.0, 20.0, 0.0, None),
            (1, JAN[3], 3.0, 30.0, 0.0, 0.3),
            (2, JAN[0], 9.0, 90.0, None, 0.9),
        ],
        FEATURE_SCHEMA,
    )
    lagged = features.add_lags(table).select(
        "county_id", "date", "gdd", "avg_ndvi", "ndvi_lag1", "ndvi_lag2", "precip_lag1", "temp_lag1"
    )
    assert rows(lagged, "county_id", "date") == [
        (1, JAN[0], 0.0, 0.1, 0.0, 0.0, 0.0, 0.0),
        (1, JAN[1], 0.0, 0.0, 0.1, 0.0, 10.0, 1.0),
        (1, JAN[3], 0.0, 0.3, 0.0, 0.1, 20.0, 2.0),
        (2, JAN[0], 0.0, 0.9, 0.0, 0.0, 0.0, 0.0),
    ]


def test_feature_join_adds_no_shuffle_to_its_inputs(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = features.join_features(
            weather.weather_indices(bindings.obs(spark, sf_dir)),
            features.zonal_ndvi(bindings.ndvi_samples(spark, sf_dir)),
        )
        assert plan_of(joined).count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_annual_features_fan_out_by_crop(spark):
    table = spark.createDataFrame(
        [(1, JAN[0], 1.0, 10.0, 5.0, 0.1), (1, JAN[1], 2.0, 20.0, 5.0, 0.4)], FEATURE_SCHEMA
    )
    harvest = spark.createDataFrame(
        [(1, "Maize", 2015, 9.0, 10), (1, "Wheat", 2015, 3.0, 20), (1, "Maize", 2016, 1.0, 1)],
        "county_id int, crop string, year int, yield_mt_ha double, area_ha int",
    )
    joined = features.join_yields(features.annual_features(table), harvest)
    assert rows(joined, "crop") == [
        (1, 2015, 0.25, 0.4, 30.0, 1.5, 10.0, "Maize", 9.0, 10),
        (1, 2015, 0.25, 0.4, 30.0, 1.5, 10.0, "Wheat", 3.0, 20),
    ]


# --- keyed tables ------------------------------------------------------------


def test_versions_keep_the_newest(spark):
    cells = spark.createDataFrame(
        [("k", e, f"v{e}") for e in range(4)], "key string, epoch int, v string"
    )
    kept = keyed.keep_versions(cells, ["key"], ["epoch"], 3)
    assert [r[1] for r in rows(kept, "epoch")] == [1, 2, 3]
    assert plan_of(kept).count("WindowGroupLimit") == 2


def test_hot_key_leaves_few_rows_in_the_shuffle(spark):
    hot = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("key"),
        F.col("id").alias("epoch"),
    )
    kept = keyed.keep_versions(hot, ["key"], ["epoch"], 1)
    assert kept.filter("key = 0").collect() == [(0, 199_998)]
    assert kept.count() == hot.select("key").distinct().count()


def test_upsert_twice_equals_upsert_once(spark):
    schema = "key string, epoch int, v int"
    current = spark.createDataFrame([("a", 1, 1), ("b", 1, 2)], schema)
    updates = spark.createDataFrame([("b", 2, 20), ("c", 2, 30), ("a", 0, -1)], schema)
    once = keyed.kv_upsert(current, updates, ["key"], ["epoch"])
    expected = [("a", 1, 1), ("b", 2, 20), ("c", 2, 30)]
    assert rows(once) == expected
    assert rows(keyed.kv_upsert(once, updates, ["key"], ["epoch"])) == expected


def test_upsert_without_order_prefers_the_update(spark):
    schema = "type string, signature string"
    stored = spark.createDataFrame([("random_forest", "old")], schema)
    fresh = spark.createDataFrame([("random_forest", "new")], schema)
    assert rows(keyed.kv_upsert(stored, fresh, ["type"])) == [("random_forest", "new")]


def test_insert_absent_first_row_wins_on_both_sides(spark):
    stored = spark.createDataFrame([(1, "A", 5.0)], "id int, crop string, y double")
    new = spark.createDataFrame(
        [(1, "A", 9.0, 0), (1, "B", 2.0, 2), (1, "B", 1.0, 1)],
        "id int, crop string, y double, ord int",
    )
    once = keyed.insert_absent(stored, new, ["id", "crop"], ["ord"])
    assert rows(once) == [(1, "A", 5.0), (1, "B", 1.0)]
    assert rows(keyed.insert_absent(once, new, ["id", "crop"], ["ord"])) == rows(once)


def test_prefix_scan_does_not_run_into_longer_ids(spark):
    table = spark.createDataFrame(
        [(1, JAN[1], 0.2), (1, JAN[0], 0.1), (11, JAN[0], 0.9)],
        "county_id int, date date, ndvi double",
    )
    kv = keyed.to_kv(table)
    assert rows(keyed.kv_prefix_scan(kv, 1, "ndvi"), "date") == [
        ("2015-01-01", 0.1), ("2015-01-17", 0.2),
    ]
    assert rows(keyed.kv_get(kv, "11_2015-01-01")) == [("11_2015-01-01", 11, JAN[0], 0.9)]


def test_stored_keys_are_read_from_one_bucket(spark, tmp_path):
    table = spark.range(500).selectExpr(
        "cast(id as int) county_id", "date'2015-01-01' date", "cast(id as double) ndvi"
    )
    path = str(tmp_path / "kv")
    keyed.write_kv(keyed.to_kv(table), path, buckets=8)
    stored = spark.read.parquet(path)
    assert stored.count() == 500
    for county in (1, 11, 499):
        hit = keyed.kv_get(keyed.stored_entities(stored, county, buckets=8), f"{county}_2015-01-01")
        assert [r.ndvi for r in hit.collect()] == [county]
    both = keyed.kv_get(
        keyed.stored_entities(stored, 1, 499, buckets=8), "1_2015-01-01", "499_2015-01-01"
    )
    assert sorted(r.ndvi for r in both.collect()) == [1, 499]
    plan = plan_of(keyed.kv_get(keyed.stored_entities(stored, 1, buckets=8), "1_2015-01-01"))
    assert "PartitionFilters: [isnotnull(bucket" in plan
    assert "EqualTo(key,1_2015-01-01)" in plan


# --- stations ----------------------------------------------------------------


def inventory(spark, *lines):
    return spark.createDataFrame(
        list(lines),
        "USAF string, WBAN string, CTRY string, LAT double, LON double, BEGIN int, END int",
    )


def test_active_stations_and_bounds(spark):
    listed = inventory(
        spark,
        ("1", "9", "US", 1.0, 1.0, 20150101, 20191231),
        ("2", "9", "US", 1.0, 1.0, 20150102, 20191231),
        ("3", "9", "US", 1.0, 1.0, 20000101, 20191230),
        ("4", "9", "US", None, 1.0, 20000101, 20191231),
        ("5", "9", "US", 1.0, 1.0, None, 20191231),
    )
    assert [r.USAF for r in stations.active_stations(listed, 2015, 2019).collect()] == ["1"]
    # The newest END in the inventory is earlier than the end of the span.
    open_end = stations.active_stations(listed, 2015, 2020).collect()
    assert [r.USAF for r in open_end] == ["1"]


def test_top_stations_ties_go_by_id(spark):
    listed = inventory(
        spark, *[(str(i), "9", "US", 1.0, 1.0, 20000101, 20190101) for i in range(12)]
    ).withColumn("station_id", F.lpad("USAF", 2, "0"))
    top = stations.top_stations(listed, 10)
    assert [r.station_id for r in top.orderBy("rank").collect()] == [f"{i:02d}" for i in range(10)]


def test_unique_station_has_one_place(spark):
    obs = spark.createDataFrame(
        [
            ("s", "US", 2.0, 1.0),
            ("s", "US", 1.0, 9.0),
            ("s", "US", 1.0, 9.0),
            ("t", "IN", 0.0, 0.0),
        ],
        "station_id string, country string, lat double, lon double",
    )
    assert rows(stations.unique_stations(obs)) == [("s", "US", 1.0, 9.0), ("t", "IN", 0.0, 0.0)]


def test_unlisted_station_has_the_unknown_country(spark):
    obs = spark.createDataFrame([("a",), ("b",)], "station_id string")
    listed = spark.createDataFrame(
        [("a", "US"), ("a", "US"), ("a", "ZZ"), ("a", None), ("b", None)],
        "station_id string, CTRY string",
    )
    assert rows(stations.station_country(obs, listed)) == [("a", "US"), ("b", "??")]


def nearest_by_hand(regions, places):
    result = {}
    for county, country, lat, lon in regions:
        own = [p for p in places if p[1] == country] or places
        result[county] = min(
            ((lat - p[2]) * (lat - p[2]) + (lon - p[3]) * (lon - p[3]), p[0]) for p in own
        )[::-1]
    return result


REGION_SCHEMA = "county_id int, country string, lat double, lon double"
PLACE_SCHEMA = "station_id string, country string, lat double, lon double"


@pytest.mark.parametrize("spread", ["uniform", "clustered", "grid"])
def test_nearest_station_equals_all_pairs(spark, spread):
    draw = random.Random(spread)

    def place():
        if spread == "uniform":
            return draw.uniform(-90, 90), draw.uniform(-180, 180)
        if spread == "grid":  # many exact ties
            return float(draw.randint(-3, 3)), float(draw.randint(-3, 3))
        # two thirds on top of each other
        if draw.random() < 0.66:
            return 41.0 + draw.randint(0, 9) / 1000, -93.0 + draw.randint(0, 9) / 1000
        return draw.uniform(35, 45), draw.uniform(-100, -85)

    places = [(f"s{i:04d}", draw.choice("AAB"), *place()) for i in range(600)]
    places += [("edge1", "A", 90.0, 180.0), ("edge2", "B", -90.0, -180.0)]
    regions = [(i, draw.choice("ABC"), *place()) for i in range(60)]
    got = stations.nearest_station(
        spark.createDataFrame(regions, REGION_SCHEMA), spark.createDataFrame(places, PLACE_SCHEMA)
    )
    assert {r.county_id: (r.station_id, r.distance) for r in got.collect()} == nearest_by_hand(
        regions, places
    )


def test_observations_fan_out_to_each_mapped_region(spark):
    obs = spark.createDataFrame(
        [("s", "2015-01-01", 1.0, 0.0), ("t", "2015-01-01", 2.0, 0.0)],
        "station_id string, date string, temp_c double, precip_mm double",
    )
    mapping = spark.createDataFrame([(1, "s"), (2, "s")], "county_id int, station_id string")
    assert rows(stations.assign_observations(obs, mapping)) == [
        (1, "2015-01-01", 1.0, 0.0), (2, "2015-01-01", 1.0, 0.0),
    ]


# --- names and yields --------------------------------------------------------


def test_region_names_in_three_steps(spark):
    names = spark.createDataFrame(
        [
            ("US", "Arkansas", 1),
            ("US", "KANSAS", 2),
            ("US", "North Iowa", 3),
            ("US", "Old Iowa", 4),
            ("US", "Nebraska State", 5),
            ("PK", "Punjab", 0),
            ("IN", "Punjab", 9),
            ("PK", "Ohio", 0),
        ],
        "country string, name string, ord int",
    )
    regions = spark.createDataFrame(
        [
            (1, "US", "Kansas"),
            (2, "US", "iowa"),
            (3, "US", "Nebraska Plains"),
            (4, "US", "Ohio"),
            (5, "IN", "punjab"),
            (6, "PK", "punjab west"),
        ],
        "county_id int, country string, name string",
    )
    assert rows(yields.match_region(regions, names)) == [
        (1, "US", "Kansas", 1, "KANSAS", 2),
        (2, "US", "iowa", 2, "North Iowa", 3),
        (3, "US", "Nebraska Plains", 3, "Nebraska State", 5),
        (5, "IN", "punjab", 1, "Punjab", 9),
        (6, "PK", "punjab west", 3, "Punjab", 0),
    ]


def test_fao_filter(spark):
    fao = spark.createDataFrame(
        [
            ("United States of America", "Maize (corn)", "Yield", 2015, 1.0),
            ("China, mainland", "Soya beans", "Area harvested", 2015, 2.0),
            ("United States of America", "Rice", "Yield", 2015, 3.0),
            ("United States of America", "Wheat", "Stocks", 2015, 4.0),
            ("United States of America", "Wheat", "Yield", 2014, 5.0),
            ("France", "Wheat", "Yield", 2015, 6.0),
        ],
        "Area string, Item string, Element string, Year int, Value double",
    )
    assert [r.Value for r in yields.filter_fao(fao, [2015]).orderBy("Value").collect()] == [1, 2]
    national = yields.national_yields(fao.filter("Year = 2015"))
    assert rows(national.select("crop", "yield_mt_ha")) == [("Maize", 0.0001), ("Wheat", 0.0006)]


def test_spread_yields_stay_near_the_national_value(spark):
    national = spark.createDataFrame(
        [("USA", "Maize", 2015, 10.0)], "country string, crop string, year int, yield_mt_ha double"
    )
    regions = spark.range(200).selectExpr("cast(id as int) county_id", "'USA' country")
    spread = yields.spread_yields(national, regions)
    low, high, small, large = spread.agg(
        F.min("yield_mt_ha"), F.max("yield_mt_ha"), F.min("area_ha"), F.max("area_ha")
    ).first()
    assert 8.5 <= low < 9 and 11 < high <= 11.5
    assert 5000 <= small and large <= 50000
    assert rows(spread) == rows(yields.spread_yields(national, regions.repartition(3)))


# --- metrics, sets -----------------------------------------------------------


def test_signature_of_empty_and_changed_tables(spark):
    empty = spark.createDataFrame([], "avg_ndvi double")
    table = spark.createDataFrame([(0.25,), (None,)], "avg_ndvi double")
    harvest = spark.createDataFrame([(1.5,)], "yield_mt_ha double")
    assert rows(metrics.signature(empty, harvest)) == [("0_0.0000_1_1.5000",)]
    assert rows(metrics.signature(table, harvest)) == [("2_0.2500_1_1.5000",)]


def test_training_is_skipped_only_for_known_inputs_with_results(spark):
    stored = spark.createDataFrame([("random_forest", "x")], "type string, signature string")
    same = spark.createDataFrame([("x",)], "signature string")
    other = spark.createDataFrame([("y",)], "signature string")
    full, empty = spark.range(1), spark.range(0)
    assert metrics.should_skip(stored, same, [full, full])
    assert not metrics.should_skip(stored, other, [full])
    assert not metrics.should_skip(stored, same, [full, empty])


def test_regression_metrics(spark):
    frame = spark.createDataFrame(
        [(1.0, 1.5), (2.0, 2.0), (4.0, 3.0), (None, 1.0)], "y double, p double"
    )
    scores = metrics.regression_metrics(frame, "y", "p").first()
    mean = 7 / 3
    total = sum((y - mean) ** 2 for y in (1, 2, 4))
    assert scores.n == 3
    assert scores.rmse == pytest.approx((1.25 / 3) ** 0.5)
    assert scores.r2 == pytest.approx(1 - 1.25 / total)


def test_scaling_and_format_ratios(spark):
    runs = spark.createDataFrame(
        [(0.1, 100, 50.0), (1.0, 1000, 200.0), (0.5, 500, 120.0)],
        "fraction double, row_count bigint, latency_ms double",
    )
    assert metrics.scaling_factor(runs).first()[0] == 0.4
    report = metrics.scaling_report(runs)
    assert rows(report.filter("fraction < 0")) == [(-1.0, 0, 0.0, 0.4)]
    assert report.count() == 4
    formats = spark.createDataFrame(
        [("orc", 10.0), ("orc", 20.0), ("csv", 45.0)], "format string, latency_ms double"
    )
    assert tuple(metrics.format_speedup(formats).first()) == (15.0, 45.0, 3.0)


def test_split_is_disjoint_and_stable(spark):
    keys = spark.range(3000)
    train, test = sets.split(keys, ["id"])
    assert train.count() + test.count() == 3000
    assert 0.77 < train.count() / 3000 < 0.83
    again, _ = sets.split(keys.repartition(7), ["id"])
    assert rows(train) == rows(again)


def test_counter_fills_while_writing(spark):
    frame, counter = sets.counted(spark.range(42), "written")
    frame.write.format("noop").mode("overwrite").save()
    assert counter.get == {"records": 42}


def test_samples_by_key_do_not_move_and_are_nested(spark):
    keys = spark.range(4000).selectExpr("id % 2000 as id", "id as temp_c")
    small, large = (sets.sample_by_key(keys, ["id"], f) for f in (0.1, 0.5))
    again = sets.sample_by_key(keys.repartition(7), ["id"], 0.1)
    assert rows(small) == rows(again)
    assert set(rows(small)) < set(rows(large)) and 250 < small.count() < 550
    assert rows(sets.sample_by_key(keys, ["id"], 0.1, seed=7)) != rows(small)
    assert sets.sample_by_key(keys, ["id"], 1.0).count() == 4000
    counts = {r.fraction: r.row_count for r in sets.sampled_counts(keys, ["id"]).collect()}
    assert counts[0.1] == small.count() and counts[0.5] == large.count() and counts[1.0] == 4000
