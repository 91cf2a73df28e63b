"""Every operator as a query over the driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestline import schemas
from harvestline.functions import calendar, geometry, keys, numeric
from harvestline.ml import yield_model
from harvestline.operators import (
    cleaning,
    features,
    keyed,
    metrics,
    raster,
    sets,
    stations,
    weather,
    yields,
)
from harvestline.plans import bindings as b
from harvestline.plans import serve
from harvestline.session import scratch_path, stored
from harvestline.sources import files, tables
from harvestline.streaming import daily, spool

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

FAO_YEARS = range(1996, 2001)
FAO_AREAS = ("NATION_3", "NATION_4")
FAO_AREA_TEXT = "NATION_1"
COUNTED_FILES = 104
POINT_KEY = "1_1998-01-01"
SERIES_COUNTY = 1


def query(build: Query) -> Query:
    REGISTRY[build.__name__] = build
    return build


def _six(name: str, value: Column | None = None) -> Column:
    """Unrounded measure at six decimals, for comparison across engines."""
    return numeric.stable_round(F.col(name) if value is None else value, 6).alias(name)


def _metres(name: str, value: Column) -> Column:
    return numeric.stable_round(value, 3).alias(name)


def indices(spark: SparkSession, d: str) -> DataFrame:
    return weather.weather_indices(b.obs(spark, d))


def zonal(spark: SparkSession, d: str) -> DataFrame:
    return features.zonal_ndvi(b.ndvi_samples(spark, d))


def feature_table(spark: SparkSession, d: str) -> DataFrame:
    return features.add_lags(features.join_features(indices(spark, d), zonal(spark, d)))


def training(spark: SparkSession, d: str) -> DataFrame:
    return features.join_yields(
        features.annual_features(feature_table(spark, d)), b.yields(spark, d)
    )


# --- cleaning and composites -------------------------------------------------


@query
def weather_clean_batch(spark, d):
    return cleaning.clean_batch(b.obs(spark, d).withColumn("date", F.col("date").cast("string")))


@query
def weather_clean_stream_rules(spark, d):
    return cleaning.clean_stream(b.stream_obs(spark, d))


@query
def composite_dates(spark, d):
    day = F.col("o_orderdate").cast("date")
    return b.table(spark, d, "orders").select(
        "o_orderkey", day.alias("date"), calendar.composite_date(day).alias("composite")
    )


@query
def weather_indices(spark, d):
    return indices(spark, d)


@query
def zonal_ndvi(spark, d):
    return zonal(spark, d)


@query
def feature_join(spark, d):
    return features.join_features(indices(spark, d), zonal(spark, d))


@query
def lag_features(spark, d):
    return feature_table(spark, d)


@query
def annual_features(spark, d):
    return features.annual_features(feature_table(spark, d))


@query
def training_join(spark, d):
    return training(spark, d)


# --- aggregates --------------------------------------------------------------


@query
def county_totals(spark, d):
    totals = weather.county_totals(indices(spark, d))
    return totals.select("county_id", _six("avg_temp"), _six("total_precip"), _six("total_gdd"))


@query
def county_indices(spark, d):
    totals = weather.county_indices(indices(spark, d))
    return totals.select("county_id", _six("total_gdd"), _six("avg_temp"))


@query
def global_mean(spark, d):
    return weather.global_mean(indices(spark, d)).select(_six("mean_avg_temp"))


@query
def raw_county(spark, d):
    totals = weather.raw_county(b.obs(spark, d))
    return totals.select("county_id", _six("mean_temp_c"), _six("sum_precip_mm"))


@query
def daily_summary(spark, d):
    return weather.daily_summary(cleaning.clean_stream(b.stream_obs(spark, d)))


@query
def signature(spark, d):
    return metrics.signature(feature_table(spark, d), b.yields(spark, d))


@query
def training_skip(spark, d):
    """Decision not to train again right after the signature was stored."""
    current = signature(spark, d)
    path = scratch_path(spark, "metadata")
    kind = F.lit("random_forest").alias("type")
    files.upsert_documents(current.select(kind, "signature"), path, "type")
    metadata = files.read_documents(spark, path, "model_metadata")
    skip = metrics.should_skip(metadata, current, [b.predictions(spark, d)])
    return current.withColumn("skip", F.lit(skip))


@query
def regression_metrics(spark, d):
    scores = metrics.regression_metrics(b.predictions(spark, d), "actual_yield", "predicted_yield")
    return scores.select("n", _six("rmse"), _six("r2"))


def _runs(spark, d):
    line = F.col("l_linenumber")
    return (
        b.table(spark, d, "lineitem")
        .groupBy((line / 7.0).alias("fraction"))
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            (F.sum("l_quantity") * F.max(line)).alias("latency_ms"),
        )
    )


@query
def scaling_factor(spark, d):
    return metrics.scaling_factor(_runs(spark, d))


@query
def scaling_report(spark, d):
    return metrics.scaling_report(_runs(spark, d))


@query
def format_speedup(spark, d):
    kind = F.when(F.col("l_linestatus") == "F", "orc").otherwise("csv")
    runs = b.table(spark, d, "lineitem").select(
        kind.alias("format"), F.col("l_quantity").alias("latency_ms")
    )
    return metrics.format_speedup(runs)


# --- scalar functions --------------------------------------------------------


@query
def numeric_coercion(spark, d):
    key, balance = F.col("c_custkey"), F.col("c_acctbal").cast("string")
    text = (
        F.when(key % 4 == 0, balance)
        .when(key % 4 == 1, F.concat(balance, F.lit("x")))
        .when(key % 4 == 2, F.concat(F.lit("  "), balance, F.lit(" ")))
        .otherwise(F.lit(""))
    )
    ragged = b.table(spark, d, "customer").select(
        key.alias(" c_custkey"),
        text.alias("BALANCE "),
        F.when(key % 5 == 0, F.lit("n/a")).otherwise(key.cast("string")).alias(" NUMBER "),
    )
    return cleaning.trim_columns(ragged).select(
        "c_custkey",
        numeric.coerce_double(F.col("BALANCE")).alias("balance"),
        numeric.coerce_int(F.col("NUMBER")).alias("number"),
    )


@query
def unit_conversions(spark, d):
    return b.station_text(spark, d).select(
        "l_orderkey",
        "l_linenumber",
        numeric.fahrenheit_to_c(F.col("TEMP")).alias("temp_c"),
        numeric.precip_to_mm(F.col("PRCP")).alias("precip_mm"),
        numeric.hg_ha_to_t_ha(F.col("Value")).alias("yield_t_ha"),
    )


@query
def crop_classification(spark, d):
    return b.table(spark, d, "part").select(
        "p_partkey", keys.classify_crop(F.col("p_name"), b.VIEW_CROPS).alias("crop")
    )


@query
def fao_filter(spark, d):
    return yields.filter_fao(
        b.fao(spark, d),
        FAO_YEARS,
        areas=FAO_AREAS,
        area_text=FAO_AREA_TEXT,
        items=tuple(b.VIEW_CROPS.values()),
    )


@query
def national_yields(spark, d):
    return yields.national_yields(b.fao(spark, d), b.VIEW_CROPS)


@query
def filename_dates(spark, d):
    return b.raster_files(spark, d).select(
        "o_orderkey", calendar.date_from_filename(F.col("file")).alias("date")
    )


@query
def tile_affine(spark, d):
    tile = geometry.tile_index(F.col("file"))
    located = b.raster_files(spark, d).select("o_orderkey", tile.alias("tile"))
    affine = geometry.tile_affine(F.col("tile.h"), F.col("tile.v"))
    return located.select("o_orderkey", "tile.h", "tile.v", affine.alias("a")).select(
        "o_orderkey",
        "h",
        "v",
        _metres("x_min", F.col("a.x_min")),
        _metres("y_max", F.col("a.y_max")),
        _metres("pixel_size", F.col("a.pixel_size")),
    )


@query
def ndvi_scaling(spark, d):
    return raster.scaled_pixels(b.raster_lines(spark, d))


@query
def json_payload(spark, d):
    return files.parse_live_weather(b.payloads(spark, d), "payload", "event_id")


@query
def live_observations(spark, d):
    events = b.table(spark, d, "events").select(
        "event_id",
        F.array(F.col("user_id").cast("int"), F.lit(-1)).alias("county_ids"),
        F.col("ts").cast("date").alias("date"),
    )
    return files.live_observations(b.payloads(spark, d).join(events, "event_id"))


# --- stations ----------------------------------------------------------------


def _active(spark, d):
    listed = stations.parse_inventory(b.inventory(spark, d))
    named = listed.withColumn("station_id", keys.station_id(F.col("USAF"), F.col("WBAN")))
    return stations.active_stations(named, 1995, 2001)


@query
def station_filter(spark, d):
    return _active(spark, d).select("station_id", "CTRY", "LAT", "LON", "BEGIN", "END")


@query
def top_stations(spark, d):
    return stations.top_stations(_active(spark, d)).select(
        "CTRY", "station_id", "duration", "rank"
    )


@query
def unique_stations(spark, d):
    return stations.unique_stations(b.station_places(spark, d))


@query
def country_lookup(spark, d):
    iso = F.array(*[F.lit(c) for c in (*keys.STATION_COUNTRY, "FRA")])
    listed = stations.parse_inventory(b.inventory(spark, d)).select(
        keys.station_id(F.col("USAF"), F.col("WBAN")).alias("station_id"), "CTRY"
    )
    code = iso[(F.col("o_orderkey") % 6).cast("int")]
    # Every station is listed again under a country that comes later.
    listed = listed.union(listed.select("station_id", F.lit("ZZ"))).union(listed)
    return stations.station_country(b.station_obs(spark, d), listed).select(
        "o_orderkey", "station_id", "country", keys.map_country(code).alias("fips")
    )


@query
def nearest_station(spark, d):
    return stations.nearest_station(b.region_centres(spark, d), b.stations(spark, d))


@query
def assign_observations(spark, d):
    mapping = stored(nearest_station(spark, d), "station-mapping")
    return stations.assign_observations(b.station_obs(spark, d), mapping)


@query
def station_files(spark, d):
    """Station folders written as text files and read back in metric units."""
    path = scratch_path(spark, "station-files")
    station = F.concat(F.lit("S"), F.lpad((F.col("l_suppkey") % 25).cast("string"), 3, "0"))
    text = b.station_text(spark, d).select(
        station.alias("station"), "DATE", "LATITUDE", "LONGITUDE", "TEMP", "PRCP"
    )
    turned = text.select("station", "PRCP", "TEMP", "LONGITUDE", "DATE", "LATITUDE")
    odd = F.substring("station", -1, 1).cast("int") % 2 == 1
    for part in (text.filter(~odd), turned.filter(odd)):
        part.write.mode("append").partitionBy("station").option("header", True).csv(path)
    return files.read_station_files(spark, path, r"station=([^/]+)/").select(
        "station_id",
        "date",
        numeric.coerce_double(F.col("lat")).alias("lat"),
        numeric.coerce_double(F.col("lon")).alias("lon"),
        "temp_c",
        "precip_mm",
    )


# --- regions and yields ------------------------------------------------------


@query
def region_match(spark, d):
    return yields.match_region(b.match_targets(spark, d), b.match_names(spark, d))


@query
def spread_yields(spark, d):
    country = F.concat(F.lit("NATION_"), F.col("county_id") % 25)
    home = b.yields(spark, d).groupBy(country.alias("country"), "crop", "year")
    national = home.agg(F.max("yield_mt_ha").alias("yield_mt_ha"))
    return yields.spread_yields(national, b.counties(spark, d))


@query
def geojson_features(spark, d):
    return serve.to_geojson(b.counties(spark, d))


@query
def wkt(spark, d):
    return b.counties(spark, d).select("county_id", geometry.to_wkt(F.col("geom")).alias("wkt"))


@query
def predictions_named(spark, d):
    return serve.predictions_with_names(b.predictions(spark, d), b.counties(spark, d))


@query
def regions_list(spark, d):
    return serve.regions(b.counties(spark, d))


@query
def polygon_bounds(spark, d):
    envelope = geometry.bounds(F.col("geom")).alias("e")
    return b.counties(spark, d).select("county_id", envelope).select("county_id", "e.*")


@query
def centroids(spark, d):
    centre = geometry.centroid(F.col("geom")).alias("c")
    return (
        b.counties(spark, d)
        .select("county_id", "name", centre)
        .select("county_id", "name", _six("lat", F.col("c.y")), _six("lon", F.col("c.x")))
    )


@query
def sinusoidal(spark, d):
    xy = geometry.to_sinusoidal(F.col("lon"), F.col("lat")).alias("p")
    return (
        b.region_centres(spark, d)
        .select("county_id", xy)
        .select("county_id", _metres("x", F.col("p.x")), _metres("y", F.col("p.y")))
    )


@query
def fallback_polygons(spark, d):
    box = geometry.bounds(geometry.fallback_polygon(F.col("name"))).alias("e")
    corners = ("min_x", "min_y", "max_x", "max_y")
    return (
        b.named_regions(spark, d)
        .select("county_id", "name", box)
        .select("county_id", "name", *[_six(c, F.col(f"e.{c}")) for c in corners])
    )


# --- raster ------------------------------------------------------------------


@query
def zonal_stats(spark, d):
    return raster.zonal_stats(b.raster_lines(spark, d), b.raster_zones(spark, d), b.VIEW_GRID)


@query
def zones_in_tile(spark, d):
    zones = b.raster_zones(spark, d).drop("geom")
    tiles = raster.zones_in_tile(zones, b.VIEW_GRID)
    present = b.raster_lines(spark, d).select("tile_h", "tile_v").distinct()
    return tiles.join(present, ["tile_h", "tile_v"], "left_semi")


# --- sets and samples --------------------------------------------------------


@query
def unseen_inputs(spark, d):
    orders = b.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return sets.unseen(
        orders, b.table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"),
        "o_orderkey",
    )


@query
def only_targets(spark, d):
    events = b.table(spark, d, "events").select("event_id", F.col("user_id").alias("key"))
    return sets.only_targets(
        events, b.table(spark, d, "supplier").select(F.col("s_suppkey").alias("key")), "key"
    )


@query
def union_observations(spark, d):
    batch = b.obs(spark, d).withColumn("date", F.col("date").cast("string"))
    return sets.union_all([batch, b.stream_obs(spark, d)])


@query
def train_test_split(spark, d):
    train, test = sets.split(b.yields(spark, d), yield_model.KEYS)
    return sets.union_all(
        [train.withColumn("part", F.lit("train")), test.withColumn("part", F.lit("test"))]
    ).select("county_id", "year", "crop", "part")


@query
def sampled_scaling(spark, d):
    counts = sets.sampled_counts(b.keyed_obs(spark, d), ["order", "line"])
    return counts.select("fraction", "row_count", _six("mean_temp_c"))


@query
def preview(spark, d):
    return sets.preview(feature_table(spark, d), ["county_id", "date"])


# --- keyed tables ------------------------------------------------------------


@query
def kv_get(spark, d):
    path = scratch_path(spark, "kv")
    keyed.write_kv(keyed.to_kv(indices(spark, d)), path)
    entity = POINT_KEY.split(keys.KEY_SEPARATOR)[0]
    return keyed.kv_get(keyed.stored_entities(spark.read.parquet(path), entity), POINT_KEY)


@query
def kv_prefix_scan(spark, d):
    path = scratch_path(spark, "kv")
    keyed.write_kv(keyed.to_kv(zonal(spark, d)), path)
    county = keyed.stored_entities(spark.read.parquet(path), SERIES_COUNTY)
    return serve.ndvi_series(county, SERIES_COUNTY)


@query
def weather_series(spark, d):
    path = scratch_path(spark, "kv")
    keyed.write_kv(keyed.to_kv(daily_summary(spark, d)), path)
    county = keyed.stored_entities(spark.read.parquet(path), SERIES_COUNTY)
    return serve.weather_series(county, SERIES_COUNTY)


@query
def kv_upsert(spark, d):
    return keyed.kv_upsert(*_accounts(spark, d), ["key"], ["epoch", "seq"])


@query
def kv_upsert_buckets(spark, d):
    """The same upsert on a stored table, bucket by bucket."""
    current, updates = (
        side.withColumn("key", F.col("key").cast("string")) for side in _accounts(spark, d)
    )
    path = scratch_path(spark, "kv-upsert")
    keyed.write_kv(current, path)
    keyed.upsert_stored(spark, path, updates, ["epoch", "seq"])
    return spark.read.parquet(path).select(*current.columns)


def _accounts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Balances of customers, and the totals of their orders as later versions."""
    current = b.table(spark, d, "customer").select(
        F.col("c_custkey").alias("key"),
        F.lit(0).cast("bigint").alias("epoch"),
        F.lit(0).cast("bigint").alias("seq"),
        F.col("c_acctbal").alias("value"),
    )
    updates = b.table(spark, d, "orders").select(
        F.col("o_custkey").alias("key"),
        F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint").alias("epoch"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_totalprice").alias("value"),
    )
    return current, updates


@query
def keep_versions(spark, d):
    day = F.col("ts").cast("date")
    versions = b.table(spark, d, "events").select(
        keys.kv_key(F.col("user_id"), day).alias("key"),
        F.hour("ts").alias("epoch"),
        "event_id",
        "value",
    )
    return keyed.keep_versions(versions, ["key"], ["epoch", "event_id"], 3)


@query
def insert_absent(spark, d):
    key = ["county_id", "crop", "year"]
    current = b.table(spark, d, "supplier").select(
        F.col("s_suppkey").cast("int").alias("county_id"),
        F.lit("A").alias("crop"),
        F.lit(1998).alias("year"),
        F.lit(0.0).alias("yield_mt_ha"),
    )
    new = b.table(spark, d, "lineitem").select(
        F.col("l_suppkey").cast("int").alias("county_id"),
        F.col("l_returnflag").alias("crop"),
        F.year("l_shipdate").alias("year"),
        (F.col("l_extendedprice") / 10000.0).alias("yield_mt_ha"),
        "l_orderkey",
        "l_linenumber",
    )
    return keyed.insert_absent(current, new, key, ["l_orderkey", "l_linenumber", "yield_mt_ha"])


# --- files -------------------------------------------------------------------


@query
def orc_roundtrip(spark, d):
    name = f"weather_indices_{uuid.uuid4().hex[:12]}"
    tables.write_indices(indices(spark, d), name, scratch_path(spark, "orc"))
    return tables.read_indices(spark, name)


@query
def csv_roundtrip(spark, d):
    path = scratch_path(spark, "csv")
    files.export_csv(b.obs(spark, d), path, header=True)
    return files.read_observations(spark, path)


@query
def headerless_csv(spark, d):
    path = scratch_path(spark, "export")
    files.export_csv(b.yields(spark, d), path)
    return files.read_csv(spark, path, schemas.CROP_YIELDS, header=False).withColumn(
        "yield_mt_ha", F.col("yield_mt_ha").cast("double")
    )


@query
def ordered_csv(spark, d):
    path = scratch_path(spark, "ordered")
    files.export_csv(b.yields(spark, d).orderBy("county_id", "year"), path, header=True)
    return files.read_csv(spark, path, schemas.CROP_YIELDS).withColumn(
        "yield_mt_ha", F.col("yield_mt_ha").cast("double")
    )


@query
def latin1_csv(spark, d):
    path = scratch_path(spark, "latin1")
    accented = b.fao(spark, d).withColumn("Area", F.concat(F.lit("Côte "), "Area"))
    files.export_csv(accented, path, header=True, encoding=files.LATIN_1)
    return files.read_fao(spark, path)


@query
def documents_roundtrip(spark, d):
    path = scratch_path(spark, "documents")
    files.write_documents(b.predictions(spark, d), path)
    return files.read_documents(spark, path, "yield_predictions").drop("prediction_date")


@query
def small_files(spark, d):
    path = scratch_path(spark, "batches")
    files.write_batches(b.stream_obs(spark, d), path)
    return files.read_observations(spark, path)


# --- streams -----------------------------------------------------------------


def _inbox(spark: SparkSession, d: str, parts: int | None = None) -> str:
    path = scratch_path(spark, "inbox")
    obs = b.stream_obs(spark, d)
    files.export_csv(obs.repartition(parts) if parts else obs, path, header=True)
    return path


def _streamed_daily(spark: SparkSession, d: str, mode: str) -> DataFrame:
    target = scratch_path(spark, "daily")
    incoming = daily.stream_observations(spark, _inbox(spark, d))
    checkpoint = scratch_path(spark, "daily-checkpoint")
    daily.run(daily.start_daily(incoming, target, checkpoint, output_mode=mode))
    latest = daily.read_latest(spark, target, complete=mode == "complete")
    return latest.drop("key", daily.RUN, daily.EPOCH)


@query
def stream_daily(spark, d):
    return _streamed_daily(spark, d, "complete")


@query
def stream_daily_update(spark, d):
    return _streamed_daily(spark, d, "update")


def _relay(spark: SparkSession, d: str, archive: str | None):
    target = scratch_path(spark, "relay")
    incoming = spool.stream_spool(spark, _inbox(spark, d), archive)
    running = spool.start_relay(incoming, target, scratch_path(spark, "relay-checkpoint"))
    daily.run(running)
    return target, running


@query
def stream_spool(spark, d):
    target, _ = _relay(spark, d, scratch_path(spark, "archive"))
    return files.read_observations(spark, target)


@query
def stream_relay(spark, d):
    """Relay into files, then the daily summary streamed from those files."""
    relayed, _ = _relay(spark, d, None)
    target = scratch_path(spark, "daily")
    incoming = daily.stream_relayed(spark, relayed)
    daily.run(daily.start_daily(incoming, target, scratch_path(spark, "daily-checkpoint")))
    return daily.read_latest(spark, target).drop("key", daily.RUN, daily.EPOCH)


@query
def stream_two_runs(spark, d):
    """Older observations under one checkpoint, then all under a new one, on one target."""
    target = scratch_path(spark, "daily")
    for share in (0.5, 1.0):
        inbox = scratch_path(spark, "inbox")
        rows = b.stream_obs(spark, d)
        part = rows.filter(F.pmod(F.hash("county_id", "date"), F.lit(100)) < share * 100)
        files.export_csv(part if share < 1 else rows, inbox, header=True)
        incoming = daily.stream_observations(spark, inbox, max_files=2)
        daily.run(daily.start_daily(incoming, target, scratch_path(spark, "daily-checkpoint")))
    return daily.read_latest(spark, target).drop("key", daily.RUN, daily.EPOCH)


@query
def ingest_counters(spark, d):
    """One file for each trigger, over more triggers than a query keeps reports of."""
    inbox = _inbox(spark, d, parts=COUNTED_FILES)
    target, checkpoint = scratch_path(spark, "relay"), scratch_path(spark, "relay-checkpoint")
    incoming = spool.stream_spool(spark, inbox, max_files=1)
    daily.run(spool.start_relay(incoming, target, checkpoint))
    return spool.ingest_counters(spark, target, checkpoint)


# --- model -------------------------------------------------------------------


def _stored_training(spark: SparkSession, d: str) -> DataFrame:
    return stored(training(spark, d), "training")


@query
def rf_train(spark, d):
    return yield_model.train(_stored_training(spark, d), use_cross_validation=False).metrics


@query
def rf_cv(spark, d):
    trained = yield_model.train(_stored_training(spark, d), parallelism=8)
    return yield_model.cv_table(trained.cross_validation)


@query
def rf_importance(spark, d):
    trained = yield_model.train(_stored_training(spark, d), use_cross_validation=False)
    return yield_model.importance_table(trained)


@query
def rf_predictions(spark, d):
    data = _stored_training(spark, d)
    return yield_model.predict_all(yield_model.train(data, use_cross_validation=False), data)
