"""The jobs end to end: ingest, batch features, training, monitoring.

Each stage is written once and read back, so later stages neither repeat it nor
depend on executors that held it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestline.functions.calendar import date_from_filename
from harvestline.functions.geometry import (
    MODIS_GRID,
    RasterGrid,
    centroid,
    fallback_polygon,
    project_geometry,
    tile_index,
)
from harvestline.functions.keys import STATION_COUNTRY, map_country, station_id
from harvestline.functions.numeric import coerce_double
from harvestline.ml import yield_model
from harvestline.operators import features, keyed, metrics, raster, sets, stations, weather, yields
from harvestline.operators.cleaning import require
from harvestline.session import stored
from harvestline.sources import files, tables
from harvestline.streaming import daily, spool

# The regions of interest by country.
TARGET_REGIONS = {
    "USA": {1: "Iowa", 2: "Illinois", 3: "Indiana", 4: "Nebraska", 5: "Kansas"},
}
FAO_COUNTRY = {"United States of America": "USA", "United States": "USA"}

MODEL_KIND = "random_forest"


# --- ingest ------------------------------------------------------------------


def target_regions(spark: SparkSession, targets: dict = TARGET_REGIONS) -> DataFrame:
    rows = [(i, name, iso) for iso, named in targets.items() for i, name in named.items()]
    return spark.createDataFrame(rows, "county_id int, name string, country string")


def build_counties(targets: DataFrame, boundaries: DataFrame) -> DataFrame:
    """Regions with their outline, a one-degree box where no boundary matches.

    ``boundaries``: country, name, ord (order of the rows), geom. A region takes
    an outline of its own country only.
    """
    matched = yields.match_region(targets, boundaries.select("country", "name", "ord"))
    outlines = matched.join(
        boundaries.select("country", "ord", F.col("name").alias("matched"), "geom"),
        ["country", "ord", "matched"],
    ).select("county_id", "geom")
    return targets.join(outlines, "county_id", "left").select(
        "county_id",
        "name",
        "country",
        F.coalesce("geom", fallback_polygon(F.col("name"))).alias("geom"),
    )


def select_stations(
    inventory: DataFrame, countries: Sequence[str], years: Sequence[int], n: int = 10
) -> DataFrame:
    """The stations to use: per country those with the longest record."""
    wanted = inventory.filter(F.col("CTRY").isin(*countries))
    active = stations.active_stations(wanted, min(years), max(years))
    named = active.withColumn("station_id", station_id(F.col("USAF"), F.col("WBAN")))
    return stations.top_stations(named, n)


def consolidate_stations(spark: SparkSession, path: str, selected: DataFrame) -> DataFrame:
    """Station files in metric units with the country of the station."""
    return stations.station_country(files.read_station_files(spark, path), selected)


def prepare_weather(consolidated: DataFrame, counties: DataFrame) -> DataFrame:
    """Daily observations of every region, taken from its nearest station.

    The station text is parsed once; both the search and the fan-out read the
    stored rows.
    """
    placed = require(
        consolidated.withColumns(
            {"lat": coerce_double(F.col("lat")), "lon": coerce_double(F.col("lon"))}
        ),
        "lat",
        "lon",
        "temp_c",
        "date",
    )
    placed = stored(placed, "station-observations")
    centres = counties.withColumn("c", centroid(F.col("geom"))).select(
        "county_id",
        F.coalesce(map_country(F.col("country"), STATION_COUNTRY), F.lit("")).alias("country"),
        F.col("c.y").alias("lat"),
        F.col("c.x").alias("lon"),
    )
    nearest = stations.nearest_station(centres, stations.unique_stations(placed))
    mapping = stored(nearest, "station-mapping")
    return stations.assign_observations(placed, mapping)


def prepare_yields(
    fao: DataFrame,
    counties: DataFrame,
    current: DataFrame,
    areas: dict[str, str] = FAO_COUNTRY,
    years: Sequence[int] | None = None,
) -> DataFrame:
    """Yield table with the regional yields that were not stored yet.

    Several items may name one crop; the first by item name counts. With
    ``years`` the bulk file is first cut to the wanted years, crops and measures.
    """
    if years is not None:
        fao = yields.filter_fao(fao, years, areas=tuple(areas))
    national = yields.national_yields(fao.filter(F.col("Area").isin(*areas))).withColumn(
        "country", map_country(F.col("area"), areas)
    )
    first = keyed.first_per_key(
        national, ["country", "crop", "year"], ["area", "item", "yield_mt_ha"]
    )
    fresh = yields.spread_yields(first, counties).withColumn(
        "yield_mt_ha", F.col("yield_mt_ha").cast(current.schema["yield_mt_ha"].dataType)
    )
    return keyed.insert_absent(current, fresh, ["county_id", "crop", "year"], ["yield_mt_ha"])


def raster_lines(lines: DataFrame) -> DataFrame:
    """Raster lines with date and tile from the file name; files without them are left out.

    ``lines``: file, line, raw.
    """
    tile = tile_index(F.col("file"))
    named = lines.withColumns(
        {
            "date": date_from_filename(F.col("file")),
            "tile_h": tile["h"],
            "tile_v": tile["v"],
        }
    )
    return require(named, "date", "tile_h", "tile_v")


def ingest_rasters(
    spark: SparkSession,
    lines: DataFrame,
    counties: DataFrame,
    samples: str,
    seen: str,
    grid: RasterGrid = MODIS_GRID,
) -> DataFrame:
    """Append the samples of raster files not seen before; returns all samples.

    ``samples`` and ``seen`` are tables that grow. The file list goes last, so a
    run that fails before repeats its files; files without any sample count as seen.
    """
    known = tables.read_or_empty(spark, seen, "file string")
    dated = raster_lines(lines)
    files_ = stored(dated.select("file").distinct(), "raster-files")
    new = stored(sets.unseen(files_, known, "file"), "new-rasters")
    found = prepare_ndvi(dated, counties, known, grid, new)
    found.write.mode("append").parquet(samples)
    new.write.mode("append").parquet(seen)
    return spark.read.parquet(samples)


def prepare_ndvi(
    lines: DataFrame,
    counties: DataFrame,
    seen: DataFrame,
    grid: RasterGrid = MODIS_GRID,
    new: DataFrame | None = None,
) -> DataFrame:
    """Vegetation samples per region, tile and date from raster files not seen before.

    New files are found from the file names alone, before any line is read, unless
    they are given as ``new``.
    """
    zones = counties.select("county_id", project_geometry(F.col("geom")).alias("geom"))
    if new is None:
        new = sets.unseen(lines.select("file").distinct(), seen, "file")
    return raster.zonal_stats(lines.join(new, "file", "left_semi"), zones, grid).select(
        "county_id", "date", F.lit(0).alias("pixel_x"), F.lit(0).alias("pixel_y"), "ndvi"
    )


# --- monitoring --------------------------------------------------------------


def run_monitoring(
    spark: SparkSession,
    inbox: str,
    relayed: str,
    target: str,
    checkpoints: str,
    archive: str | None = None,
    interval_seconds: int | None = None,
    duration_seconds: float | None = None,
) -> DataFrame:
    """Spooled files relayed, summed up by day and stored as versions; returns the newest.

    Without an interval both streams drain what is there and end. With one they
    run until ``duration_seconds`` are over; the summary takes up relayed files as
    they are committed. An error of either stream is raised.
    """
    relay = spool.start_relay(
        spool.stream_spool(spark, inbox, archive),
        relayed,
        f"{checkpoints}/relay",
        interval_seconds,
    )
    if interval_seconds is None:
        daily.run(relay)
    summary = daily.start_daily(
        daily.stream_relayed(spark, relayed), target, f"{checkpoints}/daily", interval_seconds
    )
    try:
        daily.run(summary, duration_seconds)
    finally:
        relay.stop()
    return daily.read_latest(spark, target)


# --- batch features ----------------------------------------------------------


def run_batch(
    spark: SparkSession,
    obs: DataFrame,
    samples: DataFrame,
    out: str,
    relational: tables.JdbcTable | None = None,
) -> DataFrame:
    """Zonal means, weather composites and the feature table, each stored under ``out``.

    ``relational`` names a database table that gets the features as well.
    """
    features.zonal_ndvi(samples).write.mode("overwrite").parquet(f"{out}/zonal_ndvi")
    ndvi = spark.read.parquet(f"{out}/zonal_ndvi")
    keyed.write_kv(keyed.to_kv(ndvi), f"{out}/ndvi_time_series")

    tables.write_indices(weather.weather_indices(obs), "weather_indices", f"{out}/weather_indices")
    indices = tables.read_indices(spark, "weather_indices")

    table = features.add_lags(features.join_features(indices, ndvi))
    table.write.mode("overwrite").parquet(f"{out}/yield_features")
    stored_features = spark.read.parquet(f"{out}/yield_features")
    if relational:
        tables.write_table(stored_features, relational)
    return stored_features


def export_table(spark: SparkSession, source: tables.JdbcTable, path: str) -> None:
    """A relational table as CSV files without header."""
    files.export_csv(tables.read_table(spark, source), path)


# --- training ----------------------------------------------------------------


def _documents(spark: SparkSession, out: str, collection: str) -> DataFrame | None:
    try:
        return files.read_documents(spark, f"{out}/{collection}", collection)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def run_training(
    spark: SparkSession,
    feature_table: DataFrame,
    yield_table: DataFrame,
    out: str,
    use_cross_validation: bool = True,
    relational: tables.JdbcTable | None = None,
) -> bool:
    """Train, score and store the results; False if the inputs have not changed.

    ``relational`` names a database table that gets the predictions as well and
    keeps its constraints.
    """
    current = metrics.signature(feature_table, yield_table)
    names = ("model_metadata", "yield_predictions", "cv_results", "feature_importance")
    metadata, *results = [_documents(spark, out, n) for n in names]
    if metadata is not None and all(r is not None for r in results):
        if metrics.should_skip(metadata, current, results, MODEL_KIND):
            return False

    joined = features.join_yields(features.annual_features(feature_table), yield_table)
    joined.write.mode("overwrite").parquet(f"{out}/training")
    data = spark.read.parquet(f"{out}/training")
    trained = yield_model.train(data, use_cross_validation)

    if trained.cross_validation is not None:
        files.write_documents(
            yield_model.cv_table(trained.cross_validation), f"{out}/cv_results"
        )
    files.write_documents(yield_model.importance_table(trained), f"{out}/feature_importance")
    files.write_documents(yield_model.predict_all(trained, data), f"{out}/yield_predictions")
    if relational:
        scores = files.read_documents(spark, f"{out}/yield_predictions", "yield_predictions")
        tables.write_table(scores.drop("prediction_date"), relational, truncate=True)
    # The signature goes last: a run that fails before this trains again.
    files.upsert_documents(
        current.select(F.lit(MODEL_KIND).alias("type"), "signature"),
        f"{out}/model_metadata",
        "type",
    )
    return True
