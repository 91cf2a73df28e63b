"""Read queries of the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestline.functions.geometry import geojson_geometry
from harvestline.operators.keyed import kv_prefix_scan


def to_geojson(counties: DataFrame) -> DataFrame:
    """One GeoJSON feature text per region.

    The collection is the set of lines; it is not folded into one value, which
    would put every polygon into one row.
    """
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct("county_id", "name", "country").alias("properties"),
        geojson_geometry(F.col("geom")).alias("geometry"),
    )
    return counties.select("county_id", F.to_json(feature).alias("feature"))


def regions(counties: DataFrame) -> DataFrame:
    return counties.select("county_id", "name", "country").orderBy("county_id")


def predictions_with_names(predictions: DataFrame, counties: DataFrame) -> DataFrame:
    names = counties.select("county_id", F.col("name").alias("county_name"), "country")
    return predictions.join(names, "county_id").orderBy("year", "county_id")


def ndvi_series(kv: DataFrame, county_id: int) -> DataFrame:
    return kv_prefix_scan(kv, county_id, "avg_ndvi").withColumnRenamed("avg_ndvi", "ndvi")


def weather_series(kv: DataFrame, county_id: int) -> DataFrame:
    return kv_prefix_scan(kv, county_id, "avg_temp", "total_precip", "record_count")
