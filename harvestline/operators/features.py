"""Vegetation means, the joined feature table, annual predictors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harvestline.functions.numeric import stable_round
from harvestline.operators.cleaning import fill_numeric


def zonal_ndvi(samples: DataFrame) -> DataFrame:
    """Unweighted mean of the samples of a county and date.

    Samples are means per raster tile, so a county on two tiles gets the mean of
    two means whatever their pixel counts.
    """
    return samples.groupBy("county_id", "date").agg(
        stable_round(F.avg("ndvi"), 4).alias("avg_ndvi")
    )


def join_features(indices: DataFrame, ndvi: DataFrame) -> DataFrame:
    """Composites that have both weather and vegetation.

    Both inputs are aggregated on the join keys, so the join reuses their
    partitioning and adds no shuffle.
    """
    return indices.join(ndvi, ["county_id", "date"]).select(
        "county_id", "date", "avg_temp", "total_precip", "gdd", "avg_ndvi"
    )


def add_lags(features: DataFrame) -> DataFrame:
    """Values of earlier rows of the county; what is missing becomes 0.0.

    A lag counts rows, so a gap in the composites is stepped over. ``date`` is
    unique within a county, hence a county holds at most 23 rows a year and its
    window stays small however many observations went into it.
    """
    by_county = Window.partitionBy("county_id").orderBy("date")
    lagged = features.withColumns(
        {
            "ndvi_lag1": F.lag("avg_ndvi", 1).over(by_county),
            "ndvi_lag2": F.lag("avg_ndvi", 2).over(by_county),
            "precip_lag1": F.lag("total_precip", 1).over(by_county),
            "temp_lag1": F.lag("avg_temp", 1).over(by_county),
        }
    )
    return fill_numeric(lagged, 0.0)


def annual_features(features: DataFrame) -> DataFrame:
    return features.groupBy("county_id", F.year("date").alias("year")).agg(
        stable_round(F.avg("avg_ndvi"), 4).alias("mean_ndvi"),
        stable_round(F.max("avg_ndvi"), 4).alias("max_ndvi"),
        stable_round(F.sum("total_precip"), 2).alias("annual_precip"),
        stable_round(F.avg("avg_temp"), 2).alias("mean_temp"),
        stable_round(F.sum("gdd"), 2).alias("annual_gdd"),
    )


def join_yields(annual: DataFrame, yields: DataFrame) -> DataFrame:
    """One row per county, year and crop."""
    return annual.join(yields, ["county_id", "year"])
