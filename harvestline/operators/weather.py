"""Weather aggregates: composites, daily summaries, scans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestline.functions.calendar import composite_date
from harvestline.functions.numeric import degree_days, stable_round
from harvestline.operators.cleaning import clean_batch


def weather_indices(obs: DataFrame) -> DataFrame:
    """Mean temperature, rainfall and degree days per county and composite.

    One shuffle of partial sums; a busy county adds no more than one partial row
    per composite and map task.
    """
    return (
        clean_batch(obs)
        .groupBy("county_id", composite_date(F.col("date")).alias("date"))
        .agg(
            stable_round(F.avg("temp_c"), 2).alias("avg_temp"),
            stable_round(F.sum("precip_mm"), 2).alias("total_precip"),
            stable_round(F.sum(degree_days(F.col("temp_c"))), 2).alias("gdd"),
        )
    )


def daily_summary(cleaned: DataFrame) -> DataFrame:
    """Per county and day; works on a static and on a streaming frame alike."""
    return cleaned.groupBy("county_id", "date").agg(
        stable_round(F.avg("temp_c"), 2).alias("avg_temp"),
        stable_round(F.sum("precip_mm"), 2).alias("total_precip"),
        F.count(F.lit(1)).alias("record_count"),
    )


def county_totals(indices: DataFrame) -> DataFrame:
    return indices.groupBy("county_id").agg(
        F.avg("avg_temp").alias("avg_temp"),
        F.sum("total_precip").alias("total_precip"),
        F.sum("gdd").alias("total_gdd"),
    )


def county_indices(indices: DataFrame) -> DataFrame:
    """The two-measure scan used to compare file formats."""
    return indices.groupBy("county_id").agg(
        F.sum("gdd").alias("total_gdd"), F.avg("avg_temp").alias("avg_temp")
    )


def global_mean(df: DataFrame, column: str = "avg_temp") -> DataFrame:
    return df.agg(F.avg(column).alias(f"mean_{column}"))


def raw_county(obs: DataFrame) -> DataFrame:
    """Mean temperature and rainfall per county of uncleaned observations."""
    return obs.groupBy("county_id").agg(
        F.avg("temp_c").alias("mean_temp_c"), F.sum("precip_mm").alias("sum_precip_mm")
    )
