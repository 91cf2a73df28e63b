"""Row filters and whole-row fills."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from harvestline.functions import calendar, numeric


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which every named column has a value (NaN is none)."""
    return df.dropna(subset=list(columns))


def fill_numeric(df: DataFrame, value: float = 0.0) -> DataFrame:
    """NULL and NaN of every numeric column become ``value``."""
    numeric_columns = [f.name for f in df.schema if isinstance(f.dataType, NumericType)]
    return df.na.fill(value, subset=numeric_columns)


def clean_batch(obs: DataFrame) -> DataFrame:
    """Daily observations under the batch rules: odd temperatures are imputed."""
    return calendar.with_day(obs).withColumns(
        {
            "temp_c": numeric.impute_temp(F.col("temp_c")),
            "precip_mm": numeric.clamp_non_negative(F.col("precip_mm")),
        }
    )


def clean_stream(obs: DataFrame) -> DataFrame:
    """Daily observations under the stream rules: odd temperatures become NULL."""
    keyed = obs.filter(F.col("county_id").isNotNull() & F.col("date").isNotNull())
    return keyed.withColumns(
        {
            "temp_c": numeric.null_out_of_range(F.col("temp_c")),
            "precip_mm": numeric.clamp_non_negative(F.col("precip_mm")),
        }
    )


def trim_columns(df: DataFrame) -> DataFrame:
    """Column names without surrounding blanks."""
    return df.toDF(*[name.strip() for name in df.columns])
