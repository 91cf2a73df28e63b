"""Cleaning rules, unit conversions and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data sources.
TEMP_LOW_C = -40.0
TEMP_HIGH_C = 55.0
DEFAULT_TEMP_C = 20.0
BASE_TEMP_C = 10.0
MISSING_TEMP_F = 9000.0
MISSING_PRECIP_IN = 90.0
MM_PER_INCH = 25.4
HG_PER_HA_IN_T_PER_HA = 10000.0
NDVI_NODATA = -3000
NDVI_SCALE = 10000.0


def stable_round(value: Column, scale: int, digits: int = 38) -> Column:
    """Half-up rounding that does not depend on the order of a floating sum.

    A mean such as 1.00125 may come out as 1.0012499999999998 when partial sums
    meet in another order (retried task, other partition count), and plain
    ``round`` then flips. Six guard digits of decimal remove that noise. Values
    a decimal cannot hold (NaN, very large) fall back to plain ``round``; for sums
    keep the 38 digits, values of one row with a known bound do with 18.
    """
    guarded = F.round(value.try_cast(f"decimal({digits},{scale + 6})"), scale).cast("double")
    return F.coalesce(guarded, F.round(value, scale))


def impute_temp(
    temp: Column,
    low: float = TEMP_LOW_C,
    high: float = TEMP_HIGH_C,
    default: float = DEFAULT_TEMP_C,
) -> Column:
    """Batch rule: out of range, NULL and NaN all become ``default``."""
    return F.when(temp.between(low, high), temp).otherwise(F.lit(default))


def null_out_of_range(
    temp: Column, low: float = TEMP_LOW_C, high: float = TEMP_HIGH_C
) -> Column:
    """Stream rule: out of range becomes NULL, so it leaves averages alone."""
    return F.when(temp.between(low, high), temp)


def clamp_non_negative(amount: Column) -> Column:
    """Negative and NULL become 0.0; NaN sorts above all numbers and stays."""
    return F.when(amount >= 0, amount).otherwise(F.lit(0.0))


def coerce_double(text: Column) -> Column:
    """Number or NULL, never an error."""
    return F.trim(text).try_cast("double")


def coerce_int(text: Column) -> Column:
    return F.trim(text).try_cast("int")


def degree_days(temp: Column, base: float = BASE_TEMP_C) -> Column:
    """Growing-degree term of one day."""
    return F.greatest(temp - F.lit(base), F.lit(0.0))


def fahrenheit_to_c(text: Column) -> Column:
    """Celsius of a Fahrenheit text; NULL where missing (> 9000) or not a number."""
    degrees = coerce_double(text)
    return F.when(
        ~(degrees > MISSING_TEMP_F) | F.isnan(degrees), stable_round((degrees - 32) * 5 / 9, 2, 18)
    )


def precip_to_mm(text: Column) -> Column:
    """Millimetres of an inch text with flag letters.

    Everything but digits and dots goes (a minus too), nothing left means 0.0,
    and 90 inches or more is the missing code and means 0.0 as well. NULL stays
    only where the remainder is no number, such as ``1.2.3``.
    """
    kept = F.regexp_replace(F.coalesce(text, F.lit("99.99")), "[^0-9.]", "")
    inches = F.when(kept == "", F.lit(0.0)).otherwise(kept.try_cast("double"))
    return F.when(inches < MISSING_PRECIP_IN, stable_round(inches * MM_PER_INCH, 2, 18)).when(
        inches.isNotNull(), F.lit(0.0)
    )


def hg_ha_to_t_ha(value: Column) -> Column:
    return stable_round(value / HG_PER_HA_IN_T_PER_HA, 4)


def scale_ndvi(raw: Column, nodata: int = NDVI_NODATA, scale: float = NDVI_SCALE) -> Column:
    """Index value of a raw pixel, NULL for nodata; the range is not clamped."""
    return F.when(raw != nodata, raw / scale)


def md5_fraction(*parts: Column) -> Column:
    """Repeatable pseudo-random number in [0, 1) from the values of a key."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
