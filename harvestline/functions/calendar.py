"""Dates: composites, file names, parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

COMPOSITE_DAYS = 16


def parse_day(text: Column) -> Column:
    """``yyyy-MM-dd`` text as a date, NULL where it is none."""
    return F.try_to_date(text, "yyyy-MM-dd")


def with_day(df: DataFrame, name: str = "date") -> DataFrame:
    """``df`` with ``name`` as a date; text is parsed, dates are left as they are."""
    if isinstance(df.schema[name].dataType, StringType):
        return df.withColumn(name, parse_day(F.col(name)))
    return df.withColumn(name, F.col(name).cast("date"))


def composite_date(day: Column, days: int = COMPOSITE_DAYS) -> Column:
    """First day of the composite a day falls in.

    Composites start over on every 1 January, so this is not an epoch-aligned
    time window: step back by the day-of-year offset within its composite.
    """
    return F.date_sub(day, (F.dayofyear(day) - 1) % days)


def date_from_filename(name: Column) -> Column:
    """Acquisition date in a raster file name, or NULL.

    ``A<year><day of year>`` comes first, then ``yyyy-mm-dd`` or ``yyyymmdd``.
    """
    by_day = r"A(\d{4})(\d{3})"
    by_date = r"(\d{4})-?(\d{2})-?(\d{2})"
    first = parse_day(F.concat(F.regexp_extract(name, by_day, 1), F.lit("-01-01")))
    offset = F.regexp_extract(name, by_day, 2).try_cast("int") - 1
    plain = F.concat_ws("-", *[F.regexp_extract(name, by_date, i) for i in (1, 2, 3)])
    return F.when(name.rlike(by_day), F.date_add(first, offset)).otherwise(parse_day(plain))
