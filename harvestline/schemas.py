"""Explicit schemas of every table the jobs read.

Nothing is inferred: a column of whole numbers would come out as int, and one
junk cell would turn a numeric column into text.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


POINT = _struct(x=DoubleType(), y=DoubleType())
RING = ArrayType(POINT)
POLYGON = ArrayType(RING)
MULTIPOLYGON = ArrayType(POLYGON)

WEATHER_OBS = _struct(
    county_id=IntegerType(), date=StringType(), temp_c=DoubleType(), precip_mm=DoubleType()
)
NDVI_SAMPLES = _struct(
    county_id=IntegerType(),
    date=DateType(),
    pixel_x=IntegerType(),
    pixel_y=IntegerType(),
    ndvi=DoubleType(),
)
CROP_YIELDS = _struct(
    county_id=IntegerType(),
    crop=StringType(),
    year=IntegerType(),
    yield_mt_ha=DecimalType(10, 4),
    area_ha=IntegerType(),
)
COUNTIES = _struct(
    county_id=IntegerType(), name=StringType(), country=StringType(), geom=MULTIPOLYGON
)
YIELD_PREDICTIONS = _struct(
    county_id=IntegerType(),
    crop=StringType(),
    year=IntegerType(),
    actual_yield=DoubleType(),
    predicted_yield=DoubleType(),
    prediction_date=TimestampType(),
)
WEATHER_INDICES = _struct(
    county_id=IntegerType(),
    date=DateType(),
    avg_temp=DoubleType(),
    total_precip=DoubleType(),
    gdd=DoubleType(),
)
DAILY_SUMMARY = _struct(
    county_id=IntegerType(),
    date=StringType(),
    avg_temp=DoubleType(),
    total_precip=DoubleType(),
    record_count=LongType(),
)
FAO_LONG = _struct(
    Area=StringType(),
    Item=StringType(),
    Element=StringType(),
    Year=IntegerType(),
    Value=DoubleType(),
)
RASTER_LINES = _struct(
    file=StringType(),
    tile_h=IntegerType(),
    tile_v=IntegerType(),
    date=DateType(),
    line=IntegerType(),
    raw=ArrayType(ShortType()),
)
LIVE_PAYLOAD = ArrayType(
    _struct(current=_struct(temperature_2m=DoubleType(), precipitation=DoubleType()))
)

# Result documents the dashboard reads.
CV_RESULTS = _struct(
    numTrees=IntegerType(), maxDepth=IntegerType(), avg_rmse=DoubleType(), is_best=BooleanType()
)
FEATURE_IMPORTANCE = _struct(feature=StringType(), importance=DoubleType())
BENCHMARKS = _struct(system=StringType(), query_type=StringType(), latency_ms=DoubleType())
SCALING_RESULTS = _struct(
    fraction=DoubleType(),
    row_count=LongType(),
    latency_ms=DoubleType(),
    scaling_factor=DoubleType(),
)
FORMAT_COMPARISON = _struct(
    orc_latency_ms=DoubleType(), csv_latency_ms=DoubleType(), orc_speedup=DoubleType()
)
MODEL_METADATA = _struct(type=StringType(), signature=StringType())

DOCUMENT_SCHEMAS = {
    "benchmarks": BENCHMARKS,
    "cv_results": CV_RESULTS,
    "feature_importance": FEATURE_IMPORTANCE,
    "format_comparison": FORMAT_COMPARISON,
    "model_metadata": MODEL_METADATA,
    "scaling_results": SCALING_RESULTS,
    "yield_predictions": YIELD_PREDICTIONS,
}
