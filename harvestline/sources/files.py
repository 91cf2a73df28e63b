"""CSV, JSON and document files."""

from __future__ import annotations

import csv
import functools
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from harvestline import schemas
from harvestline.functions.numeric import DEFAULT_TEMP_C, fahrenheit_to_c, precip_to_mm
from harvestline.operators.cleaning import require
from harvestline.operators.stations import parse_inventory

STATION_FROM_FILE = r"([^/]+)\.csv$"
LATIN_1 = "ISO-8859-1"


def read_csv(
    spark: SparkSession, path: str, schema: StructType, header: bool = True, **options: str
) -> DataFrame:
    """CSV under a fixed schema; a cell that does not fit becomes NULL.

    A file whose header has other names or another order is an error: columns are
    never taken by place against what the header says.
    """
    reader = spark.read.schema(schema).options(header=header, enforceSchema=not header, **options)
    return reader.csv(path)


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.WEATHER_OBS)


def read_ndvi(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.NDVI_SAMPLES)


def read_fao(spark: SparkSession, path: str) -> DataFrame:
    """Crop statistics bulk file; it is Latin-1, and its columns go by name."""
    header = spark.read.options(header=True, encoding=LATIN_1).csv(path)
    return header.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schemas.FAO_LONG]
    )


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Station inventory as text; blanks around column names are cut by the parser."""
    return parse_inventory(spark.read.option("header", True).csv(path))


STATION_COLUMNS = ("DATE", "LATITUDE", "LONGITUDE", "TEMP", "PRCP")


def files_by_header(
    spark: SparkSession, path: str, names: Sequence[str], skip_foreign: bool = False
) -> dict[str, list[str]]:
    """Files of a folder by their header line, which has all the names.

    Files without a line are passed over; one without such a header is an error
    unless it is to be skipped. The file names, which Spark lists on the driver
    anyway, are gathered there. The text is scanned once for this.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    has_names = F.lit(True)
    for name in names:
        has_names &= F.col("value").contains(name)
    header = F.max(F.when(has_names, F.col("value"))).alias("header")
    found: dict[str, list[str]] = {}
    foreign = []
    for file, line in lines.groupBy(F.col("_metadata.file_path")).agg(header).collect():
        if line is None:
            foreign.append(file)
        else:
            found.setdefault(line, []).append(unquote(file))
    if foreign and not skip_foreign:
        raise ValueError(f"{len(foreign)} files without the columns {names}, such as {foreign[0]}")
    return found


def read_station_files(
    spark: SparkSession,
    path: str,
    station_pattern: str = STATION_FROM_FILE,
    skip_bad_files: bool = False,
) -> DataFrame:
    """Daily station files in metric units, the station id taken from the path.

    All columns are read as text and taken by the header of their own file, so
    files may differ in layout. A row whose temperature is missing or whose
    numbers do not parse is left out. A file that cannot be read or lacks a column
    is an error; ``skip_bad_files`` passes over those it can tell.
    """
    parts = []
    by_header = files_by_header(spark, path, STATION_COLUMNS, skip_bad_files)
    for header, paths in sorted(by_header.items()):
        names = [n.strip() for n in next(csv.reader([header]))]
        text = StructType([StructField(n, StringType()) for n in names])
        rows = spark.read.schema(text).options(header=True, ignoreCorruptFiles=skip_bad_files)
        parts.append(
            rows.csv(paths).select(
                F.regexp_extract(F.col("_metadata.file_path"), station_pattern, 1).alias(
                    "station_id"
                ),
                *STATION_COLUMNS,
            )
        )
    fields = StructType([StructField(n, StringType()) for n in ("station_id", *STATION_COLUMNS)])
    text = functools.reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], fields)
    return require(
        text.select(
            "station_id",
            F.col("DATE").alias("date"),
            F.col("LATITUDE").alias("lat"),
            F.col("LONGITUDE").alias("lon"),
            fahrenheit_to_c(F.col("TEMP")).alias("temp_c"),
            precip_to_mm(F.col("PRCP")).alias("precip_mm"),
        ),
        "temp_c",
        "precip_mm",
    )


def _payload_list(payload: str) -> Column:
    """Readings of a payload, NULL if it is missing or is no JSON."""
    text = F.trim(F.col(payload))
    as_list = F.when(text.startswith("["), text).otherwise(
        F.concat(F.lit("["), text, F.lit("]"))
    )
    return F.from_json(as_list, schemas.LIVE_PAYLOAD)


def payload_rows(df: DataFrame, payload: str, *keep: str) -> DataFrame:
    """Readings and rejects of live-weather payloads in one pass, each payload parsed once.

    A row per location in payload order, and one with neither ``position`` nor ``reading`` for
    a payload that gives none: missing, empty, or no JSON. Store it to use both parts.
    """
    return df.withColumn("_list", _payload_list(payload)).select(
        *dict.fromkeys([*keep, payload]), F.posexplode_outer("_list").alias("position", "reading")
    )


def rejected_payloads(df: DataFrame, payload: str) -> DataFrame:
    """Rows whose payload gives no reading; with those that do, all rows."""
    return df.filter(F.coalesce(F.size(_payload_list(payload)), F.lit(0)) <= 0)


def parse_live_weather(df: DataFrame, payload: str, *keep: str) -> DataFrame:
    """One row per location of a live-weather payload, in payload order.

    A payload is a list of objects or a single object. A missing or null
    reading becomes 20.0 degrees or 0.0 mm. Payloads without any reading are left
    to ``rejected_payloads``.
    """
    rows = payload_rows(df, payload, *keep)
    return readings(rows.filter(F.col("position").isNotNull()), *keep)


def readings(rows: DataFrame, *keep: str) -> DataFrame:
    """Temperature and rainfall of ``payload_rows``."""
    temp = F.col("reading.current.temperature_2m")
    precip = F.col("reading.current.precipitation")
    return rows.select(
        *keep,
        "position",
        F.coalesce(F.round(temp, 2), F.lit(DEFAULT_TEMP_C)).alias("temp_c"),
        F.coalesce(F.round(precip, 2), F.lit(0.0)).alias("precip_mm"),
    )


def live_observations(
    df: DataFrame, payload: str = "payload", counties: str = "county_ids", day: str = "date"
) -> DataFrame:
    """Daily observations of the regions a payload was fetched for.

    ``counties`` lists the regions in the order of the readings.
    """
    return parse_live_weather(df, payload, counties, day).select(
        F.get(counties, F.col("position")).alias("county_id"),
        F.col(day).alias("date"),
        "temp_c",
        "precip_mm",
    )


def export_csv(df: DataFrame, path: str, header: bool = False, **options: str) -> None:
    """CSV files; an ordered frame gives files whose order continues in name order."""
    df.write.mode("overwrite").options(header=header, **options).csv(path)


def write_batches(df: DataFrame, path: str, rows: int = 500) -> None:
    """CSV files with header of at most ``rows`` rows each."""
    df.write.mode("overwrite").options(header=True, maxRecordsPerFile=rows).csv(path)


def write_documents(df: DataFrame, path: str) -> None:
    """Replace a collection of JSON documents."""
    df.write.mode("overwrite").json(path)


def upsert_documents(df: DataFrame, path: str, key: str) -> None:
    """Replace the documents of the keys in ``df``, keep those of other keys.

    Meant for a key with few values, each of which has its own folder.
    """
    (
        df.write.mode("overwrite")
        .partitionBy(key)
        .option("partitionOverwriteMode", "dynamic")
        .json(path)
    )


def read_documents(
    spark: SparkSession, path: str, collection: str | None = None, schema: StructType | None = None
) -> DataFrame:
    """Documents of a named result collection, or of any under a given schema."""
    fields = schema or schemas.DOCUMENT_SCHEMAS[collection]
    return spark.read.schema(fields).json(path).select(*fields.names)
