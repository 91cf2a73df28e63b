"""Spool folder to batched files, every file taken up once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from harvestline import schemas

RECORDS_PER_FILE = 500


def stream_spool(
    spark: SparkSession,
    path: str,
    archive: str | None = None,
    schema: StructType = schemas.WEATHER_OBS,
    max_files: int | None = None,
) -> DataFrame:
    """New CSV files of a folder; done ones move to ``archive``.

    The checkpoint of the query remembers which files were taken. A file is
    archived when a later batch ends, so the newest may still be in place. A file
    whose header has other names or another order stops the query.
    """
    reader = spark.readStream.schema(schema).options(header=True, enforceSchema=False)
    if archive:
        reader = reader.options(cleanSource="archive", sourceArchiveDir=archive)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(path)


def start_relay(
    incoming: DataFrame,
    target: str,
    checkpoint: str,
    interval_seconds: int | None = None,
    rows: int = RECORDS_PER_FILE,
) -> StreamingQuery:
    """Pass rows through to CSV files of at most ``rows`` rows.

    The file sink commits each batch in its own log: readers of ``target`` see
    every row once, also after a restart in the middle of a batch.
    """
    writer = incoming.writeStream.format("csv").outputMode("append").options(
        header=True, maxRecordsPerFile=rows, path=target, checkpointLocation=checkpoint
    )
    if interval_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{interval_seconds} seconds").start()


def ingest_counters(spark: SparkSession, target: str, checkpoint: str) -> DataFrame:
    """One row: ``files`` taken up and ``records`` passed on since the checkpoint began.

    Both are exact for any number of batches and restarts: the files are those in
    the log of the file source, the records those the sink has committed. A log
    entry may stand in a batch file and again in a merged one.
    """
    log = spark.read.text(f"{checkpoint}/sources/0")
    entries = log.select(F.get_json_object("value", "$.path").alias("path"))
    taken = entries.agg(F.count_distinct("path").alias("files"))
    rows = spark.read.option("header", True).csv(target).agg(F.count("*").alias("records"))
    return taken.select("files", rows.scalar().alias("records"))
