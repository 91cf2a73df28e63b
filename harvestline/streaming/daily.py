"""Running daily summary of weather files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from harvestline import schemas
from harvestline.operators.cleaning import clean_stream
from harvestline.operators.keyed import keep_versions, to_kv
from harvestline.operators.weather import daily_summary

MAX_FILES_PER_TRIGGER = 10
MAX_BYTES_PER_TRIGGER = 256 << 20  # where files are small, as relayed ones
VERSIONS = 3
RUN = "run"
EPOCH = "epoch"
RUNS = "_runs"  # a name that readers of the table pass over
STORED = StructType(
    [
        StructField("key", StringType()),
        *schemas.DAILY_SUMMARY.fields,
        StructField(RUN, LongType()),
        StructField(EPOCH, LongType()),
    ]
)


def stream_observations(
    spark: SparkSession,
    path: str,
    max_files: int = MAX_FILES_PER_TRIGGER,
    max_bytes: int | None = None,
) -> DataFrame:
    """CSV files as they arrive; a file whose header has other names or another order is an error.

    A batch has at most ``max_files``, or ``max_bytes`` in place of that: every batch commits
    the whole state store, so with small files the bytes have to bound it.
    """
    most = {"maxBytesPerTrigger": max_bytes} if max_bytes else {"maxFilesPerTrigger": max_files}
    return (
        spark.readStream.schema(schemas.WEATHER_OBS)
        .options(header=True, enforceSchema=False, **most)
        .csv(path)
    )


def stream_relayed(spark: SparkSession, path: str) -> DataFrame:
    """The files of a relay, which cuts them small."""
    return stream_observations(spark, path, max_bytes=MAX_BYTES_PER_TRIGGER)


def stream_daily(obs: DataFrame) -> DataFrame:
    """Cleaned summary per county and day; rows sent again are added, not replaced.

    There is no watermark, so the state holds every (county, day) seen.
    """
    return daily_summary(clean_stream(obs))


def run_of(spark: SparkSession, path: str, checkpoint: str) -> int:
    """Number of a checkpoint's run on a target: the same after a restart, rising for new ones.

    Epochs begin at 0 with every checkpoint, so they order versions within a run only.
    """
    known = f"{path}/{RUNS}"
    try:
        runs = spark.read.schema("checkpoint string, run long").json(known)
        found = runs.groupBy().agg(
            F.max(F.when(F.col("checkpoint") == checkpoint, F.col("run"))), F.max("run")
        ).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = (None, None)
    if found[0] is not None:
        return found[0]
    run = 0 if found[1] is None else found[1] + 1
    row = spark.createDataFrame([(checkpoint, run)], "checkpoint string, run long")
    row.coalesce(1).write.mode("append").json(known)
    return run


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def upsert_batch(path: str, run: int = 0, complete: bool = False, versions: int = VERSIONS):
    """Sink for ``foreachBatch``: stores a batch as the next version of its keys.

    Every epoch has its own folder and overwrites it, so an epoch that runs
    twice after a failure leaves one copy. Executors write in parallel, and an
    error stops the query instead of losing the batch. The batch is used once,
    since each further action would read the state again.

    A ``complete`` batch holds every key, so the epoch that is ``versions`` older
    goes once the new one is stored. A reader that opened it before may fail and
    has to read again. Batches of changed keys are all kept; ``compact`` cuts them.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        folder = f"{path}/{RUN}={run}"
        to_kv(batch).write.mode("overwrite").parquet(f"{folder}/{EPOCH}={epoch}")
        if complete and epoch >= versions:
            _delete(batch.sparkSession, f"{folder}/{EPOCH}={epoch - versions}")

    return write


def read_versions(
    spark: SparkSession, path: str, n: int = VERSIONS, complete: bool = False
) -> DataFrame:
    """The ``n`` newest versions of every key, by run and epoch; none before the first batch.

    Say ``complete`` for a sink fed in complete mode: each epoch then holds every
    key, so only the folders of the last ``n`` epochs of the last run are opened.
    """
    try:
        cells = spark.read.schema(STORED).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        cells = spark.createDataFrame([], STORED)
    if complete:
        newest = cells.agg(F.max(F.struct(RUN, EPOCH)).alias("last"))
        last = newest.select(F.col("last.run")).scalar(), newest.select(F.col("last.epoch")).scalar()
        cells = cells.filter((F.col(RUN) == last[0]) & (F.col(EPOCH) > last[1] - n))
    return keep_versions(cells, ["key"], [RUN, EPOCH], n)


def read_latest(spark: SparkSession, path: str, complete: bool = False) -> DataFrame:
    return read_versions(spark, path, 1, complete)


def compact(spark: SparkSession, path: str, target: str, n: int = VERSIONS) -> None:
    """Write the versions worth keeping to another folder, laid out the same way."""
    kept = read_versions(spark, path, n)
    kept.repartition(RUN, EPOCH, F.pmod(F.hash("key"), F.lit(64))).write.partitionBy(RUN, EPOCH).mode(
        "overwrite"
    ).parquet(target)


def start_daily(
    obs: DataFrame,
    target: str,
    checkpoint: str,
    interval_seconds: int | None = None,
    output_mode: str = "update",
) -> StreamingQuery:
    """Start the summary; without an interval it drains the input and ends.

    ``update`` stores changed keys only. ``complete`` stores the whole result each
    time and keeps the last three; both lead to the same newest versions.
    """
    run = run_of(obs.sparkSession, target, checkpoint)
    writer = (
        stream_daily(obs)
        .writeStream.outputMode(output_mode)
        .foreachBatch(upsert_batch(target, run, output_mode == "complete"))
        .option("checkpointLocation", checkpoint)
    )
    if interval_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{interval_seconds} seconds").start()


def run(query: StreamingQuery, duration_seconds: float | None = None) -> None:
    """Wait for the end of the query, or stop it after a time. Errors are raised."""
    try:
        query.awaitTermination(duration_seconds)
    finally:
        query.stop()
