"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from harvestline.session import scratch_path
from harvestline.sources import folders

Batches = Iterator[pa.RecordBatch]
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def keep(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``df`` written to the shared folder and read back, its shuffle files deleted.

    Cuts the lineage in a way that survives lost executors. Spark would keep the shuffle
    files of all steps of a long job until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.kept_at = path
    return kept


def drop(*kept: DataFrame) -> None:
    """Delete tables made by ``keep`` whose last reader has been stored."""
    for df in kept:
        folders.delete(df.sparkSession, df.kept_at)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns that an operator is about to add, whatever their case."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def appended(df: DataFrame, *fields: StructField) -> StructType:
    return StructType([*df.schema.fields, *fields])


def importable(spark: SparkSession) -> None:
    """Let Python workers find this library where the driver has it.

    On a cluster without a shared installation the library goes with ``--py-files``.
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, ROOT]))


def map_arrow(
    df: DataFrame, rows: Callable[[Batches], Batches], schema: StructType | str
) -> DataFrame:
    importable(df.sparkSession)

    def tidy(batches: Batches) -> Batches:
        try:
            yield from rows(batches)
        finally:
            give_back()

    return df.mapInArrow(tidy, schema)


def give_back() -> None:
    """Return what a task has freed to the system.

    Workers live on between tasks, and would hold it beside the executor's next stages.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def with_columns(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*batch.columns, *columns.values()], [*batch.schema.names, *columns]
    )


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of every text; null counts as empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def slabs(column: pa.Array, size: int) -> Iterator[tuple[int, pa.Array]]:
    """Copied parts of a text column of about ``size`` bytes, one text at least."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, length in enumerate([*sizes, size]):
        if total and total + length > size or i == len(sizes) > start:
            yield start, column.take(pa.array(np.arange(start, i)))
            start, total = i, 0
        total += length


def split_words(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in a row, and where those of each text begin and end.

    Words are runs of anything but ASCII white space, upper-case ASCII lowered.
    ``texts`` must not be a slice; null counts as empty.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    ends = split.offsets.to_numpy() - split.offsets[0].as_py()
    words = split.flatten()
    full = pc.greater(pc.binary_length(words), 0)
    before = np.append(0, np.cumsum(full.to_numpy(zero_copy_only=False)))
    return words.filter(full), before[ends]


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def bucket_of_id(name: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.pmod(F.crc32(F.col(name).cast("string")), F.lit(parts))
