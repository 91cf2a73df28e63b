"""Keyed tables: point and prefix reads, versions, upserts.

"First" and "last" always follow named order columns. ``row_number() <= n`` is
planned with a partial group limit, so no more than ``n`` rows of a key leave a
map task and a hot key does not pile up in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harvestline.functions.keys import KEY_SEPARATOR, key_date, key_entity, kv_key
from harvestline.sources import folders

RANK = "_rank"
SIDE = "_side"
BUCKET = "bucket"
BUCKETS = 64
# Folders beside the buckets; readers of the table pass over names with an underscore.
INCOMING, STAGED, READY = "_incoming", "_staged", "_ready"


def _top(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(RANK, F.row_number().over(ranked)).filter(F.col(RANK) <= n).drop(RANK)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _top(df, keys, [F.col(c).asc_nulls_first() for c in order], 1)


def keep_versions(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The ``n`` newest rows of every key."""
    return _top(df, keys, [F.col(c).desc_nulls_last() for c in order], n)


def kv_upsert(
    current: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Table after the updates: the newest row of every key wins.

    Without order columns, or on equal ones, an update beats the stored row.
    """
    both = current.withColumn(SIDE, F.lit(0)).unionByName(updates.withColumn(SIDE, F.lit(1)))
    return keep_versions(both, keys, [*order, SIDE], 1).drop(SIDE)


def insert_absent(
    current: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Stored rows plus the first new row of every key that is not stored yet."""
    first = first_per_key(new, keys, order).select(*current.columns)
    return current.unionByName(first.join(current.select(*keys), list(keys), "left_anti"))


def to_kv(df: DataFrame, entity: str = "county_id", day: str = "date") -> DataFrame:
    """Rows with their ``key`` in front; value columns keep their types."""
    return df.select(kv_key(F.col(entity), F.col(day)).alias("key"), *df.columns)


def kv_get(df: DataFrame, *wanted: str) -> DataFrame:
    """Rows of the given keys. On a stored table the condition reaches the file scan."""
    return df.filter(F.col("key").isin(*wanted))


def kv_prefix_scan(df: DataFrame, entity: int | str, *values: str) -> DataFrame:
    """Series of one entity by date, with the date taken from the key."""
    hits = df.filter(F.col("key").startswith(f"{entity}{KEY_SEPARATOR}"))
    series = hits.select(key_date(F.col("key")).alias("date"), *values)
    return series.filter(F.col("date").isNotNull()).orderBy("date")


def bucket_of(entity: Column, buckets: int) -> Column:
    return F.pmod(F.hash(entity.cast("string")), F.lit(buckets))


def write_kv(df: DataFrame, path: str, buckets: int = BUCKETS, mode: str = "overwrite") -> None:
    """Store a keyed table so that reads of one entity touch one folder.

    Rows are range-partitioned on (bucket, key): a busy entity spreads over
    several files with disjoint key ranges, whose statistics prune row groups.
    """
    placed = df.withColumn(BUCKET, bucket_of(key_entity(F.col("key")), buckets))
    (
        placed.repartitionByRange(BUCKET, "key")
        .sortWithinPartitions(BUCKET, "key")
        .write.mode(mode)
        .partitionBy(BUCKET)
        .parquet(path)
    )


def stored_entities(df: DataFrame, *entities: int | str, buckets: int = BUCKETS) -> DataFrame:
    """The buckets of a ``write_kv`` table that can hold the entities."""
    wanted = [bucket_of(F.lit(str(e)), buckets) for e in entities]
    return df.filter(F.col(BUCKET).isin(*wanted)).drop(BUCKET)


def upsert_stored(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    order: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> None:
    """``kv_upsert`` on a ``write_kv`` table that reads and writes the touched buckets only.

    The table may not be there yet. The new buckets are written beside the old ones and
    take their places when all are complete: a run that fails before leaves the old state,
    one that fails while they move is finished by the next (``finish_upsert``). Running an
    upsert twice does no harm. There may be one writer at a time; a reader that opened a
    bucket while it moved has to read again. ``updates`` are evaluated once.
    """
    finish_upsert(spark, path)
    incoming = f"{path}/{INCOMING}"
    placed = updates.withColumn(BUCKET, bucket_of(key_entity(F.col("key")), buckets))
    placed.write.mode("overwrite").parquet(incoming)
    news = spark.read.schema(placed.schema).parquet(incoming)
    touched = [r[0] for r in news.select(BUCKET).distinct().collect()]  # of ``buckets`` at most
    if _buckets(spark, path):
        old = spark.read.parquet(path)
        wanted = F.col(BUCKET).isin(*[b for b in touched if b is not None])
        if None in touched:  # keys that are null have a bucket of their own
            wanted = F.coalesce(wanted, F.lit(True))
        old = old.filter(wanted).select(*updates.columns)
    else:
        old = news.limit(0).drop(BUCKET)
    merged = kv_upsert(old, news.drop(BUCKET), ["key"], order)
    write_kv(merged, f"{path}/{STAGED}", buckets)
    folders.rename(spark, f"{path}/{STAGED}", f"{path}/{READY}")
    finish_upsert(spark, path)


def finish_upsert(spark: SparkSession, path: str) -> None:
    """Move complete new buckets to their places, if a run left any; drop incomplete ones."""
    ready = f"{path}/{READY}"
    for bucket in _buckets(spark, ready):
        folders.delete(spark, f"{path}/{bucket}")
        folders.rename(spark, f"{ready}/{bucket}", f"{path}/{bucket}")
    for name in (READY, STAGED, INCOMING):
        folders.delete(spark, f"{path}/{name}")


def _buckets(spark: SparkSession, path: str) -> list[str]:
    return [n for n in folders.names(spark, path) if n.startswith(f"{BUCKET}=")]
