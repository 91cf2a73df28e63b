"""Set operations, splits, samples and counters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from harvestline.functions.numeric import md5_fraction

FRACTIONS = (0.1, 0.25, 0.5, 0.75, 1.0)
SEED = 42


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def unseen(new: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Inputs that were not processed before."""
    return new.join(seen.select(key), key, "left_anti")


def only_targets(df: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    return df.join(targets.select(key), key, "left_semi")


def split(df: DataFrame, keys: Sequence[str], train: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Train and test part by a hash of the key.

    Unlike a random split the parts do not move with the partitioning, so they
    stay disjoint when a lost task is run again.
    """
    draw = md5_fraction(*[F.col(k) for k in keys])
    return df.filter(draw < train), df.filter(draw >= train)


def sample(df: DataFrame, fraction: float, seed: int = SEED) -> DataFrame:
    return df if fraction >= 1.0 else df.sample(fraction=fraction, seed=seed)


def draw_of(keys: Sequence[str], seed: int = SEED) -> Column:
    """Seeded draw from [0, 1) by the key of a row, wherever the row lies."""
    return md5_fraction(F.lit(seed), *[F.col(k) for k in keys])


def sample_by_key(
    df: DataFrame, keys: Sequence[str], fraction: float, seed: int = SEED
) -> DataFrame:
    """A seeded sample that does not depend on files, partitions or tasks run again.

    Samples of one seed are nested. Rows of equal keys stay or go together.
    """
    return df if fraction >= 1.0 else df.filter(draw_of(keys, seed) < fraction)


def sampled_counts(
    df: DataFrame, keys: Sequence[str], fractions: Sequence[float] = FRACTIONS, seed: int = SEED
) -> DataFrame:
    """Rows and mean temperature of each sample by key, in one scan.

    One draw per row decides about all fractions.
    """
    drawn = df.withColumn("draw", draw_of(keys, seed)).select(
        "temp_c",
        F.explode(
            F.filter(F.array(*[F.lit(f) for f in fractions]), lambda f: F.col("draw") < f)
        ).alias("fraction"),
    )
    return drawn.groupBy("fraction").agg(
        F.count(F.lit(1)).alias("row_count"), F.avg("temp_c").alias("mean_temp_c")
    )


def preview(df: DataFrame, order: Sequence[str | Column], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` and a counter filled while it is written, without another pass."""
    counter = Observation(name)
    return df.observe(counter, F.count(F.lit(1)).alias("records")), counter
