"""Data signatures, model errors and benchmark ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def signature(features: DataFrame, yields: DataFrame) -> DataFrame:
    """``rows_sum_rows_sum`` of features and yields, NULL sums as 0.

    Both measures have four decimals and are added up as whole ten-thousandths:
    the text must not change with the order of a floating sum. Both inputs are
    reduced to one row in the same aggregate.
    """

    def measure(df, side, column):
        parts = F.round(F.col(column).cast("double") * 10000).try_cast("bigint")
        return df.select(F.lit(side).alias("side"), parts.alias("v"))

    both = measure(features, 0, "avg_ndvi").unionByName(measure(yields, 1, "yield_mt_ha"))

    def count(side):
        return F.count_if(F.col("side") == side)

    def total(side):
        return F.coalesce(F.sum(F.when(F.col("side") == side, F.col("v"))), F.lit(0)) / 10000

    return both.agg(
        F.format_string("%d_%.4f_%d_%.4f", count(0), total(0), count(1), total(1)).alias(
            "signature"
        )
    )


def should_skip(
    metadata: DataFrame, current: DataFrame, results: list[DataFrame], kind: str = "random_forest"
) -> bool:
    """True if the stored signature is current and no result table is empty."""
    same = metadata.filter(F.col("type") == kind).join(current, "signature", "left_semi")
    return not same.isEmpty() and not any(r.isEmpty() for r in results)


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Root mean squared error and R squared in one pass."""
    scored = df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    error = F.col(actual) - F.col(predicted)
    squared = F.avg(error * error)
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(squared).alias("rmse"),
        (1 - F.try_divide(squared, F.var_pop(actual))).alias("r2"),
    )


def scaling_factor(runs: DataFrame) -> DataFrame:
    """Growth of time over growth of rows, from the smallest to the largest run.

    ``runs``: fraction, row_count, latency_ms. Below 1.0 is better than linear.
    """

    def grown(column):
        first = F.greatest(F.min_by(column, "fraction"), F.lit(1))
        return F.max_by(column, "fraction") / first

    return runs.agg(
        F.round(F.try_divide(grown("latency_ms"), grown("row_count")), 3).alias("scaling_factor")
    )


def scaling_report(runs: DataFrame) -> DataFrame:
    """The runs and, as fraction -1, a row with their scaling factor."""
    factor = scaling_factor(runs).select(
        F.lit(-1.0).alias("fraction"),
        F.lit(0).cast("bigint").alias("row_count"),
        F.lit(0.0).alias("latency_ms"),
        "scaling_factor",
    )
    return runs.select(
        "fraction", "row_count", "latency_ms", F.lit(None).cast("double").alias("scaling_factor")
    ).unionByName(factor)


def format_speedup(runs: DataFrame) -> DataFrame:
    """Mean latency of both formats and their ratio.

    ``runs``: format (``orc`` or ``csv``), latency_ms.
    """

    def mean(kind):
        return F.avg(F.when(F.col("format") == kind, F.col("latency_ms")))

    speedup = F.when(mean("orc") > 0, mean("csv") / mean("orc")).otherwise(F.lit(0.0))
    return runs.agg(
        F.round(mean("orc"), 2).alias("orc_latency_ms"),
        F.round(mean("csv"), 2).alias("csv_latency_ms"),
        F.round(speedup, 2).alias("orc_speedup"),
    )
