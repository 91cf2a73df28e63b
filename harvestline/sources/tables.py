"""Warehouse and relational tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

ORC = "orc"


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def write_indices(df: DataFrame, table: str, path: str) -> None:
    """Drop and replace an ORC warehouse table stored at ``path``."""
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    df.write.format(ORC).mode("overwrite").option("path", path).saveAsTable(table)


def read_indices(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


@dataclass(frozen=True)
class JdbcTable:
    """A relational table and how to cut its scan into parallel range reads.

    Without ``partition_column`` the whole table comes through one connection.
    """

    url: str
    table: str
    user: str
    password: str
    driver: str = "org.postgresql.Driver"
    partition_column: str | None = None
    lower_bound: int = 0
    upper_bound: int = 0
    partitions: int = 1
    fetch_size: int = 10000
    batch_size: int = 10000
    extra: dict[str, str] = field(default_factory=dict)

    def _common(self) -> dict[str, str]:
        return {
            "url": self.url,
            "dbtable": self.table,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            **self.extra,
        }

    def read_options(self) -> dict[str, str]:
        options = {**self._common(), "fetchsize": str(self.fetch_size)}
        if self.partition_column:
            options |= {
                "partitionColumn": self.partition_column,
                "lowerBound": str(self.lower_bound),
                "upperBound": str(self.upper_bound),
                "numPartitions": str(self.partitions),
            }
        return options

    def write_options(self, truncate: bool = False) -> dict[str, str]:
        """``truncate`` empties the table instead of dropping it: constraints stay."""
        return {
            **self._common(),
            "batchsize": str(self.batch_size),
            "numPartitions": str(self.partitions),
            "truncate": str(truncate).lower(),
        }


def read_table(spark: SparkSession, source: JdbcTable) -> DataFrame:
    return spark.read.format("jdbc").options(**source.read_options()).load()


def jdbc_writer(df: DataFrame, target: JdbcTable, truncate: bool = False) -> DataFrameWriter:
    return df.write.format("jdbc").options(**target.write_options(truncate)).mode("overwrite")


def write_table(df: DataFrame, target: JdbcTable, truncate: bool = False) -> None:
    jdbc_writer(df, target, truncate).save()


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of files, with no rows before it is first written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
