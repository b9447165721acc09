"""The operational tables as typed sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cotalake.operators.resolve import conform
from cotalake.schemas import OPERATIONAL_TABLES


def operational_table(df: DataFrame, table: str) -> DataFrame:
    """Cast any frame to the declared columns of an operational table."""
    return conform(df, OPERATIONAL_TABLES[table])


def read_operational(
    spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, partitions: int, **options: str
) -> DataFrame:
    """Read one table over JDBC in parallel key ranges. Needs the database's driver on the classpath."""
    raw = (
        spark.read.format("jdbc")
        .options(
            url=url, dbtable=table, partitionColumn=key, lowerBound=lower, upperBound=upper,
            numPartitions=partitions, **options,
        )
        .load()
    )
    return operational_table(raw, table)
