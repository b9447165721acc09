"""Helpers shared by the operators of this package."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cotalake.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that Spark hands to a Python worker at once. Texts are long: 10,000 of them, Spark's default, are held several times over.
BATCH_ROWS = 1_000


def text_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``BATCH_ROWS``; smaller settings of the user stay."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def written(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back, so that later steps neither recompute nor depend on executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder(key: Column, divisor: int) -> Column:
    """crc32 of the key as text, modulo ``divisor``; a null key counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def seed_of(*parts: object) -> int:
    return zlib.crc32("|".join(map(str, parts)).encode())


def bounded_sample(df: DataFrame, key: str, rows: int, seed: int) -> DataFrame:
    """At most ``rows`` rows, chosen by a hash of the key: the same ones at every run."""
    order = F.xxhash64(F.lit(seed), F.col(key))
    return df.orderBy(order, F.col(key)).limit(rows)
