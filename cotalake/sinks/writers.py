"""Table sinks. Every writer returns the number of rows it wrote."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cotalake.functions import dates
from cotalake.sources.objects import list_objects


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Counts rows while they are written, with no second pass."""
    watch = Observation(f"rows-{uuid.uuid4().hex}")
    return df.observe(watch, F.count(F.lit(1)).alias("rows")), watch


def sink_csv(df: DataFrame, path: str, sep: str = ";", encoding: str = "UTF-8", mode: str = "overwrite") -> int:
    watched, watch = _observed(df)
    watched.write.mode(mode).options(header=True, sep=sep, encoding=encoding, quote='"', escape='"').csv(path)
    return watch.get["rows"]


def sink_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    watched, watch = _observed(df)
    watched.write.mode(mode).parquet(path)
    return watch.get["rows"]


def sink_dual(spark: SparkSession, df: DataFrame, path: str) -> int:
    """Parquet, then CSV from the Parquet just written: the plan runs once and no cache can be lost."""
    rows = sink_parquet(df, f"{path}/parquet")
    sink_csv(spark.read.parquet(f"{path}/parquet"), f"{path}/csv")
    return rows


def by_month(df: DataFrame, key: str = "sk_data") -> DataFrame:
    """Adds ``ano_mes`` and groups the rows by it for writing.

    A rebalance, not a repartition: a month that exceeds the advisory size is
    split over several tasks and small months share one.
    """
    return df.withColumn("ano_mes", dates.month_key(F.col(key))).hint("rebalance", "ano_mes")


def sink_partitioned_month(
    df: DataFrame, path: str, key: str = "sk_data", form: str = "parquet", only_touched: bool = False
) -> int:
    """One folder per month, the month dropped from the files.

    ``only_touched`` replaces just the months present in ``df``.
    """
    watched, watch = _observed(by_month(df, key))
    writer = watched.write.mode("overwrite").partitionBy("ano_mes")
    if only_touched:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if form == "csv":
        writer.options(header=True, sep=";", quote='"', escape='"').csv(path)
    else:
        writer.parquet(path)
    return watch.get["rows"]


def overwrite_full_load(df: DataFrame, path: str) -> int:
    """Replace whatever the destination holds."""
    return sink_parquet(df, path, mode="overwrite")


def with_output_name(df: DataFrame, suffix: str = "_clean.csv") -> DataFrame:
    """Adds ``origem``: the name of the file a row came from, ``x.csv`` as ``x_clean.csv``."""
    return df.withColumn("origem", F.regexp_replace("_metadata.file_name", r"(?i)\.csv$", suffix))


def per_file_output(df: DataFrame, path: str, origin: str = "origem") -> int:
    """One output folder per input file; a large file is still written by many tasks."""
    watched, watch = _observed(df.hint("rebalance", origin))
    watched.write.mode("overwrite").partitionBy(origin).options(header=True, sep=";", quote='"', escape='"').csv(path)
    return watch.get["rows"]


@dataclass(frozen=True)
class Produced:
    name: str
    path: str
    rows: int


def run_manifest(spark: SparkSession, produced: list[Produced]) -> DataFrame:
    """(nome, quantidade_registros, tamanho_mb) per produced table and a ``total`` row.

    Row counts were taken while writing; sizes come from the file listing.
    """
    tables: DataFrame | None = None
    for item in produced:
        files = list_objects(spark, item.path).filter(~F.col("nome").rlike(r"^[_.]"))
        row = files.agg(
            F.lit(item.name).alias("nome"),
            F.lit(item.rows).cast("long").alias("quantidade_registros"),
            (F.coalesce(F.sum("tamanho"), F.lit(0)) / F.lit(1024.0 * 1024.0)).alias("tamanho_mb"),
        )
        tables = row if tables is None else tables.unionByName(row)
    total = tables.agg(
        F.lit("total").alias("nome"),
        F.sum("quantidade_registros").alias("quantidade_registros"),
        F.sum("tamanho_mb").alias("tamanho_mb"),
    )
    return tables.unionByName(total)


