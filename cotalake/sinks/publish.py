"""Replacing a table or a whole run at once: write beside, then move a pointer.

A destination holds numbered slots and a list of commits. A writer fills a slot that the newest commit does not name and
appends one commit, which is one small file and so is there or not. Until then readers see the old state; a writer that
dies leaves a slot without a commit, which the next writer overwrites. One writer at a time; a reader may go on with the
state it opened for ``slots - 1`` further publications.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cotalake.sinks import writers

COMMITS = "publicacoes"
COMMIT = "versao bigint, pasta string, registros bigint, momento timestamp"
SLOTS = 2
Result = TypeVar("Result")


def commits(spark: SparkSession, path: str) -> DataFrame:
    """(versao, pasta, registros, momento): what was published at ``path``, nothing where none was."""
    try:
        return spark.read.schema(COMMIT).parquet(f"{path}/{COMMITS}")
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMIT)


def _newest(spark: SparkSession, path: str) -> tuple[int, str | None]:
    row = commits(spark, path).agg(F.max(F.struct("versao", "pasta")).alias("ultima")).first()["ultima"]
    return (0, None) if row is None else (row["versao"], row["pasta"])


def current_path(spark: SparkSession, path: str) -> str:
    """Folder of the published state."""
    folder = _newest(spark, path)[1]
    if folder is None:
        raise FileNotFoundError(f"nothing was published at {path}")
    return f"{path}/{folder}"


def publish(
    spark: SparkSession, path: str, write: Callable[[str], Result], rows: Callable[[Result], int], slots: int = SLOTS
) -> Result:
    """``write`` fills the folder it is given; when it returns, that folder becomes the published state."""
    if slots < 2:
        raise ValueError("a publication needs a slot beside the published one")
    version = _newest(spark, path)[0] + 1
    folder = f"vaga_{version % slots}"
    result = write(f"{path}/{folder}")
    entry = spark.range(1).select(
        F.lit(version).cast("long").alias("versao"), F.lit(folder).alias("pasta"),
        F.lit(rows(result)).cast("long").alias("registros"), F.current_timestamp().alias("momento"),
    )
    entry.coalesce(1).write.mode("append").parquet(f"{path}/{COMMITS}")
    return result


def publish_table(df: DataFrame, path: str, slots: int = SLOTS) -> int:
    """Replace the table at ``path`` by ``df``, which may read that very table. Returns the rows written."""
    return publish(df.sparkSession, path, lambda folder: writers.sink_parquet(df, folder), lambda count: count, slots)


def published_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(current_path(spark, path))
