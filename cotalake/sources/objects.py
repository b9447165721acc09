"""Object listings: which files exist, how large and how new."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cotalake.functions import text
from cotalake.operators.joins import latest_by_pattern


def list_objects(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(caminho, nome, modificado, tamanho) of every matching file. Contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .options(recursiveFileLookup=True, pathGlobFilter=pattern)
        .load(path)
        .select("path", "modificationTime", "length")
    )
    return files.select(
        F.col("path").alias("caminho"),
        text.last_path_segment(F.col("path")).alias("nome"),
        F.col("modificationTime").alias("modificado"),
        F.col("length").alias("tamanho"),
    )


def list_csv_objects(spark: SparkSession, path: str) -> DataFrame:
    """Files that end in ``.csv`` in any case."""
    return list_objects(spark, path, "*.[cC][sS][vV]")


def single_file_by_pattern(spark: SparkSession, path: str, term: str) -> DataFrame:
    """The newest CSV whose name contains ``term``; one null row when there is none."""
    return latest_by_pattern(list_csv_objects(spark, path), "caminho", "modificado", term)
