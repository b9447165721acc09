"""Incremental refresh of the daily fact when silver months arrive or change."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cotalake.functions import dates, text
from cotalake.operators import joins, ordered
from cotalake.plans import gold
from cotalake.sinks.writers import sink_partitioned_month
from cotalake.streaming.movements import run_available

VALUES = list(gold.VARIATIONS)
ROWS = "linhas"


def _months(silver: DataFrame, months: list[int]) -> DataFrame:
    return silver.filter(F.col("ano_mes").isin(months)).drop("ano_mes")


def month_summary(report: DataFrame, dim: DataFrame, key: str = "parity") -> DataFrame:
    """(sk_fundo, ano_mes, last known values, rows): what later months need to know of a month, and how large it is."""
    rows = joins.join_fact_dim(gold.report_rows(report), dim, unique_fund_key=key == "parity")
    tie = text.row_order(joins.CNPJ, "patrimonio_liquido_dia", "captacao_dia", "resgate_dia", "cotistas_dia")
    ordered_rows = rows.withColumn("_order", ordered.chunk_order(F.col("data"), tie))
    return ordered_rows.groupBy("sk_fundo", F.trunc("data", "month").alias("_month")).agg(
        *[F.max_by(v, F.when(F.col(v).isNotNull(), F.col("_order"))).alias(v) for v in VALUES],
        F.count(F.lit(1)).alias(ROWS),
    ).withColumn("_key", dates.date_key(F.col("_month")))


def affected_months(summary: DataFrame, touched: list[int]) -> list[int]:
    """Touched months, and per fund the later ones up to its next known value.

    ``summary`` has one row per fund and month, so a fund's window group is
    bounded by the calendar, and so is the returned list.
    """
    is_touched = F.col("ano_mes").isin(touched)
    earlier = Window.partitionBy("sk_fundo").orderBy("ano_mes").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.lit(False)
    for value in VALUES:
        mark = F.when(is_touched, "changed").when(F.col(value).isNotNull(), "known")
        reached = reached | F.coalesce(F.last(mark, ignorenulls=True).over(earlier) == "changed", F.lit(False))
    rows = summary.withColumn("_reached", reached | is_touched).filter("_reached").select("ano_mes").distinct().collect()
    return sorted({r["ano_mes"] for r in rows} | set(touched))


def refresh_fact(
    spark: SparkSession, silver: DataFrame, touched: list[int], dim: DataFrame, gold_path: str, summary_path: str,
    key: str = "parity",
) -> None:
    """Rewrite exactly the months whose fact rows can differ. Repeating a refresh changes nothing."""
    sink_partitioned_month(
        month_summary(_months(silver, touched), dim, key), summary_path, key="_key", only_touched=True
    )
    summary = spark.read.parquet(summary_path)
    months = affected_months(summary, touched)
    history = summary.filter(~F.col("ano_mes").isin(months)).select(
        "sk_fundo",
        F.col("_month").alias("_chunk_day"),
        F.lit(0).cast("long").alias("_chunk_slice"),
        *VALUES,
    )
    # A summary of an earlier version has no rows; then they are counted.
    size = F.when(F.col("ano_mes").isin(months), F.col(ROWS)).otherwise(F.lit(1)) if ROWS in summary.columns else None
    sizes = None if size is None else summary.groupBy("sk_fundo").agg(F.sum(F.coalesce(size, F.lit(ordered.MAX_CHUNK_ROWS + 1))).alias("_n"))
    fact = gold.fct_fundo_diario(_months(silver, months), dim, history=history, key=key, sizes=sizes)
    sink_partitioned_month(fact, gold_path, only_touched=True)


def incremental_gold(
    spark: SparkSession, silver_path: str, dim: DataFrame, gold_path: str, summary_path: str, checkpoint: str,
    key: str = "parity",
) -> None:
    """Follow the silver folder: new files mark their months, which are then rebuilt from silver."""
    schema = spark.read.parquet(silver_path).schema
    arrivals = spark.readStream.schema(schema).parquet(silver_path).select("ano_mes")

    def rebuild(batch: DataFrame, _id: int) -> None:
        touched = sorted(r["ano_mes"] for r in batch.distinct().collect())
        if touched:
            silver = spark.read.schema(schema).parquet(silver_path)
            refresh_fact(spark, silver, touched, dim, gold_path, summary_path, key)

    run_available(arrivals.writeStream.foreachBatch(rebuild), checkpoint)
