"""Client positions kept up to date from stored balances.

A store has two tables with a folder per month (or week): ``posicao``, the daily rows, and ``saldos``, one row per key with
its balances at the end of the period. A refresh reads the balances before the first period it must rewrite and the movements from there on.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cotalake.operators import relationship as rel

PERIOD = "inicio"
BALANCES, POSITIONS = "saldos", "posicao"


def _start(day: Column, every: str) -> Column:
    return F.trunc(day, every)


def _end(start: Column, every: str) -> Column:
    return F.date_add(start, 6) if every == "week" else F.last_day(start)


def _write(df: DataFrame, path: str) -> None:
    """Replaces the periods that ``df`` holds, and no others."""
    writer = df.hint("rebalance", PERIOD).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(PERIOD).parquet(path)


def read_balances(spark: SparkSession, path: str) -> DataFrame | None:
    """None where nothing has been stored yet."""
    try:
        return spark.read.parquet(f"{path}/{BALANCES}").withColumn(PERIOD, F.col(PERIOD).cast("date"))
    except AnalysisException as fault:
        if fault.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def read_positions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{POSITIONS}").drop(PERIOD)


def refresh_positions(
    spark: SparkSession, movements: DataFrame, path: str, keys: Sequence[str] = ("sk_cliente",),
    since: dt.date | None = None, every: str = "month",
) -> dt.date | None:
    """Bring the store in line with ``movements``, of which those before ``since`` have not changed since the last refresh.

    ``movements`` holds all of them; only days from the first rewritten period on are read (folders of a column ``dia`` are
    pruned). That period is the one of ``since``, or the last one stored, as its days were not over. ``every`` is
    month or week, the same for the life of a store. Repeating a refresh changes nothing, and one that was killed is
    mended by calling it again. Returns the first rewritten day, None if there is no dated movement.
    """
    if every not in ("month", "week"):
        raise ValueError(f"a period is a month or a week, not {every}")
    day = F.col("dia") if "dia" in movements.columns else F.col("data").cast("date")
    stored = read_balances(spark, path)
    reached = None if stored is None else stored.agg(F.max(PERIOD)).first()[0]
    if since is None:
        since = movements.agg(F.min(day)).first()[0]
    if since is None:
        return None
    first = spark.range(1).select(_start(F.lit(since), every)).first()[0]
    first = first if reached is None else min(first, reached)
    recent = movements.filter(day >= F.lit(first))
    last = recent.agg(F.max(day)).first()[0]
    if last is None:
        return None
    if reached is None:
        opening = spark.createDataFrame([], recent.select(*keys).schema).withColumns(
            {"saldo_dia": F.lit(0).cast("decimal(38,2)"), "valor_investido": F.lit(0).cast("decimal(38,2)"), "ultimo_mov": F.lit(None).cast("date")}
        )
    else:
        before = stored.filter(F.col(PERIOD) < F.lit(first)).agg(F.max(PERIOD)).first()[0]
        opening = stored.filter(F.col(PERIOD) == F.lit(before).cast("date")).drop(PERIOD)
    position = rel.position_after(recent, opening, F.lit(first), F.lit(last), keys)
    _write(position.withColumn(PERIOD, _start(F.col("data"), every)), f"{path}/{POSITIONS}")
    written = spark.read.parquet(f"{path}/{POSITIONS}").withColumn(PERIOD, F.col(PERIOD).cast("date")).filter(F.col(PERIOD) >= F.lit(first))
    closing = written.filter(F.col("data") == F.least(_end(F.col(PERIOD), every), F.lit(last)))
    _write(rel.closing_balances(closing, [*keys, PERIOD]), f"{path}/{BALANCES}")
    return first
