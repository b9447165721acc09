"""Cash-movement feed: landing folder of CSV files to a typed table and to daily flows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cotalake.functions import numbers
from cotalake.operators.joins import redemption_alert
from cotalake.schemas import MOVEMENT


ORIGIN = "arquivo"
LOT = "lote"
#: Hidden from a reader of the table by its underscore.
COMMITS = "_lotes"
COMMIT = "lote string, arquivo string, tamanho bigint, linhas bigint, situacao string"
MOVEMENT_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in MOVEMENT.fields)


def typed_movements(raw: DataFrame) -> DataFrame:
    """Text columns of the feed to their declared types; bad values become null, the file's name stays where known."""
    types = {f.name: f.dataType for f in MOVEMENT.fields}

    def typed(name: str) -> Column:
        if name == "data":
            return F.try_to_timestamp(F.col(name), F.lit("yyyy-MM-dd HH:mm:ss")).alias(name)
        return F.col(name).try_cast(types[name]).alias(name)

    return raw.select(*[typed(name) for name in types], *[c for c in raw.columns if c not in types])


def read_movements(
    spark: SparkSession, landing: str, files_per_batch: int | None = None, size_as: str | None = None
) -> DataFrame:
    """Stream of the landing folder: comma-separated files with a header. ``arquivo`` is each row's file, ``size_as`` names its size."""
    schema = ", ".join(f"{name} string" for name in MOVEMENT.fieldNames())
    reader = spark.readStream.schema(schema).options(header=True, sep=",")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    size = [F.col("_metadata.file_size").alias(size_as)] if size_as else []
    return typed_movements(reader.csv(landing).select("*", F.col("_metadata.file_path").alias(ORIGIN), *size))


def run_available(query_writer, checkpoint: str) -> None:
    """Process everything that has landed, then stop."""
    query_writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def batch_folder(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """Name of a batch's folder. Every checkpoint has an identity of its own, so a new one never writes into old folders."""
    stream = spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id")).first()[0]
    return f"{stream}-{batch_id}"


def commits(spark: SparkSession, path: str) -> DataFrame:
    """(lote, arquivo, tamanho, linhas, situacao): files and row counts of each finished batch, ``lido`` or ``mudou``."""
    return spark.read.schema(COMMIT).parquet(f"{path}/{COMMITS}")


def _land(batch: DataFrame, folder: str, path: str) -> None:
    """Write a batch's new files to a folder of its own, then commit them.

    A batch tried again after a failure replaces its folder; one whose commit stands has no new files left. The table's
    days are never read: only the list of known files is, one row per file. A known file that comes again brings
    nothing; if its size has changed its rows are set aside as ``mudou``, see :func:`changed_files`.
    """
    spark = batch.sparkSession
    known = commits(spark, path).filter("situacao = 'lido'").select(ORIGIN, F.col("tamanho").alias("_antes"))
    state = F.when(F.col("_antes").isNull(), "lido").when(F.col("_antes") != F.col("tamanho"), "mudou")
    marked = batch.withColumn("dia", F.col("data").cast("date")).join(known, ORIGIN, "left").withColumn("situacao", state)
    kept = marked.drop("_antes").filter(F.col("situacao").isNotNull())
    lot = f"{path}/{LOT}={folder}"
    kept.hint("rebalance", "dia").write.mode("overwrite").partitionBy("situacao", "dia").parquet(lot)
    _commit(spark.read.schema(kept.schema).parquet(lot), folder, path)


def _commit(written: DataFrame, folder: str, path: str) -> None:
    """A row per file of the batch. One task writes them, hence one file that is there or not."""
    counted = written.groupBy(ORIGIN, "tamanho", "situacao").agg(F.count(F.lit(1)).alias("linhas")).withColumn(LOT, F.lit(folder))
    named = counted.select(LOT, ORIGIN, "tamanho", "linhas", "situacao")
    named.coalesce(1).write.mode("append").parquet(f"{path}/{COMMITS}")


def ledger_ingest(spark: SparkSession, landing: str, path: str, checkpoint: str, files_per_batch: int | None = None) -> None:
    """Land every movement of every file once in a table with a folder per batch and day. Read it with :func:`read_ledger`.

    A file is known by its name: landed again under another name it brings new movements, and files are not changed
    once landed. A batch costs what it brings, however much its days already hold.
    """
    spark.createDataFrame([], COMMIT).write.mode("ignore").parquet(f"{path}/{COMMITS}")
    feed = read_movements(spark, landing, files_per_batch, size_as="tamanho")
    writer = feed.writeStream.foreachBatch(lambda batch, at: _land(batch, batch_folder(spark, checkpoint, at), path))
    run_available(writer, checkpoint)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Movements of finished batches, with their file, batch and day. A folder that a killed batch left behind is not read."""
    schema = f"{MOVEMENT_DDL}, {ORIGIN} string, tamanho bigint, {LOT} string, situacao string, dia date"
    finished = commits(spark, path).filter("situacao = 'lido'").select(LOT).distinct()
    try:
        written = spark.read.schema(schema).parquet(path)
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        written = spark.createDataFrame([], schema)
    return written.filter("situacao = 'lido'").join(finished, LOT, "left_semi").drop("tamanho", "situacao")


def changed_files(spark: SparkSession, path: str) -> DataFrame:
    """(arquivo, tamanho, linhas): files that came again with another size; their rows lie beside the table's, in folders ``situacao=mudou``."""
    return commits(spark, path).filter("situacao = 'mudou'").select(ORIGIN, "tamanho", "linhas").distinct()


def daily_flow(movements: DataFrame, keys: Sequence[str] = ("fk_classe",), delay: str = "1 day") -> DataFrame:
    """Applications, redemptions and net per key and tumbling day, with a watermark.

    Works on a stream and on a table. A stream emits a day once the watermark
    has passed its end; later rows stay in the ledger table and reach gold there.
    """
    amount = numbers.money(F.col("valor"))
    kind = F.col("natureza_operacao")
    zero = F.lit(0).cast("decimal(19,2)")
    inflow = F.sum(F.when(kind == "A", amount).otherwise(zero))
    redemption = F.sum(F.when(kind == "R", amount).otherwise(zero))
    return (
        movements.withWatermark("data", delay)
        .groupBy(F.window("data", "1 day").alias("janela"), *keys)
        .agg(inflow.alias("_in"), redemption.alias("_out"), F.count(F.lit(1)).alias("movimentos"))
        .select(
            F.col("janela.start").cast("date").alias("dia"),
            *keys,
            F.col("_in").cast("double").alias("aplicacao"),
            F.col("_out").cast("double").alias("resgate"),
            (F.col("_in") - F.col("_out")).cast("double").alias("liquido"),
            "movimentos",
        )
    )


def daily_flow_table(
    spark: SparkSession, landing: str, path: str, checkpoint: str, keys: Sequence[str] = ("fk_classe",),
    files_per_batch: int | None = None,
) -> None:
    flows = daily_flow(read_movements(spark, landing, files_per_batch), keys)
    run_available(flows.writeStream.format("parquet").outputMode("append").option("path", path), checkpoint)


def flow_alerts(flows: DataFrame, equity: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Redemption alerts on daily flows, streamed or not. ``equity``: classe, patrimonio_liquido_dia."""
    daily = flows.select(F.col("fk_classe").alias("classe"), "dia", F.col("resgate").alias("resgate_dia"))
    return redemption_alert(daily.join(equity, "classe"), thresholds)
