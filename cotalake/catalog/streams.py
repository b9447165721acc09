"""Structured Streaming queries: land, process everything available, read the result back."""

from __future__ import annotations

from pyspark.sql import functions as F

from cotalake.catalog import sql
from cotalake.catalog.registry import query
from cotalake.operators import joins
from cotalake.plans import bindings
from cotalake.schemas import MOVEMENT
from cotalake.session import scratch_path
from cotalake.sinks import writers
from cotalake.streaming import incremental, movements, positions


def _land_movements(spark, sf_dir) -> str:
    """Every movement of the events table, as the feed's CSV files."""
    landing = scratch_path(spark, "landing")
    moves = bindings.movements(spark, sf_dir).withColumn("data", F.date_format("data", "yyyy-MM-dd HH:mm:ss"))
    writers.sink_csv(moves.select(*MOVEMENT.fieldNames()), landing, sep=",")
    return landing


_FEED = f"""WITH {sql.MOVEMENTS} SELECT sk_cliente AS fk_cliente, classe AS fk_classe, classe AS fk_subclasse,
    nat AS natureza_operacao, CAST(valor AS DOUBLE) AS valor, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS momento
    FROM mov, (SELECT unnest([1, 2]) AS vez)"""


@query("stream_ledger_ingest", _FEED)
def stream_ledger_ingest(spark, sf_dir):
    """Every movement twice in the feed: all must be kept. A second stream replays all files and must add nothing."""
    landing, path = scratch_path(spark, "landing"), scratch_path(spark, "ledger")
    moves = bindings.movements(spark, sf_dir).withColumn("data", F.date_format("data", "yyyy-MM-dd HH:mm:ss"))
    twice = moves.withColumn("_vez", F.explode(F.array(F.lit(1), F.lit(2))))
    writers.sink_csv(twice.select(*MOVEMENT.fieldNames()), landing, sep=",")
    for _ in range(2):
        movements.ledger_ingest(spark, landing, path, scratch_path(spark, "ckpt"))
    ledger = movements.read_ledger(spark, path)
    return ledger.select(
        "fk_cliente", "fk_classe", "fk_subclasse", "natureza_operacao", F.col("valor").cast("double"),
        F.date_format("data", "yyyy-MM-dd HH:mm:ss").alias("momento"),
    )


@query(
    "stream_daily_flow",
    f"""WITH {sql.MOVEMENTS}, d AS (
      SELECT date_trunc('second', ts) AS s, * FROM mov)
    SELECT {sql.date_key('s')} AS sk_data, classe AS fk_classe,
      CAST(sum(CASE WHEN nat = 'A' THEN valor ELSE 0 END) AS DOUBLE) AS aplicacao,
      CAST(sum(CASE WHEN nat = 'R' THEN valor ELSE 0 END) AS DOUBLE) AS resgate,
      CAST(sum(CASE WHEN nat = 'A' THEN valor ELSE -valor END) AS DOUBLE) AS liquido, count(*) AS movimentos
    FROM d WHERE date_trunc('day', s) + INTERVAL 1 DAY <= (SELECT max(s) - INTERVAL 1 DAY FROM d) GROUP BY 1, 2""",
)
def stream_daily_flow(spark, sf_dir):
    """Days the watermark has closed; the last ones stay open."""
    landing, path, checkpoint = _land_movements(spark, sf_dir), scratch_path(spark, "flow"), scratch_path(spark, "ckpt")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")  # a day is a UTC day
    try:
        movements.daily_flow_table(spark, landing, path, checkpoint)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    flows = spark.read.parquet(path)
    return flows.select(
        bindings.gold.dates.date_key(F.col("dia")).alias("sk_data"), "fk_classe", "aplicacao", "resgate", "liquido", "movimentos"
    )


@query("stream_incremental_gold", f"WITH {sql.FACT} SELECT * FROM fct")
def stream_incremental_gold(spark, sf_dir):
    """The first wave lacks one year, which arrives late; the result equals a full rebuild."""
    silver, gold_path, summary = (scratch_path(spark, n) for n in ("silver", "gold", "summary"))
    checkpoint = scratch_path(spark, "ckpt")
    report = bindings.daily_report(spark, sf_dir).withColumn("_key", bindings.gold.dates.date_key(F.col("DT_COMPTC")))
    late = F.year("DT_COMPTC") == 1997
    for wave in (~late, late):
        rows = writers.by_month(report.filter(wave), "_key").drop("_key")
        rows.write.mode("append").partitionBy("ano_mes").parquet(silver)
        dim = bindings.dim_fundo(spark, sf_dir)
        incremental.incremental_gold(spark, silver, dim, gold_path, summary, checkpoint)
    return spark.read.parquet(gold_path).select(
        "sk_data", "sk_fundo", joins.CNPJ, "patrimonio_liquido_dia", "captacao_dia", "resgate_dia", "cotistas_dia",
        "fluxo_liquido_dia", "variacao_pl_dia_pct", "variacao_cotistas_dia_pct", "flag_base_real",
    )


@query(
    "client_position_refresh",
    f"""WITH {sql.FUND_POSITION} SELECT sk_cliente, sk_fundo, sk_data, aporte_dia, resgate_dia, saldo_dia, valor_investido,
    dias_sem_movimentacao FROM pos WHERE dias_sem_movimentacao IS NOT NULL""",
)
def client_position_refresh(spark, sf_dir):
    """The movements of one week arrive last; the stored positions then equal those of all movements at once."""
    path, keys = scratch_path(spark, "positions"), ["sk_cliente", "sk_fundo"]
    moves = bindings.movements(spark, sf_dir).withColumnsRenamed({"fk_cliente": "sk_cliente", "fk_classe": "sk_fundo"})
    week = F.trunc(F.col("data"), "week")
    late = moves.agg(F.trunc(F.min("data") + F.expr("INTERVAL 14 DAYS"), "week")).first()[0]
    positions.refresh_positions(spark, moves.filter(week != F.lit(late)), path, keys, every="week")
    positions.refresh_positions(spark, moves, path, keys, since=late, every="week")
    amounts = ["aporte_dia", "resgate_dia", "saldo_dia", "valor_investido"]
    return positions.read_positions(spark, path).select(
        *keys, "sk_data", *[F.col(c).cast("double").alias(c) for c in amounts], "dias_sem_movimentacao"
    )
