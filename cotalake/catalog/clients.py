"""Client positions, risk and relationship KPIs."""

from __future__ import annotations

from pyspark.sql import functions as F

from cotalake.catalog import sql
from cotalake.catalog.registry import query
from cotalake.functions import dates
from cotalake.operators import relationship as rel
from cotalake.plans import bindings


def _position(spark, sf_dir):
    moves = bindings.movements(spark, sf_dir).withColumnRenamed("fk_cliente", "sk_cliente")
    return rel.client_daily_position(moves)


def _risk(spark, sf_dir):
    return rel.client_risk(rel.with_history(_position(spark, sf_dir)))


def _doubles(df, *columns: str):
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


_FUND_KEYS = ["sk_cliente", "sk_fundo"]


def _fund_position(spark, sf_dir):
    """Positions per client and fund; the class of a movement is its fund."""
    moves = bindings.movements(spark, sf_dir).withColumnsRenamed({"fk_cliente": "sk_cliente", "fk_classe": "sk_fundo"})
    return rel.client_daily_position(moves, _FUND_KEYS)


@query(
    "client_daily_position",
    f"""WITH {sql.FUND_POSITION} SELECT sk_cliente, sk_fundo, sk_data, aporte_dia, resgate_dia, saldo_dia, valor_investido,
    false AS flag_base_real FROM pos""",
)
def client_daily_position(spark, sf_dir):
    amounts = ["aporte_dia", "resgate_dia", "saldo_dia", "valor_investido"]
    position = _fund_position(spark, sf_dir).select(*_FUND_KEYS, "sk_data", *amounts, "flag_base_real")
    return _doubles(position, *amounts)


@query("days_without_movement", f"WITH {sql.FUND_POSITION} SELECT sk_cliente, sk_fundo, sk_data, dias_sem_movimentacao FROM pos")
def days_without_movement(spark, sf_dir):
    return _fund_position(spark, sf_dir).select(*_FUND_KEYS, "sk_data", "dias_sem_movimentacao")


@query(
    "balance_change_30d",
    f"""WITH {sql.FUND_POSITION}, antes AS (SELECT *, lag(saldo_dia, 30) OVER c AS saldo_30, lag(saldo_dia, 7) OVER c AS saldo_7
      FROM pos WINDOW c AS (PARTITION BY sk_cliente, sk_fundo ORDER BY dia))
    SELECT sk_cliente, sk_fundo, sk_data, {sql.ratio('saldo_dia', 'saldo_30')} AS variacao_saldo_30d_pct,
    {sql.ratio('saldo_dia', 'saldo_7')} AS variacao_saldo_7d_pct FROM antes""",
)
def balance_change_30d(spark, sf_dir):
    """The events span 30 days, so a 7-day change is shown beside the 30-day one."""
    month = rel.with_history(_fund_position(spark, sf_dir), _FUND_KEYS).select(
        *_FUND_KEYS, "data", "sk_data", "aporte_dia", "resgate_dia", "saldo_dia", F.col("variacao_saldo_30d_pct").alias("mes")
    )
    week = rel.with_history(month, _FUND_KEYS, days=7).withColumnRenamed("variacao_saldo_30d_pct", "variacao_saldo_7d_pct")
    return week.select(*_FUND_KEYS, "sk_data", F.col("mes").alias("variacao_saldo_30d_pct"), "variacao_saldo_7d_pct")


@query(
    "flow_volatility",
    f"WITH {sql.HISTORY} SELECT sk_cliente, sk_data, round(volatilidade_fluxo, 6) AS volatilidade_fluxo FROM hist",
)
def flow_volatility(spark, sf_dir):
    history = rel.with_history(_position(spark, sf_dir))
    return history.select("sk_cliente", "sk_data", F.round("volatilidade_fluxo", 6).alias("volatilidade_fluxo"))


_RISK_KEYS = "sk_cliente, sk_data"


@query("client_risk_score", f"WITH {sql.RISK} SELECT {_RISK_KEYS}, score_risco FROM risco")
def client_risk_score(spark, sf_dir):
    return _risk(spark, sf_dir).select("sk_cliente", "sk_data", "score_risco")


@query("churn_probability", f"WITH {sql.RISK} SELECT {_RISK_KEYS}, prob_churn FROM risco")
def churn_probability(spark, sf_dir):
    return _risk(spark, sf_dir).select("sk_cliente", "sk_data", "prob_churn")


@query("client_risk_level", f"WITH {sql.RISK} SELECT {_RISK_KEYS}, nivel_risco FROM risco")
def client_risk_level(spark, sf_dir):
    return _risk(spark, sf_dir).select("sk_cliente", "sk_data", "nivel_risco")


@query("risk_trend", f"WITH {sql.RISK} SELECT {_RISK_KEYS}, tendencia_risco FROM risco")
def risk_trend(spark, sf_dir):
    return _risk(spark, sf_dir).select("sk_cliente", "sk_data", "tendencia_risco")


@query("dominant_risk_reason", f"WITH {sql.RISK} SELECT {_RISK_KEYS}, motivo_risco_dominante FROM risco")
def dominant_risk_reason(spark, sf_dir):
    return _risk(spark, sf_dir).select("sk_cliente", "sk_data", "motivo_risco_dominante")


@query(
    "value_at_risk_clients",
    f"""WITH {sql.RISK} SELECT sk_data, count(*) FILTER (WHERE score_risco >= 45) AS clientes_em_risco,
    CAST(coalesce(sum(CASE WHEN score_risco >= 45 THEN CAST(valor_em_risco AS DECIMAL(19,2)) END), 0) AS DOUBLE) AS valor_sob_risco FROM risco GROUP BY 1""",
)
def value_at_risk_clients(spark, sf_dir):
    return rel.value_at_risk_clients(_risk(spark, sf_dir))


@query(
    "relationship_summary",
    f"""WITH {sql.RISK} SELECT sk_data AS data_referencia, coalesce(c_mktsegment, 'sem_segmento') AS segmento,
    count(DISTINCT sk_cliente) AS total_clientes, count(*) FILTER (WHERE score_risco >= 45) AS clientes_em_risco,
    count(*) FILTER (WHERE nivel_risco = 'critico') AS clientes_criticos,
    CAST(coalesce(sum(CASE WHEN score_risco >= 45 THEN CAST(valor_em_risco AS DECIMAL(19,2)) END), 0) AS DOUBLE) AS valor_sob_risco,
    round(avg(prob_churn) * 100, 2) AS churn_estimado_pct, round(avg(score_risco), 3) AS risco_medio
    FROM risco LEFT JOIN customer ON c_custkey = sk_cliente GROUP BY 1, 2""",
)
def relationship_summary(spark, sf_dir):
    summary = rel.relationship_summary(_risk(spark, sf_dir), bindings.segments(spark, sf_dir))
    return summary.withColumns(
        {
            "churn_estimado_pct": F.round("churn_estimado_pct", 2),
            "risco_medio": F.round("risco_medio", 3),
        }
    )


@query("risk_distribution", f"WITH {sql.RISK} SELECT sk_data, nivel_risco, count(*) AS clientes FROM risco GROUP BY 1, 2")
def risk_distribution(spark, sf_dir):
    return rel.risk_distribution(_risk(spark, sf_dir))


@query(
    "risk_weekly_trend",
    f"""WITH {sql.RISK} SELECT {sql.date_key("date_trunc('week', dia)")} AS semana, round(avg(score_risco), 3) AS risco_medio
    FROM risco GROUP BY 1""",
)
def risk_weekly_trend(spark, sf_dir):
    weekly = rel.risk_weekly_trend(_risk(spark, sf_dir))
    return weekly.withColumn("risco_medio", F.round("risco_medio", 3))


@query(
    "top_clients_at_risk",
    f"""WITH {sql.RISK} SELECT sk_cliente, sk_data, score_risco, nivel_risco, valor_em_risco
    FROM risco WHERE sk_data = (SELECT max(sk_data) FROM risco) ORDER BY risco.valor_em_risco DESC, sk_cliente LIMIT 20""",
)
def top_clients_at_risk(spark, sf_dir):
    last = bindings.movements(spark, sf_dir).agg(dates.date_key(F.max("data").cast("date"))).scalar()
    return rel.top_clients_at_risk(_risk(spark, sf_dir), 20, last)
