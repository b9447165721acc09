"""Client positions, risk and churn.

Movements are reduced to one row per client and day before anything else, so a
client's group never exceeds the number of calendar days, however many
movements that client has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cotalake.functions import dates, numbers

# Score weights, level cuts and labels.
WEIGHTS = {
    "resgates_30d_pct": 0.35,
    "queda_saldo_30d_pct": 0.25,
    "inatividade_dias": 0.20,
    "volatilidade_fluxo": 0.20,
}
LEVEL_CUTS = [45, 70]
LEVELS = ["estavel", "atencao", "critico"]
AT_RISK_FROM = 45.0
TREND_DAYS = 7
TREND_BAND = 1.0
AGE_EDGES = [20, 30, 40, 50, 60, 100]
AGE_LABELS = ["21-30", "31-40", "41-50", "51-60", "60+"]


def age_band(age: Column) -> Column:
    return numbers.right_closed_band(age, AGE_EDGES, AGE_LABELS)


def daily_flows(movements: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inflow ('A') and redemption ('R') per key and day, in exact cents."""
    amount = numbers.money(F.col("valor"))
    zero = F.lit(0).cast("decimal(19,2)")
    kind = F.col("natureza_operacao")
    return movements.groupBy(*keys, F.col("data").cast("date").alias("dia")).agg(
        F.sum(F.when(kind == "A", amount).otherwise(zero)).alias("aporte_dia"),
        F.sum(F.when(kind == "R", amount).otherwise(zero)).alias("resgate_dia"),
    )


def client_daily_position(movements: DataFrame, keys: Sequence[str] = ("sk_cliente",)) -> DataFrame:
    """One row per key and calendar day with flows, applications so far, running balance and last movement.

    The calendar is the movements' own date range. Windows run over days with
    movements only; each of those rows then unfolds, in place, into the quiet
    days up to the next one. No calendar join and no second shuffle is needed.
    """
    flows = daily_flows(movements, keys)
    span = movements.select(F.col("data").cast("date").alias("d"))
    first_day = span.agg(F.min("d")).scalar()
    last_day = span.agg(F.max("d")).scalar()
    ordered = Window.partitionBy(*keys).orderBy("dia")
    balance = F.sum(F.col("aporte_dia") - F.col("resgate_dia")).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    invested = F.sum("aporte_dia").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    until = F.date_sub(F.coalesce(F.lead("dia").over(ordered), F.date_add(last_day, 1)), 1)
    moved = flows.withColumns(
        {"saldo_dia": balance, "valor_investido": invested, "_until": until, "_place": F.row_number().over(ordered)}
    )
    own_days = F.sequence(F.col("dia"), F.col("_until"))
    quiet_start = F.when(
        (F.col("_place") == 1) & (F.col("dia") > first_day), F.sequence(first_day, F.date_sub(F.col("dia"), 1))
    ).otherwise(F.array().cast("array<date>"))
    day = F.explode(F.concat(quiet_start, own_days)).alias("data")
    unfolded = moved.select(*keys, "dia", "aporte_dia", "resgate_dia", "saldo_dia", "valor_investido", day)
    before, same = F.col("data") < F.col("dia"), F.col("data") == F.col("dia")
    zero = F.lit(0).cast("decimal(19,2)")
    return unfolded.select(
        *keys,
        "data",
        dates.date_key(F.col("data")).alias("sk_data"),
        F.when(same, F.col("aporte_dia")).otherwise(zero).alias("aporte_dia"),
        F.when(same, F.col("resgate_dia")).otherwise(zero).alias("resgate_dia"),
        F.when(before, zero).otherwise(F.col("saldo_dia")).alias("saldo_dia"),
        F.when(before, zero).otherwise(F.col("valor_investido")).alias("valor_investido"),
        F.when(~before, F.datediff("data", "dia")).alias("dias_sem_movimentacao"),
        F.lit(False).alias("flag_base_real"),
    )


def position_after(
    movements: DataFrame, opening: DataFrame, first_day: Column, last_day: Column, keys: Sequence[str] = ("sk_cliente",)
) -> DataFrame:
    """Positions of ``first_day`` to ``last_day`` from the balances of the evening before.

    ``opening`` has one row per key: saldo_dia, valor_investido and ultimo_mov, the day of the last movement. Movements of
    other days are not looked at. A key's rows begin with its first movement; from there on they equal those of
    :func:`client_daily_position` over all movements. A key without movements costs one row before it unfolds.
    """
    zero = F.lit(0).cast("decimal(19,2)")
    day = F.col("data").cast("date")
    flows = daily_flows(movements.filter(day.between(first_day, last_day)), keys).withColumns(
        {"_saldo": F.col("aporte_dia") - F.col("resgate_dia"), "_investido": F.col("aporte_dia"), "_mov": F.col("dia")}
    )
    carried = opening.select(
        *keys,
        F.date_sub(first_day, 1).alias("dia"),
        zero.alias("aporte_dia"),
        zero.alias("resgate_dia"),
        F.col("saldo_dia").alias("_saldo"),
        F.col("valor_investido").alias("_investido"),
        F.col("ultimo_mov").alias("_mov"),
    )
    ordered = Window.partitionBy(*keys).orderBy("dia")
    upto = ordered.rowsBetween(Window.unboundedPreceding, 0)
    moved = flows.unionByName(carried).withColumns(
        {
            "saldo_dia": F.sum("_saldo").over(upto),
            "valor_investido": F.sum("_investido").over(upto),
            "_from": F.greatest(F.col("dia"), first_day),
            "_until": F.date_sub(F.coalesce(F.lead("dia").over(ordered), F.date_add(last_day, 1)), 1),
        }
    )
    unfolded = moved.filter("_until >= _from").withColumn("data", F.explode(F.sequence("_from", "_until")))
    same = F.col("data") == F.col("dia")
    return unfolded.select(
        *keys,
        "data",
        dates.date_key(F.col("data")).alias("sk_data"),
        F.when(same, F.col("aporte_dia")).otherwise(zero).alias("aporte_dia"),
        F.when(same, F.col("resgate_dia")).otherwise(zero).alias("resgate_dia"),
        "saldo_dia",
        "valor_investido",
        F.datediff("data", "_mov").alias("dias_sem_movimentacao"),
        F.lit(False).alias("flag_base_real"),
    )


def closing_balances(position: DataFrame, keys: Sequence[str] = ("sk_cliente",)) -> DataFrame:
    """What :func:`position_after` needs of a day, from that day's rows."""
    return position.select(
        *keys, "saldo_dia", "valor_investido", F.date_sub("data", F.col("dias_sem_movimentacao")).alias("ultimo_mov")
    )


def with_history(position: DataFrame, keys: Sequence[str] = ("sk_cliente",), days: int = 30) -> DataFrame:
    """Adds the 30-day balance change, redemption share and flow deviation.

    The input is dense, one row per day, so ``days`` rows back is ``days`` days
    back. The partitioning by key of the position is kept, so no shuffle occurs.
    """
    ordered = Window.partitionBy(*keys).orderBy("data")
    last_days = ordered.rowsBetween(-(days - 1), 0)
    net = (F.col("aporte_dia") - F.col("resgate_dia")).cast("double")
    looked_up = position.withColumns(
        {
            "_earlier": F.lag(F.col("saldo_dia").cast("double"), days).over(ordered),
            "_gross": F.sum(F.col("aporte_dia") + F.col("resgate_dia")).over(last_days).cast("double"),
            "_redeemed": F.sum("resgate_dia").over(last_days).cast("double"),
            "volatilidade_fluxo": F.stddev_samp(net).over(last_days),
            "_day_number": F.row_number().over(ordered),
        }
    )
    return looked_up.withColumns(
        {
            "variacao_saldo_30d_pct": numbers.ratio_change(F.col("saldo_dia").cast("double"), F.col("_earlier")),
            "resgates_30d_pct": F.when(
                F.col("_gross") > 0, F.col("_redeemed") / F.when(F.col("_gross") > 0, F.col("_gross"))
            ).otherwise(F.lit(0.0)),
        }
    ).drop("_earlier", "_gross", "_redeemed")


def _z(term: str) -> Column:
    """Standard score within the day; 0 where all clients are equal."""
    deviation = F.col(f"_dev_{term}")
    return F.when(deviation > 0, (F.col(term) - F.col(f"_avg_{term}")) / F.when(deviation > 0, deviation)).otherwise(
        F.lit(0.0)
    )


def client_risk(history: DataFrame, keys: Sequence[str] = ("sk_cliente",)) -> DataFrame:
    """Score, churn probability, level, value at risk, trend and main reason per client and day.

    Terms are standardized against all clients of the same day. The statistics
    come from one aggregation with map-side combine and hold one row per
    calendar day, which bounds their broadcast; there is no window over all
    clients.
    """
    change = F.col("variacao_saldo_30d_pct")
    drop = F.when(change.isNotNull() & (change < 0), F.least(-change, F.lit(1.0))).otherwise(F.lit(0.0))
    terms = history.withColumns(
        {
            "queda_saldo_30d_pct": drop,
            "inatividade_dias": F.coalesce("dias_sem_movimentacao", "_day_number").cast("double"),
            "volatilidade_fluxo": F.coalesce(F.col("volatilidade_fluxo"), F.lit(0.0)),
        }
    )
    statistics = terms.groupBy("data").agg(
        *[
            f(F.round(F.col(t), 6)).alias(f"_{n}_{t}")
            for t in WEIGHTS
            for n, f in (("avg", F.avg), ("dev", F.stddev_pop))
        ]
    )
    by_day = F.broadcast(statistics.withColumnRenamed("data", "_data"))
    joined = terms.join(by_day, F.col("data") == F.col("_data"))
    for term in WEIGHTS:
        clean_dev = F.when(F.col(f"_dev_{term}") > 1e-9, F.col(f"_dev_{term}")).otherwise(F.lit(0.0))
        joined = joined.withColumn(f"_dev_{term}", clean_dev)
    parts = {t: F.round(_z(t) * weight, 6) for t, weight in WEIGHTS.items()}
    raw = sum(list(parts.values())[1:], list(parts.values())[0])
    score = F.round(numbers.clip(F.lit(50.0) + raw * 10, 0, 100), 6)
    # The largest term wins; of equal ones the first listed, hence the descending position.
    reason = F.array_max(
        F.array(
            *[
                F.struct(p.alias("v"), F.lit(-i).alias("i"), F.lit(t).alias("t"))
                for i, (t, p) in enumerate(parts.items())
            ]
        )
    )["t"]
    scored = joined.select(
        *keys,
        "data",
        "sk_data",
        "saldo_dia",
        F.lit(False).alias("flag_base_real"),
        F.col("dias_sem_movimentacao").alias("ultimo_mov_dias"),
        *[F.col(t) for t in WEIGHTS],
        score.alias("score_risco"),
        reason.alias("motivo_risco_dominante"),
    )
    churn = churn_probability(F.col("score_risco"))
    leveled = scored.withColumns(
        {
            "prob_churn": churn,
            "nivel_risco": client_risk_level(F.col("score_risco")),
            "valor_em_risco": F.round(F.greatest(F.col("saldo_dia").cast("double"), F.lit(0.0)) * churn, 2),
        }
    )
    return risk_trend(leveled, keys)


def churn_probability(score: Column) -> Column:
    return F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-(score - F.lit(50.0)) / F.lit(10.0))), 6)


def client_risk_level(score: Column) -> Column:
    return numbers.left_closed_band(score, LEVEL_CUTS, LEVELS)


def risk_trend(risk: DataFrame, keys: Sequence[str] = ("sk_cliente",)) -> DataFrame:
    """Against the score seven days earlier, with a dead band; stable when there is none."""
    ordered = Window.partitionBy(*keys).orderBy("data")
    change = F.round(F.col("score_risco") - F.lag("score_risco", TREND_DAYS).over(ordered), 6)
    return risk.withColumn(
        "tendencia_risco",
        F.when(change > TREND_BAND, "subindo").when(change < -TREND_BAND, "caindo").otherwise("estavel"),
    )


def value_at_risk_clients(risk: DataFrame) -> DataFrame:
    """Per day: clients from the attention threshold on, and their value at risk."""
    at_risk = F.col("score_risco") >= AT_RISK_FROM
    return risk.groupBy("sk_data").agg(
        F.count_if(at_risk).alias("clientes_em_risco"),
        F.coalesce(numbers.money_sum(F.when(at_risk, F.col("valor_em_risco"))), F.lit(0.0)).alias("valor_sob_risco"),
    )


def relationship_summary(risk: DataFrame, segments: DataFrame) -> DataFrame:
    """Per reference date and segment. ``segments``: sk_cliente, segmento, one row per client.

    The risk table has one row per client and day, so counting rows counts
    clients and every measure is combined before the shuffle.
    """
    at_risk = F.col("score_risco") >= AT_RISK_FROM
    return (
        risk.join(segments, "sk_cliente", "left")
        .groupBy(
            F.col("sk_data").alias("data_referencia"), F.coalesce("segmento", F.lit("sem_segmento")).alias("segmento")
        )
        .agg(
            F.count(F.lit(1)).alias("total_clientes"),
            F.count_if(at_risk).alias("clientes_em_risco"),
            F.count_if(F.col("nivel_risco") == "critico").alias("clientes_criticos"),
            F.coalesce(numbers.money_sum(F.when(at_risk, F.col("valor_em_risco"))), F.lit(0.0)).alias(
                "valor_sob_risco"
            ),
            (F.avg("prob_churn") * 100).alias("churn_estimado_pct"),
            F.avg("score_risco").alias("risco_medio"),
        )
    )


def risk_distribution(risk: DataFrame) -> DataFrame:
    return risk.groupBy("sk_data", "nivel_risco").agg(F.count(F.lit(1)).alias("clientes"))


def risk_weekly_trend(risk: DataFrame) -> DataFrame:
    week = F.date_trunc("week", F.col("data").cast("timestamp_ntz")).cast("date")
    return risk.groupBy(dates.date_key(week).alias("semana")).agg(F.avg("score_risco").alias("risco_medio"))


def top_clients_at_risk(risk: DataFrame, n: int = 20, day: Column | None = None) -> DataFrame:
    """Top N by value at risk on ``day`` (default: the last one); a top-N sort, not a full sort.

    Pass the day key where it is known: finding the last day reads the risk table once more.
    """
    last = risk.agg(F.max("sk_data")).scalar() if day is None else day
    return (
        risk.filter(F.col("sk_data") == last)
        .select("sk_cliente", "sk_data", "score_risco", "nivel_risco", "valor_em_risco")
        .orderBy(F.desc("valor_em_risco"), F.asc("sk_cliente"))
        .limit(n)
    )
