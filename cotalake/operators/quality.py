"""Data-quality checks: every check of a table is one conditional count in a single pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotalake import schemas
from cotalake.functions import dates, text
from cotalake.functions.numbers import missing
from cotalake.operators import joins
from cotalake.operators.resolve import resolve_column


def violations(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """One row per check with its rows and violations. A check that is null for a row counts as violated."""
    counts = [F.count_if(F.coalesce(bad, F.lit(True))).alias(f"_bad{i}") for i, bad in enumerate(checks.values())]
    entries = [
        F.struct(F.lit(name).alias("regra"), F.col("_rows").alias("registros"), F.col(f"_bad{i}").alias("violacoes"))
        for i, name in enumerate(checks)
    ]
    return df.agg(F.count(F.lit(1)).alias("_rows"), *counts).select(F.inline(F.array(*entries)))


def flow_mismatch() -> Column:
    """Net flow differs from inflow minus redemption; null when one of the three is missing."""
    return F.col("fluxo_liquido_dia") != F.col("captacao_dia") - F.col("resgate_dia")


def dq_reconcile_flow(fact: DataFrame) -> DataFrame:
    """Mismatches and rows that cannot be compared, apart; the table passes only if both are 0."""
    incomplete = F.col("captacao_dia").isNull() | F.col("resgate_dia").isNull() | F.col("fluxo_liquido_dia").isNull()
    return fact.agg(
        F.count(F.lit(1)).alias("registros"),
        F.count_if(flow_mismatch()).alias("divergentes"),
        F.count_if(incomplete).alias("incompletos"),
    ).withColumn("aprovado", (F.col("divergentes") == 0) & (F.col("incompletos") == 0))


def dq_negative_pl(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count(F.lit(1)).alias("registros"), F.count_if(F.col("patrimonio_liquido_dia") < 0).alias("negativos")
    ).withColumn("aprovado", F.col("negativos") == 0)


def dq_score_range(aggregate: DataFrame, score: str = "score_risco_fundo") -> DataFrame:
    """A missing score fails, like one outside [0, 100]."""
    value = F.col(score)
    outside = missing(value) | (value < 0) | (value > 100)
    return aggregate.agg(
        F.count(F.lit(1)).alias("registros"), F.count_if(outside).alias("fora_da_faixa")
    ).withColumn("aprovado", F.col("fora_da_faixa") == 0)


def fact_checks(fact: DataFrame) -> DataFrame:
    return violations(
        fact,
        {
            "reconciliacao_fluxo": flow_mismatch(),
            "patrimonio_negativo": F.coalesce(F.col("patrimonio_liquido_dia") < 0, F.lit(False)),
        },
    )


def aggregate_checks(aggregate: DataFrame) -> DataFrame:
    score = F.col("score_risco_fundo")
    return violations(aggregate, {"faixa_score": missing(score) | (score < 0) | (score > 100)})


def dq_status(checks: DataFrame) -> DataFrame:
    """success/200, partial/207 with the failed rules listed, or error/404 when the tables were empty."""
    summary = checks.agg(
        F.count(F.lit(1)).alias("regras"),
        F.coalesce(F.max("registros"), F.lit(0)).alias("registros"),
        F.count_if(F.col("violacoes") > 0).alias("falhas"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("violacoes") > 0, F.col("regra")))), ",").alias("erros"),
    )
    empty, failed = F.col("registros") == 0, F.col("falhas") > 0
    return summary.withColumns(
        {
            "status": F.when(empty, "error").when(failed, "partial").otherwise("success"),
            "status_code": F.when(empty, 404).when(failed, 207).otherwise(200),
        }
    )


def dq_simulation_rules(
    positions: DataFrame, risk: DataFrame, equity: DataFrame, scale: float = 1.0, tolerance: float = 0.0
) -> DataFrame:
    """No negative balance; churn within [0, 1]; positions of a fund and day close to its scaled net assets.

    ``positions``: sk_fundo, sk_data, saldo_dia. ``risk``: prob_churn. ``equity``: sk_fundo, sk_data, patrimonio. A fund's day
    breaks the third rule if its balances differ from ``scale`` times its net assets by more than ``tolerance`` of that;
    a day without net assets breaks it as well. Positions are summed per fund and day before the join.
    """
    churn, key = F.col("prob_churn"), ["sk_fundo", "sk_data"]
    held = positions.groupBy(*key).agg(F.sum(F.col("saldo_dia").cast("decimal(19,2)")).alias("saldo"))
    compared = held.join(equity.select(*key, "patrimonio"), key, "left")
    due = F.col("patrimonio") * F.lit(float(scale))
    return (
        violations(positions, {"saldo_negativo": F.col("saldo_dia") < 0})
        .unionByName(violations(risk, {"churn_fora_0_1": missing(churn) | (churn < 0) | (churn > 1)}))
        .unionByName(
            violations(
                compared,
                {"posicao_longe_do_pl": F.abs(F.col("saldo").cast("double") - due) > F.lit(float(tolerance)) * F.abs(due)},
            )
        )
    )


def report_losses(report: DataFrame, dim: DataFrame | None = None, registry: DataFrame | None = None) -> DataFrame:
    """What the fact builder will not use of a daily report, each row under its first reason.

    With ``dim`` also rows whose CNPJ has no dimension row: ``chave_colidida`` if ``registry`` holds the CNPJ and it lost its
    surrogate key to another, else ``sem_cadastro``. Rows are counted per CNPJ and reason before they are joined.
    """
    cnpj = F.col(f"`{resolve_column(report.columns, schemas.REPORT_CNPJ_CLOUD)}`")
    name = resolve_column(report.columns, schemas.REPORT_DATE)
    day = F.col(f"`{name}`")
    parsed = dates.parse_report_date(day) if dict(report.dtypes)[name] == "string" else day.cast("date")
    digits = text.normalize_cnpj(cnpj)
    reason = (
        F.when(cnpj.isNull(), "sem_cnpj")
        .when(F.length(digits) == 0, "cnpj_sem_digitos")
        .when(parsed.isNull(), "data_invalida")
        .otherwise("aproveitados")
    )
    kinds = ["sem_cnpj", "cnpj_sem_digitos", "data_invalida"]
    counted = report.select(reason.alias("_reason"), digits.alias("_cnpj"))
    if dim is None:
        counted = counted.withColumn("_n", F.lit(1))
    else:
        kinds += ["sem_cadastro", "chave_colidida"]
        counted = counted.groupBy("_reason", "_cnpj").agg(F.count(F.lit(1)).alias("_n"))
        kept = dim.select(F.col(joins.CNPJ).alias("_cnpj"), F.lit(True).alias("_kept")).distinct()
        counted = counted.join(kept, "_cnpj", "left")
        known = F.lit(False)
        if registry is not None:
            listed = F.col(f"`{resolve_column(registry.columns, schemas.CLASS_CNPJ)}`")
            counted = counted.join(
                registry.select(text.normalize_cnpj(listed).alias("_cnpj"), F.lit(True).alias("_known")).distinct(), "_cnpj", "left"
            )
            known = F.col("_known").isNotNull()
        lost = (F.col("_reason") == "aproveitados") & F.col("_kept").isNull()
        counted = counted.withColumn(
            "_reason", F.when(lost & known, "chave_colidida").when(lost, "sem_cadastro").otherwise(F.col("_reason"))
        )
    return counted.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("registros"),
        *[
            F.coalesce(F.sum(F.when(F.col("_reason") == k, F.col("_n"))), F.lit(0)).cast("long").alias(k)
            for k in (*kinds, "aproveitados")
        ],
    )
