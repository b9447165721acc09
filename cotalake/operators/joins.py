"""Fact to dimension joins and related lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cotalake.functions import numbers, text

CNPJ = "cnpj_fundo_classe_norm"


def join_fact_dim(
    fact: DataFrame, dim: DataFrame, key: str = CNPJ, bring: Sequence[str] = ("sk_fundo",), unique_fund_key: bool = False
) -> DataFrame:
    """Bring dimension columns to the fact; rows without a match go.

    By default Spark decides: it broadcasts a dimension whose size it knows to
    be small and otherwise shuffles, splitting a hot key (adaptive skew join).
    ``unique_fund_key`` states that ``dim`` holds each ``sk_fundo`` once, hence
    at most 1,000,000 rows; then it is broadcast and the fact is not shuffled.
    """
    side = dim.select(key, *bring)
    return fact.join(F.broadcast(side) if unique_fund_key else side, key, "inner")


def unmatched_report(fact: DataFrame, dim: DataFrame, key: str = CNPJ) -> DataFrame:
    """Fact rows that find no dimension row."""
    return fact.join(dim.select(key), key, "left_anti")


def key_collision_report(registry: DataFrame, cnpj: str = CNPJ) -> DataFrame:
    """Surrogate keys shared by several CNPJs: all but one of them are lost to the key dedupe."""
    return (
        registry.select(F.col(cnpj).alias("_cnpj"))
        .distinct()
        .groupBy(text.hash_key(F.col("_cnpj")).alias("sk_fundo"))
        .agg(F.count(F.lit(1)).alias("cnpjs"), F.min("_cnpj").alias("menor_cnpj"), F.max("_cnpj").alias("maior_cnpj"))
        .filter("cnpjs > 1")
    )


def summary_by_segment(fact: DataFrame, dim: DataFrame, key: str, segment: str, value: str) -> DataFrame:
    """Count, mean and sum of a measure per dimension attribute.

    The measure is summed per key before the join, so the join sees one row per
    key and a hot key costs nothing extra.
    """
    measure = F.col(value)
    per_key = fact.groupBy(key).agg(
        F.count(value).alias("_n"), F.sum(numbers.exact(measure)).alias("_exact"), F.sum(numbers.beyond(measure)).alias("_beyond")
    )
    return (
        per_key.join(dim.select(key, segment), key)
        .groupBy(segment)
        .agg(F.sum("_n").alias("quantidade"), numbers.total(F.sum("_exact"), F.sum("_beyond")).alias("soma"))
        .withColumn("media", F.col("soma") / F.col("quantidade"))
    )


def holding_valuation(holdings: DataFrame, prices: DataFrame) -> DataFrame:
    """Value per client: shares held times the newest unit price.

    ``holdings``: cliente, ativo, quantidade. ``prices``: ativo, preco,
    momento (an orderable number). Both sides are reduced before they meet: holdings to one
    row per client and asset, prices to one row per asset.
    """
    held = holdings.groupBy("cliente", "ativo").agg(F.sum(F.col("quantidade").cast("decimal(17,3)")).alias("quantidade"))
    latest = prices.groupBy("ativo").agg(F.max_by("preco", "momento").alias("preco"))
    value = F.col("quantidade").cast("decimal(17,3)") * F.col("preco").cast("decimal(19,2)")
    return (
        held.join(latest, "ativo")
        .groupBy("cliente")
        .agg(F.count(F.lit(1)).alias("ativos"), F.sum(value).cast("double").alias("valor_carteira"))
    )


def redemption_alert(
    daily: DataFrame, thresholds: DataFrame, name: str = "ALTA_RESGATE_PORCENTAGEM"
) -> DataFrame:
    """Days on which redemption / net assets of a class or subclass exceeds the stored threshold.

    A threshold with ``fk_registro_subclasse`` holds for that subclass of ``daily`` only, one without for the whole class where
    the subclass has none of its own; of several for the same the lowest counts, so a day gives one alert. The threshold is
    text; one that is not a number raises no alert.
    """
    sub = F.col("fk_registro_subclasse") if "fk_registro_subclasse" in thresholds.columns else F.lit(None)
    limit = thresholds.filter(F.col("nome") == F.lit(name)).select(
        F.col("fk_registro_classe").alias("classe"), sub.cast("string").alias("_sub"), F.col("valor").try_cast("double").alias("limite")
    )
    limit = limit.filter("limite is not null").groupBy("classe", "_sub").agg(F.min("limite").alias("limite"))
    ratio = F.when(F.col("patrimonio_liquido_dia") > 0, F.col("resgate_dia") / F.col("patrimonio_liquido_dia"))
    rows = daily.withColumn("proporcao_resgate", ratio).filter(F.col("proporcao_resgate").isNotNull())
    whole = limit.filter("_sub is null").select("classe", F.col("limite").alias("_limite_classe"))
    rows = rows.join(whole, "classe", "left")
    if "subclasse" in daily.columns:
        own = limit.filter("_sub is not null").select("classe", "_sub", F.col("limite").alias("_limite_subclasse"))
        rows = rows.withColumn("_sub", F.col("subclasse").cast("string")).join(own, ["classe", "_sub"], "left").drop("_sub")
    else:
        rows = rows.withColumn("_limite_subclasse", F.lit(None).cast("double"))
    rows = rows.withColumn("limite", F.coalesce("_limite_subclasse", "_limite_classe")).drop("_limite_subclasse", "_limite_classe")
    return rows.filter(F.col("proporcao_resgate") > F.col("limite"))


def latest_by_pattern(
    objects: DataFrame, name: str, modified: str, term: str, group: Sequence[str] = ()
) -> DataFrame:
    """Newest object whose lower-cased name contains ``term``; ties go to the larger name.

    Without a group the result is one row, null when nothing matches.
    """
    newest = F.max(
        F.when(F.lower(F.col(name)).contains(term.lower()), F.struct(F.col(modified).alias("m"), F.col(name).alias("n")))
    )
    picked = objects.groupBy(*group).agg(newest.alias("_newest"))
    return picked.select(*group, F.col("_newest.n").alias(name), F.col("_newest.m").alias(modified))


def describe_status_runs(
    history: DataFrame, key: str, day: str, status: str, tie: str
) -> DataFrame:
    """Validity intervals of a slowly changing attribute.

    A day's value is that of its last record, so the history is first reduced
    to one row per key and day (map-side); a key's window group is then bounded
    by the calendar. Equal neighbours form one interval, which ends the day
    before the next begins.
    """
    per_day = history.groupBy(key, F.col(day).alias("_day")).agg(F.max_by(status, tie).alias("_status"))
    ordered = Window.partitionBy(key).orderBy("_day")
    starts = per_day.withColumn("_before", F.lag("_status").over(ordered)).withColumn(
        "_first", F.row_number().over(ordered) == 1
    )
    changes = starts.filter(F.col("_first") | ~F.col("_status").eqNullSafe(F.col("_before")))
    return changes.select(
        key,
        F.col("_status").alias(status),
        F.col("_day").alias("dt_inicio"),
        F.date_sub(F.lead("_day").over(ordered), 1).alias("dt_fim_vigencia"),
    ).withColumn("vigente", F.col("dt_fim_vigencia").isNull())
