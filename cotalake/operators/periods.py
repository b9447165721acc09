"""Period aggregates: the as-published one and true trailing windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cotalake import schemas
from cotalake.functions import dates, numbers
from cotalake.operators import ranking
from cotalake.session import stored

# Score weights, band edges and labels of the two variants.
RISK_LABELS = ["baixo", "medio", "alto"]
LOCAL_EDGES = [0, 25, 50, 100]
CLOUD_EDGES = [0, 45, 70, 100]


def risk_score_local(equity_change: Column, holder_change: Column) -> Column:
    return numbers.clip(F.abs(equity_change) * 0.5 + F.abs(holder_change) * 0.5, 0, 100)


def risk_score_cloud(equity_change: Column) -> Column:
    """Never below 50, so the lowest band cannot occur."""
    return numbers.clip(F.lit(50.0) + F.abs(fill_zero(equity_change)) * 10, 0, 100)


def fill_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def risk_band(score: Column, variant: str = "local") -> Column:
    return numbers.right_closed_band(score, LOCAL_EDGES if variant == "local" else CLOUD_EDGES, RISK_LABELS)


def expand_periods(df: DataFrame, periods: Sequence[int] = tuple(schemas.PERIODS), column: str = "periodo") -> DataFrame:
    """One copy of each row per period, without a join."""
    return df.withColumn(column, F.explode(F.array(*[F.lit(int(p)) for p in periods])))


def agg_fundo_periodo(
    fact: DataFrame, periods: Sequence[int] = tuple(schemas.PERIODS), variant: str = "local"
) -> DataFrame:
    """Totals and mean variations per fund, repeated for each period.

    The period does not restrict the dates here; :func:`kpi_trailing_period`
    does. So the fact is aggregated once and the small result is repeated.
    """
    totals = fact.groupBy("sk_fundo").agg(
        F.coalesce(numbers.money_sum(F.col("captacao_dia")), F.lit(0.0)).alias("captacao_periodo"),
        F.coalesce(numbers.money_sum(F.col("resgate_dia")), F.lit(0.0)).alias("resgate_periodo"),
        F.coalesce(numbers.money_sum(F.col("fluxo_liquido_dia")), F.lit(0.0)).alias("fluxo_liquido_periodo"),
        F.avg("variacao_pl_dia_pct").alias("var_patrimonio_periodo_pct"),
        F.avg("variacao_cotistas_dia_pct").alias("var_cotistas_periodo_pct"),
        F.max("sk_data").alias("data_referencia"),
    )
    equity, holders = F.col("var_patrimonio_periodo_pct"), F.col("var_cotistas_periodo_pct")
    if variant == "cloud":
        totals = totals.withColumns(
            {"var_patrimonio_periodo_pct": fill_zero(equity), "var_cotistas_periodo_pct": fill_zero(holders)}
        )
        score = risk_score_cloud(equity)
    else:
        score = risk_score_local(equity, holders)
    scored = totals.withColumn("score_risco_fundo", score).withColumn(
        "nivel_risco_fundo", risk_band(F.col("score_risco_fundo"), variant)
    )
    first = ["sk_fundo", "periodo"]
    return expand_periods(scored, periods).select(*first, *[c for c in scored.columns if c not in first])


def _cut(days: int) -> str:
    return f"_corte_{int(days)}"


def with_cutoffs(fact: DataFrame, periods: Sequence[int]) -> DataFrame:
    """Rows of the longest period, with ``data_referencia`` and each period's cut-off key.

    A row is within N days of its fund's last date if its key exceeds the
    fund's N-day cut-off. The cut-offs are worked out per fund, so that rows
    only compare integers. They hold one row per fund; Spark broadcasts them if their size allows it.
    Of a fact partitioned by month only the months that some fund's periods touch are read: a fund closed long ago adds its own
    months, not those since. Their number is bounded by the calendar.
    """
    # The explicit null filter makes both uses of this aggregate the same plan, so that it runs once.
    last = (
        fact.filter(F.col("sk_fundo").isNotNull())
        .groupBy("sk_fundo")
        .agg(F.max("sk_data").alias("data_referencia"))
        .withColumn("_reference", dates.key_to_date(F.col("data_referencia")))
        .withColumns({_cut(p): dates.date_key(F.date_sub("_reference", int(p))) for p in periods})
        .drop("_reference")
    )
    longest = _cut(max(periods))
    if "ano_mes" in fact.columns:
        recent = fact.filter(F.col("ano_mes").isin(_touched_months(last, longest)))
    else:
        recent = fact.filter(F.col("sk_data") > last.agg(F.min(longest)).scalar())
    return recent.join(last, "sk_fundo").filter(F.col("sk_data") > F.col(longest))


def _touched_months(last: DataFrame, longest: str) -> list[int]:
    """Months from a fund's longest cut-off to its last date, of all funds; few spans differ, so they are grouped first."""
    month = lambda key: F.floor(F.col(key) / F.lit(100))
    spans = last.select(month(longest).alias("a"), month("data_referencia").alias("b")).distinct()
    first, final = (F.make_date(F.floor(F.col(c) / 100).cast("int"), (F.col(c) % 100).cast("int"), F.lit(1)) for c in ("a", "b"))
    months = spans.select(F.explode(F.sequence(first, final, F.expr("interval 1 month"))).alias("d")).select(dates.month_key(dates.date_key(F.col("d"))).alias("m"))
    return sorted(r["m"] for r in months.distinct().collect())


def _within(days: int, value: Column) -> Column:
    return F.when(F.col("sk_data") > F.col(_cut(days)), value)


def _per_period(df: DataFrame, keys: Sequence[str], columns: dict[str, dict[int, Column]], periods) -> DataFrame:
    """Turn one wide row per key into one row per key and period."""
    entries = [
        F.struct(F.lit(int(p)).alias("periodo"), *[by_period[p].alias(name) for name, by_period in columns.items()])
        for p in periods
    ]
    return df.select(*keys, F.inline(F.array(*entries)))


def kpi_trailing_period(fact: DataFrame, periods: Sequence[int] = tuple(schemas.PERIODS)) -> DataFrame:
    """Inflow, redemption and net flow of the N days ending on the fund's last date.

    All periods come from one aggregation with conditional sums, so no row is
    repeated per period and only rows of the longest period are aggregated.
    """
    names = {
        "captacao_dia": "captacao_periodo",
        "resgate_dia": "resgate_periodo",
        "fluxo_liquido_dia": "fluxo_liquido_periodo",
    }
    recent = with_cutoffs(fact, periods)
    sums = [
        F.coalesce(numbers.money_sum(_within(p, F.col(source))), F.lit(0.0)).alias(f"{name}_{p}")
        for source, name in names.items()
        for p in periods
    ]
    wide = recent.groupBy("sk_fundo", "data_referencia").agg(*sums)
    columns = {name: {p: F.col(f"{name}_{p}") for p in periods} for name in names.values()}
    return _per_period(wide, ["sk_fundo", "data_referencia"], columns, periods)


def _first_last(fact: DataFrame, value: str, periods: Sequence[int]) -> DataFrame:
    """First and last known value of each fund within each period."""
    recent = with_cutoffs(fact, periods)
    known = F.when(F.col(value).isNotNull(), F.col("sk_data"))
    aggregates = []
    for p in periods:
        aggregates.append(F.min_by(value, _within(p, known)).alias(f"inicial_{p}"))
        aggregates.append(F.max_by(value, _within(p, known)).alias(f"final_{p}"))
    return recent.groupBy("sk_fundo").agg(*aggregates)


def kpi_change(
    fact: DataFrame, value: str, out: str, periods: Sequence[int] = tuple(schemas.PERIODS)
) -> DataFrame:
    """``(final - initial) / initial`` of ``value`` within each trailing period."""
    wide = _first_last(fact, value, periods)
    columns = {
        "valor_inicial": {p: F.col(f"inicial_{p}") for p in periods},
        "valor_final": {p: F.col(f"final_{p}") for p in periods},
    }
    rows = _per_period(wide, ["sk_fundo"], columns, periods)
    return rows.withColumn(out, numbers.ratio_change(F.col("valor_final"), F.col("valor_inicial")))


def kpi_var_patrimonio(fact: DataFrame, periods: Sequence[int] = tuple(schemas.PERIODS)) -> DataFrame:
    return kpi_change(fact, "patrimonio_liquido_dia", "var_patrimonio_periodo", periods)


def kpi_var_cotistas(fact: DataFrame, periods: Sequence[int] = tuple(schemas.PERIODS)) -> DataFrame:
    return kpi_change(fact, "cotistas_dia", "var_cotistas_periodo", periods)


def daily_totals(fact: DataFrame) -> DataFrame:
    """One row per fund and day, which bounds every later per-fund window by the calendar.

    Sums of finite amounts, and how many amounts were plus or minus infinity (or too large to sum exactly).
    """
    flows = ("captacao_dia", "resgate_dia", "fluxo_liquido_dia")
    return fact.groupBy("sk_fundo", "sk_data").agg(
        *[F.sum(numbers.exact(F.col(c))).alias(c) for c in flows],
        *[F.count_if(numbers.beyond(F.col(c)) > 0).alias(f"{c}_acima") for c in flows],
        *[F.count_if(numbers.beyond(F.col(c)) < 0).alias(f"{c}_abaixo") for c in flows],
    )


def rolling_daily_kpi(
    fact: DataFrame, periods: Sequence[int] = tuple(schemas.PERIODS), one_row_per_day: bool = False
) -> DataFrame:
    """Trailing sums for every fund and day. One shuffle by fund serves all periods.

    A window's sum is the running total minus the running total before the
    window. Both are exact, and both frames only grow, so the work per
    row does not depend on the length of the period. Infinite amounts are
    counted, not added, so that they leave the window again; one of each sign gives NaN.

    ``one_row_per_day`` promises about one fact row per fund and day: rows then go to their fund at once. Without that promise
    days are added up first, so that a large fund is spread.
    """
    daily = daily_totals(fact.repartition("sk_fundo") if one_row_per_day else fact).withColumn("_day", F.unix_date(dates.key_to_date(F.col("sk_data"))))
    ordered = Window.partitionBy("sk_fundo").orderBy("_day")
    upto = ordered.rowsBetween(Window.unboundedPreceding, 0)
    sources = {"captacao_dia": "captacao", "resgate_dia": "resgate", "fluxo_liquido_dia": "fluxo_liquido"}
    zero = F.lit(0).cast("decimal(38,6)")
    # Days with a finite, a plus and a minus infinite amount of a flow, side by side in one number: a calendar has fewer than 2^20 days.
    up, down = 1 << 20, 1 << 40

    def days(c: str) -> Column:
        marks = ((F.col(c).isNotNull(), 1), (F.col(f"{c}_acima") > 0, up), (F.col(f"{c}_abaixo") > 0, down))
        return sum((F.when(mark, F.lit(unit)).otherwise(F.lit(0)).cast("long") for mark, unit in marks), F.lit(0).cast("long"))

    counted = {f"_days_{name}": days(source) for source, name in sources.items()}
    running = {f"_sum_{name}": F.coalesce(F.sum(source).over(upto), zero) for source, name in sources.items()}
    running |= {name: F.sum(name).over(upto) for name in counted}
    totals = daily.withColumns(counted).withColumns(running).withColumn("_total", F.struct(*running))
    earlier = {
        f"_before_{p}": F.last("_total").over(ordered.rangeBetween(Window.unboundedPreceding, -int(p))) for p in periods
    }
    compared = totals.withColumns(earlier)

    # All of these become one generated method; the JVM only interprets one of more than 8,000 bytes, so few steps each.
    def trailing(name: str, p: int) -> Column:
        before = F.col(f"_before_{p}")
        since = F.col(f"_days_{name}") - F.coalesce(before[f"_days_{name}"], F.lit(0).cast("long"))
        change = F.col(f"_sum_{name}") - F.coalesce(before[f"_sum_{name}"], zero)
        return (
            F.when(since < up, F.when(since > 0, change.cast("double")))
            .when(since < down, F.lit(numbers.INFINITY))
            .when(since.bitwiseAND(F.lit(down - 1)) < up, F.lit(-numbers.INFINITY))
            .otherwise(F.lit(float("nan")))
            .alias(f"{name}_{p}d")
        )

    return compared.select("sk_fundo", "sk_data", *[trailing(name, p) for p in periods for name in sources.values()])


def rank_funds(kpis: DataFrame, levels: DataFrame) -> DataFrame:
    """Rank by net flow within each period, with the fund's risk level.

    A period has one row per fund, any number under the wide key: ranks come from ranges of the flow, not from one window.
    """
    ranked = ranking.ranked(kpis.select("periodo", "sk_fundo", "fluxo_liquido_periodo"), "periodo", "fluxo_liquido_periodo", "posicao")
    return ranked.join(levels.select("sk_fundo", "periodo", "nivel_risco_fundo"), ["sk_fundo", "periodo"], "left")


def period_profile(fact: DataFrame, periods: Sequence[int] = tuple(schemas.PERIODS)) -> DataFrame:
    """Equity statistics, first and last holders, first and last date and mean return per period."""
    recent = with_cutoffs(fact, periods)
    equity, holders, change = (
        F.col("patrimonio_liquido_dia"),
        F.col("cotistas_dia"),
        F.col("variacao_pl_dia_pct"),
    )
    known = F.when(holders.isNotNull(), F.col("sk_data"))
    shapes = {
        "pl_medio": lambda p: numbers.money_sum(_within(p, equity)) / F.nullif(F.count(_within(p, equity)), F.lit(0)),
        "pl_maximo": lambda p: F.max(_within(p, equity)),
        "pl_minimo": lambda p: F.min(_within(p, equity)),
        "cotistas_inicial": lambda p: F.min_by(holders, _within(p, known)),
        "cotistas_final": lambda p: F.max_by(holders, _within(p, known)),
        "data_inicio": lambda p: F.min(_within(p, F.col("sk_data"))),
        "data_fim": lambda p: F.max(_within(p, F.col("sk_data"))),
        "retorno_medio_pct": lambda p: F.avg(_within(p, change)),
    }
    wide = recent.groupBy("sk_fundo").agg(
        *[make(p).alias(f"{name}_{p}") for name, make in shapes.items() for p in periods]
    )
    columns = {name: {p: F.col(f"{name}_{p}") for p in periods} for name in shapes}
    return _per_period(wide, ["sk_fundo"], columns, periods)


def describe_flow_by_period(aggregate: DataFrame) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of net flow per period.

    Quartiles are exact and come from ranges of the flow, so no task holds a period.
    """
    rows = stored(aggregate.select("periodo", "fluxo_liquido_periodo"), "period_flows")
    flow = F.col("fluxo_liquido_periodo")
    moments = rows.groupBy("periodo").agg(
        F.count(flow).alias("count"), F.avg(flow).alias("mean"), F.stddev_samp(flow).alias("std"), F.min(flow).alias("min"), F.max(flow).alias("max")
    )
    quartiles = ranking.quantiles(rows, "periodo", "fluxo_liquido_periodo", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return moments.join(quartiles, "periodo", "left").select("periodo", "count", "mean", "std", "min", "p25", "p50", "p75", "max")
