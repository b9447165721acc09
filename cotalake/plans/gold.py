"""Gold builders: calendar, fund dimension, daily fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotalake import schemas
from cotalake.functions import dates, numbers, text
from cotalake.operators import cleaning, joins, ordered, relationship
from cotalake.operators.resolve import (
    Wanted,
    project_adaptive,
    resolve_column,
    resolve_optional_column,
)

CNPJ = joins.CNPJ
FACT_COLUMNS = [
    "sk_data", "sk_fundo", CNPJ, "patrimonio_liquido_dia", "captacao_dia", "resgate_dia", "cotistas_dia",
    "fluxo_liquido_dia", "variacao_pl_dia_pct", "variacao_cotistas_dia_pct", "flag_base_real",
]


def dim_tempo(bounds: DataFrame, start: str = "inicio", end: str = "fim") -> DataFrame:
    """One row per day between the dates of a one-row frame."""
    days = bounds.select(F.explode(F.sequence(F.col(start), F.col(end))).alias("data"))
    day = F.col("data")
    return days.select(
        dates.date_key(day).alias("sk_data"),
        day,
        F.year(day).alias("ano"),
        F.month(day).alias("mes"),
        F.dayofmonth(day).alias("dia"),
        F.quarter(day).alias("trimestre"),
        F.weekday(day).alias("dia_semana"),
        (F.last_day(day) == day).cast("int").alias("eh_fim_de_mes"),
    )


def fact_bounds(fact: DataFrame) -> DataFrame:
    """First and last day of a fact, the calendar's default range."""
    return fact.agg(F.min("sk_data").alias("a"), F.max("sk_data").alias("b")).select(
        dates.key_to_date(F.col("a")).alias("inicio"), dates.key_to_date(F.col("b")).alias("fim")
    )


def calendar_extras(calendar: DataFrame) -> DataFrame:
    return calendar.withColumns(
        {
            "semana_iso": F.weekofyear("data"),
            "eh_fim_de_semana": (F.weekday("data") >= 5).cast("int"),
        }
    )


def class_columns(variant: str = "local") -> list[Wanted]:
    cloud = variant == "cloud"
    wanted = [
        Wanted("cnpj_fundo_classe", schemas.CLASS_CNPJ_CLOUD if cloud else schemas.CLASS_CNPJ, keep_source_name=cloud),
        Wanted(
            "nome_fundo",
            schemas.CLASS_NAME_CLOUD if cloud else schemas.CLASS_NAME,
            required=False,
            keep_source_name=cloud,
        ),
    ]
    for aliases in schemas.CLASS_OPTIONAL:
        wanted.append(Wanted(aliases[0], aliases, required=False, keep_source_name=True))
    return wanted


KEYS = {"parity": text.hash_key, "wide": text.wide_key}


def dim_fundo(
    registry: DataFrame, variant: str = "local", order: Sequence[str] = (), key: str = "parity"
) -> DataFrame:
    """One row per surrogate key: the first CNPJ in ``order`` (default: by CNPJ) keeps it.

    The ``parity`` key has a million values, so CNPJs that share one lose their row but for the first. The ``wide`` key
    has 60 bits and the dimension one row per CNPJ; none is lost. Blank CNPJs get no row; ``registry`` columns that are
    absent are left out.
    """
    wanted = class_columns(variant)
    chosen = project_adaptive(registry, wanted, fill_absent=False)
    cnpj = chosen.columns[0]
    keyed = chosen.withColumn(CNPJ, text.normalize_cnpj(F.col(cnpj))).filter(F.length(CNPJ) > 0)
    keyed = keyed.withColumn("sk_fundo", KEYS[key](F.col(CNPJ)))
    rest = list(order) or [CNPJ, *chosen.columns]
    unique = cleaning.distinct_by_key(keyed, ["sk_fundo" if key == "parity" else CNPJ], rest)
    return unique.select("sk_fundo", CNPJ, *chosen.columns)


def dim_fundo_full(classes: DataFrame, funds: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Class dimension completed from the fund registry by CNPJ; the class side's value wins.

    ``funds`` is reduced to one row per CNPJ before the join.
    """
    present = [c for c in attributes if c in funds.columns]
    fund_side = cleaning.distinct_by_key(funds.select(CNPJ, *present), [CNPJ], present).select(
        CNPJ, *[F.col(c).alias(f"_{c}") for c in present]
    )
    joined = classes.join(fund_side, CNPJ, "left")
    return joined.select(
        *[c for c in classes.columns if c not in present],
        *[(F.coalesce(c, f"_{c}") if c in classes.columns else F.col(f"_{c}")).alias(c) for c in present],
    )


CLIENT_COLUMNS = {
    "perfil_risco": "string", "segmento": "string", "uf": "string", "cidade": "string", "renda_estimada": "double",
    "patrimonio_estimado": "double", "data_inicio_relacionamento": "date", "canal_origem": "string", "status_cliente": "string",
}


def dim_cliente(clients: DataFrame, reference: Column, minimum_income: float = 20_000) -> DataFrame:
    """Client dimension: business id, age band on the reference date, income not below the minimum.

    ``clients`` brings sk_cliente, nome_cliente, data_nascimento and any of the
    remaining columns; those it lacks become null.
    """
    rest = [
        (F.col(name).cast(kind) if name in clients.columns else F.lit(None).cast(kind)).alias(name)
        for name, kind in CLIENT_COLUMNS.items()
    ]
    shaped = clients.select(
        "sk_cliente",
        text.business_id(F.col("sk_cliente")).alias("id_cliente"),
        "nome_cliente",
        "data_nascimento",
        relationship.age_band(dates.age_in_years(F.col("data_nascimento"), reference)).alias("faixa_etaria"),
        *rest,
    )
    return shaped.withColumn("renda_estimada", numbers.floor_value(F.col("renda_estimada"), minimum_income))


def report_rows(report: DataFrame, variant: str = "local") -> DataFrame:
    """Daily report under standard names, typed, rows without CNPJ or date dropped.

    A CNPJ without digits is left as an empty text, which no dimension row has:
    the join drops it and the report of unmatched rows shows it.
    """
    names = report.columns
    cloud = variant == "cloud"
    cnpj = resolve_column(names, schemas.REPORT_CNPJ_CLOUD if cloud else schemas.REPORT_CNPJ)
    required = resolve_column if cloud else resolve_optional_column
    picks: dict[str, str | None] = {
        "patrimonio_liquido_dia": resolve_column(names, schemas.REPORT_EQUITY),
        "captacao_dia": required(names, schemas.REPORT_INFLOW),
        "resgate_dia": required(names, schemas.REPORT_REDEMPTION),
        "cotistas_dia": resolve_column(names, schemas.REPORT_HOLDERS),
    }
    types = dict(report.dtypes)
    day_name = resolve_column(names, schemas.REPORT_DATE)
    day = F.col(f"`{day_name}`")
    parsed = dates.parse_report_date(day) if types[day_name] == "string" else day.cast("date")

    def number(source: str | None) -> Column:
        if source is None:
            return F.lit(None).cast("double")
        value = F.col(f"`{source}`")
        return numbers.to_number(value) if types[source] == "string" else value.cast("double")

    return report.filter(F.col(f"`{cnpj}`").isNotNull() & parsed.isNotNull()).select(
        text.normalize_cnpj(F.col(f"`{cnpj}`")).alias(CNPJ),
        parsed.alias("data"),
        *[number(source).alias(name) for name, source in picks.items()],
    )


VARIATIONS = {
    "patrimonio_liquido_dia": "variacao_pl_dia_pct",
    "cotistas_dia": "variacao_cotistas_dia_pct",
}


def fct_fundo_diario(
    report: DataFrame,
    dim: DataFrame,
    variant: str = "local",
    one_row_per_day: bool = False,
    max_chunk_rows: int = ordered.MAX_CHUNK_ROWS,
    history: DataFrame | None = None,
    key: str = "parity",
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Daily fact. ``dim`` is what :func:`dim_fundo` returns for this ``key``; one of parity keys is bounded and broadcast.

    ``one_row_per_day`` promises at most one report row per fund and day.
    Without that promise, rows of one fund and day are ordered by their values
    and a large fund is spread over many tasks. ``sizes`` may bring their number per fund (``sk_fundo``, ``_n``).
    """
    rows = joins.join_fact_dim(report_rows(report, variant), dim, unique_fund_key=key == "parity")
    if one_row_per_day:
        changed = ordered.padded_change(rows, "sk_fundo", "data", VARIATIONS)
    else:
        values = [CNPJ, "patrimonio_liquido_dia", "captacao_dia", "resgate_dia", "cotistas_dia"]
        tied = rows.withColumn("_tie", text.row_order(*values))
        changed = ordered.padded_change_split(
            tied, "sk_fundo", "data", "_tie", VARIATIONS, max_rows=max_chunk_rows, history=history, sizes=sizes
        )
    flag = F.lit(1) if variant == "cloud" else F.lit(True)
    return changed.withColumns(
        {
            "sk_data": dates.date_key(F.col("data")),
            "fluxo_liquido_dia": numbers.net_flow(F.col("captacao_dia"), F.col("resgate_dia")),
            "flag_base_real": flag,
        }
    ).select(*FACT_COLUMNS)


def with_month_filter(fact: DataFrame, first: int, last: int) -> DataFrame:
    """Rows between two date keys; on a month-partitioned table also prunes the partitions."""
    rows = fact.filter(F.col("sk_data").between(first, last))
    if "ano_mes" in fact.columns:
        rows = rows.filter(F.col("ano_mes").between(first // 100, last // 100))
    return rows
