"""Joins, star schema, period aggregates and fund KPIs."""

from __future__ import annotations

from pyspark.sql import functions as F

from cotalake.catalog import sql
from cotalake.catalog.registry import query
from cotalake.functions import text
from cotalake.operators import joins, ordered, periods
from cotalake.plans import bindings, gold


def _rounded(df, *columns: str, places: int = 6):
    return df.withColumns({c: F.round(c, places) for c in columns})


def _active_dim(spark, sf_dir):
    """Suppliers in credit, as the registry that survived its filters."""
    active = bindings.table(spark, sf_dir, "supplier").filter(F.col("s_acctbal") >= 0)
    return gold.dim_fundo(
        active.select(F.col("s_name").alias("CNPJ_FUNDO_CLASSE"), F.col("s_name").alias("DENOM_SOCIAL"))
    )


_ACTIVE_SQL = sql.DIM.replace("FROM supplier", "FROM supplier WHERE s_acctbal >= 0")


def _report(spark, sf_dir):
    return gold.report_rows(bindings.daily_report(spark, sf_dir))


@query(
    "join_fact_dim",
    f"""WITH {sql.REPORT},{_ACTIVE_SQL}
    SELECT cnpj AS cnpj_fundo_classe_norm, sk_fundo, nome AS nome_fundo, {sql.date_key('dia')} AS sk_data, capt AS captacao_dia
    FROM informe JOIN dim USING (cnpj)""",
)
def join_fact_dim(spark, sf_dir):
    joined = joins.join_fact_dim(_report(spark, sf_dir), _active_dim(spark, sf_dir), bring=("sk_fundo", "nome_fundo"))
    return joined.select(
        joins.CNPJ, "sk_fundo", "nome_fundo", gold.dates.date_key(F.col("data")).alias("sk_data"), "captacao_dia"
    )


@query(
    "unmatched_report",
    f"""WITH {sql.REPORT},{_ACTIVE_SQL}
    SELECT cnpj AS cnpj_fundo_classe_norm, {sql.date_key('dia')} AS sk_data, pl AS patrimonio_liquido_dia
    FROM informe WHERE cnpj NOT IN (SELECT cnpj FROM dim)""",
)
def unmatched_report(spark, sf_dir):
    rows = joins.unmatched_report(_report(spark, sf_dir), _active_dim(spark, sf_dir))
    return rows.select(joins.CNPJ, gold.dates.date_key(F.col("data")).alias("sk_data"), "patrimonio_liquido_dia")


@query(
    "join_fact_dim_summary",
    """SELECT n_name AS segmento, count(*) AS quantidade,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(19,2))) AS DOUBLE) AS soma,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(19,2))) AS DOUBLE) / count(*) AS media
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1""",
)
def join_fact_dim_summary(spark, sf_dir):
    nations = bindings.table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("segmento"))
    dim = bindings.table(spark, sf_dir, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("l_suppkey"), "segmento"
    )
    fact = bindings.table(spark, sf_dir, "lineitem")
    return joins.summary_by_segment(fact, dim, "l_suppkey", "segmento", "l_extendedprice")


@query(
    "key_collision_report",
    f"""SELECT sk_fundo, count(*) AS cnpjs, min(c) AS menor_cnpj, max(c) AS maior_cnpj FROM (
    SELECT {sql.hash_key("lpad(CAST(o_orderkey AS VARCHAR), 14, '0')")} AS sk_fundo, lpad(CAST(o_orderkey AS VARCHAR), 14, '0') AS c FROM orders)
    GROUP BY 1 HAVING count(*) > 1""",
)
def key_collision_report(spark, sf_dir):
    """Order numbers as 14-digit CNPJs: enough of them to collide."""
    registry = bindings.table(spark, sf_dir, "orders").select(
        F.lpad(F.col("o_orderkey").cast("string"), 14, "0").alias(joins.CNPJ)
    )
    return joins.key_collision_report(registry)


# ---- star schema ----

_CALENDAR_SQL = f"""
dias AS (SELECT CAST(unnest(generate_series((SELECT min(CAST(l_shipdate AS DATE)) FROM lineitem),
    (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem), INTERVAL 1 DAY)) AS DATE) AS d)"""
_CALENDAR_COLUMNS = f"""{sql.date_key('d')} AS sk_data, d AS data, CAST(year(d) AS INTEGER) AS ano,
    CAST(month(d) AS INTEGER) AS mes, CAST(day(d) AS INTEGER) AS dia, CAST(quarter(d) AS INTEGER) AS trimestre,
    CAST(isodow(d) - 1 AS INTEGER) AS dia_semana, CAST(last_day(d) = d AS INTEGER) AS eh_fim_de_mes"""


def _calendar(spark, sf_dir):
    day = F.col("l_shipdate").cast("date")
    bounds = bindings.table(spark, sf_dir, "lineitem").agg(F.min(day).alias("inicio"), F.max(day).alias("fim"))
    return gold.dim_tempo(bounds)


@query("dim_tempo", f"WITH {_CALENDAR_SQL} SELECT {_CALENDAR_COLUMNS} FROM dias")
def dim_tempo(spark, sf_dir):
    return _calendar(spark, sf_dir)


@query(
    "calendar_extras",
    f"""WITH {_CALENDAR_SQL} SELECT {sql.date_key('d')} AS sk_data, CAST(weekofyear(d) AS INTEGER) AS semana_iso,
    CAST(isodow(d) >= 6 AS INTEGER) AS eh_fim_de_semana FROM dias""",
)
def calendar_extras(spark, sf_dir):
    return gold.calendar_extras(_calendar(spark, sf_dir)).select("sk_data", "semana_iso", "eh_fim_de_semana")


@query("dim_fundo", f"WITH {sql.DIM} SELECT sk_fundo, cnpj AS cnpj_fundo_classe_norm, nome AS cnpj_fundo_classe, nome AS nome_fundo FROM dim")
def dim_fundo(spark, sf_dir):
    return bindings.dim_fundo(spark, sf_dir)


@query(
    "dim_fundo_full",
    """SELECT regexp_replace(s_name, '[^0-9]', '', 'g') AS cnpj_fundo_classe_norm, s_name AS nome_fundo, n_name AS gestor,
    r_name AS administrador, CASE WHEN s_acctbal >= 0 THEN 'Aberto' ELSE n_name END AS forma_condominio
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def dim_fundo_full(spark, sf_dir):
    """Suppliers as classes; nation and region as manager and administrator of the fund registry."""
    suppliers = bindings.table(spark, sf_dir, "supplier").withColumn(joins.CNPJ, text.normalize_cnpj(F.col("s_name")))
    nations, regions = bindings.table(spark, sf_dir, "nation"), bindings.table(spark, sf_dir, "region")
    funds = (
        suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            joins.CNPJ,
            F.col("n_name").alias("gestor"),
            F.col("r_name").alias("administrador"),
            F.col("n_name").alias("forma_condominio"),
        )
    )
    classes = suppliers.select(
        joins.CNPJ,
        F.col("s_name").alias("nome_fundo"),
        F.when(F.col("s_acctbal") >= 0, "Aberto").alias("forma_condominio"),
    )
    return gold.dim_fundo_full(classes, funds, ["gestor", "administrador", "forma_condominio"])


@query(
    "dim_cliente_simulado",
    """WITH c AS (SELECT *, DATE '2026-04-19' - CAST(8000 + floor(c_acctbal) AS INTEGER) AS n FROM customer),
    i AS (SELECT *, date_diff('day', n, DATE '2026-04-19') / 365.25 AS a FROM c)
    SELECT c_custkey AS sk_cliente, 'CLI_' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS id_cliente, c_name AS nome_cliente,
    n AS data_nascimento, CASE WHEN a > 20 AND a <= 30 THEN '21-30' WHEN a > 30 AND a <= 40 THEN '31-40'
    WHEN a > 40 AND a <= 50 THEN '41-50' WHEN a > 50 AND a <= 60 THEN '51-60' WHEN a > 60 AND a <= 100 THEN '60+' END AS faixa_etaria,
    c_mktsegment AS segmento, greatest(5000.0, c_acctbal) AS renda_estimada,
    CASE WHEN c_acctbal >= 0 THEN 'ativo' ELSE 'inativo' END AS status_cliente, CAST(NULL AS VARCHAR) AS uf FROM i""",
)
def dim_cliente_simulado(spark, sf_dir):
    """Customers as clients, born as many days before the reference date as their balance says."""
    reference = F.lit("2026-04-19").cast("date")
    clients = bindings.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("sk_cliente"),
        F.col("c_name").alias("nome_cliente"),
        F.date_sub(reference, (F.floor("c_acctbal") + 8000).cast("int")).alias("data_nascimento"),
        F.col("c_mktsegment").alias("segmento"),
        F.col("c_acctbal").alias("renda_estimada"),
        F.when(F.col("c_acctbal") >= 0, "ativo").otherwise("inativo").alias("status_cliente"),
    )
    return gold.dim_cliente(clients, reference, 5000).select(
        "sk_cliente", "id_cliente", "nome_cliente", "data_nascimento", "faixa_etaria", "segmento", "renda_estimada",
        "status_cliente", "uf",
    )


@query("fct_fundo_diario", f"WITH {sql.FACT} SELECT * FROM fct")
def fct_fundo_diario(spark, sf_dir):
    return bindings.fact(spark, sf_dir)


@query("fct_fundo_diario_wide", f"WITH {sql.FACT_WIDE} SELECT * FROM fct")
def fct_fundo_diario_wide(spark, sf_dir):
    """Under the wide key no supplier loses its rows."""
    return bindings.fact(spark, sf_dir, key="wide")


@query("sort_fund_date", f"WITH {sql.FACT} SELECT sk_fundo, sk_data, patrimonio_liquido_dia FROM fct ORDER BY 1, 2")
def sort_fund_date(spark, sf_dir):
    return (
        bindings.fact(spark, sf_dir)
        .select("sk_fundo", "sk_data", "patrimonio_liquido_dia")
        .repartitionByRange("sk_fundo", "sk_data")
        .sortWithinPartitions("sk_fundo", "sk_data")
    )


# ---- variations over raw rows: several per fund and day, any share of them in one fund ----

_RAW_TIE = ["l_orderkey", "l_linenumber", "l_partkey"]
_RAW_SQL = f"""
bruto AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS dia, l_quantity, l_extendedprice,
  CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS pl, CAST(l_linenumber AS DOUBLE) AS cot,
  l_extendedprice / l_quantity AS cota, {sql.number_order(*_RAW_TIE)} AS tie FROM lineitem),
cheio AS (SELECT *, last_value({{c}} IGNORE NULLS) OVER (PARTITION BY l_suppkey ORDER BY dia, tie
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f FROM bruto),
anterior AS (SELECT *, lag(f) OVER (PARTITION BY l_suppkey ORDER BY dia, tie) AS a FROM cheio)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {sql.date_key('dia')} AS sk_data, ({sql.ratio('f', 'a')}){{s}} AS {{o}} FROM anterior"""


def _raw_change(spark, sf_dir, value, out: str, scale: float):
    rows = bindings.table(spark, sf_dir, "lineitem").select(
        *_RAW_TIE,
        "l_suppkey",
        F.col("l_shipdate").cast("date").alias("data"),
        value.alias("_valor"),
        text.number_order(*_RAW_TIE).alias("_tie"),
    )
    changed = ordered.padded_change_split(rows, "l_suppkey", "data", "_tie", {"_valor": out}, scale)
    return changed.select(*_RAW_TIE, "l_suppkey", gold.dates.date_key(F.col("data")).alias("sk_data"), out)


@query("pct_change_pl", "WITH " + _RAW_SQL.format(c="pl", o="variacao_pl_dia_pct", s=" * 100"))
def pct_change_pl(spark, sf_dir):
    equity = F.when(F.col("l_returnflag") != "R", F.col("l_quantity"))
    return _raw_change(spark, sf_dir, equity, "variacao_pl_dia_pct", 100.0)


@query("pct_change_cotistas", "WITH " + _RAW_SQL.format(c="cot", o="variacao_cotistas_dia_pct", s=" * 100"))
def pct_change_cotistas(spark, sf_dir):
    return _raw_change(spark, sf_dir, F.col("l_linenumber").cast("double"), "variacao_cotistas_dia_pct", 100.0)


@query("daily_return", "WITH " + _RAW_SQL.format(c="cota", o="retorno_dia", s=""))
def daily_return(spark, sf_dir):
    return _raw_change(spark, sf_dir, F.col("l_extendedprice") / F.col("l_quantity"), "retorno_dia", 1.0)


# ---- period aggregates ----

_AGG_COLUMNS = """sk_fundo, periodo, captacao_periodo, resgate_periodo, fluxo_liquido_periodo,
    round(var_patrimonio_periodo_pct, 6) AS var_patrimonio_periodo_pct, round(var_cotistas_periodo_pct, 6) AS var_cotistas_periodo_pct,
    data_referencia, round(score_risco_fundo, 6) AS score_risco_fundo, nivel_risco_fundo"""
_AGG_ROUNDED = ["var_patrimonio_periodo_pct", "var_cotistas_periodo_pct", "score_risco_fundo"]


@query("agg_fundo_periodo", f"WITH {sql.AGG_LOCAL} SELECT {_AGG_COLUMNS} FROM agg")
def agg_fundo_periodo(spark, sf_dir):
    return _rounded(periods.agg_fundo_periodo(bindings.fact(spark, sf_dir)), *_AGG_ROUNDED)


@query("agg_fundo_periodo_cloud", f"WITH {sql.AGG_CLOUD} SELECT {_AGG_COLUMNS} FROM agg")
def agg_fundo_periodo_cloud(spark, sf_dir):
    fact = bindings.fact(spark, sf_dir, "cloud")
    return _rounded(periods.agg_fundo_periodo(fact, variant="cloud"), *_AGG_ROUNDED)


@query(
    "expand_periods",
    f"WITH {sql.FACT} SELECT sk_fundo, sk_data, fluxo_liquido_dia, periodo FROM fct, (SELECT unnest([7, 30, 60, 90]) AS periodo)",
)
def expand_periods(spark, sf_dir):
    fact = bindings.fact(spark, sf_dir).select("sk_fundo", "sk_data", "fluxo_liquido_dia")
    return periods.expand_periods(fact)


@query(
    "describe_flow_by_period",
    f"""WITH {sql.AGG_LOCAL} SELECT periodo, count(fluxo_liquido_periodo) AS count, round(avg(fluxo_liquido_periodo), 2) AS mean,
    round(stddev_samp(fluxo_liquido_periodo), 2) AS std, min(fluxo_liquido_periodo) AS min,
    round(quantile_cont(fluxo_liquido_periodo, 0.25), 2) AS p25, round(quantile_cont(fluxo_liquido_periodo, 0.5), 2) AS p50,
    round(quantile_cont(fluxo_liquido_periodo, 0.75), 2) AS p75, max(fluxo_liquido_periodo) AS max FROM agg GROUP BY 1""",
)
def describe_flow_by_period(spark, sf_dir):
    described = periods.describe_flow_by_period(periods.agg_fundo_periodo(bindings.fact(spark, sf_dir)))
    return _rounded(described, "mean", "std", "p25", "p50", "p75", places=2)


# ---- true trailing periods ----

_TRAILING = f"""{sql.AGED},
kpi AS (
  SELECT sk_fundo, data_referencia, periodo,
    CAST(sum(CAST(captacao_dia AS DECIMAL(19,2))) AS DOUBLE) AS captacao_periodo,
    CAST(sum(CAST(resgate_dia AS DECIMAL(19,2))) AS DOUBLE) AS resgate_periodo,
    CAST(sum(CAST(fluxo_liquido_dia AS DECIMAL(19,2))) AS DOUBLE) AS fluxo_liquido_periodo
  FROM idade JOIN periodos ON idade_dias < periodo GROUP BY ALL)"""


@query("kpi_trailing_period", f"WITH {_TRAILING} SELECT * FROM kpi")
def kpi_trailing_period(spark, sf_dir):
    return periods.kpi_trailing_period(bindings.fact(spark, sf_dir))


def _change_sql(value: str, out: str) -> str:
    return f"""WITH {sql.AGED} SELECT sk_fundo, periodo, i AS valor_inicial, f AS valor_final, {sql.ratio('f', 'i')} AS {out}
    FROM (SELECT sk_fundo, periodo, arg_min({value}, sk_data) AS i, arg_max({value}, sk_data) AS f
          FROM idade JOIN periodos ON idade_dias < periodo GROUP BY ALL)"""


@query("kpi_var_patrimonio", _change_sql("patrimonio_liquido_dia", "var_patrimonio_periodo"))
def kpi_var_patrimonio(spark, sf_dir):
    return periods.kpi_var_patrimonio(bindings.fact(spark, sf_dir))


@query("kpi_var_cotistas", _change_sql("cotistas_dia", "var_cotistas_periodo"))
def kpi_var_cotistas(spark, sf_dir):
    return periods.kpi_var_cotistas(bindings.fact(spark, sf_dir))


def _rolling_sql() -> str:
    sums = ", ".join(
        f"CAST(sum(CAST({source} AS DECIMAL(19,2))) OVER (PARTITION BY sk_fundo ORDER BY dia "
        f"RANGE BETWEEN INTERVAL {p - 1} DAY PRECEDING AND CURRENT ROW) AS DOUBLE) AS {name}_{p}d"
        for p in (7, 30, 60, 90)
        for source, name in (
            ("captacao_dia", "captacao"), ("resgate_dia", "resgate"), ("fluxo_liquido_dia", "fluxo_liquido"),
        )
    )
    return f"WITH {sql.FACT} SELECT sk_fundo, sk_data, {sums} FROM (SELECT *, {sql.key_to_date('sk_data')} AS dia FROM fct)"


@query("rolling_daily_kpi", _rolling_sql())
def rolling_daily_kpi(spark, sf_dir):
    return periods.rolling_daily_kpi(bindings.fact(spark, sf_dir), one_row_per_day=True)


@query(
    "rank_funds",
    f"""WITH {_TRAILING},
    nivel AS (SELECT sk_fundo, abs(avg(variacao_pl_dia_pct)) * 0.5 + abs(avg(variacao_cotistas_dia_pct)) * 0.5 AS s
              FROM fct GROUP BY 1)
    SELECT k.periodo, k.sk_fundo, k.fluxo_liquido_periodo,
      CAST(rank() OVER (PARTITION BY k.periodo ORDER BY k.fluxo_liquido_periodo DESC) AS INTEGER) AS posicao,
      CASE WHEN s > 0 AND s <= 25 THEN 'baixo' WHEN s > 25 AND s <= 50 THEN 'medio' WHEN s > 50 THEN 'alto' END AS nivel_risco_fundo
    FROM kpi k LEFT JOIN nivel n USING (sk_fundo)""",
)
def rank_funds(spark, sf_dir):
    fact = bindings.fact(spark, sf_dir)
    return periods.rank_funds(periods.kpi_trailing_period(fact), periods.agg_fundo_periodo(fact))


@query(
    "period_profile",
    f"""WITH {sql.AGED} SELECT sk_fundo, periodo, round(CAST(avg(patrimonio_liquido_dia) AS DOUBLE), 4) AS pl_medio,
    max(patrimonio_liquido_dia) AS pl_maximo, min(patrimonio_liquido_dia) AS pl_minimo,
    arg_min(cotistas_dia, sk_data) AS cotistas_inicial, arg_max(cotistas_dia, sk_data) AS cotistas_final,
    min(sk_data) AS data_inicio, max(sk_data) AS data_fim, round(avg(variacao_pl_dia_pct), 4) AS retorno_medio_pct
    FROM idade JOIN periodos ON idade_dias < periodo GROUP BY ALL""",
)
def period_profile(spark, sf_dir):
    return _rounded(periods.period_profile(bindings.fact(spark, sf_dir)), "pl_medio", "retorno_medio_pct", places=4)


# ---- history, valuation, alerts ----


@query(
    "dim_fundo_scd2",
    """WITH dia AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, arg_max(o_orderstatus, o_orderkey) AS s FROM orders GROUP BY 1, 2),
    marca AS (SELECT *, lag(s) OVER w AS a, row_number() OVER w AS n FROM dia WINDOW w AS (PARTITION BY o_custkey ORDER BY d)),
    inicio AS (SELECT *, lead(d) OVER (PARTITION BY o_custkey ORDER BY d) AS proximo FROM marca WHERE n = 1 OR s IS DISTINCT FROM a)
    SELECT o_custkey, s AS o_orderstatus, d AS dt_inicio, proximo - 1 AS dt_fim_vigencia, proximo IS NULL AS vigente FROM inicio""",
)
def dim_fundo_scd2(spark, sf_dir):
    history = bindings.table(spark, sf_dir, "orders").withColumn("dia", F.col("o_orderdate").cast("date"))
    return joins.describe_status_runs(history, "o_custkey", "dia", "o_orderstatus", "o_orderkey")


@query(
    "holding_valuation",
    """WITH h AS (SELECT o_custkey AS cliente, l_partkey AS ativo, sum(CAST(l_quantity AS DECIMAL(17,3))) AS q
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
    p AS (SELECT l_partkey AS ativo, arg_max(l_extendedprice,
      epoch_us(l_shipdate) + l_orderkey * 10 + l_linenumber) AS preco FROM lineitem GROUP BY 1)
    SELECT cliente, count(*) AS ativos, CAST(sum(CAST(q AS DECIMAL(17,3)) * CAST(preco AS DECIMAL(19,2))) AS DOUBLE) AS valor_carteira
    FROM h JOIN p USING (ativo) GROUP BY 1""",
)
def holding_valuation(spark, sf_dir):
    lines = bindings.table(spark, sf_dir, "lineitem")
    orders = bindings.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("cliente"))
    holdings = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "cliente", F.col("l_partkey").alias("ativo"), F.col("l_quantity").alias("quantidade")
    )
    micros = F.unix_date(F.col("l_shipdate").cast("date")).cast("long") * F.lit(86_400_000_000)
    prices = lines.select(
        F.col("l_partkey").alias("ativo"),
        F.col("l_extendedprice").alias("preco"),
        (micros + F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("momento"),
    )
    return joins.holding_valuation(holdings, prices)


@query(
    "redemption_alert",
    f"""WITH {sql.REPORT}, lim AS (
      SELECT lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS cnpj, CAST(floor(s_acctbal / 5) AS DOUBLE) AS limite
      FROM supplier WHERE s_acctbal >= 0)
    SELECT cnpj AS classe, {sql.date_key('dia')} AS sk_data, resg / pl AS proporcao_resgate, limite
    FROM informe JOIN lim USING (cnpj) WHERE pl > 0 AND resg / pl > limite""",
)
def redemption_alert(spark, sf_dir):
    """Thresholds as stored text, one of every few not a number."""
    value = F.when(F.col("s_acctbal") >= 0, F.floor(F.col("s_acctbal") / 5).cast("string")).otherwise("sem limite")
    thresholds = bindings.table(spark, sf_dir, "supplier").select(
        F.lpad(F.col("s_suppkey").cast("string"), 9, "0").alias("fk_registro_classe"),
        F.lit("ALTA_RESGATE_PORCENTAGEM").alias("nome"),
        value.alias("valor"),
    )
    daily = _report(spark, sf_dir).withColumnRenamed(joins.CNPJ, "classe")
    alerts = joins.redemption_alert(daily, thresholds)
    return alerts.select("classe", gold.dates.date_key(F.col("data")).alias("sk_data"), "proporcao_resgate", "limite")
