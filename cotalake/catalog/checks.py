"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cotalake.catalog import sql
from cotalake.catalog.registry import query
from cotalake.operators import periods, quality
from cotalake.operators import relationship as rel
from cotalake.plans import bindings, gold, runs
from cotalake.session import scratch_path
from cotalake.sources import delimited


@query(
    "dq_reconcile_flow",
    f"""WITH {sql.FACT} SELECT count(*) AS registros, count(*) FILTER (WHERE fluxo_liquido_dia <> captacao_dia - resgate_dia) AS divergentes,
    0 AS incompletos, true AS aprovado FROM fct""",
)
def dq_reconcile_flow(spark, sf_dir):
    return quality.dq_reconcile_flow(bindings.fact(spark, sf_dir))


@query("dq_negative_pl", "SELECT count(*) AS registros, count(*) FILTER (WHERE c_acctbal < 0) AS negativos, count(*) FILTER (WHERE c_acctbal < 0) = 0 AS aprovado FROM customer")
def dq_negative_pl(spark, sf_dir):
    """Account balances as net assets: some are negative."""
    balances = bindings.table(spark, sf_dir, "customer").withColumnRenamed("c_acctbal", "patrimonio_liquido_dia")
    return quality.dq_negative_pl(balances)


@query(
    "dq_score_range",
    f"""WITH {sql.AGG_LOCAL} SELECT count(*) AS registros, count(*) FILTER (WHERE score_risco_fundo IS NULL OR score_risco_fundo NOT BETWEEN 0 AND 100) AS fora_da_faixa,
    count(*) FILTER (WHERE score_risco_fundo IS NULL OR score_risco_fundo NOT BETWEEN 0 AND 100) = 0 AS aprovado FROM agg""",
)
def dq_score_range(spark, sf_dir):
    return quality.dq_score_range(periods.agg_fundo_periodo(bindings.fact(spark, sf_dir)))


@query(
    "dq_status",
    f"""WITH {sql.AGG_LOCAL}, r AS (
      SELECT 'reconciliacao_fluxo' AS regra, count(*) AS n, count(*) FILTER (WHERE fluxo_liquido_dia <> captacao_dia - resgate_dia) AS v FROM fct
      UNION ALL SELECT 'patrimonio_negativo', count(*), count(*) FILTER (WHERE patrimonio_liquido_dia < 0) FROM fct
      UNION ALL SELECT 'faixa_score', count(*), count(*) FILTER (WHERE score_risco_fundo IS NULL OR score_risco_fundo NOT BETWEEN 0 AND 100) FROM agg)
    SELECT count(*) AS regras, max(n) AS registros, count(*) FILTER (WHERE v > 0) AS falhas,
      coalesce(string_agg(regra, ',' ORDER BY regra) FILTER (WHERE v > 0), '') AS erros,
      CASE WHEN count(*) FILTER (WHERE v > 0) > 0 THEN 'partial' ELSE 'success' END AS status,
      CASE WHEN count(*) FILTER (WHERE v > 0) > 0 THEN 207 ELSE 200 END AS status_code FROM r""",
)
def dq_status(spark, sf_dir):
    fact = bindings.fact(spark, sf_dir)
    checks = quality.fact_checks(fact).unionByName(quality.aggregate_checks(periods.agg_fundo_periodo(fact)))
    return quality.dq_status(checks)


@query(
    "dq_simulation_rules",
    f"""WITH {sql.RISK}, ultimo AS (SELECT * FROM risco WHERE sk_data = (SELECT max(sk_data) FROM risco))
    SELECT 'saldo_negativo' AS regra, count(*) AS registros, count(*) FILTER (WHERE saldo_dia < 0) AS violacoes FROM pos
    UNION ALL SELECT 'churn_fora_0_1', count(*), 0 FROM risco
    UNION ALL SELECT 'posicao_longe_do_pl', count(*), count(*) FILTER (WHERE c_acctbal IS NULL OR abs(CAST(p.s AS DOUBLE) - c_acctbal * 2.0) > 0.5 * abs(c_acctbal * 2.0)) FROM (
      SELECT sk_cliente, sk_data, sum(CAST(saldo_dia AS DECIMAL(19,2))) AS s FROM pos GROUP BY ALL) p LEFT JOIN customer ON c_custkey = sk_cliente""",
)
def dq_simulation_rules(spark, sf_dir):
    """Balances per user and day against twice the account balance of the customer with that number."""
    moves = bindings.movements(spark, sf_dir).withColumnRenamed("fk_cliente", "sk_cliente")
    position = rel.client_daily_position(moves)
    risk = rel.client_risk(rel.with_history(position))
    held = position.select(F.col("sk_cliente").alias("sk_fundo"), "sk_data", "saldo_dia")
    balance = bindings.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("sk_fundo"), F.col("c_acctbal").alias("patrimonio"))
    equity = held.select("sk_fundo", "sk_data").distinct().join(balance, "sk_fundo")
    return quality.dq_simulation_rules(held, risk, equity, scale=2.0, tolerance=0.5)


@query(
    "layer_losses",
    f"""WITH {sql.DIM.replace("FROM supplier", "FROM supplier WHERE s_acctbal >= 0")},
    cadastro AS (SELECT regexp_replace(s_name, '[^0-9]', '', 'g') AS c FROM supplier WHERE s_acctbal >= 0),
    linhas AS (SELECT l_linenumber AS n, c.c IS NOT NULL AS conhecido, d.cnpj IS NOT NULL AS mantido FROM lineitem
      LEFT JOIN cadastro c ON c.c = lpad(CAST(l_suppkey AS VARCHAR), 9, '0') LEFT JOIN dim d ON d.cnpj = lpad(CAST(l_suppkey AS VARCHAR), 9, '0'))
    SELECT count(*) + count(*) FILTER (WHERE n IN (5, 6)) AS lidas, count(*) FILTER (WHERE n = 1) AS campos_demais,
      count(*) FILTER (WHERE n = 6) AS vazias, count(*) FILTER (WHERE n = 5) AS repetidas, count(*) FILTER (WHERE n = 2) AS sem_cnpj,
      count(*) FILTER (WHERE n = 3) AS cnpj_sem_digitos, count(*) FILTER (WHERE n = 4) AS data_invalida,
      count(*) FILTER (WHERE n > 4 AND NOT conhecido) AS sem_cadastro, count(*) FILTER (WHERE n > 4 AND conhecido AND NOT mantido) AS chave_colidida,
      count(*) FILTER (WHERE n > 4 AND mantido) AS aproveitados, 0 AS sem_explicacao FROM linhas""",
)
def layer_losses(spark, sf_dir):
    """Line items as the lines of daily reports, some spoiled by their line number; suppliers in credit as the registry."""
    landed, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    raw = {"header": True, "sep": delimited.NO_SEPARATOR, "quote": "", "encoding": delimited.LATIN1}
    state = F.when(F.col("s_acctbal") >= 0, "Em Funcionamento Normal").otherwise("Cancelada")
    registry = bindings.table(spark, sf_dir, "supplier").select(F.concat_ws(";", "s_name", "s_name", state))
    registry.coalesce(1).toDF("CNPJ_Classe;Denominacao_Social;Situacao").write.options(**raw).csv(f"{landed}/registro_classe")
    number = F.col("l_linenumber")
    cnpj = F.when(number == 2, "").when(number == 3, "--").otherwise(F.lpad(F.col("l_suppkey").cast("string"), 9, "0"))
    day = F.when(number == 4, "ontem").otherwise(F.col("l_shipdate").cast("date").cast("string"))
    fields = [cnpj, day, "l_orderkey", "l_extendedprice", "l_partkey", "l_linenumber"]
    line = F.when(number == 1, F.concat_ws(";", *fields, F.lit("sobra"))).otherwise(F.concat_ws(";", *fields))
    blank = F.lit(";;;;;")
    repeats = F.explode(F.when(number == 5, F.array(line, line)).when(number == 6, F.array(line, blank)).otherwise(F.array(line)))
    report = bindings.table(spark, sf_dir, "lineitem").select(repeats)
    header = "CNPJ_FUNDO_CLASSE;DT_COMPTC;VL_PATRIM_LIQ;CAPTC_DIA;RESG_DIA;NR_COTST"
    report.toDF(header).write.options(**raw).csv(f"{landed}/inf_diario_fi_todos.csv")
    runs.silver_layer(spark, landed, silver)
    return runs.layer_losses(spark, silver, gold.dim_fundo(runs.read_silver(spark, silver)[0]))
