"""Shared pieces of the reference SQL (DuckDB dialect)."""

from __future__ import annotations


def hash_key(text: str) -> str:
    """The md5 key, folded word by word as in the Spark expression."""
    remainder = "CAST(0 AS BIGINT)"
    for start in (1, 9, 17, 25):
        word = f"CAST('0x' || substr(md5({text}), {start}, 8) AS BIGINT)"
        remainder = f"(({remainder} * 967296 + {word}) % 1000000)"
    return remainder


def wide_key(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


def number_order(*columns: str) -> str:
    mixed = "CAST(0 AS BIGINT)"
    for c in columns:
        mixed = f"(({mixed} * 1000003 + {c} % 2147483648) % 2147483648)"
    return f"(({mixed} * 2654435761) % 4294967296)"


def date_key(day: str) -> str:
    return f"CAST(year({day}) * 10000 + month({day}) * 100 + day({day}) AS INTEGER)"


def key_to_date(key: str) -> str:
    return f"CAST(strptime(CAST({key} AS VARCHAR), '%Y%m%d') AS DATE)"


def ratio(current: str, previous: str) -> str:
    return (
        f"CASE WHEN {previous} <> 0 THEN {current} / {previous} - 1 "
        f"WHEN {previous} = 0 AND {current} > 0 THEN CAST('inf' AS DOUBLE) "
        f"WHEN {previous} = 0 AND {current} < 0 THEN CAST('-inf' AS DOUBLE) END"
    )


REPORT = """
informe AS (
  SELECT lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS cnpj, CAST(l_shipdate AS DATE) AS dia,
         CAST(sum(CAST(l_quantity AS DECIMAL(19,2))) AS DOUBLE) AS pl,
         CAST(sum(CASE WHEN l_returnflag <> 'R' THEN CAST(l_extendedprice AS DECIMAL(19,2)) ELSE 0 END) AS DOUBLE) AS capt,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(19,2)) ELSE 0 END) AS DOUBLE) AS resg,
         CAST(count(DISTINCT l_orderkey) AS DOUBLE) AS cot
  FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE))"""

DIM = f"""
dim AS (
  SELECT sk_fundo, cnpj, nome FROM (
    SELECT *, row_number() OVER (PARTITION BY sk_fundo ORDER BY cnpj, nome) AS rn FROM (
      SELECT {hash_key("regexp_replace(s_name, '[^0-9]', '', 'g')")} AS sk_fundo,
             regexp_replace(s_name, '[^0-9]', '', 'g') AS cnpj, s_name AS nome FROM supplier)) WHERE rn = 1)"""

DIM_WIDE = f"""
dim AS (
  SELECT {wide_key("cnpj")} AS sk_fundo, cnpj, min(nome) AS nome
  FROM (SELECT regexp_replace(s_name, '[^0-9]', '', 'g') AS cnpj, s_name AS nome FROM supplier) GROUP BY cnpj)"""

_FILLED = (
    "last_value({c} IGNORE NULLS) OVER (PARTITION BY sk_fundo ORDER BY dia "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
)

FACT = f"""{REPORT},{DIM},
cheio AS (
  SELECT i.*, d.sk_fundo, {_FILLED.format(c='pl')} AS pl_f, {_FILLED.format(c='cot')} AS cot_f
  FROM informe i JOIN dim d USING (cnpj)),
anterior AS (
  SELECT *, lag(pl_f) OVER (PARTITION BY sk_fundo ORDER BY dia) AS pl_a,
         lag(cot_f) OVER (PARTITION BY sk_fundo ORDER BY dia) AS cot_a FROM cheio),
fct AS (
  SELECT {date_key('dia')} AS sk_data, sk_fundo, cnpj AS cnpj_fundo_classe_norm, pl AS patrimonio_liquido_dia,
         capt AS captacao_dia, resg AS resgate_dia, cot AS cotistas_dia, capt - resg AS fluxo_liquido_dia,
         ({ratio('pl_f', 'pl_a')}) * 100 AS variacao_pl_dia_pct,
         ({ratio('cot_f', 'cot_a')}) * 100 AS variacao_cotistas_dia_pct, true AS flag_base_real
  FROM anterior)"""

FACT_WIDE = FACT.replace(DIM, DIM_WIDE)

TOTALS = """
totais AS (
  SELECT sk_fundo, CAST(sum(CAST(captacao_dia AS DECIMAL(19,2))) AS DOUBLE) AS captacao_periodo,
         CAST(sum(CAST(resgate_dia AS DECIMAL(19,2))) AS DOUBLE) AS resgate_periodo,
         CAST(sum(CAST(fluxo_liquido_dia AS DECIMAL(19,2))) AS DOUBLE) AS fluxo_liquido_periodo,
         avg(variacao_pl_dia_pct) AS vp, avg(variacao_cotistas_dia_pct) AS vc, max(sk_data) AS data_referencia
  FROM fct GROUP BY sk_fundo),
periodos AS (SELECT unnest([7, 30, 60, 90]) AS periodo)"""

AGG_LOCAL = f"""{FACT},{TOTALS},
agg AS (
  SELECT sk_fundo, periodo, captacao_periodo, resgate_periodo, fluxo_liquido_periodo,
         vp AS var_patrimonio_periodo_pct, vc AS var_cotistas_periodo_pct, data_referencia, score AS score_risco_fundo,
         CASE WHEN score > 0 AND score <= 25 THEN 'baixo' WHEN score > 25 AND score <= 50 THEN 'medio'
              WHEN score > 50 AND score <= 100 THEN 'alto' END AS nivel_risco_fundo
  FROM (SELECT *, CASE WHEN vp IS NOT NULL AND vc IS NOT NULL
                       THEN least(100.0, greatest(0.0, abs(vp) * 0.5 + abs(vc) * 0.5)) END AS score FROM totais), periodos)"""

AGG_CLOUD = f"""{FACT},{TOTALS},
agg AS (
  SELECT sk_fundo, periodo, captacao_periodo, resgate_periodo, fluxo_liquido_periodo,
         coalesce(vp, 0) AS var_patrimonio_periodo_pct, coalesce(vc, 0) AS var_cotistas_periodo_pct, data_referencia,
         score AS score_risco_fundo,
         CASE WHEN score > 0 AND score <= 45 THEN 'baixo' WHEN score > 45 AND score <= 70 THEN 'medio'
              WHEN score > 70 AND score <= 100 THEN 'alto' END AS nivel_risco_fundo
  FROM (SELECT *, least(100.0, greatest(0.0, 50 + abs(coalesce(vp, 0)) * 10)) AS score FROM totais), periodos)"""

AGED = f"""{FACT},
ultima AS (SELECT sk_fundo, max(sk_data) AS data_referencia FROM fct GROUP BY sk_fundo),
idade AS (
  SELECT f.*, u.data_referencia,
         date_diff('day', {key_to_date('f.sk_data')}, {key_to_date('u.data_referencia')}) AS idade_dias
  FROM fct f JOIN ultima u USING (sk_fundo)),
periodos AS (SELECT unnest([7, 30, 60, 90]) AS periodo)"""

MOVEMENTS = """
mov AS (
  SELECT user_id AS sk_cliente, CASE event_type WHEN 'purchase' THEN 'A' ELSE 'R' END AS nat,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS classe,
         CAST(value AS DECIMAL(19,2)) AS valor, ts FROM events WHERE event_type IN ('purchase', 'error'))"""

POSITION = f"""{MOVEMENTS},
fluxo AS (
  SELECT sk_cliente, CAST(ts AS DATE) AS dia, sum(CASE WHEN nat = 'A' THEN valor ELSE 0 END) AS aporte,
         sum(CASE WHEN nat = 'R' THEN valor ELSE 0 END) AS resgate FROM mov GROUP BY ALL),
calendario AS (
  SELECT CAST(unnest(generate_series((SELECT min(dia) FROM fluxo), (SELECT max(dia) FROM fluxo), INTERVAL 1 DAY)) AS DATE) AS dia),
denso AS (
  SELECT c.sk_cliente, k.dia, coalesce(f.aporte, 0) AS aporte, coalesce(f.resgate, 0) AS resgate,
         CASE WHEN f.dia IS NOT NULL THEN k.dia END AS mov_dia
  FROM (SELECT DISTINCT sk_cliente FROM mov) c CROSS JOIN calendario k
  LEFT JOIN fluxo f ON f.sk_cliente = c.sk_cliente AND f.dia = k.dia),
pos AS (
  SELECT sk_cliente, dia, {date_key('dia')} AS sk_data, CAST(aporte AS DOUBLE) AS aporte_dia,
         CAST(resgate AS DOUBLE) AS resgate_dia,
         CAST(sum(aporte - resgate) OVER (PARTITION BY sk_cliente ORDER BY dia) AS DOUBLE) AS saldo_dia,
         CAST(date_diff('day', last_value(mov_dia IGNORE NULLS) OVER (PARTITION BY sk_cliente ORDER BY dia
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), dia) AS INTEGER) AS dias_sem_movimentacao
  FROM denso)"""

FUND_POSITION = f"""{MOVEMENTS},
fluxo AS (
  SELECT sk_cliente, classe AS sk_fundo, CAST(ts AS DATE) AS dia, sum(CASE WHEN nat = 'A' THEN valor ELSE 0 END) AS aporte,
         sum(CASE WHEN nat = 'R' THEN valor ELSE 0 END) AS resgate FROM mov GROUP BY ALL),
calendario AS (
  SELECT CAST(unnest(generate_series((SELECT min(dia) FROM fluxo), (SELECT max(dia) FROM fluxo), INTERVAL 1 DAY)) AS DATE) AS dia),
denso AS (
  SELECT c.sk_cliente, c.sk_fundo, k.dia, coalesce(f.aporte, 0) AS aporte, coalesce(f.resgate, 0) AS resgate,
         CASE WHEN f.dia IS NOT NULL THEN k.dia END AS mov_dia
  FROM (SELECT DISTINCT sk_cliente, classe AS sk_fundo FROM mov) c CROSS JOIN calendario k
  LEFT JOIN fluxo f ON f.sk_cliente IS NOT DISTINCT FROM c.sk_cliente AND f.sk_fundo IS NOT DISTINCT FROM c.sk_fundo AND f.dia = k.dia),
pos AS (
  SELECT sk_cliente, sk_fundo, dia, {date_key('dia')} AS sk_data, CAST(aporte AS DOUBLE) AS aporte_dia,
         CAST(resgate AS DOUBLE) AS resgate_dia, CAST(sum(aporte - resgate) OVER j AS DOUBLE) AS saldo_dia,
         CAST(sum(aporte) OVER j AS DOUBLE) AS valor_investido,
         CAST(date_diff('day', last_value(mov_dia IGNORE NULLS) OVER j, dia) AS INTEGER) AS dias_sem_movimentacao
  FROM denso WINDOW j AS (PARTITION BY sk_cliente, sk_fundo ORDER BY dia ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

HISTORY = f"""{POSITION},
hist AS (
  SELECT *, lag(saldo_dia, 30) OVER c AS saldo_30, lag(saldo_dia, 7) OVER c AS saldo_7,
         row_number() OVER c AS dia_no,
         CASE WHEN sum(CAST(aporte_dia AS DECIMAL(19,2)) + CAST(resgate_dia AS DECIMAL(19,2))) OVER j > 0
              THEN CAST(sum(CAST(resgate_dia AS DECIMAL(19,2))) OVER j AS DOUBLE)
                   / CAST(sum(CAST(aporte_dia AS DECIMAL(19,2)) + CAST(resgate_dia AS DECIMAL(19,2))) OVER j AS DOUBLE)
              ELSE 0.0 END AS resgates_30d_pct,
         stddev_samp(CAST(CAST(aporte_dia AS DECIMAL(19,2)) - CAST(resgate_dia AS DECIMAL(19,2)) AS DOUBLE)) OVER j
              AS volatilidade_fluxo
  FROM pos
  WINDOW c AS (PARTITION BY sk_cliente ORDER BY dia),
         j AS (PARTITION BY sk_cliente ORDER BY dia ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))"""

_TERMS = [("resgates_30d_pct", 0.35), ("queda_saldo_30d_pct", 0.25), ("inatividade_dias", 0.2), ("volatilidade_fluxo", 0.2)]


def _part(i: int, term: str, weight: float) -> str:
    return (
        f"round(CASE WHEN d{i} > 1e-9 THEN (t.{term} - a{i}) / d{i} ELSE 0.0 END * {weight}, 6) AS p{i}"
    )


RISK = f"""{HISTORY},
termos AS (
  SELECT sk_cliente, dia, sk_data, saldo_dia, dias_sem_movimentacao, resgates_30d_pct,
         CASE WHEN var30 IS NOT NULL AND var30 < 0 THEN least(-var30, 1.0) ELSE 0.0 END AS queda_saldo_30d_pct,
         CAST(coalesce(dias_sem_movimentacao, dia_no) AS DOUBLE) AS inatividade_dias,
         coalesce(volatilidade_fluxo, 0.0) AS volatilidade_fluxo
  FROM (SELECT *, {ratio('saldo_dia', 'saldo_30')} AS var30 FROM hist)),
estat AS (
  SELECT dia, {', '.join(f'avg(round({t}, 6)) AS a{i}, stddev_pop(round({t}, 6)) AS d{i}' for i, (t, _) in enumerate(_TERMS))}
  FROM termos GROUP BY dia),
partes AS (
  SELECT t.*, {', '.join(_part(i, t, w) for i, (t, w) in enumerate(_TERMS))} FROM termos t JOIN estat e USING (dia)),
pontos AS (
  SELECT *, round(least(100.0, greatest(0.0, 50.0 + (p0 + p1 + p2 + p3) * 10)), 6) AS score_risco FROM partes),
churn AS (
  SELECT *, round(1.0 / (1.0 + exp(-(score_risco - 50.0) / 10.0)), 6) AS prob_churn,
         CASE WHEN score_risco < 45 THEN 'estavel' WHEN score_risco < 70 THEN 'atencao' ELSE 'critico' END AS nivel_risco,
         CASE greatest(p0, p1, p2, p3) WHEN p0 THEN 'resgates_30d_pct' WHEN p1 THEN 'queda_saldo_30d_pct'
              WHEN p2 THEN 'inatividade_dias' ELSE 'volatilidade_fluxo' END AS motivo_risco_dominante,
         round(score_risco - lag(score_risco, 7) OVER (PARTITION BY sk_cliente ORDER BY dia), 6) AS delta
  FROM pontos),
risco AS (
  SELECT *, round(greatest(saldo_dia, 0.0) * prob_churn, 2) AS valor_em_risco,
         CASE WHEN delta > 1 THEN 'subindo' WHEN delta < -1 THEN 'caindo' ELSE 'estavel' END AS tendencia_risco
  FROM churn)"""
