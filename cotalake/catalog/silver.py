"""Projections, cleaning, filters, predicates and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from cotalake.catalog import sql
from cotalake.catalog.registry import query
from cotalake.functions import dates, numbers, text
from cotalake.operators import cleaning, periods, quality, relationship
from cotalake.operators.resolve import (
    Wanted,
    column_mapping_report as mapping_report,
    inspect_schema as inspect,
    project_adaptive as project,
    rename_standard as rename,
    resolve_column as resolve,
    resolve_optional_column as resolve_optional,
)
from cotalake.plans import bindings
from cotalake.schemas import REPORT_NUMERIC


# ---- columns ----


@query("resolve_column", "SELECT o_orderkey AS pedido, o_totalprice AS valor FROM orders")
def resolve_column(spark, sf_dir):
    orders = bindings.table(spark, sf_dir, "orders")
    return orders.select(
        F.col(resolve(orders.columns, ["PEDIDO", "O_ORDERKEY"])).alias("pedido"),
        F.col(resolve(orders.columns, ["O_TotalPrice", "valor"])).alias("valor"),
    )


@query("resolve_optional_column", "SELECT p_partkey AS ativo, p_brand AS marca, CAST(NULL AS VARCHAR) AS publico FROM part")
def resolve_optional_column(spark, sf_dir):
    part = bindings.table(spark, sf_dir, "part")
    columns = {
        "ativo": resolve_optional(part.columns, ["P_PARTKEY"]),
        "marca": resolve_optional(part.columns, ["marca", "P_BRAND"]),
        "publico": resolve_optional(part.columns, ["Publico_Alvo", "PUBLICO_ALVO"]),
    }
    return part.select(*[(F.col(c) if c else F.lit(None).cast("string")).alias(n) for n, c in columns.items()])


@query(
    "project_adaptive",
    "SELECT p_partkey AS ativo, p_name AS nome, p_type AS tipo, p_size AS tamanho, CAST(NULL AS VARCHAR) AS publico FROM part",
)
def project_adaptive(spark, sf_dir):
    wanted = [
        Wanted("ativo", ["ATIVO", "P_PARTKEY"]),
        Wanted("nome", ["nome", "p_name"]),
        Wanted("tipo", ["TIPO_FUNDO", "P_TYPE"], required=False),
        Wanted("tamanho", ["p_size"], required=False, type="int"),
        Wanted("publico", ["Publico_Alvo"], required=False),
    ]
    return project(bindings.table(spark, sf_dir, "part"), wanted)


@query(
    "rename_standard",
    f"WITH {sql.REPORT} SELECT cnpj AS cnpj_fundo_classe, dia, pl AS patrimonio_liquido_dia, capt AS captacao_dia, "
    "resg AS resgate_dia, cot AS cotistas_dia FROM informe",
)
def rename_standard(spark, sf_dir):
    names = {
        "CNPJ_FUNDO_CLASSE": "cnpj_fundo_classe",
        "VL_PATRIM_LIQ": "patrimonio_liquido_dia",
        "CAPTC_DIA": "captacao_dia",
        "RESG_DIA": "resgate_dia",
        "NR_COTST": "cotistas_dia",
        "DT_COMPTC": "dia",
        "VL_QUOTA": "valor_cota",
    }
    return rename(bindings.daily_report(spark, sf_dir), names)


_MAPPED = [
    ("pedido", "o_orderkey", "alias", True),
    ("data", "o_orderdate", "override", True),
    ("valor", "o_totalprice", "alias", True),
    ("cota", None, "absent", False),
]


@query(
    "column_mapping_report",
    " UNION ALL ".join(
        f"SELECT '{n}' AS coluna_padrao, {repr(c) if c else 'CAST(NULL AS VARCHAR)'} AS coluna_origem, '{r}' AS regra, "
        f"count(*) AS registros, {f'count({c})' if c else '0'} AS preenchidos FROM orders"
        for n, c, r, _ in _MAPPED
    ),
)
def column_mapping_report(spark, sf_dir):
    wanted = [
        Wanted("pedido", ["PEDIDO", "O_ORDERKEY"]),
        Wanted("data", ["o_orderpriority"]),
        Wanted("valor", ["o_totalprice"]),
        Wanted("cota", ["VL_QUOTA"], required=False),
    ]
    return mapping_report(bindings.table(spark, sf_dir, "orders"), wanted, {"data": "O_ORDERDATE"})


_PROFILED = {
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
}


@query(
    "inspect_schema",
    " UNION ALL ".join(
        f"SELECT '{t}' AS tabela, {i} AS posicao, '{c}' AS coluna, count(*) AS registros, count({c}) AS preenchidos FROM {t}"
        for t, columns in _PROFILED.items()
        for i, c in enumerate(columns)
    ),
)
def inspect_schema(spark, sf_dir):
    return inspect({t: bindings.table(spark, sf_dir, t) for t in _PROFILED}).drop("tipo")


# ---- cleaning ----

_PAD_LEFT, _PAD_RIGHT = " \t ", "  \n"


@query("trim_text", f"SELECT doc_id, trim(text, '{text.BLANKS}') AS text, trim(source, '{text.BLANKS}') AS source FROM documents")
def trim_text(spark, sf_dir):
    """Whole texts, wrapped in blanks that a plain trim would leave."""
    docs = bindings.table(spark, sf_dir, "documents")
    padded = F.concat(F.lit(_PAD_LEFT), F.col("text"), F.lit(_PAD_RIGHT))
    return docs.select("doc_id", padded.alias("text"), "source").transform(cleaning.trim_text)


_HOLED = """SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS cliente,
    CASE WHEN o_orderstatus <> 'F' THEN NULL ELSE o_orderpriority END AS prioridade FROM orders"""


def _holed(spark, sf_dir):
    status = F.col("o_orderstatus")
    return bindings.table(spark, sf_dir, "orders").select(
        F.when(status != "P", F.col("o_custkey")).alias("cliente"),
        F.when(status == "F", F.col("o_orderpriority")).alias("prioridade"),
    )


@query("drop_all_null", f"SELECT * FROM ({_HOLED}) WHERE cliente IS NOT NULL OR prioridade IS NOT NULL")
def drop_all_null(spark, sf_dir):
    return cleaning.drop_all_null(_holed(spark, sf_dir))


@query("drop_critical_nulls", f"SELECT * FROM ({_HOLED}) WHERE cliente IS NOT NULL AND prioridade IS NOT NULL")
def drop_critical_nulls(spark, sf_dir):
    return cleaning.drop_critical_nulls(_holed(spark, sf_dir), ["cliente", "prioridade"])


@query("distinct_rows", f"SELECT DISTINCT * FROM ({_HOLED})")
def distinct_rows(spark, sf_dir):
    return cleaning.distinct_rows(_holed(spark, sf_dir))


@query(
    "basic_clean",
    f"""SELECT DISTINCT trim(text, '{text.BLANKS}') AS text, lang, source FROM documents
    WHERE text IS NOT NULL OR lang IS NOT NULL OR source IS NOT NULL""",
)
def basic_clean(spark, sf_dir):
    return cleaning.basic_clean(bindings.table(spark, sf_dir, "documents").select("text", "lang", "source"))


@query(
    "clean_filter_clean",
    f"SELECT DISTINCT trim(text, '{text.BLANKS}') AS text, role FROM conversations WHERE role <> 'system'",
)
def clean_filter_clean(spark, sf_dir):
    turns = bindings.table(spark, sf_dir, "conversations").select("text", "role")
    return cleaning.clean_filter(turns, lambda df: df.filter(F.col("role") != "system"))


_FUND_SQL = """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS Data_Adaptacao_RCVM175,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'FIP' WHEN '2-HIGH' THEN 'FIF' WHEN '3-MEDIUM' THEN 'FACFIF'
    WHEN '4-NOT SPECIFIED' THEN 'FI' ELSE 'FII' END AS Tipo_Fundo,
  CASE WHEN o_totalprice >= 100000 THEN 'Em Funcionamento Normal' ELSE 'Cancelada' END AS Situacao,
  CASE WHEN o_totalprice < 400000 THEN 'Aberto' ELSE 'Fechado' END AS Forma_Condominio FROM orders"""


@query(
    "filter_fund_registry",
    f"""SELECT * FROM ({_FUND_SQL}) WHERE Data_Adaptacao_RCVM175 IS NOT NULL AND Tipo_Fundo IN ('FIP', 'FIF', 'FACFIF', 'FI')
    AND Situacao = 'Em Funcionamento Normal' AND Forma_Condominio = 'Aberto'""",
)
def filter_fund_registry(spark, sf_dir):
    """The Exclusivo column is absent, so its rule does not apply."""
    kind = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "FIP")
        .when(F.col("o_orderpriority") == "2-HIGH", "FIF")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "FACFIF")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "FI")
        .otherwise("FII")
    )
    price = F.col("o_totalprice")
    registry = bindings.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date")).alias("Data_Adaptacao_RCVM175"),
        kind.alias("Tipo_Fundo"),
        F.when(price >= 100000, "Em Funcionamento Normal").otherwise("Cancelada").alias("Situacao"),
        F.when(price < 400000, "Aberto").otherwise("Fechado").alias("Forma_Condominio"),
    )
    return cleaning.filter_fund_registry(registry)


_CLASS_SQL = """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Renda Fixa' WHEN 'MACHINERY' THEN 'Ações'
    WHEN 'HOUSEHOLD' THEN 'Multimercado' ELSE 'Cambial' END AS Classificacao,
  CASE WHEN c_acctbal >= 0 THEN 'N' ELSE 'S' END AS Exclusivo,
  CASE WHEN c_acctbal < 9000 THEN 'Aberto' ELSE 'Fechado' END AS Forma_Condominio,
  CASE WHEN c_nationkey < 20 THEN 'Em Funcionamento Normal' ELSE 'Cancelada' END AS Situacao FROM customer"""


@query(
    "filter_class_registry",
    f"""SELECT * FROM ({_CLASS_SQL}) WHERE Forma_Condominio = 'Aberto' AND Classificacao IN ('Renda Fixa', 'Ações', 'Multimercado')
    AND Exclusivo = 'N' AND Situacao = 'Em Funcionamento Normal'""",
)
def filter_class_registry(spark, sf_dir):
    segment, balance = F.col("c_mktsegment"), F.col("c_acctbal")
    registry = bindings.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(segment == "BUILDING", "Renda Fixa")
        .when(segment == "MACHINERY", "Ações")
        .when(segment == "HOUSEHOLD", "Multimercado")
        .otherwise("Cambial")
        .alias("Classificacao"),
        F.when(balance >= 0, "N").otherwise("S").alias("Exclusivo"),
        F.when(balance < 9000, "Aberto").otherwise("Fechado").alias("Forma_Condominio"),
        F.when(F.col("c_nationkey") < 20, "Em Funcionamento Normal").otherwise("Cancelada").alias("Situacao"),
    )
    return cleaning.filter_class_registry(registry)


_SUBCLASS_SQL = """SELECT p_partkey, CASE WHEN p_size < 40 THEN 'Aberto' ELSE 'Fechado' END AS Forma_Condominio,
  CASE WHEN p_type = 'PROMO' THEN 'S' ELSE 'N' END AS Exclusivo, CASE WHEN p_type = 'LARGE' THEN 'S' ELSE 'N' END AS Exclusivo_INR,
  CASE WHEN p_retailprice > 950 THEN 'Em Funcionamento Normal' ELSE 'Pré-Operacional' END AS Situacao FROM part"""


@query(
    "filter_subclass_registry",
    f"""SELECT * FROM ({_SUBCLASS_SQL}) WHERE Forma_Condominio = 'Aberto' AND Exclusivo = 'N' AND Exclusivo_INR = 'N'
    AND Situacao = 'Em Funcionamento Normal'""",
)
def filter_subclass_registry(spark, sf_dir):
    registry = bindings.table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_size") < 40, "Aberto").otherwise("Fechado").alias("Forma_Condominio"),
        F.when(F.col("p_type") == "PROMO", "S").otherwise("N").alias("Exclusivo"),
        F.when(F.col("p_type") == "LARGE", "S").otherwise("N").alias("Exclusivo_INR"),
        F.when(F.col("p_retailprice") > 950, "Em Funcionamento Normal").otherwise("Pré-Operacional").alias("Situacao"),
    )
    return cleaning.filter_subclass_registry(registry)


@query(
    "coerce_daily_report",
    f"""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN {sql.date_key('o_orderdate')} END AS sk_data,
    CASE o_orderpriority WHEN '1-URGENT' THEN o_totalprice WHEN '2-HIGH' THEN o_totalprice END AS VL_PATRIM_LIQ,
    CASE o_orderpriority WHEN '1-URGENT' THEN CAST('inf' AS DOUBLE) WHEN '2-HIGH' THEN 1000.0 END AS CAPTC_DIA FROM orders""",
)
def coerce_daily_report(spark, sf_dir):
    """Order values as text with every kind of poison the coercion must turn into null."""
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    price = F.col("o_totalprice").cast("string")
    day = F.col("o_orderdate").cast("date").cast("string")
    text_report = bindings.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(status == "F", day)
        .when(status == "O", F.concat(day, F.lit(" 10:00")))
        .otherwise(F.date_format(F.col("o_orderdate"), "dd/MM/yyyy"))
        .alias("DT_COMPTC"),
        F.when(priority == "1-URGENT", price)
        .when(priority == "2-HIGH", F.concat(F.lit("  +"), price, F.lit(" ")))
        .when(priority == "3-MEDIUM", F.concat(price, F.lit("d")))
        .when(priority == "4-NOT SPECIFIED", F.replace(price, F.lit("."), F.lit(",")))
        .otherwise("")
        .alias("VL_PATRIM_LIQ"),
        F.when(priority == "1-URGENT", "inf").when(priority == "2-HIGH", "1e3").when(priority == "3-MEDIUM", "0x10")
        .when(priority == "4-NOT SPECIFIED", "1_0").otherwise("True")
        .alias("CAPTC_DIA"),
    )
    typed = cleaning.coerce_daily_report(text_report, numeric=REPORT_NUMERIC)
    return typed.select("o_orderkey", dates.date_key(F.col("DT_COMPTC")).alias("sk_data"), "VL_PATRIM_LIQ", "CAPTC_DIA")


_LOSSES = """CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS nulo,
    CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS vazio,
    CASE WHEN o_orderstatus <> 'P' AND o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS data_ruim"""


@query(
    "report_losses",
    f"""SELECT count(*) AS registros, CAST(sum(nulo) AS BIGINT) AS sem_cnpj, CAST(sum(vazio) AS BIGINT) AS cnpj_sem_digitos,
    CAST(sum(data_ruim) AS BIGINT) AS data_invalida, CAST(sum(1 - nulo - vazio - data_ruim) AS BIGINT) AS aproveitados
    FROM (SELECT {_LOSSES} FROM orders)""",
)
def report_losses(spark, sf_dir):
    """Orders as report rows: P without a tax id, some F with one that has no digits, 5-LOW with a broken date."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    blank = (status == "F") & (priority == "1-URGENT")
    report = bindings.table(spark, sf_dir, "orders").select(
        F.when(blank, "--").when(status != "P", F.col("o_custkey").cast("string")).alias("CNPJ_FUNDO_CLASSE"),
        F.when(priority == "5-LOW", "ontem").otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("DT_COMPTC"),
    )
    return quality.report_losses(report)


# ---- scalar expressions ----


@query("normalize_cnpj", "SELECT s_suppkey, regexp_replace(s_name, '[^0-9]', '', 'g') AS cnpj_fundo_classe_norm FROM supplier")
def normalize_cnpj(spark, sf_dir):
    return bindings.table(spark, sf_dir, "supplier").select(
        "s_suppkey", text.normalize_cnpj(F.col("s_name")).alias("cnpj_fundo_classe_norm")
    )


@query("hash_surrogate_key", f"SELECT c_custkey, {sql.hash_key('CAST(c_custkey AS VARCHAR)')} AS sk_fundo FROM customer")
def hash_surrogate_key(spark, sf_dir):
    return bindings.table(spark, sf_dir, "customer").select(
        "c_custkey", text.hash_key(F.col("c_custkey").cast("string")).alias("sk_fundo")
    )


@query("date_key", f"SELECT o_orderkey, {sql.date_key('o_orderdate')} AS sk_data, true AS ida_e_volta FROM orders")
def date_key(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    return bindings.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        dates.date_key(day).alias("sk_data"),
        (dates.key_to_date(dates.date_key(day)) == day).alias("ida_e_volta"),
    )


@query("month_key", f"SELECT {sql.date_key('o_orderdate')} // 100 AS ano_mes, count(*) AS pedidos FROM orders GROUP BY 1")
def month_key(spark, sf_dir):
    key = dates.month_key(dates.date_key(F.col("o_orderdate").cast("date")))
    return bindings.table(spark, sf_dir, "orders").groupBy(key.alias("ano_mes")).agg(F.count(F.lit(1)).alias("pedidos"))


@query("net_flow", f"WITH {sql.REPORT} SELECT cnpj, {sql.date_key('dia')} AS sk_data, capt - resg AS fluxo_liquido_dia FROM informe")
def net_flow(spark, sf_dir):
    return bindings.daily_report(spark, sf_dir).select(
        F.col("CNPJ_FUNDO_CLASSE").alias("cnpj"),
        dates.date_key(F.col("DT_COMPTC")).alias("sk_data"),
        numbers.net_flow(F.col("CAPTC_DIA"), F.col("RESG_DIA")).alias("fluxo_liquido_dia"),
    )


@query(
    "source_flag",
    f"WITH {sql.FACT} SELECT flag_base_real, count(*) AS registros FROM fct GROUP BY 1",
)
def source_flag(spark, sf_dir):
    return bindings.fact(spark, sf_dir).groupBy("flag_base_real").agg(F.count(F.lit(1)).alias("registros"))


@query(
    "fill_zero",
    f"WITH {sql.FACT} SELECT sk_fundo, sk_data, coalesce(variacao_pl_dia_pct, 0) AS variacao_pl_dia_pct FROM fct",
)
def fill_zero(spark, sf_dir):
    return bindings.fact(spark, sf_dir).select(
        "sk_fundo", "sk_data", periods.fill_zero(F.col("variacao_pl_dia_pct")).alias("variacao_pl_dia_pct")
    )


@query(
    "risk_score_local",
    f"""WITH {sql.FACT} SELECT sk_fundo, sk_data, CASE WHEN variacao_pl_dia_pct IS NOT NULL AND variacao_cotistas_dia_pct IS NOT NULL
    THEN least(100.0, greatest(0.0, abs(variacao_pl_dia_pct) * 0.5 + abs(variacao_cotistas_dia_pct) * 0.5)) END AS score FROM fct""",
)
def risk_score_local(spark, sf_dir):
    score = periods.risk_score_local(F.col("variacao_pl_dia_pct"), F.col("variacao_cotistas_dia_pct"))
    return bindings.fact(spark, sf_dir).select("sk_fundo", "sk_data", score.alias("score"))


@query(
    "risk_score_cloud",
    f"WITH {sql.FACT} SELECT sk_fundo, sk_data, least(100.0, greatest(0.0, 50 + abs(coalesce(variacao_pl_dia_pct, 0)) * 10)) AS score FROM fct",
)
def risk_score_cloud(spark, sf_dir):
    score = periods.risk_score_cloud(F.col("variacao_pl_dia_pct"))
    return bindings.fact(spark, sf_dir).select("sk_fundo", "sk_data", score.alias("score"))


def _band_sql(value: str, edges, labels) -> str:
    cases = " ".join(f"WHEN {value} > {a} AND {value} <= {b} THEN '{t}'" for a, b, t in zip(edges, edges[1:], labels))
    return f"CASE {cases} END"


@query(
    "risk_band",
    f"""SELECT p_partkey, {_band_sql('p_size * 2 - 2', periods.LOCAL_EDGES, periods.RISK_LABELS)} AS nivel_local,
    {_band_sql('p_size * 2 - 2', periods.CLOUD_EDGES, periods.RISK_LABELS)} AS nivel_nuvem FROM part""",
)
def risk_band(spark, sf_dir):
    """Sizes 1..50 as scores 0..98, so that every edge occurs."""
    score = F.col("p_size") * 2 - 2
    return bindings.table(spark, sf_dir, "part").select(
        "p_partkey",
        periods.risk_band(score).alias("nivel_local"),
        periods.risk_band(score, "cloud").alias("nivel_nuvem"),
    )


_BIRTH_SQL = "CAST(o_orderdate AS DATE) - CAST(floor(o_totalprice / 20) AS INTEGER)"


@query(
    "age_and_band",
    f"""SELECT o_orderkey, idade, {_band_sql('idade', relationship.AGE_EDGES, relationship.AGE_LABELS)} AS faixa_etaria
    FROM (SELECT o_orderkey, date_diff('day', {_BIRTH_SQL}, DATE '2024-01-01') / 365.25 AS idade
          FROM orders) """,
)
def age_and_band(spark, sf_dir):
    birth = F.date_sub(F.col("o_orderdate").cast("date"), F.floor(F.col("o_totalprice") / 20).cast("int"))
    age = dates.age_in_years(birth, F.lit("2024-01-01").cast("date")).cast("double")
    return (
        bindings.table(spark, sf_dir, "orders")
        .select("o_orderkey", age.alias("idade"))
        .withColumn("faixa_etaria", relationship.age_band(F.col("idade")))
    )


@query("format_business_id", "SELECT c_custkey, 'CLI_' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS id_cliente FROM customer")
def format_business_id(spark, sf_dir):
    return bindings.table(spark, sf_dir, "customer").select("c_custkey", text.business_id(F.col("c_custkey")).alias("id_cliente"))


@query("floor_value", "SELECT c_custkey, greatest(5000.0, c_acctbal) AS renda_estimada FROM customer")
def floor_value(spark, sf_dir):
    return bindings.table(spark, sf_dir, "customer").select(
        "c_custkey", numbers.floor_value(F.col("c_acctbal"), 5000).alias("renda_estimada")
    )


# ---- grouping and union ----


@query(
    "distinct_by_key",
    """SELECT o_custkey, o_orderkey, o_orderstatus FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def distinct_by_key(spark, sf_dir):
    orders = bindings.table(spark, sf_dir, "orders")
    first = cleaning.distinct_by_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return first.select("o_custkey", "o_orderkey", "o_orderstatus")


@query("row_counts", "SELECT event_type, count(*) AS registros FROM events GROUP BY 1")
def row_counts(spark, sf_dir):
    return cleaning.row_counts(bindings.table(spark, sf_dir, "events"), "event_type")


@query("month_counts", f"WITH {sql.FACT} SELECT sk_data // 100 AS ano_mes, count(*) AS registros FROM fct GROUP BY 1")
def month_counts(spark, sf_dir):
    return cleaning.month_counts(bindings.fact(spark, sf_dir))


@query(
    "union_all_by_name",
    """SELECT c_custkey AS chave, c_name AS nome, c_acctbal AS saldo, NULL AS tipo FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier
    UNION ALL SELECT p_partkey, p_name, NULL, p_type FROM part""",
)
def union_all_by_name(spark, sf_dir):
    customers = bindings.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("nome"), F.col("c_custkey").alias("chave"), F.col("c_acctbal").alias("saldo")
    )
    suppliers = bindings.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("chave"), F.col("s_acctbal").alias("saldo"), F.col("s_name").alias("nome")
    )
    parts = bindings.table(spark, sf_dir, "part").select(
        F.col("p_type").alias("tipo"), F.col("p_name").alias("nome"), F.col("p_partkey").alias("chave")
    )
    return cleaning.union_all_by_name(customers, suppliers, parts)
