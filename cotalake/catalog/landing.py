"""Sources and sinks, run over files that Spark writes from the supplied tables."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from cotalake.catalog import sql
from cotalake.catalog.registry import query
from cotalake.functions import dates, text
from cotalake.operators import cleaning, joins, periods
from cotalake.plans import bindings
from cotalake.session import scratch_path
from cotalake.sinks import publish, writers
from cotalake.sources import archives, delimited, listing, objects, operational, quoted

ORDER_TEXT = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "dia", "o_orderpriority"]


def orders_as_text(spark, sf_dir):
    return bindings.table(spark, sf_dir, "orders").withColumn("dia", F.col("o_orderdate").cast("date")).select(*ORDER_TEXT)


def _typed(df, *more):
    return df.select(
        F.col("o_orderkey").cast("bigint"),
        F.col("o_custkey").cast("bigint"),
        "o_orderstatus",
        F.col("o_totalprice").cast("double"),
        dates.date_key(dates.parse_report_date(F.col("dia"))).alias("sk_data"),
        "o_orderpriority",
        *more,
    )


ORDERS_SQL = (
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
    f"{sql.date_key('o_orderdate')} AS sk_data, o_orderpriority FROM orders"
)


def _write_lines(lines, header: str, path: str) -> None:
    """Write a one-column frame as raw lines under a raw header line."""
    lines.toDF(header).write.mode("overwrite").options(header=True, sep="\x01", quote="", encoding=delimited.LATIN1).csv(path)


@query("scan_delimited", ORDERS_SQL)
def scan_delimited(spark, sf_dir):
    path = scratch_path(spark, "delimited")
    writers.sink_csv(orders_as_text(spark, sf_dir), path, encoding=delimited.LATIN1)
    return _typed(delimited.scan_delimited(spark, path))


@query(
    "scan_quoted",
    f"""SELECT o.*, n.linhas, n.tamanho FROM ({ORDERS_SQL}) o JOIN (SELECT o_orderkey AS k, 3 AS linhas,
    length(o_clerk) + length(o_comment) + 8 AS tamanho FROM (SELECT *, o_orderpriority AS o_clerk, o_orderstatus AS o_comment FROM orders)) n
    ON k = o_orderkey""",
)
def scan_quoted(spark, sf_dir):
    """Orders with a field of three lines, a quoted word and separators in it."""
    path = scratch_path(spark, "quoted")
    note = F.concat_ws("\n", F.concat(F.lit('"'), F.col("o_orderpriority"), F.lit('"')), F.lit(";;"), F.concat(F.col("o_orderstatus"), F.lit('""')))
    writers.sink_csv(orders_as_text(spark, sf_dir).withColumn("nota", note), path)
    read = quoted.scan_quoted(spark, path, [*ORDER_TEXT, "nota"], encoding="UTF-8")
    return _typed(read, (F.regexp_count("nota", F.lit("\n")) + 1).alias("linhas"), F.length("nota").alias("tamanho"))


@query(
    "sniff_separator",
    "SELECT o_orderstatus, CASE o_orderstatus WHEN 'F' THEN ';' ELSE ',' END AS separador FROM orders GROUP BY 1",
)
def sniff_separator(spark, sf_dir):
    """F is written with ';', O with ',' and P as one column, where the tie gives ','."""
    path = scratch_path(spark, "sniff")
    orders = orders_as_text(spark, sf_dir)
    two = ["o_orderkey", "o_totalprice"]
    for status, sep, columns in (("F", ";", two), ("O", ",", two), ("P", ";", two[:1])):
        writers.sink_csv(orders.filter(F.col("o_orderstatus") == status).select(*columns), f"{path}/status={status}", sep)
    found = delimited.sniff_separator(spark, f"{path}/*")
    return found.select(F.regexp_extract("arquivo", "status=([A-Z])/", 1).alias("o_orderstatus"), "separador").distinct()


@query(
    "scan_union_by_name",
    f"SELECT *, 'a' AS lote FROM ({ORDERS_SQL}) UNION ALL SELECT * REPLACE (NULL AS o_orderpriority), 'b' FROM ({ORDERS_SQL})",
)
def scan_union_by_name(spark, sf_dir):
    """All orders twice: ';' files, and ',' files with another column order and one column fewer."""
    path = scratch_path(spark, "union")
    orders = orders_as_text(spark, sf_dir)
    writers.sink_csv(orders.withColumn("lote", F.lit("a")), f"{path}/inf_a", ";")
    fewer = [c for c in reversed(ORDER_TEXT) if c != "o_orderpriority"]
    writers.sink_csv(orders.select(F.lit("b").alias("lote"), *fewer), f"{path}/inf_b", ",")
    scanned = delimited.scan_union_by_name(spark, f"{path}/*")
    return _typed(scanned, "lote")


@query(
    "scan_tolerant",
    "SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS o_orderstatus, "
    "o_orderstatus = 'P' AS quarentena FROM orders",
)
def scan_tolerant(spark, sf_dir):
    """F rows lack the last field, P rows have one too many (sometimes an empty one)."""
    path = scratch_path(spark, "tolerant")
    status = F.col("o_orderstatus")
    extra = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("")).otherwise(F.lit("sobra"))
    fields = F.concat_ws(";", F.col("o_orderkey"), F.col("o_totalprice"))
    line = (
        F.when(status == "F", fields)
        .when(status == "P", F.concat_ws(";", fields, status, extra))
        .otherwise(F.concat_ws(";", fields, status))
    )
    names = ["o_orderkey", "o_totalprice", "o_orderstatus"]
    _write_lines(orders_as_text(spark, sf_dir).select(line), ";".join(names), path)
    scanned = delimited.scan_tolerant(spark, path, names)
    kept = delimited.good_rows(scanned).withColumn("quarentena", F.lit(False))
    set_aside = delimited.quarantine(scanned).drop(delimited.BROKEN).withColumn("quarentena", F.lit(True))
    return kept.unionByName(set_aside).select(
        F.col("o_orderkey").cast("bigint"), F.col("o_totalprice").cast("double"), "o_orderstatus", "quarentena"
    )


@query("list_csv_objects", "SELECT DISTINCT o_orderstatus, true AS tem_bytes FROM orders")
def list_csv_objects(spark, sf_dir):
    """A folder tree of CSV and Parquet files; only the CSV ones are listed."""
    path = scratch_path(spark, "objects")
    orders = orders_as_text(spark, sf_dir)
    orders.write.partitionBy("o_orderstatus").option("header", True).csv(f"{path}/csv")
    orders.withColumn("outra", F.concat(F.lit("p"), "o_orderstatus")).write.partitionBy("outra").parquet(f"{path}/parquet")
    listed = objects.list_csv_objects(spark, path)
    folder = F.regexp_extract("caminho", r"=([^/]*)/[^/]*$", 1)
    return listed.groupBy(folder.alias("o_orderstatus")).agg((F.min("tamanho") > 0).alias("tem_bytes"))


_NAMED_ORDERS = "SELECT *, o_orderpriority || '/' || CAST(o_orderkey AS VARCHAR) || '.csv' AS chave FROM orders"


def _order_objects(spark, sf_dir):
    orders = bindings.table(spark, sf_dir, "orders")
    key = F.concat(F.col("o_orderpriority"), F.lit("/"), F.col("o_orderkey").cast("string"), F.lit(".csv"))
    return orders.select("o_custkey", key.alias("chave"), dates.date_key(F.col("o_orderdate").cast("date")).alias("modificado"))


@query(
    "latest_by_pattern",
    f"""WITH n AS ({_NAMED_ORDERS}),
    c AS (SELECT o_custkey, chave, {sql.date_key('o_orderdate')} AS modificado,
          row_number() OVER (PARTITION BY o_custkey ORDER BY {sql.date_key('o_orderdate')} DESC, chave DESC) AS rn
          FROM n WHERE lower(chave) LIKE '%urgent%')
    SELECT a.o_custkey, c.chave, c.modificado FROM (SELECT DISTINCT o_custkey FROM orders) a
    LEFT JOIN c ON c.o_custkey = a.o_custkey AND c.rn = 1""",
)
def latest_by_pattern(spark, sf_dir):
    return joins.latest_by_pattern(_order_objects(spark, sf_dir), "chave", "modificado", "urgent", ["o_custkey"])


@query(
    "top1_latest",
    f"""SELECT chave, {sql.date_key('o_orderdate')} AS modificado FROM ({_NAMED_ORDERS})
    ORDER BY 2 DESC, 1 DESC LIMIT 1""",
)
def top1_latest(spark, sf_dir):
    return joins.latest_by_pattern(_order_objects(spark, sf_dir), "chave", "modificado", ".csv")


@query("single_file_by_pattern", "SELECT 'registro_classe' AS arquivo, count(*) AS registros FROM orders WHERE o_orderstatus = 'O'")
def single_file_by_pattern(spark, sf_dir):
    """Three registries land, one for each status; the one asked for is found by name and read."""
    path = scratch_path(spark, "single")
    orders = orders_as_text(spark, sf_dir)
    for status, name in (("F", "registro_fundo"), ("O", "registro_classe"), ("P", "registro_subclasse")):
        writers.sink_csv(orders.filter(F.col("o_orderstatus") == status), f"{path}/{name}")
    found = objects.single_file_by_pattern(spark, path, "registro_classe").first()["caminho"]
    folder = found.rsplit("/", 1)[0]
    return delimited.scan_delimited(spark, folder).agg(
        F.lit(folder.rsplit("/", 1)[-1]).alias("arquivo"), F.count(F.lit(1)).alias("registros")
    )


PAGE_SUFFIXES = ("e", "n", "s", ".")
_LINKS_SQL = r"""
bruto AS (SELECT page_id, url AS base, regexp_extract_all(html, '(?i)<a\s+href="([^"]+)">[^<]*</a>', 1) AS hrefs FROM pages),
ligacoes AS (
  SELECT page_id AS pagina, CAST(i - 1 AS INTEGER) AS posicao, hrefs[i] AS href, base
  FROM (SELECT *, unnest(generate_series(1, len(hrefs))) AS i FROM bruto)),
links AS (
  SELECT pagina, posicao, regexp_extract(base, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || href AS url,
         regexp_extract(regexp_replace(href, '[?#].*$', ''), '([^/]*)$', 1) AS nome
  FROM ligacoes WHERE href NOT LIKE '%/')"""
_SUFFIX_SQL = "lower(url) LIKE '%e' OR lower(url) LIKE '%n' OR lower(url) LIKE '%s' OR lower(url) LIKE '%.'"


@query("extract_listing_links", f"WITH {_LINKS_SQL} SELECT DISTINCT url, nome FROM links WHERE {_SUFFIX_SQL}")
def extract_listing_links(spark, sf_dir):
    pages = bindings.table(spark, sf_dir, "pages")
    return listing.extract_listing_links(pages, pattern=listing.PLAIN_LINK, suffixes=PAGE_SUFFIXES).select("url", "nome")


def _page_links(spark, sf_dir):
    pages = bindings.table(spark, sf_dir, "pages")
    return listing.find_links(pages, "page_id", "url", "html", listing.PLAIN_LINK, None)


@query(
    "distinct_by_url",
    f"""WITH {_LINKS_SQL} SELECT url, pagina, posicao FROM (
    SELECT *, row_number() OVER (PARTITION BY url ORDER BY pagina, posicao) AS rn FROM links) WHERE rn = 1""",
)
def distinct_by_url(spark, sf_dir):
    return listing.distinct_by_url(_page_links(spark, sf_dir)).select("url", "pagina", "posicao")


@query("sort_by_name", f"WITH {_LINKS_SQL} SELECT nome, url, pagina, posicao FROM links ORDER BY nome, url")
def sort_by_name(spark, sf_dir):
    return listing.sort_by_name(_page_links(spark, sf_dir).select("nome", "url", "pagina", "posicao"))


@query(
    "classify_resource",
    "SELECT page_id, (lower(url) LIKE '%.html' AND contains(lower(url), '/en/')) OR contains(lower(url), 'blog') AS relevante FROM pages",
)
def classify_resource(spark, sf_dir):
    rules = ((".html", "/en/"), ("", "blog"))
    return bindings.table(spark, sf_dir, "pages").select(
        "page_id", listing.classify_resource(F.col("url"), rules).alias("relevante")
    )


@query(
    "consolidate_sources",
    rf"""WITH {_LINKS_SQL},
    todas AS (
      SELECT url, nome, 0 AS fonte, posicao FROM links UNION ALL
      SELECT url, regexp_extract(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://[^/]*', ''), '([^/]*)$', 1), 1,
             CAST(page_id AS INTEGER) FROM pages),
    certas AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY fonte, posicao, nome) AS rn FROM todas
      WHERE (lower(nome) LIKE '%e' AND contains(lower(nome), 'r')) OR contains(lower(nome), '1'))
    SELECT url, nome, fonte FROM certas WHERE rn = 1""",
)
def consolidate_sources(spark, sf_dir):
    """Links found on the pages, then the pages themselves."""
    links = _page_links(spark, sf_dir).select("url", "nome", "modificado", "posicao")
    own = bindings.table(spark, sf_dir, "pages").select(
        "url",
        text.last_path_segment(listing.url_path(F.col("url"))).alias("nome"),
        F.lit(None).cast("timestamp").alias("modificado"),
        F.col("page_id").cast("int").alias("posicao"),
    )
    return listing.consolidate_sources([links, own], (("e", "r"), ("", "1"))).select("url", "nome", "fonte")


def _zip_batches(batches):
    """Each batch of lines as a good archive (a CSV and a note) and a truncated copy of it."""
    for batch in batches:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("dados/pedidos.csv", "\n".join(batch["linha"]) + "\n")
            archive.writestr("LEIAME.txt", "nota")
        whole = buffer.getvalue()
        first = batch["linha"].iloc[0].split(";")[0]
        yield pd.DataFrame({"path": [f"{first}.zip", f"{first}_truncado.zip"], "content": [whole, whole[: len(whole) // 2]]})


@query(
    "expand_archives",
    "SELECT 'dados/pedidos.csv' AS membro, CAST(o_orderkey AS VARCHAR) || ';' || CAST(o_custkey AS VARCHAR) || ';' || o_orderstatus AS texto FROM orders",
)
def expand_archives(spark, sf_dir):
    line = F.concat_ws(";", F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"))
    packed = bindings.table(spark, sf_dir, "orders").select(line.alias("linha")).mapInPandas(
        _zip_batches, "path string, content binary"
    )
    return archives.csv_lines(archives.expand_archives(packed)).select("membro", "texto")


def _operational(spark, sf_dir):
    """Each operational table from the supplied tables, under the declared column names."""
    t = {n: bindings.table(spark, sf_dir, n) for n in ("customer", "supplier", "nation", "region", "part", "orders", "lineitem")}
    order_lines = t["lineitem"]
    segment_id = F.conv(F.substring(F.md5("c_mktsegment"), 1, 6), 16, 10).cast("int")
    return {
        "segmento": t["customer"].select(segment_id.alias("id_segmento"), F.col("c_mktsegment").alias("nome")).distinct(),
        "cliente": t["customer"].select(
            F.col("c_custkey").alias("id_cliente"), segment_id.alias("fk_segmento"), F.col("c_name").alias("nome"),
            text.normalize_cnpj(F.col("c_name")).alias("cpf_cnpj"),
        ),
        "gerente": t["nation"].select(F.col("n_nationkey").alias("id_gerente"), F.col("n_name").alias("nome")),
        "cliente_gerente": t["customer"].select(
            F.col("c_custkey").alias("id_cliente_gerente"), F.col("c_custkey").alias("cliente_id_cliente"),
            F.col("c_nationkey").alias("gerente_id_gerente"),
        ),
        "fundo": t["supplier"].select(
            F.col("s_suppkey").alias("id_registro_fundo"), text.normalize_cnpj(F.col("s_name")).alias("cnpj"),
            F.col("s_name").alias("denominacao_social"),
        ),
        "gestor_fundo": t["region"].select(F.col("r_regionkey").alias("id_gestor_fundo"), F.col("r_name").alias("nome")),
        "usuario": t["nation"].select(
            F.col("n_nationkey").alias("id_usuario"), F.col("n_nationkey").alias("fk_gerente"),
            F.col("n_regionkey").alias("fk_gestor_fundo"),
        ),
        "classe": t["supplier"].select(
            F.col("s_suppkey").alias("id_registro_classe"), F.col("s_suppkey").alias("fk_registro_fundo"),
            F.col("s_name").alias("denominacao_social"),
        ),
        "subclasse": t["part"].select(
            F.col("p_partkey").alias("id_subclasse"), F.col("p_size").alias("codigo_cvm"),
            F.col("p_name").alias("denominacao_social"),
        ),
        "informe_diario": order_lines.select(
            F.col("l_orderkey").alias("id_patrimonio_liquido"), F.col("l_shipdate").alias("data_competencia"),
            F.col("l_extendedprice").alias("valor_patrimonio_liquido"),
        ),
        "fundo_cotista": order_lines.select(
            F.col("l_orderkey").alias("id_fundo_cotista"), F.col("l_suppkey").alias("fk_registro_classe"),
            F.col("l_quantity").alias("quantidade_cotas"),
        ),
        "parametro_alerta": t["supplier"].select(
            F.col("s_suppkey").alias("id_parametro_alerta"), F.col("s_suppkey").alias("fk_registro_classe"),
            F.lit("0.20").alias("valor"),
        ),
        "aplicacao_resgate": bindings.table(spark, sf_dir, "events").select(
            F.col("event_id").alias("id_aplicacao_resgate"), F.col("user_id").alias("fk_cliente"), F.col("value").alias("valor"),
        ),
    }


# Columns of each operational table, as its definition lists them.
_OP_COLUMNS = {
    "segmento": 2, "cliente": 7, "gerente": 4, "cliente_gerente": 5, "fundo": 15, "gestor_fundo": 3, "usuario": 5, "classe": 13,
    "subclasse": 8, "informe_diario": 12, "fundo_cotista": 6, "parametro_alerta": 5, "aplicacao_resgate": 7,
}
_OP_COUNTS = {
    "segmento": "SELECT count(DISTINCT c_mktsegment) AS n FROM customer", "cliente": "SELECT count(*) FROM customer",
    "gerente": "SELECT count(*) FROM nation", "cliente_gerente": "SELECT count(*) FROM customer",
    "fundo": "SELECT count(*) FROM supplier", "gestor_fundo": "SELECT count(*) FROM region",
    "usuario": "SELECT count(*) FROM nation", "classe": "SELECT count(*) FROM supplier",
    "subclasse": "SELECT count(*) FROM part", "informe_diario": "SELECT count(*) FROM lineitem",
    "fundo_cotista": "SELECT count(*) FROM lineitem", "parametro_alerta": "SELECT count(*) FROM supplier",
    "aplicacao_resgate": "SELECT count(*) FROM events",
}


@query(
    "op_schema",
    " UNION ALL ".join(
        f"SELECT '{t}' AS tabela, {_OP_COLUMNS[t]} AS colunas, ({c}) AS registros, ({c}) AS chaves"
        for t, c in _OP_COUNTS.items()
    ),
)
def op_schema(spark, sf_dir):
    """Every operational table under its declared types: columns, rows and rows with a key."""
    profile = None
    for name, df in _operational(spark, sf_dir).items():
        typed = operational.operational_table(df, name)
        row = typed.agg(
            F.lit(name).alias("tabela"),
            F.lit(len(typed.columns)).alias("colunas"),
            F.count(F.lit(1)).alias("registros"),
            F.count(typed.columns[0]).alias("chaves"),
        )
        profile = row if profile is None else profile.unionByName(row)
    return profile


# ---- sinks ----


@query("sink_csv", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def sink_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    writers.sink_csv(bindings.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"), path)
    back = delimited.scan_delimited(spark, path, encoding="UTF-8")
    return back.withColumns({"c_custkey": F.col("c_custkey").cast("bigint"), "c_acctbal": F.col("c_acctbal").cast("double")})


@query("sink_parquet", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def sink_parquet(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    writers.sink_parquet(bindings.table(spark, sf_dir, "documents"), path)
    return spark.read.parquet(path).select("doc_id", "text", "lang", "source", "n_chars")


@query(
    "sink_dual",
    "SELECT f AS forma, count(*) AS registros, CAST(sum(CAST(o_totalprice AS DECIMAL(19,2))) AS DOUBLE) AS total "
    "FROM orders, (SELECT unnest(['csv', 'parquet']) AS f) GROUP BY f",
)
def sink_dual(spark, sf_dir):
    path = scratch_path(spark, "dual")
    writers.sink_dual(spark, orders_as_text(spark, sf_dir), path)

    def measure(df, form):
        return df.agg(
            F.lit(form).alias("forma"),
            F.count(F.lit(1)).alias("registros"),
            F.sum(F.col("o_totalprice").cast("decimal(19,2)")).cast("double").alias("total"),
        )

    text_side = delimited.scan_delimited(spark, f"{path}/csv", encoding="UTF-8")
    return measure(text_side, "csv").unionByName(measure(spark.read.parquet(f"{path}/parquet"), "parquet"))


@query(
    "sink_partitioned_month",
    f"WITH {sql.FACT} SELECT sk_data // 100 AS ano_mes, count(*) AS registros, min(sk_data) AS primeiro, max(sk_data) AS ultimo FROM fct GROUP BY 1",
)
def sink_partitioned_month(spark, sf_dir):
    path = scratch_path(spark, "month")
    writers.sink_partitioned_month(bindings.fact(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy("ano_mes").agg(
        F.count(F.lit(1)).alias("registros"), F.min("sk_data").alias("primeiro"), F.max("sk_data").alias("ultimo")
    )


@query("overwrite_full_load", ORDERS_SQL)
def overwrite_full_load(spark, sf_dir):
    """The first load is larger and must leave nothing behind; the last reads the table that it replaces."""
    path = scratch_path(spark, "full")
    orders = orders_as_text(spark, sf_dir)
    publish.publish_table(orders.unionByName(orders), path)
    publish.publish_table(orders, path)
    publish.publish_table(publish.published_table(spark, path), path)
    return _typed(publish.published_table(spark, path).withColumn("dia", F.col("dia").cast("string")))


@query(
    "per_file_output",
    "SELECT o_orderstatus, true AS nome_certo, count(*) AS registros FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders) GROUP BY 1",
)
def per_file_output(spark, sf_dir):
    """One file per status, each holding its (customer, status) pairs with repeats, is cleaned file by file."""
    source, path = scratch_path(spark, "files"), scratch_path(spark, "files_clean")
    pairs = bindings.table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus")
    for status in ("F", "O", "P"):
        writers.sink_csv(pairs.filter(F.col("o_orderstatus") == status).hint("rebalance"), f"{source}/{status}")
    raw = writers.with_output_name(spark.read.options(header=True, sep=";").csv(f"{source}/*"))
    writers.per_file_output(raw.transform(cleaning.basic_clean), path)
    back = spark.read.options(header=True, sep=";").csv(path)
    # A folder may hold several files at scale; the repeats across them are the input's own.
    return (
        back.select("o_custkey", "o_orderstatus", F.col("origem").rlike("_clean[.]csv$").alias("_ok"))
        .groupBy("o_orderstatus", "o_custkey")
        .agg(F.bool_and("_ok").alias("_ok"))
        .groupBy("o_orderstatus")
        .agg(F.bool_and("_ok").alias("nome_certo"), F.count(F.lit(1)).alias("registros"))
    )


@query(
    "run_manifest",
    f"""WITH {sql.AGG_LOCAL}, n AS (
    SELECT 'dim_fundo' AS nome, (SELECT count(*) FROM dim) AS quantidade_registros UNION ALL
    SELECT 'fct_fundo_diario', (SELECT count(*) FROM fct) UNION ALL SELECT 'agg_fundo_periodo', (SELECT count(*) FROM agg))
    SELECT nome, quantidade_registros, true AS tem_tamanho FROM n UNION ALL
    SELECT 'total', CAST(sum(quantidade_registros) AS BIGINT), true FROM n""",
)
def run_manifest(spark, sf_dir):
    path = scratch_path(spark, "gold")
    dim_rows = writers.sink_parquet(bindings.dim_fundo(spark, sf_dir), f"{path}/dim_fundo")
    fact_rows = writers.sink_partitioned_month(bindings.fact(spark, sf_dir), f"{path}/fct_fundo_diario")
    fact = spark.read.parquet(f"{path}/fct_fundo_diario")
    agg_rows = writers.sink_partitioned_month(
        periods.agg_fundo_periodo(fact), f"{path}/agg_fundo_periodo", key="data_referencia"
    )
    produced = [
        writers.Produced(n, f"{path}/{n}", r)
        for n, r in (("dim_fundo", dim_rows), ("fct_fundo_diario", fact_rows), ("agg_fundo_periodo", agg_rows))
    ]
    manifest = writers.run_manifest(spark, produced)
    return manifest.select("nome", "quantidade_registros", (F.col("tamanho_mb") > 0).alias("tem_tamanho"))
