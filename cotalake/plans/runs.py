"""Whole-layer runs: landed archives to files, files to silver, silver to gold."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cotalake import schemas
from cotalake.operators import cleaning, periods, quality, relationship
from cotalake.plans import gold, silver
from cotalake.sinks import publish, writers
from cotalake.sources import archives, delimited, objects

DAILY = "inf_diario"
ORIGIN = "origem"
READ = "lidos"
REJECTED = "rejeitada"
LANDED = "arquivo string, linha_no bigint, texto string, membro string"
INPUTS = "entradas"
COUNTED = "contagens"
#: What Spark says of a folder or pattern without any file; every other fault ends a run.
NO_SUCH_PATH = "PATH_NOT_FOUND"


def landing_layer(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Unpack every archive below ``source`` into a table of lines at ``target``. Returns the counters.

    The table (arquivo, membro, linha_no, texto) has a folder per member and
    keeps each line's place, so a large member can be spread over many files and
    a later step reads the members it wants. Two members of one name are
    told apart by their archive; the one of the last archive counts. Archives
    are opened once: the counters come from what was written.
    """
    expanded = archives.expand_archives(archives.read_archives(spark, source), encoding="latin-1")
    name = F.regexp_extract("membro", r"([^/]*)$", 1)
    lines = archives.csv_lines(expanded).withColumn("membro", name)
    last = lines.filter("linha_no = 0").groupBy("membro").agg(F.max("arquivo").alias("arquivo"))
    current = lines.join(last, ["membro", "arquivo"], "left_semi").hint("rebalance", "membro")
    current.write.mode("overwrite").partitionBy("membro").parquet(f"{target}/linhas")
    return archives.archive_counters(expanded)


def silver_layer(
    spark: SparkSession, source: str, target: str, encoding: str = delimited.LATIN1, unpacked: bool = False
) -> DataFrame:
    """Clean the registries and the daily reports of ``source``. Returns the manifest.

    ``source`` holds CSV files, or (``unpacked``) what :func:`landing_layer`
    wrote. A missing input is skipped and the run goes on with the others;
    ``entradas`` names every input, used or missing. An input that is there and cannot be read ends the run. Rows
    with more fields than their header are set aside, see :func:`rejected_rows`.
    """
    lines = spark.read.schema(LANDED).parquet(f"{source}/linhas") if unpacked else None
    produced: list[writers.Produced] = []
    inputs: list[tuple[str, str, str]] = []

    def noted(raw: DataFrame | None, kind: str) -> DataFrame | None:
        inputs.append((kind, source, "ausente" if raw is None else "usada"))
        return raw

    def readable(raw: DataFrame, kind: str) -> DataFrame:
        """The rows as read, written once; those with too many fields stay apart, with file and raw line."""
        path = f"{target}/{READ}/{kind}"
        marked = raw.withColumn(REJECTED, F.col(delimited.BROKEN).isNotNull().cast("int"))
        marked.write.mode("overwrite").partitionBy(REJECTED).parquet(path)
        return spark.read.schema(marked.schema).parquet(path).filter(F.col(REJECTED) == 0).drop(REJECTED, delimited.BROKEN)

    for kind in silver.REGISTRY_FILTERS:
        raw = _registry(spark, source, kind, encoding) if lines is None else archives.member_table(lines, kind, file_name_as=ORIGIN)
        if noted(raw, kind) is not None:
            path = f"{target}/{kind}_clean"
            rows = writers.sink_csv(silver.clean_registry(readable(raw, kind).drop(ORIGIN), kind), path)
            produced.append(writers.Produced(f"{kind}_clean", path, rows))
    if lines is None:
        raw = _reports(spark, source, encoding)
    else:
        raw = archives.member_table(lines, f"{DAILY}_fi", file_name_as=ORIGIN)
    if noted(raw, DAILY) is not None:
        named = readable(raw, DAILY).withColumn(ORIGIN, F.regexp_replace(ORIGIN, r"(?i)\.csv$", "_clean.csv"))
        path = f"{target}/{DAILY}"
        cleaned, watch = clean_reports(named)
        produced.append(writers.Produced(DAILY, path, writers.per_file_output(cleaned, path)))
        counted = [(DAILY, watch.get["vazias"], watch.get["repetidas"])]
        spark.createDataFrame(counted, "tipo string, vazias long, repetidas long").write.mode("overwrite").parquet(f"{target}/{COUNTED}")
    spark.createDataFrame(inputs, "tipo string, caminho string, situacao string").write.mode("overwrite").parquet(f"{target}/{INPUTS}")
    if not produced:
        raise FileNotFoundError(f"no registry and no daily report under {source}")
    return writers.run_manifest(spark, produced)


def _registry(spark: SparkSession, source: str, kind: str, encoding: str) -> DataFrame | None:
    found = objects.single_file_by_pattern(spark, source, kind).first()["caminho"]
    return None if found is None else delimited.scan_union_by_name(
        spark, found, encoding, file_name_as=ORIGIN, sep=";", keep_broken=True
    )


def _reports(spark: SparkSession, source: str, encoding: str) -> DataFrame | None:
    try:
        return delimited.scan_union_by_name(
            spark, f"{source}/{DAILY}_fi*.csv", encoding, file_name_as=ORIGIN, keep_broken=True
        )
    except FileNotFoundError:
        return None
    except AnalysisException as fault:
        if fault.getCondition() != NO_SUCH_PATH:
            raise
        return None


def skipped_inputs(spark: SparkSession, silver_path: str) -> DataFrame:
    """(tipo, caminho): inputs that a silver run looked for and did not find."""
    return spark.read.parquet(f"{silver_path}/{INPUTS}").filter("situacao = 'ausente'").select("tipo", "caminho")


def rejected_rows(spark: SparkSession, silver_path: str) -> DataFrame:
    """(tipo, origem, linha): rows that the silver run set aside because they have more fields than their header."""
    rejects: DataFrame | None = None
    for kind in (*silver.REGISTRY_FILTERS, DAILY):
        try:
            read = spark.read.parquet(f"{silver_path}/{READ}/{kind}")
        except AnalysisException as fault:
            if fault.getCondition() != NO_SUCH_PATH:
                raise
            continue
        part = read.filter(F.col(REJECTED) == 1).select(F.lit(kind).alias("tipo"), ORIGIN, F.col(delimited.BROKEN).alias("linha"))
        rejects = part if rejects is None else rejects.unionByName(part)
    return rejects


def layer_losses(spark: SparkSession, silver_path: str, dim: DataFrame) -> DataFrame:
    """Where every line of the daily reports went.

    Each count is taken where the line goes: blank and repeated lines by the cleaning step, those with too many fields by the reader, the
    others from the cleaned table. ``sem_explicacao`` is what is left of ``lidas``, and 0 unless lines were lost some other way.
    """
    registry, report = read_silver(spark, silver_path)
    read = spark.read.parquet(f"{silver_path}/{READ}/{DAILY}").agg(
        F.count(F.lit(1)).alias("lidas"), F.count_if(F.col(REJECTED) == 1).alias("campos_demais")
    )
    dropped = spark.read.parquet(f"{silver_path}/{COUNTED}").filter(F.col("tipo") == DAILY).agg(
        F.coalesce(F.sum("vazias"), F.lit(0)).alias("vazias"), F.coalesce(F.sum("repetidas"), F.lit(0)).alias("repetidas")
    )
    later = quality.report_losses(report, dim, registry).drop("registros")
    joined = read.withColumn("_one", F.lit(1))
    for part in (dropped, later):
        joined = joined.join(part.withColumn("_one", F.lit(1)), "_one")
    joined = joined.drop("_one")
    known = [F.col(c) for c in joined.columns if c != "lidas"]
    return joined.withColumn("sem_explicacao", F.col("lidas") - sum(known[1:], known[0]))


def clean_reports(named: DataFrame) -> tuple[DataFrame, Observation]:
    """Daily reports cleaned file by file, and how many blank and repeated lines go (known when the result is written).

    A row that holds nothing but its file's name is blank.
    """
    content = [c for c in named.columns if c != ORIGIN]
    coerced = named.transform(cleaning.trim_text).transform(cleaning.coerce_daily_report)
    distinct = coerced.groupBy(*[F.col(f"`{c}`") for c in coerced.columns]).agg(F.count(F.lit(1)).alias("_vezes"))
    blank = F.forall(F.array(*[F.col(f"`{c}`").isNull() for c in content]), lambda x: x) if content else F.lit(True)
    marked = distinct.withColumn("_vazia", blank)
    watch = Observation(f"limpeza-{uuid.uuid4().hex}")
    watched = marked.observe(
        watch,
        F.coalesce(F.sum(F.when(F.col("_vazia"), F.col("_vezes"))), F.lit(0)).alias("vazias"),
        F.coalesce(F.sum(F.when(~F.col("_vazia"), F.col("_vezes") - 1)), F.lit(0)).alias("repetidas"),
    )
    return watched.filter(~F.col("_vazia")).drop("_vezes", "_vazia"), watch


def read_silver(spark: SparkSession, path: str, newest_only: bool = False) -> tuple[DataFrame, DataFrame]:
    """(class registry, daily report) as a silver run left them."""
    registry = delimited.scan_delimited(spark, f"{path}/registro_classe_clean", encoding="UTF-8")
    report = delimited.scan_delimited(spark, f"{path}/{DAILY}", encoding="UTF-8")
    if newest_only:
        newest = report.agg(F.max(ORIGIN)).scalar()
        report = report.filter(F.col(ORIGIN) == newest)
    return registry, report.drop(ORIGIN)


def gold_layer(
    spark: SparkSession, source: str, target: str, variant: str = "local",
    period_days: Sequence[int] = tuple(schemas.PERIODS), one_row_per_day: bool = False, key: str = "parity",
) -> tuple[DataFrame, DataFrame]:
    """Build and write the star schema and the period aggregate. Returns (manifest, quality status).

    The fact is written first and read back for everything that follows, so it
    is computed once and survives the loss of executors. The status shows what
    became of the report lines, also written to ``perdas``. The cloud variant
    reads the newest report file only (the loss report still counts all) and writes the facts as CSV as well as
    Parquet, like the local one. Tables are replaced one by one; :func:`publish_gold` replaces them at once.
    """
    produced, status = _star(spark, source, target, variant, period_days, one_row_per_day, key)
    return writers.run_manifest(spark, produced), status


def _by_month(spark: SparkSession, df: DataFrame, target: str, name: str, key: str) -> tuple[writers.Produced, DataFrame]:
    """Written as Parquet and, from there, as CSV, a folder per month each."""
    path = f"{target}/{name}"
    rows = writers.sink_partitioned_month(df, f"{path}/parquet", key)
    written = spark.read.parquet(f"{path}/parquet")
    writers.sink_partitioned_month(written.drop("ano_mes"), f"{path}/csv", key, form="csv")
    return writers.Produced(name, path, rows), written


def _whole(spark: SparkSession, df: DataFrame, target: str, name: str) -> tuple[writers.Produced, DataFrame]:
    path = f"{target}/{name}"
    return writers.Produced(name, path, writers.sink_dual(spark, df, path)), spark.read.parquet(f"{path}/parquet")


def _star(
    spark: SparkSession, source: str, target: str, variant: str, period_days: Sequence[int], one_row_per_day: bool, key: str
) -> tuple[list[writers.Produced], DataFrame]:
    registry, report = read_silver(spark, source, newest_only=variant == "cloud")
    dim_entry, dim = _whole(spark, gold.dim_fundo(registry, variant, key=key), target, "dim_fundo")
    built = gold.fct_fundo_diario(report, dim, variant, one_row_per_day, key=key)
    fact_entry, fact = _by_month(spark, built, target, "fct_fundo_diario", "sk_data")
    aggregate = periods.agg_fundo_periodo(fact, period_days, variant)
    agg_entry, aggregate = _by_month(spark, aggregate, target, "agg_fundo_periodo", "data_referencia")
    calendar_entry, _ = _whole(spark, gold.dim_tempo(gold.fact_bounds(fact)), target, "dim_tempo")
    losses_path = f"{target}/perdas"
    layer_losses(spark, source, dim).write.mode("overwrite").parquet(losses_path)
    losses = spark.read.parquet(losses_path)
    checks = quality.fact_checks(fact).unionByName(quality.aggregate_checks(aggregate))
    status = quality.dq_status(checks).withColumns(
        {f"linhas_{c}": losses.agg(F.max(c)).scalar() for c in losses.columns}
    )
    return [calendar_entry, dim_entry, fact_entry, agg_entry], status


def kpi_layer(
    spark: SparkSession, target: str, period_days: Sequence[int] = tuple(schemas.PERIODS)
) -> list[writers.Produced]:
    """KPI tables from the facts at ``target``: flows and changes by trailing period, their ranking, and flows by fund and day."""
    fact = spark.read.parquet(f"{target}/fct_fundo_diario/parquet")
    levels = spark.read.parquet(f"{target}/agg_fundo_periodo/parquet")
    both = ["sk_fundo", "periodo"]
    flows = periods.kpi_trailing_period(fact, period_days)
    equity = periods.kpi_var_patrimonio(fact, period_days).drop("valor_inicial", "valor_final")
    holders = periods.kpi_var_cotistas(fact, period_days).drop("valor_inicial", "valor_final")
    kpi_entry, kpis = _whole(spark, flows.join(equity, both, "left").join(holders, both, "left"), target, "kpi_fundo_periodo")
    rank_entry, _ = _whole(spark, periods.rank_funds(kpis, levels), target, "ranking_fundo_periodo")
    daily_entry, _ = _by_month(spark, periods.rolling_daily_kpi(fact, period_days), target, "kpi_fundo_diario", "sk_data")
    return [kpi_entry, rank_entry, daily_entry]


def relationship_layer(
    spark: SparkSession, movements: DataFrame, clients: DataFrame, reference: Column, target: str
) -> list[writers.Produced]:
    """Client tables. ``movements`` has the feed's columns, ``clients`` those of :func:`gold.dim_cliente`.

    Positions are per client and fund, risk per client over all funds. Movements without a day have no position.
    """
    dated = movements.filter(F.col("data").isNotNull()).withColumnsRenamed({"fk_cliente": "sk_cliente", "fk_classe": "sk_fundo"})
    dim_entry, dim = _whole(spark, gold.dim_cliente(clients, reference), target, "dim_cliente_simulado")
    position = relationship.client_daily_position(dated, ["sk_cliente", "sk_fundo"])
    position_entry, _ = _by_month(spark, position, target, "fct_cliente_posicao_diaria_simulada", "sk_data")
    risk = relationship.client_risk(relationship.with_history(relationship.client_daily_position(dated)))
    risk_entry, risk = _by_month(spark, risk, target, "fct_cliente_risco_diario_simulada", "sk_data")
    summary = relationship.relationship_summary(risk, dim.select("sk_cliente", "segmento"))
    summary_entry, _ = _by_month(spark, summary, target, "agg_relacionamento_periodo_simulada", "data_referencia")
    return [dim_entry, position_entry, risk_entry, summary_entry]


def publish_gold(
    spark: SparkSession, source: str, target: str, variant: str = "local",
    period_days: Sequence[int] = tuple(schemas.PERIODS), one_row_per_day: bool = False, key: str = "parity",
    movements: DataFrame | None = None, clients: DataFrame | None = None, reference: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Star schema, KPI tables and, given movements and clients, the client tables, replaced all at once. Returns (manifest, status).

    Readers find the tables below ``publish.current_path(spark, target)``. A run that fails or is killed leaves the
    last publication as it was, also where it fails half way through its tables. ``reference`` is the day of the clients' ages (default: today).
    """
    if (movements is None) != (clients is None):
        raise ValueError("the client tables need both movements and clients")

    def write(folder: str) -> tuple[list[writers.Produced], DataFrame]:
        produced, status = _star(spark, source, folder, variant, period_days, one_row_per_day, key)
        produced += kpi_layer(spark, folder, period_days)
        if movements is not None:
            produced += relationship_layer(spark, movements, clients, F.current_date() if reference is None else reference, folder)
        return produced, status

    produced, status = publish.publish(spark, target, write, lambda done: sum(p.rows for p in done[0]))
    return writers.run_manifest(spark, produced), status
