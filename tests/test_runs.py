"""From landed archives to the quality report."""

import datetime as dt
import io
import zipfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cotalake.operators import quality
from cotalake.plans import gold, runs
from cotalake.schemas import MOVEMENT
from cotalake.sinks import publish
from cotalake.streaming.movements import typed_movements

CLASSES = (
    "CNPJ_Classe;Denominacao_Social;Situacao;Classificacao;Forma_Condominio;Exclusivo\n"
    "191;Fundo Ação ;Em Funcionamento Normal;Ações;Aberto;N\n"
    "191;Fundo Ação;Em Funcionamento Normal;Ações;Aberto;N\n"
    "192;Fundo B;Em Funcionamento Normal;Renda Fixa;Aberto;N\n"
    "193;Fundo C;Cancelada;Renda Fixa;Aberto;N\n"
)
JANUARY = (
    "CNPJ_FUNDO_CLASSE;DT_COMPTC;VL_PATRIM_LIQ;CAPTC_DIA;RESG_DIA;NR_COTST\n"
    "191;2024-01-30;100.0;10;5;7\n191;2024-01-30; 100.0;10;5;7\n191;2024-01-31;110.0;10;5;7\n"
    "192;2024-01-31;50;1;1;1\n193;2024-01-31;50;1;1;1\n;;;;;\n191;31/01/2024;1;1;1;1\n"
)
FEBRUARY = "NR_COTST;DT_COMPTC;VL_PATRIM_LIQ;CAPTC_DIA;RESG_DIA;CNPJ_FUNDO_CLASSE\n14;2024-02-01;121.0;0;0;191\n"


def _landed(tmp_path):
    folder = tmp_path / "bronze"
    folder.mkdir()
    (folder / "registro_classe.csv").write_bytes(CLASSES.encode("latin-1"))
    (folder / "inf_diario_fi_202401.csv").write_bytes(JANUARY.encode("latin-1"))
    (folder / "inf_diario_fi_202402.csv").write_bytes(FEBRUARY.encode("latin-1"))
    return str(folder)


def test_archives_to_silver(spark, tmp_path, rows):
    """The same silver layer from archives as from files."""
    folder = tmp_path / "zips"
    folder.mkdir()
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("a/inf_diario_fi_202401.csv", JANUARY.replace("\n", "\r\n").encode("latin-1"))
        z.writestr("inf_diario_fi_202402.csv", FEBRUARY.encode("latin-1"))
        z.writestr("leia.txt", "x")
    (folder / "b.zip").write_bytes(buffer.getvalue())
    (folder / "c.zip").write_bytes(buffer.getvalue()[:50])
    for name, content in (("a.zip", "CNPJ_Classe;Denominacao_Social\n7;velho\n"), ("d.zip", CLASSES)):
        with zipfile.ZipFile(folder / name, "w") as z:
            z.writestr("registro_classe.csv", content.encode("latin-1"))
    counters = runs.landing_layer(spark, str(folder), str(tmp_path / "landed"))
    assert tuple(counters.first()) == (3, 1, 1)
    manifest = runs.silver_layer(spark, str(tmp_path / "landed"), str(tmp_path / "s1"), unpacked=True)
    runs.silver_layer(spark, _landed(tmp_path), str(tmp_path / "s2"))
    assert rows(manifest, "nome", "quantidade_registros") == [("inf_diario", 6), ("registro_classe_clean", 2), ("total", 8)]
    for a, b in zip(runs.read_silver(spark, str(tmp_path / "s1")), runs.read_silver(spark, str(tmp_path / "s2"))):
        assert rows(a, *b.columns) == rows(b)


def test_bronze_to_gold(spark, tmp_path, rows):
    silver, out = str(tmp_path / "silver"), str(tmp_path / "gold")
    manifest = runs.silver_layer(spark, _landed(tmp_path), silver)
    assert rows(manifest, "nome", "quantidade_registros") == [("inf_diario", 6), ("registro_classe_clean", 2), ("total", 8)]
    manifest, status = runs.gold_layer(spark, silver, out)
    assert rows(manifest, "nome", "quantidade_registros") == [
        ("agg_fundo_periodo", 8), ("dim_fundo", 2), ("dim_tempo", 3), ("fct_fundo_diario", 4), ("total", 17),
    ]
    assert tuple(status.select("status", "status_code", "falhas").first()) == ("partial", 207, 1)  # fund 192 has no change yet
    fact = spark.read.parquet(f"{out}/fct_fundo_diario/parquet")
    change = rows(fact.filter("sk_fundo = 898300"), "sk_data", "variacao_pl_dia_pct", "variacao_cotistas_dia_pct")
    assert [(k, v if v is None else round(v, 9), c) for k, v, c in change] == [
        (20240130, None, None), (20240131, 10.0, 0.0), (20240201, 10.0, 100.0),
    ]
    names = rows(spark.read.parquet(f"{out}/dim_fundo/parquet"), "nome_fundo")
    assert names == [("Fundo Ação",), ("Fundo B",)]


def test_cloud_variant_reads_the_newest_file(spark, tmp_path, rows):
    silver, out = str(tmp_path / "silver"), str(tmp_path / "gold")
    runs.silver_layer(spark, _landed(tmp_path), silver)
    manifest, status = runs.gold_layer(spark, silver, out, variant="cloud")
    assert ("fct_fundo_diario", 1) in rows(manifest, "nome", "quantidade_registros")
    assert status.first()["status"] == "success"
    aggregate = spark.read.parquet(f"{out}/agg_fundo_periodo/parquet")
    assert {(r["score_risco_fundo"], r["nivel_risco_fundo"]) for r in aggregate.collect()} == {(50.0, "medio")}


def test_every_line_is_accounted_for(spark, tmp_path, rows):
    """A line with a field too many reaches no fact row, and read = used + each loss."""
    silver, out = str(tmp_path / "silver"), str(tmp_path / "gold")
    folder = _landed(tmp_path)
    broken = "191;2024-01-30;1;000;5;2;7"
    bad = f"{broken}\n--;2024-01-30;1;1;1;1\n;2024-01-30;1;1;1;1\n"
    (tmp_path / "bronze" / "inf_diario_fi_202401.csv").write_bytes((JANUARY + bad).encode("latin-1"))
    (tmp_path / "bronze" / "registro_classe.csv").write_bytes((CLASSES + "194;a;b;c;d;e;f\n").encode("latin-1"))
    runs.silver_layer(spark, folder, silver)
    assert rows(runs.rejected_rows(spark, silver)) == [
        ("inf_diario", "inf_diario_fi_202401.csv", broken), ("registro_classe", "registro_classe.csv", "194;a;b;c;d;e;f"),
    ]
    _, status = runs.gold_layer(spark, silver, out)
    lost = spark.read.parquet(f"{out}/perdas").first().asDict()
    assert lost == {
        "lidas": 11, "campos_demais": 1, "vazias": 1, "repetidas": 1, "sem_cnpj": 1, "cnpj_sem_digitos": 1, "data_invalida": 1,
        "sem_cadastro": 1, "chave_colidida": 0, "aproveitados": 4, "sem_explicacao": 0,
    }
    assert lost.pop("lidas") == sum(lost.values())
    assert spark.read.parquet(f"{out}/fct_fundo_diario/parquet").count() == status.first()["linhas_aproveitados"] == 4


def test_lost_lines_show_in_the_account(spark, tmp_path):
    """A line that vanishes after cleaning is not passed off as blank or repeated."""
    silver = str(tmp_path / "silver")
    runs.silver_layer(spark, _landed(tmp_path), silver)
    registry, _ = runs.read_silver(spark, silver)
    dim = gold.dim_fundo(registry)
    assert runs.layer_losses(spark, silver, dim).first()["sem_explicacao"] == 0
    for name in ("inf_diario_fi_202402_clean.csv",):
        for part in (tmp_path / "silver" / "inf_diario" / f"origem={name}").iterdir():
            part.unlink()
    assert runs.layer_losses(spark, silver, dim).first()["sem_explicacao"] == 1


def test_headers_that_differ_in_case_only(spark, tmp_path, rows):
    """Both columns are read, the last one counts, and no report is dropped without a word."""
    silver = str(tmp_path / "silver")
    folder = _landed(tmp_path)
    twice = "CNPJ_FUNDO_CLASSE;DT_COMPTC;dt_comptc;VL_PATRIM_LIQ;CAPTC_DIA;RESG_DIA;NR_COTST\n191;x;2024-03-01;90;0;0;14\n"
    (tmp_path / "bronze" / "inf_diario_fi_202403.csv").write_bytes(twice.encode("latin-1"))
    manifest = runs.silver_layer(spark, folder, silver)
    assert ("inf_diario", 7) in rows(manifest, "nome", "quantidade_registros")
    registry, report = runs.read_silver(spark, silver)
    fact = gold.fct_fundo_diario(report, gold.dim_fundo(registry))
    assert (20240301, 90.0) in rows(fact, "sk_data", "patrimonio_liquido_dia")


def test_inputs_are_named_and_faults_end_a_run(spark, tmp_path, rows, monkeypatch):
    silver = str(tmp_path / "silver")
    folder = _landed(tmp_path)
    for name in ("inf_diario_fi_202401.csv", "inf_diario_fi_202402.csv"):
        (tmp_path / "bronze" / name).unlink()
    runs.silver_layer(spark, folder, silver)
    assert rows(runs.skipped_inputs(spark, silver), "tipo") == [("inf_diario",), ("registro_fundo",), ("registro_subclasse",)]
    (tmp_path / "bronze" / "inf_diario_fi_202403.csv").write_text("A;B\n1;2\n")

    def broken(*args, **kwargs):
        return spark.range(1).select("nothing")

    monkeypatch.setattr(runs.delimited, "scan_union_by_name", broken)
    with pytest.raises(AnalysisException):
        runs._reports(spark, folder, "ISO-8859-1")


def test_collided_keys_are_reported_and_the_wide_key_has_none(spark, rows):
    cnpjs = spark.range(20_000).select(F.lpad(F.col("id").cast("string"), 14, "0").alias("CNPJ_FUNDO_CLASSE"))
    report = cnpjs.withColumn("DT_COMPTC", F.lit("2024-01-02"))
    narrow, wide = (quality.report_losses(report, gold.dim_fundo(cnpjs, key=k), cnpjs).first() for k in ("parity", "wide"))
    assert narrow["chave_colidida"] > 0 and narrow["chave_colidida"] + narrow["aproveitados"] == 20_000
    assert (wide["chave_colidida"], wide["aproveitados"]) == (0, 20_000)


def test_gold_is_published_at_once(spark, tmp_path, rows, monkeypatch):
    silver, out = str(tmp_path / "silver"), str(tmp_path / "gold")
    runs.silver_layer(spark, _landed(tmp_path), silver)
    moves = [(1, 191, 1, "A", "100", "2024-01-30 10:00:00"), (1, 191, 1, "R", "40", "2024-02-01 10:00:00"), (2, 192, 1, "A", "5", None)]
    feed = typed_movements(spark.createDataFrame(moves, ", ".join(f"{c} string" for c in MOVEMENT.fieldNames())))
    clients = spark.createDataFrame([(1, "Ana", dt.date(1990, 1, 1), "varejo")], "sk_cliente bigint, nome_cliente string, data_nascimento date, segmento string")
    given = {"movements": feed, "clients": clients, "reference": F.lit(dt.date(2024, 2, 1))}
    manifest, status = runs.publish_gold(spark, silver, out, **given)
    assert rows(manifest, "nome", "quantidade_registros") == [
        ("agg_fundo_periodo", 8), ("agg_relacionamento_periodo_simulada", 3), ("dim_cliente_simulado", 1), ("dim_fundo", 2), ("dim_tempo", 3),
        ("fct_cliente_posicao_diaria_simulada", 3), ("fct_cliente_risco_diario_simulada", 3), ("fct_fundo_diario", 4),
        ("kpi_fundo_diario", 4), ("kpi_fundo_periodo", 8), ("ranking_fundo_periodo", 8), ("total", 47),
    ]
    assert status.first()["status"] == "partial"
    folder = publish.current_path(spark, out)
    kpis = spark.read.parquet(f"{folder}/kpi_fundo_periodo/parquet").filter("periodo = 7")
    assert rows(kpis, "sk_fundo", "captacao_periodo", "var_patrimonio_periodo")[-1] == (898300, 20.0, pytest.approx(0.21))
    summary = spark.read.parquet(f"{folder}/agg_relacionamento_periodo_simulada/parquet")
    assert rows(summary, "segmento", "total_clientes") == [("varejo", 1)] * 3
    before = rows(spark.read.parquet(f"{folder}/dim_fundo/parquet"))

    def killed(*_):
        raise RuntimeError("killed after the star schema")

    monkeypatch.setattr(runs, "kpi_layer", killed)
    with pytest.raises(RuntimeError):
        runs.publish_gold(spark, silver, out, key="wide")
    assert publish.current_path(spark, out) == folder and rows(spark.read.parquet(f"{folder}/dim_fundo/parquet")) == before
    with pytest.raises(ValueError):
        runs.publish_gold(spark, silver, out, movements=feed)
