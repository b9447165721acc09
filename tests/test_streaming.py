"""Streams: nothing lost, nothing doubled, same result as a batch run."""

import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from cotalake.plans import gold
from cotalake.sinks.writers import by_month
from cotalake.streaming import incremental, movements

HEADER = "fk_cliente,fk_classe,fk_subclasse,natureza_operacao,valor,data\n"


@pytest.fixture
def feed(tmp_path):
    landing = tmp_path / "simulacoes"
    landing.mkdir()
    count = iter(range(1000))

    def drop(*lines):
        (landing / f"aplicacao_resgate_{next(count)}.csv").write_text(HEADER + "".join(f"{line}\n" for line in lines))

    return str(landing), drop, str(tmp_path / "out"), str(tmp_path / "ckpt")


def test_ledger_keeps_late_and_equal_rows_and_ignores_replays(spark, feed, rows, tmp_path):
    landing, drop, out, checkpoint = feed
    drop("1,1,1,A,10.50,2024-01-05 10:00:00", "1,1,1,A,10.50,2024-01-05 10:00:00", "2,1,2,R,x,2024-01-05 11:00:00")
    movements.ledger_ingest(spark, landing, out, checkpoint)
    drop("1,1,1,A,10.50,2024-01-05 10:00:00")
    drop("3,1,2,R,7.00,2019-01-01 00:00:00", "4,,,A,1.00,ontem", "4,,,A,1.00,ontem")
    movements.ledger_ingest(spark, landing, out, checkpoint, files_per_batch=1)
    drop("4,,,A,1.00,ontem")
    movements.ledger_ingest(spark, landing, out, checkpoint)
    movements.ledger_ingest(spark, landing, out, str(tmp_path / "lost_checkpoint"))
    got = rows(spark.read.parquet(out), "fk_cliente", "valor", "data")
    assert [(r[0], None if r[1] is None else float(r[1]), r[2]) for r in got] == [
        *[(1, 10.5, dt.datetime(2024, 1, 5, 10))] * 3, (2, None, dt.datetime(2024, 1, 5, 11)),
        (3, 7.0, dt.datetime(2019, 1, 1)), *[(4, 1.0, None)] * 3,
    ]


def test_a_killed_ledger_batch_neither_doubles_nor_loses(spark, feed, rows, tmp_path, monkeypatch):
    landing, drop, out, checkpoint = feed
    drop("1,1,1,A,1.00,2024-01-05 10:00:00", "1,1,1,A,1.00,2024-01-05 10:00:00")
    movements.ledger_ingest(spark, landing, out, checkpoint)
    drop("2,1,1,A,2.00,2024-01-05 10:00:00", "3,1,1,A,3.00,2024-01-06 10:00:00")

    def killed(*_):
        raise RuntimeError("killed before the commit")

    monkeypatch.setattr(movements, "_commit", killed)
    with pytest.raises(StreamingQueryException):
        movements.ledger_ingest(spark, landing, out, checkpoint)
    monkeypatch.undo()

    def clients():
        return [r[0] for r in rows(movements.read_ledger(spark, out), "fk_cliente")]

    assert len(list(tmp_path.glob("out/lote=*"))) == 2 and clients() == [1, 1]
    # Another checkpoint leaves the folder of the killed batch aside; the old one then finds nothing new.
    movements.ledger_ingest(spark, landing, out, str(tmp_path / "other"))
    assert clients() == [1, 1, 2, 3]
    movements.ledger_ingest(spark, landing, out, checkpoint)
    assert clients() == [1, 1, 2, 3]
    assert movements.changed_files(spark, out).count() == 0


def test_a_ledger_file_that_changed_is_named(spark, feed, rows, tmp_path):
    landing, drop, out, checkpoint = feed
    drop("1,1,1,A,1.00,2024-01-05 10:00:00")
    movements.ledger_ingest(spark, landing, out, checkpoint)
    name = next((tmp_path / "simulacoes").iterdir())
    name.write_text(HEADER + "1,1,1,A,1.00,2024-01-05 10:00:00\n9,1,1,A,1.00,2024-01-05 10:00:00\n")
    movements.ledger_ingest(spark, landing, out, str(tmp_path / "other"))
    assert rows(movements.read_ledger(spark, out), "fk_cliente") == [(1,)]
    assert [(r["arquivo"].endswith(name.name), r["linhas"]) for r in movements.changed_files(spark, out).collect()] == [(True, 2)]


def test_an_empty_ledger_has_its_columns(spark, feed, tmp_path):
    landing, _, out, checkpoint = feed
    movements.ledger_ingest(spark, landing, out, checkpoint)
    assert movements.read_ledger(spark, out).columns[-2:] == ["arquivo", "dia"] and movements.read_ledger(spark, out).count() == 0


def test_daily_flow_closes_days_behind_the_watermark(spark, feed, rows):
    landing, drop, out, checkpoint = feed
    drop("1,7,1,A,10.00,2024-01-01 10:00:00", "1,7,1,R,4.00,2024-01-01 23:59:59", "1,8,1,A,1.00,2024-01-02 00:00:00")
    movements.daily_flow_table(spark, landing, out, checkpoint)
    drop("1,7,1,A,5.00,2024-01-04 12:00:00")
    movements.daily_flow_table(spark, landing, out, checkpoint)
    got = rows(spark.read.parquet(out), "dia", "fk_classe", "aplicacao", "resgate", "liquido", "movimentos")
    assert got == [
        (dt.date(2024, 1, 1), 7, 10.0, 4.0, 6.0, 2), (dt.date(2024, 1, 2), 8, 1.0, 0.0, 1.0, 1),
    ]


def test_daily_flow_of_a_table_equals_the_stream(spark, feed, rows):
    landing, drop, out, checkpoint = feed
    drop(*[f"1,{i % 3},1,{'AR'[i % 2]},{i}.25,2024-01-{1 + i % 9:02d} 10:00:00" for i in range(60)])
    movements.daily_flow_table(spark, landing, out, checkpoint)
    text = spark.read.option("header", True).csv(landing)
    batch = movements.daily_flow(movements.typed_movements(text)).filter("dia <= '2024-01-07'")
    streamed = spark.read.parquet(out)
    assert rows(streamed, *batch.columns) == rows(batch)


def test_alerts_on_the_stream(spark, feed, rows):
    landing, drop, out, checkpoint = feed
    drop("1,7,1,R,30.00,2024-01-01 10:00:00", "1,8,1,R,10.00,2024-01-01 10:00:00", "1,7,1,R,1.00,2024-01-03 10:00:00")
    equity = spark.createDataFrame([(7, 100.0), (8, 100.0)], "classe bigint, patrimonio_liquido_dia double")
    limits = spark.createDataFrame(
        [(7, "ALTA_RESGATE_PORCENTAGEM", "0.20"), (8, "ALTA_RESGATE_PORCENTAGEM", "0.20")],
        "fk_registro_classe bigint, nome string, valor string",
    )
    alerts = movements.flow_alerts(movements.daily_flow(movements.read_movements(spark, landing)), equity, limits)
    movements.run_available(alerts.writeStream.format("parquet").outputMode("append").option("path", out), checkpoint)
    got = rows(spark.read.parquet(out), "classe", "dia", "proporcao_resgate", "limite")
    assert got == [(7, dt.date(2024, 1, 1), 0.3, 0.2)]


REPORT = "CNPJ_FUNDO_CLASSE string, DT_COMPTC date, VL_PATRIM_LIQ double, CAPTC_DIA double, RESG_DIA double, NR_COTST double"


def test_late_month_refreshes_exactly_what_depends_on_it(spark, tmp_path, rows):
    silver, out, summary, checkpoint = (str(tmp_path / n) for n in ("silver", "gold", "summary", "ckpt"))
    registry = spark.createDataFrame([(str(i), "F") for i in range(1, 6)], "CNPJ_FUNDO_CLASSE string, DENOM_SOCIAL string")
    dim = gold.dim_fundo(registry)
    data = []
    for fund in range(1, 6):
        for month in range(1, 9):
            if (fund, month) in {(2, 4), (3, 4), (3, 5)}:
                continue  # these funds report nothing in some months
            for day in (3, 17):
                # Fund 4 reports no equity in April and May: the padding reaches over them.
                equity = None if fund == 4 and month in (4, 5) else 100.0 + fund * 7 + month * 3 + day
                data.append((str(fund), dt.date(2024, month, day), equity, 1.0, 2.0, float(day)))
    waves = [[r for r in data if r[1].month in (1, 2, 4, 5)], [r for r in data if r[1].month in (3,)], [r for r in data if r[1].month >= 6]]
    written = []
    for wave in waves:
        report = spark.createDataFrame(wave, REPORT).withColumn("_key", gold.dates.date_key(F.col("DT_COMPTC")))
        by_month(report, "_key").drop("_key").write.mode("append").partitionBy("ano_mes").parquet(silver)
        before = {p: p.stat().st_mtime_ns for p in (tmp_path / "gold").rglob("*.parquet")} if written else {}
        incremental.incremental_gold(spark, silver, dim, out, summary, checkpoint)
        after = {p: p.stat().st_mtime_ns for p in (tmp_path / "gold").rglob("*.parquet")}
        written.append({p.parent.name for p in after if p not in before})
    full = gold.fct_fundo_diario(spark.createDataFrame(data, REPORT), dim)
    assert rows(spark.read.parquet(out), *gold.FACT_COLUMNS) == rows(full)
    # March changes April, and May for the funds that know no April value.
    assert written[1] == {"ano_mes=202403", "ano_mes=202404", "ano_mes=202405"}
    assert written[2] == {"ano_mes=202406", "ano_mes=202407", "ano_mes=202408"}


def test_refresh_with_nothing_new_changes_nothing(spark, tmp_path):
    silver, out, summary, checkpoint = (str(tmp_path / n) for n in ("silver", "gold", "summary", "ckpt"))
    dim = gold.dim_fundo(spark.createDataFrame([("1", "F")], "CNPJ_FUNDO_CLASSE string, DENOM_SOCIAL string"))
    report = spark.createDataFrame([("1", dt.date(2024, 1, 1), 1.0, 1.0, 1.0, 1.0)], REPORT).withColumn("_key", F.lit(20240101))
    by_month(report, "_key").drop("_key").write.partitionBy("ano_mes").parquet(silver)
    for _ in range(2):
        incremental.incremental_gold(spark, silver, dim, out, summary, checkpoint)
        files = {p: p.stat().st_mtime_ns for p in (tmp_path / "gold").rglob("*.parquet")}
        assert len(files) == 1
    assert spark.read.parquet(out).count() == 1
