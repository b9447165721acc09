"""Client positions and risk against plain Python."""

import datetime as dt
import math
import random
import statistics
from decimal import Decimal

import pytest

from cotalake.operators import relationship as rel
from cotalake.streaming import positions

MOVES = "sk_cliente bigint, data timestamp, natureza_operacao string, valor double"


@pytest.fixture(scope="module")
def moves():
    """One client holds a third of the movements; another moves once, late."""
    rnd = random.Random(5)
    data = []
    for i in range(600):
        client = 1 if i % 3 == 0 else rnd.randint(2, 9)
        when = dt.datetime(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 49), seconds=rnd.randint(0, 86399))
        data.append((client, when, rnd.choice("AR"), rnd.randint(1, 99999) / 100))
    data.append((10, dt.datetime(2024, 2, 10, 12), "A", 100.0))
    data += [(2, dt.datetime(2024, 1, 1), "A", 1.0), (2, dt.datetime(2024, 2, 19), "R", 1.0)]
    return data


@pytest.fixture(scope="module")
def position(spark, moves):
    return rel.client_daily_position(spark.createDataFrame(moves, MOVES)).cache()


def _expected(moves):
    first, last = min(m[1] for m in moves).date(), max(m[1] for m in moves).date()
    days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
    out = {}
    for client in {m[0] for m in moves}:
        balance, moved = 0.0, None
        for day in days:
            a = sum(m[3] for m in moves if m[0] == client and m[1].date() == day and m[2] == "A")
            r = sum(m[3] for m in moves if m[0] == client and m[1].date() == day and m[2] == "R")
            if any(m[0] == client and m[1].date() == day for m in moves):
                moved = day
            balance += a - r
            out[client, day] = (a, r, balance, None if moved is None else (day - moved).days)
    return out


def test_position_is_dense_and_exact(position, moves):
    expected = _expected(moves)
    got = {(r["sk_cliente"], r["data"]): r for r in position.collect()}
    assert set(got) == set(expected)
    for key, (a, r, balance, quiet) in expected.items():
        row = got[key]
        assert (float(row["aporte_dia"]), float(row["resgate_dia"])) == (pytest.approx(a), pytest.approx(r))
        assert float(row["saldo_dia"]) == pytest.approx(balance, abs=1e-6)
        assert row["dias_sem_movimentacao"] == quiet


def test_position_per_client_and_fund(spark):
    moves = spark.createDataFrame(
        [(1, 7, dt.datetime(2024, 1, 1), "A", 5.0), (1, 8, dt.datetime(2024, 1, 2), "R", 2.0)],
        "sk_cliente bigint, sk_fundo bigint, data timestamp, natureza_operacao string, valor double",
    )
    got = rel.client_daily_position(moves, ["sk_cliente", "sk_fundo"]).collect()
    assert {(r["sk_fundo"], r["sk_data"]): float(r["saldo_dia"]) for r in got} == {
        (7, 20240101): 5, (7, 20240102): 5, (8, 20240101): 0, (8, 20240102): -2,
    }


def test_thirty_day_measures(position, moves):
    expected = _expected(moves)
    first = min(d for _, d in expected)
    for r in rel.with_history(position).collect():
        client, day = r["sk_cliente"], r["data"]
        back = [expected[client, day - dt.timedelta(days=i)] for i in range(30) if day - dt.timedelta(days=i) >= first]
        gross, out = sum(x[0] + x[1] for x in back), sum(x[1] for x in back)
        assert r["resgates_30d_pct"] == pytest.approx(out / gross if gross else 0.0)
        if len(back) > 1:
            assert r["volatilidade_fluxo"] == pytest.approx(statistics.stdev(x[0] - x[1] for x in back), abs=1e-9)
        earlier = expected.get((client, day - dt.timedelta(days=30)))
        if earlier is None or abs(earlier[2]) < 1e-9:
            assert r["variacao_saldo_30d_pct"] is None or math.isinf(r["variacao_saldo_30d_pct"])
        else:
            assert r["variacao_saldo_30d_pct"] == pytest.approx(expected[client, day][2] / earlier[2] - 1, abs=1e-6)


def test_risk_properties(position):
    risk = rel.client_risk(rel.with_history(position)).collect()
    by_day = {}
    for r in risk:
        assert 0 <= r["score_risco"] <= 100 and 0 <= r["prob_churn"] <= 1
        assert r["prob_churn"] == pytest.approx(1 / (1 + math.exp(-(r["score_risco"] - 50) / 10)), abs=1e-6)
        assert r["nivel_risco"] == ("estavel" if r["score_risco"] < 45 else "atencao" if r["score_risco"] < 70 else "critico")
        assert r["motivo_risco_dominante"] in rel.WEIGHTS
        by_day.setdefault(r["data"], []).append(r["score_risco"])
    for scores in by_day.values():  # standard scores are centred on every day
        assert statistics.mean(scores) == pytest.approx(50, abs=1e-3)
    scores = {(r["sk_cliente"], r["data"]): r["score_risco"] for r in risk}
    for r in risk:
        before = scores.get((r["sk_cliente"], r["data"] - dt.timedelta(days=7)))
        change = 0 if before is None else round(r["score_risco"] - before, 6)
        assert r["tendencia_risco"] == ("subindo" if change > 1 else "caindo" if change < -1 else "estavel")


def test_equal_clients_score_fifty(spark):
    moves = spark.createDataFrame([(c, dt.datetime(2024, 1, 1), "A", 10.0) for c in (1, 2, 3)], MOVES)
    risk = rel.client_risk(rel.with_history(rel.client_daily_position(moves))).collect()
    assert {(r["score_risco"], r["motivo_risco_dominante"]) for r in risk} == {(50.0, "resgates_30d_pct")}


def test_relationship_reports(spark, rows):
    risk = spark.createDataFrame(
        [(1, 20240101, 80.0, "critico", 0.9, 10.0), (2, 20240101, 45.0, "atencao", 0.4, 20.0), (3, 20240101, 10.0, "estavel", 0.1, 99.0),
         (4, 20240101, 50.0, "atencao", 0.5, 20.0)],
        "sk_cliente bigint, sk_data int, score_risco double, nivel_risco string, prob_churn double, valor_em_risco double",
    )
    segments = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "sk_cliente bigint, segmento string")
    assert rows(rel.value_at_risk_clients(risk)) == [(20240101, 3, 50.0)]
    summary = rows(rel.relationship_summary(risk, segments), "segmento", "total_clientes", "clientes_em_risco", "clientes_criticos", "valor_sob_risco")
    assert summary == [("a", 2, 2, 1, 30.0), ("b", 1, 0, 0, 0.0), ("sem_segmento", 1, 1, 0, 20.0)]
    assert rows(rel.risk_distribution(risk)) == [(20240101, "atencao", 2), (20240101, "critico", 1), (20240101, "estavel", 1)]
    assert [r["sk_cliente"] for r in rel.top_clients_at_risk(risk, 3).collect()] == [3, 2, 4]


@pytest.mark.parametrize("every", ["month", "week"])
def test_refreshed_positions_equal_all_at_once(spark, tmp_path, rows, every):
    """Movements that come later, earlier than anything stored, after quiet months, of new clients and of no client."""
    path, draw = str(tmp_path / "loja"), random.Random(7)
    start = dt.date(2024, 1, 10)
    days = [start + dt.timedelta(days=draw.randrange(40)) for _ in range(60)] + [dt.date(2024, 6, 3), dt.date(2023, 11, 2), dt.date(2024, 2, 1), dt.date(2024, 8, 15)]
    moves = [
        (draw.choice([1, 2, 3, None]), draw.choice(["A", "R", None]), Decimal(draw.randrange(10_000)) / 100, dt.datetime(d.year, d.month, d.day, 12))
        for d in days
    ]
    moves += [(9, "A", Decimal("5.00"), dt.datetime(2024, 8, 15, 1)), (1, "A", Decimal("1.00"), None)]
    schema = "sk_cliente long, natureza_operacao string, valor decimal(19,2), data timestamp"
    seen = []
    for wave in (moves[:60], moves[60:61], moves[61:63], moves[63:]):
        seen += wave
        since = min(m[3].date() for m in wave if m[3])
        for _ in range(2):
            positions.refresh_positions(spark, spark.createDataFrame(seen, schema), path, since=since, every=every)
    dated = spark.createDataFrame([m for m in seen if m[3]], schema)
    whole = rel.client_daily_position(dated).filter("dias_sem_movimentacao IS NOT NULL")
    got = positions.read_positions(spark, path)
    assert got.columns == whole.columns and rows(got) == rows(whole)


def test_a_refresh_reads_only_days_from_its_period_on(spark, tmp_path, rows):
    path, schema = str(tmp_path / "loja"), "sk_cliente long, natureza_operacao string, valor decimal(19,2), data timestamp"
    old = [(1, "A", Decimal("10.00"), dt.datetime(2024, 1, 5)), (1, "R", Decimal("4.00"), dt.datetime(2024, 2, 5))]
    positions.refresh_positions(spark, spark.createDataFrame(old, schema), path)
    january = {p: p.stat().st_mtime_ns for p in (tmp_path / "loja").rglob("inicio=2024-01-01/*.parquet")}
    new = spark.createDataFrame([old[1], (1, "A", Decimal("1.00"), dt.datetime(2024, 2, 7))], schema)
    assert positions.refresh_positions(spark, new, path, since=dt.date(2024, 2, 7)) == dt.date(2024, 2, 1)
    got = rows(positions.read_positions(spark, path).filter("sk_data >= 20240204"), "sk_data", "saldo_dia", "valor_investido")
    assert [(k, float(b), float(v)) for k, b, v in got] == [(20240204, 10, 10), (20240205, 6, 10), (20240206, 6, 10), (20240207, 7, 11)]
    assert january == {p: p.stat().st_mtime_ns for p in (tmp_path / "loja").rglob("inicio=2024-01-01/*.parquet")}


def test_no_dated_movement_stores_nothing(spark, tmp_path):
    none = spark.createDataFrame([(1, "A", Decimal("1.00"), None)], "sk_cliente long, natureza_operacao string, valor decimal(19,2), data timestamp")
    assert positions.refresh_positions(spark, none, str(tmp_path / "loja")) is None
    assert positions.read_balances(spark, str(tmp_path / "loja")) is None
