"""Star schema, variations, period aggregates."""

import contextlib
import datetime as dt
import io
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from cotalake.functions import text
from cotalake.operators import ordered, periods
from cotalake.plans import gold

REPORT = "CNPJ_FUNDO_CLASSE string, DT_COMPTC string, VL_PATRIM_LIQ string, CAPTC_DIA string, RESG_DIA string, NR_COTST string"


@pytest.fixture(scope="module")
def registry(spark):
    return spark.createDataFrame(
        [("191", "Fundo A", "Normal"), ("192", "Fundo B", "Normal"), ("--", "Sem CNPJ", "x"), (None, "Nulo", "x")],
        "CNPJ_Classe string, Denominacao_Social string, Situacao string",
    )


@pytest.fixture(scope="module")
def report(spark):
    equity = ["1000000.5", "1005000.25", "1010000.0", "1015000.75", "1020000.5"]
    inflow, redemption = [50000, 45000, 55000, 60000, 50000], [30000, 35000, 40000, 45000, 50000]
    days = [
        ("191", f"2024-01-0{i + 1}", equity[i], str(inflow[i]), str(redemption[i]), str(5000 + 20 * i)) for i in range(5)
    ]
    noise = [
        ("--", "2024-01-01", "1", "1", "1", "1"), (None, "2024-01-01", "1", "1", "1", "1"),
        ("191", "01/02/2024", "1", "1", "1", "1"), ("999", "2024-01-01", "1", "1", "1", "1"),
    ]
    return spark.createDataFrame(days + noise, REPORT)


def test_dim_fundo_local_and_cloud(registry, rows):
    local = gold.dim_fundo(registry)
    assert local.columns == ["sk_fundo", "cnpj_fundo_classe_norm", "cnpj_fundo_classe", "nome_fundo", "Situacao"]
    assert rows(local) == [(770285, "192", "192", "Fundo B", "Normal"), (898300, "191", "191", "Fundo A", "Normal")]
    assert gold.dim_fundo(registry, "cloud").columns[2:] == ["CNPJ_Classe", "Denominacao_Social", "Situacao"]


@pytest.mark.parametrize("one_row_per_day", [True, False])
def test_known_fact(spark, registry, report, one_row_per_day):
    fact = gold.fct_fundo_diario(report, gold.dim_fundo(registry), one_row_per_day=one_row_per_day)
    assert fact.columns == gold.FACT_COLUMNS
    got = fact.orderBy("sk_data").collect()
    assert [r["sk_data"] for r in got] == [20240101, 20240102, 20240103, 20240104, 20240105]
    assert {r["sk_fundo"] for r in got} == {898300}
    assert [r["fluxo_liquido_dia"] for r in got] == [20000, 10000, 15000, 15000, 0]
    expected = [None, 0.4999747500126217, 0.49748743843596177, 0.49512376237623723, 0.4925858429168706]
    assert got[0]["variacao_pl_dia_pct"] is None
    assert [r["variacao_pl_dia_pct"] for r in got[1:]] == pytest.approx(expected[1:], abs=1e-9)
    assert all(r["flag_base_real"] is True for r in got)


def test_known_aggregate(spark, registry, report):
    fact = gold.fct_fundo_diario(report, gold.dim_fundo(registry))
    got = periods.agg_fundo_periodo(fact).orderBy("periodo").collect()
    assert [r["periodo"] for r in got] == [7, 30, 60, 90]
    for r in got:
        assert (r["captacao_periodo"], r["resgate_periodo"], r["fluxo_liquido_periodo"]) == (260000, 200000, 60000)
        assert r["var_patrimonio_periodo_pct"] == pytest.approx(0.4962929484354228)
        assert r["var_cotistas_periodo_pct"] == pytest.approx(0.39762217208085815)
        assert r["score_risco_fundo"] == pytest.approx(0.4469575602581405)
        assert (r["nivel_risco_fundo"], r["data_referencia"]) == ("baixo", 20240105)
    cloud = periods.agg_fundo_periodo(fact, [7], "cloud").first()
    assert cloud["score_risco_fundo"] == pytest.approx(54.962929484354228) and cloud["nivel_risco_fundo"] == "medio"


def test_missing_flow_columns(spark, registry, report):
    fact = gold.fct_fundo_diario(report.drop("CAPTC_DIA"), gold.dim_fundo(registry))
    assert {r["fluxo_liquido_dia"] for r in fact.collect()} == {None}
    aggregate = periods.agg_fundo_periodo(fact, [7]).first()
    assert (aggregate["captacao_periodo"], aggregate["fluxo_liquido_periodo"]) == (0, 0)
    with pytest.raises(KeyError):
        gold.fct_fundo_diario(report.drop("CAPTC_DIA"), gold.dim_fundo(registry), "cloud")
    with pytest.raises(KeyError):
        gold.fct_fundo_diario(report.drop("VL_PATRIM_LIQ"), gold.dim_fundo(registry))


def test_known_calendar(spark):
    bounds = spark.createDataFrame([(dt.date(2023, 1, 1), dt.date(2024, 12, 31))], "inicio date, fim date")
    got = {r["sk_data"]: r for r in gold.calendar_extras(gold.dim_tempo(bounds)).collect()}
    assert len(got) == 731
    assert got[20230101]["dia_semana"] == 6 and got[20230101]["semana_iso"] == 52 and got[20230101]["eh_fim_de_semana"] == 1
    assert got[20241231]["eh_fim_de_mes"] == 1 and got[20240228]["eh_fim_de_mes"] == 0 and got[20240229]["eh_fim_de_mes"] == 1


PADDED = [100.0, None, 110.0, 0.0, 5.0, 0.0, 0.0, 7.0]
CHANGES = [None, 0.0, 10.0, -100.0, math.inf, -100.0, None, math.inf]


@pytest.mark.parametrize("max_rows", [None, 1_000_000, 1])
def test_padding(spark, max_rows):
    """One window, one chunk per month, and one chunk per day and slice give the same values."""
    start = dt.date(2024, 1, 28)
    data = [(1, start + dt.timedelta(days=i), v, 0) for i, v in enumerate(PADDED)]
    df = spark.createDataFrame(data, "k int, d date, v double, tie bigint")
    if max_rows is None:
        got = ordered.padded_change(df, "k", "d", {"v": "o"})
    else:
        got = ordered.padded_change_split(df, "k", "d", "tie", {"v": "o"}, max_rows=max_rows)
    values = [r["o"] for r in got.orderBy("d").collect()]
    assert [v if v is None or math.isinf(v) else round(v, 9) for v in values] == CHANGES


def brute_force(data):
    """(key, day, tie) -> change, by walking each key's rows in order."""
    out, last = {}, {}
    for k, d, tie, v in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        before = last.get(k)
        now = v if v is not None else before
        if now is None or before is None:
            out[k, d, tie] = None
        elif before == 0:
            out[k, d, tie] = None if now == 0 else math.inf
        else:
            out[k, d, tie] = (now / before - 1) * 100
        last[k] = now
    return out


@pytest.mark.parametrize("max_rows", [1_000_000, 40, 1])
def test_hot_fund_against_brute_force(spark, max_rows):
    """One fund holds a third of the rows, most of them on one day."""
    rnd = random.Random(7)
    data = []
    for i in range(900):
        hot = i % 3 == 0
        key = 1 if hot else rnd.randint(2, 12)
        day = dt.date(2024, 2, 14) if hot and i % 2 else dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 120))
        value = None if rnd.random() < 0.4 else float(rnd.randint(0, 5))
        data.append((key, day, rnd.randrange(1 << 32), value))
    df = spark.createDataFrame(data, "k int, d date, tie bigint, v double")
    got = ordered.padded_change_split(df, "k", "d", "tie", {"v": "o"}, max_rows=max_rows).collect()
    expected = brute_force(data)
    assert len(got) == len(data)
    for r in got:
        want = expected[r["k"], r["d"], r["tie"]]
        assert r["o"] == (want if want is None or math.isinf(want) else pytest.approx(want)), r


def test_hot_month_is_cut_into_slices(spark):
    """With the limit below the month's size, no chunk holds the whole month."""
    df = spark.range(4000).select(
        F.lit(1).alias("k"), F.lit("2024-01-05").cast("date").alias("d"), text.row_order("id").alias("tie"), F.col("id").alias("v")
    )
    sizes = ordered.mark_chunks(df, "k", "d", "tie", max_rows=100).groupBy("_chunk_day", "_chunk_slice").count()
    assert sizes.agg(F.max("count")).first()[0] < 100
    whole = ordered.mark_chunks(df, "k", "d", "tie").groupBy("_chunk_day", "_chunk_slice").count()
    assert [r["count"] for r in whole.collect()] == [4000]


def test_chunks_are_few_and_bounded(spark):
    """One day of 300,000 rows and a hundred small days: n / max_rows chunks and one for some of the days."""
    day = F.when(F.col("id") < 300_000, F.lit(50)).otherwise(F.col("id") % 100)
    df = spark.range(310_000).select(
        F.lit(1).alias("k"), F.date_add(F.lit("2024-01-01").cast("date"), day.cast("int")).alias("d"), text.row_order("id").alias("tie"), F.col("id").alias("v")
    )
    sizes = ordered.mark_chunks(df, "k", "d", "tie", max_rows=10_000).groupBy("_chunk_day", "_chunk_slice").count()
    chunks, largest, rows = sizes.agg(F.count(F.lit(1)), F.max("count"), F.sum("count")).first()
    assert chunks <= 31 + 100 and largest <= 10_000 and rows == 310_000


def test_equal_rows_are_one_in_the_window(spark):
    """Equal rows of a fund and day beyond any chunk: the first copy changes, the others do not."""
    start = dt.date(2024, 1, 1)
    days = [(1, start, 4.0, 1), (2, start, 1.0, 1)]
    df = spark.createDataFrame(days, "k int, d date, v double, tie bigint")
    copies = spark.range(5_000).select(
        F.lit(1).alias("k"), F.lit("2024-01-02").cast("date").alias("d"), F.when(F.col("id") < 4_990, 5.0).alias("v"),
        F.when(F.col("id") < 4_990, 7).otherwise(8).cast("long").alias("tie"),
    )
    later = spark.createDataFrame([(1, dt.date(2024, 1, 3), 10.0, 3)], "k int, d date, v double, tie bigint")
    got = ordered.padded_change_split(df.unionByName(copies).unionByName(later), "k", "d", "tie", {"v": "o"}, max_rows=100)
    counts = {(r["k"], r["d"].day, r["v"], r["o"]): r["n"] for r in got.groupBy("k", "d", "v", "o").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {(1, 1, 4.0, None): 1, (2, 1, 1.0, None): 1, (1, 2, 5.0, 25.0): 1, (1, 2, 5.0, 0.0): 4_989, (1, 2, None, 0.0): 10, (1, 3, 10.0, 100.0): 1}
    assert got.columns == ["k", "d", "v", "tie", "o"]


@pytest.mark.parametrize("max_rows", [1_000_000, 3])
def test_history_between_the_rows(spark, max_rows):
    """Known values of months that the rows lack stand where they belong."""
    rows = [(1, dt.date(2024, 2, d), 10.0 if d == 1 else None, d) for d in range(1, 8)] + [(1, dt.date(2024, 5, 1), 30.0, 1), (2, dt.date(2024, 5, 1), 1.0, 1)]
    history = spark.createDataFrame([(1, dt.date(2024, 1, 1), 5.0), (1, dt.date(2024, 4, 1), 20.0), (1, dt.date(2024, 6, 1), 99.0)], "k int, _chunk_day date, v double")
    df = spark.createDataFrame(rows, "k int, d date, v double, tie bigint")
    got = ordered.padded_change_split(df, "k", "d", "tie", {"v": "o"}, max_rows=max_rows, history=history)
    found = {(r["k"], r["d"]): r["o"] for r in got.collect()}
    assert len(found) == 9 and found[1, dt.date(2024, 2, 1)] == 100.0 and found[1, dt.date(2024, 5, 1)] == 50.0 and found[2, dt.date(2024, 5, 1)] is None
    assert all(found[1, dt.date(2024, 2, d)] == 0.0 for d in range(2, 8))


def test_the_input_is_read_twice(spark, tmp_path):
    """However many keys are large: once to count, once to order."""
    path = str(tmp_path / "t")
    spark.range(3_000).select(
        (F.col("id") % 3).alias("k"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int")).alias("d"),
        text.row_order("id").alias("tie"), F.col("id").cast("double").alias("v"),
    ).write.parquet(path)
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    df = spark.read.parquet(path)
    got = ordered.padded_change_split(df.mapInArrow(counted, df.schema), "k", "d", "tie", {"v": "o"}, max_rows=100)
    assert got.count() == 3_000 and reads.value <= 6_000


def test_known_sizes_save_the_count(spark, tmp_path):
    """With the rows per key at hand the input is read once; large keys are still cut, and the result is the same."""
    path, schema = str(tmp_path / "t"), "k bigint, d date, tie bigint, v double"
    spark.range(900).select(
        (F.col("id") % 3).alias("k"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int")).alias("d"),
        text.row_order("id").alias("tie"), F.col("id").cast("double").alias("v"),
    ).write.parquet(path)
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    df = spark.read.parquet(path)
    plain = sorted(map(tuple, ordered.padded_change_split(df, "k", "d", "tie", {"v": "o"}, max_rows=1000).collect()))
    for size, most in ((300, 900), (2000, 1800)):
        sizes = spark.range(3).select(F.col("id").alias("k"), F.lit(size).cast("long").alias("_n"))
        reads.value = 0
        got = ordered.padded_change_split(df.mapInArrow(counted, schema), "k", "d", "tie", {"v": "o"}, max_rows=1000, sizes=sizes)
        assert sorted(map(tuple, got.collect())) == plain and reads.value <= most


def test_row_order_is_a_32_bit_number(spark):
    bounds = spark.range(5000).select(text.row_order("id").alias("a"), text.number_order("id").alias("b"))
    low, high, n, m = bounds.agg(
        F.least(F.min("a"), F.min("b")), F.greatest(F.max("a"), F.max("b")), F.countDistinct("a"), F.countDistinct("b")
    ).first()
    assert low >= 0 and high < 1 << 32 and n >= 4998 and m >= 4998


# ---- true trailing periods ----

FACT = (
    "sk_fundo bigint, sk_data int, captacao_dia double, resgate_dia double, fluxo_liquido_dia double, "
    "patrimonio_liquido_dia double, cotistas_dia double, variacao_pl_dia_pct double"
)


@pytest.fixture(scope="module")
def trailing(spark):
    rnd = random.Random(3)
    data = []
    for fund in range(1, 6):
        for offset in sorted(rnd.sample(range(200), 60)):
            day = dt.date(2023, 9, 1) + dt.timedelta(days=offset)
            a, b = rnd.randint(0, 9999) / 100, rnd.randint(0, 9999) / 100
            data.append((fund, int(day.strftime("%Y%m%d")), a, b, round(a - b, 2), rnd.choice([None, 10.0, 20.0]), float(rnd.randint(1, 9)), rnd.random()))
    return data, spark.createDataFrame(data, FACT)


def _day(key):
    return dt.datetime.strptime(str(key), "%Y%m%d").date()


def _window(data, fund, n, end=None):
    mine = sorted(r for r in data if r[0] == fund)
    end = end or max(r[1] for r in mine)
    return [r for r in mine if 0 <= (_day(end) - _day(r[1])).days < n]


def test_trailing_sums(trailing):
    data, fact = trailing
    got = {(r["sk_fundo"], r["periodo"]): r for r in periods.kpi_trailing_period(fact).collect()}
    assert len(got) == 20
    for (fund, n), r in got.items():
        mine = _window(data, fund, n)
        assert r["captacao_periodo"] == pytest.approx(sum(x[2] for x in mine))
        assert r["fluxo_liquido_periodo"] == pytest.approx(sum(x[4] for x in mine))
        assert r["captacao_periodo"] <= sum(x[2] for x in data if x[0] == fund) + 1e-9


def test_trailing_change_takes_known_values(trailing):
    data, fact = trailing
    got = {(r["sk_fundo"], r["periodo"]): r["var_patrimonio_periodo"] for r in periods.kpi_var_patrimonio(fact).collect()}
    for (fund, n), change in got.items():
        known = [x[5] for x in _window(data, fund, n) if x[5] is not None]
        assert change == (pytest.approx(known[-1] / known[0] - 1) if known else None)


def test_rolling_sums(trailing):
    data, fact = trailing
    for r in periods.rolling_daily_kpi(fact).collect():
        for n in (7, 90):
            mine = _window([x for x in data if x[1] <= r["sk_data"]], r["sk_fundo"], n, r["sk_data"])
            assert r[f"captacao_{n}d"] == pytest.approx(sum(x[2] for x in mine))
            assert r[f"fluxo_liquido_{n}d"] == pytest.approx(sum(x[4] for x in mine))


def test_rolling_sum_of_nothing_is_null(spark):
    fact = spark.createDataFrame([(1, 20240101, None, 1.0, None, 1.0, 1.0, 1.0)], FACT)
    r = periods.rolling_daily_kpi(fact).first()
    assert (r["captacao_7d"], r["resgate_7d"], r["fluxo_liquido_7d"]) == (None, 1.0, None)


def test_rolling_sums_run_as_compiled_code(spark):
    """The JVM only interprets a generated method of more than 8,000 bytes."""
    fact = spark.createDataFrame([(1, 20240101, None, 1.0, None, 1.0, 1.0, 1.0)], FACT)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with contextlib.redirect_stdout(io.StringIO()) as shown:
            periods.rolling_daily_kpi(fact).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    found = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", shown.getvalue())]
    assert found and max(found) <= 8_000


def test_rolling_sums_by_promise_shuffle_once(spark, trailing, rows):
    """Rows that are one per fund and day go to their fund at once; the result is the same, also where days repeat."""
    _, fact = trailing
    several = fact.unionByName(fact)
    assert rows(periods.rolling_daily_kpi(several, one_row_per_day=True)) == rows(periods.rolling_daily_kpi(several))
    with contextlib.redirect_stdout(io.StringIO()) as shown:
        periods.rolling_daily_kpi(fact, one_row_per_day=True).explain()
    assert shown.getvalue().count("Exchange hashpartitioning") == 1


def test_rolling_sums_of_infinite_days(spark):
    """Each kind of infinite amount alone and both together, beside finite and missing ones; 8 days later they are gone."""
    inf = float("inf")
    days = [(20240101, inf, -inf, 1.0), (20240102, -inf, 2.0, None), (20240103, 5.0, None, None), (20240110, 7.0, None, -inf)]
    fact = spark.createDataFrame([(1, d, a, b, c, None, None, None) for d, a, b, c in days], FACT)
    got = periods.rolling_daily_kpi(fact, [7]).orderBy("sk_data").select("captacao_7d", "resgate_7d", "fluxo_liquido_7d").collect()
    found = [tuple("nan" if v is not None and v != v else v for v in r) for r in got]
    assert found == [(inf, -inf, 1.0), ("nan", -inf, 1.0), ("nan", -inf, 1.0), (7.0, None, -inf)]


def test_describe_matches_pandas(spark):
    import pandas as pd

    values = [float(v) for v in (1, 5, 2, 8, 13, 21)]
    df = spark.createDataFrame([(7, v) for v in values], "periodo int, fluxo_liquido_periodo double")
    got = periods.describe_flow_by_period(df).first()
    assert [float(v) for v in got[1:]] == pytest.approx(list(pd.Series(values).describe()))


def test_rank_orders_by_flow(spark, rows):
    kpis = spark.createDataFrame([(1, 7, 5.0), (2, 7, 9.0), (3, 7, 5.0)], "sk_fundo bigint, periodo int, fluxo_liquido_periodo double")
    levels = spark.createDataFrame([(1, 7, "alto")], "sk_fundo bigint, periodo int, nivel_risco_fundo string")
    assert rows(periods.rank_funds(kpis, levels), "sk_fundo", "posicao", "nivel_risco_fundo") == [(1, 2, "alto"), (2, 1, None), (3, 2, None)]


def test_month_filter_prunes(spark, tmp_path):
    from cotalake.sinks.writers import sink_partitioned_month

    df = spark.createDataFrame([(20240131, 1), (20240201, 2), (20240301, 3)], "sk_data int, v int")
    sink_partitioned_month(df, str(tmp_path / "t"))
    filtered = gold.with_month_filter(spark.read.parquet(str(tmp_path / "t")), 20240201, 20240229)
    assert [r["v"] for r in filtered.collect()] == [2]
    plan = filtered._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano_mes" in plan


def test_client_dimension(spark):
    clients = spark.createDataFrame(
        [(7, "Ana", dt.date(1990, 1, 1), 100.0)], "sk_cliente bigint, nome_cliente string, data_nascimento date, renda_estimada double"
    )
    got = gold.dim_cliente(clients, F.lit("2024-01-01").cast("date"))
    assert len(got.columns) == 14
    r = got.first()
    assert (r["id_cliente"], r["faixa_etaria"], r["renda_estimada"], r["uf"]) == ("CLI_0000007", "31-40", 20000.0, None)


def test_sums_keep_infinity_and_parts_of_a_cent(spark, rows):
    inf = float("inf")
    data = [(20240101, 1, inf, 0.004), (20240102, 1, 2.0, 0.004), (20240115, 1, 3.5001, None), (20240116, 1, None, -inf)]
    fact = spark.createDataFrame(data, "sk_data int, sk_fundo bigint, captacao_dia double, resgate_dia double").withColumns(
        {"fluxo_liquido_dia": F.col("captacao_dia") - F.col("resgate_dia"), "variacao_pl_dia_pct": F.lit(1.0)}
    ).withColumn("variacao_cotistas_dia_pct", F.lit(1.0))
    trailing = rows(periods.kpi_trailing_period(fact, [7, 30]), "periodo", "captacao_periodo", "resgate_periodo")
    assert trailing == [(30, inf, -inf), (7, 3.5001, -inf)]
    assert periods.agg_fundo_periodo(fact, [7]).first()["captacao_periodo"] == inf
    rolling = rows(periods.rolling_daily_kpi(fact, [7]), "sk_data", "captacao_7d", "resgate_7d")
    assert rolling == [(20240101, inf, 0.004), (20240102, inf, 0.008), (20240115, 3.5001, None), (20240116, 3.5001, -inf)]


def test_wide_key_keeps_every_fund(spark):
    """Of 20,000 CNPJs, some share a parity key; under the wide key none loses its row."""
    cnpjs = spark.range(20_000).select(F.lpad(F.col("id").cast("string"), 14, "0").alias("CNPJ_FUNDO_CLASSE"))
    dim = gold.dim_fundo(cnpjs, key="wide")
    assert gold.dim_fundo(cnpjs).count() < 20_000
    assert (dim.count(), dim.select("sk_fundo").distinct().count()) == (20_000, 20_000)
    report = cnpjs.select(
        "*", F.lit(dt.date(2024, 1, 2)).alias("DT_COMPTC"), *[F.lit(1.0).alias(c) for c in ("VL_PATRIM_LIQ", "CAPTC_DIA", "RESG_DIA", "NR_COTST")]
    )
    assert gold.fct_fundo_diario(report, dim, one_row_per_day=True, key="wide").count() == 20_000
