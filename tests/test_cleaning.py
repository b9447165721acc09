"""Column resolution, cleaning, rules and quality checks."""

import datetime as dt

import pytest

from cotalake import schemas
from cotalake.operators import cleaning, joins, quality
from cotalake.operators.resolve import (
    Wanted,
    column_mapping,
    column_mapping_report,
    conform,
    inspect_schema,
    project_adaptive,
    resolve_column,
    resolve_optional_column,
)
from cotalake.plans import silver


def test_alias_order_wins_over_column_order():
    assert resolve_column(["Data", "dt_comptc"], ["DT_COMPTC", "data"]) == "dt_comptc"
    assert resolve_column(["A", "a"], ["a"]) == "a"
    assert resolve_optional_column(["x"], ["y"]) is None
    with pytest.raises(KeyError, match="y"):
        resolve_column(["x"], ["y"])


def test_project_adaptive_with_columns_that_differ_in_case(spark, rows):
    df = spark.createDataFrame([(1, 2)], "a int, b int").toDF("Nome", "nome")
    got = project_adaptive(df, [Wanted("n", ["NOME"]), Wanted("z", ["z"], required=False, type="int")])
    assert rows(got) == [(2, None)]


def test_mapping_and_override(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "x")], "CNPJ_Classe int, DENOM string")
    wanted = [Wanted("cnpj", ["cnpj_classe"]), Wanted("nome", ["nome"], False), Wanted("alvo", ["alvo"], False)]
    assert column_mapping(df.columns, wanted, {"nome": "denom"}) == [
        ("cnpj", "CNPJ_Classe", "alias"), ("nome", "DENOM", "override"), ("alvo", None, "absent"),
    ]
    assert rows(column_mapping_report(df, wanted, {"nome": "denom"}), "coluna_padrao", "registros", "preenchidos") == [
        ("alvo", 2, 0), ("cnpj", 2, 2), ("nome", 2, 1),
    ]


def test_inspect_schema(spark, rows):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert rows(inspect_schema({"t": df})) == [("t", 0, "a", "int", 1, 1), ("t", 1, "b", "string", 1, 0)]


def test_dedupe_then_drop(spark, rows):
    df = spark.createDataFrame([("x", 1), (None, None), ("x", 1), (None, None), (" x", 1)], "a string, b int")
    assert rows(cleaning.basic_clean(df)) == [("x", 1)]


def test_filter_before_dedupe_gives_the_same_rows(spark, rows):
    df = spark.createDataFrame([("N ", " 1"), ("N", "1"), ("S", "1"), (None, None), ("N", "2")], "Exclusivo string, v string")
    slow = cleaning.clean_filter_clean(df, cleaning.filter_class_registry)
    assert rows(slow) == rows(cleaning.clean_filter(df, cleaning.filter_class_registry)) == [("N", "1"), ("N", "2")]


def test_daily_report_cleaning_matches_clean_coerce_clean(spark, rows):
    df = spark.createDataFrame(
        [("1", "2024-01-01", "1.0"), ("1", "2024-1-1", "1.00"), ("1", "2024-01-01 ", " 1"), (None, "bad", "x"), ("2", "bad", "y")],
        "CNPJ_FUNDO_CLASSE string, DT_COMPTC string, VL_TOTAL string",
    )
    slow = cleaning.clean_filter_clean(df, cleaning.coerce_daily_report)
    expected = [("1", dt.date(2024, 1, 1), 1.0), ("2", None, None)]
    assert rows(slow) == rows(silver.clean_daily_report(df)) == expected


def test_rules_apply_only_to_present_columns(spark, rows):
    df = spark.createDataFrame([("Aberto", "N"), ("Fechado", "N"), ("Aberto", None)], "Forma_Condominio string, Exclusivo string")
    assert rows(cleaning.filter_fund_registry(df)) == [("Aberto", "N")]
    assert cleaning.filter_by_rules(df, {"x": ["y"]}) is df


@pytest.mark.parametrize("kind, column, keep, drop", [
    ("registro_fundo", "Tipo_Fundo", "FACFIF", "FII"),
    ("registro_fundo", "Data_Adaptacao_RCVM175", "2024-01-01", None),
    ("registro_classe", "Classificacao", "Ações", "Cambial"),
    ("registro_subclasse", "Exclusivo_INR", "N", "S"),
])
def test_each_registry(spark, rows, kind, column, keep, drop):
    df = spark.createDataFrame([(keep, "a"), (drop, "b")], f"{column} string, outra string")
    assert rows(silver.clean_registry(df, kind), column) == [(keep,)]


def test_distinct_by_key_keeps_the_first(spark, rows):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (None, "d"), (None, "e")], "k int, v string")
    assert rows(cleaning.distinct_by_key(df, ["k"], ["v"])) == [(None, "d"), (1, "a"), (2, "c")]


def test_union_by_name_fills_missing(spark, rows):
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([("y",)], "s string")
    assert rows(cleaning.union_all_by_name(a, b)) == [(None, "y"), (1, "x")]


def test_operational_tables():
    assert len(schemas.OPERATIONAL_TABLES) == 13
    assert "senha" not in schemas.OPERATIONAL_TABLES["usuario"].fieldNames()
    assert schemas.OPERATIONAL_TABLES["fundo_cotista"]["quantidade_cotas"].dataType.simpleString() == "decimal(17,3)"


def test_conform_casts_and_fills(spark, rows):
    df = spark.createDataFrame([("1", "x", "9")], "ID_SEGMENTO string, nome string, outra string")
    assert rows(conform(df, schemas.OPERATIONAL_TABLES["segmento"])) == [(1, "x")]
    bad = spark.createDataFrame([("a",)], "id_segmento string")
    assert rows(conform(bad, schemas.OPERATIONAL_TABLES["segmento"])) == [(None, None)]


# ---- quality ----

FACT = "captacao_dia double, resgate_dia double, fluxo_liquido_dia double, patrimonio_liquido_dia double"


def test_null_flow_is_a_failure_of_its_own(spark):
    fact = spark.createDataFrame([(2.0, 1.0, 1.0, 5.0), (None, 1.0, None, 5.0), (2.0, 1.0, 3.0, -1.0)], FACT)
    assert tuple(quality.dq_reconcile_flow(fact).first()) == (3, 1, 1, False)
    assert tuple(quality.dq_negative_pl(fact).first()) == (3, 1, False)


def test_score_range_and_status(spark):
    agg = spark.createDataFrame([(0.0,), (100.0,), (None,), (100.1,)], "score_risco_fundo double")
    assert tuple(quality.dq_score_range(agg).first()) == (4, 2, False)
    status = quality.dq_status(quality.aggregate_checks(agg)).first()
    assert (status["status"], status["status_code"], status["erros"]) == ("partial", 207, "faixa_score")
    good = quality.dq_status(quality.aggregate_checks(agg.filter("score_risco_fundo <= 100"))).first()
    assert (good["status"], good["status_code"], good["erros"]) == ("success", 200, "")
    empty = quality.dq_status(quality.aggregate_checks(agg.filter("false"))).first()
    assert (empty["status"], empty["status_code"]) == ("error", 404)


def test_simulation_rules(spark, rows):
    positions = spark.createDataFrame(
        [(1, 20240101, 9.0), (1, 20240101, -1.0), (1, 20240102, 8.0), (2, 20240101, 5.0), (3, 20240101, 7.0)],
        "sk_fundo bigint, sk_data int, saldo_dia double",
    )
    risk = spark.createDataFrame([(0.0,), (1.0,), (1.1,), (None,)], "prob_churn double")
    equity = spark.createDataFrame([(1, 20240101, 4.0), (1, 20240102, 4.0), (2, 20240101, 5.0)], "sk_fundo bigint, sk_data int, patrimonio double")
    assert rows(quality.dq_simulation_rules(positions, risk, equity, 2.0)) == [
        ("churn_fora_0_1", 4, 2), ("posicao_longe_do_pl", 4, 2), ("saldo_negativo", 5, 1),
    ]


def test_balances_are_compared_day_by_day(spark, rows):
    positions = spark.createDataFrame([(1, 20240101, 60.0), (1, 20240102, 60.0), (1, 20240103, 120.0)], "sk_fundo bigint, sk_data int, saldo_dia double")
    risk = spark.createDataFrame([(0.5,)], "prob_churn double")
    equity = spark.createDataFrame([(1, d, 100.0) for d in (20240101, 20240102, 20240103)], "sk_fundo bigint, sk_data int, patrimonio double")
    assert ("posicao_longe_do_pl", 3, 0) in rows(quality.dq_simulation_rules(positions, risk, equity, tolerance=0.4))
    assert ("posicao_longe_do_pl", 3, 2) in rows(quality.dq_simulation_rules(positions, risk, equity, tolerance=0.3))


# ---- joins and lookups ----


def test_collisions(spark, rows):
    # These two numbers share a key; the third does not.
    seen, pair = {}, None
    import hashlib

    for n in range(5000):
        key = int(hashlib.md5(str(n).encode()).hexdigest(), 16) % 1_000_000
        if key in seen:
            pair = (key, str(seen[key]), str(n))
            break
        seen[key] = n
    df = spark.createDataFrame([(pair[1],), (pair[2],), (pair[2],), ("191",)], f"{joins.CNPJ} string")
    low, high = sorted(pair[1:])
    assert rows(joins.key_collision_report(df)) == [(pair[0], 2, low, high)]


def test_status_runs(spark, rows):
    d = dt.date
    df = spark.createDataFrame(
        [(1, d(2024, 1, 1), "a", 1), (1, d(2024, 1, 3), "a", 2), (1, d(2024, 1, 5), "b", 3), (1, d(2024, 1, 5), "c", 4),
         (1, d(2024, 1, 9), None, 5), (2, d(2024, 1, 1), None, 6)],
        "k int, dia date, s string, t int",
    )
    assert rows(joins.describe_status_runs(df, "k", "dia", "s", "t"), "k", "dt_inicio", "s", "dt_fim_vigencia", "vigente") == [
        (1, d(2024, 1, 1), "a", d(2024, 1, 4), False),
        (1, d(2024, 1, 5), "c", d(2024, 1, 8), False),
        (1, d(2024, 1, 9), None, None, True),
        (2, d(2024, 1, 1), None, None, True),
    ]


def test_alert_compares_with_stored_text(spark, rows):
    daily = spark.createDataFrame(
        [(1, 100.0, 21.0), (1, 100.0, 20.0), (2, 100.0, 90.0), (3, 0.0, 5.0), (4, 100.0, 99.0)],
        "classe bigint, patrimonio_liquido_dia double, resgate_dia double",
    )
    limits = spark.createDataFrame(
        [(1, "ALTA_RESGATE_PORCENTAGEM", "0.20"), (2, "ALTA_RESGATE_PORCENTAGEM", "n/d"), (3, "ALTA_RESGATE_PORCENTAGEM", "0"),
         (4, "OUTRO", "0.1")],
        "fk_registro_classe bigint, nome string, valor string",
    )
    assert rows(joins.redemption_alert(daily, limits), "classe", "proporcao_resgate") == [(1, 0.21)]


def test_latest_by_pattern_without_a_match(spark, rows):
    df = spark.createDataFrame([("A/Registro.csv", 2), ("b.csv", 9), ("a/registro2.csv", 2)], "chave string, m int")
    assert rows(joins.latest_by_pattern(df, "chave", "m", "registro")) == [("a/registro2.csv", 2)]
    assert rows(joins.latest_by_pattern(df, "chave", "m", "nada")) == [(None, None)]


def test_valuation_takes_the_newest_price(spark, rows):
    held = spark.createDataFrame([(1, "x", 2.0), (1, "x", 0.5), (1, "y", 1.0), (2, "z", 9.0)], "cliente int, ativo string, quantidade double")
    prices = spark.createDataFrame([("x", 10.0, 1), ("x", 20.0, 2), ("y", 3.0, 1)], "ativo string, preco double, momento int")
    assert rows(joins.holding_valuation(held, prices)) == [(1, 2, 53.0)]


def test_row_and_month_counts(spark, rows):
    df = spark.createDataFrame([("a", 20240101), ("a", 20240131), ("b", 20240201)], "origem string, sk_data int")
    assert rows(cleaning.row_counts(df)) == [("a", 2), ("b", 1)]
    assert rows(cleaning.month_counts(df)) == [(202401, 2), (202402, 1)]


def test_alert_prefers_the_threshold_of_the_subclass(spark, rows):
    daily = spark.createDataFrame(
        [(1, 1, 100.0, 25.0), (1, 2, 100.0, 25.0), (1, 3, 100.0, 25.0), (2, None, 100.0, 25.0)],
        "classe bigint, subclasse bigint, patrimonio_liquido_dia double, resgate_dia double",
    )
    name = "ALTA_RESGATE_PORCENTAGEM"
    limits = spark.createDataFrame(
        [(1, 1, name, "0.20"), (1, 2, name, "0.30"), (1, None, name, "0.10"), (1, None, name, "0.15"), (2, 7, name, "0.01")],
        "fk_registro_classe bigint, fk_registro_subclasse bigint, nome string, valor string",
    )
    assert rows(joins.redemption_alert(daily, limits), "classe", "subclasse", "limite") == [(1, 1, 0.2), (1, 3, 0.1)]
