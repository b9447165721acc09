"""The driver contract and a value comparison on the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_module

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
COMPARED = sorted(set(entry_module.oracle_sql()) - set(entry_module.LLM_SQL))

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no supplied tables")


def test_every_query_has_sql_of_the_same_name():
    own = set(entry_module.queries()) - set(entry_module.LLM_QUERIES)
    assert set(entry_module.oracle_sql()) - set(entry_module.LLM_SQL) == own and len(own) >= 102
    assert set(entry_module.LLM_SQL) <= set(entry_module.LLM_QUERIES)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns[:3] == ["sk_data", "sk_fundo", "cnpj_fundo_classe_norm"] and df.count() > 0


def _cells(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("∅" if r[i] is None else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", COMPARED)
def test_values(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = entry_module.queries()[name](spark, SF)
    result = con.execute(entry_module.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert _cells(df.columns, df.collect()) == _cells(columns, result.fetchall())
