import re

import pytest

import __spark_entry__ as entry
from checks.compare import connect, rows_of
from vitrine.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_give_the_rows_of_their_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    result = connect(SF).execute(queries.SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def test_one_query_for_every_operator_and_the_pipeline():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())


def test_operators_without_sql_return_a_row_per_input_row(spark):
    for name, table in (("op1_main_text", "pages"), ("op2_toxicity", "documents"), ("op4_near_dedup", "documents"), ("op5_sentencepiece", "documents"), ("op6_language", "documents"), ("op12_token_links", "documents")):
        assert queries.QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
