"""The corpus queries that have SQL give its rows."""

import duckdb
import pytest

from skerry.llm.queries import ORACLES, QUERIES


def same(spark, folder, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet{'' if folder.startswith('/root') else '/*.parquet'}'")
    got = con.execute(ORACLES[name])
    names = [d[0] for d in got.description]
    df = QUERIES[name](spark, folder)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(repr, map(tuple, df.select(*names).collect()))) == sorted(map(repr, got.fetchall()))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_the_rows_of_its_sql(spark, sf, name):
    same(spark, sf, name)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_and_sql_agree_on_odd_texts(spark, edge, tmp_path, name):
    edge.write.parquet(f"{tmp_path}/documents.parquet")
    same(spark, str(tmp_path), name)
