"""The registered SQL gives the queries' rows."""

import duckdb
import pytest

from stationspark.llm import oracle, queries

SF = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", oracle.ORACLE)
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    got = queries.queries()[name](spark, SF)
    want = con.sql(oracle.ORACLE[name])
    assert {c: TYPES[t] for c, t in got.dtypes} == {c: str(t) for c, t in zip(want.columns, want.types)}
    order = sorted(got.columns)
    assert sorted(map(tuple, got.select(order).collect())) == sorted(want.select(*order).fetchall())


def test_every_operator_is_registered():
    names = list(queries.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert set(oracle.ORACLE) <= set(names)
