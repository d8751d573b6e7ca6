"""The queries that SQL can express, against DuckDB over whole tables."""

import duckdb
import pytest

from returnscope.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = registry.queries()[name](spark, SF)
    got = con.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in got.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(repr, got.fetchall())) == sorted(repr(tuple(r)) for r in df.select(*columns).collect())


def test_all_queries_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13 and "pipeline" in names
