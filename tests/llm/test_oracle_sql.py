"""The SQL of the queries that have one, against their results."""

import duckdb
import pytest

from vigil.llm.queries import ORACLE, QUERIES

TABLES = ["documents", "benchmark", "pages", "embeddings"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    rows = con.execute(ORACLE[name])
    names = [d[0] for d in rows.description]
    df = QUERIES[name](spark, small)
    assert df.columns == names
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(rows.fetchall(), key=repr)
