"""Every registered query against its DuckDB oracle (sf0.001), and every
rows-only query runs and yields rows."""

import pytest

from conftest import SF_SMALL
from harness import compare, duck

import __spark_entry__ as E

NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    sp = sdf.toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(sp) > 0
        return
    res = compare(sp, con.execute(sql).df())
    assert res["ok"], res


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.count()
    assert rows == 1000
    assert {"prediction", "error", "anomaly", "predictionNext", "device_key"} <= set(df.columns)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", [n for n in NAMES if n in E.oracle_sql() and not n.startswith("stream")
                                  and n != "enriched_read"])
def test_column_types_match_oracle(spark, con, name):
    sp = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
          for f in E.queries()[name](spark, SF_SMALL).schema.fields}
    rel = con.sql(E.oracle_sql()[name])
    assert sp == dict(zip(rel.columns, [str(t) for t in rel.types]))
