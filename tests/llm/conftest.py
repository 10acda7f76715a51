"""Fixtures of the operator tests; the session comes from tests/conftest.py."""

import duckdb
import public_tokenizers
import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def ranks():
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def documents():
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    return dict(rows)


@pytest.fixture
def frame(spark):
    def make(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema)
    return make
