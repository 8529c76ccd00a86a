"""The corpus queries against their SQL, or where SQL has none, their shape."""

import duckdb
import pytest

from conftest import TESTDATA
from millrace.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in sorted((TESTDATA / "sf0.001").glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", ORACLES)
def test_corpus_query_equals_its_oracle(spark, sf_dir, tables, name):
    frame = QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    found = sorted(repr([r[c] for c in columns]) for r in frame.collect())
    result = tables.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert found == sorted(repr([r[i] for i in at]) for r in result.fetchall())


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]
