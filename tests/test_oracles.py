"""Every registered query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import TESTDATA
from workload.flows import FLOWS
from workload.flows import ORACLES as FLOW_ORACLES
from workload.hook import HOOKS

QUERIES = FLOWS | {name: hook.run for name, hook in HOOKS.items()}
ORACLES = FLOW_ORACLES | {name: hook.oracle for name, hook in HOOKS.items()}


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (list, tuple)):
        return repr([_plain(v) for v in value])
    return value.isoformat() if hasattr(value, "isoformat") else str(value)


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in sorted((TESTDATA / "sf0.001").glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert ORACLES.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_oracle(spark, sf_dir, tables, name):
    frame = QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    found = sorted(tuple(_plain(r[c]) for c in columns) for r in frame.collect())
    result = tables.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert found == sorted(tuple(_plain(r[i]) for i in at) for r in result.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
