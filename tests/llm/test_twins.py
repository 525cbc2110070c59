"""Every SQL twin of the operators, on DuckDB over the small tables."""

import math

import duckdb
import pytest

from claimlens.llm import queries
from tests.llm.frames import SF


@pytest.fixture(scope="module")
def twin():
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "labels", "conversations"):
        connection.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return connection


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_twin(spark, twin, name):
    frame = queries.QUERIES[name](spark, SF)
    found = twin.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(frame.columns) == sorted(names)
    ours = sorted((tuple(plain(row[c]) for c in names) for row in frame.collect()), key=repr)
    theirs = sorted((tuple(map(plain, row)) for row in found.fetchall()), key=repr)
    assert ours == theirs and len(ours) > 0


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
