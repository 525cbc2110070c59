"""Every registered query with a SQL twin, against DuckDB on the small tables; and plan checks."""

import math
import re
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest

import catalog
from tests.conftest import SMALL

# Relational queries stay clear of nested loops and of Python inside plans.
RELATIONAL = re.compile(r"(q\d|out|jn|ag|flt|prj|str|dt|ma|ps|wn|fe|mp|cr|set|srt|stg|dq|snk|src|smp|lim)")
UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"]
TABLES = "region nation customer supplier part orders lineitem events documents labels".split()


@pytest.fixture(scope="module")
def twin():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, date) and not isinstance(value, datetime):
        return datetime(value.year, value.month, value.day)
    return value


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_its_twin(spark, twin, name):
    frame = catalog.QUERIES[name](spark, SMALL)
    found = twin.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(frame.columns) == sorted(names)
    if RELATIONAL.match(name):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not [operator for operator in UNWANTED if operator in plan]
    assert bag(frame.columns, frame.collect()) == bag(names, found.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_query_without_a_twin_gives_rows(spark, name):
    assert catalog.QUERIES[name](spark, SMALL).count() > 0


def test_period_reaches_the_scan(spark):
    plan = catalog.QUERIES["q2_detail_rows"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    pushed = next(line for line in plan.splitlines() if "o_orderdate" in line and "PushedFilters" in line)
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01" in pushed
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert not any("l_tax" in s or "o_totalprice" in s for s in scans)


def test_unread_diagnoses_are_not_computed(spark):
    plan = catalog.QUERIES["q9_insured_extract"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "DIAGNOSTICO" not in plan


def test_scores_of_a_bundle_are_those_of_the_extract(spark):
    """Fitting on the features alone and joining afterwards gives the scores of the joined frame."""
    bundle, extract = (
        {r.uniqueid: r.anomalyscore for r in catalog.QUERIES[name](spark, SMALL).select("uniqueid", "anomalyscore").collect()}
        for name in ("ml6_scored_bundle", "ml6_scored_extract")
    )
    assert bundle.keys() == extract.keys() and len(bundle) > 0
    assert all(bundle[k] == pytest.approx(extract[k], abs=1e-9) for k in bundle)


@pytest.mark.parametrize("name", ["q9_insured_extract", "out3_detail_extract", "ag7_several_count_distincts", "ps1_policy_flags"])
def test_generated_code_gives_the_same_rows(spark, name):
    """The rest of the suite interprets plans; these run as production does."""
    interpreted = catalog.QUERIES[name](spark, SMALL)
    expected = bag(interpreted.columns, interpreted.collect())
    before = {k: spark.conf.get(k) for k in ("spark.sql.codegen.wholeStage", "spark.sql.codegen.factoryMode")}
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    spark.conf.set("spark.sql.codegen.factoryMode", "FALLBACK")
    try:
        compiled = catalog.QUERIES[name](spark, SMALL)
        assert bag(compiled.columns, compiled.collect()) == expected
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
