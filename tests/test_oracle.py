"""Every registered query that SQL can state against its DuckDB oracle on the smallest scale."""

import pytest

import __spark_entry__ as se
from conftest import SF_SMALL
from hopgraph.queries import REGISTRY

import importlib.util
import os

_spec = importlib.util.spec_from_file_location(
    "check_oracle", os.path.join(os.path.dirname(__file__), "..", "scripts", "check_oracle.py"))
check = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(check)

QUERIES = se.queries()
SQL = se.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return check.duck(SF_SMALL)


def test_every_library_query_has_an_oracle():
    assert set(REGISTRY) <= set(SQL) <= set(QUERIES)


FAMILY = {"string": "text", "VARCHAR": "text", "bigint": "int", "BIGINT": "int",
          "boolean": "bool", "BOOLEAN": "bool", "double": "float", "DOUBLE": "float",
          "timestamp_ntz": "ts", "TIMESTAMP": "ts"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    ours = check.digest(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(SQL[name])
    theirs = check.digest([d[0] for d in res.description], res.fetchall())
    assert ours == theirs
    rel = duck.sql(SQL[name])
    spark_types = {f.name: FAMILY.get(f.dataType.simpleString()) for f in df.schema.fields}
    duck_types = {c: FAMILY.get(str(t)) for c, t in zip(rel.columns, rel.types)}
    assert spark_types == duck_types
