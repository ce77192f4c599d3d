"""Every registered query against its DuckDB statement on the smallest tables."""

import importlib.util
import os

import pytest
from pyspark.sql.types import ArrayType

import __spark_entry__ as E
from conftest import SF_SMALL
from tessera.plans import ORACLE_SQL, QUERIES

_spec = importlib.util.spec_from_file_location(
    "oracle_check", os.path.join(os.path.dirname(os.path.dirname(__file__)), "scripts", "oracle_check.py"))
oc = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(oc)

_TYPES = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "DoubleType()": "DOUBLE",
          "StringType()": "VARCHAR", "BooleanType()": "BOOLEAN", "DateType()": "DATE"}


def _duck_type(t):
    if isinstance(t, ArrayType):
        return f"{_duck_type(t.elementType)}[]"
    return _TYPES.get(repr(t), repr(t))


ROWS_ONLY = {"pca_diagnostics", "pca_variance", "knn_lsh_recall", "pca_cross_validation"}


@pytest.fixture(scope="module")
def duck():
    return oc.duck(SF_SMALL)


def test_registry_shape():
    q, s = QUERIES, ORACLE_SQL
    assert set(q) <= set(E.queries()) and set(s) <= set(E.oracle_sql())
    assert set(s) <= set(q)
    assert set(q) - set(s) == ROWS_ONLY


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["l_partkey", "n", "best_cents", "orders", "feasible"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, duck, name):
    """Rows, column names, column types and exact values."""
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    rel = duck.sql(E.oracle_sql()[name])
    assert {f.name: _duck_type(f.dataType) for f in df.schema.fields} == \
        {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert len(srows) == len(drows)
    assert oc.digest(df.columns, srows, exact=True)[0] == oc.digest(dcols, drows, exact=True)[0]


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF_SMALL).count() > 0
