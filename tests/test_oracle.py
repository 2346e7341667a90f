"""Every registered query against its DuckDB oracle on the smallest fixture."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import duck, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
OWN = E._queries.QUERIES
SQL = {k: v for k, v in E.oracle_sql().items() if k in OWN}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(OWN) == set(SQL)


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    rel = con.sql(SQL[name])
    spark_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema}
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    got = sdf.toPandas()
    want = con.execute(SQL[name]).fetchdf()
    gc, gr = rows_of(got)
    wc, wr = rows_of(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[-1] == "rank"
