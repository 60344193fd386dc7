"""Every registered query equals its DuckDB oracle (sf0.001 tables)."""

import pytest

import __spark_entry__ as E
from sluice.plans.catalog import QUERIES
from sluice.plans.oracle import oracle_queries
from tools.oracle_check import SAME_TYPE, canon, duck

ORACLE = oracle_queries()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, sf_small, name):
    sdf = QUERIES[name](spark, sf_small)
    scols, srows = canon(sdf.columns, [tuple(r) for r in sdf.collect()])
    res = con.execute(ORACLE[name])
    dcols, drows = canon([d[0] for d in res.description], res.fetchall())
    assert scols == dcols
    assert len(srows) == len(drows)
    assert srows == drows
    rel = con.sql(ORACLE[name])
    duck_types = dict(zip(rel.columns, (str(t) for t in rel.types)))
    assert {c: SAME_TYPE.get(t) for c, t in sdf.dtypes} == duck_types


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 20
