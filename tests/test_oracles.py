"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import pytest

import __spark_entry__ as E
from conftest import SMALL

from ingot.registry import ORACLES, QUERIES  # the optional operators have tests of their own


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 4)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.sql(ORACLES[name])
    want = res.fetchall()
    assert sorted(df.columns) == sorted(res.columns)
    assert len(got) == len(want)
    assert _rows(df.columns, got) == _rows(res.columns, want)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert "total_kills" in df.columns
    assert df.count() > 0
