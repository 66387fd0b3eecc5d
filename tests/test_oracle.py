"""Every registered query equals its DuckDB oracle on the sf0.01 tables
(columns by name, row count, order-insensitive values)."""
import datetime as dt
import decimal
import math
from collections import Counter

import pytest

from fieldlens.registry import QUERIES


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (bool, int, str)):
        return v
    return str(v)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql is not None])
def test_query_matches_oracle(spark, duck, sf_check, name):
    fn, sql = QUERIES[name]
    df = fn(spark, sf_check)
    s_cols, s_bag = _bag(df.columns, [tuple(r) for r in df.collect()])
    res = duck.sql(sql)
    d_cols, d_bag = _bag(res.columns, res.fetchall())
    assert s_cols == d_cols
    assert sum(s_bag.values()) == sum(d_bag.values())
    assert s_bag == d_bag


def test_every_query_has_an_oracle():
    assert all(sql is not None for _, sql in QUERIES.values())


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
