"""Every registered query against its SQL, on the smallest tables."""

import math

import duckdb
import pytest
from conftest import DATA

from wordspan.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if hasattr(v, "item"):
        v = v.item()
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    return round(v, 9) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLE_SQL)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, DATA)
    found = duck.execute(registry.ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(got.columns)
    want = sorted(repr(tuple(map(norm, r))) for r in found.fetchall())
    assert sorted(repr(tuple(map(norm, r))) for r in got.select(*columns).collect()) == want
    assert want
