"""Every registered query runs on the smallest data and equals its check SQL."""

import math

import duckdb
import pytest

from railloom.catalog import CHECKS, QUERIES

BASE = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in BASE.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return repr(v + 0.0) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = [tuple(norm(v) for v in r) for r in df.select(*cols).collect()]
    assert name in CHECKS
    res = duck.execute(CHECKS[name])
    have = [c[0] for c in res.description]
    assert sorted(have) == cols
    at = [have.index(c) for c in cols]
    want = [tuple(norm(r[i]) for i in at) for r in res.fetchall()]
    assert sorted(got, key=str) == sorted(want, key=str)
