"""Every registered query of the model against its SQL in DuckDB."""

import math

import duckdb
import numpy as np
import pytest

from folio.plans import queries
from folio.sources import stored

QUERIES, ORACLES = queries.QUERIES | stored.QUERIES, queries.ORACLES | stored.ORACLES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, (list, tuple, np.ndarray)):
        return tuple(plain(y) for y in x)
    return float(f"{x:.9g}") if isinstance(x, (float, np.floating)) else x


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    res = con.execute(ORACLES[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    want = sorted((tuple(plain(row[names.index(c)]) for c in cols) for row in res.fetchall()), key=repr)
    assert got == want
