"""Every registered query against its SQL, on the small tables."""

import glob
import os

import duckdb
import pytest
from lodeframe.plans import catalog

from .conftest import SMALL


def plain(v):
    if isinstance(v, float):
        return None if v != v else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in glob.glob(f"{SMALL}/*.parquet"):
        c.execute(f"create view {os.path.basename(t)[:-8]} as select * from '{t}'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    rows = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
    if name not in catalog.ORACLE_SQL:
        return
    found = duck.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = [tuple(plain(dict(zip(names, r, strict=True))[c]) for c in columns) for r in found.fetchall()]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
