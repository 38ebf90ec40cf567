"""Every query with SQL gives DuckDB's rows; every other one runs."""

import datetime
import glob
import math
import os

import duckdb
import pytest

from sparkloom.plans import catalogue

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rows = sorted((tuple(map(plain, r)) for r in df.select(*cols).collect()), key=str)
    if name in catalogue.ORACLE:
        cur = duck.execute(catalogue.ORACLE[name])
        names = [x[0] for x in cur.description]
        assert sorted(names) == cols
        want = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in cur.fetchall()), key=str)
        assert rows == want
