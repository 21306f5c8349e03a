"""Runs a query in Spark and its SQL in DuckDB and compares them as bags of rows."""

import decimal
import glob
import math
import os

import duckdb

SF = "/root/testdata/sf0.001"


def connect(sf: str = SF):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 6)
    if isinstance(x, decimal.Decimal):
        return "D" + str(x.normalize())
    if isinstance(x, (list, tuple)):
        return tuple(plain(y) for y in x)
    return x


def assert_same(spark, con, df, sql):
    columns = sorted(df.columns)
    mine = sorted(repr([plain(x) for x in r]) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    theirs = sorted(repr([plain(r[i]) for i in at]) for r in result.fetchall())
    assert mine == theirs
