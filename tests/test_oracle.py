"""Registered queries against DuckDB on the smallest tables.

All of them take over ten minutes; a plain run takes every eighth and the
flagship, ``PRICELENS_ORACLE=all`` takes all.
"""

import datetime
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def chosen():
    names = sorted(entry.oracle_sql())  # the others are tested against brute force
    if os.environ.get("PRICELENS_ORACLE") == "all":
        return names
    return sorted({*names[::8], "regional_model"})


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v if isinstance(v, str) else repr(v)


@pytest.mark.parametrize("name", chosen())
def test_query_equals_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(cell(r[c]) for c in cols) for r in df.collect())
    res = duck.execute(entry.oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in res.description}
    names = list(types)
    assert sorted(names) == cols
    want = sorted(tuple(cell(r[names.index(c)]) for c in cols) for r in res.fetchall())
    assert got == want
    for f in df.schema.fields:
        assert types[f.name] == TYPES[f.dataType.simpleString()], f.name


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
