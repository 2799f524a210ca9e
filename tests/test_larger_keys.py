"""Queries on part keys that the given tables do not have."""

import duckdb
import pytest

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def parts(tmp_path_factory):
    """Folder with a part table whose keys pass 600,000 and 1,000,000."""
    folder = tmp_path_factory.mktemp("parts")
    duckdb.sql(f"""COPY (SELECT p_partkey + i AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice
        FROM '/root/testdata/sf0.001/part.parquet', (VALUES (0), (600000), (1000000)) t(i)) TO '{folder}/part.parquet'""")
    return str(folder)


def same_as_sql(spark, folder, name):
    df = entry.queries()[name](spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{folder}/part.parquet'")
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({entry.oracle_sql()[name]}) q").fetchall()
    assert want and sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, want))


@pytest.mark.parametrize("name", ["build_suggestion", "day_one_rejects"])
def test_ids_of_different_kinds_stay_apart_at_large_keys(spark, parts, name):
    same_as_sql(spark, parts, name)
