"""Totals with digits beyond cents and totals that are missing."""

import duckdb

import __spark_entry__ as entry

ROWS = """(1, 'O', 0.125), (2, 'F', NULL), (3, 'P', NULL), (4, 'O', 1234567.891), (5, NULL, 5.5), (6, 'F', 1e7 / 3), (7, 'O', 1e15 + 0.5), (8, 'P', 3.0),
  (9, 'O', 99.99), (10, 'F', 99999999.005)"""


def test_price_text_keeps_every_digit(spark, tmp_path):
    con = duckdb.connect()
    con.execute(f"CREATE TABLE orders AS SELECT o_orderkey, o_orderstatus, o_totalprice::DOUBLE AS o_totalprice FROM (VALUES {ROWS}) t(o_orderkey, o_orderstatus, o_totalprice)")
    con.execute(f"COPY orders TO '{tmp_path}/orders.parquet'")
    got = sorted(tuple(r) for r in entry.queries()["price_text"](spark, str(tmp_path)).collect())
    assert got == sorted(con.execute(entry.oracle_sql()["price_text"]).fetchall())
