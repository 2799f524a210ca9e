"""Snapshot rules: counts in hash tables, the stored order in chunks."""

import io
from contextlib import redirect_stdout

import pytest

import __spark_entry__ as entry
from pricelens.operators import quality as Q


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.mark.parametrize("chunk", [1, 2, 3, 1024])
def test_stored_order_over_chunks(spark, monkeypatch, chunk):
    monkeypatch.setattr(Q, "CHUNK", chunk)
    names = ["A", "C", "B", "D", "D", "A", None, "B", "A"]
    rows = [(s, "steam", i + 1, cc) for s in "xy" for i, cc in enumerate(names)]
    df = spark.createDataFrame(rows, "slug string, channel string, pos int, cc string")
    assert sorted((r.slug, r.pos) for r in Q._unsorted(df).collect()) == [(s, p) for s in "xy" for p in (3, 6, 7, 9)]


def test_snapshot_facts_are_added_up_in_hash_tables(spark):
    assert "SortAggregate" not in plan(entry.queries()["check_snapshots"](spark, "/root/testdata/sf0.001"))
