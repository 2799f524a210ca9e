"""Pages are opened once, and what is known of products never goes through the driver."""

import io
from contextlib import redirect_stdout

import pytest

import __spark_entry__ as entry
from pricelens.sources import stores as ST


def plan(spark, name):
    out = io.StringIO()
    with redirect_stdout(out):
        entry.queries()[name](spark, "/root/testdata/sf0.001").explain()
    return out.getvalue()


def test_psn_prices_joins_by_a_merge_and_opens_pages_once(spark):
    text = plan(spark, "psn_prices")
    assert "SortMergeJoin" in text and "BroadcastExchange" not in text
    assert text.count("REPARTITION_BY_NUM") == 1


def test_psn_calendar_entries_joins_by_a_merge(spark):
    text = plan(spark, "psn_calendar_entries")
    assert "SortMergeJoin" in text and "BroadcastExchange" not in text


@pytest.mark.parametrize("names", [["Doom™ 3 PS4 & PS5", "DOOM 3"], ["Ｄｏｏｍ", "doom ps5"], ["!?"], ["Ｐokémon PS4", "ΟΔΟΣ"]])
def test_keys_of_a_list_are_the_keys_of_its_names(spark, names):
    df = spark.createDataFrame([(names,)], "names array<string>")
    one = [spark.createDataFrame([(n,)], "n string").select(ST.psn_title_key("n").alias("k")).first().k for n in names]
    assert df.select(ST._psn_keys("names").alias("k")).first().k == one
