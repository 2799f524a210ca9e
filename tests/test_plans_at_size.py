"""Plans of queries whose landed bodies are far larger than the files they come from."""

import io
from contextlib import redirect_stdout

import pytest

import __spark_entry__ as entry


def plan(spark, name):
    out = io.StringIO()
    with redirect_stdout(out):
        entry.queries()[name](spark, "/root/testdata/sf0.001").explain()
    return out.getvalue()


@pytest.mark.parametrize("name", ["xbox_prices", "xbox_calendar_entries"])
def test_opened_products_are_not_broadcast(spark, name):
    text = plan(spark, name)
    assert "SortMergeJoin" in text and "BroadcastExchange" not in text


@pytest.mark.parametrize("name", ["xbox_prices", "psn_prices", "psn_search_tiles", "psn_calendar_entries", "psn_preorder_pages", "us_page_meta"])
def test_bodies_are_made_by_all_tasks(spark, name):
    assert "REPARTITION_BY_NUM" in plan(spark, name)
