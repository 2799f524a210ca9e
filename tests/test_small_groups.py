"""Numbering of mostly small groups, and tags searched once per attribute."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pricelens.functions import ordering as O
from pricelens.sources import landing as L
from test_plans_at_size import plan


def test_groups_of_every_size_are_numbered(spark):
    rows = [(g, x) for g, n in ((None, 9), ("a", 1), ("b", 3), ("c", 4), ("d", 50)) for x in range(n)]
    df = spark.createDataFrame(rows[::-1], "g string, x int")
    for hot in (0, 3, 100):
        got = sorted(map(repr, (tuple(r) for r in O.small_group_row_number(df, ["g"], [O.down("x")], "rn", hot).select("g", "x", "rn").collect())))
        assert got == sorted(map(repr, (tuple(r) for r in O.group_row_number(df, ["g"], [O.down("x")], "rn").select("g", "x", "rn").collect())))


def test_cards_search_a_tag_once_per_attribute(spark):
    text = plan(spark, "xbox_calendar_cards")
    assert r"\s*(?:" not in text and "left_anti" in text.lower().replace("leftanti", "left_anti")


@pytest.mark.parametrize("tag, want", [
    ('<div a="x">', "x"), ("<div a='x \"y'>", 'x "y'), ('<div A = "l1\nl2" a="z">', "l1\nl2"), ('<div a="">', ""), ('<div b="x">', None), ('<div a="x>', ""), ('<div a="&lt;&amp;">', "<&")])
def test_attribute_values(spark, tag, want):
    got = spark.createDataFrame([(tag,)], "t string").select(L.attribute("t", "a").alias("a"), L.attribute_text("t", "a").alias("b")).first()
    assert (got.a, got.b) == (want, want or "")


def test_raw_text_is_left_out(spark):
    html = "a<!-- x\n<b> -->b<SCRIPT q='1'>1 < 2</script >c<style>d</STYLE>e<scripty>f"
    assert spark.range(1).select(L.without_raw_text(F.lit(html)).alias("h")).first().h == "abce<scripty>f"
