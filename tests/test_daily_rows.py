"""Prices by year come from a row for every day."""

import io
from contextlib import redirect_stdout

import __spark_entry__ as entry


def test_daily_prices_makes_every_day(spark):
    out = io.StringIO()
    with redirect_stdout(out):
        entry.queries()["daily_prices"](spark, "/root/testdata/sf0.001").explain()
    text = out.getvalue()
    assert "explode(sequence(valid_from" in text and "date_diff" not in text and "datediff" not in text
    # the days are counted where they are made
    assert "Exchange" not in text[:text.index("explode(")]
