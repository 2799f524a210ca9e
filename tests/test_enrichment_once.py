"""Search documents are judged once, with the same answers."""

import io
from contextlib import redirect_stdout

import pytest

import __spark_entry__ as entry
from pricelens.operators import matching as M


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_documents_of_a_target_are_judged_once(spark):
    text = plan(entry.queries()["resolve_enrichment"](spark, "/root/testdata/sf0.001"))
    # once for titles of ASCII letters and once for others
    assert 0 < text.count("^7001") <= 2


@pytest.mark.parametrize("hac, bee, want", [("HAC", None, None), ("HAC", "", "HAC"), ("", "BEE", "BEE"), ("HAC", "BEE", None), (None, "BEE", None), ("", "", None), (None, None, None)])
def test_generation_with_unknown_codes(spark, hac, bee, want):
    df = spark.createDataFrame([([hac, bee], None)], "codes array<string>, systems array<string>")
    assert df.select(M.generation("codes", "systems").alias("g")).first().g == want
