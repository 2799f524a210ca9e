"""The audit of a target names every failed test of its documents."""

import io
from contextlib import redirect_stdout

import __spark_entry__ as entry
from pricelens.operators import matching as M

DDL = ("slug string, title string, nsuids array<string>, codes array<string>, systems array<string>, type string, removed boolean, "
       "release string, releases array<string>, price_lowest double, price_regular double")
AS_OF = "2001-06-01T00:00:00Z"


def doc(slug, title="Doom", nsuid="70010000000001", **other):
    row = {"nsuids": [nsuid], "codes": ["HAC-A"], "systems": ["Nintendo Switch"], "type": "game", "removed": False, "release": "2000-01-01T00:00:00Z",
           "releases": None, "price_lowest": 5.0, "price_regular": 9.0} | other
    return (slug, title, *[row[k] for k in ("nsuids", "codes", "systems", "type", "removed", "release", "releases", "price_lowest", "price_regular")])


def test_every_failed_test_is_counted(spark):
    late = "2002-01-01T00:00:00Z"
    docs = spark.createDataFrame([
        doc("a"), doc("a"), doc("a", "Quake"), doc("a", "Quake", type="DLC"), doc("a", type="DLC"), doc("a", type="DLC", removed=True), doc("a", nsuids=[]), doc("a", removed=True),
        doc("a", release=late), doc("a", price_lowest=0.0), doc("a", codes=["BEE-P"]),
        doc("b", release="TBA", releases=[None, "soon", "2000-05-05T00:00:00Z", late]), doc("c", release="TBA", releases=[late, "2000-05-05T00:00:00Z"]),
    ], DDL)
    targets = spark.createDataFrame([(s, "Doom") for s in "abcd"], "slug string, title string")
    owners = spark.createDataFrame([], "nsuid string, owner string")
    got = {r.slug: r for r in M.resolve_enrichment(docs, targets, owners, AS_OF).collect()}
    assert got["a"].rejected == {
        "title_mismatch": 2, "not_game": 2, "base_nsuid_missing_or_ambiguous": 1, "eshop_removed": 1, "not_released": 1,
        "paid_digital_evidence_missing": 1, "generation_missing_or_conflicting": 1}
    assert (got["a"].status, got["a"].n_docs, got["a"].n_exact) == ("matched", 11, 9)
    # the first further date that can be read decides
    assert (got["b"].status, got["b"].rejected) == ("matched", {})
    assert (got["c"].status, got["c"].rejected) == ("rejected", {"not_released": 1})
    assert (got["d"].reason, got["d"].n_docs, got["d"].rejected) == ("no_exact_title_match", 0, {})
    counts = {(r.slug, r.reason): r.n for r in M.enrichment_rejects(docs, targets, AS_OF).collect()}
    assert counts == {(s, why): n for s, r in got.items() for why, n in r.rejected.items()}


def test_the_query_counts_by_reason(spark):
    out = io.StringIO()
    with redirect_stdout(out):
        entry.queries()["resolve_enrichment"](spark, "/root/testdata/sf0.001").explain()
    assert "eshop_removed" in out.getvalue() and "title_mismatch" in out.getvalue()
