"""Both kinds of calendar changes are counted, also when there are none."""

from pricelens.operators import calendar as C

DDL = "title string, date string, month string, platforms array<string>, urls map<string,string>, image string, slug_if_tracked string"


def test_a_kind_without_rows_counts_zero(spark):
    row = lambda title: (title, "2001-01-01", "2001-01", ["pc"], {"pc": "u"}, None, None)
    table = lambda *titles: spark.createDataFrame([row(t) for t in titles], DDL)
    counts = lambda before, after: sorted(tuple(r) for r in C.change_counts(C.calendar_changes(before, after)).collect())
    assert counts(table("a"), table("a", "b", "b")) == [("added", 2), ("removed", 0)]
    assert counts(table("a", "b"), table("a")) == [("added", 0), ("removed", 1)]
    assert counts(table(), table()) == [("added", 0), ("removed", 0)]
