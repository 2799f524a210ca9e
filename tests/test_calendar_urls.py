"""Calendar versions that differ in the order of their urls only."""

from pricelens.operators import calendar as C


def test_equal_urls_in_another_order_are_no_change(spark):
    table = lambda urls: spark.sql(f"SELECT 't' AS title, '2001-01-02' AS date, '2001-01' AS month, array('pc', 'switch') AS platforms, map({urls}) AS urls, 'i' AS image, 's' AS slug_if_tracked")
    before = table("'pc', 'a', 'switch', 'b'")
    assert C.calendar_changes(before, table("'switch', 'b', 'pc', 'a'")).count() == 0
    moved = C.calendar_changes(before, table("'switch', 'b', 'pc', 'c'"))
    assert sorted(r.change for r in moved.select("change").collect()) == ["added", "removed"]
