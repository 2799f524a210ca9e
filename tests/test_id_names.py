"""Bodies keyed by ids: the reader meets no new name per body, and gives the same entries."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pricelens.operators import candidates as C
from pricelens.sources import landing as L
from pricelens.sources import stores as ST

SOLD = '{"success":true,"data":{"price_overview":{"currency":"USD","initial":100,"final":90,"discount_percent":10}}}'
BODIES = [
    f'{{"570":{SOLD}}}', f' {{\n"570" :\t{SOLD} }} ', f'{{"570":{SOLD},"730":{{"success":false}}}}', f'{{"570":{SOLD},"570":null}}',
    f'{{"":{SOLD},"570":{SOLD}}}', f'{{"570":5,"":{SOLD}}}', f'{{"a":{SOLD}}}', f'{{"\\u0035":{SOLD}}}', f"{{'570':{SOLD}}}", f'{{"12345678901234567890":{SOLD}}}',
    f'{{"0570":{SOLD}}}', f'{{"57 0":{SOLD}}}', f'{{{" " * 80}"570":{SOLD}}}', f'[{{"570":{SOLD}}}]', f'{{"570":{SOLD}', f'{{"570"7:{SOLD}}}', f'\f{{"570":{SOLD}}}',
    f'{{"570":{SOLD}}}é', '{"570":"é"}', "{}", "", None,
]


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.mark.parametrize("name", ["steam_prices", "steam_package_prices", "steam_meta", "steam_calendar", "outside_lows", "paid_game_gate"])
def test_readers_leave_the_first_id_out(spark, name):
    assert L.FIRST_ID[-20:] in plan(entry.queries()[name](spark, "/root/testdata/sf0.001"))


def test_a_body_with_one_id_has_no_name_left(spark):
    df = spark.createDataFrame([(b,) for b in BODIES], "body string")
    own, body = L.first_id("body")
    got = [tuple(r) for r in df.select(own, body).collect()]
    assert got[0] == ("570", f'{{"":{SOLD}}}')
    assert got[1] == ("570", f'{{"":\t{SOLD} }} ')
    assert [b for (own, b), was in zip(got, BODIES) if own is None] == [was for (own, _), was in zip(got, BODIES) if own is None]


def test_entries_are_those_of_the_plain_reader(spark):
    df = spark.createDataFrame(list(enumerate(BODIES)), "i int, body string")
    plain = df.select("i", F.explode(F.from_json("body", ST.APP_PRICES)).alias("app", "e"))
    read = L.id_entries(df, ST.APP_PRICES, "app", "e", "i").select("i", "app", "e")
    assert sorted(map(repr, read.collect())) == sorted(map(repr, plain.collect()))


@pytest.mark.parametrize("app, body, want, some", [
    (570, '{"570":{"success":true},"570":{"success":false}}', True, True), (730, '{"570":{"success":true},"730":{"success":false}}', False, True),
    (730, '{"570":{"success":true}}', None, True), (570, "{}", None, False), (570, None, None, False), (None, '{"570":{"success":true}}', None, True)])
def test_details_are_found_by_their_id(spark, app, body, want, some):
    df = spark.createDataFrame([(app, body)], "app_id long, body string")
    r = C.compact_details(df).first()
    assert (r.entry and r.entry.success, r.has_entries) == (want, some)
