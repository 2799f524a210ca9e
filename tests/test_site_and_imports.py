"""Rules of imports, evidence and the published site on literal rows."""

import hashlib

from pyspark.sql import functions as F

from pricelens.operators import calendar as C
from pricelens.operators import catalog as M
from pricelens.operators import evidence as E
from pricelens.operators import imports as I
from pricelens.operators import matching as MA
from pricelens.operators import quality as Q
from pricelens.operators import site as S

ITEM = ("key string, slug string, title string, catalog_action string, steam_app_id long, nsuid_americas string, nsuid_europe string, nsuid_japan string, "
        "nintendo_us_slug string, psn_product_id string, psn_concept_id string, psn_edition string, xbox_big_id string, xbox_edition string, platforms array<string>")


def item(**given):
    base = dict.fromkeys([f.split()[0] for f in ITEM.split(", ")])
    return tuple((base | {"key": "k", "slug": "s", "title": "T", "catalog_action": "new_game", "platforms": ["pc"]} | given).values())


def hits(df):
    return sorted((r.rule, r.key) for r in df.collect())


def test_declared_regions(spark):
    items = spark.createDataFrame([item(steam_app_id=1, nsuid_europe="7", nsuid_japan="8", xbox_big_id="9")], ITEM)
    plan = {r.channel: r for r in I.declared(items).collect()}
    assert set(plan) == {"steam", "eshop", "xbox"}
    assert len(plan["steam"].expected) == 18 and plan["steam"].minimum == 10 and plan["steam"].us_price
    assert len(plan["eshop"].expected) == 10 and plan["eshop"].minimum == 8 and not plan["eshop"].us_price and not plan["eshop"].us_event
    assert plan["xbox"].expected == ["US"] and plan["xbox"].minimum == 1


def test_reconciled_import(spark):
    good = item(key="a", slug="a", title="Game™ A", steam_app_id=5, xbox_big_id="X", xbox_edition="standard")
    items = spark.createDataFrame([good, item(key="b", slug="b", nsuid_americas="1", platforms=["switch"]), item(key="c", slug="gone"),
                                   item(key="d", slug="d", psn_product_id="P", catalog_action="add_platform_mapping"), item(key="d", slug="d2")], ITEM)
    catalog = spark.createDataFrame([
        item(slug="a", title="game a", steam_app_id=5, xbox_big_id="X", xbox_edition="standard"), item(slug="b", title="", nsuid_americas="1", platforms=["switch-2"]),
        item(slug="d", psn_product_id="P", psn_concept_id="1"), item(slug="d2", steam_app_id=9)], ITEM)
    regions = [c.lower() if i % 2 else c for i, c in enumerate(I.STEAM_REGIONS)]
    rows = [("a", "steam", c, "USD" if c.upper() == "US" else "EUR", 1.0) for c in regions] + [("a", "xbox", "US", "USD", 1.0)]
    rows += [("b", "eshop", c, "EUR", 1.0) for c in ("US", "CA", "CA")] + [("d", "psn", "GB", "GBP", 1.0)]
    events = [("a", "steam", "US", 1.0), ("a", "xbox", "US", 1.0), ("b", "eshop", "GB", 1.0), ("d", "psn", "US", 0.0)]
    meta = [("a", "Game A for Nintendo Switch", "https://x/y"), ("b", "Other", None), ("d", "", "http://x"), ("d2", "T", "https://x")]
    out = I.reconcile_import(items, catalog, spark.createDataFrame(rows, "slug string, channel string, cc string, currency string, amount double"),
                             spark.createDataFrame(events, "slug string, channel string, cc string, usd double"), spark.createDataFrame(meta, "slug string, name string, header_image string"))
    assert hits(out) == sorted([
        ("import_title_drift", "b"), ("import_generation_drift", "b"), ("import_not_in_catalog", "c"), ("import_psn_drift", "d"), ("import_declared_twice", "d"),
        ("import_coverage_low", "b/eshop"), ("import_region_repeat", "b/eshop"), ("import_us_price_missing", "b/eshop"), ("import_us_event_missing", "b/eshop"),
        ("import_coverage_low", "d/psn"), ("import_us_price_missing", "d/psn"), ("import_us_event_missing", "d/psn"),
        ("import_meta_title", "b"), ("import_meta_image", "b"), ("import_meta_missing", "c"), ("import_meta_name", "d"), ("import_meta_image", "d")])
    detail = I.region_overlap(I.declared(items.where("key = 'b'")), spark.createDataFrame(rows + [("b", "eshop", "FR", "EUR", 1.0)], "slug string, channel string, cc string, currency string, amount double")).first()
    assert sorted(detail.covered) == ["CA", "US"] and sorted(detail.missing) == ["AR", "BR", "CO", "MX"] and detail.extra == ["FR"]


def block(kind, observed="2001-05-20T00:00:00Z", expires=None, body="b", digest=None):
    return (kind, observed, expires, digest or "sha256:" + hashlib.sha256(body.encode()).hexdigest(), body, None, None)


def first_reasons(spark, *candidates):
    df = spark.createDataFrame([(f"c{i}", list(blocks)) for i, blocks in enumerate(candidates)], f"candidate_id string, evidence {E.EVIDENCE}")
    return {r.candidate_id: (r.n_blocks, r.n_faults, r.evidence_reason) for r in E.aged_evidence(df, "2001-06-01T00:00:00Z").collect()}


def test_a_stale_popularity_block_with_fresh_regions_fails_by_name(spark):
    got = first_reasons(
        spark, [block("europe"), block("popularity"), block("japan"), block("popularity", "2001-04-30T00:00:00Z")],
        [block("steam_match", "soon"), block("europe", "2001-06-01T00:00:01Z")], [block("japan", "2001-05-02T00:00:00Z")], [block("japan", "2001-05-01T23:59:59Z")],
        [block("product", "2001-05-31T00:00:00Z", "2001-06-07T00:00:00Z")], [block("product", "2001-05-31T00:00:00Z", "2001-06-07T00:00:01Z")],
        [block("product", "2001-05-30T00:00:00Z", "2001-06-01T00:00:00Z")], [block("product", "2001-05-30T00:00:00Z")],
        [block("rumour")], [block("europe", digest="sha256:" + "0" * 64)], [block("europe", digest="x")])
    assert got == {
        "c0": (4, 1, "popularity_2_expired"), "c1": (2, 2, "europe_in_future"), "c2": (1, 0, None), "c3": (1, 1, "japan_expired"), "c4": (1, 0, None),
        "c5": (1, 1, "product_term_invalid"), "c6": (1, 1, "product_expired"), "c7": (1, 1, "product_time_invalid"), "c8": (1, 1, "rumour_unknown"),
        "c9": (1, 1, "europe_digest_mismatch"), "c10": (1, 1, "europe_bad_digest")}


def test_owners_of_ids(spark):
    ids = "slug string, steam_app_id long, nsuid_americas string, nsuid_europe string, nsuid_japan string, psn_product_id string, psn_concept_id string, xbox_big_id string"
    catalog = spark.createDataFrame([("a", 1, "n1", None, None, None, "7", None), ("b", 2, None, "n2", None, "p", None, "x")], ids)
    asked = spark.createDataFrame([("k1", "a", 1, "n2", None, None, None, None, None), ("k2", "z", None, None, None, "n1", None, "7", "x")], "candidate_id string, " + ids)
    got = {r.candidate_id: r.asDict() for r in E.id_owners(asked, catalog).collect()}
    assert got["k1"]["any_steam"] == "a" and got["k1"]["other_steam"] is None and got["k1"]["other_nsuid"] == "b"
    assert got["k2"]["any_nsuid"] == "a" and got["k2"]["any_concept"] == "a" and got["k2"]["any_xbox"] == "b" and got["k2"]["any_psn"] is None


def test_aliases_are_followed(spark):
    o = "https://o"
    built = spark.createDataFrame([(f"{o}/a/", f"{o}/a/"), (f"{o}/new/", f"{o}/a/"), (f"{o}/self/", f"{o}/self/"), (f"{o}/lost/", f"{o}/none/"), (f"{o}/b/", None), (f"{o}/chain/", f"{o}/new/")], "url string, canonical string")
    aliases = spark.createDataFrame([(f"{o}/{x}/",) for x in ("new", "self", "lost", "chain")], "url string")
    listed = spark.createDataFrame([(f"{o}/a/",), (f"{o}/a/",), (f"{o}/self/",), (f"{o}/c/?x",), ("http://p/a/",)], "url string")
    assert hits(S.alias_faults(built, listed, aliases, o)) == sorted([
        ("alias_listed", f"{o}/self/"), ("alias_own_canonical", f"{o}/self/"), ("alias_target_missing", f"{o}/lost/"), ("alias_target_missing", f"{o}/chain/"),
        ("page_not_listed", f"{o}/b/"), ("canonical_differs", f"{o}/b/"), ("listed_twice", f"{o}/a/"), ("listed_without_page", f"{o}/c/?x"),
        ("listed_with_query", f"{o}/c/?x"), ("listed_without_page", "http://p/a/"), ("listed_elsewhere", "http://p/a/")])
    assert {r.url: r.target for r in S.resolved_pages(built, aliases).where("is_alias").collect()}[f"{o}/new/"] == f"{o}/a/"


def test_product_links(spark):
    x = S.PRODUCT_URL["xbox"] + "9NBLGGH00001"
    row = lambda *hrefs: '<tr class="r" data-store-channel="xbox"><td>' + "".join(f"<a rel='n' href=\"{h}\">buy</a>" for h in hrefs) + "</td></tr>"
    pages = spark.createDataFrame([(f"https://o/game/{s}/", html) for s, html in (
        ("one", f'<a href="{x}">outside</a>' + row(x)), ("none", row()), ("two", row(x) + row(x)), ("twice", row(x, x)), ("other", row(x, S.PRODUCT_URL["xbox"] + "9NBLGGH00002", "https://o/x")))], "url string, html string")
    catalog = spark.createDataFrame([(s, "9NBLGGH00001", None) for s in ("one", "none", "two", "twice", "other", "gone")], "slug string, xbox_big_id string, psn_product_id string")
    assert hits(S.product_link_faults(pages, catalog, "https://o", {"xbox": "xbox_big_id", "psn": "psn_product_id"})) == sorted([
        ("product_page_missing", "gone/xbox"), ("product_link_count", "none/xbox"), ("product_row_count", "two/xbox"), ("product_link_count", "twice/xbox"),
        ("product_link_foreign", "https://o/game/other/"), ("product_link_malformed", "https://o/game/other/")])


def test_lines_of_a_game_share_one_span(spark):
    events = spark.createDataFrame([("g", "steam", "US", "2026-07-03", 3.0), ("g", "steam", "US", "2026-07-01", 5.0), ("g", "xbox", "US", "2026-07-05", 4.0), ("g", "eshop", "GB", "2026-06-01", 4.0), ("h", "psn", "US", "2026-07-05", -1.0)],
                                   "slug string, channel string, cc string, d string, usd double").withColumn("d", F.to_date("d"))
    tracked = spark.createDataFrame([("g", c, "2026-07-09" if c == "xbox" else "2026-07-02") for c in ("steam", "xbox", "eshop", "psn")] + [("h", "psn", None)], "slug string, channel string, end_date string").withColumn("end_date", F.to_date("end_date"))
    got = {(r.slug, r.channel): r for r in S.aligned_series(events, tracked).collect()}
    assert {k: r.state for k, r in got.items()} == {("g", "steam"): "changes", ("g", "xbox"): "confirmed-flat", ("g", "eshop"): "empty", ("g", "psn"): "empty", ("h", "psn"): "empty"}
    assert {(str(r.span_from), str(r.span_to)) for k, r in got.items() if k[0] == "g"} == {("2026-07-01", "2026-07-09")} and got["h", "psn"].span_from is None
    assert str(got["g", "steam"].end_date) == "2026-07-03" and got["g", "steam"].last_usd == 3.0


def test_paged_category_and_batch(spark):
    good = lambda i: f"UP0001-PPSA{i:08d}-GAME{i:012d}"
    products = [("a", 1 + i // 2, good(i)) for i in range(5)] + [("b", 1, good(9)), ("b", 1, good(9)), ("b", 2, "bad")]
    pages = [("a", 1, 3, 5, 2), ("a", 2, 3, 5, 2), ("a", 3, 3, 5, 1), ("b", 1, 2, 4, 2), ("b", 2, 2, 3, 1)]
    wanted = [("a", good(0)), ("a", good(9)), ("b", good(9)), ("b", good(9))]
    out = S.category_pages(spark.createDataFrame(pages, "category string, page int, page_count int, total int, raw_count int"), spark.createDataFrame(products, "category string, page int, product_id string"),
                           spark.createDataFrame(wanted, "category string, product_id string"), 2)
    assert hits(out) == sorted([("category_pages_incomplete", "b"), ("category_id_malformed", "bad"), ("category_id_repeat", good(9)), ("candidate_not_listed", good(9)), ("candidate_repeat", good(9))])
    pair = "batch int, product_id string"
    got = S.product_batch(spark.createDataFrame([(1, "9NBLGGH00001"), (1, "9NBLGGH00002")], pair), spark.createDataFrame([(1, "9nblggh00001"), (1, "9NBLGGH00001"), (1, None)], pair))
    assert hits(got) == sorted([("batch_id_repeat", "1/9NBLGGH00001"), ("batch_id_missing", "1/9NBLGGH00002"), ("batch_id_malformed", "1/"), ("batch_id_unasked", "1/")])


def test_day_one_fallback_that_is_taken(spark):
    catalog = spark.createDataFrame([("foo", 1), ("foo-7", 2)], "slug string, steam_app_id long")
    cands = spark.createDataFrame([("foo", 7, "A"), ("foo", 8, "B"), ("bar", 9, "C"), ("bar-10", 11, "E"), ("bar", 10, "D"), ("zzz", 1, "known")], "slug_hint string, steam_app_id long, title string")
    done, lost = M.day_one(catalog, cands, "2026-07-01")
    assert sorted(r.slug for r in done.collect()) == ["bar", "bar-10", "foo-8"]
    assert sorted((r.steam_app_id, r.reason) for r in lost.collect()) == [(7, "slug_collision"), (10, "slug_collision")]


def test_snapshot_rules_from_counts(spark):
    rows = [("a", "steam", 1, "US", "USD"), ("a", "steam", 2, "DE", "EUR"), ("a", "steam", 3, "FR", "EUR"), ("a", "steam", 4, "DE", "XXX"), ("b", "steam", 1, "DE", "EUR"), ("c", "xbox", 1, "US", "USD"), ("c", "xbox", 2, "US", "USD"), ("d", "psn", 1, None, None)]
    df = spark.createDataFrame([(*r, 5.0, None, None, None) for r in rows], "slug string, channel string, pos int, cc string, currency string, amount double, list_amount double, discount_pct int, sale_ends_at string")
    out = Q.check_snapshots(df, spark.createDataFrame([("a",), ("b",), ("d",)], "slug string"), spark.createDataFrame([("EUR", 0.9)], "currency string, rate double"))
    assert hits(out) == sorted([
        ("duplicate_region", "a/steam/DE"), ("regions_unsorted", "a/steam"), ("regions_unsorted", "a/steam"), ("no_rate", "XXX"), ("steam_needs_us", "b/steam"),
        ("single_needs_one_us", "c/xbox"), ("duplicate_region", "c/xbox/US"), ("slug_not_in_catalog", "c/xbox"), ("single_needs_one_us", "d/psn")])


def test_versions_of_a_calendar_differ_as_multisets(spark):
    ddl = "title string, date string, month string, platforms array<string>, urls map<string,string>, image string, slug_if_tracked string"
    row = lambda t: (t, None, "2026-07", ["pc"], {"pc": "u"}, None, None)
    out = C.calendar_changes(spark.createDataFrame([row("a"), row("a"), row("b")], ddl), spark.createDataFrame([row("a"), row("c"), row("c")], ddl))
    assert sorted((r.title, r.change) for r in out.collect()) == [("a", "removed"), ("b", "removed"), ("c", "added"), ("c", "added")]


def test_search_reads_the_longest_list_to_its_head_only(spark):
    import random
    import re

    rng = random.Random(6)
    words = ["the", "of", "star", "stars", "moon", "mooon", "sea", "seas"]
    titles = sorted({" ".join(["the", *rng.sample(words[1:], rng.randint(0, 3)), rng.choice("abcdefgh") * rng.randint(1, 3)]) for _ in range(300)})
    catalog = spark.createDataFrame([(t, f"g{i}") for i, t in enumerate(titles)], "title string, slug string")
    queries = ["the", "the star", "of the sea", "moon", "mon", "the of", "stars moon sea the", "zzz"]
    got = {}
    for r in MA.fuzzy_title_search(spark.createDataFrame([(q,) for q in queries], "query string"), catalog, 4).collect():
        got.setdefault(r.query, []).append((r.place, r.title, r.score))
    split = lambda x: {w for w in re.split(r"[^a-z0-9]+", x.lower()) if w}

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
        return row[-1]

    def quality(q, t):
        k = int(len(q) * 0.2 + 0.5)
        return 3 if q == t else 2 if t.startswith(q) else 1 if k and edits(q, t) <= k else 0

    for query in queries:
        scored = [(-sum(max(quality(q, t) for t in split(title)) for q in split(query)), title) for title in titles]
        want = sorted(x for x in scored if x[0] < 0)[:4]
        assert [(t, -s) for s, t in want] == [(t, s) for _, t, s in sorted(got.get(query, []))]
