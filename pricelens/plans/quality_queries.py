"""Checked queries over the data-quality gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions.text import norm_title
from ..operators import calendar as CAL
from ..operators import quality as Q
from . import bindings as B
from .calendar_queries import merge_sql
from .change_queries import current, previous
from .history_queries import events, lows, seeds
from .registry import query, view


def told(df):
    return df.select("rule", "severity", "key")


def rule(name, key, frm, severity="error"):
    return f"SELECT '{name}' AS rule, '{severity}' AS severity, CAST({key} AS VARCHAR) AS key FROM {frm}"


def any_of(*parts):
    return " UNION ALL ".join(parts)


@query("check_rates", rule("rate_stale", "c_nationkey", "(SELECT c_nationkey, max(o_orderdate) AS m FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1) y WHERE NOT m > TIMESTAMP '2001-07-30'")
       + " UNION ALL SELECT 'rate_missing', 'error', 'EUR'")
def check_rates(spark, d):
    # one stamp per nation; no row is named EUR
    stamps = B.table(spark, d, "customer").join(B.table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey")).groupBy("c_nationkey").agg(F.max("o_orderdate").alias("updated_at"))
    return told(Q.check_rates(stamps.select(F.col("c_nationkey").cast("string").alias("currency"), F.lit(0.92).alias("rate"), "updated_at"), "2001-08-01T00:00:00Z"))


@query("check_currencies", "SELECT 'no_rate' AS rule, currency AS key, count(*) AS n FROM v_latest WHERE currency NOT IN (SELECT currency FROM v_rates) GROUP BY 2")
def check_currencies(spark, d):
    return Q.check_currencies(B.latest(spark, d), B.rates(spark)).select("rule", "key", F.col("detail").cast("bigint").alias("n"))


NS = "(nsuid_americas IS NOT NULL OR nsuid_europe IS NOT NULL OR nsuid_japan IS NOT NULL)"
view("v_catalog_faults", any_of(
    rule("bad_nsuid", "slug", "v_catalog WHERE nsuid_americas LIKE '7002%'"),
    rule("bad_xbox_id", "slug", "v_catalog WHERE xbox_big_id LIKE 'x%'"),
    rule("xbox_needs_standard", "slug", "v_catalog WHERE xbox_big_id IS NOT NULL AND xbox_edition IS NULL"),
    rule("psn_needs_standard", "slug", "v_catalog WHERE psn_product_id IS NOT NULL AND psn_edition IS NULL"),
    rule("console_only_needs_europe", "slug", "v_catalog WHERE steam_app_id IS NULL AND nsuid_europe IS NULL"),
    rule("americas_needs_us_slug", "slug", "v_catalog WHERE steam_app_id IS NULL AND nsuid_americas IS NOT NULL AND nintendo_us_slug IS NULL"),
    rule("bad_tier", "slug", "v_catalog WHERE tier NOT IN ('core','extended')"),
    rule("bad_added_at", "slug", "v_catalog WHERE try_cast(added_at AS DATE) IS NULL"),
    rule("bad_primary", "slug", "v_catalog WHERE primary_regional_channel NOT IN ('steam','eshop')"),
    rule("primary_needs_steam", "slug", "v_catalog WHERE primary_regional_channel = 'steam' AND steam_app_id IS NULL"),
    rule("primary_needs_nsuid", "slug", f"v_catalog WHERE primary_regional_channel = 'eshop' AND NOT {NS}"),
    rule("duplicate_id", "concat(id_kind, ':', id)", "(SELECT id_kind, id FROM v_ids GROUP BY 1, 2 HAVING count(*) > 1) z"),
    rule("core_tier_limit", "'core'", "(SELECT count(*) AS n FROM v_catalog WHERE tier = 'core') z WHERE n > 300"),
    rule("psn_limit", "'psn'", "(SELECT count(psn_product_id) AS n FROM v_catalog) z WHERE n > 20")))


@query("check_catalog", "SELECT * FROM v_catalog_faults")
def check_catalog(spark, d):
    return told(Q.check_catalog(B.catalog(spark, d)))


@query("gate", "SELECT count(*) AS errors, CAST(0 AS BIGINT) AS warnings, count(*) = 0 AS passed FROM v_catalog_faults")
def gate(spark, d):
    return Q.gate(Q.check_catalog(B.catalog(spark, d)))


@query("check_artifacts", any_of(
    rule("missing_steam", "slug", "v_catalog WHERE steam_app_id IS NOT NULL AND slug NOT IN (SELECT slug FROM v_latest WHERE channel = 'steam')"),
    rule("missing_history", "slug", "v_catalog WHERE slug NOT IN (SELECT slug FROM v_events)"),
    rule("missing_psn", "slug", "v_catalog WHERE psn_product_id IS NOT NULL AND slug NOT IN (SELECT slug FROM v_us WHERE channel = 'psn')")))
def check_artifacts(spark, d):
    latest = B.latest(spark, d)
    us = B.us_prices(spark, d)
    return told(Q.check_artifacts(B.catalog(spark, d), {
        "steam": (F.col("steam_app_id").isNotNull(), latest.where(F.col("channel") == "steam")),
        "history": (F.lit(True), events(spark, d)),
        "psn": (F.col("psn_product_id").isNotNull(), us.where(F.col("channel") == "psn")),
    }))


# Reviewed offers: one package per line item's part.
view("v_offers", """
SELECT p_partkey AS package_id, concat('p', CAST(p_partkey AS VARCHAR)) AS slug, p_size, p_type, p_size <= 25 AS edition, 100000 + p_partkey AS app FROM part
""")


def offers(spark, d):
    s, key = F.col("p_size"), F.col("p_partkey")
    app = F.lit(100000) + key
    return B.table(spark, d, "part").select(
        key.alias("package_id"), F.concat(F.when(s == 1, "zz").otherwise("p"), key.cast("string")).alias("slug"),
        F.when(s == 2, "xbox").otherwise("steam").alias("channel"), F.when(s == 3, " ").otherwise(F.col("p_name")).alias("name"),
        F.when(s <= 25, "edition").otherwise("add-on").alias("kind"), (s <= 24).alias("includes_base"), app.alias("base_app_id"),
        F.when(s <= 24, F.array(app, app + F.when(s == 5, 0).otherwise(900000))).otherwise(F.array(app + F.when(s == 40, 1).otherwise(900000))).alias("expected_app_ids"),
        F.when(s != 30, "store name").alias("expected_store_name"), F.lit("requires base").alias("required_page_text"),
        F.when(s == 31, "2001-13-01").otherwise("2001-01-01").alias("reviewed_at"), F.lit("seen").alias("note"))


@query("check_offers", any_of(
    rule("offer_unknown_slug", "package_id", "v_offers WHERE p_size = 1"), rule("offer_channel", "package_id", "v_offers WHERE p_size = 2"),
    rule("offer_package_id", "package_id", "v_offers WHERE NOT package_id > 0"), rule("offer_name", "package_id", "v_offers WHERE p_size = 3"), rule("offer_kind_base", "package_id", "v_offers WHERE p_size = 25"),
    rule("offer_add_on_guards", "package_id", "v_offers WHERE p_size = 30"),
    rule("offer_base_app", "package_id", "v_offers WHERE p_size IN (1, 50) OR p_type = 'SMALL'"),
    rule("offer_app_ids_repeat", "package_id", "v_offers WHERE p_size = 5"), rule("offer_reviewed_at", "package_id", "v_offers WHERE p_size = 31"),
    rule("offer_other_game", "o.package_id", """(SELECT package_id, CASE WHEN p_size = 1 THEN 'zz' ELSE slug END AS slug, unnest(CASE WHEN p_size <= 24 THEN [app, app + CASE WHEN p_size = 5 THEN 0 ELSE 900000 END]
      ELSE [app + CASE WHEN p_size = 40 THEN 1 ELSE 900000 END] END) AS a FROM v_offers) o
      JOIN (SELECT steam_app_id, min(slug) AS other FROM v_catalog WHERE steam_app_id IS NOT NULL GROUP BY 1) c ON o.a = c.steam_app_id WHERE c.other <> o.slug""")))
def check_offers(spark, d):
    return told(Q.check_offers(offers(spark, d), B.catalog(spark, d)))


@query("check_offer_snapshots", any_of(
    rule("offer_unapproved", "package_id", "v_offers WHERE p_size = 6"), rule("offer_name_differs", "package_id", "v_offers WHERE p_size = 7"),
    rule("offer_kind_differs", "package_id", "v_offers WHERE p_size = 8"), rule("offer_base_differs", "package_id", "v_offers WHERE p_size = 9"),
    rule("offer_missing", "package_id", "v_offers WHERE p_size = 6 AND concat(slug, 'x') = slug")))
def check_offer_snapshots(spark, d):
    reviewed = offers(spark, d)
    size = B.table(spark, d, "part").select(F.col("p_partkey").alias("package_id"), "p_size")
    s = F.col("p_size")
    stored = reviewed.join(size, "package_id").select(
        F.when(s == 6, F.concat("slug", F.lit("x"))).otherwise(F.col("slug")).alias("slug"), F.lit(0).alias("pos"), "package_id",
        F.when(s == 7, "old").otherwise(F.col("name")).alias("name"), F.when(s == 8, "bundle").otherwise(F.col("kind")).alias("kind"),
        (F.col("includes_base") != (s == 9)).alias("includes_base"))
    return told(Q.check_offer_snapshots(stored, reviewed))


PAIR = "concat(slug, '/', channel)"
KEY = "concat(slug, '/', channel, '/', cc)"


@query("check_snapshots", any_of(
    rule("single_bad_sale_end", KEY, "v_latest WHERE channel IN ('xbox','psn') AND sale_ends_at = 'soon'"),
    rule("steam_needs_us", PAIR, "(SELECT slug, channel FROM v_latest WHERE channel = 'steam' GROUP BY 1, 2 HAVING count(*) FILTER (WHERE cc = 'US') = 0) x"),
    rule("single_needs_one_us", PAIR, "(SELECT slug, channel FROM v_latest WHERE channel IN ('xbox','psn') GROUP BY 1, 2 HAVING count(*) <> 1 OR count(*) FILTER (WHERE cc = 'US') <> 1) x"),
    rule("regions_unsorted", PAIR, "(SELECT slug, channel, cc, lag(cc) OVER (PARTITION BY slug, channel ORDER BY d, cc) AS before FROM v_latest) x WHERE before > cc"),
    rule("no_rate", "currency", "(SELECT DISTINCT currency FROM v_latest WHERE currency = 'AED') x"),
    rule("slug_not_in_catalog", PAIR, "(SELECT DISTINCT slug, channel FROM v_latest WHERE slug NOT IN (SELECT slug FROM v_catalog WHERE tier <> 'other')) x")))
def check_snapshots(spark, d):
    from pyspark.sql import Window

    # the stored order of a document: by day; a store has few regions
    w = Window.partitionBy("slug", "channel").orderBy("d", "cc")
    rows = B.latest(spark, d).withColumn("pos", F.row_number().over(w))
    return told(Q.check_snapshots(rows, B.catalog(spark, d).where(F.col("tier") != "other"), B.rates(spark)))


@query("check_coverage", f"""
WITH p AS (SELECT slug, channel, count(*) AS n FROM v_prev GROUP BY 1, 2), c AS (SELECT slug, channel, count(*) AS n FROM v_cur GROUP BY 1, 2),
 m AS (SELECT c.slug, c.channel, c.n, CASE c.channel WHEN 'steam' THEN 10 WHEN 'eshop' THEN ceil((CASE WHEN nsuid_americas IS NOT NULL THEN 6 ELSE 0 END
    + CASE WHEN nsuid_europe IS NOT NULL THEN 9 ELSE 0 END + CASE WHEN nsuid_japan IS NOT NULL THEN 1 ELSE 0 END) * 0.8) ELSE 0 END AS minimum
   FROM c JOIN v_catalog g ON c.slug = g.slug WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.slug = c.slug AND p.channel = c.channel))
{rule("coverage_dropped", "concat(p.slug, '/', p.channel)", "p JOIN c ON p.slug = c.slug AND p.channel = c.channel WHERE c.n < p.n * 0.8::DOUBLE")}
UNION ALL {rule("first_coverage_low", PAIR, "m WHERE n < minimum")}
""")
def check_coverage(spark, d):
    return told(Q.check_coverage(previous(spark, d), current(spark, d), B.catalog(spark, d)))


@query("check_channel_ratio", rule("channel_price_ratio", "slug", """(SELECT slug, min(r) AS lo, max(r) AS hi, count(DISTINCT channel) AS n FROM (SELECT slug, channel, CASE WHEN list_amount > amount THEN list_amount ELSE amount END AS r
  FROM v_latest WHERE cc = 'US' AND currency = 'USD') y WHERE r > 0 GROUP BY 1) x WHERE n >= 2 AND hi / lo > 3""", "warning"))
def check_channel_ratio(spark, d):
    return told(Q.check_channel_ratio(B.latest(spark, d)))


@query("check_history", any_of(
    rule("atl_unknown_seed", "concat(slug, '/', atl_key)", "v_seeds WHERE usd > 1000"),
    rule("event_below_atl", "concat(e.slug, '/', e.channel, '/', CAST(e.d AS VARCHAR))", "v_events e JOIN v_seeds s ON e.slug = s.slug AND e.channel = 'steam' WHERE e.usd < s.usd - 0.005::DOUBLE"),
    rule("history_not_in_catalog", "slug", "(SELECT DISTINCT slug FROM v_events WHERE slug NOT IN (SELECT slug FROM v_catalog WHERE tier = 'core')) x")))
def check_history(spark, d):
    atl = seeds(spark, d).withColumn("seed", F.when(F.col("usd") > 1000, "rumour").otherwise(F.col("seed")))
    return told(Q.check_history(events(spark, d), atl, B.catalog(spark, d).where(F.col("tier") == "core")))


@query("check_single_market_history", any_of(
    rule("xbox_needs_event", "slug", "v_catalog WHERE xbox_big_id IS NOT NULL AND slug NOT IN (SELECT slug FROM v_events WHERE channel = 'xbox')"),
    rule("xbox_needs_atl", "slug", "v_catalog WHERE xbox_big_id IS NOT NULL AND slug NOT IN (SELECT slug FROM v_atl WHERE atl_key = 'xbox-us')"),
    rule("psn_needs_event", "slug", "v_catalog WHERE psn_product_id IS NOT NULL AND slug NOT IN (SELECT slug FROM v_events WHERE channel = 'psn')"),
    rule("psn_needs_atl", "slug", "v_catalog WHERE psn_product_id IS NOT NULL AND slug NOT IN (SELECT slug FROM v_atl WHERE atl_key = 'psn-us')")))
def check_single_market_history(spark, d):
    return told(Q.check_single_market_history(B.catalog(spark, d), events(spark, d), lows(spark, d)))


@query("check_feed", any_of(
    rule("feed_price", "o_orderkey", "orders WHERE NOT o_totalprice > 5000"), rule("feed_pct", "o_orderkey", "orders WHERE o_custkey % 110 NOT BETWEEN 1 AND 100"),
    rule("feed_url", "o_orderkey", "orders WHERE o_orderstatus = 'P'")))
def check_feed(spark, d):
    o = B.table(spark, d, "orders")
    return told(Q.check_feed(o.select(
        F.col("o_orderkey").alias("item_id"), (F.col("o_totalprice") - 5000).alias("price"), F.col("o_totalprice").alias("list"), (F.col("o_custkey") % 110).alias("pct"),
        F.when(F.col("o_orderstatus") == "P", "http://a").otherwise("https://a").alias("url"))))


@query("check_free_feed", any_of(rule("free_status", "o_orderkey", "orders WHERE o_orderstatus = 'P'"), rule("free_price", "o_orderkey", "orders WHERE o_orderpriority = '5-LOW'")))
def check_free_feed(spark, d):
    o = B.table(spark, d, "orders")
    return told(Q.check_free_feed(o.select(
        F.col("o_orderkey").alias("item_id"), F.when(F.col("o_orderstatus") == "P", "gone").when(F.col("o_orderstatus") == "O", "upcoming").otherwise("free-now").alias("status"),
        F.when(F.col("o_orderpriority") == "5-LOW", 1.0).otherwise(0.0).alias("price"))))


@query("check_calendar", any_of(
    rule("calendar_date", "o_orderkey", "orders WHERE o_orderstatus = 'F' AND month(o_orderdate) <> month(o_orderdate + INTERVAL 20 DAY)"),
    rule("calendar_platforms", "o_orderkey", "orders WHERE o_orderpriority = '1-URGENT'"), rule("calendar_url_missing", "o_orderkey", "orders WHERE o_orderpriority = '2-HIGH'"),
    rule("calendar_url", "o_orderkey", "orders WHERE o_orderpriority = '3-MEDIUM'"),
    rule("calendar_artwork", "'calendar'", "(SELECT count(*) AS n, count(*) FILTER (WHERE o_custkey % 4 <> 0) AS i FROM orders) x WHERE i < n * 0.8::DOUBLE")))
def check_calendar(spark, d):
    o, p = B.table(spark, d, "orders"), F.col("o_orderpriority")
    day = F.when(F.col("o_orderstatus") == "F", F.date_add(F.col("o_orderdate").cast("date"), 20)).otherwise(F.col("o_orderdate").cast("date"))
    return told(Q.check_calendar(o.select(
        F.col("o_orderkey").alias("entry_id"), F.date_format("o_orderdate", "yyyy-MM").alias("month"), day.cast("string").alias("date"),
        F.when(p == "1-URGENT", F.array(F.lit("pc"), F.lit("pc"))).when(p == "2-HIGH", F.array(F.lit("pc"), F.lit("psn"))).otherwise(F.array(F.lit("pc"))).alias("platforms"),
        F.create_map(F.lit("pc"), F.when(p == "3-MEDIUM", "ftp://a").otherwise("https://a")).alias("urls"),
        F.when(F.col("o_custkey") % 4 != 0, "https://i").alias("image"))))


view("v_cache", """
SELECT o_orderkey AS pos, o_orderstatus AS s, CAST(o_orderdate AS DATE) AS d, o_custkey, o_orderpriority AS p,
  concat('https://store.example/us/', '9N', lpad(CAST(o_custkey AS VARCHAR), 10, '0')) AS url, concat('t', CAST(o_custkey AS VARCHAR)) AS title FROM orders
""")


def cache(spark, d):
    o, p = B.table(spark, d, "orders"), F.col("o_orderpriority")
    day = F.col("o_orderdate").cast("date").cast("string")
    return o.select(
        F.col("o_orderkey").alias("pos"), F.concat(F.lit("t"), F.col("o_custkey").cast("string"), F.when(p == "1-URGENT", " ").otherwise("")).alias("title"),
        F.when(p == "2-HIGH", "2001-02-30").otherwise(day).alias("date"), F.substring(day, 1, 7).alias("month"), F.when(p == "3-MEDIUM", "psn").otherwise("xbox").alias("platform"),
        F.concat(F.lit("https://store.example/"), F.when(p == "5-LOW", "de/").otherwise("us/"), F.lit("9N"), F.lpad(F.col("o_custkey").cast("string"), 10, "0")).alias("url"),
        F.lit("https://i").alias("image"), F.concat(F.lit("p"), F.col("o_custkey").cast("string")).alias("slug_if_tracked"))


WIN = "d BETWEEN DATE '1999-01-01' AND DATE '1999-01-01' + 180"


@query("check_release_cache", any_of(
    rule("release_title", "pos", "v_cache WHERE p = '1-URGENT'"), rule("release_date", "pos", "v_cache WHERE p = '2-HIGH'"),
    rule("release_window", "pos", f"v_cache WHERE p <> '2-HIGH' AND NOT ({WIN})"), rule("release_platform", "pos", "v_cache WHERE p = '3-MEDIUM'"),
    rule("release_url", "pos", "v_cache WHERE p = '5-LOW'"),
    rule("release_unknown_slug", "pos", "v_cache WHERE concat('p', CAST(o_custkey AS VARCHAR)) NOT IN (SELECT slug FROM v_catalog)"),
    rule("release_mapping", "pos", "v_cache JOIN v_catalog ON slug = concat('p', CAST(o_custkey AS VARCHAR)) WHERE p = '5-LOW' OR xbox_big_id IS NULL OR upper(xbox_big_id) <> concat('9N', lpad(CAST(o_custkey AS VARCHAR), 10, '0'))"),
    rule("release_url_repeat", "pos", "(SELECT pos, count(*) OVER (PARTITION BY o_custkey, p = '5-LOW') AS n FROM v_cache) x WHERE n > 1"),
    rule("release_unsorted", "pos", """(SELECT pos, (dd, title, u) AS k, lag((dd, title, u)) OVER (ORDER BY pos) AS before FROM (SELECT pos, CASE WHEN p = '2-HIGH' THEN '2001-02-30' ELSE CAST(d AS VARCHAR) END AS dd,
       concat(title, CASE WHEN p = '1-URGENT' THEN ' ' ELSE '' END) AS title, CASE WHEN p = '5-LOW' THEN replace(url, '/us/', '/de/') ELSE url END AS u FROM v_cache) y) x WHERE before > k""")))
def check_release_cache(spark, d):
    return told(Q.check_release_cache(cache(spark, d), B.catalog(spark, d), "xbox", r"^https://store\.example/us/([0-9A-Za-z]{12})$", "xbox_big_id", "1999-01-01"))


@query("check_meta", any_of(
    rule("meta_review_range", "slug", "v_catalog WHERE review_count > 4500"), rule("meta_image", "slug", "v_catalog WHERE header_image IS NULL"),
    rule("meta_source", "slug", "v_catalog WHERE steam_app_id IS NULL AND tier = 'core'"),
    rule("meta_us_url", "slug", "v_catalog WHERE steam_app_id IS NULL AND tier = 'other' AND nintendo_us_slug IS NULL"),
    rule("meta_eu_nsuid", "slug", "v_catalog WHERE steam_app_id IS NULL AND tier = 'extended' AND nsuid_europe IS NULL"),
    rule("meta_eu_url", "slug", "v_catalog WHERE steam_app_id IS NULL AND tier = 'extended' AND review_count > 4000")))
def check_meta(spark, d):
    cat = B.catalog(spark, d)
    meta = cat.select(
        "slug", (F.col("review_count") / 45).alias("review_percent"), "header_image",
        F.when(F.col("tier") == "core", "manual").when(F.col("tier") == "other", "nintendo-us").otherwise("nintendo-eu-solr").alias("meta_source"),
        F.when(F.col("tier") == "other", F.concat(F.lit("https://www.nintendo.com/us/store/products/"), "nintendo_us_slug", F.lit("/")))
        .when(F.col("review_count") > 4000, "https://elsewhere.example/").otherwise("https://www.nintendo.com/x").alias("store_url"))
    return told(Q.check_meta(meta, cat))


@query("looks_degraded", """
SELECT slug, (header_image IS NOT NULL AND tier = 'core') OR tier = 'other' OR (review_count > 50 AND review_count <= 1500) AS degraded FROM v_catalog
""")
def looks_degraded(spark, d):
    cat = B.catalog(spark, d)
    prev = cat.select("slug", "header_image", F.array(F.lit("rpg")).alias("genres"), "review_count")
    cur = cat.select("slug", F.when(F.col("tier") != "core", F.col("header_image")).alias("header_image"),
                     F.when(F.col("tier") == "other", F.array().cast("array<string>")).otherwise(F.array(F.lit("rpg"))).alias("genres"),
                     F.when(F.col("review_count") > 1500, F.col("review_count")).otherwise(0).alias("review_count"))
    return Q.looks_degraded(prev, cur)


@query("meta_changed", "SELECT slug, review_count > 2500 AS changed FROM v_catalog")
def meta_changed(spark, d):
    prev = B.catalog(spark, d).select("slug", "title", "review_count", F.lit("2001-01-01").alias("updated_at"))
    cur = prev.withColumn("review_count", F.when(F.col("review_count") > 2500, 0).otherwise(F.col("review_count"))).withColumn("updated_at", F.lit("2001-02-02"))
    return Q.meta_changed(prev, cur)


@query("check_ledger", any_of(
    rule("ledger_attempt", "CASE WHEN c_custkey % 20 < 15 THEN concat('meta:shard-', CAST(c_custkey % 20 AS VARCHAR)) ELSE 'rates' END", "customer WHERE c_mktsegment = 'BUILDING'"),
    rule("ledger_success", "CASE WHEN c_custkey % 20 < 15 THEN concat('meta:shard-', CAST(c_custkey % 20 AS VARCHAR)) ELSE 'rates' END", "customer WHERE c_mktsegment = 'FURNITURE'"),
    rule("ledger_order", "CASE WHEN c_custkey % 20 < 15 THEN concat('meta:shard-', CAST(c_custkey % 20 AS VARCHAR)) ELSE 'rates' END", "customer WHERE c_mktsegment = 'MACHINERY'"),
    rule("ledger_streak", "CASE WHEN c_custkey % 20 < 15 THEN concat('meta:shard-', CAST(c_custkey % 20 AS VARCHAR)) ELSE 'rates' END", "customer WHERE c_acctbal < 0"),
    rule("ledger_key", "'meta:shard-14'", "customer WHERE c_custkey % 20 = 14"),
    rule("ledger_missing", "concat('src', CAST(n_nationkey AS VARCHAR))", "nation")))
def check_ledger(spark, d):
    c, seg, n = B.table(spark, d, "customer"), F.col("c_mktsegment"), F.col("c_custkey") % 20
    led = c.select(
        F.when(n < 15, F.concat(F.lit("meta:shard-"), n.cast("string"))).otherwise("rates").alias("source"),
        F.when(seg == "BUILDING", "never").otherwise("2001-01-02T00:00:00Z").alias("last_attempt"),
        F.when(seg == "FURNITURE", "never").when(seg == "MACHINERY", "2001-01-03T00:00:00Z").when(seg == "AUTOMOBILE", None).otherwise("2001-01-01T00:00:00Z").alias("last_success"),
        F.floor(F.col("c_acctbal")).cast("int").alias("streak"))
    req = B.table(spark, d, "nation").select(F.concat(F.lit("src"), F.col("n_nationkey").cast("string")).alias("source"))
    return told(Q.check_ledger(led, req))


@query("replacement_guard", any_of(
    rule("published_id_missing", "o_orderkey", "orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderstatus = 'P'"),
    rule("future_entries_halved", "'list'", "(SELECT count(*) AS b, count(*) FILTER (WHERE o_orderstatus <> 'P') AS a FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01') x WHERE a < b * 0.5")))
def replacement_guard(spark, d):
    o = B.table(spark, d, "orders")
    prev = o.select(F.col("o_orderkey").alias("product_id"), F.col("o_orderdate").alias("date"))
    cur = o.where(F.col("o_orderstatus") != "P").select(F.col("o_orderkey").alias("product_id"), F.col("o_orderdate").alias("date"))
    return told(Q.replacement_guard(prev, cur, "2000-01-01"))


@query("category_completeness", any_of(
    rule("category_total", "l_orderkey", "(SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) x WHERE n <> 4"),
    rule("category_repeat", "l_orderkey", "(SELECT l_orderkey, count(*) AS n, count(DISTINCT l_partkey) AS k FROM lineitem GROUP BY 1) x WHERE n <> k"),
    rule("candidate_not_listed", "o_custkey", "orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_partkey = o_custkey)")))
def category_completeness(spark, d):
    pages = B.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("category"), F.col("l_partkey").alias("product_id"), F.lit(4).alias("total"))
    cands = B.table(spark, d, "orders").select(F.col("o_orderkey").alias("category"), F.col("o_custkey").alias("product_id"))
    return told(Q.category_completeness(pages, cands))


@query("one_product_per_release", rule("release_has_two_products", "concat(lower(title), '/', date)", "(SELECT title, date FROM v_releases WHERE date IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT url) > 1) x"))
def one_product_per_release(spark, d):
    rel = B.releases(spark, d).where(F.col("date").isNotNull()).withColumnRenamed("url", "product_id")
    return told(Q.one_product_per_release(rel, norm_title("title")))


@query("import_artifacts", any_of(
    rule("import_not_in_catalog", "slug", "v_items WHERE slug NOT IN (SELECT slug FROM v_catalog)"),
    rule("import_steam_app_id_differs", "i.slug", "v_items i JOIN v_catalog c ON i.slug = c.slug WHERE i.steam_app_id IS DISTINCT FROM c.steam_app_id"),
    rule("import_steam_prices_missing", "slug", "v_items WHERE slug NOT IN (SELECT slug FROM v_latest WHERE channel = 'steam')"),
    rule("import_steam_event_missing", "slug", "v_items WHERE slug NOT IN (SELECT slug FROM v_events WHERE channel = 'steam')"),
    rule("import_coverage_low", "slug", "(SELECT slug, count(*) AS n FROM v_latest WHERE channel = 'steam' GROUP BY 1) x WHERE n < 10 AND slug IN (SELECT slug FROM v_items)")))
def import_artifacts(spark, d):
    from .candidate_queries import items

    return told(Q.import_artifacts(items(spark, d), B.latest(spark, d), events(spark, d), B.catalog(spark, d)))


@query("check_core_documents", any_of(
    rule("core_name", "l_orderkey", "(SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag <> 'R') AS named FROM lineitem GROUP BY 1) x WHERE named = 0"),
    rule("core_cheapest", "l_orderkey", "(SELECT l_orderkey, min(l_discount) AS m FROM lineitem GROUP BY 1) x WHERE NOT m > 0")))
def check_core_documents(spark, d):
    return told(Q.check_core_documents(B.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("slug"), F.when(F.col("l_returnflag") != "R", "n").alias("name"), F.col("l_linenumber").alias("plan"),
        F.col("l_suppkey").alias("cc"), F.col("l_discount").alias("usd"))))


@query("check_candidate_document", any_of(
    rule("sample_day_repeat", "day", "(SELECT CAST(o_orderdate AS DATE) AS day FROM orders GROUP BY 1 HAVING count(*) > 1) x"),
    rule("digest_mismatch", "concat('steam:', CAST(p_partkey AS VARCHAR))", "part WHERE p_size = 9"),
    rule("candidate_id_mismatch", "concat('steam:', CAST(p_partkey AS VARCHAR))", "part WHERE p_size = 8")))
def check_candidate_document(spark, d):
    p, s = B.table(spark, d, "part"), F.col("p_size")
    rows = p.select(F.concat(F.lit("steam:"), F.col("p_partkey").cast("string")).alias("candidate_id"), (F.col("p_partkey") + F.when(s == 8, 1).otherwise(0)).alias("app_id"),
                    (F.col("p_partkey") + 1).alias("source_rank"), F.col("p_name").alias("title"), "p_size")
    rows = rows.withColumn("evidence_digest", F.when(s == 9, "x").otherwise(X.fingerprint("candidate_id", "title")))
    days = B.table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    return told(Q.check_candidate_document(rows, days, "candidate_id", "title"))


@query("verify_fingerprint", "SELECT slug, tier <> 'core' AS ok FROM v_catalog")
def verify_fingerprint(spark, d):
    cat = B.catalog(spark, d).withColumn("digest", X.fingerprint("slug", "title"))
    cat = cat.withColumn("digest", F.when(F.col("tier") == "core", F.concat(F.lit("sha256:"), F.sha2("slug", 256))).otherwise(F.col("digest")))
    return Q.verify_fingerprint(cat, "slug", "digest", "slug", "title")


@query("page_links", """
SELECT page_id, CAST(len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS INT) AS n_links, CAST(len(list_distinct(regexp_extract_all(html, '<a href="([^"]*)"', 1))) AS INT) AS n_targets,
  CAST(len(regexp_extract_all(html, '<link rel="canonical" href="([^"]*)"', 1)) AS INT) AS n_canonical FROM pages
""")
def page_links(spark, d):
    return Q.page_links(B.table(spark, d, "pages"))


@query("check_pages", any_of(
    rule("page_canonical", "page_id", "pages WHERE len(regexp_extract_all(html, '<link rel=\"canonical\" href=\"([^\"]*)\"', 1)) <> 1"),
    rule("page_url_repeat", "url", "(SELECT url FROM pages GROUP BY 1 HAVING count(*) > 1) x")))
def check_pages(spark, d):
    return told(Q.check_pages(B.table(spark, d, "pages")))


@query("calendar_gate", "SELECT 0 = 0 AS passed, CAST(0 AS BIGINT) AS errors FROM (SELECT count(*) FROM v_releases) x")
def calendar_gate(spark, d):
    merged = CAL.merge_calendar(B.releases(spark, d).where(F.col("image").isNotNull())).withColumn("entry_id", F.col("seq"))
    return Q.gate(Q.check_calendar(merged)).select("passed", "errors")


@query("calendar_gate_all", f"""
SELECT images >= entries * 0.8::DOUBLE AS passed, CAST(CASE WHEN images >= entries * 0.8::DOUBLE THEN 0 ELSE 1 END AS BIGINT) AS errors
FROM (SELECT count(*) AS entries, count(image) AS images FROM ({merge_sql("v_releases")}) y) x
""")
def calendar_gate_all(spark, d):
    """The gate over every release, also those without an image."""
    merged = CAL.merge_calendar(B.releases(spark, d)).withColumn("entry_id", F.col("seq"))
    return Q.gate(Q.check_calendar(merged)).select("passed", "errors")
