"""Checked queries over the boards."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ordering as O
from ..operators import boards as K
from ..operators import history as H
from . import bindings as B
from .history_queries import CH, events, lows
from .registry import query, view


@query("game_bundle", """
SELECT c.slug, c.title, p.steam_usd, p.eshop_usd, p.xbox_usd, p.psn_usd, a.usd AS atl_usd, a.date AS atl_date, m.header_image, m.review_count
FROM v_catalog c
LEFT JOIN (SELECT slug, max(CASE WHEN channel='steam' THEN usd END) AS steam_usd, max(CASE WHEN channel='eshop' THEN usd END) AS eshop_usd,
   max(CASE WHEN channel='xbox' THEN usd END) AS xbox_usd, max(CASE WHEN channel='psn' THEN usd END) AS psn_usd FROM v_us GROUP BY slug) p ON c.slug = p.slug
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY usd, CASE atl_key WHEN 'pc' THEN 0 WHEN 'eshop-us' THEN 1 WHEN 'xbox-us' THEN 3 ELSE 4 END) rn FROM v_atl) a
  ON c.slug = a.slug AND a.rn = 1
LEFT JOIN (SELECT slug, header_image, review_count FROM v_catalog) m ON c.slug = m.slug
""")
def game_bundle(spark, d):
    cat = B.catalog(spark, d)
    return K.game_bundle(cat, B.us_prices(spark, d), lows(spark, d), cat.select("slug", "header_image", "review_count"))


view("v_multi", """
SELECT slug, channel, count(*) AS n_regions FROM v_usd WHERE channel IN ('steam','eshop') AND usd > 0 GROUP BY 1, 2 HAVING count(*) > 1
""")


@query("multi_region_sources", "SELECT * FROM v_multi")
def multi_region_sources(spark, d):
    return K.multi_region_sources(B.prices_usd(spark, d))


view("v_primary", """
SELECT slug, channel FROM (SELECT u.slug, u.channel, row_number() OVER (PARTITION BY u.slug ORDER BY
   CASE WHEN u.channel = c.primary_regional_channel THEN -1 WHEN u.channel = 'steam' THEN 0 ELSE 1 END) rn
  FROM (SELECT DISTINCT slug, channel FROM v_usd) u JOIN v_catalog c ON u.slug = c.slug
  WHERE u.channel IN ('steam','eshop') OR u.channel = c.primary_regional_channel) x WHERE rn = 1
""")


@query("primary_source", "SELECT * FROM v_primary")
def primary_source(spark, d):
    return K.primary_source(B.catalog(spark, d), B.prices_usd(spark, d))


view("v_model", """
SELECT slug, channel, min(usd) AS lo, max(usd) AS hi, arg_min(cc, (usd, cc)) AS lo_cc, arg_max(cc, (usd, cc)) AS hi_cc,
  CAST(CASE WHEN max(usd) > min(usd) THEN floor((1 - min(usd)/max(usd))*100 + 0.5::DOUBLE) ELSE 0 END AS INT) AS savings
FROM v_usd WHERE usd > 0 GROUP BY 1, 2
""")
view("v_display", """
SELECT slug, channel, lo, hi, lo_cc, hi_cc, savings FROM (SELECT m.*, row_number() OVER (PARTITION BY m.slug ORDER BY savings DESC, hi - lo DESC, lo,
   CASE m.channel WHEN 'steam' THEN 0 ELSE 1 END) rn FROM v_model m JOIN v_multi x ON m.slug = x.slug AND m.channel = x.channel) y WHERE rn = 1
""")


@query("regional_display_source", """
SELECT slug, channel, lo AS cheapest_usd, hi AS dearest_usd, lo_cc AS cheapest_cc, hi_cc AS dearest_cc, savings AS savings_pct FROM v_display
""")
def regional_display_source(spark, d):
    return K.regional_display_source(B.prices_usd(spark, d)).select(
        "slug", "channel", "cheapest_usd", "dearest_usd", "cheapest_cc", "dearest_cc", "savings_pct")


view("v_cards", """
SELECT y.slug, c.title, y.channel, y.lo_cc AS cheapest_cc, y.hi_cc AS dearest_cc, y.savings AS savings_pct, c.header_image, c.review_count,
  len(c.platforms) > 0 AND len(list_filter(c.platforms, lambda x: x NOT IN ('switch','switch-2'))) = 0 AND c.steam_app_id IS NULL AND c.xbox_big_id IS NULL AS exclusive
FROM v_display y JOIN v_catalog c ON y.slug = c.slug
WHERE y.slug IN (SELECT slug FROM v_multi WHERE channel = 'eshop')
""")


def cards(spark, d):
    return K.regional_cards(B.catalog(spark, d), B.prices_usd(spark, d), "eshop").select(
        "slug", "title", "channel", "cheapest_cc", "dearest_cc", "savings_pct", "header_image", "review_count", "exclusive")


@query("regional_cards", "SELECT * FROM v_cards")
def regional_cards(spark, d):
    return K.order_cards(cards(spark, d))


@query("popular_cards", """
SELECT slug, title, savings_pct, review_count FROM v_cards WHERE header_image IS NOT NULL
  AND slug NOT IN (SELECT slug FROM v_us) ORDER BY review_count DESC, title, slug LIMIT 4
""")
def popular_cards(spark, d):
    return K.popular_cards(cards(spark, d), 4, B.us_prices(spark, d).select("slug").distinct()).select(
        "slug", "title", "savings_pct", "review_count")


view("v_gaps", """
SELECT p.slug, p.channel, c.cc, CAST(floor((1 - c.usd/u.usd)*100 + 0.5::DOUBLE) AS INT) AS save_pct
FROM v_primary p
JOIN (SELECT slug, channel, cc, usd, row_number() OVER (PARTITION BY slug, channel ORDER BY usd, cc) rn FROM v_usd) c
  ON p.slug = c.slug AND p.channel = c.channel AND c.rn = 1
JOIN v_us u ON p.slug = u.slug AND p.channel = u.channel
WHERE c.cc <> 'US' AND u.usd > 0
""")


@query("region_gaps", "SELECT * FROM v_gaps WHERE save_pct >= 5")
def region_gaps(spark, d):
    return K.region_gaps(B.catalog(spark, d), B.prices_usd(spark, d), B.us_prices(spark, d))


@query("region_gap_board", "SELECT * FROM v_gaps WHERE save_pct >= 5 ORDER BY save_pct DESC, slug LIMIT 5")
def region_gap_board(spark, d):
    return K.region_gap_board(B.catalog(spark, d), B.prices_usd(spark, d), B.us_prices(spark, d))


ATL = f"""
WITH b AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY usd, {CH}) rn FROM v_us),
 a AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY usd, CASE atl_key WHEN 'pc' THEN 0 WHEN 'eshop-us' THEN 1 WHEN 'xbox-us' THEN 3 ELSE 4 END) rn FROM v_atl)
SELECT b.slug, b.channel, b.usd, a.date FROM b JOIN a ON a.slug = b.slug AND a.rn = 1 WHERE b.rn = 1 AND b.usd <= a.usd + 0.001::DOUBLE
"""


@query("at_low", ATL)
def at_low(spark, d):
    return K.at_low(B.us_prices(spark, d), lows(spark, d))


@query("atl_board", ATL + " ORDER BY a.date DESC NULLS LAST, b.slug LIMIT 5")
def atl_board(spark, d):
    return K.atl_board(B.us_prices(spark, d), lows(spark, d))


HOT = f"""
SELECT slug, channel, usd, discount_pct AS pct FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY discount_pct DESC, {CH}) rn
  FROM v_us WHERE discount_pct > 0) x WHERE rn = 1
"""


@query("best_discounts", HOT)
def best_discounts(spark, d):
    return K.best_discounts(B.us_prices(spark, d))


@query("hot_deals", HOT + " ORDER BY pct DESC, slug LIMIT 5")
def hot_deals(spark, d):
    return K.hot_deals(B.us_prices(spark, d))


view("v_deals", """
SELECT u.slug, u.channel, u.usd, u.list_usd, u.discount_pct AS pct, u.sale_ends_at, a.usd AS atl_usd, coalesce(u.usd <= a.usd + 0.001::DOUBLE, false) AS is_atl
FROM v_us u LEFT JOIN v_atl a ON u.slug = a.slug
  AND a.atl_key = CASE u.channel WHEN 'steam' THEN 'pc' WHEN 'eshop' THEN 'eshop-us' WHEN 'xbox' THEN 'xbox-us' ELSE 'psn-us' END
WHERE u.discount_pct > 0 AND coalesce(try_cast(u.sale_ends_at AS TIMESTAMP) > TIMESTAMP '2001-06-01', true)
""")


def deals(spark, d):
    return K.tracked_deals(B.us_prices(spark, d), lows(spark, d), B.AS_OF)


@query("tracked_deals", "SELECT * FROM v_deals")
def tracked_deals(spark, d):
    return deals(spark, d)


@query("tracked_atl_deals", "SELECT * FROM v_deals WHERE is_atl")
def tracked_atl_deals(spark, d):
    return K.tracked_atl_deals(deals(spark, d))


@query("atl_grid", f"""
SELECT slug, channel, usd, pct FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY pct DESC, usd, {CH}) rn FROM v_deals WHERE is_atl) x
WHERE rn = 1 ORDER BY pct DESC, usd, slug LIMIT 8
""")
def atl_grid(spark, d):
    return K.atl_grid(deals(spark, d)).select("slug", "channel", "usd", "pct")


@query("ending_soon", f"""
SELECT slug, channel, pct, sale_ends_at FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY sale_ends_at, pct DESC, {CH}) rn
  FROM v_deals WHERE sale_ends_at IS NOT NULL) x WHERE rn = 1 ORDER BY sale_ends_at, pct DESC, slug LIMIT 4
""")
def ending_soon(spark, d):
    return K.ending_soon(deals(spark, d)).select("slug", "channel", "pct", "sale_ends_at")


# Free items: observations at the deepest discount, some ended, some upcoming.
view("v_free", """
SELECT slug, channel, l_orderkey, l_linenumber, amount, cc, sale_ends_at AS ends_at,
  CASE WHEN d > DATE '2001-06-01' THEN 'upcoming' ELSE 'free-now' END AS status,
  concat(lpad(CAST(l_orderkey AS VARCHAR), 12, '0'), '-', CAST(l_linenumber AS VARCHAR), '-', slug, '-', cc, '-', channel) AS seq
FROM v_obs WHERE discount_pct >= 10
""")


def free_feed(spark, d):
    seq = F.concat_ws("-", F.lpad(F.col("l_orderkey").cast("string"), 12, "0"), F.col("l_linenumber").cast("string"), "slug", "cc", "channel")
    return B.observations(spark, d).where(F.col("discount_pct") >= 10).select(
        "slug", "channel", F.col("sale_ends_at").alias("ends_at"),
        F.when(F.col("d") > F.lit(B.AS_OF_DAY).cast("date"), "upcoming").otherwise("free-now").alias("status"), seq.alias("seq"))


FREE = "SELECT slug, channel, ends_at, seq FROM v_free WHERE status = 'free-now' AND coalesce(try_cast(ends_at AS TIMESTAMP) > TIMESTAMP '2001-06-01', true)"


@query("free_games", FREE)
def free_games(spark, d):
    return K.free_games(free_feed(spark, d), B.AS_OF).select("slug", "channel", "ends_at", "seq")


@query("free_now", FREE + " ORDER BY seq LIMIT 2")
def free_now(spark, d):
    return K.free_now(free_feed(spark, d), B.AS_OF).select("slug", "channel", "ends_at", "seq")


@query("current_month", """
SELECT coalesce(min(CASE WHEN month >= '2001-06' THEN month END), max(month)) AS month FROM v_releases
""")
def current_month(spark, d):
    return K.current_month(B.releases(spark, d), B.AS_OF_DAY)


@query("next_releases", """
SELECT title, date, platform, seq FROM v_releases
WHERE month = (SELECT coalesce(min(CASE WHEN month >= '2001-06' THEN month END), max(month)) FROM v_releases)
  AND CAST(date AS DATE) >= DATE '2001-06-01' ORDER BY date, title, seq LIMIT 4
""")
def next_releases(spark, d):
    return K.next_releases(B.releases(spark, d), B.AS_OF_DAY).select("title", "date", "platform", "seq")


@query("future_entries", "SELECT seq, title, month FROM v_releases WHERE month IS NULL OR month >= '2001-06'")
def future_entries(spark, d):
    return K.future_entries(B.releases(spark, d), "2001-06").select("seq", "title", "month")


@query("within_horizon", """
SELECT seq, title, date FROM v_releases WHERE CAST(date AS DATE) BETWEEN DATE '2001-01-15' AND DATE '2001-01-15' + 180
""")
def within_horizon(spark, d):
    from ..functions import expr as X

    return B.releases(spark, d).where(X.within_horizon("date", "2001-01-15")).select("seq", "title", "date")


view("v_meta", """
SELECT slug, concat('g', substr(slug, 2)) AS tracked, header_image FROM v_catalog
""")


@query("image_fallback", """
SELECT r.seq, r.platform, coalesce(r.image, m.header_image) AS image, r.slug_if_tracked FROM v_releases r LEFT JOIN v_meta m ON r.slug_if_tracked = m.tracked
""")
def image_fallback(spark, d):
    meta = B.catalog(spark, d).select(F.concat(F.lit("g"), F.expr("substring(slug, 2)")).alias("slug"), "header_image")
    return K.image_fallback(B.releases(spark, d), meta).select("seq", "platform", "image", "slug_if_tracked")


@query("untracked_items", """
SELECT slug, channel, seq FROM v_free f WHERE NOT EXISTS (SELECT 1 FROM v_catalog c WHERE c.slug = f.slug AND tier = 'core')
""")
def untracked_items(spark, d):
    core = B.catalog(spark, d).where(F.col("tier") == "core")
    return K.untracked_items(free_feed(spark, d).withColumnRenamed("slug", "slug_if_tracked"), core).select(
        F.col("slug_if_tracked").alias("slug"), "channel", "seq")


# ------------------------------------------------------------ listings

@query("paginate", """
SELECT slug, channel, pct, CAST((row_number() OVER (ORDER BY pct DESC, slug, channel) - 1) // 100 + 1 AS INT) AS page FROM v_deals
""")
def paginate(spark, d):
    rows = deals(spark, d).select("slug", "channel", "pct")
    return O.paginate(rows, [O.down("pct"), "slug", "channel"], 100)


@query("page_count", "SELECT count(*) AS n_rows, CAST(greatest(1, ceil(count(*)/100.0)) AS INT) AS pages FROM v_obs")
def page_count(spark, d):
    return O.page_count(B.observations(spark, d), 100)


@query("search_index", "SELECT slug, title, row_number() OVER (ORDER BY slug) AS ordinal FROM v_catalog")
def search_index(spark, d):
    return O.global_row_number(B.catalog(spark, d).select("slug", "title"), ["slug"], "ordinal")


@query("first_per_key", """
SELECT slug, url_page, title FROM (SELECT concat('p', CAST(l_partkey AS VARCHAR)) AS slug, l_orderkey AS url_page, l_linestatus AS title,
  row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_linestatus) rn FROM lineitem) x WHERE rn = 1
""")
def first_per_key(spark, d):
    li = B.table(spark, d, "lineitem").select(
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("slug"), F.col("l_orderkey").alias("url_page"),
        F.col("l_linestatus").alias("title"), "l_linenumber")
    return O.first_per_key(li, ["slug"], [F.col("url_page"), F.col("l_linenumber"), F.col("title")]).drop("l_linenumber")
