"""Checked queries over the price jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import prices as P
from . import bindings as B
from .registry import query

ROUND_HALF = "CAST(0.5 AS DOUBLE)"


@query("regional_model", """
WITH rk AS (SELECT slug, channel, cc, usd,
   row_number() OVER (PARTITION BY slug, channel ORDER BY usd, cc) AS lo_rank,
   row_number() OVER (PARTITION BY slug, channel ORDER BY usd DESC, cc DESC) AS hi_rank
  FROM v_usd WHERE usd > 0)
SELECT slug, channel, min(CASE WHEN lo_rank = 1 THEN cc END) AS cheapest_cc, min(usd) AS cheapest_usd,
  min(CASE WHEN hi_rank = 1 THEN cc END) AS dearest_cc, max(usd) AS dearest_usd,
  max(CASE WHEN cc = 'US' THEN usd END) AS baseline_usd, count(*) AS n_regions,
  CAST(CASE WHEN max(usd) > min(usd) THEN floor((max(usd)/min(usd) - 1)*100 + 0.5::DOUBLE) ELSE 0 END AS INT) AS spread_pct,
  CAST(CASE WHEN max(usd) > min(usd) THEN floor((1 - min(usd)/max(usd))*100 + 0.5::DOUBLE) ELSE 0 END AS INT) AS savings_pct
FROM rk GROUP BY slug, channel
""")
def regional_model(spark, d):
    return P.regional_model(B.prices_usd(spark, d))


@query("to_usd", """
SELECT slug, channel, cc, l.currency, amount,
  CASE WHEN l.currency = 'USD' THEN floor(amount*100 + 0.5::DOUBLE)/100.0::DOUBLE
       WHEN rate > 0 THEN floor(amount/rate*100 + 0.5::DOUBLE)/100.0::DOUBLE END AS usd
FROM v_latest l LEFT JOIN v_rates r ON l.currency = r.currency
""")
def to_usd(spark, d):
    return P.to_usd(B.latest(spark, d), B.rates(spark)).select("slug", "channel", "cc", "currency", "amount", "usd")


@query("fx_join", "SELECT slug, channel, cc, usd, list_usd FROM v_usd")
def fx_join(spark, d):
    return B.prices_usd(spark, d).select("slug", "channel", "cc", "usd", "list_usd")


@query("priced_rows", """
SELECT slug, channel, upper(cc) AS cc, currency, amount, list_amount, discount_pct FROM v_latest
WHERE amount > 0 AND currency <> ''
""")
def priced_rows(spark, d):
    return P.priced_rows(B.latest(spark, d)).select(
        "slug", "channel", "cc", "currency", "amount", "list_amount", "discount_pct")


@query("is_live", """
SELECT slug, channel, cc, d, l_orderkey, l_linenumber, amount,
  coalesce(try_cast(sale_ends_at AS TIMESTAMP) > TIMESTAMP '2001-06-01', true) AS live FROM v_obs
""")
def is_live(spark, d):
    return B.observations(spark, d).select(
        "slug", "channel", "cc", "d", "l_orderkey", "l_linenumber", "amount",
        X.is_live("sale_ends_at", B.AS_OF).alias("live"))


@query("effective_us_row", "SELECT * FROM v_us")
def effective_us_row(spark, d):
    return B.us_prices(spark, d)


@query("us_observation", """
SELECT slug, channel, amount AS usd, discount_pct FROM v_latest WHERE cc = 'US' AND currency = 'USD'
""")
def us_observation(spark, d):
    return P.us_observation(B.latest(spark, d)).select("slug", "channel", "usd", "discount_pct")


@query("valid_regional", "SELECT slug, channel, cc, usd FROM v_usd WHERE cc <> '' AND usd > 0")
def valid_regional(spark, d):
    return P.valid_regional(B.prices_usd(spark, d)).select("slug", "channel", "cc", "usd")


@query("rank_regions", """
SELECT slug, channel, cc, usd, CAST(row_number() OVER (PARTITION BY slug, channel ORDER BY usd, cc) AS INT) AS rank FROM v_usd
""")
def rank_regions(spark, d):
    return P.rank_regions(B.prices_usd(spark, d)).select("slug", "channel", "cc", "usd", "rank")


@query("delta_vs_baseline", """
SELECT slug, channel, cc, delta_pct, CASE WHEN delta_pct IS NULL THEN 'unknown' WHEN cc = 'US' THEN 'baseline'
  WHEN delta_pct < 0 THEN 'cheaper' WHEN delta_pct > 0 THEN 'pricier' ELSE 'par' END AS direction
FROM (SELECT p.slug, p.channel, p.cc,
   CAST(CASE WHEN b.usd IS NULL THEN NULL WHEN p.cc = 'US' THEN 0 ELSE floor((p.usd/b.usd - 1)*100 + 0.5::DOUBLE) END AS INT) AS delta_pct
  FROM v_usd p LEFT JOIN (SELECT slug, channel, usd FROM v_usd WHERE cc = 'US') b
    ON p.slug = b.slug AND p.channel = b.channel) x
""")
def delta_vs_baseline(spark, d):
    return P.delta_vs_baseline(B.prices_usd(spark, d)).select("slug", "channel", "cc", "delta_pct", "direction")


@query("map_buckets", """
WITH b AS (SELECT slug, channel, cc AS baseline_cc, usd AS base_usd FROM (
   SELECT *, row_number() OVER (PARTITION BY slug, channel ORDER BY CASE WHEN cc = 'US' THEN 0 ELSE 1 END, usd, cc) rn FROM v_usd) x WHERE rn = 1),
 j AS (SELECT p.slug, p.channel, p.cc, b.baseline_cc,
   CAST(CASE WHEN p.cc = b.baseline_cc THEN 0 ELSE floor((p.usd/b.base_usd - 1)*100 + 0.5::DOUBLE) END AS INT) AS delta_pct
   FROM v_usd p JOIN b ON p.slug = b.slug AND p.channel = b.channel)
SELECT *, CASE WHEN cc = baseline_cc THEN 'baseline' WHEN delta_pct <= -30 THEN 'cheaper-2' WHEN delta_pct < 0 THEN 'cheaper-1'
  WHEN delta_pct >= 30 THEN 'pricier-2' WHEN delta_pct > 0 THEN 'pricier-1' ELSE 'par' END AS bucket FROM j
""")
def map_buckets(spark, d):
    return P.map_buckets(B.prices_usd(spark, d)).select("slug", "channel", "cc", "baseline_cc", "delta_pct", "bucket")


@query("outlier_regions", """
WITH u AS (SELECT l.slug, l.channel, l.cc, l.amount,
   CASE WHEN l.currency = 'USD' THEN floor(coalesce(list_amount, amount)*100 + 0.5::DOUBLE)/100.0::DOUBLE
     ELSE floor(coalesce(list_amount, amount)/rate*100 + 0.5::DOUBLE)/100.0::DOUBLE END AS reg
   FROM v_latest l LEFT JOIN v_rates r ON l.currency = r.currency),
 m AS (SELECT slug, channel, count(reg) AS n, list_sort(list(reg) FILTER (WHERE reg IS NOT NULL)) AS regs FROM u GROUP BY 1, 2)
SELECT u.slug, u.channel, u.cc, u.amount FROM u JOIN m ON u.slug = m.slug AND u.channel = m.channel
WHERE m.n < 4 OR u.reg >= m.regs[CAST(m.n // 2 AS INT) + 1] * 0.1::DOUBLE
""")
def outlier_regions(spark, d):
    return P.outlier_regions(B.latest(spark, d), B.rates(spark)).select("slug", "channel", "cc", "amount")


@query("best_price_now", """
SELECT slug, usd, channel FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY usd,
  CASE channel WHEN 'steam' THEN 0 WHEN 'eshop' THEN 1 WHEN 'xbox' THEN 2 ELSE 3 END) rn FROM v_us) x WHERE rn = 1
""")
def best_price_now(spark, d):
    return P.best_price_now(B.us_prices(spark, d))


@query("best_price_flags", """
SELECT a.slug, a.channel, a.usd, g.n >= 2 AND g.hi - g.lo > 0.005::DOUBLE AND abs(a.usd - g.lo) <= 0.005::DOUBLE AS is_best
FROM v_us a JOIN (SELECT slug, min(usd) AS lo, max(usd) AS hi, count(*) AS n FROM v_us GROUP BY slug) g ON a.slug = g.slug
""")
def best_price_flags(spark, d):
    return P.best_price_flags(B.us_prices(spark, d)).select("slug", "channel", "usd", "is_best")


@query("core_summary", """
SELECT slug, channel, max(CASE WHEN lo = 1 THEN cc END) AS cheapest_cc, max(CASE WHEN hi = 1 THEN cc END) AS dearest_cc,
  max(CASE WHEN discount_pct > 0 THEN 1 ELSE 0 END) = 1 AS any_discount, count(*) AS n_regions
FROM (SELECT *, row_number() OVER (PARTITION BY slug, channel ORDER BY usd, cc) lo,
        row_number() OVER (PARTITION BY slug, channel ORDER BY usd DESC, cc DESC) hi FROM v_usd) x
GROUP BY slug, channel
""")
def core_summary(spark, d):
    return P.core_summary(B.prices_usd(spark, d))


@query("us_benchmark", """
SELECT p.slug, p.channel, max(b.usd) AS us_usd FROM v_usd p
LEFT JOIN (SELECT * FROM v_usd WHERE cc = 'US') b ON p.slug = b.slug AND p.channel = b.channel GROUP BY 1, 2
""")
def us_benchmark(spark, d):
    return P.us_benchmark(B.prices_usd(spark, d))


@query("core_catalog", """
SELECT slug, count(DISTINCT channel) AS n_plans, count(DISTINCT cc) AS n_regions, max(d) AS last_update FROM v_latest GROUP BY slug
""")
def core_catalog(spark, d):
    return P.core_catalog(B.latest(spark, d))


@query("lowest_countries", """
SELECT slug, channel, cc, usd, CAST(place AS INT) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY slug, channel ORDER BY usd, cc) AS place FROM v_usd) x WHERE place <= 3
""")
def lowest_countries(spark, d):
    return P.lowest_countries(B.prices_usd(spark, d)).select(
        "slug", "channel", "cc", "usd", F.col("place").cast("int").alias("place"))


# Supplemental offers: the store's base rows are the steam rows, the offers of
# a game are its rows in the other stores.
def offers(df):
    return df.where(F.col("channel") != "steam").withColumnRenamed("channel", "package_id")


@query("offer_columns", """
WITH o AS (SELECT slug, channel AS package_id, cc, usd FROM v_usd WHERE channel <> 'steam' AND usd > 0),
 ob AS (SELECT * FROM o WHERE cc = 'US'),
 od AS (SELECT o.slug, o.cc, o.package_id, o.usd AS offer_usd, CAST(CASE WHEN ob.usd IS NULL THEN NULL WHEN o.cc = 'US' THEN 0
     ELSE floor((o.usd/ob.usd - 1)*100 + 0.5::DOUBLE) END AS INT) AS offer_delta_pct
   FROM o LEFT JOIN ob ON o.slug = ob.slug AND o.package_id = ob.package_id)
SELECT b.slug, b.cc, b.rank, od.package_id, od.offer_usd, od.offer_delta_pct
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY slug ORDER BY usd, cc) AS INT) AS rank FROM v_usd WHERE channel = 'steam') b
LEFT JOIN od ON b.slug = od.slug AND b.cc = od.cc
""")
def offer_columns(spark, d):
    usd = B.prices_usd(spark, d)
    base = P.rank_regions(usd.where(F.col("channel") == "steam")).select("slug", "cc", "rank")
    return P.offer_columns(base, offers(usd)).select("slug", "cc", "rank", "package_id", "offer_usd", "offer_delta_pct")


@query("enrich_offers", """
SELECT slug, channel AS package_id, cc, usd, list_usd FROM v_usd WHERE channel <> 'steam'
""")
def enrich_offers(spark, d):
    return P.enrich_offers(offers(B.latest(spark, d)), B.rates(spark)).select("slug", "package_id", "cc", "usd", "list_usd")


@query("offer_display", """
SELECT l_orderkey, l_partkey AS package_id, l_suppkey, l_linenumber, l_extendedprice AS price,
  CASE WHEN p_size > 25 THEN p_name ELSE concat('stored ', CAST(l_partkey AS VARCHAR)) END AS name
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
""")
def offer_display(spark, d):
    stored = B.table(spark, d, "lineitem").select(
        "l_orderkey", F.col("l_partkey").alias("package_id"), "l_suppkey", "l_linenumber",
        F.col("l_extendedprice").alias("price"),
        F.concat(F.lit("stored "), F.col("l_partkey").cast("string")).alias("name"))
    reviewed = B.table(spark, d, "part").where(F.col("p_size") > 25).select(
        F.col("p_partkey").alias("package_id"), F.col("p_name").alias("name"))
    return P.offer_display(stored, reviewed)
