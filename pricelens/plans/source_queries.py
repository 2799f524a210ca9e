"""Checked queries over the parsers.

The landed bodies are written by Spark from the test tables, in the shape of
the store responses, and parsed back; the oracle states the expected rows
directly on the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import consoles as CO
from ..sources import feeds as FE
from ..sources import files as FI
from ..sources import meta as ME
from ..sources import rankings as RA
from ..functions.ordering import small_group_row_number
from ..sources import stores as ST
from . import bindings as B
from .registry import query

LI = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


PAGE_ROWS = 25
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
NUMBERED = ("(SELECT *, k // 25 AS page FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) - 1 AS k FROM lineitem) n)")


def line_pages(spark, d, cell):
    """Line items of an order cut into pages of a fixed size, so that a page
    stays small however many lines an order has."""
    li = B.table(spark, d, "lineitem").select("l_orderkey", *LINE_ORDER)
    numbered = small_group_row_number(li, ["l_orderkey"], LINE_ORDER, "rn")
    page = F.floor((F.col("rn") - 1) / F.lit(PAGE_ROWS))
    x = F.struct("rn", *LINE_ORDER, cell.alias("cell"))
    return numbered.groupBy("l_orderkey", page.alias("page")).agg(F.array_sort(F.collect_list(x)).alias("xs"), F.max("l_quantity").alias("q"))


def cents(c):
    return F.floor(F.col(c) * 100 + 0.5)


def steam_raw(spark, d):
    """A batch response per line item: the app id is the part, the key the flag."""
    li = B.table(spark, d, "lineitem").select(*LI)
    po = F.when(F.col("l_linestatus") == "O", F.struct(
        F.lit("USD").alias("currency"), cents("l_extendedprice").alias("initial"), F.floor(cents("l_extendedprice") * (1 - F.col("l_discount"))).alias("final"),
        F.floor(F.col("l_discount") * 100 + 0.5).cast("int").alias("discount_percent")))
    entry = F.struct((F.col("l_returnflag") != "R").alias("success"), F.struct(po.alias("price_overview"), F.lit("x").alias("name")).alias("data"))
    return li.select(F.col("l_returnflag").alias("key"), F.to_json(F.create_map(F.col("l_partkey").cast("string"), entry)).alias("body"))


@query("steam_prices", """
SELECT l_partkey AS app_id, l_returnflag AS cc, CASE WHEN ok THEN 'USD' END AS currency, CASE WHEN ok THEN floor(fin/100*100 + 0.5::DOUBLE)/100.0::DOUBLE END AS amount,
  CASE WHEN ok AND pct > 0 THEN floor(ini/100*100 + 0.5::DOUBLE)/100.0::DOUBLE END AS list_amount, CASE WHEN ok AND pct > 0 THEN pct END AS discount_pct
FROM (SELECT *, l_linestatus = 'O' AND l_returnflag <> 'R' AS ok, floor(l_extendedprice*100 + 0.5::DOUBLE) AS ini, floor(floor(l_extendedprice*100 + 0.5::DOUBLE)*(1-l_discount)) AS fin,
   CAST(floor(l_discount*100 + 0.5::DOUBLE) AS INT) AS pct FROM lineitem) x
""")
def steam_prices(spark, d):
    return ST.steam_prices(steam_raw(spark, d))


def eshop_raw(spark, d):
    li = B.table(spark, d, "lineitem").select(*LI)
    price = F.col("l_extendedprice")
    low = F.floor(price * (1 - F.col("l_discount")))
    entry = F.struct(
        F.concat(F.lit("7001"), F.lpad(F.col("l_partkey").cast("string"), 10, "0")).alias("title_id"),
        F.when(F.col("l_returnflag") == "R", "not_found").when(F.col("l_returnflag") == "N", "pre_order").otherwise("onsale").alias("sales_status"),
        F.struct(F.lit("EUR").alias("currency"), price.cast("decimal(18,2)").cast("string").alias("raw_value")).alias("regular_price"),
        F.when(F.col("l_discount") > 0, F.struct(low.cast("string").alias("raw_value"), F.lit("2001-09-01T00:00:00Z").alias("end_datetime"))).alias("discount_price"))
    return li.select(F.lower("l_linestatus").alias("key"), F.to_json(F.struct(F.lit("DE").alias("country"), F.array(entry).alias("prices"))).alias("body"))


@query("eshop_prices", """
SELECT concat('7001', lpad(CAST(l_partkey AS VARCHAR), 10, '0')) AS nsuid, l_linestatus AS cc, CASE WHEN ok THEN 'EUR' END AS currency,
  CASE WHEN ok AND sale THEN low WHEN ok THEN l_extendedprice END AS amount, CASE WHEN ok AND sale THEN l_extendedprice END AS list_amount,
  CASE WHEN ok AND sale THEN CAST(floor((1 - low/l_extendedprice)*100 + 0.5::DOUBLE) AS INT) END AS discount_pct
FROM (SELECT *, l_returnflag <> 'R' AS ok, floor(l_extendedprice*(1-l_discount)) AS low, l_discount > 0 AND floor(l_extendedprice*(1-l_discount)) < l_extendedprice AS sale FROM lineitem) x
""")
def eshop_prices(spark, d):
    return ST.eshop_prices(eshop_raw(spark, d)).drop("sale_ends_at")


@query("steam_package_prices", """
SELECT l_partkey AS package_id, l_linestatus AS cc, reason, CASE WHEN reason IS NULL THEN floor(c/100*100 + 0.5::DOUBLE)/100.0::DOUBLE END AS amount
FROM (SELECT *, floor(l_extendedprice*100 + 0.5::DOUBLE) AS c, CASE WHEN l_returnflag = 'R' THEN 'no_price' WHEN l_quantity = 1 THEN 'store_name_changed' WHEN l_quantity = 2 THEN 'page_text_missing'
   WHEN l_quantity = 3 AND p_size <= 25 THEN 'base_app_missing' WHEN l_quantity <> 3 AND p_size > 25 THEN 'base_app_unexpected' WHEN p_size <= 25 AND l_quantity = 4 THEN 'contents_changed' END AS reason
   FROM lineitem JOIN part ON l_partkey = p_partkey) x
""")
def steam_package_prices(spark, d):
    li = B.table(spark, d, "lineitem").select(*LI)
    q, app = F.col("l_quantity"), F.col("l_partkey")
    apps = F.when(q == 3, F.array(F.struct((app + 7).alias("id")))).when(q == 4, F.array(F.struct((app + 9).alias("id")), F.struct(app.alias("id")))).otherwise(F.array(F.struct(app.alias("id"))))
    data = F.struct(F.when(q == 1, "renamed").otherwise("set").alias("name"), F.when(q == 2, "nothing").otherwise("REQUIRES the base game").alias("page_content"), apps.alias("apps"),
                    F.struct(F.lit("usd").alias("currency"), cents("l_extendedprice").alias("initial"), cents("l_extendedprice").alias("final"), F.lit(0).alias("discount_percent")).alias("price"))
    body = F.to_json(F.create_map(app.cast("string"), F.struct((F.col("l_returnflag") != "R").alias("success"), data.alias("data"))))
    offers = B.table(spark, d, "part").select(
        F.col("p_partkey").alias("package_id"), F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("slug"), (F.col("p_size") <= 25).alias("includes_base"),
        F.col("p_partkey").alias("base_app_id"), F.when(F.col("p_size") <= 25, F.array("p_partkey")).alias("expected_app_ids"), F.lit("set").alias("expected_store_name"), F.lit("requires the base").alias("required_page_text"))
    return ST.steam_package_prices(li.select(F.col("l_linestatus").alias("key"), body.alias("body")), offers).select("package_id", "cc", "reason", "amount")


@query("xbox_prices", """
SELECT slug, '9N' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS big_id, floor(p_retailprice*(1 - CASE WHEN p_size < 20 THEN 0.25::DOUBLE ELSE 0 END)*100 + 0.5::DOUBLE)/100.0::DOUBLE AS amount,
  CASE WHEN p_size < 20 THEN floor(p_retailprice*100 + 0.5::DOUBLE)/100.0::DOUBLE END AS list_amount
FROM (SELECT concat('p', CAST(p_partkey AS VARCHAR)) AS slug, * FROM part) x WHERE p_type = 'PROMO' AND p_size <> 47 AND p_size NOT IN (1, 2, 3, 4, 5, 6, 7)
""")
def xbox_prices(spark, d):
    p, s = B.landed(spark, d, "part", "p_partkey"), F.col("p_size")
    conditions = F.struct(
        F.lit("2001-01-01T00:00:00Z").alias("StartDate"), F.when(s == 1, "2001-02-01T00:00:00Z").otherwise("9998-12-30T00:00:00Z").alias("EndDate"),
        F.array(F.when(s == 2, "2").otherwise("1")).alias("ResourceSetIds"),
        F.struct(F.array(F.struct(F.lit(2147483647).alias("MaxVersion"), F.lit(0).alias("MinVersion"), F.when(s == 3, "Windows.Mobile").otherwise("Windows.Xbox").alias("PlatformName"))).alias("AllowedPlatforms")).alias("ClientConditions"))
    price = F.struct((F.col("p_retailprice") * (1 - F.when(s < 20, 0.25).otherwise(0.0))).alias("ListPrice"), F.col("p_retailprice").alias("MSRP"), F.lit("USD").alias("CurrencyCode"))
    av = F.struct(F.array(F.lit("Details"), F.when(s == 4, "Browse").otherwise("Purchase")).alias("Actions"), conditions.alias("Conditions"),
                  F.struct(F.when(s == 5, F.array(F.lit("k"))).otherwise(F.array().cast("array<string>")).alias("GrantedEntitlementKeys"), price.alias("Price")).alias("OrderManagementData"))
    sku = F.struct(F.lit("0010").alias("SkuId"), F.when(s == 6, "trial").otherwise("full").alias("SkuType"), F.array(F.struct(F.col("p_name").alias("SkuTitle"))).alias("LocalizedProperties"),
                   F.struct(F.lit(False).alias("IsTrial"), F.lit(False).alias("IsBundle")).alias("Properties"))
    big = F.concat(F.when(s == 47, "x").otherwise("9"), F.lit("N"), F.lpad(F.col("p_partkey").cast("string"), 10, "0"))
    product = F.struct(big.alias("ProductId"), F.when(s == 7, "Movie").otherwise("Game").alias("ProductKind"), F.array(F.struct(F.upper("p_name").alias("ProductTitle"))).alias("LocalizedProperties"),
                       F.array(F.struct(sku.alias("Sku"), F.array(av, av).alias("Availabilities"))).alias("DisplaySkuAvailabilities"))
    raw = p.select(F.to_json(F.struct(F.array(product).alias("Products"))).alias("body"))
    return ST.xbox_prices(raw, B.catalog(spark, d), B.AS_OF).select("slug", "big_id", "amount", "list_amount")


@query("xbox_suggestions", """
SELECT '9N' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS product_id, p_name AS title, CASE WHEN p_type = 'SMALL' THEN 'Movie' ELSE 'Game' END AS kind FROM part WHERE p_size <> 9
""")
def xbox_suggestions(spark, d):
    p = B.table(spark, d, "part")
    pid = F.when(F.col("p_size") == 9, "short").otherwise(F.concat(F.lit("9n"), F.lpad(F.col("p_partkey").cast("string"), 10, "0")))
    product = F.struct(F.when(F.col("p_type") == "SMALL", "Movie").otherwise("Game").alias("Type"), pid.alias("ProductId"), F.col("p_name").alias("Title"))
    return ST.xbox_suggestions(p.select(F.to_json(F.struct(F.array(F.struct(F.array(product).alias("Products"))).alias("Results"))).alias("body")))


@query("fx_rates", """
SELECT concat('C', CAST(n_nationkey AS VARCHAR)) AS currency, CAST(n_nationkey + 1.5 AS DOUBLE) AS rate FROM nation
""")
def fx_rates(spark, d):
    n = B.table(spark, d, "nation")
    # one document per source: the first source failed, the second has every nation
    pairs = F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("C"), F.col("n_nationkey").cast("string")), F.col("n_nationkey") + F.lit(1.5))))
    good = n.groupBy().agg(pairs.alias("rates")).select(F.lit("second").alias("source"), F.to_json(F.struct("rates")).alias("body"))
    bad = n.groupBy().agg(pairs.alias("rates")).select(F.lit("first").alias("source"), F.to_json(F.struct(F.lit("error").alias("result"), "rates")).alias("body"))
    raw = good.unionByName(bad).withColumn("fetched_at", F.lit(B.AS_OF).cast("timestamp"))
    return ST.fx_rates(raw, {"first": 0, "second": 1}).select("currency", "rate")


# ------------------------------------------------------------ feeds

@query("feed_steam_specials", """
SELECT CASE WHEN o_custkey % 120 >= 100 THEN 'free-games' ELSE 'deals-steam' END AS feed, o_orderkey AS seq, CASE WHEN o_custkey % 120 >= 100 THEN 0.0::DOUBLE ELSE o_totalprice END AS price, c.slug AS slug_if_tracked
FROM orders LEFT JOIN (SELECT steam_app_id, max(slug) AS slug FROM v_catalog WHERE steam_app_id IS NOT NULL GROUP BY 1) c ON c.steam_app_id = 100000 + o_custkey
WHERE o_custkey % 120 > 0 AND o_orderstatus <> 'P'
""")
def feed_steam_specials(spark, d):
    o = B.table(spark, d, "orders")
    item = F.struct((F.lit(100000) + F.col("o_custkey")).alias("id"), F.col("o_orderkey").cast("string").alias("name"), (F.col("o_orderstatus") != "P").alias("discounted"),
                    (F.col("o_custkey") % 120).cast("int").alias("discount_percent"), cents("o_totalprice").alias("final_price"), cents("o_totalprice").alias("original_price"), F.lit(0).alias("discount_expiration"))
    raw = o.select(F.to_json(F.struct(F.struct(F.array(item).alias("items")).alias("specials"))).alias("body"))
    return FE.feed_steam_specials(raw, B.catalog(spark, d)).select("feed", F.col("title").cast("bigint").alias("seq"), "price", "slug_if_tracked")


@query("feed_epic_free", """
SELECT o_orderkey AS seq, CASE WHEN o_orderstatus = 'F' THEN 'free-now' ELSE 'upcoming' END AS status,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'https://store.epicgames.com/en-US/free-games' ELSE concat('https://store.epicgames.com/en-US/p/o', CAST(o_orderkey AS VARCHAR)) END AS url FROM orders WHERE o_orderstatus <> 'P'
""")
def feed_epic_free(spark, d):
    o, s = B.table(spark, d, "orders"), F.col("o_orderstatus")

    def groups(free):
        offer = lambda pct, end: F.struct(F.lit(end).alias("endDate"), F.struct(pct.cast("double").alias("discountPercentage")).alias("discountSetting"))
        return F.array(F.struct(F.array(offer(F.lit(50), "a"), offer(F.when(free, 0).otherwise(25), "b")).alias("promotionalOffers")))

    page = F.when(F.col("o_orderpriority") != "1-URGENT", F.concat(F.lit("o"), F.col("o_orderkey").cast("string")))
    e = F.struct(F.col("o_orderkey").cast("string").alias("title"), page.alias("productSlug"),
                 F.struct(F.struct(F.lit(1999).alias("originalPrice")).alias("totalPrice")).alias("price"),
                 F.struct(groups(s == "F").alias("promotionalOffers"), groups(s.isin("F", "O")).alias("upcomingPromotionalOffers")).alias("promotions"))
    body = F.to_json(F.struct(F.array(F.lit("partial")).alias("errors"), F.struct(F.struct(F.struct(F.array(e).alias("elements")).alias("searchStore")).alias("Catalog")).alias("data")))
    return FE.feed_epic_free(o.select(body.alias("body"))).select(F.col("title").cast("bigint").alias("seq"), "status", "url")


def eu_body(*fields):
    return F.to_json(F.struct(F.struct(F.array(F.struct(*fields)).alias("docs")).alias("response")))


def eu_id(key):
    return F.concat(F.lit("7001"), F.lpad((F.col(key) + 1000000).cast("string"), 10, "0"))


@query("feed_eu_discounts", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CASE WHEN l_tax > 0.04 THEN floor(l_discount*100 + 0.5::DOUBLE) ELSE floor((1 - low/l_extendedprice)*100 + 0.5::DOUBLE) END AS INT) AS pct, c.slug AS slug_if_tracked
FROM (SELECT *, floor(l_extendedprice*(1-l_discount)) AS low FROM lineitem) x
LEFT JOIN (SELECT nsuid_europe, max(slug) AS slug FROM v_catalog WHERE nsuid_europe IS NOT NULL GROUP BY 1) c ON c.nsuid_europe = concat('7001', lpad(CAST(l_partkey + 1000000 AS VARCHAR), 10, '0'))
WHERE low > 0 AND low < l_extendedprice
""")
def feed_eu_discounts(spark, d):
    li = B.table(spark, d, "lineitem").select(*LI)
    tag = F.concat_ws("|", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    body = eu_body(tag.alias("title"), F.array(F.lit("70050000000001"), eu_id("l_partkey")).alias("nsuid_txt"), F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("double").alias("price_discounted_f"),
                   F.col("l_extendedprice").alias("price_regular_f"), F.when(F.col("l_tax") > 0.04, F.col("l_discount") * 100).alias("price_discount_percentage_f"))
    out = FE.feed_eu_discounts(li.select(body.alias("body")), B.catalog(spark, d))
    part = lambda i, t: F.split_part("title", F.lit("|"), F.lit(i)).cast(t)
    return out.select(part(1, "bigint").alias("l_orderkey"), part(2, "int").alias("l_linenumber"), part(3, "bigint").alias("l_partkey"), part(4, "bigint").alias("l_suppkey"), "pct", "slug_if_tracked")


@query("feed_store_deals", """
SELECT o_orderkey AS seq, o_totalprice AS price, CAST(o_custkey % 110 AS INT) AS pct, CASE WHEN o_custkey % 30 < 25 THEN concat('nation-', CAST(o_custkey % 30 AS VARCHAR)) ELSE concat('store-', CAST(o_custkey % 30 AS VARCHAR)) END AS store_id
FROM orders WHERE o_orderstatus <> 'P' AND o_custkey % 110 BETWEEN 1 AND 100
""")
def feed_store_deals(spark, d):
    o = B.table(spark, d, "orders")
    deal = F.struct(F.col("o_orderkey").cast("string").alias("title"), (F.col("o_custkey") % 30).cast("string").alias("storeID"), F.lit("x").alias("dealID"),
                    F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("salePrice"),
                    F.lit("99.5").alias("normalPrice"), (F.col("o_custkey") % 110).cast("string").alias("savings"), F.lit(None).cast("string").alias("steamAppID"))
    store = F.struct(F.col("n_nationkey").cast("string").alias("storeID"), F.initcap(F.replace(F.col("n_name"), F.lit("_"), F.lit(" "))).alias("storeName"), F.lit(1).alias("isActive"))
    stores = FE.store_names(B.table(spark, d, "nation").select(F.to_json(F.array(store)).alias("body")))
    return FE.feed_store_deals(o.select(F.to_json(F.array(deal)).alias("body")), stores, B.catalog(spark, d)).select(F.col("title").cast("bigint").alias("seq"), "price", "pct", "store_id")


@query("steam_calendar", """
SELECT o_orderkey AS seq, CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS date, strftime(o_orderdate, '%Y-%m') AS month
FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' AND o_custkey % 7 <> 0
""")
def steam_calendar(spark, d):
    o, p = B.table(spark, d, "orders"), F.col("o_orderpriority")
    when = (F.when(p == "1-URGENT", F.date_format("o_orderdate", "d MMM, yyyy")).when(p == "2-HIGH", F.date_format("o_orderdate", "MMMM d, yyyy"))
            .when(p == "5-LOW", "Q4 2026").otherwise(F.date_format("o_orderdate", "MMMM yyyy")))
    name = F.concat(F.when(F.col("o_custkey") % 7 == 0, "Demo ").otherwise(""), F.col("o_orderkey").cast("string"))
    data = F.struct(name.alias("name"), F.when(F.col("o_orderstatus") == "P", "dlc").otherwise("game").alias("type"), F.struct(F.lit(True).alias("coming_soon"), when.alias("date")).alias("release_date"))
    body = F.to_json(F.create_map(F.col("o_orderkey").cast("string"), F.struct(data.alias("data"))))
    return FE.steam_calendar(o.select(body.alias("body")), B.catalog(spark, d)).select(F.col("title").cast("bigint").alias("seq"), "date", "month")


@query("eu_calendar", """
SELECT o_orderkey AS seq, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, strftime(o_orderdate, '%Y-%m') AS month, c.slug AS slug_if_tracked
FROM orders LEFT JOIN (SELECT nsuid_europe, max(slug) AS slug FROM v_catalog WHERE nsuid_europe IS NOT NULL GROUP BY 1) c ON c.nsuid_europe = concat('7001', lpad(CAST(o_custkey + 1000000 AS VARCHAR), 10, '0'))
WHERE o_orderstatus <> 'P'
""")
def eu_calendar(spark, d):
    o = B.table(spark, d, "orders")
    stamp = F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit("T00:00:00Z"))
    body = eu_body(F.col("o_orderkey").cast("string").alias("title"), F.array(eu_id("o_custkey")).alias("nsuid_txt"), F.when(F.col("o_orderstatus") != "P", F.array(stamp)).alias("dates_released_dts"))
    return FE.eu_calendar(o.select(body.alias("body")), B.catalog(spark, d)).select(F.col("title").cast("bigint").alias("seq"), "date", "month", "slug_if_tracked")


@query("outside_lows", """
SELECT CAST(o_orderkey AS VARCHAR) AS game_id, o_totalprice AS usd, CASE WHEN o_custkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END AS date FROM orders WHERE o_orderstatus <> 'P'
""")
def outside_lows(spark, d):
    o = B.table(spark, d, "orders")
    low = F.struct(F.when(F.col("o_orderstatus") == "P", "0").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("price"),
                   F.when(F.col("o_custkey") % 5 == 0, 0).otherwise(F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint") * 86400).alias("date"))
    return FE.outside_lows(o.select(F.to_json(F.create_map(F.col("o_orderkey").cast("string"), F.struct(low.alias("cheapestPriceEver")))).alias("body")))


@query("outside_game_ids", """
SELECT CAST(o_orderkey AS VARCHAR) AS app, concat('g', CAST(o_custkey AS VARCHAR)) AS game_id FROM orders WHERE o_orderstatus <> 'P'
""")
def outside_game_ids(spark, d):
    o = B.table(spark, d, "orders")
    hit = F.struct(F.concat(F.lit("g"), F.col("o_custkey").cast("string")).alias("gameID"), F.when(F.col("o_orderstatus") == "P", "other").otherwise(F.col("o_orderkey").cast("string")).alias("steamAppID"))
    near = F.struct(F.lit("near").alias("gameID"), F.lit("0x").alias("steamAppID"))
    return FE.outside_game_ids(o.select(F.col("o_orderkey").cast("string").alias("key"), F.to_json(F.array(near, hit)).alias("body")))


# ------------------------------------------------------------ meta

@query("steam_meta", """
SELECT slug, title AS name, CAST(review_count AS BIGINT) AS review_count, CASE WHEN review_count > 1000 THEN CAST(floor((review_count - 700) / review_count::DOUBLE * 100 + 0.5::DOUBLE) AS INT) ELSE 0 END AS review_percent, tier AS genre
FROM v_catalog WHERE steam_app_id IS NOT NULL AND steam_app_id NOT IN (SELECT steam_app_id FROM v_catalog WHERE steam_app_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
""")
def steam_meta(spark, d):
    cat = B.catalog(spark, d).where(F.col("steam_app_id").isNotNull())
    once = cat.groupBy("steam_app_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == 1).select("steam_app_id")
    cat = cat.join(once, "steam_app_id", "left_semi")
    details = cat.select(F.to_json(F.create_map(F.col("steam_app_id").cast("string"), F.struct(F.struct(
        F.col("title").alias("name"), F.array(F.struct(F.col("tier").alias("description"))).alias("genres")).alias("data")))).alias("body"))
    good = F.when(F.col("review_count") > 1000, F.col("review_count") - 700).otherwise(0)
    reviews = cat.select(F.col("steam_app_id").cast("string").alias("key"), F.to_json(F.struct(F.struct(
        F.col("review_count").alias("total_reviews"), good.alias("total_positive")).alias("query_summary"))).alias("body"))
    return ME.steam_meta(details, reviews, cat).select("slug", "name", "review_count", "review_percent", F.try_element_at("genres", F.lit(1)).alias("genre"))


@query("eu_meta", """
SELECT slug, upper(title) AS name, tier = 'core' AS coming_soon FROM v_catalog WHERE nsuid_europe IS NOT NULL AND tier <> 'other' AND header_image IS NOT NULL
""")
def eu_meta(spark, d):
    cat = B.catalog(spark, d).where(F.col("nsuid_europe").isNotNull())
    body = eu_body(F.upper("title").alias("title"), F.when(F.col("tier") == "other", "DLC").otherwise("GAME").alias("type"), F.array("nsuid_europe").alias("nsuid_txt"),
                   F.when(F.col("header_image").isNotNull(), F.lit("https://www.nintendo.com/eu/a.jpg")).otherwise("https://cdn.example/a.jpg").alias("image_url"),
                   F.array(F.when(F.col("tier") == "core", "2001-07-01T00:00:00Z").otherwise("2000-07-01T00:00:00Z")).alias("dates_released_dts"))
    return ME.eu_meta(cat.select(F.col("slug").alias("key"), body.alias("body")), cat, B.AS_OF).select("slug", "name", "coming_soon")


@query("sitemap_products", """
SELECT DISTINCT nintendo_us_slug AS product_slug, concat('https://www.nintendo.com/us/store/products/', nintendo_us_slug, '/') AS url FROM v_catalog WHERE nintendo_us_slug IS NOT NULL AND tier <> 'other'
""")
def sitemap_products(spark, d):
    cat = B.catalog(spark, d).where(F.col("nintendo_us_slug").isNotNull())
    loc = F.concat(F.when(F.col("tier") == "other", "https://elsewhere.example").when(F.col("tier") == "core", "https://nintendo.com").otherwise("https://www.nintendo.com"),
                   F.lit("/us/store/products/"), "nintendo_us_slug", F.when(F.col("tier") == "core", "/?a=1&amp;b=2").otherwise("/"))
    xml = cat.select(F.concat(F.lit("<urlset><url><loc> "), loc, F.lit(" </loc></url><url><loc>https://www.nintendo.com/us/</loc></url></urlset>")).alias("body"))
    return ME.sitemap_products(xml)


# ------------------------------------------------------------ rankings

@query("search_ranks", """
WITH j AS (SELECT l_orderkey * 1000000000 + page * 25 AS start, l_orderkey * 1000000000 + k + 1 AS rank, CASE WHEN l_quantity = 1 THEN NULL ELSE l_partkey + 1 END AS app_id, CASE WHEN l_quantity = 3 THEN '' ELSE concat('A & B ', CAST(l_partkey AS VARCHAR)) END AS title,
   CASE WHEN l_quantity = 1 THEN 'missing_single_appid' WHEN l_quantity = 2 THEN 'appid_href_mismatch' WHEN l_quantity = 3 THEN 'missing_title' END AS why FROM {numbered}),
 s AS (SELECT start, count(*) AS n, count(why) AS bad FROM j GROUP BY 1)
SELECT j.start, rank, app_id, title, CASE WHEN n >= 5 AND bad > n * 0.2 THEN 'page_structure_drift' ELSE why END AS reason FROM j JOIN s ON j.start = s.start
""".replace("{numbered}", NUMBERED))
def search_ranks(spark, d):
    q, key = F.col("l_quantity"), F.col("l_partkey").cast("string")
    app = (F.col("l_partkey") + 1).cast("string")
    row = F.concat(F.lit('<a href="https://s.example/'), F.when(q == 1, "bundle/9").when(q == 2, "app/999999999/x").otherwise(F.concat(F.lit("app/"), app, F.lit("/x"))), F.lit('" class="search_result_row ds"'),
                   F.when(q == 1, "").otherwise(F.concat(F.lit(' data-ds-appid="'), app, F.lit('"'))), F.lit('><div><span class="title">'),
                   F.when(q == 3, "").otherwise(F.concat(F.lit("A &amp; B "), key)), F.lit("</span></div></a>"))
    pages = line_pages(spark, d, row)
    start = F.col("l_orderkey") * F.lit(1000000000) + F.col("page") * PAGE_ROWS
    html = F.concat(F.lit('<a class="nav">skip</a>'), F.array_join(F.transform("xs", lambda x: x["cell"]), "\n"))
    body = F.to_json(F.struct(F.lit(1).alias("success"), F.lit(1000000000).alias("total_count"), html.alias("results_html"), start.alias("start")))
    return RA.search_ranks(pages.select(start.cast("string").alias("key"), body.alias("body")))


@query("featured_ranks", """
WITH r AS (SELECT concat(CAST(l_orderkey AS VARCHAR), '-', CAST(page AS VARCHAR)) AS k, CAST(k % 25 + 1 AS INT) AS rank, l_linenumber AS app_id, CASE WHEN l_quantity = 50 THEN 'Other' WHEN l_quantity = 1 THEN '' ELSE 'Game' END AS title FROM {numbered}),
 p AS (SELECT k, app_id, min(rank) AS first, count(DISTINCT title) > 1 AS conflict FROM r WHERE title <> '' GROUP BY 1, 2)
SELECT r.k AS key, rank, CAST(r.app_id AS BIGINT) AS app_id, title, CASE WHEN title = '' THEN 'invalid_featured_item' WHEN conflict THEN 'title_conflict' WHEN rank > first THEN 'duplicate_featured_appid' END AS reason
FROM r LEFT JOIN p ON r.k = p.k AND r.app_id = p.app_id
""".replace("{numbered}", NUMBERED))
def featured_ranks(spark, d):
    q = F.col("l_quantity")
    lists = line_pages(spark, d, F.when(q == 50, "Other").when(q == 1, "").otherwise("Game"))
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("page").cast("string"))
    items = F.transform("xs", lambda x: F.struct(x["l_linenumber"].cast("bigint").alias("id"), x["cell"].alias("name")))
    body = F.to_json(F.struct(F.struct(items.alias("items")).alias("top_sellers")))
    return RA.featured_ranks(lists.select(key.alias("key"), body.alias("body")))


@query("most_played", """
SELECT CAST(o_orderkey AS VARCHAR) AS key, o_custkey + 1 AS app_id, CASE WHEN epoch(o_orderdate) - epoch(TIMESTAMP '2001-06-01') > 300 THEN 'future_rollup_date'
  WHEN epoch(TIMESTAMP '2001-06-01') - epoch(o_orderdate) > 14 * 86400 THEN 'stale_rollup_date' END AS reason FROM orders WHERE o_orderstatus <> 'P'
""")
def most_played(spark, d):
    o = B.table(spark, d, "orders")
    secs = F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint") * 86400
    stamp = F.when(F.col("o_custkey") % 2 == 0, secs * 1000).otherwise(secs)
    rank = F.struct(F.when(F.col("o_orderstatus") == "P", 0).otherwise(1).alias("rank"), (F.col("o_custkey") + 1).alias("appid"), F.lit(5).alias("peak_in_game"))
    body = F.to_json(F.struct(F.struct(stamp.alias("rollup_date"), F.array(rank).alias("ranks")).alias("response")))
    return RA.most_played(o.select(F.col("o_orderkey").cast("string").alias("key"), body.alias("body")), B.AS_OF).select("key", "app_id", "reason")


@query("ir_sales_rows", """
SELECT concat('https://ir.example/', CAST(l_orderkey AS VARCHAR), '-', CAST(page AS VARCHAR)) AS final_url, CAST(k % 25 + 1 AS INT) AS rank,
  CASE WHEN l_quantity = 2 THEN concat('One / Two ', CAST(l_partkey AS VARCHAR)) ELSE concat('Title ', CAST(l_partkey AS VARCHAR)) END AS title,
  CASE WHEN l_quantity = 1 THEN NULL ELSE l_quantity + 0.25::DOUBLE END AS units_millions, CASE WHEN l_orderkey % 2 = 0 THEN 'switch' ELSE 'switch-2' END AS platform,
  CASE WHEN l_quantity = 1 THEN 'row_structure_changed' WHEN l_quantity = 2 THEN 'combined_title_row_requires_explicit_product_evidence' END AS reason FROM {numbered} WHERE l_orderkey % 10 <> 3
""".replace("{numbered}", NUMBERED))
def ir_sales_rows(spark, d):
    q, key = F.col("l_quantity"), F.col("l_partkey").cast("string")
    row = F.concat(F.lit('<li class="sales_layout_list x"><p class="sales_title">'), F.when(q == 2, F.concat(F.lit("One / Two "), key)).otherwise(F.concat(F.lit("<b>Title</b> "), key)),
                   F.lit('</p><p class="sales_value">'), F.when(q == 1, "n/a").otherwise(F.concat(F.lit("<span>"), q.cast("int").cast("string"), F.lit(".25</span> million pcs."))), F.lit("</p></li>"))
    pages = line_pages(spark, d, row)
    url = F.concat(F.lit("https://ir.example/"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("page").cast("string"))
    head = F.concat(F.lit('<meta property="og:url" content="'), url, F.when(F.col("l_orderkey") % 10 == 3, "/other").otherwise("/"), F.lit('"><div class="sales_hard"><img alt="Nintendo Switch'),
                    F.when(F.col("l_orderkey") % 2 == 0, "").otherwise(" 2"), F.lit(' software"></div>'))
    return RA.ir_sales_rows(pages.select(url.alias("final_url"), F.concat(head, F.array_join(F.transform("xs", lambda x: x["cell"]), "")).alias("body")))


# ------------------------------------------------------------ consoles

@query("psn_search_tiles", """
SELECT slug AS key, concat('UP0001-PPSA', lpad(CAST(p_partkey AS VARCHAR), 8, '0'), '-GAME', lpad(CAST(p_partkey AS VARCHAR), 12, '0')) AS product_id, concat(title, ' PS5') AS matched_title, 2 AS place
FROM (SELECT concat(title, ' ', CAST(p_partkey AS VARCHAR)) AS slug, title || ' ' || CAST(p_partkey AS VARCHAR) AS title, p_partkey, tier FROM v_catalog) x WHERE tier <> 'other'
""")
def psn_search_tiles(spark, d):
    cat = B.spread(B.catalog(spark, d).select("p_partkey", "title", "tier"), "p_partkey")
    title = F.concat_ws(" ", "title", F.col("p_partkey").cast("string"))
    pid = F.concat(F.lit("UP0001-PPSA"), F.lpad(F.col("p_partkey").cast("string"), 8, "0"), F.lit("-GAME"), F.lpad(F.col("p_partkey").cast("string"), 12, "0"))

    def tile(name, index):
        meta = F.replace(F.to_json(F.struct(pid.alias("id"), name.alias("name"), F.lit(index).alias("index"), title.alias("searchTerm"))), F.lit('"'), F.lit("&quot;"))
        href = F.concat(F.lit("/en-us/product/"), F.when(F.col("tier") == "other", F.lit("UP9999-PPSA00000000-GAME000000000000")).otherwise(pid))
        return F.concat(F.lit('<a data-track-content="web:store:product-tile" href="'), href, F.lit('" data-telemetry-meta="'), meta, F.lit('"><i>x</i></a>'))

    body = F.concat(tile(F.concat(title, F.lit(" Deluxe")), 0), F.lit('<a href="/help">h</a>'), tile(F.concat(title, F.lit(" PS5")), 5), tile(F.concat(title, F.lit(" PS5")), 2))
    return CO.psn_search_tiles(cat.select(title.alias("key"), body.alias("body")))


@query("xbox_calendar_cards", """
WITH r AS (SELECT l_orderkey * 1000000000 + page * 25 AS skip, l_partkey, l_quantity, k FROM {numbered})
SELECT skip, concat('9N', lpad(CAST(l_partkey AS VARCHAR), 10, '0')) AS big_id, concat('Game ', CAST(l_partkey AS VARCHAR)) AS title, CAST(k % 25 AS INT) AS position
FROM r WHERE skip NOT IN (SELECT skip FROM r GROUP BY 1 HAVING count(*) <> count(DISTINCT l_partkey) OR max(l_quantity) = 50)
""".replace("{numbered}", NUMBERED))
def xbox_calendar_cards(spark, d):
    pages = line_pages(spark, d, F.lit(None).cast("string"))
    key = lambda x: x["l_partkey"].cast("string")
    card = lambda x, i: F.concat(
        F.lit('<div data-bi-hn="Games coming soon" data-bi-ct="Product Card" data-bi-compnm="Product Cards: Games" data-bi-pid="9n'), F.lpad(key(x), 10, "0"),
        F.lit('" data-bi-prdname="Game '), key(x), F.lit('" data-bi-carpos="'), i.cast("string"), F.lit('">c</div>'))
    skip = F.col("l_orderkey") * F.lit(1000000000) + F.col("page") * PAGE_ROWS
    n = F.size("xs")
    shown = F.concat(F.lit("<p>Showing "), (skip + 1).cast("string"), F.lit(" - "), (skip + n).cast("string"), F.lit(" of "),
                     F.when(F.col("q") == 50, skip + n + 1).otherwise(skip + n).cast("string"), F.lit(" items</p><!-- Showing 1 - 2 of 3 items -->"))
    body = F.concat(shown, F.array_join(F.transform("xs", card), ""))
    return CO.xbox_calendar_cards(pages.select(skip.cast("string").alias("key"), body.alias("body")))[0].select("skip", "big_id", "title", "position")


# ------------------------------------------------------------ files

@query("snapshot_documents", """
SELECT channel, slug, CAST(count(*) AS INT) AS n, min(cc) AS first_cc, max(cc) AS last_cc FROM v_latest GROUP BY 1, 2
""")
def snapshot_documents(spark, d):
    doc = FI.snapshot_documents(B.latest(spark, d))
    return doc.select("channel", "slug", F.size("regions").alias("n"), F.try_element_at("regions", F.lit(1))["cc"].alias("first_cc"), F.try_element_at("regions", F.lit(-1))["cc"].alias("last_cc"))


@query("guard_cell", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN concat('''=', o_orderpriority) WHEN o_orderstatus = 'O' THEN concat(''' -', o_orderpriority) ELSE o_orderpriority END AS cell FROM orders
""")
def guard_cell(spark, d):
    s = F.col("o_orderstatus")
    text = F.concat(F.when(s == "F", "=").when(s == "O", " -").otherwise(""), "o_orderpriority")
    return B.table(spark, d, "orders").select("o_orderkey", text.alias("t")).select("o_orderkey", FI.guard_cell("t").alias("cell"))


@query("explode_plans", """
SELECT concat('o', CAST(l_orderkey AS VARCHAR)) AS name, count(*) AS n_rows, min(l_extendedprice) AS low_usd, count(*) FILTER (WHERE l_discount > 0) AS n_sale
FROM (SELECT DISTINCT ON (l_orderkey, l_linenumber) * FROM lineitem ORDER BY l_orderkey, l_linenumber, l_extendedprice, l_discount) x GROUP BY 1
""")
def explode_plans(spark, d):
    li = B.table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min(F.struct("l_extendedprice", "l_discount")).alias("m"))
    usd = F.concat(F.lit("$"), F.col("m.l_extendedprice").cast("decimal(18,2)").cast("string"))
    plan = F.struct(F.lit("x").alias("local"), usd.alias("usd"), F.lit("$99").alias("listUsd"), F.floor(F.col("m.l_discount") * 100 + 0.5).cast("int").alias("discountPct"))
    docs = li.groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(F.struct(F.col("l_linenumber").cast("string"), plan))).alias("prices"))
    region = F.struct(F.lit("US").alias("countryCode"), F.col("prices"), F.create_map(F.lit("1"), F.lit("USD")).alias("currency"))
    shaped = docs.select(F.struct(F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("name")).alias("app"), F.array(region).alias("regions"))
    return FI.explode_plans(shaped).groupBy("name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("usd").alias("low_usd"), F.count("discount_pct").alias("n_sale"))
