"""Checked queries over the page parsers and the file round trips.

Every part becomes a product page in the shape the stores render, with faults
chosen by its size.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import consoles as CO
from ..sources import files as FI
from ..sources import meta as ME
from ..sources import stores as ST
from . import bindings as B
from .candidate_queries import decided, state
from .registry import query, view
from .stream_queries import workspace


def key_text():
    return F.col("p_partkey").cast("string")


def title_col():
    return F.concat_ws(" ", "p_name", key_text())


def psn_id():
    return F.concat(F.lit("UP0001-PPSA"), F.lpad(key_text(), 8, "0"), F.lit("-GAME"), F.lpad(key_text(), 12, "0"))


def script(attrs, body):
    return F.concat(F.lit(f"<script {attrs} type=\"application/json\">"), body, F.lit("</script>"))


def next_page(props):
    return F.concat(F.lit("<html><body>"), script('id="__NEXT_DATA__"', F.replace(F.to_json(F.struct(props.alias("props"))), F.lit("</"), F.lit("\\u003c/"))), F.lit("</body></html>"))


def env_fragment(cache):
    return F.struct(F.concat(F.lit("<div></div>"), script('id="env:x"', F.to_json(F.struct(cache.alias("cache"))))).alias("text"))


def ref(value):
    return F.struct(value.alias("__ref"))


def product(size, *extra):
    pid = psn_id()
    consoles = F.when(size == 3, F.array(F.lit("PSVITA"))).otherwise(F.array(F.lit("PS5"), F.lit("PS4")))
    return F.struct(
        F.lit("Product").alias("__typename"), pid.alias("id"), F.concat(title_col(), F.lit(" PS4 & PS5")).alias("name"), title_col().alias("invariantName"),
        F.lit("GAME").alias("topCategory"), F.when(size == 1, "ADD_ON").otherwise("FULL_GAME").alias("storeDisplayClassification"),
        F.struct(F.when(size == 2, "DELUXE").otherwise("STANDARD").alias("type"), F.lit("Standard").alias("name")).alias("edition"), consoles.alias("platforms"), *extra)


def psn_cta(size, cents_col, kind):
    plus = kind == "plus"
    price = F.struct(
        cents_col.alias("discountedValue"), F.floor(F.col("p_retailprice") * 100 + 0.5).cast("bigint").alias("basePriceValue"), F.when(size == 4, "EUR").otherwise("USD").alias("currencyCode"),
        F.lit(False).alias("isFree"), F.lit("UPSELL" if plus else "APPLICABLE").alias("applicability"), F.array(F.lit("PS_PLUS" if plus else "NONE")).alias("serviceBranding"),
        F.array().cast("array<string>").alias("qualifications"), F.lit(plus).alias("isExclusive"), F.lit(plus).alias("isTiedToSubscription"),
        F.when(size == 5, "946684800000").otherwise("1900000000000").alias("endTime"))
    param = F.array(F.struct(F.lit("skuId").alias("name"), F.lit("S1").alias("value")), F.struct(F.lit("rewardId").alias("name"), F.lit("OUTRIGHT").alias("value")))
    name = "UPSELL_TRIAL" if kind == "trial" else "ADD_TO_CART"
    return F.struct(
        F.lit("GameCTA").alias("__typename"), F.lit(kind).alias("id"), F.lit(name).alias("type"), F.struct(F.lit(name).alias("type"), param.alias("param")).alias("action"),
        F.struct(F.lit("purchase").alias("ctaType")).alias("local"), F.struct(F.lit("PLUS" if plus else "NONE").alias("upSellService"), F.lit(plus).alias("exclusive")).alias("meta"), price.alias("price"))


def psn_pages(spark, d):
    p, s = B.landed(spark, d, "part", "p_partkey"), F.col("p_size")
    full = F.floor(F.col("p_retailprice") * 100 + 0.5).cast("bigint")
    sale = F.when(s > 25, F.floor(full * 0.75)).otherwise(full).cast("bigint")
    ctas = F.array(ref(F.lit("cta1")), ref(F.lit("cta2")), ref(F.lit("cta3")))
    view_a = product(s, F.lit("GAME").alias("type"))
    view_b = product(s, F.array(ref(F.lit("Sku:S1"))).alias("skus"), ctas.alias("webctas"), ref(F.concat(F.lit("Concept:"), F.lpad(key_text(), 8, "0"))).alias("concept"))
    sku = F.struct(F.lit("Sku").alias("__typename"), F.lit("S1").alias("id"), F.when(s == 6, "Demo").otherwise("Game").alias("name"))
    # entities of one cache differ in shape, so each map entry is text of its own
    entry = lambda k, e: F.concat(F.to_json(F.create_map(k, e)))
    joined = lambda *parts: F.concat(F.lit("{"), F.concat_ws(",", *[x.substr(F.lit(2), F.length(x) - 2) for x in parts]), F.lit("}"))
    prod_key = F.concat(F.lit("Product:"), psn_id())
    cache_a = joined(entry(prod_key, view_a))
    cache_b = joined(entry(prod_key, view_b), entry(F.lit("Sku:S1"), sku), entry(F.lit("cta1"), psn_cta(s, sale, "cash")),
                     entry(F.lit("cta2"), psn_cta(s, F.floor(full * 0.5).cast("bigint"), "plus")), entry(F.lit("cta3"), psn_cta(s, full, "trial")))
    # the second price fragment of size 7 disagrees
    other = joined(entry(prod_key, view_b), entry(F.lit("Sku:S1"), sku), entry(F.lit("cta1"), psn_cta(s, F.when(s == 7, F.floor(full * 0.4).cast("bigint")).otherwise(sale), "cash")))
    frag = lambda c: F.struct(F.concat(script('id="env:x"', F.concat(F.lit('{"args":{},"cache":'), c, F.lit("}")))).alias("text"))
    bat = F.create_map(F.lit("info"), frag(cache_a), F.lit("cta"), frag(cache_b), F.lit("more"), frag(other))
    props = F.struct(F.struct(F.when(s == 8, "de-de").otherwise("en-us").alias("locale"), psn_id().alias("productId"), bat.alias("batarangs")).alias("pageProps"))
    url = F.concat(F.lit("https://store.playstation.com/en-us/"), F.when(s == 9, "home/").otherwise("product/"), psn_id())
    return p.select(psn_id().alias("key"), url.alias("final_url"), next_page(props).alias("body"))


@query("psn_prices", """
SELECT concat('p', CAST(p_partkey AS VARCHAR)) AS slug, CASE WHEN p_size > 25 THEN floor(floor(c * 0.75::DOUBLE)/100*100 + 0.5::DOUBLE)/100.0::DOUBLE ELSE floor(c/100*100 + 0.5::DOUBLE)/100.0::DOUBLE END AS amount,
  CASE WHEN p_size > 25 THEN floor(c/100*100 + 0.5::DOUBLE)/100.0::DOUBLE END AS list_amount, lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS concept_id, 'ps4,ps5' AS platforms,
  floor(floor(c * 0.5::DOUBLE)/100*100 + 0.5::DOUBLE)/100.0::DOUBLE AS plus_amount, CAST(1 AS BIGINT) AS excluded_trials
FROM (SELECT *, floor(p_retailprice*100 + 0.5::DOUBLE) AS c FROM part) x WHERE p_size > 9
""")
def psn_prices(spark, d):
    cat = B.table(spark, d, "part").select(F.concat(F.lit("p"), key_text()).alias("slug"), title_col().alias("title"), psn_id().alias("psn_product_id"))
    return ST.psn_prices(psn_pages(spark, d), cat, B.AS_OF).select(
        "slug", "amount", "list_amount", "concept_id", F.array_join("platforms", ",").alias("platforms"), "plus_amount", "excluded_trials")


# ------------------------------------------------------------ dated console pages

def dated_pages(spark, d):
    p, s = B.landed(spark, d, "part", "p_partkey"), F.col("p_size")
    day = lambda shift: F.concat(F.date_add(F.lit("2001-06-01").cast("date"), s + shift).cast("string"), F.lit("T00:00:00Z"))
    art = F.array(F.struct(F.lit("IMAGE").alias("type"), F.lit("MASTER").alias("role"), F.lit("https://image.api.playstation.com/a.png").alias("url")))
    name = F.when(s == 1, F.concat(title_col(), F.lit(" Deluxe"))).otherwise(F.concat(title_col(), F.lit(" - Standard Edition")))
    view_ = lambda *extra: F.struct(
        F.lit("Product").alias("__typename"), psn_id().alias("id"), name.alias("name"), F.array(F.lit("PS5"), F.lit("PS4")).alias("platforms"), art.alias("media"), *extra)
    a = view_(day(0).alias("releaseDate"), F.lit("GAME").alias("topCategory"), F.lit("FULL_GAME").alias("storeDisplayClassification"))
    b = view_(F.when(s == 2, day(1)).when(s == 3, None).otherwise(day(0)).alias("releaseDate"), F.lit("GAME").alias("type"))
    cache = lambda e: env_fragment(F.create_map(F.concat(F.lit("Product:"), psn_id()), e))
    bat = F.map_from_arrays(F.array(F.lit("a"), F.lit("b")), F.array(cache(a), cache(b)))
    props = F.struct(F.struct(F.lit("en-us").alias("locale"), psn_id().alias("productId"), bat.alias("batarangs")).alias("pageProps"))
    label = F.when(s == 4, "1/2/2003").otherwise(F.date_format(F.date_add(F.lit("2001-06-01").cast("date"), s), "M/d/yyyy"))
    body = F.concat(next_page(props), F.lit('<span data-qa="gameInfo#releaseInformation#releaseDate-value">'), label, F.lit("</span>"))
    return p.select(psn_id().alias("key"), F.concat(F.lit("https://store.playstation.com/en-us/product/"), psn_id()).alias("final_url"), body.alias("body"))


@query("psn_calendar_entries", """
SELECT concat(p_name, ' ', CAST(p_partkey AS VARCHAR)) AS title, CAST(DATE '2001-06-01' + p_size AS VARCHAR) AS date, strftime(DATE '2001-06-01' + p_size, '%Y-%m') AS month FROM part WHERE p_size > 5
""")
def psn_calendar_entries(spark, d):
    s = F.col("p_size")
    cands = B.table(spark, d, "part").select(
        psn_id().alias("product_id"), title_col().alias("raw_title"), title_col().alias("title"),
        F.when(s == 5, F.array(F.lit("ps5"))).otherwise(F.array(F.lit("ps4"), F.lit("ps5"))).alias("platforms"), F.lit(None).cast("string").alias("image"))
    return CO.psn_calendar_entries(dated_pages(spark, d), cands).select("title", "date", "month")


@query("psn_preorder_pages", """
SELECT CAST(p_partkey + 1 AS INT) AS page, concat('UP0001-PPSA', lpad(CAST(p_partkey AS VARCHAR), 8, '0'), '-GAME', lpad(CAST(p_partkey AS VARCHAR), 12, '0')) AS product_id, p_size NOT IN (3, 4, 5, 6) AS candidate FROM part WHERE p_size NOT IN (1, 2, 7)
""")
def psn_preorder_pages(spark, d):
    """A category of one-row pages, a page per part."""
    p, s = B.landed(spark, d, "part", "p_partkey"), F.col("p_size")
    total = B.table(spark, d, "part").agg(F.count(F.lit(1)).cast("int").alias("total")).withColumn("k", F.lit(1))
    p = p.withColumn("k", F.lit(1)).join(F.broadcast(total), "k")
    row = F.col("p_partkey").cast("int")
    grid = F.struct(
        F.lit("cat").alias("id"), F.struct(F.lit("productReleaseDate").alias("name"), F.lit(False).alias("isAscending")).alias("sortedBy"),
        F.struct(F.when(s == 1, row + 5).otherwise(row).alias("offset"), F.lit(1).alias("size"), F.col("total").alias("totalCount"), (row == F.col("total") - 1).alias("isLast")).alias("pageInfo"),
        F.when(s == 2, F.array().cast("array<struct<__ref:string>>")).otherwise(F.array(ref(F.concat(F.lit("Product:"), psn_id(), F.lit(":en-us"))))).alias("products"))
    item = F.struct(
        psn_id().alias("id"), F.concat(title_col(), F.when(s == 3, " Gold Edition").otherwise("")).alias("name"), F.when(s == 4, "BUNDLE").otherwise("FULL_GAME").alias("storeDisplayClassification"),
        F.when(s == 5, F.array(F.lit("PS3"))).otherwise(F.array(F.lit("PS5"))).alias("platforms"), F.array(F.struct(F.when(s == 6, "STANDARD").otherwise("PREORDER").alias("type"))).alias("skus"),
        F.struct(F.concat(F.lit("PRODUCT:"), F.when(s == 7, "none").otherwise(psn_id())).alias("interactLink")).alias("telemetryData"))
    inner = lambda k, e: F.to_json(F.create_map(k, e))
    grid_json = inner(F.concat(F.lit("CategoryGrid:cat:en-us:"), row.cast("string"), F.lit(":1")), grid)
    item_json = inner(F.concat(F.lit("Product:"), psn_id(), F.lit(":en-us")), item)
    state_json = F.concat(grid_json.substr(F.lit(1), F.length(grid_json) - 1), F.lit(","), item_json.substr(F.lit(2), F.length(item_json)))
    props = F.to_json(F.struct(F.lit("en-us").alias("locale"), F.lit("cat").alias("categoryId"), (row + 1).alias("page"), F.lit(200).alias("statusCode")))
    doc = F.concat(F.lit('{"props":{"pageProps":'), props, F.lit(',"apolloState":'), state_json, F.lit("}}"))
    body = F.concat(F.lit("<html>"), script('id="__NEXT_DATA__"', doc), F.lit("</html>"))
    return CO.psn_preorder_pages(p.select((row + 1).cast("string").alias("key"), body.alias("body")), "cat", 1)[0].select("page", "product_id", "candidate")


# ------------------------------------------------------------ display catalog releases

LADDER = {
    1: "not_game", 2: "us_localized_product_missing", 3: "listed_title_mismatch", 4: "non_base_game_title", 5: "us_release_date_missing_or_invalid",
    6: "no_full_preorder_sku", 7: "bundle_requires_manual_resolution", 8: "ambiguous_direct_preorder_sku", 9: "sku_title_mismatch", 10: "xbox_package_missing",
    11: "sku_release_date_mismatch", 12: "no_current_public_us_purchase", 13: "hero_image_missing_or_invalid", 14: "product_missing_or_invalid",
}


@query("xbox_calendar_entries", "SELECT '9N' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS xbox_big_id, CASE p_size "
       + " ".join(f"WHEN {k} THEN '{v}'" for k, v in LADDER.items()) + " END AS reason, CASE WHEN p_size > 14 THEN '2001-09-15' END AS date FROM part")
def xbox_calendar_entries(spark, d):
    p, s = B.landed(spark, d, "part", "p_partkey"), F.col("p_size")
    big = F.concat(F.lit("9N"), F.lpad(key_text(), 10, "0"))
    name = F.concat(title_col(), F.when(s == 4, " DLC").otherwise(""))
    us = F.array(F.lit("US"), F.lit("CA"))
    image = F.struct(F.lit("SuperHeroArt").alias("ImagePurpose"), F.lit(1920.0).alias("Width"), F.lit(1080.0).alias("Height"),
                     F.when(s == 13, "https://cdn.example/a").otherwise("//store-images.s-microsoft.com/image/apps.1").alias("Uri"))
    local = lambda field, value: F.array(F.struct(us.alias("Markets"), F.when(s == 2, "fr").otherwise("en").alias("Language"), value.alias(field), F.array(image).alias("Images")))
    sku_local = F.array(F.struct(us.alias("Markets"), F.lit("en-us").alias("Language"), F.when(s == 9, "else").otherwise(name).alias("SkuTitle")))
    market = lambda field, value: F.array(F.struct(us.alias("Markets"), value.alias(field)))
    conditions = F.struct(
        F.lit("2001-01-01T00:00:00Z").alias("StartDate"), F.lit("9998-12-30T00:00:00Z").alias("EndDate"), F.array(F.lit("1")).alias("ResourceSetIds"),
        F.struct(F.array(F.struct(F.lit(2147483647).alias("MaxVersion"), F.lit(0).alias("MinVersion"), F.lit("Windows.Xbox").alias("PlatformName"))).alias("AllowedPlatforms")).alias("ClientConditions"))
    av = F.struct(F.array(F.lit("Purchase")).alias("Actions"), conditions.alias("Conditions"), us.alias("Markets"),
                  F.struct(F.array().cast("array<string>").alias("GrantedEntitlementKeys"), F.struct(F.lit(60.0).alias("ListPrice"), F.lit(60.0).alias("MSRP"), F.when(s == 12, "EUR").otherwise("USD").alias("CurrencyCode")).alias("Price")).alias("OrderManagementData"))
    packs = F.array(F.struct(F.array(F.struct(F.when(s == 10, "Windows.Desktop").otherwise("Windows.Xbox").alias("PlatformName"))).alias("PlatformDependencies")))
    sku = F.struct(F.lit("full").alias("SkuType"), sku_local.alias("LocalizedProperties"), market("FirstAvailableDate", F.when(s == 11, "2001-09-16T00:00:00Z").otherwise("2001-09-15T00:00:00Z")).alias("MarketProperties"),
                   F.struct(F.lit(False).alias("IsTrial"), (s != 6).alias("IsPreOrder"), (s == 7).alias("IsBundle"), packs.alias("Packages")).alias("Properties"))
    display = F.struct(sku.alias("Sku"), F.array(av).alias("Availabilities"))
    item = F.struct(big.alias("ProductId"), F.when(s == 1, "Movie").otherwise("Game").alias("ProductKind"), local("ProductTitle", name).alias("LocalizedProperties"),
                    market("OriginalReleaseDate", F.when(s == 5, "9999-01-01T00:00:00Z").otherwise("2001-09-15T00:00:00Z")).alias("MarketProperties"),
                    F.when(s == 8, F.array(display, display)).otherwise(F.array(display)).alias("DisplaySkuAvailabilities"))
    raw = p.where(s != 14).select(F.to_json(F.struct(F.array(item).alias("Products"))).alias("body"))
    cards = B.table(spark, d, "part").select(big.alias("big_id"), F.when(s == 3, "another").otherwise(F.upper(name)).alias("title"))
    return CO.xbox_calendar_entries(raw, cards, B.catalog(spark, d), B.AS_OF).select("xbox_big_id", "reason", "date")


# ------------------------------------------------------------ product page identity

def us_pages(spark, d):
    p, s = B.landed(spark, d, "part", "p_partkey"), F.col("p_size")
    slug = F.concat(F.lit("g-"), key_text())
    nsuid = F.concat(F.lit("7001"), F.lpad(key_text(), 10, "0"))
    path = F.concat(F.lit("/us/store/products/"), slug, F.lit("/"))
    state_key = F.concat(F.lit('Product:{"sku":"'), key_text(), F.lit('"}'))
    item = F.struct(
        slug.alias("urlKey"), F.when(s == 3, "else").otherwise(title_col()).alias("name"), nsuid.alias("nsuid"), (s == 4).alias("isUpgrade"), F.when(s == 5, "Deluxe").otherwise("Standard Edition").alias("edition"),
        path.alias('url({"relative":true})'), F.struct(F.lit("https://assets.nintendo.com/a.jpg").alias("url")).alias("productImage"), F.when(s == 6, "2001-09-01").otherwise("2000-09-01").alias("releaseDate"),
        F.struct(F.when(s == 7, "NINTENDO_SWITCH_2").otherwise("NINTENDO_SWITCH").alias("code")).alias("platform"))
    analytics = F.struct(F.struct(F.when(s == 2, "else").otherwise(title_col()).alias("name"), nsuid.alias("nsuid"), key_text().alias("sku")).alias("product"))
    doc = F.to_json(F.struct(F.struct(F.when(s == 1, "else").otherwise(slug).alias("slug")).alias("query"),
                             F.struct(F.struct(analytics.alias("analytics"), F.create_map(state_key, item).alias("initialApolloState")).alias("pageProps")).alias("props")))
    ld = F.to_json(F.struct(F.lit("Product").alias("@type"), title_col().alias("name"), F.struct(F.concat(F.lit("https://www.nintendo.com"), path).alias("url")).alias("offers"),
                            F.concat(F.lit("https://assets.nintendo.com/switch/"), F.when(s == 8, "70010000000000").otherwise(nsuid), F.lit("/x")).alias("image"), F.lit("2000-09-01").alias("datePublished")))
    graph = F.concat(F.lit('{"@context":"x","@graph":['), ld, F.lit("]}"))
    body = F.concat(F.when(s == 9, "").otherwise(script('id="__NEXT_DATA__"', doc)), F.when(s <= 25, F.concat(F.lit('<script type="application/ld+json">'), F.when(s == 10, "{broken").otherwise(graph), F.lit("</script>"))).otherwise(""))
    url = F.concat(F.lit("https://www.nintendo.com"), path)
    return p.select(url.alias("key"), F.when(s == 11, "https://www.nintendo.com/us/").otherwise(url).alias("final_url"), body.alias("body"),
                    F.concat(F.lit("p"), key_text()).alias("slug"), title_col().alias("title"), nsuid.alias("nsuid_americas"), slug.alias("nintendo_us_slug"), url.alias("url"),
                    F.when(s == 12, F.array(F.lit("pc"))).when(s == 13, F.array(F.lit("switch-2"))).otherwise(F.array(F.lit("switch"))).alias("platforms"))


view("v_page_reason", """
SELECT p_partkey, p_size, CASE p_size WHEN 1 THEN 'next_data_product_slug_mismatch' WHEN 2 THEN 'next_data_title_mismatch' WHEN 3 THEN 'next_data_product_identity_conflict' WHEN 4 THEN 'next_data_upgrade_product'
  WHEN 5 THEN 'next_data_nonstandard_edition' WHEN 6 THEN 'not_released' WHEN 7 THEN 'current_product_evidence_conflict' WHEN 8 THEN CASE WHEN p_partkey = 0 THEN NULL ELSE 'current_product_evidence_conflict' END
  WHEN 10 THEN 'json_ld_malformed' WHEN 11 THEN 'final_product_path_mismatch' WHEN 12 THEN 'missing_switch_generation' WHEN 13 THEN 'generation_mismatch' END AS reason FROM part
""")


@query("page_identity", """
SELECT concat('p', CAST(p_partkey AS VARCHAR)) AS slug, reason, CASE WHEN reason IS NULL THEN 'matched' WHEN p_size IN (6, 11, 13) THEN 'none' ELSE 'exception' END AS status,
  CASE WHEN reason IS NULL THEN concat('7001', lpad(CAST(p_partkey AS VARCHAR), 10, '0')) END AS nsuid FROM v_page_reason
""")
def page_identity(spark, d):
    pages = us_pages(spark, d)
    targets = pages.select("slug", "title", "platforms", "url")
    return ME.page_identity(pages.select("key", "final_url", "body"), targets, B.AS_OF).select("slug", "reason", "status", "nsuid")


@query("us_page_meta", """
SELECT concat('p', CAST(p_partkey AS VARCHAR)) AS slug, concat(p_name, ' ', CAST(p_partkey AS VARCHAR)) AS name, p_size = 6 AS coming_soon FROM part WHERE p_size NOT IN (1, 2, 3, 4, 5, 7, 9, 12, 13)
""")
def us_page_meta(spark, d):
    pages = us_pages(spark, d)
    cat = pages.select("slug", "title", "nsuid_americas", "nintendo_us_slug", "platforms")
    landed = pages.select(F.col("slug").alias("key"), "final_url", "body")
    return ME.us_page_meta(landed, cat, B.AS_OF).select("slug", "name", "coming_soon")


# ------------------------------------------------------------ files

@query("write_snapshot_json", """
SELECT slug, channel, cc, CAST(row_number() OVER (PARTITION BY slug, channel ORDER BY cc) - 1 AS INT) AS pos, currency, amount, list_amount, discount_pct, sale_ends_at FROM v_latest
""")
def write_snapshot_json(spark, d):
    """Documents are written per store and read back as price rows."""
    home = workspace(spark)
    FI.write_snapshot_json(B.latest(spark, d), f"{home}/snapshots")
    docs = spark.read.schema(FI.SNAPSHOT_DDL + ", channel string").json(f"{home}/snapshots")
    return docs.select("slug", "channel", F.posexplode("regions").alias("pos", "r")).select(
        "slug", "channel", "r.cc", "pos", "r.currency", "r.amount", F.col("r.list").alias("list_amount"), F.col("r.discountPct").alias("discount_pct"), F.col("r.saleEndsAt").alias("sale_ends_at"))


@query("read_history", """
SELECT slug, count(*) AS n_events, min(usd) AS low_usd, max(d) AS last_day FROM v_events GROUP BY slug
""")
def read_history(spark, d):
    """History documents are landed as JSON lines and opened as event rows."""
    from .history_queries import events

    home = workspace(spark)
    e = events(spark, d)
    # a document holds the change events of one game, bounded by its days
    row = F.struct(F.col("d").cast("string").alias("d"), F.col("channel").alias("ch"), F.lit("US").alias("cc"), "usd", "pct")
    e.groupBy("slug").agg(F.array_sort(F.collect_list(row)).alias("events")).write.json(f"{home}/history")
    docs = spark.read.schema(FI.HISTORY_DDL).json(f"{home}/history")
    return FI.history_events(docs).groupBy("slug").agg(F.count(F.lit(1)).alias("n_events"), F.min("usd").alias("low_usd"), F.max("d").alias("last_day"))


@query("write_review_csv", "SELECT candidate_id, decision, CASE WHEN approval_stale THEN '是' ELSE '否' END AS approval_stale FROM v_joined2")
def write_review_csv(spark, d):
    from ..operators.catalog import candidate_state_join

    home = workspace(spark)
    FI.write_review_csv(candidate_state_join(decided(spark, d), state(spark, d)), f"{home}/review")
    back = spark.read.option("header", True).option("escape", '"').csv(f"{home}/review")
    return back.select("candidate_id", "decision", "approval_stale")
