"""Deal, giveaway and release feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions import text as T
from ..operators.changes import track_slug
from . import landing as L

SPECIALS = (
    "struct<specials: struct<items: array<struct<id: bigint, name: string, discounted: boolean, discount_percent: int, "
    "currency: string, final_price: double, original_price: double, discount_expiration: bigint>>>>"
)


def feed_steam_specials(raw: DataFrame, catalog: DataFrame) -> DataFrame:
    """Discounted items; a full discount goes to the free feed."""
    it = raw.select(F.explode(F.from_json("body", SPECIALS)["specials"]["items"]).alias("i")).select("i.*")
    good = it.where(F.col("discounted") & (F.col("discount_percent") > 0) & F.col("final_price").isNotNull() & F.col("original_price").isNotNull())
    free = F.col("discount_percent") >= 100
    rows = good.select(
        F.when(free, "free-games").otherwise("deals-steam").alias("feed"), F.col("name").alias("title"), F.lit("steam").alias("store_id"),
        F.concat(F.lit("https://store.steampowered.com/app/"), F.col("id").cast("string"), F.lit("/")).alias("url"),
        F.coalesce("currency", F.lit("USD")).alias("currency"),
        F.when(free, 0.0).otherwise(X.round_half_up("final_price") / 100).alias("price"), (X.round_half_up("original_price") / 100).alias("list"),
        F.col("discount_percent").alias("pct"), F.when(F.col("discount_expiration") > 0, F.timestamp_seconds("discount_expiration")).alias("ends_at"),
        F.col("id").alias("steam_app_id"), F.when(free, "free-now").alias("status"))
    return track_slug(rows, catalog, "steam_app_id")


OFFER = "struct<endDate: string, discountSetting: struct<discountPercentage: double>>"
GROUPS = f"array<struct<promotionalOffers: array<{OFFER}>>>"
EPIC = (
    "struct<data: struct<Catalog: struct<searchStore: struct<elements: array<struct<title: string, productSlug: string, urlSlug: string, "
    "catalogNs: struct<mappings: array<struct<pageSlug: string>>>, price: struct<totalPrice: struct<originalPrice: double>>, "
    f"promotions: struct<promotionalOffers: {GROUPS}, upcomingPromotionalOffers: {GROUPS}>>>>>>>"
)


def feed_epic_free(raw: DataFrame) -> DataFrame:
    """Items free now, else items that will be.  Errors beside the data do not
    matter; only full discounts count."""
    e = raw.select(F.explode(F.from_json("body", EPIC)["data"]["Catalog"]["searchStore"]["elements"]).alias("e"))

    def full(groups):
        head = F.try_element_at(F.col(groups), F.lit(1))["promotionalOffers"]
        return F.try_element_at(F.filter(head, lambda o: o["discountSetting"]["discountPercentage"] == 0), F.lit(1))

    rows = e.where(F.col("e.promotions").isNotNull()).withColumns({
        "now": full("e.promotions.promotionalOffers"), "later": full("e.promotions.upcomingPromotionalOffers")})
    rows = rows.where(F.col("now").isNotNull() | F.col("later").isNotNull())
    page = F.coalesce(F.try_element_at("e.catalogNs.mappings", F.lit(1))["pageSlug"], "e.productSlug", "e.urlSlug")
    return rows.select(
        F.lit("free-games").alias("feed"), F.col("e.title").alias("title"), F.lit("epic").alias("store_id"),
        F.when(page.isNotNull(), F.concat(F.lit("https://store.epicgames.com/en-US/p/"), page)).otherwise("https://store.epicgames.com/en-US/free-games").alias("url"),
        F.lit("USD").alias("currency"), F.lit(0.0).alias("price"), (X.round_half_up("e.price.totalPrice.originalPrice") / 100).alias("list"), F.lit(100).alias("pct"),
        F.coalesce("now.endDate", "later.endDate").alias("ends_at"), F.when(F.col("now").isNotNull(), "free-now").otherwise("upcoming").alias("status"))


EU_DOCS = (
    "struct<response: struct<docs: array<struct<title: string, url: string, type: string, nsuid_txt: array<string>, price_discounted_f: double, "
    "price_regular_f: double, price_discount_percentage_f: double, dates_released_dts: array<string>, image_url: string, image_url_h2x1_s: string, "
    "image_url_h16x9_s: string, wishlist_email_banner640w_image_url_s: string, pretty_game_categories_txt: array<string>, excerpt: string, publisher: string>>>>"
)


def eu_docs(raw: DataFrame, *keep: str) -> DataFrame:
    return raw.select(*keep, F.posexplode(F.from_json("body", EU_DOCS)["response"]["docs"]).alias("place", "d")).select(*keep, "place", "d.*")


def first_base_id():
    return F.try_element_at(F.filter(F.coalesce("nsuid_txt", F.array()), lambda n: n.startswith("7001")), F.lit(1))


def feed_eu_discounts(raw: DataFrame, catalog: DataFrame) -> DataFrame:
    d = eu_docs(raw).where((F.col("price_discounted_f") > 0) & (F.col("price_regular_f") > 0) & (F.col("price_discounted_f") < F.col("price_regular_f")))
    pct = F.coalesce("price_discount_percentage_f", (F.lit(1.0) - F.col("price_discounted_f") / F.col("price_regular_f")) * 100)
    rows = d.select(
        F.lit("deals-eshop").alias("feed"), "title", F.lit("eshop-eu").alias("store_id"),
        F.concat(F.lit("https://www.nintendo.co.uk"), F.coalesce("url", F.lit(""))).alias("url"), F.lit("GBP").alias("currency"),
        F.col("price_discounted_f").alias("price"), F.col("price_regular_f").alias("list"), X.round_int(pct).alias("pct"), first_base_id().alias("nsuid_europe"))
    return track_slug(rows, catalog, "nsuid_europe")


DEALS = "array<struct<title: string, storeID: string, dealID: string, salePrice: string, normalPrice: string, savings: string, steamAppID: string>>"
STORES = "array<struct<storeID: string, storeName: string, isActive: int>>"


def store_names(raw: DataFrame) -> DataFrame:
    s = raw.select(F.explode(F.from_json("body", STORES)).alias("s")).where(F.col("s.isActive") != 0)
    return s.groupBy(F.col("s.storeID").alias("store_key")).agg(
        F.max(F.regexp_replace(F.lower("s.storeName"), "[^a-z0-9]+", "-")).alias("store_name"))


def feed_store_deals(raw: DataFrame, stores: DataFrame, catalog: DataFrame) -> DataFrame:
    """Deals of many stores; prices arrive as text."""
    d = raw.select(F.explode(F.from_json("body", DEALS)).alias("d")).select("d.*")
    rows = d.select(
        F.lit("deals-stores").alias("feed"), "title", F.col("storeID").alias("store_key"),
        F.concat(F.lit("https://www.cheapshark.com/redirect?dealID="), "dealID").alias("url"), F.lit("USD").alias("currency"),
        F.col("salePrice").try_cast("double").alias("price"), F.col("normalPrice").try_cast("double").alias("list"),
        X.round_int(F.col("savings").try_cast("double")).alias("pct"), F.col("steamAppID").try_cast("bigint").alias("steam_app_id"))
    rows = rows.where((F.col("price") > 0) & (F.col("list") > 0) & (F.col("pct") > 0) & (F.col("pct") <= 100))
    named = rows.join(stores, "store_key", "left").withColumn("store_id", F.coalesce("store_name", F.concat(F.lit("store-"), "store_key")))
    return track_slug(named.drop("store_key", "store_name"), catalog, "steam_app_id")


COMING = (
    "map<string, struct<data: struct<name: string, type: string, header_image: string, "
    "release_date: struct<coming_soon: boolean, date: string>>>>"
)


def steam_calendar(raw: DataFrame, catalog: DataFrame) -> DataFrame:
    """Upcoming games with a readable release month."""
    apps = L.id_entries(raw, COMING, "app", "e").select(F.col("app").try_cast("bigint").alias("steam_app_id"), "e.data.*")
    good = apps.where((F.col("type") == "game") & F.col("release_date.coming_soon") & ~T.junk_title("name"))
    date, month = T.parse_release("release_date.date")
    rows = good.select(
        F.col("name").alias("title"), date.cast("string").alias("date"), month.alias("month"), F.lit("pc").alias("platform"),
        F.concat(F.lit("https://store.steampowered.com/app/"), F.col("steam_app_id").cast("string"), F.lit("/")).alias("url"),
        F.col("header_image").alias("image"), "steam_app_id").where(F.col("month").isNotNull())
    return track_slug(rows, catalog, "steam_app_id")


def eu_calendar(raw: DataFrame, catalog: DataFrame) -> DataFrame:
    """Dated console releases."""
    d = eu_docs(raw).withColumn("stamp", F.try_element_at("dates_released_dts", F.lit(1))).where(F.col("stamp").isNotNull())
    rows = d.select(
        "title", F.substring("stamp", 1, 10).alias("date"), F.substring("stamp", 1, 7).alias("month"), F.lit("switch").alias("platform"),
        F.concat(F.lit("https://www.nintendo.co.uk"), "url").alias("url"),
        F.coalesce("image_url_h16x9_s", "wishlist_email_banner640w_image_url_s").alias("image"), first_base_id().alias("nsuid_europe"))
    return track_slug(rows, catalog, "nsuid_europe")


LOOKUP = "array<struct<gameID: string, steamAppID: string>>"
CHEAPEST = "map<string, struct<cheapestPriceEver: struct<price: string, date: bigint>>>"


def outside_game_ids(raw: DataFrame) -> DataFrame:
    """Game id of an outside price tracker by exact store app id (landing key)."""
    g = raw.select(F.col("key").alias("app"), F.posexplode(F.from_json("body", LOOKUP)).alias("place", "g")).where(F.col("g.steamAppID") == F.col("app"))
    return g.groupBy("app").agg(F.min_by("g.gameID", "place").alias("game_id"))


def outside_lows(raw: DataFrame) -> DataFrame:
    """Lowest price an outside tracker has seen; giveaways are no price."""
    g = L.id_entries(raw, CHEAPEST, "game_id", "e")
    price, at = F.col("e.cheapestPriceEver.price").try_cast("double"), F.col("e.cheapestPriceEver.date")
    return g.select("game_id", price.alias("usd"), F.when(at > 0, F.timestamp_seconds(at).cast("date")).alias("date")).where(F.col("usd") > 0)
