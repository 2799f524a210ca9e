"""Console store listings: calendar cards, category grids, search tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions import text as T
from ..operators.changes import track_slug
from . import landing as L
from .stores import AVAILABILITY, public_purchase, psn_fragments, psn_title_key

# Listing size and the marks every card of the listing carries, fixed values.
PAGE_SIZE = 50
CARD_MARKS = {
    "data-bi-hn": "Games coming soon",
    "data-bi-ct": "Product Card",
    "data-bi-compnm": "Product Cards: Games",
}


def _marked(tag: Column) -> Column:
    out = F.lit(True)
    for name, value in CARD_MARKS.items():
        out = out & F.coalesce(L.attribute_text(tag, name) == value, F.lit(False))
    return out


def xbox_calendar_cards(pages: DataFrame, page_size: int = PAGE_SIZE) -> tuple[DataFrame, DataFrame]:
    """(cards, page faults) of a paged coming-soon listing.

    The landing key is the number of skipped items.  A page's stated range must
    be the asked one, its cards must fill it at positions 0..n-1 and name
    distinct products; cards get their place over all pages.  A page is judged
    on its own row, without a shuffle.
    """
    p = pages.select(F.col("key").cast("bigint").alias("skip"), L.without_raw_text("body").alias("html"))
    spans = F.regexp_extract_all("html", F.lit(r"(?i)\bShowing\s+(\d+\s*[-–]\s*\d+\s+of\s+\d+)\s+items\b"), F.lit(1))
    p = p.withColumn("spans", F.array_distinct(F.transform(spans, lambda t: F.regexp_replace(t, r"\s+|[-–]|of", " "))))
    p = p.withColumn("nums", F.filter(F.split(F.try_element_at("spans", F.lit(1)), " "), lambda x: x != ""))
    at = lambda i: F.try_element_at("nums", F.lit(i)).try_cast("bigint")
    tags = F.filter(F.regexp_extract_all("html", F.lit(r"(?is)<div\b[^>]*>"), F.lit(0)), lambda t: t.contains(CARD_MARKS["data-bi-hn"]))
    card = lambda t: F.struct(
        _marked(t).alias("marked"), F.upper(L.attribute_text(t, "data-bi-pid")).alias("big_id"), F.trim(L.attribute_text(t, "data-bi-prdname")).alias("title"),
        L.attribute_text(t, "data-bi-carpos").try_cast("int").alias("position"))
    p = p.withColumns({"start": at(1), "end": at(2), "total": at(3)}).select("*", L.once(F.transform(tags, card)).alias("cards"))
    sound = lambda c: c["marked"] & X.matches(c["big_id"], X.XBOX_SHAPE) & (F.coalesce(c["title"], F.lit("")) != "") & c["position"].isNotNull()
    places = F.array_sort(F.transform("cards", lambda c: c["position"]))
    ids = F.array_distinct(F.transform("cards", lambda c: c["big_id"]))
    n = F.size("cards")
    fault = (
        F.when(F.size("spans") == 0, "range_missing").when(F.size("spans") > 1, "contradictory_ranges")
        .when((F.col("start") != F.col("skip") + 1) | (F.col("end") != F.least(F.col("skip") + page_size, F.col("total"))), "range_mismatch")
        .when(n != F.col("end") - F.col("start") + 1, "card_count").when(~F.forall("cards", sound), "card_identity")
        .when(places != F.sequence(F.lit(0), n - 1), "positions_not_contiguous").when(F.size(ids) != n, "repeated_product")
    )
    judged = p.withColumn("fault", fault)
    good = judged.where(F.col("fault").isNull()).select("skip", F.explode("cards").alias("c")).select("skip", "c.big_id", "c.title", "c.position")
    return good.withColumn("place", F.col("skip") + F.col("position")), judged.where(F.col("fault").isNotNull()).select("skip", "fault")


MARKETS = "array<struct<Markets: array<string>, OriginalReleaseDate: string, FirstAvailableDate: string>>"
LOCAL = (
    "array<struct<Markets: array<string>, Language: string, ProductTitle: string, SkuTitle: string, "
    "Images: array<struct<ImagePurpose: string, Width: double, Height: double, Uri: string>>>>"
)
PRODUCTS = (
    f"struct<Products: array<struct<ProductId: string, ProductKind: string, LocalizedProperties: {LOCAL}, MarketProperties: {MARKETS}, "
    f"DisplaySkuAvailabilities: array<struct<Sku: struct<SkuType: string, LocalizedProperties: {LOCAL}, MarketProperties: {MARKETS}, "
    "Properties: struct<IsTrial: boolean, IsPreOrder: boolean, IsBundle: boolean, Packages: array<struct<PlatformDependencies: array<struct<PlatformName: string>>>>>>, "
    f"Availabilities: {AVAILABILITY}>>>>>"
)
# Titles that are no base game, fixed values.
NON_BASE = r"(?i)(?:\(\s*(?:DLC|add[ -]?on|expansion|upgrade)\s*\)|\b(?:DLC|add[ -]?on|expansion pass|season pass|upgrade pack)\s*$)"
HERO = ("TitledHeroArt", "SuperHeroArt")
IMAGE_HOST = "https://store-images.s-microsoft.com/image/"


def _us(rows: Column) -> Column:
    hits = F.filter(rows, lambda r: F.array_contains(r["Markets"], "US"))
    return F.when(F.size(hits) == 1, F.try_element_at(hits, F.lit(1)))


def _us_local(rows: Column) -> Column:
    us = F.filter(rows, lambda r: F.array_contains(r["Markets"], "US"))
    best = F.filter(us, lambda r: F.lower(r["Language"]) == "en-us")
    plain = F.filter(us, lambda r: F.lower(r["Language"]) == "en")
    return (
        F.when(F.size(best) == 1, F.try_element_at(best, F.lit(1)))
        .when((F.size(best) == 0) & (F.size(plain) == 1), F.try_element_at(plain, F.lit(1)))
    )


def _calendar_day(text: Column) -> Column:
    ts = F.try_to_timestamp(text)
    return F.when(F.year(ts).between(2000, 2099), ts.cast("date"))


def _hero(images: Column) -> Column:
    usable = F.filter(images, lambda i: (i["Height"] > 0) & (i["Width"] / i["Height"]).between(1.5, 2.0))
    links = F.transform(usable, lambda i: F.struct(
        F.when(i["ImagePurpose"] == HERO[0], 0).when(i["ImagePurpose"] == HERO[1], 1).otherwise(9).alias("o"),
        F.when(i["Uri"].startswith("//"), F.concat(F.lit("https:"), i["Uri"])).otherwise(i["Uri"]).alias("u")))
    good = F.filter(links, lambda x: (x["o"] < 9) & x["u"].startswith(IMAGE_HOST))
    first = F.filter(good, lambda x: x["o"] == 0)
    return F.coalesce(F.try_element_at(first, F.lit(1))["u"], F.try_element_at(good, F.lit(1))["u"])


def xbox_calendar_entries(raw: DataFrame, cards: DataFrame, catalog: DataFrame, as_of) -> DataFrame:
    """Dated release of every listed card, or the first test it fails.

    Opened products are far larger than Spark expects from their files, so they
    are joined by a merge and never broadcast.
    """
    docs = raw.select(L.once(F.from_json("body", PRODUCTS)).alias("doc"))
    products = docs.select(F.explode("doc.Products").alias("p")).select(F.upper("p.ProductId").alias("big_id"), "p")
    j = cards.select("big_id", F.col("title").alias("card_title")).join(products.hint("merge"), "big_id", "left")
    j = j.withColumn("loc", _us_local(F.col("p.LocalizedProperties"))).withColumn("title", F.trim("loc.ProductTitle"))
    j = j.withColumn("day", _calendar_day(_us(F.col("p.MarketProperties"))["OriginalReleaseDate"]))
    pre = F.filter(F.coalesce("p.DisplaySkuAvailabilities", F.array()), lambda d: (d["Sku"]["SkuType"] == "full")
                   & (d["Sku"]["Properties"]["IsTrial"] == F.lit(False)) & d["Sku"]["Properties"]["IsPreOrder"])
    j = j.withColumn("pre", pre)
    j = j.withColumn("direct", F.filter("pre", lambda d: d["Sku"]["Properties"]["IsBundle"] == F.lit(False)))
    j = j.withColumn("d", F.try_element_at("direct", F.lit(1))).withColumn("image", _hero(F.col("loc.Images")))
    bundles = F.exists("pre", lambda d: d["Sku"]["Properties"]["IsBundle"])
    packages = F.coalesce("d.Sku.Properties.Packages", F.array())
    on_box = F.exists(packages, lambda k: F.exists(k["PlatformDependencies"], lambda x: x["PlatformName"] == "Windows.Xbox"))
    buyable = F.exists(F.coalesce("d.Availabilities", F.array()), lambda a: (
        public_purchase(a, as_of) & F.array_contains(a["Markets"], "US") & (a["OrderManagementData"]["Price"]["CurrencyCode"] == "USD")
        & (a["OrderManagementData"]["Price"]["ListPrice"] >= 0)))
    no = lambda c: ~F.coalesce(c, F.lit(False))
    key = T.norm_title
    reason = (
        F.when(F.col("p").isNull(), "product_missing_or_invalid").when(no(F.col("p.ProductKind") == "Game"), "not_game")
        .when(F.coalesce("title", F.lit("")) == "", "us_localized_product_missing")
        .when((key("title") == "") | (key("title") != key("card_title")), "listed_title_mismatch")
        .when(F.col("title").rlike(NON_BASE), "non_base_game_title").when(F.col("day").isNull(), "us_release_date_missing_or_invalid")
        .when(F.size("pre") == 0, "no_full_preorder_sku").when((F.size("direct") == 0) & bundles, "bundle_requires_manual_resolution")
        .when(F.size("direct") != 1, "ambiguous_direct_preorder_sku")
        .when(no(key(_us_local(F.col("d.Sku.LocalizedProperties"))["SkuTitle"]) == key("title")), "sku_title_mismatch")
        .when(no(on_box), "xbox_package_missing")
        .when(no(_calendar_day(_us(F.col("d.Sku.MarketProperties"))["FirstAvailableDate"]) == F.col("day")), "sku_release_date_mismatch")
        .when(no(buyable), "no_current_public_us_purchase").when(F.col("image").isNull(), "hero_image_missing_or_invalid")
    )
    out = j.withColumn("reason", reason)
    ok = F.col("reason").isNull()
    rows = out.select(
        F.col("big_id").alias("xbox_big_id"), F.when(ok, F.col("title")).alias("title"), F.when(ok, F.col("day").cast("string")).alias("date"),
        F.when(ok, F.date_format("day", "yyyy-MM")).alias("month"), F.lit("xbox").alias("platform"),
        F.concat(F.lit("https://www.microsoft.com/en-us/p/_/"), F.lower("big_id")).alias("url"), F.when(ok, F.col("image")).alias("image"), "reason")
    return track_slug(rows, catalog, "xbox_big_id")


# ------------------------------------------------------------ category grid

GRID_ENTITY = (
    "struct<id: string, name: string, storeDisplayClassification: string, platforms: array<string>, skus: array<struct<type: string>>, "
    "telemetryData: struct<interactLink: string>, media: array<struct<type: string, role: string, url: string>>, sortedBy: struct<name: string, isAscending: boolean>, "
    "pageInfo: struct<`offset`: int, size: int, totalCount: int, isLast: boolean>, products: array<struct<__ref: string>>>"
)
GRID_PAGE = f"struct<props: struct<pageProps: struct<locale: string, categoryId: string, page: int, statusCode: int>, apolloState: map<string, {GRID_ENTITY}>>>"
# Grid size and edition words, fixed values.
GRID_SIZE = 24
STANDARD_TAIL = r"(?i)\s*(?:[-–—:]\s*)?(?:standard\s+edition|base\s+game)\s*$"
UNSAFE_EDITION = (
    r"(?i)\b(deluxe|ultimate|premium|gold|collector(?:'s)?|starter\s*pack|upgrade|bundle|collection|anthology|"
    r"add[ -]?on|dlc|soundtrack|art\s*book|demo|trial)\b"
)
MEDIA_HOST = "https://image.api.playstation.com/"
MEDIA_ROLES = ("SIXTEEN_BY_NINE_BANNER", "BACKGROUND", "FOUR_BY_THREE_BANNER", "MASTER")


def calendar_title(title: Column | str) -> Column:
    """Title without a standard-edition mark; null for any other edition."""
    bare = F.trim(F.regexp_replace(F.trim(X.col(title)), STANDARD_TAIL, ""))
    return F.when((bare != "") & ~bare.rlike(UNSAFE_EDITION), bare)


def _media(media: Column) -> Column:
    """Url of the best official image by role, then by place."""
    good = F.filter(F.coalesce(media, F.array()), lambda m: (m["type"] == "IMAGE") & m["role"].isin(*MEDIA_ROLES) & m["url"].startswith(MEDIA_HOST))
    by_role = [F.try_element_at(F.filter(good, _has_role(role)), F.lit(1))["url"] for role in MEDIA_ROLES]
    return F.coalesce(*by_role)


def _has_role(role: str):
    return lambda m: m["role"] == role


def psn_preorder_pages(pages: DataFrame, category: str, page_size: int = GRID_SIZE) -> tuple[DataFrame, DataFrame]:
    """(listed rows, page faults) of a pre-order category; the landing key is
    the page number.  Rows carry ``candidate`` for full-game pre-orders."""
    doc = F.from_json(L.script_body("body", L.NEXT_DATA), GRID_PAGE)
    p = pages.select(F.col("key").cast("int").alias("page"), L.once(doc["props"]).alias("d"))
    offset = (F.col("page") - 1) * page_size
    key = F.concat(F.lit(f"CategoryGrid:{category}:en-us:"), offset.cast("string"), F.lit(f":{page_size}"))
    p = p.withColumn("g", F.try_element_at("d.apolloState", key)).withColumn("info", F.col("g.pageInfo"))
    total = F.col("info.totalCount")
    last = F.ceil(total / page_size)
    good = lambda c: F.coalesce(c, F.lit(False))
    fault = (
        F.when(~good((F.col("d.pageProps.locale") == "en-us") & (F.col("d.pageProps.categoryId") == category)
                     & (F.col("d.pageProps.page") == F.col("page")) & (F.col("d.pageProps.statusCode") == 200)), "page_identity")
        .when(F.col("g").isNull() | ~good(F.col("g.id") == category), "grid_missing")
        .when(~good((F.col("g.sortedBy.name") == "productReleaseDate") & ~F.col("g.sortedBy.isAscending")), "grid_order")
        .when(~good((F.col("info.offset") == offset) & (F.col("info.size") == page_size) & (total > 0)), "grid_offset")
        .when((F.col("page") > last) | ~good(F.col("info.isLast") == (F.col("page") == last)), "grid_last")
        .when(F.size(F.coalesce("g.products", F.array())) != F.least(F.lit(page_size), total - offset), "grid_rows")
    )
    p = p.withColumn("fault", fault)
    faults = p.where(F.col("fault").isNotNull()).select("page", "fault")
    rows = p.where(F.col("fault").isNull()).select("page", total.alias("total"), F.posexplode("g.products").alias("i", "ref"), F.col("d.apolloState").alias("state"))
    rows = rows.withColumn("e", F.try_element_at("state", F.col("ref.__ref"))).withColumn(
        "product_id", F.upper(F.regexp_extract("ref.__ref", r"^Product:([^:]+):en-us$", 1)))
    named = good(X.matches("product_id", X.PSN_PRODUCT_SHAPE) & (F.col("e.id") == F.col("product_id"))
                 & (F.col("e.telemetryData.interactLink") == F.concat(F.lit("PRODUCT:"), "product_id")))
    consoles = F.array_sort(F.array_distinct(F.coalesce("e.platforms", F.array())))
    title = calendar_title("e.name")
    full = good((F.col("e.storeDisplayClassification") == "FULL_GAME") & F.exists("e.skus", lambda s: s["type"] == "PREORDER")
                & (F.size(consoles) > 0) & F.forall(consoles, lambda c: c.isin("PS4", "PS5")) & title.isNotNull())
    out = rows.select("page", "total", "i", "product_id", named.alias("named"), full.alias("candidate"), F.col("e.name").alias("raw_title"), title.alias("title"),
                      F.transform(consoles, lambda c: F.lower(c)).alias("platforms"), _media(F.col("e.media")).alias("image"))
    broken = out.where(~F.col("named")).select("page", F.lit("product_identity").alias("fault")).distinct()
    return out.join(broken, "page", "left_anti").drop("named"), faults.unionByName(broken)


def psn_calendar_entries(pages: DataFrame, candidates: DataFrame) -> DataFrame:
    """Release of every candidate whose page fragments agree: at least two
    dated ones, one day, one console set, the title, and the visible day."""
    frags = psn_fragments(pages)
    entity = F.try_element_at("cache", F.concat(F.lit("Product:"), "product_id"))
    v = frags.select("product_id", entity.alias("e")).where((F.col("e.__typename") == "Product") & (F.col("e.id") == F.col("product_id")))
    e = F.col("e")
    consoles = F.array_sort(F.array_distinct(e["platforms"]))
    usable = F.coalesce((F.size(consoles) > 0) & F.forall(consoles, lambda c: c.isin("PS4", "PS5")), F.lit(False))
    ts = F.try_to_timestamp(e["releaseDate"])
    day = F.when(F.year(ts) < 2100, ts.cast("date"))
    dated = e["releaseDate"].isNotNull()
    key = lambda c: F.when(F.coalesce(c, F.lit("")) != "", F.coalesce(T.norm_title(calendar_title(c)), F.lit("?")))
    rows = v.select(
        "product_id",
        F.coalesce((e["topCategory"] == "GAME") & (e["storeDisplayClassification"] == "FULL_GAME") & dated & usable, F.lit(False)).alias("cls"),
        F.coalesce((e["type"] == "GAME") & dated & usable, F.lit(False)).alias("game"),
        (F.coalesce(e["topCategory"] != "GAME", F.lit(False)) | F.coalesce(e["storeDisplayClassification"] != "FULL_GAME", F.lit(False))
         | F.coalesce(e["type"] != "GAME", F.lit(False))).alias("wrong"),
        dated.alias("dated"), day.alias("day"), F.when(usable, F.array_join(F.transform(consoles, lambda c: F.lower(c)), ",")).alias("set"),
        key(e["name"]).alias("k1"), key(e["invariantName"]).alias("k2"), _media(e["media"]).alias("image"))
    per = rows.groupBy("product_id").agg(
        F.bool_or("cls").alias("cls"), F.bool_or("game").alias("game"), F.bool_or("wrong").alias("wrong"), F.count_if("dated").alias("n_dated"),
        F.count("day").alias("n_day"), F.min("day").alias("d_lo"), F.max("day").alias("d_hi"), F.count("set").alias("n_set"), F.min("set").alias("s_lo"),
        F.max("set").alias("s_hi"), F.min(F.least("k1", "k2")).alias("k_lo"), F.max(F.greatest("k1", "k2")).alias("k_hi"), F.max("image").alias("image"))
    label = F.trim(F.regexp_extract("body", r"(?i)data-qa=[\"']gameInfo#releaseInformation#releaseDate-value[\"'][^>]*>([^<]+)<", 1))
    seen = F.coalesce(F.try_to_date(label, "M/d/yyyy"), F.try_to_date(label, "MMMM d, yyyy"), F.try_to_date(label, "MMM d, yyyy"))
    visible = pages.select(F.upper("key").alias("product_id"), (label != "").alias("has_label"), seen.alias("seen"))
    want = candidates.select("product_id", calendar_title(F.coalesce("raw_title", "title")).alias("title"), F.array_join("platforms", ",").alias("want_set"), F.col("image").alias("c_image"))
    # as many rows as products: joined by a merge, never sent through the driver
    j = per.join(want.hint("merge"), "product_id").join(visible.hint("merge"), "product_id")
    good = (
        F.col("cls") & F.col("game") & ~F.col("wrong") & (F.col("n_dated") >= 2) & (F.col("n_day") == F.col("n_dated")) & (F.col("d_lo") == F.col("d_hi"))
        & (F.col("n_set") >= 2) & (F.col("s_lo") == F.col("want_set")) & (F.col("s_hi") == F.col("want_set"))
        & (F.col("k_lo") == T.norm_title("title")) & (F.col("k_hi") == T.norm_title("title")) & (~F.col("has_label") | (F.col("seen") == F.col("d_lo")))
    )
    return j.where(good).withColumn("image", F.coalesce("image", "c_image")).where(F.col("image").isNotNull()).select(
        "product_id", "title", F.col("d_lo").cast("string").alias("date"), F.date_format("d_lo", "yyyy-MM").alias("month"), F.lit("psn").alias("platform"),
        F.concat(F.lit("https://store.playstation.com/en-us/product/"), "product_id").alias("url"), "image")


# ------------------------------------------------------------ search tiles

TELEMETRY = "struct<id: string, name: string, index: int, searchTerm: string>"
TILE_MARK = "web:store:product-tile"


def psn_search_tiles(pages: DataFrame, mark: str = TILE_MARK) -> DataFrame:
    """Search tiles with an exact title (landing key: the searched title); the
    best place per product.  A page with a tile whose link and telemetry name
    different products, or another search, gives nothing."""
    tags = F.filter(F.regexp_extract_all("body", F.lit(r"(?is)<a\b[^>]*>"), F.lit(0)), lambda t: t.contains(mark))
    tiles = pages.select("key", F.explode(tags).alias("tag"))
    meta = F.from_json(L.attribute("tag", "data-telemetry-meta"), TELEMETRY)
    link = F.upper(F.regexp_extract(L.attribute("tag", "href"), r"^(?:https://store\.playstation\.com)?/en-us/product/([^/?#]+)/?$", 1))
    rows = tiles.select("key", meta.alias("m"), link.alias("product_id"))
    sound = F.coalesce(
        X.matches("product_id", X.PSN_PRODUCT_SHAPE) & (F.upper("m.id") == F.col("product_id")) & (T.norm_title("m.searchTerm") == T.norm_title("key")), F.lit(False))
    judged = rows.withColumn("sound", sound)
    bad = judged.where(~F.col("sound")).select("key").distinct()
    exact = judged.join(bad, "key", "left_anti").where((psn_title_key("m.name") == T.norm_title("key")) & (T.norm_title("key") != ""))
    return exact.groupBy("key", "product_id").agg(F.min(F.struct("m.index", "m.name")).alias("b")).select(
        "key", "product_id", F.col("b.name").alias("matched_title"), F.col("b.index").alias("place"))
