"""Product descriptions and page identity evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions import text as T
from ..functions.ordering import first_per_key
from ..operators.matching import allowed_generations
from . import landing as L
from .feeds import eu_docs

DETAILS = (
    "map<string, struct<data: struct<name: string, header_image: string, genres: array<struct<description: string>>, "
    "release_date: struct<date: string, coming_soon: boolean>, metacritic: struct<score: int>, recommendations: struct<total: bigint>>>>"
)
REVIEWS = "struct<query_summary: struct<total_reviews: bigint, total_positive: bigint, review_score_desc: string>>"


def steam_meta(details: DataFrame, reviews: DataFrame, catalog: DataFrame) -> DataFrame:
    """Details and review summary of every app; landing keys are app ids."""
    d = L.id_entries(details, DETAILS, "app", "e").select(
        F.col("app").try_cast("bigint").alias("steam_app_id"), F.col("e.data").alias("d"), F.lit(True).alias("__d"))
    r = reviews.select(F.col("key").try_cast("bigint").alias("steam_app_id"), F.from_json("body", REVIEWS)["query_summary"].alias("q"))
    games = catalog.where(F.col("steam_app_id").isNotNull()).select("slug", "title", "steam_app_id")
    total = F.coalesce("q.total_reviews", F.lit(0))
    return games.join(d, "steam_app_id").join(r, "steam_app_id", "left").select(
        "slug", F.coalesce("d.name", "title").alias("name"), F.col("d.header_image").alias("header_image"),
        F.transform(F.coalesce("d.genres", F.array()), lambda g: g["description"]).alias("genres"), F.col("d.release_date.date").alias("release_date"),
        F.coalesce("d.release_date.coming_soon", F.lit(False)).alias("coming_soon"), F.col("d.metacritic.score").alias("metacritic"),
        F.col("d.recommendations.total").alias("recommendations"), F.col("q.review_score_desc").alias("review_desc"), total.alias("review_count"),
        F.when(total > 0, X.round_int(F.col("q.total_positive") / total * 100)).alias("review_percent"))


def eu_meta(raw: DataFrame, catalog: DataFrame, as_of) -> DataFrame:
    """First document per console game (landing key: slug) when it names the
    mapped product, type and title."""
    first = eu_docs(raw, "key").where(F.col("place") == 0).withColumnRenamed("key", "slug").withColumnRenamed("title", "doc_title")
    games = catalog.select("slug", "title", "nsuid_europe")
    image = F.coalesce("image_url_h2x1_s", "image_url", "image_url_h16x9_s")
    fits = F.array_contains(T.edition_keys(T.norm_title("doc_title")), T.norm_title("title"))
    good = (
        (F.col("type") == "GAME") & F.array_contains("nsuid_txt", F.col("nsuid_europe")) & X.matches("nsuid_europe", X.NSUID_SHAPE)
        & fits & image.rlike(r"^https://(www\.)?nintendo\.")
    )
    release = F.try_element_at("dates_released_dts", F.lit(1))
    return first.join(games, "slug").where(good).select(
        "slug", F.col("doc_title").alias("name"), image.alias("header_image"),
        F.filter(F.transform(F.coalesce("pretty_game_categories_txt", F.array()), lambda g: F.trim(g)), lambda g: g != "").alias("genres"),
        release.alias("release_date"), F.coalesce(F.try_to_timestamp(release) > X.moment(as_of), F.lit(False)).alias("coming_soon"),
        F.col("excerpt").alias("description"), "publisher", F.concat(F.lit("https://www.nintendo.com"), "url").alias("store_url"),
        F.lit("nintendo-eu-solr").alias("meta_source"))


PRODUCT = (
    "struct<urlKey: string, name: string, nsuid: string, isUpgrade: boolean, edition: string, topLevelCategory: struct<code: string>, "
    "`url({\"relative\":true})`: string, productImage: struct<url: string>, releaseDate: string, description: string, softwarePublisher: string, "
    "softwareDeveloper: string, tags: struct<genres: array<struct<label: string>>>, platform: struct<code: string, label: string>, "
    "platforms: array<struct<code: string, label: string>>>"
)
NEXT = (
    "struct<query: struct<slug: string>, props: struct<pageProps: struct<openGraph: struct<image: string>, "
    f"analytics: struct<product: struct<name: string, nsuid: string, sku: string>>, initialApolloState: map<string, {PRODUCT}>>>>"
)
SITE = "https://www.nintendo.com"


def _generation(values: Column) -> Column:
    upper = F.transform(F.array_compact(values), lambda v: F.upper(v))
    second = r"NINTENDO_SWITCH_2|SWITCH 2|/SWITCH2/"
    bee = F.exists(upper, lambda v: v.rlike(second))
    hac = F.exists(upper, lambda v: v.contains("SWITCH") & ~v.rlike(second))
    return F.when(bee & ~hac, "BEE").when(hac & ~bee, "HAC")


def _platform_values(p: str) -> Column:
    many = F.coalesce(F.col(f"{p}.platforms"), F.array())
    return F.concat(
        F.array(F.col(f"{p}.platform.code"), F.col(f"{p}.platform.label")),
        F.transform(many, lambda x: x["code"]), F.transform(many, lambda x: x["label"]))


def open_pages(pages: DataFrame) -> DataFrame:
    """Page data with the product its analytics block points at."""
    scripts = L.script_bodies("body", L.NEXT_DATA)
    opened = pages.select("*", L.once(scripts).alias("scripts")).withColumn("n_next", F.size("scripts"))
    opened = opened.select("*", L.once(F.from_json(F.try_element_at("scripts", F.lit(1)), NEXT)).alias("next")).drop("scripts")
    key = F.concat(F.lit('Product:{"sku":"'), F.col("next.props.pageProps.analytics.product.sku"), F.lit('"}'))
    return opened.withColumn("a", F.col("next.props.pageProps.analytics.product")).withColumn(
        "p", F.try_element_at("next.props.pageProps.initialApolloState", key))


def us_page_meta(pages: DataFrame, catalog: DataFrame, as_of) -> DataFrame:
    """Meta of a product page (landing key: slug) when page data, analytics and
    product state all name the mapped game."""
    games = catalog.select(F.col("slug").alias("key"), "title", "nsuid_americas", "nintendo_us_slug", "platforms")
    j = open_pages(pages).join(games, "key")
    want = T.norm_title("title")
    fits = lambda c: F.array_contains(T.edition_keys(T.norm_title(c)), want)
    path = F.col('p.`url({"relative":true})`')
    image = F.coalesce("p.productImage.url", "next.props.pageProps.openGraph.image")
    good = (
        (F.col("next.query.slug") == F.col("nintendo_us_slug")) & fits("a.name") & (F.col("a.nsuid") == F.col("nsuid_americas"))
        & X.matches("nsuid_americas", X.NSUID_SHAPE) & (F.col("p.urlKey") == F.col("nintendo_us_slug")) & fits("p.name")
        & (F.col("p.nsuid") == F.col("nsuid_americas")) & ~F.coalesce("p.isUpgrade", F.lit(False))
        & F.array_contains(allowed_generations(), _generation(_platform_values("p")))
        & (F.coalesce("p.edition", F.lit("Standard Edition")) == "Standard Edition") & (F.coalesce("p.topLevelCategory.code", F.lit("GAMES")) == "GAMES")
        & (path == F.concat(F.lit("/us/store/products/"), "nintendo_us_slug", F.lit("/"))) & image.rlike(r"^https://assets\.nintendo\.com/")
    )
    labels = F.transform(F.coalesce("p.tags.genres", F.array()), lambda g: F.trim(g["label"]))
    return j.where(good).select(
        F.col("key").alias("slug"), F.coalesce("p.name", "title").alias("name"), image.alias("header_image"),
        F.array_distinct(F.filter(labels, lambda g: g != "")).alias("genres"), F.col("p.releaseDate").alias("release_date"),
        F.coalesce(F.try_to_timestamp(F.col("p.releaseDate")) > X.moment(as_of), F.lit(False)).alias("coming_soon"),
        F.col("p.description").alias("description"), F.col("p.softwarePublisher").alias("publisher"), F.col("p.softwareDeveloper").alias("developer"),
        F.concat(F.lit(SITE), path).alias("store_url"), F.lit("nintendo-us").alias("meta_source"))


LD = (
    "struct<`@type`: string, name: string, url: string, offers: struct<url: string>, gamePlatform: string, operatingSystem: string, image: string, "
    "contentUrl: string, downloadUrl: string, datePublished: string, releaseDate: string, `@graph`: array<string>>"
)
PATH = r"^(?:https://(?:www\.)?nintendo\.com)?(/[^?#]*?)/*(?:[?#].*)?$"


def _path(url: Column | str) -> Column:
    return F.regexp_extract(X.col(url), PATH, 1)


def _next_evidence(pages: DataFrame) -> DataFrame:
    """Verdict of the page-data block per page (status, reason, identity)."""
    j = open_pages(pages)
    same = lambda c: F.coalesce((T.norm_title(c) == F.col("want")) & (F.col("want") != ""), F.lit(False))
    gen = _generation(_platform_values("p"))
    no = lambda c: ~F.coalesce(c, F.lit(False))
    reason = (
        F.when(F.col("n_next") == 0, "next_data_absent").when(F.col("n_next") > 1, "multiple_next_data_documents")
        .when(F.col("next").isNull(), "next_data_malformed").when(no(F.col("next.query.slug") == F.col("product_slug")), "next_data_product_slug_mismatch")
        .when(~same("a.name"), "next_data_title_mismatch").when(~X.matches("a.nsuid", X.NSUID_SHAPE), "next_data_not_base_game")
        .when(F.coalesce("a.sku", F.lit("")) == "", "next_data_sku_missing").when(F.col("p").isNull(), "next_data_product_state_missing")
        .when(no((F.col("p.urlKey") == F.col("product_slug")) & (_path('p.`url({"relative":true})`') == F.col("path"))), "next_data_product_url_mismatch")
        .when(~same("p.name") | no(F.col("p.nsuid") == F.col("a.nsuid")), "next_data_product_identity_conflict")
        .when(F.col("p.isUpgrade"), "next_data_upgrade_product").when(F.col("p.edition") != "Standard Edition", "next_data_nonstandard_edition")
        .when(F.col("p.topLevelCategory.code") != "GAMES", "next_data_not_game_category").when(gen.isNull(), "next_data_generation_missing_or_conflicting")
    )
    return j.withColumn("n_reason", reason).select(
        "slug", "path", "n_reason", F.when(F.col("n_reason").isNull(), F.struct(
            F.col("a.nsuid").alias("nsuid"), gen.alias("generation"), F.col("a.name").alias("title"), F.col("p.releaseDate").alias("release"))).alias("n"))


def _ld_evidence(pages: DataFrame) -> DataFrame:
    """Verdict of the linked-data block per page.  Products may sit at the top,
    in an array or in a graph."""
    docs = pages.select("slug", "path", "want", F.explode(L.script_bodies("body", L.LD_JSON)).alias("text"))
    broken = docs.where(F.try_parse_json("text").isNull()).select("slug", "path").distinct().withColumn("broken", F.lit(True))
    tops = F.when(F.ltrim("text").startswith("["), F.from_json("text", "array<string>")).otherwise(F.array("text"))
    nodes = docs.select("slug", "path", "want", F.explode(tops).alias("node")).withColumn("o", F.from_json("node", LD))
    inner = nodes.select("slug", "path", "want", F.explode("o.`@graph`").alias("node")).withColumn("o", F.from_json("node", LD))
    both = nodes.unionByName(inner).where(F.col("o.`@type`").rlike("Product|VideoGame|SoftwareApplication"))
    mine = both.where(_path(F.coalesce("o.offers.url", "o.url")) == F.col("path"))
    ids = F.array_distinct(F.regexp_extract_all("node", F.lit(r'(?i)(?:switch2?)/(7001\d{10})(?=/|["?])'), F.lit(1)))
    gen = _generation(F.array("o.gamePlatform", "o.operatingSystem", "o.image", "o.contentUrl", "o.downloadUrl"))
    judged = mine.select(
        "slug", "path", (T.norm_title("o.name") == F.col("want")).alias("same"),
        F.when((F.size(ids) == 1) & gen.isNotNull(), F.struct(
            F.try_element_at(ids, F.lit(1)).alias("nsuid"), gen.alias("generation"), F.col("o.name").alias("title"),
            F.coalesce("o.datePublished", "o.releaseDate").alias("release"))).alias("l"))
    per = judged.groupBy("slug", "path").agg(
        F.bool_and(F.coalesce("same", F.lit(False))).alias("same"), F.min("l").alias("l"),
        F.min(F.struct("l.nsuid", "l.generation")).alias("lo"), F.max(F.struct("l.nsuid", "l.generation")).alias("hi"))
    reason = (
        F.when(F.col("broken"), "json_ld_malformed").when(F.col("same").isNull(), "json_ld_current_product_absent")
        .when(~F.col("same"), "json_ld_current_product_title_mismatch").when(F.col("l").isNull(), "json_ld_identity_or_generation_missing")
        .when((F.col("lo") != F.col("hi")) & F.col("lo.nsuid").isNotNull(), "json_ld_current_product_conflict")
    )
    return pages.select("slug", "path").distinct().join(per, ["slug", "path"], "left").join(broken, ["slug", "path"], "left").select(
        "slug", "path", reason.alias("l_reason"), F.when(reason.isNull(), F.col("l")).alias("l"))


ABSENT = ("next_data_absent", "json_ld_current_product_absent")


def page_identity(pages: DataFrame, targets: DataFrame, as_of) -> DataFrame:
    """matched / none / exception of every landed product page.

    Two blocks of a page are read independently and must agree.  ``pages`` is
    the landing table with the requested url as key; ``targets`` holds (slug,
    title, platforms, url).  A page that was landed several times is judged once,
    on its newest landing.
    """
    newest = [F.col("fetched_at").desc_nulls_last()] if "fetched_at" in pages.columns else []
    pages = first_per_key(pages, ["key"], [*newest, F.col("final_url"), F.xxhash64("body")])
    asked = targets.withColumn("want", T.norm_title("title")).withColumn("allowed", allowed_generations())
    rows = pages.join(asked, pages["key"] == asked["url"]).withColumn("path", _path("url"))
    rows = rows.withColumn("product_slug", F.regexp_extract("url", r"^https://(?:www\.)?nintendo\.com/us/store/products/([a-z0-9]+(?:-[a-z0-9]+)*)/*$", 1))
    right = rows.where((F.col("product_slug") != "") & (_path("final_url") == F.col("path")))
    j = rows.join(_next_evidence(right), ["slug", "path"], "left").join(_ld_evidence(right), ["slug", "path"], "left")
    fatal = lambda c: F.when(F.col(c).isNotNull() & ~F.col(c).isin(*ABSENT), F.col(c))
    pick = F.coalesce("n", "l")
    clash = F.col("n").isNotNull() & F.col("l").isNotNull() & (
        (F.col("n.nsuid") != F.col("l.nsuid")) | (F.col("n.generation") != F.col("l.generation")))
    release = F.try_to_timestamp(F.col("hit.release"))
    reason = (
        F.when(F.col("product_slug") == "", "requested_product_url_invalid").when(_path("final_url") != F.col("path"), "final_product_path_mismatch")
        .when(F.size("allowed") == 0, "missing_switch_generation").when(fatal("n_reason").isNotNull(), F.col("n_reason"))
        .when(fatal("l_reason").isNotNull(), F.col("l_reason")).when(F.col("hit").isNull(), "current_product_identity_missing")
        .when(clash, "current_product_evidence_conflict").when(~F.array_contains("allowed", F.col("hit.generation")), "generation_mismatch")
        .when(release.isNull(), "release_date_missing_or_invalid").when(release > X.moment(as_of), "not_released")
    )
    soft = ("final_product_path_mismatch", "current_product_identity_missing", "generation_mismatch", "not_released")
    out = j.withColumn("hit", pick).withColumn("reason", reason)
    ok = F.col("reason").isNull()
    status = F.when(ok, "matched").when(F.col("reason").isin(*soft), "none").otherwise("exception")
    return out.select("slug", "url", status.alias("status"), "reason", F.when(ok, F.col("hit.nsuid")).alias("nsuid"),
                      F.when(ok, F.col("hit.generation")).alias("generation"), F.when(ok, F.col("product_slug")).alias("product_slug"))


def sitemap_products(xml: DataFrame) -> DataFrame:
    """Product slug and canonical url of every store product in a sitemap."""
    locs = xml.select(F.explode(F.regexp_extract_all("body", F.lit(r"(?i)<loc>\s*([^<]+?)\s*</loc>"), F.lit(1))).alias("loc"))
    url = F.replace(F.col("loc"), F.lit("&amp;"), F.lit("&"))
    slug = F.regexp_extract(url, r"^https://(?:www\.)?nintendo\.com/us/store/products/([a-z0-9]+(?:-[a-z0-9]+)*)/*(?:[?#].*)?$", 1)
    return locs.select(slug.alias("product_slug")).where(F.col("product_slug") != "").distinct().select(
        "product_slug", F.concat(F.lit(f"{SITE}/us/store/products/"), "product_slug", F.lit("/")).alias("url"))
