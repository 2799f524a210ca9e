"""What a published site promises about its pages, games and listings.

Pages are tables of (url, canonical) and of links taken out of their markup;
promises are joins on urls and ids and counts of them.  A page that stands for
another one (an alias) is followed to it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions.ordering import down, group_row_number
from ..sources.landing import clean_url
from .history import KEY
from .quality import row_rules, union_all, violation

# ------------------------------------------------------------ pages and their canonical urls

def resolved_pages(built: DataFrame, aliases: DataFrame) -> DataFrame:
    """(url, canonical, is_alias, target): the page that stands for each built page.

    ``built`` holds (url, canonical), ``aliases`` (url).  An alias stands for its
    canonical url, every other page for itself.
    """
    named = aliases.select("url").distinct().withColumn("is_alias", F.lit(True))
    pages = built.join(named, "url", "left").withColumn("is_alias", F.coalesce("is_alias", F.lit(False)))
    return pages.withColumn("target", F.when(F.col("is_alias"), F.col("canonical")).otherwise(F.col("url")))


def alias_faults(built: DataFrame, listed: DataFrame, aliases: DataFrame, origin: str) -> DataFrame:
    """One row per violation between built pages, the sitemap and the alias list.

    A page is listed under its own canonical url; an alias is not listed, points
    to another page, and that page is built, listed and no alias itself.
    """
    pages = resolved_pages(built, aliases)
    once = listed.groupBy("url").agg(F.count(F.lit(1)).alias("n_listed"))
    targets = pages.where(~F.col("is_alias")).join(once, "url").select(F.col("url").alias("target"), F.lit(True).alias("target_ok")).distinct()
    j = pages.join(once, "url", "left").join(targets, "target", "left")
    alias, is_listed = F.col("is_alias"), F.col("n_listed").isNotNull()
    own = F.coalesce(F.col("canonical") == F.col("url"), F.lit(False))
    rules = {
        "alias_listed": alias & is_listed,
        "alias_own_canonical": alias & own,
        "alias_target_missing": alias & ~own & F.col("target_ok").isNull(),
        "page_not_listed": ~alias & ~is_listed,
        "canonical_differs": ~alias & ~own,
    }
    listing = once.join(pages.select("url", F.lit(True).alias("page")).distinct(), "url", "left")
    of_listing = {
        "listed_twice": F.col("n_listed") > 1,
        "listed_without_page": F.col("page").isNull(),
        "listed_elsewhere": ~F.col("url").startswith(f"{origin}/"),
        "listed_with_query": F.col("url").rlike(r"[?#]"),
    }
    return union_all(row_rules(j, "url", rules), row_rules(listing, "url", of_listing))


# ------------------------------------------------------------ product links

# Product pages of two stores, fixed values.
PRODUCT_URL = {"xbox": "https://www.microsoft.com/store/productId/", "psn": "https://store.playstation.com/en-us/product/"}
PRODUCT_PAGE = {"xbox": ("www.microsoft.com", r"/store/productId/([A-Z0-9]{12})"),
                "psn": ("store.playstation.com", r"/en-us/product/([A-Z]{2}\d{4}-[A-Z0-9_]{12}-[A-Z0-9_]{16})")}


def official_product(url: str | Column = "href") -> tuple[Column, Column]:
    """(channel, id) of a store's product url; null for any other, also one with a query or fragment."""
    ids = {c: F.nullif(clean_url(url, *page), F.lit("")) for c, page in PRODUCT_PAGE.items()}
    channel = F.coalesce(*[F.when(value.isNotNull(), c) for c, value in ids.items()])
    return channel, F.coalesce(*ids.values())


def store_links(pages: DataFrame) -> DataFrame:
    """(url, channel, n_rows, href): links inside a page's comparison rows, and rows without one.

    A comparison row is a table row that names its store in ``data-store-channel``.
    """
    tr = r'(?is)<tr\b(?=[^>]*\bdata-store-channel="({})")[^>]*>.*?</tr>'
    rows = F.array(*[F.struct(F.lit(c).alias("channel"), F.regexp_extract_all("html", F.lit(tr.format(c)), F.lit(0)).alias("found")) for c in PRODUCT_URL])
    per = pages.select("url", F.explode(rows).alias("r")).where(F.size("r.found") > 0)
    hrefs = F.flatten(F.transform("r.found", lambda x: F.regexp_extract_all(x, F.lit(r'(?i)<a\b[^>]*?\bhref="([^"]*)"'), F.lit(1))))
    return per.select("url", "r.channel", F.size("r.found").alias("n_rows"), F.explode_outer(hrefs).alias("href"))


def product_link_faults(pages: DataFrame, catalog: DataFrame, origin: str, ids: Mapping[str, str]) -> DataFrame:
    """Mapped games without a page, without exactly one comparison row per store, or whose row does not link exactly once to the product.

    ``pages`` holds (url, html); ``ids`` names the catalog's id column of each store.
    Links to a product that the page's game is not mapped to are faults of their own.
    """
    each = F.array_compact(F.array(*[F.when(F.col(column).isNotNull(), F.struct(F.lit(c).alias("channel"), F.concat(F.lit(PRODUCT_URL[c]), F.col(column)).alias("wanted"))) for c, column in ids.items()]))
    mapped = catalog.select("slug", F.explode(each).alias("m")).select("slug", "m.*").withColumn("url", F.concat(F.lit(f"{origin}/game/"), "slug", F.lit("/")))
    links = store_links(pages)
    per = links.join(mapped, ["url", "channel"]).groupBy("slug", "channel").agg(
        F.max("n_rows").alias("n_rows"), F.count_if(F.col("href") == F.col("wanted")).alias("n_links"))
    there = pages.select("url").distinct().withColumn("page", F.lit(True))
    j = mapped.join(there, "url", "left").join(per, ["slug", "channel"], "left")
    n_rows, n_links = F.coalesce("n_rows", F.lit(0)), F.coalesce("n_links", F.lit(0))
    rules = {
        "product_page_missing": F.col("page").isNull(),
        "product_row_count": F.col("page") & (n_rows != 1),
        "product_link_count": F.col("page") & (n_rows == 1) & (n_links != 1),
    }
    channel, product = official_product("href")
    told = links.withColumn("linked", channel).withColumn("product", product)
    foreign = told.where(F.col("product").isNotNull()).join(mapped.select("url", F.col("wanted").alias("href")), ["url", "href"], "left_anti")
    odd = told.where(F.col("href").isNotNull() & F.col("product").isNull())
    return union_all(
        row_rules(j, F.concat_ws("/", "slug", "channel"), rules),
        violation(foreign, "product_link_foreign", "url", "href"), violation(odd, "product_link_malformed", "url", "href"))


# ------------------------------------------------------------ price lines of a game

def aligned_series(events: DataFrame, tracked: DataFrame) -> DataFrame:
    """Every tracked line of a game, also one without a point, over one span of days.

    ``events`` holds (slug, channel, cc, d, usd), of which US rows with a price
    count; ``tracked`` (slug, channel, end_date), one row per line.  A line ends
    at ``end_date`` but never before its last point.  The span runs from the
    first point to the last end over all lines of the game and is null where the
    game has no point.
    """
    points = events.where((F.col("cc") == "US") & (F.col("usd") >= 0) & F.col("d").isNotNull())
    lines = points.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n_points"), F.min("d").alias("first_date"), F.max("d").alias("last_event_date"), F.max_by("usd", F.struct("d", "usd")).alias("last_usd"))
    j = tracked.select(*KEY, F.col("end_date").alias("asked")).join(lines, list(KEY), "left")
    j = j.withColumn("end_date", F.when(F.col("n_points").isNotNull(), F.greatest("last_event_date", "asked")))
    state = (
        F.when(F.col("n_points").isNull(), "empty").when(F.col("n_points") > 1, "changes")
        .when(F.col("end_date") > F.col("first_date"), "confirmed-flat").otherwise("point")
    )
    # a game has a handful of stores
    span = Window.partitionBy("slug")
    return j.select(*KEY, state.alias("state"), F.coalesce("n_points", F.lit(0)).alias("n_points"), "first_date", "last_event_date", "end_date", "last_usd",
                    F.min("first_date").over(span).alias("span_from"), F.max("end_date").over(span).alias("span_to"))


# ------------------------------------------------------------ games and listings

def full_bundle(catalog: DataFrame, prices: DataFrame, offers: DataFrame, reviewed: DataFrame, events: DataFrame, meta: DataFrame) -> DataFrame:
    """Everything known about a game in one row: shown prices by store, reviewed offers, price history, metadata.

    ``prices`` holds (slug, channel, usd), ``offers`` (slug, package_id, cc, usd,
    name, kind), ``reviewed`` (slug, package_id, name, kind), ``events`` (slug,
    channel, d, usd).  A reviewed name and kind replace the stored ones.  History
    is one array of change events, so it is bounded by a game's days.
    """
    shown = prices.groupBy("slug").agg(*[F.max(F.when(F.col("channel") == c, F.col("usd"))).alias(f"{c}_usd") for c in X.CHANNELS])
    display = reviewed.select("slug", "package_id", F.col("name").alias("r_name"), F.col("kind").alias("r_kind"))
    named = offers.join(display, ["slug", "package_id"], "left").select(
        "slug", "package_id", "cc", "usd", F.coalesce("r_name", "name").alias("name"), F.coalesce("r_kind", "kind").alias("kind"))
    offered = named.groupBy("slug").agg(F.array_sort(F.collect_set(F.struct("package_id", "cc", "usd", "name", "kind"))).alias("offers"))
    told = events.groupBy("slug").agg(F.array_sort(F.collect_set(F.struct("d", "channel", "usd"))).alias("events"))
    none = lambda c: F.coalesce(c, F.array().cast(next(f.dataType for df in (offered, told) for f in df.schema.fields if f.name == c)))
    out = catalog.select("slug", "title").join(shown, "slug", "left").join(offered, "slug", "left").join(told, "slug", "left").join(meta, "slug", "left")
    return out.withColumns({"offers": none("offers"), "events": none("events")})


def ranked_deals(deals: DataFrame, keys: Sequence[str] = ("channel",)) -> DataFrame:
    """Deals with their 1-based place in the listing of their store: largest discount first, then slug."""
    return group_row_number(deals, list(keys), [down("pct"), "slug"], "place")


def category_pages(pages: DataFrame, products: DataFrame, candidates: DataFrame, size: int, shape: str = X.PSN_PRODUCT_SHAPE) -> DataFrame:
    """A paged listing is whole: every page is there with the rows it must have, ids are well formed and unique, candidates are listed once.

    ``pages`` holds (category, page, page_count, total, raw_count), ``products``
    (category, page, product_id), ``candidates`` (category, product_id).
    """
    ids = products.groupBy("category", "page").agg(F.count(F.lit(1)).alias("n_ids"))
    per = pages.groupBy("category").agg(
        F.count(F.lit(1)).alias("n_pages"), F.count_distinct("page").alias("n_numbers"), F.min("page").alias("lo"), F.max("page").alias("hi"),
        F.min("total").alias("t_lo"), F.max("total").alias("t_hi"), F.min("page_count").alias("c_lo"), F.max("page_count").alias("c_hi"))
    torn = (
        (F.col("t_lo") != F.col("t_hi")) | (F.col("c_lo") != F.col("c_hi")) | (F.col("t_hi") <= 0) | (F.col("c_hi") != F.ceil(F.col("t_hi") / size))
        | (F.col("n_pages") != F.col("c_hi")) | (F.col("n_numbers") != F.col("c_hi")) | (F.col("lo") != 1) | (F.col("hi") != F.col("c_hi")))
    must = F.least(F.lit(size), F.col("total") - (F.col("page") - 1) * size)
    rows = pages.join(ids, ["category", "page"], "left").withColumn("n_ids", F.coalesce("n_ids", F.lit(0)))
    short = (F.col("n_ids") != must) | ~F.coalesce(F.col("raw_count") == F.col("n_ids"), F.lit(False))
    again = products.groupBy("category", "product_id").agg(F.count(F.lit(1)).alias("n"))
    twice = candidates.groupBy("category", "product_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    lost = candidates.select("category", "product_id").distinct().join(again, ["category", "product_id"], "left_anti")
    return union_all(
        row_rules(per, "category", {"category_pages_incomplete": torn}),
        row_rules(rows, F.concat_ws("/", "category", "page"), {"category_page_rows": short}),
        violation(again.where(~X.matches("product_id", shape)), "category_id_malformed", "product_id", "category"),
        violation(again.where(F.col("n") > 1), "category_id_repeat", "product_id", "n"),
        violation(lost, "candidate_not_listed", "product_id", "category"),
        violation(twice, "candidate_repeat", "product_id", "n"))


def product_batch(asked: DataFrame, returned: DataFrame, shape: str = X.XBOX_SHAPE) -> DataFrame:
    """A batch answer holds every asked id once and no other.  Both sides hold (batch, product_id); ids of the answer count in upper case."""
    got = returned.select("batch", F.upper(F.coalesce("product_id", F.lit(""))).alias("product_id")).groupBy("batch", "product_id").agg(F.count(F.lit(1)).alias("n"))
    want = asked.select("batch", "product_id").distinct().withColumn("asked", F.lit(True))
    j = got.join(want, ["batch", "product_id"], "full_outer")
    rules = {
        "batch_id_malformed": F.col("n").isNotNull() & ~X.matches("product_id", shape),
        "batch_id_unasked": F.col("n").isNotNull() & F.col("asked").isNull(),
        "batch_id_repeat": F.col("n") > 1,
        "batch_id_missing": F.col("n").isNull(),
    }
    return row_rules(j, F.concat_ws("/", "batch", "product_id"), rules)
