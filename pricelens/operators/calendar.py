"""Release calendar: merging per-store entries into one row per release.

The ambiguity test of a release (a store with two product pages, or two tracked
games) is decided on aggregates before anything is picked.  Entries are first
reduced to distinct (release, platform, url, slug) rows, so copies of one entry,
however many, cost one row after the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions.text import with_title_key

ENTRY = ("title", "date", "month", "platform", "url", "image", "slug_if_tracked", "seq")


def usable_entries(entries: DataFrame, title_key: Column | None = None) -> DataFrame:
    """Entries with at least a month, a title, a platform and a url, keyed by
    title and day (or by month when the day is open)."""
    slim = entries.select(*ENTRY)
    return (
        (with_title_key(slim) if title_key is None else slim.withColumn("title_key", title_key))
        .where(F.col("month").isNotNull() & (F.col("title_key") != ""))
        .where(F.col("platform").isNotNull() & F.col("url").isNotNull())
        .withColumn("release_key", F.coalesce("date", F.concat("month", F.lit("-tbc"))))
    )


GROUP = ("title_key", "release_key")


def merge_calendar(entries: DataFrame, title_key: Column | None = None) -> DataFrame:
    """One row per release, or the distinct product rows of an ambiguous one."""
    seq_of = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct("seq", c)))
    products = (
        usable_entries(entries, title_key)
        .groupBy(*GROUP, "platform", "url", "slug_if_tracked")
        .agg(F.min(F.struct("seq", "title", "image", "date", "month")).alias("head"),
             seq_of("image").alias("art"))
        .withColumn("seq", F.col("head.seq"))
    )
    per_platform = products.groupBy(*GROUP, "platform").agg(
        F.min("url").alias("url_lo"), F.max("url").alias("url_hi"),
        F.min("slug_if_tracked").alias("slug_lo"), F.max("slug_if_tracked").alias("slug_hi"),
        F.min(F.when(F.col("slug_if_tracked").isNotNull(), F.struct("seq", "slug_if_tracked"))).alias("slug_at"),
        F.min("art").alias("art"),
        F.min(F.struct("seq", "head")).alias("head"),
    )
    # at most one row per platform and release from here on
    releases = per_platform.groupBy(*GROUP).agg(
        (F.bool_or(F.col("url_lo") != F.col("url_hi")) | (F.min("slug_lo") != F.max("slug_hi"))).alias("gate"),
        F.array_sort(F.collect_list(F.struct("platform", F.col("url_lo").alias("url")))).alias("links"),
        F.min("head").alias("head"), F.min("art").alias("art"), F.min("slug_at").alias("slug_at"),
    ).withColumn("ambiguous", F.coalesce("gate", F.lit(False)))

    head = F.col("head.head")
    merged = releases.where(~F.col("ambiguous")).select(
        head["title"].alias("title"), head["date"].alias("date"), head["month"].alias("month"),
        X.sort_platforms(F.transform("links", lambda x: x["platform"])).alias("platforms"),
        F.map_from_entries("links").alias("urls"),
        F.col("art.image").alias("image"), F.col("slug_at.slug_if_tracked").alias("slug_if_tracked"),
        F.col("head.seq").alias("seq"),
    )
    doubtful = releases.where(F.col("ambiguous")).select(*GROUP)
    apart = products.join(doubtful, list(GROUP), "left_semi").select(
        F.col("head.title").alias("title"), F.col("head.date").alias("date"), F.col("head.month").alias("month"),
        F.array("platform").alias("platforms"), F.create_map("platform", "url").alias("urls"),
        F.col("head.image").alias("image"), "slug_if_tracked", "seq",
    )
    return merged.unionByName(apart)


def split_calendar(calendar: DataFrame) -> DataFrame:
    """Merged rows back to one row per platform."""
    return calendar.select(
        "title", "date", "month", F.explode("urls").alias("platform", "url"), "image", "slug_if_tracked", "seq")


def remerge_calendar(current: DataFrame, caches: DataFrame, base: tuple[str, ...] = ("pc", "switch"),
                     title_key: Column | None = None) -> DataFrame:
    """Merge store caches into the calendar again.

    Rows of the base platforms come from the current calendar, all others from
    the caches, which go first and so name the release.
    """
    kept = split_calendar(current).where(F.col("platform").isin(*base)).withColumn(
        "seq", F.concat(F.lit("1"), F.lpad(F.col("seq").cast("string"), 18, "0")))
    fresh = caches.withColumn("seq", F.concat(F.lit("0"), F.lpad(F.col("seq").cast("string"), 18, "0")))
    return merge_calendar(fresh.select(*ENTRY).unionByName(kept.select(*ENTRY)), title_key)


def calendar_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows added to and removed from the calendar, as comparable text.

    The versions are one table with a sign; equal rows cancel in one grouped
    sum, and what is left over comes out as often as it is left.  Urls are
    compared in the order of their platforms, whatever order a map holds them in.
    """
    flat = lambda df: df.select(
        "title", "date", "month", F.array_join("platforms", ",").alias("platforms"),
        F.to_json(F.map_from_entries(F.array_sort(F.map_entries("urls")))).alias("urls"), "image", "slug_if_tracked")
    signed = flat(after).withColumn("sign", F.lit(1)).unionByName(flat(before).withColumn("sign", F.lit(-1)))
    cols = [c for c in signed.columns if c != "sign"]
    left = signed.groupBy(*cols).agg(F.sum("sign").alias("left")).where(F.col("left") != 0)
    again = F.explode(F.array_repeat(F.when(F.col("left") > 0, "added").otherwise("removed"), F.abs("left").cast("int")))
    return left.select(*cols, again.alias("change"))


def change_counts(changes: DataFrame) -> DataFrame:
    """Number of added and of removed rows; a kind without any counts zero."""
    kinds = ("added", "removed")
    return changes.agg(*[F.count_if(F.col("change") == k).alias(k) for k in kinds]).unpivot([], list(kinds), "change", "n")


def calendar_artwork(releases: DataFrame, minimum: float = 0.8) -> DataFrame:
    good = F.coalesce(F.col("image").rlike("^https://"), F.lit(False))
    return releases.agg(
        F.count(F.lit(1)).alias("entries"), F.count_if(good).alias("images"),
    ).withColumn("ok", (F.col("entries") == 0) | (F.col("images") >= F.col("entries") * F.lit(minimum)))


def platform_presence(releases: DataFrame) -> DataFrame:
    """Platforms that occur in a month, in display order."""
    pairs = releases.select("month", "platform").distinct()
    return pairs.groupBy("month").agg(X.sort_platforms(F.collect_list("platform")).alias("platforms"))
