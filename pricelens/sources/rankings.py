"""Popularity lists: search pages, featured lists, most played, sales tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions import text as T
from . import landing as L

SEARCH = "struct<success: int, total_count: bigint, start: bigint, results_html: string>"


CLASS_MARK = r"(?is)^<a\b[^>]*\sclass\s*=\s*[\"'](?:[^\"']*\s)?search_result_row(?:\s[^\"']*)?[\"']"
OWN_ID = r"(?is)^<a\b[^>]*\sdata-ds-appid\s*=\s*[\"'](\d+)[\"']"
LINK_ID = r"(?is)^<a\b[^>]*\shref\s*=\s*[\"'][^\"'>]*/app/(\d+)(?:/|[\"'])"
TITLE_SPAN = r"(?is)<span\b[^>]*class\s*=\s*[\"'][^\"']*\btitle\b[^\"']*[\"'][^>]*>(.*?)</span>"


def search_ranks(raw: DataFrame) -> DataFrame:
    """Every result row of a search page (landing key: start offset) in page
    order, with the reason a row was refused.  A page with five rows or more of
    which over a fifth were refused is refused as a whole, as is one whose
    offset is not the asked one.  Pages are judged row by row, no shuffle."""
    page = raw.select(F.col("key").cast("bigint").alias("asked"), F.from_json("body", SEARCH).alias("b"))
    anchors = F.filter(F.regexp_extract_all("b.results_html", F.lit(r"(?is)<a\b[^>]*>.*?</a>"), F.lit(0)), lambda a: a.rlike(CLASS_MARK))

    def facts(block, i):
        return F.struct(
            (F.col("asked") + i + 1).alias("rank"), F.regexp_extract(block, OWN_ID, 1).try_cast("bigint").alias("own"),
            F.regexp_extract(block, LINK_ID, 1).try_cast("bigint").alias("link"), L.strip_tags(F.regexp_extract(block, TITLE_SPAN, 1)).alias("title"))

    def judged(r):
        app = F.coalesce(r["own"], r["link"])
        reason = (
            F.when(app.isNull(), "missing_single_appid").when(r["own"] != r["link"], "appid_href_mismatch")
            .when(app <= 0, "invalid_appid").when(r["title"] == "", "missing_title")
        )
        return F.struct(r["rank"].alias("rank"), app.alias("app_id"), r["title"].alias("title"), reason.alias("reason"))

    rows = page.select("asked", F.coalesce(F.col("b.start") == F.col("asked"), F.lit(True)).alias("same_start"), F.transform(anchors, facts).alias("rows"))
    rows = rows.select("asked", "same_start", L.once(F.transform("rows", judged)).alias("rows"))
    bad = F.size(F.filter("rows", lambda r: r["reason"].isNotNull()))
    drift = (F.size("rows") >= 5) & (bad > F.size("rows") * 0.2)
    flat = rows.select("asked", "same_start", drift.alias("drift"), F.explode("rows").alias("r"))
    reason = F.when(~F.col("same_start"), "start_mismatch").when(F.col("drift"), "page_structure_drift").otherwise(F.col("r.reason"))
    return flat.select(F.col("asked").alias("start"), "r.rank", "r.app_id", "r.title", reason.alias("reason"))


FEATURED = "struct<top_sellers: struct<items: array<struct<id: bigint, name: string>>>>"


def featured_ranks(raw: DataFrame) -> DataFrame:
    """First rank of every app in a featured list (landing key: list id);
    repeats are refused and conflicting titles mark the app.  A list is short,
    so it is compared with itself inside its row."""
    def fact(it, i):
        title = F.trim(F.coalesce(it["name"], F.lit("")))
        ok = F.coalesce((it["id"] > 0) & (title != ""), F.lit(False))
        return F.struct((i + 1).alias("rank"), it["id"].alias("app_id"), title.alias("title"), F.when(ok, it["id"]).alias("valid"), T.norm_title_basic(title).alias("k"))

    lists = raw.select("key", F.transform(F.from_json("body", FEATURED)["top_sellers"]["items"], fact).alias("xs"))
    lists = lists.withColumn("ids", F.transform("xs", lambda x: F.coalesce(x["valid"], F.lit(-1))))
    flat = lists.select("key", "xs", "ids", F.explode("xs").alias("x"))
    conflict = F.exists("xs", lambda y: (y["valid"] == F.col("x.valid")) & (y["k"] != F.col("x.k")))
    reason = (
        F.when(F.col("x.valid").isNull(), "invalid_featured_item").when(conflict, "title_conflict")
        .when(F.array_position("ids", F.col("x.valid")) < F.col("x.rank"), "duplicate_featured_appid")
    )
    return flat.select("key", "x.rank", "x.app_id", "x.title", reason.alias("reason"))


PLAYED = "struct<response: struct<rollup_date: bigint, ranks: array<struct<rank: int, appid: bigint, peak_in_game: bigint>>>>"


def most_played(raw: DataFrame, as_of, max_days: int = 14) -> DataFrame:
    """Ranked list with its age test: not older than two weeks and not more
    than five minutes ahead."""
    doc = raw.select("key", F.from_json("body", PLAYED)["response"].alias("r"))
    stamp = F.col("r.rollup_date")
    at = F.when(stamp > 10_000_000_000, F.timestamp_millis(stamp)).otherwise(F.timestamp_seconds(stamp))
    age = F.unix_seconds(X.moment(as_of)) - F.unix_seconds(at)
    reason = F.when(age < -300, "future_rollup_date").when(age > max_days * 86400, "stale_rollup_date")
    rows = doc.select("key", at.alias("rolled_up_at"), reason.alias("reason"), F.explode("r.ranks").alias("i"))
    good = F.coalesce((F.col("i.appid") >= 1) & (F.col("i.rank") >= 1) & (F.col("i.peak_in_game") >= 0), F.lit(False))
    return rows.where(good).select("key", "rolled_up_at", F.col("i.appid").alias("app_id"), F.col("i.rank").alias("rank"), F.col("i.peak_in_game").alias("peak"), "reason")


def ir_sales_rows(pages: DataFrame) -> DataFrame:
    """Rows of a saved sales-units page: rank, title, units, console.

    A page counts only when its own canonical url is the source url and it
    names one console generation; rows that combine titles are marked.
    """
    og = F.coalesce(
        F.nullif(F.regexp_extract("body", r"(?is)<meta\b[^>]*property=[\"']og:url[\"'][^>]*content=[\"']([^\"']+)[\"']", 1), F.lit("")),
        F.regexp_extract("body", r"(?is)<meta\b[^>]*content=[\"']([^\"']+)[\"'][^>]*property=[\"']og:url[\"']", 1))
    hardware = F.regexp_extract("body", r"(?is)<div\b[^>]*class=[\"'][^\"']*\bsales_hard\b[^\"']*[\"'][^>]*>.*?<img\b[^>]*alt=[\"'](Nintendo Switch(?: 2)? software)[\"']", 1)
    platform = F.when(hardware == "Nintendo Switch software", "switch").when(hardware == "Nintendo Switch 2 software", "switch-2")
    bare = lambda c: F.regexp_replace(c, "/+$", "")
    good = pages.withColumn("platform", platform).where((bare(og) == bare(F.col("final_url"))) & F.col("platform").isNotNull())
    blocks = F.regexp_extract_all("body", F.lit(r"(?is)<li\b[^>]*class=[\"'][^\"']*\bsales_layout_list\b[^\"']*[\"'][^>]*>(.*?)</li>"), F.lit(1))
    rows = good.select("final_url", "platform", F.posexplode(blocks).alias("i", "li"))
    part = lambda name: F.regexp_extract("li", rf"(?is)<p\b[^>]*class=[\"'][^\"']*\b{name}\b[^\"']*[\"'][^>]*>(.*?)</p>", 1)
    raw_title = part("sales_title")
    units = F.regexp_extract(part("sales_value"), r"(?is)<span\b[^>]*>([0-9]+(?:\.[0-9]+)?)</span>\s*million\s+pcs\.", 1).try_cast("double")
    title = L.strip_tags(raw_title)
    reason = F.when((title == "") | units.isNull(), "row_structure_changed").when(
        raw_title.rlike(r"(?i)\s/\s|/\s*<br"), "combined_title_row_requires_explicit_product_evidence")
    return rows.select("final_url", (F.col("i") + 1).alias("rank"), title.alias("title"), units.alias("units_millions"), "platform", reason.alias("reason"))
