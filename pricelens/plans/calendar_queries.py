"""Checked queries over the release calendar."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions.text import norm_title
from ..operators import calendar as C
from . import bindings as B
from .registry import query, view

RANK = "CASE {p} WHEN 'pc' THEN 0 WHEN 'switch' THEN 1 WHEN 'xbox' THEN 2 ELSE 3 END"

MERGE = """
SELECT *, coalesce(date, concat(month, '-tbc')) AS rk, lower(title) AS tk FROM {src}
"""


def merge_sql(src: str) -> str:
    return f"""
WITH e AS ({MERGE.format(src=src)}),
 g AS (SELECT tk, rk, count(DISTINCT slug_if_tracked) AS slugs FROM e GROUP BY 1, 2),
 pu AS (SELECT tk, rk, max(urls) AS urls FROM (SELECT tk, rk, platform, count(DISTINCT url) AS urls FROM e GROUP BY 1, 2, 3) x GROUP BY 1, 2),
 a AS (SELECT e.*, pu.urls > 1 OR g.slugs > 1 AS amb FROM e JOIN g ON e.tk = g.tk AND e.rk = g.rk JOIN pu ON e.tk = pu.tk AND e.rk = pu.rk)
SELECT arg_min(title, seq) AS title, min(date) AS date, min(month) AS month,
  array_to_string(list_transform(list_sort(list(DISTINCT concat(CAST({RANK.format(p='platform')} AS VARCHAR), platform))), lambda x: substr(x, 2)), ',') AS platforms,
  array_to_string(list_sort(list(DISTINCT concat(platform, '=', url))), ',') AS urls,
  arg_min(image, seq) FILTER (WHERE image IS NOT NULL) AS image, arg_min(slug_if_tracked, seq) FILTER (WHERE slug_if_tracked IS NOT NULL) AS slug_if_tracked, min(seq) AS seq
FROM a WHERE NOT amb GROUP BY tk, rk
UNION ALL
SELECT title, date, month, platform, concat(platform, '=', url), image, slug_if_tracked, seq
FROM (SELECT *, row_number() OVER (PARTITION BY tk, rk, platform, url, slug_if_tracked ORDER BY seq) rn FROM a WHERE amb) x WHERE rn = 1
"""


def flat(df):
    links = F.array_sort(F.transform(F.map_entries("urls"), lambda x: F.concat(x["key"], F.lit("="), x["value"])))
    return df.select("title", "date", "month", F.array_join("platforms", ",").alias("platforms"),
                     F.array_join(links, ",").alias("urls"), "image", "slug_if_tracked", "seq")


@query("merge_calendar", merge_sql("v_releases"))
def merge_calendar(spark, d):
    return flat(C.merge_calendar(B.releases(spark, d)))


@query("remerge_calendar", f"""
SELECT title, date, month, platforms, urls, image, slug_if_tracked FROM ({merge_sql("(SELECT * REPLACE (CASE WHEN platform IN ('pc','switch') THEN seq + 1000000000000 ELSE seq END AS seq) FROM v_split) z")}) y
""")
def remerge_calendar(spark, d):
    rel = B.releases(spark, d)
    current = C.merge_calendar(rel.where(F.col("platform").isin("pc", "switch")))
    caches = rel.where(~F.col("platform").isin("pc", "switch"))
    return flat(C.remerge_calendar(current, caches)).drop("seq")


# What a merged calendar of the two base platforms splits back into, plus the caches.
view("v_base_merged", merge_sql("(SELECT * FROM v_releases WHERE platform IN ('pc','switch')) b"))
view("v_split", """
SELECT title, date, month, split_part(u, '=', 1) AS platform, substr(u, strpos(u, '=') + 1) AS url, image, slug_if_tracked, seq
FROM (SELECT * EXCLUDE (urls, platforms), unnest(string_split(urls, ',')) AS u FROM v_base_merged) m
UNION ALL SELECT title, date, month, platform, url, image, slug_if_tracked, seq FROM v_releases WHERE platform NOT IN ('pc','switch')
""")


@query("calendar_artwork", """
SELECT count(*) AS entries, count(*) FILTER (WHERE image LIKE 'https://%') AS images, count(*) FILTER (WHERE image LIKE 'https://%') >= count(*) * 0.8::DOUBLE AS ok FROM v_releases
""")
def calendar_artwork(spark, d):
    return C.calendar_artwork(B.releases(spark, d))


@query("platform_presence", f"""
SELECT month, array_to_string(list_transform(list_sort(list(DISTINCT concat(CAST({RANK.format(p='platform')} AS VARCHAR), platform))), lambda x: substr(x, 2)), ',') AS platforms
FROM v_releases GROUP BY month
""")
def platform_presence(spark, d):
    return C.platform_presence(B.releases(spark, d)).select("month", F.array_join("platforms", ",").alias("platforms"))


@query("calendar_changes", f"""
WITH after AS (SELECT title, date, month, platforms, urls, image, slug_if_tracked FROM ({merge_sql('v_releases')}) a),
 before AS (SELECT title, date, month, platforms, urls, image, slug_if_tracked FROM ({merge_sql("(SELECT * FROM v_releases WHERE platform IN ('pc','switch')) b")}) c)
SELECT 'added' AS change, count(*) AS n FROM (SELECT * FROM after EXCEPT ALL SELECT * FROM before) x
UNION ALL SELECT 'removed', count(*) FROM (SELECT * FROM before EXCEPT ALL SELECT * FROM after) y
""")
def calendar_changes(spark, d):
    rel = B.releases(spark, d)
    before = C.merge_calendar(rel.where(F.col("platform").isin("pc", "switch")))
    after = C.merge_calendar(rel)
    return C.change_counts(C.calendar_changes(before, after))


@query("union_entries", """
SELECT title, month, platform, url, NULL::VARCHAR AS edition FROM v_releases WHERE platform = 'pc'
UNION ALL SELECT title, month, platform, url, 'console' FROM v_releases WHERE platform <> 'pc'
""")
def union_entries(spark, d):
    rel = B.releases(spark, d).select("title", "month", "platform", "url")
    console = rel.where(F.col("platform") != "pc").withColumn("edition", F.lit("console"))
    return rel.where(F.col("platform") == "pc").unionByName(console, allowMissingColumns=True)


@query("union_distinct_by_key", """
SELECT url, title, seq FROM (SELECT *, row_number() OVER (PARTITION BY url, title ORDER BY feed, seq) rn FROM
  (SELECT url, title, seq, CASE WHEN platform = 'pc' THEN 0 ELSE 1 END AS feed FROM v_releases) x) y WHERE rn = 1
""")
def union_distinct_by_key(spark, d):
    from ..functions.ordering import first_per_key

    rel = B.releases(spark, d).select("url", "title", "seq", "platform")
    first = rel.where(F.col("platform") == "pc").withColumn("feed", F.lit(0))
    second = rel.where(F.col("platform") != "pc").withColumn("feed", F.lit(1))
    return first_per_key(first.unionByName(second), ["url", "title"], [F.col("feed"), F.col("seq")]).select("url", "title", "seq")


@query("sort_platforms", f"""
SELECT slug, array_to_string(platforms, ',') AS platforms FROM v_catalog
""")
def sort_platforms(spark, d):
    # pc, switch, xbox come first; ps5 is not a calendar platform and goes last
    mixed = F.concat(F.reverse("platforms"), F.col("platforms"))
    return B.catalog(spark, d).select("slug", F.array_join(X.sort_platforms(mixed), ",").alias("platforms"))


@query("norm_title", """
SELECT doc_id AS k, regexp_replace(lower(nfc_normalize(text)), '[^\\p{L}\\p{N}]+', '', 'g') AS raw_key FROM documents
""")
def norm_title_query(spark, d):
    return B.table(spark, d, "documents").select(F.col("doc_id").alias("k"), norm_title("text").alias("raw_key"))
