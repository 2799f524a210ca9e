"""Checked queries over matching and search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions import text as T
from ..operators import matching as M
from . import bindings as B
from .registry import query, view

KEY = "regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}]+', '', 'g')"

# Store search results: one document per line item.
view("v_docs", """
SELECT l_orderkey, concat('p', CAST(l_partkey AS VARCHAR)) AS slug,
  concat(p_name, ' ', CAST(l_partkey AS VARCHAR), CASE WHEN l_linenumber = 5 THEN ' for Nintendo Switch' WHEN l_linenumber = 6 THEN ' Deluxe' ELSE '' END) AS title,
  concat('7001', lpad(CAST(l_partkey + CASE WHEN l_quantity = 50 THEN 5000000 ELSE 0 END AS VARCHAR), 10, '0')) AS main_id,
  l_quantity = 49 AS two_ids,
  CASE WHEN l_returnflag = 'R' THEN 'BEE' ELSE 'HAC' END AS code_gen,
  CASE WHEN l_returnflag = 'R' OR l_quantity = 48 THEN 'BEE' ELSE 'HAC' END AS system_gen,
  CASE WHEN l_quantity = 47 THEN 'DLC' ELSE 'game' END AS type, l_quantity = 46 AS removed,
  CASE WHEN l_quantity = 45 THEN 'TBA' ELSE concat(CAST(CAST(l_shipdate AS DATE) AS VARCHAR), 'T00:00:00Z') END AS release,
  CASE WHEN l_tax = 0 THEN NULL WHEN l_tax = 0.01 THEN 0.0 ELSE l_extendedprice END AS price_lowest, l_extendedprice AS price_regular
FROM lineitem JOIN part ON l_partkey = p_partkey
""")


def docs(spark, d):
    rows = B.table(spark, d, "lineitem").join(B.table(spark, d, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    qty, line = F.col("l_quantity"), F.col("l_linenumber")
    main = F.concat(F.lit("7001"), F.lpad((F.col("l_partkey") + F.when(qty == 50, 5000000).otherwise(0)).cast("string"), 10, "0"))
    bee = F.col("l_returnflag") == "R"
    return rows.select(
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("slug"),
        F.concat("p_name", F.lit(" "), F.col("l_partkey").cast("string"),
                 F.when(line == 5, " for Nintendo Switch").when(line == 6, " Deluxe").otherwise("")).alias("title"),
        F.when(qty == 49, F.array(main, F.lit("70019999999999"))).otherwise(F.array(main, F.lit("70050000000001"), main)).alias("nsuids"),
        F.array(F.when(bee, "BEE-P").otherwise("HAC-A")).alias("codes"),
        F.array(F.when(bee | (qty == 48), "Nintendo Switch 2").otherwise("Nintendo Switch")).alias("systems"),
        F.when(qty == 47, "DLC").otherwise("game").alias("type"), (qty == 46).alias("removed"),
        F.when(qty == 45, "TBA").otherwise(F.concat(F.col("l_shipdate").cast("date").cast("string"), F.lit("T00:00:00Z"))).alias("release"),
        F.when(F.col("l_tax") == 0, None).when(F.col("l_tax") == 0.01, 0.0).otherwise(F.col("l_extendedprice")).alias("price_lowest"),
        F.col("l_extendedprice").alias("price_regular"),
    )


view("v_targets", """
SELECT concat('p', CAST(p_partkey AS VARCHAR)) AS slug, concat(upper(p_name), ' - ', CAST(p_partkey AS VARCHAR)) AS title, p_size,
  p_size <= 30 AS hac, p_size > 20 AND p_size <= 48 AS bee FROM part
""")


def targets(spark, d):
    size = F.col("p_size")
    return B.table(spark, d, "part").select(
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("slug"),
        F.concat(F.upper("p_name"), F.lit(" - "), F.col("p_partkey").cast("string")).alias("title"),
        F.array_compact(F.array(F.lit("pc"), F.when(size <= 30, "switch"), F.when((size > 20) & (size <= 48), "switch-2"))).alias("platforms"))


USABLE = ("NOT two_ids AND code_gen = system_gen AND upper(type) = 'GAME' AND NOT removed "
          "AND coalesce(try_cast(release AS TIMESTAMP) <= TIMESTAMP '2001-06-01', false) AND coalesce(price_lowest, price_regular) > 0")

view("v_usable", f"""
SELECT *, regexp_replace({KEY.format(c='title')}, 'fornintendoswitch$', '') AS k FROM v_docs WHERE {USABLE}
""")


@query("title_match", f"""
WITH c AS (SELECT DISTINCT concat(slug, '-', CAST(l_orderkey AS VARCHAR)) AS cand_id, regexp_replace({KEY.format(c='title')}, 'fornintendoswitch$', '') AS k FROM v_docs)
SELECT t.slug AS id, count(c.cand_id) AS n_matches, CASE WHEN count(c.cand_id) = 1 THEN min(c.cand_id) END AS match_id
FROM v_targets t LEFT JOIN c ON {KEY.format(c='t.title')} = c.k GROUP BY t.slug
""")
def title_match(spark, d):
    li = B.table(spark, d, "lineitem").join(B.table(spark, d, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    part = F.col("l_partkey").cast("string")
    cands = li.select(
        F.concat(F.lit("p"), part, F.lit("-"), F.col("l_orderkey").cast("string")).alias("cand_id"),
        F.concat("p_name", F.lit(" "), part, F.when(F.col("l_linenumber") == 5, " for Nintendo Switch")
                 .when(F.col("l_linenumber") == 6, " Deluxe").otherwise("")).alias("title"))
    return M.title_match(targets(spark, d).select(F.col("slug").alias("id"), "title"), cands)


@query("resolve_region_match", f"""
WITH m AS (SELECT t.slug, t.hac, t.bee, u.main_id, max(CASE WHEN u.code_gen = 'HAC' THEN 1 ELSE 0 END) AS any_hac FROM v_targets t
   JOIN v_usable u ON {KEY.format(c='t.title')} = u.k AND ((t.hac AND u.code_gen = 'HAC') OR (t.bee AND u.code_gen = 'BEE')) GROUP BY 1, 2, 3, 4),
 g AS (SELECT slug, count(*) AS n, min(main_id) AS nsuid FROM m GROUP BY 1),
 h AS (SELECT k, main_id, bool_or(code_gen = 'HAC') AS has_hac, min(title) AS title FROM v_usable GROUP BY 1, 2),
 s AS (SELECT t.slug, CASE WHEN NOT t.hac AND NOT t.bee THEN 'exception' WHEN n IS NULL THEN 'none' WHEN n > 1 THEN 'exception' ELSE 'matched' END AS status,
  CASE WHEN NOT t.hac AND NOT t.bee THEN 'missing_switch_generation' WHEN n IS NULL THEN 'no_exact_paid_released_generation_match' WHEN n > 1 THEN 'ambiguous_exact_matches' END AS reason, g.nsuid, t.title AS want
  FROM v_targets t LEFT JOIN g ON t.slug = g.slug)
SELECT s.slug, 'europe' AS region, status, reason, CASE WHEN status = 'matched' THEN nsuid END AS nsuid,
  CASE WHEN status = 'matched' THEN CASE WHEN has_hac THEN 'HAC' ELSE 'BEE' END END AS generation, CASE WHEN status = 'matched' THEN h.title END AS matched_title
FROM s LEFT JOIN h ON s.status = 'matched' AND h.k = {KEY.format(c='s.want')} AND h.main_id = s.nsuid
""")
def resolve_region_match(spark, d):
    return M.resolve_region_match(docs(spark, d), targets(spark, d), "europe", M.eu_purchasable(B.AS_OF))


@query("eu_purchasable", """
SELECT type, removed, price_lowest IS NULL AS no_low, count(*) AS n,
  count(*) FILTER (WHERE upper(type) = 'GAME' AND NOT removed AND coalesce(try_cast(release AS TIMESTAMP) <= TIMESTAMP '2001-06-01', false) AND coalesce(price_lowest, price_regular) > 0) AS n_ok
FROM v_docs GROUP BY 1, 2, 3
""")
def eu_purchasable(spark, d):
    return docs(spark, d).withColumn("ok", M.eu_purchasable(B.AS_OF)).groupBy(
        "type", "removed", F.col("price_lowest").isNull().alias("no_low")).agg(F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("n_ok"))


@query("jp_purchasable", """
SELECT o_orderkey, o_orderstatus <> 'P' AND o_orderpriority NOT LIKE '1%' AND o_orderpriority NOT LIKE '5%' AND o_totalprice > 1000 AS ok FROM orders
""")
def jp_purchasable(spark, d):
    o = B.table(spark, d, "orders")
    pr = F.col("o_orderpriority")
    return o.select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", "sold out").otherwise("onsale").alias("sales_status"),
        pr.startswith("1").alias("upgrade"), F.when(pr.startswith("5"), "dlc pack").otherwise("hard").alias("form"),
        F.lit(None).cast("string").alias("form_name"), F.lit("game").alias("category"),
        F.when(F.col("o_totalprice") > 1000, F.col("o_totalprice")).otherwise(0.0).alias("current_price"), F.lit(99.0).alias("price"),
    ).select("o_orderkey", M.jp_purchasable().alias("ok"))


@query("generation", """
SELECT code_gen, system_gen, CASE WHEN code_gen = system_gen THEN code_gen END AS generation, count(*) AS n FROM v_docs GROUP BY 1, 2
""")
def generation(spark, d):
    return docs(spark, d).select(
        F.when(F.element_at("codes", 1).startswith("BEE"), "BEE").otherwise("HAC").alias("code_gen"),
        F.when(F.element_at("systems", 1).endswith("2"), "BEE").otherwise("HAC").alias("system_gen"),
        M.generation("codes", "systems").alias("generation")).groupBy("code_gen", "system_gen", "generation").agg(F.count(F.lit(1)).alias("n"))


WHY = """CASE WHEN {k} <> want THEN 'title_mismatch' WHEN upper(type) <> 'GAME' THEN 'not_game' WHEN two_ids THEN 'base_nsuid_missing_or_ambiguous'
  WHEN removed THEN 'eshop_removed' WHEN NOT coalesce(try_cast(release AS TIMESTAMP) <= TIMESTAMP '2001-06-01', false) THEN 'not_released'
  WHEN NOT coalesce(price_lowest, price_regular) > 0 THEN 'paid_digital_evidence_missing' WHEN code_gen <> system_gen THEN 'generation_missing_or_conflicting' END"""

view("v_judged", f"""
SELECT x.*, {WHY.format(k='k')} AS why FROM (SELECT d.*, regexp_replace({KEY.format(c='d.title')}, 'fornintendoswitch$', '') AS k, {KEY.format(c='t.title')} AS want
  FROM v_docs d JOIN v_targets t ON d.slug = t.slug) x
""")


def owners(spark, d):
    return B.catalog(spark, d).where(F.col("nsuid_americas").isNotNull()).select(
        F.col("nsuid_americas").alias("nsuid"), F.concat(F.lit("x"), F.col("slug")).alias("owner")).where(F.col("owner").endswith("7"))


@query("resolve_enrichment", """
WITH a AS (SELECT slug, count(*) AS n_docs, count(*) FILTER (WHERE coalesce(why, '') <> 'title_mismatch') AS n_exact FROM v_judged GROUP BY 1),
 p AS (SELECT slug, count(DISTINCT concat(main_id, code_gen)) AS n, min(main_id) AS nsuid, min(code_gen) AS gen FROM v_judged WHERE why IS NULL GROUP BY 1),
 o AS (SELECT DISTINCT nsuid_americas AS nsuid FROM v_catalog WHERE nsuid_americas IS NOT NULL AND slug LIKE '%7'),
 r AS (SELECT t.slug, p.nsuid, p.gen, coalesce(n_docs, 0) AS n_docs, coalesce(n_exact, 0) AS n_exact,
   CASE WHEN p.n IS NULL AND coalesce(n_exact, 0) = 0 THEN 'no_exact_title_match' WHEN p.n IS NULL THEN 'no_exact_paid_released_base_generation_match'
     WHEN p.n > 1 THEN 'ambiguous_exact_matches' WHEN o.nsuid IS NOT NULL THEN 'catalog_nsuid_owned_by_other_slug' END AS reason
   FROM v_targets t LEFT JOIN a ON t.slug = a.slug LEFT JOIN p ON t.slug = p.slug LEFT JOIN o ON p.nsuid = o.nsuid)
SELECT slug, CASE WHEN reason IS NULL THEN 'matched' ELSE 'rejected' END AS status, reason, CASE WHEN reason IS NULL THEN nsuid END AS nsuid,
  CASE WHEN reason IS NULL THEN gen END AS generation, n_docs, n_exact FROM r
""")
def resolve_enrichment(spark, d):
    out = M.resolve_enrichment(docs(spark, d), targets(spark, d), owners(spark, d), B.AS_OF)
    return out.select("slug", "status", "reason", "nsuid", "generation", "n_docs", "n_exact")


@query("enrichment_rejects", "SELECT slug, why AS reason, count(*) AS n FROM v_judged WHERE why IS NOT NULL GROUP BY 1, 2")
def enrichment_rejects(spark, d):
    return M.enrichment_rejects(docs(spark, d), targets(spark, d), B.AS_OF)


@query("enrichment_cache_hit", """
SELECT o_orderkey, concat('c', CAST(o_custkey AS VARCHAR)) AS slug, o_orderstatus AS title FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderstatus = CASE WHEN c_acctbal > 0 THEN 'O' ELSE 'F' END AND o_orderpriority <> '1-URGENT'
  AND o_orderdate <= TIMESTAMP '2001-06-01' AND o_orderdate >= TIMESTAMP '2001-05-02'
""")
def enrichment_cache_hit(spark, d):
    cache = B.table(spark, d, "orders").select(
        "o_orderkey", F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("slug"), F.col("o_orderstatus").alias("title"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "old").otherwise("url").alias("source_url"), F.col("o_orderdate").alias("collected_at"))
    want = B.table(spark, d, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("slug"), F.when(F.col("c_acctbal") > 0, "O").otherwise("F").alias("title"), F.lit("url").alias("source_url"))
    return M.enrichment_cache_hit(cache, want, B.AS_OF, 30).select("o_orderkey", "slug", "title")


@query("exact_unique_suggestion", f"""
WITH g AS (SELECT {KEY.format(c='p_name')} AS k, count(DISTINCT p_partkey) AS n, min(p_partkey) AS product_id FROM part WHERE p_type = 'SMALL' AND p_size = 7 GROUP BY 1)
SELECT concat('p', CAST(p_partkey AS VARCHAR)) AS slug, product_id FROM part JOIN g ON {KEY.format(c='p_name')} = g.k AND g.n = 1
""")
def exact_unique_suggestion(spark, d):
    part = B.table(spark, d, "part")
    game = (F.col("p_type") == "SMALL") & (F.col("p_size") == 7)
    results = part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("title"), F.when(game, "Game").otherwise("Movie").alias("kind"))
    titles = part.select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("slug"), F.upper("p_name").alias("title"))
    return M.exact_unique_suggestion(results, titles)


@query("sitemap_locate", """
WITH s AS (SELECT DISTINCT concat('p', CAST(l_partkey AS VARCHAR), CASE WHEN l_linenumber <= 2 THEN '-switch' WHEN l_linenumber <= 4 THEN '-switch-2' WHEN l_linenumber = 5 THEN '' ELSE '-gone' END) AS product_slug
   FROM lineitem),
 t AS (SELECT slug, CASE WHEN p_size = 1 THEN concat(slug, '-gone') END AS hint, hac, bee FROM v_targets),
 k AS (SELECT slug, 'audited_hint' AS located_by, hint AS product_slug FROM t WHERE hint IS NOT NULL
   UNION ALL SELECT slug, 'sitemap_slug', concat(slug, '-switch-2') FROM t WHERE hint IS NULL AND bee
   UNION ALL SELECT slug, 'sitemap_slug', concat(slug, '-switch') FROM t WHERE hint IS NULL AND hac
   UNION ALL SELECT slug, 'sitemap_slug', slug FROM t WHERE hint IS NULL)
SELECT k.slug, k.located_by, k.product_slug, concat('https://shop.example/', k.product_slug) AS url FROM k JOIN s ON k.product_slug = s.product_slug
""")
def sitemap_locate(spark, d):
    line = F.col("l_linenumber")
    slug = F.concat(F.lit("p"), F.col("l_partkey").cast("string"),
                    F.when(line <= 2, "-switch").when(line <= 4, "-switch-2").when(line == 5, "").otherwise("-gone"))
    sitemap = B.table(spark, d, "lineitem").select(slug.alias("product_slug"))
    sitemap = sitemap.withColumn("url", F.concat(F.lit("https://shop.example/"), "product_slug"))
    want = targets(spark, d).join(B.table(spark, d, "part").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("slug"), "p_size"), "slug")
    want = want.withColumn("hint", F.when(F.col("p_size") == 1, F.concat("slug", F.lit("-gone"))))
    return M.sitemap_locate(want, sitemap).select("slug", "located_by", "product_slug", "url")


LINKS = "regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)"


@query("url_reconcile", f"""
WITH b AS (SELECT DISTINCT concat('/', split_part(regexp_replace(url, '[?#].*$', ''), '/', -1)) AS url FROM pages),
 l AS (SELECT DISTINCT unnest({LINKS}) AS url FROM pages)
SELECT coalesce(b.url, l.url) AS url, CASE WHEN l.url IS NULL THEN 'not_listed' ELSE 'no_page' END AS status FROM b FULL JOIN l ON b.url = l.url
WHERE b.url IS NULL OR l.url IS NULL
""")
def url_reconcile(spark, d):
    pages = B.table(spark, d, "pages")
    bare = F.regexp_replace("url", "[?#].*$", "")
    built = pages.select(F.concat(F.lit("/"), F.element_at(F.split(bare, "/"), -1)).alias("url"))
    listed = pages.select(F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))).alias("url"))
    return M.url_reconcile(built, listed)


# Misspelt titles as queries: the letter e left out, and the last word cut to
# what a reader has typed so far.
TERMS = "list_distinct(list_filter(regexp_split_to_array(lower({c}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> ''))"


@query("fuzzy_title_search", f"""
WITH a AS (SELECT DISTINCT query, unnest({TERMS.format(c='query')}) AS q FROM (SELECT DISTINCT replace(p_name, 'e', '') AS query FROM part) x),
 v AS (SELECT DISTINCT title, unnest({TERMS.format(c='title')}) AS t FROM (SELECT DISTINCT p_name AS title FROM part) y),
 k AS (SELECT DISTINCT q, CAST(least(floor(length(q) * 0.2::DOUBLE + 0.5::DOUBLE), 6) AS INT) AS k FROM a),
 m AS (SELECT k.q, w.t, CASE WHEN k.q = w.t THEN 3 WHEN starts_with(w.t, k.q) THEN 2 ELSE 1 END AS quality FROM k JOIN (SELECT DISTINCT t FROM v) w
   ON starts_with(w.t, k.q) OR (k.k > 0 AND levenshtein(k.q, w.t) <= k.k)),
 b AS (SELECT a.query, v.title, a.q, max(m.quality) AS quality FROM a JOIN m ON a.q = m.q JOIN v ON v.t = m.t GROUP BY 1, 2, 3),
 s AS (SELECT query, title, CAST(sum(quality) AS BIGINT) AS score FROM b GROUP BY 1, 2)
SELECT query, slug, title, score, CAST(place AS INT) AS place FROM (SELECT s.query, c.slug, s.title, s.score,
   row_number() OVER (PARTITION BY s.query ORDER BY score DESC, s.title, c.slug) AS place FROM s JOIN v_catalog c ON s.title = c.title) z WHERE place <= 8
""")
def fuzzy_title_search(spark, d):
    asked = B.table(spark, d, "part").select(F.replace(F.col("p_name"), F.lit("e"), F.lit("")).alias("query")).distinct()
    return M.fuzzy_title_search(asked, B.catalog(spark, d)).select("query", "slug", "title", "score", F.col("place").cast("int").alias("place"))


@query("org_key", """
SELECT s_suppkey, trim(regexp_replace(regexp_replace(lower(concat(s_name, ' Co., Ltd')), '\\b(?:incorporated|inc|ltd|limited|llc|corp|corporation|co)\\b', '', 'g'), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS org FROM supplier
""")
def org_key(spark, d):
    return B.table(spark, d, "supplier").select("s_suppkey", T.org_key(F.concat("s_name", F.lit(" Co., Ltd"))).alias("org"))


@query("junk_title", """
SELECT doc_id, regexp_matches(lower(text), '\\b(demo|playtest|soundtrack|dlc|art\\s*book|trailer|the)\\b') AS junk FROM documents
""")
def junk_title(spark, d):
    pattern = T.CALENDAR_JUNK.replace("trailer", "trailer|the")
    return B.table(spark, d, "documents").select("doc_id", T.junk_title("text", pattern).alias("junk"))


@query("id_patterns", """
SELECT slug, regexp_full_match(slug, '[a-z0-9]+(?:-[a-z0-9]+)*') AS slug_ok, coalesce(regexp_full_match(nsuid_americas, '7001\\d{10}'), false) AS nsuid_ok,
  coalesce(regexp_full_match(xbox_big_id, '[A-Z0-9]{12}'), false) AS xbox_ok, coalesce(regexp_full_match(psn_product_id, '[A-Z]{2}\\d{4}-[A-Z0-9_]{12}-[A-Z0-9_]{16}'), false) AS psn_ok FROM v_catalog
""")
def id_patterns(spark, d):
    return B.catalog(spark, d).select(
        "slug", X.matches("slug", X.SLUG_SHAPE).alias("slug_ok"), X.matches("nsuid_americas", X.NSUID_SHAPE).alias("nsuid_ok"),
        X.matches("xbox_big_id", X.XBOX_SHAPE).alias("xbox_ok"), X.matches("psn_product_id", X.PSN_PRODUCT_SHAPE).alias("psn_ok"))
