"""Checked queries over reconciled imports and aged evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import evidence as E
from ..operators import imports as I
from . import bindings as B
from .quality_queries import any_of, rule, told
from .registry import query, view

# what a batch declares: catalog rows, some of them changed since
STEAM = ("US", *[f"C{100 + n}" for n in range(25) if n != 1])
ESHOP = {"americas": ("US", "C100", "C102", "C103", "C124"), "europe": ("C106", "C107", "C119", "C122", "C123"), "japan": ("C112",)}
SWEEP = {"steam": STEAM, "eshop": ESHOP, "steam_minimum": 3, "eshop_ratio": 0.4}

view("v_import_items", """
SELECT concat('i', CAST(p.p_partkey AS VARCHAR)) AS key, p.p_size, c.p_partkey,
  CASE WHEN p.p_size = 1 THEN concat('gone', CAST(p.p_partkey AS VARCHAR)) ELSE c.slug END AS slug,
  CASE WHEN p.p_size = 2 THEN 'other' WHEN p.p_size = 3 THEN upper(c.title) ELSE c.title END AS title,
  CASE WHEN p.p_size % 2 = 0 THEN 'new_game' ELSE 'add_platform_mapping' END AS catalog_action,
  CASE WHEN p.p_size = 4 THEN c.steam_app_id + 1 ELSE c.steam_app_id END AS steam_app_id,
  CASE WHEN p.p_size = 5 THEN c.nsuid_americas || '0' ELSE c.nsuid_americas END AS nsuid_americas,
  CASE WHEN p.p_size = 6 THEN c.nsuid_europe || '0' ELSE c.nsuid_europe END AS nsuid_europe,
  CASE WHEN p.p_size = 7 THEN c.nsuid_japan || '0' ELSE c.nsuid_japan END AS nsuid_japan,
  CASE WHEN p.p_size = 8 THEN 'x' ELSE c.nintendo_us_slug END AS nintendo_us_slug,
  c.psn_product_id, CASE WHEN p.p_size = 9 THEN 'x' END AS psn_concept_id,
  CASE WHEN p.p_size = 10 THEN 'deluxe' ELSE c.psn_edition END AS psn_edition,
  c.xbox_big_id, CASE WHEN p.p_size = 11 THEN 'deluxe' ELSE c.xbox_edition END AS xbox_edition,
  CASE WHEN p.p_size = 12 THEN list_append(c.platforms, 'switch-2') ELSE c.platforms END AS platforms
FROM part p JOIN v_catalog c ON p.p_partkey = c.p_partkey
""")


def items(spark, d):
    size = F.col("p_size")
    cat = B.catalog(spark, d).join(B.table(spark, d, "part").select("p_partkey", "p_size"), "p_partkey")
    changed = lambda c, at, to: F.when(size == at, to).otherwise(F.col(c)).alias(c)
    return cat.select(
        F.concat(F.lit("i"), F.col("p_partkey").cast("string")).alias("key"), "p_size", "p_partkey",
        changed("slug", 1, F.concat(F.lit("gone"), F.col("p_partkey").cast("string"))),
        F.when(size == 2, "other").when(size == 3, F.upper("title")).otherwise(F.col("title")).alias("title"),
        F.when(size % 2 == 0, "new_game").otherwise("add_platform_mapping").alias("catalog_action"),
        changed("steam_app_id", 4, F.col("steam_app_id") + 1),
        *[changed(f"nsuid_{g}", at, F.concat(f"nsuid_{g}", F.lit("0"))) for g, at in (("americas", 5), ("europe", 6), ("japan", 7))],
        changed("nintendo_us_slug", 8, F.lit("x")), "psn_product_id", F.when(size == 9, "x").alias("psn_concept_id"),
        changed("psn_edition", 10, F.lit("deluxe")), "xbox_big_id", changed("xbox_edition", 11, F.lit("deluxe")),
        F.when(size == 12, F.array_append("platforms", F.lit("switch-2"))).otherwise(F.col("platforms")).alias("platforms"))


# metadata of the sweep: some items have none, no name, a longer title, an edition's title or an open image address
view("v_import_meta", """
SELECT concat('p', CAST(p_partkey AS VARCHAR)) AS slug,
  CASE WHEN p_size = 21 THEN ' - ' WHEN p_size = 22 THEN concat(p_name, ' Remake') WHEN p_size = 24 THEN concat(p_name, ' for Nintendo Switch') ELSE p_name END AS name,
  CASE WHEN p_size = 23 THEN 'http://img.example/a.jpg' WHEN p_size <> 25 THEN 'https://img.example/a.jpg' END AS header_image
FROM part WHERE p_size <> 20
""")


def meta(spark, d):
    p, s = B.table(spark, d, "part"), F.col("p_size")
    return p.where(s != 20).select(
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("slug"),
        F.when(s == 21, " - ").when(s == 22, F.concat("p_name", F.lit(" Remake"))).when(s == 24, F.concat("p_name", F.lit(" for Nintendo Switch"))).otherwise(F.col("p_name")).alias("name"),
        F.when(s == 23, "http://img.example/a.jpg").when(s != 25, "https://img.example/a.jpg").alias("header_image"))


# prices of the sweep: the latest, and for some games a second row in lower case
view("v_import_rows", """
SELECT slug, channel, cc, currency, amount FROM v_latest
UNION ALL SELECT slug, channel, lower(cc), currency, amount FROM v_latest WHERE slug LIKE '%13' AND cc LIKE 'C%'
""")


def rows(spark, d):
    latest = B.latest(spark, d).select("slug", "channel", "cc", "currency", "amount")
    again = latest.where(F.col("slug").endswith("13") & F.col("cc").startswith("C")).withColumn("cc", F.lower("cc"))
    return latest.unionByName(again)


def first_events(spark, d):
    obs = B.observations(spark, d).where((F.col("currency") == "USD") & (F.col("l_linenumber") <= 3))
    return obs.select("slug", "channel", "cc", F.col("amount").alias("usd"))


def _list(values):
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


view("v_import_plan", f"""
SELECT key, slug, 'steam' AS channel, {_list(STEAM)} AS expected, 3 AS minimum, true AS us FROM v_import_items WHERE steam_app_id IS NOT NULL
UNION ALL SELECT key, slug, 'psn', ['US'], 1, true FROM v_import_items WHERE psn_product_id IS NOT NULL
UNION ALL SELECT key, slug, 'xbox', ['US'], 1, true FROM v_import_items WHERE xbox_big_id IS NOT NULL
UNION ALL SELECT key, slug, 'eshop', expected, CAST(ceil(len(expected) * 0.4::DOUBLE) AS INTEGER), nsuid_americas IS NOT NULL FROM (
  SELECT *, list_concat(CASE WHEN nsuid_americas IS NOT NULL THEN {_list(ESHOP['americas'])} ELSE [] END,
                        CASE WHEN nsuid_europe IS NOT NULL THEN {_list(ESHOP['europe'])} ELSE [] END,
                        CASE WHEN nsuid_japan IS NOT NULL THEN {_list(ESHOP['japan'])} ELSE [] END) AS expected
  FROM v_import_items) x WHERE len(expected) > 0
""")
view("v_import_checked", """
SELECT p.*, coalesce(a.n, 0) AS n, coalesce(a.regions, 0) AS regions, coalesce(a.native, false) AS native,
  (SELECT count(DISTINCT upper(cc)) FROM v_import_rows r WHERE r.slug = p.slug AND r.channel = p.channel AND list_contains(p.expected, upper(r.cc))) AS covered
FROM v_import_plan p LEFT JOIN (
  SELECT slug, channel, count(*) AS n, count(DISTINCT upper(cc)) AS regions, bool_or(upper(cc) = 'US' AND currency = 'USD' AND amount > 0) AS native
  FROM v_import_rows GROUP BY 1, 2) a ON p.slug = a.slug AND p.channel = a.channel
""")
STORE = "concat(key, '/', channel)"
BOTH = "v_import_items i JOIN v_catalog c ON i.slug = c.slug"


@query("reconcile_import", any_of(
    rule("import_not_in_catalog", "key", "v_import_items WHERE slug NOT IN (SELECT slug FROM v_catalog)"),
    rule("import_title_drift", "i.key", f"{BOTH} WHERE regexp_replace(lower(i.title), '[^a-z0-9]', '', 'g') <> regexp_replace(lower(c.title), '[^a-z0-9]', '', 'g')"),
    rule("import_steam_drift", "i.key", f"{BOTH} WHERE i.p_size = 4 AND i.steam_app_id IS NOT NULL"),
    rule("import_nsuid_americas_drift", "i.key", f"{BOTH} WHERE i.nsuid_americas <> c.nsuid_americas"),
    rule("import_nsuid_europe_drift", "i.key", f"{BOTH} WHERE i.nsuid_europe <> c.nsuid_europe"),
    rule("import_nsuid_japan_drift", "i.key", f"{BOTH} WHERE i.nsuid_japan <> c.nsuid_japan"),
    rule("import_us_slug_drift", "i.key", f"{BOTH} WHERE i.nintendo_us_slug IS DISTINCT FROM c.nintendo_us_slug AND i.nintendo_us_slug IS NOT NULL"),
    rule("import_psn_drift", "i.key", f"{BOTH} WHERE i.psn_product_id IS NOT NULL AND i.p_size IN (9, 10)"),
    rule("import_xbox_drift", "i.key", f"{BOTH} WHERE i.xbox_big_id IS NOT NULL AND i.p_size = 11"),
    rule("import_generation_drift", "i.key", f"{BOTH} WHERE i.p_size = 12 AND coalesce(i.nsuid_americas, i.nsuid_europe, i.nsuid_japan) IS NOT NULL"),
    rule("import_prices_missing", STORE, "v_import_checked WHERE n = 0"),
    rule("import_region_repeat", STORE, "v_import_checked WHERE n <> regions"),
    rule("import_coverage_low", STORE, "v_import_checked WHERE n > 0 AND covered < minimum"),
    rule("import_us_price_missing", STORE, "v_import_checked WHERE n > 0 AND us AND NOT native"),
    rule("import_us_event_missing", STORE, "v_import_plan p WHERE us AND NOT EXISTS (SELECT 1 FROM v_obs o WHERE o.slug = p.slug AND o.channel = p.channel AND o.cc = 'US' AND o.currency = 'USD' AND o.l_linenumber <= 3)"),
    rule("import_meta_missing", "key", "v_import_items WHERE slug NOT IN (SELECT slug FROM v_import_meta)"),
    rule("import_meta_name", "key", "v_import_items i JOIN v_import_meta m ON i.slug = m.slug WHERE m.name = ' - '"),
    rule("import_meta_title", "key", "v_import_items i JOIN v_import_meta m ON i.slug = m.slug WHERE catalog_action = 'new_game' AND (name LIKE '% Remake' OR i.title = 'other')"),
    rule("import_meta_image", "key", "v_import_items i JOIN v_import_meta m ON i.slug = m.slug WHERE header_image IS NULL OR header_image NOT LIKE 'https://%'")))
def reconcile_import(spark, d):
    return told(I.reconcile_import(items(spark, d), B.catalog(spark, d).withColumn("psn_concept_id", F.lit(None).cast("string")),
                                   rows(spark, d), first_events(spark, d), meta(spark, d), **SWEEP))


@query("region_overlap", """
SELECT p.key, p.channel, CAST(len(list_filter(expected, lambda e: list_contains(have, e))) AS INT) AS n_covered,
  coalesce(list_aggregate(list_sort(list_filter(expected, lambda e: list_contains(have, e))), 'string_agg', ','), '') AS covered,
  coalesce(list_aggregate(list_sort(list_filter(expected, lambda e: NOT list_contains(have, e))), 'string_agg', ','), '') AS missing,
  coalesce(list_aggregate(list_sort(list_filter(have, lambda e: NOT list_contains(expected, e))), 'string_agg', ','), '') AS extra
FROM (SELECT p.*, coalesce(a.have, []) AS have FROM v_import_plan p LEFT JOIN (SELECT slug, channel, list(DISTINCT upper(cc)) AS have FROM v_import_rows GROUP BY 1, 2) a
      ON p.slug = a.slug AND p.channel = a.channel) p
""")
def region_overlap(spark, d):
    """Wanted regions that arrived, that did not, and that nobody asked for."""
    out = I.region_overlap(I.declared(items(spark, d), **SWEEP), rows(spark, d))
    told_ = lambda c: F.concat_ws(",", F.array_sort(c)).alias(c)
    return out.select("key", "channel", F.size("covered").alias("n_covered"), told_("covered"), told_("missing"), told_("extra"))


# candidates of three stores with blocks of evidence; p_size names what is wrong with one
view("v_evidence_catalog", """
SELECT slug, title, p_partkey, steam_app_id, nsuid_americas, nsuid_europe, nsuid_japan, nintendo_us_slug, platforms, psn_product_id, psn_edition,
  CASE WHEN psn_product_id IS NOT NULL THEN lpad(CAST(p_partkey AS VARCHAR), 8, '0') END AS psn_concept_id,
  CASE WHEN p_partkey % 3 <> 0 THEN xbox_big_id END AS xbox_big_id, CASE WHEN p_partkey % 3 <> 0 THEN xbox_edition END AS xbox_edition
FROM v_catalog
""")


def evidence_catalog(spark, d):
    own = F.col("p_partkey") % 3 != 0
    return B.catalog(spark, d).withColumns({
        "psn_concept_id": F.when(F.col("psn_product_id").isNotNull(), F.lpad(F.col("p_partkey").cast("string"), 8, "0")),
        "xbox_big_id": F.when(own, F.col("xbox_big_id")), "xbox_edition": F.when(own, F.col("xbox_edition"))})


SIGNED = ("candidate_id", "slug", "title", "catalog_action", "nintendo_us_slug")


def kept_candidates(spark, d):
    p, s, key = B.table(spark, d, "part"), F.col("p_size"), F.col("p_partkey")
    text = key.cast("string")
    kind = F.when(F.col("p_type").isin("STANDARD", "MEDIUM"), "psn").when(F.col("p_type").isin("PROMO", "SMALL"), "xbox").otherwise("ns")
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    p = p.withColumn("kind", kind)
    ns = F.col("kind") == "ns"
    new = ns & (s % 2 == 0)
    p = p.withColumns({
        "am": F.when(ns & (s != 9), F.concat(F.lit("7001"), pad(key + 5000000, 10))), "eu": F.when(ns, F.concat(F.lit("7001"), pad(key + 6000000, 10))),
        "pid": F.when(F.col("kind") == "psn", F.concat(F.lit("UP0002-PPSA"), pad(F.when(s == 17, F.lit(1)).otherwise(key), 8), F.lit("-GAME"), pad(key, 12))),
        "xid": F.when(F.col("kind") == "xbox", F.concat(F.lit("8N"), pad(key, 10)))})
    ident = F.when(ns, F.concat(F.lit("ns:"), F.when(s == 1, "7002").otherwise(""), F.when(s == 6, F.lit("70010000000001")).when(s == 9, F.col("eu")).otherwise(F.col("am"))))
    ident = ident.when(F.col("pid").isNotNull(), F.concat(F.lit("psn:"), "pid")).otherwise(F.concat(F.lit("xbox:"), "xid"))

    def block(name, at="2001-05-20T00:00:00Z", until=None, product_slug=None, nsuid=None, forged=F.lit(False)):
        body = F.concat(F.lit(name), text)
        lit = lambda x: F.lit(None).cast("string") if x is None else x if not isinstance(x, str) else F.lit(x)
        return F.struct(F.lit(name).alias("block"), lit(at).alias("observed_at"), lit(until).alias("expires_at"),
                        F.concat(F.lit("sha256:"), F.sha2(F.when(forged, "x").otherwise(body), 256)).alias("digest"), body.alias("body"),
                        lit(nsuid).alias("nsuid"), lit(product_slug).alias("product_slug"))

    old, ok, later = F.lit("2001-05-01T00:00:00Z"), F.lit("2001-05-20T00:00:00Z"), F.lit("2001-06-02T00:00:00Z")
    at = lambda *pairs: F.coalesce(*[F.when(s.isin(*sizes), v) for sizes, v in pairs], ok)
    us = {"nsuid": F.when(s == 7, "70010000000007").otherwise(F.col("am")), "product_slug": F.when(s == 8, "other").otherwise(F.concat(F.lit("us-"), text))}
    retained = F.array_compact(F.array(
        F.when(s != 12, block("us_automatic", at(((11,), old)), **us)), F.when(s == 12, block("us_manual", F.lit("soon"), **us)),
        block("popularity", at(((19,), old))), block("popularity", at(((15,), old))),
        block("europe", at(((13,), later)), forged=s == 20), F.when(s % 3 == 0, block("japan", ok)), F.when(s == 14, block("japan", old)),
        F.when(s == 16, block("exclusivity", old)), block("steam_match", at(((17,), later), ((19,), old)))))
    seen = F.when(s == 13, later).otherwise("2001-05-30T00:00:00Z")
    until = F.when(s == 11, F.lit("2001-06-07T00:00:00Z")).when(s == 12, F.lit("2001-06-01T00:00:00Z")).otherwise("2001-06-05T00:00:00Z")
    product = F.when(s != 14, F.array(block("product", seen, until))).otherwise(F.array().cast("array<struct<block:string,observed_at:string,expires_at:string,digest:string,body:string,nsuid:string,product_slug:string>>"))
    rows = p.select(
        ident.alias("candidate_id"), F.concat(F.when(new | ((s == 21) & ~ns), "n").otherwise("p"), text).alias("slug"),
        F.when(s == 22, "other").otherwise(F.col("p_name")).alias("title"), F.when(new, "new_game").otherwise("add_platform_mapping").alias("catalog_action"),
        F.when(s == 18, F.lit(100001)).alias("steam_app_id"), F.col("am").alias("nsuid_americas"), F.col("eu").alias("nsuid_europe"), F.lit(None).cast("string").alias("nsuid_japan"),
        F.when(ns & (s != 9), F.concat(F.lit("us-"), text)).alias("nintendo_us_slug"), F.col("pid").alias("psn_product_id"), F.when(s == 23, pad(F.lit(2), 8)).alias("psn_concept_id"),
        F.when(s == 1, "deluxe").otherwise("standard").alias("psn_edition"), F.col("xid").alias("xbox_big_id"), F.when(s == 1, "deluxe").otherwise("standard").alias("xbox_edition"),
        F.when(s == 4, F.array(F.lit("pc"))).when(F.col("kind") == "psn", F.array(F.lit("ps5"))).otherwise(F.array(F.lit("xbox"))).alias("platforms"),
        F.when(new & (s != 10), "eshop").alias("primary_regional_channel"), F.when(s == 4, "exception").otherwise("passed").alias("verify_status"),
        F.when(s == 5, F.array(F.lit("x"))).alias("exception_reasons"), F.when(ns, retained).otherwise(product).alias("evidence"), "p_size", text.alias("part"))
    sealed = F.when(s == 2, "x").when(s == 3, F.concat(F.lit("sha256:"), F.sha2("slug", 256))).otherwise(X.fingerprint(*SIGNED))
    return rows.withColumn("evidence_digest", sealed)


NS_KIND = "(p_type NOT IN ('STANDARD', 'MEDIUM', 'PROMO', 'SMALL'))"
view("v_kept", f"""
SELECT CAST(p_partkey AS VARCHAR) AS part, p_size, p_partkey, p_type, p_name, {NS_KIND} AS ns, {NS_KIND} AND p_size % 2 = 0 AS fresh,
  p_type IN ('STANDARD', 'MEDIUM') AS psn, p_type IN ('PROMO', 'SMALL') AS xbox FROM part
""")
view("v_block_faults", """
SELECT part, min(CASE WHEN p_size = 11 THEN 'us_automatic_expired' WHEN p_size = 12 THEN 'us_manual_time_invalid' WHEN p_size = 13 THEN 'europe_in_future' WHEN p_size = 14 THEN 'japan_expired'
  WHEN p_size = 15 THEN 'popularity_2_expired' WHEN p_size = 16 THEN 'exclusivity_expired' WHEN p_size = 17 THEN 'steam_match_in_future' WHEN p_size = 19 THEN 'popularity_1_expired'
  WHEN p_size = 20 THEN 'europe_digest_mismatch' END) AS reason, count(*) AS one FROM v_kept WHERE ns GROUP BY part
UNION ALL SELECT part, CASE WHEN p_size IN (11, 13) THEN 'product_term_invalid' WHEN p_size = 12 THEN 'product_expired' END, 1 FROM v_kept WHERE NOT ns AND p_size <> 14
""")


@query("verify_retained", """
SELECT k.part, CASE
  WHEN p_size = 1 THEN 'bad_candidate_id' WHEN p_size = 2 THEN 'bad_digest' WHEN p_size = 3 THEN 'digest_mismatch'
  WHEN ns AND p_size IN (4, 5) THEN 'discovery_not_passed' WHEN ns AND p_size = 6 THEN 'candidate_id_not_retained' WHEN ns AND p_size = 7 THEN 'americas_evidence_mismatch'
  WHEN ns AND p_size = 8 THEN 'us_slug_mismatch' WHEN ns AND p_size = 9 THEN 'us_identity_without_nsuid' WHEN fresh AND p_size = 10 THEN 'wrong_primary_channel'
  WHEN NOT ns AND p_size = 4 THEN 'platform_mismatch' WHEN NOT ns AND p_size = 14 THEN 'product_evidence_missing'
  WHEN f.reason IS NOT NULL THEN f.reason
  WHEN NOT ns AND p_size = 21 THEN 'mapping_target_missing' WHEN NOT fresh AND p_size = 22 THEN 'title_mismatch'
  WHEN p_size = 18 AND EXISTS (SELECT 1 FROM v_evidence_catalog o WHERE o.steam_app_id = 100001 AND (o.slug <> c.slug OR fresh)) THEN 'steam_id_owned'
  WHEN ns AND NOT fresh AND (c.nsuid_americas IS NOT NULL OR c.nsuid_europe IS NOT NULL) THEN 'replaces_nsuid'
  WHEN xbox AND NOT list_contains(c.platforms, 'xbox') THEN 'target_without_platform'
  WHEN psn AND c.psn_product_id IS NOT NULL THEN 'replaces_psn_identity' WHEN xbox AND c.xbox_big_id IS NOT NULL THEN 'replaces_xbox_identity'
  WHEN psn AND p_size = 23 AND EXISTS (SELECT 1 FROM v_evidence_catalog o WHERE o.psn_concept_id = '00000002') THEN 'concept_owned' END AS reason
FROM v_kept k JOIN v_evidence_catalog c ON k.p_partkey = c.p_partkey LEFT JOIN v_block_faults f ON k.part = f.part
""")
def verify_retained(spark, d):
    return E.verify_retained(kept_candidates(spark, d), evidence_catalog(spark, d), B.AS_OF, SIGNED).select("part", "reason")


@query("aged_evidence", """
SELECT k.part, CASE WHEN ns THEN 5 + CASE WHEN p_size % 3 = 0 THEN 1 ELSE 0 END + CASE WHEN p_size IN (14, 16) THEN 1 ELSE 0 END ELSE 1 END AS n_blocks,
  CASE WHEN f.reason IS NULL THEN 0 WHEN p_size = 19 THEN 2 ELSE 1 END AS n_faults, f.reason AS evidence_reason
FROM v_kept k LEFT JOIN v_block_faults f ON k.part = f.part WHERE ns OR p_size <> 14
""")
def aged_evidence(spark, d):
    """How many blocks a candidate has, how many no longer hold, and the first that does not."""
    kept = kept_candidates(spark, d).withColumn("candidate_id", F.col("part"))
    return E.aged_evidence(kept, B.AS_OF).select(F.col("candidate_id").alias("part"), F.col("n_blocks").cast("int").alias("n_blocks"), F.col("n_faults").cast("int").alias("n_faults"), "evidence_reason")
