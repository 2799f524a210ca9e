"""Checked queries over version comparison, existence checks and runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions.ordering import first_per_key
from ..operators import changes as C
from ..operators import health as H
from ..operators import prices as P
from . import bindings as B
from .registry import query, view

# Two versions of the price table: the state at the end of 1998 and at the end.
view("v_prev", """
SELECT * EXCLUDE (rn) FROM (SELECT o.*, row_number() OVER (PARTITION BY slug, channel, cc
  ORDER BY d DESC, l_orderkey DESC, l_linenumber DESC, amount DESC, list_amount DESC NULLS LAST, currency DESC) rn
  FROM v_obs o WHERE d < DATE '2000-01-01') x WHERE rn = 1
""")
view("v_cur", """
SELECT slug, channel, cc, currency, CASE WHEN discount_pct = 10 THEN NULL ELSE amount END AS amount, list_amount, discount_pct, sale_ends_at
FROM v_latest WHERE d >= DATE '1998-01-01'
""")


def previous(spark, d):
    rows = B.observations(spark, d).where(F.col("d") < F.lit("2000-01-01").cast("date"))
    return first_per_key(rows, ["slug", "channel", "cc"], [F.col(c).desc_nulls_last() for c in B.LATEST_ORDER])


def current(spark, d):
    rows = B.latest(spark, d).where(F.col("d") >= F.lit("1998-01-01").cast("date"))
    return rows.withColumn("amount", F.when(F.col("discount_pct") == 10, None).otherwise(F.col("amount")))


@query("carry_forward", """
SELECT coalesce(c.slug, p.slug) AS slug, coalesce(c.channel, p.channel) AS channel, coalesce(c.cc, p.cc) AS cc,
  CASE WHEN c.slug IS NOT NULL THEN c.amount ELSE p.amount END AS amount,
  CASE WHEN c.slug IS NOT NULL THEN c.currency ELSE p.currency END AS currency, c.slug IS NULL AS carried
FROM v_cur c FULL JOIN v_prev p ON c.slug = p.slug AND c.channel = p.channel AND c.cc = p.cc
WHERE CASE WHEN c.slug IS NOT NULL THEN c.amount ELSE p.amount END IS NOT NULL
""")
def carry_forward(spark, d):
    return C.carry_forward(current(spark, d), previous(spark, d)).select("slug", "channel", "cc", "amount", "currency", "carried")


@query("carry_failed_sources", """
WITH failed AS (SELECT DISTINCT n_regionkey AS source FROM nation WHERE n_regionkey >= 3)
SELECT o_orderkey AS item, CAST(o_custkey AS BIGINT) AS cust, 'new' AS version, c_nationkey AS source FROM orders JOIN customer ON o_custkey = c_custkey
 JOIN nation ON c_nationkey = n_nationkey WHERE o_orderstatus <> 'O' AND n_regionkey NOT IN (SELECT source FROM failed)
UNION ALL
SELECT o_orderkey, CAST(o_custkey AS BIGINT), 'old', c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey
 JOIN nation ON c_nationkey = n_nationkey WHERE o_orderstatus = 'O' AND n_regionkey IN (SELECT source FROM failed)
""")
def carry_failed_sources(spark, d):
    items = B.table(spark, d, "orders").join(B.table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("item"), F.col("o_custkey").cast("bigint").alias("cust"), "o_orderstatus", F.col("c_nationkey").alias("source"))
    new = items.where(F.col("o_orderstatus") != "O").drop("o_orderstatus").withColumn("version", F.lit("new"))
    old = items.where(F.col("o_orderstatus") == "O").drop("o_orderstatus").withColumn("version", F.lit("old"))
    runs = B.table(spark, d, "nation").select(F.col("n_nationkey").alias("source"), (F.col("n_regionkey") < 3).alias("ok"))
    return C.carry_failed_sources(new, old, runs)


@query("snapshot_diff", """
WITH j AS (SELECT coalesce(c.slug, p.slug) AS slug, coalesce(c.channel, p.channel) AS channel, c.slug IS NOT NULL AS now,
   c.slug IS NOT NULL AND p.slug IS NOT NULL AND c.currency IS NOT DISTINCT FROM p.currency AND c.amount IS NOT DISTINCT FROM p.amount
   AND c.list_amount IS NOT DISTINCT FROM p.list_amount AND c.discount_pct IS NOT DISTINCT FROM p.discount_pct
   AND c.sale_ends_at IS NOT DISTINCT FROM p.sale_ends_at AS same
  FROM v_cur c FULL JOIN v_prev p ON c.slug = p.slug AND c.channel = p.channel AND c.cc = p.cc)
SELECT slug, channel, CASE WHEN count(*) FILTER (WHERE now) = 0 THEN 'skipped' WHEN bool_and(same) THEN 'unchanged' ELSE 'changed' END AS status,
  count(*) FILTER (WHERE now) AS n_now FROM j GROUP BY 1, 2
""")
def snapshot_diff(spark, d):
    return C.snapshot_diff(previous(spark, d), current(spark, d))


@query("offer_price_change", """
SELECT c.p_partkey AS package_id, c.p_name AS name, CASE WHEN c.p_size < 25 THEN DATE '2000-01-01' ELSE DATE '2001-01-01' END AS changed_at,
  NOT (c.p_size < 25 AND c.p_size > 5) AS rewrite FROM part c
""")
def offer_price_change(spark, d):
    part = B.table(spark, d, "part")
    cur = part.select(F.col("p_partkey").alias("package_id"), F.col("p_name").alias("name"),
                      F.sha2(F.col("p_retailprice").cast("string"), 256).alias("price_digest"), F.lit("2001-01-01").cast("date").alias("changed_at"))
    prev = part.select(F.col("p_partkey").alias("package_id"),
                       F.when(F.col("p_size") > 5, F.col("p_name")).otherwise(F.lit("old name")).alias("name"),
                       F.when(F.col("p_size") < 25, F.sha2(F.col("p_retailprice").cast("string"), 256)).otherwise(F.lit("-")).alias("price_digest"),
                       F.lit("2000-01-01").cast("date").alias("changed_at"))
    return C.offer_price_change(prev, cur)


@query("coverage_drop", """
WITH p AS (SELECT slug, channel, count(*) AS n FROM v_prev GROUP BY 1, 2), c AS (SELECT slug, channel, count(*) AS n FROM v_cur GROUP BY 1, 2)
SELECT coalesce(p.slug, c.slug) AS slug, coalesce(p.channel, c.channel) AS channel, coalesce(p.n, 0) AS n_previous, coalesce(c.n, 0) AS n_current,
  coalesce(p.n, 0) > 0 AND coalesce(c.n, 0) < coalesce(p.n, 0) * 0.8::DOUBLE AS keep_previous
FROM p FULL JOIN c ON p.slug = c.slug AND p.channel = c.channel
""")
def coverage_drop(spark, d):
    return C.coverage_drop(previous(spark, d), current(spark, d))


@query("first_coverage", """
WITH c AS (SELECT slug, channel, count(*) AS n_regions FROM v_cur GROUP BY 1, 2),
 m AS (SELECT c.*, CAST(CASE channel WHEN 'steam' THEN 10 WHEN 'eshop' THEN ceil((CASE WHEN nsuid_americas IS NOT NULL THEN 6 ELSE 0 END
    + CASE WHEN nsuid_europe IS NOT NULL THEN 9 ELSE 0 END + CASE WHEN nsuid_japan IS NOT NULL THEN 1 ELSE 0 END) * 0.8) ELSE 0 END AS INT) AS minimum
   FROM c JOIN v_catalog g ON c.slug = g.slug
   WHERE NOT EXISTS (SELECT 1 FROM v_obs p WHERE p.slug = c.slug AND p.channel = c.channel AND p.d < DATE '1998-01-01'))
SELECT * FROM m WHERE n_regions < minimum
""")
def first_coverage(spark, d):
    before = B.observations(spark, d).where(F.col("d") < F.lit("1998-01-01").cast("date"))
    return C.first_coverage(current(spark, d), before, B.catalog(spark, d))


@query("raw_only_projection", "SELECT slug, channel, cc, currency, amount, list_amount, discount_pct, sale_ends_at FROM v_usd")
def raw_only_projection(spark, d):
    ranked = P.rank_regions(B.prices_usd(spark, d)).drop("d", "l_orderkey", "l_linenumber")
    return C.raw_only(ranked)


@query("missing_artifacts", """
SELECT slug FROM v_catalog WHERE steam_app_id IS NOT NULL AND slug NOT IN (SELECT slug FROM v_us WHERE channel = 'steam')
""")
def missing_artifacts(spark, d):
    return C.missing_artifacts(B.catalog(spark, d), B.us_prices(spark, d).where(F.col("channel") == "steam"), F.col("steam_app_id").isNotNull())


@query("orphans", "SELECT slug, channel, cc FROM v_latest WHERE slug NOT IN (SELECT slug FROM v_catalog WHERE tier = 'core')")
def orphans(spark, d):
    core = B.catalog(spark, d).where(F.col("tier") == "core")
    return C.orphans(B.latest(spark, d), core).select("slug", "channel", "cc")


@query("not_in_catalog", """
SELECT DISTINCT 100000 + l_partkey AS steam_app_id, CASE WHEN 100000 + l_partkey IN (SELECT steam_app_id FROM v_catalog WHERE steam_app_id IS NOT NULL)
  THEN 'already_in_catalog' END AS reason FROM lineitem
""")
def not_in_catalog(spark, d):
    pool = B.table(spark, d, "lineitem").select((F.lit(100000) + F.col("l_partkey")).alias("steam_app_id")).distinct()
    return C.not_in_catalog(pool, B.catalog(spark, d), "steam_app_id")


@query("track_slug", """
SELECT l_orderkey, l_linenumber, l_suppkey, 100000 + l_partkey AS steam_app_id, s.slug AS slug_if_tracked FROM lineitem
LEFT JOIN (SELECT steam_app_id, max(slug) AS slug FROM v_catalog WHERE steam_app_id IS NOT NULL GROUP BY 1) s ON 100000 + l_partkey = s.steam_app_id
""")
def track_slug(spark, d):
    feed = B.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", (F.lit(100000) + F.col("l_partkey")).alias("steam_app_id"))
    return C.track_slug(feed, B.catalog(spark, d), "steam_app_id")


@query("duplicates", """
SELECT slug, title FROM v_catalog WHERE title IN (SELECT title FROM v_catalog GROUP BY title HAVING count(*) > 1)
""")
def duplicates(spark, d):
    return C.duplicates(B.catalog(spark, d).select("slug", "title"), ["title"])


IDS = ("steam_app_id", "nsuid_americas", "nsuid_europe", "nsuid_japan", "nintendo_us_slug", "xbox_big_id", "psn_product_id")
LONG = " UNION ALL ".join(f"SELECT slug, '{i}' AS id_kind, CAST({i} AS VARCHAR) AS id FROM v_catalog WHERE {i} IS NOT NULL" for i in IDS)
view("v_ids", LONG)


@query("duplicate_values", """
SELECT id_kind, id, count(*) AS n, min(slug) AS first_owner, max(slug) AS last_owner FROM v_ids GROUP BY 1, 2 HAVING count(*) > 1
""")
def duplicate_values(spark, d):
    return C.duplicate_values(B.catalog(spark, d), "slug", IDS)


@query("owner_conflicts", """
SELECT DISTINCT concat('i', CAST(l_suppkey AS VARCHAR)) AS slug, 'steam_app_id' AS id_kind, id, v.slug AS owner
FROM lineitem JOIN v_ids v ON v.id_kind = 'steam_app_id' AND v.id = CAST(100000 + l_partkey AS VARCHAR)
""")
def owner_conflicts(spark, d):
    items = B.table(spark, d, "lineitem").select(
        F.concat(F.lit("i"), F.col("l_suppkey").cast("string")).alias("slug"), (F.lit(100000) + F.col("l_partkey")).alias("steam_app_id"))
    return C.owner_conflicts(items, B.catalog(spark, d), ["steam_app_id"])


@query("contiguous", """
SELECT l_orderkey, count(*) AS n, count(DISTINCT l_linenumber) AS n_distinct, CAST(min(l_linenumber) - 1 AS INT) AS lo, CAST(max(l_linenumber) - 1 AS INT) AS hi
FROM lineitem GROUP BY l_orderkey
HAVING count(*) <> count(DISTINCT l_linenumber) OR min(l_linenumber) <> 1 OR max(l_linenumber) <> count(*)
""")
def contiguous(spark, d):
    li = B.table(spark, d, "lineitem").select("l_orderkey", (F.col("l_linenumber") - 1).alias("pos"))
    return C.contiguous(li, ["l_orderkey"], "pos").select("l_orderkey", "n", "n_distinct", "lo", "hi")


@query("is_sorted", """
SELECT event_type, event_id, value FROM (SELECT *, lag(value) OVER (PARTITION BY 1 ORDER BY event_id) AS before FROM events) x WHERE before > value
""")
def is_sorted(spark, d):
    ev = B.table(spark, d, "events").select(F.lit(1).alias("doc"), "event_id", "event_type", "value")
    return C.unsorted_rows(ev, ["doc"], "event_id", ["value"]).select("event_type", "event_id", "value")


FNV = "CAST(list_reduce(list_transform(string_split(slug, ''), lambda c: CAST(ascii(c) AS BIGINT)), lambda acc, x: (xor(acc, x) * 16777619) & 4294967295, CAST(2166136261 AS BIGINT)) % {n} AS INT)"
view("v_shards", f"SELECT slug, tier, title, {FNV.format(n=7)} AS shard, {FNV.format(n=14)} AS meta_shard FROM v_catalog")


@query("fnv_shard", "SELECT slug, shard, meta_shard FROM v_shards")
def fnv_shard(spark, d):
    return B.catalog(spark, d).select("slug", X.fnv_shard("slug", 7).alias("shard"), X.fnv_shard("slug", 14).alias("meta_shard"))


@query("select_run", "SELECT slug, tier FROM v_shards WHERE tier = 'extended' AND shard = 3")
def select_run(spark, d):
    return C.select_run(B.catalog(spark, d), "extended", 3).select("slug", "tier")


@query("cursor_page", """
SELECT slug, title FROM v_catalog WHERE xbox_big_id IS NULL AND slug > 'p15' ORDER BY slug LIMIT 50
""")
def cursor_page(spark, d):
    return C.cursor_page(B.catalog(spark, d), F.col("xbox_big_id").isNull(), "p15", 50).select("slug", "title")


@query("cursor_totals", """
WITH m AS (SELECT slug FROM v_catalog WHERE xbox_big_id IS NULL), p AS (SELECT slug FROM m WHERE slug > 'p15' ORDER BY slug LIMIT 50)
SELECT (SELECT count(*) FROM m) AS n_missing, (SELECT count(*) FROM m WHERE slug > 'p15') AS n_remaining, (SELECT count(*) FROM p) AS page_rows,
 CASE WHEN (SELECT count(*) FROM m WHERE slug > 'p15') > (SELECT count(*) FROM p) THEN (SELECT max(slug) FROM p) END AS next_cursor
""")
def cursor_totals(spark, d):
    return C.cursor_totals(B.catalog(spark, d), F.col("xbox_big_id").isNull(), "p15", 50)


# ------------------------------------------------------------ runs and freshness

view("v_ledger", """
WITH f AS (SELECT source, run_at, seq, ok FROM v_runs WHERE NOT targeted),
 s AS (SELECT source, run_at, seq FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY run_at DESC, seq DESC) rn FROM f WHERE ok) x WHERE rn = 1)
SELECT f.source, max(f.run_at) AS last_attempt, max(s.run_at) AS last_success,
  count(*) FILTER (WHERE NOT f.ok AND (s.run_at IS NULL OR (f.run_at, f.seq) > (s.run_at, s.seq))) AS streak
FROM f LEFT JOIN s ON f.source = s.source GROUP BY f.source
""")


def ledger(spark, d):
    return H.source_ledger(B.runs(spark, d))


@query("failure_streak", "SELECT * FROM v_ledger")
def failure_streak(spark, d):
    return ledger(spark, d)


@query("run_complete", """
SELECT user_id, count(*) AS expected, count(*) FILTER (WHERE event_type = 'purchase') AS changed,
  count(*) FILTER (WHERE event_type IN ('view','click','signup')) AS unchanged, 0 AS skipped, count(*) FILTER (WHERE event_type = 'error' AND value > 20) AS failed,
  count(*) > 0 AND count(*) FILTER (WHERE event_type <> 'error') = count(*) AND count(*) FILTER (WHERE event_type = 'error' AND value > 20) = 0 AS complete
FROM events GROUP BY user_id
""")
def run_complete(spark, d):
    kind = F.col("event_type")
    runs = B.table(spark, d, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("expected"), F.count_if(kind == "purchase").alias("changed"),
        F.count_if(kind.isin("view", "click", "signup")).alias("unchanged"), F.lit(0).alias("skipped"),
        F.count_if((kind == "error") & (F.col("value") > 20)).alias("failed"))
    return H.run_complete(runs)


STATE = """SELECT *, CASE WHEN last_success IS NULL THEN 'down'
   WHEN greatest(0, epoch_us(TIMESTAMP '2024-01-31 12:00:00') - epoch_us(last_success)) <= 3600000000 * budget_hours AND streak = 0 THEN 'fresh'
   WHEN greatest(0, epoch_us(TIMESTAMP '2024-01-31 12:00:00') - epoch_us(last_success)) <= 7200000000 * budget_hours AND
     (streak = 0 OR greatest(0, epoch_us(TIMESTAMP '2024-01-31 12:00:00') - epoch_us(last_success)) <= 7200000000 * budget_hours) THEN 'stale'
   ELSE 'down' END AS state FROM (SELECT *, 13 AS budget_hours FROM v_ledger) x"""


@query("freshness", STATE)
def freshness(spark, d):
    return H.source_states(ledger(spark, d), "2024-01-31T12:00:00Z", F.lit(13))


@query("stale_sources", f"SELECT source, state FROM ({STATE}) y WHERE state <> 'fresh'")
def stale_sources(spark, d):
    return H.stale_sources(ledger(spark, d), "2024-01-31T12:00:00Z", F.lit(13)).select("source", "state")


KEYS = ("CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'meta' WHEN 'BUILDING' THEN concat('meta:shard-', CAST(c_custkey % 14 AS VARCHAR)) "
        "WHEN 'FURNITURE' THEN concat('steam-regional:extended-', CAST(c_custkey % 7 AS VARCHAR)) WHEN 'MACHINERY' THEN 'steam-offers' ELSE 'rates' END")


@query("budget_hours", f"""
SELECT c_custkey, {KEYS} AS source, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 360 WHEN 'BUILDING' THEN 360 WHEN 'FURNITURE' THEN 192 WHEN 'MACHINERY' THEN 192 ELSE 26 END AS budget FROM customer
""")
def budget_hours(spark, d):
    return B.table(spark, d, "customer").select("c_custkey", F.expr(KEYS.replace("VARCHAR", "STRING")).alias("source")).withColumn(
        "budget", X.budget_hours("source"))


view("v_required", "SELECT concat('src', CAST(n_nationkey AS VARCHAR)) AS source FROM nation WHERE n_regionkey < 3")


@query("fleet_freshness", """
SELECT min(last_success) AS fleet_stamp, count(*) FILTER (WHERE last_success IS NULL) AS missing_members, count(*) AS members
FROM v_required r LEFT JOIN v_ledger l ON r.source = l.source
""")
def fleet_freshness(spark, d):
    required = B.table(spark, d, "nation").where(F.col("n_regionkey") < 3).select(F.concat(F.lit("src"), F.col("n_nationkey").cast("string")).alias("source"))
    return H.fleet_freshness(ledger(spark, d), required)


@query("data_updated_at", "SELECT greatest((SELECT max(ts) FROM events), (SELECT max(o_orderdate) FROM orders), (SELECT max(l_shipdate) FROM lineitem)) AS updated_at")
def data_updated_at(spark, d):
    return H.data_updated_at(
        B.table(spark, d, "events").select(F.col("ts").alias("stamp")),
        B.table(spark, d, "orders").select(F.col("o_orderdate").alias("stamp")),
        B.table(spark, d, "lineitem").select(F.col("l_shipdate").alias("stamp")))


@query("health_rollup", """
SELECT source, last_success AS stamp FROM v_ledger
UNION ALL SELECT concat('src', CAST(n_nationkey AS VARCHAR)), max(o_orderdate) FROM nation JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey
WHERE concat('src', CAST(n_nationkey AS VARCHAR)) NOT IN (SELECT source FROM v_ledger) GROUP BY 1
""")
def health_rollup(spark, d):
    docs = B.table(spark, d, "orders").join(B.table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy(
        F.concat(F.lit("src"), F.col("c_nationkey").cast("string")).alias("source")).agg(F.max("o_orderdate").alias("stamp"))
    return H.health_rollup(ledger(spark, d), docs)


@query("source_lookup", """
WITH g AS (SELECT s.slug, u.channel, CASE WHEN u.channel = 'steam' AND s.tier = 'extended' THEN concat('steam-regional:extended-', CAST(s.shard AS VARCHAR))
   ELSE CASE u.channel WHEN 'steam' THEN 'steam-regional' WHEN 'eshop' THEN 'eshop-regional' WHEN 'xbox' THEN 'xbox-us' ELSE 'psn-us' END END AS source
  FROM v_shards s JOIN (SELECT DISTINCT slug, channel FROM v_usd) u ON s.slug = u.slug),
 l AS (SELECT CASE WHEN user_id % 10 < 7 THEN concat('steam-regional:extended-', CAST(user_id % 10 AS VARCHAR)) ELSE 'eshop-regional' END AS source,
   max(ts) FILTER (WHERE event_type <> 'error') AS last_success FROM events WHERE event_type <> 'signup' GROUP BY 1)
SELECT g.slug, g.channel, g.source, l.last_success FROM g LEFT JOIN l ON g.source = l.source
""")
def source_lookup(spark, d):
    games = B.catalog(spark, d).select("slug", "tier").join(B.prices_usd(spark, d).select("slug", "channel").distinct(), "slug")
    n = F.col("user_id") % 10
    runs = B.table(spark, d, "events").select(
        F.when(n < 7, F.concat(F.lit("steam-regional:extended-"), n.cast("string"))).otherwise("eshop-regional").alias("source"),
        F.col("ts").alias("run_at"), F.col("event_id").alias("seq"), (F.col("event_type") != "error").alias("ok"), (F.col("event_type") == "signup").alias("targeted"))
    return H.source_lookup(games, H.source_ledger(runs)).select("slug", "channel", "source", "last_success")


@query("covered_keys", """
SELECT 'steam-regional' AS source UNION ALL SELECT DISTINCT concat('steam-regional:extended-', CAST(shard AS VARCHAR)) FROM v_shards WHERE tier = 'extended'
""")
def covered_keys(spark, d):
    return H.covered_keys(B.catalog(spark, d), "steam-regional")


@query("member_shards", "SELECT DISTINCT shard FROM v_shards")
def member_shards(spark, d):
    return H.member_shards(B.catalog(spark, d))


@query("stalest_shard", """
SELECT CAST(user_id % 14 AS INT) AS shard, max(ts) FILTER (WHERE event_type <> 'error') AS last_success FROM events GROUP BY 1
ORDER BY last_success NULLS FIRST, shard LIMIT 1
""")
def stalest_shard(spark, d):
    led = B.table(spark, d, "events").groupBy(F.concat(F.lit("meta:shard-"), (F.col("user_id") % 14).cast("string")).alias("source")).agg(
        F.max(F.when(F.col("event_type") != "error", F.col("ts"))).alias("last_success"))
    return H.stalest_shard(led, "meta")


@query("daily_admissions", """
SELECT CAST(o_orderdate + to_hours(CAST(o_custkey % 24 AS INT)) + INTERVAL 9 HOUR AS DATE) AS day, CAST(sum(o_custkey % 9) AS BIGINT) AS admitted,
  CAST(greatest(25 - sum(o_custkey % 9), 0) AS BIGINT) AS room, sum(o_custkey % 9) > 25 AS over_cap FROM orders GROUP BY 1
""")
def daily_admissions(spark, d):
    o = B.table(spark, d, "orders")
    applied = F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_custkey") % 24).cast("int"))
    return H.daily_admissions(o.select(applied.alias("applied_at"), (F.col("o_custkey") % 9).alias("items")), cap=25)


@query("reused_batches", """
SELECT o_custkey AS batch_id FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1
""")
def reused_batches(spark, d):
    return H.reused_batches(B.table(spark, d, "orders").select(F.col("o_custkey").alias("batch_id"), F.col("o_orderpriority").alias("digest")))


@query("weekly_stability", """
WITH w AS (SELECT user_id, date_trunc('week', ts) AS week, count(*) AS n, min(ts) AS lo, max(ts) AS hi FROM events WHERE event_type = 'purchase' AND value > 10 GROUP BY 1, 2)
SELECT user_id AS source, count(*) AS weeks, max(n) AS most_in_week,
  count(*) >= 2 AND max(n) = 1 AND epoch(max(hi)) - epoch(min(lo)) >= 518400 AS stable FROM w GROUP BY 1
""")
def weekly_stability(spark, d):
    ev = B.table(spark, d, "events").select(
        F.col("user_id").alias("source"), F.col("ts").alias("run_at"), ((F.col("event_type") == "purchase") & (F.col("value") > 10)).alias("complete"))
    return H.weekly_stability(ev)


@query("requests_per_day", """
SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS requests, max(ts) AS last_request, count(*) > 3 AS over_limit FROM events GROUP BY 1, 2
""")
def requests_per_day(spark, d):
    return H.requests_per_day(B.table(spark, d, "events"), 3)


@query("spacing_breaches", """
SELECT user_id, count(*) AS breaches FROM (SELECT user_id, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS gap FROM events) x
WHERE gap < 600000000 GROUP BY 1
""")
def spacing_breaches(spark, d):
    return H.spacing_breaches(B.table(spark, d, "events"), 600)
