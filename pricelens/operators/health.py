"""Source runs, freshness, admissions and request quotas.

A source may own a large share of all runs, so streaks and last successes are
aggregates over the run log, never windows over one source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X


def run_complete(runs: DataFrame) -> DataFrame:
    """A run is complete when every expected item was verified, no more no less."""
    ok = (
        (F.col("expected") > 0)
        & (F.col("changed") + F.col("unchanged") == F.col("expected"))
        & (F.col("skipped") == 0) & (F.col("failed") == 0)
    )
    return runs.withColumn("complete", ok)


def source_ledger(runs: DataFrame) -> DataFrame:
    """Last attempt, last success and failures since then, per source.

    ``runs`` holds (source, run_at, seq, ok, targeted).  Runs aimed at single
    items say nothing about the source and are left out.
    """
    full = runs.where(~F.coalesce("targeted", F.lit(False))).select("source", "run_at", "seq", "ok")
    at = F.struct("run_at", "seq")
    last = full.groupBy("source").agg(
        F.max("run_at").alias("last_attempt"),
        F.max(F.when(F.col("ok"), at)).alias("last_ok"))
    failures = (
        full.where(~F.col("ok")).join(last.select("source", "last_ok"), "source")
        .where(F.col("last_ok").isNull() | (at > F.col("last_ok")))
        .groupBy("source").agg(F.count(F.lit(1)).alias("streak"))
    )
    return last.join(failures, "source", "left").select(
        "source", "last_attempt", F.col("last_ok.run_at").alias("last_success"),
        F.coalesce("streak", F.lit(0)).cast("bigint").alias("streak"))


def source_states(ledger: DataFrame, as_of, budget: Column | None = None) -> DataFrame:
    """fresh / stale / down of every source."""
    hours = X.budget_hours("source") if budget is None else budget
    return ledger.withColumn("budget_hours", hours).withColumn(
        "state", X.freshness("last_success", "budget_hours", "streak", as_of))


def stale_sources(ledger: DataFrame, as_of, budget: Column | None = None) -> DataFrame:
    return source_states(ledger, as_of, budget).where(F.col("state") != "fresh")


def fleet_freshness(ledger: DataFrame, required: DataFrame) -> DataFrame:
    """A fleet is as fresh as its oldest member; members without any success
    are counted."""
    j = required.select("source").distinct().join(ledger.select("source", "last_success"), "source", "left")
    return j.agg(
        F.min("last_success").alias("fleet_stamp"),
        F.count_if(F.col("last_success").isNull()).alias("missing_members"),
        F.count(F.lit(1)).alias("members"))


def data_updated_at(*stamped: DataFrame) -> DataFrame:
    """Newest of all stamps; every input has one column ``stamp``."""
    both = stamped[0].agg(F.max("stamp").alias("stamp"))
    for df in stamped[1:]:
        both = both.unionByName(df.agg(F.max("stamp").alias("stamp")))
    return both.agg(F.max("stamp").alias("updated_at"))


def health_rollup(ledger: DataFrame, stamps: DataFrame) -> DataFrame:
    """One row per source with its last success; document stamps fill in for
    sources that keep no run log."""
    own = ledger.select("source", F.col("last_success").alias("stamp"))
    other = stamps.select("source", "stamp").join(own.select("source"), "source", "left_anti")
    return own.unionByName(other)


# Health key of a store, fixed values.
BASE_KEYS = {"steam": "steam-regional", "eshop": "eshop-regional", "xbox": "xbox-us", "psn": "psn-us"}
EXTENDED_SHARDS = 7


def source_key(channel: str = "channel", tier: str = "tier", slug: str = "slug") -> Column:
    """Ledger key of a game's store; only the long tail of one store is sharded."""
    sharded = F.concat(F.lit("steam-regional:extended-"), X.fnv_shard(slug, EXTENDED_SHARDS).cast("string"))
    long_tail = (F.col(channel) == "steam") & F.coalesce(F.col(tier) == "extended", F.lit(False))
    return F.when(long_tail, sharded).otherwise(X.relabel(channel, BASE_KEYS))


def source_lookup(games: DataFrame, ledger: DataFrame) -> DataFrame:
    keyed = games.withColumn("source", source_key())
    return keyed.join(ledger.select("source", "last_success"), "source", "left")


def covered_keys(games: DataFrame, base: str, tier: str | None = None, shard: int | None = None) -> DataFrame:
    """Ledger keys one run may stamp."""
    spark = games.sparkSession
    if tier == "core":
        return spark.range(1).select(F.lit(base).alias("source"))
    if tier == "extended":
        return spark.range(1).select(F.lit(f"{base}:extended-{shard}").alias("source"))
    members = games.where(F.col("tier") == "extended").select(
        F.concat(F.lit(f"{base}:extended-"), X.fnv_shard("slug", EXTENDED_SHARDS).cast("string")).alias("source")).distinct()
    return spark.range(1).select(F.lit(base).alias("source")).unionByName(members)


def member_shards(games: DataFrame, shards: int = EXTENDED_SHARDS) -> DataFrame:
    return games.select(X.fnv_shard("slug", shards).alias("shard")).distinct()


def stalest_shard(ledger: DataFrame, base: str) -> DataFrame:
    """The shard whose last success is oldest; never-run shards first."""
    shard = F.regexp_extract("source", "^" + base + r":(?:extended|shard)-(\d+)$", 1)
    rows = ledger.withColumn("shard", shard).where(F.col("shard") != "").withColumn("shard", F.col("shard").cast("int"))
    return rows.orderBy(F.col("last_success").asc_nulls_first(), "shard").limit(1).select("shard", "last_success")


def daily_admissions(receipts: DataFrame, tz: str = "Asia/Tokyo", cap: int = 1000) -> DataFrame:
    """Items admitted per local day against the daily cap.  ``applied_at`` is
    a UTC timestamp without zone."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), F.col("applied_at")).cast("date")
    return (
        receipts.groupBy(local.alias("day")).agg(F.sum("items").cast("bigint").alias("admitted"))
        .withColumn("room", F.greatest(F.lit(cap) - F.col("admitted"), F.lit(0)).cast("bigint"))
        .withColumn("over_cap", F.col("admitted") > cap)
    )


def reused_batches(receipts: DataFrame) -> DataFrame:
    """Batch ids bound to more than one digest."""
    return (
        receipts.groupBy("batch_id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi"))
        .where(F.col("lo") != F.col("hi")).select("batch_id")
    )


def weekly_stability(runs: DataFrame, min_days: int = 6) -> DataFrame:
    """Sources with complete runs in at least two weeks, at most one a week,
    whose first and last are far enough apart."""
    done = runs.where(F.col("complete")).withColumn("week", F.date_trunc("week", "run_at"))
    weeks = done.groupBy("source", "week").agg(
        F.count(F.lit(1)).alias("n"), F.min("run_at").alias("lo"), F.max("run_at").alias("hi"))
    span = F.unix_seconds(F.col("hi").cast("timestamp")) - F.unix_seconds(F.col("lo").cast("timestamp"))
    return (
        weeks.groupBy("source").agg(
            F.count(F.lit(1)).alias("weeks"), F.max("n").alias("most_in_week"),
            F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .select("source", "weeks", "most_in_week",
                ((F.col("weeks") >= 2) & (F.col("most_in_week") == 1) & (span >= min_days * 86400)).alias("stable"))
    )


def requests_per_day(log: DataFrame, limit: int, keys: tuple[str, ...] = ("user_id",)) -> DataFrame:
    """Requests per client and UTC day with the breach flag."""
    return (
        log.groupBy(*keys, F.col("ts").cast("date").alias("day"))
        .agg(F.count(F.lit(1)).alias("requests"), F.max("ts").alias("last_request"))
        .withColumn("over_limit", F.col("requests") > limit)
    )


def spacing_breaches(log: DataFrame, min_seconds: float, keys: tuple[str, ...] = ("user_id",)) -> DataFrame:
    """How often a client's request followed the one before too closely.

    Requests fall into slots of the minimum spacing.  All but the first of one
    slot are too close to their predecessor, and the first one is exactly when
    it is too close to the last request of the slot before.  Only slot totals
    are joined, so a very busy client is never sorted in one task.
    """
    micros = int(min_seconds * 1_000_000)
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    slots = log.groupBy(*keys, F.floor(us / F.lit(micros)).alias("slot")).agg(
        F.count(F.lit(1)).alias("n"), F.min(us).alias("lo"), F.max(us).alias("hi"))
    prev = slots.select(*keys, (F.col("slot") + 1).alias("slot"), F.col("hi").alias("prev_hi"))
    close = F.when(F.col("lo") - F.col("prev_hi") < micros, 1).otherwise(0)
    return (
        slots.join(prev, [*keys, "slot"], "left")
        .groupBy(*keys).agg(F.sum(F.col("n") - 1 + close).cast("bigint").alias("breaches"))
        .where(F.col("breaches") > 0)
    )
