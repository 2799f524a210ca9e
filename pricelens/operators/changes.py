"""Comparing two versions of a price table: carry-forward, diff, coverage.

Versions are keyed on (slug, channel, cc); per-game facts come from a second,
much smaller aggregation.  Duplicate and completeness checks use aggregates, so
a key shared by very many rows never meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ("slug", "channel", "cc")
FACTS = ("currency", "amount", "list_amount", "discount_pct", "sale_ends_at")


def carry_forward(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Complete a run from the previous version.

    ``current`` holds every region the run got an answer for; an answer with a
    null amount says "not sold here".  Only a region with no answer at all keeps
    its previous row, so a withdrawn product does not come back.
    """
    cur = current.select(*KEY, *[F.col(c).alias(f"__c_{c}") for c in FACTS], F.lit(True).alias("__answered"))
    prev = previous.select(*KEY, *FACTS)
    both = cur.join(prev, list(KEY), "full_outer")
    answered = F.coalesce("__answered", F.lit(False))
    picked = [F.when(answered, F.col(f"__c_{c}")).otherwise(F.col(c)).alias(c) for c in FACTS]
    return both.select(*KEY, *picked, (~answered).alias("carried")).where(F.col("amount").isNotNull())


def carry_failed_sources(feed: DataFrame, previous: DataFrame, runs: DataFrame) -> DataFrame:
    """A failed source keeps its previous items; runs hold (source, ok)."""
    failed = runs.where(~F.col("ok")).select("source").distinct()
    kept = previous.join(failed, "source", "left_semi")
    fresh = feed.join(failed, "source", "left_anti")
    return fresh.unionByName(kept)


def snapshot_diff(previous: DataFrame, current: DataFrame) -> DataFrame:
    """changed / unchanged / skipped of every game and store; stamps are ignored."""
    left = previous.select(*KEY, F.struct(*FACTS).alias("p"))
    right = current.select(*KEY, F.struct(*FACTS).alias("c"))
    rows = left.join(right, list(KEY), "full_outer")
    per_game = rows.groupBy("slug", "channel").agg(
        F.count("c").alias("n_now"), F.bool_and(F.col("p").eqNullSafe(F.col("c"))).alias("same"))
    status = F.when(F.col("n_now") == 0, "skipped").when(F.col("same"), "unchanged").otherwise("changed")
    return per_game.select("slug", "channel", status.alias("status"), "n_now")


def offer_price_change(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Change stamp of every offer: a new label alone keeps the old stamp.

    Both sides hold (package_id, name, price_digest, changed_at).
    """
    prev = previous.select("package_id", F.col("name").alias("p_name"),
                           F.col("price_digest").alias("p_digest"), F.col("changed_at").alias("p_changed"))
    j = current.join(prev, "package_id", "left")
    same_price = F.coalesce(F.col("price_digest") == F.col("p_digest"), F.lit(False))
    write = ~(same_price & F.coalesce(F.col("name") == F.col("p_name"), F.lit(False)))
    return j.select(
        "package_id", "name",
        F.when(same_price, F.col("p_changed")).otherwise(F.col("changed_at")).alias("changed_at"),
        write.alias("rewrite"))


def coverage_drop(previous: DataFrame, current: DataFrame, keep: float = 0.8) -> DataFrame:
    """Keep the previous version where the new one lost too many regions."""
    n = lambda df, name: df.groupBy("slug", "channel").agg(F.count(F.lit(1)).alias(name))
    both = n(previous, "n_previous").join(n(current, "n_current"), ["slug", "channel"], "full_outer")
    both = both.fillna(0, ["n_previous", "n_current"])
    return both.withColumn(
        "keep_previous", (F.col("n_previous") > 0) & (F.col("n_current") < F.col("n_previous") * F.lit(keep)))


# Number of regions in each store group, and the fewest a first version covers, fixed values.
ESHOP_GROUPS = {"americas": 6, "europe": 9, "japan": 1}
STEAM_MINIMUM = 10


def minimum_regions(channel: str = "channel") -> Column:
    """Regions a first version must cover, given the game's mapped groups."""
    mapped = sum(
        (F.when(F.col(f"nsuid_{g}").isNotNull(), n).otherwise(0) for g, n in ESHOP_GROUPS.items()),
        F.lit(0))
    return (
        F.when(F.col(channel) == "steam", STEAM_MINIMUM)
        .when(F.col(channel) == "eshop", F.ceil(mapped * F.lit(0.8)).cast("int"))
        .otherwise(0)
    )


def first_coverage(current: DataFrame, previous: DataFrame, catalog: DataFrame) -> DataFrame:
    """Games seen for the first time with too few regions."""
    known = previous.select("slug", "channel").distinct()
    counted = current.groupBy("slug", "channel").agg(F.count(F.lit(1)).alias("n_regions"))
    fresh = counted.join(known, ["slug", "channel"], "left_anti")
    ids = catalog.select("slug", *[f"nsuid_{g}" for g in ESHOP_GROUPS])
    return (
        fresh.join(ids, "slug").withColumn("minimum", minimum_regions())
        .where(F.col("n_regions") < F.col("minimum")).select("slug", "channel", "n_regions", "minimum")
    )


def raw_only(df: DataFrame, derived: Sequence[str] = ("usd", "list_usd", "rank")) -> DataFrame:
    """Drop fields that belong to read time."""
    return df.drop(*derived)


# ------------------------------------------------------------ existence checks

def missing_artifacts(catalog: DataFrame, table: DataFrame, needs: Column) -> DataFrame:
    return catalog.where(needs).select("slug").join(table.select("slug"), "slug", "left_anti")


def orphans(table: DataFrame, catalog: DataFrame) -> DataFrame:
    return table.join(catalog.select("slug"), "slug", "left_anti")


def not_in_catalog(pool: DataFrame, catalog: DataFrame, key: str) -> DataFrame:
    """Flag pool rows whose id is already in the catalog."""
    known = catalog.where(F.col(key).isNotNull()).select(key).distinct().withColumn("__known", F.lit(True))
    return pool.join(known, key, "left").select(
        *pool.columns, F.when(F.col("__known"), "already_in_catalog").alias("reason"))


def track_slug(feed: DataFrame, catalog: DataFrame, key: str) -> DataFrame:
    """Tracked slug of a feed row by store id; null when unknown.  Where an id
    has two owners the last one by slug is taken."""
    owners = catalog.where(F.col(key).isNotNull()).groupBy(key).agg(F.max("slug").alias("slug_if_tracked"))
    return feed.join(owners, key, "left")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key occurs more than once; no participant is kept.

    The count is a two-step aggregate and the way back a semi join, which Spark
    splits when one key is very frequent; a window would not be.
    """
    present = df
    for k in keys:
        present = present.where(F.col(k).isNotNull())
    many = present.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select(*keys)
    return present.join(many, list(keys), "left_semi")


def duplicate_values(df: DataFrame, owner: str, ids: Sequence[str]) -> DataFrame:
    """Id values with more than one owner, over several id columns at once."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("id_kind"), F.col(c).cast("string").alias("id")) for c in ids]))
    long = df.select(owner, pairs.alias("p")).select(owner, "p.id_kind", "p.id").where(F.col("id").isNotNull())
    return (
        long.groupBy("id_kind", "id")
        .agg(F.count(F.lit(1)).alias("n"), F.min(owner).alias("first_owner"), F.max(owner).alias("last_owner"))
        .where(F.col("n") > 1)
    )


def owner_conflicts(items: DataFrame, catalog: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Ids of items that already belong to another catalog game."""
    def long(df: DataFrame, owner: str) -> DataFrame:
        pairs = F.explode(F.array(*[
            F.struct(F.lit(c).alias("id_kind"), F.col(c).cast("string").alias("id")) for c in ids]))
        return df.select(F.col("slug").alias(owner), pairs.alias("p")).select(
            owner, "p.id_kind", "p.id").where(F.col("id").isNotNull()).distinct()

    return (
        long(items, "slug").join(long(catalog, "owner"), ["id_kind", "id"])
        .where(F.col("owner") != F.col("slug"))
    )


def contiguous(df: DataFrame, group: Sequence[str], pos: str) -> DataFrame:
    """Groups whose positions are not exactly 0..n-1."""
    return (
        df.groupBy(*group, pos).agg(F.count(F.lit(1)).alias("c"))
        .groupBy(*group)
        .agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("n_distinct"),
             F.min(pos).alias("lo"), F.max(pos).alias("hi"))
        .where((F.col("n") != F.col("n_distinct")) | (F.col("lo") != 0) | (F.col("hi") != F.col("n") - 1))
    )


def unsorted_rows(df: DataFrame, group: Sequence[str], pos: str, keys: Sequence[str]) -> DataFrame:
    """Rows that sort before their predecessor in the stored order.

    The predecessor is found by an equi-join on (group, position - 1), which
    spreads even one huge group over all tasks.
    """
    before = df.select(*group, (F.col(pos) + 1).alias(pos), F.struct(*keys).alias("__before"))
    return (
        df.join(before, [*group, pos])
        .where(F.col("__before") > F.struct(*keys)).drop("__before")
    )


def select_run(games: DataFrame, tier: str | None = None, shard: int | None = None, shards: int = 7) -> DataFrame:
    """Games of one scheduled run: a tier, and for the long tail one shard."""
    from ..functions.expr import fnv_shard

    out = games
    if tier is not None:
        out = out.where(F.coalesce("tier", F.lit("core")) == tier)
    if tier == "extended" and shard is not None:
        out = out.where(fnv_shard("slug", shards) == shard)
    return out


def cursor_page(catalog: DataFrame, missing: Column, start_after: str, size: int) -> DataFrame:
    """Next page, by slug, of the games that still lack a mapping."""
    return catalog.where(missing & (F.col("slug") > start_after)).orderBy("slug").limit(size)


def cursor_totals(catalog: DataFrame, missing: Column, start_after: str, size: int) -> DataFrame:
    """Counts around one page and the cursor of the next."""
    page = cursor_page(catalog, missing, start_after, size).agg(
        F.count(F.lit(1)).alias("page_rows"), F.max("slug").alias("next_cursor"))
    totals = catalog.where(missing).agg(
        F.count(F.lit(1)).alias("n_missing"),
        F.count_if(F.col("slug") > start_after).alias("n_remaining"))
    more = F.col("n_remaining") > F.col("page_rows")
    # two scalar rows
    return page.withColumn("k", F.lit(1)).join(totals.withColumn("k", F.lit(1)), "k").select(
        "n_missing", "n_remaining", "page_rows", F.when(more, F.col("next_cursor")).alias("next_cursor"))
