"""Reader-facing boards over the per-game price tables.

A board is a filter, a join on slug and a top-k.  The limits are the boards'
own sizes; Spark plans them as TakeOrderedAndProject.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions.ordering import first_per_key, top_k
from .prices import best_price_now, rank_regions, regional_model, valid_regional
from .history import overall_atl

REGIONAL = ("steam", "eshop")


def game_bundle(catalog: DataFrame, prices: DataFrame, lows: DataFrame, meta: DataFrame) -> DataFrame:
    """Everything known about a game in one row.

    The four stores' shown prices are pivoted in one aggregate instead of four
    joins; every other side is unique on slug.
    """
    pivoted = prices.groupBy("slug").agg(*[
        F.max(F.when(F.col("channel") == c, F.col("usd"))).alias(f"{c}_usd") for c in X.CHANNELS])
    low = overall_atl(lows).select("slug", F.col("usd").alias("atl_usd"), F.col("date").alias("atl_date"))
    return (
        catalog.select("slug", "title").join(pivoted, "slug", "left")
        .join(low, "slug", "left").join(meta, "slug", "left")
    )


def multi_region_sources(prices: DataFrame) -> DataFrame:
    """Stores with prices in more than one region, per game."""
    return (
        valid_regional(prices.where(F.col("channel").isin(*REGIONAL)))
        .groupBy("slug", "channel").agg(F.count(F.lit(1)).alias("n_regions"))
        .where(F.col("n_regions") > 1)
    )


def primary_source(catalog: DataFrame, prices: DataFrame) -> DataFrame:
    """The store that speaks for a game: the configured one if it has rows,
    else steam, else eshop."""
    present = prices.where(F.col("channel").isin(*X.CHANNELS)).groupBy("slug", "channel").agg(F.count(F.lit(1)).alias("n"))
    own = F.col("channel") == F.col("primary_regional_channel")
    order = F.when(own, -1).otherwise(X.ordinal("channel", REGIONAL))
    return (
        present.join(catalog.select("slug", "primary_regional_channel"), "slug")
        .withColumn("o", order).where(F.col("o") < 99)
        .groupBy("slug").agg(F.min_by("channel", "o").alias("channel"))
    )


def display_order() -> list[Column]:
    spread = F.col("dearest_usd") - F.col("cheapest_usd")
    return [F.col("savings_pct").desc(), spread.desc(), F.col("cheapest_usd"), X.ordinal("channel", REGIONAL)]


def regional_display_source(prices: DataFrame) -> DataFrame:
    """One store owns the whole region comparison of a game."""
    eligible = prices.join(multi_region_sources(prices).select("slug", "channel"), ["slug", "channel"], "left_semi")
    return first_per_key(regional_model(eligible), ["slug"], display_order())


# Platforms of a console-exclusive game, fixed values.
SWITCH_FAMILY = ("switch", "switch-2")


def regional_cards(catalog: DataFrame, prices: DataFrame, channel: str) -> DataFrame:
    """Card facts of every game listed under a store, in listing order."""
    listed = multi_region_sources(prices).where(F.col("channel") == channel).select("slug")
    only_switch = (F.size("platforms") > 0) & F.forall("platforms", lambda p: p.isin(*SWITCH_FAMILY))
    exclusive = (
        F.lit(channel == "eshop") & only_switch
        & F.col("steam_app_id").isNull() & F.col("xbox_big_id").isNull()
    )
    facts = catalog.select("slug", "title", "header_image", "review_count", exclusive.alias("exclusive"))
    return (
        regional_display_source(prices).join(listed, "slug", "left_semi").join(facts, "slug")
        .withColumn("exclusive", F.coalesce("exclusive", F.lit(False)))
    )


def order_cards(cards: DataFrame) -> DataFrame:
    """Exclusives first, then saving, then title in dictionary order."""
    return cards.orderBy(
        F.col("exclusive").desc(), F.col("savings_pct").desc(), F.collate("title", "UNICODE"), "slug")


def popular_cards(cards: DataFrame, k: int = 4, exclude: DataFrame | None = None) -> DataFrame:
    """Cards with artwork by review volume."""
    rows = cards.where(F.col("header_image").isNotNull())
    if exclude is not None:
        rows = rows.join(exclude.select("slug"), "slug", "left_anti")
    return top_k(rows, [F.coalesce("review_count", F.lit(0)).desc(), F.col("title"), F.col("slug")], k)


def region_gaps(catalog: DataFrame, prices: DataFrame, us: DataFrame, min_save: int = 5) -> DataFrame:
    """Saving of the cheapest region against the shown baseline price, in the
    store that speaks for the game."""
    source = primary_source(catalog, prices)
    cheapest = rank_regions(prices).where(F.col("rank") == 1).select(
        "slug", "channel", "cc", F.col("usd").alias("low_usd"))
    rows = (
        source.join(cheapest, ["slug", "channel"])
        .join(us.select("slug", "channel", "usd"), ["slug", "channel"])
        .where((F.col("cc") != "US") & (F.col("usd") > 0))
        .withColumn("save_pct", X.below_today_pct("usd", "low_usd"))
    )
    return rows.where(F.col("save_pct") >= min_save).select("slug", "channel", "cc", "save_pct")


def region_gap_board(catalog: DataFrame, prices: DataFrame, us: DataFrame, k: int = 5) -> DataFrame:
    return top_k(region_gaps(catalog, prices, us), [F.col("save_pct").desc(), F.col("slug")], k)


def at_low(us: DataFrame, lows: DataFrame) -> DataFrame:
    """Games whose best shown price is their overall low."""
    low = overall_atl(lows).select("slug", F.col("usd").alias("atl_usd"), "date")
    return (
        best_price_now(us).join(low, "slug")
        .where(F.col("usd") <= F.col("atl_usd") + 0.001).select("slug", "channel", "usd", "date")
    )


def atl_board(us: DataFrame, lows: DataFrame, k: int = 5) -> DataFrame:
    return top_k(at_low(us, lows), [F.col("date").desc_nulls_last(), F.col("slug")], k)


def best_discounts(us: DataFrame) -> DataFrame:
    """Highest discount of every game over its stores; ties in store order."""
    o = X.ordinal("channel", X.CHANNELS)
    return (
        us.where(F.col("discount_pct") > 0).groupBy("slug")
        .agg(F.max(F.struct(F.col("discount_pct").alias("pct"), (-o).alias("o"), "channel", "usd")).alias("b"))
        .select("slug", F.col("b.channel").alias("channel"), F.col("b.usd").alias("usd"), F.col("b.pct").alias("pct"))
    )


def hot_deals(us: DataFrame, k: int = 5) -> DataFrame:
    return top_k(best_discounts(us), [F.col("pct").desc(), F.col("slug")], k)


def tracked_deals(us: DataFrame, lows: DataFrame, as_of) -> DataFrame:
    """Discounted, still running prices with the flag "at this store's low".
    Lows are never mixed across stores."""
    low = lows.select("slug", "atl_key", F.col("usd").alias("atl_usd"))
    live = us.where((F.col("discount_pct") > 0) & X.is_live("sale_ends_at", as_of))
    flag = F.coalesce(F.col("usd") <= F.col("atl_usd") + 0.001, F.lit(False))
    return (
        live.withColumn("atl_key", X.relabel("channel", X.ATL_KEY_OF_CHANNEL))
        .join(low, ["slug", "atl_key"], "left")
        .select("slug", "channel", "usd", "list_usd", F.col("discount_pct").alias("pct"), "sale_ends_at",
                "atl_usd", flag.alias("is_atl"))
    )


def tracked_atl_deals(deals: DataFrame) -> DataFrame:
    return deals.where(F.col("is_atl"))


def atl_grid(deals: DataFrame, k: int = 8) -> DataFrame:
    """Deals at their low over all stores, one per game."""
    order = [F.col("pct").desc(), F.col("usd"), X.ordinal("channel", X.CHANNELS)]
    one = first_per_key(tracked_atl_deals(deals), ["slug"], order)
    return top_k(one, [F.col("pct").desc(), F.col("usd"), F.col("slug")], k)


def ending_soon(deals: DataFrame, k: int = 4) -> DataFrame:
    """Deals with an end, one per game, soonest first."""
    order = [F.col("sale_ends_at"), F.col("pct").desc(), X.ordinal("channel", X.CHANNELS)]
    one = first_per_key(deals.where(F.col("sale_ends_at").isNotNull()), ["slug"], order)
    return top_k(one, [F.col("sale_ends_at"), F.col("pct").desc(), F.col("slug")], k)


def free_games(feed: DataFrame, as_of, status: str = "free-now") -> DataFrame:
    return feed.where((F.col("status") == status) & X.is_live("ends_at", as_of))


def free_now(feed: DataFrame, as_of, k: int = 2) -> DataFrame:
    return top_k(free_games(feed, as_of), [F.col("seq")], k)


def current_month(calendar: DataFrame, as_of) -> DataFrame:
    """First month from now on that has entries, else the last month there is."""
    now = F.date_format(X.day(as_of), "yyyy-MM")
    return calendar.agg(
        F.coalesce(F.min(F.when(F.col("month") >= now, F.col("month"))), F.max("month")).alias("month"))


def next_releases(calendar: DataFrame, as_of, k: int = 4) -> DataFrame:
    """Dated entries of the current month from today on."""
    # a single scalar row
    month = current_month(calendar, as_of)
    rows = calendar.join(F.broadcast(month), "month").where(F.col("date").cast("date") >= X.day(as_of))
    return top_k(rows, [F.col("date"), F.col("title"), F.col("seq")], k)


def future_entries(df: DataFrame, month: str) -> DataFrame:
    return df.where(F.col("month").isNull() | (F.col("month") >= month))


def image_fallback(releases: DataFrame, meta: DataFrame) -> DataFrame:
    """An entry without artwork takes the tracked game's header image."""
    header = meta.select(F.col("slug").alias("slug_if_tracked"), F.col("header_image").alias("__header"))
    return (
        releases.join(header, "slug_if_tracked", "left")
        .withColumn("image", F.coalesce("image", "__header")).drop("__header")
    )


def untracked_items(feed: DataFrame, catalog: DataFrame, key: str = "slug_if_tracked") -> DataFrame:
    known = catalog.select(F.col("slug").alias(key))
    return feed.join(known, key, "left_anti")

