"""Price history: change events, lows, step series and intervals.

History is kept on daily grain, one row per (slug, channel, day).  Whatever
number of raw observations a hot game has, ``daily_grain`` cuts it to one row a
day inside the map tasks, so the per-game windows below are bounded by the
number of days in the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions.ordering import down, first_per_key, global_row_number

KEY = ("slug", "channel")


def daily_grain(obs: DataFrame, *order: str) -> DataFrame:
    """Last observation of every game, store and day."""
    return first_per_key(obs, [*KEY, "d"], [F.col(c).desc_nulls_last() for c in order])


def change_events(daily: DataFrame) -> DataFrame:
    """Days on which price or discount differ from the day before; the first
    day always counts.  Needs daily grain."""
    w = Window.partitionBy(*KEY).orderBy("d")
    prev = F.lag(F.struct("usd", "pct")).over(w)
    changed = F.col("__prev").isNull() | ~F.struct("usd", "pct").eqNullSafe(F.col("__prev"))
    return daily.withColumn("__prev", prev).where(changed).select(*KEY, "d", "usd", "pct")


def atl_from_events(events: DataFrame, seed: str = "self") -> DataFrame:
    """Lowest price of every game and store with the first day it was seen."""
    return (
        events.groupBy(*KEY).agg(F.min(F.struct("usd", "d")).alias("b"))
        .select("slug", X.relabel("channel", X.ATL_KEY_OF_CHANNEL).alias("atl_key"),
                F.col("b.usd").alias("usd"), F.col("b.d").alias("date"), F.lit(seed).alias("seed"))
    )


def seed_atl(atl: DataFrame, seeds: DataFrame) -> DataFrame:
    """An outside low replaces the own low only when strictly lower."""
    cols = ("slug", "atl_key", "usd", "date", "seed")
    both = atl.select(*cols, F.lit(0).alias("o")).unionByName(seeds.select(*cols, F.lit(1).alias("o")))
    return (
        both.groupBy("slug", "atl_key").agg(F.min(F.struct("usd", "o", "date", "seed")).alias("b"))
        .select("slug", "atl_key", F.col("b.usd").alias("usd"), F.col("b.date").alias("date"),
                F.col("b.seed").alias("seed"))
    )


def overall_atl(atl: DataFrame) -> DataFrame:
    """Lowest low of every game over the reader-facing keys; ties in key order."""
    return (
        atl.where(F.col("atl_key").isin(*X.ATL_KEYS)).groupBy("slug")
        .agg(F.min(F.struct("usd", X.ordinal("atl_key", X.ATL_KEYS).alias("o"), "atl_key", "date", "seed")).alias("b"))
        .select("slug", F.col("b.atl_key").alias("atl_key"), F.col("b.usd").alias("usd"),
                F.col("b.date").alias("date"), F.col("b.seed").alias("seed"))
    )


def visible_events(events: DataFrame) -> DataFrame:
    return events.where(F.col("channel").isin(*X.CHANNELS))


def visible_atl(atl: DataFrame) -> DataFrame:
    return atl.where(F.col("atl_key").isin(*X.ATL_KEYS))


def running_atl(daily: DataFrame) -> DataFrame:
    """Lowest price so far, and its day, at every day."""
    w = Window.partitionBy(*KEY).orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    low = F.min(F.struct("usd", "d")).over(w)
    return daily.withColumn("__low", low).select(
        *KEY, "d", "usd", F.col("__low.usd").alias("low_usd"), F.col("__low.d").alias("low_date"))


def step_series(events: DataFrame, last_success: DataFrame) -> DataFrame:
    """Extent and state of every step line.  A line ends at its own source's
    last success, never before its last event.  ``last_success`` holds one
    row per channel."""
    lines = events.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n_points"),
        F.min("d").alias("first_date"),
        F.max("d").alias("last_event_date"),
        F.max_by("usd", "d").alias("last_usd"),
    )
    ended = lines.join(last_success.select("channel", "success_date"), "channel", "left")
    end = F.greatest("last_event_date", "success_date")
    state = (
        F.when(F.col("n_points") > 1, "changes")
        .when(F.col("end_date") > F.col("first_date"), "confirmed-flat")
        .otherwise("point")
    )
    return ended.withColumn("end_date", end).withColumn("state", state).drop("success_date")


def price_intervals(events: DataFrame) -> DataFrame:
    """[valid_from, valid_to) of every price; the last one is open."""
    w = Window.partitionBy(*KEY).orderBy("d")
    return events.select(
        *KEY, "usd", "pct", F.col("d").alias("valid_from"), F.lead("d").over(w).alias("valid_to"))


def price_as_of(events: DataFrame, dates: Sequence[str]) -> DataFrame:
    """Price in force per game and store on each of a few asked dates.

    An event is copied only to the asked dates on or after it, and the newest
    event per (game, store, date) is a plain aggregate with map-side combine,
    so neither a range join nor gathering a key is needed.
    """
    asked = F.array(*[X.day(x) for x in dates])
    reach = F.filter(asked, lambda x: x >= F.col("d"))
    return (
        events.withColumn("as_of", F.explode(reach))
        .groupBy(*KEY, "as_of")
        .agg(F.max_by(F.struct("usd", "pct"), "d").alias("p"), F.max("d").alias("since"))
        .select(*KEY, "as_of", F.col("p.usd").alias("usd"), F.col("p.pct").alias("pct"), "since")
    )


def daily_prices(events: DataFrame, until) -> DataFrame:
    """One row per day between the first event and ``until``."""
    iv = price_intervals(events)
    last = F.coalesce(F.date_sub("valid_to", 1), X.day(until))
    days = F.explode(F.sequence("valid_from", last))
    return iv.where(F.col("valid_from") <= last).select(*KEY, days.alias("d"), "usd", "pct")


def yearly_prices(events: DataFrame, until) -> DataFrame:
    """Days with a price and its extremes per year, from the row of every day.

    Days are made beside their event and counted in the same task, so none is shuffled.
    """
    return daily_prices(events, until).groupBy(*KEY, F.year("d").alias("year")).agg(
        F.count(F.lit(1)).alias("n_days"), F.min("usd").alias("low_usd"), F.max("usd").alias("high_usd"))


def recent_events(events: DataFrame, n: int = 4) -> DataFrame:
    """Last ``n`` events of every game, newest first."""
    order = [F.col("d").desc(), X.ordinal("channel", X.CHANNELS)]
    return first_per_key(events, ["slug"], order, n, rank="place")


def placed_history_log(events: DataFrame) -> DataFrame:
    """The log with every event's 1-based place, newest first."""
    return global_row_number(events, [down("d"), "slug", "channel"], "place")


def price_history_log(events: DataFrame) -> DataFrame:
    return events.orderBy(F.col("d").desc(), "slug", "channel")


def first_observed(events: DataFrame) -> DataFrame:
    """Earliest valid event day of every game (``d`` may be text)."""
    day = F.when(X.valid_day(F.substring(F.col("d").cast("string"), 1, 10)),
                 F.substring(F.col("d").cast("string"), 1, 10).try_cast("date"))
    return events.groupBy("slug").agg(F.min(day).alias("first_date"))


def verdicts(best: DataFrame, lows: DataFrame) -> DataFrame:
    """BUY / FAIR / WAIT of every game from its best price and overall low."""
    low = lows.select("slug", F.col("usd").alias("atl_usd"))
    return best.join(low, "slug").select(
        "slug", "usd", "atl_usd", X.verdict("usd", "atl_usd").alias("verdict"),
        X.below_today_pct("usd", "atl_usd").alias("below_pct"))


def due_for_recheck(games: DataFrame, status: DataFrame, today, days: int = 30, limit: int | None = None) -> DataFrame:
    """Games whose outside low was never checked or whose check is old, and
    which have no recorded miss still in force."""
    known = games.join(status.select("slug", "seed_checked_at", "lookup_miss_until"), "slug", "left")
    now = X.day(today)
    fresh = F.coalesce(F.date_add("seed_checked_at", days) > now, F.lit(False))
    missed = F.coalesce(F.col("lookup_miss_until") > now, F.lit(False))
    due = known.where(~fresh & ~missed)
    return due if limit is None else due.orderBy("slug").limit(limit)
