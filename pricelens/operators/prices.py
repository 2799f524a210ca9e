"""Region price jobs: currency conversion, ranking, comparison, outliers.

Input is one row per (slug, channel, cc).  A store has a fixed, small set of
regions, so windows over (slug, channel) are bounded by it however large the
table is; anything that still holds repeated observations is reduced first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions.sizing import broadcast_if_small

GROUP = ("slug", "channel")


def _usd(amount: str) -> Column:
    """Dollar value of a local amount, given a joined ``rate``."""
    return (
        F.when(F.col("currency") == "USD", X.round2(amount))
        .when(F.col("rate") > 0, X.round2(F.col(amount) / F.col("rate")))
    )


def to_usd(df: DataFrame, rates: DataFrame, amount: str = "amount", out: str = "usd") -> DataFrame:
    """Add the dollar value; rows without a usable rate get null."""
    fx = broadcast_if_small(rates.select("currency", "rate"))
    return df.join(fx, "currency", "left").withColumn(out, _usd(amount)).drop("rate")


def fx_join(df: DataFrame, rates: DataFrame) -> DataFrame:
    """Add ``usd`` and ``list_usd`` with one join; rows without a rate drop."""
    fx = broadcast_if_small(rates.select("currency", "rate"))
    return (
        df.join(fx, "currency", "left")
        .withColumn("usd", _usd("amount"))
        .withColumn("list_usd", _usd("list_amount"))
        .where(F.col("usd").isNotNull())
        .drop("rate")
    )


def priced_rows(df: DataFrame) -> DataFrame:
    """Keep rows with a positive amount and a currency; upper-case regions."""
    usable = (F.col("amount") > 0) & F.col("currency").isNotNull() & (F.col("currency") != "")
    return df.where(usable).withColumn("cc", F.upper("cc"))


def effective_us_row(df: DataFrame, as_of, baseline: str = "US") -> DataFrame:
    """The baseline row as shown today: an ended discount falls back to its
    list price, or the row disappears when there is none."""
    ended = (F.coalesce(F.col("discount_pct"), F.lit(0)) != 0) & ~X.is_live("sale_ends_at", as_of)
    rows = df.where(F.col("cc") == baseline).withColumn("__ended", ended)
    rows = rows.where(~F.col("__ended") | (F.col("list_usd") > 0))
    over = F.col("__ended")
    return rows.withColumns({
        "amount": F.when(over, F.coalesce("list_amount", "list_usd")).otherwise(F.col("amount")),
        "usd": F.when(over, F.col("list_usd")).otherwise(F.col("usd")),
        "list_amount": F.when(~over, F.col("list_amount")),
        "list_usd": F.when(~over, F.col("list_usd")),
        "discount_pct": F.when(~over, F.col("discount_pct")),
        "sale_ends_at": F.when(~over, F.col("sale_ends_at")),
    }).drop("__ended")


def us_observation(df: DataFrame, baseline: str = "US") -> DataFrame:
    """Baseline rows that are natively in dollars; no conversion involved."""
    return df.where((F.col("cc") == baseline) & (F.col("currency") == "USD")).withColumn("usd", F.col("amount"))


def valid_regional(df: DataFrame) -> DataFrame:
    return df.where((F.coalesce(F.col("cc"), F.lit("")) != "") & (F.col("usd") > 0))


def rank_regions(df: DataFrame) -> DataFrame:
    """1-based rank by dollar price inside a game's store; ties by region."""
    w = Window.partitionBy(*GROUP).orderBy("usd", "cc")
    return df.withColumn("rank", F.row_number().over(w).cast("int"))


def delta_vs_baseline(df: DataFrame, baseline: str = "US") -> DataFrame:
    """Difference of every region to the baseline region, with its direction."""
    w = Window.partitionBy(*GROUP)
    base = F.max(F.when(F.col("cc") == baseline, F.col("usd"))).over(w)
    is_base = F.col("cc") == baseline
    delta = F.when(is_base & F.col("__base").isNotNull(), 0).when(
        F.col("__base") > 0, X.pct_change("usd", "__base"))
    direction = (
        F.when(F.col("delta_pct").isNull(), "unknown")
        .when(is_base, "baseline")
        .when(F.col("delta_pct") < 0, "cheaper")
        .when(F.col("delta_pct") > 0, "pricier")
        .otherwise("par")
    )
    return (
        df.withColumn("__base", base).withColumn("delta_pct", delta)
        .withColumn("direction", direction).drop("__base")
    )


def map_buckets(df: DataFrame, baseline: str = "US", deep: int = 30) -> DataFrame:
    """Five-step colour class per region.  Without the baseline region the
    cheapest one takes its place."""
    w = Window.partitionBy(*GROUP)
    own = F.max(F.when(F.col("cc") == baseline, F.struct("usd", "cc"))).over(w)
    low = F.min(F.struct("usd", "cc")).over(w)
    pct = F.coalesce(F.when(F.col("cc") == F.col("__b.cc"), 0).otherwise(
        X.pct_change("usd", "__b.usd")), F.lit(0))
    bucket = (
        F.when(F.col("cc") == F.col("baseline_cc"), "baseline")
        .when(F.col("delta_pct") <= -deep, "cheaper-2")
        .when(F.col("delta_pct") < 0, "cheaper-1")
        .when(F.col("delta_pct") >= deep, "pricier-2")
        .when(F.col("delta_pct") > 0, "pricier-1")
        .otherwise("par")
    )
    return (
        df.withColumn("__b", F.coalesce(own, low))
        .withColumn("baseline_cc", F.col("__b.cc"))
        .withColumn("delta_pct", pct)
        .drop("__b")
        .withColumn("bucket", bucket)
    )


def regional_model(df: DataFrame, baseline: str = "US") -> DataFrame:
    """Cheapest and dearest region, spread and saving of every game's store."""
    low, high = F.col("__lo"), F.col("__hi")
    ranged = high["usd"] > low["usd"]
    return (
        valid_regional(df).groupBy(*GROUP).agg(
            F.min(F.struct("usd", "cc")).alias("__lo"),
            F.max(F.struct("usd", "cc")).alias("__hi"),
            F.max(F.when(F.col("cc") == baseline, F.col("usd"))).alias("baseline_usd"),
            F.count(F.lit(1)).alias("n_regions"),
        )
        .select(
            *GROUP,
            low["cc"].alias("cheapest_cc"), low["usd"].alias("cheapest_usd"),
            high["cc"].alias("dearest_cc"), high["usd"].alias("dearest_usd"),
            "baseline_usd", "n_regions",
            F.when(ranged, X.pct_change(high["usd"], low["usd"])).otherwise(0).alias("spread_pct"),
            F.when(ranged, X.below_today_pct(high["usd"], low["usd"])).otherwise(0).alias("savings_pct"),
        )
    )


def outlier_regions(df: DataFrame, rates: DataFrame, min_ratio: float = 0.1) -> DataFrame:
    """Drop regions whose regular price is far under the store's upper median.

    The judged price is the list price where there is one, so a true sale
    stays.  With fewer than four convertible regions nothing is judged; where
    the rule is active, regions without a rate go too.
    """
    regular = df.withColumn("__regular", F.coalesce("list_amount", "amount"))
    priced = to_usd(regular, rates, "__regular", "__usd")
    w = Window.partitionBy(*GROUP)
    # bounded by the region set of a store
    values = F.array_sort(F.collect_list("__usd").over(w))
    size = F.size(F.col("__values"))
    median = F.try_element_at("__values", (F.floor(size / 2) + 1).cast("int"))
    keep = (size < 4) | F.coalesce(F.col("__usd") >= median * F.lit(min_ratio), F.lit(False))
    return priced.withColumn("__values", values).where(keep).drop("__values", "__usd", "__regular")


def best_price_now(us: DataFrame) -> DataFrame:
    """Store with the lowest shown price of every game; ties in store order."""
    return (
        us.where(F.col("usd").isNotNull())
        .groupBy("slug")
        .agg(F.min(F.struct("usd", X.ordinal("channel", X.CHANNELS).alias("o"), "channel")).alias("b"))
        .select("slug", F.col("b.usd").alias("usd"), F.col("b.channel").alias("channel"))
    )


def best_price_flags(df: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """Flag all prices tied with the lowest, none when all are level."""
    w = Window.partitionBy("slug")
    low, high, n = F.min("usd").over(w), F.max("usd").over(w), F.count(F.lit(1)).over(w)
    flag = (n >= 2) & (high - low > tolerance) & (F.abs(F.col("usd") - low) <= tolerance)
    return df.withColumn("is_best", flag)


def core_summary(df: DataFrame) -> DataFrame:
    """One row per game and plan: cheapest and dearest region, any discount."""
    return df.groupBy(*GROUP).agg(
        F.min_by("cc", F.struct("usd", "cc")).alias("cheapest_cc"),
        F.max_by("cc", F.struct("usd", "cc")).alias("dearest_cc"),
        F.bool_or(F.coalesce(F.col("discount_pct") > 0, F.lit(False))).alias("any_discount"),
        F.count(F.lit(1)).alias("n_regions"),
    )


def us_benchmark(df: DataFrame, baseline: str = "US") -> DataFrame:
    """The plan's baseline price copied onto the plan."""
    return df.groupBy(*GROUP).agg(
        F.max(F.when(F.col("cc") == baseline, F.col("usd"))).alias("us_usd"))


def core_catalog(df: DataFrame) -> DataFrame:
    """Plans, regions and last update of every price document."""
    return df.groupBy("slug").agg(
        F.count_distinct("channel").alias("n_plans"),
        F.count_distinct("cc").alias("n_regions"),
        F.max("d").alias("last_update"),
    )


def lowest_countries(df: DataFrame, n: int = 3) -> DataFrame:
    """First ``n`` distinct regions by price of every game's store."""
    from ..functions.ordering import first_per_key

    one = first_per_key(df, [*GROUP, "cc"], [F.col("usd")])
    return first_per_key(one, list(GROUP), [F.col("usd"), F.col("cc")], n, rank="place")


# ------------------------------------------------------------ supplemental offers

def enrich_offers(offers: DataFrame, rates: DataFrame) -> DataFrame:
    """Dollar values of supplemental offers; they carry no rank."""
    return fx_join(offers, rates)


def offer_columns(base: DataFrame, offers: DataFrame, baseline: str = "US") -> DataFrame:
    """Attach supplemental offer prices to the base game's region rows.

    The base game alone decides which rows exist and their rank; every offer
    is compared with its own baseline price.
    """
    judged = (
        valid_regional(offers)
        .withColumn("__base", F.max(F.when(F.col("cc") == baseline, F.col("usd")))
                    .over(Window.partitionBy("slug", "package_id")))
        .withColumn("offer_delta_pct", F.when(F.col("__base").isNotNull() & (F.col("cc") == baseline), 0)
                    .when(F.col("__base") > 0, X.pct_change("usd", "__base")))
        .select("slug", "cc", "package_id", F.col("usd").alias("offer_usd"), "offer_delta_pct")
    )
    return base.join(judged, ["slug", "cc"], "left")


def offer_display(offers: DataFrame, offer_catalog: DataFrame) -> DataFrame:
    """Reviewed names override the names stored with the prices."""
    reviewed = offer_catalog.select("package_id", F.col("name").alias("__reviewed"))
    return (
        offers.join(reviewed, "package_id", "left")
        .withColumn("name", F.coalesce("__reviewed", "name")).drop("__reviewed")
    )
