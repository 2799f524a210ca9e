"""Scoring new catalog candidates from daily rankings and reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions import text as T
from ..functions.ordering import Key, down, global_row_number, keys_of
from ..sources.landing import first_id, id_head, once

# Scoring constants, fixed values.
POINTS_CEILING = 2001
AUX_CEILING = 101
DAY_WEIGHT = 100_000
FINAL_MINIMUM_DAYS = 14
DAY_ONE_FLOOR = 10_000


def best_rank_per_app(pages: DataFrame) -> DataFrame:
    """Lowest rank of every app over the pages; conflicting titles are flagged."""
    key = T.norm_title_basic("title")
    return pages.groupBy("app_id").agg(
        F.min(F.struct("rank", "title")).alias("b"),
        (F.min(key) != F.max(key)).alias("title_conflict"),
    ).select("app_id", F.col("b.rank").alias("rank"), F.col("b.title").alias("title"), "title_conflict")


def daily_sample_dedupe(samples: DataFrame, minimum_days: int = 1) -> DataFrame:
    """One sample per day: number of copies, conflict flag, and whether enough
    days are there."""
    days = samples.groupBy("day").agg(
        F.count(F.lit(1)).alias("copies"), (F.min("digest") != F.max("digest")).alias("conflict"),
        F.min("digest").alias("digest"))
    total = days.agg(F.count(F.lit(1)).alias("n")).withColumn("k", F.lit(1))
    # a single total row
    return days.withColumn("k", F.lit(1)).join(F.broadcast(total), "k").select(
        "day", "copies", "conflict", "digest", (F.col("n") >= minimum_days).alias("enough_days"))


def rank_points(rankings: DataFrame) -> DataFrame:
    """Evidence of every app: days seen, rank points, best auxiliary ranks.

    ``rankings`` holds (day, source, app_id, rank, title); sources are top,
    featured and played.  One rank a day and app counts in the top list.
    """
    top = F.col("source") == "top"
    per_day = rankings.groupBy("app_id", "day").agg(
        F.max(F.when(top, F.col("rank"))).alias("top_rank"),
        F.min(F.when(F.col("source") == "featured", F.col("rank"))).alias("featured"),
        F.min(F.when(F.col("source") == "played", F.col("rank"))).alias("played"),
        F.min(F.when(F.col("source") != "played", T.norm_title_basic("title"))).alias("lo"),
        F.max(F.when(F.col("source") != "played", T.norm_title_basic("title"))).alias("hi"),
    )
    points = F.greatest(F.lit(1), F.lit(POINTS_CEILING) - F.col("top_rank"))
    return per_day.groupBy("app_id").agg(
        F.count("top_rank").alias("days_seen"),
        F.coalesce(F.sum(F.when(F.col("top_rank").isNotNull(), points)), F.lit(0)).cast("bigint").alias("points"),
        F.min("featured").alias("best_featured"), F.min("played").alias("best_played"),
        F.coalesce(F.min("lo") != F.max("hi"), F.lit(False)).alias("title_conflict"),
    )


def _aux(column: str) -> Column:
    return F.coalesce(F.greatest(F.lit(1), F.lit(AUX_CEILING) - F.col(column)), F.lit(0))


def popularity_score(pool: DataFrame, recommendations: str = "recommendations") -> DataFrame:
    """Score of every app from its evidence and its recommendation count."""
    proxy = X.round_int(F.log10(F.coalesce(F.col(recommendations), F.lit(0)) + 1) * 1000)
    score = F.col("days_seen") * DAY_WEIGHT + F.col("points") + proxy + _aux("best_featured") + _aux("best_played")
    return pool.withColumn("proxy_points", proxy).withColumn("score", score.cast("bigint"))


def candidate_keys() -> list[Key]:
    return keys_of([down("score"), down("days_seen"), down("points"), down(F.coalesce("recommendations", F.lit(0))), "app_id"])


def candidate_order() -> list[Column]:
    return [k.order() for k in candidate_keys()]


def rank_candidates(scored: DataFrame, limit: int) -> DataFrame:
    """First ``limit`` accepted candidates with their 1-based source rank."""
    from pyspark.sql import Window

    head = scored.orderBy(*candidate_order()).limit(limit)
    # the window sees the limited head only
    w = Window.orderBy(*candidate_order())
    return head.withColumn("source_rank", F.row_number().over(w).cast("int"))


def source_rank(scored: DataFrame) -> DataFrame:
    """1-based rank of every candidate, over the whole table in parallel."""
    return global_row_number(scored, candidate_keys(), "source_rank")


def day_one_cohort(pool: DataFrame, limit: int = 100) -> DataFrame:
    """Day-one mode: pool order is kept, a candidate needs a recommendation
    floor, and a row without details ahead of the cut makes the head
    incomplete.

    ``pool`` holds (app_id, priority, state, recommendations) with state
    accepted / rejected / pending.
    """
    ok = (F.col("state") == "accepted") & (F.coalesce("recommendations", F.lit(0)) >= DAY_ONE_FLOOR)
    order = [F.col("priority").desc(), F.col("app_id")]
    head = pool.where(ok).orderBy(*order).limit(limit)
    # scalar: position of the last accepted row of a full head
    last = head.agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("priority", (-F.col("app_id")).alias("neg"))).alias("cut")).withColumn("k", F.lit(1))
    ahead = F.struct("priority", (-F.col("app_id")).alias("neg")) > F.col("cut")
    gaps = (
        pool.where(F.col("state") == "pending").withColumn("k", F.lit(1)).join(F.broadcast(last), "k")
        .where((F.col("n") < limit) | ahead).agg(F.count(F.lit(1)).alias("gaps")).withColumn("k", F.lit(1))
    )
    return head.withColumn("k", F.lit(1)).join(F.broadcast(gaps), "k").select(
        "app_id", "priority", "recommendations", (F.col("gaps") > 0).alias("head_incomplete"))


def pool_report(pool: DataFrame, limit: int) -> DataFrame:
    """Counts of one candidate document."""
    state = F.col("state")
    return pool.agg(
        F.count(F.lit(1)).alias("discovered"),
        F.count_if(F.coalesce("has_details", F.lit(False))).alias("evidenced"),
        F.count_if(state == "accepted").alias("accepted"),
        F.least(F.count_if(state == "accepted"), F.lit(limit).cast("bigint")).alias("emitted"),
        F.count_if(state == "rejected").alias("rejected"),
        F.count_if(state == "pending").alias("pending"),
        (F.count_if(state == "pending") > 0).alias("incomplete"),
    )


def rejection_counts(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------ paid game gate

DETAILS_DDL = (
    "map<string, struct<success: boolean, data: struct<steam_appid: bigint, name: string, type: string, "
    "is_free: boolean, release_date: struct<coming_soon: boolean, date: string>, "
    "price_overview: struct<currency: string, initial: bigint, final: bigint, discount_percent: int>, "
    "recommendations: struct<total: bigint>>>>"
)


def compact_details(raw: DataFrame) -> DataFrame:
    """Only the fields the gate reads, from the landed detail responses.

    The narrow schema is the projection: nothing else of the body is built.
    """
    own, body = first_id("body", F.col("head"))
    asked = F.col("app_id").cast("string")
    heads = raw.select("app_id", "body", once(id_head("body")).alias("head"))
    return heads.select("app_id", F.when(own == asked, "").otherwise(asked).alias("name"), F.from_json(body, DETAILS_DDL).alias("doc")).select(
        "app_id", (F.size(F.coalesce(F.map_keys("doc"), F.array())) > 0).alias("has_entries"), F.try_element_at("doc", "name").alias("entry"))


def paid_game_gate(details: DataFrame, titles: DataFrame, as_of) -> DataFrame:
    """Accept released, paid base games in dollars; otherwise the first failed
    test.  ``titles`` holds (app_id, title_lo, title_hi), the extremes of the
    loosely normalised ranking titles."""
    d = F.col("entry.data")
    title = F.trim(d["name"])
    release = F.coalesce(F.try_to_timestamp(d["release_date"]["date"]), T.parse_release(d["release_date"]["date"])[0].cast("timestamp"))
    late = F.coalesce(release > X.moment(as_of) + F.expr("INTERVAL 1 DAY"), F.lit(False))
    price = d["price_overview"]
    is_null_or = lambda c: F.coalesce(c, F.lit(True))
    known = details.join(titles, "app_id", "left").withColumn("loose", T.loose_title(title))
    reason = (
        F.when(F.col("entry").isNull() & F.col("has_entries"), "appid_response_mismatch")
        .when(F.col("entry").isNull(), "empty_response")
        .when(~F.coalesce(F.col("entry.success"), F.lit(False)), "appdetails_unsuccessful")
        .when(is_null_or(d["steam_appid"] != F.col("app_id")), "steam_appid_mismatch")
        .when(is_null_or(title == ""), "missing_title")
        .when(T.junk_title(title, T.CANDIDATE_NOISE), "excluded_title_noise")
        .when(F.col("title_lo") != F.col("title_hi"), "conflicting_ranking_titles")
        .when(F.col("title_lo") != F.col("loose"), "title_mismatch")
        .when(is_null_or(d["type"] != "game"), "not_base_game")
        .when(d["is_free"], "free_game")
        .when(d["is_free"].isNull(), "missing_is_free")
        .when(d["release_date"]["coming_soon"].isNull(), "missing_release_status")
        .when(d["release_date"]["coming_soon"], "unreleased")
        .when(is_null_or(F.trim(d["release_date"]["date"]) == ""), "missing_release_date")
        .when(late, "future_release_date")
        .when(price.isNull(), "missing_us_price")
        .when(is_null_or(price["currency"] != "USD"), "non_usd_us_price")
        .when(is_null_or(price["initial"] <= 0), "missing_positive_us_list_price")
        .when(is_null_or(price["final"] < 0), "invalid_us_current_price")
        .when(~F.coalesce(price["discount_percent"].between(0, 100), F.lit(False)), "invalid_discount_percent")
        .when(d["recommendations"].isNotNull() & is_null_or(d["recommendations"]["total"] < 0), "invalid_recommendation_count")
    )
    ok = F.col("reason").isNull()
    return known.withColumn("reason", reason).select(
        "app_id", ok.alias("accepted"), "reason", F.when(ok, title).alias("title"),
        F.when(ok, price["initial"] / F.lit(100.0)).alias("list_usd"),
        F.when(ok, price["final"] / F.lit(100.0)).alias("current_usd"),
        F.when(ok, price["discount_percent"]).alias("discount_pct"),
        F.when(ok, d["recommendations"]["total"]).alias("recommendations"))


# ------------------------------------------------------------ second console family

def popularity_of(evidence: DataFrame) -> DataFrame:
    """Best score and rank per candidate; without evidence it is unverified."""
    return evidence.groupBy("candidate_id").agg(
        F.max("score").alias("score"), F.min(F.when(F.col("rank") > 0, F.col("rank"))).alias("rank"),
        (F.count_if(F.col("score").isNotNull() | F.col("rank").isNotNull()) == 0).alias("unverified"))


EXCLUSIVITY_WEIGHT = {"official_exclusive_or_first_party": 0, "unverified": 1, "known_cross_platform": 2}


def exclusivity(df: DataFrame) -> DataFrame:
    """Class of a candidate from official statements and a store match.

    Needs ``official`` (first_party, official_exclusive, official_cross_platform
    or null), ``steam_exact`` and the organisation key arrays ``orgs`` and
    ``steam_orgs``.
    """
    official = F.coalesce("official", F.lit(""))
    exact = F.coalesce("steam_exact", F.lit(False))
    known = exact & F.arrays_overlap("orgs", "steam_orgs")
    exclusive = official.isin("first_party", "official_exclusive")
    cross = official == "official_cross_platform"
    conflict = exclusive & (F.coalesce(known, F.lit(False)) | cross)
    known = F.coalesce(known, F.lit(False))
    cls = F.when(conflict, "unverified").when(exclusive, "official_exclusive_or_first_party").when(
        known | cross, "known_cross_platform").otherwise("unverified")
    reason = (
        F.when(conflict, "exclusivity_evidence_conflict").when(exclusive, official)
        .when(cross, "official_cross_platform").when(known, "exact_title_and_organization_overlap")
        .when(exact, "exact_title_without_organization_overlap").otherwise("no_affirmative_platform_evidence")
    )
    return df.withColumn("classification", cls).withColumn("conflict", conflict).withColumn("reason", reason)


def suggestion_keys() -> list[Key]:
    """Review order: exclusives first, evidenced before unverified, score, rank (none last)."""
    weight = X.relabel("classification", {name: F.lit(w) for name, w in EXCLUSIVITY_WEIGHT.items()})
    return keys_of([weight, "unverified", down("score"), F.col("rank").isNull(), "rank", "title", "candidate_id"])


def rank_suggestions(df: DataFrame) -> DataFrame:
    return df.orderBy(*[k.order() for k in suggestion_keys()])


def placed_suggestions(df: DataFrame) -> DataFrame:
    """Suggestions with their 1-based place in review order."""
    return global_row_number(df, suggestion_keys(), "place")


def merge_sources(records: DataFrame, key: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Join the records of one game from several sources.

    Records with one title that disagree on slug, platform or app id are all
    rejected.  Evidence stays in the record table, keyed by title; only counts
    and the best priority are combined, so no evidence list grows with a title.
    """
    keyed = T.with_title_key(records) if key is None else records.withColumn("title_key", key)
    facts = keyed.groupBy("title_key").agg(
        ((F.min("slug") != F.max("slug")) | (F.min("platform") != F.max("platform"))
         | F.coalesce(F.min("steam_app_id") != F.max("steam_app_id"), F.lit(False))).alias("conflict"),
        F.min(F.struct("seq", "title", "slug", "platform")).alias("first"),
        F.max("steam_app_id").alias("steam_app_id"),
        F.min(F.struct("priority_group", "priority_value")).alias("best"),
        F.count(F.lit(1)).alias("n_evidence"), F.min("source_key").alias("source_key"))
    merged = facts.where(~F.col("conflict")).select(
        "title_key", F.col("first.title").alias("title"), F.col("first.slug").alias("slug"),
        F.col("first.platform").alias("platform"), "steam_app_id",
        F.col("best.priority_group").alias("priority_group"), F.col("best.priority_value").alias("priority_value"),
        "n_evidence", "source_key")
    bad = facts.where(F.col("conflict")).select("title_key")
    rejected = keyed.join(bad, "title_key", "left_semi").select(
        "source_key", "title", "slug", F.lit("source_identity_conflict").alias("reason"))
    return merged, rejected


def seed_reason(excluded: DataFrame, merged: DataFrame) -> DataFrame:
    """Reject ladder before identity: excluded by hand, edition variants."""
    out = merged.join(excluded.select("slug").distinct().withColumn("__x", F.lit(True)), "slug", "left")
    variant = F.col("title").rlike(r"(?i)(?:[-–—:]\s*)?nintendo\s+switch\s*2\s+edition\s*$")
    return out.withColumn("reason", F.when(F.col("__x"), "manifest_excluded").when(
        variant, "edition_variant_requires_equivalence_evidence")).drop("__x")


def rank_seeds(df: DataFrame, limit: int = 25) -> DataFrame:
    return df.where(F.col("reason").isNull()).orderBy("priority_group", "priority_value", "title", "source_key").limit(limit)


def ranking_evidence_faults(rankings: DataFrame) -> DataFrame:
    """Ids or ranks that occur twice in one daily list."""
    lists = ("day", "source")
    by_app = rankings.groupBy(*lists, "app_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select(
        *lists, F.lit("duplicate_app").alias("fault"), F.col("app_id").cast("bigint").alias("value"))
    by_rank = rankings.groupBy(*lists, "rank").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select(
        *lists, F.lit("duplicate_rank").alias("fault"), F.col("rank").cast("bigint").alias("value"))
    return by_app.unionByName(by_rank)
