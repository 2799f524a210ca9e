"""Catalog upserts: identity, decisions, verification and slug assignment.

Every decision is one reason column filled by a ladder of tests; an item is
accepted when it has no reason.  Ids must be unique inside a plan, otherwise all
items sharing one are rejected, so the outcome does not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions import text as T
from ..functions.ordering import first_per_key, group_row_number
from ..session import ensure_checkpoint_dir
from .changes import owner_conflicts

NSUIDS = ("nsuid_americas", "nsuid_europe", "nsuid_japan")
SHARED_IDS = ("steam_app_id", *NSUIDS)
SINGLE_IDS = ("psn_product_id", "xbox_big_id")
ITEM_COLS = ("slug", "title", "steam_app_id", *NSUIDS, "nintendo_us_slug", "psn_product_id", "psn_edition",
             "xbox_big_id", "xbox_edition", "platforms", "tier", "added_at", "primary_regional_channel")


def _marked(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.select(key).distinct().withColumn(name, F.lit(True))


def plan_duplicates(items: DataFrame) -> DataFrame:
    """Plan keys that share a slug or an id with another item of the plan."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("id"))
        for c in ("slug", *SHARED_IDS, *SINGLE_IDS)]))
    long = items.select("key", pairs.alias("p")).select("key", "p.kind", "p.id").where(F.col("id").isNotNull())
    shared = long.groupBy("kind", "id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return long.join(shared.select("kind", "id"), ["kind", "id"], "left_semi").select("key").distinct()


def _replaces(column: str) -> Column:
    return F.coalesce(F.col(f"c_{column}") != F.col(column), F.lit(False))


def judge_batch(catalog: DataFrame, items: DataFrame, title_key=T.norm_title) -> DataFrame:
    """Items with the reason they cannot be applied, or null."""
    foreign = owner_conflicts(items, catalog, SHARED_IDS).select("slug", "id_kind")
    taken_single = F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("id")) for c in SINGLE_IDS]))
    singles = items.select("slug", taken_single.alias("p")).select("slug", "p.kind", "p.id").where(F.col("id").isNotNull())
    held = catalog.select(taken_single.alias("p")).select("p.kind", "p.id").where(F.col("id").isNotNull()).distinct()
    owned = singles.join(held, ["kind", "id"], "left_semi")
    existing = catalog.select(
        F.col("slug"), F.lit(True).alias("c_exists"), title_key("title").alias("c_key"), F.col("platforms").alias("c_platforms"),
        *[F.col(c).alias(f"c_{c}") for c in (*SHARED_IDS, "nintendo_us_slug", *SINGLE_IDS)])
    j = (
        items.join(_marked(plan_duplicates(items), "key", "dup"), "key", "left")
        .join(_marked(foreign, "slug", "foreign"), "slug", "left")
        .join(_marked(owned, "slug", "owned"), "slug", "left")
        .join(existing, "slug", "left")
        .withColumn("own_key", title_key("title"))
    )
    switch = lambda c: F.filter(F.coalesce(c, F.array()), lambda p: p.isin("switch", "switch-2"))
    before, coming = switch(F.col("c_platforms")), switch(F.col("platforms"))
    clash = (
        (F.coalesce(*[F.col(c) for c in NSUIDS]).isNotNull()) & (F.size(before) > 0)
        & ((F.size(before) != 1) | ~F.coalesce(F.try_element_at(before, F.lit(1)) == F.try_element_at(coming, F.lit(1)), F.lit(False)))
    )
    new, add = F.col("catalog_action") == "new_game", F.col("catalog_action") == "add_platform_mapping"
    reason = (
        F.when(F.col("dup"), "duplicate_in_plan")
        .when(F.col("foreign") | F.col("owned"), "id_owned_by_other_game")
        .when(~(new | add), "unsupported_action")
        .when(new & F.col("c_exists"), "slug_already_exists")
        .when(add & F.col("c_exists").isNull(), "mapping_target_missing")
        .when(add & ((F.col("own_key") == "") | (F.col("own_key") != F.col("c_key"))), "title_mismatch")
        .when(add & _replaces("steam_app_id"), "replaces_steam_app_id")
        .when(add & (_replaces("nsuid_americas") | _replaces("nsuid_europe") | _replaces("nsuid_japan")), "replaces_nsuid")
        .when(add & _replaces("nintendo_us_slug"), "replaces_nintendo_us_slug")
        .when(add & F.col("psn_product_id").isNotNull() & F.col("c_psn_product_id").isNotNull(), "replaces_psn_identity")
        .when(add & F.col("xbox_big_id").isNotNull() & F.col("c_xbox_big_id").isNotNull(), "replaces_xbox_identity")
        .when(add & clash, "console_generation_conflict")
    )
    return j.withColumn("reason", reason).select(*items.columns, "reason")


def apply_batch(catalog: DataFrame, items: DataFrame, added_at: str, title_key=T.norm_title) -> tuple[DataFrame, DataFrame]:
    """(new catalog, rejects).  New games are appended; mappings fill empty ids
    and add platforms but never replace anything."""
    judged = judge_batch(catalog, items, title_key)
    good = judged.where(F.col("reason").isNull())
    fresh = good.where(F.col("catalog_action") == "new_game").withColumns({
        "tier": F.lit("extended"), "added_at": F.lit(added_at), "title": F.trim("title"),
        "platforms": F.array_distinct("platforms")})
    fill = [c for c in ITEM_COLS if c not in ("slug", "title", "tier", "added_at", "platforms")]
    mapped = good.where(F.col("catalog_action") == "add_platform_mapping").select(
        "slug", F.col("platforms").alias("i_platforms"), *[F.col(c).alias(f"i_{c}") for c in fill])
    kept = catalog.select(*ITEM_COLS).join(mapped, "slug", "left").select(
        "slug", "title", *[F.coalesce(c, f"i_{c}").alias(c) for c in fill], "tier", "added_at",
        F.array_union("platforms", F.coalesce("i_platforms", F.array())).alias("platforms"))
    return kept.unionByName(fresh.select(*ITEM_COLS)), judged.where(F.col("reason").isNotNull())


def resolve_identity(records: DataFrame, catalog: DataFrame, title_key=T.norm_title) -> DataFrame:
    """Which catalog game a record belongs to, or why it cannot be decided.

    ``records`` holds (source_key, slug, title, steam_app_id).  Catalog titles
    and ids are reduced to one owner per key first.
    """
    mapped = F.coalesce(*[F.col(c) for c in NSUIDS]).isNotNull()
    games = catalog.select("slug", "steam_app_id", title_key("title").alias("key"), mapped.alias("mapped"))
    by_app = games.where(F.col("steam_app_id").isNotNull()).groupBy("steam_app_id").agg(
        F.max(F.struct("slug", "key", "mapped")).alias("app"))
    by_title = games.where(F.col("key") != "").groupBy("key").agg(F.max(F.struct("slug", "key", "mapped")).alias("named"))
    by_slug = games.select(F.col("slug")).distinct().withColumn("slug_taken", F.lit(True))
    j = (
        records.withColumn("key", title_key("title")).join(by_app, "steam_app_id", "left")
        .join(by_title, "key", "left").join(by_slug, "slug", "left")
        .withColumn("hit", F.coalesce("app", "named"))
    )
    fits = F.array_contains(T.edition_keys("key"), F.col("hit.key"))
    reason = (
        F.when(F.col("app.slug") != F.col("named.slug"), "catalog_identity_conflict")
        .when(F.col("hit").isNotNull() & ~F.coalesce(fits, F.lit(False)), "catalog_title_conflict")
        .when(F.col("hit.mapped"), "already_has_nintendo_mapping")
        .when(F.col("hit").isNull() & F.col("slug_taken"), "catalog_slug_conflict")
    )
    action = F.when(F.col("reason").isNull(), F.when(F.col("hit").isNotNull(), "add_platform_mapping").otherwise("new_game"))
    return j.withColumn("reason", reason).select(
        "source_key", "title", "steam_app_id", F.coalesce("hit.slug", "slug").alias("slug"), action.alias("catalog_action"), "reason")


def dedupe_slugs(candidates: DataFrame, catalog: DataFrame, base: Column | None = None) -> DataFrame:
    """Collision-free slugs for new games: the title's slug, then with the
    release year, then with the store id, then with a counter after the highest
    one in use.

    ``candidates`` holds (seq, title, year, store_id).  Claims are settled in
    rounds over all candidates: the earliest ``seq`` claiming a free slug gets
    it.  A round is one aggregate per slug, so a slug claimed by very many
    candidates is not gathered anywhere; its outcome is checkpointed, so that the
    next round does not compute it again.
    """
    ensure_checkpoint_dir(candidates.sparkSession)
    wanted = T.slugify("title", 72) if base is None else base
    open_ = candidates.withColumn("base", F.when(wanted != "", wanted).otherwise(F.concat(F.lit("game-"), F.col("store_id").cast("string"))))
    taken = catalog.select("slug").distinct()
    done = None
    claims = (
        F.col("base"),
        F.when(F.col("year").isNotNull(), F.concat_ws("-", "base", F.col("year").cast("string"))),
        F.concat_ws("-", "base", F.col("store_id").cast("string")),
    )
    for claim in claims:
        asked = open_.withColumn("slug", claim)
        free = asked.where(F.col("slug").isNotNull()).join(taken, "slug", "left_anti")
        winners = free.groupBy("slug").agg(F.min("seq").alias("seq"))
        settled = open_.join(winners, "seq", "left").select(*open_.columns, "slug").checkpoint()
        won = settled.where(F.col("slug").isNotNull())
        done = won if done is None else done.unionByName(won)
        taken = taken.unionByName(won.select("slug"))
        open_ = settled.where(F.col("slug").isNull()).drop("slug")
    # what is left repeats both base and store id; (stem, counter) names a slug, so new counters are free
    stem = F.concat_ws("-", "base", F.col("store_id").cast("string"))
    rest = group_row_number(open_.withColumn("stem", stem), ["stem"], ["seq"], "n")
    counter = r"^(.*)-(\d{1,9})$"
    used = taken.where(F.col("slug").rlike(counter)).groupBy(F.regexp_extract("slug", counter, 1).alias("stem")).agg(
        F.max(F.regexp_extract("slug", counter, 2).cast("long")).alias("used"))
    rest = rest.join(used, "stem", "left").withColumn("n", F.greatest(F.coalesce("used", F.lit(1)), F.lit(1)) + F.col("n"))
    rest = rest.select(*open_.columns, F.concat_ws("-", "stem", F.col("n").cast("string")).alias("slug"))
    return done.unionByName(rest)


def freeze_slugs(candidates: DataFrame, catalog: DataFrame, title_key=T.norm_title) -> DataFrame:
    """Every candidate with its slug, or the reason it gets none.

    ``candidates`` holds (seq, title, year, store_id, slug, catalog_action).  A
    mapping keeps the slug it names, if that is a game of the catalog whose title
    it matches; a new game starts from its own slug where that is well formed,
    else from its title, and is told apart from the catalog and from all others
    as in ``dedupe_slugs``.
    """
    action = F.col("catalog_action")
    good = X.matches("slug", X.SLUG_SHAPE)
    known = catalog.groupBy("slug").agg(F.min("title").alias("t_title"))
    mapped = candidates.where(action == "add_platform_mapping").join(known, "slug", "left")
    own = title_key("title")
    fits = F.array_contains(T.edition_keys(own), title_key("t_title"))
    reason = (
        F.when(~good, "mapping_without_slug").when(F.col("t_title").isNull(), "mapping_target_missing")
        .when((own == "") | ~F.coalesce(fits, F.lit(False)), "title_mismatch")
    )
    mapped = mapped.withColumn("reason", reason).select("seq", F.when(F.col("reason").isNull(), F.col("slug")).alias("slug"), "reason")
    fresh = candidates.where(F.coalesce(action, F.lit("new_game")) == "new_game")
    wanted = F.when(X.matches("hint", X.SLUG_SHAPE), F.col("hint")).otherwise(T.slugify("title", 72))
    named = dedupe_slugs(fresh.withColumnRenamed("slug", "hint"), catalog, wanted).select("seq", "slug", F.lit(None).cast("string").alias("reason"))
    other = candidates.where(~F.coalesce(action, F.lit("new_game")).isin("new_game", "add_platform_mapping")).select(
        "seq", F.lit(None).cast("string").alias("slug"), F.lit("unsupported_action").alias("reason"))
    return named.unionByName(mapped).unionByName(other)


def apply_day_one(catalog: DataFrame, candidates: DataFrame, added_at: str) -> DataFrame:
    """The appended rows of ``day_one``."""
    return day_one(catalog, candidates, added_at)[0]


def day_one(catalog: DataFrame, candidates: DataFrame, added_at: str) -> tuple[DataFrame, DataFrame]:
    """(appended, rejects): unknown store ids under their slug, or slug-id when it is taken.

    A store id that comes more than once is appended once, under its smallest
    slug.  A candidate whose fallback is taken as well, by the catalog or as
    another one's slug, is a reject (steam_app_id, slug_hint, title, reason).
    """
    known = catalog.where(F.col("steam_app_id").isNotNull()).select("steam_app_id").distinct()
    fresh = candidates.join(known, "steam_app_id", "left_anti")
    fresh = first_per_key(fresh, ["steam_app_id"], [F.col("slug_hint"), F.col("title")])
    first = fresh.groupBy("slug_hint").agg(F.min("steam_app_id").alias("first_id"))
    taken = _marked(catalog, "slug", "taken").withColumnRenamed("slug", "slug_hint")
    j = fresh.join(first, "slug_hint").join(taken, "slug_hint", "left")
    plain = F.col("taken").isNull() & (F.col("steam_app_id") == F.col("first_id"))
    slug = F.when(plain, F.col("slug_hint")).otherwise(F.concat_ws("-", "slug_hint", F.col("steam_app_id").cast("string")))
    title = F.trim(F.regexp_replace(F.regexp_replace("title", "[™®©]", ""), r"\s+", " "))
    named = j.select(slug.alias("slug"), plain.alias("plain"), "slug_hint", title.alias("title"), "steam_app_id")
    # slugs the catalog or a plain candidate holds; a fallback that is one of them has no place
    held = catalog.select("slug").union(named.where("plain").select("slug")).distinct().withColumn("held", F.lit(True))
    named = named.join(held, "slug", "left")
    lost = ~F.col("plain") & F.col("held").isNotNull()
    appended = named.where(~lost).select("slug", "title", "steam_app_id", F.array(F.lit("pc")).alias("platforms"),
                                         F.lit("extended").alias("tier"), F.lit(added_at).alias("added_at"))
    return appended, named.where(lost).select("steam_app_id", "slug_hint", "title", F.lit("slug_collision").alias("reason"))


# ------------------------------------------------------------ decisions and state

# Words of a review sheet, fixed values.
DECISIONS = {
    "approve": ("批准", "已批准", "可上线", "已上线", "approved"),
    "reject": ("淘汰", "已淘汰", "忽略", "已忽略", "拒绝", "已拒绝", "rejected"),
    "pending": ("", "待定", "待审", "待审核", "待批准", "未决定", "pending"),
}


def decision(text: str) -> Column:
    """approve / reject / pending, or null for an unknown word."""
    word = F.lower(F.trim(F.coalesce(F.col(text), F.lit(""))))
    out = None
    for name, words in DECISIONS.items():
        out = F.when(word.isin(*words), name) if out is None else out.when(word.isin(*words), name)
    return out


def candidate_id() -> Column:
    """Stable id of a candidate: the first store id it has."""
    return F.coalesce(
        F.concat(F.lit("steam:"), F.col("steam_app_id").cast("string")),
        *[F.concat(F.lit("ns:"), F.col(c)) for c in NSUIDS],
        F.concat(F.lit("psn:"), F.col("psn_product_id")),
        F.concat(F.lit("xbox:"), F.col("xbox_big_id")))


def candidate_id_fault(given: str = "candidate_id") -> Column:
    """Reason a given id disagrees with the store ids of its row."""
    kind, value = F.split_part(F.col(given), F.lit(":"), F.lit(1)), F.split_part(F.col(given), F.lit(":"), F.lit(2))
    ids = F.array_compact(F.array(*[F.col(c) for c in NSUIDS]))
    differs = lambda c: F.col(c).isNotNull() & (F.col(c).cast("string") != value)
    return (
        F.when(~kind.isin("steam", "ns", "psn", "xbox") | (value == ""), "bad_candidate_id")
        .when((kind == "steam") & differs("steam_app_id"), "steam_id_mismatch")
        .when((kind == "ns") & (F.size(ids) > 0) & ~F.array_contains(ids, value), "nsuid_mismatch")
        .when((kind == "psn") & differs("psn_product_id"), "psn_id_mismatch")
        .when((kind == "xbox") & differs("xbox_big_id"), "xbox_id_mismatch")
    )


def decision_join(candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """An explicit decision counts only for the evidence that was reviewed."""
    d = decisions.select("candidate_id", decision("decision").alias("source_decision"), "reviewed_digest")
    j = candidates.join(d, "candidate_id", "left")
    stale = F.coalesce(F.col("reviewed_digest") != F.col("evidence_digest"), F.lit(False))
    said = F.coalesce("source_decision", F.lit("pending"))
    return j.select(*candidates.columns, said.alias("source_decision"), stale.alias("evidence_stale"),
                    F.when(stale, "pending").otherwise(said).alias("decision"))


STATE = ("verify_status", "apply_status", "verified_at", "applied_at")


def decision_digest(decided: str = "decision") -> Column:
    return F.sha2(F.concat_ws("|", "candidate_id", "evidence_digest", F.col(decided)), 256)


def candidate_state_join(candidates: DataFrame, state: DataFrame) -> DataFrame:
    """Machine state of every candidate; it is void once evidence or decision
    changed, but an applied candidate stays applied and a frozen slug stays."""
    s = state.select("candidate_id", F.col("evidence_digest").alias("s_evidence"), F.col("decision_digest").alias("s_decision"),
                     F.col("slug").alias("s_slug"), *[F.col(c).alias(f"s_{c}") for c in STATE], F.lit(True).alias("s_known"))
    by_policy = F.col("policy_approved") if "policy_approved" in candidates.columns else F.lit(False)
    j = candidates.join(s, "candidate_id", "left").withColumn("known", F.coalesce("s_known", F.lit(False)))
    changed = F.col("known") & ~F.coalesce(F.col("s_evidence") == F.col("evidence_digest"), F.lit(False))
    stale = F.coalesce("evidence_stale", F.lit(False))
    lost = (F.col("source_decision") == "approve") & (F.col("evidence_changed") | stale) & ~F.coalesce(by_policy, F.lit(False))
    j = j.withColumn("evidence_changed", changed).withColumn("approval_stale", lost)
    j = j.withColumn("decision", F.when(F.col("approval_stale"), "pending").otherwise(F.col("source_decision")))
    j = j.withColumn("decision_digest", decision_digest())
    moved = F.col("known") & ~F.col("evidence_changed") & ~F.coalesce(F.col("s_decision") == F.col("decision_digest"), F.lit(False))
    j = j.withColumn("decision_changed", moved)
    valid = F.col("known") & ~F.col("evidence_changed") & ~F.col("decision_changed") & ~stale
    j = j.withColumn("state_valid", valid)
    applied = F.col("known") & (F.col("s_apply_status") == "applied")
    keep = F.col("state_valid")
    return j.select(
        "candidate_id", "title", "evidence_digest", F.coalesce("s_slug", "slug").alias("slug"), "source_decision", "decision",
        "decision_digest", F.when(keep, F.col("s_verify_status")).otherwise("pending").alias("verify_status"),
        F.when(keep | applied, F.col("s_apply_status")).otherwise("not_applied").alias("apply_status"),
        F.when(keep, F.col("s_verified_at")).alias("verified_at"),
        F.when(keep | applied, F.col("s_applied_at")).alias("applied_at"),
        "evidence_changed", "decision_changed", "approval_stale", F.coalesce("evidence_stale", F.lit(False)).alias("evidence_stale"), "state_valid")


def policy_approve(candidates: DataFrame, state: DataFrame) -> DataFrame:
    """Approve everything under a named policy, then rejoin the state."""
    approved = candidates.withColumns({
        "source_decision": F.lit("approve"), "evidence_stale": F.lit(False), "policy_approved": F.lit(True)})
    return candidate_state_join(approved, state)


def eligible_for_batch(joined: DataFrame, as_of=None, max_age_days: int | None = None) -> DataFrame:
    """Approved, verified and not yet applied candidates with a recent check."""
    ok = (
        (F.col("decision") == "approve") & ~F.col("approval_stale") & ~F.col("evidence_stale") & F.col("state_valid")
        & (F.col("verify_status") == "passed") & F.col("apply_status").isin("not_applied", "failed")
        & F.col("verified_at").isNotNull() & (F.col("decision_digest") == decision_digest())
    )
    if max_age_days is not None:
        age = F.unix_seconds(X.moment(as_of)) - F.unix_seconds(F.col("verified_at").cast("timestamp"))
        ok = ok & (age <= max_age_days * 86400)
    return joined.where(ok)


def batch_items(joined: DataFrame, limit: int = 25, as_of=None, max_age_days: int | None = None) -> DataFrame:
    """The next batch: eligible candidates with a frozen slug and a title."""
    rows = eligible_for_batch(joined, as_of, max_age_days).where(X.matches("slug", X.SLUG_SHAPE) & (F.trim("title") != ""))
    return rows.orderBy("candidate_id").limit(limit).select(
        F.col("candidate_id").alias("key"), "slug", F.trim("title").alias("title"), "evidence_digest", "decision_digest", "verified_at")


# ------------------------------------------------------------ suggestions and verification

def build_suggestion(candidates: DataFrame, evidence: DataFrame, owners: DataFrame) -> DataFrame:
    """Combine the three regions' evidence of every candidate.

    ``evidence`` holds one row per (slug, region) with status, reason, nsuid and
    generation; ``owners`` (nsuid, owner).  A suggestion passes when no test
    leaves an exception.
    """
    regions = ("americas", "europe", "japan")
    ev = evidence.groupBy("slug").agg(*[
        F.max(F.when(F.col("region") == r, F.struct("status", "reason", "nsuid", "generation"))).alias(r) for r in regions])
    owned = owners.groupBy("nsuid").agg(F.min("owner").alias("owner"))
    foreign = (
        evidence.where(F.col("nsuid").isNotNull()).join(owned, "nsuid").where(F.col("owner") != F.col("slug"))
        .groupBy("slug").agg(F.array_sort(F.collect_set(F.concat(F.lit("catalog_nsuid_conflict:"), "nsuid"))).alias("foreign"))
    )
    j = candidates.join(ev, "slug", "left").join(foreign, "slug", "left")
    ids = {r: F.when(F.col(f"{r}.status") == "matched", F.col(f"{r}.nsuid")) for r in regions}
    gens = F.array_distinct(F.array_compact(F.array(*[F.when(F.col(f"{r}.status") == "matched", F.col(f"{r}.generation")) for r in regions])))
    new = F.col("catalog_action") == "new_game"
    faults = [F.when(F.col(f"{r}.status") == "exception", F.concat(F.lit(f"{r}_"), F.coalesce(f"{r}.reason", F.lit("exception")))) for r in regions]
    faults += [
        F.when(F.size(gens) > 1, "generation_fingerprint_conflict"),
        F.when(F.coalesce(*ids.values()).isNull(), "no_verified_nsuid"),
        F.when(F.coalesce("exclusivity_conflict", F.lit(False)), "exclusivity_evidence_conflict"),
        F.when(new & F.coalesce("popularity_unverified", F.lit(True)), "popularity_evidence_missing"),
        F.when(new & ids["europe"].isNull(), "new_game_europe_mapping_required"),
    ]
    missing = [F.when(F.coalesce(F.col(f"{r}.status"), F.lit("none")) == "none", f"{r}_not_found") for r in regions]
    exceptions = F.array_sort(F.array_distinct(F.concat(F.array_compact(F.array(*faults)), F.coalesce("foreign", F.array()))))
    return j.select(
        "slug", "title", "catalog_action", *[ids[r].alias(f"nsuid_{r}") for r in regions],
        F.when(F.size(gens) == 1, F.try_element_at(gens, F.lit(1))).alias("generation"),
        exceptions.alias("exceptions"), F.array_sort(F.array_compact(F.array(*missing))).alias("warnings"),
    ).withColumn("verify_status", F.when(F.size("exceptions") == 0, "passed").otherwise("exception"))


def verify_candidates(candidates: DataFrame, catalog: DataFrame, as_of, ttl_days: int = 30, title_key=T.norm_title) -> DataFrame:
    """Re-check approved candidates on retained evidence: digest, age and
    identity in the catalog.

    ``candidates`` holds key, slug, title, catalog_action, ids, collected_at,
    evidence_digest and computed_digest.
    """
    at = F.unix_seconds(F.try_to_timestamp("collected_at"))
    age = F.unix_seconds(X.moment(as_of)) - F.col("__at")
    judged = judge_batch(catalog, candidates, title_key).withColumn("__at", at)
    reason = (
        F.when(~X.matches("evidence_digest", X.DIGEST_SHAPE), "bad_digest")
        .when(F.col("evidence_digest") != F.col("computed_digest"), "digest_mismatch")
        .when(F.col("__at").isNull(), "bad_evidence_time")
        .when(age < 0, "evidence_from_the_future")
        .when(age > ttl_days * 86400, "evidence_expired")
        .otherwise(F.col("reason"))
    )
    return judged.withColumn("reason", reason).drop("__at").withColumn("passed", F.col("reason").isNull())


def mapping_candidates(found: DataFrame, products: DataFrame, as_of, ttl_days: int = 7, title_key=T.norm_title) -> DataFrame:
    """Mapping candidates of a single-market store from search and product
    evidence, with the offer arithmetic re-checked.

    ``found`` holds (slug, title, product_id, matched_title); ``products``
    (product_id, product_title, sku_title, edition, amount, list_amount,
    discount_pct, observed_at).
    """
    j = found.join(products, "product_id", "left")
    want = title_key("title")
    same = lambda c: title_key(c) == F.col("want")
    expires = F.col("observed_at").cast("timestamp") + F.expr(f"INTERVAL {ttl_days} DAYS")
    on_sale = F.col("list_amount").isNotNull()
    right_pct = F.col("discount_pct") == X.discount_pct("amount", "list_amount")
    reason = (
        F.when(F.col("product_title").isNull(), "product_missing")
        .when(F.col("want") == "", "empty_title")
        .when(~(same("matched_title") & same("product_title") & same("sku_title")), "title_mismatch")
        .when(~F.coalesce(F.col("edition") == "standard", F.lit(False)), "not_standard_edition")
        .when(~F.coalesce(F.col("amount") > 0, F.lit(False)), "no_public_offer")
        .when(on_sale & ~F.coalesce((F.col("list_amount") > F.col("amount")) & right_pct, F.lit(False)), "offer_arithmetic")
        .when(~on_sale & F.col("discount_pct").isNotNull(), "offer_arithmetic")
        .when(F.col("observed_at").cast("timestamp") > X.moment(as_of), "observed_in_future")
        .when(expires <= X.moment(as_of), "expired")
    )
    return j.withColumn("want", want).withColumn("expires_at", expires).withColumn("reason", reason).select(
        "slug", "product_id", "amount", "list_amount", "discount_pct", "observed_at", "expires_at", "reason")


def manual_input_check(entries: DataFrame, catalog: DataFrame, lo: int = 10, hi: int = 20, title_key=T.norm_title) -> DataFrame:
    """Hand-made mappings: known game, equal title, unique, not mapped yet.
    The row count of the whole input must lie in [lo, hi]."""
    total = entries.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("k", F.lit(1))
    games = catalog.select("slug", title_key("title").alias("c_key"), F.col("psn_product_id").alias("mapped"))
    many = lambda c: entries.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    owned = catalog.where(F.col("psn_product_id").isNotNull()).select(F.col("psn_product_id").alias("product_id")).distinct().withColumn("owned", F.lit(True))
    j = (
        entries.withColumn("k", F.lit(1)).join(F.broadcast(total), "k").join(games, "slug", "left")
        .join(_marked(many("slug"), "slug", "dup_slug"), "slug", "left")
        .join(_marked(many("product_id"), "product_id", "dup_id"), "product_id", "left")
        .join(owned, "product_id", "left")
    )
    reason = (
        F.when(~F.col("n_rows").between(lo, hi), "row_count")
        .when(F.col("dup_slug"), "duplicate_slug").when(F.col("c_key").isNull(), "unknown_slug")
        .when((F.col("c_key") == "") | (title_key("title") != F.col("c_key")), "title_mismatch")
        .when(F.col("mapped").isNotNull(), "already_mapped").when(F.col("dup_id"), "duplicate_product")
        .when(F.col("owned"), "product_owned")
    )
    status = F.when(F.col("reason").isNotNull(), "rejected").when(F.col("product_id").isNull(), "pending").otherwise("ready")
    return j.withColumn("reason", reason).withColumn("status", status).select("slug", "title", "product_id", "status", "reason")
