"""Candidates re-checked on the evidence kept for them.

Evidence is unpivoted to one row per block.  Every block is judged on its own
digest, its own time and its own term, and the blocks of a candidate fold back
to the first reason in a fixed order.  Catalog ids are unpivoted likewise, so
that all questions of ownership are one join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions import text as T
from .catalog import NSUIDS

# Blocks in the order in which they are judged, and days they hold, fixed values.
RETAINED = ("us_automatic", "us_manual", "europe", "japan", "popularity", "exclusivity", "steam_match")
SEALED = ("product",)
RETAINED_DAYS = 30
SEALED_DAYS = 7
SEVERAL = ("popularity",)
KINDS = ("ns", "psn", "xbox")
EVIDENCE = "array<struct<block:string,observed_at:string,expires_at:string,digest:string,body:string,nsuid:string,product_slug:string>>"


def evidence_blocks(candidates: DataFrame) -> DataFrame:
    """(candidate_id, place, name, and the block's own columns): a row per block.

    A kind that may occur several times is named by its number, ``popularity_2``.
    Blocks of an unknown kind come first, so that they cannot be overlooked.
    """
    ev = F.coalesce("evidence", F.array().cast(EVIDENCE))
    several = F.col("e.block").isin(*SEVERAL)
    number = F.size(F.filter(F.slice("ev", 1, F.col("pos") + 1), lambda b: b["block"] == F.col("e.block")))
    rows = candidates.select("candidate_id", ev.alias("ev")).select("candidate_id", "ev", F.posexplode("ev").alias("pos", "e"))
    name = F.when(several, F.concat("e.block", F.lit("_"), number.cast("string"))).otherwise(F.col("e.block"))
    place = F.struct(X.ordinal("e.block", (*RETAINED, *SEALED), -1).alias("kind"), F.col("pos"))
    return rows.select("candidate_id", place.alias("place"), name.alias("name"), "e.*")


def judged_blocks(blocks: DataFrame, as_of, retained_days: int = RETAINED_DAYS, sealed_days: int = SEALED_DAYS) -> DataFrame:
    """Blocks with the reason they no longer hold, or null.

    A retained block holds for a term from its own time; a sealed one names its
    end, which may not lie further than the term.
    """
    now = F.unix_seconds(X.moment(as_of))
    seen, ends = F.unix_seconds(F.try_to_timestamp("observed_at")), F.unix_seconds(F.try_to_timestamp("expires_at"))
    sealed = F.col("block").isin(*SEALED)
    term = ends - seen
    fault = (
        F.when(~F.col("block").isin(*RETAINED, *SEALED), "unknown")
        .when(~X.matches("digest", X.DIGEST_SHAPE), "bad_digest")
        .when(F.col("digest") != F.concat(F.lit("sha256:"), F.sha2("body", 256)), "digest_mismatch")
        .when(seen.isNull() | (sealed & ends.isNull()), "time_invalid")
        .when(~sealed & (seen > now), "in_future")
        .when(~sealed & (now - seen > retained_days * 86400), "expired")
        .when(sealed & ((term <= 0) | (term > sealed_days * 86400) | (seen > now)), "term_invalid")
        .when(sealed & (ends <= now), "expired")
    )
    return blocks.withColumn("fault", fault).withColumn("reason", F.when(F.col("fault").isNotNull(), F.concat_ws("_", "name", "fault")))


def aged_evidence(candidates: DataFrame, as_of, **terms: int) -> DataFrame:
    """(candidate_id, n_blocks, n_faults, evidence_reason): the blocks of a candidate folded to its first reason."""
    judged = judged_blocks(evidence_blocks(candidates), as_of, **terms)
    first = F.min(F.when(F.col("reason").isNotNull(), F.struct("place", "reason")))
    per = judged.groupBy("candidate_id").agg(F.count(F.lit(1)).alias("n_blocks"), F.count("reason").alias("n_faults"), first.alias("first"))
    return per.select("candidate_id", "n_blocks", "n_faults", F.col("first.reason").alias("evidence_reason"))


OWNED = {"steam_app_id": "steam", **{c: "nsuid" for c in NSUIDS}, "psn_product_id": "psn", "psn_concept_id": "concept", "xbox_big_id": "xbox"}


def _ids(df: DataFrame, *keep: str) -> DataFrame:
    """A row per id that is set: (*keep, kind, id)."""
    each = F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("id")) for c, kind in OWNED.items()]))
    return df.select(*keep, each.alias("i")).where(F.col("i.id").isNotNull()).select(*keep, "i.kind", "i.id")


def id_owners(candidates: DataFrame, catalog: DataFrame) -> DataFrame:
    """(candidate_id, any_<kind>, other_<kind>): a game that holds an id of the candidate, and one that is not its own target."""
    held = _ids(catalog, "slug").groupBy("kind", "id").agg(F.min("slug").alias("owner"), F.max("slug").alias("last"))
    asked = _ids(candidates, "candidate_id", "slug").join(held, ["kind", "id"])
    other = F.when(F.col("owner") != F.col("slug"), F.col("owner")).when(F.col("last") != F.col("slug"), F.col("last"))
    kinds = sorted(set(OWNED.values()))
    return asked.withColumn("other", other).groupBy("candidate_id").agg(
        *[F.min(F.when(F.col("kind") == k, F.col("owner"))).alias(f"any_{k}") for k in kinds],
        *[F.min(F.when(F.col("kind") == k, F.col("other"))).alias(f"other_{k}") for k in kinds])


def _block(kind: str) -> Column:
    """The first block of a kind, or null."""
    return F.try_element_at(F.filter(F.coalesce("evidence", F.array().cast(EVIDENCE)), lambda e: e["block"] == kind), F.lit(1))


def verify_retained(candidates: DataFrame, catalog: DataFrame, as_of, signed: Sequence[str], title_key=T.norm_title, **terms: int) -> DataFrame:
    """Every candidate with (passed, reason): the first test it fails, none if it still holds.

    ``candidates`` holds candidate_id (``ns:``, ``psn:`` or ``xbox:`` and a store
    id), slug, title, catalog_action, the store ids, nintendo_us_slug,
    psn_edition, xbox_edition, platforms, primary_regional_channel,
    verify_status, exception_reasons, evidence_digest and ``evidence``, an array
    of blocks.  ``evidence_digest`` seals the columns named in ``signed``.
    """
    kind = F.split_part("candidate_id", F.lit(":"), F.lit(1))
    own_id = F.split_part("candidate_id", F.lit(":"), F.lit(2))
    target = catalog.select(
        "slug", F.lit(True).alias("t_known"), title_key("title").alias("t_key"), F.col("platforms").alias("t_platforms"),
        *[F.col(c).alias(f"t_{c}") for c in (*NSUIDS, "nintendo_us_slug", "psn_product_id", "psn_concept_id", "psn_edition", "xbox_big_id", "xbox_edition")])
    j = (
        candidates.withColumns({"__kind": kind, "__key": title_key("title"), "__us": F.coalesce(_block("us_automatic"), _block("us_manual"))})
        .join(aged_evidence(candidates, as_of, **terms), "candidate_id", "left")
        .join(id_owners(candidates, catalog), "candidate_id", "left").join(target, "slug", "left")
    )
    ns, psn, xbox = (F.col("__kind") == k for k in KINDS)
    new, add = F.col("catalog_action") == "new_game", F.col("catalog_action") == "add_platform_mapping"
    known = F.coalesce("t_known", F.lit(False))
    nsuids = F.array_compact(F.array(*[F.col(c) for c in NSUIDS]))
    no = lambda c: ~F.coalesce(c, F.lit(False))
    differs = lambda c: no(F.col(f"t_{c}") == F.col(c))
    sealed = F.lit(True)
    for mine, shape, column, edition in ((psn, X.PSN_PRODUCT_SHAPE, "psn_product_id", "psn_edition"), (xbox, X.XBOX_SHAPE, "xbox_big_id", "xbox_edition")):
        good = X.matches(column, shape) & (own_id == F.col(column)) & (F.col(edition) == "standard")
        sealed = sealed & (~mine | F.coalesce(good & add & X.matches("slug", X.SLUG_SHAPE) & (F.trim("title") != ""), F.lit(False)))
    consoles = F.array_sort(F.array_distinct("platforms"))
    fits = (~psn | ((F.size("platforms") > 0) & (consoles == F.col("platforms")) & (F.size(F.array_except("platforms", F.array(F.lit("ps4"), F.lit("ps5")))) == 0))) & (
        ~xbox | (F.col("platforms") == F.array(F.lit("xbox"))))
    primary = F.when(new, "eshop")
    ladder = (
        (~F.col("__kind").isin(*KINDS) | (ns & ~X.matches(own_id, X.NSUID_SHAPE)) | ~sealed, "bad_candidate_id"),
        (~X.matches("evidence_digest", X.DIGEST_SHAPE), "bad_digest"),
        (F.col("evidence_digest") != X.fingerprint(*signed), "digest_mismatch"),
        (ns & (no(F.col("verify_status") == "passed") | (F.size(F.coalesce("exception_reasons", F.array().cast("array<string>"))) > 0)), "discovery_not_passed"),
        (ns & ~F.array_contains(nsuids, own_id), "candidate_id_not_retained"),
        (ns & F.col("nsuid_americas").isNotNull() & no(F.col("__us.nsuid") == F.col("nsuid_americas")), "americas_evidence_mismatch"),
        (ns & F.col("nsuid_americas").isNotNull() & ~F.col("__us.product_slug").eqNullSafe(F.col("nintendo_us_slug")), "us_slug_mismatch"),
        (ns & F.col("nsuid_americas").isNull() & (F.col("nintendo_us_slug").isNotNull() | F.col("__us").isNotNull()), "us_identity_without_nsuid"),
        (ns & ~F.col("primary_regional_channel").eqNullSafe(primary), "wrong_primary_channel"),
        (~ns & no(fits), "platform_mismatch"),
        (~ns & _block("product").isNull(), "product_evidence_missing"),
        (F.col("evidence_reason").isNotNull(), F.col("evidence_reason")),
        (~(new | add), "unsupported_action"),
        (new & known, "slug_already_exists"),
        (add & ~known, "mapping_target_missing"),
        (add & ((F.col("__key") == "") | no(F.array_contains(T.edition_keys("__key"), F.col("t_key")))), "title_mismatch"),
        (F.col("other_steam").isNotNull() | (new & F.col("any_steam").isNotNull()), "steam_id_owned"),
        (F.col("other_nsuid").isNotNull() | (new & F.col("any_nsuid").isNotNull()), "nsuid_owned"),
        (ns & add & F.coalesce(*[F.when(F.col(c).isNotNull() & F.col(f"t_{c}").isNotNull() & differs(c), True) for c in NSUIDS], F.lit(False)), "replaces_nsuid"),
        (ns & add & F.col("t_nintendo_us_slug").isNotNull() & differs("nintendo_us_slug"), "replaces_nintendo_us_slug"),
        (~ns & (F.col("__key") != F.col("t_key")), "title_not_exact"),
        (xbox & no(F.array_contains("t_platforms", "xbox")), "target_without_platform"),
        (psn & F.coalesce("t_psn_product_id", "t_psn_concept_id", "t_psn_edition").isNotNull(), "replaces_psn_identity"),
        (xbox & F.coalesce("t_xbox_big_id", "t_xbox_edition").isNotNull(), "replaces_xbox_identity"),
        (psn & F.col("any_psn").isNotNull(), "product_owned"),
        (psn & F.col("any_concept").isNotNull(), "concept_owned"),
        (xbox & F.col("any_xbox").isNotNull(), "product_owned"),
    )
    reason = F.coalesce(*[F.when(bad, X.col(told) if isinstance(told, Column) else F.lit(told)) for bad, told in ladder])
    return j.withColumn("reason", reason).withColumn("passed", F.col("reason").isNull()).select(*candidates.columns, "passed", "reason")
