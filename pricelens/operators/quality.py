"""The data-quality gate: one row per violated rule.

Every check returns (rule, severity, key, detail).  The gate passes when no row
of severity ``error`` exists.  Checks are filters, joins on unique sides and
counts; nothing is gathered per key.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expr as X
from . import changes as C

ERROR, WARNING = "error", "warning"
ALLOWED_PLATFORMS = ("pc", "ps4", "ps5", "xbox", "switch", "switch-2", "mobile")
SEEDS = ("self", "cheapshark", "eshop-eu")
CORE_LIMIT = 300
PSN_LIMIT = 20


def violation(df: DataFrame, rule: str, key: Column | str, detail: Column | str | None = None, severity: str = ERROR) -> DataFrame:
    told = F.lit(None).cast("string") if detail is None else X.col(detail).cast("string")
    return df.select(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), X.col(key).cast("string").alias("key"), told.alias("detail"))


def row_rules(df: DataFrame, key: str | Column, rules: Mapping[str, Column], severity: str = ERROR) -> DataFrame:
    """All row-level rules in one pass over the table; a rule is the condition
    under which a row is bad."""
    hits = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), name) for name, bad in rules.items()]))
    return (
        df.withColumn("__rule", F.explode(hits))
        .select(F.col("__rule").alias("rule"), F.lit(severity).alias("severity"), X.col(key).cast("string").alias("key"),
                F.lit(None).cast("string").alias("detail"))
    )


def union_all(first: DataFrame, *rest: DataFrame) -> DataFrame:
    for df in rest:
        first = first.unionByName(df)
    return first


def gate(violations: DataFrame) -> DataFrame:
    """Error and warning counts and the verdict, one row."""
    return violations.agg(
        F.count_if(F.col("severity") == ERROR).alias("errors"), F.count_if(F.col("severity") == WARNING).alias("warnings"),
    ).withColumn("passed", F.col("errors") == 0)


def check_rates(rates: DataFrame, as_of, max_hours: int = 48) -> DataFrame:
    """The euro rate is plausible and the table is recent; needs updated_at."""
    age = F.unix_seconds(X.moment(as_of)) - F.unix_seconds(F.col("updated_at").cast("timestamp"))
    eur = rates.where(F.col("currency") == "EUR")
    have = rates.agg(F.count_if(F.col("currency") == "EUR").alias("n"))
    return union_all(
        violation(eur.where(~F.col("rate").between(0.5, 2.0)), "rate_implausible", "currency", "rate"),
        violation(have.where(F.col("n") == 0), "rate_missing", F.lit("EUR")),
        violation(rates.where(~F.coalesce(age < max_hours * 3600, F.lit(False))), "rate_stale", "currency", "updated_at"),
    )


def check_currencies(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """Every foreign currency in use has a positive rate."""
    used = rows.where(F.col("currency") != "USD").groupBy("currency").agg(F.count(F.lit(1)).alias("n"))
    good = rates.where(F.col("rate") > 0).select("currency")
    return violation(used.join(good, "currency", "left_anti"), "no_rate", "currency", "n")


CATALOG_IDS = ("steam_app_id", "nsuid_americas", "nsuid_europe", "nsuid_japan", "nintendo_us_slug", "xbox_big_id", "psn_product_id")


def catalog_rules() -> dict[str, Column]:
    """Row rules of the catalog."""
    has = lambda c: F.col(c).isNotNull()
    bad = lambda c, shape: has(c) & ~X.matches(c, shape)
    holds = lambda *p: F.arrays_overlap("platforms", F.array(*[F.lit(x) for x in p]))
    nsuid = has("nsuid_americas") | has("nsuid_europe") | has("nsuid_japan")
    primary = F.col("primary_regional_channel")
    return {
        "bad_slug": ~X.matches("slug", X.SLUG_SHAPE),
        "missing_title": F.trim(F.coalesce("title", F.lit(""))) == "",
        "bad_steam_app_id": has("steam_app_id") & (F.col("steam_app_id") <= 0),
        "bad_nsuid": bad("nsuid_americas", X.NSUID_SHAPE) | bad("nsuid_europe", X.NSUID_SHAPE) | bad("nsuid_japan", X.NSUID_SHAPE),
        "bad_xbox_id": bad("xbox_big_id", X.XBOX_SHAPE),
        "xbox_needs_standard": has("xbox_big_id") & (F.coalesce("xbox_edition", F.lit("")) != "standard"),
        "bad_psn_id": bad("psn_product_id", X.PSN_PRODUCT_SHAPE),
        "psn_needs_standard": has("psn_product_id") & (F.coalesce("psn_edition", F.lit("")) != "standard"),
        "psn_needs_platform": has("psn_product_id") & ~holds("ps4", "ps5"),
        "psn_edition_alone": has("psn_edition") & ~has("psn_product_id"),
        "bad_platforms": (F.size("platforms") == 0) | F.exists("platforms", lambda p: ~p.isin(*ALLOWED_PLATFORMS)),
        "duplicate_platforms": F.size("platforms") != F.size(F.array_distinct("platforms")),
        "steam_needs_pc": has("steam_app_id") & ~holds("pc"),
        "xbox_needs_platform": has("xbox_big_id") & ~holds("xbox"),
        "nsuid_needs_switch": nsuid & ~holds("switch", "switch-2"),
        "no_store": ~has("steam_app_id") & ~nsuid,
        "console_only_needs_europe": ~has("steam_app_id") & ~has("nsuid_europe"),
        "us_slug_needs_americas": has("nintendo_us_slug") & ~has("nsuid_americas"),
        "americas_needs_us_slug": ~has("steam_app_id") & has("nsuid_americas") & ~has("nintendo_us_slug"),
        "bad_us_slug": bad("nintendo_us_slug", X.SLUG_SHAPE),
        "bad_tier": ~F.coalesce(F.col("tier").isin("core", "extended"), F.lit(False)),
        "bad_added_at": ~X.valid_day("added_at"),
        "bad_primary": has("primary_regional_channel") & ~primary.isin("steam", "eshop"),
        "primary_needs_steam": (primary == "steam") & ~has("steam_app_id"),
        "primary_needs_nsuid": (primary == "eshop") & ~nsuid,
    }


def check_catalog(catalog: DataFrame) -> DataFrame:
    dup = C.duplicate_values(catalog, "slug", CATALOG_IDS)
    slugs = catalog.groupBy("slug").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    counts = catalog.agg(
        F.count_if(F.col("tier") == "core").alias("core"), F.count("psn_product_id").alias("psn"))
    return union_all(
        row_rules(catalog, "slug", catalog_rules()),
        violation(dup, "duplicate_id", F.concat_ws(":", "id_kind", "id"), "n"),
        violation(slugs, "duplicate_slug", "slug", "n"),
        violation(counts.where(F.col("core") > CORE_LIMIT), "core_tier_limit", F.lit("core"), "core"),
        violation(counts.where(F.col("psn") > PSN_LIMIT), "psn_limit", F.lit("psn"), "psn"),
    )


def check_artifacts(catalog: DataFrame, needs: Mapping[str, tuple[Column, DataFrame]]) -> DataFrame:
    """Rows the catalog promises: name -> (which games need one, the table)."""
    parts = [violation(C.missing_artifacts(catalog, table, need), f"missing_{name}", "slug") for name, (need, table) in needs.items()]
    return union_all(*parts)


def check_offers(offers: DataFrame, catalog: DataFrame) -> DataFrame:
    """Reviewed supplemental offers: kind, base app and app set agree.

    ``offers`` holds package_id, slug, channel, name, kind, includes_base,
    base_app_id, expected_app_ids, expected_store_name, required_page_text,
    reviewed_at, note.
    """
    game = catalog.select("slug", F.col("steam_app_id").alias("c_app"), F.lit(True).alias("c_known"))
    apps = F.coalesce("expected_app_ids", F.array())
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    j = offers.join(game, "slug", "left")
    rules = {
        "offer_unknown_slug": F.col("c_known").isNull(),
        "offer_channel": F.col("channel") != "steam",
        "offer_package_id": ~F.coalesce(F.col("package_id") > 0, F.lit(False)),
        "offer_name": blank("name"),
        "offer_kind": ~F.coalesce(F.col("kind").isin("edition", "add-on"), F.lit(False)),
        "offer_kind_base": F.col("includes_base").isNull() | (F.col("includes_base") != (F.col("kind") == "edition")),
        "offer_add_on_guards": (F.col("kind") == "add-on") & (blank("expected_store_name") | blank("required_page_text")),
        "offer_base_app": ~F.coalesce(F.col("base_app_id") == F.col("c_app"), F.lit(False)),
        "offer_app_ids": F.exists(apps, lambda a: a <= 0),
        "offer_app_ids_repeat": F.size(apps) != F.size(F.array_distinct(apps)),
        "offer_base_missing": F.col("includes_base") & ~F.array_contains(apps, F.col("base_app_id")),
        "offer_base_unexpected": ~F.col("includes_base") & F.array_contains(apps, F.col("base_app_id")),
        "offer_reviewed_at": ~X.valid_day("reviewed_at"),
        "offer_note": blank("note"),
    }
    packages = offers.groupBy("package_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    owner = catalog.where(F.col("steam_app_id").isNotNull()).groupBy("steam_app_id").agg(F.min("slug").alias("other"))
    foreign = (
        offers.select("package_id", "slug", F.explode(apps).alias("steam_app_id")).join(owner, "steam_app_id")
        .where(F.col("other") != F.col("slug"))
    )
    return union_all(
        row_rules(j, "package_id", rules),
        violation(packages, "offer_package_repeat", "package_id", "n"),
        violation(foreign, "offer_other_game", "package_id", "other"),
    )


OFFER_LEAKS = ("column_label", "note", "reviewed_at", "base_app_id", "expected_app_ids", "expected_store_name", "required_page_text")


def check_offer_snapshots(stored: DataFrame, offer_catalog: DataFrame) -> DataFrame:
    """Stored offers against the reviewed set.

    ``stored`` holds slug, pos, package_id, name, kind, includes_base.
    """
    reviewed = offer_catalog.select("package_id", F.col("slug").alias("r_slug"), F.col("name").alias("r_name"),
                                    F.col("kind").alias("r_kind"), F.col("includes_base").alias("r_base"))
    j = stored.join(reviewed, "package_id", "left")
    known = F.col("r_slug") == F.col("slug")
    rules = {
        "offer_unapproved": ~F.coalesce(known, F.lit(False)),
        "offer_name_differs": known & ~F.col("name").eqNullSafe(F.col("r_name")),
        "offer_kind_differs": known & ~F.col("kind").eqNullSafe(F.col("r_kind")),
        "offer_base_differs": known & ~F.col("includes_base").eqNullSafe(F.col("r_base")),
    }
    kept = stored.select("slug").distinct()
    expected = offer_catalog.join(kept, "slug", "left_semi").select("slug", "package_id")
    absent = expected.join(stored.select("slug", "package_id"), ["slug", "package_id"], "left_anti")
    leaked = [c for c in OFFER_LEAKS if c in stored.columns]
    out = [
        row_rules(j, "package_id", rules),
        violation(absent, "offer_missing", "package_id", "slug"),
        violation(C.unsorted_rows(stored, ["slug"], "pos", ["package_id"]), "offers_unsorted", "slug"),
    ]
    out += [violation(stored.where(F.col(c).isNotNull()), "offer_field_leaked", "package_id", F.lit(c)) for c in leaked]
    return union_all(*out)


DERIVED = ("usd", "list_usd", "rank")


def check_snapshots(rows: DataFrame, catalog: DataFrame, rates: DataFrame) -> DataFrame:
    """Price rows: positive prices, sane discounts, no derived field stored,
    native dollars at home, one row per region.

    ``rows`` holds slug, channel, pos, cc, currency, amount, list_amount,
    discount_pct, sale_ends_at; ``pos`` is the stored order, a number once in a pair.
    """
    single = F.col("channel").isin("xbox", "psn")
    pct = F.col("discount_pct")
    key = F.concat_ws("/", "slug", "channel", "cc")
    rules = {
        "price_not_positive": ~F.coalesce(F.col("amount") > 0, F.lit(False)),
        "pct_out_of_range": pct.isNotNull() & ~((pct > 0) & (pct <= 100)),
        "discount_without_list": pct.isNotNull() & ~F.coalesce(F.col("list_amount") > 0, F.lit(False)),
        "single_list_not_higher": single & pct.isNotNull() & ~F.coalesce(F.col("list_amount") > F.col("amount"), F.lit(False)),
        "single_list_without_discount": single & pct.isNull() & F.col("list_amount").isNotNull(),
        "single_bad_sale_end": single & F.col("sale_ends_at").isNotNull() & F.try_to_timestamp(F.col("sale_ends_at")).isNull(),
        "us_not_native": (F.col("cc") == "US") & (F.col("currency") != "USD"),
        **{f"derived_{c}_stored": F.col(c).isNotNull() for c in DERIVED if c in rows.columns},
    }
    return union_all(row_rules(rows, key, rules), _snapshot_counts(rows, catalog, rates))


#: Stored rows of a pair that are looked at together.
CHUNK = 1024


def _unsorted(rows: DataFrame) -> DataFrame:
    """Rows (slug, channel, cc, pos) that stand behind a row of a greater region.

    A list is cut into chunks, so that a long one lies in many groups; the first
    row of a chunk is also the last one of the chunk before.
    """
    chunk = F.floor(F.col("pos") / CHUNK).cast("long")
    chunks = F.when(F.pmod(F.col("pos"), F.lit(CHUNK)) == 0, F.array(chunk - 1, chunk)).otherwise(F.array(chunk))
    # a missing region sorts first
    by = Window.partitionBy("slug", "channel", "chunk").orderBy("pos")
    seen = rows.select("slug", "channel", "pos", F.struct("cc").alias("here"), F.explode(chunks).alias("chunk"))
    seen = seen.withColumns({"before": F.lag("here").over(by), "at": F.lag("pos").over(by)})
    return seen.where((F.col("at") == F.col("pos") - 1) & (F.col("before") > F.col("here")))


def _snapshot_counts(rows: DataFrame, catalog: DataFrame, rates: DataFrame) -> DataFrame:
    """The rules of ``check_snapshots`` that need more than one row.

    A row is a fact of its pair (game, store), of its region there and of its
    currency.  Facts are counted by grain in one pass; every rule is a condition
    on the counts of its grain.  Only the stored order needs rows side by side.
    """
    none = F.lit(None).cast("string")

    def fact(grain: str, item: Column = none, slug: Column | str = "slug", channel: Column | str = "channel") -> Column:
        return F.struct(F.lit(grain).alias("grain"), X.col(slug).alias("slug"), X.col(channel).alias("channel"), item.cast("string").alias("item"))

    facts = F.explode(F.array(fact("pair"), fact("region", F.col("cc")), fact("currency", F.col("currency"), slug=none, channel=none)))
    us = F.col("cc") == "US"
    # counts only, which Spark adds up in hash tables
    per = rows.select("cc", "currency", facts.alias("f")).groupBy("f.grain", "f.slug", "f.channel", "f.item").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(us & (F.col("currency") == "USD")).alias("us"), F.count_if(us).alias("us_any"))
    known = catalog.select("slug").distinct().withColumn("known", F.lit(True))
    priced = rates.where(F.col("rate") > 0).select(F.col("currency").alias("item")).distinct().withColumn("priced", F.lit(True))
    single, pair = F.col("channel").isin("xbox", "psn"), F.concat_ws("/", "slug", "channel")
    grain = lambda name: F.col("grain") == name
    n = F.col("n").cast("string")
    # most regions are single and break no rule: they go before the joins
    per = per.where(~grain("region") | (F.col("n") > 1)).join(known, "slug", "left").join(priced, "item", "left")
    rules = (
        ("steam_needs_us", grain("pair") & (F.col("channel") == "steam") & (F.col("us") == 0), pair, none),
        ("single_needs_one_us", grain("pair") & single & ((F.col("n") != 1) | (F.col("us_any") != 1)), pair, n),
        ("slug_not_in_catalog", grain("pair") & F.col("known").isNull(), pair, none),
        ("duplicate_region", grain("region") & (F.col("n") > 1), F.concat_ws("/", "slug", "channel", "item"), n),
        ("no_rate", grain("currency") & (F.col("item") != "USD") & F.col("priced").isNull(), F.col("item"), n),
    )
    hits = F.array_compact(F.array(*[
        F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(name).alias("rule"), F.lit(ERROR).alias("severity"), told.alias("key"), more.alias("detail")))
        for name, bad, told, more in rules]))
    return per.select(F.explode(hits).alias("hit")).select("hit.*").unionByName(violation(_unsorted(rows), "regions_unsorted", pair))


def check_coverage(previous: DataFrame, current: DataFrame, catalog: DataFrame) -> DataFrame:
    pair = F.concat_ws("/", "slug", "channel")
    lost = C.coverage_drop(previous, current).where(F.col("keep_previous") & (F.col("n_current") > 0))
    return union_all(
        violation(lost, "coverage_dropped", pair, "n_current"),
        violation(C.first_coverage(current, previous, catalog), "first_coverage_low", pair, "n_regions"),
    )


def check_channel_ratio(rows: DataFrame, limit: float = 3.0) -> DataFrame:
    """Warn when the regular home prices of a game differ widely by store."""
    regular = F.when(F.col("list_amount") > F.col("amount"), F.col("list_amount")).otherwise(F.col("amount"))
    us = rows.where((F.col("cc") == "US") & (F.col("currency") == "USD")).withColumn("regular", regular).where(F.col("regular") > 0)
    per = us.groupBy("slug").agg(F.min("regular").alias("lo"), F.max("regular").alias("hi"), F.count_distinct("channel").alias("n"))
    bad = per.where((F.col("n") >= 2) & (F.col("hi") / F.col("lo") > limit))
    return violation(bad, "channel_price_ratio", "slug", "n", WARNING)


def check_history(events: DataFrame, atl: DataFrame, catalog: DataFrame) -> DataFrame:
    """Lows are positive and of known origin; no event lies under its low."""
    rules = {"atl_not_positive": ~F.coalesce(F.col("usd") > 0, F.lit(False)), "atl_unknown_seed": ~F.coalesce(F.col("seed").isin(*SEEDS), F.lit(False))}
    low = atl.select("slug", "atl_key", F.col("usd").alias("low"))
    keyed = events.withColumn("atl_key", X.relabel("channel", X.ATL_KEY_OF_CHANNEL)).join(low, ["slug", "atl_key"], "left")
    key = F.concat_ws("/", "slug", "channel", F.col("d").cast("string"))
    faults = {"event_not_positive": ~F.coalesce(F.col("usd") > 0, F.lit(False)), "event_below_atl": F.col("usd") < F.col("low") - 0.005}
    return union_all(
        row_rules(atl, F.concat_ws("/", "slug", "atl_key"), rules),
        row_rules(keyed, key, faults),
        violation(C.orphans(events.select("slug").distinct(), catalog), "history_not_in_catalog", "slug"),
    )


def check_single_market_history(catalog: DataFrame, events: DataFrame, atl: DataFrame) -> DataFrame:
    """A mapped single-market game has an event and a low of its own."""
    out = []
    for channel, column in (("xbox", "xbox_big_id"), ("psn", "psn_product_id")):
        mapped = F.col(column).isNotNull()
        mine = events.where((F.col("channel") == channel) & (F.col("usd") > 0))
        low = atl.where((F.col("atl_key") == X.ATL_KEY_OF_CHANNEL[channel]) & (F.col("usd") > 0))
        out.append(violation(C.missing_artifacts(catalog, mine, mapped), f"{channel}_needs_event", "slug"))
        out.append(violation(C.missing_artifacts(catalog, low, mapped), f"{channel}_needs_atl", "slug"))
    return union_all(*out)


def check_feed(items: DataFrame) -> DataFrame:
    """Deal feeds: prices, discount range, secure links, not empty."""
    https = F.coalesce(F.col("url").rlike("^https://"), F.lit(False))
    rules = {
        "feed_price": ~F.coalesce((F.col("price") > 0) & (F.col("list") > 0), F.lit(False)),
        "feed_pct": ~F.coalesce((F.col("pct") > 0) & (F.col("pct") <= 100), F.lit(False)),
        "feed_url": ~https,
    }
    empty = items.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == 0)
    return union_all(row_rules(items, "item_id", rules), violation(empty, "feed_empty", F.lit("feed")))


def check_free_feed(items: DataFrame) -> DataFrame:
    rules = {
        "free_status": ~F.coalesce(F.col("status").isin("free-now", "upcoming"), F.lit(False)),
        "free_price": ~F.coalesce(F.col("price") == 0, F.lit(False)),
    }
    return row_rules(items, "item_id", rules)


def check_calendar(calendar: DataFrame, minimum: float = 0.8) -> DataFrame:
    """Merged calendar: month keys, dates inside the month, one secure url per
    platform, enough artwork.  Needs an ``entry_id``."""
    from .calendar import calendar_artwork

    links = F.coalesce(F.map_keys("urls"), F.array())
    rules = {
        "calendar_month": ~F.coalesce(F.col("month").rlike(r"^\d{4}-\d{2}$"), F.lit(False)),
        "calendar_date": F.col("date").isNotNull() & ~F.coalesce(F.col("date").startswith(F.col("month")), F.lit(False)),
        "calendar_platforms": (F.size("platforms") == 0) | (F.size("platforms") != F.size(F.array_distinct("platforms"))),
        "calendar_url_missing": F.size(F.array_except("platforms", links)) > 0,
        "calendar_url": F.exists(F.map_values("urls"), lambda u: ~u.rlike("^https://")),
    }
    art = calendar_artwork(calendar, minimum).where(~F.col("ok"))
    return union_all(row_rules(calendar, "entry_id", rules), violation(art, "calendar_artwork", F.lit("calendar"), "images"))


# Field names of one sealed release item, fixed values.
RELEASE_FIELDS = ("title", "date", "month", "platform", "url", "image", "slug_if_tracked")


def check_release_cache(cache: DataFrame, catalog: DataFrame, platform: str, url_shape: str, id_column: str, updated_on) -> DataFrame:
    """A store's release cache: exact fields, 180-day window, unique product
    urls in date, title, url order, and mappings that agree with the catalog.

    ``cache`` holds pos and the item fields; the product id is the last path
    part of the url.
    """
    product = F.upper(F.regexp_extract("url", url_shape, 1))
    owner = catalog.select(F.col("slug").alias("slug_if_tracked"), F.upper(id_column).alias("c_id"), F.lit(True).alias("c_known"))
    j = cache.withColumn("product", product).join(owner, "slug_if_tracked", "left")
    title = F.coalesce("title", F.lit(""))
    rules = {
        "release_title": (title == "") | (title != F.trim(title)) | (F.length(title) > 300),
        "release_date": ~X.valid_day("date") | ~F.coalesce(F.col("month") == F.substring("date", 1, 7), F.lit(False)),
        "release_window": X.valid_day("date") & ~F.coalesce(X.within_horizon(F.col("date").try_cast("date"), updated_on), F.lit(False)),
        "release_platform": ~F.coalesce(F.col("platform") == platform, F.lit(False)),
        "release_url": F.coalesce(F.col("product"), F.lit("")) == "",
        "release_image": ~F.coalesce(F.col("image").rlike("^https://"), F.lit(False)),
        "release_unknown_slug": F.col("slug_if_tracked").isNotNull() & F.col("c_known").isNull(),
        "release_mapping": F.col("c_known").isNotNull() & ~F.coalesce(F.col("c_id") == F.col("product"), F.lit(False)),
    }
    extra = sorted(set(cache.columns) - set(RELEASE_FIELDS) - {"pos"})
    out = [
        row_rules(j, "pos", rules),
        violation(C.duplicates(cache.select("pos", "url"), ["url"]), "release_url_repeat", "pos", "url"),
        violation(C.unsorted_rows(cache.withColumn("doc", F.lit(1)), ["doc"], "pos", ["date", "title", "url"]), "release_unsorted", "pos"),
    ]
    if extra:
        head = cache.limit(1)
        out.append(violation(head, "release_fields", F.lit(",".join(extra))))
    return union_all(*out)


def check_meta(meta: DataFrame, catalog: DataFrame) -> DataFrame:
    """Meta rows: review range, absolute artwork, source of console-only games."""
    game = catalog.select("slug", "steam_app_id", "nsuid_europe", "nintendo_us_slug", F.lit(True).alias("c_known"))
    j = meta.join(game, "slug", "left")
    console = F.col("c_known") & F.col("steam_app_id").isNull()
    us_url = F.concat(F.lit("https://www.nintendo.com/us/store/products/"), F.col("nintendo_us_slug"), F.lit("/"))
    us, eu = F.col("meta_source") == "nintendo-us", F.col("meta_source") == "nintendo-eu-solr"
    rules = {
        "meta_not_in_catalog": F.col("c_known").isNull(),
        "meta_review_range": F.col("review_percent").isNotNull() & ~F.col("review_percent").between(0, 100),
        "meta_image": ~F.coalesce(F.col("header_image").rlike("^https://"), F.lit(False)),
        "meta_source": console & ~F.coalesce(us | eu, F.lit(False)),
        "meta_us_url": console & us & ~F.coalesce(F.col("store_url") == us_url, F.lit(False)),
        "meta_eu_nsuid": console & eu & F.col("nsuid_europe").isNull(),
        "meta_eu_url": console & eu & F.col("store_url").isNotNull() & ~F.col("store_url").rlike(r"^https://www\.nintendo\.com/"),
    }
    return row_rules(j, "slug", rules)


def looks_degraded(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Meta rows that lost their artwork, genres or reviews in a refresh."""
    prev = previous.select("slug", F.col("header_image").alias("p_image"), F.col("genres").alias("p_genres"), F.col("review_count").alias("p_reviews"))
    n = lambda c: F.coalesce(F.size(c), F.lit(0))
    some = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    bad = (
        (some("p_image") & ~some("header_image")) | ((n("p_genres") > 0) & (n("genres") <= 0))
        | ((F.coalesce("p_reviews", F.lit(0)) > 50) & (F.coalesce("review_count", F.lit(0)) == 0))
    )
    return current.join(prev, "slug").select("slug", bad.alias("degraded"))


def meta_changed(previous: DataFrame, current: DataFrame, stamp: str = "updated_at") -> DataFrame:
    """Rows whose content differs, the check stamp aside."""
    cols = [c for c in current.columns if c != stamp]
    p = previous.select("slug", X.fingerprint(*cols).alias("p_digest"))
    c = current.select("slug", X.fingerprint(*cols).alias("c_digest"))
    return c.join(p, "slug", "left").select("slug", (~F.col("c_digest").eqNullSafe(F.col("p_digest"))).alias("changed"))


SHARD_KEY = r"^(steam-regional|eshop-regional):extended-[0-6]$|^meta:shard-(\d|1[0-3])$"


def check_ledger(ledger: DataFrame, required: DataFrame) -> DataFrame:
    """Freshness ledger: readable stamps, success not after attempt, streaks,
    key shapes, required sources.  Stamps are text."""
    attempt, success = F.try_to_timestamp(F.col("last_attempt")), F.try_to_timestamp(F.col("last_success"))
    rules = {
        "ledger_attempt": attempt.isNull(),
        "ledger_success": F.col("last_success").isNotNull() & success.isNull(),
        "ledger_order": success > attempt,
        "ledger_streak": ~F.coalesce(F.col("streak") >= 0, F.lit(False)),
        "ledger_key": F.col("source").contains(":") & ~F.col("source").rlike(SHARD_KEY),
    }
    return union_all(
        row_rules(ledger, "source", rules),
        violation(required.select("source").distinct().join(ledger.select("source"), "source", "left_anti"), "ledger_missing", "source"),
    )


def replacement_guard(previous: DataFrame, current: DataFrame, as_of, keep: float = 0.5) -> DataFrame:
    """A new release list must not lose a published id, nor half its future."""
    today = X.day(as_of)
    ahead = lambda df: df.where(F.col("date").cast("date") >= today)
    gone = ahead(previous).join(current.select("product_id"), "product_id", "left_anti")
    counts = ahead(previous).agg(F.count(F.lit(1)).alias("before")).withColumn("k", F.lit(1)).join(
        ahead(current).agg(F.count(F.lit(1)).alias("after")).withColumn("k", F.lit(1)), "k")
    shrunk = counts.where(F.col("after") < F.col("before") * F.lit(keep))
    return union_all(violation(gone, "published_id_missing", "product_id"), violation(shrunk, "future_entries_halved", F.lit("list"), "after"))


def category_completeness(pages: DataFrame, candidates: DataFrame) -> DataFrame:
    """Paged listing: rows add up to the stated total, ids are unique and every
    candidate is listed.  ``pages`` holds (category, product_id, total)."""
    rows = pages.groupBy("category", "product_id").agg(F.count(F.lit(1)).alias("c"), F.max("total").alias("total"))
    per = rows.groupBy("category").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("n_ids"), F.max("total").alias("total"))
    lost = candidates.join(pages.select("category", "product_id"), ["category", "product_id"], "left_anti")
    return union_all(
        violation(per.where(F.col("n") != F.col("total")), "category_total", "category", "n"),
        violation(per.where(F.col("n") != F.col("n_ids")), "category_repeat", "category", "n_ids"),
        violation(lost, "candidate_not_listed", "product_id", "category"),
    )


def one_product_per_release(entries: DataFrame, title_key: Column) -> DataFrame:
    """Releases with more than one product under one title and day."""
    per = entries.withColumn("title_key", title_key).groupBy("title_key", "date").agg(
        F.min("product_id").alias("lo"), F.max("product_id").alias("hi"))
    return violation(per.where(F.col("lo") != F.col("hi")), "release_has_two_products", F.concat_ws("/", "title_key", F.col("date").cast("string")))


def import_artifacts(items: DataFrame, rows: DataFrame, events: DataFrame, catalog: DataFrame) -> DataFrame:
    """Every item of a batch arrived: its ids are in the catalog, its stores
    have prices with enough regions and a first event."""
    ids = ("steam_app_id", "xbox_big_id", "psn_product_id")
    have = catalog.select("slug", F.lit(True).alias("c_known"), *[F.col(c).alias(f"c_{c}") for c in ids])
    j = items.join(have, "slug", "left")
    wants = {"steam": F.col("steam_app_id").isNotNull(), "xbox": F.col("xbox_big_id").isNotNull(), "psn": F.col("psn_product_id").isNotNull()}
    rules = {"import_not_in_catalog": F.col("c_known").isNull()}
    rules |= {f"import_{c}_differs": F.col("c_known") & F.col(c).isNotNull() & ~F.col(c).eqNullSafe(F.col(f"c_{c}")) for c in ids}
    out = [row_rules(j, "slug", rules)]
    per = rows.groupBy("slug", "channel").agg(F.count(F.lit(1)).alias("n"))
    for channel, need in wants.items():
        out.append(violation(C.missing_artifacts(items, per.where(F.col("channel") == channel), need), f"import_{channel}_prices_missing", "slug"))
        first = events.where(F.col("channel") == channel)
        out.append(violation(C.missing_artifacts(items, first, need), f"import_{channel}_event_missing", "slug"))
    thin = per.where((F.col("channel") == "steam") & (F.col("n") < C.STEAM_MINIMUM)).join(items.where(wants["steam"]), "slug", "left_semi")
    return union_all(*out, violation(thin, "import_coverage_low", "slug", "n"))


def check_core_documents(rows: DataFrame) -> DataFrame:
    """Price documents: a name, plans, regions and a cheapest price."""
    per = rows.groupBy("slug").agg(
        F.max(F.length(F.trim(F.coalesce("name", F.lit(""))))).alias("name_len"), F.count("plan").alias("plans"),
        F.count("cc").alias("regions"), F.min("usd").alias("cheapest"))
    rules = {"core_name": F.col("name_len") == 0, "core_plans": F.col("plans") == 0, "core_regions": F.col("regions") == 0,
             "core_cheapest": ~F.coalesce(F.col("cheapest") > 0, F.lit(False))}
    return row_rules(per, "slug", rules)


def check_candidate_document(candidates: DataFrame, days: DataFrame, *digest_columns: str) -> DataFrame:
    """Candidate list: distinct sample days, contiguous ranks, right digests."""
    repeat = days.groupBy("day").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    gaps = C.contiguous(candidates.withColumn("doc", F.lit("list")).withColumn("pos", F.col("source_rank") - 1), ["doc"], "pos")
    forged = candidates.where(~F.coalesce(X.fingerprint(*digest_columns) == F.col("evidence_digest"), F.lit(False)))
    bad_id = candidates.where(F.col("candidate_id") != F.concat(F.lit("steam:"), F.col("app_id").cast("string")))
    return union_all(
        violation(repeat, "sample_day_repeat", "day", "n"), violation(gaps, "rank_not_contiguous", "doc", "n"),
        violation(forged, "digest_mismatch", "candidate_id"), violation(bad_id, "candidate_id_mismatch", "candidate_id"))


def verify_fingerprint(df: DataFrame, key: str, stored: str, *cols: str) -> DataFrame:
    """Whether the stored digest of a row equals the recomputed one."""
    same = F.coalesce(X.fingerprint(*cols) == F.col(stored), F.lit(False))
    return df.select(key, (X.matches(stored, X.DIGEST_SHAPE) & same).alias("ok"))


def page_links(pages: DataFrame) -> DataFrame:
    """Links, canonical links and distinct link targets of every page."""
    hrefs = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))
    canon = F.regexp_extract_all("html", F.lit('<link rel="canonical" href="([^"]*)"'), F.lit(1))
    return pages.select("page_id", F.size(hrefs).alias("n_links"), F.size(F.array_distinct(hrefs)).alias("n_targets"), F.size(canon).alias("n_canonical"))


def check_pages(pages: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """One canonical link per page and unique urls; alias pages are left out."""
    own = pages if aliases is None else pages.join(aliases.select("url"), "url", "left_anti")
    links = page_links(own)
    repeated = own.groupBy("url").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return union_all(
        violation(links.where(F.col("n_canonical") != 1), "page_canonical", "page_id", "n_canonical"),
        violation(repeated, "page_url_repeat", "url", "n"))

