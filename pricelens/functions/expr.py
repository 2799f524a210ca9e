"""Scalar column expressions shared by the jobs.

All of them are built-in Spark functions, so they stay inside generated code.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def moment(as_of: Column | str | datetime) -> Column:
    """The reference instant of a job as a timestamp column."""
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def day(as_of: Column | str | date) -> Column:
    if isinstance(as_of, Column):
        return as_of.cast("date")
    return F.lit(str(as_of)[:10]).cast("date")


def round_half_up(value: ColumnLike, digits: int = 0) -> Column:
    """Round half towards plus infinity on the binary value.

    ``F.round`` works on the decimal text and rounds halves away from zero,
    which moves prices such as 1.005 and negative deltas such as -2.5.
    """
    scale = F.lit(float(10**digits))
    return F.floor(col(value) * scale + F.lit(0.5)) / scale


def round_int(value: ColumnLike) -> Column:
    return F.floor(col(value) + F.lit(0.5)).cast("int")


def round2(value: ColumnLike) -> Column:
    return round_half_up(value, 2)


def discount_pct(amount: ColumnLike, list_amount: ColumnLike) -> Column:
    return round_int((F.lit(1.0) - F.try_divide(col(amount), col(list_amount))) * F.lit(100.0))


def pct_change(value: ColumnLike, base: ColumnLike) -> Column:
    return round_int((F.try_divide(col(value), col(base)) - F.lit(1.0)) * F.lit(100.0))


def is_live(end_text: ColumnLike, as_of: Column | str) -> Column:
    """An end that is missing or cannot be read counts as still running."""
    return F.coalesce(F.try_to_timestamp(col(end_text)) > moment(as_of), F.lit(True))


def valid_day(text: ColumnLike) -> Column:
    """True for a ``YYYY-MM-DD`` text naming a real calendar day."""
    shaped = F.when(col(text).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(col(text), "yyyy-MM-dd"))
    return F.coalesce(F.date_format(shaped, "yyyy-MM-dd") == col(text), F.lit(False))


def day_add(value: ColumnLike, days: int) -> Column:
    return F.date_add(col(value).cast("date"), days)


def within_horizon(release: ColumnLike, as_of: Column | str, days: int = 180) -> Column:
    start = day(as_of)
    return col(release).cast("date").between(start, F.date_add(start, days))


def honest_sale_end(ts: ColumnLike) -> Column:
    """Stores mark an open-ended price with a far future date; that is no end."""
    return F.when(F.year(col(ts)) < 2100, col(ts))


def parse_usd_text(text: ColumnLike) -> Column:
    digits = F.regexp_replace(col(text), r"[^0-9.]", "")
    return F.coalesce(digits.try_cast("double"), F.lit(float("inf")))


def verdict(best: ColumnLike, atl: ColumnLike) -> Column:
    ratio = F.try_divide(col(best), col(atl))
    return (
        F.when(ratio <= 1.001, "BUY")
        .when(ratio <= 1.15, "FAIR")
        .when(ratio.isNotNull(), "WAIT")
    )


def below_today_pct(best: ColumnLike, atl: ColumnLike) -> Column:
    return round_int((F.lit(1.0) - F.try_divide(col(atl), col(best))) * F.lit(100.0))


# Freshness budgets in hours, fixed values.
DAILY_BUDGET = 26
WEEKLY_BUDGET = 192
META_BUDGET = 360
WEEKLY_SOURCES = (
    "steam-offers",
    "xbox-us",
    "psn-us",
    "calendar",
    "calendar-xbox-us",
    "calendar-psn-us",
)


def budget_hours(source: ColumnLike) -> Column:
    key = col(source)
    return (
        F.when(key.rlike(r"^[a-z-]+:extended-\d+$"), WEEKLY_BUDGET)
        .when(key.rlike(r"^meta:shard-\d+$"), META_BUDGET)
        .when(key == "meta", META_BUDGET)
        .when(key.isin(*WEEKLY_SOURCES), WEEKLY_BUDGET)
        .otherwise(DAILY_BUDGET)
    )


def freshness(stamp: ColumnLike, budget: ColumnLike, failures: ColumnLike, as_of: Column | str) -> Column:
    """fresh / stale / down by age against the budget; failures never stay fresh."""
    seconds = F.greatest(
        F.lit(0.0), moment(as_of).cast("double") - col(stamp).cast("timestamp").cast("double")
    )
    age = seconds / F.lit(3600.0)
    limit = col(budget).cast("double")
    usable = col(stamp).isNotNull() & (limit > 0)
    failing = F.coalesce(col(failures) > 0, F.lit(False))
    return (
        F.when(~F.coalesce(usable, F.lit(False)), "down")
        .when((age <= limit) & ~failing, "fresh")
        .when(age <= limit * 2, "stale")
        .otherwise("down")
    )


# Identifier shapes, fixed values.
SLUG_SHAPE = r"^[a-z0-9]+(?:-[a-z0-9]+)*$"
NSUID_SHAPE = r"^7001\d{10}$"
XBOX_SHAPE = r"^[A-Z0-9]{12}$"
PSN_PRODUCT_SHAPE = r"^[A-Z]{2}\d{4}-[A-Z0-9_]{12}-[A-Z0-9_]{16}$"
PSN_CONCEPT_SHAPE = r"^\d{8}$"
DIGEST_SHAPE = r"^sha256:[0-9a-f]{64}$"


def matches(value: ColumnLike, shape: str) -> Column:
    return F.coalesce(col(value).cast("string").rlike(shape), F.lit(False))


FNV_OFFSET = 2166136261
FNV_PRIME = 16777619


def fnv_shard(slug: ColumnLike, count: int) -> Column:
    """32-bit FNV-1a of the text, modulo ``count``.

    Only needed where the shard number is itself data; to spread work use
    ``repartition``.  Slugs are ASCII, so code points equal bytes.
    """
    codes = F.transform(
        F.filter(F.split(col(slug), ""), lambda c: c != ""), lambda c: F.ascii(c).cast("bigint")
    )
    mask = F.lit(0xFFFFFFFF).cast("bigint")
    step = lambda acc, code: acc.bitwiseXOR(code) * F.lit(FNV_PRIME).cast("bigint")
    hashed = F.aggregate(
        codes, F.lit(FNV_OFFSET).cast("bigint"), lambda acc, code: step(acc, code).bitwiseAND(mask)
    )
    return (hashed % F.lit(count)).cast("int")


def fingerprint(*cols: str) -> Column:
    """Digest of named columns, independent of the order they are given in."""
    body = F.to_json(F.struct(*[F.col(c) for c in sorted(cols)]), {"ignoreNullFields": "false"})
    return F.concat(F.lit("sha256:"), F.sha2(body, 256))


# Price summary channels and low keys, fixed values.
CHANNELS = ("steam", "eshop", "xbox", "psn")
ATL_KEYS = ("pc", "eshop-us", "eshop-eu", "xbox-us", "psn-us")
ATL_KEY_OF_CHANNEL = {"steam": "pc", "eshop": "eshop-us", "xbox": "xbox-us", "psn": "psn-us"}
PLATFORM_ORDER = ("pc", "switch", "xbox", "psn")


def ordinal(value: ColumnLike, ordered: tuple[str, ...], missing: int = 99) -> Column:
    """Position of a value in a short fixed list."""
    out = None
    for i, item in enumerate(ordered):
        out = F.when(col(value) == item, i) if out is None else out.when(col(value) == item, i)
    return out.otherwise(missing)


def relabel(value: ColumnLike, mapping: dict[str, str]) -> Column:
    out = None
    for key, new in mapping.items():
        out = F.when(col(value) == key, new) if out is None else out.when(col(value) == key, new)
    return out


def sort_platforms(platforms: ColumnLike) -> Column:
    """Distinct platforms in display order, unknown ones last by name."""
    keyed = F.transform(
        F.array_distinct(col(platforms)),
        lambda p: F.struct(ordinal(p, PLATFORM_ORDER).alias("o"), p.alias("p")),
    )
    return F.transform(F.array_sort(keyed), lambda s: s["p"])
