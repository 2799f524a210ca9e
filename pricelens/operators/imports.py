"""Reconciling an import: what a batch declared against what arrived.

The plan is a table, one row per item and store, that names the regions wanted,
how many must be there and whether a native US price and a first US event are
required.  Prices arrive as one array of regions per item and store; both sides
are compared by set containment.  All rules of one grain are flags of one join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .catalog import NSUIDS
from .quality import row_rules, union_all, violation

# Regions of a price sweep, fixed values.
STEAM_REGIONS = (
    "UA", "KZ", "PK", "IN", "TR", "GE", "AR", "BR", "CN",
    "KR", "JP", "CA", "US", "AU", "GB", "DE", "MX", "CH",
)
ESHOP_REGIONS = {
    "americas": ("US", "CA", "MX", "BR", "AR", "CO"),
    "europe": ("GB", "DE", "PL", "NO", "DK", "CH", "ZA", "AU", "NZ"),
    "japan": ("JP",),
}
SWITCHES = ("switch", "switch-2")
STEAM_MINIMUM = 10
ESHOP_RATIO = 0.8
ITEM = ["key", "slug", "title", "catalog_action", "steam_app_id", *NSUIDS, "nintendo_us_slug",
        "psn_product_id", "psn_concept_id", "psn_edition", "xbox_big_id", "xbox_edition", "platforms"]


def _array(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def declared(items: DataFrame, steam: Sequence[str] = STEAM_REGIONS, eshop: Mapping[str, Sequence[str]] = ESHOP_REGIONS,
             steam_minimum: int = STEAM_MINIMUM, eshop_ratio: float = ESHOP_RATIO) -> DataFrame:
    """What a batch must bring: (key, slug, channel, expected, minimum, us_price, us_event).

    An item is expected in every store it has an id of.  The eShop is asked for
    the regions of the groups that have an NSUID, and for US prices only with an
    American one.
    """
    groups = {g: F.col(f"nsuid_{g}").isNotNull() for g in ("americas", "europe", "japan")}
    sold = F.flatten(F.array(*[F.when(have, _array(eshop[g])).otherwise(_array(())) for g, have in groups.items()]))

    def wanted(channel: str, need: Column, expected: Column, minimum: Column, us: Column) -> Column:
        return F.when(need, F.struct(F.lit(channel).alias("channel"), expected.alias("expected"), minimum.cast("int").alias("minimum"), us.alias("us")))

    only_us, yes = _array(("US",)), F.lit(True)
    stores = F.array_compact(F.array(
        wanted("steam", F.col("steam_app_id").isNotNull(), _array(steam), F.lit(min(len(steam), steam_minimum)), yes),
        wanted("eshop", F.coalesce(*[F.col(c) for c in NSUIDS]).isNotNull(), sold, F.ceil(F.size(sold) * F.lit(eshop_ratio)), groups["americas"]),
        wanted("psn", F.col("psn_product_id").isNotNull(), only_us, F.lit(1), yes),
        wanted("xbox", F.col("xbox_big_id").isNotNull(), only_us, F.lit(1), yes)))
    per = items.select("key", "slug", F.explode(stores).alias("s"))
    return per.select("key", "slug", "s.channel", "s.expected", "s.minimum", F.col("s.us").alias("us_price"), F.col("s.us").alias("us_event"))


def arrived(rows: DataFrame) -> DataFrame:
    """Per item and store: the array of its regions, how many rows, and whether one is a paid native US price.

    ``rows`` holds (slug, channel, cc, currency, amount).  The set is gathered
    on the map side first, so it is bounded by the region list, not by rows.
    """
    cc = F.upper("cc")
    native = (cc == "US") & (F.col("currency") == "USD") & (F.col("amount") > 0)
    return rows.groupBy("slug", "channel").agg(
        F.array_sort(F.collect_set(cc)).alias("regions"), F.count(cc).alias("n_rows"), F.coalesce(F.max(native), F.lit(False)).alias("native_us"))


def region_overlap(plan: DataFrame, rows: DataFrame) -> DataFrame:
    """Each expectation with what of it arrived (``covered``), what did not (``missing``) and what nobody asked for (``extra``)."""
    have = F.coalesce("regions", _array(()))
    return plan.join(arrived(rows), ["slug", "channel"], "left").withColumns({
        "covered": F.array_intersect("expected", have), "missing": F.array_except("expected", have), "extra": F.array_except(have, "expected")})


def _generation(platforms: Column) -> Column:
    """The one console generation a platform list names, else null."""
    mine = F.filter(F.coalesce(platforms, _array(())), lambda p: p.isin(*SWITCHES))
    return F.when(F.size(mine) == 1, F.try_element_at(mine, F.lit(1)))


def identity_faults(items: DataFrame, catalog: DataFrame, title_key=T.norm_title) -> DataFrame:
    """Staged catalog rows that are missing or differ from the item that staged them."""
    mine = ("title", "steam_app_id", *NSUIDS, "nintendo_us_slug", "psn_product_id", "psn_concept_id", "psn_edition", "xbox_big_id", "xbox_edition", "platforms")
    staged = catalog.select("slug", F.lit(True).alias("known"), *[F.col(c).alias(f"c_{c}") for c in mine])
    j = items.join(staged, "slug", "left")
    there = F.coalesce("known", F.lit(False))
    # ids are compared as text: stores give them as numbers or digits
    same = lambda c: F.col(c).cast("string").eqNullSafe(F.col(f"c_{c}").cast("string"))
    asked = lambda c: there & F.col(c).isNotNull()
    game_title, item_title = title_key("c_title"), title_key("title")
    nintendo = F.coalesce(*[F.col(c) for c in NSUIDS]).isNotNull()
    rules = {
        "import_not_in_catalog": ~there,
        "import_title_drift": there & ((game_title == "") | (game_title != item_title)),
        "import_steam_drift": asked("steam_app_id") & ~same("steam_app_id"),
        **{f"import_{c}_drift": asked(c) & ~same(c) for c in NSUIDS},
        "import_us_slug_drift": asked("nintendo_us_slug") & ~same("nintendo_us_slug"),
        "import_psn_drift": asked("psn_product_id") & ~(same("psn_product_id") & same("psn_concept_id") & same("psn_edition")),
        "import_xbox_drift": asked("xbox_big_id") & ~(same("xbox_big_id") & same("xbox_edition")),
        "import_generation_drift": there & nintendo & ~F.coalesce(_generation(F.col("platforms")) == _generation(F.col("c_platforms")), F.lit(False)),
    }
    return row_rules(j, "key", rules)


def coverage_faults(plan: DataFrame, rows: DataFrame, events: DataFrame) -> DataFrame:
    """Stores of an item without prices, with a region twice, too few of the wanted regions, no native US price or no first US event.

    ``events`` holds (slug, channel, cc, usd).
    """
    first = events.where((F.col("cc") == "US") & (F.col("usd") > 0)).select("slug", "channel").distinct().withColumn("seen", F.lit(True))
    j = region_overlap(plan, rows).join(first, ["slug", "channel"], "left")
    there = F.coalesce(F.size("regions") > 0, F.lit(False))
    rules = {
        "import_prices_missing": ~there,
        "import_region_repeat": there & (F.col("n_rows") != F.size("regions")),
        "import_coverage_low": there & (F.size("covered") < F.col("minimum")),
        "import_us_price_missing": there & F.col("us_price") & ~F.coalesce("native_us", F.lit(False)),
        "import_us_event_missing": F.col("us_event") & F.col("seen").isNull(),
    }
    return row_rules(j, F.concat_ws("/", "key", "channel"), rules)


def metadata_faults(items: DataFrame, meta: DataFrame, title_key=T.norm_title) -> DataFrame:
    """Items without metadata, or whose metadata lack a name, a fitting title or a secure image.

    ``meta`` holds (slug, name, header_image).  A platform added to a known game
    needs a name only; a new game's must match its title or extend it by a known
    edition suffix.
    """
    j = items.join(meta.select("slug", F.lit(True).alias("has"), "name", "header_image"), "slug", "left")
    has, name = F.coalesce("has", F.lit(False)), title_key("name")
    fits = F.array_contains(T.edition_keys(name), title_key("title"))
    new = ~F.coalesce(F.col("catalog_action") == "add_platform_mapping", F.lit(False))
    rules = {
        "import_meta_missing": ~has,
        "import_meta_name": has & (name == ""),
        "import_meta_title": has & new & (name != "") & ~F.coalesce(fits, F.lit(False)),
        "import_meta_image": has & ~F.coalesce(F.col("header_image").startswith("https://"), F.lit(False)),
    }
    return row_rules(j, "key", rules)


def reconcile_import(items: DataFrame, catalog: DataFrame, rows: DataFrame, events: DataFrame, meta: DataFrame, title_key=T.norm_title, **sweep) -> DataFrame:
    """Every way in which a batch did not arrive as declared, one row per rule and item or item/store.

    ``sweep`` are the options of ``declared``.  Items and catalog have one row
    per slug; an item that is declared twice is a fault of its own.
    """
    twice = items.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return union_all(
        identity_faults(items, catalog, title_key), coverage_faults(declared(items, **sweep), rows, events),
        metadata_faults(items, meta, title_key), violation(twice, "import_declared_twice", "key", "n"))
