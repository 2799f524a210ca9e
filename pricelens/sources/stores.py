"""Store price responses to typed price rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions import text as T
from . import landing as L


def _when(ok: Column, value: Column) -> Column:
    return F.when(F.coalesce(ok, F.lit(False)), value)


# ------------------------------------------------------------ app price overviews

APP_PRICES = (
    "map<string, struct<success: boolean, data: struct<price_overview: struct<"
    "currency: string, initial: double, final: double, discount_percent: int>>>>"
)


def steam_prices(raw: DataFrame) -> DataFrame:
    """One row per app and region of every landed batch response.

    The landing key is the region.  An app without a usable price keeps its row
    with a null amount: the store answered and does not sell it there.
    """
    entries = L.id_entries(raw, APP_PRICES, "app", "e", F.upper("key").alias("cc"))
    p = F.col("e.data.price_overview")
    ok = F.col("e.success") & p["final"].isNotNull()
    sale = ok & (F.coalesce(p["discount_percent"], F.lit(0)) > 0)
    return entries.select(
        F.col("app").try_cast("bigint").alias("app_id"), "cc", _when(ok, p["currency"]).alias("currency"),
        _when(ok, X.round2(p["final"] / 100)).alias("amount"), _when(sale, X.round2(p["initial"] / 100)).alias("list_amount"),
        _when(sale, p["discount_percent"]).alias("discount_pct"))


TITLE_PRICES = (
    "struct<country: string, prices: array<struct<title_id: string, sales_status: string, "
    "regular_price: struct<currency: string, raw_value: string>, discount_price: struct<raw_value: string, end_datetime: string>>>>"
)
ON_SALE = ("onsale", "pre_order")


def eshop_prices(raw: DataFrame) -> DataFrame:
    """One row per title and region; titles not for sale have a null amount."""
    rows = raw.select(F.upper("key").alias("cc"), F.explode(F.from_json("body", TITLE_PRICES)["prices"]).alias("p"))
    regular = F.col("p.regular_price.raw_value").try_cast("double")
    cut = F.col("p.discount_price.raw_value").try_cast("double")
    ok = F.col("p.sales_status").isin(*ON_SALE) & (regular > 0) & (F.coalesce("p.regular_price.currency", F.lit("")) != "")
    sale = ok & (cut < regular)
    return rows.select(
        F.col("p.title_id").alias("nsuid"), "cc", _when(ok, F.col("p.regular_price.currency")).alias("currency"),
        F.when(F.coalesce(sale, F.lit(False)), cut).otherwise(_when(ok, regular)).alias("amount"), _when(sale, regular).alias("list_amount"),
        _when(sale, X.discount_pct(cut, regular)).alias("discount_pct"), _when(sale, F.col("p.discount_price.end_datetime")).alias("sale_ends_at"))


PACKAGES = (
    "map<string, struct<success: boolean, data: struct<name: string, page_content: string, apps: array<struct<id: bigint>>, "
    "price: struct<currency: string, initial: double, final: double, discount_percent: int>>>>"
)


def steam_package_prices(raw: DataFrame, offers: DataFrame) -> DataFrame:
    """Price rows of reviewed packages with the reason a row was refused.

    A package whose name, page text or app set no longer is what was reviewed
    is refused; ``no_price`` means the store answered without a price.
    """
    entries = L.id_entries(raw, PACKAGES, "pkg", "e", F.upper("key").alias("cc"))
    j = entries.withColumn("package_id", F.col("pkg").try_cast("bigint")).join(offers, "package_id")
    d = F.col("e.data")
    price = d["price"]
    apps = F.array_sort(F.transform(F.coalesce(d["apps"], F.array()), lambda a: a["id"]))
    want = F.array_sort(F.coalesce("expected_app_ids", F.array()))
    named = F.coalesce("expected_store_name", F.lit("")) != ""
    need_text = F.coalesce("required_page_text", F.lit("")) != ""
    reason = (
        F.when(~F.coalesce(F.col("e.success") & (price["final"] > 0) & price["currency"].isNotNull(), F.lit(False)), "no_price")
        .when(named & ~F.coalesce(d["name"] == F.col("expected_store_name"), F.lit(False)), "store_name_changed")
        .when(need_text & ~F.coalesce(F.lower(d["page_content"]).contains(F.lower("required_page_text")), F.lit(False)), "page_text_missing")
        .when(F.col("includes_base") & ~F.array_contains(apps, F.col("base_app_id")), "base_app_missing")
        .when(~F.col("includes_base") & F.array_contains(apps, F.col("base_app_id")), "base_app_unexpected")
        .when((F.col("includes_base") | (F.size(want) > 0)) & (apps != want), "contents_changed")
    )
    amount = X.round2(price["final"] / 100)
    initial = F.coalesce(X.round2(price["initial"] / 100), amount)
    pct = F.when(price["discount_percent"] > 0, price["discount_percent"]).when(initial > amount, X.discount_pct(amount, initial))
    j = j.withColumn("reason", reason)
    ok = F.col("reason").isNull()
    sale = ok & (pct > 0) & (initial > amount)
    return j.select(
        "package_id", "slug", "cc", _when(ok, F.upper(price["currency"])).alias("currency"), _when(ok, amount).alias("amount"),
        _when(sale, initial).alias("list_amount"), _when(sale, pct).alias("discount_pct"), "reason")


# ------------------------------------------------------------ display catalog

AVAILABILITY = (
    "array<struct<Actions: array<string>, Conditions: string, Markets: array<string>, "
    "OrderManagementData: struct<GrantedEntitlementKeys: array<string>, Price: struct<ListPrice: double, MSRP: double, CurrencyCode: string>>>>"
)
DISPLAY = (
    "struct<Products: array<struct<ProductId: string, ProductKind: string, LocalizedProperties: array<struct<ProductTitle: string>>, "
    "DisplaySkuAvailabilities: array<struct<Sku: struct<SkuId: string, SkuType: string, LocalizedProperties: array<struct<SkuTitle: string>>, "
    f"Properties: struct<IsTrial: boolean, IsBundle: boolean>>, Availabilities: {AVAILABILITY}>>>>>"
)
CONDITIONS = (
    "struct<StartDate: string, EndDate: string, ResourceSetIds: array<string>, ClientConditions: string>"
)
CLIENT = "struct<AllowedPlatforms: array<string>>"
PLATFORM = "struct<MinVersion: bigint, MaxVersion: bigint, PlatformName: string>"

# Values a public purchase may carry, fixed values.
PUBLIC_ACTIONS = ("Browse", "Curate", "Details", "Fulfill", "Gift", "Purchase", "Redeem")
PUBLIC_PLATFORMS = ("Windows.8828080", "Windows.Desktop", "Windows.Xbox")


def public_purchase(a: Column, as_of) -> Column:
    """The availability can be bought now by anyone, under conditions we know.

    Condition objects are kept as text so that unknown keys can be noticed.
    """
    cond = F.from_json(a["Conditions"], CONDITIONS)
    platforms = F.from_json(cond["ClientConditions"], CLIENT)["AllowedPlatforms"]
    parsed = F.transform(platforms, lambda p: F.from_json(p, PLATFORM))
    names = F.transform(parsed, lambda p: p["PlatformName"])
    start, end = F.try_to_timestamp(cond["StartDate"]), F.try_to_timestamp(cond["EndDate"])
    now = X.moment(as_of)
    tests = (
        F.array_contains(a["Actions"], "Purchase"),
        F.size(a["Actions"]) == F.size(F.array_distinct(a["Actions"])),
        F.forall(a["Actions"], lambda x: x.isin(*PUBLIC_ACTIONS)),
        (start <= now) & (now < end),
        L.keys_are(a["Conditions"], "ClientConditions", "EndDate", "ResourceSetIds", "StartDate"),
        cond["ResourceSetIds"] == F.array(F.lit("1")),
        L.keys_are(cond["ClientConditions"], "AllowedPlatforms"),
        F.size(platforms).between(1, 3),
        F.forall(platforms, lambda p: L.keys_are(p, "MaxVersion", "MinVersion", "PlatformName")),
        F.forall(parsed, lambda p: (p["MinVersion"] >= 0) & (p["MaxVersion"] >= p["MinVersion"]) & p["PlatformName"].isin(*PUBLIC_PLATFORMS)),
        F.size(names) == F.size(F.array_distinct(names)),
        F.array_contains(names, "Windows.Xbox"),
        F.size(a["OrderManagementData"]["GrantedEntitlementKeys"]) == 0,
    )
    out = F.lit(True)
    for t in tests:
        out = out & F.coalesce(t, F.lit(False))
    return out


def xbox_prices(raw: DataFrame, catalog: DataFrame, as_of) -> DataFrame:
    """The one public offer of every mapped standard edition.

    Products are matched on id and title; all current public offers of a
    product must be the same one, otherwise it has no price.  A catalog id that
    is not twelve capitals or digits maps nothing.  Opened products are far
    larger than the files they come from, by which Spark would judge them small
    enough to go through the driver, so they are joined by a merge.
    """
    mapped = catalog.where(F.col("xbox_big_id").rlike(r"^[A-Z0-9]{12}\z")).select(
        F.upper("xbox_big_id").alias("big_id"), "slug", T.norm_title("title").alias("want"))
    docs = raw.select(L.once(F.from_json("body", DISPLAY)).alias("doc"))
    products = docs.select(F.explode("doc.Products").alias("p")).select(F.upper("p.ProductId").alias("big_id"), "p")
    title = F.try_element_at("p.LocalizedProperties", F.lit(1))["ProductTitle"]
    known = products.join(mapped.hint("merge"), "big_id").withColumn("title_key", T.norm_title(title))
    known = known.where((F.col("p.ProductKind") == "Game") & (F.col("want") != "") & (F.col("title_key") == F.col("want")))
    skus = known.select("big_id", "slug", "want", F.explode("p.DisplaySkuAvailabilities").alias("s"))
    sku_title = F.try_element_at("s.Sku.LocalizedProperties", F.lit(1))["SkuTitle"]
    full = (
        (F.col("s.Sku.SkuType") == "full") & ~F.coalesce("s.Sku.Properties.IsTrial", F.lit(False))
        & ~F.coalesce("s.Sku.Properties.IsBundle", F.lit(False))
    )
    skus = skus.where(full).withColumn("sku_title", sku_title).where(T.norm_title("sku_title") == F.col("want"))
    offers = skus.select("big_id", "slug", "sku_title", F.col("s.Sku.SkuId").alias("sku_id"), F.explode("s.Availabilities").alias("a"))
    price = F.col("a.OrderManagementData.Price")
    public = offers.where(public_purchase(F.col("a"), as_of) & (price["ListPrice"] > 0) & price["CurrencyCode"].rlike("^[A-Z]{3}$"))
    sale = price["MSRP"] > price["ListPrice"]
    end = F.try_to_timestamp(F.from_json(F.col("a.Conditions"), CONDITIONS)["EndDate"])
    flat = public.select(
        "big_id", "slug", "sku_id", "sku_title", price["CurrencyCode"].alias("currency"), X.round2(price["ListPrice"]).alias("amount"),
        _when(sale, X.round2(price["MSRP"])).alias("list_amount"), _when(sale, X.discount_pct(price["ListPrice"], price["MSRP"])).alias("discount_pct"),
        _when(sale, X.honest_sale_end(end)).alias("sale_ends_at"))
    # one row per distinct offer, then products with exactly one
    one = flat.distinct().groupBy("slug", "big_id").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("sku_id", "sku_title", "currency", "amount", "list_amount", "discount_pct", "sale_ends_at")).alias("o"))
    return one.where(F.col("n") == 1).select("slug", "big_id", F.lit("US").alias("cc"), "o.*")


SUGGESTIONS = "struct<Results: array<struct<Products: array<struct<Type: string, ProductId: string, Title: string>>>>>"


def xbox_suggestions(raw: DataFrame) -> DataFrame:
    """Products of landed search suggestions."""
    groups = raw.select(F.explode(F.from_json("body", SUGGESTIONS)["Results"]).alias("g"))
    p = groups.select(F.explode("g.Products").alias("p")).where(F.col("p.ProductId").rlike("(?i)^[A-Z0-9]{12}$"))
    return p.select(F.upper("p.ProductId").alias("product_id"), F.col("p.Title").alias("title"), F.col("p.Type").alias("kind"))


# ------------------------------------------------------------ page-embedded caches

PAGE = "struct<props: struct<pageProps: struct<locale: string, productId: string, batarangs: map<string, struct<text: string>>>>>"
REF = "struct<__ref: string>"
ENTITY = (
    "struct<__typename: string, id: string, name: string, invariantName: string, topCategory: string, storeDisplayClassification: string, "
    "type: string, edition: struct<type: string, name: string>, platforms: array<string>, releaseDate: string, "
    f"skus: array<{REF}>, webctas: array<{REF}>, concept: {REF}, media: array<struct<type: string, role: string, url: string>>, "
    "action: struct<type: string, param: array<struct<name: string, value: string>>>, local: struct<ctaType: string>, "
    "meta: struct<upSellService: string, exclusive: boolean>, price: struct<discountedValue: bigint, basePriceValue: bigint, currencyCode: string, "
    "isFree: boolean, applicability: string, serviceBranding: array<string>, qualifications: array<string>, isExclusive: boolean, "
    "isTiedToSubscription: boolean, endTime: string>>"
)
FRAGMENT = f"struct<cache: map<string, {ENTITY}>>"
ENV_SCRIPT = "id=[\"']env:[^\"']+[\"']"
# Words of mixed products and closing platform marks, fixed values.
MIXED_TITLES = r"(?i)\b(bundle|collection|anthology)\b"
PLATFORM_TAIL = r"(?:ps4(?:and)?ps5|ps5(?:and)?ps4|ps4|ps5)$"


def psn_title_key(title) -> Column:
    """Title key without a closing platform mark."""
    return F.regexp_replace(T.norm_title(title), PLATFORM_TAIL, "")


def _psn_keys(names: str) -> Column:
    """``psn_title_key`` of every name of a list, by one Python step for all that are not ASCII."""
    bare = F.transform(names, lambda n: F.regexp_replace(F.lower(n), "[™®©℠]", ""))
    folded = F.split(T._folded(T.nfkc, F.array_join(bare, "\u0001")), "\u0001")
    return F.transform(folded, lambda n: F.regexp_replace(F.regexp_replace(n, r"[^\p{L}\p{N}]+", ""), PLATFORM_TAIL, ""))


def _own_product() -> Column:
    """A cache's entity of the page's own product."""
    return F.try_element_at("cache", F.concat(F.lit("Product:"), "product_id"))


def psn_fragments(pages: DataFrame) -> DataFrame:
    """Embedded cache fragments of product pages: (product_id, final_url, doc, cache)."""
    page = F.from_json(L.script_body("body", L.NEXT_DATA), PAGE)["props"]["pageProps"]
    opened = pages.select("final_url", F.upper("key").alias("product_id"), L.once(page).alias("pp"))
    asked = F.concat(F.lit("https://store.playstation.com/en-us/product/"), "product_id")
    opened = opened.where(
        X.matches("product_id", X.PSN_PRODUCT_SHAPE) & (F.col("pp.locale") == "en-us") & (F.col("pp.productId") == F.col("product_id"))
        & (F.rtrim(F.col("final_url"), F.lit("/")) == asked))
    docs = opened.select("product_id", F.explode("pp.batarangs").alias("doc", "part"))
    inner = F.from_json(L.script_body("part.text", ENV_SCRIPT), FRAGMENT)["cache"]
    return docs.select("product_id", "doc", L.once(inner).alias("cache")).where(F.col("cache").isNotNull())


def _observation(price: Column, as_of, public: bool) -> Column:
    """Price facts of one call to action, null when it is not of the wanted kind."""
    low, base = price["discountedValue"], price["basePriceValue"]
    brand = F.coalesce(price["serviceBranding"], F.array())
    qualified = F.size(F.coalesce(price["qualifications"], F.array())) > 0
    sane = (low > 0) & (base > 0) & (low <= base) & (price["currencyCode"] == "USD") & ~F.coalesce(price["isFree"], F.lit(False))
    if public:
        kind = (
            (price["applicability"] == "APPLICABLE") & (brand == F.array(F.lit("NONE"))) & ~qualified
            & (price["isExclusive"] == F.lit(False)) & (price["isTiedToSubscription"] == F.lit(False))
        )
    else:
        kind = (
            F.array_contains(brand, "PS_PLUS") | qualified | F.coalesce(price["applicability"] == "UPSELL", F.lit(False))
            | F.coalesce(price["isExclusive"], F.lit(False)) | F.coalesce(price["isTiedToSubscription"], F.lit(False))
        )
    blank = F.coalesce(price["endTime"], F.lit("")) == ""
    end = F.when(~blank, F.timestamp_millis(price["endTime"].try_cast("bigint")))
    end_ok = blank | ((F.year(end) < 2100) & (end > X.moment(as_of)))
    sale = low < base
    facts = F.struct(
        X.round2(low / 100).alias("amount"), F.when(sale, X.round2(base / 100)).alias("list_amount"),
        F.when(sale, X.discount_pct(low, base)).alias("discount_pct"), F.when(sale, end).alias("sale_ends_at"))
    return F.when(F.coalesce(sane & kind & end_ok, F.lit(False)), facts)


def psn_prices(pages: DataFrame, catalog: DataFrame, as_of) -> DataFrame:
    """The unrestricted public offer of every mapped standard edition.

    All fragments of a page must agree on it.  Membership offers and trials are
    kept as annotations and never become the price.
    """
    want = catalog.where(F.col("psn_product_id").isNotNull() & ~F.col("title").rlike(MIXED_TITLES)).select(
        F.upper("psn_product_id").alias("product_id"), "slug", T.norm_title("title").alias("want"))

    # a fragment gives its views of the product and, where it carries both the
    # calls to action and their units, its offers: one kind of row for both, so
    # that a page is opened once
    frags = psn_fragments(pages).withColumn("prod", _own_product())
    views = F.filter(F.map_values("cache"), lambda e: (e["__typename"] == "Product") & (e["id"] == F.col("product_id")))
    offered = (F.size(F.coalesce("prod.webctas", F.array())) > 0) & (F.size(F.coalesce("prod.skus", F.array())) > 0)
    calls = F.when(F.coalesce(offered, F.lit(False)), F.col("prod.webctas")).otherwise(F.array())
    items = F.concat(
        F.transform(views, lambda e: F.struct(e.alias("view"), F.lit(False).alias("call"), F.lit(None).cast("string").alias("ref"))),
        F.transform(calls, lambda r: F.struct(F.lit(None).cast(ENTITY).alias("view"), F.lit(True).alias("call"), r["__ref"].alias("ref"))))
    rows = frags.select(
        "product_id", "doc", "cache", F.col("prod.concept.__ref").alias("concept"),
        F.transform("prod.skus", lambda r: F.regexp_replace(r["__ref"], "^Sku:", "")).alias("sku_ids"), F.explode(items).alias("item"))

    # identity and class over every view of the product
    e = F.col("item.view")
    standard = (e["edition"]["type"] == "STANDARD") | (e["edition"]["type"].isNull() & e["edition"]["name"].isin("", "Base Game"))
    standard = F.coalesce(standard, F.lit(False))
    conflict = (
        F.coalesce(e["topCategory"] != "GAME", F.lit(False)) | F.coalesce(e["storeDisplayClassification"] != "FULL_GAME", F.lit(False))
        | F.coalesce(e["type"] != "GAME", F.lit(False)) | (e["edition"].isNotNull() & ~standard)
    )
    full = F.coalesce((e["topCategory"] == "GAME") & (e["storeDisplayClassification"] == "FULL_GAME"), F.lit(False)) & standard
    consoles = F.coalesce(e["platforms"], F.array())
    # keys of names are made per product: the Python step they may need then sees one row of it
    names = F.filter(F.array(e["name"], e["invariantName"]), lambda n: F.coalesce(n, F.lit("")) != "")

    cta = rows.withColumn("c", F.try_element_at("cache", F.col("item.ref")))
    params = F.coalesce(F.col("c.action.param"), F.array())
    sku_id = F.try_element_at(F.filter(params, lambda p: p["name"] == "skuId"), F.lit(1))["value"]
    reward = F.filter(params, lambda p: p["name"] == "rewardId")
    cta = cta.withColumn("sku_id", sku_id).withColumn("unit", F.try_element_at("cache", F.concat(F.lit("Sku:"), "sku_id")))
    bound = (F.col("c.__typename") == "GameCTA") & F.array_contains("sku_ids", F.col("sku_id")) & (F.col("unit.__typename") == "Sku") & (F.col("unit.name") == "Game")
    cash = (
        (F.col("c.type") == "ADD_TO_CART") & (F.col("c.action.type") == "ADD_TO_CART") & (F.col("c.local.ctaType") == "purchase")
        & (F.col("c.meta.upSellService") == "NONE") & (F.col("c.meta.exclusive") == F.lit(False)) & (F.size(reward) > 0)
        & F.coalesce(F.try_element_at(reward, F.lit(1))["value"], F.lit("OUTRIGHT")).isin("OUTRIGHT")
    )
    bound, cash = F.coalesce(bound, F.lit(False)), F.coalesce(cash, F.lit(False))
    price = F.col("c.price")
    trial = F.col("c.type").contains("TRIAL") | F.coalesce(price["isFree"], F.lit(False)) | F.coalesce(price["discountedValue"] == 0, F.lit(False))
    judged = cta.select(
        "product_id", "doc", F.col("item.call").alias("call"), F.when(F.col("item.call"), F.col("concept")).alias("concept"), "sku_id",
        F.when(bound & cash, _observation(price, as_of, True)).alias("pub"),
        F.when(bound, _observation(price, as_of, False)).alias("plus"),
        F.when(bound & F.coalesce(trial, F.lit(False)), F.coalesce("c.id", F.concat_ws(":", "c.type", "sku_id"))).alias("trial"),
        F.when(~F.col("item.call"), F.struct(
            conflict.alias("conflict"), full.alias("full"), F.coalesce(e["type"] == "GAME", F.lit(False)).alias("game"),
            F.array_contains(consoles, "PS4").alias("ps4"), F.array_contains(consoles, "PS5").alias("ps5"),
            names.alias("names"), F.coalesce(e["invariantName"], e["name"]).alias("title"))).alias("v"))
    flags = ("conflict", "full", "game", "ps4", "ps5")
    per_doc = judged.groupBy("product_id", "doc").agg(
        F.bool_or("call").alias("offers"),
        F.min(F.when(F.col("pub").isNotNull(), F.struct(F.col("pub.amount").alias("a"), "sku_id", "pub"))).alias("best"),
        F.min("plus").alias("plus"), F.min("concept").alias("concept"), F.collect_set("trial").alias("trials"),
        *[F.bool_or(f"v.{x}").alias(x) for x in flags], F.collect_set("v.names").alias("names"), F.max("v.title").alias("matched_title"))
    # a page has a handful of fragments with a handful of offers and names each
    trials = F.size(F.array_distinct(F.flatten(F.collect_list("trials")))).cast("bigint").alias("excluded_trials")
    one = per_doc.groupBy("product_id").agg(
        F.min("best").alias("lo"), F.max("best").alias("hi"), F.count_if("offers").alias("docs"), F.count_if(F.col("offers") & F.col("best").isNull()).alias("empty"),
        F.min("plus").alias("plus"), F.min("concept").alias("c_lo"), F.max("concept").alias("c_hi"), trials,
        *[F.bool_or(x).alias(x) for x in flags], F.array_distinct(F.flatten(F.flatten(F.collect_list("names")))).alias("names"),
        F.max("matched_title").alias("matched_title"))
    one = one.where((F.col("docs") > 0) & (F.col("empty") == 0) & (F.col("lo") == F.col("hi")) & F.col("c_lo").eqNullSafe(F.col("c_hi")))
    one = one.where(~F.col("conflict") & F.col("full") & F.col("game") & (F.col("ps4") | F.col("ps5")))
    one = one.withColumn("keys", F.array_distinct(_psn_keys("names"))).where(F.size("keys") == 1).withColumn("key", F.get("keys", F.lit(0)))
    consoles = F.array_compact(F.array(F.when(F.col("ps4"), "ps4"), F.when(F.col("ps5"), "ps5")))
    concept = F.regexp_extract(F.coalesce("c_lo", F.lit("")), r"^Concept:(\d{8})$", 1)
    # as many rows as products: joined by a merge, never sent through the driver
    return (
        one.join(want.hint("merge"), "product_id").where((F.col("want") != "") & (F.col("key") == F.col("want")))
        .select("slug", "product_id", F.lit("US").alias("cc"), F.lit("USD").alias("currency"), "lo.pub.*", F.col("lo.sku_id").alias("sku_id"),
                F.nullif(concept, F.lit("")).alias("concept_id"), consoles.alias("platforms"), "matched_title",
                F.col("plus.amount").alias("plus_amount"), "excluded_trials")
    )


# ------------------------------------------------------------ exchange rates

RATES = "struct<result: string, rates: map<string, double>>"


def fx_rates(raw: DataFrame, priority: dict[str, int]) -> DataFrame:
    """Rates of the most preferred source that has a usable document.  Some
    sources state their success, others only carry rates."""
    doc = F.from_json("body", RATES)
    rank = None
    for source, place in priority.items():
        rank = F.when(F.col("source") == source, place) if rank is None else rank.when(F.col("source") == source, place)
    usable = raw.withColumn("doc", doc).withColumn("place", rank).where(
        F.col("place").isNotNull() & (F.coalesce(F.size("doc.rates"), F.lit(0)) > 0) & F.coalesce(F.col("doc.result") == "success", F.lit(True)))
    best = usable.groupBy().agg(F.min_by(F.struct("doc", "fetched_at"), F.struct("place", (-F.unix_micros("fetched_at")).alias("n"))).alias("b"))
    return best.select(F.explode("b.doc.rates").alias("currency", "rate"), F.col("b.fetched_at").alias("as_of"))
