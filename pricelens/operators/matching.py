"""Matching titles, products and pages across stores.

Titles are matched by equality of normalised keys.  The candidate side is
first reduced to one row per key (counts, lowest id), so that a title carried
by very many products costs one row in the join and no pairs are emitted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions import text as T
from ..functions.ordering import first_per_key


def title_match(wanted: DataFrame, candidates: DataFrame, key=T.norm_title) -> DataFrame:
    """For every wanted title the number of matching candidates and, when
    there is exactly one, its id.

    ``wanted`` holds (id, title), ``candidates`` (cand_id, title).  A candidate
    answers to its own key and to the key without a known edition suffix;
    empty keys never match.
    """
    named = T.with_title_key(candidates.select("cand_id", "title"), "own_key", key=key)
    keyed = named.select("cand_id", F.explode(T.edition_keys("own_key")).alias("title_key"))
    per_key = keyed.groupBy("title_key").agg(
        F.count_distinct("cand_id").alias("n"), F.min("cand_id").alias("low"))
    return (
        T.with_title_key(wanted, key=key).where(F.col("title_key") != "")
        .join(per_key, "title_key", "left")
        .select("id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_matches"),
                F.when(F.col("n") == 1, F.col("low")).alias("match_id"))
    )


def exact_unique_suggestion(results: DataFrame, titles: DataFrame, key=T.norm_title) -> DataFrame:
    """Product id of a wanted title when exactly one game-type product has it."""
    games = T.with_title_key(results.where(F.lower("kind") == "game").select("product_id", "title"), key=key)
    one = games.where(F.col("title_key") != "").groupBy("title_key").agg(
        F.count_distinct("product_id").alias("n"), F.min("product_id").alias("product_id")).where(F.col("n") == 1)
    return T.with_title_key(titles, key=key).join(one, "title_key").select("slug", "product_id")


# ------------------------------------------------------------ store search results

GENERATIONS = {"switch": "HAC", "switch-2": "BEE"}


def allowed_generations(platforms: str = "platforms") -> Column:
    return F.array_compact(F.array(*[
        F.when(F.array_contains(platforms, p), g) for p, g in GENERATIONS.items()]))


def generation(codes: str, systems: str) -> Column:
    """The one console generation that hardware codes and system names agree
    on, else null."""
    upper = F.transform(F.coalesce(F.col(codes), F.array()), lambda c: F.upper(c))
    lower = F.transform(F.coalesce(F.col(systems), F.array()), lambda c: F.lower(c))
    second = r"nintendo\s+switch\s*2"
    hac = F.exists(upper, lambda c: c.contains("HAC")) | F.exists(
        lower, lambda s: s.rlike(r"nintendo\s+switch") & ~s.rlike(second))
    bee = F.exists(upper, lambda c: c.contains("BEE")) | F.exists(lower, lambda s: s.rlike(second))
    # each test stands here once, so it runs once a row; an unknown one gives null
    return F.get(F.array(F.lit(None).cast("string"), F.lit("HAC"), F.lit("BEE")), hac.cast("int") + 2 * bee.cast("int"))


def one_base_nsuid(ids: str) -> Column:
    base = F.array_distinct(F.filter(F.coalesce(F.col(ids), F.array()), lambda i: i.rlike(X.NSUID_SHAPE)))
    # the ids are bound to a name, so they are found once a row
    return F.get(F.transform(F.array(base), lambda b: F.when(F.size(b) == 1, F.get(b, F.lit(0)))), F.lit(0))


def released_by(release: str, as_of, others: str | None = None) -> Column:
    """Whether the release has come; where its text is no date, the first of ``others`` (a list) that is one counts."""
    at = F.try_to_timestamp(F.col(release))
    if others is not None:
        dated = F.filter(F.transform(others, lambda t: F.try_to_timestamp(t)), lambda t: t.isNotNull())
        at = F.coalesce(at, F.get(dated, F.lit(0)))
    return F.coalesce(at <= X.moment(as_of), F.lit(False))


def positive_price(lowest: str = "price_lowest", regular: str = "price_regular") -> Column:
    """The lowest price decides where known, else the regular one."""
    return F.coalesce(F.coalesce(F.col(lowest), F.col(regular)) > 0, F.lit(False))


def eu_purchasable(as_of) -> Column:
    is_game = F.coalesce(F.upper("type") == "GAME", F.lit(True))
    removed = F.coalesce(F.lower(F.col("removed").cast("string")).isin("true", "1"), F.lit(False))
    return is_game & ~removed & released_by("release", as_of) & positive_price()


def jp_purchasable() -> Column:
    on_sale = F.coalesce(F.lower("sales_status") == "onsale", F.lit(False))
    upgrade = F.coalesce(F.lower(F.col("upgrade").cast("string")).isin("true", "1"), F.lit(False))
    form = F.concat_ws(" ", "form", "form_name", "category")
    extra = form.rlike("(?i)(DLC|AOC|UPGRADE|BUNDLE)")
    price = F.coalesce("current_price", "price")
    return on_sale & ~upgrade & ~extra & F.coalesce(price > 0, F.lit(False))


def resolve_region_match(docs: DataFrame, targets: DataFrame, region: str, sellable: Column,
                         key=T.norm_title) -> DataFrame:
    """matched / none / exception of every target in one region's results.

    Results are reduced to one row per title key with, for each generation
    choice a target can allow, the number of distinct products and the lowest.
    """
    usable = (
        docs.withColumn("gen", generation("codes", "systems")).withColumn("nsuid", one_base_nsuid("nsuids"))
        .where(sellable & F.col("gen").isNotNull() & F.col("nsuid").isNotNull())
        .select(F.explode(T.edition_keys(key("title"))).alias("title_key"), "nsuid", "gen", "title")
    )
    product = usable.groupBy("title_key", "nsuid").agg(
        F.bool_or(F.col("gen") == "HAC").alias("hac"), F.bool_or(F.col("gen") == "BEE").alias("bee"),
        F.min("title").alias("title"))
    choice = {"HAC": F.col("hac"), "BEE": F.col("bee"), "HAC,BEE": F.lit(True)}
    facts = [F.struct(
        F.count_if(c).alias("n"),
        F.min(F.when(c, F.struct("nsuid", "title", F.when(F.col("hac"), "HAC").otherwise("BEE").alias("gen")))).alias("hit"))
        for c in choice.values()]
    per_key = product.groupBy("title_key").agg(*[f.alias(f"c{i}") for i, f in enumerate(facts)])
    wanted = targets.select("slug", key("title").alias("title_key"), F.array_join(allowed_generations(), ",").alias("allowed"))
    j = wanted.join(per_key, "title_key", "left")
    picked = None
    for i, name in enumerate(choice):
        picked = F.when(F.col("allowed") == name, F.col(f"c{i}")) if picked is None else picked.when(F.col("allowed") == name, F.col(f"c{i}"))
    n = F.coalesce(F.col("p.n"), F.lit(0))
    status = F.when(F.col("allowed") == "", "exception").when(n == 0, "none").when(n > 1, "exception").otherwise("matched")
    reason = (
        F.when(F.col("allowed") == "", "missing_switch_generation")
        .when(n == 0, "no_exact_paid_released_generation_match")
        .when(n > 1, "ambiguous_exact_matches")
    )
    hit = F.when(F.col("status") == "matched", F.col("p.hit"))
    return (
        j.withColumn("p", picked).withColumn("status", status).withColumn("reason", reason).withColumn("hit", hit)
        .select("slug", F.lit(region).alias("region"), "status", "reason", F.col("hit.nsuid").alias("nsuid"),
                F.col("hit.gen").alias("generation"), F.col("hit.title").alias("matched_title"))
    )


def enrichment_reason(as_of, nsuid: Column | None = None, gen: Column | None = None, releases: str | None = None) -> Column:
    """First failed test of a search document; null when it is usable.

    ``nsuid`` and ``gen`` are the document's own where they are known already,
    ``releases`` the list of its further release dates, if it has one.
    """
    nsuid = one_base_nsuid("nsuids") if nsuid is None else nsuid
    gen = generation("codes", "systems") if gen is None else gen
    removed = F.coalesce(F.lower(F.col("removed").cast("string")).isin("true", "1"), F.lit(False))
    return (
        F.when(~F.coalesce(F.upper("type") == "GAME", F.lit(False)), "not_game")
        .when(nsuid.isNull(), "base_nsuid_missing_or_ambiguous")
        .when(removed, "eshop_removed")
        .when(~released_by("release", as_of, releases), "not_released")
        .when(~positive_price(), "paid_digital_evidence_missing")
        .when(gen.isNull(), "generation_missing_or_conflicting")
    )


def _releases(docs: DataFrame) -> str | None:
    return "releases" if "releases" in docs.columns else None


def resolve_enrichment(docs: DataFrame, targets: DataFrame, owners: DataFrame, as_of, key=T.norm_title) -> DataFrame:
    """matched / rejected of every target with the audit of its documents:
    their number, that of exact titles, and that of every failed test.

    ``docs`` carries the slug of the target it was fetched for and, where a
    document has more than one release date, the others as ``releases``;
    ``owners`` holds (nsuid, owner).
    """
    wanted = T.with_title_key(targets.select("slug", "title"), "want", key=key).drop("title")
    # judged and reduced before the join: what is left to it is whether the title is the wanted one
    own = F.struct(one_base_nsuid("nsuids").alias("nsuid"), generation("codes", "systems").alias("gen"))
    found = T.with_title_key(docs, "__key", key=key).withColumn("p", F.explode(F.array(own)))
    failed = enrichment_reason(as_of, F.col("p.nsuid"), F.col("p.gen"), _releases(docs))
    found = found.select("slug", F.col("__key").alias("title_key"), "p", failed.alias("failed"))
    # a document is usable as a product of its own, else it is one more of its failed test
    found = found.select("slug", "title_key", "failed", F.when(F.col("failed").isNull(), F.col("p")).alias("p"))
    found = found.groupBy("slug", "title_key", "failed", "p.nsuid", "p.gen").agg(F.count(F.lit(1)).alias("c")).join(wanted, "slug")
    exact = F.array_contains(T.edition_keys("title_key"), F.col("want")) & (F.col("want") != "")
    # products of other titles are none
    why = F.when(~exact, "title_mismatch").otherwise(F.col("failed"))
    found = found.select("slug", "c", why.alias("why"), *[F.when(exact, F.col(x)).alias(x) for x in ("nsuid", "gen")])
    # one row per usable product and one per failed test
    audit = found.groupBy("slug", "why", "nsuid", "gen").agg(F.sum("c").alias("c"))
    rejected = F.collect_list(F.when(F.col("why").isNotNull(), F.struct("why", "c")))
    one = audit.groupBy("slug").agg(
        F.sum("c").alias("n_docs"), F.sum(F.when(F.col("why") == "title_mismatch", 0).otherwise(F.col("c"))).alias("n_exact"),
        F.count("nsuid").alias("n"), F.min("nsuid").alias("nsuid"), F.min("gen").alias("gen"),
        F.map_from_entries(F.array_sort(rejected)).alias("rejected"))
    owned = owners.groupBy("nsuid").agg(F.min("owner").alias("owner"))
    j = targets.select("slug").join(one, "slug", "left").join(owned, "nsuid", "left")
    exact = F.coalesce("n_exact", F.lit(0))
    n = F.coalesce("n", F.lit(0))
    reason = (
        F.when((n == 0) & (exact == 0), "no_exact_title_match")
        .when(n == 0, "no_exact_paid_released_base_generation_match")
        .when(n > 1, "ambiguous_exact_matches")
        .when(F.col("owner").isNotNull() & (F.col("owner") != F.col("slug")), "catalog_nsuid_owned_by_other_slug")
    )
    ok = F.col("reason").isNull()
    return j.withColumn("reason", reason).select(
        "slug", F.when(ok, "matched").otherwise("rejected").alias("status"), "reason",
        F.when(ok, F.col("nsuid")).alias("nsuid"), F.when(ok, F.col("gen")).alias("generation"),
        F.coalesce("n_docs", F.lit(0)).cast("bigint").alias("n_docs"), exact.cast("bigint").alias("n_exact"),
        F.coalesce("rejected", F.create_map().cast("map<string,bigint>")).alias("rejected"))


def enrichment_rejects(docs: DataFrame, targets: DataFrame, as_of, key=T.norm_title) -> DataFrame:
    """Number of documents per target and failed test."""
    wanted = targets.select("slug", key("title").alias("want"))
    exact = F.array_contains(T.edition_keys(key("title")), F.col("want")) & (F.col("want") != "")
    why = F.when(~exact, "title_mismatch").otherwise(enrichment_reason(as_of, releases=_releases(docs)))
    return docs.join(wanted, "slug").groupBy("slug", why.alias("reason")).agg(
        F.count(F.lit(1)).alias("n")).where(F.col("reason").isNotNull())


def enrichment_cache_hit(cache: DataFrame, targets: DataFrame, as_of, max_days: int = 7) -> DataFrame:
    """Cached responses that still answer a target: same title and url, recent."""
    wanted = targets.select("slug", F.col("title").alias("w_title"), F.col("source_url").alias("w_url"))
    age = F.unix_seconds(X.moment(as_of)) - F.unix_seconds(F.col("collected_at").cast("timestamp"))
    return (
        cache.join(wanted, "slug")
        .where((F.col("title") == F.col("w_title")) & (F.col("source_url") == F.col("w_url")))
        .where((age >= 0) & (age <= max_days * 86400)).drop("w_title", "w_url")
    )


# ------------------------------------------------------------ pages

def sitemap_locate(targets: DataFrame, sitemap: DataFrame) -> DataFrame:
    """Product pages a target may use: the reviewed slug if the sitemap has it,
    else the game's slug with a platform suffix, else bare.

    ``targets`` holds (slug, platforms, hint), ``sitemap`` (product_slug, url).
    """
    variants = F.array_compact(F.array(
        F.when(F.array_contains("platforms", "switch-2"), F.concat("slug", F.lit("-switch-2"))),
        F.when(F.array_contains("platforms", "switch"), F.concat("slug", F.lit("-switch"))),
        F.col("slug")))
    guesses = F.when(F.col("hint").isNotNull(), F.array("hint")).otherwise(F.array_distinct(variants))
    keys = targets.select("slug", F.when(F.col("hint").isNotNull(), "audited_hint").otherwise("sitemap_slug").alias("located_by"),
                          F.posexplode(guesses).alias("place", "product_slug"))
    pages = sitemap.groupBy("product_slug").agg(F.max("url").alias("url"))
    return keys.where(F.col("product_slug").rlike(X.SLUG_SHAPE)).join(pages, "product_slug")


def url_reconcile(built: DataFrame, listed: DataFrame) -> DataFrame:
    """Pages missing from the sitemap and sitemap entries without a page."""
    b = built.select("url").distinct().withColumn("b", F.lit(True))
    s = listed.select("url").distinct().withColumn("l", F.lit(True))
    status = F.when(F.col("l").isNull(), "not_listed").when(F.col("b").isNull(), "no_page")
    return b.join(s, "url", "full_outer").withColumn("status", status).where(F.col("status").isNotNull()).select("url", "status")


# ------------------------------------------------------------ title search

def _terms(text: str | Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(X.col(text)), r"[^\p{L}\p{N}]+"), lambda w: w != ""))


#: Most edits a query term may have, however long it is.
MOST_EDITS = 6


def _edits(length: Column) -> Column:
    """Edits allowed for a query term: a fifth of its length, rounded, ``MOST_EDITS`` at most."""
    return F.least(F.floor(length * 0.2 + 0.5), F.lit(MOST_EDITS)).cast("int")


def similar_terms(queries: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Pairs (q, t, quality) of query terms and vocabulary terms that match
    exactly (3), as a prefix (2) or within the allowed edits (1).

    Fuzzy candidates are found by equality only.  Cut a query term into one
    piece more than the allowed edits: at least one piece survives unchanged in
    any term within reach, moved by at most that many places.  Vocabulary terms
    therefore publish, for every query length they could answer, the substrings
    at the places such a piece could have; a distance check settles the rest.
    Both sides are distinct words, so their size follows the language.
    """
    q = queries.select("q").distinct().withColumn("len", F.length("q")).withColumn("k", _edits(F.length("q")))
    t = vocabulary.select("t").distinct().withColumn("tlen", F.length("t"))

    prefixes = t.select("t", F.explode(F.transform(F.sequence(F.lit(1), F.col("tlen")), lambda i: F.substring(F.col("t"), F.lit(1), i))).alias("q"))
    near = q.join(prefixes, "q").select("q", "t", F.when(F.col("q") == F.col("t"), 3).otherwise(2).alias("quality"))

    def piece(i: Column, length: Column, k: Column) -> tuple[Column, Column]:
        start = F.floor(i * length / (k + 1)).cast("int")
        stop = F.floor((i + 1) * length / (k + 1)).cast("int")
        return start, stop - start

    i = F.col("i")
    start, width = piece(i, F.col("len"), F.col("k"))
    q_keys = (
        q.where(F.col("k") > 0).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("k"))))
        .select("q", "k", "len", "i", F.substring(F.col("q"), start + 1, width).alias("piece"))
    )
    # query lengths a term can answer: at most ``MOST_EDITS`` away and within their own allowance
    lens = t.withColumn("len", F.explode(F.sequence(F.greatest(F.col("tlen") - MOST_EDITS, F.lit(1)), F.col("tlen") + MOST_EDITS)))
    lens = lens.withColumn("k", _edits(F.col("len"))).where((F.col("k") > 0) & (F.abs(F.col("len") - F.col("tlen")) <= F.col("k")))
    spots = lens.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("k")))).withColumn("shift", F.explode(F.sequence(-F.col("k"), F.col("k"))))
    at = start + F.col("shift")
    t_keys = (
        spots.where((at >= 0) & (at + width <= F.col("tlen")))
        .select("t", "len", "i", F.substring(F.col("t"), at + 1, width).alias("piece")).distinct()
    )
    fuzzy = (
        q_keys.join(t_keys, ["len", "i", "piece"]).select("q", "t", "k").distinct()
        .where(F.levenshtein("q", "t") <= F.col("k")).select("q", "t", F.lit(1).alias("quality"))
    )
    return near.unionByName(fuzzy).groupBy("q", "t").agg(F.max("quality").alias("quality"))


def fuzzy_title_search(queries: DataFrame, catalog: DataFrame, limit: int = 8) -> DataFrame:
    """Top titles of every query: terms match as a whole, as a prefix or within
    a fifth of their length in edits (``MOST_EDITS`` at most); any matching term counts.

    Scoring runs over distinct titles; each brings at most ``limit`` games, so
    a title shared by very many games costs no more than any other.

    Of a query's terms the one with the longest lists is read only to the first
    ``limit`` titles of each list.  A title that matches another term too is
    found by that one; titles that match this term alone differ by their best
    word, and whatever stands before such a title in that word's list scores as
    much, so nothing behind the first ``limit`` can be among the top.  A word
    that every title holds thus never brings all titles to a query.  The titles
    found are then scored by all terms.
    """
    asked = queries.select("query").distinct().select("query", F.explode(_terms("query")).alias("q"))
    titles = catalog.select("title").distinct().select("title", F.explode(_terms("title")).alias("t"))
    pairs = similar_terms(asked, titles)
    lists = pairs.join(titles.groupBy("t").agg(F.count(F.lit(1)).alias("df")), "t")
    longest = asked.join(lists.groupBy("q").agg(F.sum("df").alias("size")), "q").groupBy("query").agg(F.max_by("q", F.struct("size", "q")).alias("most"))
    reached = asked.join(pairs, "q").join(longest, "query")
    heads = first_per_key(titles, ["t"], [F.col("title")], limit)
    found = reached.where("q <> most").join(titles, "t").select("query", "title").union(
        reached.where("q = most").join(heads, "t").select("query", "title")).distinct()
    # a title's own words against the words the query reaches
    best = found.join(titles, "title").join(reached.select("query", "q", "t", "quality"), ["query", "t"])
    best = best.groupBy("query", "title", "q").agg(F.max("quality").alias("quality"))
    scored = best.groupBy("query", "title").agg(F.sum("quality").cast("bigint").alias("score"))
    order = [F.col("score").desc(), F.col("title")]
    top_titles = first_per_key(scored, ["query"], order, limit)
    games = first_per_key(catalog.select("title", "slug"), ["title"], [F.col("slug")], limit)
    return first_per_key(top_titles.join(games, "title"), ["query"], [*order, F.col("slug")], limit, rank="place")
