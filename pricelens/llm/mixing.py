"""Mixing sources to target weights by weighted fair queueing.

Every source queues its documents in a shuffled order, round after round.  A
copy's virtual finish time is the source's cumulative words divided by the
source's target.  All copies are put in one order of finish time, and the mix is
the longest prefix within the budget, so each source fills its target at the
same pace.  Both cumulative sums are taken over buckets of bounded size: totals
of buckets first, then rows inside a bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import row_key, settle

WEIGHTS = (3, 1, 2)
#: Share of all words that the mix holds, and rounds a document can take part in.
BUDGET = 1.5
ROUNDS = 2
#: Rows a bucket of a running sum holds on average.
BUCKET = 4_000
WORDS = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame, seed: str) -> DataFrame:
    """doc_id, source, size in words and the shuffle key; one row per input row."""
    text_size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORDS)), F.lit(0)).cast("long")
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(seed)).cast("binary"))
    return docs.select("doc_id", "source", text_size.alias("size"), key.alias("h"), *row_key(*docs.columns))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, rounds: int = ROUNDS) -> DataFrame:
    """source, rank, source_size, n_rows, target, budget: one row per source.

    Sources by code point, null last, weigh ``weights`` in turn.  With the
    common level L a source gets min(weight * L, rounds * size).  In order of
    size over weight, L is found at the first source that is not filled: its own
    share of what the filled ones before it leave.  Behind it the same formula
    gives ever lower values, so the first is the largest of those that fit.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ranked = per.withColumn("rank", rank)
    ranked = ranked.withColumn("w", F.get(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights)).cast("int")).cast("long"))
    ranked = ranked.withColumn("cap", F.col("source_size") * rounds)
    by_fill = Window.orderBy(F.col("cap") / F.col("w"), "rank")
    everything = Window.partitionBy()
    filled = ranked.select(
        "*", F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)).alias("full"),
        F.sum("w").over(by_fill.rowsBetween(0, Window.unboundedFollowing)).alias("open"),
        (F.sum("source_size").over(everything) * F.lit(float(budget))).alias("budget"))
    level = (F.col("budget") - F.coalesce(F.col("full"), F.lit(0))) / F.col("open")
    reached = filled.withColumn("level", F.when(level <= F.col("cap") / F.col("w"), level))
    reached = reached.withColumn("level", F.max("level").over(everything))
    cap = F.col("cap").cast("double")
    return reached.select("source", "rank", "source_size", "n_rows", F.least(cap, F.coalesce(F.col("w") * F.col("level"), cap)).alias("target"), "budget")


def running_sum(df: DataFrame, group: list[str], bucket: str, order: list[Column], value: str, name: str, peers: bool = False) -> DataFrame:
    """Sum of ``value`` up to each row of its group, in an order that ``bucket`` refines to.

    ``peers``: rows equal in the order share the sum that includes all of them.
    The window without a group runs over one row per bucket, never over rows.
    """
    per = df.groupBy(*group, bucket).agg(F.sum(value).alias("__sum"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offset = per.select(*group, bucket, F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(*group, bucket).orderBy(*order)
    frame = inside.rangeBetween(Window.unboundedPreceding, 0) if peers else inside.rowsBetween(Window.unboundedPreceding, 0)
    summed = df.withColumn("__own", F.sum(value).over(frame))
    return summed.join(offset, [*group, bucket]).withColumn(name, F.col("__own") + F.col("__before")).drop("__own", "__before")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, rounds: int = ROUNDS, seed: str = ":mix") -> DataFrame:
    """Copies of every document in the mix, one row per input row.

    Returns doc_id, size (words; null text 0), source_size, target, copies (0 to
    ``rounds``), taken (copies times size) and the row's key k1, k2.  Sources
    near their target by less than one document; equal finish times go by
    source, round and id.  A text without words has size 0: it stays out of the
    common line, fills nothing, and its copies count by their place alone.  Rows that are equal in everything queue one after
    the other.  The null source is a source of its own; a null id sorts as empty
    text.  Other columns are ignored; an empty table gives no rows.
    """
    sizes = settle(sized(docs, seed), "sizes")
    goal = targets(sizes, weights, budget, rounds)
    placed = sizes.join(goal, F.equal_null(sizes["source"], goal["source"])).select(
        "doc_id", "size", "h", "k1", "k2", "rank", "source_size", "n_rows", "target", "budget")
    buckets = F.ceil(F.col("n_rows") / BUCKET)
    placed = placed.withColumn("b", F.floor(F.conv(F.substring("h", 1, 8), 16, 10).cast("long") * buckets / F.lit(2.0**32)))
    queued = running_sum(placed, ["rank"], "b", [F.col("h"), F.col("doc_id").asc_nulls_first(), F.col("size"), F.col("k1"), F.col("k2")], "size", "cum")
    queued = settle(queued.drop("b", "h", "n_rows"), "queues")
    turn = F.explode(F.sequence(F.lit(0), F.lit(rounds - 1)))
    finish = (F.col("cum") + F.col("turn") * F.col("source_size")) / F.when(F.col("target") > 0, F.col("target"))
    items = queued.where("size > 0").select("*", turn.alias("turn")).withColumn("v", F.coalesce(finish, F.lit(0.0)))
    n_buckets = -(-sizes.count() // BUCKET)
    items = items.withColumn("vb", F.floor(F.col("v") * n_buckets).cast("long"))
    order = [F.col("v"), F.col("rank"), F.col("turn"), F.col("doc_id").asc_nulls_first()]
    line = running_sum(items, [], "vb", order, "size", "line", peers=True)
    named = {"v": "v", "rank": "rank", "turn": "turn", "id": f"coalesce(doc_id, {-(2**63) + 1} - 1)"}
    last = line.where("line <= budget").agg(F.max(F.struct(*[F.expr(e).alias(n) for n, e in named.items()])).alias("p")).first().p
    taken = F.lit(0)
    for t in range(rounds if last else 0):
        # the place of this copy against the last place of the mix
        at = F.coalesce((F.col("cum") + t * F.col("source_size")) / F.when(F.col("target") > 0, F.col("target")), F.lit(0.0))
        place = F.struct(at.alias("v"), F.col("rank"), F.lit(t).alias("turn"), F.expr(named["id"]).alias("id"))
        end = F.struct(F.lit(last["v"]).alias("v"), F.lit(last["rank"]).alias("rank"), F.lit(last["turn"]).alias("turn"), F.lit(last["id"]).cast("long").alias("id"))
        taken = taken + F.when(place <= end, 1).otherwise(0)
    out = queued.withColumn("copies", taken.cast("long"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "k1", "k2")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, all columns, each as often as it is taken.

    Null texts and texts without words count 0 and come out as often as their
    place allows.  Rows equal in every column are one row with the copies of all
    of them.  An empty table gives no rows.
    """
    plan = mix(docs, **options).groupBy("k1", "k2").agg(F.sum("copies").alias("__copies")).where("__copies > 0").withColumnsRenamed({"k1": "__p1", "k2": "__p2"})
    keyed = docs.select("*", *[k.alias(f"__{n}") for k, n in zip(row_key(*docs.columns), ("k1", "k2"))])
    once = keyed.dropDuplicates(["__k1", "__k2"])
    joined = once.join(plan, (F.col("__k1") == F.col("__p1")) & (F.col("__k2") == F.col("__p2")))
    copied = joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
    return copied.select(*docs.columns)


MIX_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(concat(CAST(doc_id AS VARCHAR), ':mix')) AS h
  FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM per),
weighted AS (SELECT *, CASE rank % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w, 2 * source_size AS cap FROM ranked),
shares AS (SELECT CAST(sum(source_size) AS DOUBLE) * CAST(1.5 AS DOUBLE) AS budget, count(*) AS n FROM weighted),
-- the level of a round: what the sources above it leave, by the weights of the others
levels AS (
  SELECT 0 AS k, (SELECT budget FROM shares) / CAST((SELECT sum(w) FROM weighted) AS DOUBLE) AS lvl
  UNION ALL
  SELECT l.k + 1, (any_value(s.budget) - CAST(coalesce(sum(g.cap) FILTER (WHERE g.cap < g.w * l.lvl), 0) AS DOUBLE))
                  / CAST(sum(g.w) FILTER (WHERE g.cap >= g.w * l.lvl) AS DOUBLE)
  FROM levels l, weighted g, shares s WHERE l.k < s.n GROUP BY l.k, l.lvl),
goal AS (SELECT source, rank, source_size, least(CAST(cap AS DOUBLE), w * (SELECT lvl FROM levels ORDER BY k DESC LIMIT 1)) AS target,
                (SELECT budget FROM shares) AS budget FROM weighted),
queued AS (SELECT s.doc_id, s.size, g.rank, g.source_size, g.target, g.budget,
                  CAST(sum(s.size) OVER (PARTITION BY g.rank ORDER BY s.h, s.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum
           FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source),
items AS (SELECT q.*, turn, coalesce(CAST(cum + turn * source_size AS DOUBLE) / CASE WHEN target > 0 THEN target END, 0.0) AS v
          FROM queued q, (VALUES (0), (1)) AS t(turn)),
line AS (SELECT *, sum(size) OVER (ORDER BY v, rank, turn, doc_id) AS filled_to FROM items)
SELECT doc_id, size, source_size, target, CAST(sum(CASE WHEN filled_to <= budget THEN size ELSE 0 END) AS BIGINT) AS taken
FROM line GROUP BY doc_id, size, source_size, target
"""
