"""Approximate nearest neighbours over balanced posting lists.

Centroids of a bounded sample cut the vectors into lists.  A vector near a
boundary is replicated to further lists, unless one already chosen lies between.
A query walks a graph over the centroids in memory and reads the lists whose
centroids are not much farther than its nearest.  How many lists that takes is
measured: a sample of the queries is compared with the whole table, and the
reach is set so that the lists read hold ``TARGET`` of the true neighbours.
Lists are dealt out in pieces of bounded size on both sides, so copies of one
vector make many pieces and no large group.  Distances of all members of the
chosen lists are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordering import first_per_key
from .common import fitted, settle

#: Vectors used to fit the centroids, vectors for each list, and most lists.
SAMPLE, PER_LIST, MOST_LISTS = 20_000, 200, 4096
#: A vector goes to at most ``REPLICAS`` lists: those where the plane halfway to the nearest
#: centroid is within ``CLOSE`` halves of the way between the two.
REPLICAS, CLOSE = 4, 0.2
#: A query keeps at least ``BEAM`` centroids and reads at least the lists within ``RATIO`` of the nearest one.
BEAM, RATIO, DEGREE = 96, 1.6, 24
#: Queries compared with the whole table, and the share of their true neighbours in the lists read.
TRIALS, TARGET = 200, 0.95
#: Members and queries that a group holds on average at most.
PIECE = 4096


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2.0 * (x @ y.T), 0.0)


def centroids_of(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means whose assignment pays for crowded lists, so that lists come out alike in size."""
    x = np.unique(x, axis=0)
    if len(x) <= k:
        return x
    rng = np.random.default_rng(5)
    c = x[rng.choice(len(x), k, replace=False)]
    load = np.zeros(k)
    for _ in range(rounds):
        d = squared(x, c)
        to = np.argmin(d + d.min(1).mean() * 0.3 * load[None] / (len(x) / k), axis=1)
        count = np.bincount(to, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, to, x)
        c = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], x[rng.choice(len(x), k)])
        load = count.astype(float)
    return c


def graph_of(c: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """Neighbours of every centroid: the nearest ones, and its two neighbours on a ring that keeps all in reach."""
    k = len(c)
    near = min(degree, k - 1)
    links = np.empty((k, near + 2), dtype=np.int64)
    for start in range(0, k, 512):
        d = squared(c[start: start + 512], c)
        d[np.arange(len(d)), np.arange(start, start + len(d))] = np.inf
        links[start: start + 512, :near] = np.argsort(d, axis=1)[:, :near]
    links[:, near] = (np.arange(k) + 1) % k
    links[:, near + 1] = (np.arange(k) - 1) % k
    return links


def walk(q: np.ndarray, c: np.ndarray, links: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search for a block of queries: nearest centroids found and squared distances, in order.

    Where the search would follow as many links as there are centroids, all are ranked instead.
    """
    n, k = len(q), len(c)
    beam = min(beam, k)
    if beam * links.shape[1] >= k:
        dist = squared(q, c)
        ids = np.argsort(dist, axis=1, kind="stable")[:, :beam]
        return ids, np.take_along_axis(dist, ids, 1)
    row = np.arange(n)[:, None]
    starts = np.unique(np.linspace(0, k - 1, min(k, 8)).astype(np.int64))
    ids = np.broadcast_to(starts, (n, len(starts))).copy()
    dist = squared(q, c[starts])
    seen = np.zeros((n, k), dtype=bool)
    seen[:, starts] = True
    opened = np.zeros(ids.shape, dtype=bool)
    while True:
        pick = np.argmin(np.where(opened, np.inf, dist), axis=1)
        live = ~opened[row[:, 0], pick]
        if not live.any():
            break
        opened[row[:, 0], pick] = True
        next_ids = links[ids[row[:, 0], pick]]
        fresh = ~seen[row, next_ids] & live[:, None]
        # a neighbour may be listed twice; its first place counts
        for j in range(1, next_ids.shape[1]):
            fresh[:, j] &= ~((next_ids[:, :j] == next_ids[:, j: j + 1]) & fresh[:, :j]).any(1)
        near = ((q[:, None, :] - c[next_ids]) ** 2).sum(2)
        near[~fresh] = np.inf
        seen[np.nonzero(fresh)[0], next_ids[fresh]] = True
        ids, dist = np.concatenate([ids, next_ids], 1), np.concatenate([dist, near], 1)
        opened = np.concatenate([opened, ~fresh], 1)
        best = np.argsort(dist, axis=1, kind="stable")[:, :beam]
        ids, dist, opened = ids[row, best], dist[row, best], opened[row, best]
    return ids, dist


def lists_of(d: np.ndarray, between: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest lists of vectors from their squared distances ``d`` to the centroids, and which of them hold the vector.

    For two centroids the difference of the squared distances over the squared
    gap is 0 on the plane halfway and 1 at the nearer centroid, whatever lies
    across; so it is measured against the gap and not against the distance.
    """
    order = np.argsort(d, axis=1)[:, : 4 * REPLICAS]
    close = np.take_along_axis(d, order, 1)
    chosen = np.zeros(order.shape, dtype=bool)
    chosen[:, 0] = True
    for j in range(1, order.shape[1]):
        gap = between[order[:, 0], order[:, j]]
        shadowed = (chosen[:, 1:j] & (between[order[:, 1:j], order[:, j: j + 1]] < gap[:, None])).any(1)
        chosen[:, j] = (close[:, j] - close[:, 0] <= CLOSE * gap) & ~shadowed & (chosen[:, :j].sum(1) < REPLICAS)
    return order, chosen


def reach(places: np.ndarray, margins: np.ndarray, target: float = TARGET) -> tuple[int, float]:
    """Lists to keep and squared distance beyond the nearest centroid's to read, from the place
    and margin of the first list that holds each true neighbour.  Each bound may lose half of what
    the target allows, so both together keep the target on the sample."""
    if not len(places):
        return 0, 0.0
    last = min(len(places) - 1, int(np.ceil((1 + target) / 2 * len(places))) - 1)
    return int(np.sort(places)[last]) + 1, float(np.sort(margins)[last])


def vectors(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def usable(df: DataFrame, ident: str, vector: str) -> DataFrame:
    """(id, v) of the rows that take part: id not null, vector of the commonest length, finite, not zero."""
    v = F.col(vector).cast("array<double>")
    ok = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = df.where(F.col(ident).isNotNull() & ok).select(F.col(ident).cast("long").alias("id"), F.col(vector).alias("v"))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (common.n if common else 0))


def calibrated(q: np.ndarray, held: list[tuple[int, list[int]]], c: np.ndarray, links: np.ndarray, target: float = TARGET) -> tuple[int, float]:
    """Centroids a query's walk keeps and squared distance beyond the nearest one's that it reads.

    ``held`` names, for each true neighbour of a query (its row in ``q``), the
    lists that hold it.  The walk that queries take is tried with ever more
    centroids kept until it meets a list of enough of the neighbours; where it
    would follow as many links as there are centroids it ranks them all.
    """
    if not held:
        return 0, 0.0
    beam = min(BEAM, len(c))
    while True:
        ids, dist = walk(q, c, links, beam)
        places, margins = [], []
        for i, lists in held:
            met = np.flatnonzero(np.isin(ids[i], lists))
            places.append(int(met[0]) if len(met) else len(c))
            margins.append(float(dist[i, met[0]] - dist[i, 0]) if len(met) else np.inf)
        width, margin = reach(np.array(places), np.array(margins), target)
        if width <= beam or beam >= len(c):
            return beam, margin
        beam = min(2 * beam, len(c))


def trial(rows: DataFrame, queries: DataFrame, postings: DataFrame, k: int) -> tuple[np.ndarray, list[tuple[int, list[int]]]]:
    """At most ``TRIALS`` queries, and for each of their true neighbours the query's row and the lists that
    hold the neighbour.  One pass over the table, compared with the sample in memory."""
    spark = rows.sparkSession
    some = queries.orderBy(F.xxhash64("id"), "id").limit(TRIALS).collect()
    if not some:
        return np.zeros((0, 0)), []
    q = np.array([r.v for r in some], dtype=np.float64)
    shared = spark.sparkContext.broadcast((np.array([r.id for r in some]), q))

    def closest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, q = shared.value
        at = np.arange(len(q))[:, None]
        ids, best = np.zeros((len(q), 0), np.int64), np.zeros((len(q), 0))
        for batch in batches:
            for start in range(0, len(batch), 4096):
                part = batch.slice(start, 4096)
                new, first = np.unique(part.column("id").to_numpy(), return_index=True)
                d = squared(q, vectors(part.column("v"))[first])
                d[own[:, None] == new[None]] = np.inf
                ids, best = np.concatenate([ids, np.broadcast_to(new, d.shape)], 1), np.concatenate([best, d], 1)
                top = np.argsort(best, axis=1, kind="stable")[:, :k]
                ids, best = ids[at, top], best[at, top]
        i, j = np.nonzero(np.isfinite(best))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(ids[i, j]), pa.array(best[i, j])], ["q", "id", "d"])

    found = rows.mapInArrow(closest, "q long, id long, d double").groupBy("q", "id").agg(F.min("d").alias("d"))
    true = first_per_key(found, ["q"], [F.col("d"), F.col("id")], k).select("q", "id")
    # at most TRIALS * k pairs
    held = postings.select("list", "id").join(F.broadcast(true), "id").groupBy("q", "id").agg(F.collect_set("list").alias("lists")).collect()
    return q, [(r.q, r.lists) for r in held]


def nearest(df: DataFrame, is_query, k: int = 10, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` nearest found for every query row: query_id, rank, vec_id, score.

    ``is_query`` is a condition on the id column.  Score is the Euclidean
    distance in double precision; nearest first, ties to the smaller id; rows
    that share the query's id are its own.  Rows with a null id, or a vector
    that is null, zero, holds a null or non-finite component or has not the
    commonest length take no part.  Every query gets ``k`` rows, or all
    candidates if fewer.  Where there are more than ``BEAM`` lists, the reach is
    set by a sample of the queries (see ``trial``).  Repeated rows of one id count once.  Other columns are
    ignored; an empty table gives no rows.
    """
    spark = df.sparkSession
    rows = settle(usable(df, ident, vector), "vectors")
    n = rows.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if n == 0:
        return spark.createDataFrame([], schema)
    n_lists = max(1, min(MOST_LISTS, n // PER_LIST))

    def one(table: pa.Table) -> pa.Table:
        c = centroids_of(vectors(table.column("v").combine_chunks()), n_lists)
        return pa.table({"n": pa.array([len(c)], pa.int64()), "c": pa.array([np.ascontiguousarray(c).tobytes()], pa.binary())})

    model = fitted(rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE), one, "n long, c binary")[0]
    c = np.frombuffer(bytes(model.c), dtype=np.float64).reshape(model.n, -1)
    # at most MOST_LISTS centroids and their links
    links = graph_of(c) if len(c) > 1 else np.zeros((1, 1), np.int64)
    shared = spark.sparkContext.broadcast((c, links, squared(c, c)))

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, _, between = shared.value
        for batch in batches:
            for start in range(0, len(batch), 1024):
                part = batch.slice(start, 1024)
                d = squared(vectors(part.column("v")), c)
                order, chosen = lists_of(d, between)
                i, j = np.nonzero(chosen)
                at = pa.array(i)
                yield pa.RecordBatch.from_arrays([pa.array(order[i, j]), pa.array(j == 0), part.column("id").take(at), part.column("v").take(at)], ["list", "own", "id", "v"])

    element = rows.schema["v"].dataType.simpleString()
    postings = settle(rows.mapInArrow(assigned, f"list long, own boolean, id long, v {element}"), "postings")
    # one row per list
    sizes = {r.list: (r.n, r.own) for r in postings.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("own").cast("int")).alias("own")).collect()}
    members = np.array([sizes.get(i, (0, 0))[0] for i in range(len(c))])
    own = np.array([sizes.get(i, (0, 0))[1] for i in range(len(c))])

    queries = rows.where(is_query(F.col("id"))).dropDuplicates(["id"])
    width, margin = calibrated(*trial(rows, queries, postings, k), c, links) if len(c) > BEAM else (0, 0.0)
    width = max(BEAM, width)

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, links, _ = shared.value
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                q = vectors(part.column("v"))
                ids, dist = walk(q, c, links, width)
                # lists are read until k + 1 vectors have their own list among them, whatever the ratio says
                before = np.cumsum(own[ids], axis=1) - own[ids]
                read = (dist <= RATIO**2 * dist[:, :1]) | (dist - dist[:, :1] <= margin) | (before <= k)
                short = np.flatnonzero(own[ids].sum(1) <= k)
                i, j = np.nonzero(read)
                keep = ~np.isin(i, short)
                i, to = i[keep], ids[i[keep], j[keep]]
                i, to = np.concatenate([i, np.repeat(short, len(c))]), np.concatenate([to, np.tile(np.arange(len(c)), len(short))])
                at = pa.array(i)
                yield pa.RecordBatch.from_arrays([pa.array(to.astype(np.int64)), part.column("id").take(at), part.column("v").take(at)], ["list", "id", "v"])

    asked = settle(queries.mapInArrow(routed, f"list long, id long, v {element}"), "asked")
    wanted = {r.list: r.n for r in asked.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = spark.createDataFrame([(i, int(-(-m // PIECE)), -(-wanted.get(i, 0) // PIECE)) for i, m in enumerate(members.tolist()) if m and wanted.get(i)],
                                  "list long, n_sub long, n_ask long")
    parts = F.broadcast(parts)  # one row per list
    sub, ask = F.pmod(F.xxhash64("id"), F.col("n_sub")), F.pmod(F.xxhash64("id"), F.col("n_ask"))

    def every(n_col: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n_col).cast("long") - 1))

    held = postings.join(parts, "list").withColumn("sub", sub.cast("long")).select("list", "sub", every("n_ask").alias("ask"), "id", "v")
    asks = asked.join(parts, "list").withColumn("ask", ask.cast("long")).select("list", every("n_sub").alias("sub"), "ask", "id", "v")

    def search(members: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[list] = [[], [], []]
        if len(members) and len(queries):
            x, q = vectors(members.column("v").combine_chunks()), vectors(queries.column("v").combine_chunks())
            ids = members.column("id").to_numpy()
            rough = squared(q, x)
            slack = 1e-9 * ((q * q).sum(1) + (x * x).sum(1).max())
            for i, query in enumerate(queries.column("id").to_pylist()):
                d = np.where(ids == query, np.inf, rough[i])
                if len(d) > k:
                    near = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1] + slack[i])
                else:
                    near = np.arange(len(d))
                near = near[ids[near] != query]
                exact = np.sqrt(((q[i] - x[near]) ** 2).sum(axis=1))
                best = np.lexsort((ids[near], exact))
                _, first = np.unique(ids[near][best], return_index=True)
                best = best[np.sort(first)][:k]
                found[0] += [query] * len(best)
                found[1] += ids[near][best].tolist()
                found[2] += exact[best].tolist()
        return pa.table({"query_id": pa.array(found[0], pa.int64()), "vec_id": pa.array(found[1], pa.int64()), "score": pa.array(found[2], pa.float64())})

    keys = ["list", "sub", "ask"]
    partial = held.groupBy(*keys).cogroup(asks.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score double")
    distinct = partial.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return first_per_key(distinct, ["query_id"], [F.col("score"), F.col("vec_id")], k, "rank").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
