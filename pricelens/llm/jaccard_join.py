"""Exact set similarity join on word shingles, with set relations used to skip work.

Documents with the same set are one class.  A class posts the first shingles of
its set, rare ones first: two sets of similarity t share one among their first
n - ceil(t n) + 1.  Lists of a shingle are skipped by blocks of set size and by
position, which bound the overlap that is still possible.

Lists with the same classes are one list.  Within a list every class is first
compared with one leader only.  The leader's answers then serve the whole list:
classes linked to it are connected and need no more comparison among themselves,
and the distances to the leader bound the distance of any other two (the Jaccard
distance is a metric).  Only pairs that these answers leave open are compared.

A class carries a signature: one parity bit for each of about n slots its
shingles fall into.  Two signatures differ in no more bits than the sets do in
shingles, so a pair whose signatures differ too much is no link.  Sets, which
are longer than the texts, are fetched for the pairs that pass only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SMALL, KeyFilter, blocks, discard, key_filter, row_key, settle
from .components import components, stars_of
from .hashing import U, combine, join, mix, prefix, spans, words

SHINGLE, PERCENT = 5, 75
#: Counters of the frequency sketch that orders the shingles, and chunks it travels in.
SKETCH_BITS, CHUNK_BITS, FAN_IN = 22, 16, 64
#: A list whose sketch count is over this takes the way for lists of any length.
LIGHT = 10_000
#: Undecided lists up to this length are paired member by member; members of longer ones meet in blocks.
PAIRED, BLOCK = 32, 256
#: Tasks that postings are dealt to, for each shuffle partition of the session.
SPLIT = 4
CLASS_SEEDS = (U(0x5851F42D4C957F2D), U(0x14057B7EF767814F))
SIGNATURE_SEED = U(0x2545F4914F6CDD1D)


def shingle_sets(texts: list[bytes], width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, sorted by (text, hash): (hashes, bounds per text)."""
    data, at = join(texts)
    start, end = words(data)
    doc = np.searchsorted(at, start, side="right") - 1
    word = spans(prefix(data, seed=4, lower=True), start, end)
    full = combine(word, width)
    same = doc[width - 1:] == doc[: len(full)] if len(full) else np.zeros(0, bool)
    owner, hashes = doc[: len(full)][same], full[same]
    count = np.bincount(doc, minlength=len(texts))
    short = np.flatnonzero((count > 0) & (count < width))
    first = np.cumsum(count) - count
    own = np.array([combine(word[first[i]: first[i] + count[i]], int(count[i]))[0] ^ U(count[i]) for i in short], dtype=U)
    owner, hashes = np.concatenate([owner, short]), np.concatenate([hashes, own])
    order = np.argsort(owner, kind="stable")
    owner, hashes = owner[order], hashes[order]
    at = np.searchsorted(owner, np.arange(len(texts) + 1))
    for low, high in zip(at[:-1], at[1:]):
        hashes[low:high].sort()
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    owner, hashes = owner[new], hashes[new]
    return hashes, np.searchsorted(owner, np.arange(len(texts) + 1))


def sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums modulo 2^64 of every stretch."""
    with np.errstate(over="ignore"):
        total = np.zeros(len(values) + 1, dtype=U)
        np.cumsum(values, out=total[1:])
        return total[at[1:]] - total[at[:-1]]


def class_ids(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit id of every set, the same for equal sets in any order."""
    sizes = np.diff(at).astype(U)
    return mix(sums(mix(hashes ^ CLASS_SEEDS[0]), at) ^ mix(sums(mix(hashes ^ CLASS_SEEDS[1]), at) + sizes)).view(np.int64)


def signatures(hashes: np.ndarray, at: np.ndarray) -> pa.ListArray:
    """Parity bits of every set in words of 64; their number is a power of two, n at least, and folds to the one below."""
    n = np.diff(at)
    bits = np.int64(1) << np.ceil(np.log2(np.maximum(n, 64))).astype(np.int64)
    first = np.cumsum(bits) - bits
    owner = np.repeat(np.arange(len(n)), n)
    slot = (mix(hashes ^ SIGNATURE_SEED) & (bits[owner] - 1).astype(U)).astype(np.int64)
    odd = (np.bincount(first[owner] + slot, minlength=int(bits.sum())) & 1).astype(np.uint8)
    words = np.packbits(odd, bitorder="little").view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(bits >> 6)]).astype(np.int32)), pa.array(words))


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", *row_key("doc_id", "text"), F.col("text").cast("binary").alias("__text"))


def surveyed(docs: DataFrame) -> DataFrame:
    """One row per document (doc_id, k1, k2, n, cls, sig), and each task's part of the sketch in chunks."""
    names = ["doc_id", "k1", "k2", "n", "cls", "sig", "chunk", "task", "counts"]
    types = [pa.int64()] * 5 + [pa.list_(pa.int64())] + [pa.int64()] * 2 + [pa.binary()]

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        counts = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        for piece, texts in blocks(batches, "__text", SMALL):
            hashes, at = shingle_sets(texts)
            cell, times = np.unique(hashes >> U(64 - SKETCH_BITS), return_counts=True)
            counts[cell.astype(np.int64)] += times.astype(np.uint32)
            rows = [*[piece.column(c) for c in names[:3]], pa.array(np.diff(at)), pa.array(class_ids(hashes, at)), signatures(hashes, at)]
            yield pa.RecordBatch.from_arrays([*rows, *[pa.nulls(len(texts), t) for t in types[6:]]], names)
        task = TaskContext.get().partitionId()
        for k in range(1 << SKETCH_BITS - CHUNK_BITS):
            part = counts[k << CHUNK_BITS: (k + 1) << CHUNK_BITS]
            if part.any():
                values = [None] * 6 + [k, task, zlib.compress(part.astype(np.int64).tobytes(), 1)]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)

    return settle(keyed(docs).mapInArrow(survey, "doc_id long, k1 long, k2 long, n long, cls long, sig array<long>, chunk long, task long, counts binary"), "survey")


def sketch(parts: DataFrame) -> np.ndarray:
    """Sum of all tasks' sketches: 2^22 counters whatever the input, added up by groups of bounded size."""
    import zlib

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(1 << CHUNK_BITS, dtype=np.int64)
        for raw in table.column("counts").to_pylist():
            total += np.frombuffer(zlib.decompress(raw), dtype=np.int64)
        return pa.table({"chunk": table.column("chunk")[:1], "task": table.column("task")[:1], "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    parts = parts.select("chunk", "task", "counts")
    n_tasks = (parts.agg(F.max("task")).first()[0] or 0) + 1
    while True:
        n_tasks = -(-n_tasks // FAN_IN)
        parts = parts.withColumn("task", F.col("task") % n_tasks).groupBy("chunk", "task").applyInArrow(add, "chunk long, task long, counts binary")
        if n_tasks == 1:
            break
    out = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    for row in parts.collect():  # at most 2^22 counters, compressed
        out[row.chunk << CHUNK_BITS: (row.chunk + 1) << CHUNK_BITS] = np.frombuffer(zlib.decompress(bytes(row.counts)), dtype=np.int64)
    return np.minimum(out, 2**32 - 1).astype(np.uint32)


def postings(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """(token, heavy, cls, n, pos) of the first shingles of every set, rare ones first."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in blocks(batches, "__text", SMALL):
            hashes, at = shingle_sets(texts)
            ids, n = class_ids(hashes, at), np.diff(at)
            # copies within the block post once
            _, one = np.unique(ids, return_index=True)
            use = np.zeros(len(n), dtype=bool)
            use[one] = True
            owner = np.repeat(np.arange(len(n)), n)
            count = shared.value[(hashes >> U(64 - SKETCH_BITS)).astype(np.int64)]
            # hashes of a set are in order, so a stable sort leaves equal counts in it
            order = np.argsort(owner.astype(U) << U(32) | count, kind="stable")
            pos = np.arange(len(hashes)) - at[owner]
            keep = (pos < (n - -(-PERCENT * n // 100) + 1)[owner]) & use[owner]
            h, o = hashes[order][keep], owner[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(count[order][keep] > LIGHT), pa.array(ids[o]), pa.array(n[o].astype(np.int32)), pa.array(pos[keep].astype(np.int32))],
                ["token", "heavy", "cls", "n", "pos"])

    return docs.select(F.col("text").cast("binary").alias("__text")).mapInArrow(post, "token long, heavy boolean, cls long, n int, pos int")


def lists(posts: DataFrame) -> DataFrame:
    """(list, cls, n, pos, leader, leader_n, leader_pos), settled: lists that two classes share, with their leader (its smallest class).

    Shingles with the same classes make one list; a class's position there is
    that of the first of them, which is the same shingle for all its classes.
    """
    head = F.struct("cls", "n", "pos")
    same = F.sum(F.xxhash64("cls").bitwiseAND((1 << 40) - 1))
    # a task holds its rows twice, as distinct ones and in order, so there are more and smaller tasks than elsewhere
    tasks = SPLIT * int(posts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the sketch bounds the lists of one task; the others are spread over the tasks and summed up below
    spread = posts.withColumn("part", F.when(F.col("heavy"), F.col("cls")).otherwise(F.lit(0).cast("long"))).repartition(tasks, "token", "part").distinct()
    own = Window.partitionBy("token", "part")
    found = spread.select("*", F.min(head).over(own).alias("head"), F.max("cls").over(own).alias("last"), same.over(own).alias("same"))
    found = settle(found.where("heavy OR head.cls <> last").drop("part"), "posts")
    heavy = found.where("heavy").select("token", "cls", "n", "pos")
    heads = heavy.groupBy("token").agg(F.min(head).alias("head"), F.max("cls").alias("last"), same.alias("same")).where("head.cls <> last")
    named = found.where("NOT heavy").drop("heavy").unionByName(heavy.join(heads, "token"))
    named = named.withColumn("list", F.xxhash64("head.cls", "last", "same"))
    out = named.groupBy("list", "cls", "n", F.col("head.cls").alias("leader"), F.col("head.n").alias("leader_n")).agg(F.min("pos").alias("pos"), F.min("head.pos").alias("leader_pos"))
    out = settle(out, "lists")
    discard(found)
    return out


def possible(n: Column, pos: Column, m: Column, at: Column) -> Column:
    """Sets of n and m shingles that meet first at these positions can still be similar enough."""
    sizes = 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)
    return sizes & ((100 + PERCENT) * F.least(n - pos, m - at).cast("long") >= PERCENT * (n + m).cast("long"))


def sets_of(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(cls, set), once for each of ``keys`` (k1, k2, cls), whose row keys and classes both are unique."""
    shared = docs.sparkSession.sparkContext.broadcast(key_filter(keys, "k1"))

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted: KeyFilter = shared.value
        for batch in batches:
            batch = batch.filter(pa.array(wanted.may_hold(batch.column("k1").to_numpy())))
            for piece, texts in blocks(iter([batch]), "__text", SMALL):
                hashes, at = shingle_sets(texts)
                sets = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([piece.column("k1"), piece.column("k2"), sets], ["k1", "k2", "set"])

    found = keyed(docs).mapInArrow(shingled, "k1 long, k2 long, set array<long>")
    # repeated rows meet where the join has put them, so they cost no shuffle of their own
    return found.join(keys, ["k1", "k2"]).dropDuplicates(["k1", "k2"]).select("cls", "set")


def differing(one: Column, other: Column) -> Column:
    """Number of bits that differ in two signatures; sizes of linked sets lie so near that one is at most twice as long."""
    def folded(own: Column, size: Column) -> Column:
        halves = F.zip_with(F.slice(own, F.lit(1), size), F.slice(own, size + 1, size), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(own) > size, halves).otherwise(own)

    bits = F.zip_with(folded(one, F.size(other)), folded(other, F.size(one)), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(bits, F.lit(0), lambda total, x: total + x)


def likely(classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the class pairs (a, b), of compatible sizes, that their signatures leave open; no link is lost.

    Sets of n and m shingles are linked if at most (n + m) * (100 - t) / (100 + t) are in one of them only.
    """
    left, right = (classes.select(F.col("cls").alias(c), F.col("n").alias(f"n{c}"), F.col("sig").alias(f"g{c}")) for c in "ab")
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    return both.where((100 + PERCENT) * differing(F.col("ga"), F.col("gb")).cast("long") <= (100 - PERCENT) * (F.col("na") + F.col("nb"))).select("a", "b")


def fetched(docs: DataFrame, classes: DataFrame, cls: DataFrame) -> DataFrame:
    """(cls, set) of the classes in ``cls``, settled."""
    keys = settle(cls.select("cls").distinct().join(classes, "cls").select("k1", "k2", "cls"), "wanted")
    sets = settle(sets_of(docs, keys), "sets")
    discard(keys)
    return sets


def compared(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, common, either), settled: sizes of intersection and union of the sets of distinct class pairs.

    Pairs that cannot be linked by their signatures are left out.
    """
    near = settle(likely(classes, pairs), "near")
    sets = fetched(docs, classes, near.select(F.explode(F.array("a", "b")).alias("cls")))
    left, right = sets.select(F.col("cls").alias("a"), F.col("set").alias("sa")), sets.select(F.col("cls").alias("b"), F.col("set").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    out = settle(near.join(left, "a").join(right, "b").select("a", "b", common.alias("common"), (F.size("sa") + F.size("sb") - common).alias("either")), "answers")
    discard(near, sets)
    return out


def overlaps(one: np.ndarray, rows: np.ndarray, n_rows: int, left: np.ndarray, right: np.ndarray, step: int = 4096) -> np.ndarray:
    """Intersection sizes of the sets of ``left`` rows with those of ``right`` rows; entries are (row, shingle number)."""
    out = np.zeros((len(left), len(right)))
    order = np.argsort(one, kind="stable")
    one, rows = one[order], rows[order]
    last = int(one[-1]) + 1 if len(one) else 0
    for start in range(0, last, step):
        a, b = np.searchsorted(one, [start, start + step])
        cells = np.zeros((n_rows, step), dtype=np.float32)
        cells[rows[a:b], one[a:b] - start] = 1
        out += cells[left] @ cells[right].T
    return out


def block_links(sets: DataFrame, members: DataFrame) -> DataFrame:
    """Links (a, b) that connect different roots among the members (leader, cls, root) of each leader.

    Members are dealt to blocks of bounded size and every two blocks meet in one
    task; a task returns a spanning set of the links between roots, not all.
    """
    sizes = members.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("nb"))
    dealt = members.join(sizes, "leader").withColumn("own", F.pmod(F.xxhash64("cls"), F.col("nb"))).join(sets, "cls")
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb").cast("long") - 1)))

    def compare(table: pa.Table) -> pa.Table:
        cls, root, own = (table.column(c).to_numpy() for c in ("cls", "root", "own"))
        sets = [x.values.to_numpy() for x in table.column("set")]
        n = np.array([len(x) for x in sets])
        values, number, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        rows, many = np.repeat(np.arange(len(n)), n), times[number] > 1
        number = (np.cumsum(times > 1) - 1)[number[many]]
        first = own == own.min()
        left, right = (np.flatnonzero(first), np.flatnonzero(~first)) if not first.all() else (np.arange(len(n)), np.arange(len(n)))
        both = overlaps(number, rows[many], len(n), left, right)
        hit = (100 * both >= PERCENT * (n[left][:, None] + n[right][None] - both)) & (root[left][:, None] != root[right][None])
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        found: list[tuple[int, int]] = []
        for i, j in zip(*np.nonzero(hit)):
            a, b = left[i], right[j]
            x, y = find(int(root[a])), find(int(root[b]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                found.append((int(cls[a]), int(cls[b])))
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    keyed_ = dealt.select("leader", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cls", "root", "set")
    return keyed_.groupBy("leader", "i", "j").applyInArrow(compare, "a long, b long")


def linked() -> Column:
    return 100 * F.col("common") >= PERCENT * F.col("either")


def components_of(docs: DataFrame) -> DataFrame:
    """doc_id, k1, k2, n_shingles, cls and root of every row, settled; rows of one root are connected.

    Set of a document: distinct five-word shingles of its lower-cased words; with
    fewer words the whole sequence is one shingle; without words, or with null
    text, the set is empty and links with nothing (cls and root are then null).
    Documents link when 100 * intersection >= 75 * union.
    """
    survey = surveyed(docs)
    rows = survey.where("chunk IS NULL").select("doc_id", "k1", "k2", "n", "cls")
    counts = sketch(survey.where("chunk IS NOT NULL"))
    shared = lists(postings(docs, counts))
    # equal sets have one signature, so it changes nothing in the order
    one = survey.where("chunk IS NULL AND n > 0").groupBy("cls").agg(F.min(F.struct("k1", "k2", "n", "sig")).alias("k")).select("cls", "k.*")
    classes = settle(one.join(shared.select("cls").distinct(), "cls"), "classes")

    def undecided(own: DataFrame) -> DataFrame:
        """Lists of ``own`` whose classes are not all connected, with each class's root."""
        own = own.drop("root").join(rooted.select(F.col("node").alias("cls"), "root"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
        mixed = own.groupBy("list").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("list")
        return own.join(mixed, "list", "left_semi")

    # every class with the leaders of its lists
    met = possible(F.col("n"), F.col("pos"), F.col("leader_n"), F.col("leader_pos")) & (F.col("cls") != F.col("leader"))
    asked = shared.where(met).select(F.col("cls").alias("a"), F.col("leader").alias("b")).distinct()
    answers = compared(docs, classes, asked)
    rooted = components(answers.where(linked()).select("a", "b"))
    distance = answers.select(F.col("a").alias("cls"), F.col("b").alias("leader"), (1 - F.col("common") / F.col("either")).alias("d"))
    open_ = settle(undecided(shared).join(distance, ["cls", "leader"], "left"), "open")

    # a leader may lie at the rim of its group: the class nearest to it is asked too, and the nearest
    # one among those that are still apart from it; one that its signature kept off counts as far
    hub = F.when(met, F.struct(F.coalesce("d", F.lit(1.0)).alias("d"), "cls", "n", "pos", "root"))
    hubs = open_.groupBy("list", "root").agg(F.min(hub).alias("hub"), F.max(F.col("cls") == F.col("leader")).alias("own"))
    hubs = hubs.groupBy("list").agg(F.min("hub").alias("hub"), F.min(F.when(~F.col("own"), F.col("hub"))).alias("apart"))
    hubs = hubs.select("list", F.explode(F.array_compact(F.array_distinct(F.array("hub", "apart")))).alias("hub"))
    asked = open_.join(hubs, "list").where("root <> hub.root").where(possible(F.col("n"), F.col("pos"), F.col("hub.n"), F.col("hub.pos")))
    asked = asked.select(F.greatest("cls", "hub.cls").alias("a"), F.least("cls", "hub.cls").alias("b")).distinct()
    more = compared(docs, classes, asked.join(answers, ["a", "b"], "left_anti"))
    known = [answers, more]
    answers = answers.union(more)
    rooted = components(stars_of(rooted).union(more.where(linked()).select("a", "b")))

    # what these answers leave open; the distances to a list's leader bound the distance of two members
    first, open_ = open_, settle(undecided(open_), "open")
    discard(first, shared)
    long_lists = open_.groupBy("list").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > PAIRED).select("list")
    # long lists: all members of a leader's lists against each other, block by block
    members = settle(open_.join(long_lists, "list", "left_semi").select("leader", "cls", "root").distinct(), "members")
    # short lists: pairs; compatible sizes lie in the same or neighbouring blocks
    block = F.floor(F.log(F.col("n")) / F.log(F.lit(100.0 / PERCENT)))
    left = open_.join(long_lists, "list", "left_anti").where("cls <> leader").select("list", "cls", "n", "pos", "root", "d", block.alias("block"))
    right = left.select("list", *[F.col(c).alias(f"{c}_") for c in ("cls", "n", "pos", "root", "d")], F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1)).alias("block"))
    gap = F.coalesce(F.abs(F.col("d") - F.col("d_")), F.lit(0.0))
    pairs = left.join(right, ["list", "block"]).where("cls < cls_ AND root <> root_").where(possible(F.col("n"), F.col("pos"), F.col("n_"), F.col("pos_")))
    pairs = pairs.where(gap <= 1 - PERCENT / 100 + 1e-9).select(F.col("cls_").alias("a"), F.col("cls").alias("b")).distinct()
    short = compared(docs, classes, pairs.join(answers, ["a", "b"], "left_anti"))
    known.append(short)
    links = stars_of(rooted).union(short.where(linked()).select("a", "b"))
    if not members.isEmpty():
        sets = fetched(docs, classes, members)
        known.append(sets)
        links = links.union(block_links(sets, members))
    rooted = components(links)
    discard(classes, open_, members, *known)
    out = rows.join(rooted, F.col("cls") == F.col("node"), "left")
    some = F.col("n") > 0
    out = out.select("doc_id", "k1", "k2", F.col("n").alias("n_shingles"), F.when(some, F.col("cls")).alias("cls"), F.when(some, F.coalesce("root", "cls")).alias("root"))
    out = settle(out, "rooted")
    discard(survey)
    return out


def jaccard_join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document, one row per input row.

    component_id is the smallest doc_id reachable by links, the row's own
    included; a null id never is one unless no other is in reach.  Repeated rows
    are linked with each other, other columns are ignored, an empty table gives
    no rows.
    """
    rows = components_of(docs)
    least = rows.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    joined = rows.join(least, "root", "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each component stays (smallest id, null last), all columns unchanged.

    Documents with an empty set are not linked and all stay.
    """
    rows = components_of(docs)
    best = rows.where("root IS NOT NULL").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "k1", "k2")).alias("w"))
    stay = best.select(F.col("w.k1").alias("__w1"), F.col("w.k2").alias("__w2"))
    empty = rows.where("root IS NULL").select("k1", "k2").distinct()
    cols = docs.columns
    k1, k2 = row_key("doc_id", "text")
    own = docs.withColumns({"__k1": k1, "__k2": k2})
    kept = own.join(stay.hint("shuffle_hash"), (F.col("__k1") == F.col("__w1")) & (F.col("__k2") == F.col("__w2")), "left_semi")
    wordless = own.join(empty.select(F.col("k1").alias("__w1"), F.col("k2").alias("__w2")).hint("shuffle_hash"), (F.col("__k1") == F.col("__w1")) & (F.col("__k2") == F.col("__w2")), "left_semi")
    return kept.dropDuplicates(["__k1", "__k2"]).select(*cols).union(wordless.select(*cols))
