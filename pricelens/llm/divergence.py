"""How far the sources of a language differ in their words, and in which.

The first pass counts in how many documents of its language each term occurs;
terms below the threshold go.  The kept terms of a language are dealt into
shards of a few thousand, and a minimal perfect hash is built for each shard in
a task of its own.  The second pass reads the documents again with the hashes of
as many shards as a fixed number of bytes holds and adds to dense arrays, one
slot per term, for every source met; a stored key tells kept terms from others.
Arrays are summed by source and shard, and both results are read off them shard
by shard.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settle
from .perfect_hash import build, unpacked

MIN_DOCS = 30
TOP = 50
SMOOTH = 5
SCALE_DIGITS = 9
#: Terms a shard holds on average.
SHARD_TERMS = 2048
#: Bytes of hashes and stored keys that one pass broadcasts.
PASS_BYTES = 64 << 20
#: Entries of a counting dictionary and slots of arrays that a task holds before it passes them on.
MOST_ENTRIES = 400_000
MOST_SLOTS = 4_000_000
#: Arrays that meet in one stream of the first sum.
SALTS = 16
#: Bytes of terms, lower-cased: code points other than ASCII letters below 128 are gaps.
TERM_BYTES = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Seed of Spark's xxhash64, by which terms are dealt into shards.
DEALING = 42


def terms(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters and code points from 128 on, A-Z lower-cased."""
    return (text or b"").translate(TERM_BYTES).split()


def grouped(docs: DataFrame) -> DataFrame:
    """lang, source and text as binary; null as empty."""
    return docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")], F.col("text").cast("binary").alias("text"))


def kept_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term as binary): terms in at least ``min_docs`` documents of the language."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = defaultdict(Counter)

        def emit() -> Iterator[pa.RecordBatch]:
            for lang, per in found.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(per), pa.string()), pa.array(list(per), pa.binary()), pa.array(list(per.values()), pa.int64())], ["lang", "term", "n"])
            found.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                found[lang].update(set(terms(text.as_py())))
                if sum(map(len, found.values())) > MOST_ENTRIES:
                    yield from emit()
        yield from emit()

    per = docs.select("lang", "text").mapInArrow(counted, "lang string, term binary, n long").groupBy("lang", "term").agg(F.sum("n").alias("n"))
    return per.where(F.col("n") >= min_docs).select("lang", "term")


def dealt(term: bytes, n_shards: int) -> int:
    """The shard of a term: pmod(xxhash64(term), n_shards) of Spark, which reads the hash as signed."""
    h = xxhash.xxh64_intdigest(term, DEALING)
    return (h - (h >> 63 << 64)) % n_shards


def sharded(kept: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(lang, shard, n_slots, blob): a perfect hash for every shard of a language's terms."""
    placed = kept.join(vocabulary, "lang").select("lang", F.pmod(F.xxhash64("term"), "n_shards").alias("shard"), "term")

    def hashed(key: tuple, table: pa.Table) -> pa.Table:
        blob = build(sorted(table.column("term").to_pylist())).packed()
        return pa.table({"lang": pa.array([key[0].as_py()], pa.string()), "shard": pa.array([key[1].as_py()], pa.int64()), "n_slots": pa.array([len(table)], pa.int64()), "blob": pa.array([blob], pa.binary())})

    # shards are small and take long, so run-time coalescing by bytes would put them into one task
    spread = placed.repartition(int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions")), "lang", "shard")
    return spread.groupBy("lang", "shard").applyInArrow(hashed, "lang string, shard long, n_slots long, blob binary")


def packed(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.astype("<i8").tobytes(), 1)


def unpack(blob: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(blob), dtype="<i8")


COUNTS = "lang string, source string, shard long, part long, n long, counts binary"


def recounted(docs: DataFrame, hashes: DataFrame, n_shards: dict[str, int]) -> DataFrame:
    """Arrays of counts per source and shard, several of each, for the shards of ``hashes``.

    The hashes are broadcast; the caller bounds their bytes.
    """
    rows = hashes.select("lang", "shard", "blob").collect()
    shared = docs.sparkSession.sparkContext.broadcast(({(r.lang, r.shard): bytes(r.blob) for r in rows}, n_shards))

    def counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs, shards = shared.value
        opened = {key: unpacked(blob) for key, blob in blobs.items()}
        slots: dict[tuple, np.ndarray] = {}
        words: dict[tuple, Counter] = defaultdict(Counter)
        waiting = held = part = 0

        def emit() -> Iterator[pa.RecordBatch]:
            nonlocal held, part
            keys = list(slots)
            for i in range(0, len(keys), 1000):
                some = keys[i: i + 1000]
                yield arrays([(*k, part % SALTS, slots[k]) for k in some])
                part += 1
            slots.clear()
            held = 0

        def place() -> Iterator[pa.RecordBatch]:
            nonlocal held
            places: dict[str, dict[bytes, tuple[int, int]]] = defaultdict(dict)  # a term of several sources is looked up once
            for (lang, source), per in words.items():
                found = places[lang]
                for term, n in per.items():
                    if term not in found:
                        shard = dealt(term, shards[lang])
                        known = opened.get((lang, shard))
                        found[term] = shard, -1 if known is None else known.slot(term)
                    shard, at = found[term]
                    if at >= 0:
                        counts = slots.get((lang, source, shard))
                        if counts is None:
                            counts = slots[lang, source, shard] = np.zeros(len(opened[lang, shard]), dtype=np.int64)
                            held += len(counts)
                        counts[at] += n
                if held > MOST_SLOTS:
                    yield from emit()
            words.clear()

        for batch in batches:
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text")):
                if lang not in shards:
                    continue
                per = words[lang, source]
                before = len(per)
                per.update(terms(text.as_py()))
                waiting += len(per) - before
                if waiting > MOST_ENTRIES:
                    yield from place()
                    waiting = 0
        yield from place()
        yield from emit()

    return docs.mapInArrow(counting, COUNTS)


def arrays(rows: list[tuple]) -> pa.RecordBatch:
    """A batch of COUNTS from (lang, source, shard, part, array)."""
    cols = [[r[i] for r in rows] for i in range(4)] + [[int(r[4].sum()) for r in rows], [packed(r[4]) for r in rows]]
    types = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["lang", "source", "shard", "part", "n", "counts"])


def summed(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Sum arrays of equal keys in a sorted stream, one array held at a time."""

    def adding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        done: list[tuple] = []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("lang", "source", "shard", "part")]
            for key, blob in zip(zip(*cols), batch.column("counts")):
                key = key if "part" in keys else (*key[:3], 0)
                if key == now:
                    total += unpack(blob.as_py())
                    continue
                if now is not None:
                    done.append((*now, total))
                    if len(done) >= 500:
                        yield arrays(done)
                        done = []
                now, total = key, unpack(blob.as_py()).copy()
        if now is not None:
            yield arrays([*done, (*now, total)])

    return parts.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(adding, COUNTS)


def share(counts: np.ndarray, total: int, n_terms: int) -> np.ndarray:
    """1 + floor(10^9 (count + 5) / (total + 5 n_terms)), digit by digit, exact for totals up to 9 * 10^17."""
    whole = total + SMOOTH * n_terms
    rest, out = counts + SMOOTH, np.zeros(len(counts), dtype=np.int64)
    for _ in range(SCALE_DIGITS):
        # count + 5 is at most the whole, so every rest fits ten times
        rest = rest * 10
        out = out * 10 + rest // whole
        rest = rest % whole
    return out + 1


def compared(grid: DataFrame, hashes: DataFrame, top: int) -> DataFrame:
    """From every shard: parts of the distances of its sources, and each source's leading terms.

    ``grid`` holds a row for every group and shard of its language: lang,
    source, shard, counts (null: all 0), n (of the source), n_lang, v.
    """
    schema = "lang string, source string, part string, item string, value long"

    def one(key: tuple, table: pa.Table, hashed: pa.Table) -> pa.Table:
        lang = key[0].as_py()
        known = unpacked(hashed.column("blob")[0].as_py())
        table = table.sort_by("source")  # a pair is named the same way round in every shard, however its rows arrive
        sources, totals = table.column("source").to_pylist(), table.column("n").to_pylist()
        n_lang, v = table.column("n_lang")[0].as_py(), table.column("v")[0].as_py()
        counts = np.zeros((len(sources), len(known)), dtype=np.int64)
        for i, blob in enumerate(table.column("counts")):
            if blob.is_valid:
                counts[i] = unpack(blob.as_py())
        p = np.stack([share(c, n, v) for c, n in zip(counts, totals)])
        q = share(counts.sum(axis=0), n_lang, v)
        out: list[tuple] = []
        for i, source in enumerate(sources):
            for j, far in enumerate(np.abs(p[i + 1:] - p[i]).sum(axis=1).tolist(), i + 1):
                out.append((lang, source, "pair", sources[j], far))
            ahead = np.flatnonzero((counts[i] > 0) & (p[i] > q))
            best = sorted((int(q[k]) - int(p[i][k]), known.key(k)) for k in ahead.tolist())[:top]
            out += [(lang, source, "term", term.decode(), -f) for f, term in best]
        cols = [[r[i] for r in out] for i in range(5)]
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.string(),) * 4 + (pa.int64(),))], names=["lang", "source", "part", "item", "value"])

    own = hashes.select(F.col("lang").alias("h_lang"), F.col("shard").alias("h_shard"), "blob")
    return grid.groupBy("lang", "shard").cogroup(own.groupBy("h_lang", "h_shard")).applyInArrow(one, schema)


def passes(sizes: list[tuple[str, int, int]], most: int) -> list[list[tuple[str, int]]]:
    """Shards (lang, shard, bytes) in runs of at most ``most`` bytes; a larger shard is a run of its own."""
    runs: list[list[tuple[str, int]]] = []
    room = 0
    for lang, shard, size in sizes:
        if not runs or size > room:
            runs.append([])
            room = most
        runs[-1].append((lang, shard))
        room -= size
    return runs


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank for every source of every language.

    ``pair``: the other sources of the language, farthest first, by the sum of
    |p - q| over the language's kept terms.  ``term``: at most ``top`` kept terms
    that the source uses more than its language does.  p = 1 + floor(10^9 (count
    + 5) / (N + 5 V)) with V the kept terms and N their occurrences in the group.

    A null lang, source or text is empty; an empty language or source is a group
    like any other.  Groups without terms keep their pairs; a language without
    kept terms has distance 0 throughout.  Equal values go by item in UTF-8
    order.  Every row counts as a document, repeated ids too; other columns are
    ignored; an empty table gives no rows.
    """
    slim = grouped(docs)
    groups = settle(slim.select("lang", "source").distinct(), "groups")
    kept = settle(kept_terms(slim, min_docs), "terms")
    vocabulary = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v")).withColumn("n_shards", F.ceil(F.col("v") / SHARD_TERMS).cast("long"))
    hashes = settle(sharded(kept, vocabulary), "hashes")
    # a small row for every few thousand kept terms, and for every language with one
    sizes = [tuple(r) for r in hashes.select("lang", "shard", F.octet_length("blob")).orderBy("lang", "shard").collect()]
    n_shards = {r.lang: r.n_shards for r in vocabulary.collect()}
    counts = docs.sparkSession.createDataFrame([], COUNTS)
    for run in passes(sizes, PASS_BYTES):
        wanted = docs.sparkSession.createDataFrame(run, "lang string, shard long")
        some = recounted(slim, hashes.join(F.broadcast(wanted), ["lang", "shard"]), n_shards)
        counts = counts.union(settle(summed(summed(some, ["lang", "source", "shard", "part"]), ["lang", "source", "shard"]), "counts"))
    per = counts.select("lang", "source", "shard", F.col("n").alias("n_shard"), "counts")
    n = per.groupBy("lang", "source").agg(F.sum("n_shard").alias("n"))
    n_lang = n.groupBy("lang").agg(F.sum("n").alias("n_lang"))
    whole = groups.join(vocabulary.select("lang", "v"), "lang").join(n, ["lang", "source"], "left").join(n_lang, "lang", "left").fillna(0, ["n", "n_lang"])
    grid = whole.join(hashes.select("lang", "shard"), "lang").join(per.drop("n_shard"), ["lang", "source", "shard"], "left")
    found = settle(compared(grid, hashes, top), "found")
    half = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    far = half.union(half.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    # the result has a row for every two sources of a language
    others = groups.join(groups.withColumnRenamed("source", "item"), "lang").where("source <> item")
    pairs = others.join(far, ["lang", "source", "item"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item"))
    leading = found.where("part = 'term'").withColumn("rank", rank).where(F.col("rank") <= top)
    return pairs.withColumn("rank", rank).unionByName(leading)


DIVERGENCE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
tokens AS (
  SELECT id, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
kept AS (SELECT lang, term FROM tokens GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
seen AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM tokens t JOIN kept k ON t.lang = k.lang AND t.term = k.term GROUP BY ALL),
dense AS (SELECT g.lang, g.source, k.term, coalesce(s.n, 0) AS n FROM groups g JOIN kept k ON g.lang = k.lang
          LEFT JOIN seen s ON s.lang = g.lang AND s.source = g.source AND s.term = k.term),
p AS (SELECT e.lang, e.source, e.term, e.n,
             1 + (CAST(1000000000 AS HUGEINT) * (e.n + 5)) // (sum(e.n) OVER (PARTITION BY e.lang, e.source) + 5 * v.v) AS p
      FROM dense e JOIN v ON v.lang = e.lang),
per_lang AS (SELECT lang, term, sum(n) AS n FROM dense GROUP BY lang, term),
q AS (SELECT l.lang, l.term, 1 + (CAST(1000000000 AS HUGEINT) * (l.n + 5)) // (sum(l.n) OVER (PARTITION BY l.lang) + 5 * v.v) AS q
      FROM per_lang l JOIN v ON v.lang = l.lang),
far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN far f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
ahead AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, CAST(p.p - q.q AS BIGINT) AS value
            FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM ahead))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
