"""URL filters with a Bloom filter cascade.

The listed keys go into a first Bloom filter.  The other keys of the corpus that
pass it are its false positives; they go into a second filter, the listed keys
that pass that one into a third, and so on until none is left.  Over the whole
key universe the first filter that a key fails tells exactly on which side it
is, so pages are judged by a few bit tests and no join with the list.

Keys are dealt to shards by hash, and every shard has its own cascade, built in
one task from a bounded number of keys.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle, without
from .hashing import U, mix

#: Keys a shard holds on average.
SHARD_KEYS = 200_000
#: Bytes of filters that one pass broadcasts; more shards take more passes.
PASS_BYTES = 64 << 20
#: Filters of a cascade; about two keys in three leave at each.
LEVELS = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Applies to a host and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    return F.when(F.instr(url, "://") > 0, F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)).otherwise("")


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end; empty without ://."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def rule_of(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    picked = F.lit(None).cast("struct<rule: string, verdict: string>")
    for r in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        picked = F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(picked)
    return picked


def key_hashes(key: Column) -> list[Column]:
    return [F.xxhash64(F.lit(11), key).alias("a"), F.xxhash64(F.lit(12), key).alias("b")]


def slots(a: np.ndarray, b: np.ndarray, level, n_hash: int, n_bits) -> Iterator[np.ndarray]:
    """Bit positions of keys at a level (level and size may be arrays)."""
    with np.errstate(over="ignore"):
        seed = mix(a + np.asarray(level, dtype=U) * U(0x9E3779B97F4A7C15))
        for i in range(n_hash):
            yield (mix(seed + U(i) * (b | U(1))) % np.asarray(n_bits, dtype=U)).astype(np.int64)


def cascade(a: np.ndarray, b: np.ndarray, listed: np.ndarray) -> list[tuple[int, int, bytes]]:
    """(hashes, bits, filter) of every level for the keys of one shard."""
    inside, outside = (a[listed], b[listed]), (a[~listed], b[~listed])
    out: list[tuple[int, int, bytes]] = []
    while len(inside[0]) and len(out) < LEVELS:
        share = 0.5 if out else min(0.5, len(inside[0]) / (1.5 * max(1, len(outside[0]))))
        n_hash = max(1, round(-np.log2(share)))
        n_bits = max(64, int(np.ceil(len(inside[0]) * n_hash * 1.4427)))
        bits = np.zeros(n_bits, dtype=bool)
        for at in slots(*inside, len(out), n_hash, n_bits):
            bits[at] = True
        passed = np.ones(len(outside[0]), dtype=bool)
        for at in slots(*outside, len(out), n_hash, n_bits):
            passed &= bits[at]
        out.append((n_hash, n_bits, np.packbits(bits).tobytes()))
        inside, outside = tuple(x[passed] for x in outside), inside
    if len(inside[0]):
        raise ValueError("a listed and an unlisted key share a 128-bit hash")
    return out


def build(universe: DataFrame, listed: DataFrame, key: str) -> tuple[DataFrame, int]:
    """Cascades of all shards (shard, level, n_hash, n_bits, bits), settled, and the number of shards.

    Both tables hold keys in column ``key``; repeats and nulls do not matter.
    """
    marks = universe.select(key, F.lit(0).alias("y")).union(listed.select(key, F.lit(1).alias("y"))).where(F.col(key).isNotNull())
    keys = settle(marks.groupBy(key).agg(F.max("y").alias("y")).select(*key_hashes(F.col(key)), "y"), "keys")
    n_shards = max(1, -(-keys.count() // SHARD_KEYS))

    def one(table: pa.Table) -> pa.Table:
        a, b = (table.column(c).to_numpy().view(U) for c in ("a", "b"))
        levels = cascade(a, b, table.column("y").to_numpy() == 1)
        shard = table.column("shard")[0].as_py()
        return pa.table({"shard": pa.array([shard] * len(levels), pa.int64()), "level": pa.array(range(len(levels)), pa.int32()),
                         "n_hash": pa.array([x[0] for x in levels], pa.int32()), "n_bits": pa.array([x[1] for x in levels], pa.int64()),
                         "bits": pa.array([x[2] for x in levels], pa.binary())})

    dealt = keys.withColumn("shard", F.pmod("a", F.lit(n_shards)))
    return settle(dealt.groupBy("shard").applyInArrow(one, "shard long, level int, n_hash int, n_bits long, bits binary"), "cascades"), n_shards


class Probe:
    """Filters of a range of shards, laid out as one bit array."""

    def __init__(self, rows: list, first: int, last: int) -> None:
        depth = max((r.level + 1 for r in rows), default=0)
        shape = (last - first + 1, depth)
        self.first, self.n_hash, self.n_bits, self.base = first, np.zeros(shape, int), np.ones(shape, int), np.zeros(shape, int)
        parts, at = [], 0
        for r in rows:
            where = (r.shard - first, r.level)
            self.n_hash[where], self.n_bits[where], self.base[where] = r.n_hash, r.n_bits, at
            parts.append(np.frombuffer(bytes(r.bits), dtype=np.uint8))
            at += 8 * len(parts[-1])
        self.bits = np.concatenate(parts) if parts else np.zeros(0, np.uint8)

    def listed(self, a: np.ndarray, b: np.ndarray, shard: np.ndarray) -> np.ndarray:
        """True where the first filter that a key fails is one of false positives."""
        alive, result, row = np.arange(len(a)), np.zeros(len(a), dtype=bool), shard - self.first
        for level in range(self.n_hash.shape[1]):
            n_hash = self.n_hash[row[alive], level]
            # behind the last filter of its shard a key stays on the side it passed to
            result[alive[n_hash == 0]] = level % 2 == 1
            alive = alive[n_hash > 0]
            n_hash = self.n_hash[row[alive], level]
            n_bits, base, passed = self.n_bits[row[alive], level], self.base[row[alive], level], np.ones(len(alive), dtype=bool)
            for i, at in enumerate(slots(a[alive], b[alive], level, int(n_hash.max(initial=0)), n_bits)):
                at = at + base
                passed &= (self.bits[at >> 3] >> (7 - (at & 7)) & 1).astype(bool) | (i >= n_hash)
            result[alive[~passed]] = level % 2 == 1
            alive = alive[passed]
        result[alive] = self.n_hash.shape[1] % 2 == 1
        return result


def mark_listed(df: DataFrame, key: str, cascades: DataFrame, n_shards: int, name: str = "listed") -> DataFrame:
    """Add whether the key is listed; exact for keys of the universe, false for a null key.

    One pass broadcasts at most about ``PASS_BYTES`` of filters.  With more, each
    range of shards is a pass over its own rows, written before the next begins.
    """
    sizes = cascades.groupBy("shard").agg(F.sum(F.length("bits")).alias("n")).groupBy(F.floor(F.col("shard") / 64).alias("g"))
    groups = sizes.agg(F.sum("n").alias("n")).orderBy("g").collect()  # a number for each 64 shards
    ranges, room = [[0, n_shards - 1]], PASS_BYTES
    for g in groups:
        if g.n > room and g.g > 0:
            ranges[-1][1] = g.g * 64 - 1
            ranges.append([g.g * 64, n_shards - 1])
            room = PASS_BYTES
        room -= g.n
    cols = df.columns
    keyed = df.withColumns({"__a": key_hashes(F.col(key))[0], "__b": key_hashes(F.col(key))[1]}).withColumn("__s", F.pmod("__a", F.lit(n_shards)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + f", `{name}` boolean"
    done = []
    for first, last in ranges:
        rows = cascades.where(F.col("shard").between(first, last)).collect()
        shared = df.sparkSession.sparkContext.broadcast(Probe(rows, first, last))

        def probe(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                a, b = (batch.column(c).to_numpy(zero_copy_only=False).view(U) for c in ("__a", "__b"))
                found = shared.value.listed(a, b, batch.column("__s").to_numpy(zero_copy_only=False))
                found &= batch.column(key).is_valid().to_numpy(zero_copy_only=False)
                arrays, names = without(batch, "__a", "__b", "__s")
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(found)], [*names, name])

        part = keyed if len(ranges) == 1 else keyed.where(F.col("__s").between(first, last))
        part = part.mapInArrow(probe, schema)
        if len(ranges) > 1:
            part = settle(part, "judged")
            shared.destroy()
        done.append(part)
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    return out.select(*cols, name)


def url_filter(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule], ids: Sequence[str] = ("page_id",), url: str = "url") -> DataFrame:
    """``ids``, host, path, rule and verdict of every page, one row per input row.

    The longest fitting rule decides; a page without one is blocked if its host
    is in ``listed`` (column host), else allowed.  A null url or one without ://
    has an empty host and path and no rule.  Repeated rows are judged alike,
    other columns are ignored, an empty table gives no rows.
    """
    split = pages.select(*ids, host_of(F.coalesce(url, F.lit(""))).alias("host"), path_of(F.coalesce(url, F.lit(""))).alias("path"))
    cascades, n_shards = build(split.select("host"), listed.select("host"), "host")
    marked = mark_listed(split, "host", cascades, n_shards)
    judged = marked.withColumn("__r", rule_of(rules, F.col("host"), F.col("path")))
    verdict = F.coalesce(F.col("__r.verdict"), F.when(F.col("listed"), "block").otherwise("allow"))
    return judged.select(*ids, "host", "path", F.col("__r.rule").alias("rule"), verdict.alias("verdict"))


def tracked_hosts(pages: DataFrame, url: str = "url") -> DataFrame:
    """Hosts at least half of whose page urls carry a tracking parameter."""
    host = host_of(F.coalesce(url, F.lit("")))
    tracked = F.sum(F.when(F.contains(F.col(url), F.lit("utm_source=")), 1).otherwise(0))
    per = pages.groupBy(host.alias("host")).agg(tracked.alias("t"), F.count(F.lit(1)).alias("n"))
    return per.where("host <> '' AND 2 * t >= n").select("host")


RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
         Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))

URL_SQL = r"""
WITH cut AS (
  SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
listed AS (
  SELECT host FROM split WHERE host <> '' GROUP BY host
  HAVING 2 * sum(CASE WHEN contains(url, 'utm_source=') THEN 1 ELSE 0 END) >= count(*)),
rules AS (SELECT * FROM (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                                ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) AS r(verdict, rhost, rpath)),
best AS (
  SELECT page_id, url, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(verdict, length(rhost || rpath)) AS verdict
  FROM (SELECT DISTINCT page_id, url, host, path FROM split) s JOIN rules
    ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id, url)
SELECT s.page_id, s.host, s.path, b.rule,
       coalesce(b.verdict, CASE WHEN l.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM split s LEFT JOIN best b ON s.page_id IS NOT DISTINCT FROM b.page_id AND s.url IS NOT DISTINCT FROM b.url
LEFT JOIN listed l ON s.host = l.host
"""
