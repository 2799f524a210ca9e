"""Suffix-array deduplication: remove every byte of a 400-byte string that occurs twice.

Each 400-byte string is assigned to an anchor in it, the 100 bytes with the
smallest hash, leftmost of equals; equal strings have equal anchors at the same
place.  The strings of one anchor form a segment of the text.  Segments that are
equal throughout are one, with a count; anchors that occur once are done.

The different segments of an anchor are aligned at it, and the suffixes that
start there are sorted.  A stack scan over their common prefix lengths gives the
interval tree: an interval holds all suffixes that share so many bytes to the
right.  Inside an interval the bytes to the left are compared backwards; where
they differ, the interval is a maximal repeat, and its groups name all
occurrences.  A segment's string at offset o before the anchor is repeated if
some interval shares at least 400 - o bytes to the right and another member at
least o to the left.

An anchor with many different segments is not gathered: its strings are counted
one by one instead, which is exact for any number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KeyFilter, blocks, key_filter, row_key, settle
from .hashing import U, join, mix, prefix, spans

LENGTH, GRAM = 400, 100
#: Different segments of an anchor that are gathered in one task; the scan is quadratic in them at worst.
MOST_SEGMENTS = 48
FAR = np.iinfo(np.uint64).max


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from running minima of blocks in both directions."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    rows = -(-len(x) // width)
    padded = np.full(rows * width, FAR, dtype=U)
    padded[: len(x)] = x
    padded = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1: width - 1 + n])


class Segments:
    """Anchored segments of a block of texts.

    Arrays by segment: text number, first and last start of its strings in that
    text, the anchor's place there, hashes of the anchor and of the segment.
    """

    def __init__(self, texts: list[bytes], length: int, gram: int) -> None:
        data, at = join(texts)
        n = len(data) - gram + 1
        self.data, self.at = data, at
        if n <= 0 or len(data) < length:
            self.text = self.lo = self.hi = self.anchor = np.zeros(0, np.int64)
            self.h = self.g = np.zeros(0, np.int64)
            return
        sums = prefix(data, seed=5)
        start = np.arange(n)
        grams = spans(sums, start, start + gram)
        end = np.repeat(at[1:] - 1, np.diff(at))  # end of the own text, by byte
        place = (grams & ~U(0xFFFFFFFF)) | start.astype(U)
        place[start + gram > end[:n]] = FAR
        least = sliding_min(place, length - gram + 1)
        first = np.flatnonzero(np.arange(len(least)) + length <= end[: len(least)])
        anchor = (least[first] & U(0xFFFFFFFF)).astype(np.int64)
        new = np.ones(len(first), dtype=bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (first[1:] != first[:-1] + 1)
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(first)) - 1 if len(head) else head
        lo, hi, anchor = first[head], first[tail], anchor[head]
        self.text = np.searchsorted(at, lo, side="right") - 1
        base = at[self.text]
        self.lo, self.hi, self.anchor = lo - base, hi - base, anchor - base
        self.h = grams[anchor].view(np.int64)
        with np.errstate(over="ignore"):
            self.g = mix(spans(sums, lo, hi + length) + U(3) * (anchor - lo).astype(U)).view(np.int64)


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(*row_key("doc_id", "text"), F.col("text").cast("binary").alias("__text"))


def anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(k1, k2, h, g, width, los): the different segments of every document and where each starts."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in blocks(batches, "__text"):
            s = Segments(texts, length, gram)
            order = np.lexsort((s.lo, s.g, s.h, s.text))
            text, h, g, lo = s.text[order], s.h[order], s.g[order], s.lo[order]
            new = np.ones(len(order), dtype=bool)
            new[1:] = (text[1:] != text[:-1]) | (h[1:] != h[:-1]) | (g[1:] != g[:-1])
            head = np.flatnonzero(new)
            los = pa.ListArray.from_arrays(pa.array(np.append(head, len(order)).astype(np.int32)), pa.array(lo.astype(np.int32)))
            at = pa.array(text[head])
            yield pa.RecordBatch.from_arrays(
                [piece.column("k1").take(at), piece.column("k2").take(at), pa.array(h[head]), pa.array(g[head]),
                 pa.array((s.hi - s.lo)[order][head].astype(np.int32)), los], ["k1", "k2", "h", "g", "width", "los"])

    return keyed(docs).mapInArrow(found, "k1 long, k2 long, h long, g long, width int, los array<int>")


def contexts(docs: DataFrame, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """(h, g, hot, left, right): bytes before and from the anchor of the wanted segments (k1, k2, h, g, lo, hot)."""
    shared = docs.sparkSession.sparkContext.broadcast(key_filter(wanted.withColumn("m", F.col("k1").bitwiseXOR(F.col("h"))), "m"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve: KeyFilter = shared.value
        for piece, texts in blocks(batches, "__text"):
            s = Segments(texts, length, gram)
            k1 = piece.column("k1").to_numpy()[s.text]
            pick = np.flatnonzero(sieve.may_hold(k1 ^ s.h))
            left, right = [], []
            for i in pick:
                t = texts[s.text[i]]
                left.append(t[s.lo[i]: s.anchor[i]])
                right.append(t[s.anchor[i]: s.hi[i] + length])
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1[pick]), piece.column("k2").take(pa.array(s.text[pick])), pa.array(s.h[pick]), pa.array(s.lo[pick].astype(np.int32)),
                 pa.array(left, pa.binary()), pa.array(right, pa.binary())], ["k1", "k2", "h", "lo", "left", "right"])

    rows = keyed(docs).mapInArrow(cut, "k1 long, k2 long, h long, lo int, left binary, right binary")
    # a repeated row gives its segments twice, which are repeats of each other anyway
    return rows.join(wanted, ["k1", "k2", "h", "lo"]).select("h", "g", "hot", "left", "right")


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """Common-prefix intervals (length, first, last) of a sorted list with neighbours' lengths ``lcp``, by a stack scan."""
    stack = [(0, 0)]  # length, first
    for i in range(1, len(lcp) + 2):
        now, first = (lcp[i - 1] if i <= len(lcp) else 0), i - 1
        while stack[-1][0] > now:
            length, first = stack.pop()
            yield length, first, i - 1
        if now > stack[-1][0]:
            stack.append((now, first))


def maximal_repeats(lefts: list[bytes], rights: list[bytes], least: int) -> Iterator[tuple[int, int, list[int]]]:
    """Maximal repeats of at least ``least`` bytes across an anchor, with all occurrences.

    Yields the bytes shared to the left and to the right of the anchor and the
    segment numbers.  The members of a right interval are sorted by their bytes
    to the left, read backwards; an interval there ends where the left
    extensions of its members differ, so each group is maximal to both sides.
    """
    order = sorted(range(len(rights)), key=rights.__getitem__)
    back = [x[::-1] for x in lefts]
    for right, a, b in intervals([common(rights[i], rights[j]) for i, j in zip(order, order[1:])]):
        members = sorted(order[a: b + 1], key=back.__getitem__)
        shared = [common(back[i], back[j]) for i, j in zip(members, members[1:])]
        if right >= least and min(shared) == 0:
            yield 0, right, members  # their left extensions differ at once
        if right + max(shared) >= least:
            for left, x, y in intervals(shared):
                if left + right >= least:
                    yield left, right, members[x: y + 1]


def repeated(lefts: list[bytes], rights: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """Per segment, the inclusive ranges of offsets before the anchor whose strings occur in another segment."""
    out: list[list[tuple[int, int]]] = [[] for _ in lefts]
    for left, right, members in maximal_repeats(lefts, rights, length):
        for i in members:
            out[i].append((max(0, length - right), left))
    return out


def merged(ranges: list[tuple[int, int]], gap: int = 1) -> list[tuple[int, int]]:
    """Union of inclusive ranges; ranges that touch are joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1] + gap:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


RANGES = "h long, g long, ranges array<struct<a: int, b: int>>"
RANGE = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def by_intervals(rows: DataFrame, length: int) -> DataFrame:
    """(h, g, ranges): repeated string starts, relative to the segment's first, of anchors with few segments."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []

        def close() -> tuple[list, list, list]:
            found = repeated([x[2] for x in group], [x[3] for x in group], length)
            h, g, ranges = [], [], []
            for (own, seg, left, _), r in zip(group, found):
                if r:
                    h.append(own)
                    g.append(seg)
                    ranges.append([{"a": len(left) - b, "b": len(left) - a} for a, b in merged(r)])
            return h, g, ranges

        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for row in zip(*[batch.column(c).to_pylist() for c in ("h", "g", "left", "right")]):
                if group and row[0] != group[0][0]:
                    for to, new in zip(out, close()):
                        to += new
                    group = []
                group.append(row)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], RANGE)], ["h", "g", "ranges"])
        last = close() if group else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(last[0], pa.int64()), pa.array(last[1], pa.int64()), pa.array(last[2], RANGE)], ["h", "g", "ranges"])

    laid = rows.select("h", "g", "left", "right").repartition("h").sortWithinPartitions("h", "g")
    return laid.mapInArrow(scan, RANGES)


def by_counts(rows: DataFrame, length: int) -> DataFrame:
    """The same for anchors with any number of segments: every string is hashed and counted."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                data, place = join([a + b for a, b in zip(part.column("left").to_pylist(), part.column("right").to_pylist())])
                n = np.diff(place) - length
                own = np.repeat(np.arange(len(part)), n)
                o = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
                start = place[own] + o
                pair = [pa.array(spans(prefix(data, seed=s), start, start + length).view(np.int64)) for s in (6, 7)]
                take = pa.array(own)
                yield pa.RecordBatch.from_arrays([part.column("h").take(take), part.column("g").take(take), pa.array(o.astype(np.int32)), *pair], ["h", "g", "o", "x", "y"])

    # segments in even shares, whatever files they were read from
    hashed = rows.repartition("h", "g").mapInArrow(strings, "h long, g long, o int, x long, y long")
    twice = hashed.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("x", "y")
    hits = hashed.join(twice, ["x", "y"]).groupBy("h", "g").agg(F.collect_list(F.struct(F.col("o").alias("a"), F.col("o").alias("b"))).alias("ranges"))
    return hits.select("h", "g", "ranges")


def removed_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(k1, k2, spans): byte ranges of repeated strings, unmerged, of every document that has any."""
    all_anchors = settle(anchors(docs, length, gram), "anchors")
    often = all_anchors.groupBy("h").agg(F.sum(F.size("los")).alias("n")).where("n > 1").select("h")
    shared = settle(all_anchors.join(often, "h"), "shared")
    rep = F.min(F.struct("k1", "k2", F.element_at("los", 1).alias("lo")))
    per = settle(shared.groupBy("h", "g").agg(F.sum(F.size("los")).alias("n"), rep.alias("rep"), F.min("width").alias("width")), "segments")
    several = per.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    wanted = per.join(several, "h").select("rep.k1", "rep.k2", "h", "g", "rep.lo", (F.col("m") > MOST_SEGMENTS).alias("hot"))
    texts = settle(contexts(docs, settle(wanted, "wanted"), length, gram), "contexts")
    whole = per.where("n > 1").select("h", "g", F.array(F.struct(F.lit(0).alias("a"), F.col("width").alias("b"))).alias("ranges"))
    marks = whole.union(by_intervals(texts.where("NOT hot"), length)).union(by_counts(texts.where("hot"), length))
    hits = shared.join(marks, ["h", "g"]).select("k1", "k2", F.explode("los").alias("lo"), "ranges")
    spans_ = hits.select("k1", "k2", F.explode(F.transform("ranges", lambda r: F.struct((F.col("lo") + r["a"]).alias("s"), (F.col("lo") + r["b"] + length).alias("e")))).alias("x"))
    return spans_.groupBy("k1", "k2").agg(F.collect_set("x").alias("spans"))


def cut_out(text: bytes, spans_: list) -> tuple[bytes, int, int]:
    """What is left, bytes removed, maximal runs removed."""
    runs = merged([(s["s"], s["e"]) for s in spans_], gap=0)
    kept, at = [], 0
    for s, e in runs:
        kept.append(text[at:s])
        at = e
    kept.append(text[at:])
    return b"".join(kept), sum(e - s for s, e in runs), len(runs)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept of every document, one row per input row.

    Every byte of a ``length``-byte string that also starts anywhere else, in
    the same document or another, is removed; overlaps count and strings are
    judged on the input.  Null is empty; texts under ``length`` bytes lose
    nothing; repeated rows are repeats of each other and lose all they share.
    Other columns are ignored; an empty table gives no rows.
    """
    k1, k2 = row_key("doc_id", "text")
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("__text"), k1.alias("a1"), k2.alias("a2"))
    found = removed_spans(docs, length, gram)
    joined = rows.join(found.hint("shuffle_hash"), (F.col("a1") == F.col("k1")) & (F.col("a2") == F.col("k2")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column("__text").to_pylist()]
            done = [cut_out(t, s or []) for t, s in zip(texts, batch.column("spans").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array([d[1] for d in done], pa.int64()),
                 pa.array([d[2] for d in done], pa.int64()), pa.array([hashlib.sha256(d[0]).hexdigest() for d in done]), pa.array([d[0] for d in done], pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return joined.select("doc_id", "__text", "spans").mapInArrow(cut, schema)
