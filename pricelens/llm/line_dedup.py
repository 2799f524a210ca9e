"""Line deduplication by sorted line hashes.

Every line's key is hashed; the hashes are range partitioned and sorted by
document, largest id first, and position.  A streamed pass sees a key's
documents one after the other: the first keeps the line, and once there are
enough documents the others lose it.  A key of any weight may reach over several
partitions, so the first and the last key of a partition are left open and are
settled afterwards from counts.  What comes back is a compressed bitmap of kept
lines per document; texts are never shuffled for the decision.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, row_key, settle

MIN_POINTS = 20
MIN_DOCS = 3
BLANKS = SPACES.encode()
NO_ID = -(2**63)  # stands for a null id: it counts as a document and is smaller than any id


def line_key(line: bytes) -> bytes:
    return line.strip(BLANKS).lower()  # bytes.lower changes A-Z only


def hashed_lines(docs: DataFrame, min_points: int) -> DataFrame:
    """(h, g, doc, k1, k2, n_lines, pos) of every line whose key is long enough."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, at, pos, count = [], [], [], []
            for i, text in enumerate(batch.column("__text").to_pylist()):
                lines = (text or b"").split(b"\n")
                for j, line in enumerate(lines):
                    key = line_key(line)
                    if len(key) >= min_points and len(key.decode()) >= min_points:
                        keys.append(hashlib.blake2b(key, digest_size=16).digest())
                        at.append(i)
                        pos.append(j)
                        count.append(len(lines))
            both = np.frombuffer(b"".join(keys), dtype=np.int64).reshape(-1, 2)
            at_ = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()), *[batch.column(c).take(at_) for c in ("doc", "k1", "k2")],
                 pa.array(count, pa.int64()), pa.array(pos, pa.int64())], ["h", "g", "doc", "k1", "k2", "n_lines", "pos"])

    slim = docs.select(F.coalesce("doc_id", F.lit(NO_ID + 1) - 1).cast("long").alias("doc"), *row_key("doc_id", "text"), F.col("text").cast("binary").alias("__text"))
    return slim.mapInArrow(hashed, "h long, g long, doc long, k1 long, k2 long, n_lines long, pos long")


def judged_runs(h: np.ndarray, g: np.ndarray, doc: np.ndarray, min_docs: int) -> np.ndarray:
    """Lost lines among whole runs of equal keys, sorted by document."""
    new_key = np.ones(len(h), dtype=bool)
    new_key[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
    new_doc = new_key.copy()
    new_doc[1:] |= doc[1:] != doc[:-1]
    run = np.cumsum(new_key) - 1
    docs = np.bincount(run[new_doc], minlength=run[-1] + 1 if len(run) else 0)
    first = doc[np.flatnonzero(new_key)]
    return (docs[run] >= min_docs) & (doc != first[run])


def streamed(min_docs: int):
    """One pass over a sorted partition: lost lines, and the lines of its first and last key as open."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: pa.Table | None = None
        first = True

        def emit(rows: pa.Table, keep: np.ndarray | None) -> Iterator[pa.RecordBatch]:
            rows = rows if keep is None else rows.filter(pa.array(keep))
            yield from rows.append_column("open", pa.array(np.full(len(rows), keep is None))).to_batches()

        for batch in batches:
            if not len(batch):
                continue
            rows = pa.Table.from_batches([batch]) if carry is None else pa.concat_tables([carry, pa.Table.from_batches([batch])]).combine_chunks()
            h, g = rows.column("h").to_numpy(), rows.column("g").to_numpy()
            new = np.flatnonzero((h[1:] != h[:-1]) | (g[1:] != g[:-1])) + 1
            if not len(new):
                carry = rows
                continue
            start = 0
            if first:
                yield from emit(rows.slice(0, new[0]), None)
                first, start = False, int(new[0])
            whole = rows.slice(start, int(new[-1]) - start)
            if len(whole):
                yield from emit(whole, judged_runs(*[whole.column(c).to_numpy() for c in ("h", "g", "doc")], min_docs))
            carry = rows.slice(int(new[-1]))
        if carry is not None:
            yield from emit(carry, None)

    return stream


def keep_bitmaps(docs: DataFrame, min_points: int = MIN_POINTS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(k1, k2, n_lines, n_lost, keep) of every document that loses lines.

    ``k1, k2`` is the row's key; ``keep`` is a zlib-compressed bitmap, one bit
    per line, first line in the highest bit.  A document without a row keeps all
    its lines.
    """
    order = [F.col("h"), F.col("g"), F.col("doc").desc(), F.col("k1"), F.col("pos")]
    laid = hashed_lines(docs, min_points).repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "h long, g long, doc long, k1 long, k2 long, n_lines long, pos long, open boolean"
    seen = settle(laid.mapInArrow(streamed(min_docs), schema), "lines")
    lines = seen.where("open")
    # at most two keys of each partition, so the edges are broadcast and the lines of a frequent key stay where they are
    per = lines.groupBy("h", "g", "doc").agg(F.lit(1).alias("one")).groupBy("h", "g").agg(F.count(F.lit(1)).alias("docs"), F.max("doc").alias("last"))
    edges = per.where(F.col("docs") >= min_docs).drop("docs")
    late = lines.join(F.broadcast(edges), ["h", "g"]).where(F.col("doc") != F.col("last"))
    lost = seen.where("NOT open").select("k1", "k2", "n_lines", "pos").union(late.select("k1", "k2", "n_lines", "pos"))
    per_doc = lost.groupBy("k1", "k2", "n_lines").agg(F.collect_set("pos").alias("pos"))

    def pressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bitmaps = []
            for n, pos in zip(batch.column("n_lines").to_pylist(), batch.column("pos").to_pylist()):
                keep = np.ones(n, dtype=bool)
                keep[pos] = False
                bitmaps.append(zlib.compress(np.packbits(keep).tobytes()))
            lost_lines = pc.list_value_length(batch.column("pos")).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("k1", "k2", "n_lines")], lost_lines, pa.array(bitmaps, pa.binary())],
                                             ["k1", "k2", "n_lines", "n_lost", "keep"])

    return per_doc.mapInArrow(pressed, "k1 long, k2 long, n_lines long, n_lost long, keep binary")


def kept_text(text: bytes, keep: bytes | None) -> bytes:
    """The lines whose bit is set, joined by line feeds."""
    if keep is None:
        return text
    lines = text.split(b"\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), dtype=np.uint8), count=len(lines))
    return b"\n".join(line for line, b in zip(lines, bits) if b)


def matched(docs: DataFrame, **options) -> DataFrame:
    """All rows of ``docs`` with ``__keep`` and ``__lost``, null where nothing is lost."""
    maps = keep_bitmaps(docs, **options).select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), F.col("keep").alias("__keep"), F.col("n_lost").alias("__lost"))
    k1, k2 = row_key("doc_id", "text")
    return docs.withColumns({"__a": k1, "__b": k2}).join(
        maps.hint("shuffle_hash"), (F.col("__a") == F.col("__k1")) & (F.col("__b") == F.col("__k2")), "left").drop("__a", "__b", "__k1", "__k2")


def line_dedup(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 of every document, one row per input row.

    A line whose stripped, lower-cased key has at least 20 code points and lies
    in at least 3 documents stays only in the largest id that holds it (there in
    all its places).  A null or empty text is one empty line.  Rows of one id
    are one document for the count; a null id is one more, smaller than any
    other.  Other columns are ignored; an empty table gives no rows.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keeps = batch.column("__text").to_pylist(), batch.column("__keep").to_pylist()
            lines = pa.array([(t or b"").count(b"\n") + 1 for t in texts], pa.int64())
            sha = pa.array([hashlib.sha256(kept_text(t or b"", k)).hexdigest() for t, k in zip(texts, keeps)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lines, batch.column("__lost"), sha], ["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    found = matched(docs.select("doc_id", "text"), **options)
    slim = found.select("doc_id", F.col("text").cast("binary").alias("__text"), "__keep", F.coalesce("__lost", F.lit(0)).cast("long").alias("__lost"))
    return slim.mapInArrow(digest, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def drop_lines(docs: DataFrame, **options) -> DataFrame:
    """The documents with their lost lines cut out of ``text``, other columns unchanged.

    A document that loses all its lines keeps its row with an empty text; a null
    text stays null; repeated rows lose the same lines; an empty table gives no rows.
    """
    cols = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keeps = batch.column("text").to_pylist(), batch.column("__keep").to_pylist()
            new = pa.array([t if k is None else kept_text(t.encode(), k).decode() for t, k in zip(texts, keeps)], pa.string())
            yield pa.RecordBatch.from_arrays([new if c == "text" else batch.column(c) for c in cols], cols)

    return matched(docs, **options).select(*cols, "__keep").mapInArrow(cut, schema)


LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, pos, parts[pos] AS line FROM (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS pos
    FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AND k.doc_id <> c.last AS lost FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN lost THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
