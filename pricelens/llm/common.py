"""Tables in the shared folder, and text columns as blocks of bytes."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
SPACES = " \t\n\u000b\u000c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
#: Bytes of text in a piece for operators that make several numbers of each byte.
SMALL = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared checkpoint folder and read it back.

    Cuts the lineage: later jobs read files that every executor sees, so a lost
    executor costs its running tasks only.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    with shuffles_removed(df.sparkSession), small_batches(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.settled_at = path
    return out


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Statements that run inside delete their shuffle files when they end: a written table needs them no more."""
    before = spark.conf.get(REMOVE_SHUFFLES, None)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(REMOVE_SHUFFLES)
        else:
            spark.conf.set(REMOVE_SHUFFLES, before)


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Statements that run inside send Python workers 4 MB of rows at a time, not up to 64, unless the session says how much."""
    if spark.conf.get(BATCH_BYTES, None) is not None:
        yield
        return
    spark.conf.set(BATCH_BYTES, "4m")
    try:
        yield
    finally:
        spark.conf.unset(BATCH_BYTES)


def discard(*tables: DataFrame) -> None:
    """Delete settled tables that nothing will read again."""
    for table_ in tables:
        spark = table_.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table_.settled_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def row_key(*cols: str | Column) -> list[Column]:
    """Two 64-bit hashes that stand for a row in joins; equal rows share them."""
    return [F.xxhash64(F.lit(1), *cols).alias("k1"), F.xxhash64(F.lit(2), *cols).alias("k2")]


def held_out(doc_id: str | Column = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``, is 0; a null id counts as empty text."""
    text = (F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string")
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary")) % folds == 0


def blocks(batches: Iterator[pa.RecordBatch], text: str, limit: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut record batches so that the texts of a piece take about ``limit`` bytes.

    ``text`` is a binary column; null is read as empty.  A longer text is a
    piece of its own and stays whole.  Only the piece's texts are copied out of
    the batch.
    """
    def piece(batch: pa.RecordBatch, start: int, end: int) -> tuple[pa.RecordBatch, list[bytes]]:
        part = batch.slice(start, end - start)
        return part, [b"" if t is None else t for t in part.column(text).to_pylist()]

    for batch in batches:
        start = size = 0
        for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()):
            if size and size + n > limit:
                yield piece(batch, start, i)
                start, size = i, 0
            size += n
        if start < len(batch):
            yield piece(batch, start, len(batch))


def without(batch: pa.RecordBatch, *names: str) -> tuple[list[pa.Array], list[str]]:
    """Columns and names of a batch but for some."""
    keep = [n for n in batch.schema.names if n not in names]
    return [batch.column(n) for n in keep], keep


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """At most ``bound`` labelled documents outside the held-out fold: (text as binary, y).

    The ids with the smallest hashes are taken; only these ids, never texts, go
    through the driver, and they are broadcast because the bound is fixed.  A
    row whose label is null is not labelled; an id with several labels takes
    the largest.
    """
    seen = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    ids = seen.groupBy("doc_id").agg(F.max(F.col(label)).cast("int").alias("y"))
    # the documents' own ids first, so that the bound counts rows that exist
    there = docs.select("doc_id").distinct()
    chosen = ids.join(there, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    rows = [(r.doc_id, r.y) for r in chosen.collect()]
    small = docs.sparkSession.createDataFrame(rows, "doc_id long, y int")
    # repeated ids take their first text by order of the text's hash
    picked = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(small), "doc_id")
    one = picked.groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return one.select("doc_id", F.col("text").cast("binary").alias("text"), "y")


def fitted(features: DataFrame, fit, schema: str) -> list:
    """Fit on a bounded table of features inside one executor task; rows of the model come back."""
    return features.withColumn("__one", F.lit(1)).groupBy("__one").applyInArrow(fit, schema).collect()


#: Bits of a key filter, whatever the number of keys.
FILTER_BITS = 24


@dataclass(frozen=True)
class KeyFilter:
    """Bit set over the low bits of 64-bit keys: a key it lacks is not wanted, others are checked by a join."""

    bits: np.ndarray

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        low = keys.astype(np.int64) & ((1 << FILTER_BITS) - 1)
        return (self.bits[low >> 6] >> (low & 63) & 1).astype(bool)


def key_filter(keys: DataFrame, column: str) -> KeyFilter:
    """Filter of the hashes in a column; 2 MB, so that it can be broadcast.  It only spares work:
    with too many keys it lets all rows pass and the join does the rest."""
    slot = F.col(column).bitwiseAND((1 << FILTER_BITS) - 1)
    per = keys.groupBy(F.shiftright(slot, 6).alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST({column} & 63 AS INT))")).alias("bits"))
    out = np.zeros(1 << FILTER_BITS - 6, dtype=np.int64)
    found = per.toPandas()  # at most 2^18 rows
    out[found["w"].to_numpy(dtype=np.int64)] = found["bits"].to_numpy(dtype=np.int64)
    return KeyFilter(out)
