"""Exact deduplication by merging sorted runs of digests in rounds.

Every text is normalised and digested where it is read.  A partition's digests
make one sorted run, equal neighbours merged to their smallest row.  Runs then
meet in rounds of a binomial exchange with several partners: in round k the
cells whose numbers differ in digit k only swap runs, and each keeps the entries
whose digest has its own digit there.  A cell merges the runs it is sent and
again keeps the smallest identifier of equal entries.  After the last round all
digits are the digest's, so a cell holds a digest's only entry, and no cell ever
holds more than its share of the digests: a group of copies enters a round with
one entry per run, however many rows it has.  The classes go back by run, so
that a group's rows never meet in one task either.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, settle

#: Runs that meet in a cell in each round, as bits of a cell number's digit.
DIGIT_BITS = 3
RUN = "cell int, sha binary, n_bytes long, no_id boolean, doc_id long, row long, n long"
#: Entries are sorted by digest, so equal ones are neighbours, the smallest row first; a null id is larger than any.
ORDER = ["cell", "sha", "n_bytes", "no_id", "doc_id", "row"]
FLUSH = 50_000


def normalised(text: str = "text") -> Column:
    """Each run of white space as one blank; null as empty text."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE_CLASS + "+", " ")


def digests(docs: DataFrame) -> DataFrame:
    """(cell, sha, n_bytes, no_id, doc_id, row, n): one entry per row, its run named by the partition it was read in."""
    text = normalised()
    slim = docs.select(F.spark_partition_id().alias("cell"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("sha"),
                       F.octet_length(text).cast("long").alias("n_bytes"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.monotonically_increasing_id().alias("row"))
    return slim.select("cell", "sha", "n_bytes", F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", F.lit(1).cast("long").alias("n"))


def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge equal neighbours of a sorted stream: first entry, sum of ``n``.

    Entries are equal only if the whole digest and the length are.  One entry is
    carried from batch to batch, so memory does not depend on a group's size.
    """
    carry: pa.RecordBatch | None = None
    for batch in batches:
        if not len(batch):
            continue
        table = pa.Table.from_batches([batch] if carry is None else [carry, batch]).combine_chunks()
        new = np.ones(len(table), dtype=bool)
        same = [pc.equal(table.column(c).slice(1), table.column(c).slice(0, len(table) - 1)).to_numpy(zero_copy_only=False) for c in ("cell", "sha", "n_bytes")]
        new[1:] = ~np.logical_and.reduce(same)
        first = np.flatnonzero(new)
        n = np.add.reduceat(table.column("n").to_numpy(), first)
        merged = table.take(pa.array(first)).set_column(6, "n", pa.array(n)).combine_chunks().to_batches()[0]
        carry = merged.slice(len(merged) - 1)
        if len(merged) > 1:
            yield merged.slice(0, len(merged) - 1)
    if carry is not None:
        yield carry


def merged(runs: DataFrame) -> DataFrame:
    """Each partition's entries in order, equal ones merged."""
    return runs.sortWithinPartitions(*ORDER).mapInArrow(merge, RUN)


def exchanged(runs: DataFrame, rounds: int) -> DataFrame:
    """The runs after ``rounds`` rounds: one entry per digest."""
    radix = 1 << DIGIT_BITS
    for k in range(rounds):
        place = radix**k
        # two bytes of the digest for each digit of the cell's number, so that digits are independent
        own = F.conv(F.hex(F.substring("sha", 2 * k % 32 + 1, 2)), 16, 10).cast("int") % radix
        digit = F.floor(F.col("cell") / place).cast("int") % radix
        runs = merged(runs.withColumn("cell", (F.col("cell") + (own - digit) * place).cast("int")).repartition("cell"))
    return runs


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 and n_bytes (of the normalised text), one row per input row.

    Texts are equal when they are so after each run of blanks, tabs and line
    ends is one blank (nothing is stripped); a null text is empty.  The row with
    the smallest id of its group stays; a null id is larger than any id, so it
    stays only in a group without ids, whose keep_id is null.  Of rows that
    repeat the smallest id exactly one stays.  A text counts as a whole, however
    long.  Other columns are ignored; an empty table gives no rows.
    """
    rows = settle(digests(docs), "digests")
    highest = rows.agg(F.max("cell")).first()[0] or 0
    rounds = 1
    while (1 << DIGIT_BITS) ** rounds <= highest:
        rounds += 1
    # the first runs are written too: they are the tree's leaves on the way up and on the way down
    leaves = settle(merged(rows), "runs")
    whole = exchanged(leaves, rounds).select("sha", "n_bytes", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"), F.col("n").alias("group_size"))
    # a run whose file is read in parts has an entry from each
    settled = leaves.select("cell", "sha", "n_bytes").join(whole, ["sha", "n_bytes"]).dropDuplicates(["cell", "sha", "n_bytes"])
    out = rows.select("cell", "sha", "n_bytes", "doc_id", "row").join(settled, ["cell", "sha", "n_bytes"])
    return out.select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), "n_bytes")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents whose row stays, all columns unchanged; the same cases as ``classes``.

    Of rows with the same id and equal texts any one stays, whatever their other columns.
    """
    keep = classes(docs).where("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"))
    first = docs.withColumn("__own", F.sha2(normalised().cast("binary"), 256)).dropDuplicates(["doc_id", "__own"])
    return first.join(keep, F.equal_null(F.col("doc_id"), F.col("__id")) & (F.col("__own") == F.col("__sha")), "left_semi").select(*docs.columns)


COPIES_SQL = r"""
WITH digested AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM digested
"""
