"""Versioned tables for ``foreachBatch`` state.

Batch N reads the newest version below N and writes version N by overwriting
it, so a batch that is run again after a failure gives the same table.
``VersionedTable`` is for small tables that every batch rewrites.
``BucketedTable`` is for state that grows with the keys: a batch reads and
writes the buckets it touches only, and what no kept version names is deleted.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Versions that stay readable: the newest and the one a retried batch starts from.
KEPT_VERSIONS = 2


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    def _versions(self) -> list[int]:
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        out = []
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            done = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if name.startswith("v=") and fs.exists(done):
                out.append(int(name[2:]))
        return sorted(out)

    def before(self, batch_id: int) -> DataFrame | None:
        older = [v for v in self._versions() if v < batch_id]
        return self.spark.read.parquet(f"{self.path}/v={older[-1]}") if older else None

    def current(self) -> DataFrame | None:
        versions = self._versions()
        return self.spark.read.parquet(f"{self.path}/v={versions[-1]}") if versions else None

    def write(self, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/v={batch_id}")
        for version in self._versions()[:-KEPT_VERSIONS]:
            old = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v={version}")
            old.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(old, True)


class BucketedTable:
    """State split by a bucket column; each version is a list of where every bucket's files are.

    ``bucket`` gives a row's bucket, a whole number: a hash of its key, or a day.
    A version holds the files of the buckets it touched under ``v=<batch>/b=<bucket>``
    and an index ``v=<batch>/_index``, which commits it: for each bucket the
    versions that make it up and a number its user keeps about it, and a clock.
    """

    def __init__(self, spark: SparkSession, path: str, bucket: Callable[[], Column]) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.bucket = bucket

    # -- files

    def _fs(self, *parts: str):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def versions(self) -> list[int]:
        fs, root = self._fs()
        if not fs.exists(root):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(root)]
        return sorted(int(n[2:]) for n in names if n.startswith("v=") and fs.exists(self._fs(n, "_index")[1]))

    def index(self, version: int | None) -> dict:
        """``{"clock": ..., "buckets": {bucket: [[versions], note]}}`` of a version; empty for None."""
        if version is None:
            return {"clock": None, "buckets": {}}
        fs, path = self._fs(f"v={version}", "_index")
        stream = fs.open(path)
        try:
            found = json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()
        return {"clock": found["clock"], "buckets": {int(b): v for b, v in found["buckets"].items()}}

    def before(self, batch_id: int) -> dict:
        older = [v for v in self.versions() if v < batch_id]
        return self.index(older[-1] if older else None)

    # -- rows

    def touched(self, batch: DataFrame) -> set[int]:
        """Buckets of a batch's rows; numbers only, as many as there are buckets."""
        return {r[0] for r in batch.select(self.bucket().alias("b")).distinct().collect()}

    def read(self, index: dict, buckets: Iterable[int] | None = None) -> DataFrame | None:
        """Rows of some buckets, or of all; None if they hold nothing."""
        wanted = index["buckets"] if buckets is None else {b: index["buckets"][b] for b in buckets if b in index["buckets"]}
        paths = [f"{self.path}/v={v}/b={b}" for b, (versions, _) in sorted(wanted.items()) for v in versions]
        return self.spark.read.parquet(*paths) if paths else None

    def current(self) -> DataFrame | None:
        versions = self.versions()
        return self.read(self.index(versions[-1] if versions else None))

    def write(self, rows: DataFrame, batch_id: int, index: dict, touched: Iterable[int], append: bool = False, clock: float | None = None,
              note: Column | None = None, drop: Iterable[int] = ()) -> None:
        """Version ``batch_id``: ``index`` with the touched buckets replaced by ``rows``, or added to with ``append``.

        ``note``, an aggregate, is kept for each bucket that is written.  Buckets
        in ``drop`` are left out.
        """
        home = f"{self.path}/v={batch_id}"
        rows.withColumn("b", self.bucket()).repartition("b").write.mode("overwrite").partitionBy("b").parquet(home)
        fs, at = self._fs(f"v={batch_id}")
        there = sorted(int(s.getPath().getName()[2:]) for s in fs.listStatus(at) if s.getPath().getName().startswith("b="))
        notes: dict[int, float | None] = {}
        if note is not None and there:
            written = self.spark.read.parquet(home).groupBy(F.col("b").cast("long")).agg(note.cast("double"))
            notes = {r[0]: r[1] for r in written.collect()}
        buckets = {b: v for b, v in index["buckets"].items() if b not in set(drop) and (append or b not in set(touched))}
        for b in there:
            held = buckets.get(b, [[], None])[0] if append else []
            buckets[b] = [[*held, batch_id], notes.get(b)]
        out = fs.create(self._fs(f"v={batch_id}", "_index")[1], True)
        try:
            out.write(json.dumps({"clock": clock, "buckets": buckets}).encode())
        finally:
            out.close()
        self._clean()

    def _clean(self) -> None:
        """Delete what only versions before the kept ones name."""
        versions = self.versions()
        old, kept = versions[:-KEPT_VERSIONS], versions[-KEPT_VERSIONS:]
        used = {(v, b) for k in kept for b, (vs, _) in self.index(k)["buckets"].items() for v in vs}
        for version in old:
            fs, home = self._fs(f"v={version}")
            names = [s.getPath().getName() for s in fs.listStatus(home)]
            mine = [n for n in names if n.startswith("b=")]
            gone = [n for n in mine if (version, int(n[2:])) not in used]
            for name in gone:
                fs.delete(self._fs(f"v={version}", name)[1], True)
            if len(gone) == len(mine):
                fs.delete(home, True)
