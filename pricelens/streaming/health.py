"""Source health and request quotas on streams.

There are few sources and one may send a large share of all runs, so their
state is kept with aggregates per micro-batch (combined on the map side) and a
merge of two small ledgers, not in one key's processor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import health as H
from .state_table import BucketedTable, VersionedTable


def merge_ledgers(old: DataFrame, new: DataFrame) -> DataFrame:
    """Ledger after a batch.  A batch with a success starts the streak anew;
    without one its failures add up."""
    o = old.select("source", F.col("last_attempt").alias("o_attempt"), F.col("last_success").alias("o_success"), F.col("streak").alias("o_streak"))
    j = new.join(o, "source", "full_outer")
    anew = F.col("last_success").isNotNull() & (F.col("o_success").isNull() | (F.col("last_success") >= F.col("o_success")))
    streak = F.when(anew, F.col("streak")).otherwise(F.coalesce("o_streak", F.lit(0)) + F.coalesce("streak", F.lit(0)))
    return j.select(
        "source", F.greatest("last_attempt", "o_attempt").alias("last_attempt"), F.greatest("last_success", "o_success").alias("last_success"),
        streak.cast("bigint").alias("streak"))


def ledger_step(table: VersionedTable, late: str | None = None):
    """``foreachBatch`` function keeping the source ledger in ``table``.

    Runs at or before a source's last attempt are late: they are appended to
    the ``late`` path, when given, and do not move the ledger.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        old = table.before(batch_id)
        runs = batch
        if old is not None:
            seen = old.select("source", F.col("last_attempt").alias("__seen"))
            marked = batch.join(seen, "source", "left")
            is_late = F.coalesce(F.col("run_at") <= F.col("__seen"), F.lit(False))
            if late is not None:
                marked.where(is_late).drop("__seen").write.mode("overwrite").parquet(f"{late}/v={batch_id}")
            runs = marked.where(~is_late).drop("__seen")
        new = H.source_ledger(runs)
        table.write(new if old is None else merge_ledgers(old, new), batch_id)

    return step


def stream_source_health(runs: DataFrame, table: VersionedTable, checkpoint: str, late: str | None = None, **trigger):
    """Start the ledger query over a stream of runs (source, run_at, seq, ok,
    targeted)."""
    return (
        runs.writeStream.foreachBatch(ledger_step(table, late)).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def stale_now(table: VersionedTable, as_of) -> DataFrame:
    """Sources out of their budget at an instant, from the kept ledger."""
    ledger = table.current()
    if ledger is None:
        raise ValueError("the ledger has no version yet")
    return H.stale_sources(ledger, as_of)


def stream_requests_per_day(log: DataFrame, limit: int, keep: str = "31 days") -> DataFrame:
    """Requests per client and UTC day with the breach flag; days leave the
    state a month after the newest request."""
    return (
        log.withWatermark("ts", keep)
        .groupBy(F.window("ts", "1 day").alias("w"), "user_id")
        .agg(F.count(F.lit(1)).alias("requests"))
        .select("user_id", F.col("w.start").cast("date").alias("day"), "requests", (F.col("requests") > limit).alias("over_limit"))
    )


def _by_day():
    return F.unix_date("day")


def quota_step(state: str, out: str, spark: SparkSession, keep_days: int = 31):
    """``foreachBatch`` function: request counts per client and UTC day under ``state``, the changed ones of a batch under ``out``.

    State lies by day: a batch rewrites the days it holds.  A day more than
    ``keep_days`` before the newest one leaves the state; what still comes for it
    is written under ``out``-retired and counts nowhere.  A batch that is run
    again starts from the version before it, so no request counts twice.
    """
    table = BucketedTable(spark, state, _by_day)

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = batch.where(F.col("ts").isNotNull()).select("user_id", F.col("ts").cast("date").alias("day"))
        index, touched = table.before(batch_id), table.touched(rows)
        newest = max([*touched, *([index["clock"]] if index["clock"] is not None else [])], default=None)
        edge = -(1 << 31) if newest is None else newest - keep_days
        counted = rows.groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("requests"))
        counted.where(_by_day() < edge).write.mode("overwrite").parquet(f"{out}-retired/v={batch_id}")
        live = {b for b in touched if b >= edge}
        counted = counted.where(_by_day() >= edge)
        held = table.read(index, live)
        now = counted.withColumn("fresh", F.lit(True))
        if held is not None:
            both = now.unionByName(held.withColumn("fresh", F.lit(False)))
            now = both.groupBy("user_id", "day").agg(F.sum("requests").alias("requests"), F.max("fresh").alias("fresh"))
        now.where("fresh").drop("fresh").write.mode("overwrite").parquet(f"{out}/v={batch_id}")
        table.write(now.drop("fresh"), batch_id, index, live, clock=newest, drop=[b for b in index["buckets"] if b < edge])

    return step


def kept_quota(spark: SparkSession, state: str, limit: int) -> DataFrame:
    """Requests per client and kept day with the breach flag."""
    days = BucketedTable(spark, state, _by_day).current()
    return days.select("user_id", "day", "requests", (F.col("requests") > limit).alias("over_limit"))
