"""Price streams: change events, running lows, deduplication, deal expiry.

Observations carry (slug, channel, d, usd, pct) and an event time.  Reruns of a
day are dropped in front of the state, so what reaches one key in a batch is at
most one row per day, however often a hot game was observed.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import expr as X
from ..functions.ordering import first_per_key
from ..operators.history import KEY
from .state_table import BucketedTable

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_store(spark: SparkSession) -> None:
    """Arbitrary state needs the RocksDB state store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def dedupe_observations(obs: DataFrame, delay: str | None = None) -> DataFrame:
    """A rerun of one day adds nothing, in whatever order files arrive.

    The state holds one key per row passed on.  A ``delay`` bounds it: keys are
    then forgotten, and rows that come later than the delay are lost.
    """
    if delay is None:
        return obs.dropDuplicates(["slug", "channel", "d"])
    return obs.withWatermark("observed_at", delay).dropDuplicatesWithinWatermark(["slug", "channel", "d"])


def _null_if_nan(value: Any) -> Any:
    return None if value is None or pd.isna(value) else value


EVENTS = T.StructType([
    T.StructField("slug", T.StringType()), T.StructField("channel", T.StringType()), T.StructField("d", T.DateType()),
    T.StructField("usd", T.DoubleType()), T.StructField("pct", T.IntegerType()), T.StructField("kind", T.StringType()),
])


class ChangeEvents(StatefulProcessor):
    """Keeps the last event of a key and emits a row when price or discount
    change.  An observation before the last one seen is late and moves nothing."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "d date, usd double, pct int")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        held = self.last.get() if self.last.exists() else None
        last: tuple[date, float, int | None] | None = tuple(held) if held is not None else None
        batch = pd.concat(list(rows), ignore_index=True).sort_values("d", kind="stable")
        out = []
        for d, usd, pct in zip(batch["d"], batch["usd"], batch["pct"], strict=True):
            pct = None if _null_if_nan(pct) is None else int(pct)
            if last is not None and d < last[0]:
                out.append((*key, d, usd, pct, "late"))
                continue
            if last is None or usd != last[1] or pct != last[2]:
                out.append((*key, d, usd, pct, "event"))
            last = (d, usd, pct)
        if last is not None:
            self.last.update(last)
        if out:
            frame = pd.DataFrame(out, columns=EVENTS.names)
            frame["pct"] = frame["pct"].astype("Int32")
            yield frame

    def close(self) -> None:
        pass


def stream_change_events(obs: DataFrame) -> DataFrame:
    """Change events (kind ``event``) and late rows (kind ``late``) of a stream
    of daily observations."""
    return (
        obs.select("slug", "channel", "d", "usd", "pct").groupBy("slug", "channel")
        .transformWithStateInPandas(ChangeEvents(), EVENTS, "Append", "None")
    )


#: Parts that keyed state is split into.
BUCKETS = 64


def by_key() -> Column:
    return F.pmod(F.xxhash64(*KEY), F.lit(BUCKETS))


def change_events_step(state: str, out: str, spark: SparkSession):
    """``foreachBatch`` function: change events and late rows of a batch, written under ``out``.

    The table under ``state`` keeps the newest day of every key and nothing
    else; the events of a batch are those of its rows behind that day.  Only the
    buckets of the batch's keys are read and written.  Rules as ``ChangeEvents``.
    """
    last = BucketedTable(spark, state, by_key)

    def step(batch: DataFrame, batch_id: int) -> None:
        cols = ("d", "usd", "pct")
        rows = batch.select(*KEY, *cols, F.lit(True).alias("__new"))
        index, touched = last.before(batch_id), last.touched(batch)
        held = last.read(index, touched)
        if held is not None:
            rows = rows.join(held.select(*KEY, F.col("d").alias("__seen")), list(KEY), "left")
            rows = rows.withColumn("__late", F.coalesce(F.col("d") < F.col("__seen"), F.lit(False))).drop("__seen")
            rows = rows.unionByName(held.select(*KEY, *cols, F.lit(False).alias("__new"), F.lit(False).alias("__late")))
        else:
            rows = rows.withColumn("__late", F.lit(False))
        prev = F.lag(F.struct("usd", "pct")).over(Window.partitionBy(*KEY, "__late").orderBy("d", "__new"))
        changed = F.col("__prev").isNull() | ~F.struct("usd", "pct").eqNullSafe(F.col("__prev"))
        kind = F.when(F.col("__late"), "late").otherwise("event").alias("kind")
        told = rows.withColumn("__prev", prev).where(F.col("__new") & (F.col("__late") | changed)).select(*KEY, *cols, kind)
        told.write.mode("overwrite").parquet(f"{out}/v={batch_id}")
        last.write(first_per_key(rows.where(~F.col("__late")), KEY, [F.desc("d"), F.desc("__new")]).select(*KEY, *cols), batch_id, index, touched)

    return step


def dedupe_step(state: str, out: str, spark: SparkSession, keep_days: int | None = None, span: int = 1):
    """``foreachBatch`` function: the first row of every (game, store, day), written under ``out``.

    The seen keys are a log by day, ``span`` days to a bucket.  A batch probes the
    buckets it holds and appends to them, so its cost does not depend on how many
    days are kept; a backfill of years wants a longer span.  With
    ``keep_days``, days that many before the newest one are retired: their keys
    go, and rows that still come for them are not passed on but written under
    ``out``-retired.  Without it, every day is kept and no row is lost.
    """
    seen = BucketedTable(spark, state, lambda: F.floor(F.unix_date("d") / span))
    keys = [*KEY, "d"]

    def step(batch: DataFrame, batch_id: int) -> None:
        index, touched = seen.before(batch_id), seen.touched(batch)
        latest = batch.agg(F.max(F.unix_date("d"))).first()[0]
        newest = max((t for t in (latest, index["clock"]) if t is not None), default=None)
        edge = None if keep_days is None or newest is None else newest - keep_days
        fresh = batch.dropDuplicates(keys)
        if edge is not None:
            fresh.where(F.unix_date("d") < edge).write.mode("overwrite").parquet(f"{out}-retired/v={batch_id}")
            fresh = fresh.where(F.unix_date("d") >= edge)
        held = seen.read(index, touched)
        if held is not None:
            fresh = fresh.join(held, keys, "left_anti")
        fresh.write.mode("overwrite").parquet(f"{out}/v={batch_id}")
        mine = spark.read.schema(batch.schema).parquet(f"{out}/v={batch_id}").select(*keys)
        retired = [b for b in index["buckets"] if edge is not None and (b + 1) * span <= edge]
        seen.write(mine, batch_id, index, touched, append=True, clock=newest, drop=retired)

    return step


def atl_step(state: str, out: str, spark: SparkSession):
    """``foreachBatch`` function: lows that a batch sets, written under ``out``; ``state`` keeps every key's low.

    The low is the smallest price and, of equal ones, the first day; rows may
    come in any order and more than once.
    """
    lows = BucketedTable(spark, state, by_key)

    def step(batch: DataFrame, batch_id: int) -> None:
        index, touched = lows.before(batch_id), lows.touched(batch)
        rows, held = batch.select(*KEY, "usd", "d"), lows.read(index, touched)
        told = None if held is None else held.select(*KEY, F.struct("usd", "d").alias("old"))
        new = (rows if held is None else rows.unionByName(held.select(*KEY, "usd", "d"))).groupBy(*KEY).agg(F.min(F.struct("usd", "d")).alias("b"))
        moved = new if told is None else new.join(told, list(KEY), "left").where(~F.col("b").eqNullSafe(F.col("old")))
        moved.select(*KEY, "b.usd", "b.d").write.mode("overwrite").parquet(f"{out}/v={batch_id}")
        lows.write(new.select(*KEY, "b.usd", "b.d"), batch_id, index, touched)

    return step


def kept_lows(spark: SparkSession, state: str) -> DataFrame:
    """Running low per game and store from the table of ``atl_step``."""
    low = BucketedTable(spark, state, by_key).current()
    return low.select("slug", X.relabel("channel", X.ATL_KEY_OF_CHANNEL).alias("atl_key"), "usd", F.col("d").alias("date"))


def stream_atl(obs: DataFrame) -> DataFrame:
    """Running low per game and store with its first day; update mode."""
    low = obs.groupBy("slug", "channel").agg(F.min(F.struct("usd", "d")).alias("b"))
    return low.select("slug", X.relabel("channel", X.ATL_KEY_OF_CHANNEL).alias("atl_key"), F.col("b.usd").alias("usd"), F.col("b.d").alias("date"))


SHOWN = T.StructType([
    T.StructField("slug", T.StringType()), T.StructField("channel", T.StringType()), T.StructField("usd", T.DoubleType()),
    T.StructField("discount_pct", T.IntegerType()), T.StructField("reason", T.StringType()),
])


class DealExpiry(StatefulProcessor):
    """Shows the newest price of a key and, once event time passes the end of
    its sale, the list price in its place."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.deal = handle.getValueState("deal", "at timestamp, list_usd double, ends timestamp")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        held = self.deal.get() if self.deal.exists() else None
        newest = None
        for chunk in rows:
            top = chunk.sort_values("observed_at", kind="stable").iloc[-1]
            if newest is None or top["observed_at"] >= newest["observed_at"]:
                newest = top
        if newest is None or (held is not None and newest["observed_at"] < pd.Timestamp(held[0])):
            return
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        ends = _null_if_nan(newest["sale_ends_at"])
        listed = _null_if_nan(newest["list_usd"])
        pct = _null_if_nan(newest["discount_pct"])
        self.deal.update((newest["observed_at"].to_pydatetime(), listed, None if ends is None else ends.to_pydatetime()))
        if ends is not None and pct is not None:
            self.handle.registerTimer(int(ends.timestamp() * 1000))
        yield self._row(key, newest["usd"], None if pct is None else int(pct), "observed")

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        if not self.deal.exists():
            return
        at, listed, _ = self.deal.get()
        self.deal.update((at, None, None))
        yield self._row(key, listed, None, "sale_ended" if listed is not None else "withdrawn")

    @staticmethod
    def _row(key: Any, usd: float | None, pct: int | None, reason: str) -> pd.DataFrame:
        frame = pd.DataFrame([(*key, usd, pct, reason)], columns=SHOWN.names)
        frame["usd"] = frame["usd"].astype("float64")
        frame["discount_pct"] = frame["discount_pct"].astype("Int32")
        return frame

    def close(self) -> None:
        pass


def deal_expiry(obs: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """Shown price changes of every game and store.  ``obs`` holds slug,
    channel, observed_at, usd, list_usd, discount_pct and sale_ends_at, the
    last as a timestamp (null for an open end).

    Rows that come later than the delay are lost, also the first of a key;
    ``deal_expiry_step`` loses none.
    """
    cols = ("slug", "channel", "observed_at", "usd", "list_usd", "discount_pct", "sale_ends_at")
    return (
        obs.withWatermark("observed_at", delay).select(*cols).groupBy("slug", "channel")
        .transformWithStateInPandas(DealExpiry(), SHOWN, "Append", "eventTime")
    )


def deal_expiry_step(state: str, out: str, spark: SparkSession):
    """``foreachBatch`` function: shown price changes of a batch, written under ``out``.

    The table under ``state`` keeps the newest observation of every key; the
    newest time seen is the clock.  Only an observation older than its own key's
    moves nothing, so a key may be first seen however late.  Every bucket notes
    when its next sale ends, so a batch opens the buckets of its own keys and
    those in which the clock has passed an end.  Rules as ``DealExpiry``.
    """
    deals = BucketedTable(spark, state, by_key)

    def step(batch: DataFrame, batch_id: int) -> None:
        cols = (*KEY, "observed_at", "usd", "list_usd", "discount_pct", "sale_ends_at")
        open_end = F.col("sale_ends_at").isNotNull() & F.col("discount_pct").isNotNull()
        index = deals.before(batch_id)
        newest = batch.agg(F.max(F.unix_micros("observed_at"))).first()[0]
        clock = max((t for t in (newest, index["clock"]) if t is not None), default=None)
        due = {b for b, (_, ends) in index["buckets"].items() if ends is not None and clock is not None and ends <= clock}
        touched = deals.touched(batch) | due
        rows = batch.select(*cols, F.lit(True).alias("fresh"), open_end.alias("due"))
        held = deals.read(index, touched)
        if held is not None:
            rows = rows.unionByName(held.select(*cols, F.lit(False).alias("fresh"), (F.col("due") & ~F.col("ended")).alias("due")))
        now = first_per_key(rows, KEY, [F.desc("observed_at"), F.desc("fresh")])
        ended = F.col("due") & F.coalesce(F.unix_micros("sale_ends_at") <= F.lit(clock), F.lit(False))
        ahead = F.min(F.when(F.col("due") & ~F.col("ended"), F.unix_micros("sale_ends_at")))
        now = now.withColumn("ended", ended)
        deals.write(now, batch_id, index, touched, clock=clock, note=ahead)
        kept = deals.read(deals.index(batch_id), touched)
        kept = now if kept is None else kept  # an empty batch leaves empty files, not none
        shown = kept.where("fresh").select(*KEY, "usd", "discount_pct", F.lit("observed").alias("reason"))
        reason = F.when(F.col("list_usd").isNotNull(), "sale_ended").otherwise("withdrawn")
        back = kept.where("ended").select(*KEY, F.col("list_usd").alias("usd"), F.lit(None).cast("int").alias("discount_pct"), reason.alias("reason"))
        shown.unionByName(back).write.mode("overwrite").parquet(f"{out}/v={batch_id}")

    return step
