"""Checked streaming queries.

The derived tables are landed as files in time order under the session's
checkpoint folder and read back as streams, the price streams with a trigger
after every span; what the stream leaves behind is compared with the batch
statement of the same rule.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..streaming import health as SH
from ..streaming import prices as SP
from ..streaming.state_table import VersionedTable
from . import bindings as B
from .registry import query, view


def workspace(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}"


def landed(df: DataFrame, time: str, cuts: Sequence[str], path: str, run: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Land a table in time order and open it as a stream.

    With ``run``, the stream is run to its end after every span, from the same
    checkpoint, and the last result is returned.  So the number of files cannot
    split a span.  Without, all that is landed is left to one trigger.
    """
    edges = ["0001-01-01", *cuts, "9999-01-01"]
    out = None
    for lo, hi in zip(edges, edges[1:]):
        span = (F.col(time) >= F.lit(lo).cast("timestamp")) & (F.col(time) < F.lit(hi).cast("timestamp"))
        df.where(span).write.mode("append").parquet(path)
        if run is not None:
            out = run(df.sparkSession.readStream.schema(df.schema).parquet(path))
    return df.sparkSession.readStream.schema(df.schema).parquet(path) if run is None else out


def finish_steps(stream: DataFrame, step, home: str, sink: str) -> DataFrame:
    """Run a ``foreachBatch`` function over everything landed and read what its batches wrote."""
    made = step(f"{home}/{sink}-state", f"{home}/{sink}", stream.sparkSession)
    q = stream.writeStream.foreachBatch(made).option(
        "checkpointLocation", f"{home}/{sink}-checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.parquet(f"{home}/{sink}").drop("v")


CUTS = ("1997-01-01", "1999-06-01")


def daily_stream(spark, d, home, run=None):
    daily = B.daily(spark, d).withColumn("observed_at", F.col("d").cast("timestamp"))
    return landed(daily, "observed_at", CUTS, f"{home}/daily", run)


@query("stream_change_events", "SELECT slug, channel, d, usd, pct, 'event' AS kind FROM v_events")
def stream_change_events(spark, d):
    home = workspace(spark)
    return daily_stream(spark, d, home, lambda s: finish_steps(s, SP.change_events_step, home, "events"))


@query("stream_atl", "SELECT slug, atl_key, usd, date FROM v_atl")
def stream_atl(spark, d):
    home = workspace(spark)
    daily_stream(spark, d, home, lambda s: finish_steps(s, SP.atl_step, home, "atl"))
    return SP.kept_lows(spark, f"{home}/atl-state")


@query("dedupe_observations", "SELECT slug, channel, d, usd FROM v_daily")
def dedupe_observations(spark, d):
    """Every day is landed twice; the rerun adds nothing."""
    home = workspace(spark)
    daily = B.daily(spark, d).withColumn("observed_at", F.col("d").cast("timestamp"))
    twice = daily.unionByName(daily.withColumn("observed_at", F.col("observed_at") + F.expr("INTERVAL 6 HOURS")))
    return landed(twice.select("slug", "channel", "d", "usd", "observed_at"), "observed_at", CUTS, f"{home}/twice",
                  lambda s: finish_steps(s, partial(SP.dedupe_step, span=64), home, "once")).select("slug", "channel", "d", "usd")


view("v_shown", """
SELECT slug, channel, d, usd, list_usd, discount_pct, try_cast(sale_ends_at AS TIMESTAMP) AS ends, max(d) OVER () AS last FROM v_usd WHERE cc = 'US'
""")


@query("deal_expiry", """
SELECT slug, channel, usd, discount_pct, 'observed' AS reason FROM v_shown
UNION ALL SELECT slug, channel, list_usd, NULL, 'sale_ended' FROM v_shown WHERE discount_pct IS NOT NULL AND ends <= last
""")
def deal_expiry(spark, d):
    home = workspace(spark)
    rows = B.prices_usd(spark, d).where(F.col("cc") == "US").select(
        "slug", "channel", F.col("d").cast("timestamp").alias("observed_at"), "usd", "list_usd", "discount_pct",
        F.try_to_timestamp(F.col("sale_ends_at")).alias("sale_ends_at"))
    return landed(rows, "observed_at", CUTS, f"{home}/prices", lambda s: finish_steps(s, SP.deal_expiry_step, home, "shown"))


def kept_ledger(spark, d):
    home = workspace(spark)
    stream = landed(B.runs(spark, d), "run_at", ("2024-01-08", "2024-01-20"), f"{home}/runs")
    table = VersionedTable(spark, f"{home}/ledger")
    SH.stream_source_health(stream, table, f"{home}/ledger-checkpoint").awaitTermination()
    return table


@query("stream_source_health", "SELECT * FROM v_ledger")
def stream_source_health(spark, d):
    return kept_ledger(spark, d).current()


@query("stream_stale_sources", "SELECT source FROM v_ledger WHERE last_success IS NULL OR last_success < TIMESTAMP '2024-01-31 12:00:00' - INTERVAL 26 HOUR OR streak > 0")
def stream_stale_sources(spark, d):
    return SH.stale_now(kept_ledger(spark, d), "2024-01-31T12:00:00Z").select("source")


@query("stream_requests_per_day", "SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS requests, count(*) > 3 AS over_limit FROM events GROUP BY 1, 2")
def stream_requests_per_day(spark, d):
    home = workspace(spark)
    log = B.table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "user_id")
    landed(log, "ts", ("2024-01-10", "2024-01-20"), f"{home}/log", lambda s: finish_steps(s, SH.quota_step, home, "quota"))
    return SH.kept_quota(spark, f"{home}/quota-state", 3)
