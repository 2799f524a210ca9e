"""Streams against their batch twins."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pricelens.operators import health as H
from pricelens.operators import history as HI
from pricelens.plans import bindings as B
from pricelens.plans import stream_queries as SQ
from pricelens.streaming import health as SH
from pricelens.streaming import prices as SP
from pricelens.streaming.state_table import VersionedTable

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def run(df, name, tmp, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", f"{tmp}/{name}").trigger(availableNow=True).start()
    q.awaitTermination(300)
    assert q.exception() is None
    return df.sparkSession.table(name)


@pytest.fixture(scope="module")
def daily_stream(spark, tmp_path_factory):
    """Daily prices landed in three files by time, each file shuffled."""
    SP.use_state_store(spark)
    path = str(tmp_path_factory.mktemp("daily"))
    daily = B.daily(spark, SF).withColumn("observed_at", F.col("d").cast("timestamp"))
    for lo, hi in (("1995-01-01", "1997-01-01"), ("1997-01-01", "1999-06-01"), ("1999-06-01", "2003-01-01")):
        part = daily.where((F.col("d") >= F.lit(lo).cast("date")) & (F.col("d") < F.lit(hi).cast("date")))
        part.orderBy(F.hash("slug", "d")).coalesce(1).write.mode("append").parquet(path)
    return daily, path


def test_change_events_equal_batch(spark, daily_stream, tmp_path):
    daily, path = daily_stream
    stream = spark.readStream.schema(daily.schema).option("maxFilesPerTrigger", 1).parquet(path)
    out = run(SP.stream_change_events(stream), "t_events", tmp_path)
    assert out.where("kind = 'late'").count() == 0
    assert rows(out.drop("kind")) == rows(HI.change_events(daily.drop("observed_at")))


def test_running_low_equals_batch(spark, daily_stream, tmp_path):
    daily, path = daily_stream
    stream = spark.readStream.schema(daily.schema).option("maxFilesPerTrigger", 1).parquet(path)
    out = run(SP.stream_atl(stream), "t_atl", tmp_path, "complete")
    assert rows(out) == rows(HI.atl_from_events(daily).drop("seed"))


def write(spark, path, data, ddl):
    spark.createDataFrame(data, ddl).coalesce(1).write.mode("append").parquet(path)


OBS = "slug string, channel string, d date, usd double, pct int, observed_at timestamp"


def ts(text):
    return datetime.fromisoformat(text)


def test_late_observation_moves_nothing(spark, tmp_path):
    SP.use_state_store(spark)
    path = str(tmp_path / "in")
    day = lambda text: ts(text).date()
    write(spark, path, [("g", "steam", day("2026-07-03"), 30.0, None, ts("2026-07-03"))], OBS)
    write(spark, path, [("g", "steam", day("2026-07-01"), 10.0, None, ts("2026-07-01"))], OBS)
    write(spark, path, [("g", "steam", day("2026-07-04"), 30.0, None, ts("2026-07-04"))], OBS)
    stream = spark.readStream.schema(OBS).option("maxFilesPerTrigger", 1).parquet(path)
    out = run(SP.stream_change_events(stream), "t_late", tmp_path)
    assert rows(out.select("kind", "usd")) == [("event", 30.0), ("late", 10.0)]


def test_rerun_of_a_day_is_dropped(spark, tmp_path):
    path = str(tmp_path / "in")
    row = ("g", "steam", ts("2026-07-01").date(), 30.0, None, ts("2026-07-01T01:00:00"))
    again = (*row[:5], ts("2026-07-01T02:00:00"))
    write(spark, path, [row], OBS)
    write(spark, path, [again], OBS)
    stream = spark.readStream.schema(OBS).option("maxFilesPerTrigger", 1).parquet(path)
    assert run(SP.dedupe_observations(stream), "t_dedupe", tmp_path).count() == 1


def test_sale_end_restores_list_price(spark, tmp_path):
    SP.use_state_store(spark)
    ddl = "slug string, channel string, observed_at timestamp, usd double, list_usd double, discount_pct int, sale_ends_at timestamp"
    path = str(tmp_path / "in")
    write(spark, path, [("g", "xbox", ts("2026-07-01"), 30.0, 60.0, 50, ts("2026-07-05"))], ddl)
    write(spark, path, [("other", "xbox", ts("2026-07-09"), 10.0, None, None, None)], ddl)
    write(spark, path, [("other", "xbox", ts("2026-07-10"), 10.0, None, None, None)], ddl)
    stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(path)
    out = run(SP.deal_expiry(stream), "t_expiry", tmp_path).where("slug = 'g'")
    assert rows(out.select("usd", "discount_pct", "reason")) == sorted([(30.0, 50, "observed"), (60.0, None, "sale_ended")], key=repr)


def test_source_health_equals_batch(spark, tmp_path):
    path = str(tmp_path / "in")
    runs = B.runs(spark, SF)
    for lo, hi in (("2024-01-01", "2024-01-08"), ("2024-01-08", "2024-01-20"), ("2024-01-20", "2024-03-01")):
        runs.where((F.col("run_at") >= F.lit(lo)) & (F.col("run_at") < F.lit(hi))).coalesce(1).write.mode("append").parquet(path)
    table = VersionedTable(spark, str(tmp_path / "ledger"))
    stream = spark.readStream.schema(runs.schema).option("maxFilesPerTrigger", 1).parquet(path)
    SH.stream_source_health(stream, table, str(tmp_path / "chk"), str(tmp_path / "late")).awaitTermination(300)
    assert rows(table.current()) == rows(H.source_ledger(runs))
    stale = rows(SH.stale_now(table, "2024-06-01T00:00:00Z").select("source"))
    assert len(stale) == table.current().count()


def test_requests_per_day_equals_batch(spark, tmp_path):
    path = str(tmp_path / "in")
    log = B.table(spark, SF, "events").select(F.col("ts").cast("timestamp").alias("ts"), "user_id")
    log.write.parquet(path)
    out = run(SH.stream_requests_per_day(spark.readStream.schema(log.schema).parquet(path), 3), "t_quota", tmp_path, "update")
    assert rows(out) == rows(H.requests_per_day(log, 3).drop("last_request"))


@pytest.fixture
def many_files(spark):
    """200 shuffle partitions that stay apart, so that a span is landed as many files."""
    conf = {"spark.sql.shuffle.partitions": "200", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def batches(home):
    return sum(f.name.isdigit() for f in home.glob("*-checkpoint/commits/*"))


@pytest.mark.parametrize("name", ["deal_expiry", "stream_change_events", "dedupe_observations"])
def test_queries_cross_triggers_with_many_files(spark, many_files, tmp_path, monkeypatch, name):
    daily = B.daily(spark, SF)
    monkeypatch.setattr(SQ, "workspace", lambda spark: str(tmp_path))
    got = getattr(SQ, name)(spark, SF)
    if name == "deal_expiry":
        got, want = got.where("reason = 'observed'").drop("reason"), B.prices_usd(spark, SF).where("cc = 'US'").select("slug", "channel", "usd", "discount_pct")
    elif name == "stream_change_events":
        want = HI.change_events(daily).withColumn("kind", F.lit("event"))
    else:
        want = daily.select("slug", "channel", "d", "usd")
    assert rows(got) == rows(want)
    assert batches(tmp_path) >= 3


def test_dedupe_keeps_days_that_arrive_late(spark, tmp_path):
    path = str(tmp_path / "in")
    for day in ("2026-07-20", "2026-07-01", "2026-07-10", "2026-07-01"):
        write(spark, path, [("g", "steam", ts(day).date(), 30.0, None, ts(day))], OBS)
    stream = spark.readStream.schema(OBS).option("maxFilesPerTrigger", 1).parquet(path)
    assert run(SP.dedupe_observations(stream), "t_dedupe_late", tmp_path).count() == 3


def test_change_event_steps_equal_the_processor(spark, tmp_path):
    SP.use_state_store(spark)
    path = str(tmp_path / "in")
    for part in ([("03", 30.0, None), ("04", 30.0, 5)], [("01", 10.0, None), ("04", 20.0, 5), ("06", 20.0, 5)], [("07", 20.0, 5), ("08", 1.0, None)]):
        write(spark, path, [("g", "steam", ts(f"2026-07-{d}").date(), usd, pct, ts(f"2026-07-{d}")) for d, usd, pct in part], OBS)
    stream = spark.readStream.schema(OBS).option("maxFilesPerTrigger", 1).parquet(path)
    want = rows(run(SP.stream_change_events(stream), "t_steps", tmp_path).select("d", "usd", "pct", "kind"))
    got = SQ.finish_steps(stream, SP.change_events_step, str(tmp_path), "e")
    assert rows(got.select("d", "usd", "pct", "kind")) == want and len(want) == 5


def test_deal_steps_show_a_game_first_seen_late(spark, tmp_path):
    ddl = "slug string, channel string, observed_at timestamp, usd double, list_usd double, discount_pct int, sale_ends_at timestamp"
    path = str(tmp_path / "in")
    write(spark, path, [("other", "xbox", ts("2026-07-09"), 10.0, None, None, None), ("open", "xbox", ts("2026-07-09"), 5.0, 9.0, 44, ts("2026-07-11"))], ddl)
    write(spark, path, [("g", "xbox", ts("2026-07-01"), 30.0, 60.0, 50, ts("2026-07-05"))], ddl)
    write(spark, path, [("g", "xbox", ts("2026-06-01"), 1.0, None, None, None), ("other", "xbox", ts("2026-07-12"), 10.0, None, None, None)], ddl)
    stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(path)
    out = SQ.finish_steps(stream, SP.deal_expiry_step, str(tmp_path), "shown").where("slug <> 'other'")
    assert rows(out.select("slug", "usd", "discount_pct", "reason")) == sorted(
        [("g", 30.0, 50, "observed"), ("g", 60.0, None, "sale_ended"), ("open", 5.0, 44, "observed"), ("open", 9.0, None, "sale_ended")], key=repr)
