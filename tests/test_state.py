"""Partitioned stream state: what a trigger rewrites, what is deleted, and rows in any order."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pricelens.streaming import health as SH
from pricelens.streaming import prices as SP
from pricelens.streaming.state_table import BucketedTable, VersionedTable

OBS = "slug string, channel string, d date, usd double, pct int, observed_at timestamp"


def obs(spark, rows):
    day = lambda n: date(2026, 7, 1) + timedelta(days=n)
    return spark.createDataFrame([(s, "steam", day(n), usd, None, datetime(2026, 7, 1) + timedelta(days=n)) for s, n, usd in rows], OBS)


def buckets(home, version):
    return sorted(p.name for p in (home / f"v={version}").glob("b=*"))


def test_a_trigger_with_one_key_rewrites_one_bucket(spark, tmp_path):
    step = SP.change_events_step(str(tmp_path / "state"), str(tmp_path / "out"), spark)
    step(obs(spark, [(f"g{i}", 0, 10.0) for i in range(300)]), 0)
    assert len(buckets(tmp_path / "state", 0)) > 50
    step(obs(spark, [("g7", 1, 9.0)]), 1)
    assert len(buckets(tmp_path / "state", 1)) == 1
    table = BucketedTable(spark, str(tmp_path / "state"), SP.by_key)
    assert table.current().count() == 300
    assert [(r.slug, r.usd) for r in table.current().where("usd < 10").collect()] == [("g7", 9.0)]


def test_versions_that_nothing_names_are_deleted(spark, tmp_path):
    step = SP.change_events_step(str(tmp_path / "state"), str(tmp_path / "out"), spark)
    for n in range(6):
        step(obs(spark, [("a", n, float(n))]), n)
    home = tmp_path / "state"
    assert sorted(p.name for p in home.glob("v=*")) == ["v=4", "v=5"]
    step(obs(spark, [(f"k{i}", 0, 1.0) for i in range(40)]), 6)
    step(obs(spark, [(f"k{i}", 1, 1.0) for i in range(40)]), 7)
    step(obs(spark, [("k3", 2, 1.0)]), 8)
    step(obs(spark, [("k3", 3, 1.0)]), 9)
    # a bucket is there once for each kept version that differs
    files = [p.name for p in home.glob("v=*/b=*")]
    assert all(files.count(b) <= 2 for b in files) and BucketedTable(spark, str(home), SP.by_key).current().count() == 41


def test_a_batch_that_is_run_again_gives_the_same(spark, tmp_path):
    step = SP.atl_step(str(tmp_path / "state"), str(tmp_path / "out"), spark)
    step(obs(spark, [("a", 3, 5.0), ("b", 1, 7.0)]), 0)
    for _ in range(2):
        step(obs(spark, [("a", 1, 5.0), ("b", 2, 8.0), ("c", 0, 1.0)]), 1)
        low = {r.slug: (r.usd, r.date.day) for r in SP.kept_lows(spark, str(tmp_path / "state")).collect()}
        assert low == {"a": (5.0, 2), "b": (7.0, 2), "c": (1.0, 1)}
        assert spark.read.parquet(f"{tmp_path}/out/v=1").count() == 2  # b did not move


def test_seen_days_in_any_order_and_retired(spark, tmp_path):
    rng = random.Random(1)
    rows = [(f"g{i % 5}", rng.randrange(20), float(i)) for i in range(200)]
    step = SP.dedupe_step(str(tmp_path / "state"), str(tmp_path / "out"), spark)
    for n in range(4):
        step(obs(spark, rows[n * 50: n * 50 + 50]), n)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == got.select("slug", "d").distinct().count() == len({(s, n) for s, n, _ in rows})
    kept = SP.dedupe_step(str(tmp_path / "s2"), str(tmp_path / "o2"), spark, keep_days=5)
    kept(obs(spark, [("a", 0, 1.0), ("a", 10, 1.0), ("a", 12, 1.0)]), 0)
    kept(obs(spark, [("a", 12, 1.0), ("a", 8, 1.0), ("a", 3, 1.0), ("a", 20, 1.0)]), 1)
    kept(obs(spark, [("a", 20, 1.0), ("a", 12, 1.0), ("b", 18, 1.0)]), 2)
    assert sorted(r.d.day for r in spark.read.parquet(str(tmp_path / "o2")).collect()) == [11, 13, 19, 21]
    assert sorted(r.d.day for r in spark.read.parquet(str(tmp_path / "o2-retired")).collect()) == [1, 4, 9, 13, 13]  # 13 came twice
    index = BucketedTable(spark, str(tmp_path / "s2"), lambda: F.unix_date("d")).before(99)
    assert len(index["buckets"]) == 2  # days 18 and 20: state is bounded by the days kept


def test_a_sale_ends_in_a_bucket_that_the_batch_does_not_touch(spark, tmp_path):
    ddl = "slug string, channel string, observed_at timestamp, usd double, list_usd double, discount_pct int, sale_ends_at timestamp"
    at = lambda n: datetime(2026, 7, n)
    step = SP.deal_expiry_step(str(tmp_path / "state"), str(tmp_path / "out"), spark)
    step(spark.createDataFrame([(f"g{i}", "xbox", at(1), 5.0, 9.0, 44, at(5 if i == 3 else 20)) for i in range(30)], ddl), 0)
    step(spark.createDataFrame([("other", "xbox", at(6), 1.0, None, None, None)], ddl), 1)
    out = spark.read.parquet(f"{tmp_path}/out/v=1").where("reason <> 'observed'").collect()
    assert [(r.slug, r.usd, r.reason) for r in out] == [("g3", 9.0, "sale_ended")]
    assert len(buckets(tmp_path / "state", 1)) <= 2
    step(spark.createDataFrame([], ddl), 2)
    assert spark.read.parquet(f"{tmp_path}/out/v=2").count() == 0


def test_quota_counts_by_day_and_forgets_old_days(spark, tmp_path):
    log = lambda rows: spark.createDataFrame([(datetime(2026, 7, 1) + timedelta(days=n, hours=h), u) for u, n, h in rows], "ts timestamp, user_id long")
    step = SH.quota_step(str(tmp_path / "state"), str(tmp_path / "out"), spark)
    step(log([(1, 0, 1), (1, 0, 2), (2, 0, 3)]), 0)
    step(log([(1, 0, 4), (1, 1, 0)]), 1)
    step(log([(1, 0, 4), (1, 1, 0)]), 1)
    assert {(r.user_id, r.day.day): (r.requests, r.over_limit) for r in SH.kept_quota(spark, str(tmp_path / "state"), 2).collect()} == {
        (1, 1): (3, True), (2, 1): (1, False), (1, 2): (1, False)}
    assert spark.read.parquet(f"{tmp_path}/out/v=1").count() == 2
    step(log([(1, 32, 0), (1, 0, 0)]), 2)
    assert {r.day for r in SH.kept_quota(spark, str(tmp_path / "state"), 2).collect()} == {date(2026, 7, 2), date(2026, 8, 2)}
    assert spark.read.parquet(f"{tmp_path}/out-retired/v=2").count() == 1


@pytest.mark.parametrize("n", [0])
def test_empty_first_batch(spark, tmp_path, n):
    for name, step in (("e", SP.change_events_step), ("a", SP.atl_step), ("d", SP.dedupe_step)):
        step(str(tmp_path / f"{name}s"), str(tmp_path / f"{name}o"), spark)(spark.createDataFrame([], OBS), n)


def test_small_tables_keep_two_versions(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    for n in range(5):
        table.write(spark.range(n + 1), n)
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["v=3", "v=4"]
    assert table.current().count() == 5 and table.before(4).count() == 4
