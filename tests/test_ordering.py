"""Positions in a total order: equal to a plain window, no job before the result's own, no checkpoint."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pricelens.functions import ordering as O


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    data = [(i, rng.choice([None, "b", "a", "é", "Z"]), rng.choice([None, 1.5, -2.0, 0.0]), 0 if i % 3 else rng.randrange(40)) for i in range(6000)]
    return spark.createDataFrame(data, "id long, name string, x double, g int").repartition(7).cache()


@pytest.mark.parametrize("order", [["id"], [O.down("id")], ["name", O.down("x"), "id"], [O.down("x"), O.down("name"), "id"]])
def test_positions_equal_a_window(rows, order):
    window = Window.orderBy(*[k.order() for k in O.keys_of(order)])
    want = {r.id: r.rn for r in rows.withColumn("rn", F.row_number().over(window)).collect()}
    assert {r.id: r.rn for r in O.global_row_number(rows, order).collect()} == want


def test_positions_in_groups_that_reach_over_many_ranges(rows):
    window = Window.partitionBy("g").orderBy(F.col("name").desc(), "id")
    want = {r.id: r.rn for r in rows.withColumn("rn", F.row_number().over(window)).collect()}
    assert {r.id: r.rn for r in O.group_row_number(rows, ["g"], [O.down("name"), "id"]).collect()} == want


def test_null_groups_empty_tables_and_pages(spark, rows):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 3)], "k string, id int")
    assert {(r.k, r.id): r.rn for r in O.group_row_number(df, ["k"], ["id"]).collect()} == {(None, 1): 1, (None, 2): 2, ("a", 3): 1}
    assert O.global_row_number(df.limit(0), ["id"]).count() == 0
    pages = {r.id: r.page for r in O.paginate(rows.select("id"), ["id"], 100).collect()}
    assert pages == {i: i // 100 + 1 for i in range(6000)}


def test_ranges_are_ordered_and_of_like_size(rows):
    per = O.ranged(rows, ["id"]).groupBy("__range").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("n")).orderBy("lo").collect()
    assert len(per) > 500 and all(a.hi < b.lo and a["__range"] < b["__range"] for a, b in zip(per, per[1:]))
    assert max(r.n for r in per) < 100


def test_nothing_runs_before_the_result(spark, rows):
    rows.count()
    spark.sparkContext.setJobGroup("lazy-positions", "building")
    O.paginate(rows, ["id"])
    O.group_row_number(rows, ["g"], ["id"])
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("lazy-positions") == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_sort_expressions_are_keys_too(rows):
    order = [F.col("name").asc_nulls_last(), F.col("x").desc_nulls_first(), F.coalesce("g", F.lit(0)).desc(), F.col("id").asc()]
    want = {r.id: r.rn for r in rows.withColumn("rn", F.row_number().over(Window.orderBy(*order))).collect()}
    assert {r.id: r.rn for r in O.global_row_number(rows, order).collect()} == want
