"""Prices by year are counted without making a row for every day."""

from pyspark.sql import functions as F

from pricelens.operators import history as H


def test_yearly_prices_are_the_days_by_year(spark):
    rows = [("a", "steam", "1999-12-31", 5.0, None), ("a", "steam", "2000-01-01", 4.0, 10), ("a", "steam", "2000-02-28", 6.0, None), ("b", "psn", "1600-02-28", 1.0, None),
            ("b", "psn", "2001-12-31", None, None), ("c", "xbox", "2002-01-01", 9.0, None), ("d", "xbox", "2001-12-30", 2.0, None)]
    events = spark.createDataFrame(rows, "slug string, channel string, d string, usd double, pct int").withColumn("d", F.col("d").cast("date"))
    days = H.daily_prices(events, "2001-12-31").groupBy("slug", "channel", F.year("d").alias("year")).agg(F.count(F.lit(1)).alias("n_days"), F.min("usd").alias("low_usd"), F.max("usd").alias("high_usd"))
    assert sorted(map(repr, H.yearly_prices(events, "2001-12-31").collect())) == sorted(map(repr, days.collect()))
    assert H.yearly_prices(events, "2001-12-31").where("slug = 'b'").count() == 402
