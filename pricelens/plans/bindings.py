"""Domain tables derived from the shared test tables.

The test tables hold no store data, so every job is checked on views over
them: line items become price observations, parts the catalog, orders release
entries and receipts, events source runs and request logs.  Each view exists
twice, as a DataFrame here and as SQL text for the second engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions.ordering import first_per_key
from ..operators import prices
from .registry import view

AS_OF = "2001-06-01T00:00:00Z"
AS_OF_DAY = "2001-06-01"
EVENTS_AS_OF = "2024-02-02T00:00:00Z"

RATES = (("USD", 1.0), ("EUR", 0.92), ("JPY", 156.4), ("ZAR", 18.1))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows that become landed bodies, dealt out over all tasks.

    The rows are short and the bodies long: one split of a small file would
    otherwise be one task that makes and parses every body.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def landed(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    return spread(table(spark, sf_dir, name), key)


# ---------------------------------------------------------------- prices

view("v_obs", """
SELECT concat('p', CAST(l_partkey AS VARCHAR)) AS slug,
       CASE WHEN l_returnflag = 'A' THEN 'steam' WHEN l_returnflag = 'N' THEN 'eshop'
            WHEN l_linestatus = 'O' THEN 'psn' ELSE 'xbox' END AS channel,
       CASE WHEN n_nationkey = 1 THEN 'US' ELSE concat('C', CAST(100 + n_nationkey AS VARCHAR)) END AS cc,
       CASE n_regionkey WHEN 1 THEN 'USD' WHEN 3 THEN 'EUR' WHEN 2 THEN 'JPY'
                        WHEN 0 THEN 'ZAR' ELSE 'AED' END AS currency,
       floor(l_extendedprice/l_quantity*(1-l_discount)*100 + CAST(0.5 AS DOUBLE)) / CAST(100 AS DOUBLE) AS amount,
       CASE WHEN l_discount > 0 THEN floor(l_extendedprice/l_quantity*100 + CAST(0.5 AS DOUBLE)) / CAST(100 AS DOUBLE) END AS list_amount,
       CASE WHEN l_discount > 0 THEN CAST(floor(l_discount*100 + CAST(0.5 AS DOUBLE)) AS INT) END AS discount_pct,
       CASE WHEN l_discount > 0 AND l_linenumber = 7 THEN 'soon'
            WHEN l_discount > 0 AND l_linenumber > 1
            THEN concat(CAST(CAST(l_shipdate AS DATE) + CAST(l_linenumber*60 AS INT) AS VARCHAR), 'T00:00:00Z') END AS sale_ends_at,
       CAST(l_shipdate AS DATE) AS d, l_orderkey, CAST(l_linenumber AS INT) AS l_linenumber
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
""")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
    sellers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey").join(
        table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"),
        F.col("s_nationkey") == F.col("n_nationkey"))
    rows = li.join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    discounted = F.col("l_discount") > 0
    sale_end = F.date_add(F.col("l_shipdate").cast("date"), F.col("l_linenumber") * 60)
    return rows.select(
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("slug"),
        F.when(F.col("l_returnflag") == "A", "steam").when(F.col("l_returnflag") == "N", "eshop")
        .when(F.col("l_linestatus") == "O", "psn").otherwise("xbox").alias("channel"),
        F.when(F.col("n_nationkey") == 1, "US")
        .otherwise(F.concat(F.lit("C"), (F.lit(100) + F.col("n_nationkey")).cast("string"))).alias("cc"),
        F.when(F.col("n_regionkey") == 1, "USD").when(F.col("n_regionkey") == 3, "EUR")
        .when(F.col("n_regionkey") == 2, "JPY").when(F.col("n_regionkey") == 0, "ZAR")
        .otherwise("AED").alias("currency"),
        X.round2(unit * (F.lit(1) - F.col("l_discount"))).alias("amount"),
        F.when(discounted, X.round2(unit)).alias("list_amount"),
        F.when(discounted, X.round_int(F.col("l_discount") * 100)).alias("discount_pct"),
        F.when(discounted & (F.col("l_linenumber") == 7), "soon")
        .when(discounted & (F.col("l_linenumber") > 1),
              F.concat(sale_end.cast("string"), F.lit("T00:00:00Z"))).alias("sale_ends_at"),
        F.col("l_shipdate").cast("date").alias("d"),
        "l_orderkey",
        F.col("l_linenumber").cast("int").alias("l_linenumber"),
    )


LATEST_ORDER = ("d", "l_orderkey", "l_linenumber", "amount", "list_amount", "currency")

view("v_latest", """
SELECT * EXCLUDE (rn) FROM (SELECT o.*, row_number() OVER (
  PARTITION BY slug, channel, cc
  ORDER BY d DESC, l_orderkey DESC, l_linenumber DESC, amount DESC, list_amount DESC NULLS LAST, currency DESC) rn
  FROM v_obs o) x WHERE rn = 1
""")


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col(c).desc_nulls_last() for c in LATEST_ORDER]
    return first_per_key(observations(spark, sf_dir), ["slug", "channel", "cc"], order)


view("v_rates", """
SELECT * FROM (VALUES ('USD', CAST(1.0 AS DOUBLE)), ('EUR', CAST(0.92 AS DOUBLE)),
  ('JPY', CAST(156.4 AS DOUBLE)), ('ZAR', CAST(18.1 AS DOUBLE))) t(currency, rate)
""")


def rates(spark: SparkSession) -> DataFrame:
    return dimension(spark, "currency, rate", RATES)


def dimension(spark: SparkSession, names: str, rows) -> DataFrame:
    """A small fixed table as inline values, so that its size is known."""
    def lit(value):
        if isinstance(value, str):
            return "'" + value + "'"
        return f"{value}D" if isinstance(value, float) else str(value)

    values = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")


view("v_usd", """
SELECT l.*, CASE WHEN l.currency = 'USD' THEN floor(amount*100 + CAST(0.5 AS DOUBLE))/CAST(100 AS DOUBLE)
       ELSE floor(amount/rate*100 + CAST(0.5 AS DOUBLE)) / CAST(100 AS DOUBLE) END AS usd,
       CASE WHEN l.currency = 'USD' THEN floor(list_amount*100 + CAST(0.5 AS DOUBLE))/CAST(100 AS DOUBLE)
       ELSE floor(list_amount/rate*100 + CAST(0.5 AS DOUBLE)) / CAST(100 AS DOUBLE) END AS list_usd
FROM v_latest l JOIN v_rates r ON l.currency = r.currency
""")


def prices_usd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest price per game, store and region in USD; regions without a rate drop."""
    return prices.fx_join(latest(spark, sf_dir), rates(spark))


view("v_us", """
SELECT slug, channel,
       CASE WHEN expired THEN coalesce(list_amount, list_usd) ELSE amount END AS amount,
       CASE WHEN expired THEN list_usd ELSE usd END AS usd,
       CASE WHEN expired THEN NULL ELSE list_usd END AS list_usd,
       CASE WHEN expired THEN NULL ELSE discount_pct END AS discount_pct,
       CASE WHEN expired THEN NULL ELSE sale_ends_at END AS sale_ends_at
FROM (SELECT *, coalesce(discount_pct, 0) <> 0 AND
        NOT coalesce(try_cast(sale_ends_at AS TIMESTAMP) > TIMESTAMP '2001-06-01 00:00:00', true) AS expired
      FROM v_usd WHERE cc = 'US') x
WHERE NOT expired OR list_usd > 0
""")


def us_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prices.effective_us_row(prices_usd(spark, sf_dir), AS_OF).select(
        "slug", "channel", "amount", "usd", "list_usd", "discount_pct", "sale_ends_at")


# ---------------------------------------------------------------- history

view("v_daily", """
SELECT slug, channel, d, amount AS usd, discount_pct AS pct FROM (
  SELECT *, row_number() OVER (PARTITION BY slug, channel, d
    ORDER BY l_orderkey DESC, l_linenumber DESC, amount DESC, list_amount DESC NULLS LAST) rn
  FROM v_obs WHERE currency = 'USD') x WHERE rn = 1
""")


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dollar price per game, store and day (the last one seen)."""
    order = [F.col(c).desc_nulls_last() for c in ("l_orderkey", "l_linenumber", "amount", "list_amount")]
    usd = observations(spark, sf_dir).where(F.col("currency") == "USD")
    return first_per_key(usd, ["slug", "channel", "d"], order).select(
        "slug", "channel", "d", F.col("amount").alias("usd"), F.col("discount_pct").alias("pct"))


view("v_events", """
SELECT slug, channel, d, usd, pct FROM (
  SELECT *, lag(usd) OVER w AS prev_usd, lag(pct) OVER w AS prev_pct, row_number() OVER w AS rn
  FROM v_daily WINDOW w AS (PARTITION BY slug, channel ORDER BY d)) x
WHERE rn = 1 OR usd IS DISTINCT FROM prev_usd OR pct IS DISTINCT FROM prev_pct
""")

view("v_atl", """
SELECT slug, CASE channel WHEN 'steam' THEN 'pc' WHEN 'eshop' THEN 'eshop-us' WHEN 'xbox' THEN 'xbox-us' ELSE 'psn-us' END AS atl_key,
       usd, d AS date, 'self' AS seed
FROM (SELECT *, row_number() OVER (PARTITION BY slug, channel ORDER BY usd, d) rn FROM v_daily) x WHERE rn = 1
""")


# ---------------------------------------------------------------- catalog

view("v_catalog", """
SELECT concat('p', CAST(p_partkey AS VARCHAR)) AS slug, p_name AS title, p_partkey,
  CASE WHEN p_type <> 'SMALL' THEN 100000 + p_partkey - CASE WHEN p_size = 50 THEN 1 ELSE 0 END END AS steam_app_id,
  CASE WHEN p_type IN ('LARGE','MEDIUM','SMALL') THEN concat(CASE WHEN p_size = 49 THEN '7002' ELSE '7001' END, lpad(CAST(p_partkey AS VARCHAR), 10, '0')) END AS nsuid_americas,
  CASE WHEN p_type IN ('MEDIUM','SMALL') AND p_size <> 40 THEN concat('7001', lpad(CAST(p_partkey + 1000000 AS VARCHAR), 10, '0')) END AS nsuid_europe,
  CASE WHEN p_type = 'SMALL' THEN concat('7001', lpad(CAST(p_partkey + 2000000 AS VARCHAR), 10, '0')) END AS nsuid_japan,
  CASE WHEN p_type IN ('LARGE','MEDIUM','SMALL') AND p_size <> 48 THEN concat(replace(p_name, ' ', '-'), '-', CAST(p_partkey AS VARCHAR)) END AS nintendo_us_slug,
  CASE WHEN p_type = 'PROMO' THEN concat(CASE WHEN p_size = 47 THEN 'x' ELSE '9' END, 'N', lpad(CAST(p_partkey AS VARCHAR), 10, '0')) END AS xbox_big_id,
  CASE WHEN p_type = 'PROMO' AND p_size <> 46 THEN 'standard' END AS xbox_edition,
  CASE WHEN p_type = 'STANDARD' THEN concat('UP0001-PPSA', lpad(CAST(p_partkey AS VARCHAR), 8, '0'), '-GAME', lpad(CAST(p_partkey AS VARCHAR), 12, '0')) END AS psn_product_id,
  CASE WHEN p_type = 'STANDARD' AND p_size <> 45 THEN 'standard' END AS psn_edition,
  list_filter([CASE WHEN p_type <> 'SMALL' THEN 'pc' END, CASE WHEN p_type IN ('LARGE','MEDIUM','SMALL') THEN 'switch' END,
               CASE WHEN p_type = 'PROMO' THEN 'xbox' END, CASE WHEN p_type = 'STANDARD' THEN 'ps5' END], lambda x: x IS NOT NULL) AS platforms,
  CASE WHEN p_size <= 10 THEN 'core' WHEN p_size = 44 THEN 'other' ELSE 'extended' END AS tier,
  CASE WHEN p_size = 43 THEN 'eshop' WHEN p_size = 42 THEN 'steam' WHEN p_size = 41 THEN 'web' END AS primary_regional_channel,
  CASE WHEN p_size = 39 THEN '2001-02-30' ELSE '2001-01-15' END AS added_at,
  CASE WHEN p_brand <> 'Brand#1' THEN concat('https://img.example/', CAST(p_partkey AS VARCHAR), '.jpg') END AS header_image,
  CAST(p_size * 100 AS INT) AS review_count
FROM part
""")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    size, kind = F.col("p_size"), F.col("p_type")
    text = key.cast("string")
    switch = kind.isin("LARGE", "MEDIUM", "SMALL")

    def pad(value, width):
        return F.lpad(value.cast("string"), width, "0")

    return p.select(
        F.concat(F.lit("p"), text).alias("slug"),
        F.col("p_name").alias("title"),
        key.alias("p_partkey"),
        F.when(kind != "SMALL", F.lit(100000) + key - F.when(size == 50, 1).otherwise(0)).alias("steam_app_id"),
        F.when(switch, F.concat(F.when(size == 49, "7002").otherwise("7001"), pad(key, 10))).alias("nsuid_americas"),
        F.when(kind.isin("MEDIUM", "SMALL") & (size != 40), F.concat(F.lit("7001"), pad(key + 1000000, 10))).alias("nsuid_europe"),
        F.when(kind == "SMALL", F.concat(F.lit("7001"), pad(key + 2000000, 10))).alias("nsuid_japan"),
        F.when(switch & (size != 48), F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit("-")), F.lit("-"), text)).alias("nintendo_us_slug"),
        F.when(kind == "PROMO", F.concat(F.when(size == 47, "x").otherwise("9"), F.lit("N"), pad(key, 10))).alias("xbox_big_id"),
        F.when((kind == "PROMO") & (size != 46), "standard").alias("xbox_edition"),
        F.when(kind == "STANDARD", F.concat(F.lit("UP0001-PPSA"), pad(key, 8), F.lit("-GAME"), pad(key, 12))).alias("psn_product_id"),
        F.when((kind == "STANDARD") & (size != 45), "standard").alias("psn_edition"),
        F.array_compact(F.array(
            F.when(kind != "SMALL", "pc"), F.when(switch, "switch"),
            F.when(kind == "PROMO", "xbox"), F.when(kind == "STANDARD", "ps5"))).alias("platforms"),
        F.when(size <= 10, "core").when(size == 44, "other").otherwise("extended").alias("tier"),
        F.when(size == 43, "eshop").when(size == 42, "steam").when(size == 41, "web").alias("primary_regional_channel"),
        F.when(size == 39, "2001-02-30").otherwise("2001-01-15").alias("added_at"),
        F.when(F.col("p_brand") != "Brand#1", F.concat(F.lit("https://img.example/"), text, F.lit(".jpg"))).alias("header_image"),
        (size * 100).cast("int").alias("review_count"),
    )


# ---------------------------------------------------------------- runs, receipts, releases

view("v_runs", """
SELECT concat('src', CAST(user_id % 10 AS VARCHAR)) AS source, ts AS run_at, event_id AS seq,
       event_type <> 'error' AS ok, event_type = 'signup' AS targeted
FROM events
""")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("src"), (F.col("user_id") % 10).cast("string")).alias("source"),
        F.col("ts").alias("run_at"),
        F.col("event_id").alias("seq"),
        (F.col("event_type") != "error").alias("ok"),
        (F.col("event_type") == "signup").alias("targeted"),
    )


view("v_releases", """
SELECT c_mktsegment AS title, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS date,
       strftime(o_orderdate, '%Y-%m') AS month,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'pc' WHEN '2' THEN 'switch' WHEN '3' THEN 'xbox' ELSE 'psn' END AS platform,
       concat('https://store.example/', CAST(o_custkey % 3 AS VARCHAR)) AS url,
       CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE concat('https://img.example/', CAST(o_custkey % 7 AS VARCHAR)) END AS image,
       CASE WHEN o_custkey % 2 = 0 THEN concat('g', CAST(o_custkey % 5 AS VARCHAR)) END AS slug_if_tracked,
       o_orderkey AS seq
FROM orders JOIN customer ON o_custkey = c_custkey
""")


def releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"),
        F.col("o_custkey") == F.col("c_custkey"))
    cust = F.col("o_custkey")
    digit = F.substring("o_orderpriority", 1, 1)
    return o.select(
        F.col("c_mktsegment").alias("title"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date").cast("string")).alias("date"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        F.when(digit == "1", "pc").when(digit == "2", "switch").when(digit == "3", "xbox").otherwise("psn").alias("platform"),
        F.concat(F.lit("https://store.example/"), (cust % 3).cast("string")).alias("url"),
        F.when(cust % 4 != 0, F.concat(F.lit("https://img.example/"), (cust % 7).cast("string"))).alias("image"),
        F.when(cust % 2 == 0, F.concat(F.lit("g"), (cust % 5).cast("string"))).alias("slug_if_tracked"),
        F.col("o_orderkey").alias("seq"),
    )


view("v_rankings", """
SELECT day, CASE l_returnflag WHEN 'A' THEN 'top' WHEN 'N' THEN 'featured' ELSE 'played' END AS source,
       l_partkey AS app_id, CAST(row_number() OVER (PARTITION BY day, l_returnflag ORDER BY qty DESC, l_partkey) AS INT) AS rank,
       concat('title ', CAST(l_partkey AS VARCHAR)) AS title
FROM (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS day, l_returnflag, l_partkey, sum(CAST(l_quantity AS BIGINT)) AS qty
      FROM lineitem GROUP BY 1, 2, 3) x
""")
