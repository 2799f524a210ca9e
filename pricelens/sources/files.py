"""Per-game JSON files: reading them as tables and writing them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators.prices import to_usd

HISTORY_DDL = (
    "slug string, cheapsharkGameId string, atl map<string, struct<usd: double, date: string, seed: string>>, "
    "events array<struct<d: string, ch: string, cc: string, usd: double, pct: int>>"
)
SNAPSHOT_DDL = (
    "slug string, lastPriceChangeAt string, regions array<struct<cc: string, currency: string, amount: double, list: double, "
    "discountPct: int, saleEndsAt: string>>"
)


def _file_slug():
    return F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1)


def read_history(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """All history documents with the slug their file is named after.

    Files hold one document each, laid out over several lines, or one on every line.
    """
    return spark.read.schema(HISTORY_DDL).json(path, multiLine=one_per_file).withColumn("file_slug", _file_slug())


def history_events(history: DataFrame) -> DataFrame:
    return history.select("slug", F.posexplode("events").alias("seq", "e")).select(
        "slug", "seq", F.col("e.ch").alias("channel"), F.col("e.cc").alias("cc"), F.col("e.d").try_cast("date").alias("d"),
        F.col("e.usd").alias("usd"), F.col("e.pct").alias("pct"))


def history_atl(history: DataFrame) -> DataFrame:
    return history.select("slug", F.explode("atl").alias("atl_key", "a")).select(
        "slug", "atl_key", F.col("a.usd").alias("usd"), F.col("a.date").try_cast("date").alias("date"), F.col("a.seed").alias("seed"))


def _region():
    named = {"cc": "cc", "currency": "currency", "amount": "amount", "list": "list_amount", "discountPct": "discount_pct", "saleEndsAt": "sale_ends_at"}
    return [F.col(f"r.{old}").alias(new) for old, new in named.items()]


def read_snapshots(spark: SparkSession, path: str, channel: str) -> DataFrame:
    """Price rows of all snapshot documents of one store, in stored order."""
    docs = spark.read.schema(SNAPSHOT_DDL).json(path, multiLine=True).withColumn("file_slug", _file_slug())
    return docs.select("slug", "file_slug", F.lit(channel).alias("channel"), F.posexplode("regions").alias("pos", "r")).select(
        "slug", "file_slug", "channel", "pos", *_region())


def read_documents(spark: SparkSession, path: str, channel: str) -> DataFrame:
    """Price rows of documents kept many to a file, each with the file name (``game``) it stands for."""
    docs = spark.read.schema(SNAPSHOT_DDL + ", game string").json(path)
    return docs.select("slug", "game", F.lit(channel).alias("channel"), F.posexplode("regions").alias("pos", "r")).select("slug", "game", "channel", "pos", *_region())


def misnamed_files(docs: DataFrame) -> DataFrame:
    return docs.where(~F.col("slug").eqNullSafe(F.col("file_slug"))).select("slug", "file_slug").distinct()


def snapshot_documents(rows: DataFrame) -> DataFrame:
    """One nested document per game and store, regions in code order.  A store
    has few regions, so the array is small."""
    region = F.struct("cc", "currency", "amount", F.col("list_amount").alias("list"), F.col("discount_pct").alias("discountPct"), F.col("sale_ends_at").alias("saleEndsAt"))
    return rows.groupBy("channel", "slug").agg(F.array_sort(F.collect_list(region)).alias("regions"))


def write_snapshot_json(rows: DataFrame, path: str) -> None:
    """Partitioned by store; null fields are written, not left out."""
    snapshot_documents(rows).write.mode("overwrite").partitionBy("channel").option("ignoreNullFields", "false").json(path)


# Labels of a review sheet, fixed values.
VERIFY_LABELS = {"pending": "待核验", "passed": "通过", "exception": "异常"}
APPLY_LABELS = {"not_applied": "未应用", "staged": "已进入 staging", "applied": "已应用", "failed": "失败"}


def guard_cell(value) -> F.Column:
    """A cell a spreadsheet would run as a formula gets a quote mark."""
    text = F.coalesce(X.col(value).cast("string"), F.lit(""))
    return F.when(text.rlike(r"^\s*[=+\-@]"), F.concat(F.lit("'"), text)).otherwise(text)


def review_rows(joined: DataFrame) -> DataFrame:
    """Review report: every cell guarded, states with their labels."""
    labelled = joined.withColumn("verify_label", F.coalesce(X.relabel("verify_status", VERIFY_LABELS), "verify_status")).withColumn(
        "apply_label", F.coalesce(X.relabel("apply_status", APPLY_LABELS), "apply_status"))
    stale = F.when(F.col("approval_stale"), "是").otherwise("否")
    plain = ("candidate_id", "title", "decision", "verify_status", "verify_label", "apply_status", "apply_label", "verified_at", "applied_at", "evidence_digest")
    return labelled.select(*[guard_cell(c).alias(c) for c in plain], stale.alias("approval_stale"))


def write_review_csv(joined: DataFrame, path: str) -> None:
    review_rows(joined).write.mode("overwrite").option("header", True).option("quoteAll", False).option("escape", '"').csv(path)


PLAN = "struct<local: string, usd: string, listLocal: string, listUsd: string, discountPct: int>"
CORE_DDL = (
    f"app struct<name: string, updatedAt: string>, plans array<struct<id: string, name: string>>, "
    f"regions array<struct<countryCode: string, prices: map<string, {PLAN}>, currency: map<string, string>>>"
)


def explode_plans(docs: DataFrame) -> DataFrame:
    """One row per plan and region of older price documents; list price and
    discount only where there is a discount."""
    r = docs.select(F.col("app.name").alias("name"), F.explode("regions").alias("r"))
    p = r.select("name", F.col("r.countryCode").alias("cc"), F.col("r.currency").alias("cur"), F.explode("r.prices").alias("plan", "p"))
    sale = F.coalesce(F.col("p.discountPct") > 0, F.lit(False))
    return p.select(
        "name", "plan", "cc", F.try_element_at("cur", F.col("plan")).alias("currency"), X.parse_usd_text("p.usd").alias("usd"),
        F.when(sale, X.parse_usd_text("p.listUsd")).alias("list_usd"), F.when(sale, F.col("p.discountPct")).alias("discount_pct"))


def plan_prices(responses: DataFrame, plans: DataFrame, rates: DataFrame) -> DataFrame:
    """Price per plan and region from landed app prices, with dollar values;
    plans hold (plan, app_id)."""
    priced = responses.where(F.col("amount").isNotNull()).join(plans, "app_id")
    usd = to_usd(to_usd(priced, rates), rates, "list_amount", "list_usd")
    return usd.select("plan", "cc", "currency", "amount", "usd", "list_amount", "list_usd", "discount_pct")
