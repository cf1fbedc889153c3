"""User, merchant and date dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.operators.upsert import latest_per_key

# The seeded calendar.
FIRST_DATE = date(2024, 1, 1)
LAST_DATE = date(2027, 12, 31)


def build_dim_user(raw: DataFrame) -> DataFrame:
    """First and last event and the number of transactions of any status."""
    return raw.groupBy("user_id").agg(
        F.min("event_time").alias("first_seen"),
        F.max("event_time").alias("last_seen"),
        F.count(F.lit(1)).alias("txn_count"),
    )


def merchant_order() -> list[Column]:
    """Latest event wins; equal times fall back to the transaction id."""
    return [F.col("event_time"), F.col("transaction_id")]


def latest_merchants(raw: DataFrame) -> DataFrame:
    """The winning row of each merchant, with the columns that made it win."""
    rows = raw.select(
        "merchant_id", "merchant_name", "merchant_category", "event_time", "transaction_id"
    )
    return latest_per_key(rows, "merchant_id", merchant_order())


def build_dim_merchant(raw: DataFrame) -> DataFrame:
    return latest_merchants(raw).select("merchant_id", "merchant_name", "merchant_category")


def merge_latest_merchants(stored: DataFrame, raw: DataFrame) -> DataFrame:
    """Fold new raw rows into the stored winners."""
    both = stored.unionByName(latest_merchants(raw))
    return latest_per_key(both, "merchant_id", merchant_order())


def date_series(spark: SparkSession, start: date = FIRST_DATE, end: date = LAST_DATE) -> DataFrame:
    """Every day from start to end, both included."""
    days = F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))
    return spark.range(1).select(F.explode(days).alias("date_key"))


def build_dim_date(
    spark: SparkSession, start: date = FIRST_DATE, end: date = LAST_DATE
) -> DataFrame:
    """Calendar attributes; weekday 0 is Monday."""
    d = F.col("date_key")
    return date_series(spark, start, end).select(
        "date_key",
        F.dayofmonth(d).cast("smallint").alias("day"),
        F.month(d).cast("smallint").alias("month"),
        F.year(d).cast("smallint").alias("year"),
        F.weekday(d).cast("smallint").alias("weekday"),
        F.weekday(d).isin(5, 6).alias("is_weekend"),
    )
