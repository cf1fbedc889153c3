"""Reports over the star schema, each a lazy DataFrame.

Every order has a last key that makes it total, so a limit always keeps the
same rows.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.functions.money import money_sum
from txnlake.functions.rules import is_authorised

# How many rows a caller may ask for.
DAILY_SPEND_MAX = 365
TOP_MERCHANTS_MAX = 100
DEFAULT_WINDOW_DAYS = 30


def _limit(n: int, most: int) -> int:
    if not isinstance(n, int) or not 1 <= n <= most:
        raise ValueError(f"limit must be a whole number from 1 to {most}, not {n!r}")
    return n


def _date(value: date | str) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def spend_window(
    from_date: date | str | None, to_date: date | str | None, as_of: date | None = None
) -> tuple[date, date]:
    """Both ends default from today, UTC: `to` to it, `from` to 30 days before it."""
    today = as_of or datetime.now(timezone.utc).date()
    start = _date(from_date) if from_date else today - timedelta(days=DEFAULT_WINDOW_DAYS)
    return start, _date(to_date) if to_date else today


def authorised(df: DataFrame) -> DataFrame:
    return df.where(is_authorised())


def where_user(df: DataFrame, user_id: int) -> DataFrame:
    return df.where(F.col("user_id") == user_id)


def in_date_range(df: DataFrame, from_date: date, to_date: date) -> DataFrame:
    return df.where(F.col("date_key").between(F.lit(from_date), F.lit(to_date)))


def user_spend_all(
    fact: DataFrame,
    dim_user: DataFrame,
    from_date: date | str | None = None,
    to_date: date | str | None = None,
    as_of: date | None = None,
) -> DataFrame:
    """Authorised spend of every known user, 0.00 for those without any."""
    start, end = spend_window(from_date, to_date, as_of)
    spend = (
        authorised(in_date_range(fact, start, end))
        .groupBy("user_id")
        .agg(money_sum(F.col("amount_gbp")).alias("spent"), F.count(F.lit(1)).alias("n"))
    )
    zero = F.lit(0)
    return (
        dim_user.select("user_id")
        .join(spend, "user_id", "left")
        .select(
            "user_id",
            F.lit(start).alias("from_date"),
            F.lit(end).alias("to_date"),
            F.coalesce("spent", zero.cast("decimal(18,2)")).alias("total_gbp"),
            F.coalesce("n", zero.cast("bigint")).alias("txn_count"),
        )
    )


def user_spend(
    fact: DataFrame,
    dim_user: DataFrame,
    user_id: int,
    from_date: date | str | None = None,
    to_date: date | str | None = None,
    as_of: date | None = None,
) -> DataFrame:
    """One row for a known user, none for an unknown one."""
    return user_spend_all(
        where_user(fact, user_id), where_user(dim_user, user_id), from_date, to_date, as_of
    )


def daily_spend(mart: DataFrame, category: str | None = None, limit: int = 30) -> DataFrame:
    """Newest mart rows, of one category if given. The limit counts rows, not days."""
    n = _limit(limit, DAILY_SPEND_MAX)
    rows = mart if category is None else mart.where(F.col("merchant_category") == category)
    return rows.orderBy(F.desc("date_key"), "merchant_category").limit(n)


def top_merchants(fact: DataFrame, dim_merchant: DataFrame, limit: int = 10) -> DataFrame:
    """Merchants by authorised spend. Facts are summed per merchant before the join."""
    n = _limit(limit, TOP_MERCHANTS_MAX)
    spend = (
        authorised(fact)
        .groupBy("merchant_id")
        .agg(money_sum(F.col("amount_gbp")).alias("total_gbp"), F.count(F.lit(1)).alias("txn_count"))
    )
    return (
        spend.join(dim_merchant, "merchant_id")
        .select("merchant_id", "merchant_name", "merchant_category", "total_gbp", "txn_count")
        .orderBy(F.desc("total_gbp"), "merchant_id")
        .limit(n)
    )


def freshness(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.count(F.lit(1)).alias("row_count"), F.max("ingested_at").alias("last_ingested_at")
    )


def fact_count(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count(F.lit(1)).alias("row_count"))


def top_users(dim_user: DataFrame, n: int = 10) -> DataFrame:
    return (
        dim_user.select("user_id", "txn_count", "first_seen", "last_seen")
        .orderBy(F.desc("txn_count"), "user_id")
        .limit(n)
    )


def weekly_top_categories(mart: DataFrame, as_of: date | None = None) -> DataFrame:
    """Spend per category since seven days before `as_of`."""
    today = as_of or datetime.now(timezone.utc).date()
    return (
        mart.where(F.col("date_key") >= F.lit(today - timedelta(days=7)))
        .groupBy("merchant_category")
        .agg(money_sum(F.col("total_gbp")).alias("weekly_gbp"))
        .orderBy(F.desc("weekly_gbp"), "merchant_category")
    )


def dq_history(log: DataFrame, n: int = 10) -> DataFrame:
    return (
        log.select("run_ts", "check_name", "passed", "detail")
        .orderBy(F.desc("run_ts"), "check_name")
        .limit(n)
    )


def flagged_transactions(raw: DataFrame, n: int = 10) -> DataFrame:
    return (
        raw.where("is_flagged")
        .select("transaction_id", "user_id", "amount_gbp", "currency", "event_time")
        .orderBy(F.desc("amount_gbp"), "transaction_id")
        .limit(n)
    )


def mart_top(mart: DataFrame, n: int = 10) -> DataFrame:
    return mart.orderBy(F.desc("date_key"), F.desc("total_gbp"), "merchant_category").limit(n)
