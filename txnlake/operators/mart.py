"""Daily spend by category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.functions.money import money_sum
from txnlake.functions.rules import is_authorised
from txnlake.functions.times import date_key, iso_date
from txnlake.operators.upsert import merge_replace

MART_KEYS = ["date_key", "merchant_category"]
ROLLUP_KEYS = ["date_key", "merchant_id"]


def daily_spend_by_category(enriched: DataFrame) -> DataFrame:
    """Authorised spend per UTC day and the event's own category."""
    return (
        enriched.where(is_authorised())
        .groupBy(
            iso_date(date_key(F.col("event_time"))).alias("day"), F.col("merchant_category")
        )
        .agg(money_sum(F.col("amount_gbp")).alias("total_gbp"))
    )


def merchant_day_totals(fact: DataFrame) -> DataFrame:
    """Mart measures per day and merchant, before categories are looked up.

    Money and counts are of authorised rows, flags of all rows.
    """
    return fact.groupBy(*ROLLUP_KEYS).agg(
        money_sum(F.col("amount_gbp"), is_authorised()).alias("total_gbp"),
        F.count_if(is_authorised()).alias("txn_count"),
        F.count_if("is_flagged").alias("flagged_count"),
    )


def _added_up() -> list[Column]:
    return [
        money_sum(F.col("total_gbp")).alias("total_gbp"),
        F.sum("txn_count").alias("txn_count"),
        F.sum("flagged_count").alias("flagged_count"),
    ]


def add_merchant_days(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Totals of facts already counted plus totals of new facts."""
    return stored.unionByName(new).groupBy(*ROLLUP_KEYS).agg(*_added_up())


def category_totals(merchant_days: DataFrame, dim_merchant: DataFrame) -> DataFrame:
    """Roll merchants up to their current category."""
    return (
        merchant_days.join(dim_merchant.select("merchant_id", "merchant_category"), "merchant_id")
        .groupBy(*MART_KEYS)
        .agg(*_added_up())
    )


def build_daily_mart(fact: DataFrame, dim_merchant: DataFrame) -> DataFrame:
    """The mart from scratch.

    Facts shrink to one row per merchant and day before the join, so the join
    and its shuffle never see a fact row, whatever one merchant's share is.
    """
    return category_totals(merchant_day_totals(fact), dim_merchant)


def refresh_mart(mart: DataFrame, fresh: DataFrame, mode: str = "merge") -> DataFrame:
    """`merge` replaces matching rows and keeps the others; `rebuild` keeps none.

    They differ once a merchant changes category: merging leaves the row of the
    old category behind, with spend that is also under the new one.
    """
    if mode == "merge":
        return merge_replace(mart, fresh, MART_KEYS)
    if mode == "rebuild":
        return fresh.select(*mart.columns)
    raise ValueError(f"mode must be 'merge' or 'rebuild', not {mode!r}")
