"""Validation as columns: a bad event gets reasons, never an exception."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.functions.rules import is_alpha
from txnlake.schemas import MONEY, STATUSES
from txnlake.sources.rates import with_rate


def _rules() -> dict[str, Column]:
    """Reason code to the condition a good event meets."""
    amount = F.col("amount")
    return {
        "transaction_id": F.length("transaction_id") >= 8,
        "user_id": F.col("user_id") > 0,
        "card_id": F.length("card_id") >= 4,
        "merchant_id": F.col("merchant_id") > 0,
        "merchant_name": F.length("merchant_name") >= 1,
        "merchant_category": F.length("merchant_category") >= 1,
        # An amount the stored column cannot hold would stop the whole load.
        "amount": (amount > 0) & amount.try_cast(MONEY).isNotNull(),
        "currency": is_alpha(F.col("currency"), 3),
        # Upper-casing can lengthen text, and the stored code has two letters.
        "country": is_alpha(F.col("country"), 2) & (F.length(F.upper("country")) == 2),
        "status": F.col("status").isin(*STATUSES),
        "event_time": F.col("event_time").isNotNull(),
        "unknown_currency": ~is_alpha(F.col("currency"), 3) | F.col("rate").isNotNull(),
    }


def validate(df: DataFrame, rates: DataFrame | None = None) -> DataFrame:
    """Add `reasons`, empty for a good event, and the event's `rate`.

    A body that is not a JSON object has the single reason `json`.
    """
    rated = with_rate(df, rates)
    failed = F.array_compact(
        F.array(
            *[
                F.when(~F.coalesce(ok, F.lit(code == "unknown_currency")), F.lit(code))
                for code, ok in _rules().items()
            ]
        )
    )
    if "is_json" in df.columns:
        failed = F.when(F.col("is_json"), failed).otherwise(F.array(F.lit("json")))
    return rated.withColumn("reasons", failed)


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) of a validated frame."""
    good = df.where(F.size("reasons") == 0).drop("reasons", "is_json", "value")
    rejects = df.where(F.size("reasons") > 0)
    return good, rejects


def reject_counts(rejects: DataFrame) -> DataFrame:
    """Rejected events per reason; an event counts once under each of its reasons."""
    return (
        rejects.select(F.explode("reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("rejected"))
    )
