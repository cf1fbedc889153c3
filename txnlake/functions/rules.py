"""Row predicates shared by batch and stream."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnlake.schemas import AUTHORISED, STATUSES

# Fixed value: amounts from here up are flagged for review.
HIGH_VALUE_GBP = Decimal("5000.00")


def is_alpha(c: Column, n: int) -> Column:
    """Exactly `n` letters of any script. `\\z`, since `$` lets a newline through."""
    return c.rlike(rf"^\p{{L}}{{{n}}}\z")


def flag_suspicious(amount_gbp: Column, status: Column, has_rate: Column) -> Column:
    """High value, or authorised in a currency that has no rate."""
    high_value = F.coalesce(amount_gbp >= F.lit(HIGH_VALUE_GBP), F.lit(False))
    return high_value | ((status == AUTHORISED) & ~has_rate)


def is_authorised() -> Column:
    return F.col("status") == AUTHORISED


def null_key() -> Column:
    return (
        F.col("transaction_id").isNull()
        | F.col("user_id").isNull()
        | F.col("merchant_id").isNull()
    )


def nonpositive_amount() -> Column:
    return F.col("amount") <= 0


def invalid_status() -> Column:
    """A null status is not counted: NOT IN over null is null."""
    return ~F.col("status").isin(*STATUSES)
