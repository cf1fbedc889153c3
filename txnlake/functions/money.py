"""Exact decimal arithmetic for amounts. No doubles anywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnlake.schemas import MONEY


def money(c: Column) -> Column:
    """Round half up to two decimals, as stored."""
    return c.cast(MONEY)


def to_gbp(amount: Column, rate: Column) -> Column:
    """Convert at `rate` units per pound, half-up to the penny; null without a rate."""
    return money(F.round(amount / rate, 2))


def normalise_currency(c: Column) -> Column:
    return F.upper(c)


def money_sum(c: Column, cond: Column | None = None) -> Column:
    """Sum of `c` where `cond` holds; 0.00 when nothing qualifies."""
    picked = c if cond is None else F.when(cond, c)
    return money(F.coalesce(F.sum(picked), F.lit(0)))
