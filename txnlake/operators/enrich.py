"""Enrichment of valid events into raw rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.functions.money import money, normalise_currency, to_gbp
from txnlake.functions.rules import flag_suspicious
from txnlake.schemas import RAW_COLUMNS
from txnlake.sources.rates import with_rate


def normalise(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"currency": normalise_currency(F.col("currency")), "country": F.upper("country")}
    )


def select_raw(df: DataFrame) -> DataFrame:
    return df.select(*RAW_COLUMNS)


def enrich(
    df: DataFrame, rates: DataFrame | None = None, now: datetime | Column | None = None
) -> DataFrame:
    """Raw rows: upper-case codes, the amount in pounds, the flag, the ingest time.

    The conversion uses the amount as sent; only then is the amount rounded for
    storage. A row whose currency has no rate fails the job: validate and split first.
    `now` fixes the ingest time; by default it is the time of the query.
    """
    if now is None:
        ingested_at = F.current_timestamp()
    else:
        ingested_at = now if isinstance(now, Column) else F.lit(now)
    rated = df if "rate" in df.columns else with_rate(df, rates)
    no_rate = F.raise_error(F.concat(F.lit("no rate for currency "), F.coalesce("currency", F.lit("null"))))
    converted = normalise(rated).withColumn(
        "amount_gbp",
        F.when(F.col("rate").isNotNull(), to_gbp(F.col("amount"), F.col("rate"))).otherwise(no_rate),
    )
    return select_raw(
        converted.withColumns(
            {
                "amount": money(F.col("amount")),
                "is_flagged": flag_suspicious(
                    F.col("amount_gbp"), F.col("status"), F.col("rate").isNotNull()
                ),
                "ingested_at": ingested_at,
            }
        )
    )
