"""Static exchange rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.functions.money import normalise_currency
from txnlake.schemas import RATE

BASE_CURRENCY = "GBP"

# Units of the currency per pound.
RATES_PER_GBP = {
    "GBP": "1.00",
    "USD": "1.27",
    "EUR": "1.17",
    "INR": "106.50",
    "PLN": "5.05",
    "AED": "4.66",
    "SGD": "1.71",
    "JPY": "198.40",
}


def fx_rates(spark: SparkSession) -> DataFrame:
    """The eight fixed rates as a (currency, rate) relation."""
    rows = ", ".join(f"('{c}', {r}BD)" for c, r in RATES_PER_GBP.items())
    return spark.sql(
        f"SELECT currency, CAST(rate AS {RATE}) AS rate FROM VALUES {rows} AS t(currency, rate)"
    )


def supported_currencies(rates: DataFrame) -> DataFrame:
    return rates.select("currency").orderBy("currency")


def with_rate(df: DataFrame, rates: DataFrame | None = None) -> DataFrame:
    """Left-join the rate of each row's currency, ignoring case.

    The built-in eight rows are broadcast. A caller's own table is not hinted:
    its size is unknown here, so the planner decides.
    """
    if rates is None:
        rates = F.broadcast(fx_rates(df.sparkSession))
    keyed = rates.select(F.col("currency").alias("_rate_currency"), "rate")
    return df.join(
        keyed, normalise_currency(df["currency"]) == keyed["_rate_currency"], "left"
    ).drop("_rate_currency")
