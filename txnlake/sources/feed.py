"""Transaction feeds derived from the general test tables by plain expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.schemas import MONEY

# Spend categories.
CATEGORIES = (
    "Groceries", "Restaurants", "Transport", "Travel", "Entertainment",
    "Utilities", "Shopping", "Health", "Cash", "Transfers",
)

# The last currency has no rate on purpose, some are lower case.
_FEED_CURRENCIES = ("GBP", "usd", "EUR", "inr", "PLN", "AED", "SGD", "JPY", "ZZZ")
_FEED_COUNTRIES = ("gb", "US", "DE", "IN", "PL", "AE", "SG", "JP", "ZZ")

_CATEGORY_BY_EVENT_TYPE = {
    "click": "Groceries",
    "view": "Travel",
    "purchase": "Shopping",
    "signup": "Health",
}


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


def _txn_id(number: Column) -> Column:
    """`txn-` and at least eight digits; longer numbers keep all of theirs."""
    text = number.cast("string")
    return F.concat(F.lit("txn-"), F.lpad(text, F.greatest(F.lit(8), F.length(text)), F.lit("0")))


def transactions_from_events(events: DataFrame) -> DataFrame:
    """Main feed: one transaction per event, some of them invalid."""
    i = F.col("event_id")
    category = F.coalesce(
        *[F.when(F.col("event_type") == k, v) for k, v in _CATEGORY_BY_EVENT_TYPE.items()],
        F.lit("Cash"),
    )
    merchant = F.get_json_object("props", "$.k").cast("bigint") + 1
    share = i % 100
    return events.select(
        _txn_id(i).alias("transaction_id"),
        F.col("user_id"),
        F.concat(F.lit("visa-"), F.col("user_id"), F.lit("-"), i % 2).alias("card_id"),
        merchant.alias("merchant_id"),
        F.concat(F.lit("Shop "), merchant, F.lit(", "), category).alias("merchant_name"),
        category.alias("merchant_category"),
        (F.col("value").cast(MONEY) * F.when(i % 10 == 0, 100).otherwise(1))
        .cast(MONEY)
        .alias("amount"),
        _pick(_FEED_CURRENCIES, i % 9).alias("currency"),
        _pick(_FEED_COUNTRIES, i % 9).alias("country"),
        F.when(share < 88, "AUTHORISED")
        .when(share < 97, "DECLINED")
        .otherwise("REVERSED")
        .alias("status"),
        F.col("ts").cast("timestamp").alias("event_time"),
        (
            F.col("ts").cast("timestamp")
            + F.make_dt_interval(secs=(F.lit(5) * (i % 5)).cast("decimal(18,6)"))
        ).alias("ingested_at"),
    )


def transactions_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Heavy feed: repeated transaction ids, dates on both sides of the date dimension."""
    i = F.col("l_partkey")
    user = F.col("l_orderkey") % 500 + 1
    merchant = F.col("l_suppkey") + 1
    category = _pick(CATEGORIES, i % 10)
    when = (F.col("l_shipdate") + F.make_ym_interval(F.lit(28))).cast("timestamp")
    flag = F.col("l_returnflag")
    return lineitem.select(
        F.concat(_txn_id(F.col("l_orderkey")), F.lit("-"), F.col("l_linenumber")).alias(
            "transaction_id"
        ),
        user.alias("user_id"),
        F.concat(F.lit("visa-"), user, F.lit("-"), i % 2).alias("card_id"),
        merchant.alias("merchant_id"),
        F.concat(F.lit("Shop "), merchant, F.lit(", "), category).alias("merchant_name"),
        category.alias("merchant_category"),
        F.col("l_extendedprice").cast(MONEY).alias("amount"),
        _pick(_FEED_CURRENCIES, i % 8).alias("currency"),
        _pick(_FEED_COUNTRIES, i % 8).alias("country"),
        F.when(flag == "N", "AUTHORISED")
        .when(flag == "R", "REVERSED")
        .otherwise("DECLINED")
        .alias("status"),
        when.alias("event_time"),
        when.alias("ingested_at"),
    )


def events_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def lineitem_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from_lineitem(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


def faulty_messages(events: DataFrame) -> DataFrame:
    """JSON messages of the main feed: about half with a fault, some with an unusual but good form.

    Every validation rule is broken by some message; the event's number says by which.
    """
    rows = transactions_from_events(events)
    k = F.substring("transaction_id", 5, 30).cast("bigint") % 32
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    text = lambda value: F.lit(f'"{value}"')
    stamp = lambda at, zone: quoted(F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(zone)))
    at, user, amount = F.col("event_time"), F.col("user_id").cast("string"), F.col("amount").cast("string")
    usual = {
        "transaction_id": quoted(F.col("transaction_id")),
        "user_id": user,
        "card_id": quoted(F.col("card_id")),
        "merchant_id": F.col("merchant_id").cast("string"),
        "merchant_name": quoted(F.col("merchant_name")),
        "merchant_category": quoted(F.col("merchant_category")),
        "amount": quoted(amount),
        "currency": quoted(F.col("currency")),
        "country": quoted(F.col("country")),
        "status": quoted(F.col("status")),
        "event_time": stamp(at, "Z"),
    }
    planted = {
        0: ("transaction_id", text("short")),
        1: ("user_id", F.lit("0")),
        2: ("user_id", text("nobody")),
        3: ("card_id", text("abc")),
        4: ("merchant_id", F.concat(F.lit("-"), F.col("merchant_id"))),
        5: ("merchant_name", text("")),
        6: ("merchant_category", F.lit("null")),
        7: ("amount", text("0.00")),
        8: ("amount", text("plenty")),
        9: ("currency", text("G8P")),
        10: ("currency", text("QQQ")),
        11: ("country", text("GBR")),
        12: ("status", text("pending")),
        13: ("event_time", text("yesterday")),
        # good: text for a number, a third decimal, another zone, no zone, a whole number with a point
        16: ("user_id", quoted(user)),
        17: ("amount", F.concat(amount, F.lit("5"))),
        18: ("event_time", stamp(at + F.expr("interval 2 hours"), "+02:00")),
        19: ("event_time", stamp(at, "")),
        20: ("user_id", F.concat(user, F.lit(".0"))),
    }
    fields = []
    for name, body in usual.items():
        for n, (field, other) in planted.items():
            if field == name:
                body = F.when(k == n, other).otherwise(body)
        fields.append(F.concat(F.lit(f'"{name}":'), body))
    whole = F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))
    value = F.when(k == 14, F.substring(whole, 1, 20)).when(k == 15, F.lit("[1, 2]")).otherwise(whole)
    return rows.select(user.alias("key"), value.alias("value"), "ingested_at")
