"""Fact rows: incremental window, projection, referential check."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.functions.times import date_key
from txnlake.operators.upsert import append_new

# Missing keys of a column up to which they are broadcast to the rows.
BROADCAST_KEYS = 100_000


def raw_window(raw: DataFrame, low: datetime, high: datetime) -> DataFrame:
    """Rows ingested after `low` and up to `high`."""
    at = F.col("ingested_at")
    return raw.where((at > F.lit(low)) & (at <= F.lit(high)))


def to_fact(raw: DataFrame) -> DataFrame:
    return raw.select(
        "transaction_id",
        date_key(F.col("event_time")).alias("date_key"),
        "user_id",
        "merchant_id",
        "amount_gbp",
        "currency",
        "status",
        "is_flagged",
        "event_time",
    )


def load_fact(fact: DataFrame, raw: DataFrame, low: datetime, high: datetime) -> DataFrame:
    """Fact rows to insert for one ingest window. Raw holds each id once."""
    return append_new(fact, to_fact(raw_window(raw, low, high)), "transaction_id")


def facts_after(fact: DataFrame, low: datetime) -> DataFrame:
    """Number of facts whose event happened after `low`."""
    return fact.where(F.col("event_time") > F.lit(low)).agg(
        F.count(F.lit(1)).alias("fact_count")
    )


def missing_keys(fact_rows: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """(column, key): the keys of the rows that have no dimension row, in one pass over the rows.

    `dims` maps a key column to its dimension. Distinct keys are taken before the
    shuffle, so a key with very many rows reaches the one join a few times. A null key is not missing.
    """
    tagged = lambda c: F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("key"))
    used = fact_rows.select(F.explode(F.array(*[tagged(c) for c in dims])).alias("x")).select("x.*")
    known = [dim.select(tagged(c).alias("x")).select("x.*") for c, dim in dims.items()]
    used = used.where("key is not null").distinct()
    return used.join(reduce(DataFrame.unionByName, known), ["column", "key"], "left_anti")


def check_references(fact_rows: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Every fact row with `missing`, the keys that have no dimension row.

    The missing keys, normally none, are found first and counted. A column without any is not joined at
    all; few are broadcast, so that the rows are marked where they are read.
    """
    missing = missing_keys(fact_rows, dims).persist(StorageLevel.MEMORY_AND_DISK)
    counts = {r.column: r["count"] for r in missing.groupBy("column").count().collect()}
    checked, marks = fact_rows, []
    for column in dims:
        if column not in counts:
            continue
        keys = missing.where(F.col("column") == column).select(
            F.col("key").cast(fact_rows.schema[column].dataType).alias(column), F.lit(column).alias(f"_no_{column}")
        )
        if counts[column] <= BROADCAST_KEYS:
            keys = F.broadcast(keys)
        checked = checked.join(keys, column, "left")
        marks.append(F.col(f"_no_{column}"))
    none = F.array().cast("array<string>")
    found = F.array_compact(F.array(*marks)) if marks else none
    return checked.select(*fact_rows.columns, found.alias("missing"))


def split_references(
    fact_rows: DataFrame, dims: dict[str, DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """(rows with all their dimensions, violations with `missing`)."""
    checked = check_references(fact_rows, dims)
    whole = F.size("missing") == 0
    return checked.where(whole).drop("missing"), checked.where(~whole)
