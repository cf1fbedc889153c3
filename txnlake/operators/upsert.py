"""Insert-if-absent and merge, as joins. Keys are single columns or lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

Keys = str | list[str]


def _list(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def first_per_key(df: DataFrame, keys: Keys, order: list[Column]) -> DataFrame:
    """One row per key, the first by `order`.

    The rank limit is applied on each input partition before the shuffle, so a
    key with very many copies sends one row per partition.
    """
    ranked = df.withColumn("_n", F.row_number().over(W.partitionBy(*_list(keys)).orderBy(*order)))
    return ranked.where(F.col("_n") == 1).drop("_n")


def latest_per_key(df: DataFrame, keys: Keys, order: list[Column]) -> DataFrame:
    """One row per key, the last by `order` (ascending columns)."""
    return first_per_key(df, keys, [c.desc() for c in order])


def append_new(
    target: DataFrame,
    batch: DataFrame,
    key: str,
    order: list[Column] | None = None,
) -> DataFrame:
    """Rows of `batch` whose key is not in `target`, the first of each key.

    Without `order` the batch must already hold each key once. The target is
    first cut down to the batch's keys; the planner broadcasts these where its own
    threshold allows, so a small batch scans the target's history without shuffling it.
    """
    fresh = batch if order is None else first_per_key(batch, key, order)
    known = target.select(key).join(batch.select(key).distinct(), key, "left_semi")
    return fresh.join(known, key, "left_anti")


def _matched(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join with each side's columns in a struct, null where absent."""
    pack = lambda df, name: df.select(*keys, F.struct(*df.columns).alias(name))
    return pack(target, "t").join(pack(source, "s"), keys, "full_outer")


def merge_replace(target: DataFrame, source: DataFrame, keys: Keys) -> DataFrame:
    """Source rows, and the target rows whose key the source lacks."""
    keys = _list(keys)
    row = F.coalesce("s", "t")
    return _matched(target, source.select(*target.columns), keys).select(
        *[row[c].alias(c) for c in target.columns]
    )


def merge_dim_user(target: DataFrame, source: DataFrame, add_counts: bool = False) -> DataFrame:
    """Widen first/last seen; take the source's count.

    `add_counts` is for a source that holds only rows the target has not seen.
    """
    if add_counts:
        zero = F.lit(0).cast("bigint")
        count = F.coalesce("s.txn_count", zero) + F.coalesce("t.txn_count", zero)
    else:
        count = F.coalesce("s.txn_count", "t.txn_count")
    return _matched(target, source, ["user_id"]).select(
        "user_id",
        F.least("t.first_seen", "s.first_seen").alias("first_seen"),
        F.greatest("t.last_seen", "s.last_seen").alias("last_seen"),
        count.alias("txn_count"),
    )
