"""Parquet tables under one root folder.

Raw, fact and log tables only ever grow. The daily tables (totals per merchant
and the mart) are partitioned by day, and a run replaces only the days it
touches. The other tables are replaced as a whole: each new version goes to a
folder of its own, never reused, and becomes current when one small row set is
appended to the publish log. That append is also what moves the load watermark.
A run that dies before it writes its days again from the same pending rows, so
a reader may see some of a run's days before it is published, and never a day in part.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake import schemas as S
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)

# Table to (stored columns, partition columns).
GROWING = {
    "raw_transactions": (f"{S.RAW}, landed bigint, landed_hour string", ["landed_hour"]),
    "landings": (S.LANDING, ["landed_hour"]),
    "rejected_events": (f"{S.REJECT}, rejected_on date", ["rejected_on"]),
    "fact_transaction": (S.FACT, ["date_key"]),
    "fact_rejected": (S.FACT_REJECT, []),
    "dq_check_log": (S.DQ_LOG, []),
}
DAILY = {"merchant_day": S.MERCHANT_DAY, "daily_spend_by_category": S.MART}
# How raw rows, their ids and staged rows are stored: about two thirds and half of the size by default.
COMPRESSED = {"compression": "zstd"}
# Ids seen before, sorted, in levels of doubling size.
SEEN_LEVELS = [f"seen_ids_{level}" for level in range(24)]
REPLACED = {
    "dim_user": S.DIM_USER,
    "dim_merchant": S.DIM_MERCHANT_STORED,
    "dim_date": S.DIM_DATE,
    "pending_transactions": S.RAW,
    "landing_mark": S.LANDING_MARK,
    **dict.fromkeys(SEEN_LEVELS, "transaction_id string"),
}

_PUBLISHED = "table_name string, version bigint, last_loaded timestamp"


@dataclass(frozen=True)
class Version:
    version: int
    last_loaded: datetime


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The files at `path`, or no rows where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def current_versions(spark: SparkSession, root: str) -> dict[str, Version]:
    """Latest published version per table."""
    log = _read(spark, f"{root}/_published", _PUBLISHED)
    rows = (
        log.groupBy("table_name")
        .agg(
            F.max("version").alias("version"),
            F.unix_micros(F.max_by("last_loaded", "version")).alias("micros"),
        )
        .collect()
    )
    return {
        r.table_name: Version(r.version, EPOCH + timedelta(microseconds=r.micros))
        for r in rows
    }


def _folder(root: str, name: str, version: int) -> str:
    """Each version has a folder of its own, so a reader keeps what it began to read."""
    return f"{root}/{name}/version{version}"


def read_table(
    spark: SparkSession, root: str, name: str, versions: dict[str, Version] | None = None
) -> DataFrame:
    if name in GROWING or name in DAILY:
        schema = GROWING[name][0] if name in GROWING else DAILY[name]
        return _read(spark, f"{root}/{name}", schema)
    versions = current_versions(spark, root) if versions is None else versions
    if name not in versions:
        return spark.createDataFrame([], REPLACED[name])
    return _read(spark, _folder(root, name, versions[name].version), REPLACED[name])


def _dealt(df: DataFrame, partitions: list[str]) -> DataFrame:
    """Rebalancing splits a partition value that holds most of the rows over many
    files, and packs small values into few. Without adaptive execution it would
    send each value to one task, so it is left out then.
    """
    adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    return df.hint("rebalance", *partitions) if partitions and adaptive else df


def append_rows(df: DataFrame, root: str, name: str) -> None:
    """Append in the table's layout."""
    partitions = GROWING[name][1]
    _dealt(df, partitions).write.mode("append").options(**COMPRESSED).partitionBy(*partitions).parquet(f"{root}/{name}")


def replace_days(df: DataFrame, root: str, name: str) -> None:
    """Replace the days that the rows hold; the files of all other days stay."""
    rows = _dealt(df, ["date_key"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    rows.partitionBy("date_key").parquet(f"{root}/{name}")


def write_version(df: DataFrame, root: str, name: str, version: int, **options: str) -> None:
    """Write a version that nobody sees before it is published."""
    df.write.mode("overwrite").options(**COMPRESSED, **options).parquet(_folder(root, name, version))


def publish(spark: SparkSession, root: str, versions: dict[str, Version]) -> None:
    """Make versions current, all at once: one file with one row per table."""
    rows = [
        F.struct(
            F.lit(name).alias("table_name"),
            F.lit(v.version).cast("bigint").alias("version"),
            F.lit(v.last_loaded).alias("last_loaded"),
        )
        for name, v in versions.items()
    ]
    spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows))).write.mode("append").parquet(
        f"{root}/_published"
    )


def get_watermark(spark: SparkSession, root: str, name: str) -> datetime:
    """Upper end of the last window loaded into `name`; the epoch before the first."""
    found = current_versions(spark, root).get(name)
    return found.last_loaded if found else EPOCH


def set_watermark(spark: SparkSession, root: str, name: str, ts: datetime) -> None:
    if name in REPLACED or name in DAILY:
        raise ValueError(f"the watermark of {name} moves with its versions")
    found = current_versions(spark, root).get(name)
    publish(spark, root, {name: Version(found.version + 1 if found else 1, ts)})


def load_watermark(spark: SparkSession, root: str) -> DataFrame:
    """The watermark table: (table_name, last_loaded)."""
    log = _read(spark, f"{root}/_published", _PUBLISHED)
    return log.groupBy("table_name").agg(F.max_by("last_loaded", "version").alias("last_loaded"))
