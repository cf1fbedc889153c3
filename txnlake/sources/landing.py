"""Raw rows in numbered landings, and the ids seen before.

Every append to the raw table is a landing. Its rows carry its number, and its
row in the landing log says what the batch held, what was stored and how many
stored rows break a quality check. So whatever follows the raw table (the load
watermark, the gate, running totals) follows numbers and adds up log rows: a
late stamp cannot slip past a number, and no history is read. Stored rows are
counted when they have landed, by reading them back: that also counts rows of an
earlier attempt that died, and no row twice when a lost executor's task runs again.

A landing lies in the partition of the hour in which it was taken, and hours
never go back, so a range of numbers is a range of partitions. Rows of an attempt
that died may lie in an hour before that of their landing, but not before that of the landing before it.

Ids of earlier landings are kept sorted by id in levels, each twice the one
before: a fold merges the new ids with the levels that are in use and writes the
next one, as a binary counter carries, so an id is written again a few times only
and there are few levels. A batch's ids are pushed to the scans as single values
(or ranges, when they are many), which reads only the pages that may hold them.

One writer may land to a root at a time.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.operators.quality import checks
from txnlake.schemas import LANDING_COUNTS
from txnlake.sources.tables import (
    EPOCH,
    SEEN_LEVELS,
    Version,
    append_rows,
    current_versions,
    publish,
    read_table,
    write_version,
)

RAW, LOG, SEEN = "raw_transactions", "landings", "seen_ids"
# Landings and rows after which the ids landed since are folded into the levels.
FOLD_LANDINGS, FOLD_ROWS = 500, 500_000
# Most ids that are pushed one by one; more are pushed as so many ranges.
PUSHED_IDS, PUSHED_RANGES = 1000, 32
IDS_PER_FILE, IDS_PER_PAGE = 2_000_000, 2_000


@dataclass(frozen=True)
class Landing:
    """A place in the order of landings; the first landing is number 1."""

    landed: int = 0
    hour: str = ""


def _hour(at: datetime) -> str:
    return at.strftime("%Y-%m-%dT%H")


def after(table: DataFrame, mark: Landing) -> DataFrame:
    """Rows of the raw table or of the log that landed after a mark."""
    return table.where((F.col("landed_hour") >= mark.hour) & (F.col("landed") > mark.landed))


def landing_log(spark: SparkSession, root: str, mark: Landing = Landing()) -> DataFrame:
    """One row per landing after a mark: the newest where a landing was counted again."""
    log = after(read_table(spark, root, LOG), mark)
    newest = F.max_by(F.struct(*log.columns), "taken").alias("x")
    return log.groupBy("landed").agg(newest).select("x.*")


def _folded(versions: dict[str, Version]) -> Landing:
    """The last landing whose ids are in the levels."""
    found = versions.get(SEEN)
    return Landing(found.version, _hour(found.last_loaded)) if found else Landing()


@dataclass(frozen=True)
class _Place:
    """Where the log stands: its last landing, what has landed since a mark, and a batch's own landing."""

    last: Landing
    landings: int
    rows: int
    own: Landing | None


def _place(spark: SparkSession, root: str, mark: Landing, stream: str | None = None, batch: int | None = None) -> _Place:
    since = F.col("landed") > mark.landed
    own = (F.col("stream") == stream) & (F.col("batch") == batch) if stream is not None else F.lit(False)
    # from the mark's hour on: a batch that runs again may be the one that folded
    found = landing_log(spark, root, Landing(0, mark.hour)).agg(
        F.max("landed").alias("landed"),
        F.max("landed_hour").alias("hour"),
        F.count_if(since).alias("landings"),
        F.coalesce(F.sum(F.when(since, F.col("inserted"))), F.lit(0)).alias("rows"),
        F.max(F.when(own, F.struct("landed", "landed_hour"))).alias("own"),
    ).first()
    last = mark if found.landed is None else Landing(found.landed, found.hour)
    return _Place(last, found.landings, found.rows, Landing(*found.own) if found.own else None)


def count_landing(
    spark: SparkSession, root: str, landing: Landing, stream: str = "", batch: int = 0,
    attempted: int | None = None, rejected: int = 0, since: str = "",
) -> int:
    """Count the stored rows of a landing into the log; returns how many there are.

    Counting a landing again, as after a repair of its rows, replaces its log row. None of its rows
    lies before the hour `since`.
    """
    stored = read_table(spark, root, RAW).where(
        (F.col("landed_hour") >= since) & (F.col("landed") == landing.landed)
    )
    found = stored.agg(
        F.count("*").alias("inserted"),
        *[F.count_if(bad).alias(name) for name, bad in checks().items()],
        F.unix_micros(F.max("ingested_at")).alias("last_ingested"),
    ).first()
    values = {
        "landed": F.lit(landing.landed),
        "taken": F.lit(time.time_ns()),
        "stream": F.lit(stream),
        "batch": F.lit(batch),
        "attempted": F.lit(found.inserted if attempted is None else attempted),
        "rejected": F.lit(rejected),
        **{c: F.lit(found[c]) for c in ("inserted", *checks())},
        "last_ingested": F.timestamp_micros(F.lit(found.last_ingested).cast("bigint")),
        "landed_hour": F.lit(landing.hour),
    }
    fields = read_table(spark, root, LOG).schema
    row = [values[f.name].cast(f.dataType).alias(f.name) for f in fields]
    append_rows(spark.range(0, 1, 1, 1).select(*row), root, LOG)
    return found.inserted


def land(
    rows: DataFrame | list[DataFrame], root: str, stream: str | None = None, batch: int | None = None,
    attempted: int | None = None, rejected: int = 0,
) -> int:
    """Append raw rows as the next landing; returns how many it holds. Rows in several parts are appended one after the other.

    A batch that runs again is the same landing: what is appended now joins what it has, and
    its log row is taken anew. So is a landing without a log row, whose writer died.
    """
    parts = rows if isinstance(rows, list) else [rows]
    spark = parts[0].sparkSession
    mark = _folded(current_versions(spark, root))
    place = _place(spark, root, mark, stream, batch)
    landing = place.own
    if landing is None:
        # A clock that goes back does not move a landing before an earlier one.
        landing = Landing(place.last.landed + 1, max(place.last.hour, _hour(datetime.now(timezone.utc))))
    for part in parts:
        append_rows(
            part.withColumns(
                {"landed": F.lit(landing.landed).cast("bigint"), "landed_hour": F.lit(landing.hour)}
            ),
            root,
            RAW,
        )
    since = mark.hour if place.own else place.last.hour
    stored = count_landing(spark, root, landing, stream or "", batch or 0, attempted, rejected, since)
    if place.landings + 1 >= FOLD_LANDINGS or place.rows + stored >= FOLD_ROWS:
        fold_seen(spark, root)
    return stored


def fold_seen(spark: SparkSession, root: str) -> None:
    """Take the ids landed since the last fold into the levels."""
    versions = current_versions(spark, root)
    mark = _folded(versions)
    place = _place(spark, root, mark)
    last = place.last
    if last == mark:
        return
    used = [name for name in SEEN_LEVELS if versions.get(name, Version(0, EPOCH)).last_loaded > EPOCH]
    free = next(i for i, name in enumerate(SEEN_LEVELS) if name not in used)
    ids = after(read_table(spark, root, RAW), mark).where(F.col("landed") <= last.landed).select("transaction_id")
    for name in SEEN_LEVELS[:free]:
        ids = ids.unionByName(read_table(spark, root, name, versions))
    files = max(1, (place.rows << free) // IDS_PER_FILE)
    by_id = ids.repartitionByRange(files, "transaction_id").sortWithinPartitions("transaction_id")
    write_version(
        by_id, root, SEEN_LEVELS[free], last.landed, **{"parquet.page.row.count.limit": str(IDS_PER_PAGE)}
    )
    at = datetime.strptime(last.hour, "%Y-%m-%dT%H").replace(tzinfo=timezone.utc)
    emptied = {name: Version(last.landed, EPOCH) for name in SEEN_LEVELS[:free]}
    publish(spark, root, {**emptied, SEEN_LEVELS[free]: Version(last.landed, at), SEEN: Version(last.landed, at)})


def _pushed(ids: DataFrame) -> Column:
    """A condition that all the ids meet, made for push-down. Bounded numbers of ids reach the driver."""
    few = [r[0] for r in ids.limit(PUSHED_IDS + 1).collect()]
    if len(few) <= PUSHED_IDS:
        return F.col("transaction_id").isin(few)
    parts = ids.repartitionByRange(PUSHED_RANGES, "transaction_id").groupBy(F.spark_partition_id())
    ranges = parts.agg(F.min("transaction_id"), F.max("transaction_id")).collect()
    condition = F.lit(False)
    for _, low, high in ranges:
        condition = condition | F.col("transaction_id").between(low, high)
    return condition


def seen_before(spark: SparkSession, root: str, ids: DataFrame) -> DataFrame:
    """Ids that have landed and may be among `ids`; all of `ids` that have landed are there.

    `ids` (transaction_id) holds no id twice and is read more than once. What has landed
    since the last fold is bounded and read as it is; the levels hold all the rest.
    """
    versions = current_versions(spark, root)
    found = after(read_table(spark, root, RAW), _folded(versions)).select("transaction_id")
    levels = [name for name in SEEN_LEVELS if versions.get(name, Version(0, EPOCH)).last_loaded > EPOCH]
    if levels:
        # up to this length an IN list is pushed as single values, beyond it as one range
        spark.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", str(PUSHED_IDS))
        wanted = _pushed(ids)
        for name in levels:
            found = found.unionByName(read_table(spark, root, name, versions).where(wanted))
    return found


def totals(spark: SparkSession, root: str) -> DataFrame:
    """Running totals over all landings: (attempted, inserted, rejected)."""
    log = landing_log(spark, root)
    return log.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in LANDING_COUNTS[:3]])
