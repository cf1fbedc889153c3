"""Messages to raw rows: decode, validate, enrich, insert if absent.

Offsets are committed by the checkpoint after a micro-batch is written. A batch
that runs again finds its own rows in the table and adds nothing, so each
transaction lands once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txnlake.operators.enrich import enrich
from txnlake.operators.upsert import first_per_key
from txnlake.operators.validate import split_valid, validate
from txnlake.session import use_utc
from txnlake.sources.events import decode_events
from txnlake.sources.landing import land, seen_before
from txnlake.sources.tables import COMPRESSED, append_rows, read_table

# Fixed value: how often a running stream writes.
DEFAULT_TRIGGER = {"processingTime": "2 seconds"}

_ARRIVAL = ("partition", "offset")

# Rows of a stream in state mode: ids that the state has not seen, what the check found, messages as they came.
_ID, _CHECKED, _MESSAGE = 0, 1, 2

# Folders that the rows of a batch are dealt to by id, and rows that are shuffled at once, about.
SLICES, SLICE_ROWS = 16, 1_000_000

# Set for streams that remember ids in state: on disk, with a bound on what RocksDB takes beside the heap.
_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Counting keys costs a read for each write.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def _arrival_order(columns: list[str]) -> list[Column]:
    """Kafka gives the order of arrival; other sources order by what they carry."""
    return [F.col(c) for c in columns if c in _ARRIVAL] or [F.col("value")]


def _check(messages: DataFrame, rates: DataFrame | None, order: list[Column] | None) -> DataFrame:
    """Decoded and validated messages with their place in the order of arrival."""
    order = order or _arrival_order(messages.columns)
    return validate(decode_events(messages).withColumn("_order", F.struct(*order)), rates)


def _store_rejects(rejects: DataFrame, root: str, stream: str, batch: int) -> None:
    """Append a batch's rejects to the folder of the day, but for those that an earlier attempt stored."""
    spark, mine = rejects.sparkSession, (F.col("stream") == stream) & (F.col("batch") == batch)
    stored = read_table(spark, root, "rejected_events").where(mine).select("value", "reasons")
    rejects = rejects.select("value", "reasons")
    if not stored.isEmpty():
        rejects = rejects.exceptAll(stored)
    at = F.current_timestamp()
    columns = {"rejected_at": at, "stream": F.lit(stream), "batch": F.lit(batch).cast("bigint"), "rejected_on": F.to_date(at)}
    append_rows(rejects.withColumns(columns), root, "rejected_events")


def _lean(checked: DataFrame) -> DataFrame:
    """Checked rows with the message once: in the order of good rows or as the value of rejects."""
    is_good = F.size("reasons") == 0
    return checked.withColumns({"value": F.when(~is_good, F.col("value")), "_order": F.when(is_good, F.col("_order"))})


def _staged(checked: DataFrame, root: str, stream: str) -> DataFrame:
    """Checked rows of a batch, stored in the folder of its stream, in slices by id.

    Stored and not cached: a cached partition that does not fit is written out a hundred blocks at a
    time, each of ten thousand wide rows, which takes more heap than the rows of many tasks leave. The
    message is stored once, in the order of good rows (which may be made of it) or as the value of rejects.
    """
    return _kept(_sliced(_lean(checked)), root, stream, "rows", "_slice")


def _sliced(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_slice", F.pmod(F.xxhash64("transaction_id"), F.lit(SLICES)).cast("int"))


def _kept(rows: DataFrame, root: str, stream: str, name: str, by: str | None = None) -> DataFrame:
    """Rows stored below the staging folder of a stream, in place of those of the batch before."""
    path, spark = f"{_staging(root, stream)}/{name}", rows.sparkSession
    # with a writer open for each folder a task need not sort its rows by folder
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(SLICES))
    writer = rows.write.mode("overwrite").options(**COMPRESSED, partitionOverwriteMode="static")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _staging(root: str, stream: str) -> str:
    return f"{root}/_staging/{hashlib.sha256(stream.encode()).hexdigest()[:12]}"


def _clear(spark: SparkSession, root: str, stream: str) -> None:
    """Leave no rows of a batch behind that has landed; those of one that failed go with the next."""
    empty = spark.createDataFrame([], "transaction_id string")
    empty.write.mode("overwrite").parquet(_staging(root, stream))


def _counts(checked: DataFrame) -> Row:
    is_good = F.size("reasons") == 0
    return checked.agg(F.count_if(is_good).alias("attempted"), F.count_if(~is_good).alias("rejected")).first()


def _new_ids(spark: SparkSession, root: str, stream: str, ids: DataFrame) -> DataFrame:
    """Those of the ids that have not landed, stored in the slices of their rows."""
    ids = _kept(ids, root, stream, "ids")
    return _kept(_sliced(ids.join(seen_before(spark, root, ids), "transaction_id", "left_anti")), root, stream, "new", "_slice")


def _grouped(slices: list[int], rows: int) -> list[list[int]]:
    """The slices in groups of about SLICE_ROWS rows, of the rows that all SLICES slices hold."""
    each = max(1, SLICES * SLICE_ROWS // max(rows, 1))
    return [slices[i : i + each] for i in range(0, len(slices), each)]


def _fresh_parts(good: DataFrame, new: DataFrame, rows: int) -> list[DataFrame]:
    """The first copy of each new id, in parts that are shuffled one after the other."""
    held = sorted(r[0] for r in new.select("_slice").distinct().collect())
    parts = []
    for group in _grouped(held, rows):
        inside = F.col("_slice").isin(group)
        # copies go before the join, so that an id with very many does not meet in one task
        fresh = first_per_key(good.where(inside), "transaction_id", [F.col("_order")])
        parts.append(fresh.join(new.where(inside).select("transaction_id"), "transaction_id", "left_semi"))
    return parts


def _write_checked(
    spark: SparkSession, staged: DataFrame, root: str, stream: str, batch: int, now: datetime | Column | None
) -> dict[str, int]:
    """Land a staged batch. A large one is compared and landed slice by slice, so that its shuffles stay small."""
    seen = _counts(staged)
    good, rejects = split_valid(staged)
    if seen.rejected:
        _store_rejects(rejects, root, stream, batch)
    if seen.attempted <= SLICE_ROWS:
        # copies go before the joins, so that an id with very many does not meet in one task
        fresh = first_per_key(good, "transaction_id", [F.col("_order")])
        known = seen_before(spark, root, good.select("transaction_id").distinct())
        parts = [fresh.join(known, "transaction_id", "left_anti")]
    else:
        new = _new_ids(spark, root, stream, good.select("transaction_id").distinct())
        parts = _fresh_parts(good, new, seen.attempted)
    return _land(parts, good, root, stream, batch, now, seen)


def _land(
    parts: list[DataFrame], good: DataFrame, root: str, stream: str, batch: int, now: datetime | Column | None, seen: Row
) -> dict[str, int]:
    inserted = 0
    if seen.attempted or seen.rejected:
        now = now if now is not None else datetime.now(timezone.utc)
        rows = [enrich(part, now=now) for part in parts or [good.where(F.lit(False))]]
        inserted = land(rows, root, stream, batch, seen.attempted, seen.rejected)
    return {"attempted": seen.attempted, "inserted": inserted, "rejected": seen.rejected}


def _spread(messages: DataFrame, min_partitions: int | None) -> DataFrame:
    """Messages in at least so many partitions; those that come in enough stay where they are."""
    if min_partitions is None or messages.rdd.getNumPartitions() >= min_partitions:
        return messages
    return messages.repartition(min_partitions)


def write_batch(
    spark: SparkSession,
    messages: DataFrame,
    root: str,
    stream: str,
    batch: int,
    rates: DataFrame | None = None,
    now: datetime | Column | None = None,
    order: list[Column] | None = None,
    min_partitions: int | None = None,
) -> dict[str, int]:
    """Write one batch of messages; works for streams and for one-off loads.

    An id already in the raw table is skipped, however old, and of several
    copies in the batch the first by `order` stays. Ids are looked up in sorted
    tables, of which only the pages that may hold them are read. Each batch is
    one landing.
    Decoding is the costly part: `min_partitions` spreads the messages first, for
    sources that deliver a batch in fewer pieces than there are cores.
    """
    use_utc(spark)
    staged = _staged(_check(_spread(messages, min_partitions), rates, order), root, stream)
    counts = _write_checked(spark, staged, root, stream, batch, now)
    _clear(spark, root, stream)
    return counts


def _with_fresh_ids(messages: DataFrame, rates: DataFrame | None, min_partitions: int | None) -> DataFrame:
    """All messages as they came, what the check found of each, and each valid id that the state has not seen before.

    Of a good message the check keeps the id only, of a reject its value: whole rows would be shuffled
    once more, at several times their size in a file. Only ids are kept in state. Which copy of a new id
    stays is decided over the rows of the batch. Both sides of the check read one exchange, so the stream
    decodes a message once: rows are dealt by all columns (the partition they come from keeps copies
    apart), and rejects go as null ids, of which the state keeps one, since a choice of columns or rows
    would move below the exchange and make it a different one for each side. The ids come first: the
    planner keeps renamings below the first side of a union, which would also tell the two apart.
    """
    dealt = messages.select("value") if min_partitions is None else messages.select("value").repartition(min_partitions)
    is_good = F.size("reasons") == 0
    dealt = validate(decode_events(dealt), rates).select(
        F.when(is_good, F.col("transaction_id")).alias("_id"),
        F.when(~is_good, F.col("value")).alias("_reject"),
        F.col("reasons").alias("_reasons"),
        F.spark_partition_id().alias("_from"),
    )
    dealt = dealt.repartition(*dealt.columns)
    ids = dealt.select("_id").dropDuplicates(["_id"]).withColumn("_kind", F.lit(_ID))
    more = dealt.withColumn("_kind", F.lit(_CHECKED)).drop("_from"), messages.withColumn("_kind", F.lit(_MESSAGE))
    return ids.unionByName(more[0], allowMissingColumns=True).unionByName(more[1], allowMissingColumns=True)


def _write_with_ids(
    rows: DataFrame, root: str, stream: str, batch: int, rates: DataFrame | None,
    now: datetime | Column | None, order: list[Column] | None,
) -> dict[str, int]:
    """Land a batch of `_with_fresh_ids`. Messages are decoded to whole rows only where an id has not landed before."""
    spark, own = rows.sparkSession, ("_id", "_reject", "_reasons", "_kind")
    staged = _kept(rows, root, stream, "stream", "_kind")
    checked = staged.where(F.col("_kind") == _CHECKED)
    checked = checked.select(F.col("_id").alias("transaction_id"), F.col("_reject").alias("value"), F.col("_reasons").alias("reasons"))
    seen = _counts(checked)
    if seen.rejected:
        _store_rejects(checked.where(F.size("reasons") > 0), root, stream, batch)
    ids = staged.where((F.col("_kind") == _ID) & F.col("_id").isNotNull()).select(F.col("_id").alias("transaction_id"))
    new = _new_ids(spark, root, stream, ids)
    good, parts = _check(staged.where(F.col("_kind") == _MESSAGE).drop(*own), rates, order), []
    if not new.isEmpty():
        good, _ = split_valid(_staged(good, root, stream))
        parts = _fresh_parts(good, new, seen.attempted)
    counts = _land(parts, good, root, stream, batch, now, seen)
    _clear(spark, root, stream)
    return counts


def _stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The query's own id: kept over restarts, new when a checkpoint is begun anew at an old path."""
    own = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint
    return hashlib.sha256(own.encode()).hexdigest()[:12]


def ingest(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
    on_batch: Callable[[int, dict[str, int]], None] | None = None,
    remember: str = "table",
    rates: DataFrame | None = None,
    now: datetime | Column | None = None,
    order: list[Column] | None = None,
    min_partitions: int | None = None,
) -> StreamingQuery:
    """Start the stream into `root`. One stream may write to a root at a time.

    `remember` says where ids seen before are looked up. Both are exact and
    without an age limit, over restarts, replayed batches and new checkpoints, and
    both keep the first of several copies by `order`:

    - `table`: in the sorted ids of earlier landings. A batch reads the pages
      that may hold its ids, however long the history is.
    - `state`: in the stream's state store first (RocksDB, which this sets for the session),
      so copies of ids that this checkpoint has seen are not looked up. What the
      state lets through is still looked up in the table, since only the table
      knows of replayed batches and of other checkpoints. Messages of a batch with
      ids that have not landed are decoded a second time, to whole rows.

    `on_batch` gets each batch's number and its counts of attempted, inserted
    and rejected events; `landing.totals` adds them up over restarts. To bound a
    batch, set the source's own limit (`maxOffsetsPerTrigger`,
    `maxFilesPerTrigger`). Other options are those of `write_batch`.
    """
    if remember not in ("table", "state"):
        raise ValueError(f"remember must be 'table' or 'state', not {remember!r}")

    def write(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        name = _stream_name(spark, checkpoint)
        # a batch runs many queries; without this their shuffle files lie until the driver collects its garbage
        spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
        if remember == "state":
            counts = _write_with_ids(rows, root, name, batch, rates, now, order)
        else:
            counts = write_batch(spark, rows, root, name, batch, rates, now, order, min_partitions)
        if on_batch is not None and any(counts.values()):
            on_batch(batch, counts)

    use_utc(stream.sparkSession)
    if remember == "state":
        for key, value in _STATE_CONF.items():
            stream.sparkSession.conf.set(key, value)
        stream = _with_fresh_ids(stream, rates, min_partitions)
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or DEFAULT_TRIGGER))
        .start()
    )
