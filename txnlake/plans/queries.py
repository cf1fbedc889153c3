"""Every operator as a query over the test tables: name -> f(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.functions.money import to_gbp
from txnlake.functions.rules import flag_suspicious
from txnlake.functions.times import date_key
from txnlake.operators import dims as D
from txnlake.operators import facts as FT
from txnlake.operators import mart as M
from txnlake.operators import quality as Q
from txnlake.operators import upsert as U
from txnlake.operators.enrich import enrich, normalise
from txnlake.operators.validate import reject_counts, split_valid, validate
from txnlake.plans import reports as R
from txnlake.plans.batch import run_batch
from txnlake.schemas import EVENT_COLUMNS, MONEY, RAW_COLUMNS
from txnlake.session import scratch_dir, use_utc
from txnlake.sources import feed, landing, tables
from txnlake.sources.events import decode_events, read_events, to_keyed_json
from txnlake.sources.rates import fx_rates, supported_currencies, with_rate
from txnlake.streaming.ingest import ingest, write_batch

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = date(2024, 1, 31)
EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string"
)
LINEITEM_SCHEMA = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz"
)


MESSAGES = "key string, value string, ingested_at timestamp"


def _utc(*args: int) -> datetime:
    return datetime(*args, tzinfo=timezone.utc)


# Ingest times at which the queries cut the feeds.
EVENTS_CUT = _utc(2024, 1, 16)
EVENTS_CUTS = (_utc(2024, 1, 10), _utc(2024, 1, 20))
RUN_TIMES = (*EVENTS_CUTS, _utc(2024, 2, 1))
LINEITEM_CUT = _utc(2026, 1, 1)
LINEITEM_LANDED = _utc(2030, 1, 1)
LONG_AGO = _utc(2020, 1, 1)


def _plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone and 32-bit small numbers, for comparing engines."""
    out: list[Column] = []
    for name, kind in df.dtypes:
        c = F.col(name)
        if kind == "timestamp":
            c = c.cast("timestamp_ntz")
        elif kind == "smallint":
            c = c.cast("int")
        elif kind == "array<string>":
            c = F.array_join(c, ",")
        out.append(c.alias(name))
    return df.select(*out)


# ---- the two feeds and what the warehouse holds of them ---------------------


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return feed.events_feed(spark, sf)


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    """Valid events, enriched, ingest time as recorded. Ids are unique already."""
    good, _ = split_valid(validate(_events(spark, sf)))
    return enrich(good, now=F.col("ingested_at"))


def _ends(raw: DataFrame) -> tuple[datetime, ...]:
    """Upper ends of three runs; the last takes all there is."""
    last = raw.agg(F.unix_micros(F.max("ingested_at"))).first()[0] or 0
    return (*EVENTS_CUTS, max(tables.EPOCH + timedelta(microseconds=last), EVENTS_CUTS[-1] + timedelta(days=1)))


def _fact(spark: SparkSession, sf: str) -> DataFrame:
    return FT.to_fact(_raw(spark, sf))


def _mart(spark: SparkSession, sf: str) -> DataFrame:
    return M.build_daily_mart(_fact(spark, sf), D.build_dim_merchant(_raw(spark, sf)))


def _lineitem_order() -> list[Column]:
    rest = [c for c in EVENT_COLUMNS if c not in ("transaction_id", "event_time")]
    return [F.col(c) for c in ("ingested_at", "event_time", *rest)]


def _lineitem_raw(spark: SparkSession, sf: str) -> DataFrame:
    rows = U.first_per_key(feed.lineitem_feed(spark, sf), "transaction_id", _lineitem_order())
    good, _ = split_valid(validate(rows))
    return enrich(good, now=F.col("ingested_at"))


def _written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _messages(spark: SparkSession, sf: str) -> DataFrame:
    return to_keyed_json(_events(spark, sf))


def _sent(spark: SparkSession, sf: str) -> DataFrame:
    """Messages as they would be read: stored, so that decoding starts from a column."""
    return _written(spark, _messages(spark, sf), "sent")


# ---- ingest ----------------------------------------------------------------


def q_reject_counts(spark: SparkSession, sf: str) -> DataFrame:
    _, rejects = split_valid(validate(decode_events(_sent(spark, sf))))
    return reject_counts(rejects)


def q_rejects(spark: SparkSession, sf: str) -> DataFrame:
    _, rejects = split_valid(validate(decode_events(_sent(spark, sf))))
    return rejects.select("transaction_id", "reasons")


def q_keyed_json(spark: SparkSession, sf: str) -> DataFrame:
    return _messages(spark, sf)


def q_json_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = split_valid(validate(decode_events(_sent(spark, sf))))
    return good.select(
        *[F.col(c).cast(MONEY) if c == "amount" else F.col(c) for c in EVENT_COLUMNS]
    )


def q_fx_convert(spark: SparkSession, sf: str) -> DataFrame:
    rated = with_rate(_events(spark, sf)).where(F.col("rate").isNotNull())
    return normalise(rated).select(
        "transaction_id",
        "currency",
        "amount",
        to_gbp(F.col("amount"), F.col("rate")).alias("amount_gbp"),
    )


def q_fx_by_currency(spark: SparkSession, sf: str) -> DataFrame:
    rated = normalise(with_rate(feed.lineitem_feed(spark, sf)))
    return rated.groupBy("currency").agg(
        F.sum(to_gbp(F.col("amount"), F.col("rate"))).cast(MONEY).alias("total_gbp"),
        F.count(F.lit(1)).alias("txn_count"),
    )


def q_supported_currencies(spark: SparkSession, sf: str) -> DataFrame:
    used = (
        normalise(_events(spark, sf)).groupBy("currency").agg(F.count(F.lit(1)).alias("txn_count"))
    )
    return supported_currencies(fx_rates(spark)).join(used, "currency")


def q_enriched(spark: SparkSession, sf: str) -> DataFrame:
    return _raw(spark, sf)


def q_flag_rules(spark: SparkSession, sf: str) -> DataFrame:
    rated = with_rate(_events(spark, sf))
    has_rate = F.col("rate").isNotNull()
    gbp = to_gbp(F.col("amount"), F.col("rate"))
    return rated.select(
        "transaction_id",
        "status",
        has_rate.alias("has_rate"),
        flag_suspicious(gbp, F.col("status"), has_rate).alias("is_flagged"),
    )


def q_raw_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return _lineitem_raw(spark, sf)


def q_raw_append(spark: SparkSession, sf: str) -> DataFrame:
    rows = feed.lineitem_feed(spark, sf)
    earlier = rows.where(F.col("ingested_at") < F.lit(LINEITEM_CUT))
    target = U.first_per_key(earlier, "transaction_id", _lineitem_order())
    fresh = U.append_new(target, rows, "transaction_id", _lineitem_order())
    return target.unionByName(fresh).select(*EVENT_COLUMNS, "ingested_at")


# ---- dimensions ------------------------------------------------------------


def _lineitem_days(spark: SparkSession, sf: str) -> DataFrame:
    return feed.lineitem_feed(spark, sf).select(date_key(F.col("event_time")).alias("date_key")).distinct()


def q_dim_date(spark: SparkSession, sf: str) -> DataFrame:
    days = _lineitem_days(spark, sf)
    return D.build_dim_date(spark).join(days, "date_key", "left_semi")


def q_dim_date_seed(spark: SparkSession, sf: str) -> DataFrame:
    """Days seen in the data plus the seeded days that are not among them."""
    seen = _lineitem_days(spark, sf)
    seeded = D.build_dim_date(spark).select("date_key")
    return seen.unionByName(U.append_new(seen, seeded, "date_key"))


def feed_as_raw(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = split_valid(validate(feed.lineitem_feed(spark, sf)))
    return enrich(good, now=F.col("ingested_at"))


def q_dim_user(spark: SparkSession, sf: str) -> DataFrame:
    return D.build_dim_user(_raw(spark, sf))


def _halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    raw = _raw(spark, sf)
    early = F.col("ingested_at") < F.lit(EVENTS_CUT)
    return raw.where(early), raw.where(~early)


def q_dim_user_merge(spark: SparkSession, sf: str) -> DataFrame:
    first, second = _halves(spark, sf)
    return U.merge_dim_user(D.build_dim_user(first), D.build_dim_user(second))


def q_dim_user_incremental(spark: SparkSession, sf: str) -> DataFrame:
    first, second = _halves(spark, sf)
    return U.merge_dim_user(D.build_dim_user(first), D.build_dim_user(second), add_counts=True)


def q_dim_merchant(spark: SparkSession, sf: str) -> DataFrame:
    return D.build_dim_merchant(_raw(spark, sf))


def q_dim_merchant_merge(spark: SparkSession, sf: str) -> DataFrame:
    first, second = _halves(spark, sf)
    return U.merge_replace(
        D.build_dim_merchant(first), D.build_dim_merchant(second), "merchant_id"
    )


# ---- facts and mart --------------------------------------------------------


def q_fact_window(spark: SparkSession, sf: str) -> DataFrame:
    """New facts of one window, part of which is loaded already."""
    raw = _raw(spark, sf)
    loaded = FT.to_fact(raw.where(F.col("ingested_at") <= F.lit(_utc(2024, 1, 12))))
    return FT.load_fact(loaded, raw, EVENTS_CUTS[0], EVENTS_CUTS[1])


def q_facts_after(spark: SparkSession, sf: str) -> DataFrame:
    return FT.facts_after(_fact(spark, sf), EVENTS_CUT)


def q_fact_count(spark: SparkSession, sf: str) -> DataFrame:
    return R.fact_count(_fact(spark, sf))


def q_fact_ref_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Heavy-feed facts against the calendar and the main feed's users and merchants."""
    raw = _raw(spark, sf)
    # The rows are read for their keys and again for the marks, so they are deduplicated once and kept.
    _, bad = FT.split_references(
        _written(spark, FT.to_fact(_lineitem_raw(spark, sf)), "facts"),
        {
            "date_key": D.build_dim_date(spark),
            "user_id": D.build_dim_user(raw),
            "merchant_id": D.build_dim_merchant(raw),
        },
    )
    return bad.select("transaction_id", "date_key", "user_id", "merchant_id", "missing")


def q_daily_spend_event_category(spark: SparkSession, sf: str) -> DataFrame:
    return M.daily_spend_by_category(_raw(spark, sf))


def q_daily_mart(spark: SparkSession, sf: str) -> DataFrame:
    return _mart(spark, sf)


def _mart_refresh(spark: SparkSession, sf: str, mode: str) -> DataFrame:
    """An early mart refreshed after merchants have changed category."""
    first, _ = _halves(spark, sf)
    early = M.build_daily_mart(FT.to_fact(first), D.build_dim_merchant(first))
    return M.refresh_mart(early, _mart(spark, sf), mode)


def q_daily_mart_merge(spark: SparkSession, sf: str) -> DataFrame:
    return _mart_refresh(spark, sf, "merge")


def q_daily_mart_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    return _mart_refresh(spark, sf, "rebuild")


def q_mart_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    raw = feed_as_raw(spark, sf)
    return M.build_daily_mart(FT.to_fact(raw), D.build_dim_merchant(raw))


# ---- quality ---------------------------------------------------------------


def q_quality_checks(spark: SparkSession, sf: str) -> DataFrame:
    counts = Q.quality_counts(_events(spark, sf))
    return Q.check_results(counts, _utc(2024, 1, 31)).drop("run_ts")


def q_dq_history(spark: SparkSession, sf: str) -> DataFrame:
    """The log of three runs, each over what had arrived by then."""
    raw = _events(spark, sf)
    runs = [
        Q.check_results(Q.quality_counts(FT.raw_window(raw, tables.EPOCH, at)), at)
        for at in RUN_TIMES
    ]
    return R.dq_history(runs[0].unionByName(runs[1]).unionByName(runs[2]), 5)


# ---- reports ---------------------------------------------------------------


def q_user_spend(spark: SparkSession, sf: str) -> DataFrame:
    dim = D.build_dim_user(_raw(spark, sf))
    return R.user_spend(_fact(spark, sf), dim, 7, "2024-01-05", "2024-01-25")


def q_user_spend_all(spark: SparkSession, sf: str) -> DataFrame:
    dim = D.build_dim_user(_raw(spark, sf))
    return R.user_spend_all(_fact(spark, sf), dim, as_of=AS_OF)


def q_daily_spend(spark: SparkSession, sf: str) -> DataFrame:
    return R.daily_spend(_mart(spark, sf))


def q_daily_spend_travel(spark: SparkSession, sf: str) -> DataFrame:
    return R.daily_spend(_mart(spark, sf), "Travel", 5)


def q_top_merchants(spark: SparkSession, sf: str) -> DataFrame:
    return R.top_merchants(_fact(spark, sf), D.build_dim_merchant(_raw(spark, sf)))


def q_freshness(spark: SparkSession, sf: str) -> DataFrame:
    return R.freshness(_raw(spark, sf))


def q_weekly_top_categories(spark: SparkSession, sf: str) -> DataFrame:
    return R.weekly_top_categories(_mart(spark, sf), AS_OF)


def q_top_users(spark: SparkSession, sf: str) -> DataFrame:
    return R.top_users(D.build_dim_user(_raw(spark, sf)))


def q_flagged_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return R.flagged_transactions(_raw(spark, sf))


def q_mart_top(spark: SparkSession, sf: str) -> DataFrame:
    return R.mart_top(_mart(spark, sf))


# ---- jobs over written tables ----------------------------------------------


def _stream(
    spark: SparkSession,
    sf: str,
    table: str,
    now: datetime | None = None,
    remember: str = "table",
) -> str:
    """Run the whole table through the stream once; returns the tables' root.

    Rows keep their recorded ingest time unless `now` replaces it.
    """
    schema, to_feed = {
        "events": (EVENTS_SCHEMA, feed.transactions_from_events),
        "lineitem": (LINEITEM_SCHEMA, feed.transactions_from_lineitem),
    }[table]
    root = scratch_dir(spark, f"stream-{table}")
    # A pattern, because a stream takes a single file only through one.
    source = read_events(spark, "parquet", schema=schema, path=f"{sf}/{table}.parque[t]")
    ingest(
        to_keyed_json(to_feed(source), "ingested_at"),
        root,
        f"{root}/_checkpoint",
        {"availableNow": True},
        now=now or F.col("ingested_at"),
        order=[F.col("ingested_at"), F.col("value")],
        remember=remember,
        min_partitions=spark.sparkContext.defaultParallelism,
    ).awaitTermination()
    return root


def q_stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    root = _stream(spark, sf, "events")
    return tables.read_table(spark, root, "raw_transactions").select(*RAW_COLUMNS)


def q_stream_state(spark: SparkSession, sf: str) -> DataFrame:
    """As above, with the ids seen kept in the stream's own state."""
    root = _stream(spark, sf, "events", remember="state")
    return tables.read_table(spark, root, "raw_transactions").select(*RAW_COLUMNS)


def q_stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    root = _stream(spark, sf, "lineitem", LINEITEM_LANDED)
    return tables.read_table(spark, root, "raw_transactions").select(*RAW_COLUMNS)


def q_stream_mart(spark: SparkSession, sf: str) -> DataFrame:
    root = _stream(spark, sf, "events")
    run_batch(spark, root, _ends(tables.read_table(spark, root, "raw_transactions"))[-1])
    return tables.read_table(spark, root, "daily_spend_by_category")


def _batch(
    spark: SparkSession, raw: DataFrame, first: int = 0, **options: str
) -> str:
    """Land all rows and run up to each end from the `first`; returns the tables' root."""
    root = scratch_dir(spark, "batch")
    landing.land(raw, root)
    for high in _ends(tables.read_table(spark, root, "raw_transactions"))[first:]:
        run_batch(spark, root, high, **options)
    return root


def q_fact_incremental(spark: SparkSession, sf: str) -> DataFrame:
    root = _batch(spark, _raw(spark, sf))
    return tables.read_table(spark, root, "fact_transaction")


def q_batch_dim_user(spark: SparkSession, sf: str) -> DataFrame:
    root = _batch(spark, _raw(spark, sf))
    return tables.read_table(spark, root, "dim_user")


def q_batch_mart(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs; rows of categories that merchants have since left stay."""
    root = _batch(spark, _raw(spark, sf))
    return tables.read_table(spark, root, "daily_spend_by_category")


def q_batch_mart_full(spark: SparkSession, sf: str) -> DataFrame:
    root = _batch(spark, _raw(spark, sf), 1, mart_mode="rebuild", refresh="full")
    return tables.read_table(spark, root, "daily_spend_by_category")


def q_batch_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """Runs that are repeated, over landings of which the last is a copy of the first: nothing counts twice."""
    raw = _raw(spark, sf)
    root = scratch_dir(spark, "rerun")
    early = raw.where(F.col("ingested_at") < F.lit(EVENTS_CUT))
    landing.land(early, root)
    for _ in range(2):
        run_batch(spark, root, EVENTS_CUT)
    landing.land(raw.where(F.col("ingested_at") >= F.lit(EVENTS_CUT)), root)
    landing.land(early, root)
    last = _ends(raw)[-1]
    for day in (0, 1):
        run_batch(spark, root, last + timedelta(days=day))
    return tables.read_table(spark, root, "fact_transaction")


def q_batch_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that land after the run their stamp belongs to: the next run loads them, a full run no second time."""
    raw = _raw(spark, sf)
    late = F.pmod(F.xxhash64("transaction_id"), F.lit(7)) == 0
    root = scratch_dir(spark, "late")
    landing.land(raw.where(~late), root)
    ends = _ends(raw)
    run_batch(spark, root, ends[0])
    landing.land(raw.where(late), root)
    run_batch(spark, root, ends[1])
    run_batch(spark, root, ends[2], refresh="full")
    return tables.read_table(spark, root, "dim_user")


def q_dq_history_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The audit log that three runs have written."""
    root = scratch_dir(spark, "audit")
    landing.land(_raw(spark, sf), root)
    for at in RUN_TIMES:
        run_batch(spark, root, at, run_ts=at)
    return R.dq_history(tables.read_table(spark, root, "dq_check_log"), 9)


# ---- faults, replays, restarts ---------------------------------------------


def _faulty(spark: SparkSession, sf: str) -> DataFrame:
    """Messages with every fault planted, stored like the others."""
    return _written(spark, feed.faulty_messages(spark.read.parquet(f"{sf}/events.parquet")), "faulty")


def q_reject_counts_faulty(spark: SparkSession, sf: str) -> DataFrame:
    _, rejects = split_valid(validate(decode_events(_faulty(spark, sf))))
    return reject_counts(rejects)


def q_decode_coercion(spark: SparkSession, sf: str) -> DataFrame:
    """Unusual but good forms: text for numbers, a third decimal, other zones and none."""
    good, _ = split_valid(validate(decode_events(_faulty(spark, sf))))
    return enrich(good, now=LINEITEM_LANDED).select(*RAW_COLUMNS)


def _send_and_ingest(
    messages: DataFrame, source: str, root: str, checkpoint: str, remember: str, now: datetime | None = None
) -> None:
    """Append messages to the source, then take what is new there."""
    spark = messages.sparkSession
    messages.write.mode("append").options(**tables.COMPRESSED).parquet(source)
    ingest(
        read_events(spark, "parquet", schema=MESSAGES, path=source),
        root,
        f"{root}/{checkpoint}",
        {"availableNow": True},
        now=now or F.col("ingested_at"),
        order=[F.col("ingested_at"), F.col("value")],
        remember=remember,
        min_partitions=spark.sparkContext.defaultParallelism,
    ).awaitTermination()


def q_stream_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """The stored rejects, by their reasons."""
    root = scratch_dir(spark, "rejects")
    _send_and_ingest(_faulty(spark, sf), f"{root}/_source", root, "_checkpoint", "state")
    stored = tables.read_table(spark, root, "rejected_events")
    return stored.groupBy("reasons").agg(F.count(F.lit(1)).alias("n"))


def _replayed(spark: SparkSession, sf: str, modes: tuple[str, str]) -> DataFrame:
    """Raw rows after a stream with restarts, a repeated part and then a second checkpoint over all of it."""
    sent = to_keyed_json(feed.lineitem_feed(spark, sf), "ingested_at")
    at = F.col("ingested_at")
    cuts = [F.lit(_utc(2025, 1, 1)), F.lit(_utc(2027, 1, 1))]
    parts = [sent.where(at < cuts[0]), sent.where((at >= cuts[0]) & (at < cuts[1])), sent.where(at >= cuts[1])]
    root = scratch_dir(spark, "replay")
    for part in (*parts, parts[0]):
        _send_and_ingest(part, f"{root}/_source", root, "_first", modes[0], LONG_AGO)
    _send_and_ingest(parts[1], f"{root}/_source", root, "_second", modes[1], LONG_AGO)
    return tables.read_table(spark, root, "raw_transactions").select(*RAW_COLUMNS)


def q_stream_replay(spark: SparkSession, sf: str) -> DataFrame:
    return _replayed(spark, sf, ("table", "state"))


def q_stream_replay_state(spark: SparkSession, sf: str) -> DataFrame:
    return _replayed(spark, sf, ("state", "table"))


def q_stream_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Running totals over three starts of a stream, the last one on a clock, and over a load beside it."""
    sent = _faulty(spark, sf)
    third = F.pmod(F.xxhash64("value"), F.lit(3))
    root = scratch_dir(spark, "totals")
    for part in (0, 1):
        _send_and_ingest(sent.where(third == part), f"{root}/_source", root, "_checkpoint", "table")
    sent.where(third == 2).write.mode("append").parquet(f"{root}/_source")
    source = read_events(spark, "parquet", schema=MESSAGES, path=f"{root}/_source")
    running = ingest(source, root, f"{root}/_checkpoint", {"processingTime": "1 second"}, now=F.col("ingested_at"))
    running.processAllAvailable()
    running.stop()
    write_batch(spark, sent, root, "load", 0, now=F.col("ingested_at"))
    return landing.totals(spark, root)


def q_batch_gate(spark: SparkSession, sf: str) -> DataFrame:
    """The audit log of runs that a bad landing stops, until it is set right."""
    raw = _raw(spark, sf)
    root = scratch_dir(spark, "gate")
    n = F.substring("transaction_id", 5, 18).cast("bigint") % 50
    when = lambda k, bad, column: F.when(n == k, bad).otherwise(F.col(column)).alias(column)
    faults = {
        "user_id": when(1, F.lit(None), "user_id"),
        "amount": when(2, F.lit(0).cast(MONEY), "amount"),
        "status": when(3, F.lit("PENDING"), "status"),
    }
    late = F.col("ingested_at") >= F.lit(EVENTS_CUT)
    landing.land(raw.where(~late), root)
    run_batch(spark, root, EVENTS_CUT, run_ts=EVENTS_CUT)
    landing.land(raw.where(late).select(*[faults.get(c, F.col(c)) for c in RAW_COLUMNS]), root)
    last = _ends(raw)[-1]
    for day in (1, 2):
        with suppress(Q.DataQualityError):
            run_batch(spark, root, last + timedelta(days=day), run_ts=_utc(2024, 3, day))
    return tables.read_table(spark, root, "dq_check_log")


def all_queries() -> dict[str, Query]:
    def plain(query: Query) -> Query:
        return lambda spark, sf: _plain(query(use_utc(spark), sf))

    return {
        name[2:]: plain(query)
        for name, query in globals().items()
        if name.startswith("q_") and callable(query)
    }
