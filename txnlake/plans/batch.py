"""The hourly run: gate, dimensions, facts, mart.

The load watermark is a landing number: a run takes what has landed since the
last one, whatever its stamps say, and the gate adds up the counts that were taken
of each landing. A run first writes the new raw rows of its window to a pending version and
publishes that. Everything else is computed from the pending rows, and one
publish at the end makes all results current and moves the watermark. A run
that dies in between is finished by the next one from the same pending rows.

Totals per merchant and day and the mart are refreshed by day: only the days of new
facts, and in the mart those of merchants that have changed category. Both
are computed from what is stored for these days, so a run that does it twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from txnlake.functions.times import date_key
from txnlake.operators import dims as D
from txnlake.operators.facts import split_references, to_fact
from txnlake.operators.mart import category_totals, merchant_day_totals, refresh_mart
from txnlake.operators.quality import (
    check_results,
    checks,
    counts_frame,
    quality_counts,
    require_passed,
)
from txnlake.operators.upsert import append_new, merge_dim_user, merge_replace
from txnlake.schemas import LANDING_COUNTS
from txnlake.session import use_utc
from txnlake.sources import landing as L
from txnlake.sources.landing import Landing
from txnlake.sources.tables import (
    DAILY,
    EPOCH,
    Version,
    append_rows,
    current_versions,
    publish,
    read_table,
    replace_days,
    write_version,
)

MARK = "landing_mark"
FACT = "fact_transaction"
MART = "daily_spend_by_category"
PENDING = "pending_transactions"


class MissingReferenceError(ValueError):
    """Fact rows whose date, user or merchant has no dimension row."""


@dataclass(frozen=True)
class RunResult:
    low: datetime
    high: datetime
    inserted: int
    rejected: int


@dataclass(frozen=True)
class _Options:
    refresh: str
    mart_mode: str
    on_violation: str


def _together(*jobs: Callable[[], object]) -> list:
    """Run independent Spark jobs side by side; the first failure is raised."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def seed_dim_date(spark: SparkSession, root: str, start=D.FIRST_DATE, end=D.LAST_DATE) -> int:
    """Add the days that the date dimension lacks; returns how many."""
    versions = current_versions(spark, root)
    existing = read_table(spark, root, "dim_date", versions)
    missing = append_new(existing, D.build_dim_date(spark, start, end), "date_key")
    added = missing.count()
    if added:
        version = versions["dim_date"].version + 1 if "dim_date" in versions else 1
        write_version(existing.unionByName(missing).coalesce(1), root, "dim_date", version)
        publish(spark, root, {"dim_date": Version(version, EPOCH)})
    return added


def _mark(spark: SparkSession, root: str, versions: dict[str, Version]) -> tuple[Landing, dict[str, int]]:
    """The last landing that runs have taken in full, and the counts of all up to there."""
    row = read_table(spark, root, MARK, versions).first()
    if row is None:
        return Landing(), dict.fromkeys(LANDING_COUNTS, 0)
    return Landing(row.landed, row.landed_hour), {c: row[c] for c in LANDING_COUNTS}


@dataclass(frozen=True)
class _Window:
    """What a run looks at: landings after `low` up to `upto`, and rows stamped up to `high`.

    Landings up to `mark` hold no later stamp; `totals` counts these. `offending` is the number of
    rows that break each check among all that have landed.
    """

    low: Landing
    upto: int
    high: datetime
    mark: Landing
    totals: dict[str, int]
    offending: dict[str, int]

    def rows(self, raw: DataFrame, low: Landing | None = None) -> DataFrame:
        rows = L.after(raw, self.low if low is None else low).where(F.col("landed") <= self.upto)
        return rows.where(F.col("ingested_at") <= F.lit(self.high))


def _window(spark: SparkSession, root: str, versions: dict[str, Version], high: datetime) -> _Window:
    """Add up the log rows of the landings since the last run. Raw rows are read only of
    landings with stamps after `high`, which a run up to now does not have.
    """
    low, done = _mark(spark, root, versions)
    log = L.landing_log(spark, root, low)
    whole = F.coalesce(F.col("last_ingested") <= F.lit(high), F.lit(True))
    sums = lambda which, name: [F.coalesce(F.sum(F.when(which, F.col(c))), F.lit(0)).alias(f"{name}_{c}") for c in LANDING_COUNTS]
    places = F.struct("landed", "landed_hour")
    found = log.agg(
        *sums(whole, "whole"), F.max(places).alias("last"), F.min(F.when(~whole, F.col("landed"))).alias("part")
    ).first()
    last = Landing(*found["last"]) if found["last"] else low
    upto, offending = last.landed, {c: done[c] + found[f"whole_{c}"] for c in checks()}
    if found.part is None:
        return _Window(low, upto, high, last, {c: done[c] + found[f"whole_{c}"] for c in LANDING_COUNTS}, offending)
    known, before = F.col("landed") <= upto, F.col("landed") < found.part
    taken = log.agg(*sums(before, "before"), F.max(F.when(before, places)).alias("mark")).first()
    mark = Landing(*taken.mark) if taken.mark else low
    window = _Window(low, upto, high, mark, {c: done[c] + taken[f"before_{c}"] for c in LANDING_COUNTS}, offending)
    parts = log.where(known & ~whole).select("landed")
    rows = window.rows(read_table(spark, root, "raw_transactions")).join(parts, "landed", "left_semi")
    for row in quality_counts(rows).collect():
        offending[row.check_name] += row.offending
    return window


def quality_gate(spark: SparkSession, root: str, offending: dict[str, int], run_ts: datetime) -> None:
    """Log the result of every check, and only then raise if any failed."""
    results = [Row(check_name=check, offending=n) for check, n in offending.items()]
    append_rows(check_results(counts_frame(spark, results), run_ts), root, "dq_check_log")
    require_passed(results)


def _event_days(rows: DataFrame, dim_date: DataFrame) -> list:
    """Calendar days among the rows' events: at most one row per day of the date dimension reaches the driver."""
    days = rows.select(date_key(F.col("event_time")).alias("date_key")).distinct()
    return [r[0] for r in days.join(dim_date.select("date_key"), "date_key", "left_semi").collect()]


def _unknown(spark: SparkSession, root: str, rows: DataFrame, days: list) -> DataFrame:
    """Rows whose id is in neither the fact table nor its rejects, the first ingested of each id.

    Copies of an id are looked for on the event days of the rows themselves: only
    those fact partitions are read.
    """
    fact = read_table(spark, root, FACT).where(F.col("date_key").isin(days))
    fresh = append_new(fact, rows, "transaction_id", [F.col("ingested_at")])
    return append_new(read_table(spark, root, "fact_rejected"), fresh, "transaction_id")


def _stage(
    spark: SparkSession, root: str, versions: dict[str, Version], high: datetime, run_ts: datetime, options: _Options
) -> dict[str, Version]:
    """Gate all that has landed and publish the window's new rows as pending, with the landings taken."""
    window = _window(spark, root, versions, high)
    quality_gate(spark, root, window.offending, run_ts)
    # raw rows only behind the gate
    start = Landing() if options.refresh == "full" else None
    rows = window.rows(read_table(spark, root, "raw_transactions"), start)
    days = _event_days(rows, read_table(spark, root, "dim_date", versions))
    new = _unknown(spark, root, rows, days)
    version = versions[FACT].version + 1 if FACT in versions else 1
    mark = {"seen": window.upto, "landed": window.mark.landed, "landed_hour": window.mark.hour, **window.totals}
    mark = spark.range(0, 1, 1, 1).select(*[F.lit(x).alias(c) for c, x in mark.items()])
    _together(
        lambda: write_version(new.drop("landed", "landed_hour"), root, PENDING, version),
        lambda: write_version(mark, root, MARK, version),
    )
    publish(spark, root, {PENDING: Version(version, high)})
    return {**versions, PENDING: Version(version, high)}


def _finish(
    spark: SparkSession, root: str, versions: dict[str, Version], options: _Options, resumed: bool
) -> tuple[int, int]:
    """Build everything from the pending rows, then publish. (inserted, rejected)."""
    version, high = versions[PENDING].version, versions[PENDING].last_loaded
    table = lambda name: read_table(spark, root, name, versions)
    new = table(PENDING)

    if options.refresh == "full":
        seen = read_table(spark, root, MARK, {MARK: Version(version, high)}).first().seen
        raw = table("raw_transactions").where((F.col("landed") <= seen) & (F.col("ingested_at") <= F.lit(high)))
        users = merge_dim_user(table("dim_user"), D.build_dim_user(raw))
        merchants = merge_replace(
            table("dim_merchant"), D.latest_merchants(raw), "merchant_id"
        )
    else:
        users = merge_dim_user(table("dim_user"), D.build_dim_user(new), add_counts=True)
        merchants = D.merge_latest_merchants(table("dim_merchant"), new)
    _together(
        lambda: write_version(users, root, "dim_user", version),
        lambda: write_version(merchants, root, "dim_merchant", version),
    )
    done = {name: Version(version, high) for name in (FACT, "dim_user", "dim_merchant")}
    written = {**versions, **done}

    facts = to_fact(new)
    dims = {
        "date_key": table("dim_date"),
        "user_id": read_table(spark, root, "dim_user", written),
        "merchant_id": read_table(spark, root, "dim_merchant", written),
    }
    good, bad = split_references(facts, dims)
    rejected, pending, days = _together(bad.count, new.count, lambda: _event_days(new, table("dim_date")))
    if rejected and options.on_violation == "fail":
        raise MissingReferenceError(f"{rejected} fact rows lack a dimension row")
    if not rejected:
        good = facts
    inserted = pending - rejected
    to_write, to_reject = good, bad
    if resumed:
        # The earlier attempt may have written some of these.
        known = table(FACT).where(F.col("date_key").isin(days))
        to_write = append_new(known, good, "transaction_id")
        to_reject = append_new(table("fact_rejected"), bad, "transaction_id")

    append_rows(to_write, root, FACT)
    if rejected:
        append_rows(to_reject, root, "fact_rejected")
    touched = None if options.refresh == "full" else days
    _refresh_days(spark, root, touched, table("dim_merchant"), dims["merchant_id"], options.mart_mode)
    done[MARK] = Version(version, high)
    for name in DAILY:
        done[name] = Version(version, high)
    publish(spark, root, done)
    return inserted, rejected


def _refresh_days(
    spark: SparkSession, root: str, touched: list[date] | None, before: DataFrame, merchants: DataFrame, mode: str
) -> None:
    """Bring the daily tables up to date for the days of new facts, or for all days.

    The totals of a touched day are counted again from its facts. The mart is rolled up again for these
    days and for all days of merchants whose category has changed; a rebuild rolls up all days.
    """
    of = lambda name, days: read_table(spark, root, name).where(F.col("date_key").isin(days))
    facts = read_table(spark, root, FACT) if touched is None else of(FACT, touched)
    replace_days(merchant_day_totals(facts), root, "merchant_day")
    totals, mart = read_table(spark, root, "merchant_day"), read_table(spark, root, MART)
    if touched is not None and mode == "merge":
        was = before.select("merchant_id", F.col("merchant_category").alias("_was"))
        moved = merchants.join(was, "merchant_id").where(~F.col("_was").eqNullSafe(F.col("merchant_category")))
        moved = totals.join(moved.select("merchant_id"), "merchant_id", "left_semi").select("date_key").distinct()
        # at most one row per day of the calendar reaches the driver
        days = sorted({*touched, *[r[0] for r in moved.collect()]})
        totals, mart = of("merchant_day", days), of(MART, days)
    replace_days(refresh_mart(mart, category_totals(totals, merchants), mode), root, MART)


def run_batch(
    spark: SparkSession,
    root: str,
    high: datetime | None = None,
    refresh: str = "incremental",
    mart_mode: str = "merge",
    on_violation: str = "fail",
    run_ts: datetime | None = None,
) -> RunResult:
    """Load the raw rows that have landed since the last run and are stamped up to `high`, once.

    A row that lands late is loaded by the next run, whatever its stamp; one stamped after `high`
    waits for a run with a later `high`. `refresh="full"` looks at every raw row, loads
    those not loaded yet and recomputes dimensions and totals from all raw and fact rows
    instead of folding in the new ones; both give the same tables over the same rows.
    `on_violation` is `fail`, which blocks this and later runs until solved, or
    `quarantine`.
    """
    if refresh not in ("incremental", "full"):
        raise ValueError(f"refresh must be 'incremental' or 'full', not {refresh!r}")
    if mart_mode not in ("merge", "rebuild"):
        raise ValueError(f"mart_mode must be 'merge' or 'rebuild', not {mart_mode!r}")
    if on_violation not in ("fail", "quarantine"):
        raise ValueError(f"on_violation must be 'fail' or 'quarantine', not {on_violation!r}")
    use_utc(spark)
    options = _Options(refresh, mart_mode, on_violation)
    high = high or datetime.now(timezone.utc)
    run_ts = run_ts or datetime.now(timezone.utc)

    versions = current_versions(spark, root)
    if "dim_date" not in versions:
        seed_dim_date(spark, root)
        versions = current_versions(spark, root)
    loaded = versions.get(FACT, Version(0, EPOCH))
    inserted = rejected = 0
    if PENDING in versions and versions[PENDING].version > loaded.version:
        # Its rows may be fewer than a full run would load, so they are folded in.
        folded = replace(options, refresh="incremental")
        inserted, rejected = _finish(spark, root, versions, folded, resumed=True)
        versions = current_versions(spark, root)
        loaded = versions[FACT]
    low = loaded.last_loaded
    if high > low:
        versions = _stage(spark, root, versions, high, run_ts, options)
        more, bad = _finish(spark, root, versions, options, resumed=False)
        inserted, rejected = inserted + more, rejected + bad
    return RunResult(low, high, inserted, rejected)
