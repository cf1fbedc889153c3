from decimal import Decimal

import pytest
from helpers import as_set, raw_rows, utc

from txnlake.operators.quality import DataQualityError
from txnlake.plans import batch as B
from txnlake.sources import tables as T
from txnlake.sources.landing import land

TABLES = ("dim_user", "dim_merchant", "fact_transaction", "daily_spend_by_category")


def load(spark, root, *rows):
    land(raw_rows(spark, *rows), root)


def contents(spark, root):
    return {name: as_set(T.read_table(spark, root, name)) for name in TABLES}


def hour(i, **more):
    return {
        "transaction_id": f"txn-{i:05}",
        "user_id": i % 3 + 1,
        "merchant_id": i % 2 + 1,
        "merchant_category": ("Travel", "Health", "Cash")[i % 3],
        "event_time": utc(2026, 5, 1 + i % 3, i % 24),
        "ingested_at": utc(2026, 5, 4, i % 24),
        **more,
    }


def test_run_loads_once_and_moves_the_watermark(spark, root):
    load(spark, root, *[hour(i) for i in range(6)])
    assert T.get_watermark(spark, root, "fact_transaction") == T.EPOCH
    high = utc(2026, 5, 4, 4)
    assert B.run_batch(spark, root, high).inserted == 5
    assert T.get_watermark(spark, root, "fact_transaction") == high
    before = contents(spark, root)
    again = B.run_batch(spark, root, high)
    assert (again.inserted, again.rejected) == (0, 0)
    assert contents(spark, root) == before
    assert B.run_batch(spark, root, utc(2026, 5, 5)).inserted == 1
    marks = {r.table_name for r in T.load_watermark(spark, root).collect()}
    assert {"fact_transaction", "dim_user"} <= marks


def test_many_runs_equal_one_and_incremental_equals_full(spark, root):
    rows = [hour(i) for i in range(12)]
    roots = [f"{root}/{i}" for i in range(3)]
    for r in roots:
        load(spark, r, *rows)
    for at in (utc(2026, 5, 4, 3), utc(2026, 5, 4, 8), utc(2026, 5, 5)):
        B.run_batch(spark, roots[0], at, mart_mode="rebuild")
    B.run_batch(spark, roots[1], utc(2026, 5, 4, 6), refresh="full", mart_mode="rebuild")
    B.run_batch(spark, roots[1], utc(2026, 5, 5), refresh="full", mart_mode="rebuild")
    B.run_batch(spark, roots[2], utc(2026, 5, 5))
    want = contents(spark, roots[2])
    assert contents(spark, roots[0]) == want
    assert contents(spark, roots[1]) == want


def test_gate_stops_everything_but_the_log(spark, root):
    load(spark, root, hour(1), hour(2, amount=Decimal("0.00")))
    with pytest.raises(DataQualityError, match=r"no_nonpositive_amounts \(1\)"):
        B.run_batch(spark, root, utc(2026, 5, 5), run_ts=utc(2026, 5, 5))
    assert all(not rows for rows in contents(spark, root).values())
    log = T.read_table(spark, root, "dq_check_log").select("check_name", "passed", "detail")
    assert as_set(log) == {
        ("no_null_keys", True, "0 offending rows"),
        ("no_nonpositive_amounts", False, "1 offending rows"),
        ("valid_status", True, "0 offending rows"),
    }


def test_date_outside_the_calendar_blocks_or_is_set_aside(spark, root):
    load(spark, root, hour(1), hour(2, event_time=utc(2028, 1, 1)))
    with pytest.raises(B.MissingReferenceError):
        B.run_batch(spark, root, utc(2026, 5, 5))
    with pytest.raises(B.MissingReferenceError):
        B.run_batch(spark, root, utc(2026, 5, 6))
    assert all(not rows for rows in contents(spark, root).values())
    result = B.run_batch(spark, root, utc(2026, 5, 6), on_violation="quarantine")
    assert (result.inserted, result.rejected) == (1, 1)
    aside = T.read_table(spark, root, "fact_rejected").collect()
    assert [(r.transaction_id, r.missing) for r in aside] == [("txn-00002", ["date_key"])]
    # Read again by a full run, the row stays aside.
    B.run_batch(spark, root, utc(2026, 5, 7), refresh="full", on_violation="quarantine")
    assert T.read_table(spark, root, "fact_rejected").count() == 1
    assert {r.txn_count for r in T.read_table(spark, root, "dim_user").collect()} == {1}


def test_a_longer_calendar_unblocks(spark, root):
    load(spark, root, hour(2, event_time=utc(2028, 1, 1)))
    with pytest.raises(B.MissingReferenceError):
        B.run_batch(spark, root, utc(2026, 5, 5))
    assert B.seed_dim_date(spark, root, end=utc(2028, 12, 31).date()) == 366
    assert B.seed_dim_date(spark, root) == 0
    assert B.run_batch(spark, root, utc(2026, 5, 5)).inserted == 1


@pytest.mark.parametrize("step", ["write_version", "append_rows", "replace_days", "publish"])
def test_a_run_that_dies_is_finished_by_the_next(spark, root, monkeypatch, step):
    rows = [hour(i) for i in range(8)]
    load(spark, f"{root}/whole", *rows)
    load(spark, f"{root}/broken", *rows)
    B.run_batch(spark, f"{root}/whole", utc(2026, 5, 4, 3))
    B.run_batch(spark, f"{root}/broken", utc(2026, 5, 4, 3))
    real = getattr(B, step)
    fatal = {"write_version": "dim_user", "append_rows": "fact_transaction", "replace_days": "merchant_day", "publish": "dim_user"}

    def die_after(*args, **kwargs):
        real(*args, **kwargs)
        if any(a == fatal[step] for a in args):
            raise RuntimeError("lost")

    def die_before_publish(spark, root, versions):
        if fatal["publish"] in versions:
            raise RuntimeError("lost")
        real(spark, root, versions)

    monkeypatch.setattr(B, step, die_before_publish if step == "publish" else die_after)
    with pytest.raises(RuntimeError):
        B.run_batch(spark, f"{root}/broken", utc(2026, 5, 5))
    monkeypatch.setattr(B, step, real)
    B.run_batch(spark, f"{root}/whole", utc(2026, 5, 5))
    B.run_batch(spark, f"{root}/broken", utc(2026, 5, 5))
    assert contents(spark, f"{root}/broken") == contents(spark, f"{root}/whole")
    assert len(contents(spark, f"{root}/broken")["fact_transaction"]) == 8
    assert T.read_table(spark, f"{root}/broken", "fact_transaction").count() == 8


def test_the_next_run_loads_rows_that_land_late(spark, root):
    load(spark, root, hour(5))
    B.run_batch(spark, root, utc(2026, 5, 4, 12))
    load(spark, root, hour(3))
    assert B.run_batch(spark, root, utc(2026, 5, 4, 13)).inserted == 1
    before = contents(spark, root)
    for refresh, at in (("full", 14), ("incremental", 15)):
        assert B.run_batch(spark, root, utc(2026, 5, 4, at), refresh=refresh).inserted == 0
        assert contents(spark, root) == before
    assert T.read_table(spark, root, "fact_transaction").count() == 2
    assert sum(r.txn_count for r in T.read_table(spark, root, "dim_user").collect()) == 2


def test_rows_stamped_after_a_run_wait_for_a_later_one(spark, root):
    """A landing of which a run takes a part is looked at again, one that it takes whole is not."""
    load(spark, root, hour(1), hour(9))
    load(spark, root, hour(2))
    load(spark, root, hour(3), hour(11))
    assert B.run_batch(spark, root, utc(2026, 5, 4, 5)).inserted == 3
    mark = T.read_table(spark, root, "landing_mark").first()
    assert (mark.seen, mark.landed, mark.inserted) == (3, 0, 0)
    assert B.run_batch(spark, root, utc(2026, 5, 4, 10)).inserted == 1
    mark = T.read_table(spark, root, "landing_mark").first()
    assert (mark.seen, mark.landed, mark.inserted) == (3, 2, 3)
    load(spark, root, hour(4))
    assert B.run_batch(spark, root, utc(2026, 5, 4, 12)).inserted == 2
    mark = T.read_table(spark, root, "landing_mark").first()
    assert (mark.seen, mark.landed, mark.inserted) == (4, 4, 6)
    assert T.read_table(spark, root, "fact_transaction").count() == 6


def test_the_gate_adds_up_landings_and_does_not_read_rows(spark, root, monkeypatch):
    from txnlake.sources import landing

    load(spark, root, hour(1))
    B.run_batch(spark, root, utc(2026, 5, 5))
    load(spark, root, hour(2, amount=Decimal("0.00")), hour(3, status="ODD"), hour(4, user_id=None))
    load(spark, root, hour(5, amount=Decimal("-1.00")))
    real = T.read_table

    def no_raw(spark, root, name, *more):
        assert name != "raw_transactions"
        return real(spark, root, name, *more)

    monkeypatch.setattr(B, "read_table", no_raw)
    for at in (6, 7):
        with pytest.raises(DataQualityError, match=r"no_null_keys \(1\), no_nonpositive_amounts \(2\), valid_status \(1\)"):
            B.run_batch(spark, root, utc(2026, 5, at), run_ts=utc(2026, 5, at))
    monkeypatch.setattr(B, "read_table", real)
    log = T.read_table(spark, root, "dq_check_log").where("not passed").select("run_ts", "check_name")
    assert log.count() == 6
    # a landing that is repaired and counted again no longer blocks
    path = f"{root}/raw_transactions"
    whole = spark.createDataFrame(T.read_table(spark, root, "raw_transactions").where("landed = 1").collect(), T.read_table(spark, root, "raw_transactions").schema)
    kept = {r.landed: r.landed_hour for r in landing.landing_log(spark, root).collect()}
    whole.write.mode("overwrite").partitionBy("landed_hour").parquet(path)
    for n in (2, 3):
        landing.count_landing(spark, root, landing.Landing(n, kept[n]))
    assert B.run_batch(spark, root, utc(2026, 5, 8)).inserted == 0


def test_files_of_untouched_days_stay(spark, root):
    from pathlib import Path

    def files():
        return {
            str(p): p.stat().st_mtime_ns
            for name in ("merchant_day", "daily_spend_by_category")
            for p in Path(root, name).rglob("date_key=*/*.parquet")
        }

    for day in range(1, 6):
        load(spark, root, *[hour(i + 10 * day, event_time=utc(2026, 5, day, i), merchant_id=day, merchant_category="Travel") for i in range(3)])
    B.run_batch(spark, root, utc(2026, 5, 5))
    before = files()
    assert len({p.split("date_key=")[1][:10] for p in before}) == 5
    # new facts on the second day; the merchant of the fourth day changes its category by an event of the fifth
    load(spark, root, hour(90, event_time=utc(2026, 5, 2, 20), merchant_id=2, merchant_category="Travel"))
    load(spark, root, hour(91, event_time=utc(2026, 5, 5, 20), merchant_id=4, merchant_category="Cash"))
    assert B.run_batch(spark, root, utc(2026, 5, 6)).inserted == 2
    after = files()
    gone = {p.removeprefix(root + "/").split("/")[0] + " " + p.split("date_key=")[1][:10] for p in before if after.get(p) != before[p]}
    assert gone == {
        "merchant_day 2026-05-02", "merchant_day 2026-05-05",
        "daily_spend_by_category 2026-05-02", "daily_spend_by_category 2026-05-04", "daily_spend_by_category 2026-05-05",
    }
    mart = {(r.date_key.day, r.merchant_category): r.txn_count for r in T.read_table(spark, root, "daily_spend_by_category").collect()}
    assert mart == {(1, "Travel"): 3, (2, "Travel"): 4, (3, "Travel"): 3, (4, "Travel"): 3, (4, "Cash"): 3, (5, "Travel"): 3, (5, "Cash"): 1}
    B.run_batch(spark, root, utc(2026, 5, 7), mart_mode="rebuild")
    mart = {(r.date_key.day, r.merchant_category): r.txn_count for r in T.read_table(spark, root, "daily_spend_by_category").collect()}
    assert mart == {(1, "Travel"): 3, (2, "Travel"): 4, (3, "Travel"): 3, (4, "Cash"): 3, (5, "Travel"): 3, (5, "Cash"): 1}


def test_watermark_of_a_growing_table_can_be_set(spark, root):
    at = utc(2026, 5, 1, 2, 3, 4, 567891)
    T.set_watermark(spark, root, "raw_transactions", at)
    assert T.get_watermark(spark, root, "raw_transactions") == at
    with pytest.raises(ValueError):
        T.set_watermark(spark, root, "dim_user", at)


@pytest.mark.parametrize("bad", [{"refresh": "x"}, {"mart_mode": "x"}, {"on_violation": "x"}])
def test_options_are_checked(spark, root, bad):
    with pytest.raises(ValueError):
        B.run_batch(spark, root, **bad)
