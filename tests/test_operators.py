from datetime import date
from decimal import Decimal

import pytest
from helpers import as_set, raw_rows, utc
from pyspark.sql import functions as F

from txnlake.operators import dims, facts, mart, quality
from txnlake.operators import upsert as U
from txnlake.sources.tables import EPOCH


def kv(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, v int")


def test_append_new_first_wins_and_known_stay_out(spark):
    target = kv(spark, ("a", 1))
    batch = kv(spark, ("a", 9), ("b", 2), ("b", 1), ("c", 5))
    got = U.append_new(target, batch, "k", [F.col("v")])
    assert as_set(got) == {("b", 1), ("c", 5)}


def test_append_new_is_a_no_op_the_second_time(spark):
    batch = kv(spark, ("a", 1), ("b", 2))
    once = U.append_new(kv(spark, ("z", 0)), batch, "k")
    assert U.append_new(kv(spark, ("z", 0)).unionByName(once), batch, "k").count() == 0


def test_one_key_with_nearly_all_rows(spark):
    hot = spark.range(20000).select(F.lit("hot").alias("k"), F.col("id").cast("int").alias("v"))
    rest = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit(0).alias("v"))
    got = U.first_per_key(hot.unionByName(rest), "k", [F.col("v")])
    assert got.count() == 101 and got.where("k = 'hot'").first().v == 0


def test_rank_limit_runs_before_the_shuffle(spark):
    plan = U.first_per_key(
        spark.range(10).selectExpr("id % 2 AS k", "id AS v"), "k", [F.col("v")]
    )._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Partial")


def test_merge_replace(spark):
    got = U.merge_replace(kv(spark, ("a", 1), ("b", 2)), kv(spark, ("b", 9), ("c", 3)), "k")
    assert as_set(got) == {("a", 1), ("b", 9), ("c", 3)}


def test_merge_replace_takes_a_null_from_the_source(spark):
    assert as_set(U.merge_replace(kv(spark, ("a", 1)), kv(spark, ("a", None)), "k")) == {("a", None)}


USER = "user_id bigint, first_seen timestamp, last_seen timestamp, txn_count bigint"


def users(spark, *rows):
    return spark.createDataFrame([(u, utc(2026, 1, a), utc(2026, 1, b), n) for u, a, b, n in rows], USER)


def days(df):
    rows = df.select("user_id", F.day("first_seen"), F.day("last_seen"), "txn_count").collect()
    return {tuple(r) for r in rows}


def test_merge_users_widens_and_replaces_the_count(spark):
    old, new = users(spark, (1, 5, 10, 7), (2, 1, 2, 3)), users(spark, (1, 6, 12, 4), (3, 9, 9, 1))
    assert days(U.merge_dim_user(old, new)) == {(1, 5, 12, 4), (2, 1, 2, 3), (3, 9, 9, 1)}
    assert days(U.merge_dim_user(old, new, add_counts=True)) == {(1, 5, 12, 11), (2, 1, 2, 3), (3, 9, 9, 1)}


def test_latest_merchant_and_its_tie(spark):
    raw = raw_rows(
        spark,
        {"transaction_id": "txn-0001", "merchant_category": "A"},
        {"transaction_id": "txn-0002", "merchant_category": "B", "event_time": utc(2026, 5, 2)},
        {"transaction_id": "txn-0003", "merchant_category": "C", "event_time": utc(2026, 5, 2)},
        {"transaction_id": "txn-0004", "merchant_category": "D", "merchant_id": 8},
    )
    got = as_set(dims.build_dim_merchant(raw).select("merchant_id", "merchant_category"))
    assert got == {(58, "C"), (8, "D")}


def test_merchants_in_two_steps_equal_one(spark):
    rows = [
        {"transaction_id": f"txn-{i:04}", "merchant_id": i % 3 + 1, "merchant_category": str(i * 7 % 5),
         "event_time": utc(2026, 5, 1 + i * 5 % 11)}
        for i in range(20)
    ]
    whole = dims.latest_merchants(raw_rows(spark, *rows))
    steps = dims.merge_latest_merchants(
        dims.latest_merchants(raw_rows(spark, *rows[:9])), raw_rows(spark, *rows[9:])
    )
    assert as_set(whole) == as_set(steps)


def test_window_is_open_below_and_closed_above(spark):
    low, high = utc(2026, 5, 1, 10), utc(2026, 5, 1, 11)
    raw = raw_rows(
        spark,
        {"transaction_id": "at-low", "ingested_at": low},
        {"transaction_id": "inside", "ingested_at": utc(2026, 5, 1, 10, 30)},
        {"transaction_id": "at-high", "ingested_at": high},
        {"transaction_id": "after", "ingested_at": utc(2026, 5, 1, 11, 0, 0, 1)},
    )
    assert {r[0] for r in facts.raw_window(raw, low, high).select("transaction_id").collect()} == {
        "inside",
        "at-high",
    }


def test_split_windows_equal_one_load(spark):
    raw = raw_rows(
        spark,
        *[{"transaction_id": f"txn-{i:04}", "ingested_at": utc(2026, 5, 1, i)} for i in range(12)],
    )
    empty = facts.to_fact(raw).limit(0)
    whole = facts.load_fact(empty, raw, EPOCH, utc(2026, 5, 1, 11))
    first = facts.load_fact(empty, raw, EPOCH, utc(2026, 5, 1, 6))
    second = facts.load_fact(first, raw, utc(2026, 5, 1, 3), utc(2026, 5, 1, 11))
    assert whole.count() == 12
    assert as_set(first.unionByName(second)) == as_set(whole)
    assert facts.facts_after(whole, utc(2026, 5, 1, 9)).first()[0] == 12


def test_missing_references_are_named(spark):
    raw = raw_rows(
        spark,
        {"transaction_id": "good"},
        {"transaction_id": "late", "event_time": utc(2028, 1, 1)},
        {"transaction_id": "both", "user_id": 5, "merchant_id": 9},
    )
    known = raw.where("transaction_id <> 'both'")
    dimensions = {
        "date_key": dims.build_dim_date(spark),
        "user_id": dims.build_dim_user(known),
        "merchant_id": dims.build_dim_merchant(known),
    }
    good, bad = facts.split_references(facts.to_fact(raw), dimensions)
    assert {r.transaction_id for r in good.collect()} == {"good"}
    assert {r.transaction_id: r.missing for r in bad.collect()} == {
        "late": ["date_key"],
        "both": ["user_id", "merchant_id"],
    }


def test_mart_counts_and_stale_rows(spark):
    raw = raw_rows(
        spark,
        {"transaction_id": "txn-1", "amount_gbp": Decimal("10.00")},
        {"transaction_id": "txn-2", "amount_gbp": Decimal("20.00"), "status": "DECLINED", "is_flagged": True},
    )
    first = mart.build_daily_mart(facts.to_fact(raw), dims.build_dim_merchant(raw))
    day = date(2026, 5, 1)
    assert as_set(first) == {(day, "Restaurants", Decimal("10.00"), 1, 1)}

    moved = raw.unionByName(
        raw_rows(
            spark,
            {"transaction_id": "txn-3", "merchant_category": "Travel", "status": "REVERSED",
             "event_time": utc(2026, 5, 2)},
        )
    )
    fresh = mart.build_daily_mart(facts.to_fact(moved), dims.build_dim_merchant(moved))
    travel = {
        (day, "Travel", Decimal("10.00"), 1, 1),
        (date(2026, 5, 2), "Travel", Decimal("0.00"), 0, 0),
    }
    assert as_set(mart.refresh_mart(first, fresh, "rebuild")) == travel
    assert as_set(mart.refresh_mart(first, fresh)) == travel | as_set(first)
    with pytest.raises(ValueError):
        mart.refresh_mart(first, fresh, "other")


def test_totals_add_up_in_steps(spark):
    rows = raw_rows(
        spark,
        *[{"transaction_id": f"txn-{i:04}", "merchant_id": i % 2 + 1, "amount_gbp": Decimal(i),
           "status": ("AUTHORISED", "DECLINED")[i % 3 == 0]} for i in range(10)],
    )
    f = facts.to_fact(rows)
    early = F.col("transaction_id") < "txn-0004"
    steps = mart.add_merchant_days(
        mart.merchant_day_totals(f.where(early)), mart.merchant_day_totals(f.where(~early))
    )
    assert as_set(steps) == as_set(mart.merchant_day_totals(f))


def test_gate_counts_and_raises(spark):
    raw = raw_rows(
        spark,
        {"transaction_id": None},
        {"amount": Decimal("0.00")},
        {"amount": Decimal("-1.00"), "merchant_id": None},
        {"status": "PENDING"},
        {"status": None},
        {},
    )
    results = quality.run_quality_gate(raw)
    assert [tuple(r) for r in results] == [
        ("no_null_keys", 2),
        ("no_nonpositive_amounts", 2),
        ("valid_status", 1),
    ]
    with pytest.raises(quality.DataQualityError) as e:
        quality.require_passed(results)
    assert str(e.value) == (
        "raw rows break these checks: no_null_keys (2), no_nonpositive_amounts (2), valid_status (1)"
    )
    audit = quality.check_results(quality.counts_frame(spark, results), utc(2026, 5, 1))
    assert audit.select("passed", "detail").first().detail == "2 offending rows"
    quality.require_passed(quality.run_quality_gate(raw_rows(spark, {})))
