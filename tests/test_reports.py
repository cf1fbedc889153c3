from datetime import date, timedelta
from decimal import Decimal

import pytest
from helpers import as_set, raw_rows, utc

from txnlake import schemas as S
from txnlake.operators.dims import build_dim_merchant, build_dim_user
from txnlake.operators.facts import to_fact
from txnlake.plans import reports as R


@pytest.fixture(scope="module")
def raw(spark):
    day = lambda d: utc(2025, 3, d)
    rows = [
        {"user_id": 1, "merchant_id": 1, "amount_gbp": Decimal("64.80"), "event_time": day(1)},
        {"user_id": 1, "merchant_id": 2, "amount_gbp": Decimal("22.35"), "event_time": day(31)},
        {"user_id": 1, "merchant_id": 2, "amount_gbp": Decimal("7.00"), "event_time": day(5), "status": "DECLINED"},
        {"user_id": 2, "merchant_id": 3, "amount_gbp": Decimal("22.35"), "event_time": utc(2025, 4, 1)},
        {"user_id": 2, "merchant_id": 4, "amount_gbp": Decimal("9000.00"), "event_time": day(9),
         "status": "REVERSED", "is_flagged": True},
    ]
    return raw_rows(spark, *[{"transaction_id": f"txn-{i:04}", **r} for i, r in enumerate(rows)]).cache()


def spend(raw, *args, **kwargs):
    return R.user_spend(to_fact(raw), build_dim_user(raw), *args, **kwargs)


def test_user_spend_both_ends_count(raw):
    row = spend(raw, 1, "2025-03-01", date(2025, 3, 31)).collect()
    assert [tuple(r) for r in row] == [
        (1, date(2025, 3, 1), date(2025, 3, 31), Decimal("87.15"), 2)
    ]


def test_unknown_user_has_no_row_and_idle_user_has_zero(raw):
    assert spend(raw, 40).count() == 0
    row = spend(raw, 1, "2024-11-01", "2024-11-30").first()
    assert (row.total_gbp, row.txn_count) == (Decimal("0.00"), 0)


def test_window_defaults_to_thirty_days(raw):
    today = date(2025, 3, 31)
    row = spend(raw, 1, as_of=today).first()
    assert (row.from_date, row.to_date) == (today - timedelta(days=30), today)
    assert R.spend_window(None, "2025-06-01", today) == (date(2025, 3, 1), date(2025, 6, 1))
    with pytest.raises(ValueError):
        R.spend_window("31st of May", None)


def test_spend_of_all_users(raw):
    got = R.user_spend_all(to_fact(raw), build_dim_user(raw), "2025-03-01", "2025-03-31")
    assert as_set(got.select("user_id", "total_gbp", "txn_count")) == {
        (1, Decimal("87.15"), 2),
        (2, Decimal("0.00"), 0),
    }


MART_ROWS = [
    (date(2025, 9, 1), "Utilities", Decimal("41.00"), 7, 0),
    (date(2025, 9, 1), "Health", Decimal("610.25"), 3, 0),
    (date(2025, 8, 31), "Transport", Decimal("77.70"), 4, 1),
    (date(2025, 8, 21), "Transport", Decimal("805.00"), 6, 1),
]


def test_daily_spend(spark):
    mart = spark.createDataFrame(MART_ROWS, S.MART)
    got = R.daily_spend(mart, limit=3).collect()
    assert [(r.date_key.day, r.merchant_category) for r in got] == [
        (1, "Health"), (1, "Utilities"), (31, "Transport"),
    ]
    assert [r.flagged_count for r in R.daily_spend(mart, "Transport", 1).collect()] == [1]
    assert [r.total_gbp for r in R.mart_top(mart, 2).collect()] == [Decimal("610.25"), Decimal("41.00")]
    weekly = R.weekly_top_categories(mart, date(2025, 9, 2)).collect()
    assert [r.merchant_category for r in weekly] == ["Health", "Transport", "Utilities"]
    assert weekly[1].weekly_gbp == Decimal("77.70")


@pytest.mark.parametrize("limit", [0, 366, -1, "5", None])
def test_daily_spend_limit(spark, limit):
    with pytest.raises(ValueError):
        R.daily_spend(spark.createDataFrame([], S.MART), limit=limit)


@pytest.mark.parametrize("limit", [0, 101])
def test_top_merchants_limit(raw, limit):
    with pytest.raises(ValueError):
        R.top_merchants(to_fact(raw), build_dim_merchant(raw), limit)


def test_top_merchants_breaks_ties_by_id(raw):
    got = R.top_merchants(to_fact(raw), build_dim_merchant(raw), 3).collect()
    assert [(r.merchant_id, r.total_gbp, r.txn_count) for r in got] == [
        (1, Decimal("64.80"), 1), (2, Decimal("22.35"), 1), (3, Decimal("22.35"), 1),
    ]


def test_small_reports(raw, spark):
    assert R.freshness(raw).first().row_count == 5
    assert R.fact_count(to_fact(raw)).first().row_count == 5
    assert [r.user_id for r in R.top_users(build_dim_user(raw), 1).collect()] == [1]
    assert [r.transaction_id for r in R.flagged_transactions(raw).collect()] == ["txn-0004"]
    log = spark.createDataFrame(
        [(utc(2026, 1, d), name, True, "") for d in (1, 2) for name in "ba"], S.DQ_LOG
    )
    assert [r.check_name for r in R.dq_history(log, 3).collect()] == ["a", "b", "a"]


def test_top_k_is_not_a_full_sort(raw):
    plan = R.top_merchants(to_fact(raw), build_dim_merchant(raw))._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in plan
