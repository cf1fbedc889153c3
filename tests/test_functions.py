from datetime import date
from decimal import Decimal

import pytest
from helpers import as_set, event, utc
from pyspark.sql import functions as F

from txnlake.functions.money import money, money_sum, to_gbp
from txnlake.functions.rules import HIGH_VALUE_GBP, flag_suspicious, is_alpha
from txnlake.functions.times import date_key, iso_date, to_utc
from txnlake.operators.dims import build_dim_date
from txnlake.operators.enrich import enrich
from txnlake.operators.mart import daily_spend_by_category
from txnlake.sources.rates import fx_rates, supported_currencies, with_rate


def convert(spark, amount, currency):
    df = spark.createDataFrame([(Decimal(amount), currency)], "amount decimal(38,18), currency string")
    return with_rate(df).select(to_gbp(F.col("amount"), F.col("rate"))).first()[0]


@pytest.mark.parametrize(
    "amount, currency, gbp",
    [
        ("100.00", "GBP", "100.00"),
        ("12.70", "USD", "10.00"),
        ("12.70", "usd", "10.00"),
        ("1.00", "INR", "0.01"),
        ("2.345", "GBP", "2.35"),
        ("0.005", "GBP", "0.01"),
        ("0.00499999999999", "GBP", "0.00"),
        ("9999999999999999.99", "GBP", "9999999999999999.99"),
    ],
)
def test_conversion_rounds_half_up(spark, amount, currency, gbp):
    assert convert(spark, amount, currency) == Decimal(gbp)


def test_no_rate_gives_no_amount(spark):
    assert convert(spark, "10.00", "ZZZ") is None


def test_conversion_agrees_with_whole_number_arithmetic(spark):
    pence = spark.range(1, 20001).select(F.col("id").alias("p"))
    rates = fx_rates(spark).select((F.col("rate") * 100).cast("bigint").alias("r"), "rate")
    both = pence.join(F.broadcast(rates)).select(
        to_gbp((F.col("p") / F.lit(Decimal(100))).cast("decimal(38,18)"), F.col("rate")).alias("got"),
        (F.expr("(200 * p + r) div (2 * r)") / F.lit(Decimal(100))).cast("decimal(18,2)").alias("want"),
    )
    assert both.where(F.col("got") != F.col("want")).count() == 0


def test_currencies_are_sorted(spark):
    got = [r.currency for r in supported_currencies(fx_rates(spark)).collect()]
    assert got == sorted(got) and "GBP" in got and len(got) == 8


def test_storing_rounds_half_up_and_empty_sum_is_zero(spark):
    df = spark.createDataFrame([(Decimal("23.455"),)], "a decimal(38,18)")
    assert df.select(money(F.col("a"))).first()[0] == Decimal("23.46")
    assert df.agg(money_sum(F.col("a"), F.lit(False))).first()[0] == Decimal("0.00")


def test_alpha_takes_letters_only(spark):
    words = ["GBP", "éàü", "GB1", "GB", "GBPP", "GBP\n", ""]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r[0] for r in df.select(is_alpha(F.col("w"), 3)).collect()]
    assert got == [True, True, False, False, False, False, False]


@pytest.mark.parametrize(
    "text, want",
    [
        ("2026-05-01T10:00:00+00:00", utc(2026, 5, 1, 10)),
        ("2026-05-01T10:00:00+02:00", utc(2026, 5, 1, 8)),
        ("2026-05-01 10:00", utc(2026, 5, 1, 10)),
        ("2026-05-01T10:00:00", utc(2026, 5, 1, 10)),
        ("2026-05-01t10:00:00z", utc(2026, 5, 1, 10)),
        ("2026-05-01_10:00+0200", utc(2026, 5, 1, 8)),
        ("2026-05-01", utc(2026, 5, 1)),
        ("2026-05-01T10:00:00.1234567Z", utc(2026, 5, 1, 10, 0, 0, 123456)),
        ("1777629600", utc(2026, 5, 1, 10)),
        ("1777629600000", utc(2026, 5, 1, 10)),
        ("1777629600.5", utc(2026, 5, 1, 10, 0, 0, 500000)),
        ("2026-5-1", None),
        ("2026-13-01", None),
        ("now", None),
        ("yesterday", None),
        ("10:00", None),
        ("", None),
        ("99999999999999999999", None),
    ],
)
def test_event_time_text(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string").select(to_utc(F.col("t")).alias("t"))
    got = df.select(F.unix_micros("t")).first()[0]
    assert got == (None if want is None else round(want.timestamp() * 1_000_000))


def test_dates_are_utc(spark):
    df = spark.createDataFrame([(utc(2026, 5, 1, 23, 59),)], "t timestamp")
    day = date_key(F.col("t"))
    assert tuple(df.select(day, iso_date(day)).first()) == (date(2026, 5, 1), "2026-05-01")


@pytest.mark.parametrize(
    "gbp, status, has_rate, want",
    [
        ("100.00", "AUTHORISED", True, False),
        ("4999.99", "DECLINED", True, False),
        (str(HIGH_VALUE_GBP), "DECLINED", True, True),
        ("9000.00", "AUTHORISED", True, True),
        ("1.00", "AUTHORISED", False, True),
        ("1.00", "DECLINED", False, False),
        (None, "AUTHORISED", False, True),
        (None, "REVERSED", False, False),
    ],
)
def test_flag(spark, gbp, status, has_rate, want):
    row = (gbp and Decimal(gbp), status, has_rate)
    df = spark.createDataFrame([row], "g decimal(18,2), s string, h boolean")
    assert df.select(flag_suspicious(F.col("g"), F.col("s"), F.col("h"))).first()[0] is want


def test_enrich_converts_and_takes_the_given_clock(spark):
    now = utc(2026, 5, 3, 6, 30, 1)
    out = enrich(event(spark, {"amount": Decimal("31.75"), "currency": "usd"}), now=now)
    row = out.select("*", (F.col("ingested_at") == F.lit(now)).alias("same")).first()
    assert row.amount_gbp == Decimal("25.00") and row.same
    assert (row.currency, row.country, row.is_flagged) == ("USD", "GB", False)


def test_enrich_uses_the_amount_as_sent(spark):
    row = enrich(event(spark, {"amount": Decimal("0.001")})).first()
    assert (row.amount, row.amount_gbp) == (Decimal("0.00"), Decimal("0.00"))
    row = enrich(event(spark, {"amount": Decimal("1.004"), "currency": "INR"})).first()
    assert (row.amount, row.amount_gbp) == (Decimal("1.00"), Decimal("0.01"))


def test_daily_spend_counts_authorised_per_day_and_category(spark):
    rows = event(
        spark,
        {"amount": Decimal("4.20")},
        {"amount": Decimal("6.35")},
        {"amount": Decimal("71.00"), "status": "DECLINED"},
        {"amount": Decimal("33.10"), "merchant_category": "Utilities"},
        {"amount": Decimal("8.90"), "merchant_category": "Utilities", "event_time": utc(2026, 5, 2, 3)},
    )
    assert as_set(daily_spend_by_category(enrich(rows))) == {
        ("2026-05-01", "Restaurants", Decimal("10.55")),
        ("2026-05-01", "Utilities", Decimal("33.10")),
        ("2026-05-02", "Utilities", Decimal("8.90")),
    }


def test_calendar(spark):
    cal = build_dim_date(spark)
    assert cal.count() == 1461
    first = cal.orderBy("date_key").first()
    assert tuple(first) == (date(2024, 1, 1), 1, 1, 2024, 0, False)
    sunday = cal.where("date_key = '2024-02-25'").first()
    assert (sunday.weekday, sunday.is_weekend) == (6, True)


def test_enrich_fails_without_a_rate(spark):
    with pytest.raises(Exception, match="no rate for currency ZZZ"):
        enrich(event(spark, {"currency": "zzz"})).collect()
