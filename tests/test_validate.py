import json

import pytest
from helpers import BASE, message, messages
from pyspark.sql import functions as F

from txnlake.operators.validate import split_valid, validate
from txnlake.sources.events import decode_events, to_keyed_json

ACCEPTED = {
    "as is": {},
    "number as text": {"user_id": "311"},
    "whole float": {"user_id": 311.0},
    "whole float as text": {"merchant_id": "58.0"},
    "amount as number": {"amount": 18.60},
    "tiny amount": {"amount": "0.001"},
    "largest amount": {"amount": "9999999999999999.99"},
    "naive time": {"event_time": "2026-05-01 10:00"},
    "epoch": {"event_time": 1777629600},
    "unknown field": {"extra": {"transaction_id": 5}},
    "letters of another script": {"merchant_name": "ż"},
}

REJECTED = {
    "short id": ({"transaction_id": "txn-001"}, "transaction_id"),
    "id as number": ({"transaction_id": 12345678}, "transaction_id"),
    "no id": ({"transaction_id": ...}, "transaction_id"),
    "user zero": ({"user_id": 0}, "user_id"),
    "user fraction": ({"user_id": 311.5}, "user_id"),
    "user true": ({"user_id": True}, "user_id"),
    "user too large": ({"user_id": 99999999999999999999}, "user_id"),
    "short card": ({"card_id": "c_1"}, "card_id"),
    "merchant negative": ({"merchant_id": -1}, "merchant_id"),
    "no merchant name": ({"merchant_name": ""}, "merchant_name"),
    "name as object": ({"merchant_name": {"a": 1}}, "merchant_name"),
    "no category": ({"merchant_category": None}, "merchant_category"),
    "amount negative": ({"amount": "-1.00"}, "amount"),
    "amount zero": ({"amount": "0"}, "amount"),
    "amount NaN": ({"amount": "NaN"}, "amount"),
    "amount too large": ({"amount": "10000000000000000"}, "amount"),
    "currency too long": ({"currency": "POUND"}, "currency"),
    "currency with digit": ({"currency": "GB1"}, "currency"),
    "country with digit": ({"country": "G1"}, "country"),
    "country that grows": ({"country": "aß"}, "country"),
    "status unknown": ({"status": "PENDING"}, "status"),
    "status lower case": ({"status": "authorised"}, "status"),
    "time word": ({"event_time": "now"}, "event_time"),
    "time only": ({"event_time": "10:00"}, "event_time"),
    "no rate": ({"currency": "ZZZ"}, "unknown_currency"),
}

NOT_OBJECTS = ["not json", "[1]", '"text"', "", message() + " trailing", "{", "null"]


def test_good_events_pass(spark):
    df = messages(spark, *[message(**c) for c in ACCEPTED.values()])
    bad = validate(decode_events(df)).where(F.size("reasons") > 0)
    assert [r.value for r in bad.collect()] == []


def test_each_fault_has_its_reason(spark):
    bodies = {message(**change): code for change, code in REJECTED.values()}
    got = validate(decode_events(messages(spark, *bodies))).select("value", "reasons").collect()
    assert {r.value: r.reasons for r in got} == {v: [code] for v, code in bodies.items()}


def test_bodies_that_are_no_object(spark):
    df = messages(spark, *NOT_OBJECTS)
    assert [r.reasons for r in validate(decode_events(df)).collect()] == [["json"]] * len(NOT_OBJECTS)


def test_null_body(spark):
    df = spark.createDataFrame([(None,)], "value string")
    assert validate(decode_events(df)).first().reasons == ["json"]


def test_several_faults_are_all_listed(spark):
    df = messages(spark, message(user_id=0, currency="ZZZ", status="x"))
    assert validate(decode_events(df)).first().reasons == ["user_id", "status", "unknown_currency"]


def test_split_keeps_every_row_once(spark):
    df = messages(spark, message(), message(user_id=0), "x")
    good, rejects = split_valid(validate(decode_events(df)))
    assert (good.count(), rejects.count()) == (1, 2)
    assert "value" in rejects.columns and "reasons" in rejects.columns


def test_binary_values_decode(spark):
    df = messages(spark, message()).select(F.encode("value", "UTF-8").alias("value"))
    assert decode_events(df).first().user_id == 311


def test_large_number_keeps_its_pence(spark):
    body = message().replace('"18.60"', "1234567890123456.78")
    row = decode_events(messages(spark, body)).select(F.col("amount").cast("decimal(18,2)")).first()
    assert str(row.amount) == "1234567890123456.78"


def test_round_trip(spark):
    start = decode_events(messages(spark, message(), message(event_time="2026-05-01T10:00:00.25Z")))
    sent = to_keyed_json(start)
    assert {r.key for r in sent.collect()} == {"311"}
    again = decode_events(sent)
    columns = list(BASE)
    assert again.select(*columns).exceptAll(start.select(*columns)).count() == 0
    body = json.loads(sent.first().value)
    assert isinstance(body["amount"], str) and body["event_time"].endswith("Z")


@pytest.mark.parametrize("rate, ok", [("0.50", True), (None, False)])
def test_own_rates(spark, rate, ok):
    own = spark.createDataFrame([("ZZZ", rate)], "currency string, rate string").where("rate is not null")
    own = own.select("currency", F.col("rate").cast("decimal(5,2)").alias("rate"))
    good, _ = split_valid(validate(decode_events(messages(spark, message(currency="zzz"))), own))
    assert (good.count() == 1) is ok
