"""Small literal inputs shared by the tests."""

from __future__ import annotations

import json
from datetime import datetime, timezone
from decimal import Decimal

from txnlake import schemas as S

BASE = {
    "transaction_id": "pay-00000001",
    "user_id": 311,
    "card_id": "visa-3110",
    "merchant_id": 58,
    "merchant_name": "Harbour Bakery",
    "merchant_category": "Restaurants",
    "amount": "18.60",
    "currency": "Gbp",
    "country": "Gb",
    "status": "AUTHORISED",
    "event_time": "2026-05-01T08:15:00Z",
}


def utc(*args):
    return datetime(*args, tzinfo=timezone.utc)


def message(**changes) -> str:
    body = {**BASE, **changes}
    return json.dumps({k: v for k, v in body.items() if v is not ...})


def messages(spark, *bodies):
    return spark.createDataFrame([(b,) for b in bodies], "value string")


def event(spark, *changes):
    """Typed events, before enrichment."""
    rows = []
    for change in changes:
        row = {**BASE, "amount": Decimal("100.00"), "event_time": utc(2026, 5, 1, 12), **change}
        rows.append(tuple(row[c] for c in S.EVENT_COLUMNS))
    return spark.createDataFrame(rows, S.EVENT)


def raw_rows(spark, *changes):
    """Stored raw rows."""
    base = {
        **BASE,
        "amount": Decimal("10.00"),
        "amount_gbp": Decimal("10.00"),
        "currency": "GBP",
        "country": "GB",
        "is_flagged": False,
        "event_time": utc(2026, 5, 1, 10),
        "ingested_at": utc(2026, 5, 1, 11),
    }
    rows = []
    for change in changes:
        row = {**base, **change}
        rows.append(tuple(row[c] for c in S.RAW_COLUMNS))
    return spark.createDataFrame(rows, S.RAW)


def as_set(df):
    return {tuple(r) for r in df.collect()}
