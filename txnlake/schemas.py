"""Table schemas (as DDL text) and fixed values. Nothing in this package infers a schema."""

from __future__ import annotations

# Transaction statuses, exact case.
AUTHORISED = "AUTHORISED"
DECLINED = "DECLINED"
REVERSED = "REVERSED"
STATUSES = (AUTHORISED, DECLINED, REVERSED)

MONEY = "decimal(18,2)"
# Amounts arrive with any number of decimals; the stored column has two.
EVENT_AMOUNT = "decimal(38,18)"
RATE = "decimal(5,2)"

EVENT_COLUMNS = (
    "transaction_id",
    "user_id",
    "card_id",
    "merchant_id",
    "merchant_name",
    "merchant_category",
    "amount",
    "currency",
    "country",
    "status",
    "event_time",
)

RAW_COLUMNS = (
    "transaction_id",
    "user_id",
    "card_id",
    "merchant_id",
    "merchant_name",
    "merchant_category",
    "amount",
    "currency",
    "amount_gbp",
    "country",
    "status",
    "is_flagged",
    "event_time",
    "ingested_at",
)

EVENT = (
    "transaction_id string, user_id bigint, card_id string, merchant_id bigint,"
    " merchant_name string, merchant_category string,"
    f" amount {EVENT_AMOUNT}, currency string, country string, status string,"
    " event_time timestamp"
)

RAW = (
    "transaction_id string, user_id bigint, card_id string, merchant_id bigint,"
    " merchant_name string, merchant_category string,"
    f" amount {MONEY}, currency string, amount_gbp {MONEY}, country string,"
    " status string, is_flagged boolean, event_time timestamp, ingested_at timestamp"
)

DIM_USER = (
    "user_id bigint, first_seen timestamp, last_seen timestamp, txn_count bigint"
)

DIM_MERCHANT = (
    "merchant_id bigint, merchant_name string, merchant_category string"
)

# The stored merchant dimension also carries the row that won, so that a later
# load can compare against it without reading the raw history again.
DIM_MERCHANT_STORED = (
    "merchant_id bigint, merchant_name string, merchant_category string,"
    " event_time timestamp, transaction_id string"
)

DIM_DATE = (
    "date_key date, day smallint, month smallint, year smallint,"
    " weekday smallint, is_weekend boolean"
)

FACT = (
    "transaction_id string, date_key date, user_id bigint, merchant_id bigint,"
    f" amount_gbp {MONEY}, currency string, status string, is_flagged boolean,"
    " event_time timestamp"
)

MART = (
    f"date_key date, merchant_category string, total_gbp {MONEY},"
    " txn_count bigint, flagged_count bigint"
)

# Per merchant and day; rolls up to the mart once categories are known.
MERCHANT_DAY = (
    f"date_key date, merchant_id bigint, total_gbp {MONEY},"
    " txn_count bigint, flagged_count bigint"
)

WATERMARK = ("table_name string, last_loaded timestamp")

DQ_LOG = (
    "run_ts timestamp, check_name string, passed boolean, detail string"
)

REJECT = (
    "value string, reasons array<string>, rejected_at timestamp, stream string, batch bigint"
)

# One row per append to the raw table: what the batch held and what was stored of it.
# The last three are offending rows by check.
LANDING_COUNTS = (
    "attempted", "inserted", "rejected", "no_null_keys", "no_nonpositive_amounts", "valid_status",
)
LANDING = (
    "landed bigint, taken bigint, stream string, batch bigint, "
    + ", ".join(f"{c} bigint" for c in LANDING_COUNTS)
    + ", last_ingested timestamp, landed_hour string"
)

# The last landing that a run saw (seen) and the last up to which it took all, with the counts up to there.
LANDING_MARK = "seen bigint, landed bigint, landed_hour string, " + ", ".join(f"{c} bigint" for c in LANDING_COUNTS)

FACT_REJECT = FACT + ", missing array<string>"
