"""The same queries in plain SQL, written independently of the Spark code."""

from __future__ import annotations

_RATES = """rates(currency, r) AS (VALUES ('GBP', 100), ('USD', 127), ('EUR', 117), ('INR', 10650),
  ('PLN', 505), ('AED', 466), ('SGD', 171), ('JPY', 19840))"""

# Half-up to the penny in whole numbers: a is the amount in pence, r the rate times 100.
_GBP = "CAST(((200 * a + r) // (2 * r)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2))"

_FEED = """feed AS (
  SELECT 'txn-' || lpad(CAST(event_id AS VARCHAR), CAST(greatest(8, length(CAST(event_id AS VARCHAR))) AS INTEGER), '0') AS transaction_id,
    user_id,
    'visa-' || user_id || '-' || event_id % 2 AS card_id,
    CAST(props->>'k' AS BIGINT) + 1 AS merchant_id,
    'Shop ' || (CAST(props->>'k' AS BIGINT) + 1) || ', ' || category AS merchant_name,
    category AS merchant_category,
    CAST(CAST(value AS DECIMAL(18,2)) * (CASE WHEN event_id % 10 = 0 THEN 100 ELSE 1 END) AS DECIMAL(18,2)) AS amount,
    ['GBP','usd','EUR','inr','PLN','AED','SGD','JPY','ZZZ'][event_id % 9 + 1] AS currency,
    ['gb','US','DE','IN','PL','AE','SG','JP','ZZ'][event_id % 9 + 1] AS country,
    CASE WHEN event_id % 100 < 88 THEN 'AUTHORISED' WHEN event_id % 100 < 97 THEN 'DECLINED' ELSE 'REVERSED' END AS status,
    ts AS event_time,
    ts + INTERVAL '5' SECOND * (event_id % 5) AS ingested_at
  FROM (SELECT *, CASE event_type WHEN 'click' THEN 'Groceries' WHEN 'view' THEN 'Travel'
    WHEN 'purchase' THEN 'Shopping' WHEN 'signup' THEN 'Health' ELSE 'Cash' END AS category FROM events))"""

_CHECKED = """checked AS (
  SELECT f.*, r.r, CAST(f.amount * 100 AS BIGINT) AS a,
    list_filter([
      CASE WHEN f.user_id <= 0 THEN 'user_id' END,
      CASE WHEN f.merchant_id <= 0 THEN 'merchant_id' END,
      CASE WHEN f.amount <= 0 THEN 'amount' END,
      CASE WHEN f.status NOT IN ('AUTHORISED','DECLINED','REVERSED') THEN 'status' END,
      CASE WHEN r.r IS NULL THEN 'unknown_currency' END], lambda x: x IS NOT NULL) AS reasons
  FROM feed f LEFT JOIN rates r ON r.currency = upper(f.currency))"""

_RAW_COLUMNS = f"""transaction_id, user_id, card_id, merchant_id, merchant_name, merchant_category,
    amount, upper(currency) AS currency, {_GBP} AS amount_gbp, upper(country) AS country, status,
    ({_GBP} >= 5000) AS is_flagged, event_time, ingested_at"""

_RAW = f"raw AS (SELECT {_RAW_COLUMNS} FROM checked WHERE len(reasons) = 0)"

_FACT_COLUMNS = """transaction_id, CAST(event_time AS DATE) AS date_key, user_id, merchant_id,
    amount_gbp, currency, status, is_flagged, event_time"""

_FACT = f"fact AS (SELECT {_FACT_COLUMNS} FROM raw)"

_DIM_USER = """dim_user AS (SELECT user_id, min(event_time) AS first_seen, max(event_time) AS last_seen,
    count(*) AS txn_count FROM raw GROUP BY user_id)"""


def _latest(name: str, source: str) -> str:
    # text that sorts by time and then by id
    newest = "strftime(event_time, '%Y%m%d%H%M%S%f') || transaction_id"
    return f"""{name} AS (SELECT merchant_id, arg_max(merchant_name, {newest}) AS merchant_name,
    arg_max(merchant_category, {newest}) AS merchant_category FROM {source} GROUP BY ALL)"""


def _mart(name: str, fact: str, merchants: str) -> str:
    # measures as numbers per fact; each fact finds its category by a look-up in a map
    return f"""{name}_lookup AS (SELECT map_from_entries(list((merchant_id, merchant_category))) AS m FROM {merchants}),
  {name}_measures AS (SELECT date_key, m[merchant_id] AS merchant_category, is_flagged::INT AS flag,
    (status = 'AUTHORISED')::INT AS paid, paid * amount_gbp AS spent FROM {fact}, {name}_lookup),
  {name} AS (SELECT date_key, merchant_category, CAST(sum(spent) AS DECIMAL(18,2)) AS total_gbp,
    CAST(sum(paid) AS BIGINT) AS txn_count, CAST(sum(flag) AS BIGINT) AS flagged_count
    FROM {name}_measures WHERE merchant_category IS NOT NULL GROUP BY ALL)"""


_HALVES = """first_half AS (SELECT * FROM raw WHERE ingested_at < TIMESTAMP '2024-01-16'),
  second_half AS (SELECT * FROM raw WHERE ingested_at >= TIMESTAMP '2024-01-16')"""

_LI_FEED = """li_feed AS (
  SELECT 'txn-' || lpad(CAST(l_orderkey AS VARCHAR), CAST(greatest(8, length(CAST(l_orderkey AS VARCHAR))) AS INTEGER), '0') || '-' || l_linenumber AS transaction_id,
    l_orderkey % 500 + 1 AS user_id,
    'visa-' || (l_orderkey % 500 + 1) || '-' || l_partkey % 2 AS card_id,
    l_suppkey + 1 AS merchant_id,
    'Shop ' || (l_suppkey + 1) || ', ' || category AS merchant_name,
    category AS merchant_category,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
    ['GBP','usd','EUR','inr','PLN','AED','SGD','JPY'][l_partkey % 8 + 1] AS currency,
    ['gb','US','DE','IN','PL','AE','SG','JP'][l_partkey % 8 + 1] AS country,
    CASE l_returnflag WHEN 'N' THEN 'AUTHORISED' WHEN 'R' THEN 'REVERSED' ELSE 'DECLINED' END AS status,
    l_shipdate + INTERVAL '28' YEAR AS event_time,
    l_shipdate + INTERVAL '28' YEAR AS ingested_at
  FROM (SELECT *, ['Groceries','Restaurants','Transport','Travel','Entertainment','Utilities',
    'Shopping','Health','Cash','Transfers'][l_partkey % 10 + 1] AS category FROM lineitem))"""

_FIRST = """ORDER BY ingested_at, event_time, user_id, card_id, merchant_id, merchant_name,
    merchant_category, amount, currency, country, status"""

_LI_ONCE = f"""li_once AS (SELECT * FROM li_feed
    QUALIFY row_number() OVER (PARTITION BY transaction_id {_FIRST}) = 1)"""


def _li_raw(name: str, source: str) -> str:
    return f"""{name} AS (SELECT {_RAW_COLUMNS} FROM (SELECT f.*, r.r, CAST(f.amount * 100 AS BIGINT) AS a
    FROM {source} f JOIN rates r ON r.currency = upper(f.currency)) WHERE amount > 0)"""


_LI_FACT = f"li_fact AS (SELECT {_FACT_COLUMNS} FROM li_raw)"

_JSON = """'{"transaction_id":"' || transaction_id || '","user_id":' || user_id || ',"card_id":"' || card_id
    || '","merchant_id":' || merchant_id || ',"merchant_name":"' || merchant_name || '","merchant_category":"'
    || merchant_category || '","amount":"' || amount || '","currency":"' || currency || '","country":"' || country
    || '","status":"' || status || '","event_time":"' || strftime(event_time, '%Y-%m-%dT%H:%M:%S')
    || CASE WHEN microsecond(event_time) % 1000000 = 0 THEN '' ELSE strftime(event_time, '.%f') END || 'Z"}'"""

_CALENDAR = """calendar AS (SELECT CAST(d AS DATE) AS date_key, CAST(day(d) AS INTEGER) AS "day",
    CAST(month(d) AS INTEGER) AS "month", CAST(year(d) AS INTEGER) AS "year",
    CAST(isodow(d) - 1 AS INTEGER) AS weekday, isodow(d) IN (6, 7) AS is_weekend
    FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2027-12-31', INTERVAL 1 DAY) t(d))"""

_EVENT_COLUMNS = """transaction_id, user_id, card_id, merchant_id, merchant_name, merchant_category,
    amount, currency, country, status, event_time"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


_C = (_RATES, _FEED, _CHECKED)
_R = (*_C, _RAW)
_F = (*_R, _FACT)
_M = (*_F, _latest("dim_merchant", "raw"), _mart("mart", "fact", "dim_merchant"))
_LI = (_RATES, _LI_FEED, _LI_ONCE, _li_raw("li_raw", "li_once"))


def _checks_sql(source: str) -> str:
    # one pass: what is left of all rows after the good ones; names and statuses are fixed values
    return f"""SELECT unnest(['no_null_keys', 'no_nonpositive_amounts', 'valid_status']) AS check_name, unnest(n) AS n FROM (
      SELECT [count(*) - count(transaction_id || user_id || merchant_id), count(amount) - count_if(amount > 0),
        count(status) - count_if(status IN ('AUTHORISED', 'DECLINED', 'REVERSED'))] AS n FROM {source})"""


def _mart_at(run: int, at: str) -> str:
    """The mart computed from what had arrived by the given time."""
    return ",\n".join(
        [
            f"raw{run} AS (SELECT * FROM raw WHERE ingested_at <= TIMESTAMP '{at}')",
            f"fact{run} AS (SELECT {_FACT_COLUMNS} FROM raw{run})",
            _latest(f"merchant{run}", f"raw{run}"),
            _mart(f"mart{run}", f"fact{run}", f"merchant{run}"),
        ]
    )


_BATCH_MART = (
    _with(*_R, _mart_at(1, "2024-01-10"), _mart_at(2, "2024-01-20"), _mart_at(3, "9999-12-31"))
    + """SELECT date_key, merchant_category, total_gbp, txn_count, flagged_count
         FROM (SELECT 1 AS run, * FROM mart1 UNION ALL SELECT 2, * FROM mart2 UNION ALL SELECT 3, * FROM mart3)
         QUALIFY row_number() OVER (PARTITION BY date_key, merchant_category ORDER BY run DESC) = 1"""
)

# Which fault the faulty feed plants, by the event's number; mills is the amount in thousandths.
_FAULTY = """planted AS (SELECT *, CAST(substr(transaction_id, 5) AS BIGINT) % 32 AS k FROM feed),
  faulty AS (SELECT * REPLACE (
      CASE k WHEN 0 THEN 'short' ELSE transaction_id END AS transaction_id,
      CASE WHEN k = 1 THEN 0 WHEN k = 2 THEN NULL ELSE user_id END AS user_id,
      CASE k WHEN 3 THEN 'abc' ELSE card_id END AS card_id,
      CASE k WHEN 4 THEN -merchant_id ELSE merchant_id END AS merchant_id,
      CASE k WHEN 5 THEN '' ELSE merchant_name END AS merchant_name,
      CASE k WHEN 6 THEN NULL ELSE merchant_category END AS merchant_category,
      CASE WHEN k = 9 THEN 'G8P' WHEN k = 10 THEN 'QQQ' ELSE currency END AS currency,
      CASE k WHEN 11 THEN 'GBR' ELSE country END AS country,
      CASE k WHEN 12 THEN 'pending' ELSE status END AS status,
      CASE k WHEN 13 THEN NULL ELSE event_time END AS event_time),
    CASE WHEN k = 7 THEN 0 WHEN k = 8 THEN NULL
      WHEN k = 17 THEN CAST(amount * 1000 AS BIGINT) + 5 ELSE CAST(amount * 1000 AS BIGINT) END AS mills FROM planted)"""

_FAULTY_CHECKED = """faulty_checked AS (SELECT f.*, r.r, CASE WHEN k IN (14, 15) THEN ['json'] ELSE list_filter([
      CASE WHEN length(f.transaction_id) < 8 THEN 'transaction_id' END,
      CASE WHEN f.user_id IS NULL OR f.user_id <= 0 THEN 'user_id' END,
      CASE WHEN length(f.card_id) < 4 THEN 'card_id' END,
      CASE WHEN f.merchant_id <= 0 THEN 'merchant_id' END,
      CASE WHEN f.merchant_name = '' THEN 'merchant_name' END,
      CASE WHEN f.merchant_category IS NULL THEN 'merchant_category' END,
      CASE WHEN f.mills IS NULL OR f.mills <= 0 THEN 'amount' END,
      CASE WHEN NOT regexp_full_match(f.currency, '[A-Za-z]{3}') THEN 'currency' END,
      CASE WHEN NOT regexp_full_match(f.country, '[A-Za-z]{2}') THEN 'country' END,
      CASE WHEN f.status NOT IN ('AUTHORISED','DECLINED','REVERSED') THEN 'status' END,
      CASE WHEN f.event_time IS NULL THEN 'event_time' END,
      CASE WHEN r.r IS NULL AND regexp_full_match(f.currency, '[A-Za-z]{3}') THEN 'unknown_currency' END],
      lambda x: x IS NOT NULL) END AS reasons
  FROM faulty f LEFT JOIN rates r ON r.currency = upper(f.currency))"""

# Half-up from thousandths, for what is stored and what it is worth.
_MILLS_AMOUNT = "CAST(((mills + 5) // 10) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2))"
_MILLS_GBP = "CAST(((20 * mills + r) // (2 * r)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2))"

_RAW_SELECT = _with(*_R) + "SELECT * FROM raw"
_MART_SELECT = _with(*_M) + "SELECT * FROM mart"
_DIM_USER_SELECT = _with(*_R, _DIM_USER) + "SELECT * FROM dim_user"


_STREAMED = _with(
    _RATES,
    _LI_FEED,
    f"""sent AS (SELECT * FROM li_feed
        QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY ingested_at, {_JSON}) = 1)""",
    _li_raw("li_raw", "sent"),
)


def all_oracles() -> dict[str, str]:
    return {
        "reject_counts": _with(*_C)
        + "SELECT reason, count(*) AS rejected FROM (SELECT unnest(reasons) AS reason FROM checked) GROUP BY reason",
        "rejects": _with(*_C)
        + "SELECT transaction_id, array_to_string(reasons, ',') AS reasons FROM checked WHERE len(reasons) > 0",
        "keyed_json": _with(_FEED)
        + f"SELECT CAST(user_id AS VARCHAR) AS key, {_JSON} AS value FROM feed",
        "json_round_trip": _with(*_C) + f"SELECT {_EVENT_COLUMNS} FROM checked WHERE len(reasons) = 0",
        "fx_convert": _with(*_C)
        + f"SELECT transaction_id, upper(currency) AS currency, amount, {_GBP} AS amount_gbp FROM checked WHERE r IS NOT NULL",
        "fx_by_currency": _with(_RATES, _LI_FEED, _li_raw("li_all", "li_feed"))
        + """SELECT currency, CAST(sum(amount_gbp) AS DECIMAL(18,2)) AS total_gbp, count(*) AS txn_count
             FROM li_all GROUP BY currency""",
        "supported_currencies": _with(_RATES, _FEED)
        + """SELECT r.currency, count(*) AS txn_count FROM rates r JOIN feed f ON upper(f.currency) = r.currency
             GROUP BY r.currency""",
        "enriched": _RAW_SELECT,
        "flag_rules": _with(*_C)
        + f"""SELECT transaction_id, status, r IS NOT NULL AS has_rate,
             CASE WHEN r IS NULL THEN status = 'AUTHORISED' ELSE {_GBP} >= 5000 END AS is_flagged FROM checked""",
        "raw_dedup": _with(*_LI) + "SELECT * FROM li_raw",
        "raw_append": _with(_LI_FEED, _LI_ONCE) + f"SELECT {_EVENT_COLUMNS}, ingested_at FROM li_once",
        "dim_date": _with(_LI_FEED, _CALENDAR)
        + "SELECT * FROM calendar WHERE date_key IN (SELECT CAST(event_time AS DATE) FROM li_feed)",
        "dim_date_seed": _with(_LI_FEED, _CALENDAR)
        + "SELECT CAST(event_time AS DATE) AS date_key FROM li_feed UNION SELECT date_key FROM calendar",
        "dim_user": _DIM_USER_SELECT,
        "dim_user_merge": _with(*_R)
        + """SELECT user_id, min(event_time) AS first_seen, max(event_time) AS last_seen,
             CASE WHEN max(ingested_at) >= TIMESTAMP '2024-01-16'
               THEN count(*) FILTER (WHERE ingested_at >= TIMESTAMP '2024-01-16')
               ELSE count(*) END AS txn_count FROM raw GROUP BY user_id""",
        "dim_user_incremental": _DIM_USER_SELECT,
        "dim_merchant": _with(*_R, _latest("dim_merchant", "raw")) + "SELECT * FROM dim_merchant",
        "dim_merchant_merge": _with(*_R, _HALVES, _latest("old", "first_half"), _latest("new", "second_half"))
        + """SELECT * FROM new UNION ALL
             SELECT * FROM old WHERE merchant_id NOT IN (SELECT merchant_id FROM new)""",
        "fact_window": _with(*_F)
        + """SELECT f.* FROM fact f JOIN raw r USING (transaction_id)
             WHERE r.ingested_at > TIMESTAMP '2024-01-12' AND r.ingested_at <= TIMESTAMP '2024-01-20'""",
        "facts_after": _with(*_F)
        + "SELECT count(*) AS fact_count FROM fact WHERE event_time > TIMESTAMP '2024-01-16'",
        "fact_count": _with(*_F) + "SELECT count(*) AS row_count FROM fact",
        "fact_ref_violations": _with(*_R, _LI_FEED, _LI_ONCE, _li_raw("li_raw", "li_once"), _LI_FACT, _CALENDAR)
        + """, marked AS (SELECT transaction_id, date_key, user_id, merchant_id, list_filter([
               CASE WHEN date_key NOT IN (SELECT date_key FROM calendar) THEN 'date_key' END,
               CASE WHEN user_id NOT IN (SELECT user_id FROM raw) THEN 'user_id' END,
               CASE WHEN merchant_id NOT IN (SELECT merchant_id FROM raw) THEN 'merchant_id' END],
               lambda x: x IS NOT NULL) AS m FROM li_fact)
             SELECT transaction_id, date_key, user_id, merchant_id, array_to_string(m, ',') AS missing
             FROM marked WHERE len(m) > 0""",
        "daily_spend_event_category": _with(*_R)
        + """SELECT strftime(event_time, '%Y-%m-%d') AS day, merchant_category,
             CAST(sum(amount_gbp) AS DECIMAL(18,2)) AS total_gbp FROM raw WHERE status = 'AUTHORISED'
             GROUP BY day, merchant_category""",
        "daily_mart": _MART_SELECT,
        "daily_mart_merge": _with(
            *_M,
            _HALVES,
            f"first_fact AS (SELECT {_FACT_COLUMNS} FROM first_half)",
            _latest("first_merchant", "first_half"),
            _mart("old", "first_fact", "first_merchant"),
        )
        + """SELECT * FROM mart UNION ALL SELECT * FROM old o WHERE NOT EXISTS (SELECT 1 FROM mart m
             WHERE m.date_key = o.date_key AND m.merchant_category = o.merchant_category)""",
        "daily_mart_rebuild": _MART_SELECT,
        "mart_lineitem": _with(
            _RATES,
            _LI_FEED,
            _li_raw("li_raw", "li_feed"),
            _LI_FACT,
            _latest("dim_merchant", "li_raw"),
            _mart("mart", "li_fact", "dim_merchant"),
        )
        + "SELECT * FROM mart",
        "quality_checks": _with(_FEED)
        + f"SELECT check_name, n = 0 AS passed, n || ' offending rows' AS detail FROM ({_checks_sql('feed')})",
        "dq_history": _with(_FEED)
        + "SELECT run_ts, check_name, n = 0 AS passed, n || ' offending rows' AS detail FROM ("
        + " UNION ALL ".join(
            f"SELECT TIMESTAMP '{at}' AS run_ts, * FROM ("
            + _checks_sql(f"(SELECT * FROM feed WHERE ingested_at <= TIMESTAMP '{at}')")
            + ")"
            for at in ("2024-01-10", "2024-01-20", "2024-02-01")
        )
        + ") ORDER BY run_ts DESC, check_name LIMIT 5",
        "user_spend": _with(*_F)
        + """SELECT user_id, DATE '2024-01-05' AS from_date, DATE '2024-01-25' AS to_date,
             CAST(coalesce(sum(amount_gbp) FILTER (WHERE ok), 0) AS DECIMAL(18,2)) AS total_gbp,
             count(*) FILTER (WHERE ok) AS txn_count
             FROM (SELECT *, status = 'AUTHORISED' AND date_key >= DATE '2024-01-05'
                   AND date_key <= DATE '2024-01-25' AS ok FROM fact) WHERE user_id = 7 GROUP BY user_id""",
        "user_spend_all": _with(*_F)
        + """SELECT user_id, DATE '2024-01-01' AS from_date, DATE '2024-01-31' AS to_date,
             CAST(coalesce(sum(amount_gbp) FILTER (WHERE ok), 0) AS DECIMAL(18,2)) AS total_gbp,
             count(*) FILTER (WHERE ok) AS txn_count
             FROM (SELECT *, status = 'AUTHORISED' AND date_key >= DATE '2024-01-01'
                   AND date_key <= DATE '2024-01-31' AS ok FROM fact) GROUP BY user_id""",
        "daily_spend": _MART_SELECT + " ORDER BY date_key DESC, merchant_category LIMIT 30",
        "daily_spend_travel": _MART_SELECT
        + " WHERE merchant_category = 'Travel' ORDER BY date_key DESC LIMIT 5",
        "top_merchants": _with(*_M)
        + """, paid AS (SELECT merchant_id, CAST(sum(amount_gbp) AS DECIMAL(18,2)) AS total_gbp, count(*) AS txn_count
               FROM fact WHERE status = 'AUTHORISED' GROUP BY ALL),
             placed AS (SELECT *, row_number() OVER (ORDER BY total_gbp DESC, merchant_id) AS place FROM paid)
             SELECT dim_merchant.*, total_gbp, txn_count FROM placed JOIN dim_merchant USING (merchant_id) WHERE place <= 10""",
        "freshness": _with(*_R) + "SELECT count(*) AS row_count, max(ingested_at) AS last_ingested_at FROM raw",
        "weekly_top_categories": _with(*_M)
        + """SELECT merchant_category, CAST(sum(total_gbp) AS DECIMAL(18,2)) AS weekly_gbp FROM mart
             WHERE date_key >= DATE '2024-01-31' - 7 GROUP BY merchant_category""",
        "top_users": _with(*_R, _DIM_USER)
        + """SELECT user_id, txn_count, first_seen, last_seen FROM dim_user
             ORDER BY txn_count DESC, user_id LIMIT 10""",
        "flagged_transactions": _with(*_R)
        + """SELECT transaction_id, user_id, amount_gbp, currency, event_time FROM raw WHERE is_flagged
             ORDER BY amount_gbp DESC, transaction_id LIMIT 10""",
        "mart_top": _MART_SELECT + " ORDER BY date_key DESC, total_gbp DESC, merchant_category LIMIT 10",
        "reject_counts_faulty": _with(_RATES, _FEED, _FAULTY, _FAULTY_CHECKED)
        + "SELECT reason, count(*) AS rejected FROM (SELECT unnest(reasons) AS reason FROM faulty_checked) GROUP BY reason",
        "decode_coercion": _with(_RATES, _FEED, _FAULTY, _FAULTY_CHECKED)
        + f"""SELECT transaction_id, user_id, card_id, merchant_id, merchant_name, merchant_category,
             {_MILLS_AMOUNT} AS amount, upper(currency) AS currency, {_MILLS_GBP} AS amount_gbp, upper(country) AS country,
             status, {_MILLS_GBP} >= 5000 AS is_flagged, event_time, TIMESTAMP '2030-01-01' AS ingested_at
             FROM faulty_checked WHERE len(reasons) = 0""",
        "stream_rejects": _with(_RATES, _FEED, _FAULTY, _FAULTY_CHECKED)
        + """SELECT array_to_string(reasons, ',') AS reasons, count(*) AS n FROM faulty_checked
             WHERE len(reasons) > 0 GROUP BY ALL""",
        "stream_replay": _STREAMED + "SELECT * REPLACE (TIMESTAMP '2020-01-01' AS ingested_at) FROM li_raw",
        "stream_replay_state": _STREAMED + "SELECT * REPLACE (TIMESTAMP '2020-01-01' AS ingested_at) FROM li_raw",
        "dq_history_stored": _with(*_R)
        + "SELECT run_ts, check_name, n = 0 AS passed, n || ' offending rows' AS detail FROM ("
        + " UNION ALL ".join(
            f"SELECT TIMESTAMP '{at}' AS run_ts, * FROM ("
            + _checks_sql(f"(SELECT * FROM raw WHERE ingested_at <= TIMESTAMP '{at}')")
            + ")"
            for at in ("2024-01-10", "2024-01-20", "2024-02-01")
        )
        + ")",
        "batch_late_rows": _DIM_USER_SELECT,
        "batch_rerun": _with(*_F) + "SELECT * FROM fact",
        "stream_totals": _with(_RATES, _FEED, _FAULTY, _FAULTY_CHECKED)
        + """SELECT CAST(2 * count(*) FILTER (WHERE len(reasons) = 0) AS BIGINT) AS attempted,
             count(DISTINCT transaction_id) FILTER (WHERE len(reasons) = 0) AS inserted,
             CAST(2 * count(*) FILTER (WHERE len(reasons) > 0) AS BIGINT) AS rejected FROM faulty_checked""",
        "batch_gate": _with(*_R)
        + """, late AS (SELECT CAST(substr(transaction_id, 5) AS BIGINT) % 50 AS k FROM raw WHERE ingested_at >= TIMESTAMP '2024-01-16'),
             bad AS (SELECT unnest(['no_null_keys', 'no_nonpositive_amounts', 'valid_status']) AS check_name, unnest([1, 2, 3]) AS k),
             runs AS (SELECT unnest([TIMESTAMP '2024-01-16', TIMESTAMP '2024-03-01', TIMESTAMP '2024-03-02']) AS run_ts, unnest([0, 1, 1]) AS has_late)
             SELECT run_ts, check_name, n = 0 AS passed, n || ' offending rows' AS detail
             FROM (SELECT run_ts, check_name, has_late * (SELECT count(*) FROM late WHERE late.k = bad.k) AS n FROM runs, bad)""",
        "stream_ingest": _RAW_SELECT,
        "stream_state": _RAW_SELECT,
        "stream_dedup": _STREAMED + "SELECT * REPLACE (TIMESTAMP '2030-01-01' AS ingested_at) FROM li_raw",
        "stream_mart": _MART_SELECT,
        "fact_incremental": _with(*_F) + "SELECT * FROM fact",
        "batch_dim_user": _DIM_USER_SELECT,
        "batch_mart": _BATCH_MART,
        "batch_mart_full": _MART_SELECT,
    }
