"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the operator semantics, not from the Spark code: the events are
re-derived from ``orders`` in SQL, the dedup survivor is picked with a window,
the rules are CASE expressions.  Views ``orders`` etc. are pre-registered.
Column names and types match the Spark queries (money as DOUBLE, counts as
BIGINT, timestamps as epoch seconds).
"""

from __future__ import annotations

# Events derived from orders (one per order + re-sent copies of k % 97 = 5).
EVENTS = """
base AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_totalprice AS p, o_orderdate AS d
  FROM orders
),
one AS (
  SELECT
    CASE WHEN k % 1000 = 173 THEN NULL ELSE concat('TXN-', k) END AS transaction_id,
    CASE WHEN k % 100 = 3 THEN NULL WHEN k % 1000 = 127 THEN '   '
         ELSE concat('CUST-', c) END AS customer_id,
    concat('ACC-', 10000 + c) AS account_id,
    concat('MER-', 100 + k % 900) AS merchant_id,
    (['BAKERY','BOOKS','CYCLES','GARDEN','MUSIC','OPTICS','PETS','TOOLS'])[k % 8 + 1] AS merchant_category,
    (['SALE','RETURN','MOVE','PAYOUT'])[c % 4 + 1] AS transaction_type,
    CASE WHEN k % 1000 = 151 THEN NULL
         WHEN k % 1000 = 163 THEN CAST(0 AS DOUBLE)
         WHEN k % 100 = 17 THEN -(floor(p * 2) / 100)
         ELSE floor(p * 2) / 100 END AS amount,
    CASE WHEN k % 100 = 31 THEN 'XYZ' WHEN k % 1000 = 417 THEN 'ZZZ'
         WHEN k % 1000 = 71 THEN ' usd ' WHEN k % 1000 = 113 THEN NULL
         ELSE (['USD','EUR','GBP','CAD'])[k % 4 + 1] END AS currency,
    (['CARD','CASH','VOUCHER','WIRE'])[(k + c) % 4 + 1] AS payment_method,
    CASE WHEN k % 1000 = 211 THEN NULL WHEN c % 8 < 5 THEN 'US' WHEN c % 8 = 5 THEN 'CA'
         WHEN c % 8 = 6 THEN 'GB' ELSE 'DE' END AS country,
    'WEB' AS device_type,
    CASE WHEN k % 100 = 47 THEN 'UNKNOWN' WHEN k % 1000 = 223 THEN NULL
         WHEN (k + 3 * c) % 20 < 17 THEN 'APPROVED'
         WHEN (k + 3 * c) % 20 < 19 THEN 'DECLINED' ELSE 'PENDING' END AS status,
    CASE WHEN k % 100 = 59 THEN NULL WHEN k % 1000 = 139 THEN 'not-a-date'
         ELSE CAST(CAST(d AS DATE) AS VARCHAR) || 'T00:00:00+00:00' END AS event_timestamp,
    k
  FROM base
),
ev AS (
  SELECT * EXCLUDE (k), 'CITY' AS city, CAST(k % 3 AS INTEGER) AS partition, 2 * k AS "offset",
         CAST(1704067200 AS BIGINT) AS sent_epoch, 0 AS resend FROM one
  UNION ALL
  SELECT * EXCLUDE (k), 'TOWN', CAST((k + 1) % 3 AS INTEGER), 2 * k + 1,
         CAST(1704067200 + CASE k % 3 WHEN 0 THEN -60 WHEN 1 THEN 60 ELSE 0 END AS BIGINT), 1
  FROM one WHERE k % 97 = 5
)"""

EVENT_COLS = ("transaction_id, customer_id, account_id, merchant_id, merchant_category, "
              "transaction_type, amount, currency, payment_method, country, city, "
              "device_type, status")

# Local profile: standardise, parse, all failing codes joined.
LOCAL = EVENTS + """,
std AS (
  SELECT * REPLACE (upper(trim(currency, ' ')) AS currency, upper(trim(status, ' ')) AS status),
         try_cast(event_timestamp AS TIMESTAMPTZ) AS ts_parsed
  FROM ev
),
validated AS (
  SELECT *, concat_ws('; ',
      CASE WHEN transaction_id IS NULL THEN 'MISSING_TRANSACTION_ID' END,
      CASE WHEN customer_id IS NULL THEN 'MISSING_CUSTOMER_ID' END,
      CASE WHEN amount IS NULL THEN 'MISSING_AMOUNT' END,
      CASE WHEN amount <= 0 THEN 'INVALID_AMOUNT' END,
      CASE WHEN NOT (currency IN ('USD','EUR','GBP','CAD')) THEN 'INVALID_CURRENCY' END,
      CASE WHEN NOT (status IN ('APPROVED','DECLINED','PENDING')) THEN 'INVALID_STATUS' END,
      CASE WHEN ts_parsed IS NULL THEN 'INVALID_OR_MISSING_TIMESTAMP' END
    ) AS error_reason
  FROM std
),
valid AS (SELECT * FROM validated WHERE error_reason = ''),
silver AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY sent_epoch, partition, "offset") AS rn
    FROM valid) WHERE rn = 1
),
risk AS (
  SELECT *,
    (CASE WHEN amount > 5000 THEN 30 ELSE 0 END)
    + (CASE WHEN country <> 'US' THEN 20 ELSE 0 END)
    + (CASE WHEN status = 'DECLINED' THEN 20 ELSE 0 END) AS risk_score
  FROM silver
),
gold AS (
  SELECT *, CASE WHEN risk_score >= 60 THEN 'HIGH' WHEN risk_score >= 30 THEN 'MEDIUM'
                 ELSE 'LOW' END AS risk_level,
         CAST(timezone('UTC', ts_parsed) AS DATE) AS transaction_date
  FROM risk
)
"""

# Cloud profile: no standardisation, blank checks, NULL-aware IN, first code only.
CLOUD = EVENTS + """,
validated AS (
  SELECT *, CASE
      WHEN transaction_id IS NULL OR trim(transaction_id, ' ') = '' THEN 'MISSING_TRANSACTION_ID'
      WHEN customer_id IS NULL OR trim(customer_id, ' ') = '' THEN 'MISSING_CUSTOMER_ID'
      WHEN amount IS NULL THEN 'MISSING_AMOUNT'
      WHEN amount <= 0 THEN 'INVALID_AMOUNT'
      WHEN currency IS NULL OR NOT (currency IN ('USD','EUR','GBP','CAD')) THEN 'INVALID_CURRENCY'
      WHEN status IS NULL OR NOT (status IN ('APPROVED','DECLINED','PENDING')) THEN 'INVALID_STATUS'
      WHEN event_timestamp IS NULL OR trim(event_timestamp, ' ') = '' THEN 'MISSING_EVENT_TIMESTAMP'
    END AS validation_error
  FROM ev
),
valid AS (SELECT * FROM validated WHERE validation_error IS NULL),
silver AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY sent_epoch, partition, "offset") AS rn
    FROM valid) WHERE rn = 1
),
risk AS (
  SELECT *,
    (CASE WHEN amount > 5000 THEN 30 ELSE 0 END)
    + (CASE WHEN country <> 'US' THEN 20 ELSE 0 END)
    + (CASE WHEN status = 'DECLINED' THEN 20 ELSE 0 END) AS risk_score
  FROM silver
),
gold AS (
  SELECT *, CASE WHEN risk_score >= 60 THEN 'HIGH' WHEN risk_score >= 30 THEN 'MEDIUM'
                 ELSE 'LOW' END AS risk_level,
         CAST(timezone('UTC', try_cast(event_timestamp AS TIMESTAMPTZ)) AS DATE) AS transaction_date
  FROM risk
)
"""

CTE = {"local": LOCAL, "cloud": CLOUD}
ERR = {"local": "error_reason", "cloud": "validation_error"}
SUFFIX = {"local": "amount", "cloud": "value"}
PREFIX = {"local": "kafka", "cloud": "eventhub"}


def total(col: str = "amount") -> str:
    return f"CAST(round(sum(CAST({col} AS DECIMAL(18,2))), 2) AS DOUBLE)"


def average(col: str = "amount") -> str:
    return (f"CAST(round(CAST(CAST(sum(CAST({col} AS DECIMAL(18,2))) AS DOUBLE) / count({col})"
            f" AS DECIMAL(38,6)), 2) AS DOUBLE)")


def exact(col: str = "amount", scale: int = 60) -> str:
    """The exact sum of doubles, rounded once: multiples of 2^-60 as whole numbers of 128 bits."""
    return f"CAST(CAST(sum(CAST({col} * {float(1 << scale)!r} AS HUGEINT)) AS VARCHAR) AS DOUBLE) / {float(1 << scale)!r}"


def cents(x: str) -> str:
    """A double rounded to cents by its decimal spelling, halves up."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


def _with(profile: str, body: str) -> str:
    return "WITH " + CTE[profile].strip() + "\n" + body


def _lineage(profile: str) -> str:
    pre = PREFIX[profile]
    return f'partition AS {pre}_partition, "offset" AS {pre}_offset'


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["transactions"] = ("WITH " + EVENTS.strip() + "\nSELECT " + EVENT_COLS +
                         ', event_timestamp, partition, "offset", sent_epoch, resend FROM ev')
    q["raw_messages"] = ("WITH " + EVENTS.strip() + """
SELECT transaction_id AS kafka_key,
       json_object('transaction_id', transaction_id, 'customer_id', customer_id,
         'account_id', account_id, 'merchant_id', merchant_id,
         'merchant_category', merchant_category, 'transaction_type', transaction_type,
         'amount', amount, 'currency', currency, 'payment_method', payment_method,
         'country', country, 'city', city, 'device_type', device_type, 'status', status,
         'event_timestamp', event_timestamp)::VARCHAR AS kafka_value,
       'order-events' AS topic, partition, "offset", sent_epoch AS timestamp_epoch
FROM ev""")
    bronze_cols = f"{EVENT_COLS}, event_timestamp, {_lineage('local')}"
    q["bronze_roundtrip"] = "WITH " + EVENTS.strip() + f"\nSELECT {bronze_cols} FROM ev"
    q["bronze_stream"] = q["bronze_roundtrip"]
    q["bronze_stream_resume"] = q["bronze_roundtrip"]
    q["bronze_stream_table_cloud"] = ("WITH " + EVENTS.strip() +
                                      f"\nSELECT {EVENT_COLS}, event_timestamp, {_lineage('cloud')} FROM ev")
    q["events_from_json"] = "WITH " + EVENTS.strip() + f"\nSELECT {EVENT_COLS}, event_timestamp FROM ev"
    q["stream_report"] = "WITH " + EVENTS.strip() + """
SELECT count(*) AS input_rows, count(*) AS bronze_rows FROM ev"""
    q["ingestion_stamp"] = "SELECT CAST(0 AS BIGINT) AS null_stamps, CAST(1 AS BIGINT) AS stamps"
    q["batch_stream_reconcile"] = ("WITH " + EVENTS.strip() + """
SELECT count(*) AS bronze_batch_records, count(*) AS bronze_streaming_records,
       true AS counts_match FROM ev""")
    q["quality_errors_rules"] = ("WITH " + EVENTS.strip() + """,
std AS (
  SELECT * REPLACE (upper(trim(currency, ' ')) AS currency, upper(trim(status, ' ')) AS status)
  FROM ev
)
SELECT concat_ws('; ',
      CASE WHEN transaction_id IS NULL THEN 'MISSING_TRANSACTION_ID' END,
      CASE WHEN customer_id IS NULL THEN 'MISSING_CUSTOMER_ID' END,
      CASE WHEN amount IS NULL THEN 'MISSING_AMOUNT' END,
      CASE WHEN amount <= 0 THEN 'INVALID_AMOUNT' END,
      CASE WHEN NOT (currency IN ('USD','EUR','GBP','CAD')) THEN 'INVALID_CURRENCY' END,
      CASE WHEN NOT (status IN ('APPROVED','DECLINED','PENDING')) THEN 'INVALID_STATUS' END
    ) AS error_reason, count(*) AS n
FROM std GROUP BY 1""")

    for p in ("local", "cloud"):
        err, suf, pre = ERR[p], SUFFIX[p], PREFIX[p]
        tot, avg = f"total_transaction_{suf}", f"average_transaction_{suf}"
        q[f"quality_errors_{p}"] = _with(p, f"SELECT {err}, count(*) AS n FROM validated GROUP BY {err}")
        q[f"validated_{p}"] = _with(p, f'SELECT transaction_id, "offset" AS {pre}_offset, {err} FROM validated')
        if p == "local":
            q["quarantine_local"] = _with(p, f"""
SELECT {EVENT_COLS}, event_timestamp, {_lineage(p)}, error_reason
FROM validated WHERE error_reason <> ''""")
            q["silver_local"] = _with(p, f"""
SELECT {EVENT_COLS}, {_lineage(p)}, CAST(epoch(ts_parsed) AS BIGINT) AS event_epoch
FROM silver""")
            risk_extra = "CAST(epoch(ts_parsed) AS BIGINT) AS event_epoch"
        else:
            q["quarantine_cloud"] = _with(p, f"""
SELECT {EVENT_COLS}, event_timestamp, {_lineage(p)}, validation_error
FROM validated WHERE validation_error IS NOT NULL""")
            q["silver_cloud"] = _with(p, f"""
SELECT {EVENT_COLS}, event_timestamp, {_lineage(p)}, validation_error FROM silver""")
            risk_extra = "event_timestamp"
        q[f"gold_risk_rows_{p}"] = _with(p, f"""
SELECT {EVENT_COLS}, {_lineage(p)}, {risk_extra}, risk_score, risk_level FROM gold""")
        daily_avg = f", {average()} AS {avg}" if p == "local" else ""
        q[f"gold_daily_{p}"] = _with(p, f"""
SELECT transaction_date, count(*) AS transaction_count, {total()} AS {tot}{daily_avg}
FROM gold GROUP BY transaction_date""")
        q[f"gold_country_{p}"] = _with(p, f"""
SELECT country, count(*) AS transaction_count, {total()} AS {tot}, {average()} AS {avg}
FROM gold GROUP BY country""")
        q[f"gold_payment_{p}"] = _with(p, f"""
SELECT payment_method, count(*) AS transaction_count, {total()} AS {tot}
FROM gold GROUP BY payment_method""")
        q[f"gold_risk_summary_{p}"] = _with(p, f"""
SELECT risk_level, count(*) AS transaction_count, {total()} AS {tot}
FROM gold GROUP BY risk_level""")
        q[f"total_value_{p}"] = _with(p, f"SELECT {total()} AS total_transaction_value FROM silver")
        q[f"total_value_{p}_parity"] = _with(
            p, "SELECT round(sum(amount), 2) AS total_transaction_value FROM silver")
        q[f"gold_risk_summary_{p}_parity"] = _with(p, f"""
SELECT risk_level, count(*) AS transaction_count, round(sum(amount), 2) AS {tot}
FROM gold GROUP BY risk_level""")
        for name, keys in (("daily", "transaction_date"), ("country", "country"), ("payment", "payment_method"),
                           ("merchant", "merchant_id, merchant_category" if p == "local" else "merchant_category")):
            averaged = name == "country" or p == "local" and name in ("daily", "merchant")
            more = f", {cents(f'({exact()}) / count(amount)')} AS {avg}" if averaged else ""
            q[f"gold_{name}_{p}_parity"] = _with(p, f"""
SELECT {keys}, count(*) AS transaction_count, round(sum(amount), 2) AS {tot}{more} FROM gold GROUP BY {keys}""")
        q[f"risk_distribution_{p}"] = _with(p, 'SELECT risk_level, count(*) AS "count" FROM gold GROUP BY risk_level')
        q[f"duplicates_removed_{p}"] = _with(p, """
SELECT (SELECT count(*) FROM valid) AS valid_before_dedup,
       (SELECT count(*) FROM silver) AS silver_records,
       (SELECT count(*) FROM valid) - (SELECT count(*) FROM silver) AS duplicates_removed""")
        q[f"monitoring_metrics_{p}"] = _with(p, """,
counts AS (
  SELECT (SELECT count(*) FROM ev) AS b,
         (SELECT count(*) FROM silver) AS s,
         (SELECT count(*) FROM validated) - (SELECT count(*) FROM valid) AS qn,
         (SELECT count(*) FROM gold) AS g,
         (SELECT count(*) FROM gold WHERE risk_level = 'HIGH') AS hi,
         (SELECT count(*) FROM gold WHERE risk_level = 'MEDIUM') AS me,
         (SELECT count(*) FROM gold WHERE risk_level = 'LOW') AS lo
)
SELECT 'ledgerlake' AS pipeline_name, 'SUCCESS' AS status,
       b AS bronze_records, s AS silver_records, qn AS quarantined_records,
       b - s - qn AS records_removed_during_quality_processing,
       g AS gold_risk_records, hi AS high_risk_transactions,
       me AS medium_risk_transactions, lo AS low_risk_transactions,
       round(s / b * 100, 2) AS silver_retention_rate_percent,
       round(qn / b * 100, 2) AS quarantine_rate_percent
FROM counts""")
        q[f"metrics_document_{p}"] = q[f"monitoring_metrics_{p}"]
    q["silver_table_cloud"] = q["silver_cloud"]

    q["gold_merchant_local"] = _with("local", f"""
SELECT merchant_id, merchant_category, count(*) AS transaction_count,
       {total()} AS total_transaction_amount, {average()} AS average_transaction_amount
FROM gold GROUP BY merchant_id, merchant_category""")
    q["top_merchants_local"] = q["gold_merchant_local"] + """
ORDER BY total_transaction_amount DESC, merchant_id, merchant_category LIMIT 10"""
    q["gold_merchant_cloud"] = _with("cloud", f"""
SELECT merchant_category, count(*) AS transaction_count, {total()} AS total_transaction_value
FROM gold GROUP BY merchant_category""")
    q["money_of_any_amount"] = """
WITH t AS (SELECT o_orderkey % 3 AS kind, CASE o_orderkey % 3 WHEN 0 THEN floor(o_totalprice * 2) / 100
    WHEN 1 THEN floor(o_totalprice) / 1024 ELSE floor(o_totalprice) * 1099511627776 END AS amount,
    CASE o_orderkey % 3 WHEN 2 THEN 1048576e0 ELSE 1152921504606846976e0 END AS unit FROM orders
), sums AS (SELECT kind, count(*) AS n,
    CAST(CAST(sum(CAST(amount * unit AS HUGEINT)) AS VARCHAR) AS DOUBLE) / any_value(unit) AS s FROM t GROUP BY kind)
SELECT kind, n AS transaction_count, CASE WHEN abs(s) < 1e13 THEN round(s, 2) ELSE s END AS total,
       CASE WHEN abs(s / n) < 1e13 THEN round(s / n, 2) ELSE s / n END AS average FROM sums"""
    q["offset_runs"] = "WITH " + EVENTS.strip() + """,
seen AS (SELECT partition, "offset" AS o, count(*) AS n FROM ev GROUP BY ALL),
marked AS (SELECT *, o - row_number() OVER (PARTITION BY partition ORDER BY o) AS island FROM seen),
runs AS (SELECT partition, min(o) AS first_offset, max(o) AS last_offset, CAST(sum(n) AS BIGINT) AS rows,
                CAST(sum(n) AS BIGINT) - count(*) AS repeats FROM marked GROUP BY partition, island)
SELECT *, lead(first_offset) OVER (PARTITION BY partition ORDER BY first_offset) - last_offset - 1 AS missing FROM runs"""
    q["content_differences"] = "WITH " + EVENTS.strip() + """
SELECT partition, "offset", CASE "offset" % 1000 WHEN 14 THEN 'lost' WHEN 16 THEN 'repeated' ELSE 'altered' END AS kind,
       CAST(1 AS BIGINT) AS left_rows, CAST(CASE "offset" % 1000 WHEN 14 THEN 0 WHEN 16 THEN 2 ELSE 1 END AS BIGINT) AS right_rows
FROM ev WHERE "offset" < 20000 AND "offset" % 1000 IN (14, 16, 18)"""
    steady = EVENT_COLS.replace(" city,", "")
    q["stream_silver_local"] = _with("local", f"""
SELECT {steady}, CAST(epoch(ts_parsed) AS BIGINT) AS event_epoch FROM silver""")
    q["stream_quarantine_local"] = q["quarantine_local"]
    q["published_silver_local"] = q["silver_local"]
    q["published_quarantine_local"] = q["quarantine_local"]
    q["incremental_daily_local"] = _with("local", f"""
SELECT transaction_date, count(*) AS transaction_count, {total()} AS total_transaction_amount,
       {cents(f'({exact()}) / count(amount)')} AS average_transaction_amount
FROM gold GROUP BY transaction_date""")
    q["stream_daily_local"] = _with("local", f""",
arrived AS (
  SELECT *, CAST(timezone('UTC', ts_parsed) AS TIMESTAMP) AS seen,
         NOT (timezone('UTC', ts_parsed) < TIMESTAMP '1995-07-01' AND "offset" % 100 <> 14) AS later FROM gold),
judged AS (
  SELECT *, later AND transaction_date + INTERVAL 1 DAY <= (SELECT max(seen) FROM arrived WHERE NOT later) - INTERVAL 2 DAY AS late
  FROM arrived),
timely AS (
  SELECT transaction_date, count(*) AS n, {total()} AS s, {cents(f'({exact()}) / count(amount)')} AS a
  FROM judged WHERE NOT late GROUP BY transaction_date),
missed AS (SELECT transaction_date, count(*) AS n FROM judged WHERE late GROUP BY transaction_date)
SELECT transaction_date, coalesce(t.n, 0) AS transaction_count, t.s AS total_transaction_amount,
       t.a AS average_transaction_amount, coalesce(m.n, 0) AS late_rows
FROM timely t FULL JOIN missed m USING (transaction_date)
WHERE transaction_date + INTERVAL 1 DAY <= (SELECT max(seen) FROM arrived) - INTERVAL 2 DAY""")
    value = """json_object('transaction_id', transaction_id, 'customer_id', customer_id,
         'account_id', account_id, 'merchant_id', merchant_id,
         'merchant_category', merchant_category, 'transaction_type', transaction_type,
         'amount', {}, 'currency', currency, 'payment_method', payment_method,
         'country', country, 'city', city, 'device_type', device_type, 'status', status,
         'event_timestamp', event_timestamp)::VARCHAR"""
    q["malformed_payloads"] = "WITH " + EVENTS.strip() + f""",
planted AS (
  SELECT *, "offset" % 1000 AS fault, {value.format('amount')} AS v, {value.format("'n/a'")} AS w FROM ev
  WHERE "offset" % 1000 IN (22, 24, 26, 28, 30))
SELECT {_lineage('local')},
       CASE fault WHEN 22 THEN v[:-2] WHEN 24 THEN concat('[', v, ',', v, ']') WHEN 26 THEN w WHEN 28 THEN '  ' END AS payload_text,
       CASE fault WHEN 22 THEN 'NOT_JSON' WHEN 24 THEN 'JSON_ARRAY' WHEN 26 THEN 'WRONG_TYPE'
               WHEN 28 THEN 'EMPTY_PAYLOAD' ELSE 'NO_PAYLOAD' END AS payload_error
FROM planted"""
    q["replayed_payloads"] = "WITH " + EVENTS.strip() + f"""
SELECT {EVENT_COLS}, event_timestamp, {_lineage('local')}
FROM ev JOIN (VALUES (22), (24), (24)) AS planted(fault) ON "offset" % 1000 = fault"""
    q["exact_sums"] = f"""
WITH t AS (SELECT l_returnflag, l_linestatus, l_extendedprice * (1 - l_discount)
    * CASE WHEN l_orderkey % 2 = 0 THEN 1e0 ELSE -1e0 END
    * CASE WHEN l_orderkey % 5 = 0 THEN 1048576e0 WHEN l_orderkey % 5 = 1 THEN 0.0009765625e0 ELSE 1e0 END AS x FROM lineitem)
SELECT l_returnflag, l_linestatus, count(*) AS n, {exact('x')} AS total FROM t GROUP BY l_returnflag, l_linestatus"""
    q["approved_count"] = _with("local", """
SELECT count(*) AS approved_count FROM silver WHERE status = 'APPROVED'""")
    return q
