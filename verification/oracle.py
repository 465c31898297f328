"""Independent SQL for every query, written for DuckDB over the same tables.

The common table expressions rebuild each layer from ``events``; each oracle
selects from them. Money is summed in whole cents on both sides, so results do
not depend on the order of addition and can be compared exactly.
"""


def total(x: str) -> str:
    return f"(CAST(sum(CAST(round({x} * 100) AS BIGINT)) AS DOUBLE) / 100.0)"


def mean(x: str) -> str:
    return f"({total(x)} / nullif(count({x}), 0))"


def pct(part: str, whole: str, digits: int) -> str:
    ratio = f"CAST({part} AS DOUBLE) * 100 / nullif(CAST({whole} AS DOUBLE), 0)"
    return f"CAST(round(CAST({ratio} AS DECIMAL(30, 12)), {digits}) AS DOUBLE)"


def stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def n_if(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def text(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


LAYERS = """
WITH tagged AS (
    SELECT *, round(value * 2000, 2) AS amt, CAST(event_id % 1000 AS DOUBLE) AS rest,
           CAST(event_id % 5000 AS DOUBLE) AS dest, event_id AS e, 0 AS again
    FROM events
    UNION ALL
    SELECT *, round(value * 2000, 2), CAST(event_id % 1000 AS DOUBLE),
           CAST(event_id % 5000 AS DOUBLE), event_id, 1
    FROM events WHERE event_id % 101 = 0
),
ledger AS (
    SELECT CAST((day(ts) - 1) * 24 + hour(ts) + 1 AS BIGINT) AS step,
           CASE WHEN e % 239 = 0 THEN NULL
                WHEN e % 227 = 0 THEN 'UNKNOWN'
                WHEN e % 241 = 0 THEN ' transfer '
                ELSE CASE event_type WHEN 'view' THEN 'PAYMENT' WHEN 'click' THEN 'TRANSFER'
                     WHEN 'purchase' THEN 'CASH_OUT' WHEN 'error' THEN 'DEBIT'
                     WHEN 'signup' THEN 'CASH_IN' END
           END AS type,
           CASE WHEN e % 211 = 0 THEN NULL WHEN e % 223 = 0 THEN -amt ELSE amt END AS amount,
           'C' || CAST(user_id AS VARCHAR) AS nameOrig,
           CASE e % 5 WHEN 0 THEN amt WHEN 1 THEN 0.0 ELSE amt + rest END AS oldbalanceOrg,
           CASE WHEN e % 5 IN (0, 1) OR e % 10 = 2 THEN 0.0 ELSE rest END AS newbalanceOrig,
           CASE WHEN e % 233 <> 0 THEN 'M' || CAST((e * 31) % 97 AS VARCHAR) END AS nameDest,
           dest AS oldbalanceDest, dest + amt AS newbalanceDest,
           CASE WHEN e % 229 = 0 THEN NULL WHEN e % 251 = 0 THEN 7
                WHEN e % 53 = 0 AND event_type IN ('click', 'purchase') THEN 1
                ELSE 0 END AS isFraud,
           CASE WHEN event_type = 'click' AND amt > 200000 THEN 1 ELSE 0 END AS isFlaggedFraud,
           CAST(user_id % 4 AS BIGINT) AS kafka_partition,
           CAST(e + again * 100000000 AS BIGINT) AS kafka_offset,
           ts AS sent_ts
    FROM tagged
),
message AS (
    SELECT *,
           round(oldbalanceOrg - newbalanceOrig, 2) AS balanceDropOrig,
           round(newbalanceDest - oldbalanceDest, 2) AS balanceChangeDest,
           round(amount, 2) AS expectedDrop,
           abs(round(oldbalanceOrg - newbalanceOrig, 2) - amount) < 0.01 AS dropMatchesAmount,
           oldbalanceOrg > 0 AND newbalanceOrig = 0 AS isFullDrain,
           coalesce(isFraud, 0) <> 0 AS isSuspicious,
           strftime(sent_ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS sentAt,
           'paysim-producer' AS source
    FROM ledger
),
judged AS (
    SELECT *,
           concat_ws('|',
               CASE WHEN amount IS NULL THEN 'amount_missing' END,
               CASE WHEN amount <= 0 THEN 'amount_not_positive' END,
               CASE WHEN nameOrig IS NULL THEN 'sender_missing' END,
               CASE WHEN nameDest IS NULL THEN 'receiver_missing' END,
               CASE WHEN coalesce(type, '') NOT IN
                    ('CASH_IN', 'CASH_OUT', 'DEBIT', 'PAYMENT', 'TRANSFER')
                    THEN 'type_unknown' END,
               CASE WHEN coalesce(isFraud, -1) NOT IN (0, 1) THEN 'label_invalid' END
           ) AS quarantine_reason,
           amount IS NOT NULL AND amount > 0 AND nameOrig IS NOT NULL AND nameDest IS NOT NULL
           AND type IN ('CASH_IN', 'CASH_OUT', 'DEBIT', 'PAYMENT', 'TRANSFER')
           AND isFraud IN (0, 1) AS verdict
    FROM message
),
bronze AS (SELECT * EXCLUDE (quarantine_reason, verdict) FROM judged WHERE verdict),
rejected AS (SELECT * FROM judged WHERE NOT coalesce(verdict, FALSE)),
cleaned AS (
    SELECT * REPLACE (upper(trim(type)) AS type, trim(nameOrig) AS nameOrig,
                      trim(nameDest) AS nameDest),
           CAST(sent_ts AS DATE) AS tx_date, hour(sent_ts) AS tx_hour
    FROM bronze
),
silver AS (
    SELECT * EXCLUDE (newest),
           FALSE AS dq_null_critical,
           amount <= 0 AS dq_negative_amount,
           FALSE AS dq_unknown_type,
           isFraud NOT IN (0, 1) AS dq_invalid_fraud_label,
           abs(balanceDropOrig - amount) > 1.0 AS dq_balance_mismatch,
           oldbalanceOrg > 0 AND newbalanceOrig = 0 AS dq_suspicious_zero_bal,
           abs(balanceDropOrig - amount) <= 1.0 AS dq_is_clean
    FROM (SELECT *, row_number() OVER (PARTITION BY nameOrig, nameDest, amount, step
                    ORDER BY kafka_offset DESC, kafka_partition) AS newest FROM cleaned)
    WHERE newest = 1
),
profiled AS (
    SELECT *,
           CAST(sum(CAST(round(amount * 100) AS BIGINT)) OVER day_of_sender AS DOUBLE) / 100.0
               / count(amount) OVER day_of_sender AS sender_avg_amount,
           count(*) OVER (PARTITION BY nameOrig, tx_date, step) AS sender_tx_count_in_step
    FROM silver
    WINDOW day_of_sender AS (PARTITION BY nameOrig, tx_date)
),
ruled AS (
    SELECT *, amount > 3 * sender_avg_amount AS r4_large_amount,
           sender_tx_count_in_step >= 3 AS r5_rapid_repeat
    FROM profiled
),
scored AS (
    SELECT *,
           concat_ws('|',
               CASE WHEN isFraud = 1 THEN 'R1:fraud_label' END,
               CASE WHEN dq_balance_mismatch THEN 'R2:balance_mismatch' END,
               CASE WHEN dq_suspicious_zero_bal THEN 'R3:full_drain' END,
               CASE WHEN r4_large_amount THEN 'R4:large_amount' END,
               CASE WHEN r5_rapid_repeat THEN 'R5:rapid_repeat' END) AS alert_reasons,
           CAST(coalesce(isFraud = 1, FALSE) AS INT)
               + CAST(coalesce(dq_balance_mismatch, FALSE) AS INT)
               + CAST(coalesce(dq_suspicious_zero_bal, FALSE) AS INT)
               + CAST(coalesce(r4_large_amount, FALSE) AS INT)
               + CAST(coalesce(r5_rapid_repeat, FALSE) AS INT) AS alert_score
    FROM ruled
),
alert AS (
    SELECT *, [NULL, 'LOW', 'MEDIUM', 'HIGH', 'HIGH', 'HIGH'][alert_score + 1] AS alert_severity,
           md5('alert-' || nameOrig || '-' || step || '-' || CAST(amount AS DECIMAL(18, 2)))
               AS alert_id
    FROM scored WHERE alert_score > 0
),
account_day AS (
    SELECT *,
           CASE WHEN fraud_tx_count > 0 THEN 'HIGH' WHEN suspicious_tx_count > 0 THEN 'MEDIUM'
                WHEN balance_mismatch_count > 0 THEN 'LOW' ELSE 'NORMAL' END
               AS account_risk_level,
           md5('summary-' || nameOrig || '-' || tx_date) AS summary_id
    FROM (
        SELECT nameOrig, tx_date, count(*) AS tx_count,
               {total_amount} AS total_amount_sent, {mean_amount} AS avg_amount,
               max(amount) AS max_amount, min(amount) AS min_amount,
               {total_drop} AS total_balance_drop,
               arg_min(oldbalanceOrg, step * 1000000000::HUGEINT + kafka_offset)
                   AS opening_balance,
               arg_max(newbalanceOrig, step * 1000000000::HUGEINT + kafka_offset)
                   AS closing_balance,
               count(*) FILTER (WHERE isFraud = 1) AS fraud_tx_count,
               count(*) FILTER (WHERE isSuspicious) AS suspicious_tx_count,
               count(*) FILTER (WHERE dq_balance_mismatch) AS balance_mismatch_count,
               count(*) FILTER (WHERE dq_suspicious_zero_bal) AS full_drain_count,
               count(DISTINCT nameDest) AS unique_recipients,
               count(DISTINCT type) AS unique_tx_types,
               count(DISTINCT tx_hour) AS hours_active,
               count(*) FILTER (WHERE type = 'CASH_IN') AS tx_cash_in_count,
               count(*) FILTER (WHERE type = 'CASH_OUT') AS tx_cash_out_count,
               count(*) FILTER (WHERE type = 'DEBIT') AS tx_debit_count,
               count(*) FILTER (WHERE type = 'PAYMENT') AS tx_payment_count,
               count(*) FILTER (WHERE type = 'TRANSFER') AS tx_transfer_count,
               count(*) FILTER (WHERE dq_is_clean) AS clean_tx_count
        FROM silver GROUP BY nameOrig, tx_date
    )
)
""".replace("{total_amount}", total("amount")).replace("{mean_amount}", mean("amount")).replace(
    "{total_drop}", total("balanceDropOrig")
)

MESSAGE = """step, type, amount, nameOrig, oldbalanceOrg, newbalanceOrig, nameDest,
 oldbalanceDest, newbalanceDest, CAST(isFraud AS BIGINT) AS isFraud,
 CAST(isFlaggedFraud AS BIGINT) AS isFlaggedFraud, balanceDropOrig, balanceChangeDest,
 expectedDrop, dropMatchesAmount, isFullDrain, isSuspicious, sentAt, source"""
BROKER = "kafka_partition, kafka_offset"
TX = "nameOrig, nameDest, amount, step, kafka_offset"
DAY_PARTS = """strftime(sent_ts, '%Y') AS year, strftime(sent_ts, '%m') AS month,
 strftime(sent_ts, '%d') AS day"""
SENT = f"{stamp('sent_ts')} AS sentAt"
CALENDAR = f"{text('tx_date')} AS transaction_date, CAST(tx_hour AS BIGINT) AS transaction_hour"
FLAGS = """dq_null_critical, dq_negative_amount, dq_unknown_type, dq_invalid_fraud_label,
 dq_balance_mismatch, dq_suspicious_zero_bal, dq_is_clean"""
ENVELOPE_TIME = f"{stamp('sent_ts')} AS kafka_timestamp"

LOADED = "(sent_ts + to_minutes(7 * kafka_partition))"
FACT = f"""md5(nameOrig || '-' || step || '-' || CAST(amount AS DECIMAL(18, 2)) || '-' || nameDest)
 AS transaction_id, step, type, amount, nameOrig AS name_orig, nameDest AS name_dest,
 oldbalanceOrg AS old_balance_orig, newbalanceOrig AS new_balance_orig,
 oldbalanceDest AS old_balance_dest, newbalanceDest AS new_balance_dest,
 balanceDropOrig AS balance_drop_orig, balanceChangeDest AS balance_change_dest,
 CAST(isFraud AS BIGINT) AS is_fraud, CAST(isFlaggedFraud AS BIGINT) AS is_flagged_fraud,
 isSuspicious AS is_suspicious, isFullDrain AS is_full_drain, {FLAGS},
 {stamp('sent_ts')} AS sent_at, {CALENDAR}, {BROKER}, {stamp(LOADED)} AS loaded_at"""

FRAUD = "CAST(sum(isFraud) AS BIGINT)"
FRAUD_AMOUNT = total("CASE WHEN isFraud = 1 THEN amount ELSE 0 END")
TWO_DAYS = "tx_date BETWEEN DATE '2024-01-15' AND DATE '2024-01-16'"
TX_DATE = f"{text('tx_date')} AS transaction_date"


def fraud_columns(digits: int = 3) -> str:
    return (
        f"count(*) AS total_transactions, {FRAUD} AS fraud_count, "
        f"{pct('sum(isFraud)', 'count(*)', digits)} AS fraud_rate_pct"
    )


SEVERITIES = f"""count(*) AS total_alerts, {n_if("alert_severity = 'HIGH'")} AS high_alerts,
 {n_if("alert_severity = 'MEDIUM'")} AS medium_alerts,
 {n_if("alert_severity = 'LOW'")} AS low_alerts"""
FLAGGED = f"""{total('amount')} AS total_flagged_amount, {mean('amount')} AS avg_flagged_amount"""
RISK_ROW = """nameOrig AS name_orig, CAST(tx_date AS VARCHAR) AS transaction_date, tx_count,
 fraud_tx_count, total_amount_sent, unique_recipients, account_risk_level"""
ACCOUNT_DAY = f"nameOrig, {TX_DATE}"
SUMMARY_MEASURES = {
    "volume": "tx_count, total_amount_sent, avg_amount, max_amount, min_amount",
    "balance": "total_balance_drop, opening_balance, closing_balance",
    "risk": "fraud_tx_count, suspicious_tx_count, balance_mismatch_count, full_drain_count,"
            " account_risk_level",
    "diversity": "unique_recipients, unique_tx_types, hours_active",
    "types": "tx_cash_in_count, tx_cash_out_count, tx_debit_count, tx_payment_count,"
             " tx_transfer_count",
    "quality": "clean_tx_count",
}

LOOSE = """SELECT *, amount IS NULL OR nameOrig IS NULL OR nameDest IS NULL OR type IS NULL
        OR step IS NULL AS no_key,
    amount <= 0 AS negative,
    upper(trim(type)) NOT IN ('CASH_IN', 'CASH_OUT', 'DEBIT', 'PAYMENT', 'TRANSFER') AS odd_type,
    isFraud NOT IN (0, 1) AS odd_label,
    abs(balanceDropOrig - amount) > 1.0 AS mismatch FROM message"""

BUCKET = """CASE WHEN amount < 1000 THEN 1 WHEN amount < 10000 THEN 2 WHEN amount < 50000 THEN 3
 WHEN amount < 100000 THEN 4 WHEN amount < 500000 THEN 5 ELSE 6 END"""
BUCKET_LABEL = """['< $1K', '$1K - $10K', '$10K - $50K', '$50K - $100K', '$100K - $500K',
 '> $500K']"""


def check(layer: str, name: str, metric: str, status: str, source: str, detail: str = "NULL"):
    return (
        f"SELECT '{layer}' AS layer, '{name}' AS \"check\", {status} AS status, metric, detail "
        f"FROM (SELECT CAST({metric} AS DOUBLE) AS metric, CAST({detail} AS VARCHAR) AS detail "
        f"FROM {source})"
    )


def graded(*rungs: str, otherwise: str = "failed") -> str:
    whens = " ".join(f"WHEN metric {cond} THEN '{status}'" for cond, status in
                     (rung.split(" -> ") for rung in rungs))
    return f"CASE {whens} ELSE '{otherwise}' END"


def share(condition: str, base: str = "count(*)") -> str:
    return f"CAST({n_if(condition)} AS DOUBLE) * 100 / CAST({base} AS DOUBLE)"


def tally(column: str, values) -> str:
    return " || '|' || ".join(
        f"""'{v}=' || {n_if(f"{column} = '{v}'")}""" for v in values
    )


BRONZE_CHECKS = [
    check("bronze", "row_count", "count(*)", graded("> 0 -> passed"), "message"),
    check("bronze", "required_columns", "max(0)", "'passed'", "message"),
    *(
        check("bronze", f"null_rate_{col}", share(f"{col} IS NULL"),
              graded("= 0 -> passed", "< 5 -> warning"), "message")
        for col in ("nameOrig", "nameDest", "amount", "type")
    ),
    check("bronze", "unknown_type_rate",
          share("coalesce(type, '') NOT IN "
                "('CASH_IN', 'CASH_OUT', 'DEBIT', 'PAYMENT', 'TRANSFER')"),
          graded("< 1 -> passed"), "message"),
    check("bronze", "type_distribution", "count(type)", "'info'", "message",
          tally("type", ("CASH_IN", "CASH_OUT", "DEBIT", "PAYMENT", "TRANSFER"))),
    check("bronze", "invalid_labels", n_if("coalesce(isFraud, -1) NOT IN (0, 1)"),
          graded("= 0 -> passed"), "message"),
]
SILVER_CHECKS = [
    check("silver", "row_count", "count(*)", graded("> 0 -> passed"), "silver"),
    check("silver", "required_columns", "max(0)", "'passed'", "silver"),
    check("silver", "clean_rate", share("dq_is_clean", "count(dq_is_clean)"),
          graded(">= 30 -> passed", ">= 10 -> warning"), "silver"),
    check("silver", "fraud_rate", "CAST(sum(isFraud) AS DOUBLE) * 100 / count(isFraud)",
          "'passed'", "silver"),
    check("silver", "mismatch_rate", share("dq_balance_mismatch", "count(dq_balance_mismatch)"),
          graded("< 70 -> passed", otherwise="warning"), "silver"),
    check("silver", "duplicates",
          "count(*) - count(DISTINCT (nameOrig, nameDest, amount, step))",
          graded("= 0 -> passed", otherwise="warning"), "silver"),
]
GOLD_CHECKS = [
    check("gold", "alert_rows", "count(*)", graded("> 0 -> passed"), "alert"),
    check("gold", "severity_distribution", "count(alert_severity)", graded("> 0 -> passed"),
          "alert", tally("alert_severity", ("HIGH", "MEDIUM", "LOW"))),
    check("gold", "score_range", n_if("alert_score NOT BETWEEN 1 AND 5"),
          graded("= 0 -> passed"), "alert", "min(alert_score) || '-' || max(alert_score)"),
    check("gold", "summary_rows", "count(*)", graded("> 0 -> passed"), "account_day"),
    check("gold", "risk_distribution", "count(account_risk_level)", graded("> 0 -> passed"),
          "account_day", tally("account_risk_level", ("HIGH", "MEDIUM", "LOW", "NORMAL"))),
]
TABLES = {"fact_transactions": "silver", "fraud_alerts": "alert",
          "transaction_summary": "account_day"}
WAREHOUSE_CHECKS = [
    *(check("warehouse", f"rows_{name}", "count(*)", "'info'", source)
      for name, source in TABLES.items()),
    check("warehouse", "reconcile", "0", "'passed'", "(SELECT 1)"),
]


ON_DAY = "tx_date = DATE '2024-01-15'"
DAY_CHECKS = [
    *(sql.replace("FROM silver)", f"FROM silver WHERE {ON_DAY})") for sql in SILVER_CHECKS),
    *(check(layer, "files_exist", "0", "'failed'", "(SELECT 1)") for layer in ("gold", "warehouse")),
]


def union(parts) -> str:
    return " UNION ALL ".join(parts)


_SELECTS = {
    # sources and sinks
    "unknown_types": """SELECT DISTINCT type FROM ledger WHERE coalesce(type, '') NOT IN
        ('CASH_IN', 'CASH_OUT', 'DEBIT', 'PAYMENT', 'TRANSFER')""",
    "ledger_slice": """SELECT step, type, amount, nameOrig, oldbalanceOrg, newbalanceOrig,
        nameDest, oldbalanceDest, newbalanceDest, CAST(isFraud AS BIGINT) AS isFraud,
        CAST(isFlaggedFraud AS BIGINT) AS isFlaggedFraud, kafka_offset
        FROM ledger ORDER BY kafka_offset LIMIT 500 OFFSET 100""",
    "ledger_slice_deep": """SELECT step, type, amount, nameOrig, oldbalanceOrg, newbalanceOrig,
        nameDest, oldbalanceDest, newbalanceDest, CAST(isFraud AS BIGINT) AS isFraud,
        CAST(isFlaggedFraud AS BIGINT) AS isFlaggedFraud, kafka_offset
        FROM (SELECT *, row_number() OVER (ORDER BY kafka_offset) - 1 AS place, count(*) OVER () // 2 AS half
              FROM ledger) WHERE place >= half AND place < 2 * half""",
    "ledger_fed": """SELECT type, count(*) AS row_count, count(*) FILTER (WHERE isSuspicious) AS fraud_count,
        count(*) FILTER (WHERE isFullDrain) AS drained, any_value(s) AS job_sent, any_value(f) AS job_fraud,
        any_value(u) AS job_unknown_type FROM (SELECT *, count(*) OVER () AS s,
            count(*) FILTER (WHERE isSuspicious) OVER () AS f,
            count(*) FILTER (WHERE coalesce(type, '') NOT IN ('CASH_IN', 'CASH_OUT', 'DEBIT', 'PAYMENT',
                'TRANSFER')) OVER () AS u
            FROM (SELECT * FROM message QUALIFY row_number() OVER (ORDER BY kafka_offset) > 100))
        GROUP BY type""",
    "ledger_csv": """SELECT step, type, amount, nameOrig, oldbalanceOrg, newbalanceOrig,
        nameDest, oldbalanceDest, newbalanceDest, CAST(isFraud AS BIGINT) AS isFraud,
        CAST(isFlaggedFraud AS BIGINT) AS isFlaggedFraud FROM ledger""",
    "json_roundtrip": f"SELECT {BROKER}, {MESSAGE} FROM message",
    "bronze_stream": f"SELECT {BROKER}, {ENVELOPE_TIME}, {MESSAGE}, {DAY_PARTS} FROM bronze",
    "quarantine_stream": f"""SELECT {BROKER}, {ENVELOPE_TIME}, {MESSAGE}, {DAY_PARTS},
        quarantine_reason FROM rejected""",
    "compacted_day": f"""SELECT {BROKER}, {ENVELOPE_TIME}, {MESSAGE} FROM bronze
        WHERE CAST(sent_ts AS DATE) = DATE '2024-01-15'""",
    "dedup_across_days": f"""SELECT {text('sent_day')} AS transaction_date, {TX} FROM (SELECT *,
        tx_date + CASE WHEN kafka_offset >= 100000000 THEN 1 ELSE 0 END AS sent_day FROM cleaned)
        WHERE sent_day BETWEEN DATE '2024-01-15' AND DATE '2024-01-17'
        QUALIFY sent_day = min(sent_day) OVER (PARTITION BY nameOrig, nameDest, amount, step)
        AND row_number() OVER (PARTITION BY nameOrig, nameDest, amount, step, sent_day
            ORDER BY kafka_offset DESC, kafka_partition) = 1""",
    "stream_restart": f"SELECT {TX}, kafka_partition, true AS each_batch_once FROM message",
    "batch_metrics": """SELECT 6 AS batch_count, count(*) AS input_rows,
        count(*) FILTER (WHERE verdict) AS valid, count(*) FILTER (WHERE NOT coalesce(verdict, false)) AS quarantined,
        0 AS rescued, count(*) FILTER (WHERE coalesce(isFraud, 0) <> 0) AS fraud,
        true AS equals_landed FROM judged""",
    "ingest_dedup": f"""SELECT 'bronze' AS route, {BROKER}, {MESSAGE} FROM bronze QUALIFY row_number() OVER (
        PARTITION BY nameOrig, nameDest, amount, step ORDER BY kafka_offset) = 1
        UNION ALL SELECT 'quarantine', {BROKER}, {MESSAGE} FROM rejected""",
    "stream_dedup": "SELECT DISTINCT nameOrig, nameDest, amount, step FROM message",
    "partition_file_count": f"""SELECT {DAY_PARTS}, true AS has_files, count(*) AS row_count
        FROM bronze GROUP BY ALL""",
    "partition_scan": f"""SELECT {BROKER}, {MESSAGE} FROM bronze
        WHERE CAST(sent_ts AS DATE) = DATE '2024-01-15'""",
    "overwrite_idempotent": f"""SELECT {TX_DATE}, count(*) AS row_count,
        CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS BIGINT) AS cents,
        count(DISTINCT (nameOrig, step, amount, nameDest)) AS id_count
        FROM silver GROUP BY tx_date""",
    "publish_fact": f"SELECT {FACT} FROM silver",
    "publish_interrupted": f"""SELECT phase, {TX_DATE}, count(*) AS row_count,
        CAST(sum(CAST(round(amount * 100) AS BIGINT) * CASE WHEN phase IN ('rerun', 'vacuumed')
            AND {ON_DAY} THEN 2 ELSE 1 END) AS BIGINT) AS cents
        FROM silver, (VALUES ('interrupted'), ('rerun'), ('as of the first'), ('vacuumed')) p(phase)
        GROUP BY phase, tx_date""",
    # enrichment and routing
    "enrich": f"SELECT {BROKER}, {MESSAGE} FROM message",
    "date_parts": f"SELECT kafka_offset, {DAY_PARTS} FROM message",
    "bronze_valid": f"SELECT {BROKER}, {MESSAGE} FROM bronze",
    "quarantine": f"SELECT {BROKER}, {MESSAGE} FROM rejected",
    "rescued_fields": """SELECT kafka_offset, CASE WHEN odd <> 'cut' THEN nameOrig END AS nameOrig,
        CASE odd WHEN 'amount' THEN '{"amount":"much"}' WHEN 'flag' THEN '{"isFlaggedFraud":[]}'
             WHEN 'unknown' THEN '{"channel":{"app":"web","hops":[1,2]}}' END AS rescued_fields,
        CASE odd WHEN 'cut' THEN 'json_unreadable' WHEN 'amount' THEN 'field_mistyped:amount'
             WHEN 'flag' THEN 'field_mistyped:isFlaggedFraud' END AS rescue_reason
        FROM (SELECT *, CASE WHEN kafka_offset % 37 = 0 THEN 'cut' WHEN kafka_offset % 41 = 0 THEN 'amount'
            WHEN kafka_offset % 43 = 0 THEN 'unknown' WHEN kafka_offset % 47 = 0 THEN 'flag' ELSE 'none'
            END AS odd FROM message)""",
    "quarantine_reasons": "SELECT kafka_offset, quarantine_reason FROM rejected",
    # silver
    "silver_cast": f"""SELECT {BROKER}, {MESSAGE} FROM (SELECT * REPLACE (
        upper(trim(type)) AS type, trim(nameOrig) AS nameOrig, trim(nameDest) AS nameDest)
        FROM message)""",
    "silver_time": f"""SELECT kafka_offset, {SENT}, {text('CAST(sent_ts AS DATE)')}
        AS transaction_date, CAST(hour(sent_ts) AS BIGINT) AS transaction_hour FROM message""",
    "dq_flags": f"""SELECT kafka_offset, no_key AS dq_null_critical,
        negative AS dq_negative_amount, odd_type AS dq_unknown_type,
        odd_label AS dq_invalid_fraud_label, mismatch AS dq_balance_mismatch,
        oldbalanceOrg > 0 AND newbalanceOrig = 0 AS dq_suspicious_zero_bal,
        NOT (no_key OR negative OR odd_type OR odd_label OR mismatch) AS dq_is_clean
        FROM ({LOOSE})""",
    "dq_mismatch_by_type": """SELECT kafka_offset, abs(balanceDropOrig - amount) > 1.0
        AND upper(trim(type)) IN ('TRANSFER', 'CASH_OUT') AS dq_balance_mismatch FROM message""",
    "null_drop": f"""SELECT {TX}, upper(trim(type)) AS type FROM ({LOOSE}) WHERE NOT no_key""",
    "null_fill": """SELECT kafka_offset,
        CASE WHEN kafka_offset % 3 = 0 THEN 0.0 ELSE oldbalanceOrg END AS oldbalanceOrg,
        CASE WHEN kafka_offset % 5 = 0 THEN 0.0 ELSE newbalanceOrig END AS newbalanceOrig,
        CASE WHEN kafka_offset % 7 = 0 THEN 0.0 ELSE oldbalanceDest END AS oldbalanceDest,
        CASE WHEN kafka_offset % 11 = 0 THEN 0.0 ELSE newbalanceDest END AS newbalanceDest,
        CASE WHEN kafka_offset % 13 = 0 THEN 0.0 ELSE balanceDropOrig END AS balanceDropOrig,
        CASE WHEN kafka_offset % 17 = 0 THEN 0.0 ELSE balanceChangeDest END AS balanceChangeDest,
        CAST(CASE WHEN kafka_offset % 19 = 0 THEN 0 ELSE isFlaggedFraud END AS BIGINT)
            AS isFlaggedFraud,
        CAST(CASE WHEN kafka_offset % 23 = 0 THEN -1 ELSE kafka_partition END AS BIGINT)
            AS kafka_partition FROM message""",
    "dedup_latest": f"SELECT {TX}, kafka_partition FROM silver",
    "duplicate_count": """SELECT CAST(count(*) - count(DISTINCT (nameOrig, nameDest, amount, step))
        AS BIGINT) AS duplicate_rows FROM bronze""",
    "silver_metrics": f"""SELECT count(*) AS total_rows, {n_if('dq_is_clean')} AS clean_rows,
        {pct(n_if('dq_is_clean'), 'count(*)', 1)} AS clean_pct,
        {n_if('isFraud = 1')} AS fraud_rows, {n_if('dq_balance_mismatch')} AS mismatch_rows,
        {n_if('dq_suspicious_zero_bal')} AS zero_balance_rows FROM silver""",
    "silver": f"""SELECT {BROKER}, {MESSAGE.replace('sentAt, ', '')}, {SENT}, {CALENDAR}, {FLAGS}
        FROM silver""",
    # alerts
    "alerts": f"""SELECT nameOrig, nameDest, type, amount, step, oldbalanceOrg, newbalanceOrig,
        oldbalanceDest, newbalanceDest, CAST(isFraud AS BIGINT) AS isFraud,
        CAST(isFlaggedFraud AS BIGINT) AS isFlaggedFraud, isSuspicious, alert_reasons,
        CAST(alert_score AS BIGINT) AS alert_score, alert_severity, {CALENDAR},
        dq_balance_mismatch, dq_suspicious_zero_bal, r4_large_amount, r5_rapid_repeat,
        sender_avg_amount, sender_tx_count_in_step, {SENT}, {BROKER} FROM alert""",
    "sender_avg": f"SELECT {TX}, sender_avg_amount FROM ruled",
    "sender_avg_history": f"""SELECT {TX}, sender_avg_amount, sender_tx_count_in_step,
        amount > 3 * sender_avg_amount AS r4_large_amount FROM (SELECT *,
        CAST(sum(CAST(round(amount * 100) AS BIGINT)) OVER sender AS DOUBLE) / 100.0
        / count(amount) OVER sender AS sender_avg_amount,
        count(*) OVER (PARTITION BY nameOrig, step) AS sender_tx_count_in_step
        FROM silver WINDOW sender AS (PARTITION BY nameOrig))""",
    "rule_large_amount": f"SELECT {TX}, r4_large_amount FROM ruled",
    "sender_velocity": f"SELECT {TX}, sender_tx_count_in_step FROM ruled",
    "rule_rapid_repeat": f"SELECT {TX}, r5_rapid_repeat FROM ruled",
    "alert_reasons": f"SELECT {TX}, alert_reasons FROM scored",
    "alert_score": f"SELECT {TX}, CAST(alert_score AS BIGINT) AS alert_score FROM scored",
    "alert_severity": f"""SELECT {TX}, CASE alert_score WHEN 0 THEN NULL WHEN 1 THEN 'LOW'
        WHEN 2 THEN 'MEDIUM' ELSE 'HIGH' END AS alert_severity FROM scored""",
    "alert_severity_5tier": f"""SELECT {TX}, CASE alert_score WHEN 0 THEN NULL WHEN 1 THEN 'LOW'
        WHEN 2 THEN 'MEDIUM' WHEN 3 THEN 'HIGH' ELSE 'CRITICAL' END AS alert_severity
        FROM scored""",
    "rule_threshold": f"""SELECT {TX}, concat_ws('|', nullif(alert_reasons, ''),
        CASE WHEN amount > 500000 THEN 'R6:threshold_amount' END) AS alert_reasons,
        CAST(points AS BIGINT) AS alert_score, CASE points WHEN 1 THEN 'LOW'
        WHEN 2 THEN 'MEDIUM' ELSE 'HIGH' END AS alert_severity FROM (SELECT *,
        alert_score + CAST(amount > 500000 AS INT) AS points FROM scored) WHERE points > 0""",
    "gold_metrics": f"""UNPIVOT (SELECT * FROM (SELECT
        {SEVERITIES} FROM alert) CROSS JOIN (SELECT count(*) AS accounts,
        {n_if("account_risk_level = 'HIGH'")} AS high_risk_accounts FROM account_day))
        ON COLUMNS(*) INTO NAME metric VALUE value""",
    # account days
    **{
        f"summary_{name}": f"SELECT {ACCOUNT_DAY}, {columns} FROM account_day"
        for name, columns in SUMMARY_MEASURES.items()
    },
    "summary": f"""SELECT {ACCOUNT_DAY}, {', '.join(SUMMARY_MEASURES.values())}
        FROM account_day""",
    "summary_alert_count": """SELECT s.nameOrig, CAST(s.tx_date AS VARCHAR) AS transaction_date,
        s.tx_count, count(a.alert_id) AS alert_tx_count FROM account_day s
        LEFT JOIN alert a ON a.nameOrig = s.nameOrig AND a.tx_date = s.tx_date
        GROUP BY ALL""",
    # warehouse
    "fact": f"SELECT {FACT} FROM silver",
    "fact_ids": f"SELECT kafka_offset, transaction_id FROM (SELECT {FACT} FROM silver)",
    "alert_ids": "SELECT kafka_offset, alert_id FROM alert",
    "summary_ids": f"SELECT nameOrig AS name_orig, {TX_DATE}, summary_id FROM account_day",
    "load_report": union(
        f"SELECT '{name}' AS table_name, count(*) AS rows_loaded FROM {source}"
        for name, source in TABLES.items()
    ),
    # reports
    "v_kpi_fraud_rate": f"""SELECT count(*) AS total_transactions, {FRAUD} AS total_fraud,
        {pct('sum(isFraud)', 'count(*)', 3)} AS fraud_rate_pct,
        {FRAUD_AMOUNT} AS total_fraud_amount, {total('amount')} AS total_transaction_amount,
        {pct(FRAUD_AMOUNT, total('amount'), 3)} AS fraud_amount_pct FROM silver""",
    "v_kpi_alert_summary": f"""SELECT {SEVERITIES}, {FLAGGED}, max(amount) AS max_flagged_amount
        FROM alert""",
    "clustered_lookup": f"""SELECT transaction_id, kafka_offset, step, amount, true AS few_files
        FROM (SELECT {FACT}, tx_date FROM silver) WHERE {ON_DAY} AND step BETWEEN 337 AND 341
        AND amount BETWEEN 1000 AND 30000 AND name_orig BETWEEN 'C1' AND 'C12'""",
    "alerts_with_history": f"""SELECT alert_id, kafka_offset, nameOrig AS name_orig, amount, alert_severity,
        history_tx, history_amount, first_seen, active_days, most_hours_active FROM alert
        LEFT JOIN (SELECT nameOrig, count(*) AS history_tx, {total('amount')} AS history_amount,
            {text('min(tx_date)')} AS first_seen FROM silver GROUP BY nameOrig) USING (nameOrig)
        LEFT JOIN (SELECT nameOrig, count(*) AS active_days, max(hours_active) AS most_hours_active
            FROM account_day GROUP BY nameOrig) USING (nameOrig)""",
    "median_from_sketches": """SELECT type, count(amount) AS priced, true AS within_bound
        FROM silver GROUP BY type""",
    "kpi_from_partials": f"""SELECT * FROM (SELECT count(*) AS total_transactions, {FRAUD} AS total_fraud,
        {pct('sum(isFraud)', 'count(*)', 3)} AS fraud_rate_pct,
        {FRAUD_AMOUNT} AS total_fraud_amount, {total('amount')} AS total_transaction_amount,
        {pct(FRAUD_AMOUNT, total('amount'), 3)} AS fraud_amount_pct FROM silver) UNION ALL BY NAME
        SELECT {SEVERITIES}, {FLAGGED}, max(amount) AS max_flagged_amount FROM alert""",
    "v_kpi_account_risk": """SELECT count(DISTINCT nameOrig) AS total_accounts,
        count(DISTINCT nameOrig) FILTER (WHERE account_risk_level = 'HIGH')
            AS high_risk_accounts,
        count(DISTINCT nameOrig) FILTER (WHERE account_risk_level = 'MEDIUM')
            AS medium_risk_accounts,
        count(DISTINCT nameOrig) FILTER (WHERE account_risk_level = 'LOW') AS low_risk_accounts,
        count(DISTINCT nameOrig) FILTER (WHERE account_risk_level = 'NORMAL')
            AS normal_accounts FROM account_day""",
    "v_daily_fraud_trend": f"""SELECT {TX_DATE}, {fraud_columns()},
        {total('amount')} AS total_amount, {FRAUD_AMOUNT} AS fraud_amount,
        {mean('amount')} AS avg_transaction_amount FROM silver GROUP BY tx_date""",
    "v_fraud_by_hour": f"""SELECT CAST(tx_hour AS BIGINT) AS transaction_hour, {fraud_columns()},
        {mean('amount')} AS avg_amount FROM silver GROUP BY tx_hour""",
    "v_daily_alert_trend": f"""SELECT {TX_DATE}, alert_severity, count(*) AS alert_count,
        {total('amount')} AS total_amount, avg(alert_score) AS avg_alert_score
        FROM alert GROUP BY tx_date, alert_severity""",
    "v_fraud_by_type_detail": f"""SELECT type, {fraud_columns()}, {mean('amount')} AS avg_amount,
        {total('amount')} AS total_amount, {FRAUD_AMOUNT} AS fraud_amount,
        min(amount) AS min_amount, max(amount) AS max_amount,
        quantile_cont(amount, 0.5) AS median_amount FROM silver GROUP BY type""",
    "v_amount_distribution": f"""SELECT {BUCKET_LABEL}[bucket] AS amount_bucket,
        CAST(bucket AS BIGINT) AS bucket_order, count(*) AS transaction_count,
        {FRAUD} AS fraud_count, {pct('sum(isFraud)', 'count(*)', 2)} AS fraud_rate_pct,
        {total('amount')} AS total_amount FROM (SELECT *, {BUCKET} AS bucket FROM silver)
        GROUP BY bucket""",
    "v_balance_drain_analysis": f"""SELECT type, count(*) AS total_transactions,
        {n_if('isFullDrain')} AS full_drain_count,
        {pct(n_if('isFullDrain'), 'count(*)', 2)} AS full_drain_pct,
        {n_if('dq_balance_mismatch')} AS balance_mismatch_count,
        {mean('balanceDropOrig')} AS avg_balance_drop FROM silver GROUP BY type""",
    "v_top_risk_accounts": f"""SELECT {RISK_ROW}, suspicious_tx_count, avg_amount, max_amount,
        hours_active, full_drain_count, balance_mismatch_count, tx_transfer_count,
        tx_cash_out_count, opening_balance, closing_balance, total_balance_drop
        FROM account_day WHERE account_risk_level IN ('HIGH', 'MEDIUM')
        ORDER BY fraud_tx_count DESC, total_amount_sent DESC, nameOrig, tx_date LIMIT 100""",
    "v_account_risk_distribution": f"""SELECT account_risk_level,
        count(DISTINCT nameOrig) AS account_count,
        CAST(sum(tx_count) AS BIGINT) AS total_transactions,
        {total('total_amount_sent')} AS total_amount, avg(tx_count) AS avg_tx_per_account,
        avg(unique_recipients) AS avg_unique_recipients
        FROM account_day GROUP BY account_risk_level""",
    "v_account_activity_patterns": f"""SELECT nameOrig AS name_orig,
        CAST(sum(tx_count) AS BIGINT) AS total_tx, {total('total_amount_sent')} AS total_amount,
        CAST(sum(fraud_tx_count) AS BIGINT) AS total_fraud,
        max(unique_recipients) AS max_unique_recipients, max(hours_active) AS max_hours_active,
        max(account_risk_level) AS risk_level,
        arg_min(account_risk_level, CASE account_risk_level WHEN 'HIGH' THEN 1
            WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 3 ELSE 4 END) AS worst_risk_level,
        count(DISTINCT tx_date) AS active_days FROM account_day GROUP BY nameOrig""",
    "v_alert_detail": f"""SELECT alert_id, {CALENDAR}, nameOrig AS name_orig,
        nameDest AS name_dest, type, amount, step, oldbalanceOrg AS old_balance_orig,
        newbalanceOrig AS new_balance_orig, oldbalanceDest AS old_balance_dest,
        newbalanceDest AS new_balance_dest, CAST(isFraud AS BIGINT) AS is_fraud,
        isSuspicious AS is_suspicious, alert_severity,
        CAST(alert_score AS BIGINT) AS alert_score, alert_reasons, dq_balance_mismatch,
        dq_suspicious_zero_bal, r4_large_amount, r5_rapid_repeat, sender_avg_amount,
        sender_tx_count_in_step, CAST(round(CAST(amount / nullif(sender_avg_amount, 0)
            AS DECIMAL(30, 12)), 2) AS DOUBLE) AS amount_vs_avg_ratio,
        {stamp('sent_ts')} AS sent_at, {stamp(LOADED)} AS loaded_at FROM alert""",
    "v_alert_rule_breakdown": f"""SELECT rule_name, trigger_count,
        {pct('trigger_count', 'sum(trigger_count) OVER ()', 2)} AS trigger_pct, avg_amount,
        confirmed_fraud_count FROM (SELECT rule_name, count(*) AS trigger_count,
        {mean('amount')} AS avg_amount, {n_if('isFraud = 1')} AS confirmed_fraud_count
        FROM (SELECT amount, isFraud, unnest(string_split(alert_reasons, '|')) AS rule_name
        FROM alert) GROUP BY rule_name)""",
    "v_daily_dq_metrics": f"""SELECT {TX_DATE}, count(*) AS total_rows,
        {n_if('dq_is_clean')} AS clean_rows,
        {pct(n_if('dq_is_clean'), 'count(*)', 2)} AS clean_rate_pct,
        {n_if('dq_null_critical')} AS null_critical_count,
        {n_if('dq_balance_mismatch')} AS balance_mismatch_count,
        {n_if('dq_suspicious_zero_bal')} AS suspicious_zero_count,
        {n_if('dq_negative_amount')} AS negative_amount_count,
        {n_if('dq_unknown_type')} AS unknown_type_count,
        {n_if('dq_invalid_fraud_label')} AS invalid_label_count FROM silver GROUP BY tx_date""",
    "v_pipeline_load_history": f"""SELECT {TX_DATE}, {stamp(f'min({LOADED})')} AS first_loaded_at,
        {stamp(f'max({LOADED})')} AS last_loaded_at, count(*) AS rows_loaded,
        date_diff('minute', min({LOADED}), max({LOADED})) AS load_duration_mins
        FROM silver GROUP BY tx_date""",
    "v_daily_fraud_summary": f"SELECT {TX_DATE}, {SEVERITIES}, {FLAGGED} FROM alert "
                             "GROUP BY tx_date",
    "v_high_risk_accounts": f"""SELECT {RISK_ROW} FROM account_day
        WHERE account_risk_level IN ('HIGH', 'MEDIUM')""",
    "v_fraud_by_type": f"""SELECT type, {fraud_columns(2)}, {mean('amount')} AS avg_amount,
        {total('amount')} AS total_amount FROM silver GROUP BY type""",
    "fraud_trend_7d": f"""SELECT transaction_date, total_transactions, fraud_count,
        fraud_rate_pct, CAST(sum(fraud_count) OVER week AS BIGINT) AS fraud_count_7d,
        {pct('sum(fraud_count) OVER week', 'sum(total_transactions) OVER week', 3)}
            AS fraud_rate_7d_pct
        FROM (SELECT tx_date, {TX_DATE}, {fraud_columns()} FROM silver GROUP BY tx_date)
        WINDOW week AS (ORDER BY tx_date RANGE BETWEEN INTERVAL 6 DAY PRECEDING
            AND CURRENT ROW)""",
    "fraud_heatmap": f"SELECT step, type, {fraud_columns()} FROM silver GROUP BY step, type",
    "pipeline_health": union(
        f"""SELECT '{name}' AS table_name, count(*) AS row_count,
        {text('min(tx_date)')} AS first_date, {text('max(tx_date)')} AS last_date,
        count(DISTINCT tx_date) AS day_count FROM {source}"""
        for name, source in TABLES.items()
    ),
    # quality
    "dq_bronze": union(BRONZE_CHECKS),
    "dq_silver": union(SILVER_CHECKS),
    "dq_gold": union(GOLD_CHECKS),
    "type_distribution": "SELECT type, count(*) AS row_count FROM message GROUP BY type",
    "severity_distribution": """SELECT alert_severity, count(*) AS row_count FROM alert
        GROUP BY alert_severity""",
    "risk_distribution": """SELECT account_risk_level, count(*) AS row_count FROM account_day
        GROUP BY account_risk_level""",
    "warehouse_counts": union(
        f"SELECT {TX_DATE}, count(*) AS row_count, '{name}' AS table_name "
        f"FROM {source} GROUP BY tx_date"
        for name, source in TABLES.items()
    ),
    "reconcile": f"""SELECT {TX_DATE}, silver_rows, fact_rows, CASE WHEN fact_rows = silver_rows
        THEN 'passed' WHEN fact_rows > 0 THEN 'warning' ELSE 'failed' END AS status FROM (
        SELECT tx_date, count(*) AS silver_rows, count(*) FILTER (WHERE tx_date <> DATE '2024-01-16'
        AND NOT (tx_date = DATE '2024-01-15' AND step % 2 = 0)) AS fact_rows
        FROM silver GROUP BY tx_date)""",
    "job_rerun_emptied_day": union(
        f"SELECT '{name}' AS table_name, {TX_DATE}, count(*) AS row_count FROM {source} "
        f"WHERE tx_date = DATE '2024-01-16' GROUP BY tx_date"
        for name, source in TABLES.items()
    ),
    "job_day": union(
        f"SELECT '{name}' AS table_name, {TX_DATE}, count(*) AS row_count FROM {source} "
        f"WHERE {ON_DAY} GROUP BY tx_date"
        for name, source in TABLES.items()
    ),
    "catalog_after_two_loads": f"""SELECT * FROM (SELECT type, {fraud_columns(2)}, {mean('amount')} AS avg_amount,
        {total('amount')} AS total_amount FROM silver WHERE {TWO_DAYS} GROUP BY type) UNION ALL BY NAME SELECT * FROM ("""
    + union(
        f"""SELECT '{name}' AS table_name, count(*) AS row_count, {text('min(tx_date)')} AS first_date,
        {text('max(tx_date)')} AS last_date, count(DISTINCT tx_date) AS day_count
        FROM {source} WHERE {TWO_DAYS}"""
        for name, source in TABLES.items()
    ) + ")",
    "silver_job_metrics": f"""SELECT count(*) AS total_rows, {n_if('dq_is_clean')} AS clean_rows,
        {pct(n_if('dq_is_clean'), 'count(*)', 1)} AS clean_pct,
        {n_if('isFraud = 1')} AS fraud_rows, {n_if('dq_balance_mismatch')} AS mismatch_rows,
        {n_if('dq_suspicious_zero_bal')} AS zero_balance_rows,
        (SELECT count(*) FROM bronze WHERE CAST(sent_ts AS DATE) = DATE '2024-01-15') AS rows_read,
        0::BIGINT AS incomplete_rows,
        (SELECT count(*) FROM bronze WHERE CAST(sent_ts AS DATE) = DATE '2024-01-15') - count(*)
        AS duplicate_rows FROM silver WHERE {ON_DAY}""",
    "dq_absent_day": union(DAY_CHECKS),
    "dq_gate": f"""SELECT passed, warnings, failed, CASE WHEN failed > 0 THEN 'failures'
        WHEN warnings > 0 THEN 'warnings' ELSE 'all clear' END AS verdict, failed > 0 AS refused FROM (SELECT
        {n_if("status = 'passed'")} AS passed, {n_if("status = 'warning'")} AS warnings,
        {n_if("status = 'failed'")} AS failed FROM ({union(DAY_CHECKS)}))""",
    "dq_report": f"""SELECT passed, warnings, failed, CASE WHEN failed > 0 THEN 'failures'
        WHEN warnings > 0 THEN 'warnings' ELSE 'all clear' END AS verdict FROM (SELECT
        {n_if("status = 'passed'")} AS passed, {n_if("status = 'warning'")} AS warnings,
        {n_if("status = 'failed'")} AS failed FROM (
        {union(BRONZE_CHECKS + SILVER_CHECKS + GOLD_CHECKS + WAREHOUSE_CHECKS)}))""",
}

ORACLES = {name: f"{LAYERS} {select}" for name, select in _SELECTS.items()}
