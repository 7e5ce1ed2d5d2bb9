"""DuckDB SQL for every catalog query that SQL can express.

Ratios that Spark rounds half-up are computed in whole numbers here, because rounding a double
would decide exact halves by its binary error.
"""

from __future__ import annotations

SNAPSHOTS = ["2024-01-15", "2024-01-29", "2024-01-30", "2024-01-31"]
DAY = "DATE '2024-01-30'"
REPORT_DAY = ["2024-01-30"]
MERGE_DAY = "DATE '2024-01-16'"
LIMIT_DAY = 86_400


def half_up(numerator: str, denominator: str) -> str:
    """Nearest whole number to a non-negative ratio, halves up."""
    return f"((2 * ({numerator}) + ({denominator})) // (2 * ({denominator})))"


def ratio(numerator: str, denominator: str, digits: int, shown: int) -> str:
    """The ratio rounded to ``digits``, shown times ten to the ``digits - shown``, as double."""
    scaled = f"CAST(({numerator}) AS HUGEINT) * {10 ** digits}"
    whole = half_up(scaled, f"CAST(({denominator}) AS HUGEINT)")
    return f"CAST({whole} AS DOUBLE) / {10 ** shown}"


def mean(total: str, count: str) -> str:
    """Mean of money with six digits."""
    cents = f"CAST(({total}) * 100 AS HUGEINT)"
    whole = half_up(f"{cents} * 10000", f"CAST(({count}) AS HUGEINT)")
    return (f"CAST(CAST({whole} AS DECIMAL(28,0)) * CAST(0.000001 AS DECIMAL(7,6)) "
            "AS DECIMAL(22,6))")


def money(expression: str) -> str:
    return f"CAST({expression} AS DECIMAL(28,2))"


def draw(key: str, purpose: str, sides: int) -> str:
    return f"(CAST('0x' || substr(md5({key} || ':{purpose}'), 1, 8) AS BIGINT) % {sides})"


CURRENCIES = "['USD','EUR','BRL','GBP','JPY','CAD','AUD']"
TYPES = "['purchase','transfer','withdrawal','deposit','refund']"
CATEGORIES = ("['grocery','restaurant','travel','entertainment','healthcare','utilities',"
              "'online_retail','fuel']")
PAYMENTS = "['credit_card','debit_card','pix','wire_transfer','cash']"
ACCOUNT_TYPES = "['checking','savings','investment','credit']"

PAYLOAD = [
    "transaction_id", "account_id", "customer_id", "transaction_type", "amount", "currency",
    "merchant", "merchant_category", "timestamp", "status", "payment_method",
    "device_fingerprint", "ip_country", "_is_late_arrival",
]
META = ["kafka_offset", "kafka_partition", "kafka_timestamp", "ingestion_timestamp",
        "ingestion_date"]
CRITICAL = ["transaction_id", "customer_id", "account_id", "amount", "timestamp"]


def _quoted(name: str) -> str:
    return f'"{name}"'


def cols(names: list[str]) -> str:
    return ", ".join(map(_quoted, names))


SENT = f"""
deliveries AS (
  SELECT e.*, CAST(regexp_extract(e.props, '[0-9]+') AS INTEGER) AS k, d.delivery
  FROM events e JOIN (VALUES (0), (1)) d(delivery) ON d.delivery = 0 OR e.event_id % 50 = 0
),
plain AS (
  SELECT *,
    printf('TXN%08d', event_id) AS txn,
    printf('ACC%08d', user_id * 2 + CAST(event_type = 'purchase' AS INTEGER)) AS acc,
    {CURRENCIES}[k % 7 + 1] AS cur,
    {TYPES}[k % 5 + 1] AS kind,
    CASE WHEN event_type = 'error' THEN 'failed' WHEN k % 10 = 0 THEN 'pending'
         ELSE 'completed' END AS state,
    CAST(value AS DECIMAL(18,2)) AS amt,
    ts + to_minutes(k % 40 + delivery * 5) AS arrived
  FROM deliveries
),
sent AS (
  SELECT event_id % 500 = 499 AS corrupt, event_id,
    CASE WHEN event_id % 40 = 3 THEN ' ' || txn || ' ' ELSE txn END AS transaction_id,
    CASE WHEN event_id % 40 = 3 THEN ' ' || acc || ' ' ELSE acc END AS account_id,
    CASE WHEN event_id % 100 <> 7 THEN
      printf('CUS%08d', user_id + CASE WHEN event_id % 90 = 31 THEN 50000000 ELSE 0 END)
    END AS customer_id,
    CASE WHEN event_id % 5 = 2 THEN ' ' || upper(kind) ELSE kind END AS transaction_type,
    CAST(CASE WHEN event_id % 300 = 19 THEN 0 WHEN event_id % 20 = 13 THEN -amt ELSE amt END
         AS DECIMAL(18,2)) AS amount,
    CASE WHEN event_id % 200 = 11 THEN 'XXX'
         WHEN event_id % 4 = 1 THEN ' ' || lower(cur) || ' ' ELSE cur END AS currency,
    'M' || k AS merchant,
    {CATEGORIES}[k % 8 + 1] AS merchant_category,
    ts AS "timestamp",
    CASE WHEN delivery = 1 THEN 'completed' WHEN event_id % 250 = 17 THEN 'reversed'
         WHEN event_id % 6 = 1 THEN upper(state) ELSE state END AS status,
    CASE WHEN event_id % 10 <> 0 THEN {PAYMENTS}[k % 5 + 1] END AS payment_method,
    CASE WHEN event_id % 3 = 0 THEN printf('DEV%08d', user_id) END AS device_fingerprint,
    CASE WHEN event_id % 3 = 0 THEN 'NATION_' || (k % 25) END AS ip_country,
    CASE WHEN k % 40 >= 10 THEN 'true' ELSE 'false' END AS _is_late_arrival,
    event_id * 2 + delivery AS kafka_offset,
    CAST(user_id % 12 AS INTEGER) AS kafka_partition,
    arrived AS kafka_timestamp, arrived AS ingestion_timestamp,
    CAST(arrived AS DATE) AS ingestion_date
  FROM plain
)"""

_JSON = [  # name, whether it is quoted, expression of its text
    ("transaction_id", True, "transaction_id"), ("account_id", True, "account_id"),
    ("customer_id", True, "customer_id"), ("transaction_type", True, "transaction_type"),
    ("amount", False, "CAST(amount AS VARCHAR)"), ("currency", True, "currency"),
    ("merchant", True, "merchant"), ("merchant_category", True, "merchant_category"),
    ("timestamp", True, "strftime(\"timestamp\", '%Y-%m-%dT%H:%M:%S.%f')"),
    ("status", True, "status"), ("payment_method", True, "payment_method"),
    ("device_fingerprint", True, "device_fingerprint"), ("ip_country", True, "ip_country"),
    ("_is_late_arrival", False, "_is_late_arrival"),
]


def json_object(fields: list[tuple[str, bool, str]]) -> str:
    """JSON text without NULL fields; the first field must not be NULL."""
    parts = []
    for place, (name, quoted, text) in enumerate(fields):
        mark = '"' if quoted else ""
        piece = f"'{',' if place else ''}\"{name}\":{mark}' || {text} || '{mark}'"
        parts.append(f"coalesce({piece}, '')")
    return "'{' || " + " || ".join(parts) + " || '}'"


BRONZE = f"""
bronze AS (
  SELECT account_id AS kafka_key,
    CASE WHEN corrupt THEN 'corrupt:' || event_id ELSE {json_object(_JSON)} END AS raw_payload,
    'transaction-events' AS kafka_topic, {cols(META)}, event_id
  FROM sent
)"""
PARSED = "parsed AS (SELECT " + ", ".join(
    f'CASE WHEN NOT corrupt THEN "{c}" END AS "{c}"' for c in PAYLOAD
) + f", {cols(META)} FROM sent)"
LACKING = " OR ".join(f'"{c}" IS NULL' for c in CRITICAL)


def _cleaned(source: str) -> str:
    return f"""
  SELECT trim(transaction_id) AS transaction_id, trim(account_id) AS account_id,
    trim(customer_id) AS customer_id, lower(trim(transaction_type)) AS transaction_type,
    abs(amount) AS amount,
    CASE WHEN upper(trim(currency)) IN ('USD','EUR','BRL','GBP','JPY','CAD','AUD')
         THEN upper(trim(currency)) ELSE 'UNKNOWN' END AS currency,
    merchant, merchant_category, "timestamp",
    CASE WHEN lower(trim(status)) IN ('completed','pending','failed')
         THEN lower(trim(status)) ELSE 'unknown' END AS status,
    payment_method, device_fingerprint, ip_country, _is_late_arrival, {cols(META)},
    CAST(ingestion_timestamp AS DATE) AS processing_date,
    CAST("timestamp" AS DATE) AS event_date,
    "timestamp" < ingestion_timestamp - INTERVAL 30 MINUTE AS is_late_arrival
  FROM {source} WHERE NOT ({LACKING})"""


def latest(source: str, where: str = "true", order: str = "DESC") -> str:
    return f"""
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY
      ingestion_timestamp {order}, kafka_partition {order}, kafka_offset {order}) AS rn
    FROM {source} WHERE {where}) WHERE rn = 1"""


CLEAN = f"clean AS ({_cleaned('parsed')})"
SILVER = f"silver AS ({latest('clean')})"
CUSTOMERS = """
customers AS (
  SELECT printf('CUS%08d', c_custkey) AS customer_id, c_name AS name,
    CAST(c_custkey % 63 + 18 AS INTEGER) AS age, n_name AS country, c_mktsegment AS segment,
    lower(replace(c_name, '#', '.')) || '@example.com' AS email,
    printf('+1-%010d', c_custkey) AS phone,
    ['USD','EUR','BRL','GBP'][c_custkey % 4 + 1] AS preferred_currency,
    CAST(DATE '2019-01-01' + CAST(c_custkey % 1800 AS INTEGER) AS TIMESTAMP) AS created_at,
    CAST(DATE '2019-01-01' + CAST(c_custkey % 1800 + c_custkey % 365 AS INTEGER) AS TIMESTAMP)
      AS updated_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""
ACCOUNTS = f"""
accounts AS (
  SELECT printf('ACC%08d', c_custkey * 2 + nth) AS account_id,
    printf('CUS%08d', c_custkey) AS customer_id,
    {ACCOUNT_TYPES}[(c_custkey + nth) % 4 + 1] AS account_type,
    CASE WHEN c_custkey % 20 = 0 THEN 'blocked' WHEN c_custkey % 10 = 1 THEN 'inactive'
         ELSE 'active' END AS status,
    CAST(c_acctbal AS DECIMAL(18,2)) AS balance,
    ['USD','EUR','BRL','GBP'][c_custkey % 4 + 1] AS currency,
    CAST(DATE '2019-01-01' + CAST(c_custkey % 1800 AS INTEGER) AS TIMESTAMP) AS created_at
  FROM customer, (VALUES (0), (1)) n(nth)
)"""
LEDGER = [SENT, BRONZE, PARSED, CLEAN, SILVER, CUSTOMERS, ACCOUNTS]


def ledger(select: str, *more: str) -> str:
    """A query over the ledger tables and further table expressions."""
    return "WITH " + ",\n".join([*LEDGER, *more]) + "\n" + select


def snapshots(days: list[str]) -> str:
    values = ", ".join(f"(DATE '{d}')" for d in days)
    return f"snapshots(process_date) AS (VALUES {values})"


# --- gold customers -------------------------------------------------------------------------

CORE = f"""
core AS (
  SELECT process_date, customer_id, count(*) AS total_transactions,
    {money('sum(amount)')} AS total_spend,
    {mean('sum(amount)', 'count(*)')} AS avg_transaction_value,
    quantile_disc(amount, 0.95) AS p95_transaction_value,
    max("timestamp") AS last_transaction_at, min("timestamp") AS first_transaction_at,
    max(event_date) AS last_event_date,
    count(DISTINCT event_date) AS active_days, count(DISTINCT account_id) AS accounts_used,
    {money("coalesce(sum(amount) FILTER (transaction_type = 'purchase'), 0)")} AS total_purchases,
    {money("coalesce(sum(amount) FILTER (transaction_type = 'transfer'), 0)")} AS total_transfers,
    CAST(process_date - max(event_date) AS INTEGER) AS recency_days,
    count(*) AS frequency, {money('sum(amount)')} AS monetary
  FROM snapshots JOIN silver
    ON event_date BETWEEN process_date - 90 AND process_date AND status <> 'failed'
  GROUP BY process_date, customer_id
)"""


def scores(source: str, recency: str = "recency_days", by: str = "process_date") -> str:
    part = f"PARTITION BY {by} " if by else ""
    return f"""
scored AS (
  SELECT *, recency_score + frequency_score + monetary_score AS rfm_score FROM (
    SELECT *,
      CAST(ntile(5) OVER ({part}ORDER BY {recency}, customer_id) AS INTEGER) AS recency_score,
      CAST(ntile(5) OVER ({part}ORDER BY frequency, customer_id) AS INTEGER) AS frequency_score,
      CAST(ntile(5) OVER ({part}ORDER BY monetary, customer_id) AS INTEGER) AS monetary_score
    FROM {source})
)"""


def tier(score: str) -> str:
    return (f"CASE WHEN {score} >= 12 THEN 'champion' WHEN {score} >= 9 THEN 'loyal' "
            f"WHEN {score} >= 6 THEN 'potential' WHEN {score} >= 4 THEN 'at_risk' "
            "ELSE 'churned' END")


GOLD_CUSTOMERS = f"""
gold_customers AS (
  SELECT s.* EXCLUDE (last_event_date, frequency, monetary), {tier('rfm_score')} AS activity_tier,
    name, country, segment, preferred_currency, age
  FROM scored s LEFT JOIN customers USING (customer_id)
)"""


def customer_report(select: str, days: list[str] | None = None) -> str:
    return ledger(select, snapshots(days or SNAPSHOTS), CORE, scores("core"), GOLD_CUSTOMERS)


# --- gold transactions ----------------------------------------------------------------------

def by_type(source: str, keys: str = "") -> str:
    return f"""
  SELECT {keys}event_date, transaction_type, currency, count(*) AS tx_count,
    {money('sum(amount)')} AS total_volume, {mean('sum(amount)', 'count(*)')} AS avg_amount,
    quantile_disc(amount, 0.5) AS p50_amount, quantile_disc(amount, 0.95) AS p95_amount,
    quantile_disc(amount, 0.99) AS p99_amount,
    count(*) FILTER (status = 'completed') AS completed_count,
    count(*) FILTER (status = 'failed') AS failed_count,
    count(*) FILTER (is_late_arrival) AS late_arrival_count,
    count(*) FILTER (status = 'completed') / count(*) AS success_rate,
    'daily_by_type' AS granularity
  FROM {source} GROUP BY {keys}event_date, transaction_type, currency"""


def by_merchant(source: str, keys: str = "") -> str:
    return f"""
  SELECT {keys}event_date, merchant_category, count(*) AS tx_count,
    {money('sum(amount)')} AS total_volume, {mean('sum(amount)', 'count(*)')} AS avg_amount,
    count(DISTINCT merchant) AS unique_merchants, 'daily_by_merchant' AS granularity
  FROM {source} GROUP BY {keys}event_date, merchant_category"""


def by_hour(source: str, keys: str = "") -> str:
    return f"""
  SELECT {keys}date_trunc('hour', "timestamp") AS hour, transaction_type, count(*) AS tx_count,
    {money('sum(amount)')} AS total_volume,
    CAST(date_trunc('hour', "timestamp") AS DATE) AS event_date, 'hourly' AS granularity
  FROM {source} GROUP BY {keys}date_trunc('hour', "timestamp"), transaction_type"""


def by_payment(source: str, keys: str = "") -> str:
    return f"""
  SELECT {keys}event_date, payment_method, count(*) AS tx_count,
    {money('sum(amount)')} AS total_volume, 'daily_by_payment' AS granularity
  FROM {source} WHERE payment_method IS NOT NULL GROUP BY {keys}event_date, payment_method"""


RECENT = """
recent AS (SELECT process_date, silver.* FROM snapshots JOIN silver
           ON event_date BETWEEN process_date - 30 AND process_date)"""
GOLD_TRANSACTIONS = "gold_transactions AS (" + " UNION ALL BY NAME ".join(
    f"({part('recent', 'process_date, ')})" for part in (by_type, by_merchant, by_hour, by_payment)
) + ")"


def transaction_report(select: str, days: list[str] | None = None) -> str:
    return ledger(select, snapshots(days or SNAPSHOTS), RECENT, GOLD_TRANSACTIONS)


# --- risk -----------------------------------------------------------------------------------

SECONDS = """
timed AS (SELECT *, epoch_us("timestamp") // 1000000 AS second FROM silver)"""


def counted(seconds: int) -> str:
    return f"""
counted AS (
  SELECT *, count(*) OVER (PARTITION BY account_id ORDER BY second
    RANGE BETWEEN {seconds} PRECEDING AND CURRENT ROW) AS tx_in_window FROM timed
)"""


VELOCITY = f"""
velocity AS (
  SELECT account_id, customer_id, max(tx_in_window) AS max_tx_in_window,
    count(*) AS flagged_transactions, {money('sum(amount)')} AS flagged_amount,
    max("timestamp") AS latest_flagged_at, 'velocity_alert' AS risk_signal, 'HIGH' AS risk_level
  FROM counted WHERE tx_in_window > 5 GROUP BY account_id, customer_id
)"""


# The amount divided by the mean as decimals, with sixteen digits.
_SIXTEEN = half_up("CAST(amount * 100 AS HUGEINT) * 100000000000000000000",
                   "CAST(customer_avg_amount * 1000000 AS HUGEINT)")
DECIMAL_RATIO = (f"CAST(CAST({_SIXTEEN} AS DECIMAL(21,0)) * "
                 "CAST('0.0000000000000001' AS DECIMAL(17,16)) AS DECIMAL(38,16))")


def outsized(name: str, means: str, join: str) -> str:
    return f"""
{name} AS (
  SELECT account_id, t.customer_id, transaction_id, amount, customer_avg_amount,
    {DECIMAL_RATIO} AS amount_vs_avg_ratio,
    "timestamp", 'large_transaction' AS risk_signal,
    CASE WHEN {DECIMAL_RATIO} > 10 THEN 'CRITICAL' WHEN {DECIMAL_RATIO} > 5 THEN 'HIGH'
         ELSE 'MEDIUM' END AS risk_level
  FROM silver t JOIN ({means}) m ON {join}
  WHERE amount > customer_avg_amount * 3
)"""


LARGE = outsized(
    "large",
    f"SELECT customer_id, {mean('sum(amount)', 'count(*)')} AS customer_avg_amount "
    "FROM silver GROUP BY customer_id",
    "t.customer_id = m.customer_id")
LARGE_TRAILING = outsized(
    "large",
    f"""SELECT a.customer_id, a.event_date,
          {mean('sum(b.amount)', 'count(*)')} AS customer_avg_amount
        FROM (SELECT DISTINCT customer_id, event_date FROM silver) a JOIN silver b
          ON a.customer_id = b.customer_id AND b.event_date BETWEEN a.event_date - 30
             AND a.event_date
        GROUP BY a.customer_id, a.event_date""",
    "t.customer_id = m.customer_id AND t.event_date = m.event_date")
GEO = f"""
geo AS (
  SELECT customer_id, ip_country, country, count(*) AS anomalous_tx_count,
    {money('sum(amount)')} AS anomalous_amount, max("timestamp") AS latest_at,
    'geo_anomaly' AS risk_signal, 'MEDIUM' AS risk_level
  FROM silver JOIN customers USING (customer_id) WHERE ip_country <> country
  GROUP BY customer_id, ip_country, country
)"""
FAILURES = """
failures AS (
  SELECT account_id, customer_id, count(*) AS total_tx,
    count(*) FILTER (status = 'failed') AS failed_tx,
    count(*) FILTER (status = 'failed') / count(*) AS failure_rate,
    'high_failure_rate' AS risk_signal, 'MEDIUM' AS risk_level
  FROM silver GROUP BY account_id, customer_id
  HAVING count(*) FILTER (status = 'failed') / count(*) > CAST(0.2 AS DOUBLE) AND count(*) >= 5
)"""
EXPOSURE = f"""
exposure AS (
  SELECT currency, segment, country, {money('sum(amount)')} AS total_exposure,
    count(*) AS transaction_count, count(DISTINCT customer_id) AS customer_count,
    'currency_exposure' AS risk_signal, 'INFO' AS risk_level
  FROM silver JOIN customers USING (customer_id) WHERE status IN ('completed', 'pending')
  GROUP BY currency, segment, country
)"""

# --- data quality ---------------------------------------------------------------------------

_FAILED = {
    "completeness_critical_fields": (1.0, LACKING),
    "validity_amount_positive": (0.99, "amount <= 0"),
    "validity_currency_known": (
        0.99, "currency NOT IN ('USD','EUR','BRL','GBP','JPY','CAD','AUD')"),
    "validity_status_known": (1.0, "status NOT IN ('completed','pending','failed','unknown')"),
    "late_arrival_rate": (0.9, "is_late_arrival"),
}


DAILY_VOLUME = """
calendar AS (
  SELECT CAST(unnest(generate_series(min(event_date), max(event_date), INTERVAL 1 DAY)) AS DATE)
    AS process_date FROM silver),
daily AS (
  SELECT process_date, count(transaction_id) AS total_count
  FROM calendar LEFT JOIN silver ON event_date = process_date GROUP BY process_date),
volume AS (
  SELECT process_date, total_count, history_days, lower_bound, upper_bound,
    CASE WHEN history_days < 7 OR total_count BETWEEN lower_bound AND upper_bound
         THEN 'PASS' ELSE 'FAIL' END AS status
  FROM (
    SELECT process_date, total_count, coalesce(n, 0) AS history_days,
      CAST(s AS DOUBLE) / n - 3 * (sqrt(CAST(q * n - s * s AS DOUBLE)) / n) AS lower_bound,
      CAST(s AS DOUBLE) / n + 3 * (sqrt(CAST(q * n - s * s AS DOUBLE)) / n) AS upper_bound
    FROM daily LEFT JOIN (
      SELECT d.process_date, count(*) AS n, sum(p.total_count) AS s,
        sum(CAST(p.total_count AS HUGEINT) * p.total_count) AS q
      FROM daily d JOIN daily p
        ON p.process_date BETWEEN d.process_date - 7 AND d.process_date - 1
      GROUP BY d.process_date) USING (process_date)))"""


def dq() -> str:
    lines = [
        f"SELECT event_date, '{name}' AS check_name, CAST({least} AS DOUBLE) AS threshold, "
        f"count(*) FILTER ({test}) AS failed_count, count(*) AS total_count "
        "FROM silver GROUP BY event_date"
        for name, (least, test) in _FAILED.items()
    ]
    lines.append(
        "SELECT event_date, 'referential_integrity_customer', CAST(0.99 AS DOUBLE), "
        "count(*) FILTER (customer_id NOT IN (SELECT customer_id FROM customers)), count(*) "
        "FROM silver GROUP BY event_date")
    lines.append(
        "SELECT event_date, 'freshness_2h', CAST(1 AS DOUBLE), CAST(max(\"timestamp\") < "
        "CAST(event_date + 1 AS TIMESTAMP) - INTERVAL 2 HOUR AS BIGINT), 1 "
        "FROM silver GROUP BY event_date")
    lines.append(
        "SELECT process_date, 'volume_anomaly', CAST(1 AS DOUBLE), "
        "CAST(status = 'FAIL' AS BIGINT), 1 FROM volume")
    return f"""{DAILY_VOLUME},
checks AS ({' UNION ALL '.join(lines)}),
dq AS (
  SELECT check_name,
    CASE WHEN (total_count - failed_count) / total_count >= threshold THEN 'PASS' ELSE 'FAIL' END
      AS status,
    {ratio('total_count - failed_count', 'total_count', 6, 6)} AS pass_rate, threshold,
    failed_count, CAST(total_count AS BIGINT) AS total_count, event_date AS process_date,
    CAST(event_date + 1 AS TIMESTAMP) AS checked_at
  FROM checks
)"""


def dq_only(check: str) -> str:
    return ledger(
        f"SELECT * EXCLUDE (checked_at) FROM dq WHERE check_name = '{check}'", dq())


# --- merge ----------------------------------------------------------------------------------

MERGED = f"""
stored AS ({latest('clean', f"event_date < {MERGE_DAY}", "ASC")}),
merged AS (
  SELECT s.transaction_id,
    CASE WHEN t.transaction_id IS NULL THEN 'insert'
         WHEN s.ingestion_timestamp > t.ingestion_timestamp THEN 'update' ELSE 'duplicate' END
      AS _action, s AS src, t AS tgt
  FROM silver s LEFT JOIN stored t ON s.transaction_id = t.transaction_id
)"""


def _merged_column(name: str, updatable: bool) -> str:
    actions = "('insert','update')" if updatable else "('insert')"
    return f"CASE WHEN _action IN {actions} THEN src.{name} ELSE tgt.{name} END AS {name}"


MERGED_COLUMNS = "transaction_id, " + ", ".join([
    *[_merged_column(c, True) for c in
      ("status", "amount", "ingestion_timestamp", "is_late_arrival")],
    *[_merged_column(c, False) for c in ("kafka_offset", "event_date")],
])

# --- streams --------------------------------------------------------------------------------

WATERMARK = """
mark AS (SELECT epoch_ms(max("timestamp")) - 1800000 AS watermark FROM clean)"""
UPSERTED = ("transaction_id, status, amount, ingestion_timestamp, is_late_arrival, kafka_offset, "
            "event_date")
_SENT_JSON = [
    ("account_id", True, "account_id"), ("transaction_id", True, "transaction_id"),
    ("customer_id", True, "customer_id"), ("amount", False, "CAST(amount AS VARCHAR)"),
    ("status", True, "status"), ("payment_method", True, "payment_method"),
    ("is_late_arrival", False, "CAST(is_late_arrival AS VARCHAR)"),
]
SPEND_BY_TYPE = f"""
spend AS (
  SELECT t.customer_id, segment, country, account_type, count(*) AS tx_count,
    {money('sum(amount)')} AS total_amount, {mean('sum(amount)', 'count(*)')} AS avg_amount
  FROM silver t LEFT JOIN customers c ON t.customer_id = c.customer_id
    LEFT JOIN accounts a ON t.account_id = a.account_id
  WHERE event_date BETWEEN {DAY} - 30 AND {DAY}
  GROUP BY t.customer_id, segment, country, account_type
)"""
SIGNAL = ("{account} AS account_id, {customer} AS customer_id, risk_signal, risk_level, "
          "{transaction} AS transaction_id, {amount} AS flagged_amount, "
          "{latest} AS latest_flagged_at, " + DAY + " AS process_date")


def _signal(source: str, **columns: str) -> str:
    names = ("account", "customer", "transaction", "amount", "latest")
    return "SELECT " + SIGNAL.format(**{n: columns.get(n, "NULL") for n in names}) \
        + f" FROM {source}"


def _by_day_and_type(where: str) -> str:
    return transaction_report(f"""
      SELECT event_date, transaction_type, CAST(sum(tx_count) AS BIGINT) AS tx_count,
        {money('sum(total_volume)')} AS total_volume,
        round(avg(success_rate) * 100, 2) AS avg_success_rate_pct
      FROM gold_transactions WHERE granularity = 'daily_by_type' AND {where}
      GROUP BY event_date, transaction_type""")


def _by_hour_of_day(where: str) -> str:
    return transaction_report(f"""
      SELECT CAST(hour(hour) AS INTEGER) AS hour_of_day, transaction_type,
        CAST(sum(tx_count) AS BIGINT) AS total_tx_count,
        {money('sum(total_volume)')} AS total_volume,
        {ratio('sum(tx_count)', 'count(*)', 1, 1)} AS avg_tx_per_day
      FROM gold_transactions WHERE granularity = 'hourly' AND {where}
      GROUP BY hour(hour), transaction_type""")


def _late_by_day(where: str) -> str:
    return transaction_report(f"""
      SELECT event_date, CAST(sum(tx_count) AS BIGINT) AS total_tx,
        CAST(sum(late_arrival_count) AS BIGINT) AS late_arrivals,
        {ratio('sum(late_arrival_count)', 'sum(tx_count)', 4, 2)} AS late_rate_pct
      FROM gold_transactions WHERE granularity = 'daily_by_type' AND {where}
      GROUP BY event_date""")


def _customers_of(where: str = "true") -> str:
    return f"FROM gold_customers WHERE process_date = {DAY} AND {where}"


def _rounded(column: str, alias: str | None = None) -> str:
    return f"{money(f'round({column}, 2)')} AS {alias or column}"


def _top10() -> str:
    return customer_report(f"""
      SELECT customer_id, name, country, segment, total_spend, total_transactions,
        {_rounded('avg_transaction_value', 'avg_tx_value')}, activity_tier
      {_customers_of()} ORDER BY total_spend DESC, customer_id LIMIT 10""")


def _share() -> str:
    cents, all_cents = "CAST(v * 100 AS HUGEINT)", "CAST(w * 100 AS HUGEINT)"
    six = half_up(f"{cents} * 1000000", all_cents)
    return (f"CAST(CAST({half_up(six, '100')} AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) "
            "AS DECIMAL(10,2))")


def _breakdown(columns: str) -> str:
    return transaction_report(f"""
      SELECT {columns} FROM (
        SELECT currency, CAST(sum(tx_count) AS BIGINT) AS total_transactions,
          sum(total_volume) AS v, sum(sum(total_volume)) OVER () AS w
        FROM gold_transactions
        WHERE granularity = 'daily_by_type' AND process_date = {DAY} GROUP BY currency)""")


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    position = "kafka_partition, kafka_offset"

    # sources
    sql["bronze_project"] = ledger("SELECT * EXCLUDE (event_id) FROM bronze")
    sql["scan_partition_day"] = ledger(
        f"SELECT transaction_id, amount, event_date FROM silver WHERE event_date = {DAY}")
    sql["scan_lookback"] = ledger(
        "SELECT transaction_id, amount, event_date FROM silver "
        f"WHERE event_date BETWEEN {DAY} - 90 AND {DAY}")
    sql["scan_staged"] = ledger(
        "SELECT transaction_id, kafka_offset, processing_date, event_date FROM clean "
        f"WHERE processing_date = {DAY}")
    sql["stream_source_options"] = ledger(
        f"SELECT {position}, kafka_key, kafka_timestamp FROM bronze")
    sql["load_entities_json"] = ledger("SELECT * FROM customers")
    sql["read_report_tables"] = ledger(
        """SELECT 'gold_customer_analytics' AS table_name, process_date, count(*) AS row_count
           FROM core GROUP BY process_date
           UNION ALL SELECT 'gold_transaction_analytics', process_date, count(*)
           FROM gold_transactions GROUP BY process_date
           UNION ALL SELECT 'silver_dq_metrics', process_date, count(*)
           FROM dq GROUP BY process_date""",
        snapshots(SNAPSHOTS), CORE, RECENT, GOLD_TRANSACTIONS, dq())

    # sinks and table operations
    sql["bronze_sink"] = sql["stream_bronze"] = sql["bronze_project"]
    sql["silver_append"] = ledger(f"""
      SELECT transaction_id, event_date, amount,
        CASE WHEN event_date >= {MERGE_DAY} THEN ip_country END AS ip_country FROM silver""")
    rejected = f"SELECT *, 'null_critical_field' AS quarantine_reason FROM parsed WHERE {LACKING}"
    sql["quarantine_append"] = ledger(
        f"SELECT r.*, b.raw_payload FROM ({rejected}) r JOIN bronze b USING (kafka_offset)")
    sql["replace_partition"] = ledger(
        "SELECT process_date, event_date, transaction_type, currency, count(*) AS tx_count, "
        f"{money('sum(amount)')} AS total_volume FROM recent "
        "GROUP BY process_date, event_date, transaction_type, currency",
        snapshots(SNAPSHOTS[:-1]), RECENT)
    sql["dq_metrics_append"] = ledger("SELECT * EXCLUDE (checked_at) FROM dq", dq())
    sql["upsert_latest"] = ledger(f"SELECT {MERGED_COLUMNS}, _action FROM merged", MERGED)
    sql["upsert_table"] = ledger(f"SELECT {MERGED_COLUMNS} FROM merged", MERGED)
    sql["upsert_metrics"] = ledger(
        "SELECT CASE WHEN tgt.transaction_id IS NOT NULL AND src.event_date < DATE '2024-01-05' "
        "THEN 'untouched' ELSE _action END AS _action, count(*) AS row_count FROM merged "
        "GROUP BY ALL", MERGED)
    sql["upsert_generic"] = """
      SELECT o_orderkey, o_custkey,
        CASE WHEN o_orderdate >= DATE '1997-01-01' THEN 'C' ELSE o_orderstatus END
          AS o_orderstatus,
        o_totalprice, o_orderdate, o_orderpriority,
        CASE WHEN o_orderdate < DATE '1997-01-01' THEN 'untouched'
             WHEN o_orderdate < DATE '1998-01-01' THEN 'update' ELSE 'insert' END AS _action
      FROM orders"""
    sql["table_exists"] = ledger(
        "SELECT false AS exists_before, true AS exists_after, count(*) AS row_count FROM customers")
    sql["row_count"] = ledger(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in ("silver", "customers", "accounts")))
    sql["latest_partition"] = ledger("SELECT max(event_date) AS latest FROM silver")
    sql["compact_table"] = ledger("SELECT transaction_id, amount, event_date FROM silver")
    sql["cluster_table"] = ledger("SELECT transaction_id, currency, event_date FROM silver")
    sql["keyed_json_sink"] = ledger(
        f"SELECT account_id AS key, {json_object(_SENT_JSON)} AS value FROM silver")

    sql["keyed_json_ordered"] = ledger(
        "SELECT account_id AS key, transaction_id, row_number() OVER (PARTITION BY account_id "
        "ORDER BY \"timestamp\", transaction_id) AS seq FROM silver")

    # projections and filters
    sql["parse_payload"] = ledger("SELECT * FROM parsed")
    sql["payload_drift"] = ledger("""
      SELECT ingestion_date, field, kind, count(*) AS row_count FROM (
        SELECT ingestion_date, unnest([
          {'field': 'payment_method', 'kind': 'STRING', 'there': payment_method IS NOT NULL},
          {'field': 'device_fingerprint', 'kind': 'STRING', 'there': device_fingerprint IS NOT NULL},
          {'field': 'ip_country', 'kind': 'STRING', 'there': ip_country IS NOT NULL},
          {'field': '_is_late_arrival', 'kind': 'BOOLEAN', 'there': true}], recursive := true)
        FROM sent WHERE NOT corrupt) WHERE there GROUP BY ALL""")
    sql["split_valid"] = ledger(f"SELECT * FROM parsed WHERE NOT ({LACKING})")
    sql["split_quarantine"] = ledger(rejected)
    normal = ("trim(transaction_id) AS transaction_id, trim(customer_id) AS customer_id, "
              "trim(account_id) AS account_id, upper(trim(currency)) AS currency, "
              "lower(trim(status)) AS status, lower(trim(transaction_type)) AS transaction_type")
    sql["normalise_values"] = ledger(f"SELECT {position}, {normal} FROM parsed")
    sql["guard_enums"] = ledger(f"""
      SELECT {position},
        CASE WHEN currency IN ('USD','EUR','BRL','GBP','JPY','CAD','AUD') THEN currency
             ELSE 'UNKNOWN' END AS currency,
        CASE WHEN status IN ('completed','pending','failed') THEN status ELSE 'unknown' END
          AS status
      FROM (SELECT {position}, {normal} FROM parsed)""")
    sql["amount_abs"] = ledger(f"SELECT {position}, abs(amount) AS amount FROM parsed")
    sql["derive_dates"] = ledger(
        f"SELECT {position}, CAST(ingestion_timestamp AS DATE) AS processing_date, "
        "CAST(\"timestamp\" AS DATE) AS event_date FROM parsed")
    sql["flag_late"] = ledger(
        f"SELECT {position}, \"timestamp\" < ingestion_timestamp - INTERVAL 30 MINUTE "
        "AS is_late_arrival FROM parsed")
    sql["clean_transactions"] = ledger("SELECT * FROM clean")
    sql["quarantine_reasons_intent"] = ledger(f"""
      SELECT {position}, transaction_id, coalesce(rule, CASE WHEN row_number() OVER (
          PARTITION BY transaction_id, rule
          ORDER BY ingestion_timestamp, kafka_partition, kafka_offset) > 1
        THEN 'duplicate' END) AS quarantine_reason
      FROM (
        SELECT {cols(META)}, trim(transaction_id) AS transaction_id, CASE
          WHEN transaction_id IS NULL THEN 'missing_transaction_id'
          WHEN customer_id IS NULL THEN 'missing_customer_id'
          WHEN amount IS NULL OR amount <= 0 THEN 'invalid_amount'
          WHEN "timestamp" IS NULL THEN 'missing_timestamp'
          WHEN currency IS NULL OR upper(trim(currency)) NOT IN
            ('USD','EUR','BRL','GBP','JPY','CAD','AUD') THEN 'invalid_currency' END AS rule
        FROM parsed)""")
    sql["filter_not_failed"] = ledger(
        "SELECT transaction_id, status FROM silver WHERE status <> 'failed'")
    sql["filter_open_status"] = ledger(
        "SELECT transaction_id, status FROM silver WHERE status IN ('completed', 'pending')")
    sql["filter_has_payment"] = ledger(
        "SELECT transaction_id, payment_method FROM silver WHERE payment_method IS NOT NULL")
    sql["prune_columns"] = ledger(
        "SELECT transaction_id, customer_id, account_id, amount, \"timestamp\", event_date, "
        "transaction_type FROM silver")
    sql["tag_rows"] = ledger(
        "SELECT transaction_id, 'velocity_alert' AS risk_signal, 'HIGH' AS risk_level, "
        f"'daily_by_type' AS granularity, {DAY} AS process_date FROM silver")
    sql["project_schema_version"] = ledger(
        "SELECT transaction_id, amount, payment_method, device_fingerprint, ip_country FROM silver")

    # joins
    one = [snapshots(REPORT_DAY), CORE]
    sql["join_customer_left"] = ledger(
        "SELECT customer_id, recency_days, frequency, monetary, name, country, segment, "
        "preferred_currency, age FROM core LEFT JOIN customers USING (customer_id)", *one)
    sql["join_rfm_left"] = ledger(
        "SELECT customer_id, total_transactions, total_spend, active_days, accounts_used, "
        "recency_days, frequency, monetary FROM core", *one)
    sql["orphans_anti"] = ledger(
        "SELECT transaction_id, customer_id, amount FROM silver "
        "WHERE customer_id NOT IN (SELECT customer_id FROM customers)")
    sql["join_geo_inner"] = ledger(
        "SELECT customer_id, ip_country, country, anomalous_tx_count FROM geo", GEO)
    sql["join_exposure_inner"] = ledger(
        "SELECT currency, segment, country, total_exposure FROM exposure", EXPOSURE)
    sql["join_self_avg"] = ledger(
        "SELECT transaction_id, customer_id, amount, customer_avg_amount FROM large", LARGE)
    sql["join_two_dims_naive"] = ledger(f"""
      SELECT t.customer_id, segment, country, count(*) AS tx_count,
        {money('sum(amount)')} AS total_amount, {mean('sum(amount)', 'count(*)')} AS avg_amount
      FROM silver t LEFT JOIN customers c ON t.customer_id = c.customer_id
        LEFT JOIN accounts a ON t.account_id = a.account_id
      GROUP BY t.customer_id, segment, country""")
    sql["join_two_dims_broadcast"] = ledger("SELECT * FROM spend", SPEND_BY_TYPE)
    sql["benchmark_agg"] = sql["join_two_dims_broadcast"]

    # aggregations
    sql["customer_core_agg"] = ledger(
        "SELECT * EXCLUDE (process_date, recency_days, frequency, monetary) FROM core", *one)
    sql["rfm_agg"] = ledger(
        "SELECT customer_id, recency_days, frequency, monetary FROM core", *one)
    sql["daily_by_type"] = ledger(by_type("silver"))
    sql["daily_by_merchant"] = ledger(by_merchant("silver"))
    sql["hourly_volume"] = ledger(by_hour("silver"))
    sql["daily_by_payment"] = ledger(by_payment("silver"))
    volume = (f"SELECT event_date, currency, count(*) AS tx_count, {money('sum(amount)')} "
              "AS total_volume FROM silver")
    sql["currency_volume"] = ledger(f"{volume} GROUP BY event_date, currency")
    sql["percentiles"] = ledger(
        "SELECT transaction_type, currency, quantile_disc(amount, 0.5) AS p50_amount, "
        "quantile_disc(amount, 0.95) AS p95_amount, quantile_disc(amount, 0.99) AS p99_amount "
        "FROM silver GROUP BY transaction_type, currency")
    sql["stream_profile"] = ledger("""
      SELECT stat, count(*) AS n FROM (
        SELECT unnest([
          CASE WHEN corrupt THEN 'parse_errors' ELSE 'total' END,
          CASE WHEN NOT corrupt THEN 'status_' || coalesce(status, 'unknown') END,
          CASE WHEN NOT corrupt THEN 'type_' || coalesce(transaction_type, 'unknown') END,
          CASE WHEN NOT corrupt AND _is_late_arrival = 'true' THEN 'late_arrivals' END,
          CASE WHEN NOT corrupt AND transaction_id IS NULL THEN 'null_transaction_id' END
        ]) AS stat FROM sent) WHERE stat IS NOT NULL GROUP BY stat""")

    # window functions
    sql["dedup_latest"] = ledger("SELECT * FROM silver")
    sql["dedup_latest_lineitem"] = """
      SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
            l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
            l_linestatus DESC) AS rn
        FROM lineitem) WHERE rn = 1"""
    score_columns = ("customer_id, recency_days, frequency, monetary, recency_score, "
                     "frequency_score, monetary_score, rfm_score")
    sql["rfm_scores"] = ledger(f"SELECT {score_columns} FROM scored", *one, scores("core"))
    sql["rfm_scores_intent"] = ledger(
        f"SELECT {score_columns} FROM scored", *one, scores("core", "recency_days DESC"))
    sql["activity_tier"] = ledger(
        f"SELECT customer_id, rfm_score, {tier('rfm_score')} AS activity_tier FROM scored",
        *one, scores("core"))
    sql["rfm_scores_orders"] = f"""
      WITH ordered AS (
        SELECT printf('CUS%08d', o_custkey) AS customer_id,
          CAST(DATE '2002-01-01' - max(CAST(o_orderdate AS DATE)) AS INTEGER) AS recency_days,
          count(*) AS frequency, {money('sum(CAST(o_totalprice AS DECIMAL(18,2)))')} AS monetary
        FROM orders GROUP BY o_custkey), {scores('ordered', by='')}
      SELECT {score_columns} FROM scored"""
    window = "SELECT transaction_id, account_id, tx_in_window FROM counted"
    sql["velocity_window"] = ledger(window, SECONDS, counted(600))
    sql["velocity_window_day"] = ledger(window, SECONDS, counted(LIMIT_DAY))
    sql["volume_share"] = _breakdown(
        f"currency, {money('v')} AS total_volume, {_share()} AS volume_share_pct")

    # sorts, limits, unions
    sql["sort_multi_key"] = ledger(f"""
      SELECT event_date, transaction_type, currency, {money('sum(amount)')} AS total_volume
      FROM silver GROUP BY event_date, transaction_type, currency
      ORDER BY event_date DESC, total_volume DESC, transaction_type, currency""")
    sql["top10_by_spend"] = sql["rpt_top10_customers"] = _top10()
    sql["gold_transactions_union_intent"] = transaction_report(
        "SELECT * FROM gold_transactions", REPORT_DAY)
    sql["risk_signals_union_intent"] = ledger(
        " UNION ALL ".join([
            _signal("velocity", account="account_id", customer="customer_id",
                    amount="flagged_amount", latest="latest_flagged_at"),
            _signal("large", account="account_id", customer="customer_id",
                    transaction="transaction_id", amount=money("amount"), latest='"timestamp"'),
            _signal("geo", customer="customer_id", amount="anomalous_amount", latest="latest_at"),
            _signal("failures", account="account_id", customer="customer_id"),
            _signal("exposure", amount="total_exposure"),
        ]), SECONDS, counted(LIMIT_DAY), VELOCITY, LARGE, GEO, FAILURES, EXPOSURE)
    sql["scalar_functions"] = ledger(f"""
      SELECT {position}, trim(transaction_id) AS trimmed, upper(currency) AS uppered,
        lower(status) AS lowered, CAST(kafka_offset AS VARCHAR) AS offset_text,
        CAST("timestamp" AS DATE) AS event_day, CAST("timestamp" AS DATE) - 30 AS month_before,
        CAST({DAY} - CAST("timestamp" AS DATE) AS INTEGER) AS age_days,
        date_trunc('hour', "timestamp") AS event_hour,
        CAST(hour("timestamp") AS INTEGER) AS hour_of_day,
        "timestamp" - INTERVAL 30 MINUTE AS half_hour_before,
        epoch_us("timestamp") // 1000000 AS epoch_second, abs(amount) AS magnitude,
        CAST(kafka_offset AS DOUBLE) / nullif(kafka_partition, 0) AS guarded_ratio,
        CAST(round(amount, 1) AS DECIMAL(18,1)) AS rounded,
        CAST(amount * 100 AS DECIMAL(22,2)) AS in_percent,
        CASE WHEN amount > 100 THEN 'large' WHEN amount > 10 THEN 'medium' ELSE 'small' END
          AS size_class,
        status IN ('completed', 'pending') AS is_open, payment_method IS NOT NULL AS has_payment,
        customer_id IS NULL AS lacks_customer, {tier('kafka_partition')} AS tier,
        '{{"kafka_partition":' || kafka_partition || ',"kafka_offset":' || kafka_offset || '}}'
          AS as_json, kafka_offset AS from_json
      FROM parsed""")

    # risk
    sql["velocity_alerts"] = ledger(
        "SELECT * FROM velocity", SECONDS, counted(LIMIT_DAY), VELOCITY)
    sql["large_tx_flags"] = ledger("SELECT * FROM large", LARGE)
    sql["large_tx_flags_intent"] = ledger("SELECT * FROM large", LARGE_TRAILING)
    sql["geo_anomalies"] = ledger("SELECT * FROM geo", GEO)
    sql["failure_rate_flags"] = ledger("SELECT * FROM failures", FAILURES)
    sql["currency_exposure"] = ledger("SELECT * FROM exposure", EXPOSURE)

    # data quality
    for key, check in {
        "dq_completeness": "completeness_critical_fields",
        "dq_amount_positive": "validity_amount_positive",
        "dq_currency_known": "validity_currency_known",
        "dq_status_known": "validity_status_known",
        "dq_referential": "referential_integrity_customer",
        "dq_late_rate": "late_arrival_rate",
        "dq_freshness": "freshness_2h",
    }.items():
        sql[key] = dq_only(check)
    sql["dq_report"] = ledger("SELECT * FROM dq", dq())
    sql["dq_gate"] = ledger(
        "SELECT process_date, count(*) FILTER (status = 'FAIL') AS failed_checks, "
        "bool_and(status <> 'FAIL') AS gate_passed FROM dq GROUP BY process_date", dq())
    sql["dq_volume_intent"] = ledger("SELECT * FROM volume", DAILY_VOLUME)
    sql["bronze_freshness"] = ledger("""
      SELECT max(ingestion_timestamp) AS latest_ts,
        coalesce(max(ingestion_timestamp) >= TIMESTAMP '2024-01-30 22:00:00', false) AS is_fresh
      FROM bronze WHERE ingestion_date >= DATE '2024-01-30'""")
    sql["dq_score"] = ledger(f"""
      SELECT account_id, failed_count, total_count,
        CASE WHEN (total_count - failed_count) / total_count >= CAST(0.8 AS DOUBLE) THEN 'PASS'
             ELSE 'FAIL' END AS status,
        {ratio('total_count - failed_count', 'total_count', 6, 6)} AS pass_rate
      FROM (SELECT account_id, count(*) FILTER (status = 'failed') AS failed_count,
              count(*) AS total_count FROM silver GROUP BY account_id)""")

    # reports
    sql["rpt_customer_summary"] = customer_report(f"""
      SELECT customer_id, name, country, segment, activity_tier, total_transactions,
        {_rounded('total_spend')}, {_rounded('avg_transaction_value')},
        {_rounded('p95_transaction_value')}, active_days, recency_days, rfm_score,
        last_transaction_at, process_date
      {_customers_of()}""")
    average = half_up(half_up(
        "CAST(sum(avg_transaction_value) * 1000000 AS HUGEINT) * 10000",
        "CAST(count(*) AS HUGEINT)"), "100000000")
    sql["rpt_segment_distribution"] = customer_report(f"""
      SELECT segment, activity_tier, count(*) AS customer_count,
        {money('sum(total_spend)')} AS segment_total_spend,
        {money(f'CAST({average} AS DECIMAL(26,0)) * CAST(0.01 AS DECIMAL(3,2))')}
          AS segment_avg_tx_value,
        {ratio('sum(rfm_score)', 'count(*)', 2, 2)} AS avg_rfm_score
      {_customers_of()} GROUP BY segment, activity_tier""")
    sql["rpt_churn_risk"] = customer_report(f"""
      SELECT customer_id, name, country, segment, recency_days, frequency_score, monetary_score,
        rfm_score, activity_tier, last_transaction_at
      {_customers_of("activity_tier IN ('at_risk', 'churned')")}""")
    sql["rpt_activity_trend"] = customer_report(f"""
      SELECT process_date, activity_tier, count(*) AS customer_count,
        {money('sum(total_spend)')} AS total_spend
      FROM gold_customers WHERE process_date BETWEEN {DAY} - 30 AND {DAY}
      GROUP BY process_date, activity_tier""")
    sql["rpt_new_vs_returning"] = customer_report(f"""
      SELECT process_date,
        count(*) FILTER (first_transaction_at >= process_date - 30) AS new_customers,
        count(*) FILTER (first_transaction_at < process_date - 30) AS returning_customers
      FROM gold_customers WHERE process_date BETWEEN {DAY} - 7 AND {DAY}
      GROUP BY process_date""")
    today = f"granularity = 'daily_by_type' AND process_date = {DAY}"
    sql["rpt_daily_summary"] = transaction_report(f"""
      SELECT event_date, transaction_type, currency, tx_count, {_rounded('total_volume')},
        {_rounded('avg_amount')}, {_rounded('p50_amount', 'median_amount')},
        {_rounded('p95_amount')}, {_rounded('p99_amount')},
        {ratio('completed_count', 'tx_count', 4, 2)} AS success_rate_pct, failed_count,
        late_arrival_count
      FROM gold_transactions WHERE {today}""")
    week, latest_day = f"process_date BETWEEN {DAY} - 7 AND {DAY}", f"process_date = {DAY}"
    last_week = f"{latest_day} AND event_date BETWEEN {DAY} - 7 AND {DAY}"
    sql["rpt_volume_trend"] = _by_day_and_type(f"process_date BETWEEN {DAY} - 30 AND {DAY}")
    sql["rpt_volume_trend_intent"] = _by_day_and_type(latest_day)
    sql["rpt_currency_breakdown"] = _breakdown(
        f"currency, total_transactions, {money('v')} AS total_volume, "
        f"{_share()} AS volume_share_pct")
    sql["rpt_failure_monitor"] = transaction_report(f"""
      SELECT event_date, transaction_type, currency, tx_count, failed_count,
        {ratio('failed_count', 'tx_count', 4, 2)} AS failure_rate_pct,
        CASE WHEN failed_count * 100 / tx_count > 5 THEN 'ALERT'
             WHEN failed_count * 100 / tx_count > 2 THEN 'WARNING' ELSE 'OK' END AS status
      FROM gold_transactions WHERE {today}""")
    sql["rpt_peak_hours"] = _by_hour_of_day(week)
    sql["rpt_peak_hours_intent"] = _by_hour_of_day(last_week)
    sql["rpt_late_impact"] = _late_by_day(week)
    sql["rpt_late_impact_intent"] = _late_by_day(last_week)
    sql["rpt_dq_dashboard"] = ledger(f"""
      SELECT process_date, check_name, status,
        {ratio('total_count - failed_count', 'total_count', 6, 4)} AS pass_rate_pct,
        round(threshold * 100, 2) AS threshold_pct, failed_count, total_count, checked_at
      FROM dq WHERE process_date BETWEEN {DAY} - 7 AND {DAY}""", dq())

    # gold, star schema, generated input
    sql["gold_customers"] = customer_report("SELECT * FROM gold_customers", REPORT_DAY)
    sql["gold_transactions"] = ledger(
        by_type("recent", "process_date, "), snapshots(REPORT_DAY), RECENT)
    sql["gold_risk"] = ledger(
        f"SELECT *, {DAY} AS process_date FROM ({volume} WHERE event_date = {DAY} "
        "GROUP BY event_date, currency)")
    key = "CAST(strftime({0}, '%Y%m%d') AS INTEGER) AS date_key"
    sql["dim_date_intent"] = ledger(f"""
      SELECT {key.format('date')}, date, CAST(year(date) AS INTEGER) AS year,
        CAST(quarter(date) AS INTEGER) AS quarter, CAST(month(date) AS INTEGER) AS month,
        CAST(day(date) AS INTEGER) AS day, CAST(isodow(date) AS INTEGER) AS day_of_week,
        isodow(date) >= 6 AS is_weekend
      FROM (SELECT CAST(unnest(generate_series(min(event_date), max(event_date),
              INTERVAL 1 DAY)) AS DATE) AS date FROM silver)""")
    merchant = ("md5('{\"merchant\":\"' || merchant || '\"' || coalesce("
                "',\"merchant_category\":\"' || merchant_category || '\"', '') || '}')")
    sql["dim_merchant_intent"] = ledger(
        f"SELECT DISTINCT {merchant} AS merchant_key, merchant, merchant_category FROM silver "
        "WHERE merchant IS NOT NULL")
    sql["dim_account_intent"] = ledger("SELECT * FROM accounts")
    sql["dim_product_intent"] = f"""
      SELECT printf('PRD%08d', p_partkey) AS product_id, p_name AS product_name,
        {ACCOUNT_TYPES}[p_partkey % 4 + 1] AS category, p_size / 4 AS interest_rate,
        CASE WHEN p_partkey % 10 = 0 THEN 'discontinued' ELSE 'active' END AS status,
        CAST(p_retailprice AS DECIMAL(18,2)) AS minimum_balance,
        CAST(DATE '2015-01-01' + CAST(p_partkey % 2000 AS INTEGER) AS TIMESTAMP) AS created_at
      FROM part"""
    sql["dim_customer_intent"] = ledger(
        "SELECT customer_id, name, age, country, segment, email, created_at FROM customers")
    sql["fact_transactions_intent"] = ledger(
        f"SELECT transaction_id, customer_id, account_id, {key.format('event_date')}, "
        f"CASE WHEN merchant IS NOT NULL THEN {merchant} END AS merchant_key, transaction_type, "
        "currency, amount, status, payment_method, is_late_arrival FROM silver")
    field = draw("txn", "field", 4)
    lost = f"({draw('txn', 'null', 100)} < 1 AND {field} = {{}})"
    sql["inject_faults"] = ledger(f"""
      SELECT CASE WHEN NOT {lost.format(0)} THEN transaction_id END AS transaction_id,
        CASE WHEN NOT {lost.format(1)} THEN customer_id END AS customer_id, account_id,
        CASE WHEN NOT {lost.format(2)} THEN amount END AS amount,
        CASE WHEN NOT {lost.format(3)} THEN
          CASE WHEN {draw('txn', 'late', 100)} < 5
               THEN "timestamp" - to_minutes({draw('txn', 'minutes', 36)} + 10)
               ELSE "timestamp" END END AS "timestamp",
        CASE WHEN {draw('txn', 'late', 100)} < 5 THEN 'true' ELSE 'false' END
          AS _is_late_arrival
      FROM (SELECT *, transaction_id AS txn FROM silver)
        JOIN (VALUES (0), (1)) d(delivery)
          ON d.delivery = 0 OR {draw('txn', 'repeat', 100)} < 2""")

    # streaming
    sql["stream_late_split_intent"] = ledger(
        f"SELECT {position}, transaction_id, \"timestamp\", is_late_arrival FROM clean")
    sql["stream_watermark_intent"] = sql["stream_dedup_intent"] = ledger(
        "SELECT transaction_id, account_id, customer_id, amount, \"timestamp\" FROM silver")
    sql["stream_hourly"] = ledger(
        f"SELECT * EXCLUDE (granularity) FROM ({by_hour('silver')}), mark "
        "WHERE epoch_ms(hour + INTERVAL 1 HOUR) <= watermark".replace(
            "SELECT * EXCLUDE (granularity)",
            "SELECT hour, transaction_type, tx_count, total_volume, event_date"), WATERMARK)
    sql["gold_customers_incremental"] = sql["gold_customers_bucketed"] = sql["gold_customers"]
    sql["weekly_quantiles"] = ledger(f"""
      SELECT CAST(date_trunc('week', event_date) AS DATE) AS week, transaction_type,
        count(*) AS tx_count, {money('sum(amount)')} AS total_volume,
        quantile_disc(amount, 0.5) AS p50_amount, quantile_disc(amount, 0.95) AS p95_amount,
        quantile_disc(amount, 0.99) AS p99_amount
      FROM silver GROUP BY 1, 2""")
    sql["monthly_merchants"] = ledger("""
      SELECT CAST(date_trunc('month', event_date) AS DATE) AS month, merchant_category,
        count(DISTINCT merchant) AS unique_merchants FROM silver GROUP BY 1, 2""")
    sql["stream_hourly_corrected"] = ledger(
        "SELECT hour, transaction_type, tx_count, total_volume, event_date "
        f"FROM ({by_hour('silver')})")
    sql["stream_profile_running"] = sql["stream_profile"]
    sql["stream_velocity"] = ledger(
        "SELECT DISTINCT account_id, second, tx_in_window AS trailing_count "
        "FROM counted, mark WHERE (second + 1) * 1000 <= watermark",
        SECONDS, counted(600), WATERMARK)
    sql["stream_upsert"] = ledger(f"SELECT {UPSERTED} FROM silver")
    return sql
