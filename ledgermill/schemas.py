"""Table schemas (DDL text) and value domains."""

from __future__ import annotations

# Domains of the ledger.
CURRENCIES = ["USD", "EUR", "BRL", "GBP", "JPY", "CAD", "AUD"]
TRANSACTION_TYPES = ["purchase", "transfer", "withdrawal", "deposit", "refund"]
ACCOUNT_TYPES = ["checking", "savings", "investment", "credit"]
SEGMENTS = ["retail", "premium", "private", "sme", "corporate"]
MERCHANT_CATEGORIES = [
    "grocery", "restaurant", "travel", "entertainment",
    "healthcare", "utilities", "online_retail", "fuel",
]
STATUSES = ["completed", "pending", "failed"]
PAYMENT_METHODS = ["credit_card", "debit_card", "pix", "wire_transfer", "cash"]
TOPIC = "transaction-events"
TOPIC_PARTITIONS = 12

# Names and types of the columns, oldest payload version first.
PAYLOAD_V1 = (
    "transaction_id string, account_id string, customer_id string, transaction_type string, "
    "amount decimal(18,2), currency string, merchant string, merchant_category string, "
    "timestamp timestamp, status string"
)
PAYLOAD_V2 = PAYLOAD_V1 + ", payment_method string"
PAYLOAD_V3 = PAYLOAD_V2 + ", device_fingerprint string, ip_country string"
PAYLOAD = PAYLOAD_V3 + ", _is_late_arrival string"

TRANSPORT = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)
BRONZE = (
    "kafka_key string, raw_payload string, kafka_topic string, kafka_partition int, "
    "kafka_offset bigint, kafka_timestamp timestamp, ingestion_timestamp timestamp, "
    "ingestion_date date"
)
SILVER = PAYLOAD + (
    ", kafka_offset bigint, kafka_partition int, kafka_timestamp timestamp, "
    "ingestion_timestamp timestamp, ingestion_date date, processing_date date, event_date date, "
    "is_late_arrival boolean"
)
CUSTOMERS = (
    "customer_id string, name string, age int, country string, segment string, email string, "
    "phone string, preferred_currency string, created_at timestamp, updated_at timestamp"
)
ACCOUNTS = (
    "account_id string, customer_id string, account_type string, status string, "
    "balance decimal(18,2), currency string, created_at timestamp, updated_at timestamp"
)
PRODUCTS = (
    "product_id string, product_name string, category string, interest_rate double, "
    "status string, minimum_balance decimal(18,2), created_at timestamp, updated_at timestamp"
)
DQ_METRICS = (
    "check_name string, status string, pass_rate double, threshold double, "
    "failed_count bigint, total_count bigint, process_date date, checked_at timestamp"
)

# Columns without which a transaction cannot be used.
CRITICAL = ["transaction_id", "customer_id", "account_id", "amount", "timestamp"]
