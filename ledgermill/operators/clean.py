"""Bronze payloads to typed, validated, normalised transactions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgermill import schemas
from ledgermill.functions.text import known_or
from ledgermill.functions.times import older_than
from ledgermill.workspace import stage

LATE_MINUTES = 30
TRANSPORT_COLUMNS = [
    "kafka_offset", "kafka_partition", "kafka_timestamp", "ingestion_timestamp", "ingestion_date",
]


def parse_payload(bronze: DataFrame, keep_raw: bool = False) -> DataFrame:
    """JSON text to the typed payload columns, transport columns kept.

    A field of the wrong type becomes NULL, text that is no JSON gives NULL throughout;
    ``keep_raw`` carries the text along so that quarantine can show it. The parsed row comes out
    of a one-row ``inline`` and not a projection: filters on its fields then stay above it, while
    Spark would copy a projected ``from_json`` into each condition and parse the text again.
    """
    carried = TRANSPORT_COLUMNS + (["raw_payload"] if keep_raw else [])
    parsed = F.inline(F.array(F.from_json("raw_payload", schemas.PAYLOAD)))
    rows = bronze.select(*carried, parsed)
    return rows.select(*[c for c in rows.columns if c not in carried], *carried)


def lacks_critical() -> Column:
    """True where any critical field is NULL; never NULL itself."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in schemas.CRITICAL])


def split_valid(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~lacks_critical())


def split_quarantine(parsed: DataFrame) -> DataFrame:
    return parsed.filter(lacks_critical()).withColumn(
        "quarantine_reason", F.lit("null_critical_field")
    )


def route(parsed: DataFrame) -> DataFrame:
    """Both branches in one frame, so that one pass over bronze can write both."""
    reason = F.when(lacks_critical(), F.lit("null_critical_field"))
    return parsed.withColumn("quarantine_reason", reason).withColumn(
        "is_valid", ~lacks_critical()
    )


def normalise_values(df: DataFrame) -> DataFrame:
    changes = {c: F.trim(c) for c in ("transaction_id", "customer_id", "account_id")}
    changes |= {c: F.lower(F.trim(c)) for c in ("status", "transaction_type")}
    changes["currency"] = F.upper(F.trim("currency"))
    return df.withColumns(changes)


def guard_enums(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "currency": known_or(F.col("currency"), schemas.CURRENCIES, "UNKNOWN"),
        "status": known_or(F.col("status"), schemas.STATUSES, "unknown"),
    })


def amount_abs(df: DataFrame) -> DataFrame:
    return df.withColumn("amount", F.abs("amount"))


def derive_dates(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "processing_date": F.to_date("ingestion_timestamp"),
        "event_date": F.to_date("timestamp"),
    })


def flag_late(df: DataFrame, minutes: int = LATE_MINUTES) -> DataFrame:
    late = older_than(F.col("timestamp"), F.col("ingestion_timestamp"), minutes)
    return df.withColumn("is_late_arrival", late)


def correct_values(valid: DataFrame) -> DataFrame:
    """Everything done to a row that passed validation."""
    steps = (normalise_values, guard_enums, amount_abs, derive_dates, flag_late)
    return reduce(lambda df, step: df.transform(step), steps, valid)


def clean_transactions(bronze: DataFrame) -> DataFrame:
    """The whole step: parse, keep the valid rows, normalise, enrich."""
    return bronze.transform(parse_payload).transform(split_valid).transform(correct_values)


def unify_versions(*frames: DataFrame) -> DataFrame:
    """Rows of any payload version in one frame; columns a version lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def tag_rows(df: DataFrame, **constants) -> DataFrame:
    """Constant label columns; a Column value is used as it is."""
    tags = {
        name: value if isinstance(value, Column) else F.lit(value)
        for name, value in constants.items()
    }
    return df.withColumns(tags)


def decision_tree(parsed: DataFrame) -> DataFrame:
    """First failing rule of each row in ``quarantine_reason``, NULL where the row is accepted.

    ``parsed`` is read twice, so stage it first.

    Only the first arrival of an id among the otherwise acceptable rows is accepted. The first
    arrival of every repeated id is found by a grouped minimum, which merges map-side, and joined
    back as a staged table: no task ever holds all copies of one id, as a window over the id
    would. Rows that fail a rule, such as all those without an id, take no part in the join.
    """
    amount, currency = F.col("amount"), F.upper(F.trim("currency"))
    rule = (
        F.when(F.col("transaction_id").isNull(), "missing_transaction_id")
        .when(F.col("customer_id").isNull(), "missing_customer_id")
        .when(amount.isNull() | (amount <= 0), "invalid_amount")
        .when(F.col("timestamp").isNull(), "missing_timestamp")
        .when(currency.isNull() | ~currency.isin(schemas.CURRENCIES), "invalid_currency")
    )
    arrival = F.struct("ingestion_timestamp", "kafka_partition", "kafka_offset")
    judged = parsed.withColumn("transaction_id", F.trim("transaction_id")).withColumn("_rule", rule)
    accepted = judged.filter(F.col("_rule").isNull()).drop("_rule")
    first = stage(
        accepted.groupBy("transaction_id")
        .agg(F.min(arrival).alias("_first"), F.count(F.lit(1)).alias("_copies"))
        .filter("_copies > 1").drop("_copies"),
        "first-arrivals")
    repeated = F.when(arrival != F.col("_first"), "duplicate")
    told = accepted.join(first, "transaction_id", "left").withColumn("quarantine_reason", repeated)
    refused = judged.filter(F.col("_rule").isNotNull()).withColumnRenamed(
        "_rule", "quarantine_reason")
    return told.drop("_first").unionByName(refused)
