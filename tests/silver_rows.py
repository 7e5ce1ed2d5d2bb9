"""Silver rows by id, without a Python row each."""

from pyspark.sql import functions as F, types as T

from ledgermill import schemas


def silver_rows(spark, ids, ingestion_hour=12, status="completed", day="2024-01-15"):
    """Rows of the silver schema; an id is a number or text."""
    names = [(i if isinstance(i, str) else f"TXN{i:03d}",) for i in ids]
    known = {
        "transaction_id": F.col("id"), "status": F.lit(status), "event_date": F.lit(day).cast("date"),
        "ingestion_timestamp": F.lit(f"{day} {ingestion_hour:02d}:00:00").cast("timestamp"),
        "timestamp": F.lit(f"{day} 01:00:00").cast("timestamp"), "account_id": F.concat(F.lit("A"), "id"),
        "customer_id": F.concat(F.lit("C"), F.substring("id", 5, 2)), "amount": F.lit("10.00"),
    }
    return spark.createDataFrame(names, "id string").select(*(
        known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(schemas.SILVER).fields))
