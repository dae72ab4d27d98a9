"""Explicit schemas: raw landing, processed, events, state and metrics."""
from pyspark.sql import types as T

RAW_COLUMNS = (
    "transaction_id", "customer_id", "customer_name", "customer_email", "region", "store_id",
    "product_id", "quantity", "unit_price", "amount", "currency", "payment_method", "status",
    "transaction_ts", "ingest_ts",
)

RAW = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])
RAW_WITH_PARTITION = T.StructType(RAW.fields + [T.StructField("ingest_date", T.DateType())])

PROCESSED = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("customer_email", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("store_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", T.DecimalType(12, 2)),
    T.StructField("amount", T.DecimalType(14, 2)),
    T.StructField("currency", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("transaction_ts", T.TimestampType()),
    T.StructField("ingest_ts", T.TimestampType()),
    T.StructField("ingest_date", T.DateType()),
    T.StructField("transaction_date", T.DateType()),
    # Partition folders; read back as zero-padded strings, never inferred.
    T.StructField("year", T.StringType()),
    T.StructField("month", T.StringType()),
    T.StructField("day", T.StringType()),
])
PROCESSED_COLUMNS = tuple(f.name for f in PROCESSED.fields)

EVENT = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("store_id", T.StringType()),
    T.StructField("amount", T.DecimalType(14, 2)),
    T.StructField("status", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
])
EVENT_FIELDS = tuple(f.name for f in EVENT.fields)

STATE = T.StructType([
    T.StructField("job", T.StringType()),
    T.StructField("rows_read", T.LongType()),
    T.StructField("rows_valid", T.LongType()),
    T.StructField("rows_quarantined", T.LongType()),
    T.StructField("duplicates_removed", T.LongType()),
    T.StructField("duration_sec", T.DoubleType()),
    T.StructField("last_ingest_date", T.StringType()),
    T.StructField("updated_at", T.StringType()),
])

METRICS = T.StructType([
    T.StructField("run_ts", T.TimestampType()),
    T.StructField("event", T.StringType()),
    T.StructField("job", T.StringType()),
    T.StructField("rows_read", T.LongType()),
    T.StructField("rows_valid", T.LongType()),
    T.StructField("rows_quarantined", T.LongType()),
    T.StructField("duplicates_removed", T.LongType()),
    T.StructField("duration_sec", T.DoubleType()),
])
