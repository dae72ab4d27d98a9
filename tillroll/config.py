"""Configuration: one dataclass plus the fixed values results depend on."""
from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------
# Timestamp formats tried in order for transaction_ts; the first that parses wins.
TS_FORMATS = ("yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm", "yyyy-MM-dd'T'HH:mm:ss'Z'")
# Format of ingest_ts.
INGEST_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Regions accepted by the batch data-quality rule (reference default list).
REFERENCE_REGIONS = ("NORTH", "SOUTH", "EAST", "WEST", "CENTRAL")
# Business key of a transaction.
BUSINESS_KEY = "transaction_id"
# A run fails when strictly more than this share of rows is rejected.
MAX_REJECT_RATIO = 0.10
# Defaults for missing values.
DEFAULT_CURRENCY = "INR"
DEFAULT_PAYMENT_METHOD = "UNKNOWN"
# Data-quality rule names, in output order.
DQ_RULE_NAMES = (
    "missing_transaction_id",
    "missing_customer_id",
    "invalid_or_missing_date",
    "missing_amount",
    "non_positive_amount",
    "invalid_region",
)
# Star schema constants.
DIM_REGION_COUNTRY = "India"
OPEN_END_DATE = dt.date(9999, 12, 31)
# Streaming: watermark delay and tumbling window.
STREAM_WATERMARK = "2 hours"
STREAM_WINDOW = "5 minutes"
STREAM_TRIGGER_INTERVAL = "30 seconds"
STREAM_MAX_RECORDS = 10000
STREAM_MAX_FILES_PER_TRIGGER = 5
DLQ_MALFORMED = "malformed_json"
DLQ_MISSING_FIELD = "missing_required_field"
EVENT_KEY_UNKNOWN = "unknown"
EVENT_KEY_MALFORMED = "malformed"
# Monitoring thresholds.
QUARANTINE_ALARM_ROWS = 1000
NO_DATA_ALARM_HOURS = 26
STREAM_LAG_ALARM_MS = 300_000
STREAM_LAG_ALARM_PERIODS = 3
FAILED_RUN_MARKER = "ETL run FAILED"
LATEST_METRICS_LIMIT = 20
# Output layout.
STATE_FILE = "watermark.json"
CURATED_DAILY_REGION = "daily_region_sales"
CURATED_DAILY = "daily_sales"
# File sizes that a table's folders are compacted to (128 MB to 1 GB).
TARGET_FILE_BYTES = 512 << 20
MOST_FILE_BYTES = 1 << 30
STREAM_CLEAN_DIR = "processed/transactions_stream"
STREAM_AGG_DIR = "curated/region_sales_5min"
STREAM_DLQ_DIR = "dlq/transactions_stream"
STREAM_CHECKPOINT_DIR = "_checkpoints/transactions_stream"
STREAM_PROGRESS_DIR = "progress/transactions_stream"
# Kafka with IAM authentication, and the Kinesis endpoint pattern.
KAFKA_IAM_OPTIONS = {
    "kafka.security.protocol": "SASL_SSL",
    "kafka.sasl.mechanism": "AWS_MSK_IAM",
    "kafka.sasl.jaas.config": "software.amazon.msk.auth.iam.IAMLoginModule required;",
    "kafka.sasl.client.callback.handler.class": "software.amazon.msk.auth.iam.IAMClientCallbackHandler",
}
KINESIS_ENDPOINT = "https://kinesis.{region}.amazonaws.com"
# Analytics windows (days).
RECENT_SALES_DAYS = 30
DORMANT_DAYS = 90
TOP_CUSTOMERS = 10


@dataclass(frozen=True)
class LakeConfig:
    """Knobs of a batch run.  Paths are folders on the shared file system."""

    valid_regions: tuple[str, ...] = REFERENCE_REGIONS
    ts_formats: tuple[str, ...] = TS_FORMATS
    max_reject_ratio: float = MAX_REJECT_RATIO
    # Upper bound on rows per written file; a large day becomes several files.
    max_records_per_file: int = 5_000_000
    curated_partitions: tuple[str, ...] = ("year", "month")
    job_name: str = "tillroll-batch"


@dataclass(frozen=True)
class StreamConfig:
    watermark: str = STREAM_WATERMARK
    window: str = STREAM_WINDOW
    # State partitions, fixed by the checkpoint at the first start.  None: the
    # session's spark.sql.shuffle.partitions.
    shuffle_partitions: int | None = None
    # The batch layer upper-cases status; the stream keeps it as sent unless asked.
    normalise_status: bool = False
