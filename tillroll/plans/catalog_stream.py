"""Registered streaming queries.  The staged payload files and one
availableNow run of the three queries are shared per session and input."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import config as C
from tillroll.session import pin_session, scratch_path
from tillroll.streaming import payloads as P
from tillroll.streaming import job as SP

def _cfg(spark: SparkSession) -> C.StreamConfig:
    """State partitions sized to the cluster's cores, not to a fixed default."""
    return C.StreamConfig(shuffle_partitions=max(4, spark.sparkContext.defaultParallelism))


CLEAN_COLUMNS = ["transaction_id", "customer_id", "region", "store_id", "amount", "status", "event_time", "event_date"]
_RUNS: dict[tuple[str, str], dict] = {}


def _source(spark: SparkSession, inbox: str) -> DataFrame:
    """The staged payloads as a stream, one folder of files a trigger."""
    return SP.read_source(spark, "files", f"{inbox}/batch=*", SP.file_options(P.FILES_PER_BATCH))


def _staged(spark: SparkSession, sf: str) -> dict:
    pin_session(spark)
    key = (spark.sparkContext.applicationId, sf)
    if key not in _RUNS:
        lines_path = scratch_path(spark, "stream-lines-all")
        P.event_lines(spark, sf).write.mode("overwrite").parquet(lines_path)
        inbox = scratch_path(spark, "stream-in")
        P.stage_batches(spark.read.parquet(lines_path), inbox)
        run = SP.start(spark, _source(spark, inbox), scratch_path(spark, "stream-out"), cfg=_cfg(spark))
        SP.await_all(run)
        _RUNS[key] = {"lines": lines_path, "run": run, "inbox": inbox}
    return _RUNS[key]


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(_staged(spark, sf)["lines"])


def _lines_batch(spark: SparkSession, sf: str) -> DataFrame:
    """The same payloads as a batch frame (no staging needed)."""
    pin_session(spark)
    return P.event_lines(spark, sf)


def event_parse(spark: SparkSession, sf: str) -> DataFrame:
    parsed = SP.parse(_lines_batch(spark, sf).select(F.col("line").alias("raw")), stamp=False)
    return parsed.select("raw", "evt.*")


def dlq_split(spark: SparkSession, sf: str) -> DataFrame:
    parsed = SP.parse(_lines_batch(spark, sf).select(F.col("line").alias("raw")), stamp=False)
    bad = SP.is_bad()
    return parsed.select("raw", F.when(bad, F.lit("dlq")).otherwise(F.lit("clean")).alias("route"),
                         F.when(bad, SP.error_reason()).alias("error_reason"))


def event_key(spark: SparkSession, sf: str) -> DataFrame:
    return SP.event_key(_lines_batch(spark, sf).select(F.col("line").alias("raw")))


def stream_clean(spark: SparkSession, sf: str) -> DataFrame:
    run = _staged(spark, sf)["run"]
    return spark.read.parquet(run.clean_path).select(*CLEAN_COLUMNS)


def stream_window_sales(spark: SparkSession, sf: str) -> DataFrame:
    run = _staged(spark, sf)["run"]
    return spark.read.parquet(run.agg_path).select("window_start", "window_end", "region", "txn_count",
                                                   "total_sales", "event_date")


def stream_dlq(spark: SparkSession, sf: str) -> DataFrame:
    run = _staged(spark, sf)["run"]
    return spark.read.parquet(run.dlq_path).select("raw", "error_reason")


def stream_late_drop(spark: SparkSession, sf: str) -> DataFrame:
    """Valid events the stream did not emit (older than the watermark when they
    arrived); duplicates of emitted ids are not counted as drops."""
    run = _staged(spark, sf)["run"]
    parsed = SP.parse(_lines(spark, sf).select(F.col("line").alias("raw")), stamp=False)
    valid = parsed.filter(~SP.is_bad()).select("evt.transaction_id", "evt.event_time").distinct()
    emitted = spark.read.parquet(run.clean_path).select("transaction_id")
    return valid.join(emitted, "transaction_id", "left_anti")


def stream_restart(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs on one checkpoint: the first half of the batches, then the rest
    added and the query restarted.  Output must equal a single run."""
    pin_session(spark)
    lines = _lines(spark, sf)
    half = lines.agg(F.max("file_no")).first()[0] // 2  # one number
    inbox, out = scratch_path(spark, "stream-restart-in"), scratch_path(spark, "stream-restart-out")
    for part in (F.col("file_no") <= half, F.col("file_no") > half):
        P.stage_batches(lines.where(part), inbox)
        run = SP.start(spark, _source(spark, inbox), out, cfg=_cfg(spark))
        SP.await_all(run)
    return spark.read.parquet(run.clean_path).select(*CLEAN_COLUMNS)


def stream_progress(spark: SparkSession, sf: str) -> DataFrame:
    """Input rows of every batch of the three queries, from the progress table."""
    staged = _staged(spark, sf)
    return SP.record_progress(spark, staged["run"].out, SP.file_rows(spark, "text", f"{staged['inbox']}/batch=*"))


QUERIES = {
    "event_parse": event_parse,
    "dlq_split": dlq_split,
    "event_key": event_key,
    "stream_clean": stream_clean,
    "stream_late_drop": stream_late_drop,
    "stream_window_sales": stream_window_sales,
    "stream_dlq": stream_dlq,
    "stream_restart": stream_restart,
    "stream_progress": stream_progress,
}
