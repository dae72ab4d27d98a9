"""Registered lake queries (raw -> processed -> curated)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import config as C
from tillroll import schemas
from tillroll.functions.columns import parse_ts
from tillroll.operators import aggregates as agg
from tillroll.operators.clean import add_date_parts
from tillroll.operators.dedup import latest_per_key
from tillroll.operators.lake import (compact, compact_to_bytes, file_report, file_sizes, merge_into_processed, read_processed,
                                     schema_drift, to_processed_layout, write_partitioned)
from tillroll.operators.quality import reject_summary, with_dq_errors, write_quarantine
from tillroll.plans import lake_inputs as L
from tillroll.session import pin_session, scratch_path
from tillroll.sources.files import delete_path
from tillroll.sources.landing import extract, landing_for, read_state, write_watermark

RAW_OUT = [*schemas.RAW_COLUMNS, "ingest_date"]
STD_OUT = [*schemas.RAW_COLUMNS, "ingest_date"]


def raw_scan(spark: SparkSession, sf: str) -> DataFrame:
    return L.raw(spark, sf, with_source=False).select(*RAW_OUT)


def incremental_extract(spark: SparkSession, sf: str) -> DataFrame:
    L.raw(spark, sf, with_source=False)
    return extract(spark, landing_for(spark, sf), watermark=L.WATERMARK).select(*RAW_OUT)


def backfill_extract(spark: SparkSession, sf: str) -> DataFrame:
    L.raw(spark, sf, with_source=False)
    return extract(spark, landing_for(spark, sf), run_date=L.BACKFILL_DATE, watermark=L.WATERMARK).select(*RAW_OUT)


def standardise_q(spark: SparkSession, sf: str) -> DataFrame:
    return L.std(spark, sf).select(*STD_OUT)


def date_normalise(spark: SparkSession, sf: str) -> DataFrame:
    r = L.raw(spark, sf, with_source=False)
    ts = parse_ts(F.nullif(F.trim("transaction_ts"), F.lit("")))
    return r.select("transaction_id", F.col("transaction_ts").alias("transaction_ts_text"),
                    ts.alias("transaction_ts"), F.to_date(ts).alias("transaction_date"))


def null_defaults(spark: SparkSession, sf: str) -> DataFrame:
    return L.std(spark, sf).select("transaction_id", "ingest_ts", "currency", "payment_method")


def dq_reasons(spark: SparkSession, sf: str) -> DataFrame:
    d = with_dq_errors(L.std(spark, sf), C.REFERENCE_REGIONS)
    return d.select("transaction_id", "ingest_ts", F.concat_ws(",", "dq_errors").alias("dq_errors"),
                    F.size("dq_errors").cast("int").alias("n_errors"))


def dq_good(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = L.good_bad(spark, sf)
    return good.select(*STD_OUT)


def dq_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = L.good_bad(spark, sf)
    path = scratch_path(spark, "quarantine")
    write_quarantine(bad.drop("source_file"), path)
    return spark.read.parquet(path).select(*STD_OUT, "dq_errors")


def reject_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return reject_summary(L.std(spark, sf), C.REFERENCE_REGIONS, C.MAX_REJECT_RATIO)


def date_parts(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = L.good_bad(spark, sf)
    return add_date_parts(good).select("transaction_id", "ingest_ts", "transaction_ts", "transaction_date",
                                       "year", "month", "day")


def dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = L.good_bad(spark, sf)
    return L.deduped(good).select(*schemas.PROCESSED_COLUMNS)


def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = L.good_bad(spark, sf)
    first = good.filter(L.ingest_hour(21)).select("transaction_id", "amount", "status", "ingest_ts")
    second = good.filter(L.ingest_hour(22)).select("transaction_id", "status", "ingest_ts", "currency")
    return first.unionByName(second, allowMissingColumns=True)


def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Three landings merged in two runs: first versions, then corrections and
    moved transactions.  Result: the whole processed table."""
    good, _ = L.good_bad(spark, sf)
    path = scratch_path(spark, "processed-merge")
    run1 = latest_per_key(good.filter(L.ingest_hour(21)), prefer=[F.col("source_file")]).drop("source_file")
    merge_into_processed(spark, run1, path)
    second = good.filter(L.ingest_hour(22)).unionByName(L.moved_slice(good))
    run2 = latest_per_key(second, prefer=[F.col("source_file")]).drop("source_file")
    merge_into_processed(spark, run2, path)
    return read_processed(spark, path).select(*schemas.PROCESSED_COLUMNS)


def partition_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """Write processed, then replace the days of one month with only their
    completed rows; the other folders stay as they were."""
    good, _ = L.good_bad(spark, sf)
    path = scratch_path(spark, "processed-overwrite")
    processed = to_processed_layout(L.deduped(good))
    write_partitioned(processed, path, ["year", "month", "day"])
    y, m = L.OVERWRITE_MONTH
    current = read_processed(spark, path)
    replacement = current.filter((F.col("year") == y) & (F.col("month") == m) & (F.col("status") == "COMPLETED"))
    staging = scratch_path(spark, "overwrite-staging")
    replacement.write.mode("overwrite").parquet(staging)
    write_partitioned(read_processed(spark, staging), path, ["year", "month", "day"])
    return read_processed(spark, path).select(*schemas.PROCESSED_COLUMNS)


def next_watermark(spark: SparkSession, sf: str) -> DataFrame:
    """New watermark = greatest(previous, max ingest_date read): a backfill of
    an old day never moves the watermark back."""
    L.raw(spark, sf, with_source=False)
    land = landing_for(spark, sf)
    prev = F.lit(L.WATERMARK)
    inc = extract(spark, land, watermark=L.WATERMARK, with_source=False).agg(F.max("ingest_date").alias("m"))
    back = extract(spark, land, run_date=L.OLD_BACKFILL_DATE, watermark=L.WATERMARK, with_source=False) \
        .agg(F.max("ingest_date").alias("m"))
    def shape(df, mode):
        return df.select(F.lit(mode).alias("mode"), prev.alias("previous_watermark"),
                         F.col("m").alias("max_ingest_date"), F.greatest(prev, F.col("m")).alias("next_watermark"))
    return shape(inc, "incremental").unionByName(shape(back, "backfill"))


def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """rows_read / rows_valid / rows_quarantined / duplicates_removed in one pass."""
    from tillroll.functions.columns import any_rule_broken
    s = L.std(spark, sf)
    ok = ~any_rule_broken(C.REFERENCE_REGIONS)
    m = s.agg(F.count(F.lit(1)).alias("rows_read"), F.count_if(ok).alias("rows_valid"),
              F.count_distinct(F.when(ok, F.col("transaction_id"))).alias("_ids"))
    return m.select("rows_read", "rows_valid", (F.col("rows_read") - F.col("rows_valid")).alias("rows_quarantined"),
                    (F.col("rows_valid") - F.col("_ids")).alias("duplicates_removed"))


def watermark_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Commit the state row of a full run and read it back."""
    state = scratch_path(spark, "state")
    m = run_metrics(spark, sf).first().asDict()
    last = L.raw(spark, sf, with_source=False).agg(F.max("ingest_date")).first()[0]
    write_watermark(spark, state, str(last), dict(m, job=C.LakeConfig.job_name, duration_sec=0.0))
    return read_state(spark, state).select("job", "rows_read", "rows_valid", "rows_quarantined",
                                           "duplicates_removed", "last_ingest_date")


def _processed(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = L.good_bad(spark, sf)
    return L.deduped(good)


def daily_region_sales(spark: SparkSession, sf: str) -> DataFrame:
    return agg.daily_region_sales(_processed(spark, sf))


def daily_sales(spark: SparkSession, sf: str) -> DataFrame:
    return agg.daily_sales(_processed(spark, sf))


def _compacted(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    """Processed written with four files per day, then one month compacted."""
    path = scratch_path(spark, "processed-compact")
    processed = to_processed_layout(_processed(spark, sf))
    write_partitioned(processed, path, ["year", "month", "day"], files_per_partition=4)
    y, m = L.COMPACT_MONTH
    compact(spark, path, ["year", "month", "day"], {"year": y, "month": m}, files_per_partition=1)
    return path, read_processed(spark, path)


def compact_partition(spark: SparkSession, sf: str) -> DataFrame:
    _, df = _compacted(spark, sf)
    return df.select(*schemas.PROCESSED_COLUMNS)


MONTHS = ["year", "month"]
BY_MONTH = T.StructType([f for f in schemas.PROCESSED.fields if f.name != "day"])


def compact_bytes(spark: SparkSession, sf: str) -> DataFrame:
    """Processed by month, four files a month, compacted to the target file
    size.  Result: each month's files and rows, and whether its files are as
    many as its bytes ask for."""
    path = scratch_path(spark, "processed-bytes")
    rows = to_processed_layout(_processed(spark, sf)).drop("day")
    write_partitioned(rows.select(*BY_MONTH.names), path, MONTHS, files_per_partition=4)
    compact_to_bytes(spark, path, MONTHS, BY_MONTH)
    asked = F.greatest(F.lit(1), F.ceil(F.col("bytes") / C.TARGET_FILE_BYTES))
    fits = file_sizes(spark, path, MONTHS, BY_MONTH).select(*MONTHS, (F.col("n_files") <= asked).alias("fits"))
    return file_report(spark, path, MONTHS, BY_MONTH).join(fits, MONTHS).select(*MONTHS, "n_files", "n_rows", "fits")


def file_report_q(spark: SparkSession, sf: str) -> DataFrame:
    path, _ = _compacted(spark, sf)
    return file_report(spark, path, ["year", "month", "day"], schemas.PROCESSED)


def partition_sync(spark: SparkSession, sf: str) -> DataFrame:
    """Processed written, registered as a catalog table, partitions recovered;
    result: the catalog's partitions as (year, month, day)."""
    import uuid

    from tillroll.operators.lake import sync_partitions

    path = scratch_path(spark, "processed-sync")
    write_partitioned(to_processed_layout(_processed(spark, sf)), path, ["year", "month", "day"])
    table = f"processed_{uuid.uuid4().hex[:10]}"
    parts = sync_partitions(spark, table, path, schemas.PROCESSED, ["year", "month", "day"])
    kv = F.split(F.col("partition"), "/")
    return parts.select(*[F.element_at(F.split(F.element_at(kv, i + 1), "="), 2).alias(c)
                          for i, c in enumerate(["year", "month", "day"])])


def batch_run(spark: SparkSession, sf: str) -> DataFrame:
    """The full batch job over the whole landing (first run, then a rerun
    that finds nothing new); result: the processed table."""
    from tillroll.plans.batch import BatchPaths, run_batch

    pin_session(spark)
    root = scratch_path(spark, "batch-run")
    paths = BatchPaths(landing_for(spark, sf), f"{root}/processed", f"{root}/curated",
                       f"{root}/quarantine", f"{root}/state")
    run_batch(spark, paths, print_metrics=False)
    if run_batch(spark, paths, print_metrics=False) is not None:
        raise RuntimeError("a rerun without new data must not process anything")
    return read_processed(spark, paths.processed).select(*schemas.PROCESSED_COLUMNS)


def schema_drift_q(spark: SparkSession, sf: str) -> DataFrame:
    """Processed with two real layouts, years before L.DRIFT_YEAR without
    currency and with amount as double, later ones with an extra column."""
    path, staging = scratch_path(spark, "processed-drift"), scratch_path(spark, "drift-staging")
    to_processed_layout(_processed(spark, sf)).write.parquet(staging)  # both layouts read this copy
    rows = read_processed(spark, staging)
    early = rows.filter(F.col("year") < L.DRIFT_YEAR).drop("currency").withColumn("amount", F.col("amount").cast("double"))
    late = rows.filter(F.col("year") >= L.DRIFT_YEAR).withColumn("channel", F.lit("web"))
    for part in (early, late):
        write_partitioned(part, path, ["year", "month", "day"], mode="append")
    delete_path(spark, staging)
    return schema_drift(spark, path, schemas.PROCESSED, ["year", "month", "day"])


QUERIES = {
    "raw_scan": raw_scan,
    "incremental_extract": incremental_extract,
    "backfill_extract": backfill_extract,
    "standardise": standardise_q,
    "date_normalise": date_normalise,
    "null_defaults": null_defaults,
    "dq_reasons": dq_reasons,
    "dq_good": dq_good,
    "dq_quarantine": dq_quarantine,
    "reject_ratio": reject_ratio,
    "date_parts": date_parts,
    "dedup_latest": dedup_latest,
    "union_by_name": union_by_name,
    "merge_upsert": merge_upsert,
    "partition_overwrite": partition_overwrite,
    "next_watermark": next_watermark,
    "watermark_roundtrip": watermark_roundtrip,
    "run_metrics": run_metrics,
    "daily_region_sales": daily_region_sales,
    "daily_sales": daily_sales,
    "compact_partition": compact_partition,
    "compact_bytes": compact_bytes,
    "file_report": file_report_q,
    "schema_drift": schema_drift_q,
    "batch_run": batch_run,
    "partition_sync": partition_sync,
}
