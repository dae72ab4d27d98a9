"""The full batch run: extract -> clean/DQ -> quarantine -> breaker -> dedup ->
merge into processed -> curated aggregates -> metrics -> watermark.

Write order is processed, curated, metrics, watermark, and every write is
idempotent, so a failed run is repaired by re-running it.
"""
from __future__ import annotations

import datetime as dt
import json
import logging
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import config as C
from tillroll import schemas
from tillroll.functions.columns import any_rule_broken
from tillroll.operators import aggregates as agg
from tillroll.operators.clean import standardise
from tillroll.operators.dedup import latest_per_key
from tillroll.operators.lake import (DATE_PARTS, Merged, delete_partitions, merge_into_processed, partition_keys, prune_to_partitions,
                                     read_processed, schema_drift, sync_touched, write_partitioned)
from tillroll.operators.quality import check_reject_ratio, split_good_bad, write_quarantine
from tillroll.session import pin_session, scratch_path
from tillroll.sources.files import delete_path
from tillroll.sources.landing import extract, read_watermark, write_watermark

log = logging.getLogger("tillroll.batch")


@dataclass(frozen=True)
class BatchPaths:
    source: str
    processed: str
    curated: str
    quarantine: str
    state: str
    metrics: str | None = None
    log: str | None = None  # a table of (log_ts, message), a row a run
    tables: str | None = None  # what the names of the catalog's three tables begin with, e.g. "lake."


LOG = "log_ts timestamp, message string"


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The job log that runs have appended to."""
    return spark.read.schema(LOG).parquet(path)


def run_batch(spark: SparkSession, paths: BatchPaths, run_date: str | None = None,
              cfg: C.LakeConfig = C.LakeConfig(), print_metrics: bool = True, now: dt.datetime | None = None) -> dict | None:
    """Returns the run metrics, or None when there was nothing new.

    ``paths.log`` gets a line for every run that finishes or fails, ``paths.metrics``
    a record for every run that read something; both are stamped ``now`` (a
    scheduler's run time), the clock's time unless given.

    ``print_metrics`` writes the DQ_METRICS JSON line to stdout (what log
    metric filters pick up); otherwise it goes to the log only."""
    pin_session(spark)
    began, now = time.monotonic(), now or dt.datetime.now(dt.timezone.utc)
    staged = scratch_path(spark, "batch-standardised")
    try:
        before = read_watermark(spark, paths.state)
        log.info("batch run: run_date %s, processed up to %s", run_date, before)
        # written once: the checks, the quarantine and the merge read the files
        std = standardise(extract(spark, paths.source, run_date, before), cfg.ts_formats)
        std.write.parquet(staged)
        metrics = _process(spark, paths, spark.read.schema(std.schema).parquet(staged), cfg, began)
        if metrics is None:
            log.info("batch run: no rows to process")
            return None
        newest = metrics.pop("_newest")
        if paths.metrics:
            record = metrics | {"event": "DQ_METRICS", "run_ts": now}
            spark.createDataFrame([tuple(record[f.name] for f in schemas.METRICS)], schemas.METRICS).write.mode("append").parquet(paths.metrics)
        write_watermark(spark, paths.state, max(newest, before or newest), metrics)
    except Exception:
        log.exception("%s; the state is as before the run", C.FAILED_RUN_MARKER)
        _log_line(spark, paths, now, f"{C.FAILED_RUN_MARKER}; the state is as before the run")
        raise
    finally:
        delete_path(spark, staged)
    _log_line(spark, paths, now, "batch run finished")
    line = json.dumps(dict(metrics, event="DQ_METRICS"))
    if print_metrics:
        print(line, flush=True)
    else:
        log.info(line)
    return metrics


def _log_line(spark: SparkSession, paths: BatchPaths, now: dt.datetime, message: str) -> None:
    if paths.log:
        spark.createDataFrame([(now, message)], LOG).write.mode("append").parquet(paths.log)


def _process(spark: SparkSession, paths: BatchPaths, std: DataFrame, cfg: C.LakeConfig, began: float) -> dict | None:
    """Quarantine, breaker, merge, curated tables; the run's metrics."""
    ok = ~any_rule_broken(cfg.valid_regions)
    per_day = std.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("ok")).collect()  # a row per ingest day
    if not per_day:
        return None
    n_read, n_valid = sum(r["n"] for r in per_day), sum(r["ok"] for r in per_day)
    good, bad = split_good_bad(std, cfg.valid_regions)
    write_quarantine(bad, paths.quarantine, [r["ingest_date"] for r in per_day if r["ok"] == r["n"]])
    check_reject_ratio(n_read, n_read - n_valid, cfg.max_reject_ratio)

    deduped = latest_per_key(good, prefer=[F.col("source_file")]).drop("source_file")
    merged = merge_into_processed(spark, deduped, paths.processed)
    months = sorted({day[:2] for day in merged.touched})
    gone = _recompute_curated(spark, paths, cfg, merged, months)
    drift = _sync(spark, paths, cfg, merged, months, gone) if paths.tables else {}
    log.info("batch run: %d rows read, %d quarantined, %d replaced by later versions", n_read, n_read - n_valid, n_valid - merged.new_rows)
    return {"job": cfg.job_name, "rows_read": n_read, "rows_valid": n_valid, "rows_quarantined": n_read - n_valid,
            "duplicates_removed": n_valid - merged.new_rows, "duration_sec": round(time.monotonic() - began, 1), **drift,
            "_newest": str(max(r["ingest_date"] for r in per_day))}


CURATED = {C.CURATED_DAILY_REGION: agg.daily_region_sales, C.CURATED_DAILY: agg.daily_sales}


def _recompute_curated(spark: SparkSession, paths: BatchPaths, cfg: C.LakeConfig, merged: Merged, months: list[tuple]) -> list[tuple]:
    """Every month with a rewritten or emptied day, from all its days; a month
    without days any more leaves the curated tables too and is returned."""
    parts = list(cfg.curated_partitions)
    processed = prune_to_partitions(read_processed(spark, paths.processed), months, ["year", "month"])
    gone = sorted(set(months) - {day[:2] for day in set(merged.touched) - set(merged.emptied)})  # unless other days are left
    if gone:
        left = set(partition_keys(prune_to_partitions(processed, gone, ["year", "month"]), ["year", "month"]))
        gone = [m for m in gone if m not in left]
    for name, table in CURATED.items():
        write_partitioned(table(processed), f"{paths.curated}/{name}", parts)
        delete_partitions(spark, f"{paths.curated}/{name}", ["year", "month"], gone)
    return gone


def _sync(spark: SparkSession, paths: BatchPaths, cfg: C.LakeConfig, merged: Merged, months: list[tuple], gone: list[tuple]) -> dict:
    """After the writes: the catalog's partitions of the three tables, and the
    drift of their touched years, which is logged and counted."""
    days = [d for d in merged.touched if d not in merged.emptied]
    processed = read_processed(spark, paths.processed)
    tables = {"processed": (paths.processed, schemas.PROCESSED, DATE_PARTS, days, merged.emptied)}
    for name, table in CURATED.items():
        path, schema, parts = f"{paths.curated}/{name}", table(processed).schema, list(cfg.curated_partitions)
        written = [tuple(r) for r in prune_to_partitions(spark.read.schema(schema).parquet(path), months, ["year", "month"])
                   .select(*parts).distinct().collect()]  # folders of the touched months
        tables[name] = (path, schema, parts, written, gone)
    found = 0
    for name, (path, schema, parts, written, empty) in tables.items():
        sync_touched(spark, f"{paths.tables}{name}", path, schema, parts, written, empty)
        drift = schema_drift(spark, path, schema, parts, sorted({k[0] for k in written})) if written else None
        for r in drift.where("status <> 'ok'").collect() if drift is not None else []:  # a row a column and touched year
            log.warning("drift in %s, %s=%s: column %s is %s, expected %s (%s)", name, parts[0], r["folder"], r["column_name"], r["actual_type"],
                        r["expected_type"], r["status"])
            found += 1
    return {"drifted_columns": found}


def processed_table(spark: SparkSession, paths: BatchPaths) -> DataFrame:
    return read_processed(spark, paths.processed).select(*schemas.PROCESSED_COLUMNS)
