"""Registered monitoring queries over metrics derived from the lake runs."""
from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import config as C
from tillroll.operators import monitoring as M
from tillroll.operators.quality import RejectRatioExceeded
from tillroll.plans import lake_inputs as L
from tillroll.plans.batch import BatchPaths, read_log, run_batch
from tillroll.session import pin_session, scratch_path
from tillroll.sources.landing import landing_for
from tillroll.streaming import payloads as P


def _metrics(spark: SparkSession, sf: str) -> DataFrame:
    return L.metrics_per_ingest_day(L.std(spark, sf))


def latest_dq_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return M.latest_metrics(_metrics(spark, sf))


def dq_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return M.hourly(_metrics(spark, sf))


def alarm_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    return M.quarantine_alarm(_metrics(spark, sf))


def alarm_no_data(spark: SparkSession, sf: str) -> DataFrame:
    return M.no_data_alarm(_metrics(spark, sf))


def alarm_failed_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The alarm over the log that batch runs wrote: some whose breaker trips,
    and one day's backfill that finishes."""
    L.raw(spark, sf, with_source=False)
    root = scratch_path(spark, "failed-runs")
    paths = BatchPaths(landing_for(spark, sf), f"{root}/processed", f"{root}/curated", f"{root}/quarantine", f"{root}/state", log=f"{root}/log")
    for now, most in L.FAILING_RUNS:
        with contextlib.suppress(RejectRatioExceeded):
            run_batch(spark, paths, cfg=C.LakeConfig(max_reject_ratio=most), print_metrics=False, now=now)
    run_batch(spark, paths, run_date=str(L.BACKFILL_DATE), cfg=C.LakeConfig(max_reject_ratio=1.0), print_metrics=False, now=L.FAILING_RUNS[-1][0])
    return M.failed_runs_alarm(read_log(spark, paths.log))


def alarm_stream_lag(spark: SparkSession, sf: str) -> DataFrame:
    pin_session(spark)
    lines = P.event_lines(spark, sf).filter(F.col("kind") != "poison")
    lags = lines.select((F.col("event_time") + F.make_interval(secs=F.col("lag_ms") / 1000)).alias("arrival_ts"), "lag_ms")
    return M.stream_lag_alarm(lags)


QUERIES = {
    "latest_dq_metrics": latest_dq_metrics,
    "dq_hourly": dq_hourly,
    "alarm_quarantine": alarm_quarantine,
    "alarm_no_data": alarm_no_data,
    "alarm_failed_runs": alarm_failed_runs,
    "alarm_stream_lag": alarm_stream_lag,
}
