"""Monitoring over the run-metrics table, the job log and stream lag:
latest records, hourly series and the four alarms, as DataFrame queries."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll import config as C
from tillroll.operators.positions import with_position


def latest_metrics(metrics: DataFrame, n: int = C.LATEST_METRICS_LIMIT) -> DataFrame:
    return (metrics.orderBy(F.col("run_ts").desc()).limit(n)
            .select("run_ts", "rows_read", "rows_valid", "rows_quarantined", "duplicates_removed", "duration_sec"))


def hourly(metrics: DataFrame) -> DataFrame:
    """Valid vs quarantined rows per hour (hours with runs)."""
    return (metrics.groupBy(F.window("run_ts", "1 hour").alias("w"))
            .agg(F.sum("rows_valid").alias("rows_valid"), F.sum("rows_quarantined").alias("rows_quarantined"))
            .select(F.col("w.start").alias("hour_start"), "rows_valid", "rows_quarantined"))


def quarantine_alarm(metrics: DataFrame, threshold: int = C.QUARANTINE_ALARM_ROWS) -> DataFrame:
    """Hourly maximum of rows_quarantined and whether it breaches the threshold."""
    return (metrics.groupBy(F.window("run_ts", "1 hour").alias("w"))
            .agg(F.max("rows_quarantined").alias("max_quarantined"))
            .select(F.col("w.start").alias("hour_start"), "max_quarantined",
                    (F.col("max_quarantined") > threshold).alias("breaching")))


def consecutive_breaches(observed: DataFrame, ts_col: str, breach: str, n: int, step_seconds: int) -> DataFrame:
    """Periods that end a run of ``n`` consecutive breaching periods; a period
    without a row between the first and the last one counts as breaching.

    ``observed`` has a row for each period seen (at most the calendar's number
    of periods).  Only periods that do not breach, and the first and last one,
    bound a run; the periods of a run follow from its bounds by arithmetic, so
    none is generated that does not alarm and ``observed`` is evaluated once.
    What follows a bound is found by its position: no task holds all periods.
    """
    seen = observed.select(F.unix_seconds(ts_col).alias("_at"), F.col(breach).alias("_bad")).where("_at IS NOT NULL")
    placed = with_position(seen, ["_at"], "_pos")
    ends = placed.agg(F.max("_pos").alias("_n"))
    held = placed.crossJoin(ends).withColumns({"_first": F.col("_pos") == 1, "_last": F.col("_pos") == F.col("_n")}).where("NOT _bad OR _first OR _last")
    bounds = with_position(held.select("_at", "_bad", "_first"), ["_at"], "_b")
    following = bounds.select((F.col("_b") - 1).alias("_b"), F.col("_at").alias("_next"), F.col("_bad").alias("_next_bad"))
    bounds = bounds.join(following, "_b", "left")
    before = F.when(~F.col("_bad"), F.col("_at")).when(F.col("_first"), F.col("_at") - step_seconds)
    after = (F.when(F.col("_next").isNull(), F.when(F.col("_bad"), F.col("_at") + step_seconds))
             .when(F.col("_next_bad"), F.col("_next") + step_seconds).otherwise(F.col("_next")))
    runs = bounds.select((before + n * step_seconds).alias("lo"), (after - step_seconds).alias("hi")).where("lo <= hi")
    return runs.select(F.explode(F.sequence("lo", "hi", F.lit(step_seconds).cast("long"))).alias("_p")).select(F.timestamp_seconds("_p").alias(ts_col))


def no_data_alarm(metrics: DataFrame, hours: int = C.NO_DATA_ALARM_HOURS) -> DataFrame:
    """Hours ending ``hours`` consecutive hourly buckets whose summed
    rows_valid is below 1; an hour without a record counts as breaching."""
    per_hour = metrics.groupBy(F.date_trunc("hour", "run_ts").alias("hour_start")).agg((F.sum("rows_valid") < 1).alias("breach"))
    return consecutive_breaches(per_hour, "hour_start", "breach", hours, 3600)


def failed_runs_alarm(log: DataFrame, marker: str = C.FAILED_RUN_MARKER) -> DataFrame:
    """Five-minute periods with at least one log line containing the marker."""
    return (log.filter(F.col("message").contains(marker))
            .groupBy(F.window("log_ts", "5 minutes").alias("w"))
            .agg(F.count(F.lit(1)).alias("failures"))
            .filter(F.col("failures") > 0)
            .select(F.col("w.start").alias("period_start"), "failures"))


def stream_lag_alarm(lags: DataFrame, limit_ms: int = C.STREAM_LAG_ALARM_MS,
                     periods: int = C.STREAM_LAG_ALARM_PERIODS) -> DataFrame:
    """Five-minute periods ending ``periods`` consecutive periods whose maximum
    lag exceeds ``limit_ms``; a period without data counts as breaching."""
    per = (lags.groupBy(F.window("arrival_ts", "5 minutes").start.alias("period_start"))
           .agg((F.max("lag_ms") > limit_ms).alias("breach")))
    return consecutive_breaches(per, "period_start", "breach", periods, 300)
