"""Data-quality rules, good/bad split, quarantine and the reject-ratio breaker."""
from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll import config as C
from tillroll.functions.columns import any_rule_broken, broken_rules
from tillroll.operators.lake import delete_partitions, partition_keys
from tillroll.session import small_tasks_apart


class RejectRatioExceeded(RuntimeError):
    pass


def with_dq_errors(df: DataFrame, valid_regions: Iterable[str] = C.REFERENCE_REGIONS) -> DataFrame:
    return df.withColumn("dq_errors", broken_rules(valid_regions))


def split_good_bad(df: DataFrame, valid_regions: Iterable[str] = C.REFERENCE_REGIONS,
                   stamp: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good, bad).  Good rows carry no extra column; bad rows carry the broken
    rule names and a ``rejected_at`` stamp."""
    regions = tuple(valid_regions)
    broken = any_rule_broken(regions)
    good = df.filter(~broken)
    bad = df.filter(broken).withColumn("dq_errors", broken_rules(regions))
    if stamp:
        bad = bad.withColumn("rejected_at", F.current_timestamp())
    return good, bad


def reject_summary(std: DataFrame, valid_regions: Iterable[str] = C.REFERENCE_REGIONS,
                   limit: float = C.MAX_REJECT_RATIO) -> DataFrame:
    """One row: rows_read, rows_valid, rows_quarantined, reject_ratio, breaker_tripped."""
    broken = any_rule_broken(tuple(valid_regions))
    s = std.agg(F.count(F.lit(1)).alias("rows_read"),
                F.count_if(broken).alias("rows_quarantined"))
    ratio = F.when(F.col("rows_read") > 0, F.col("rows_quarantined") / F.col("rows_read")).otherwise(F.lit(0.0))
    return s.select(
        "rows_read",
        (F.col("rows_read") - F.col("rows_quarantined")).alias("rows_valid"),
        "rows_quarantined",
        F.round(ratio, 6).alias("reject_ratio"),
        (ratio > F.lit(limit)).alias("breaker_tripped"),
    )


def check_reject_ratio(rows_read: int, rows_bad: int, limit: float = C.MAX_REJECT_RATIO) -> float:
    ratio = rows_bad / rows_read if rows_read else 0.0
    if ratio > limit:
        raise RejectRatioExceeded(
            f"{rows_bad} of {rows_read} rows ({ratio:.1%}) break a rule, more than the allowed {limit:.0%}")
    return ratio


def quarantine_rows(bad: DataFrame) -> DataFrame:
    """Quarantine layout: rule names joined with commas."""
    return bad.withColumn("dq_errors", F.concat_ws(",", "dq_errors"))


def write_quarantine(bad: DataFrame, path: str, days: Sequence = ()) -> None:
    """Each ingest_date folder is replaced, so a retried run does not append
    the same rejects twice.  ``days``: the ingest dates that were read; those
    without a reject lose the rejects of an earlier run."""
    with small_tasks_apart(bad.sparkSession):
        (quarantine_rows(bad).hint("rebalance", "ingest_date").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy("ingest_date").parquet(path))
    with_rejects = {k for k, in partition_keys(bad, ["ingest_date"])} if days else set()
    delete_partitions(bad.sparkSession, path, ["ingest_date"], [(d,) for d in days if d not in with_rejects])
