"""Shared inputs of the lake queries: the landed fault fixture, standardised,
split, deduplicated.  Lazy plans; each query decides what it runs."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import config as C
from tillroll.operators.clean import add_date_parts, standardise
from tillroll.operators.dedup import latest_per_key
from tillroll.functions.columns import any_rule_broken
from tillroll.operators.quality import split_good_bad
from tillroll.session import pin_session
from tillroll.sources.landing import landing_for, read_landing

# Parameters of the registered lake queries.
WATERMARK = dt.date(1998, 6, 30)
BACKFILL_DATE = dt.date(1999, 3, 15)
OLD_BACKFILL_DATE = dt.date(1996, 2, 1)
OVERWRITE_MONTH = ("1997", "06")
DRIFT_YEAR = "1998"  # first year of the newer layout in the drift scenario
COMPACT_MONTH = ("1997", "06")
# Batch runs over the whole landing whose breaker trips where more rows than this share are rejected.
FAILING_RUNS = tuple((dt.datetime(2024, 1, 1, h, m, tzinfo=dt.timezone.utc), most) for h, m, most in ((2, 0, 0.05), (2, 3, 0.02), (3, 0, 0.06)))
MOVED_ID_RESIDUE = 101  # every 101st order is re-sent one day later (moves partition)

_FRAMES: dict[tuple[str, str, bool], DataFrame] = {}


def raw(spark: SparkSession, sf_dir: str, with_source: bool = True) -> DataFrame:
    """The landing scan, memoised per session so the folder listing is reused.
    ``with_source`` adds the lineage column ``source_file`` (file metadata)."""
    pin_session(spark)
    key = (spark.sparkContext.applicationId, sf_dir, with_source)
    if key not in _FRAMES:
        _FRAMES[key] = read_landing(spark, landing_for(spark, sf_dir), with_source)
    return _FRAMES[key]


def std(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardise(raw(spark, sf_dir))


def good_bad(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return split_good_bad(std(spark, sf_dir), C.REFERENCE_REGIONS)


def deduped(good: DataFrame) -> DataFrame:
    """Latest version per id; a newer landed file wins equal ingest stamps."""
    return add_date_parts(latest_per_key(good, prefer=[F.col("source_file")]))


def metrics_per_ingest_day(std: DataFrame, job: str = C.LakeConfig.job_name) -> DataFrame:
    """One DQ_METRICS record per daily run (one run per ingest_date), computed
    in one aggregation.  Runs start at an hour that varies with the day."""
    ok = ~any_rule_broken(C.REFERENCE_REGIONS)
    per_day = std.groupBy("ingest_date").agg(
        F.count(F.lit(1)).alias("rows_read"), F.count_if(ok).alias("rows_valid"),
        F.count_distinct(F.when(ok, F.col("transaction_id"))).alias("_ids"))
    hour = (F.dayofyear("ingest_date") * 7) % 24
    return per_day.select(
        (F.col("ingest_date").cast("timestamp") + F.make_interval(hours=hour)).alias("run_ts"),
        F.lit("DQ_METRICS").alias("event"), F.lit(job).alias("job"),
        "rows_read", "rows_valid",
        (F.col("rows_read") - F.col("rows_valid")).alias("rows_quarantined"),
        (F.col("rows_valid") - F.col("_ids")).alias("duplicates_removed"),
        (F.col("rows_read").cast("double") / 2).alias("duration_sec"))


def ingest_hour(h: int):
    return F.hour("ingest_ts") == h


def moved_slice(good: DataFrame) -> DataFrame:
    """Corrections that move a first-version transaction one day later,
    landed one hour after the second versions."""
    num = F.substring(F.col("transaction_id"), 3, 10).cast("long")
    return (good.filter(ingest_hour(21) & (num % MOVED_ID_RESIDUE == 0))
            .withColumn("transaction_ts", F.col("transaction_ts") + F.expr("INTERVAL 1 DAY"))
            .withColumn("ingest_ts", F.col("ingest_ts") + F.expr("INTERVAL 2 HOURS")))
