"""Raw landing zone (CSV by ingest_date), incremental extract and run state."""
from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import config as C
from tillroll import schemas
from tillroll.session import folders_listed_together, scratch_path, small_tasks_apart
from tillroll.sources.files import delete_path, path_exists, rename_path

_CSV_OPTIONS = {
    "header": "true",
    # keep padded text exactly as delivered (the writer trims by default)
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_landing(raw: DataFrame, path: str) -> str:
    """Land raw text rows as header CSV, one folder per ingest_date."""
    with small_tasks_apart(raw.sparkSession):
        (raw.select(*schemas.RAW_COLUMNS, "ingest_date")
         .hint("rebalance", "ingest_date")  # ~one file per day; AQE splits an oversized day
         .write.mode("overwrite").options(**_CSV_OPTIONS)
         .partitionBy("ingest_date").csv(path))
    return path


def read_landing(spark: SparkSession, path: str, with_source: bool = True) -> DataFrame:
    """All-text scan with an explicit schema (a bad value never fails the read);
    ``ingest_date`` comes from the folder names, ``source_file`` from metadata."""
    with folders_listed_together(spark):
        df = (spark.read.schema(schemas.RAW_WITH_PARTITION)
              .options(**_CSV_OPTIONS).option("mode", "PERMISSIVE")
              .csv(path))
    if with_source:
        df = df.withColumn("source_file", F.col("_metadata.file_path"))
    return df


def extract(spark: SparkSession, path: str, run_date: str | dt.date | None = None,
            watermark: str | dt.date | None = None, with_source: bool = True) -> DataFrame:
    """The folders of one day (``run_date``), else those after ``watermark``,
    else all.  Both are partition filters: all folders are listed, only the
    matching ones are read."""
    landed = read_landing(spark, path, with_source)
    day = F.col("ingest_date")
    given = lambda value: F.lit(str(value)).cast("date")
    wanted = day == given(run_date) if run_date else day > given(watermark) if watermark else F.lit(True)
    return landed.where(wanted)


_LANDINGS: dict[tuple[str, str], str] = {}


def landing_for(spark: SparkSession, sf_dir: str) -> str:
    """The fault fixture of ``sf_dir`` landed as CSV once per session."""
    from tillroll.sources.fixtures import raw_transactions

    key = (spark.sparkContext.applicationId, sf_dir)
    path = _LANDINGS.get(key)
    if path is None or not path_exists(spark, path):
        tag = hashlib.sha1(sf_dir.encode()).hexdigest()[:8]
        path = write_landing(raw_transactions(spark, sf_dir), scratch_path(spark, f"landing-{tag}"))
        _LANDINGS[key] = path
    return path


# ---------------------------------------------------------------------------
# Run state: one JSON row, replaced at the end of a successful run.  The new
# file is complete before the old one goes, and the old one is kept aside until
# the new one is in place.
# ---------------------------------------------------------------------------
class UnreadableState(RuntimeError):
    pass


def _state_file(spark: SparkSession, folder: str) -> str | None:
    current = f"{folder}/{C.STATE_FILE}"
    return next((p for p in (current, f"{current}.old") if path_exists(spark, p)), None)


def read_watermark(spark: SparkSession, folder: str) -> str | None:
    """The last ingest date that was processed; None before the first run.
    A state file without a valid date raises: reading everything again because
    of a damaged file must be somebody's decision."""
    path = _state_file(spark, folder)
    if path is None:
        return None
    found = spark.read.schema(schemas.STATE).json(path).select("last_ingest_date", F.col("last_ingest_date").try_cast("date").alias("d")).take(2)
    if len(found) != 1 or found[0]["d"] is None:
        raise UnreadableState(f"{path} holds no ingest date")
    return found[0]["last_ingest_date"]


def read_state(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(schemas.STATE).json(_state_file(spark, folder) or f"{folder}/{C.STATE_FILE}")


def write_watermark(spark: SparkSession, folder: str, last_ingest_date: str, metrics: dict) -> None:
    stamp = dt.datetime.now(dt.timezone.utc).isoformat()
    values = metrics | {"last_ingest_date": str(last_ingest_date), "updated_at": stamp}
    row = tuple(values.get(f.name) for f in schemas.STATE.fields)
    current = f"{folder}/{C.STATE_FILE}"
    spark.createDataFrame([row], schemas.STATE).coalesce(1).write.mode("overwrite").json(f"{current}.new")
    if path_exists(spark, current):
        delete_path(spark, f"{current}.old")
        rename_path(spark, current, f"{current}.old")
    rename_path(spark, f"{current}.new", current)
    delete_path(spark, f"{current}.old")
