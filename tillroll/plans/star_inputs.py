"""The star schema built from the processed stand-in, written once per
session to the shared folder (the warehouse load) and read back by the
analytic queries."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import star as S
from tillroll.session import pin_session, scratch_path
from tillroll.sources.files import path_exists
from tillroll.sources.fixtures import customer_feed, stg_transactions

AS_OF = dt.date(2001, 8, 1)
SCD2_CUTOFF = dt.date(2000, 6, 1)  # used by tests as a mid-history day
SCD2_INCREMENT_DAYS = 3
FACT_MERGE_EXISTING_BEFORE = 20010101
FACT_MERGE_RESENT_FROM = 20001201

_STARS: dict[tuple[str, str], dict[str, str]] = {}


DIMENSIONS = {"dim_date": S.dim_date, "dim_region": S.dim_region, "dim_customer": S.dim_customer}


def dimension(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The plan of one dimension straight from the stand-in (no writes)."""
    pin_session(spark)
    return DIMENSIONS[name](stg_transactions(spark, sf_dir))


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star loaded as Parquet tables (once per session and input).

    The staged transactions are written once; dimensions and fact read them.
    The fact is laid out by date (ranges of date_key, sorted), so a date range
    skips files and row groups; ``load_ts`` says when it was loaded.
    """
    pin_session(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    paths = _STARS.get(key)
    if paths is None or not all(path_exists(spark, p) for p in paths.values()):
        root = scratch_path(spark, "star")
        stg_transactions(spark, sf_dir).write.parquet(f"{root}/stg")
        stg = spark.read.parquet(f"{root}/stg")
        paths = {name: f"{root}/{name}" for name in (*DIMENSIONS, "fact")}
        for name, plan in DIMENSIONS.items():
            plan(stg).write.parquet(paths[name])
        fact = S.fact_transactions(stg, *[spark.read.parquet(paths[n]) for n in ("dim_customer", "dim_region")])
        (fact.withColumn("load_ts", F.current_timestamp()).repartitionByRange("date_key").sortWithinPartitions("date_key")
         .write.parquet(paths["fact"]))
        _STARS[key] = paths
    return {name: spark.read.parquet(p) for name, p in paths.items()}


def fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact load itself: stand-in rows looked up against the stored dimensions."""
    t = tables(spark, sf_dir)
    return S.fact_transactions(stg_transactions(spark, sf_dir), t["dim_customer"], t["dim_region"])


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_session(spark)
    return customer_feed(spark, sf_dir)


def scd2_with_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole feed: history built up to the last three feed days, then those
    days spliced in together as one increment."""
    f = feed(spark, sf_dir)
    last = f.select("transaction_date").distinct().orderBy(F.col("transaction_date").desc()).limit(SCD2_INCREMENT_DAYS)
    first = last.agg(F.min("transaction_date")).first()[0]  # one date
    return S.scd2_splice(S.scd2_history(f.filter(F.col("transaction_date") < F.lit(first))), f.filter(F.col("transaction_date") >= F.lit(first)))


STAR_VIEWS = {"dim_date": "dim_date", "dim_region": "dim_region", "dim_customer": "dim_customer",
              "fact": "fact_transactions"}


def register_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Expose the loaded star as temporary views (dim_date, dim_region,
    dim_customer, fact_transactions) so existing SQL runs on it unchanged."""
    t = tables(spark, sf_dir)
    for name, view in STAR_VIEWS.items():
        t[name].createOrReplaceTempView(view)
    return t


def bucketed_tables(spark: SparkSession, sf_dir: str, buckets: int) -> dict[str, DataFrame]:
    """The fact and dim_customer as catalog tables bucketed (and sorted) by
    customer_key, the analogue of a distribution key: aggregating the fact
    per customer and joining it to the dimension then needs no shuffle of the
    fact.  Both tables use the same bucket count.  Opt-in: it pays off only
    when the customer join is too big to broadcast."""
    import uuid

    t = tables(spark, sf_dir)
    root = scratch_path(spark, "star-bucketed")
    tag = uuid.uuid4().hex[:8]
    out = dict(t)
    for name in ("fact", "dim_customer"):
        table = f"{name}_bucketed_{tag}"
        (t[name].write.mode("overwrite").bucketBy(buckets, "customer_key").sortBy("customer_key")
         .option("path", f"{root}/{name}").saveAsTable(table))
        out[name] = spark.table(table)
    return out
