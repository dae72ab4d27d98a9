"""Star schema: calendar, region and customer (SCD2) dimensions, fact load,
fact merge and integrity checks."""
from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll import config as C
from tillroll.functions.columns import date_key, null_safe_differs
from tillroll.operators import key_index
from tillroll.operators.lake import delete_partitions, partition_keys, prune_to_partitions
from tillroll.operators.positions import with_position
from tillroll.session import scratch_path, small_tasks_apart
from tillroll.sources.files import delete_path, path_exists

CUSTOMER_ATTRS = ["customer_name", "customer_email", "home_region_code"]
# Attributes whose change opens a new customer version.
SCD2_TRIGGERS = ["customer_email", "home_region_code"]
FACT_COLUMNS = ["transaction_id", "date_key", "customer_key", "region_key", "store_id", "product_id",
                "payment_method", "status", "quantity", "unit_price", "amount", "transaction_ts"]


# ---------------------------------------------------------------------------
# dim_date
# ---------------------------------------------------------------------------
def dim_date_between(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    cal = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))).alias("d"))
    return _calendar_columns(cal)


def dim_date(facts: DataFrame, date_col: str = "transaction_date") -> DataFrame:
    """Whole calendar years spanning the data (every fact date has a row).

    Size is bounded by the calendar (366 rows per year), so it is broadcast
    wherever it is joined.
    """
    bounds = facts.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    cal = bounds.select(F.explode(F.sequence(
        F.trunc("lo", "year"), F.make_date(F.year("hi"), F.lit(12), F.lit(31)), F.expr("INTERVAL 1 DAY"))).alias("d"))
    return _calendar_columns(cal)


def _calendar_columns(cal: DataFrame) -> DataFrame:
    d = F.col("d")
    iso_dow = (F.weekday(d) + 1).cast("int")  # Monday = 1 .. Sunday = 7
    return cal.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.dayofmonth(d).cast("int").alias("day_of_month"),
        F.date_format(d, "EEEE").alias("day_name"),
        iso_dow.alias("day_of_week"),
        F.weekofyear(d).cast("int").alias("week_of_year"),
        F.month(d).cast("int").alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).cast("int").alias("quarter_number"),
        F.year(d).cast("int").alias("year_number"),
        (iso_dow >= 6).alias("is_weekend"),
    )


# ---------------------------------------------------------------------------
# dim_region
# ---------------------------------------------------------------------------
def dim_region(stg: DataFrame, country: str = C.DIM_REGION_COUNTRY) -> DataFrame:
    """Distinct region codes with dense keys in code order.  A handful of rows:
    the global ordering window is cheap here."""
    regions = stg.select(F.col("region").alias("region_code")).filter(F.col("region_code").isNotNull()).distinct()
    return regions.select(
        F.row_number().over(Window.orderBy("region_code")).cast("int").alias("region_key"),
        "region_code",
        F.initcap("region_code").alias("region_name"),
        F.lit(country).alias("country"),
    )


# ---------------------------------------------------------------------------
# dim_customer: initial load and SCD2
# ---------------------------------------------------------------------------
def dim_customer(stg: DataFrame) -> DataFrame:
    """One current version per customer: latest attributes (ties: larger
    transaction_id), effective from the first purchase date.

    One partial aggregation per customer (no window over a hot customer);
    dense keys in customer_id order without a single-partition sort.
    """
    per_customer = stg.groupBy("customer_id").agg(
        F.max_by(F.struct(F.col("customer_name"), F.col("customer_email"), F.col("region").alias("home_region_code")),
                 F.struct("transaction_ts", "transaction_id")).alias("_s"),
        F.min("transaction_date").alias("effective_from"),
    )
    versions = per_customer.select(
        "customer_id", "_s.*", "effective_from",
        F.lit(C.OPEN_END_DATE).alias("effective_to"),
        F.lit(True).alias("is_current"),
    )
    keyed = with_position(versions, ["customer_id"], "customer_key")
    return keyed.select("customer_key", "customer_id", *CUSTOMER_ATTRS, "effective_from", "effective_to", "is_current")


def _day_states(feed: DataFrame) -> DataFrame:
    """Last attributes of each customer per day (partial aggregation)."""
    return (feed.groupBy("customer_id", F.col("transaction_date").alias("day"))
            .agg(F.max_by(F.struct(*CUSTOMER_ATTRS), F.struct("transaction_ts", "transaction_id")).alias("_s"))
            .select("customer_id", "day", "_s.*"))


def scd2_history(feed: DataFrame) -> DataFrame:
    """SCD2 versions from a feed of (customer, attributes, transaction time).

    A version starts on the first day and on every day whose last e-mail or
    region differs (NULL-safe) from the previous day's; it ends the day
    before the next version starts.  Same-day changes collapse into the
    day's last state.  The per-customer window runs over day states, so a
    customer's partition is bounded by the number of calendar days.
    """
    days = _day_states(feed)
    w = Window.partitionBy("customer_id").orderBy("day")
    prev = [F.lag(c).over(w) for c in SCD2_TRIGGERS]
    starts = days.withColumn("_first", F.lag("day").over(w).isNull()) \
                 .withColumn("_changed", null_safe_differs([F.col(c) for c in SCD2_TRIGGERS], prev))
    versions = starts.filter(F.col("_first") | F.col("_changed"))
    nxt = F.lead("day").over(Window.partitionBy("customer_id").orderBy("day"))
    versions = versions.select(
        "customer_id", *CUSTOMER_ATTRS,
        F.col("day").alias("effective_from"),
        F.coalesce(F.date_sub(nxt, 1), F.lit(C.OPEN_END_DATE)).alias("effective_to"),
        nxt.isNull().alias("is_current"),
    )
    keyed = with_position(versions, ["customer_id", "effective_from"], "customer_key")
    return keyed.select("customer_key", "customer_id", *CUSTOMER_ATTRS, "effective_from", "effective_to", "is_current")


def scd2_splice(dim: DataFrame, feed: DataFrame) -> DataFrame:
    """Apply a feed of any days, in any order, to an SCD2 dimension in one pass.

    A customer's boundaries are the starts of the versions it has and the days
    of the feed; at each stands a state, the feed's where its trigger attributes
    differ.  Equal neighbours are one run: a feed day that changes nothing
    disappears, and one before a version of the same state moves that version's
    start back, with its key.  Versions that exist stay versions of their own
    (facts hold their keys); one that began on a changed day is updated in
    place.  New ones get keys after the largest, by start and customer.
    Customers without feed rows pass through untouched; what a window orders is
    bounded by a customer's versions and days.  The same feed again changes
    nothing.
    """
    days = _day_states(feed)
    touched = days.select("customer_id").distinct()
    held = dim.join(touched, "customer_id", "left_semi").select(
        "customer_id", F.col("effective_from").alias("day"), "customer_key", *[F.col(c).alias(f"_held_{c}") for c in CUSTOMER_ATTRS])
    both = days.withColumn("_fed", F.lit(True)).join(held, ["customer_id", "day"], "full_outer")
    fed, exists = F.col("_fed").isNotNull(), F.col("customer_key").isNotNull()
    differs = null_safe_differs([F.col(c) for c in SCD2_TRIGGERS], [F.col(f"_held_{c}") for c in SCD2_TRIGGERS])
    from_feed = fed & (~exists | differs)
    states = both.select("customer_id", "day", "customer_key", *[F.when(from_feed, F.col(c)).otherwise(F.col(f"_held_{c}")).alias(c) for c in CUSTOMER_ATTRS])

    ordered = Window.partitionBy("customer_id").orderBy("day")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    changed = F.lag("day").over(ordered).isNull() | null_safe_differs(
        [F.col(c) for c in SCD2_TRIGGERS], [F.lag(c).over(ordered) for c in SCD2_TRIGGERS])
    runs = states.withColumn("_run", F.sum(changed.cast("int")).over(so_far))
    in_run = Window.partitionBy("customer_id", "_run")
    # a run's boundaries up to its second existing version are one version, and so on
    which = F.greatest(F.lit(1), F.count("customer_key").over(in_run.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    runs = runs.withColumn("_which", which)
    in_version = Window.partitionBy("customer_id", "_run", "_which")
    first = F.row_number().over(in_version.orderBy("day"))
    starts = runs.withColumn("customer_key", F.max("customer_key").over(in_version)).withColumn("_first", first).where("_first = 1")
    until = F.lead("day").over(ordered)
    versions = starts.select("customer_key", "customer_id", *CUSTOMER_ATTRS, F.col("day").alias("effective_from"),
                             F.coalesce(F.date_sub(until, 1), F.lit(C.OPEN_END_DATE)).alias("effective_to"), until.isNull().alias("is_current"))

    largest = dim.agg(F.coalesce(F.max("customer_key"), F.lit(0)).alias("m")).first()["m"]  # one number
    new = with_position(versions.where("customer_key IS NULL").drop("customer_key"), ["effective_from", "customer_id"], "_pos")
    new = new.withColumn("customer_key", (F.col("_pos") + F.lit(largest)).cast("long"))
    untouched = dim.join(touched, "customer_id", "left_anti")
    out = untouched.unionByName(versions.where("customer_key IS NOT NULL")).unionByName(new.drop("_pos"))
    return out.select("customer_key", "customer_id", *CUSTOMER_ATTRS, "effective_from", "effective_to", "is_current")


def scd2_apply(dim: DataFrame, feed_day: DataFrame, day: dt.date) -> DataFrame:
    """Apply one day of the feed to an SCD2 dimension (days may come in any order)."""
    return scd2_splice(dim, feed_day.filter(F.col("transaction_date") == F.lit(day)))


def scd2_lookup(facts: DataFrame, dim: DataFrame, date_col: str = "transaction_date") -> DataFrame:
    """As-of lookup: the version whose [effective_from, effective_to] holds the
    fact's date (both ends inclusive).  Equi-join on customer_id with a range
    residual; AQE splits a hot customer's fact rows across tasks."""
    d = dim.select("customer_key", F.col("customer_id").alias("_cid"), "effective_from", "effective_to",
                   *[F.col(c).alias(f"dim_{c}") for c in CUSTOMER_ATTRS])
    cond = ((facts["customer_id"] == d["_cid"])
            & (facts[date_col] >= d["effective_from"]) & (facts[date_col] <= d["effective_to"]))
    return facts.join(d, cond, "inner").drop("_cid")


# ---------------------------------------------------------------------------
# fact
# ---------------------------------------------------------------------------
def fact_transactions(stg: DataFrame, customers: DataFrame, regions: DataFrame) -> DataFrame:
    """Fact rows with surrogate keys.  Rows whose region has no dimension row
    are dropped by the inner join (the integrity checks surface that)."""
    # The region side has one row per region; joined before the customer
    # lookup, so the planner broadcasts it by its size.
    r = regions.select("region_key", F.col("region_code"))
    with_region = stg.join(r, stg["region"] == r["region_code"], "inner")
    j = scd2_lookup(with_region, customers)
    return j.select(
        "transaction_id", date_key(F.col("transaction_date")).alias("date_key"), "customer_key", "region_key",
        "store_id", "product_id", "payment_method", "status", "quantity", "unit_price", "amount", "transaction_ts")


def merge_by_key(spark: SparkSession, path: str, increment: DataFrame, key: str,
                 partition_cols: Sequence[str]) -> DataFrame:
    """Idempotent upsert of ``increment`` into a Parquet table partitioned by
    ``partition_cols``: rows of the increment replace rows with the same key,
    wherever those lie; only touched partitions (new ones and those that by the
    table's index may hold the same keys) are read and rewritten, and those left
    empty are removed.  Of several
    rows of the increment with one key the greatest by all columns stays."""
    parts, columns = list(partition_cols), increment.columns
    rest = [c for c in columns if c != key]
    newest = F.row_number().over(Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in rest]))
    new_path, staging = scratch_path(spark, "fact-merge-new"), scratch_path(spark, "fact-merge-staging")
    increment.withColumn("_n", newest).filter("_n = 1").drop("_n").write.mode("overwrite").parquet(new_path)
    new = spark.read.schema(increment.schema).parquet(new_path).select(*columns)
    exists, merged = path_exists(spark, path), new
    holding = key_index.folders_of(spark, path, new, increment.schema, key, parts)
    touched = partition_keys(new.select(*parts).unionByName(holding), parts)
    if exists:
        existing = spark.read.schema(increment.schema).parquet(path)
        merged = prune_to_partitions(existing, touched, parts).join(new.select(key), key, "left_anti").select(*columns).unionByName(new)
    merged.write.mode("overwrite").parquet(staging)
    staged = spark.read.schema(increment.schema).parquet(staging).select(*columns)
    with small_tasks_apart(spark):
        (staged.hint("rebalance", *parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*parts).parquet(path))
    left = set(partition_keys(staged, parts))
    delete_partitions(spark, path, parts, [k for k in touched if k not in left])
    for p in (new_path, staging):
        delete_path(spark, p)
    return spark.read.schema(increment.schema).parquet(path)


# ---------------------------------------------------------------------------
# integrity
# ---------------------------------------------------------------------------
def _count_as(df: DataFrame, name: str, col: str = "violations") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(col)).select(F.lit(name).alias("check_name"), col)


def fk_orphans(fact: DataFrame, customers: DataFrame, regions: DataFrame, dates: DataFrame) -> DataFrame:
    """Fact rows whose key has no dimension row, per foreign key."""
    return (_count_as(fact.join(customers.select("customer_key"), "customer_key", "left_anti"), "fk_customer")
            .unionByName(_count_as(fact.join(regions.select("region_key"), "region_key", "left_anti"), "fk_region"))
            .unionByName(_count_as(fact.join(dates.select("date_key"), "date_key", "left_anti"), "fk_date")))


def duplicate_key_count(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.agg((F.count(F.lit(1)) - F.count_distinct(key)).alias("violations")).select(
        F.lit(name).alias("check_name"), "violations")


def pk_unique(fact: DataFrame, customers: DataFrame, regions: DataFrame, dates: DataFrame) -> DataFrame:
    return (duplicate_key_count(fact, "transaction_id", "pk_fact_transactions")
            .unionByName(duplicate_key_count(customers, "customer_key", "pk_dim_customer"))
            .unionByName(duplicate_key_count(regions, "region_key", "pk_dim_region"))
            .unionByName(duplicate_key_count(dates, "date_key", "pk_dim_date")))


# Columns that must not be NULL, per table.
REQUIRED = {
    "fact": ("transaction_id", "date_key", "customer_key", "region_key"),
    "dim_customer": ("customer_key", "customer_id", "effective_from", "effective_to", "is_current"),
    "dim_region": ("region_key", "region_code", "region_name"),
    "dim_date": ("date_key", "full_date", "year_number", "month_number"),
}


def constraint_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(check_name, violations): repeated region codes, and rows of each table
    with a NULL in a required column.  One aggregation a table."""
    out = duplicate_key_count(tables["dim_region"], "region_code", "uk_region_code")
    for name, columns in REQUIRED.items():
        lacking = F.exists(F.array(*[F.col(c).isNull() for c in columns]), lambda x: x)
        out = out.unionByName(tables[name].agg(F.count_if(lacking).alias("violations")).select(F.lit(f"nn_{name}").alias("check_name"), "violations"))
    return out
