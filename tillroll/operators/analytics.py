"""Analytic statements H1-H5 over the star schema.

Each aggregates the fact table *before* joining dimensions where the
semantics allow it, so joins see one row per key instead of one per sale.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll import config as C


def _key(d: dt.date) -> int:
    return d.year * 10000 + d.month * 100 + d.day


def _completed(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("status") == "COMPLETED")


def h1_top_customers(fact: DataFrame, customers: DataFrame, top_n: int = C.TOP_CUSTOMERS) -> DataFrame:
    """Top customers by completed sales, grouped by id and name (a renamed
    customer splits), ordered by total then id then name; DENSE_RANK over the
    totals.  The rank is computed on the top rows only: a row's dense rank
    depends only on larger totals, and those are all in the list."""
    per_key = (_completed(fact).groupBy("customer_key")
               .agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("s")))
    totals = (per_key.join(customers.select("customer_key", "customer_id", "customer_name"), "customer_key")
              .groupBy("customer_id", "customer_name")
              .agg(F.sum("n").alias("txn_count"), F.sum("s").alias("total_amount")))
    order = [F.col("total_amount").desc(), F.col("customer_id").asc(), F.col("customer_name").asc_nulls_last()]
    top = totals.orderBy(*order).limit(top_n)
    return top.select("customer_id", "customer_name", "txn_count", "total_amount",
                      F.dense_rank().over(Window.orderBy(F.col("total_amount").desc())).cast("long").alias("sales_rank"))


def h2_region_sales(fact: DataFrame, regions: DataFrame, dates: DataFrame, as_of: dt.date,
                    days: int = C.RECENT_SALES_DAYS) -> DataFrame:
    """Completed sales per region for as_of - days <= date < as_of + 1 day,
    with each region's share of the filtered total."""
    lo, hi = as_of - dt.timedelta(days=days), as_of + dt.timedelta(days=1)
    in_range = dates.filter((F.col("full_date") >= F.lit(lo)) & (F.col("full_date") < F.lit(hi))).select("date_key")
    # the same range as a key predicate on the fact: pushed into its scan
    f = _completed(fact).filter((F.col("date_key") >= _key(lo)) & (F.col("date_key") < _key(hi)))
    f = f.join(in_range, "date_key", "left_semi")
    per_region = f.groupBy("region_key").agg(F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("total_sales"))
    named = (per_region.join(regions.select("region_key", "region_name"), "region_key")
             .groupBy("region_name").agg(F.sum("txn_count").alias("txn_count"), F.sum("total_sales").alias("total_sales")))
    grand = F.sum("total_sales").over(Window.partitionBy(F.lit(1)))
    return named.select(
        "region_name", "txn_count", "total_sales",
        F.round(F.lit(100.0) * F.col("total_sales").cast("double") / grand.cast("double"), 2).alias("pct_of_total"))


def h3_mom_growth(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Monthly completed sales, the previous row's sales and the growth in %."""
    per_day = _completed(fact).groupBy("date_key").agg(F.sum("amount").alias("s"))
    monthly = (per_day.join(dates.select("date_key", "year_number", "month_number"), "date_key")
               .groupBy("year_number", "month_number").agg(F.sum("s").alias("monthly_sales")))
    w = Window.orderBy("year_number", "month_number")  # one row per month
    prev = F.lag("monthly_sales").over(w)
    growth = F.round(F.lit(100.0) * (F.col("monthly_sales").cast("double") - F.col("prev_month_sales").cast("double"))
                     / F.nullif(F.col("prev_month_sales").cast("double"), F.lit(0.0)), 2)
    return (monthly.withColumn("prev_month_sales", prev)
            .withColumn("mom_growth_pct", growth)
            .select("year_number", "month_number", "monthly_sales", "prev_month_sales", "mom_growth_pct"))


def h5_dormant_customers(fact: DataFrame, customers: DataFrame, dates: DataFrame, as_of: dt.date,
                         days: int = C.DORMANT_DAYS) -> DataFrame:
    """Current customers with no sale (any status, any version) on or after
    as_of - days; with their last purchase date (NULL if they never bought)."""
    since = as_of - dt.timedelta(days=days)
    versions = customers.select("customer_key", "customer_id")
    calendar = dates.select("date_key", "full_date")
    recent = (fact.filter(F.col("date_key") >= _key(since)).select("customer_key", "date_key")
              .join(calendar, "date_key")
              .filter(F.col("full_date") >= F.lit(since))
              .join(versions, "customer_key").select("customer_id").distinct())
    last_per_key = fact.groupBy("customer_key").agg(F.max("date_key").alias("_dk"))
    last = (last_per_key.join(calendar.withColumnRenamed("date_key", "_dk"), "_dk")
            .join(versions, "customer_key")
            .groupBy("customer_id").agg(F.max("full_date").alias("last_transaction_date")))
    current = customers.filter("is_current").select("customer_id", "customer_name", "customer_email")
    dormant = current.join(recent, "customer_id", "left_anti").join(last, "customer_id", "left")
    return dormant.select(
        "customer_id", "customer_name", "customer_email", "last_transaction_date",
        F.date_diff(F.lit(as_of), F.col("last_transaction_date")).cast("int").alias("days_since_last_txn"))
