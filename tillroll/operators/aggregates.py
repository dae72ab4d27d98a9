"""Curated daily aggregates (completed sales only)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAY_KEYS = ["year", "month", "day", "transaction_date"]


def completed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") == "COMPLETED")


def daily_region_sales(processed: DataFrame) -> DataFrame:
    return (completed(processed).groupBy(*DAY_KEYS, "region")
            .agg(F.count(F.lit(1)).alias("txn_count"),
                 F.sum("amount").alias("total_sales"),
                 F.round(F.avg("amount"), 2).alias("avg_ticket"),
                 F.count_distinct("customer_id").alias("unique_customers")))


def daily_sales(processed: DataFrame) -> DataFrame:
    return (completed(processed).groupBy(*DAY_KEYS)
            .agg(F.count(F.lit(1)).alias("txn_count"),
                 F.sum("amount").alias("total_sales"),
                 F.count_distinct("customer_id").alias("unique_customers")))


def daily_from_region(daily_region: DataFrame) -> DataFrame:
    """Daily totals rolled up from the region grain (counts and sums are
    additive; distinct customers are not, so they are not rolled up)."""
    return (daily_region.groupBy(*DAY_KEYS)
            .agg(F.sum("txn_count").alias("txn_count"), F.sum("total_sales").alias("total_sales")))
