"""Inputs derived from the driver tables by Spark plans.

The reference's own sample files are not available, so every input of the
lake is derived, deterministically, from ``orders``/``customer``/``nation``/
``region``/``events``.  Residues of ``o_orderkey`` decide *which* rows carry
an injected fault; no row is ever dropped, so the work grows with the tables.
The DuckDB twins of these plans live in ``tillroll.plans.oracle``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.columns import padded
from tillroll.sources.tables import read_table


def _k() -> Column:
    return F.col("o_orderkey")


def stg_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed-layer stand-in: one clean, unique transaction per order."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                                   "o_totalprice", "o_orderdate")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation/region are fixed-size reference tables; the optimizer broadcasts
    # them from their file size.  orders x customer is a shuffled join.
    j = (o.join(c, o.o_custkey == c.c_custkey)
         .join(n, c.c_nationkey == n.n_nationkey)
         .join(r, n.n_regionkey == r.r_regionkey))
    k = _k()
    return j.select(
        F.concat(F.lit("RT"), padded(k, 10)).alias("transaction_id"),
        F.concat(F.lit("C"), padded(F.col("o_custkey"), 6)).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("customer_email"),
        F.upper(F.col("r_name")).alias("region"),
        F.concat(F.lit("S"), padded(k % 40 + 1, 3)).alias("store_id"),
        F.concat(F.lit("P"), padded(k % 500 + 1, 4)).alias("product_id"),
        (k % 9 + 1).cast("int").alias("quantity"),
        F.concat((k % 50 + 1).cast("string"), F.lit("."), padded(k % 100, 2)).cast("decimal(12,2)").alias("unit_price"),
        F.col("o_totalprice").cast("decimal(14,2)").alias("amount"),
        F.lit("INR").alias("currency"),
        F.when(k % 4 == 0, "CARD").when(k % 4 == 1, "UPI").when(k % 4 == 2, "CASH").otherwise("WALLET").alias("payment_method"),
        F.when(F.col("o_orderstatus") == "P", "PENDING").otherwise("COMPLETED").alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("transaction_ts"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fault fixture in landing form: all-text columns plus ``ingest_date``.

    Every order lands once (v = 1); every 23rd order lands a second, corrected
    version (v = 2, pending -> completed) later the same day.  Blank ids,
    missing customers, bad regions/amounts/dates and padded text are injected
    by residues of the order key.
    """
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                                   "o_totalprice", "o_orderdate")
    first = o.withColumn("v", F.lit(1))
    second = o.filter(_k() % 23 == 0).withColumn("v", F.lit(2))
    q = first.unionByName(second)
    k = _k()
    ck = F.col("o_custkey")
    y = F.year("o_orderdate").cast("string")
    m = padded(F.month("o_orderdate"), 2)
    d = padded(F.dayofmonth("o_orderdate"), 2)
    v = F.col("v")
    return q.select(
        F.when(k % 97 == 1, F.lit("  ")).otherwise(F.concat(F.lit("RT"), padded(k, 10))).alias("transaction_id"),
        F.when(k % 89 == 2, F.lit(None).cast("string")).otherwise(F.concat(F.lit("C"), padded(ck, 6))).alias("customer_id"),
        F.concat(F.lit("Customer#"), padded(ck, 9)).alias("customer_name"),
        F.when(k % 59 == 8, F.lit("   ")).otherwise(
            F.concat(F.lit("customer."), padded(ck, 9), F.lit("@example.com"))).alias("customer_email"),
        F.when(k % 83 == 3, F.lit("ATLANTIS")).when(k % 2 == 0, F.lit(" north")).otherwise(F.lit("South ")).alias("region"),
        F.concat(F.lit("S"), padded(k % 40 + 1, 3)).alias("store_id"),
        F.concat(F.lit("P"), padded(k % 500 + 1, 4)).alias("product_id"),
        F.when(k % 61 == 7, F.lit("two")).otherwise((k % 9 + 1).cast("string")).alias("quantity"),
        F.concat((k % 50 + 1).cast("string"), F.lit("."), padded(k % 100, 2)).alias("unit_price"),
        F.when(k % 79 == 4, F.lit("n/a")).when(k % 73 == 5, F.lit("-5.00"))
         .otherwise(F.col("o_totalprice").cast("decimal(14,2)").cast("string")).alias("amount"),
        F.when(k % 7 == 0, F.lit(" ")).otherwise(F.lit("INR")).alias("currency"),
        F.when(k % 4 == 0, "CARD").when(k % 4 == 1, "UPI").when(k % 4 == 2, "CASH").alias("payment_method"),
        F.when(v == 2, F.lit("completed")).when((k % 23 == 0) | (F.col("o_orderstatus") == "P"), F.lit("pending"))
         .otherwise(F.lit("completed")).alias("status"),
        F.when(k % 71 == 6, F.lit("31/02/2001 10:00"))
         .when(k % 3 == 0, F.concat(y, F.lit("-"), m, F.lit("-"), d, F.lit(" 10:11:12")))
         .when(k % 3 == 1, F.concat(d, F.lit("/"), m, F.lit("/"), y, F.lit(" 10:11")))
         .otherwise(F.concat(y, F.lit("-"), m, F.lit("-"), d, F.lit("T10:11:12Z"))).alias("transaction_ts"),
        F.concat(y, F.lit("-"), m, F.lit("-"), d, F.lit(" 2"), v.cast("string"), F.lit(":00:00")).alias("ingest_ts"),
        F.col("o_orderdate").cast("date").alias("ingest_date"),
        v.alias("version"),
    )


def customer_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer attributes as seen on each transaction, with real changes.

    Every 5th customer moves to a new e-mail domain from 1998 on; every 7th
    customer moves to another region from 2000 on.  This is the input of the
    SCD2 history (one version per change).
    """
    s = stg_transactions(spark, sf_dir)
    ck = F.substring(F.col("customer_id"), 2, 10).cast("long")
    late_email = (ck % 5 == 0) & (F.col("transaction_date") >= F.lit("1998-01-01").cast("date"))
    moved = (ck % 7 == 0) & (F.col("transaction_date") >= F.lit("2000-01-01").cast("date"))
    return s.select(
        "transaction_id", "customer_id", "customer_name",
        F.when(late_email, F.replace(F.col("customer_email"), F.lit("@example.com"), F.lit("@mail.example.org")))
         .otherwise(F.col("customer_email")).alias("customer_email"),
        F.when(moved & (F.col("region") == "EUROPE"), F.lit("ASIA")).when(moved, F.lit("EUROPE"))
         .otherwise(F.col("region")).alias("home_region_code"),
        "transaction_ts", "transaction_date",
    )
