"""Hot keys: one key holding a third of the rows must give exact results."""
import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.operators import star as S
from tillroll.operators.dedup import duplicate_rows, latest_per_key


def _skewed(spark, n=30000):
    ids = F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("K"), (F.col("id") % 5000).cast("string")))
    return spark.range(n).select(
        ids.alias("transaction_id"),
        (F.lit(dt.datetime(2024, 1, 1)) + F.make_interval(secs=F.col("id"))).alias("ingest_ts"),
        F.col("id").alias("payload"))


def test_latest_per_key_with_hot_key(spark):
    df = _skewed(spark)
    got = latest_per_key(df).select("transaction_id", "payload")
    ref = (df.withColumn("rn", F.row_number().over(Window.partitionBy("transaction_id").orderBy(F.col("ingest_ts").desc())))
           .filter("rn = 1").select("transaction_id", "payload"))
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0
    assert got.filter(F.col("transaction_id") == "HOT").first()["payload"] == 29997


def test_duplicate_rows_with_hot_key(spark):
    df = _skewed(spark, 9000).withColumn("status", F.lit("X"))
    got = duplicate_rows(df, tiebreak=["payload"]).select("transaction_id", "payload", "rn", "copies")
    w = Window.partitionBy("transaction_id")
    ref = (df.withColumn("rn", F.row_number().over(w.orderBy(F.col("ingest_ts").desc(), "payload")).cast("long"))
           .withColumn("copies", F.count(F.lit(1)).over(w)).filter("copies > 1")
           .select("transaction_id", "payload", "rn", "copies"))
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_asof_lookup_with_hot_customer(spark):
    days = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("C_HOT")).otherwise(F.concat(F.lit("C"), (F.col("id") % 300).cast("string"))).alias("customer_id"),
        F.concat(F.lit("T"), F.col("id").cast("string")).alias("transaction_id"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 900).cast("int")).alias("transaction_date"))
    feed = days.select(
        "customer_id", "transaction_id", "transaction_date",
        F.lit("n").alias("customer_name"),
        F.concat(F.lit("e"), (F.year("transaction_date")).cast("string")).alias("customer_email"),
        F.lit("R").alias("home_region_code"),
        F.col("transaction_date").cast("timestamp").alias("transaction_ts"))
    hist = S.scd2_history(feed)
    hot_versions = hist.filter(F.col("customer_id") == "C_HOT").count()
    assert hot_versions == 3  # one per calendar year of e-mail
    j = S.scd2_lookup(feed.select("transaction_id", "customer_id", "transaction_date"), hist)
    assert j.count() == feed.count()
    wrong = j.filter(F.col("dim_customer_email") != F.concat(F.lit("e"), F.year("transaction_date").cast("string")))
    assert wrong.count() == 0
