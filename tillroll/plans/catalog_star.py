"""Registered star-schema and analytic queries."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import config as C
from tillroll.operators import analytics as A
from tillroll.operators import star as S
from tillroll.operators.dedup import duplicate_keys, duplicate_rows
from tillroll.plans import lake_inputs as L
from tillroll.plans import star_inputs as SI
from tillroll.schemas import RAW_COLUMNS
from tillroll.session import scratch_path

H4B_TIEBREAK = ["customer_id", "transaction_ts", "amount", "product_id", "store_id", "status"]


def dim_date_q(spark: SparkSession, sf: str) -> DataFrame:
    return SI.dimension(spark, sf, "dim_date")


def dim_region_q(spark: SparkSession, sf: str) -> DataFrame:
    return SI.dimension(spark, sf, "dim_region")


def dim_customer_q(spark: SparkSession, sf: str) -> DataFrame:
    return SI.dimension(spark, sf, "dim_customer")


def fact_load(spark: SparkSession, sf: str) -> DataFrame:
    return SI.fact_load(spark, sf)


def scd2_history_q(spark: SparkSession, sf: str) -> DataFrame:
    return S.scd2_history(SI.feed(spark, sf))


def scd2_apply_q(spark: SparkSession, sf: str) -> DataFrame:
    return SI.scd2_with_increments(spark, sf)


def scd2_asof(spark: SparkSession, sf: str) -> DataFrame:
    f = SI.feed(spark, sf)
    hist = S.scd2_history(f)
    j = S.scd2_lookup(f.select("transaction_id", "customer_id", "transaction_date"), hist)
    return j.select("transaction_id", "customer_id", "transaction_date", "customer_key",
                    F.col("dim_customer_email").alias("customer_email"),
                    F.col("dim_home_region_code").alias("home_region_code"))


def fact_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Existing fact up to 2000, then a re-sent month plus 2001 merged on
    transaction_id, twice (the second run must change nothing)."""
    fact = SI.tables(spark, sf)["fact"].withColumn("month_key", (F.col("date_key") / 100).cast("int"))
    path = scratch_path(spark, "fact-merge")
    existing = fact.filter(F.col("date_key") < SI.FACT_MERGE_EXISTING_BEFORE)
    S.merge_by_key(spark, path, existing, "transaction_id", ["month_key"])
    increment = (fact.filter(F.col("date_key") >= SI.FACT_MERGE_RESENT_FROM)
                 .withColumn("status", F.lit("COMPLETED")))
    S.merge_by_key(spark, path, increment, "transaction_id", ["month_key"])
    out = S.merge_by_key(spark, path, increment, "transaction_id", ["month_key"])
    return out.select(*S.FACT_COLUMNS)


def _star(spark, sf):
    t = SI.tables(spark, sf)
    return t["fact"], t["dim_customer"], t["dim_region"], t["dim_date"]


def fk_orphans_q(spark: SparkSession, sf: str) -> DataFrame:
    return S.fk_orphans(*_star(spark, sf))


def pk_unique_q(spark: SparkSession, sf: str) -> DataFrame:
    return S.pk_unique(*_star(spark, sf))


def constraint_checks(spark: SparkSession, sf: str) -> DataFrame:
    return S.constraint_violations(SI.tables(spark, sf))


def h1(spark: SparkSession, sf: str) -> DataFrame:
    fact, cust, _, _ = _star(spark, sf)
    out = A.h1_top_customers(fact, cust)
    return out.withColumn("total_amount", F.col("total_amount").cast("decimal(24,2)"))


def h2(spark: SparkSession, sf: str) -> DataFrame:
    fact, _, reg, dates = _star(spark, sf)
    out = A.h2_region_sales(fact, reg, dates, SI.AS_OF).withColumn("total_sales", F.col("total_sales").cast("decimal(24,2)"))
    return out.orderBy(F.col("total_sales").desc())


def h3(spark: SparkSession, sf: str) -> DataFrame:
    fact, _, _, dates = _star(spark, sf)
    return (A.h3_mom_growth(fact, dates)
            .withColumn("monthly_sales", F.col("monthly_sales").cast("decimal(24,2)"))
            .withColumn("prev_month_sales", F.col("prev_month_sales").cast("decimal(24,2)"))
            .orderBy("year_number", "month_number"))


def h4a(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_keys(L.raw(spark, sf, with_source=False)).orderBy(F.col("copies").desc(), "transaction_id")


def h4b(spark: SparkSession, sf: str) -> DataFrame:
    raw = L.raw(spark, sf, with_source=False)
    return (duplicate_rows(raw, tiebreak=H4B_TIEBREAK).select(*RAW_COLUMNS, "ingest_date", "rn", "copies")
            .orderBy("transaction_id", "rn"))


def h5(spark: SparkSession, sf: str) -> DataFrame:
    fact, cust, _, dates = _star(spark, sf)
    return A.h5_dormant_customers(fact, cust, dates, SI.AS_OF).orderBy(F.col("last_transaction_date").asc_nulls_first())


def integrity_report(spark: SparkSession, sf: str) -> DataFrame:
    """All integrity checks and result expectations as one table."""
    fact, cust, reg, dates = _star(spark, sf)
    zero = F.col("observed") == 0
    def as_check(df, expectation, passed):
        return df.select("check_name", F.col("violations").cast("long").alias("observed"),
                         F.lit(expectation).alias("expectation")).withColumn("passed", passed)
    def rows(df, name):
        return df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")
    checks = [
        as_check(S.fk_orphans(fact, cust, reg, dates), "= 0", zero),
        as_check(S.pk_unique(fact, cust, reg, dates), "= 0", zero),
        as_check(rows(h1(spark, sf), "h1_rows"), f"= {C.TOP_CUSTOMERS}", F.col("observed") == C.TOP_CUSTOMERS),
        as_check(rows(h2(spark, sf), "h2_rows"), "= 5", F.col("observed") == 5),
        as_check(rows(h4a(spark, sf), "h4a_rows"), "> 0", F.col("observed") > 0),
        as_check(rows(h5(spark, sf), "h5_rows"), "> 0", F.col("observed") > 0),
    ]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


QUERIES = {
    "dim_date": dim_date_q,
    "dim_region": dim_region_q,
    "dim_customer": dim_customer_q,
    "scd2_history": scd2_history_q,
    "scd2_apply": scd2_apply_q,
    "scd2_asof": scd2_asof,
    "fact_load": fact_load,
    "fact_merge": fact_merge,
    "fk_orphans": fk_orphans_q,
    "pk_unique": pk_unique_q,
    "constraint_checks": constraint_checks,
    "integrity_report": integrity_report,
    "h1_top_customers": h1,
    "h2_region_sales_30d": h2,
    "h3_mom_growth": h3,
    "h4a_duplicate_keys": h4a,
    "h4b_duplicate_rows": h4b,
    "h5_dormant_customers": h5,
}
