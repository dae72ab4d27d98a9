"""Plan shape: the physical choices the design relies on."""
import pytest
from pyspark.sql import functions as F

from tillroll.plans import catalog_star, lake_inputs as L


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_reduces_before_shuffle(spark, sf_small):
    good, _ = L.good_bad(spark, sf_small)
    p = _plan(L.deduped(good))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_dormant_uses_anti_join(spark, sf_small):
    df = catalog_star.h5(spark, sf_small)
    df.collect()
    assert "LeftAnti" in _plan(df)


def test_h2_pushes_date_key_range_into_scan(spark, sf_small):
    df = catalog_star.h2(spark, sf_small)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in p and "date_key" in p


def test_dim_customer_keys_without_single_partition(spark, sf_small):
    """The only single-partition exchange is over the per-partition counts
    (one row per partition), never over customer rows."""
    df = catalog_star.dim_customer_q(spark, sf_small)
    lines = _plan(df).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "keys=[_pid" in lines[i + 1], lines[i:i + 3]


def test_landing_filter_is_partition_pruned(spark, sf_small):
    from tillroll.sources.landing import extract, landing_for
    L.raw(spark, sf_small)
    df = extract(spark, landing_for(spark, sf_small), watermark="1998-06-30").select("transaction_id")
    p = _plan(df)
    assert "PartitionFilters" in p and "ingest_date" in p
    assert F is not None


def test_bucketed_star_aggregates_and_joins_without_shuffling_the_fact(spark, sf_small):
    from tillroll.plans import star_inputs as SI

    t = SI.bucketed_tables(spark, sf_small, 8)
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force the shuffle-join path
    try:
        per_key = t["fact"].groupBy("customer_key").agg(F.sum("amount").alias("s"))
        joined = per_key.join(t["dim_customer"], "customer_key")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert "Exchange hashpartitioning(customer_key" not in plan, plan
        assert joined.count() == t["dim_customer"].join(
            t["fact"].select("customer_key").distinct(), "customer_key").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)


DATA_SIZED = ["standardise", "dq_reasons", "dedup_latest", "run_metrics", "daily_region_sales", "daily_sales",
              "dim_customer", "scd2_history", "scd2_asof", "fact_load", "h4a_duplicate_keys", "h4b_duplicate_rows",
              "h5_dormant_customers", "alarm_no_data", "alarm_stream_lag", "event_parse"]


@pytest.mark.parametrize("key", DATA_SIZED)
def test_no_single_partition_over_data(spark, sf_small, key):
    """Queries over fact-sized inputs never gather rows into one partition.
    Single-partition exchanges are allowed only over one row per partition:
    the offsets of the dense-key step, or the partial results of a global
    aggregate (``keys=[]``) being merged."""
    from tillroll.plans.catalog import _ALL

    df = _ALL[key](spark, sf_small)
    df.write.format("noop").mode("overwrite").save()
    lines = _plan(df).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            nxt = lines[i + 1]
            assert "keys=[_pid" in nxt or "HashAggregate(keys=[]," in nxt, (key, lines[i:i + 3])
