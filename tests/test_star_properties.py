"""SCD2 invariants, dense keys and as-of lookups."""
import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.operators import star as S
from tillroll.operators.positions import with_position
from tillroll.plans import star_inputs as SI


def test_scd2_history_invariants(spark, sf_small):
    h = S.scd2_history(SI.feed(spark, sf_small))
    assert h.filter("effective_to < effective_from").count() == 0
    cur = h.filter("is_current").groupBy("customer_id").count()
    assert cur.filter("count <> 1").count() == 0
    assert cur.count() == h.select("customer_id").distinct().count()
    w = Window.partitionBy("customer_id").orderBy("effective_from")
    gaps = h.withColumn("nxt", F.lead("effective_from").over(w)).filter(
        F.col("nxt").isNotNull() & (F.date_add("effective_to", 1) != F.col("nxt")))
    assert gaps.count() == 0  # contiguous, no overlaps
    assert h.select("customer_key").distinct().count() == h.count()


def test_scd2_apply_same_feed_twice_changes_nothing(spark, sf_small):
    f = SI.feed(spark, sf_small)
    day = f.filter(F.col("transaction_date") >= F.lit(SI.SCD2_CUTOFF)).agg(F.min("transaction_date")).first()[0]
    dim = S.scd2_history(f.filter(F.col("transaction_date") < F.lit(SI.SCD2_CUTOFF))).checkpoint()
    once = S.scd2_apply(dim, f, day).checkpoint()
    twice = S.scd2_apply(once, f, day)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_scd2_same_day_change_updates_in_place(spark, sf_small):
    f = SI.feed(spark, sf_small)
    day = dt.date(2000, 6, 1)
    dim = S.scd2_history(f.filter(F.col("transaction_date") < F.lit(day))).checkpoint()
    one = f.filter(F.col("transaction_date") < F.lit(day)).limit(1).withColumn("transaction_date", F.lit(day))
    first = S.scd2_apply(dim, one.withColumn("customer_email", F.lit("a@x.org")), day).checkpoint()
    second = S.scd2_apply(first, one.withColumn("customer_email", F.lit("b@x.org")), day)
    cid = one.first()["customer_id"]
    versions = second.filter(F.col("customer_id") == cid)
    assert versions.filter("effective_to < effective_from").count() == 0
    assert versions.filter("is_current").select("customer_email").first()[0] == "b@x.org"
    assert versions.count() == first.filter(F.col("customer_id") == cid).count()


def test_positions_equal_row_number_with_hot_key(spark):
    df = spark.range(0, 5000).select((F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))).alias("k"),
                                     F.col("id"))
    got = with_position(df, ["k", "id"], "pos", partitions=7)
    ref = df.withColumn("pos", F.row_number().over(Window.orderBy("k", "id")).cast("long"))
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_fact_lookup_hits_exactly_one_version(spark, sf_small):
    f = SI.feed(spark, sf_small)
    h = S.scd2_history(f)
    j = S.scd2_lookup(f.select("transaction_id", "customer_id", "transaction_date"), h)
    assert j.count() == f.count()
    assert j.select("transaction_id").distinct().count() == f.count()


def test_star_views_answer_sql(spark, sf_small):
    """The star registered as views: a SQL statement over them equals the
    DataFrame implementation (monthly completed sales, H3's first step)."""
    from tillroll.operators import analytics as A

    t = SI.register_views(spark, sf_small)
    sql = spark.sql("""
        SELECT d.year_number, d.month_number, SUM(f.amount) AS monthly_sales
        FROM fact_transactions f JOIN dim_date d ON d.date_key = f.date_key
        WHERE f.status = 'COMPLETED' GROUP BY d.year_number, d.month_number""")
    df = A.h3_mom_growth(t["fact"], t["dim_date"]).select("year_number", "month_number", "monthly_sales")
    assert sql.exceptAll(df).count() == 0 and df.exceptAll(sql).count() == 0


def test_scd2_same_day_change_to_null_is_kept(spark, sf_small):
    """An in-place update may set an attribute to NULL."""
    f = SI.feed(spark, sf_small)
    day = dt.date(2000, 6, 1)
    dim = S.scd2_history(f.filter(F.col("transaction_date") < F.lit(day))).checkpoint()
    one = f.filter(F.col("transaction_date") < F.lit(day)).limit(1).withColumn("transaction_date", F.lit(day))
    first = S.scd2_apply(dim, one.withColumn("customer_email", F.lit("a@x.org")), day).checkpoint()
    second = S.scd2_apply(first, one.withColumn("customer_email", F.lit(None).cast("string")), day)
    cid = one.first()["customer_id"]
    cur = second.filter((F.col("customer_id") == cid) & F.col("is_current")).select("customer_email").collect()
    assert [r[0] for r in cur] == [None]


def test_fact_merge_moves_keys_empties_partitions_and_drops_repeats(spark):
    from tillroll.operators.star import merge_by_key
    from tillroll.session import scratch_path
    from tillroll.sources.files import list_dirs

    path = scratch_path(spark, "t-fact-merge")
    schema = "transaction_id string, amount int, month int"
    merge_by_key(spark, path, spark.createDataFrame([("A", 1, 202401), ("B", 2, 202402)], schema), "transaction_id", ["month"])
    moved = spark.createDataFrame([("A", 5, 202402), ("A", 4, 202402), ("C", 1, 202403)], schema)
    for _ in range(2):  # again: the same table
        got = merge_by_key(spark, path, moved, "transaction_id", ["month"])
        assert sorted(tuple(r) for r in got.select("transaction_id", "amount", "month").collect()) == [("A", 5, 202402), ("B", 2, 202402), ("C", 1, 202403)]
    assert sorted(list_dirs(spark, path)) == ["month=202402", "month=202403"]


def test_scd2_takes_days_in_any_order(spark):
    import datetime as dt

    from tillroll import config as C
    from tillroll.operators.star import CUSTOMER_ATTRS, scd2_apply, scd2_lookup

    d = lambda m, day=1: dt.date(2024, m, day)
    feed = spark.createDataFrame([("K", "n", e, "NORTH", day, dt.datetime(day.year, day.month, day.day, 9)) for e, day in
                                  (("jan", d(1)), ("mar", d(3)), ("feb", d(2)), ("old", dt.date(2023, 6, 1)))],
                                 "customer_id string, customer_name string, customer_email string, region string, transaction_date date, transaction_ts timestamp")
    feed = feed.withColumn("home_region_code", F.col("region")).withColumn("ingest_ts", F.col("transaction_ts")).withColumn("transaction_id", F.col("customer_email"))
    dim = spark.createDataFrame([], "customer_key long, customer_id string, " + ", ".join(f"{c} string" for c in CUSTOMER_ATTRS)
                                + ", effective_from date, effective_to date, is_current boolean")
    for day in (d(1), d(3), d(2), dt.date(2023, 6, 1), d(2)):
        dim = scd2_apply(dim, feed, day).checkpoint()
    got = [(r.customer_email, r.effective_from, r.effective_to, r.is_current) for r in dim.orderBy("effective_from").collect()]
    assert got == [("old", dt.date(2023, 6, 1), dt.date(2023, 12, 31), False), ("jan", d(1), d(1, 31), False),
                   ("feb", d(2), d(2, 29), False), ("mar", d(3), C.OPEN_END_DATE, True)]
    assert scd2_lookup(feed.select("customer_id", "transaction_date"), dim).count() == 4


def _feed(spark, rows):
    """rows: (customer, name, e-mail, region, day of 2024 from 0)"""
    start = dt.date(2024, 1, 1)
    data = [(c, n, e, r, start + dt.timedelta(days=i), dt.datetime(2024, 1, 1, 9) + dt.timedelta(days=i, minutes=at)) for at, (c, n, e, r, i) in enumerate(rows)]
    df = spark.createDataFrame(data, "customer_id string, customer_name string, customer_email string, home_region_code string, transaction_date date, transaction_ts timestamp")
    return df.withColumn("transaction_id", F.concat("customer_id", F.col("transaction_ts").cast("string")))


def _versions(df):
    return sorted((tuple(r) for r in df.drop("customer_key").collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_spliced_days_equal_the_history(spark, seed):
    """All days in one splice, shuffled, and in consecutive pieces."""
    rnd = random.Random(seed)
    rows = [(f"C{rnd.randrange(6)}", rnd.choice("xyz"), rnd.choice(["a", "b", None]), rnd.choice(["N", "S"]), rnd.randrange(20)) for _ in range(90)]
    feed = _feed(spark, rows)
    whole = S.scd2_history(feed)
    empty = whole.limit(0)
    assert _versions(S.scd2_splice(empty, feed.orderBy(F.rand(seed)))) == _versions(whole)
    dim = empty
    for lo, hi in ((0, 3), (3, 11), (11, 20)):
        part = feed.filter(F.col("transaction_date").between(F.lit(dt.date(2024, 1, 1) + dt.timedelta(days=lo)), F.lit(dt.date(2024, 1, 1) + dt.timedelta(days=hi - 1))))
        before = dim
        dim = S.scd2_splice(dim, part).checkpoint()
        assert dim.select("customer_key").distinct().count() == dim.count()
        # a version that existed keeps its key and start
        assert before.join(dim, ["customer_key", "customer_id", "effective_from"], "left_anti").count() == 0
    assert _versions(dim) == _versions(whole)
    again = S.scd2_splice(dim, feed)
    assert again.exceptAll(dim).count() == 0 and dim.exceptAll(again).count() == 0


def test_late_days_move_split_and_leave_alone(spark):
    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i)
    dim = S.scd2_history(_feed(spark, [("K", "n", "a", "N", 5), ("K", "n", "b", "N", 10), ("Q", "n", "q", "S", 7)])).checkpoint()
    keys = {(r.customer_id, r.customer_email): r.customer_key for r in dim.collect()}
    late = _feed(spark, [("K", "n", "a", "N", 2),   # the state of the first version: it begins earlier
                         ("K", "n", "a", "N", 7),   # no change
                         ("K", "n", "c", "N", 8),   # splits it
                         ("K", "m", "d", "N", 10)])  # the second version changes on its own first day
    got = S.scd2_splice(dim, late).orderBy("customer_id", "effective_from").collect()
    assert [(r.customer_id, r.customer_email, r.effective_from, r.is_current) for r in got] == [
        ("K", "a", day(2), False), ("K", "c", day(8), False), ("K", "d", day(10), True), ("Q", "q", day(7), True)]
    assert [got[0].customer_key, got[2].customer_key, got[3].customer_key] == [keys["K", "a"], keys["K", "b"], keys["Q", "q"]]
    assert got[1].customer_key == max(keys.values()) + 1
    assert [r.effective_to for r in got[:2]] == [day(7), day(9)]


def test_calendar_over_a_given_range(spark):
    rows = S.dim_date_between(spark, dt.date(2023, 12, 30), dt.date(2024, 3, 1)).orderBy("date_key").collect()
    assert [r["full_date"] for r in rows] == [dt.date(2023, 12, 30) + dt.timedelta(days=i) for i in range(63)]
    assert {r["date_key"] for r in rows} >= {20231231, 20240229}


def test_stored_fact_is_laid_out_by_date(spark, sf_small):
    """Files hold disjoint date ranges, so the range that H2 and H5 push down skips most of them."""
    fact = SI.tables(spark, sf_small)["fact"].withColumn("f", F.col("_metadata.file_path"))
    spans = fact.groupBy("f").agg(F.min("date_key").alias("lo"), F.max("date_key").alias("hi")).orderBy("lo").collect()
    assert all(a["hi"] <= b["lo"] for a, b in zip(spans, spans[1:]))
    assert fact.where("load_ts IS NULL").count() == 0


def test_dimensions_start_no_job_of_their_own(spark, sf_small):
    tracker = spark.sparkContext.statusTracker()
    SI.dimension(spark, sf_small, "dim_date")  # listing and schema of the source tables
    spark.sparkContext.setJobGroup("dims", "plan only")
    SI.dimension(spark, sf_small, "dim_date")
    SI.dimension(spark, sf_small, "dim_region")
    jobs = tracker.getJobIdsForGroup("dims")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 16  # schema inference of the tables read, none that reads rows
