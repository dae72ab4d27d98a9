"""Properties of the lake: split, dedup, merge, partitions, curated, batch run."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillroll import config as C
from tillroll import schemas
from tillroll.operators import aggregates as agg
from tillroll.operators.lake import merge_into_processed, read_processed
from tillroll.operators.quality import RejectRatioExceeded, check_reject_ratio, write_quarantine
from tillroll.plans import lake_inputs as L
from tillroll.plans.batch import BatchPaths, run_batch
from tillroll.session import scratch_path
from tillroll.sources.files import list_dirs
from tillroll.sources.landing import read_watermark, write_landing


def test_good_plus_bad_is_raw(spark, sf_small):
    good, bad = L.good_bad(spark, sf_small)
    assert good.count() + bad.count() == L.raw(spark, sf_small).count()


def test_dq_rules_all_present_and_ordered(spark, sf_small):
    _, bad = L.good_bad(spark, sf_small)
    seen = {r for row in bad.select("dq_errors").collect() for r in row[0]}
    assert {"missing_transaction_id", "missing_customer_id", "invalid_or_missing_date",
            "non_positive_amount", "invalid_region"} <= seen


def test_reject_ratio_breaker_is_strict():
    assert check_reject_ratio(100, 10) == pytest.approx(0.10)
    with pytest.raises(RejectRatioExceeded):
        check_reject_ratio(100, 11)


def test_dedup_keeps_latest_and_unique(spark, sf_small):
    good, _ = L.good_bad(spark, sf_small)
    d = L.deduped(good)
    assert d.count() == d.select("transaction_id").distinct().count()
    # every corrected id (two versions) keeps the second, completed one
    ids = good.groupBy("transaction_id").count().filter("count > 1").select("transaction_id")
    kept = d.join(ids, "transaction_id").select("status", F.hour("ingest_ts").alias("h")).distinct().collect()
    assert {(r["status"], r["h"]) for r in kept} == {("COMPLETED", 22)}


def test_merge_is_idempotent_and_moves_ids(spark, sf_small):
    good, _ = L.good_bad(spark, sf_small)
    path = scratch_path(spark, "t-merge")
    first = L.deduped(good.filter(L.ingest_hour(21)))
    merge_into_processed(spark, first.drop("source_file", "transaction_date", "year", "month", "day"), path)
    moved = L.moved_slice(good).drop("source_file")
    merge_into_processed(spark, moved, path)
    once = read_processed(spark, path).checkpoint()  # materialised before the files change
    merge_into_processed(spark, moved, path)
    twice = read_processed(spark, path)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
    assert twice.count() == twice.select("transaction_id").distinct().count()
    # moved ids live only in their new day
    m = moved.select("transaction_id", F.to_date("transaction_ts").alias("d"))
    got = twice.join(m, "transaction_id").filter(F.col("transaction_date") != F.col("d")).count()
    assert got == 0
    # folders stay zero-padded strings (no month=6 next to month=06)
    months = {d for y in list_dirs(spark, path) for d in list_dirs(spark, f"{path}/{y}")}
    assert all(len(m.split("=")[1]) == 2 for m in months)


def test_quarantine_rewrite_is_idempotent(spark, sf_small):
    _, bad = L.good_bad(spark, sf_small)
    path = scratch_path(spark, "t-quarantine")
    write_quarantine(bad.drop("source_file"), path)
    write_quarantine(bad.drop("source_file"), path)
    assert spark.read.parquet(path).count() == bad.count()


def test_daily_region_rolls_up_to_daily(spark, sf_small):
    good, _ = L.good_bad(spark, sf_small)
    p = L.deduped(good)
    rolled = agg.daily_from_region(agg.daily_region_sales(p))
    daily = agg.daily_sales(p).select(*agg.DAY_KEYS, "txn_count", "total_sales")
    assert rolled.exceptAll(daily).count() == 0 and daily.exceptAll(rolled).count() == 0


def test_batch_run_incremental_and_rerun(spark, sf_small):
    raw = L.raw(spark, sf_small).drop("source_file")
    src = scratch_path(spark, "t-src")
    cut = dt.date(1998, 1, 1)
    write_landing(raw.filter(F.col("ingest_date") < F.lit(cut)), src)
    root = scratch_path(spark, "t-run")
    paths = BatchPaths(src, f"{root}/processed", f"{root}/curated", f"{root}/quarantine", f"{root}/state")
    m1 = run_batch(spark, paths)
    assert m1 and m1["rows_read"] > 0
    assert run_batch(spark, paths) is None  # no new data: nothing to do
    # a later landing adds days; the run reads only them
    write_landing(raw.filter(F.col("ingest_date") >= F.lit(cut)), f"{src}-2")
    paths2 = BatchPaths(f"{src}-2", paths.processed, paths.curated, paths.quarantine, paths.state)
    m2 = run_batch(spark, paths2)
    assert m2["rows_read"] == raw.filter(F.col("ingest_date") >= F.lit(cut)).count()
    assert read_watermark(spark, paths.state) == str(raw.agg(F.max("ingest_date")).first()[0])
    # processed = latest version per id over everything landed
    good, _ = L.good_bad(spark, sf_small)
    expect = L.deduped(good).select(*schemas.PROCESSED_COLUMNS)
    got = read_processed(spark, paths.processed).select(*schemas.PROCESSED_COLUMNS)
    assert got.exceptAll(expect).count() == 0 and expect.exceptAll(got).count() == 0
    # curated months hold every day of the month
    cur = spark.read.parquet(f"{paths.curated}/daily_sales")
    assert cur.count() == agg.daily_sales(expect).count()


def test_curated_month_keeps_all_days_and_backfill_keeps_watermark(spark, sf_small):
    """D2: a run touching half a month rewrites the month from all its days.
    D5: a backfill of an old day does not move the watermark back."""
    from tillroll.plans.lake_inputs import metrics_per_ingest_day

    raw = L.raw(spark, sf_small).drop("source_file")
    year = raw.filter(F.year("ingest_date") == 1997)
    split = F.lit(dt.date(1997, 6, 16))
    src1, src2 = scratch_path(spark, "t-d2-a"), scratch_path(spark, "t-d2-b")
    write_landing(year.filter(F.col("ingest_date") < split), src1)
    write_landing(year.filter(F.col("ingest_date") >= split), src2)
    root = scratch_path(spark, "t-d2")
    p1 = BatchPaths(src1, f"{root}/processed", f"{root}/curated", f"{root}/quarantine", f"{root}/state")
    run_batch(spark, p1)
    p2 = BatchPaths(src2, p1.processed, p1.curated, p1.quarantine, p1.state)
    run_batch(spark, p2)
    june = (F.col("year") == "1997") & (F.col("month") == "06")
    curated_days = spark.read.parquet(f"{p1.curated}/daily_sales").filter(june).count()
    got_days = read_processed(spark, p1.processed).filter(june & (F.col("status") == "COMPLETED")) \
        .select("transaction_date").distinct().count()
    assert curated_days == got_days
    days = [r[0] for r in spark.read.parquet(f"{p1.curated}/daily_sales").filter(june).select("day").collect()]
    assert min(days) < "16" <= max(days)  # both runs' halves of June survived
    wm = read_watermark(spark, p1.state)
    # backfill an early day whose reject ratio is under the breaker
    ok_days = (metrics_per_ingest_day(L.std(spark, sf_small))
               .filter((F.year("run_ts") == 1997) & (F.month("run_ts") < 6) & (F.col("rows_quarantined") == 0))
               .select(F.to_date("run_ts").alias("d")).orderBy("d").limit(1).collect())
    assert ok_days
    run_batch(spark, p1, run_date=str(ok_days[0]["d"]))
    assert read_watermark(spark, p1.state) == wm


def test_merge_prefers_new_side_on_equal_ingest_stamp(spark, sf_small):
    """D9: a re-sent version with the same ingest stamp replaces the stored one."""
    good, _ = L.good_bad(spark, sf_small)
    path = scratch_path(spark, "t-d9")
    base = L.deduped(good).drop("source_file", "transaction_date", "year", "month", "day")
    merge_into_processed(spark, base, path)
    one = base.limit(1).checkpoint()
    tid = one.first()["transaction_id"]
    merge_into_processed(spark, one.withColumn("status", F.lit("REFUNDED")), path)
    got = read_processed(spark, path).filter(F.col("transaction_id") == tid).select("status").collect()
    assert [r[0] for r in got] == ["REFUNDED"]


def test_extract_is_strictly_after_watermark(spark, sf_small):
    """D6: the watermark day itself is not read again; a backfill reads it."""
    from tillroll.sources.landing import extract, landing_for

    L.raw(spark, sf_small)
    land = landing_for(spark, sf_small)
    day = L.raw(spark, sf_small).agg(F.min("ingest_date")).first()[0]
    inc = extract(spark, land, watermark=day, with_source=False)
    assert inc.filter(F.col("ingest_date") == F.lit(day)).count() == 0
    back = extract(spark, land, run_date=day, watermark=day, with_source=False)
    assert back.count() > 0 and back.filter(F.col("ingest_date") != F.lit(day)).count() == 0


def test_cli_batch_run(spark, sf_small):
    """The command line runs the whole batch job on a landing folder."""
    from tillroll.__main__ import main
    from tillroll.sources.landing import landing_for

    L.raw(spark, sf_small)
    root = scratch_path(spark, "t-cli-batch")
    args = ["batch", "--source_path", landing_for(spark, sf_small), "--processed_path", f"{root}/processed",
            "--curated_path", f"{root}/curated", "--quarantine_path", f"{root}/quarantine",
            "--state_path", f"{root}/state", "--metrics_path", f"{root}/metrics"]
    assert main(args) == 0
    good, _ = L.good_bad(spark, sf_small)
    assert read_processed(spark, f"{root}/processed").count() == L.deduped(good).count()
    m = spark.read.parquet(f"{root}/metrics").first()
    assert m["event"] == "DQ_METRICS" and m["rows_read"] == L.raw(spark, sf_small).count()


def test_files_per_partition(spark, sf_small):
    """Up to N files per folder with a salt; one file per folder by default."""
    from tillroll.operators.lake import file_report, write_partitioned

    good, _ = L.good_bad(spark, sf_small)
    df = L.deduped(good).drop("source_file").filter(F.col("year") == "1997")
    one, three = scratch_path(spark, "t-fpp1"), scratch_path(spark, "t-fpp3")
    write_partitioned(df, one, ["year", "month"])
    write_partitioned(df, three, ["year", "month"], files_per_partition=3)
    r1 = file_report(spark, one, ["year", "month"]).agg(F.max("n_files"), F.sum("n_rows")).first()
    r3 = file_report(spark, three, ["year", "month"]).agg(F.max("n_files"), F.sum("n_rows")).first()
    assert r1[0] == 1 and r3[0] == 3 and r1[1] == r3[1] == df.count()


def test_compaction_leaves_one_file_per_day(spark, sf_small):
    from tillroll import schemas
    from tillroll.operators.lake import file_report
    from tillroll.plans.catalog_lake import _compacted

    path, df = _compacted(spark, sf_small)
    rep = file_report(spark, path, ["year", "month", "day"], schemas.PROCESSED)
    y, m = L.COMPACT_MONTH
    in_month = rep.filter((F.col("year") == y) & (F.col("month") == m)).agg(F.max("n_files")).first()[0]
    elsewhere = rep.filter(~((F.col("year") == y) & (F.col("month") == m))).agg(F.max("n_files")).first()[0]
    assert in_month == 1 and elsewhere > 1


def test_prune_to_partitions_reads_only_their_folders(spark, sf_small):
    import re

    from tillroll.operators.lake import DATE_PARTS, partition_keys, prune_to_partitions, write_partitioned

    good, _ = L.good_bad(spark, sf_small)
    path = scratch_path(spark, "t-prune")
    write_partitioned(L.deduped(good).drop("source_file").filter(F.col("year") == "1999"), path, DATE_PARTS)
    table = read_processed(spark, path)
    keys = partition_keys(table, DATE_PARTS)[:5]
    pruned = prune_to_partitions(table, keys, DATE_PARTS)
    assert re.search(r"PartitionFilters: \[\(?concat_ws", pruned._jdf.queryExecution().executedPlan().toString())
    assert partition_keys(pruned, DATE_PARTS) == keys
    assert prune_to_partitions(table, [], DATE_PARTS).count() == 0


# --- cases that the fixtures do not reach ---------------------------------
def _land(spark, path, rows):
    """rows: (transaction_id, transaction_ts, amount, ingest_date)"""
    values = {"customer_id": "C1", "customer_name": "A B", "customer_email": "a@b.c", "region": "NORTH", "store_id": "S1", "product_id": "P1",
              "quantity": "1", "unit_price": "10.00", "currency": "INR", "payment_method": "CARD", "status": "COMPLETED"}
    full = [tuple({**values, "transaction_id": t, "transaction_ts": ts, "amount": a, "ingest_ts": f"{d} 21:00:00"}.get(c, "x") for c in schemas.RAW_COLUMNS)
            + (dt.date.fromisoformat(d),) for t, ts, a, d in rows]
    write_landing(spark.createDataFrame(full, ", ".join(f"{c} string" for c in schemas.RAW_COLUMNS) + ", ingest_date date"), path)


def _paths(spark, name):
    root = scratch_path(spark, name)
    return BatchPaths(f"{root}/raw", f"{root}/processed", f"{root}/curated", f"{root}/quarantine", f"{root}/state")


def test_curated_forgets_a_sale_that_moved_to_another_month(spark):
    p = _paths(spark, "t-moved")
    _land(spark, p.source, [("RT1", "2024-06-30 10:00:00", "10.00", "2024-07-01")])
    run_batch(spark, p)
    _land(spark, p.source, [("RT1", "2024-07-01 10:00:00", "10.00", "2024-07-02")])
    run_batch(spark, p, run_date="2024-07-02")
    got = spark.read.parquet(f"{p.curated}/daily_sales").select("year", "month", "day", F.col("total_sales").cast("double")).collect()
    assert [(int(r[0]), int(r[1]), int(r[2]), r[3]) for r in got] == [(2024, 7, 1, 10.0)]


def test_a_clean_backfill_clears_the_days_rejects(spark):
    p = _paths(spark, "t-clean-backfill")
    good = [(f"G{i}", "2024-06-30 10:00:00", "10.00", "2024-07-01") for i in range(20)]
    _land(spark, p.source, [*good, ("B1", "2024-06-30 10:00:00", "-1", "2024-07-01")])
    assert run_batch(spark, p)["rows_quarantined"] == 1
    _land(spark, p.source, good)
    assert run_batch(spark, p, run_date="2024-07-01")["rows_quarantined"] == 0
    assert list_dirs(spark, p.quarantine) == []


def test_a_damaged_state_raises_and_a_missing_one_is_a_first_run(spark):
    from tillroll import config as C
    from tillroll.sources.landing import UnreadableState, write_watermark

    state = scratch_path(spark, "t-state")
    assert read_watermark(spark, state) is None
    write_watermark(spark, state, "2024-07-01", {})
    write_watermark(spark, state, "2024-07-02", {})
    assert read_watermark(spark, state) == "2024-07-02"
    spark.createDataFrame([('{"last_ingest_date": "2024-0',)], "value string").write.mode("overwrite").text(f"{state}/{C.STATE_FILE}")
    with pytest.raises(UnreadableState):
        read_watermark(spark, state)


def test_batch_run_leaves_no_staging(spark):
    from tillroll.session import checkpoint_root

    p = _paths(spark, "t-staging")
    _land(spark, p.source, [("RT1", "2024-06-30 10:00:00", "10.00", "2024-07-01")])
    before = set(list_dirs(spark, f"{checkpoint_root(spark)}/tillroll"))
    run_batch(spark, p)
    assert set(list_dirs(spark, f"{checkpoint_root(spark)}/tillroll")) == before


def test_scratch_root_raises_off_a_local_master():
    from tillroll.session import checkpoint_root, is_local

    class Context:
        master = "local-cluster[3,2,1000]"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext, conf = Context(), {}

    assert is_local("local[8]") and is_local("local") and not is_local(Context.master)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def test_drift_tells_contradicting_files_of_a_folder(spark):
    from pyspark.sql import types as T

    from tillroll.operators.lake import schema_drift

    path = scratch_path(spark, "t-drift")
    spark.createDataFrame([("a", 1, "x")], "k string, v int, d string").write.partitionBy("d").parquet(path)
    spark.createDataFrame([("a", 2.5, 7, "y")], "k string, v double, extra int, d string").write.mode("append").partitionBy("d").parquet(path)
    expected = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType()), T.StructField("d", T.StringType())])
    got = {(r.folder, r.column_name): (r.status, r.n_rows) for r in schema_drift(spark, path, expected, ["d"]).collect()}
    assert got == {("x", "k"): ("ok", 1), ("x", "v"): ("ok", 1), ("y", "k"): ("ok", 1), ("y", "v"): ("type_changed", 1), ("y", "extra"): ("unexpected", 1)}
    spark.createDataFrame([("a", "text", "y")], "k string, v string, d string").write.mode("append").partitionBy("d").parquet(path)
    assert ("y", None, "conflicting_files") in {(r.folder, r.column_name, r.status) for r in schema_drift(spark, path, expected, ["d"]).collect()}


def test_compaction_by_bytes(spark):
    """Folders get as many files as their bytes ask for; those that have them stay as they are."""
    import glob
    import os

    from pyspark.sql import types as T

    from tillroll.operators.lake import compact_to_bytes, file_sizes, write_partitioned

    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType()), T.StructField("p", T.IntegerType())])
    rows = spark.range(9000).selectExpr("id AS k", "sha2(cast(id AS string), 256) AS v", "CASE WHEN id < 8000 THEN 1 WHEN id < 8999 THEN 2 ELSE 3 END AS p")
    path = scratch_path(spark, "t-bytes")
    write_partitioned(rows, path, ["p"], files_per_partition=8)
    single = glob.glob(f"{path.replace('file:', '')}/p=3/*.parquet")
    stamp = os.stat(single[0]).st_mtime_ns
    target = 300_000
    done = {r.p: r for r in compact_to_bytes(spark, path, ["p"], schema, target, 600_000).collect()}
    assert set(done) == {1, 2} and done[1].files > 1
    after = {r.p: r for r in file_sizes(spark, path, ["p"], schema).collect()}
    assert {p: after[p].n_files for p in after} == {1: done[1].files, 2: done[2].files, 3: 1}
    assert all(r.largest <= 2 * target for r in after.values())
    assert os.stat(single[0]).st_mtime_ns == stamp
    got = spark.read.schema(schema).parquet(path)
    assert got.exceptAll(rows.select(*schema.names)).count() == 0 and got.count() == 9000
    assert compact_to_bytes(spark, path, ["p"], schema, target, 600_000).count() == 0  # nothing left to do


def test_runs_are_logged(spark, sf_small):
    """A failing run leaves a line in the log and the state as it was."""
    from tillroll.operators.quality import RejectRatioExceeded
    from tillroll.plans.batch import read_log
    from tillroll.sources.files import path_exists
    from tillroll.sources.landing import landing_for

    L.raw(spark, sf_small)
    root = scratch_path(spark, "t-log")
    paths = BatchPaths(landing_for(spark, sf_small), f"{root}/processed", f"{root}/curated", f"{root}/quarantine", f"{root}/state", f"{root}/metrics", f"{root}/log")
    at = dt.datetime(2024, 5, 1, 3, 4, tzinfo=dt.timezone.utc)
    with pytest.raises(RejectRatioExceeded):
        run_batch(spark, paths, cfg=C.LakeConfig(max_reject_ratio=0.001), now=at)
    assert [C.FAILED_RUN_MARKER in r.message for r in read_log(spark, paths.log).collect()] == [True]
    assert not path_exists(spark, paths.processed) and not path_exists(spark, paths.metrics)
    run_batch(spark, paths, run_date=str(L.BACKFILL_DATE), cfg=C.LakeConfig(max_reject_ratio=1.0), now=at)
    assert read_log(spark, paths.log).selectExpr("min(unix_seconds(log_ts))", "max(unix_seconds(log_ts))", "count(*)").first() == (int(at.timestamp()),) * 2 + (2,)
    assert spark.read.parquet(paths.metrics).selectExpr("unix_seconds(run_ts)").first()[0] == int(at.timestamp())


def test_catalog_tables_follow_each_run_and_drift_is_told(spark, sf_small, caplog):
    """Two incremental runs: the three tables hold the folders that exist, also
    after a day was emptied; a file of another layout is told column by column."""
    from tillroll.operators.lake import DATE_PARTS

    raw = L.raw(spark, sf_small).drop("source_file").filter((F.year("ingest_date") == 1997) & (F.month("ingest_date") < 3)).checkpoint()
    src, root, prefix = scratch_path(spark, "t-sync-src"), scratch_path(spark, "t-sync"), f"sync_{dt.datetime.now():%H%M%S%f}_"
    write_landing(raw.filter(F.month("ingest_date") == 1), src)
    paths = BatchPaths(src, f"{root}/processed", f"{root}/curated", f"{root}/quarantine", f"{root}/state", tables=prefix)
    cfg = C.LakeConfig(max_reject_ratio=1.0)
    assert run_batch(spark, paths, cfg=cfg, print_metrics=False)["drifted_columns"] == 0
    write_landing(raw.filter(F.month("ingest_date") == 2), f"{src}-2")
    folder = spark.table(f"{prefix}processed").select(*DATE_PARTS).first()
    read_processed(spark, paths.processed).where((F.col("year") == folder.year)).limit(1).drop("currency").withColumn("channel", F.lit("web")).write.mode(
        "append").partitionBy(*DATE_PARTS).parquet(paths.processed)
    second = run_batch(spark, BatchPaths(f"{src}-2", *[getattr(paths, f) for f in ("processed", "curated", "quarantine", "state")], tables=prefix), cfg=cfg, print_metrics=False)
    assert second["drifted_columns"] >= 1 and "channel" in caplog.text
    for name, path, parts in (("processed", paths.processed, DATE_PARTS), ("daily_sales", f"{paths.curated}/daily_sales", ["year", "month"]),
                              ("daily_region_sales", f"{paths.curated}/daily_region_sales", ["year", "month"])):
        known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {prefix}{name}").collect()}
        found = [""]
        for _ in parts:
            found = [f"{f}/{d}".strip("/") for f in found for d in list_dirs(spark, f"{path}/{f}")]
        assert known == set(found)
        assert spark.table(f"{prefix}{name}").count() == spark.read.schema(spark.table(f"{prefix}{name}").schema).parquet(path).count()
        spark.sql(f"DROP TABLE {prefix}{name}")
