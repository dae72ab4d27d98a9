"""The key index: merges read only folders that hold their keys, and it never
misses one."""
import glob
import random

import pytest
from pyspark.sql import functions as F

from tillroll.operators import key_index
from tillroll.operators.lake import compact, merge_into_processed, read_processed, write_partitioned
from tillroll.operators.star import merge_by_key
from tillroll.session import scratch_path

SCHEMA = "transaction_id string, amount int, month int"


def _rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _table(spark, path):
    return sorted(tuple(r) for r in spark.read.schema(SCHEMA).parquet(path).collect())


def _damage(path, folder):
    """Make the folder's files unreadable, so a test fails if anything reads them."""
    files = glob.glob(f"{path.replace('file:', '')}/{folder}/*.parquet")
    assert files
    for f in files:
        with open(f, "wb") as fh:
            fh.write(b"not parquet")


def test_untouched_folders_are_not_read(spark):
    path = scratch_path(spark, "t-index")
    merge_by_key(spark, path, _rows(spark, [(f"T{i}", i, 202401 + i % 6) for i in range(60)]), "transaction_id", ["month"])
    for month in (202403, 202404, 202405, 202406):
        _damage(path, f"month={month}")
    merge_by_key(spark, path, _rows(spark, [("T0", 100, 202402), ("NEW", 1, 202402)]), "transaction_id", ["month"])
    got = spark.read.schema(SCHEMA).parquet(path).where("month IN (202401, 202402)").collect()
    expected = {(f"T{i}", i, 202401 + i % 6) for i in range(1, 60) if i % 6 < 2} | {("T0", 100, 202402), ("NEW", 1, 202402)}
    assert {tuple(r) for r in got} == expected


def test_the_batch_merge_reads_touched_days_only(spark, sf_small):
    from tillroll.plans import lake_inputs as L

    good, _ = L.good_bad(spark, sf_small)
    path = scratch_path(spark, "t-index-days")
    base = L.deduped(good).drop("source_file", "transaction_date", "year", "month", "day")
    merge_into_processed(spark, base, path)
    one = base.orderBy("transaction_ts", "transaction_id").limit(1).checkpoint()
    day = read_processed(spark, path).select("year", "month", "day").distinct().orderBy(F.desc("year"), F.desc("month"), F.desc("day")).first()
    _damage(path, f"year={day.year}/month={day.month}/day={day.day}")
    merged = merge_into_processed(spark, one.withColumn("status", F.lit("REFUNDED")), path)
    assert len(merged.touched) == 1 and merged.new_rows == 1


def test_few_keys_read_few_buckets(spark):
    path = scratch_path(spark, "t-index-buckets")
    merge_by_key(spark, path, _rows(spark, [(f"T{i}", i, 202401) for i in range(500)]), "transaction_id", ["month"])
    schema = _rows(spark, []).schema
    wanted = _rows(spark, [("T7", 0, 0), ("nobody", 0, 0)])
    need = {r[0] for r in wanted.select(key_index._bucket("transaction_id")).collect()}
    for b in set(range(key_index.BUCKETS)) - need:
        if glob.glob(f"{path.replace('file:', '')}/_key_index/bucket={b}/*.parquet"):
            _damage(path, f"_key_index/bucket={b}")
    found = key_index.lookup(spark, path, wanted, schema, "transaction_id", ["month"])
    assert [tuple(r)[:2] for r in found.collect()] == [("T7", 202401)]


@pytest.mark.parametrize("seed", [0, 1])
def test_merges_in_any_order_equal_a_plain_dictionary(spark, seed):
    rnd, path, held = random.Random(seed), scratch_path(spark, "t-index-random"), {}
    for step in range(6):
        rows = {f"T{rnd.randrange(25)}": (rnd.randrange(1000), 202401 + rnd.randrange(4)) for _ in range(8)}
        merge_by_key(spark, path, _rows(spark, [(k, a, m) for k, (a, m) in rows.items()]), "transaction_id", ["month"])
        held |= rows
        if step == 3:
            key_index.rebuild(spark, path, _rows(spark, []).schema, "transaction_id", ["month"])
        assert _table(spark, path) == sorted((k, a, m) for k, (a, m) in held.items())
    schema = _rows(spark, []).schema
    found = key_index.lookup(spark, path, _rows(spark, [(k, 0, 0) for k in held]), schema, "transaction_id", ["month"])
    assert {(k, m) for k, (_, m) in held.items()} <= {tuple(r)[:2] for r in found.collect()}


def test_tables_written_by_others_and_entries_without_data(spark):
    path, schema = scratch_path(spark, "t-index-other"), _rows(spark, []).schema
    write_partitioned(_rows(spark, [("A", 1, 202401), ("B", 2, 202402)]), path, ["month"])
    assert not key_index.ready(spark, path)
    merge_by_key(spark, path, _rows(spark, [("A", 5, 202402)]), "transaction_id", ["month"])
    assert _table(spark, path) == [("A", 5, 202402), ("B", 2, 202402)] and key_index.ready(spark, path)
    # a run that failed after it noted its keys and before it wrote its data
    key_index.folders_of(spark, path, _rows(spark, [("C", 1, 202403)]), schema, "transaction_id", ["month"])
    merge_by_key(spark, path, _rows(spark, [("C", 1, 202404)]), "transaction_id", ["month"])
    assert _table(spark, path) == [("A", 5, 202402), ("B", 2, 202402), ("C", 1, 202404)]
    compact(spark, path, ["month"], {}, schema=schema)  # keys stay in their folders
    assert key_index.ready(spark, path)
    write_partitioned(_rows(spark, [("D", 9, 202409)]), path, ["month"])  # a backfill beside the merge
    assert not key_index.ready(spark, path)
    merge_by_key(spark, path, _rows(spark, [("D", 8, 202401)]), "transaction_id", ["month"])
    assert ("D", 8, 202401) in _table(spark, path) and ("D", 9, 202409) not in _table(spark, path)
