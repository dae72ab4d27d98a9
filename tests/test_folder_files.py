"""Files a folder of the queries' tables: as many as its rows ask for, however
many tasks hold rows of it."""
import datetime as dt
import glob
from collections import Counter

import pytest

from tillroll.session import scratch_path


@pytest.fixture
def orders(spark):
    """Tables of 400 orders on four days, two of them before the newer layout."""
    days = [dt.datetime(1997, 6, 3), dt.datetime(1997, 6, 4), dt.datetime(1998, 7, 5), dt.datetime(1999, 7, 5)]
    rows = [(k, k % 9, "F", 10.0 + k, days[k % 4]) for k in range(400)]
    sf = scratch_path(spark, "t-orders")
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp") \
        .write.parquet(f"{sf}/orders.parquet")
    option = "spark.sql.adaptive.coalescePartitions.enabled"  # rows of every day in every task
    before = spark.conf.get(option)
    spark.conf.set(option, "false")
    yield sf
    spark.conf.set(option, before)


def _per_folder(path: str) -> Counter:
    return Counter(f.rsplit("/", 1)[0] for f in glob.glob(f"{path.removeprefix('file:')}/**/*.parquet", recursive=True))


def test_drift_input_has_a_file_a_day(spark, orders, monkeypatch):
    from tillroll.plans import catalog_lake

    paths, report = [], catalog_lake.schema_drift
    monkeypatch.setattr(catalog_lake, "schema_drift", lambda s, path, *rest: paths.append(path) or report(s, path, *rest))
    got = {(r.folder, r.column_name): r.status for r in catalog_lake.schema_drift_q(spark, orders).collect()}
    assert got["1997", "currency"] == "missing" and got["1997", "amount"] == "type_changed" and got["1997", "status"] == "ok"
    assert got["1998", "channel"] == got["1999", "channel"] == "unexpected" and got["1999", "amount"] == "ok"
    files = _per_folder(paths[0])
    assert len(files) == 4 and set(files.values()) == {1}


def test_a_first_merge_stages_its_rows_once(spark, monkeypatch):
    """Without a processed layer the latest versions are staged, indexed and
    written; later merges find them."""
    from pyspark.sql import functions as F

    from tillroll import schemas
    from tillroll.operators import lake

    names = []
    monkeypatch.setattr(lake, "scratch_path", lambda s, name: names.append(name) or scratch_path(s, name))
    option = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(option)
    given = [("A", 3, 1), ("A", 4, 2), ("B", 3, 1), ("C", 5, 1)]  # id, day of June, version

    def rows(values):
        at = lambda day, hour: F.make_timestamp(F.lit(1997), F.lit(6), day, hour, F.lit(0), F.lit(0))
        df = spark.createDataFrame(values, "transaction_id string, d int, v int")
        df = df.withColumns({"transaction_ts": at(F.col("d"), F.lit(1)), "ingest_ts": at(F.col("d"), F.col("v"))})
        have = [*df.columns, "transaction_date", "year", "month", "day"]
        return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.PROCESSED.fields if f.name not in have])

    def table():
        return sorted((r.transaction_id, r.day) for r in lake.read_processed(spark, path).collect())

    path = scratch_path(spark, "t-first-merge")
    first = lake.merge_into_processed(spark, rows(given), path)
    assert names == ["merge-new"]
    assert first == lake.Merged([("1997", "06", "03"), ("1997", "06", "04"), ("1997", "06", "05")], [], 3)
    assert table() == [("A", "04"), ("B", "03"), ("C", "05")]
    moved = lake.merge_into_processed(spark, rows([("C", 6, 2)]), path)
    assert moved.emptied == [("1997", "06", "05")] and table() == [("A", "04"), ("B", "03"), ("C", "06")]
    assert spark.conf.get(option) == before
