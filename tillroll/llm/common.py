"""Helpers shared by the training-data operators."""
from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.session import scratch_path

# Words of the contracts: runs of anything but space, tab, newline, VT, FF, CR.
WORD = r"[^\x20\x09-\x0D]+"
ARROW_BYTES = 2 << 20  # of a batch that goes to a Python worker, where ``bound_batches`` holds


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared scratch folder and read it back: lineage
    ends at files that every executor sees, so a lost executor costs one task."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """From now on batches that go to Python workers end at ``ARROW_BYTES``
    (one row, if that is longer), unless the session has a limit set: a task
    holds its batch in the JVM and once more in each worker it feeds, and by
    default that is 10,000 rows or 64 MB."""
    option = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(option, None) is None:
        spark.conf.set(option, str(ARROW_BYTES))


def small(batches: Iterable, rows: int = 256) -> Iterator:
    """The batches in pieces of few rows, so what a task holds as Python
    objects at a time stays small."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def strings(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Spans of an array of UTF-8 bytes as Arrow strings."""
    from tillroll.llm.pretokens import ragged

    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    spans = np.ascontiguousarray(ragged(data, starts, sizes))
    return pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(spans)]).cast(pa.string())


_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers: Spark sends a zip of
    its sources to the executors, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    folder = tempfile.TemporaryDirectory()  # the driver's own: Spark serves the file from it
    path = f"{folder.name}/{root.name}.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(path)
    _SHIPPED[sc.applicationId] = folder


def map_batches(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with this package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def random_key(*cols: Column | str, seed: str = "") -> Column:
    """MD5 of the columns as text: a random order that is the same in every
    run, partitioning and engine.  NULL counts as the empty text."""
    text = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("|", F.lit(seed), *text))


def key_hash(*cols: Column | str, seed: str = "") -> Column:
    """The first 8 bytes of :func:`random_key`."""
    return F.unhex(F.substring(random_key(*cols, seed=seed), 1, 16))


def key_range(key: Column, ranges: Column) -> Column:
    """Which of ``ranges`` equal slices of the key space ``key`` lies in; the
    slices are in key order, so slice then key is the order of the key."""
    return F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * ranges / F.lit(2.0**32)).cast("long")


def running_total(df: DataFrame, by: Sequence[str], order: Sequence[str], value: Column, ranges: int,
                  before: str = "before", total: str = "total", slice_by: Column | None = None) -> DataFrame:
    """Exclusive prefix sums of ``value`` within ``by`` in the order of
    ``order`` (first column: a :func:`random_key`), spread over tasks.

    Each group is cut into ``ranges`` slices of the key space; a window sums
    within a slice and the sums of the slices (``ranges`` rows a group) carry
    over.  No task holds more than a slice, however large a group is.
    """
    slices = df.withColumn("_v", value).withColumn("_slice", key_range(F.col(order[0]), F.lit(ranges)))
    sums = slices.groupBy(*by, "_slice").agg(F.sum("_v").alias("_s"))
    earlier = Window.partitionBy(*by).orderBy("_slice")
    sums = (sums.withColumn("_off", F.sum("_s").over(earlier) - F.col("_s"))
            .withColumn(total, F.sum("_s").over(Window.partitionBy(*by))))
    # eqNullSafe per column: NULL is a group like any other
    sums = sums.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], F.col("_slice").alias("_ks"), "_off", total)
    within = Window.partitionBy(*by, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    on = F.col("_slice") == F.col("_ks")
    for i, c in enumerate(by):
        on = on & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    return (slices.withColumn("_in", F.coalesce(F.sum("_v").over(within), F.lit(0)))
            .join(sums, on)
            .withColumn(before, F.col("_off") + F.col("_in"))
            .drop("_v", "_slice", "_in", "_off", "_ks", *[f"_k{i}" for i in range(len(by))]))


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest id that each node of ``edges`` (a, b)
    reaches.  Alternating large-star and small-star rounds: every node points
    its neighbours to the smallest one, until all of a component point to one.
    Aggregations and joins only; each round is written to the shared folder."""
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    current = save(pairs, f"{name}-0")
    state = None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = (small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        current = save(small, name)
        check = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if check == state:
            break
        state = check
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
