"""A secondary index of a partitioned Parquet table: in which partition folders
a key may lie.

The index is a folder inside the table that Spark's readers of the table skip
(its name begins with an underscore): rows (key, partition columns) in
``BUCKETS`` hash buckets.  A merge asks it for the folders that hold its keys and
so never reads the key column of folders it does not touch; a small increment
reads the buckets of its keys only.

Entries are written before the data they point to and never removed, so after a
failure between the two the index names a folder too many, never one too few; a
folder too many costs reading it.  ``rebuild`` makes it from the table anew, for
tables written by others and to drop entries of moved keys; ``write_partitioned``
drops an index that it may have made stale.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.session import scratch_path
from tillroll.sources.files import delete_path, path_exists, rename_path

FOLDER, BUCKETS = "_key_index", 64


def _path(table: str) -> str:
    return f"{table}/{FOLDER}"


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(BUCKETS)).cast("int").alias("bucket")


def _append(entries: DataFrame, path: str) -> None:
    entries.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(path)


def _entries(rows: DataFrame, key: str, parts: Sequence[str], unique: bool = False) -> DataFrame:
    entries = rows.select(key, *parts, _bucket(key))
    return entries if unique else entries.distinct()


def _read(spark: SparkSession, table: str, schema: T.StructType, key: str, parts: Sequence[str]) -> DataFrame:
    fields = [schema[c] for c in (key, *parts)]
    return spark.read.schema(T.StructType([*fields, T.StructField("bucket", T.IntegerType())])).parquet(_path(table))


def rebuild(spark: SparkSession, table: str, schema: T.StructType, key: str, parts: Sequence[str]) -> None:
    """The index of everything the table holds (one scan of its key column),
    made beside the old one and put in its place."""
    new = f"{table}/{FOLDER}_new"
    delete_path(spark, new)
    _append(_entries(spark.read.schema(schema).parquet(table), key, parts), new)
    drop(spark, table)
    rename_path(spark, new, _path(table))


def drop(spark: SparkSession, table: str) -> None:
    """Forget the index: the next merge makes it anew."""
    delete_path(spark, _path(table))


def ready(spark: SparkSession, table: str) -> bool:
    return path_exists(spark, f"{_path(table)}/_SUCCESS")


def lookup(spark: SparkSession, table: str, keys: DataFrame, schema: T.StructType, key: str, parts: Sequence[str]) -> DataFrame:
    """The index entries (key, partition columns, bucket) of ``keys`` (key)."""
    wanted = keys.select(key).distinct()
    buckets = [r[0] for r in wanted.select(_bucket(key)).distinct().collect()]  # at most BUCKETS
    index = _read(spark, table, schema, key, parts).where(F.col("bucket").isin(buckets) if buckets else F.lit(False))
    return index.join(wanted, key, "left_semi")


def folders_of(spark: SparkSession, table: str, rows: DataFrame, schema: T.StructType, key: str, parts: Sequence[str],
               unique: bool = False) -> DataFrame:
    """The partition folders (with repeats) that may hold the keys of ``rows``
    (key, partition columns), after noting in the index where ``rows`` will lie.
    A table without an index gets one first.  ``unique``: no key is in two rows,
    so the entries need no shuffle to be distinct."""
    exists = path_exists(spark, table)
    if exists and not ready(spark, table):
        rebuild(spark, table, schema, key, parts)
    own = _entries(rows, key, parts, unique)
    if not exists:
        _append(own, _path(table))
        return own.select(*parts).limit(0)
    found_path = scratch_path(spark, "key-index-found")
    lookup(spark, table, rows, schema, key, parts).write.parquet(found_path)  # as many rows as the increment, but for moved keys
    found = spark.read.schema(own.schema).parquet(found_path)
    _append(own.join(found, own.columns, "left_anti"), _path(table))
    return found.select(*parts)
