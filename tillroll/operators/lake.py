"""Processed/curated layers on plain Parquet: partitioned writes, merge,
compaction, file report and schema drift."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import config as C
from tillroll import schemas
from tillroll.operators import key_index
from tillroll.operators.clean import add_date_parts
from tillroll.operators.dedup import latest_per_key
from tillroll.session import folders_listed_together, scratch_path, small_tasks_apart
from tillroll.sources.files import delete_path, list_dirs, path_exists

DATE_PARTS = ["year", "month", "day"]


def write_partitioned(df: DataFrame, path: str, partitions: Sequence[str],
                      max_records_per_file: int = C.LakeConfig.max_records_per_file,
                      mode: str = "overwrite", files_per_partition: int = 1, keys_stay: bool = False) -> None:
    """Dynamic partition overwrite: only folders present in ``df`` are replaced.
    The table's key index goes with it unless ``keys_stay`` in their folders.

    Default: ``rebalance`` on the folder columns brings each folder's rows to
    one task (one file per small folder) while AQE splits a folder that is too
    big for one; ``maxRecordsPerFile`` caps files.  Small tasks are not put
    together: the time goes into opening files, not into their bytes.  ``files_per_partition`` > 1 spreads each folder over up to that
    many tasks and files with a salt of the row hash (hashing on the folder
    columns alone would still send a folder to a single task).  The explicit
    partition count keeps AQE from coalescing the salted partitions again.
    """
    if not keys_stay:
        key_index.drop(df.sparkSession, path)
    if files_per_partition > 1:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files_per_partition))
        n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), files_per_partition)
        laid_out = df.repartition(n, *[F.col(c) for c in partitions], salt)
    else:
        laid_out = df.hint("rebalance", *partitions)
    with small_tasks_apart(df.sparkSession):
        (laid_out
         .write.mode(mode)
         .option("partitionOverwriteMode", "dynamic")
         .option("maxRecordsPerFile", max_records_per_file)
         .partitionBy(*partitions).parquet(path))


def partition_keys(touched: DataFrame, partitions: Sequence[str]) -> list[tuple]:
    """The distinct partition folders of ``touched``: at most one per day or
    month of the calendar, so they are listed on the driver."""
    return sorted(tuple(r) for r in touched.select(*partitions).distinct().toLocalIterator())


def prune_to_partitions(df: DataFrame, keys: Sequence[tuple], partitions: Sequence[str]) -> DataFrame:
    """Rows of ``df`` in the partition folders ``keys``: a static partition
    filter (``IN`` over the folder columns), so only those folders are read."""
    folder = F.concat_ws("/", *[F.col(c).cast("string") for c in partitions])
    return df.filter(folder.isin(["/".join(map(str, k)) for k in keys])) if keys else df.limit(0)


def delete_partitions(spark: SparkSession, path: str, partitions: Sequence[str], keys: Sequence[tuple]) -> None:
    for key in keys:
        delete_path(spark, "/".join([path, *[f"{c}={v}" for c, v in zip(partitions, key)]]))


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """Explicit schema: year/month/day stay zero-padded strings."""
    with folders_listed_together(spark):
        return spark.read.schema(schemas.PROCESSED).parquet(path)


def to_processed_layout(df: DataFrame) -> DataFrame:
    return add_date_parts(df).select(*schemas.PROCESSED_COLUMNS)


@dataclass(frozen=True)
class Merged:
    touched: list[tuple]  # (year, month, day) folders that were rewritten or emptied
    emptied: list[tuple]  # those of them that are gone
    new_rows: int         # rows of the increment after deduplication


def merge_into_processed(spark: SparkSession, new_rows: DataFrame, processed_path: str,
                         relocate_moved_ids: bool = True) -> Merged:
    """Upsert ``new_rows`` (standardised, DQ-clean) into the processed layer.

    * touched days = days of the new rows, plus (``relocate_moved_ids``) the
      days that may hold the same ids, so a correction that moves a transaction
      to another day removes the old copy.  The table's index tells those days
      (``key_index``): no other day's files are read;
    * the touched days are read back whole (only their folders: a static
      partition filter, see ``prune_to_partitions``), unioned with the new
      rows and deduplicated with the new side preferred on equal ingest stamps;
    * date parts are recomputed from transaction_ts after the union;
    * the result is staged (lineage cut) and written with dynamic overwrite;
      touched days that end up empty are removed, and so is the staging;
    * without a processed layer yet, the increment's latest versions are all of
      it: they are staged once and written, with nothing to union or to empty.
    """
    # Stage the increment once: every later step reads this copy instead of
    # recomputing the upstream pipeline (and the lineage is cut).
    new_path = scratch_path(spark, "merge-new")
    rows = to_processed_layout(new_rows)
    if not path_exists(spark, processed_path):
        # on rows that are distinct by id already this is a sort within their partitions
        latest_per_key(rows.withColumn("_new", F.lit(1)), prefer=[F.col("_new")]).drop("_new").write.mode("overwrite").parquet(new_path)
        new = read_processed(spark, new_path)
        if relocate_moved_ids:
            key_index.folders_of(spark, processed_path, new, schemas.PROCESSED, "transaction_id", DATE_PARTS, unique=True)
        write_partitioned(new, processed_path, DATE_PARTS, keys_stay=relocate_moved_ids)
        first = Merged(partition_keys(new, DATE_PARTS), [], new.count())
        delete_path(spark, new_path)
        return first
    staging = scratch_path(spark, "merge-staging")
    rows.write.mode("overwrite").parquet(new_path)
    new = read_processed(spark, new_path).withColumn("_new", F.lit(1))
    touched = new.select(*DATE_PARTS)
    if relocate_moved_ids:
        touched = touched.unionByName(key_index.folders_of(spark, processed_path, new, schemas.PROCESSED, "transaction_id", DATE_PARTS))
    days = partition_keys(touched, DATE_PARTS)
    existing = read_processed(spark, processed_path)
    merged = prune_to_partitions(existing, days, DATE_PARTS).withColumn("_new", F.lit(0)).unionByName(new)
    merged = latest_per_key(merged, prefer=[F.col("_new")]).drop("_new")
    to_processed_layout(merged).write.mode("overwrite").parquet(staging)
    staged = read_processed(spark, staging)
    write_partitioned(staged, processed_path, DATE_PARTS, keys_stay=relocate_moved_ids)
    left = set(partition_keys(staged, DATE_PARTS))
    emptied = [d for d in days if d not in left]
    delete_partitions(spark, processed_path, DATE_PARTS, emptied)
    count = new.count()
    for path in (new_path, staging):
        delete_path(spark, path)
    return Merged(days, emptied, count)


STREAM_LOG = "_spark_metadata"


def file_sizes(spark: SparkSession, path: str, partitions: Sequence[str], schema: T.StructType) -> DataFrame:
    """(partition columns, n_files, bytes, largest) of each partition folder, by
    the files' own lengths."""
    files = (spark.read.schema(schema).parquet(path)
             .select(*partitions, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_bytes")).distinct())
    return files.groupBy(*partitions).agg(F.count(F.lit(1)).alias("n_files"), F.sum("_bytes").alias("bytes"), F.max("_bytes").alias("largest"))


def compact_to_bytes(spark: SparkSession, path: str, partitions: Sequence[str], schema: T.StructType,
                     target: int = C.TARGET_FILE_BYTES, most: int = C.MOST_FILE_BYTES) -> DataFrame:
    """Rewrite the folders whose files are too many for their bytes, or one of
    which exceeds ``most`` bytes, into files of about ``target`` bytes: as many
    as the folder's bytes ask for, its rows dealt to them evenly by hash, and
    each file written by a task of its own.  Other folders are not read.
    Returns what was rewritten: (partition columns, n_files, bytes, files)."""
    if path_exists(spark, f"{path}/{STREAM_LOG}"):
        raise ValueError(f"{path} is written by a stream; compact it into a table of its own with compact_stream")
    parts = list(partitions)
    sizes = file_sizes(spark, path, parts, schema).withColumn("files", F.greatest(F.lit(1), F.ceil(F.col("bytes") / target)).cast("long"))
    due = sizes.where((F.col("n_files") > F.col("files")) | (F.col("largest") > most))
    before = F.sum("files").over(Window.orderBy(*parts)) - F.col("files")  # a row a folder
    plan_path, staging = scratch_path(spark, "compact-plan"), scratch_path(spark, "compact-staging")
    due.withColumn("_first", before).write.parquet(plan_path)
    plan = spark.read.parquet(plan_path).select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in parts], "n_files", "bytes", "files", "_first")
    total = plan.agg(F.sum("files")).first()[0]  # one number
    if total:
        rows = prune_to_partitions(spark.read.schema(schema).parquet(path), partition_keys(plan, parts), parts)
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.col("files"))
        placed = rows.join(plan.select(*parts, "files", "_first"), parts).withColumn("_file", (F.col("_first") + salt).cast("int"))
        placed.drop("files", "_first").write.parquet(staging)
        staged = spark.read.schema(T.StructType([*schema.fields, T.StructField("_file", T.IntegerType())])).parquet(staging)
        (staged.repartitionById(int(total), "_file").select(*schema.names).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path))
        delete_path(spark, staging)
    return plan.drop("_first")


def compact(spark: SparkSession, path: str, partitions: Sequence[str], where: dict[str, str],
            files_per_partition: int = 1, schema: T.StructType = schemas.PROCESSED) -> DataFrame:
    """Rewrite the folders selected by ``where`` into ``files_per_partition``
    files each, more where a folder exceeds the records-per-file bound (rows
    unchanged).  Reads are staged first: a folder is never overwritten while it
    is being read.  The explicit schema keeps folder values as written ('06'
    stays '06', never re-inferred as 6).  A streaming sink's folder is refused:
    its log lists the files, see ``compact_stream``."""
    if path_exists(spark, f"{path}/{STREAM_LOG}"):
        raise ValueError(f"{path} is written by a stream; compact it into a table of its own with compact_stream")
    df = spark.read.schema(schema).parquet(path)
    for c, v in where.items():
        df = df.filter(F.col(c) == F.lit(v))
    staging = scratch_path(spark, "compact-staging")
    df.write.mode("overwrite").partitionBy(*partitions).parquet(staging)
    write_partitioned(spark.read.schema(schema).parquet(staging), path, partitions, files_per_partition=files_per_partition, keys_stay=True)
    delete_path(spark, staging)
    return spark.read.schema(schema).parquet(path)


def compact_stream(spark: SparkSession, path: str, into: str, partitions: Sequence[str],
                   files_per_partition: int = 1) -> DataFrame:
    """A compacted copy of a streaming sink's table, in a folder of its own.
    The sink's log says which files count; they stay as they are, so the
    stream and its readers are not disturbed.  Run again, it replaces every
    partition that the stream has written by then."""
    if not path_exists(spark, f"{path}/{STREAM_LOG}"):
        raise ValueError(f"{path} has no stream log")
    df = spark.read.parquet(path)
    write_partitioned(df, into, partitions, files_per_partition=files_per_partition)
    return spark.read.schema(df.schema).parquet(into)


def file_report(spark: SparkSession, path: str, partitions: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Files and rows per partition folder (small-file monitoring)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    return (df.select(*partitions, F.col("_metadata.file_path").alias("_file"))
            .groupBy(*partitions)
            .agg(F.count_distinct("_file").alias("n_files"), F.count(F.lit(1)).alias("n_rows")))


def schema_drift(spark: SparkSession, path: str, expected: T.StructType, partitions: Sequence[str],
                 folders: Sequence[str] | None = None) -> DataFrame:
    """(folder, column_name, expected_type, actual_type, status, n_rows): what
    the files of each top-level partition folder hold against the expected
    data columns.  Spark reads and merges the footers of a folder's files in
    parallel; where they contradict each other, the folder's one row says so.
    Drift is reported, never applied.  ``folders``: only these values of the
    first partition column."""
    want = {f.name: f.dataType.simpleString() for f in expected.fields if f.name not in partitions}
    top, rows = partitions[0], []
    for name in list_dirs(spark, path):  # as many as the top level has, say years
        if not name.startswith(f"{top}="):
            continue
        folder = name.split("=", 1)[1]
        if folders is not None and folder not in folders:
            continue
        try:
            found = spark.read.option("mergeSchema", "true").parquet(f"{path}/{name}").schema
        except (PySparkException, Py4JJavaError) as e:
            if "CANNOT_MERGE_SCHEMAS" not in str(e):
                raise
            rows.append((folder, None, None, None, "conflicting_files"))
            continue
        has = {f.name: f.dataType.simpleString() for f in found.fields if f.name not in partitions}
        for c in [*want, *sorted(has.keys() - want.keys())]:
            e, a = want.get(c), has.get(c)
            status = "ok" if e == a else "missing" if a is None else "unexpected" if e is None else "type_changed"
            rows.append((folder, c, e, a, status))
    report = spark.createDataFrame(rows, "folder string, column_name string, expected_type string, actual_type string, status string")
    counts = (spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in partitions])).parquet(path)
              .groupBy(F.col(top).alias("folder")).agg(F.count(F.lit(1)).alias("n_rows")))
    return report.join(counts, "folder")


def sync_partitions(spark: SparkSession, table: str, path: str, schema: T.StructType,
                    partitions: Sequence[str]) -> DataFrame:
    """Register ``path`` as an external partitioned table (if needed), recover
    the partition folders written since the last sync, and list them.
    The table's schema is the expected one: drift is reported by
    ``schema_drift``, never applied here."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet "
              f"PARTITIONED BY ({', '.join(partitions)}) LOCATION '{path}'")
    spark.catalog.recoverPartitions(table)
    return spark.sql(f"SHOW PARTITIONS {table}")


def sync_touched(spark: SparkSession, table: str, path: str, schema: T.StructType, partitions: Sequence[str],
                 written: Sequence[tuple], gone: Sequence[tuple]) -> None:
    """Bring the catalog's partitions of ``path`` up to date after a run: those
    ``written`` are added, those ``gone`` dropped; nothing is listed.  A table
    that the catalog does not have yet is registered with all its partitions."""
    if not spark.catalog.tableExists(table):
        sync_partitions(spark, table, path, schema, partitions)
        return
    spec = lambda key: "PARTITION (" + ", ".join(f"{c} = '{v}'" for c, v in zip(partitions, key)) + ")"
    if written:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(map(spec, written)))
    if gone:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(map(spec, gone)))
    spark.catalog.refreshTable(table)
