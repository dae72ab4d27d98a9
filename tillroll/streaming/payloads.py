"""Transaction-event payloads derived from the ``events`` table, with the
producer's fault mix injected by residues of event_id, staged as ordered
folders (one micro-batch per folder of several files)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.columns import padded
from tillroll.sources.files import order_files
from tillroll.sources.tables import read_table

# The three poison payloads of the reference's producer.
POISON_PAYLOADS = ('{"transaction_id": "BROKEN", amount: }', "not json at all",
                   '{"customer_id": "C00001", "amount": 10}')
DAYS_PER_FILE = 3
FILES_PER_BATCH = 4
LATE_MINUTES = 30
VERY_LATE_HOURS = 5
VERY_LATE_FILE_OFFSET = 2


def _payload(tid: Column, ts: Column) -> Column:
    e = F.col("event_id")
    region = F.when(e % 2 == 0, F.col("event_type")).otherwise(F.concat(F.lit(" "), F.upper("event_type"), F.lit(" ")))
    status = F.when(e % 5 == 0, F.lit("PENDING")).otherwise(F.lit("COMPLETED"))
    return F.concat(
        F.lit('{"transaction_id":"'), tid,
        F.lit('","customer_id":"C'), padded(F.col("user_id"), 5),
        F.lit('","region":"'), region,
        F.lit('","store_id":"S'), padded(e % 40 + 1, 3),
        F.lit('","amount":'), F.col("value").cast("decimal(14,2)").cast("string"),
        F.lit(',"status":"'), status,
        F.lit('","event_time":"'), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit('"}'))


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_no, kind, event_id, line, lag_ms).  kinds: base, duplicate,
    late (30 min old, same file), very_late (5 h old, two files later), poison.

    Late rows are dropped against the watermark of an earlier batch: with
    chained stateful operators Spark compares with the watermark of two
    batches back (one more after a restart's no-data batch).  A very late
    copy lands two files after its original, so it is dropped under either
    lag, and the result does not depend on where a restart falls.
    """
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    d0 = ev.agg(F.min(F.to_date("ts"))).first()[0]  # a single date (scalar action)
    ev = ev.withColumn("d0", F.lit(d0))
    e = F.col("event_id")
    ts = F.col("ts")
    file_no = F.floor(F.date_diff(F.to_date(ts), F.col("d0")) / DAYS_PER_FILE).cast("int")
    tid = F.concat(F.lit("T"), e.cast("string"))
    base = ev.select(file_no.alias("file_no"), F.lit("base").alias("kind"), e, _payload(tid, ts).alias("line"),
                     ((e % 13) * 30000).alias("lag_ms"), ts.cast("timestamp").alias("event_time"))
    dup = base.filter(F.col("event_id") % 33 == 0).withColumn("kind", F.lit("duplicate"))
    late_ts = ts - F.expr(f"INTERVAL {LATE_MINUTES} MINUTES")
    late = ev.filter(e % 50 == 1).select(
        file_no.alias("file_no"), F.lit("late").alias("kind"), e,
        _payload(F.concat(tid, F.lit("L")), late_ts).alias("line"),
        F.lit(LATE_MINUTES * 60_000).cast("long").alias("lag_ms"), late_ts.cast("timestamp").alias("event_time"))
    vlate_ts = ts - F.expr(f"INTERVAL {VERY_LATE_HOURS} HOURS")
    vlate = ev.filter(e % 100 == 2).select(
        (file_no + VERY_LATE_FILE_OFFSET).alias("file_no"), F.lit("very_late").alias("kind"), e,
        _payload(F.concat(tid, F.lit("V")), vlate_ts).alias("line"),
        F.lit(VERY_LATE_HOURS * 3_600_000).cast("long").alias("lag_ms"), vlate_ts.cast("timestamp").alias("event_time"))
    choice = F.floor(e / 100) % 3
    poison = ev.filter(e % 100 == 3).select(
        file_no.alias("file_no"), F.lit("poison").alias("kind"), e,
        F.when(choice == 0, F.lit(POISON_PAYLOADS[0])).when(choice == 1, F.lit(POISON_PAYLOADS[1]))
         .otherwise(F.lit(POISON_PAYLOADS[2])).alias("line"),
        F.lit(None).cast("long").alias("lag_ms"), F.lit(None).cast("timestamp").alias("event_time"))
    return base.unionByName(dup).unionByName(late).unionByName(vlate).unionByName(poison)


def stage_batches(lines: DataFrame, path: str, files_per_batch: int = FILES_PER_BATCH) -> None:
    """Write the lines in one distributed job: a folder for each file_no, its
    lines spread over ``files_per_batch`` files.  Modification times follow
    file_no, so a file source that takes that many files a trigger reads one
    folder after the other."""
    spark = lines.sparkSession
    last = lines.agg(F.max("file_no")).first()[0]  # one number
    if last is None:
        return
    place = F.col("file_no") * files_per_batch + F.pmod(F.xxhash64("event_id", "kind"), F.lit(files_per_batch))
    placed = lines.select(place.cast("int").alias("place"), F.format_string("%05d", "file_no").alias("batch"), F.col("line").alias("value"))
    (placed.repartitionById((last + 1) * files_per_batch, "place").drop("place")
     .write.mode("append").partitionBy("batch").text(path))
    order_files(spark, path, files_per_batch)
