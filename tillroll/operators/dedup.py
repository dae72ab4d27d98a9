"""Latest-version deduplication and duplicate reports."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll import config as C
from tillroll.operators.positions import with_position


def row_fingerprint(df: DataFrame, exclude: Sequence[str] = ()) -> Column:
    """A hash of all columns: the last tiebreak, so "latest" is a total order."""
    return F.xxhash64(*[F.col(c) for c in df.columns if c not in exclude])


def latest_per_key(df: DataFrame, key: str = C.BUSINESS_KEY, ts: str = "ingest_ts",
                   prefer: Sequence[Column] = ()) -> DataFrame:
    """Keep one row per key: newest ``ts`` (NULLs last), then ``prefer`` columns
    descending, then the row hash.

    ``row_number() ... = 1`` is planned with a partial WindowGroupLimit before
    the shuffle, so each map task sends at most one row per key: a hot key is
    reduced where it is read instead of in one reducer.
    """
    order = [F.col(ts).desc_nulls_last(), *[p.desc_nulls_last() for p in prefer],
             row_fingerprint(df).desc()]
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def duplicate_keys(raw: DataFrame, key: str = C.BUSINESS_KEY) -> DataFrame:
    """Keys that occur more than once, with copies, distinct statuses and the
    first/last ingest stamp (compared as text, as landed)."""
    return (raw.groupBy(key)
            .agg(F.count(F.lit(1)).alias("copies"),
                 F.count_distinct("status").alias("distinct_statuses"),
                 F.min("ingest_ts").alias("first_ingested"),
                 F.max("ingest_ts").alias("last_ingested"))
            .filter(F.col("copies") > 1))


def duplicate_rows(raw: DataFrame, key: str = C.BUSINESS_KEY, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Every row of a duplicated key with ``rn`` (1 = kept, newest ingest first)
    and ``copies``.

    Skew-safe: copies come from a pre-aggregated count; ``rn`` is the row's
    position in a range-partitioned global sort minus the key's first
    position, so a hot key is spread over many tasks instead of one window.
    """
    counts = raw.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
    dups = raw.join(counts, raw[key].eqNullSafe(counts[key]), "inner").drop(counts[key])
    order = [F.col(key).asc_nulls_first(), F.col("ingest_ts").desc_nulls_last(),
             *[F.col(c).asc_nulls_last() for c in tiebreak]]
    pos = with_position(dups, order, "_pos")
    first = pos.groupBy(key).agg(F.min("_pos").alias("_first"))
    out = pos.join(first, pos[key].eqNullSafe(first[key]), "inner").drop(first[key])
    return out.withColumn("rn", (F.col("_pos") - F.col("_first") + 1).cast("long")).drop("_pos", "_first")
