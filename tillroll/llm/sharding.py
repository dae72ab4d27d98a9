"""Sharding by jump consistent hashing.

A row's shard follows from its key and the number of shards alone: the key's
64-bit hash seeds a linear congruential sequence whose values say at which
numbers of shards the key jumps, and the last jump below the number of shards
is its shard.  No ring table exists.  Appending a shard moves the 1 / (n + 1)
of the keys that jump at n, and those only into the new shard.

Where a row lies in its shard (``slot``) is the exclusive prefix sum of rows in
the order of a hash of key, size and checksum.  Equal rows are counted before
they are ordered and each shard is cut into slices of the hash's range, so no
task holds a shard, a hot key or a group of copies.

The law is ``key``: equal texts under different keys may lie in different
shards, as key and number of shards alone decide.

Defined cases: a NULL key is a key like any other; rows that share a key share
a shard; NULL and empty texts have checksum 0 and size 1; repeated rows take
consecutive slots; very long texts are only measured, row by row; an empty
table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import key_hash, random_key, running_total, save, ship

SHARDS = 8
EXPLODED = 1 << 16  # repeated rows that one row is expanded into at a time

# Fixed values of the published algorithm: its multiplier, and 2**31 over the upper 31 bits of the state.
_MULTIPLIER, _SPAN, _DROP = np.uint64(2862933555777941757), 2.0**31, np.uint64(33)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard, 0 to shards - 1, of each 64-bit key."""
    if shards < 1:
        raise ValueError("there must be at least one shard")
    shard = np.zeros(len(keys), np.int64)
    live, state = np.arange(len(keys)), keys.astype(np.uint64)
    while len(live):
        state = state * _MULTIPLIER + np.uint64(1)
        to = ((shard[live] + 1) * (_SPAN / ((state >> _DROP) + np.uint64(1)).astype(np.float64))).astype(np.int64)
        inside = to < shards
        live, state = live[inside], state[inside]
        shard[live] = to[inside]
    return shard


def shard_of(spark, shards: int):
    """A column function: 8-byte hash -> shard among ``shards``."""
    ship(spark)

    @F.pandas_udf("int")
    def of(hashes: pd.Series) -> pd.Series:
        return pd.Series(jump(np.frombuffer(b"".join(hashes), ">u8"), shards).astype(np.int32))

    return of


def assign(rows: DataFrame, key: str = "doc_id", shards: int = SHARDS) -> DataFrame:
    """``rows`` with ``shard``, and ``grown_shard`` with one more shard: a narrow map."""
    hashed = key_hash(key, seed="shard")
    spark = rows.sparkSession
    return rows.withColumns({"shard": shard_of(spark, shards)(hashed), "grown_shard": shard_of(spark, shards + 1)(hashed)})


def with_slots(rows: DataFrame, by: str = "shard") -> DataFrame:
    """``rows`` (all columns of types that can be compared) with ``slot``, gapless from 0 within ``by``."""
    columns = [c for c in rows.columns if c != by]
    counted = rows.groupBy(by, *columns).agg(F.count(F.lit(1)).alias("_n"))
    counted = save(counted.withColumn("_key", random_key(*columns, seed="slot")), "shard-rows")
    largest = counted.groupBy(by).count().agg(F.max("count")).first()[0] or 1  # one number decides the slicing, not the result
    placed = running_total(counted, [by], ["_key", *columns], F.col("_n"), math.ceil(math.sqrt(largest)), before="_before", total="_total")
    out = rows.columns
    few = placed.where(F.col("_n") <= EXPLODED).withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    # many equal rows are first expanded into pieces, which other tasks expand
    piece = (placed.where(F.col("_n") > EXPLODED)
             .withColumn("_p", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_n - 1) div {EXPLODED}"))))
             .repartition(*out, "_p"))
    many = piece.withColumn("_i", F.explode(F.sequence(F.col("_p") * EXPLODED, F.least(F.col("_n"), (F.col("_p") + 1) * EXPLODED) - 1))).drop("_p")
    return few.unionByName(many).select(*out, (F.col("_before") + F.col("_i")).alias("slot"))


def write(rows: DataFrame, folder: str, key: str = "doc_id", shards: int = SHARDS) -> None:
    """Write ``rows`` to one folder a shard (shard=0 ...), several files each."""
    assign(rows, key, shards).drop("grown_shard").write.partitionBy("shard").parquet(folder)


def op11(spark, sf_dir: str) -> DataFrame:
    from tillroll.llm.common import read

    text = F.coalesce("text", F.lit(""))
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return with_slots(assign(docs)).withColumn("law", F.lit("key"))


def oracle(docs: str = "documents", shards: int = SHARDS) -> str:
    """DuckDB SQL for op11's rows: jumps by recursion, CRC-32 byte by byte."""
    table = []
    for c in range(256):  # the reflected polynomial's table
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    key = "md5('shard|' || coalesce(doc_id::VARCHAR, ''))"
    seed = f"('0x' || substr({key}, 1, 16))::UBIGINT::HUGEINT"
    jumped = lambda n: f"""SELECT seed, max_by(b, jumps) AS shard FROM (  -- the last jump below {n}
    WITH RECURSIVE j AS (SELECT seed, seed AS state, 0::BIGINT AS b, 0 AS jumps FROM (SELECT DISTINCT seed FROM d)
      UNION ALL SELECT seed, state, b, jumps FROM (
        SELECT seed, s AS state, floor((b + 1)::DOUBLE * (2147483648.0::DOUBLE / ((s // 8589934592) + 1)::DOUBLE))::BIGINT AS b, jumps + 1 AS jumps
        FROM (SELECT *, (state * 2862933555777941757 + 1) % 18446744073709551616 AS s FROM j)) WHERE b < {n})
    SELECT * FROM j) GROUP BY seed"""  # noqa: E731
    return f"""
WITH d AS (SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 1 AS size, {seed} AS seed,
    xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::UBIGINT)),
      lambda c, b: xor(c >> 8, ({table}::UBIGINT[])[(xor(c, b) & 255)::INT + 1])), 4294967295::UBIGINT)::BIGINT AS text_crc32 FROM {docs}),
now AS ({jumped(shards)}), grown AS ({jumped(shards + 1)}),
s AS (SELECT doc_id, size, text_crc32, now.shard::INT AS shard, grown.shard::INT AS grown_shard FROM d JOIN now USING (seed) JOIN grown USING (seed))
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
    row_number() OVER (PARTITION BY shard ORDER BY md5('slot|' || coalesce(doc_id::VARCHAR, '') || '|' || size || '|' || text_crc32 || '|' || grown_shard),
      doc_id NULLS FIRST, size, text_crc32, grown_shard) - 1 AS slot FROM s"""
