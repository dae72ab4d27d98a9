"""Token-ID files: documents' ids in ascending doc_id order, range-coded.

A file set is a Parquet folder whose rows are chunks of whole documents:
part and chunk (their order), the documents' ids and numbers of token ids,
the coded payload (:mod:`tillroll.llm.range_coder`), and the length and
checksum of each of its blocks.  Chunks decode independently, so reading is a
narrow map over however many tasks Spark chooses; any Hadoop path will do.

Writing range-partitions the texts by doc_id (one shuffle), sorts within, and
tokenizes and codes in the same task.  Where a document starts among all ids
follows from the chunks' totals: prefix sums within a part and over the parts.

Defined cases: NULL and empty texts are the end id alone; rows with a NULL
doc_id come first; repeated doc_ids follow each other by text; one very long
document makes one long chunk; an empty table writes an empty folder; other
columns are not written.  A damaged block raises when it is read.
"""
from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm import range_coder
from tillroll.llm.common import map_batches
from tillroll.session import scratch_path

END_ID = 2
CHUNK_IDS = range_coder.CHUNK

_CHUNK = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
                    ("block", pa.int32()), ("words", pa.list_(pa.int32())), ("crcs", pa.list_(pa.int64())), ("payload", pa.binary())])
CHUNK = "part int, chunk long, doc_ids array<long>, sizes array<long>, block int, words array<int>, crcs array<long>, payload binary"


@functools.lru_cache(maxsize=1)
def _encoder(path: str):
    from tillroll.llm.pretokens import Encoder

    return Encoder(path)


def write(docs: DataFrame, folder: str, path: str, end_id: int = END_ID) -> None:
    """Write the ids of ``docs`` (doc_id, text) to ``folder``; ``path``: a tokenizers file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(path)
        part, chunk = TaskContext.get().partitionId(), 0
        doc_ids: list = []
        ids: list[np.ndarray] = []
        held = 0

        def row() -> pa.RecordBatch:
            payload, block, words, crcs = range_coder.encode(np.concatenate(ids))
            values = [part, chunk, doc_ids, [len(x) for x in ids], block, words, crcs, payload]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _CHUNK)], schema=_CHUNK)

        for b in batches:
            flat, counts = enc.encode([t or "" for t in b.column(1).to_pylist()])
            at = 0
            for doc, n in zip(b.column(0).to_pylist(), counts.tolist()):
                doc_ids.append(doc)
                ids.append(np.append(flat[at:at + n], end_id))
                at += n
                held += n + 1
                if held >= CHUNK_IDS:
                    yield row()
                    chunk, doc_ids, ids, held = chunk + 1, [], [], 0
        if ids:
            yield row()

    order = F.col("doc_id").asc_nulls_first()
    ranged = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(order)
              .sortWithinPartitions(order, F.col("text").asc_nulls_first()))
    map_batches(ranged, run, CHUNK).write.parquet(folder)


def read(spark: SparkSession, folder: str, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files; with
    ``digest`` the ids are replaced by ids_crc32, the CRC-32 of the ids as
    little-endian 32-bit integers."""
    name, kind, arrow = ("ids_crc32", "long", pa.int64()) if digest else ("ids", "array<int>", pa.list_(pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):  # one chunk at a time
                part, chunk, docs, sizes, block, words, crcs, payload = (b.column(c)[i].as_py() for c in _CHUNK.names)
                ends = np.cumsum(np.array(sizes, np.int64))
                ids = range_coder.decode(payload, block, words, crcs, int(ends[-1]))
                each = np.split(ids, ends[:-1])
                values = [zlib.crc32(x.astype("<u4").tobytes()) for x in each] if digest else each
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(docs), part), pa.int32()), pa.array(np.full(len(docs), chunk), pa.int64()), pa.array(docs, pa.int64()),
                     pa.array(ends - sizes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(values, arrow)],
                    ["part", "chunk", "doc_id", "_at", "n_tokens", name])

    chunks = spark.read.schema(CHUNK).parquet(folder)
    rows = map_batches(chunks, run, f"part int, chunk long, doc_id long, _at long, n_tokens long, {name} {kind}")
    totals = chunks.select("part", "chunk", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("_n"))
    before = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # one row a part: as many as the files were written by tasks
    parts = totals.groupBy("part").agg(F.sum("_n").alias("_n")).select("part", before(Window.orderBy("part")).alias("_part"))
    at = totals.withColumn("_chunk", before(Window.partitionBy("part").orderBy("chunk"))).join(parts, "part")
    return (rows.join(at.select("part", "chunk", "_part", "_chunk"), ["part", "chunk"])
            .select("doc_id", (F.col("_part") + F.col("_chunk") + F.col("_at")).alias("start"), "n_tokens", name))


def op5(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tillroll.llm import common

    folder = scratch_path(spark, "id-files")
    write(common.read(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return read(spark, folder, digest=True)
