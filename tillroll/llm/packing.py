"""Packing documents into sequences by cutting-stock column generation.

Documents longer than a sequence are cut into full sequences and a remainder.
The lengths of all pieces form a histogram of ``capacity / step`` size classes
(a length counts as its class's upper bound).  On it a linear program chooses
how often to use each pattern, a set of classes that fits one sequence; its
columns are generated by knapsack dynamic programming against the current
prices.  Whole parts of the solution become sequences, the few pieces that
rounding leaves are packed first-fit decreasing.  Each piece has a rank within
its class (distributed prefix counts), and class and rank say which sequence
and slot it gets.

Only the histogram (at most ``capacity / step`` rows) reaches the driver, and
only the list of patterns (bounded by the same number) goes to the tasks.

Defined cases: NULL and empty texts are one piece, the end id; very long texts
are cut into full sequences; repeated rows are packed each; an empty table
gives an empty result; other columns are not read.
"""
from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import map_batches, random_key, running_total, save, ship

CAPACITY, STEP = 2048, 8
END_ID = 1


@functools.lru_cache(maxsize=1)
def _encoder(path: str):
    from tillroll.llm.pretokens import Encoder

    return Encoder(path)


def pieces(docs: DataFrame, path: str, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): each document's ids and
    the end id, cut every ``capacity`` ids."""
    fields = [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(path)
        for b in batches:
            ids, counts = enc.encode([t or "" for t in b.column(1).to_pylist()])
            at, rows, owner = 0, [], []
            for i, n in enumerate(counts.tolist()):
                mine = np.append(ids[at:at + n], end_id).astype("<u4")
                at += n
                for start in range(0, n + 1, capacity):
                    part = mine[start:start + capacity]
                    rows.append((start, len(part), zlib.crc32(part.tobytes()), n + 1))
                    owner.append(i)
            columns = list(zip(*rows)) or [()] * len(fields)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(owner, pa.int64())), *[pa.array(c, t) for c, (_, t) in zip(columns, fields)]],
                ["doc_id", *[n for n, _ in fields]])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, " + ", ".join(f"{n} long" for n, _ in fields))


def best_pattern(price: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Knapsack by dynamic programming: the multiset of sizes that fits into
    ``room`` with the highest total price, as counts."""
    value, last = np.zeros(room + 1), np.full(room + 1, -1)
    order = np.argsort(sizes, kind="stable")
    s, p = sizes[order], price[order]
    for w in range(1, room + 1):
        value[w] = value[w - 1]
        fits = np.searchsorted(s, w, "right")
        if fits:
            gain = value[w - s[:fits]] + p[:fits]
            i = int(gain.argmax())
            if gain[i] > value[w] + 1e-12:
                value[w], last[w] = gain[i], order[i]
    counts, w = np.zeros(len(sizes), np.int64), room
    while w > 0:
        if last[w] < 0:
            w -= 1
        else:
            counts[last[w]] += 1
            w -= sizes[last[w]]
    return float(value[room]), counts


def column_generation(demand: np.ndarray, sizes: np.ndarray, room: int, rounds: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """(patterns, how often each, fractional): fewest sequences that hold
    ``demand[i]`` pieces of ``sizes[i]``.  Revised simplex; a basis has one
    column per size.  Every round's solution is feasible, so a limit on the
    rounds would cost padding only, never pieces."""
    m = len(sizes)
    columns, cost = np.diag(room // sizes).astype(float), np.ones(m)
    inverse = np.diag(1.0 / np.diag(columns))
    x = inverse @ demand
    for _ in range(rounds):
        price = cost @ inverse
        if price.min() < -1e-9:  # a size is supplied beyond its demand: let it have surplus
            enter, fee = np.zeros(m), 0.0
            enter[price.argmin()] = -1
        else:
            worth, counts = best_pattern(price, sizes, room)
            if worth <= 1 + 1e-7:
                break
            enter, fee = counts.astype(float), 1.0
        step = inverse @ enter
        up = step > 1e-9
        if not up.any():
            break
        ratio = np.where(up, x / np.where(up, step, 1), np.inf)
        out = int(ratio.argmin())
        amount = max(ratio[out], 0.0)
        x = np.maximum(x - amount * step, 0)
        x[out] = amount
        columns[:, out], cost[out] = enter, fee
        inverse[out] /= step[out]
        others = step.copy()
        others[out] = 0
        inverse -= np.outer(others, inverse[out])
    used = cost > 0
    return columns[:, used].round().astype(np.int64).T, x[used]


def plan(histogram: dict[int, int], room: int) -> tuple[np.ndarray, int]:
    """(entries, sequences).  An entry (class, first rank, slots a sequence,
    first sequence) covers the ranks up to the class's next entry."""
    entries, sequences = [], 0
    sizes = np.array(sorted(c for c, n in histogram.items() if n), np.int64)
    left = np.array([histogram[c] for c in sizes], np.int64)
    given = np.zeros(len(sizes), np.int64)

    def use(pattern: np.ndarray, times: int) -> None:
        nonlocal sequences
        for i in np.flatnonzero(pattern):
            entries.append((sizes[i], given[i], pattern[i], sequences))
            given[i] += pattern[i] * times
            left[i] = max(0, left[i] - pattern[i] * times)
        sequences += times

    if len(sizes):
        patterns, often = column_generation(left.astype(float), sizes, room)
        for pattern, times in zip(patterns, np.floor(often + 1e-6).astype(np.int64)):
            if times > 0:
                use(pattern, int(times))
    while left.any():  # what rounding leaves: less than a sequence for each pattern
        pattern, free = np.zeros(len(sizes), np.int64), room
        for i in range(len(sizes) - 1, -1, -1):
            pattern[i] = min(left[i], free // sizes[i])
            free -= pattern[i] * sizes[i]
        use(pattern, max(1, int((left[pattern > 0] // pattern[pattern > 0]).min())))
    return np.array(entries, np.int64).reshape(-1, 4), sequences


def pack(cut: DataFrame, capacity: int = CAPACITY, step: int = STEP) -> DataFrame:
    """Adds sequence_id and offset to ``pieces`` (doc_id, start, length, ...)."""
    ship(cut.sparkSession)
    classed = save(cut.withColumn("_class", F.ceil(F.col("length") / step).cast("long"))
                   .withColumn("_key", random_key("doc_id", "start", "ids_crc32")), "pack-pieces")
    histogram = {r["_class"]: r["count"] for r in classed.groupBy("_class").count().collect()}  # capacity / step rows
    entries, _ = plan(histogram, capacity // step)
    entries = entries[np.lexsort((entries[:, 1], entries[:, 0]))]
    begin = entries[:, 0] << 44 | entries[:, 1]

    @F.pandas_udf("long")
    def sequence_of(kind: pd.Series, rank: pd.Series) -> pd.Series:
        place = kind.to_numpy() << 44 | rank.to_numpy()
        e = entries[np.searchsorted(begin, place, "right") - 1]
        return pd.Series(e[:, 3] + (rank.to_numpy() - e[:, 1]) // e[:, 2])

    slices = math.ceil(math.sqrt(max(histogram.values(), default=1)))
    ranked = running_total(classed, ["_class"], ["_key", "doc_id", "start"], F.lit(1).cast("long"), slices, before="_rank", total="_all")
    placed = ranked.withColumn("sequence_id", sequence_of("_class", "_rank")).drop("_class", "_all", "_key")
    # a sequence has at most ``capacity`` pieces
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "_rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")).drop("_rank")


def pack_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Pieces of all documents with the sequence and offset they lie at."""
    import public_tokenizers

    return pack(pieces(docs, path or public_tokenizers.path("word_bpe_49k.json"))).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op9(spark, sf_dir: str) -> DataFrame:
    from tillroll.llm.common import read

    return pack_documents(read(spark, sf_dir, "documents"))
