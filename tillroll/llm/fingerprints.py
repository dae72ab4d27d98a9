"""Document fingerprints from closed syncmers.

A k-mer of characters is a closed syncmer if, of its inner s-mers, the one
with the smallest hash lies at its first or last place.  That depends on the
k-mer alone, so the same passage gives the same anchors whatever surrounds it.
A repeated k-mer counts once per occurrence (its hash is mixed with the number
of the occurrence), so a page of one repeated line is like its own three
quarters.  Short texts have shorter k-mers (``SCALES``).  What is written out of
a document's anchors is its digest: their number, then hash and place (8 hex
digits apiece) of the ``size`` with the smallest hashes.

The likeness of two texts looks at all their anchors, at the shorter text's
scale: those that both hold and whose places increase in both (a longest
increasing chain: passages in the same order), over those that either holds,
are the Jaccard coefficient J; reported is the share of common anchors
2 J / (1 + J).

``edited`` pairs each document with the next one by id.  Documents are dealt
to ranges of doc_id at fixed bounds; the first document of each range also
visits the range before it, so one shuffle of the texts is enough and no range
needs another's rows.

Defined cases: NULL text counts as empty; a text of one character is one
anchor, an empty one has none (two empty texts are alike: 1, one empty: 0);
where s-mers tie, both ends of a k-mer may hold the smallest; very long texts
are anchored in steps and compared by all anchors, as any other; rows with a
NULL doc_id come first; repeated doc_ids follow each other by text; the only
row's next document is itself; an empty table gives an empty result; other
columns are not read.
"""
from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import map_batches, ship
from tillroll.llm.hashing import MIX1, mix, powers

SIZE = 64  # anchors of a digest
# (texts shorter than this, k, s)
SCALES = ((16, 2, 1), (64, 4, 2), (1 << 62, 12, 6))
STEP_CHARS = 1 << 20  # characters worked at a time, whatever the text's length


def _window_min(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each window of w, by doubling."""
    out, have = a, 1
    while have < w:
        step = min(have, w - have)
        out = np.minimum(out[:len(out) - step], out[step:])
        have += step
    return out


def syncmers(codes: np.ndarray, k: int, s: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of the closed syncmers of an array of code points."""
    n = len(codes)
    if n < k:
        k = s = n
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    up, down = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(codes.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    inner = mix((total[s:] - total[:-s]) * down[:n - s + 1])
    w = k - s + 1
    low = _window_min(inner, w)
    at = np.flatnonzero((inner[:len(low)] == low) | (inner[w - 1:] == low))
    return mix((total[at + k] - total[at]) * down[at] + np.uint64(k)), at


Anchors = tuple[np.ndarray, np.ndarray]  # hashes ascending, places


def scale_of(text: str) -> tuple[int, int]:
    return next((k, s) for limit, k, s in SCALES if len(text) < limit)


def anchors(text: str, scale: tuple[int, int] | None = None) -> Anchors:
    """All anchors of a text, at its own scale unless told."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    k, s = scale or scale_of(text)
    if len(codes) <= STEP_CHARS:
        h, at = syncmers(codes, k, s)
    else:  # windows overlap by k - 1, so every k-mer is seen once
        parts = [(h, at + a) for a in range(0, len(codes) - k + 1, STEP_CHARS)
                 for h, at in [syncmers(codes[a:a + STEP_CHARS + k - 1], k, s)]]
        h, at = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(h, kind="stable")
    h, at = h[order], at[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    if not new.all():  # the number of the occurrence goes into the hash
        index = np.arange(len(h))
        nth = (index - np.maximum.accumulate(np.where(new, index, 0))).astype(np.uint64)
        h = np.where(new, h, mix(h + nth * MIX1))
        order = np.argsort(h, kind="stable")
        h, at = h[order], at[order]
    return h, at


def digest(a: Anchors, size: int = SIZE) -> str:
    h, at = (a[0][:size] >> np.uint64(32)).tolist(), a[1][:size].tolist()
    return f"{len(a[0]):08x}" + "".join(f"{x:08x}{p & 0xFFFFFFFF:08x}" for x, p in zip(h, at))


def chain_length(q: np.ndarray) -> int:
    """Length of the longest non-decreasing subsequence."""
    drops = np.flatnonzero(q[1:] < q[:-1])
    if not len(drops):
        return len(q)
    chain = q[:drops[0] + 1].tolist()  # ascending so far: its own best chain
    for v in q[drops[0] + 1:].tolist():
        i = bisect.bisect_right(chain, v)
        chain[i:i + 1] = [v]
    return len(chain)


def likeness(a: Anchors, b: Anchors) -> float:
    """0 to 1: the share of common anchors in common order, of two sets at one scale."""
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    shared = b[0][at] == a[0]
    place, other = a[1][shared], b[1][at[shared]]
    j = chain_length(other[np.argsort(place)]) / (len(a[0]) + len(b[0]) - len(place))
    return 2 * j / (1 + j)


def alike(x: str, a: Anchors, y: str, b: Anchors) -> float:
    """The likeness of two texts, given their anchors at their own scales."""
    if x and y and (one := min(scale_of(x), scale_of(y))) != max(scale_of(x), scale_of(y)):
        a, b = (own if scale_of(t) == one else anchors(t, one) for t, own in ((x, a), (y, b)))
    return likeness(a, b)


def edit(text: str, following: str) -> str:
    """The last quarter replaced by the front of the following document."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


FIRST_OF_ALL = -(1 << 63)  # the order key of a NULL doc_id


def _dealt(docs: DataFrame, ranges: int) -> DataFrame:
    """(part, place, key, text): each document in its range of ids (place 0),
    and the first of each range once more, after the rows of the range before
    it (place 1; the first of all comes after the last range)."""
    ship(docs.sparkSession)
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST_OF_ALL)).alias("key"), "doc_id", "text")
    # at most ``ranges`` bounds, and the first key from each on: one row a range
    cuts = keyed.agg(F.percentile_approx("key", [i / ranges for i in range(1, ranges)], 10_000)).first()[0] if ranges > 1 else None
    cuts = np.array(sorted(set(cuts or [])), np.int64)

    @F.pandas_udf("int")
    def part_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, key.to_numpy(), "right").astype(np.int32))

    found = keyed.select("key").groupBy(part_of("key").alias("part")).agg(F.min("key").alias("head")).orderBy("part").collect()
    parts, heads = np.array([r["part"] for r in found], np.int32), np.array([r["head"] for r in found], np.int64)

    @F.pandas_udf("array<struct<part:int,place:int>>")
    def goes(key: pd.Series) -> pd.Series:
        at = np.searchsorted(heads, key.to_numpy(), "right") - 1
        return pd.Series([[(p, 0), (q, 1)] if first else [(p, 0)]
                          for p, q, first in zip(parts[at].tolist(), parts[at - 1].tolist(), heads[at] == key.to_numpy())])

    return keyed.withColumn("_to", F.explode(goes("key"))).select("_to.part", "_to.place", "key", "doc_id", "text")


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def edited(docs: DataFrame, ranges: int, size: int = SIZE) -> DataFrame:
    """One row per document: its fingerprint, its edited text's, and how alike they are."""

    def row(doc_id, text, a, following, b):
        changed = edit(text, following)
        e = anchors(changed)
        return (doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), digest(a, size), digest(e, size),
                alike(text, a, changed, e), alike(text, a, following, b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out = None, []
        for batch in batches:
            for part, place, _, doc_id, text in zip(*[c.to_pylist() for c in batch.columns]):
                text = text or ""
                if held and held[0] == part and held[1] == 1:
                    continue  # a visitor with a repeated id: the first of them has come
                a = anchors(text)
                if held and held[0] == part:
                    out.append(row(held[2], held[3], held[4], text, a))
                held = (part, place, doc_id, text, a)
                if len(out) >= 512:
                    yield pa.RecordBatch.from_pylist(_named(out), schema=_ARROW)
                    out = []
        if out:
            yield pa.RecordBatch.from_pylist(_named(out), schema=_ARROW)

    spread = _dealt(docs, ranges).repartition("part").sortWithinPartitions(
        "part", "place", "key", F.col("text").asc_nulls_first())
    return map_batches(spread, run, SCHEMA)


_ARROW = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), *[(c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")],
                    ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _named(rows: list[tuple]) -> list[dict]:
    return [dict(zip(_ARROW.names, r)) for r in rows]


def op10(spark, sf_dir: str) -> DataFrame:
    from tillroll.llm.common import read

    docs = read(spark, sf_dir, "documents")
    return edited(docs, ranges=4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
