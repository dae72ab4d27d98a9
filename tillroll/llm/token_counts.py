"""Token counts of whole texts by rank-synchronous merging.

The distinct pre-tokens of a batch lie end to end in one array of symbol ids,
a ragged array with one sequence per pre-token.  In each round every sequence
merges all occurrences of its own lowest-ranked pair at once; sequences
without a mergeable pair leave with their number of surviving symbols.  As a
pair that contains a merged symbol ranks after that symbol's own merge, this
gives the same result as merging one pair at a time.

The count of a text is the sum over its pre-tokens; counts of distinct
pre-tokens are remembered per worker (bounded).  A narrow map: no shuffle.

Defined cases: NULL and empty texts have 0 tokens; special strings inside a
text count as one token each, as the library does by default; very long texts
are worked in slices; repeated rows are counted each; an empty table gives an
empty result; other columns are not read unless named in ``keep``.
"""
from __future__ import annotations

import functools
import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import map_batches

NEVER = np.int64(1) << 40


class PairRanks:
    """(left, right) -> rank by hashing into a few levels of slots."""

    BITS = 17

    def __init__(self, pairs: np.ndarray):
        """pairs: (n, 2) ids in rank order."""
        keys = pairs[:, 0].astype(np.uint64) << np.uint64(32) | pairs[:, 1].astype(np.uint64)
        ranks = np.arange(len(keys), dtype=np.int64)
        self.levels = []
        while len(keys):
            slot = self._slot(keys, len(self.levels))
            taken, first = np.unique(slot, return_index=True)
            held = np.full(1 << self.BITS, np.iinfo(np.uint64).max, np.uint64)
            rank = np.full(1 << self.BITS, NEVER, np.int64)
            held[taken], rank[taken] = keys[first], ranks[first]
            self.levels.append((held, rank))
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, ranks = keys[rest], ranks[rest]

    def _slot(self, keys: np.ndarray, level: int) -> np.ndarray:
        odd = np.uint64((0x9E3779B97F4A7C15 + 2 * 0x632BE59BD9B4E019 * level) % (1 << 64) | 1)
        return (keys * odd) >> np.uint64(64 - self.BITS)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        out = np.full(len(keys), NEVER, np.int64)
        todo = np.arange(len(keys))
        for level, (held, rank) in enumerate(self.levels):
            slot = self._slot(keys[todo], level)
            hit = held[slot] == keys[todo]
            out[todo[hit]] = rank[slot[hit]]
            todo = todo[~hit & (rank[slot] != NEVER)]
        return out


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies:
    printable bytes stand for themselves, the rest follow from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(0x100 + hidden.index(b)) for b in range(256)]


class Merger:
    """Counts the symbols that byte sequences end up with."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        pairs = np.array([(vocab[a], vocab[b]) for a, b in merges], np.int64)
        self.byte_id = np.array([vocab[c] for c in byte_letters()], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.ranks = PairRanks(pairs)

    def counts(self, data: bytes, sizes: np.ndarray) -> np.ndarray:
        """Surviving symbols of the sequences that lie end to end in ``data``."""
        out = np.zeros(len(sizes), np.int64)
        live = np.flatnonzero(sizes)
        size = sizes[live].astype(np.int64)
        ids = self.byte_id[np.frombuffer(data, np.uint8)]
        last = np.zeros(len(ids), bool)
        last[np.cumsum(size) - 1] = True
        rank = np.full(len(ids), NEVER, np.int64)
        inner = np.flatnonzero(~last)
        rank[inner] = self.ranks(ids[inner], ids[inner + 1])
        while len(live):
            lowest = np.minimum.reduceat(rank, np.cumsum(size) - size)
            done = lowest == NEVER
            if done.any():
                out[live[done]] = size[done]
                stay = np.repeat(~done, size)
                ids, last, rank = ids[stay], last[stay], rank[stay]
                live, size, lowest = live[~done], size[~done], lowest[~done]
                if not len(live):
                    break
            at = np.flatnonzero(rank == np.repeat(lowest, size))
            # in a chain of overlapping occurrences (aaa) every second merges, from the left
            chain = np.ones(len(at), bool)
            chain[1:] = at[1:] != at[:-1] + 1
            head = np.maximum.accumulate(np.where(chain, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - head) % 2 == 0]
            ids[at] = self.merged[rank[at]]
            last[at] = last[at + 1]
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            owner = np.repeat(np.arange(len(live)), size)
            size = size - np.bincount(owner[at], minlength=len(live))
            moved = at - np.arange(len(at))  # place after the removals
            ids, last, rank = ids[stay], last[stay], rank[stay]
            again = np.unique(np.concatenate([moved, moved[moved > 0] - 1]))
            rank[again] = NEVER
            again = again[~last[again]]
            rank[again] = self.ranks(ids[again], ids[again + 1])
        return out


@functools.lru_cache(maxsize=1)
def counter(path: str):
    """texts -> token counts, with this worker's memo."""
    from tillroll.llm.pretokens import Memo, Scheme, slices

    scheme, merger = Scheme(path), Merger(path)

    def solve(pretokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = [p.encode() for p in pretokens]
        plain = merger.counts(b"".join(raw), np.fromiter(map(len, raw), np.int64, len(raw)))
        special = np.fromiter((p in scheme.specials for p in pretokens), bool, len(raw))
        return np.where(special, 1, plain).astype(np.int32), np.ones(len(raw), np.int32)

    memo = Memo(scheme, solve)

    def count(texts: list[str]) -> np.ndarray:
        totals = np.zeros(len(texts), np.int64)
        for joined, seg_at, special, docs in slices(scheme, texts):
            starts, ends, keys = scheme.tokens(joined, seg_at, special)
            if len(starts):
                each = memo.values(memo.slots(joined, starts, ends, keys))
                owner = docs[np.searchsorted(seg_at, starts, "right") - 1]
                totals += np.bincount(owner, each, len(texts)).astype(np.int64)
        return totals

    return count


def token_counts(docs: DataFrame, path: str, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns and n_tokens long of each row."""
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("n_tokens", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for b in batches:
            n = count([t or "" for t in b.column(len(keep)).to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.array(n, pa.int64())], [*keep, "n_tokens"])

    return map_batches(docs.select(*keep, F.col(text).alias("_text")), run, schema)


def op1(spark, sf_dir: str, limit: int = 1024) -> DataFrame:
    import public_tokenizers

    from tillroll.llm.common import read

    docs = read(spark, sf_dir, "documents")
    docs = docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    counts = token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), ("doc_id", "n_bytes"))
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
