"""Ranked lexical search over a length-stratified index.

The index keeps, of every document, its length and the queries' terms that it
holds with their frequencies.  A task searches it in blocks: a block's documents
are grouped into strata of equal normaliser m, each term's postings lie by
stratum and, within it, by descending frequency tf.  A term's impact depends on
m and tf only, so it is computed once per stratum and tf.  What a query can
reach in a stratum is bounded by the impacts of its terms' highest tf there;
strata are visited from the highest bound down, a few more at a time, until no
bound reaches the k-th best score so far, which a task carries from block to
block.  A task answers at most k documents an item, and Spark ranks the answers.

Queries are worked in blocks of at most ``QUERY_BYTES`` of text (a longer item
is a block of its own), so what is broadcast is bounded however many there are;
the statistics of a block's terms are summed over all documents.

Defined cases: NULL texts and texts without a term hold nothing, count in no
statistic and are never found; items without a term find nothing; an item's
repeated terms count each time; repeated documents and items are ranked each;
equal scores rank by doc_id, NULL first; very long texts are worked in slices;
empty tables give an empty result; other columns are not read.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import map_batches, save, small
from tillroll.llm.hashing import span_keys
from tillroll.llm.pretokens import ragged

K = 20
QUERY_BYTES = 1 << 22   # text of the items that are searched for at a time
PIECE_BYTES = 1 << 21   # text whose terms are found at a time
BLOCK_POSTINGS = 1 << 20  # postings of an index block, at most (one document at least)

# Bytes of a term: digits, letters, and every byte of a character beyond ASCII.  A-Z are lower-cased.
_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the terms of a byte array."""
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = _TERM[raw]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[::2], edge[1::2]


def terms(text: str | None) -> list[bytes]:
    raw = np.frombuffer((text or "").encode(), np.uint8)
    low = _LOWER[raw].tobytes()
    return [low[a:e] for a, e in zip(*[x.tolist() for x in spans(raw)])]


@dataclass
class Queries:
    """Items and their distinct terms; a block of queries."""

    ids: list
    words: list[bytes] = field(default_factory=list)
    use: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)  # of each item (terms, times)

    @classmethod
    def of(cls, rows: list[tuple]) -> Queries:
        place: dict[bytes, int] = {}
        use = []
        for _, text in rows:
            own = np.array([place.setdefault(t, len(place)) for t in terms(text)], np.int64)
            use.append(np.unique(own, return_counts=True))
        return cls([i for i, _ in rows], list(place), use)

    def finder(self):
        """(data, starts, ends) of spans -> the terms' numbers, -1 where no item has them."""
        sizes = np.fromiter(map(len, self.words), np.int64, len(self.words))
        data = np.frombuffer(b"".join(self.words), np.uint8)
        first = np.cumsum(sizes) - sizes
        keys = span_keys(data, first, first + sizes)
        order = np.argsort(keys)
        keys = keys[order]
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two terms share a 64-bit key")

        def find(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
            if not len(keys) or not len(starts):
                return np.full(len(starts), -1)
            of = span_keys(low, starts, ends)
            at = np.minimum(np.searchsorted(keys, of), len(keys) - 1)
            hit = np.flatnonzero((keys[at] == of) & (sizes[order[at]] == ends - starts))
            # equal keys are compared byte by byte
            word = order[at[hit]]
            same = ragged(data, first[word], sizes[word]) == ragged(low, starts[hit], sizes[word])
            wrong = np.zeros(len(hit), bool)
            wrong[np.repeat(np.arange(len(hit)), sizes[word])[~same]] = True
            out = np.full(len(starts), -1)
            out[hit[~wrong]] = word[~wrong]
            return out

        return find


def _slices(raw: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of at least PIECE_BYTES (the last: what is left) that no term crosses."""
    at = 0
    while at < len(raw):
        to = min(at + PIECE_BYTES, len(raw))
        while to < len(raw) and _TERM[raw[to]]:
            to += 1
        yield at, to
        at = to


def build(docs: DataFrame, queries: Queries) -> DataFrame:
    """The index rows (doc_id, n, terms, tf) of the documents with a term: its
    length and the queries' terms it holds, ascending, with their frequencies."""
    known = docs.sparkSession.sparkContext.broadcast(queries)  # at most QUERY_BYTES or one item

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, width = known.value.finder(), len(known.value.words) + 1
        for b in small(batches, 1024):
            texts = b.column(1).cast(pa.large_binary()).fill_null(b"")
            size = pc.binary_length(texts).to_numpy(zero_copy_only=False)
            # a blank between documents, so none of their terms touch
            joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array([0, len(texts)], pa.int64()), texts), pa.scalar(b" ", pa.large_binary()))
            raw = np.frombuffer(joined.buffers()[2] or b"", np.uint8)[:int(size.sum()) + max(0, len(texts) - 1)]
            begin = np.cumsum(size + 1) - size - 1
            n = np.zeros(len(texts), np.int64)
            held = []
            for a, e in _slices(raw):
                starts, ends = spans(raw[a:e])
                doc = np.searchsorted(begin, starts + a, "right") - 1
                n += np.bincount(doc, minlength=len(texts))
                word = find(_LOWER[raw[a:e]], starts, ends)
                hit = word >= 0
                held.append(np.unique(doc[hit] * width + word[hit], return_counts=True))
            keys, at = np.unique(np.concatenate([np.zeros(0, np.int64), *[k for k, _ in held]]), return_inverse=True)
            tf = np.zeros(len(keys), np.int64)
            np.add.at(tf, at, np.concatenate([np.zeros(0, np.int64), *[c for _, c in held]]))
            cuts = pa.array(np.searchsorted(keys, np.arange(len(texts) + 1) * width), pa.int32())
            lists = [pa.ListArray.from_arrays(cuts, pa.array(v, t)) for v, t in ((keys % width, pa.int32()), (tf, pa.int64()))]
            out = pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), *lists], ["doc_id", "n", "terms", "tf"])
            yield out.filter(pa.array(n > 0))

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, n long, terms array<int>, tf array<long>")


def weights(index: DataFrame, n_words: int) -> tuple[int, int, np.ndarray]:
    """(N, L, the weight of each query term) over the whole index."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_words, np.int64)
        for b in batches:
            df += np.bincount(b.column(0).flatten().to_numpy(zero_copy_only=False), minlength=n_words)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(df[at], pa.int64())], ["term", "df"])

    docs, length = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(n_words, np.int64)
    # one row a term of the block of queries
    for r in map_batches(index.select("terms"), count, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]
    return docs, length, np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


class Best:
    """The k best of an item so far: score descending, then doc_id, NULL first."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.doc, self.known = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self) -> int:
        """What a document must score at least to matter."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc: np.ndarray, known: np.ndarray) -> None:
        score, doc, known = (np.concatenate(x) for x in ((self.score, score), (self.doc, doc), (self.known, known)))
        keep = np.lexsort((doc, known, -score))[:self.k]
        self.score, self.doc, self.known = score[keep], doc[keep], known[keep]


class Block:
    """Documents by stratum; postings by term, stratum, and tf from the highest."""

    def __init__(self, doc: np.ndarray, known: np.ndarray, n: np.ndarray, owner: np.ndarray, term: np.ndarray, tf: np.ndarray, docs: int, length: int):
        self.doc, self.known = doc, known
        self.m, stratum = np.unique(75 + 25 * n * docs // length, return_inverse=True)
        s = stratum[owner]
        order = np.lexsort((-tf, s, term))
        self.owner, s, term, tf = owner[order], s[order], term[order], tf[order]
        # the impact of each (stratum, tf), once
        keys, at = np.unique(s * (tf.max(initial=0) + 1) + tf, return_inverse=True)
        of, f = np.divmod(keys, tf.max(initial=0) + 1)
        self.impact = (1_000_000_000 * f // (1000 * f + 12 * self.m[of]))[at]
        new = np.ones(len(term), bool)
        new[1:] = (term[1:] != term[:-1]) | (s[1:] != s[:-1])
        self.start = np.flatnonzero(new)              # of each (term, stratum): its postings,
        self.size = np.diff(np.append(self.start, len(term)))
        self.stratum = s[self.start]
        self.most = self.impact[self.start]           # and its highest impact
        self.of_term = term[self.start]

    def search(self, words: np.ndarray, weight: np.ndarray, best: Best) -> None:
        """Add to ``best`` what it lacks; ``weight`` of each of the ascending ``words``."""
        first, last = np.searchsorted(self.of_term, words), np.searchsorted(self.of_term, words, "right")
        lists = ragged(np.arange(len(self.start)), first, last - first)
        w = np.repeat(weight, last - first)
        bound = np.zeros(len(self.m), np.int64)
        np.add.at(bound, self.stratum[lists], w * self.most[lists])
        visit = np.argsort(-bound, kind="stable")
        rank = np.empty(len(visit), np.int64)
        rank[visit] = np.arange(len(visit))
        turn = rank[self.stratum[lists]]
        at, step = 0, 1
        while at < len(visit) and bound[visit[at]] >= best.least:
            now = np.flatnonzero((turn >= at) & (turn < at + step))
            mine, size = lists[now], self.size[lists[now]]
            owner = ragged(self.owner, self.start[mine], size)
            found, place = np.unique(owner, return_inverse=True)
            score = np.zeros(len(found), np.int64)
            np.add.at(score, place, np.repeat(w[now], size) * ragged(self.impact, self.start[mine], size))
            keep = np.flatnonzero(score >= best.least)
            best.add(score[keep], self.doc[found[keep]], self.known[found[keep]])
            at, step = at + step, 2 * step


def _blocks(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows with at most BLOCK_POSTINGS postings, one row at least."""
    ends = np.cumsum(pc.list_value_length(b.column(2)).to_numpy(zero_copy_only=False))
    at = 0
    while at < b.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK_POSTINGS, "right")))
        yield b.slice(at, to - at)
        at = to


def answers(index: DataFrame, queries: Queries, docs: int, length: int, weight: np.ndarray, k: int = K) -> DataFrame:
    """(item, doc_id, score): each task's k best documents of each item (its place in ``queries``)."""
    known = index.sparkSession.sparkContext.broadcast((queries.use, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use, w = known.value
        best = [Best(k) for _ in use]
        for batch in batches:
            for b in _blocks(batch):
                size = pc.list_value_length(b.column(2)).to_numpy(zero_copy_only=False)
                term, tf = (b.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in (2, 3))
                ids = b.column(0)
                block = Block(ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False), b.column(1).to_numpy(),
                              np.repeat(np.arange(b.num_rows), size), term, tf, docs, length)
                for (words, times), found in zip(use, best):
                    block.search(words, w[words] * times, found)
        for item, found in enumerate(best):
            if len(found.score):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found.score), item), pa.int32()), pa.array(found.doc, pa.int64(), mask=~found.known),
                                                  pa.array(found.score, pa.int64())], ["item", "doc_id", "score"])

    return map_batches(index, run, "item int, doc_id long, score long")


def query_blocks(items: DataFrame) -> DataFrame:
    """(block, item_id, text): items in blocks of at most QUERY_BYTES of text on average."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    total = items.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]  # one number
    blocks = max(1, -(-total // QUERY_BYTES))
    return items.select(F.pmod(F.xxhash64("item_id", F.monotonically_increasing_id()), F.lit(blocks)).alias("block"), "item_id", "text")


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): of each item of ``items`` (item_id, text)
    the ``k`` documents of ``docs`` (doc_id, text) that score highest."""
    spark = docs.sparkSession
    dealt = save(query_blocks(items), "search-items")
    out = None
    for row in dealt.select("block").distinct().orderBy("block").collect():  # one number for each QUERY_BYTES of items
        rows = dealt.where(F.col("block") == row["block"]).orderBy("item_id", "text").collect()  # a block of items
        queries = Queries.of([(r["item_id"], r["text"]) for r in rows])
        index = save(build(docs, queries), "search-index")
        n, length, weight = weights(index, len(queries.words))
        found = answers(index, queries, n, length, weight, k)
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
        names = spark.createDataFrame([(i, x) for i, x in enumerate(queries.ids)], f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).join(names, "item")
        ranked = ranked.select("item_id", "rank", "doc_id", "score")
        out = ranked if out is None else out.unionByName(save(ranked, "search-found"))
    return out if out is not None else spark.createDataFrame([], f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long")


def op13(spark, sf_dir: str) -> DataFrame:
    from tillroll.llm.common import read

    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def oracle(docs: str = "documents", items: str = "benchmark", k: int = K) -> str:
    """DuckDB SQL for op13's rows."""
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS doc, doc_id, {words} AS words FROM {docs}),
tot AS (SELECT count(*)::BIGINT AS n, sum(len(words))::BIGINT AS l FROM d WHERE len(words) > 0),
p AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(words) AS term FROM d) GROUP BY ALL),
i AS (SELECT item, item_id, term, count(*) AS times FROM (SELECT item, item_id, unnest(words) AS term
    FROM (SELECT row_number() OVER () AS item, item_id, {words} AS words FROM {items})) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * count(doc) + 1)::DOUBLE))::BIGINT AS w
    FROM (SELECT DISTINCT term FROM i) LEFT JOIN p USING (term), tot GROUP BY term, n),
s AS (SELECT item, item_id, doc, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(words) * n) // l))))::BIGINT AS score
    FROM i JOIN w USING (term) JOIN p USING (term) JOIN d USING (doc), tot GROUP BY ALL),
r AS (SELECT item_id, (row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST))::INT AS rank, doc_id, score
    FROM s JOIN d USING (doc) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= {k}"""
