"""Source divergence audit: how far the sources of a language differ in words.

Counting is by length-bucketed packing.  Terms of up to 8 bytes become one
64-bit word and those of up to 16 two (first byte highest), which a
least-significant-digit radix sort orders and a pass over the runs counts.
Longer terms lie in buckets of equal padded length, sorted there as bytes.  A
piece's documents are put in the order of their groups first, so after one
stable sort the runs of a term are its documents, group by group: their lengths
are the counts, their number is the document frequency.  Spark sums the pieces.

A language keeps the terms in at least ``LEAST_DOCS`` of its documents.  Shares
are smoothed and exact: 1 + floor(10**9 (count + 5) / (N + 5 V)).  Differences
between a language's sources are summed over blocks of its terms, each a matrix
of sources by terms of at most ``CELLS`` cells on average, so neither a common
term nor a hot source meets in one task; only sums leave a block.  A source's 50
leading terms against its language are ranked by Spark, which cuts each task's
rows to 50 a source before it shuffles them.

Defined cases: NULL text, lang and source are empty ones; a group without terms
has all counts 0; a language without kept terms has V = 0 and its sources differ
by 0; a lone source has no pairs; repeated rows are documents of their own; ties
go by the item's UTF-8 bytes; very long texts are counted in slices, whose
distinct terms are put together; an empty table gives an empty result; other
columns are not read.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import map_batches, save, strings
from tillroll.llm.pretokens import ragged

LEAST_DOCS, TOP = 30, 50
SMOOTHING, SCALE = 5, 1_000_000_000
PIECE_BYTES = 1 << 22   # text that is counted at a time
CELLS = 1 << 15         # cells of a block's matrix, on average (more where there are more than its square root of sources)

# Bytes of a term: letters, and every byte of a character beyond ASCII.  A-Z are lower-cased.
_TERM = np.zeros(256, bool)
_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """The stable ascending order of tuples of uint64 (most significant word
    first): one pass for each 16-bit digit in which they differ, lowest first."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        differ = int(np.bitwise_or.reduce(word ^ word[:1])) if len(word) else 0
        for shift in range(0, 64, 16):
            if differ >> shift & 0xFFFF:
                digit = (word[order] >> np.uint64(shift)).astype(np.uint16)
                order = order[np.argsort(digit, kind="stable")]  # numpy sorts 16-bit integers by radix
    return order


def pack(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, words: int) -> list[np.ndarray]:
    """Terms of at most 8 * ``words`` bytes as big-endian words, padded with
    zeros; no term has a zero byte, so equal words are equal terms."""
    room = np.concatenate([data, np.zeros(8 * words, np.uint8)])
    grid = room[starts[:, None] + np.arange(8 * words)]
    grid[np.arange(8 * words) >= sizes[:, None]] = 0
    return list(np.ascontiguousarray(grid).view(">u8").astype(np.uint64).T)


def _buckets(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(terms in order, whether each differs from the one before) of each length bucket."""
    for low, high, words in ((0, 8, 1), (8, 16, 2)):
        at = np.flatnonzero((sizes > low) & (sizes <= high))
        if len(at):
            packed = pack(data, starts[at], sizes[at], words)
            order = radix_order(packed)
            new = np.ones(len(at), bool)
            new[1:] = np.logical_or.reduce([w[order[1:]] != w[order[:-1]] for w in packed])
            yield at[order], new
    long = np.flatnonzero(sizes > 16)
    padded = -(-sizes[long] // 16) * 16
    for width in np.unique(padded).tolist():
        at = long[padded == width]
        room = np.zeros((len(at), width), np.uint8)
        inside = np.arange(width) < sizes[at][:, None]
        room[inside] = ragged(data, starts[at], sizes[at])
        terms = room.view(f"S{width}").ravel()
        order = np.argsort(terms, kind="stable")
        new = np.ones(len(at), bool)
        new[1:] = terms[order[1:]] != terms[order[:-1]]
        yield at[order], new


def find_terms(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, sizes, document) of the terms of documents that lie end to end;
    ``ends``: where each document ends."""
    inside = _TERM[raw]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    cuts = ends[:-1][ends[:-1] < len(raw)]
    begin[cuts] = inside[cuts]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    cuts = cuts[cuts > 0] - 1
    stop[cuts] = inside[cuts]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(stop) + 1 - starts, np.searchsorted(ends, starts, "right")


def count_terms(raw: np.ndarray, ends: np.ndarray, group: np.ndarray) -> Iterator[tuple]:
    """(data, starts, sizes, groups, occurrences, documents) of each bucket's
    distinct (term, group).  ``group`` of each document, ascending."""
    starts, sizes, doc = find_terms(raw, ends)
    data = _LOWER[raw]
    for order, new in _buckets(data, starts, sizes):
        d = doc[order]
        g = group[d]
        change, seen = new.copy(), new.copy()
        change[1:] |= g[1:] != g[:-1]
        seen[1:] |= d[1:] != d[:-1]
        first = np.flatnonzero(change)
        occurrences = np.diff(np.append(first, len(order)))
        yield data, starts[order[first]], sizes[order[first]], g[first], occurrences, np.add.reduceat(seen.astype(np.int64), first)


def _pieces(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(from, to) of runs of rows of at most PIECE_BYTES each, one row at least."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + PIECE_BYTES, "right")))
        yield at, to
        at = to


def _long_text(raw: np.ndarray) -> tuple:
    """As count_terms for one very long document: slices cut between terms,
    their distinct terms put together."""
    total: Counter[bytes] = Counter()
    at = 0
    while at < len(raw):
        to = min(at + PIECE_BYTES, len(raw))
        if to < len(raw):
            gap = np.flatnonzero(~_TERM[raw[to:]][:PIECE_BYTES])
            while not len(gap) and to < len(raw):  # a term longer than a piece
                to = min(to + PIECE_BYTES, len(raw))
                gap = np.flatnonzero(~_TERM[raw[to:]][:PIECE_BYTES])
            to += int(gap[0]) if len(gap) else 0
        one = np.array([to - at])
        for data, starts, sizes, _, n, _ in count_terms(raw[at:to], one, np.zeros(1, np.int64)):
            for s, z, c in zip(starts.tolist(), sizes.tolist(), n.tolist()):
                total[data[s:s + z].tobytes()] += c
        at = to
    sizes = np.fromiter(map(len, total), np.int64, len(total))
    data = np.frombuffer(b"".join(total), np.uint8)
    return data, np.cumsum(sizes) - sizes, sizes, np.zeros(len(total), np.int64), np.fromiter(total.values(), np.int64, len(total)), np.ones(len(total), np.int64)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of ``docs`` (lang, source, text): how often
    a group has a term, and in how many of its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).cast(pa.large_binary())
            for a, e in _pieces(texts):
                keys = pa.table({"lang": b.column(0)[a:e], "source": b.column(1)[a:e]})
                names = keys.group_by(["lang", "source"]).aggregate([])
                index = {(x, y): i for i, (x, y) in enumerate(zip(*[names[c].to_pylist() for c in ("lang", "source")]))}
                group = np.array([index[k] for k in zip(*[keys[c].to_pylist() for c in ("lang", "source")])], np.int64)
                order = np.argsort(group, kind="stable")
                piece = texts[a:e].take(pa.array(order))
                sizes = pc.binary_length(piece).to_numpy(zero_copy_only=False)
                offset = np.frombuffer(piece.buffers()[1], np.int64)[piece.offset]
                raw = np.frombuffer(piece.buffers()[2] or b"", np.uint8)[offset:offset + int(sizes.sum())]
                found = [_long_text(raw)] if len(raw) > PIECE_BYTES else count_terms(raw, np.cumsum(sizes), group[order])
                for data, starts, lengths, g, n, d in found:
                    pick = pa.array(g)
                    yield pa.RecordBatch.from_arrays(
                        [names["lang"].combine_chunks().take(pick), names["source"].combine_chunks().take(pick), strings(data, starts, lengths), pa.array(n, pa.int64()), pa.array(d, pa.int64())],
                        ["lang", "source", "term", "n", "docs"])

    parts = map_batches(docs.select("lang", "source", "text"), run, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: str, total: str) -> Column:
    """1 + floor(SCALE (n + SMOOTHING) / total) of two SQL expressions, exact."""
    return F.expr(f"1 + CAST({n} + {SMOOTHING} AS DECIMAL(20,0)) * CAST({SCALE} AS DECIMAL(10,0)) div CAST({total} AS DECIMAL(20,0))")


def kept_shares(docs: DataFrame, least_docs: int = LEAST_DOCS) -> tuple[DataFrame, DataFrame]:
    """(groups, shares).  ``groups``: (lang, source, size, total, n_terms,
    lang_total, none) of every occurring group: N + 5 V of the group and of its
    language, and the share of a term that the group has not.  ``shares``:
    (lang, source, term, n, p, q) of the kept terms that a group has; p and q
    its share in the group and in the language."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    docs = docs.select(text("lang"), text("source"), text("text"))
    counts = save(term_counts(docs), "audit-counts")
    kept = (counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
            .where(F.col("docs") >= least_docs).select("lang", "term", "lang_n"))
    kept = save(counts.drop("docs").join(kept, ["lang", "term"]), "audit-kept")
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    langs = (kept.groupBy("lang", "term").agg(F.max("lang_n").alias("lang_n")).groupBy("lang")
             .agg(F.count(F.lit(1)).alias("n_terms"), F.sum("lang_n").alias("lang_size")))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    groups = (docs.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", zero("size"), zero("n_terms"), zero("lang_size")))
    groups = groups.withColumns({"total": F.col("size") + SMOOTHING * F.col("n_terms"), "lang_total": F.col("lang_size") + SMOOTHING * F.col("n_terms")})
    groups = save(groups.withColumn("none", F.when(F.col("n_terms") > 0, share("0", "total")).otherwise(0).cast("long")), "audit-groups")
    shares = (kept.join(groups.select("lang", "source", "total", "lang_total"), ["lang", "source"])
              .select("lang", "source", "term", "n", share("n", "total").alias("p"), share("lang_n", "lang_total").alias("q")))
    return groups, shares


def pair_sums(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """(lang, a, b, f) of each two sources a < b of a language with kept terms:
    the differences of their shares, summed over all its kept terms."""
    size = groups.where("n_terms > 0").groupBy("lang").agg(F.count(F.lit(1)).alias("_groups"), F.max("n_terms").alias("_terms"))
    # a block has at least as many terms as there are sources, so its sums are fewer than its cells
    terms = F.greatest(F.col("_groups"), F.lit(CELLS) / F.col("_groups"))
    size = size.select("lang", F.ceil(F.col("_terms") / terms).cast("long").alias("blocks"))
    cells = shares.join(size, "lang").select("lang", F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"), "source", "term", "p")
    sides = groups.join(size, "lang").select("lang", "source", "none", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))

    def sums(cells: pd.DataFrame, sides: pd.DataFrame) -> pd.DataFrame:
        sides = sides.sort_values("source", ignore_index=True)
        column, terms = pd.factorize(cells["term"])
        row = pd.Index(sides["source"]).get_indexer(cells["source"])
        p = np.repeat(sides["none"].to_numpy(np.int64)[:, None], len(terms), 1)
        p[row, column] = cells["p"].to_numpy(np.int64)
        out = [np.abs(p[i + 1:] - p[i]).sum(1) for i in range(len(p) - 1)]
        a = np.repeat(np.arange(len(p)), [len(p) - 1 - i for i in range(len(p))])
        b = np.concatenate([np.arange(i + 1, len(p)) for i in range(len(p))])
        name = sides["source"].to_numpy()
        names = {"lang": np.full(len(a), sides["lang"].iloc[0]), "a": name[a], "b": name[b]}
        return pd.DataFrame({c: pd.Series(v, dtype=object) for c, v in names.items()} | {"f": np.concatenate([*out, np.zeros(0, np.int64)])})

    parts = cells.groupBy("lang", "block").cogroup(sides.groupBy("lang", "block")).applyInPandas(sums, "lang string, a string, b string, f long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("f").alias("f"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` ranks a group
    against the other sources of its language, part ``term`` its ``top`` terms
    against its language."""
    groups, shares = kept_shares(docs, least_docs)
    shares = save(shares, "audit-shares")
    sums = pair_sums(groups, shares)
    both = sums.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "f").unionByName(
        sums.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "f"))
    names = groups.select("lang", "source")
    pairs = names.join(names.withColumnRenamed("source", "item"), "lang").where("source <> item")  # a row of the result each
    pairs = pairs.join(both, ["lang", "source", "item"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("f", F.lit(0)).alias("value"))
    terms = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    return ranked(pairs).unionByName(ranked(terms).where(F.col("rank") <= top))


def oracle(docs: str = "documents", least_docs: int = LEAST_DOCS, top: int = TOP) -> str:
    """DuckDB SQL for op12's rows."""
    share = lambda n, total: f"(1 + ({SCALE}::HUGEINT * ({n} + {SMOOTHING})) // ({total}))::BIGINT"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM {docs}),
w AS (SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT doc) >= {least_docs}),
l AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
c AS (SELECT w.lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT x.lang, x.source, coalesce(any_value(l.v), 0) AS v, coalesce(sum(c.n), 0) AS n
    FROM (SELECT DISTINCT lang, source FROM d) x LEFT JOIN l ON x.lang = l.lang LEFT JOIN c ON x.lang = c.lang AND x.source = c.source GROUP BY ALL),
s AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, {share("coalesce(c.n, 0)", f"g.n + {SMOOTHING} * g.v")} AS p,
    {share("k.n", f"l.n + {SMOOTHING} * l.v")} AS q
    FROM g JOIN kept k ON g.lang = k.lang JOIN l ON l.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.f, 0)::BIGINT AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
    UNION ALL SELECT lang, source, 'term', term, p - q FROM s WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank FROM (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)))::INT AS rank FROM r)
WHERE part = 'pair' OR rank <= {top}"""


def op12(spark, sf_dir: str) -> DataFrame:
    from tillroll.llm.common import read

    return audit(read(spark, sf_dir, "documents"))
