"""N-gram Jaccard join by T-occurrence search.

Documents are sets of word shingles; two link when their Jaccard coefficient
is at least ``percent`` / 100.  Sets of x and y tokens then share at least
T = ceil(percent (x + y) / (100 + percent)) of them, so a document is found by
counting in how many inverted lists of the query's tokens it occurs.  As in
DivideSkip, the lists are divided into long and short ones, only the short
ones are merged, and the long ones are probed for what the merge found:

* Between tasks, as many of the longest lists are set aside as the least T of
  a set allows (T - 1), so what remains must share a token of the short lists.
  Which lists are long is told by a counting sketch of all tokens of all
  documents; it only orders them, any order gives the same links.  Spark merges
  the short lists by shuffling (token, document).
* Within a task, a query meets a block of the documents that the merge found:
  their inverted lists are divided again, the short ones heap-merged, documents
  that reach T less the number of long lists probe those by binary search, and
  those that reach T are links.

Equal sets are one class, known by a number of its own, and no pairs within a
group are listed.  Each short list gives pairs of its first member with the
others only (as many as the list is long), and once more pairs of another member
with those that are not joined to it; verified, they join most copies.
Members of a list that are then still in different components are compared in a
second round, as components: those that share a list meet in salted blocks in a
task, where size ranges and histograms bound the overlap that any two of their
members can have; only those that no bound keeps apart leave it.  If the first
members of two components do not link but others may, by the triangle
inequality, the smaller one's members within reach are queries to the inverted
lists of the larger one, block by block, until the first link: it joins them.

Links are counted apart (``jaccard_links``): they lie within components, so a
component's classes are dealt to salted blocks, each pair of blocks meets in a
task, and a query counts in how many inverted lists of its tokens each class of
the other block occurs.  Only the counts leave the task.

Defined cases: NULL and blank texts have no shingles and link with nothing;
texts shorter than a shingle are one shingle, their word sequence; repeated
rows are equal sets; rows that share a doc_id and have different sets are
documents of their own, each linked by its own text; a row without doc_id joins
like any other, but a component of such rows only has no component_id; very
long texts are worked in slices; an empty table gives an empty result; other
columns are not read.
"""
from __future__ import annotations

import heapq
import itertools
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import connected_components, map_batches, save, ship, small
from tillroll.llm.hashing import mix, span_keys

WORDS, PERCENT = 4, 85
BATCH_BYTES = 1 << 18
SKETCH_BITS = 20            # counters of the sketch of list lengths (4 MB)
CHUNK = 1 << 12             # counters a row of it carries
BINS = 256                  # bins of a document's token histogram
BLOCK = 512                 # documents a query meets at a time, on average
GROUPS = 512                # components of a list that meet others at a time, on average
BLOCK_TOKENS = 1 << 21      # tokens of a block of classes whose links are counted, on average
LISTED = 1 << 20            # entries of inverted lists that are counted at a time
MU = 0.0085                 # DivideSkip's weight of merging against probing

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def _word_keys(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(key, start) of each word, A-Z lower-cased."""
    raw = np.frombuffer(data, np.uint8)
    space = np.ones(len(raw) + 2, bool)
    space[1:-1] = _SPACE[raw]
    edge = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edge[::2], edge[1::2]
    return span_keys(_LOWER[raw], starts, ends), starts


def shingle_sets(texts: list[str | None], words: int = WORDS) -> Iterator[np.ndarray]:
    """For each text its distinct shingles as ascending 64-bit keys."""
    group: list[bytes] = []
    held = 0

    def out(keys: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
        many = np.zeros(max(0, len(keys) - words + 1), np.uint64)
        for j in range(words):
            many += keys[j:len(keys) - words + 1 + j] * _ODD[j] if len(many) else many
        many = mix(many + np.uint64(words))
        at = 0
        for n in sizes.tolist():
            if n >= words:
                yield np.unique(many[at:at + n - words + 1])
            elif n:
                yield mix((keys[at:at + n] * _ODD[:n]).sum(dtype=np.uint64)[None] + np.uint64(n))
            else:
                yield np.empty(0, np.uint64)
            at += n

    def flush() -> Iterator[np.ndarray]:
        sizes = np.fromiter(map(len, group), np.int64, len(group)) + 1
        keys, starts = _word_keys(b" ".join(group))
        yield from out(keys, np.diff(np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))))

    for t in texts:
        b = (t or "").encode()
        if held + len(b) > BATCH_BYTES and group:
            yield from flush()
            group, held = [], 0
        if len(b) > 2 * BATCH_BYTES:  # a very long text: its words slice by slice, cut at white space
            keys, a = [], 0
            while a < len(b):
                e = a + BATCH_BYTES
                while e < len(b) and not _SPACE[b[e]]:
                    e += 1
                keys.append(_word_keys(b[a:e])[0])
                a = e
            joined = np.concatenate(keys)
            yield from out(joined, np.array([len(joined)]))
        else:
            group.append(b)
            held += len(b)
    if group:
        yield from flush()


def _sketch(docs: DataFrame, words: int) -> np.ndarray:
    """How many documents hold the tokens of each counter, over all documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for b in small(batches):
            sets = shingle_sets(b.column(0).to_pylist(), words)
            while some := list(itertools.islice(sets, 256)):
                total += np.bincount((np.concatenate(some) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(total))
        yield from rows({c: total[c * CHUNK:(c + 1) * CHUNK] for c in range(len(total) // CHUNK)})

    def rows(parts: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        filled = {c: np.flatnonzero(v) for c, v in parts.items() if v.any()}
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(filled), pa.int32()), pa.array([at.astype(np.uint16).tobytes() for at in filled.values()], pa.binary()),
             pa.array([parts[c][at].tobytes() for c, at in filled.items()], pa.binary())], ["chunk", "at", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for b in batches:
            for c, at, n in zip(*[x.to_pylist() for x in b.columns]):
                parts.setdefault(c, np.zeros(CHUNK, np.int64))[np.frombuffer(at, np.uint16)] += np.frombuffer(n, np.int64)
        yield from rows(parts)

    kind = "chunk int, at binary, n binary"
    out = np.zeros(1 << SKETCH_BITS, np.int64)
    for r in map_batches(map_batches(docs.select("text"), count, kind).repartition("chunk"), add, kind).collect():  # the sketch's size
        out[r["chunk"] * CHUNK + np.frombuffer(r["at"], np.uint16).astype(np.int64)] = np.frombuffer(r["n"], np.int64)
    return out


def least_overlap(n: int, percent: int) -> int:
    """What a set of n shares at least with any set it links with."""
    return -(-percent * n // 100)


def _set_hash(s: np.ndarray) -> tuple[int, int]:
    """A 128-bit hash of a set."""
    return int(mix(s).sum(dtype=np.uint64).astype(np.int64)), int(np.bitwise_xor.reduce(mix(s + _ODD[0]), initial=np.uint64(0)).astype(np.int64))


def _described(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, tag, n, h1, h2: a 128-bit hash of the set, bins: its histogram,
    short: the tokens whose lists are merged, shortest list first)."""
    spark = docs.sparkSession
    lengths = spark.sparkContext.broadcast(_sketch(docs, words).astype(np.uint32))  # 2**SKETCH_BITS counters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            out = []
            for s in shingle_sets(b.column(2).to_pylist(), words):
                first = s[np.lexsort((s, lengths.value[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]))[:len(s) - least_overlap(len(s), percent) + 1]] if len(s) else s
                bins = np.bincount((s & np.uint64(BINS - 1)).astype(np.int64), minlength=BINS)
                out.append((len(s), *_set_hash(s),
                            bins.astype(np.uint8).tobytes() if bins.max() < 256 else None, first.astype(np.int64)))
            cols = list(zip(*out)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(c, t) for c, t in zip(cols, kinds)]],
                                             ["doc_id", "tag", "n", "h1", "h2", "bins", "short"])

    return save(map_batches(docs.select("doc_id", "tag", "text"), run,
                            "doc_id long, tag binary, n long, h1 long, h2 long, bins binary, short array<long>"), "join-sets")


def divide_skip(query: np.ndarray, others: list[np.ndarray], percent: int) -> list[int]:
    """The indices of ``others`` that link with ``query``: T-occurrence search
    over the inverted lists of the query's tokens."""
    sizes = [len(o) for o in others]
    need = [-(-percent * (len(query) + n) // (100 + percent)) for n in sizes]
    tokens = np.concatenate(others)
    owner = np.repeat(np.arange(len(others)), sizes)
    at = np.searchsorted(query, tokens)
    known = np.flatnonzero((at < len(query)) & (query[np.minimum(at, len(query) - 1)] == tokens))
    at, owner = at[known], owner[known]
    order = np.lexsort((owner, at))
    cuts = np.flatnonzero(np.diff(at[order])) + 1
    lists = [x.tolist() for x in np.split(owner[order], cuts)] if len(order) else []
    lists.sort(key=len)
    least = min(need)
    if len(lists) < least:
        return []
    long = min(least - 1, int(least / (MU * max(1, len(lists[-1])).bit_length() + 1)))
    short, long_lists = lists[:len(lists) - long], lists[len(lists) - long:]
    found = []
    for doc, run in itertools.groupby(heapq.merge(*short)):
        n, left = sum(1 for _ in run), long
        if n + left < need[doc]:
            continue
        for l in long_lists:
            if n >= need[doc] or n + left < need[doc]:
                break
            i = bisect_left(l, doc)
            n += i < len(l) and l[i] == doc
            left -= 1
        if n >= need[doc]:
            found.append(doc)
    return found


def _possible(pairs: DataFrame, about: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that may link, or whose groups may: two sets share at
    most what their histograms do, so their distance is at least that much,
    and their groups' members are nearer by the radii at most.
    ``about``: (id, n, bins, radius)."""
    side = lambda c: about.select(F.col("id").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("n", "bins", "radius")])
    wide = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select(
        "a", "b", (F.col("n_a") + F.col("n_b")).alias("n"), (F.col("radius_a") + F.col("radius_b")).alias("radius"), "bins_a", "bins_b")
    limit = 1 - percent / 100 + 1e-9

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 2048):
            n, radius = b.column(2).to_numpy(), b.column(3).to_numpy()
            keep = np.ones(b.num_rows, bool)
            both = np.flatnonzero(b.column(4).is_valid().to_numpy(zero_copy_only=False) & b.column(5).is_valid().to_numpy(zero_copy_only=False))
            if len(both):
                x, y = (np.frombuffer(b"".join(b.column(c).take(pa.array(both)).to_pylist()), np.uint8).reshape(-1, BINS) for c in (4, 5))
                shared = np.minimum(x, y).sum(1, dtype=np.int64)
                keep[both] = 1 - shared / np.maximum(1, n[both] - shared) - radius[both] <= limit
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(mask), b.column(1).filter(mask)], ["a", "b"])

    return map_batches(wide, run, "a long, b long")


def _sets_of(ids: DataFrame, classes: DataFrame, docs: DataFrame, words: int, name: str) -> DataFrame:
    """(id, set) of the classes ``ids`` (id): the set of their first row."""
    wanted = classes.join(ids, "id", "left_semi").select("id", F.col("rep.doc_id").alias("_doc"), F.col("rep.tag").alias("_tag"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            found = [s.tobytes() for s in shingle_sets(b.column(1).to_pylist(), words)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.binary())], ["id", "set"])

    # rows that are equal in doc_id and text have one set; the first stands for them
    rows = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["_doc"]) & (docs["tag"] == wanted["_tag"])).select("id", "text").dropDuplicates(["id"])
    return save(map_batches(rows, sets, "id long, set binary"), f"{name}-sets")


def _meet(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, name: str, answer) -> DataFrame:
    """(a, b, value) of the pairs (a, b) of classes for which ``answer``(set of
    a, sets of a block of its b) names one: (index, value)."""
    pairs = save(pairs, f"{name}-candidates")
    held = _sets_of(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct(), classes, docs, words, name)
    sizes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    dealt = pairs.join(sizes, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("blocks")).alias("block"))
    others = dealt.join(held, dealt["b"] == held["id"]).select("a", "block", "b", "set")
    queries = dealt.select("a", "block").distinct().join(held, F.col("a") == held["id"]).select("a", "block", F.lit(None).cast("long").alias("b"), "set")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, query, ids, others = None, None, [], []

        def out() -> pa.RecordBatch:
            hits = answer(query, others) if others and query is not None else []
            return pa.RecordBatch.from_arrays([pa.array([key[0]] * len(hits), pa.int64()), pa.array([ids[i] for i, _ in hits], pa.int64()),
                                               pa.array([v for _, v in hits], pa.float64())], ["a", "b", "value"])

        for b in small(batches):
            for a, block, other, s in zip(*[c.to_pylist() for c in b.columns]):
                if key != (a, block):
                    if key:
                        yield out()
                    key, query, ids, others = (a, block), None, [], []
                if other is None:
                    query = np.frombuffer(s, np.uint64)
                else:
                    ids.append(other)
                    others.append(np.frombuffer(s, np.uint64))
        if key:
            yield out()

    together = others.unionByName(queries).repartition("a", "block").sortWithinPartitions("a", "block", F.col("b").asc_nulls_first())
    return save(map_batches(together, search, "a long, b long, value double"), f"{name}-found")


def _links(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int, name: str) -> DataFrame:
    """The pairs that link, by T-occurrence search with a as the query."""
    return _meet(pairs, classes, docs, words, name, lambda query, others: [(i, 0.0) for i in divide_skip(query, others, percent)]).select("a", "b")


def _distances(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, name: str) -> DataFrame:
    """(a, b, value): the Jaccard distances of the pairs."""
    def answer(query: np.ndarray, others: list[np.ndarray]) -> list[tuple[int, float]]:
        out = []
        for i, o in enumerate(others):
            shared = int((query[np.minimum(np.searchsorted(query, o), len(query) - 1)] == o).sum())
            out.append((i, 1 - shared / (len(query) + len(o) - shared)))
        return out

    return _meet(pairs, classes, docs, words, name, answer)


def _tag() -> Column:
    """A 128-bit hash of the text, which tells texts of one doc_id apart."""
    return F.unhex(F.md5(F.coalesce("text", F.lit(""))))


def _tagged(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _tag().alias("tag"), "text")


def jaccard_join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of ``docs`` (doc_id, text)."""
    sets, placed = _joined(_tagged(docs), words, percent)
    return (sets.select("doc_id", "h1", "h2", "n").join(placed, ["h1", "h2", "n"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with one row of each
    component, that of the smallest doc_id (a NULL one last, then the text's
    hash); rows without shingles stay, repeated ones (equal doc_id and text) once."""
    tagged = docs.withColumns({"_join_id": F.col("doc_id").cast("long"), "_join_tag": _tag()})
    sets, placed = _joined(_tagged(docs), words, percent)
    rows = sets.select("doc_id", "tag", "h1", "h2", "n").join(placed, ["h1", "h2", "n"], "left")
    first = rows.where("n > 0").groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tag")).alias("_f"))
    kept = (first.select(F.col("_f.doc_id").alias("_kept"), F.col("_f.tag").alias("_of"))
            .unionByName(rows.where("n = 0").select(F.col("doc_id").alias("_kept"), F.col("tag").alias("_of")).distinct()))
    found = tagged.join(kept, F.col("_join_id").eqNullSafe(F.col("_kept")) & (F.col("_join_tag") == F.col("_of")), "left_semi")
    return found.dropDuplicates(["_join_id", "_join_tag"]).select(docs.columns)


def jaccard_links(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of each row of ``docs``:
    n_links is the number of other documents with an id that it links with,
    equal sets included.  A class without any id links with nothing."""
    docs = _tagged(docs)
    sets, placed = _joined(docs, words, percent)
    key = ["h1", "h2", "n"]
    size = sets.where("n > 0 AND doc_id IS NOT NULL").select(*key, "doc_id").distinct().groupBy(key).agg(F.count(F.lit(1)).alias("size"))
    placed = save(placed.join(size, key, "left"), "join-placed")
    near = _near_counts(placed, docs, words, percent)
    own = F.coalesce("size", F.lit(0)) - F.when(F.col("doc_id").isNotNull() & F.col("size").isNotNull(), 1).otherwise(0)
    return (sets.select("doc_id", *key).join(placed, key, "left").join(near, key, "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"),
                    (own + F.coalesce("near", F.lit(0))).alias("n_links")))


def near_links(queries: Iterable[np.ndarray], others: list[np.ndarray], percent: int) -> Iterator[np.ndarray]:
    """For each query which of ``others`` link with it, by counting in how many
    inverted lists of the query's tokens each of them occurs."""
    sizes = np.fromiter(map(len, others), np.int64, len(others))
    tokens = np.concatenate(others)
    order = np.argsort(tokens, kind="stable")
    owner = np.repeat(np.arange(len(others), dtype=np.int32), sizes)[order]
    known, starts = np.unique(tokens[order], return_index=True)
    ends = np.append(starts[1:], len(tokens))
    for q in queries:
        at = np.searchsorted(known, q)
        at = at[(at < len(known)) & (known[np.minimum(at, len(known) - 1)] == q)]
        a, held = starts[at], ends[at] - starts[at]
        shared = np.zeros(len(others), np.int64)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(np.cumsum(held) // LISTED)) + 1, [len(at)]])
        for i, j in zip(cuts[:-1], cuts[1:]):  # a bounded number of entries at a time
            n = held[i:j]
            if len(n):
                spots = np.repeat(a[i:j] - np.cumsum(n) + n, n) + np.arange(n.sum())
                shared += np.bincount(owner[spots], minlength=len(others))
        yield 100 * shared >= percent * (len(q) + sizes - shared)


def _near_counts(placed: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(h1, h2, n, near): how many documents of other classes each class links with.
    ``placed``: (id, h1, h2, n, rep, group, component, size) of all classes."""
    key = ["h1", "h2", "n"]
    listed = placed.where("size IS NOT NULL")
    groups = listed.groupBy("group").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("tokens")).where("m > 1")
    # blocks of 8 sqrt(m) classes, and of a bounded number of tokens on average
    groups = groups.select("group", F.greatest(F.ceil(F.sqrt("m") / 8), F.ceil(F.col("tokens") / BLOCK_TOKENS)).alias("blocks"))
    members = save(listed.join(groups, "group").select("id", *key, F.col("group").alias("component"), "size", "blocks"), "links-members")
    held = members.join(_sets_of(members.select("id"), placed, docs, words, "links"), "id")
    block = F.pmod(F.xxhash64(*key), F.col("blocks"))
    dealt = (held.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("component", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", *key, "size", "set"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, left, right = None, [], []

        def out() -> pa.RecordBatch:
            found = []
            if at[1] == at[2]:
                sizes = np.array([r[3] for r in left], np.int64)
                for i, hit in enumerate(near_links([r[4] for r in left], [r[4] for r in left], percent)):
                    found.append((*left[i][:3], int(sizes[hit].sum() - sizes[i])))
            elif left and right:
                sizes, back = np.array([r[3] for r in right], np.int64), np.zeros(len(right), np.int64)
                for r, hit in zip(left, near_links([r[4] for r in left], [r[4] for r in right], percent)):
                    found.append((*r[:3], int(sizes[hit].sum())))
                    back += hit * r[3]
                found += [(*r[:3], int(n)) for r, n in zip(right, back)]
            cols = list(zip(*found)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], [*key, "near"])

        for b in small(batches):
            for c, x, y, own, h1, h2, n, size, s in zip(*[v.to_pylist() for v in b.columns]):
                if at != (c, x, y):
                    if at:
                        yield out()
                    at, left, right = (c, x, y), [], []
                (left if own == x else right).append((h1, h2, n, size, np.frombuffer(s, np.uint64)))
        if at:
            yield out()

    together = dealt.repartition("component", "x", "y").sortWithinPartitions("component", "x", "y")
    found = map_batches(together, count, "h1 long, h2 long, n long, near long")
    return save(found.groupBy(key).agg(F.sum("near").alias("near")), "links-near")


def _could(n1, p1, n2, p2, percent: int):
    """Sizes within reach of each other, and enough tokens left from the shared one on."""
    least, most = F.least(n1, n2), F.greatest(n1, n2)
    return (100 * least >= percent * most) & ((100 + percent) * F.least(n1 - p1, n2 - p2) >= percent * (n1 + n2))


def _mixed(lists: DataFrame, component: DataFrame) -> DataFrame:
    """``lists`` (token, id ...) with the members' ``group``, without the lists
    of one group only."""
    of = component.select(F.col("node").alias("id"), F.col("component").alias("group"))
    known = lists.join(of, "id", "left").withColumn("group", F.coalesce("group", "id"))
    several = known.groupBy("token").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).where("lo <> hi").select("token")
    return known.join(several, "token", "left_semi")


def _star(lists: DataFrame, first: Column, about: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int, name: str) -> DataFrame:
    """The links (a, b) of each list's least member by ``first`` with its members
    of other groups.  ``lists``: (token, id, n, pos, group)."""
    head = lists.groupBy("token").agg(F.min(F.struct(first.alias("order"), "id", "n", "pos", "group")).alias("head"))
    pairs = (lists.join(head, "token").where((F.col("group") != F.col("head.group")) & _could(F.col("n"), F.col("pos"), F.col("head.n"), F.col("head.pos"), percent))
             .select(F.col("head.id").alias("a"), F.col("id").alias("b")).distinct())
    return _links(_possible(pairs, about, percent), classes, docs, words, percent, name)


def _joined(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(the described sets of all rows, (id, h1, h2, n, rep, group, component) of
    their classes: ``rep`` a row of the class, ``group`` the classes that reach
    each other, ``component`` the smallest doc_id among them)."""
    ship(docs.sparkSession)
    key = ["h1", "h2", "n"]
    sets = _described(docs, words, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tag"))
    classes = sets.where("n > 0").groupBy(*key).agg(F.min("doc_id").alias("low"), first.alias("rep"))
    classes = save(classes.withColumn("id", F.monotonically_increasing_id()), "join-classes")  # saved, so the numbers stay
    reps = classes.select("id", F.col("rep.doc_id").alias("_doc"), F.col("rep.tag").alias("_tag"))
    firsts = save(sets.join(reps, sets["doc_id"].eqNullSafe(reps["_doc"]) & (sets["tag"] == reps["_tag"])).dropDuplicates(["id"])
                  .select("id", "doc_id", "n", "bins", "short"), "join-firsts")

    # the short lists with more than one member
    listed = firsts.select("id", "doc_id", "n", F.posexplode("short").alias("pos", "token"))
    long_enough = listed.groupBy("token").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    lists = save(listed.join(long_enough, "token"), "join-lists")
    about = firsts.select("id", "n", "bins", F.lit(0.0).alias("radius"))

    # stars: each list's members against one of them, first the one that comes first by doc_id, ...
    near = _star(lists.withColumn("group", F.col("id")), F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "id"),
                 about, classes, docs, words, percent, "join-1")
    component = connected_components(near, "join-components-1")
    # ... then one that is first by chance, against members that are not joined to it yet
    lists = save(_mixed(lists.where("size > 2"), component), "join-mixed")
    also = _star(lists, F.struct(F.xxhash64("id").alias("h"), "id"), about, classes, docs, words, percent, "join-2")
    near = save(near.unionByName(also), "join-near")
    component = connected_components(near, "join-components-2")
    lists = save(_mixed(lists.drop("group"), component), "join-rest")
    more = _between(lists, about, component, classes, docs, words, percent)
    if not more.isEmpty():
        component = connected_components(near.unionByName(more), "join-components-3")

    placed = classes.join(component.withColumnRenamed("node", "id"), "id", "left").withColumn("group", F.coalesce("component", "id")).drop("component")
    low = placed.groupBy("group").agg(F.min("low").alias("component"))
    return sets, placed.join(low, "group").select("id", *key, "rep", "group", "component")


def _near_groups(groups: DataFrame, percent: int) -> DataFrame:
    """The pairs a < b of components that share a list and that no bound keeps
    apart.  ``groups``: (token, group, least, most: the sizes of its members in
    the list, n, bins, radius: of the component's first document).  A list's
    components meet in blocks; only pairs within reach leave a task."""
    blocks = groups.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / GROUPS).alias("blocks"), F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    dealt = (groups.join(blocks, "token").withColumn("block", F.pmod(F.xxhash64("group"), F.col("blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("token", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "group", "least", "most", "n", "radius", "bins"))
    limit = 1 - percent / 100 + 1e-9

    def within(rows: list[tuple], x: int, y: int) -> Iterator[tuple[int, int]]:
        own, group, least, most, n, radius = (np.array(c) for c in list(zip(*rows))[:6])
        known = np.array([r[6] is not None for r in rows])
        bins = np.frombuffer(b"".join(r[6] or bytes(BINS) for r in rows), np.uint8).reshape(-1, BINS)
        right = np.flatnonzero(own == y)
        for i in np.flatnonzero(own == x).tolist():
            others = right[right > i] if x == y else right
            others = others[(100 * most[others] >= percent * least[i]) & (100 * most[i] >= percent * least[others]) & (group[others] != group[i])]
            shared = np.minimum(bins[others], bins[i]).sum(1, dtype=np.int64)
            far = 1 - shared / np.maximum(1, n[others] + n[i] - shared) - radius[others] - radius[i] > limit
            for j in others[~(far & known[others] & known[i])].tolist():
                yield min(group[i], group[j]), max(group[i], group[j])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, found = None, [], set()
        for b in itertools.chain(small(batches), [None]):
            for t, x, y, *row in zip(*[c.to_pylist() for c in b.columns]) if b is not None else [(None, None, None)]:
                if at != (t, x, y):
                    if len(rows) > 1:
                        found.update(within(rows, at[1], at[2]))
                    at, rows = (t, x, y), []
                rows.append(tuple(row))
            if found and (b is None or len(found) > 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])
                found = set()

    together = dealt.repartition("token", "x", "y").sortWithinPartitions("token", "x", "y")
    return map_batches(together, meet, "a long, b long").distinct()


def _first_links(wide: DataFrame, member: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int, name: str) -> DataFrame:
    """One link (a, b) at least of each two components of ``wide`` (x, y, value,
    r_x, r_y) that have one.  The larger component is at home: its members lie
    in blocks, once each, as inverted lists; those members of the smaller that
    are within reach visit every block as queries, up to their first link, found
    by counting.  ``member``: (id, group, d: its distance to the first one)."""
    limit = 1 - percent / 100 + 1e-9
    sizes = member.groupBy("group").agg(F.count(F.lit(1)).alias("m"))
    size = lambda c: sizes.select(F.col("group").alias(c), F.col("m").alias(f"m_{c}"))
    larger = F.col("m_x") >= F.col("m_y")
    pairs = wide.join(size("x"), "x").join(size("y"), "y").select(
        F.when(larger, F.col("x")).otherwise(F.col("y")).alias("home"), F.when(larger, F.col("y")).otherwise(F.col("x")).alias("guest"), "value",
        F.when(larger, F.col("r_x")).otherwise(F.col("r_y")).alias("r"), F.ceil(F.greatest("m_x", "m_y") / BLOCK).alias("blocks"))
    pairs = save(pairs, f"{name}-pairs")
    at_home = (pairs.select("home", "blocks").distinct().join(member, F.col("home") == F.col("group"))
               .select("home", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block"), F.lit(None).cast("long").alias("guest"), "id"))
    guests = (pairs.join(member, F.col("guest") == F.col("group")).where(F.col("value") - F.col("d") - F.col("r") <= limit)
              .select("home", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "guest", "id"))
    rows = save(at_home.unionByName(guests), f"{name}-members")
    held = _sets_of(rows.select("id").distinct(), classes, docs, words, name)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, lists, guests, linked = None, [], [], [], set()

        def out() -> list[tuple[int, int]]:
            asked, found = [], []

            def queries() -> Iterator[np.ndarray]:
                for guest, i, s in guests:
                    if guest not in linked:
                        asked.append((guest, i))
                        yield s

            for hit in near_links(queries(), lists, percent) if lists else []:
                if hit.any():
                    linked.add(asked[-1][0])
                    found.append((asked[-1][1], ids[int(hit.argmax())]))
            guests.clear()
            return found

        for b in itertools.chain(small(batches), [None]):
            found = []
            for home, block, guest, i, s in zip(*[c.to_pylist() for c in b.columns]) if b is not None else []:
                if at != (home, block):
                    found += out()
                    at, ids, lists, linked = (home, block), [], [], set()
                if guest is None:  # the home's members come first
                    ids.append(i)
                    lists.append(np.frombuffer(s, np.uint64))
                else:
                    guests.append((guest, i, np.frombuffer(s, np.uint64)))
            found += out()
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

    together = (rows.join(held, "id").select("home", "block", "guest", "id", "set").repartition("home", "block")
                .sortWithinPartitions("home", "block", F.col("guest").asc_nulls_first()))
    return save(map_batches(together, search, "a long, b long"), f"{name}-found")


def _between(lists: DataFrame, about: DataFrame, component: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between classes that share a list and are in different components:
    enough of them to join what belongs together.  ``lists``: the members
    (token, id, n, group) of lists of several components."""
    limit = 1 - percent / 100 + 1e-9
    of = component.select(F.col("node").alias("id"), F.col("component").alias("group"))

    # how far members lie from their component's first document
    far = _distances(of.where("id <> group").select(F.col("group").alias("a"), F.col("id").alias("b")), classes, docs, words, "join-radius")
    radius = far.groupBy("a").agg(F.max("value").alias("r"))
    firsts = about.join(radius.withColumnRenamed("a", "id"), "id", "left").select(F.col("id").alias("group"), "n", "bins", F.coalesce("r", F.lit(0.0)).alias("radius"))

    # components that share a list
    groups = lists.groupBy("token", "group").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    apart = _distances(_near_groups(groups.join(firsts, "group"), percent), classes, docs, words, "join-apart")
    direct = apart.where(F.col("value") <= limit).select("a", "b")

    # components whose first documents are too far apart to link, but not too far for their members
    r = lambda c: radius.select(F.col("a").alias(c), F.col("r").alias(f"r_{c}"))
    reach = lambda c: F.coalesce(f"r_{c}", F.lit(0.0))
    wide = (apart.where(F.col("value") > limit).join(r("a"), "a", "left").join(r("b"), "b", "left")
            .where((F.col("value") - reach("a") - reach("b") <= limit) & (F.col("r_a").isNotNull() | F.col("r_b").isNotNull()))
            .select(F.col("a").alias("x"), F.col("b").alias("y"), "value", reach("a").alias("r_x"), reach("b").alias("r_y")))
    wide = save(wide, "join-wide")
    away = far.select(F.col("b").alias("id"), F.col("value").alias("d"))
    member = lists.select("id", "group").distinct()
    member = save(member.join(away, "id", "left").select("id", "group", F.coalesce("d", F.lit(0.0)).alias("d")), "join-members")
    more = _first_links(wide, member, classes, docs, words, percent, "join-3")
    return direct.unionByName(more)


def op8(spark, sf_dir: str) -> DataFrame:
    from tillroll.llm.common import read

    return jaccard_links(read(spark, sf_dir, "documents"))
