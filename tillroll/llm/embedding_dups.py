"""Exact near-duplicate pairs of embeddings by cover-tree dual traversal.

Unit vectors link when their cosine is at least ``threshold``, that is when
they lie within a distance ``reach`` of each other.  Equal vectors are one
class with a multiplicity.  The classes are dealt to cells around a bounded
sample of pivots, large cells to blocks, and every block becomes a cover tree:
levels of centres with halving radii, each node with its covering radius (the
distance of its farthest member).  Pairs of blocks are traversed together from
the roots: two nodes farther apart than their radii and the reach have no
links and are pruned; nodes so close that all their members link are counted
whole; others are opened.  Single vectors are compared in double precision.

Neighbouring blocks make a group, one row and file of a few MB.  The groups are
written once, and a pair of groups is a task that reads its two files: no
vector is copied or shuffled for a pair, so the disk grows with the table and
not with its pairs.  Groups whose cells lie too far apart are never paired.  A
pair of groups returns, per vector, the number of its links, and a spanning
forest of them, never all pairs; components follow from the forests.

Defined cases: vectors that are NULL, empty, zero, or hold NULL or non-finite
components link with nothing; vectors of different lengths link with nothing;
repeated rows are vectors of their own that link with each other; an empty
table gives an empty result; other columns (label) are not read.
"""
from __future__ import annotations

import itertools
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import bound_batches, connected_components, map_batches, save, ship
from tillroll.session import folders_listed_together, scratch_path

BLOCK = 2048        # vectors a block holds on average
CELL = 4 * BLOCK    # vectors a pivot's cell holds on average
PIVOTS = 2048       # pivots at most
SAMPLE = 20         # sampled vectors per pivot
SAMPLED = 64 << 20  # bytes of sampled vectors at most: long vectors have fewer pivots
GROUP = 8 << 20     # bytes of a group of blocks, one block at least
GROUPS = 8          # groups of a small table; a larger one has more
LEFT = 16           # groups that meet their partners in one job
MANY = 2            # copies per class from which they are merged before they are dealt to groups
# Bounds use float32 distances: beyond the reach they are exact to the first, near 0 to the second.
SLACK, SLACK_NEAR = 1e-5, 2e-3
LARGE = 2048        # pairs of children that are compared as a product of matrices
FEW, NARROW = 8, 0.3  # nodes of so few members are not kept at wider radii


class Tree:
    """Cover tree over unit vectors (n, d), given in double precision."""

    def __init__(self, x: np.ndarray, finest: float = 1e-3):
        n = len(x)
        self.order = np.arange(n)
        nodes = [[0, 0, n, 0.0, 0, 0]]  # centre, members from, to, radius, children from, to
        self.x = x
        level, radius = [0], 1.0
        nodes[0][3] = self._far(0, self.order)  # radii are exact: computed in double
        while level:
            below = []
            for node in level:
                centre, a, b, far = nodes[node][:4]
                if b - a == 1 or far <= finest:
                    continue
                nodes[node][4] = len(nodes)
                members = self.order[a:b]
                members = np.concatenate([[centre], members[members != centre]])
                at = a
                while len(members):
                    near = self._distance(members[0], members) <= radius
                    near[0] = True
                    mine = members[near]
                    members = members[~near]
                    # a wide node of few members would prune next to nothing: they stand for themselves
                    for part in ([mine] if len(mine) > FEW or radius <= NARROW else np.split(mine, len(mine))):
                        self.order[at:at + len(part)] = part
                        below.append(len(nodes))
                        nodes.append([part[0], at, at + len(part), self._far(part[0], part), 0, 0])
                        at += len(part)
                nodes[node][5] = len(nodes)
            level, radius = below, radius / 2
        table = list(zip(*nodes))
        self.centre, self.a, self.b = (np.array(table[i], np.int64) for i in range(3))
        self.radius = np.array(table[3], np.float32)
        self.first, self.last = np.array(table[4], np.int64), np.array(table[5], np.int64)
        self.x = x.astype(np.float32)

    def _distance(self, centre: int, members: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, 2 - 2 * (self.x[members] @ self.x[centre])))

    def _far(self, centre: int, members: np.ndarray) -> float:
        return float(self._distance(centre, members).max()) + SLACK if len(members) > 1 else 0.0


class Links:
    """What a traversal finds: links per vector, and a spanning forest over
    the vectors of both sides (the right side counted on from the left's)."""

    def __init__(self, left: int, right: int):
        self.count = np.zeros(left + right, np.int64)
        self.root = np.arange(left + right)
        self.edges: list[tuple[int, int]] = []

    def _find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        for i, j in zip(a.tolist(), b.tolist()):
            p, q = self._find(i), self._find(j)
            if p != q:
                self.root[max(p, q)] = min(p, q)
                self.edges.append((i, j))


def traverse(s: Tree, t: Tree, exact_s: np.ndarray, exact_t: np.ndarray, weight_s: np.ndarray, weight_t: np.ndarray,
             threshold: float, same: bool) -> Links:
    """All links between the trees' vectors (``same``: within one tree).
    exact_*: the unit vectors in double, weight_*: their multiplicities."""
    reach = math.sqrt(2 - 2 * threshold)
    shift = 0 if same else len(exact_s)
    out = Links(len(exact_s), 0 if same else len(exact_t))
    sum_s, sum_t = (np.concatenate([[0], np.cumsum(w[tree.order])]) for w, tree in ((weight_s, s), (weight_t, t)))

    def whole(i: int, j: int) -> None:
        """All members of node i of s link with all of node j of t."""
        left, right = s.order[s.a[i]:s.b[i]], t.order[t.a[j]:t.b[j]]
        out.count[left] += sum_t[t.b[j]] - sum_t[t.a[j]]
        if same and i == j:
            out.count[left] -= weight_s[left]
        elif same:
            out.count[right] += sum_s[s.b[i]] - sum_s[s.a[i]]
        else:
            out.count[right + shift] += sum_s[s.b[i]] - sum_s[s.a[i]]
        out.join(np.full(len(right), s.centre[i]), right + shift)
        out.join(left, np.full(len(left), t.centre[j] + shift))

    def leaves(i: int, j: int) -> None:
        left, right = s.order[s.a[i]:s.b[i]], t.order[t.a[j]:t.b[j]]
        link = exact_s[left] @ exact_t[right].T >= threshold
        if same and i == j:
            np.fill_diagonal(link, False)
        p, q = np.nonzero(link)
        np.add.at(out.count, left[p], weight_t[right[q]])
        if not (same and i == j):
            np.add.at(out.count, right[q] + shift, weight_s[left[p]])
        out.join(left[p], right[q] + shift)

    def singles(i: np.ndarray, j: np.ndarray) -> None:
        """Nodes of one vector each."""
        p, q = s.order[s.a[i]], t.order[t.a[j]]
        link = (np.einsum("ij,ij->i", exact_s[p], exact_t[q]) >= threshold) & ~(same & (p == q))
        p, q = p[link], q[link]
        np.add.at(out.count, p, weight_t[q])
        np.add.at(out.count, q + shift, weight_s[p])
        out.join(p, q + shift)

    def bounded(i: np.ndarray, j: np.ndarray, dot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Prune and settle node pairs with the given dot products of their centres; the rest."""
        d = np.sqrt(np.maximum(0, 2 - 2 * dot))
        wide = s.radius[i] + t.radius[j]
        open_ = d <= wide + reach + SLACK
        i, j, d, wide = i[open_], j[open_], d[open_], wide[open_]
        full = (d + wide <= reach - SLACK_NEAR) & ~((wide == 0) & ~(same & (i == j)))  # single vectors are compared exactly
        for a, b in zip(i[full].tolist(), j[full].tolist()):
            whole(a, b)
        return i[~full], j[~full]

    def centres(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", s.x[s.centre[i]], t.x[t.centre[j]])

    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    i, j = bounded(i, j, centres(i, j))
    while len(i):
        leaf = (s.first[i] == s.last[i]) & (t.first[j] == t.last[j])
        single = leaf & (s.b[i] - s.a[i] == 1) & (t.b[j] - t.a[j] == 1)
        singles(i[single], j[single])
        for a, b in zip(i[leaf & ~single].tolist(), j[leaf & ~single].tolist()):
            leaves(a, b)
        i, j = i[~leaf], j[~leaf]
        # open both nodes; one without children stands for itself
        (from_i, m), (from_j, n) = _opened(s, i), _opened(t, j)
        large = m * n > LARGE
        next_i, next_j = [], []
        for some in _portions(np.flatnonzero(~large), m * n):
            sizes = (m * n)[some]
            of = np.repeat(some, sizes)
            at = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            u, v = from_i[of] + at // n[of], from_j[of] + at % n[of]
            if same:
                keep = (i[of] != j[of]) | (u <= v)
                u, v = u[keep], v[keep]
            u, v = bounded(u, v, centres(u, v))
            next_i.append(u)
            next_j.append(v)
        for x in np.flatnonzero(large).tolist():
            a, b, left, right = i[x], j[x], np.arange(from_i[x], from_i[x] + m[x]), np.arange(from_j[x], from_j[x] + n[x])
            hits = []
            # single vectors and wider nodes apart: each has its own bound for all
            for rows, columns in itertools.product(_by_width(s, left), _by_width(t, right)):
                y = t.x[t.centre[columns]]
                limit = 1 - (s.radius[rows].max() + t.radius[columns].max() + reach + 2 * SLACK) ** 2 / 2
                for at in range(0, len(rows), 128):
                    some = rows[at:at + 128]
                    dots = s.x[s.centre[some]] @ y.T
                    p, q = np.divmod(np.flatnonzero(dots >= limit), len(columns))
                    hits.append((some[p], columns[q], dots[p, q]))
            u, v, dot = (np.concatenate(x) for x in zip(*hits))
            if same and a == b:
                keep = u <= v
                u, v, dot = u[keep], v[keep], dot[keep]
            u, v = bounded(u, v, dot)
            next_i.append(u)
            next_j.append(v)
        i = np.concatenate(next_i) if next_i else np.empty(0, np.int64)
        j = np.concatenate(next_j) if next_j else np.empty(0, np.int64)
    return out


def _opened(tree: Tree, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first child and the number of children; a node without any counts as its own."""
    children = tree.last[nodes] - tree.first[nodes]
    return np.where(children > 0, tree.first[nodes], nodes), np.maximum(children, 1)


def _portions(which: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """``which`` in pieces whose sizes add up to about 16 times ``LARGE``."""
    if len(which):
        yield from np.split(which, np.flatnonzero(np.diff(np.cumsum(sizes[which]) // (16 * LARGE))) + 1)


def _by_width(tree: Tree, nodes: np.ndarray) -> list[np.ndarray]:
    wide = tree.radius[nodes] > 0
    return [part for part in (nodes[~wide], nodes[wide]) if len(part)]


def _unit(raw: np.ndarray) -> np.ndarray:
    x = raw.astype(np.float64)
    # scaled first, so that squares neither overflow nor vanish
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _matrix(vectors: pa.ListArray | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length, without NULLs, as rows."""
    if isinstance(vectors, pa.ChunkedArray):
        return np.concatenate([_matrix(c) for c in vectors.chunks if len(c)])
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def _pivots(x: np.ndarray, k: int) -> np.ndarray:
    """k of the vectors, each the farthest from those before; in the order of
    a walk over the tree that hangs each below its nearest one before, so that
    neighbours have neighbouring numbers."""
    chosen, nearest, below = [0], x @ x[0], {0: []}
    parent = np.zeros(len(x), np.int64)
    while len(chosen) < min(k, len(x)):
        new = int(nearest.argmin())
        if new in below:  # all vectors are pivots
            break
        below[int(parent[new])].append(new)
        below[new] = []
        chosen.append(new)
        dots = x @ x[new]
        parent[dots > nearest] = new
        nearest = np.maximum(nearest, dots)
    order, left = [], [0]
    while left:
        order.append(left.pop())
        left += below[order[-1]]
    return x[order]


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of ``vectors``, which
    are read several times: only hashes of them are stored."""
    ship(vectors.sparkSession)
    bound_batches(vectors.sparkSession)
    reach = math.sqrt(2 - 2 * threshold)
    # float32 stays as it is: half the bytes, and the same values
    kind = "array<float>" if dict(vectors.dtypes)[embedding] == "array<float>" else "array<double>"
    v = F.col("v").cast("array<double>")
    inf = F.lit(float("inf")).cast(kind[6:-1])
    # array_contains gives NULL if the array holds NULL; NaN is the largest number
    sound = F.coalesce((F.size("v") > 0) & ~F.array_contains("v", inf) & (F.array_max("v") < inf) & (F.array_min("v") > -inf)
                       & ((F.array_min("v") != 0) | (F.array_max("v") != 0)), F.lit(False))
    rows = (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast(kind).alias("v"))
            .withColumn("sound", sound).withColumn("dim", F.size("v")).withColumn("h1", F.xxhash64(v)).withColumn("h2", F.xxhash64(F.lit(1), v)))
    given = save(rows.drop("v"), "emb-given")
    classes = given.where("sound").groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("size"), F.first("dim").alias("dim"))
    classes = save(classes, "emb-classes")

    edges, counts = [], []
    for row in classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("copies")).orderBy("dim").collect():  # as a rule, one length
        alike = F.col("dim") == row["dim"]
        found = _links(rows.where(F.col("sound") & alike).select("h1", "h2", "vec_id", "v"), classes.where(alike), row["n"], row["copies"], row["dim"], threshold, reach)
        edges.append(found.where("b IS NOT NULL").select("a", "b"))
        counts.append(found.where("b IS NULL").select(F.col("a").alias("rep"), "n"))
    if not edges:
        linked = given.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    else:
        union = lambda parts: parts[0] if len(parts) == 1 else parts[0].unionByName(union(parts[1:]))
        component = connected_components(union(edges), "emb-components").withColumnRenamed("node", "rep")
        total = union(counts).groupBy("rep").agg(F.sum("n").alias("n"))
        about = (classes.select("h1", "h2", "rep", "size").join(total, "rep", "left").join(component, "rep", "left")
                 .select("h1", "h2", (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
        linked = (given.where("sound").join(about, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
                  .unionByName(given.where("NOT sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))))
    return linked.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _links(rows: DataFrame, classes: DataFrame, n: int, copies: int, dim: int, threshold: float, reach: float) -> DataFrame:
    """(a, b, n): rows with b are links that span the components, rows without
    say that class a has n linked vectors in other classes.  ``rows`` are
    ``copies`` vectors of the length ``dim``, of ``n`` classes."""
    spark = rows.sparkSession
    k = max(1, min(PIVOTS, n // CELL, SAMPLED // (SAMPLE * dim * 8)))
    some = classes.select("h1", "h2").orderBy("h2", "h1").limit(SAMPLE * k)  # bounded by PIVOTS * SAMPLE and SAMPLED
    sample = rows.join(F.broadcast(some), ["h1", "h2"]).groupBy("h1", "h2").agg(F.first("v").alias("v")).toArrow().sort_by([("h2", "ascending"), ("h1", "ascending")])
    pivots = _pivots(_unit(_matrix(sample["v"])), k)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cell, _ = _cells(_unit(_matrix(b.column("v"))), pivots)
                yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), b.column("h1")], ["cell", "h1"])

    sizes = np.full(len(pivots), n)
    if len(pivots) > 1:
        sizes[:] = 0
        for r in map_batches(rows.select("h1", "v"), cells, "cell int, h1 long").groupBy("cell").agg(F.approx_count_distinct("h1").alias("n")).collect():
            sizes[r["cell"]] = r["n"]
    blocks = np.maximum(1, -(-sizes // BLOCK))
    first = np.cumsum(blocks) - blocks
    kind = dict(rows.dtypes)["v"]
    most = GROUP // (BLOCK * (dim * (4 if kind == "array<float>" else 8) + 56))
    per = int(max(1, min(most, -(-blocks.sum() // GROUPS))))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cell, dot = _cells(_unit(_matrix(b.column("v"))), pivots)
                h1, h2 = (b.column(c).to_numpy() for c in ("h1", "h2"))
                block = first[cell] + h1 % blocks[cell]
                rep = b.column("rep").fill_null(np.iinfo(np.int64).max).to_numpy()  # the least id is not NULL if there is another
                # of a vector with many copies one leaves the batch
                at = np.lexsort((h2, h1))
                starts = np.flatnonzero(np.concatenate([[True], (h1[at][1:] != h1[at][:-1]) | (h2[at][1:] != h2[at][:-1])]))
                row, rep, size = at[starts], np.minimum.reduceat(rep[at], starts), np.add.reduceat(b.column("size").to_numpy()[at], starts)
                yield pa.RecordBatch.from_arrays([
                    *(pa.array(x) for x in (block[row] // per, block[row], dot[row], rep, size, h1[row], h2[row])), b.column("v").take(pa.array(row))],
                    ["grp", "block", "dot", "rep", "size", "h1", "h2", "v"])

    def build(table: pa.Table) -> pa.Table:
        block, dot, rep, size = (table[c].to_numpy() for c in ("block", "dot", "rep", "size"))
        raw = _matrix(table["v"])
        trees, fars = [], []
        for i in np.unique(block):
            mine = np.flatnonzero(block == i)
            mine = mine[np.argsort(-dot[mine], kind="stable")]  # the root's centre is the nearest to the pivot
            tree = Tree(_unit(raw[mine]))
            trees.append((raw[mine], rep[mine], size[mine], *(x.astype(np.int32) for x in (tree.order, tree.centre, tree.a, tree.b, tree.first, tree.last)), tree.radius))
            fars.append(math.sqrt(max(0, 2 - 2 * dot[mine].min())))
        of = np.searchsorted(first, np.unique(block), "right") - 1
        return pa.table({"payload": pa.array([pickle.dumps(trees, 5)], pa.binary()), "cells": [of.tolist()], "fars": [fars], "grp": table["grp"][:1]})

    groups = int(-(-blocks.sum() // per))
    merged = [F.min("rep").alias("rep"), F.sum("size").alias("size"), F.first("v").alias("v")]
    rows = rows.select("h1", "h2", F.col("vec_id").alias("rep"), F.lit(1).cast("long").alias("size"), "v")
    if copies > MANY * n:  # else a shuffle of all vectors would cost more than that of the copies
        rows = rows.groupBy("h1", "h2").agg(*merged)
    dealt = map_batches(rows, deal, f"grp long, block long, dot double, rep long, size long, h1 long, h2 long, v {kind}").repartition(groups, "grp")
    dealt = dealt.groupBy("grp", "block", "h1", "h2").agg(F.first("dot").alias("dot"), *merged)  # in the same tasks
    trees = dealt.drop("h1", "h2").groupBy("grp").applyInArrow(build, "payload binary, cells array<long>, fars array<double>, grp long")
    path = scratch_path(spark, "emb-trees")
    trees.write.partitionBy("grp").parquet(path)
    with folders_listed_together(spark):
        trees = spark.read.schema(trees.schema).parquet(path)
    near = _near(sorted((r["grp"], r["cells"], r["fars"]) for r in trees.select("grp", "cells", "fars").collect()), pivots, reach)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = (None, None)
        for b in batches:
            for i in range(b.num_rows):
                s, t = b.column(0)[i].as_py(), b.column(2)[i].as_py()
                if s != left[0]:
                    left = (s, _load(b.column(1)[i]))
                ids, found = _meet(left[1], left[1] if s == t else _load(b.column(3)[i]), threshold)
                linked = np.flatnonzero(found.count)
                edges = np.array(found.edges, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([ids[linked], ids[edges[:, 0]]])),
                    pa.array(np.concatenate([ids[linked], ids[edges[:, 1]]]), mask=np.arange(len(linked) + len(edges)) < len(linked)),
                    pa.array(np.concatenate([found.count[linked], np.zeros(len(edges), np.int64)]))], ["a", "b", "n"])

    path, schema = scratch_path(spark, "emb-links"), "a long, b long, n long"
    lefts = sorted(near)
    for some in (lefts[at:at + LEFT] for at in range(0, len(lefts), LEFT)):
        both = None
        for i in some:
            s = trees.where(F.col("grp") == i).select(F.col("grp").alias("s"), F.col("payload").alias("left"))
            t = trees.where(F.col("grp").isin(near[i])).select(F.col("grp").alias("t"), F.col("payload").alias("right"))
            pairs = s.hint("shuffle_replicate_nl").crossJoin(t)  # tasks read the files of their groups
            both = pairs if both is None else both.unionByName(pairs)
        map_batches(both, compare, schema).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _cells(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each vector and their dot product.  A product of
    matrices rounds by their shapes: near ties are settled by sums of their
    own, so that equal vectors get the same pivot in every batch."""
    dots = x @ pivots.T
    row, cell = np.divmod(np.flatnonzero(dots >= dots.max(1, keepdims=True) - 1e-9), len(pivots))
    if len(row) > len(x):
        at = np.lexsort((cell, -np.einsum("ij,ij->i", x[row], pivots[cell]), row))
        cell = cell[at[np.searchsorted(row, np.arange(len(x)))]]  # sorted by row, as row is
    return cell, dots[np.arange(len(x)), cell]


def _near(groups: list[tuple[int, list[int], list[float]]], pivots: np.ndarray, reach: float) -> dict[int, list[int]]:
    """Of each group those from itself on that can have links with it; a group
    has the cells of its blocks and the distances of their farthest members."""
    cell = np.array([c for _, cells, _ in groups for c in cells], np.int64)
    far = np.array([f for _, _, fars in groups for f in fars])
    starts = np.cumsum([0] + [len(cells) for _, cells, _ in groups])
    out = {}
    for i, (grp, _, _) in enumerate(groups):
        mine = slice(starts[i], starts[i + 1])
        apart = np.sqrt(np.maximum(0, 2 - 2 * (pivots[cell[mine]] @ pivots[cell[starts[i]:]].T)))
        close = (apart <= far[mine, None] + far[None, starts[i]:] + reach + SLACK).any(0)
        hit = np.flatnonzero(np.logical_or.reduceat(close, starts[i:-1] - starts[i]))
        out[grp] = [groups[i + j][0] for j in hit]
    return out


def _load(payload: pa.BinaryScalar) -> list[tuple[Tree, np.ndarray, np.ndarray, np.ndarray]]:
    """(tree, unit vectors, ids, multiplicities) of each block of a group."""
    out = []
    for raw, rep, size, order, centre, a, b, first, last, radius in pickle.loads(payload.as_buffer()):
        tree, x = Tree.__new__(Tree), _unit(raw)
        tree.x, tree.radius = x.astype(np.float32), radius
        tree.order, tree.centre, tree.a, tree.b, tree.first, tree.last = (p.astype(np.int64) for p in (order, centre, a, b, first, last))
        out.append((tree, x, rep, size))
    return out


def _meet(left: list, right: list, threshold: float) -> tuple[np.ndarray, Links]:
    """The ids of two groups' classes, and what the traversals of their pairs
    of blocks find; ``right`` is ``left`` where a group meets itself."""
    same = left is right
    sides = left if same else [*left, *right]
    starts = np.cumsum([0] + [len(x) for _, x, _, _ in sides])
    out = Links(int(starts[-1]), 0)
    for i, j in (itertools.combinations_with_replacement(range(len(left)), 2) if same else itertools.product(range(len(left)), range(len(left), len(sides)))):
        (s, xs, _, ws), (t, xt, _, wt) = sides[i], sides[j]
        found = traverse(s, t, xs, xt, ws, wt, threshold, i == j)
        out.count[starts[i]:starts[i + 1]] += found.count[:len(xs)]
        if i != j:
            out.count[starts[j]:starts[j + 1]] += found.count[len(xs):]
        if found.edges:
            edges = np.array(found.edges, np.int64)
            edges += np.where(edges < len(xs), starts[i], starts[j] - len(xs))
            out.join(edges[:, 0], edges[:, 1])
    return np.concatenate([rep for _, _, rep, _ in sides]), out


def op2(spark, sf_dir: str) -> DataFrame:
    from tillroll.llm.common import read

    return near_duplicates(read(spark, sf_dir, "embeddings"))
