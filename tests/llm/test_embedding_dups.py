"""Cover-tree dual traversal against all pairs."""
from pathlib import Path

import numpy as np
import pytest

from tillroll.llm import embedding_dups
from tillroll.llm.embedding_dups import near_duplicates

NAN, INF = float("nan"), float("inf")


def _brute(ids, vectors, threshold=0.95):
    sound = [v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for v in vectors]
    n, links, root = len(ids), np.zeros(len(ids), int), list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if s else None for v, s in zip(vectors, sound)]
    for i in range(n):
        for j in range(i):
            if sound[i] and sound[j] and len(unit[i]) == len(unit[j]) and (list(vectors[i]) == list(vectors[j]) or unit[i] @ unit[j] >= threshold):
                links[[i, j]] += 1
                root[find(i)] = find(j)
    low = {}
    for i in range(n):
        low[find(i)] = min(ids[i], low.get(find(i), ids[i]))
    return sorted((ids[i], int(links[i]), low[find(i)], ids[i] == low[find(i)]) for i in range(n))


def _table(spark, ids, vectors):
    return spark.createDataFrame([(i, v, 0, 1.0, 2) for i, v in zip(ids, vectors)], "vec_id long, embedding array<float>, label int, n double, cell int")


def _clustered(seed, n=260, d=12):
    rng = np.random.default_rng(seed)
    out = [c + rng.normal(0, s, d) for c in rng.normal(size=(n // 13, d)) for s in (0.0, 0.0, *rng.choice([0.02, 0.1, 0.25, 0.4, 1.0], 11))]
    return [np.float32(v).tolist() for v in out]


@pytest.mark.parametrize("block", [2048, 40])
def test_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dups, "BLOCK", block)
    monkeypatch.setattr(embedding_dups, "CELL", 2 * block)
    vectors = _clustered(block)
    ids = np.random.default_rng(0).permutation(len(vectors)).tolist()
    got = near_duplicates(_table(spark, ids, vectors))
    assert sorted(map(tuple, got.collect())) == _brute(ids, vectors)


def test_awkward_vectors(spark):
    vectors = [None, [], [0.0, 0.0], [1.0, None], [1.0, NAN], [INF, 1.0], [1.0, 0.0], [2.0, 0.0], [2.0, 0.0], [1.0, 0.1], [0.0, 1.0], [1.0, 0.0, 0.0], [1e-30, 0.0], [3e38, 3e38]]
    ids = [*range(len(vectors))]
    ids += [8]
    vectors += [[2.0, 0.0]]  # a repeated row
    got = sorted(map(tuple, near_duplicates(_table(spark, ids, vectors)).collect()))
    assert got == _brute(ids, vectors)
    assert near_duplicates(_table(spark, [], [])).count() == 0
    assert [tuple(r) for r in near_duplicates(_table(spark, [4], [None])).collect()] == [(4, 0, 4, True)]


@pytest.mark.parametrize(("kind", "many", "least"), [("float", 1, 0), ("double", 9, 0), ("float", 9, 1 << 30)])
def test_groups_of_blocks_equal_brute_force(spark, monkeypatch, kind, many, least):
    for name, value in {"BLOCK": 20, "CELL": 30, "LEFT": 3, "MANY": many, "GROUP": least}.items():
        monkeypatch.setattr(embedding_dups, name, value)
    vectors = _clustered(3)
    vectors += vectors[:40] * 2  # copies, with ids of their own
    ids = np.random.default_rng(1).permutation(len(vectors)).tolist()
    table = _table(spark, ids, vectors)
    got = near_duplicates(table.withColumn("embedding", table["embedding"].cast(f"array<{kind}>")))
    assert sorted(map(tuple, got.collect())) == _brute(ids, vectors)


def test_equal_vectors_have_one_cell():
    pivots = np.eye(8)
    x = embedding_dups._unit(np.random.default_rng(0).integers(-1, 2, (500, 8)) + np.eye(1, 8) * 4)
    x[::2, 0] = x[::2, 1] = np.abs(x[::2]).max(1)  # as near to the first pivot as to the second
    alone = np.concatenate([embedding_dups._cells(x[i:i + 1], pivots)[0] for i in range(len(x))])
    assert (embedding_dups._cells(x, pivots)[0] == alone).all()


def test_groups_apart_do_not_meet():
    near = lambda far: embedding_dups._near([(4, [0, 0], [0.1, far]), (6, [1], [0.2])], np.eye(2), 0.3)
    assert near(0.4) == {4: [4], 6: [6]}
    assert near(1.0) == {4: [4, 6], 6: [6]}


def _shuffled(spark):
    """Bytes of each of the shuffle files there are."""
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f: f.stat().st_size for d in folders for f in Path(d.getPath()).rglob("shuffle_*.data")}


def test_shuffle_grows_with_the_vectors_not_with_their_pairs(spark, monkeypatch):
    monkeypatch.setattr(embedding_dups, "BLOCK", 25)
    monkeypatch.setattr(embedding_dups, "CELL", 100)
    written = {}
    for n in (400, 1600):
        before = _shuffled(spark)
        table = _table(spark, range(n), np.random.default_rng(n).normal(size=(n, 64)).tolist())
        assert near_duplicates(table).where("n_links = 0 AND kept").count() == n
        written[n] = sum(size for f, size in _shuffled(spark).items() if f not in before)
    assert written[1600] < 8 * written[400]  # pairs: 16 times
