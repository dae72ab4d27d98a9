"""Jaccard join against all pairs of plain-Python shingle sets."""
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.tables import awkward, prose, table
from tillroll.llm import ngram_join
from tillroll.llm.ngram_join import divide_skip, jaccard_join, shingle_sets


def _set(text, words=4):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower() if (text or "").isascii() else (text or "").encode())
    return {tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())


def _brute(rows, words=4, percent=85):
    """(doc_id, n_shingles, component) per row; rows with one id are one document."""
    sets = [_set(t, words) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]) or rows[i][0] is not None and rows[i][0] == rows[j][0] and sets[i] == sets[j]:
                root[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[find(i)] = min(r[0], low.get(find(i), r[0]))
    return sorted(((r[0], len(sets[i]), low.get(find(i))) for i, r in enumerate(rows)), key=repr)


@pytest.mark.parametrize("seed", [0, 1])
def test_join_equals_brute_force(spark, seed):
    rows = awkward(seed)
    got = sorted((tuple(r) for r in jaccard_join(table(spark, rows)).collect()), key=repr)
    assert got == _brute(rows)


def test_chains_groups_and_shared_passages(spark):
    """Copies that drift step by step, a large tight group, and one passage that
    many different documents hold."""
    rnd = random.Random(5)
    rows, words = [], prose(9, 80).split()
    for i in range(25):
        rows.append((i, " ".join(words), "en", "a"))
        words[rnd.randrange(len(words))] = f"drift{i}"
    base = prose(10, 60).split()
    for i in range(60):
        w = base[:]
        w[i] = f"edit{i}"
        rows.append((100 + i, " ".join(w), "en", "a"))
    passage = prose(11, 40)
    rows += [(200 + i, f"{passage} {prose(300 + i, rnd.randint(2, 12))}", "en", "b") for i in range(40)]
    rnd.shuffle(rows)
    got = sorted((tuple(r) for r in jaccard_join(table(spark, rows)).collect()), key=repr)
    assert got == _brute(rows)


def test_empty_and_unlinked_tables(spark):
    assert jaccard_join(table(spark, [])).count() == 0
    got = jaccard_join(table(spark, [(1, None, None, None), (2, " ", "en", "a"), (3, "x", "en", "a")])).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 1), (2, 0, 2), (3, 1, 3)]


def test_long_texts_have_the_same_sets_in_slices(monkeypatch):
    texts = [prose(i, 3000) for i in range(3)] + ["", "a b"]
    whole = [s.tolist() for s in shingle_sets(texts)]
    monkeypatch.setattr(ngram_join, "BATCH_BYTES", 1000)
    assert [s.tolist() for s in shingle_sets(texts)] == whole
    assert [len(s) for s in whole] == [len(_set(t)) for t in texts]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sets(st.integers(0, 25), min_size=1), min_size=2, max_size=30), st.sampled_from([50, 85, 100]))
def test_divide_skip_equals_counting(sets, percent):
    query, *others = [np.array(sorted(s), np.uint64) for s in sets]
    expected = [i for i, o in enumerate(others) if 100 * len(set(o) & set(query)) >= percent * len(set(o) | set(query))]
    assert sorted(divide_skip(query, others, percent)) == expected
