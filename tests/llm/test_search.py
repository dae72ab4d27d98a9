"""Search against scoring every document for every item in plain Python."""
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.tables import awkward, prose, table
from tillroll.llm import search
from tillroll.llm.search import Best, Block, Queries

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _terms(text):
    return TERM.findall((text or "").translate(LOWER))


def _brute(rows, items, k=20):
    docs = [(i, Counter(_terms(t))) for i, t, *_ in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    count, length = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in docs:
            m = 75 + 25 * n * count // length
            s = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in _terms(text) if c[t])
            if s > 0:
                scores.append((-s, i is not None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def _items(spark, items):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in items], "item_id long, text string, doc_id string, score long")


@pytest.mark.parametrize("seed,limit,piece", [(0, 1 << 22, 1 << 21), (1, 300, 64)])
def test_search_equals_brute_force(spark, monkeypatch, seed, limit, piece):
    monkeypatch.setattr(search, "QUERY_BYTES", limit)
    rows = awkward(seed)
    items = [(i, rows[7 * i][1]) for i in range(15)] + [(50, "one one two nine NINE"), (51, None), (52, ""), (53, "?!"), (54, "words words two"), (55, "nowherefound"), (50, "again one")]
    got = search.search(table(spark, rows), _items(spark, items)).collect()
    assert sorted(map(tuple, got), key=repr) == _brute(rows, items)


def test_ties_repeated_documents_and_empty_tables(spark):
    rows = [(i % 30, "same text here", "en", "a") for i in range(90)] + [(None, "same text here", "en", "a"), (99, None, None, None)]
    items = [(1, "text"), (2, "other")]
    got = search.search(table(spark, rows), _items(spark, items)).collect()
    assert sorted(map(tuple, got), key=repr) == _brute(rows, items)
    assert search.search(table(spark, []), _items(spark, items)).count() == 0
    assert search.search(table(spark, rows), _items(spark, [])).columns == ["item_id", "rank", "doc_id", "score"]
    assert search.search(table(spark, rows), _items(spark, [])).count() == 0


def test_bounds_leave_nothing_out_over_many_strata():
    rnd = random.Random(4)
    rows = [(i, prose(i % 50, rnd.choice([3, 10, 40, 200])) + " rare" * rnd.randint(0, 3), "en", "a") for i in range(400)]
    items = [(j, " ".join(rnd.choice(rows)[1].split()[:12]) + " rare") for j in range(20)]
    queries = Queries.of(items)
    word = {w.decode(): i for i, w in enumerate(queries.words)}
    docs = [(i, Counter(_terms(t))) for i, t, *_ in rows]
    count, length = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    w = np.array([math.floor(1000 * math.log((2 * count + 2) / (2 * df[t.decode()] + 1))) for t in queries.words])
    best = [Best(20) for _ in items]
    for at in range(0, 400, 100):  # blocks, one after the other
        some = docs[at:at + 100]
        flat = [(o, word[t], f) for o, (_, c) in enumerate(some) for t, f in c.items() if t in word]
        owner, term, tf = (np.array(x) for x in zip(*flat))
        block = Block(np.array([i for i, _ in some]), np.ones(100, bool), np.array([sum(c.values()) for _, c in some]), owner, term, tf, count, length)
        for (words, times), b in zip(queries.use, best):
            block.search(words, w[words] * times, b)
    got = [(item, r + 1, int(d), int(s)) for (item, _), b in zip(items, best) for r, (s, d) in enumerate(zip(b.score, b.doc))]
    assert sorted(got, key=repr) == _brute(rows, items)


def test_a_term_that_shares_a_key_is_told_apart(monkeypatch):
    queries = Queries.of([(0, "alpha")])
    monkeypatch.setattr(search, "span_keys", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    raw = np.frombuffer(b"alpha omega alphas", np.uint8)
    assert queries.finder()(raw, *search.spans(raw)).tolist() == [0, -1, -1]
