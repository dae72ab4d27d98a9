"""Mixing against a plain-Python version: water-filling by repetition, budgets by a full sort."""
import hashlib
import re
from collections import Counter, defaultdict

import pytest

from tests.llm.tables import awkward, table
from tillroll.llm import mixing


def _targets(sizes: dict) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 3 * sizes[s]
            left -= target[s]
        free -= over
    return target


def _brute(rows):
    docs = [(hashlib.md5(f"mix|{'' if i is None else i}".encode()).hexdigest(), i, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), s) for i, t, _, s in rows]
    sizes = Counter()
    for *_, n, s in docs:
        sizes[s] += n
    target = _targets(sizes)
    out = []
    by = defaultdict(list)
    for d in docs:
        by[d[3]].append(d)
    for s, mine in by.items():
        budget = int(target[s] + 1e-9)
        epochs, rest = divmod(budget, sizes[s]) if sizes[s] else (0, 0)
        for _, i, n, _ in sorted(mine, key=lambda d: (d[0], d[1] or 0, d[2])):
            part = max(0, min(rest, n))
            rest -= part
            out.append((i, n, sizes[s], epochs * n + part))
    return out, target


@pytest.mark.parametrize("seed", [0, 1])
def test_mix_equals_brute_force(spark, seed):
    rows = awkward(seed)
    got = mixing.mix(table(spark, rows)).collect()
    expected, target = _brute(rows)
    assert Counter((r.doc_id, r.size, r.source_size, r.taken) for r in got) == Counter(expected)
    taken = Counter()
    for r in got:
        assert abs(r.target - target[r.source]) < 1e-6
        assert r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - t) <= 1 for s, t in target.items())


def test_hot_source_and_empty_tables(spark):
    rows = [(i, "w " * (i % 7), "en", "hot" if i % 10 else f"s{i % 4}") for i in range(600)]
    got = mixing.mix(table(spark, rows)).collect()
    assert Counter((r.doc_id, r.size, r.source_size, r.taken) for r in got) == Counter(_brute(rows)[0])
    assert mixing.mix(table(spark, [])).count() == 0
    assert [r.taken for r in mixing.mix(table(spark, [(1, None, "en", "a"), (2, "", "en", None)])).collect()] == [0, 0]
