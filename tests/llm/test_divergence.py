"""The audit against counting in plain Python, term by term."""
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.tables import LONG, awkward, table
from tillroll.llm import divergence

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _terms(text):
    return TERM.findall((text or "").translate(LOWER))


def _brute(rows, least, top=50):
    df, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, t, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        words = _terms(t)
        df[lang].update(set(words))
        counts[lang, source].update(words)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= least]
        size = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: 1 + 10**9 * (counts[lang, s][t] + 5) // (size[s] + 5 * len(kept)) for t in kept} for s in sources}
        whole = {t: sum(counts[lang, s][t] for s in sources) for t in kept}
        q = {t: 1 + 10**9 * (whole[t] + 5) // (sum(whole.values()) + 5 * len(kept)) for t in kept}
        for s in sources:
            parts = {"pair": [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources - {s}],
                     "term": [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]}
            for part, found in parts.items():
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, f, i + 1) for i, (item, f) in enumerate(found[:None if part == "pair" else top])]
    return sorted(out)


def _rows(seed):
    rnd = random.Random(seed)
    words = ["a", "Ünï", "ß", "eightlet", "ninelette", "x" * 16, "y" * 17, "y" * 18 + "z", "é" * 40, "日本語" * 9, "don't", "TIES", "ties", "m_n", "q1r2"]
    rows = [(i, " ".join(rnd.choices(words, range(1, len(words) + 1), k=rnd.randint(0, 40))), rnd.choice(["en", "fr", None, ""]), rnd.choice("abcd")) for i in range(150)]
    return rows + awkward(seed)


@pytest.mark.parametrize("seed,least,top,cells", [(0, 3, 5, 1 << 18), (1, 1, 50, 16), (2, 30, 50, 64)])
def test_audit_equals_brute_force(spark, monkeypatch, seed, least, top, cells):
    monkeypatch.setattr(divergence, "CELLS", cells)
    rows = _rows(seed)
    got = divergence.audit(table(spark, rows), least, top).select("lang", "source", "part", "item", "value", "rank").collect()
    assert sorted(map(tuple, got)) == _brute(rows, least, top)


def test_ties_hot_source_lone_source_and_empty_tables(spark):
    rows = [(i, f"common word{i % 3} tie{chr(97 + i % 2)}", "en", "hot" if i % 3 else f"s{i % 5}") for i in range(300)] + [(i, "Allein hier", "de", "lone") for i in range(40)]
    got = divergence.audit(table(spark, rows)).select("lang", "source", "part", "item", "value", "rank").collect()
    assert sorted(map(tuple, got)) == _brute(rows, 30)
    assert divergence.audit(table(spark, [])).count() == 0
    blank = [(1, None, "en", "a"), (2, "", "en", "b"), (3, "1 2 3", "en", None)]
    got = divergence.audit(table(spark, blank)).select("lang", "source", "part", "item", "value", "rank").collect()
    assert sorted(map(tuple, got)) == _brute(blank, 30) and all(r.value == 0 for r in got)


def _counted(texts, groups):
    data = "".join(texts).encode()
    ends = np.cumsum([len(t.encode()) for t in texts])
    out = {}
    for low, starts, sizes, g, n, d in divergence.count_terms(np.frombuffer(data, np.uint8), ends, np.array(groups)):
        for s, z, *rest in zip(*(x.tolist() for x in (starts, sizes, g, n, d))):
            assert (low[s:s + z].tobytes().decode(), rest[0]) not in out
            out[low[s:s + z].tobytes().decode(), rest[0]] = tuple(rest[1:])
    return out


def test_terms_touching_at_the_edge_of_a_document():
    texts, groups = ["ab cd", "cd", "", "cd ab", " ab", "ab", "zz" * 30], [0, 0, 0, 1, 1, 1, 2]
    expected = defaultdict(lambda: [0, 0])
    for t, g in zip(texts, groups):
        for w, n in Counter(_terms(t)).items():
            expected[w, g][0] += n
            expected[w, g][1] += 1
    assert _counted(texts, groups) == {k: tuple(v) for k, v in expected.items()}


def test_radix_order_is_the_stable_order():
    rng = np.random.default_rng(3)
    words = [rng.integers(0, 5, 2000).astype(np.uint64) << np.uint64(40), rng.integers(0, 2**63, 2000).astype(np.uint64) & np.uint64(0xFF0000FF)]
    assert divergence.radix_order(words).tolist() == sorted(range(2000), key=lambda i: (words[0][i], words[1][i], i))


@pytest.mark.parametrize("piece", [16, 1000])
def test_slices_of_a_very_long_text_count_as_the_whole(monkeypatch, piece):
    monkeypatch.setattr(divergence, "PIECE_BYTES", piece)
    text = LONG[:5000] + "w" * 3000 + " ends"
    data, starts, sizes, _, n, d = divergence._long_text(np.frombuffer(text.encode(), np.uint8))
    assert {data[s:s + z].tobytes().decode(): c for s, z, c in zip(starts, sizes, n)} == Counter(_terms(text)) and (d == 1).all()
