"""Fingerprints: syncmers by definition, the edit pairing against plain Python."""
import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.tables import awkward, prose, table
from tillroll.llm import fingerprints as fp


@settings(max_examples=60, deadline=None)
@given(st.text("abcd", min_size=8, max_size=60))
def test_closed_syncmers_by_definition(text):
    k, s = 6, 3
    codes = np.array([ord(c) for c in text], np.uint32)
    hashes = {text[i:i + s]: int(fp.syncmers(codes[i:i + s], s, s)[0][0]) for i in range(len(text) - s + 1)}
    assert len(set(hashes.values())) == len(hashes)
    _, at = fp.syncmers(codes, k, s)
    # context-free: whether a k-mer is an anchor can be told from the k-mer alone
    alone = [i for i in range(len(text) - k + 1) if len(fp.syncmers(codes[i:i + k], k, s)[1])]
    assert at.tolist() == alone


def test_likeness():
    a, b = prose(1, 400), prose(2, 400)
    assert fp.likeness(fp.anchors(a), fp.anchors(a)) == 1
    assert fp.likeness(fp.anchors(a), fp.anchors(b)) < 0.05
    assert 0.55 < fp.likeness(fp.anchors(a), fp.anchors(fp.edit(a, b))) < 0.95
    line = "the same line again and again. " * 40
    assert fp.likeness(fp.anchors(line), fp.anchors(fp.edit(line, b))) > 0.5
    assert fp.likeness(fp.anchors(""), fp.anchors("")) == 1 and fp.likeness(fp.anchors(""), fp.anchors("x")) == 0


def test_long_texts_are_anchored_alike_in_steps(monkeypatch):
    text = prose(3, 2000)
    whole = [x.tolist() for x in fp.anchors(text)]
    monkeypatch.setattr(fp, "STEP_CHARS", 700)
    assert [x.tolist() for x in fp.anchors(text)] == whole


def _naive(text, k, s):
    """(k-mer, occurrence) -> place of the closed syncmers, by the hash of each s-mer alone."""
    if len(text) < k:
        k = s = len(text)
    def value(x):
        codes = np.array([ord(c) for c in x], np.uint64)
        return int(fp.mix((fp.mix(codes + np.uint64(1)) * fp.powers(len(x))[0]).sum(dtype=np.uint64)[None])[0])

    out, seen = {}, {}
    for i in range(len(text) - k + 1):
        inner = [value(text[j:j + s]) for j in range(i, i + k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            kmer = text[i:i + k]
            out[kmer, seen.setdefault(kmer, 0)] = i
            seen[kmer] += 1
    return out


def _naive_alike(x, y):
    if not x or not y:
        return float(not x and not y)
    k, s = min(fp.scale_of(x), fp.scale_of(y))
    a, b = _naive(x, k, s), _naive(y, k, s)
    shared = sorted((p, b[h]) for h, p in a.items() if h in b)
    best = []  # best[i]: longest chain that ends at shared[i]
    for i, (_, q) in enumerate(shared):
        best.append(1 + max([best[j] for j in range(i) if shared[j][1] <= q], default=0))
    j = max(best, default=0) / len({*a, *b})
    return 2 * j / (1 + j)


def test_likeness_of_all_anchors_equals_the_naive_one():
    base = prose(21, 60)
    texts = ["", "a", "ab", base[:14], base[:15], base[:16], base[:17], base[:53], base[:63], base[:64], base[:65], base[:67], base, prose(22, 50),
             "again " * 20, base[100:] + base[:100]]
    for x in texts:
        for y in texts:
            assert abs(fp.alike(x, fp.anchors(x), y, fp.anchors(y)) - _naive_alike(x, y)) < 1e-12, (x, y)


def test_no_jump_where_the_scale_changes():
    base = prose(23, 60)
    near = lambda x, y: fp.alike(x, fp.anchors(x), y, fp.anchors(y))
    for n in (16, 64):
        for a, b in ((n - 1, n + 1), (n - 1, n), (n, n + 1)):
            assert near(base[:a], base[:b]) > 0.7
    assert near(base[:70], fp.edit(base[:70], "")) > 0.7
    long = prose(24, 3000)
    passage = prose(25, 50)
    assert near(f"{long} {passage}", f"{passage} {prose(26, 3000)}") > 0


def test_pairing_equals_plain_python(spark):
    rows = awkward()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    texts = [r[1] or "" for r in order]
    expected = []
    for i, (t, n) in enumerate(zip(texts, texts[1:] + texts[:1])):
        cut = len(t) // 4
        e = t[:len(t) - cut] + n[:cut]
        expected.append((order[i][0], len(t), hashlib.sha256(e.encode()).hexdigest(), fp.digest(fp.anchors(t)), fp.digest(fp.anchors(e)),
                         fp.alike(t, fp.anchors(t), e, fp.anchors(e)), fp.alike(t, fp.anchors(t), n, fp.anchors(n))))
    for ranges in (1, 7):
        got = [tuple(r) for r in fp.edited(table(spark, rows), ranges).collect()]
        assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_single_row_and_empty_table(spark):
    (r,) = fp.edited(table(spark, [(5, "abcdefgh", "en", "a")]), 8).collect()
    assert r.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and r.near_next == 1
    assert fp.edited(table(spark, []), 8).count() == 0
