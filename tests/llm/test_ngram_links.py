"""Numbers of links against all pairs of plain-Python shingle sets."""
import random

import pytest

from tests.llm.tables import awkward, prose, table
from tests.llm.test_ngram_join import _brute, _set
from tillroll.llm import ngram_join
from tillroll.llm.ngram_join import jaccard_links


def _counted(rows, words=4, percent=85):
    sets = [_set(t, words) for _, t, *_ in rows]
    out = []
    for (i, *_), s in zip(rows, sets):
        linked = {r[0] for r, o in zip(rows, sets) if s and o and r[0] is not None and 100 * len(s & o) >= percent * len(s | o)}
        known = any(r[0] is not None and o == s for r, o in zip(rows, sets))
        out.append((i, len(linked - {i}) if known else 0))
    return out


def _chains():
    rnd = random.Random(5)
    rows, words = [], prose(9, 80).split()
    for i in range(25):
        rows.append((i, " ".join(words), "en", "a"))
        words[rnd.randrange(len(words))] = f"drift{i}"
    base = prose(10, 60).split()
    for i in range(60):
        rows.append((100 + i, " ".join(f"edit{i}" if j == i else w for j, w in enumerate(base)), "en", "a"))
    rows += [(300 + i, rows[i * 7][1].upper(), "en", "a") for i in range(10)] + [(None, rows[0][1], "en", "a")]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("rows,tokens", [(awkward(), 1 << 21), (_chains(), 1 << 21), (_chains(), 700)])
def test_links_equal_all_pairs(spark, monkeypatch, rows, tokens):
    monkeypatch.setattr(ngram_join, "BLOCK_TOKENS", tokens)
    monkeypatch.setattr(ngram_join, "LISTED", 1 << 20 if tokens > 700 else 50)
    got = jaccard_links(table(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_links) for r in got), key=repr) == sorted(_counted(rows), key=repr)
    assert sorted((tuple(r)[:3] for r in got), key=repr) == _brute(rows)


def test_texts_that_share_an_id_are_linked_each(spark):
    """(5, A) and (5, B) are documents of their own: what is near B reaches 5 as well."""
    a, b = prose(40, 60), prose(41, 60)
    rows = [(5, a, "en", "a"), (5, b, "en", "a"), (7, a + " end", "en", "a"), (8, b + " end", "en", "a"), (None, a + " more", "en", "a"), (None, None, None, None)]
    got = jaccard_links(table(spark, rows)).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=repr) == sorted([(5, 5), (5, 5), (7, 5), (8, 5), (None, 5), (None, None)], key=repr)
    assert sorted((tuple(r)[:3] for r in got), key=repr) == _brute(rows)
    assert sorted((r.doc_id, r.n_links) for r in got if r.doc_id) == [(5, 1), (5, 1), (7, 1), (8, 1)]


def test_one_of_each_group_stays(spark):
    a, b = prose(42, 60), prose(43, 60)
    rows = [(5, a, "en", "a"), (5, b, "fr", "a"), (7, a + " end", "en", "a"), (3, b + " end", "en", "a"), (None, a + " more", "en", "a"), (None, prose(44, 9), "en", "a"),
            (None, prose(44, 9).upper(), "en", "b"), (9, None, None, None), (9, None, None, None), (9, " ", "en", "a"), (None, "", "en", "a")]
    got = ngram_join.one_of_each(table(spark, rows + rows[:2])).select("doc_id", "text")
    assert got.columns == ["doc_id", "text"]
    found = sorted(map(tuple, got.collect()), key=repr)
    null = [r for r in found if r[0] is None and r[1]]
    assert len(null) == 1 and null[0][1].lower() == prose(44, 9)
    assert [r for r in found if r not in null] == sorted([(5, a), (3, b + " end"), (9, None), (9, " "), (None, "")], key=repr)


@pytest.mark.parametrize("groups,block", [(512, 512), (3, 4)])
def test_components_that_meet_in_blocks(spark, monkeypatch, groups, block):
    """Unlinked documents of one common passage, and chains that only the second round joins."""
    monkeypatch.setattr(ngram_join, "GROUPS", groups)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rnd = random.Random(8)
    passage = prose(50, 60)
    rows = [(i, f"{passage} {prose(500 + i, rnd.randint(1, 11))}", "en", "a") for i in range(70)]
    rows += [(100 + i, f"{prose(600 + i, rnd.randint(1, 11))} {passage}", "en", "a") for i in range(50)] + _chains()
    rnd.shuffle(rows)
    rows = [(i, *r[1:]) for i, r in enumerate(rows)]
    got = sorted((tuple(r) for r in ngram_join.jaccard_join(table(spark, rows)).collect()), key=repr)
    assert got == _brute(rows)


def test_links_of_empty_tables(spark):
    assert jaccard_links(table(spark, [])).columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    assert jaccard_links(table(spark, [])).count() == 0
