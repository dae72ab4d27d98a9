"""The sample that the language model is fitted on: every language, within its bound."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.tables import table
from tillroll.llm import language
from tillroll.llm.toxicity import fold

LETTERS = {"aa": "abcdefgh", "bb": "ijklmnop", "rr": "äöüßqrst"}


def _rows(many, rare):
    rng = np.random.default_rng(2)
    langs = ["aa", "bb"] * (many // 2) + ["rr"] * rare
    return [(i, " ".join("".join(rng.choice(list(LETTERS[lang]), 5)) for _ in range(12)), lang, "s") for i, lang in enumerate(langs)]


def test_rare_languages_are_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE", 40)
    monkeypatch.setattr(language, "LEAST", 5)
    rows = _rows(1600, 12)
    docs = table(spark, rows)
    model = language.fit(docs)
    assert model.langs == ["aa", "bb", "rr"]
    held = {r[0] for r in docs.where(fold(F.col("doc_id"), 3) == 1).select("doc_id").collect()}
    tried = [r for r in rows if r[0] in held]
    assert {"aa", "bb", "rr"} == {r[2] for r in tried}
    assert model.predict([r[1] for r in tried])[0] == [r[2] for r in tried]


@pytest.mark.parametrize("same_id", [None, 7])
def test_bound_holds_for_rows_of_one_id(spark, monkeypatch, same_id):
    monkeypatch.setattr(language, "SAMPLE", 40)
    monkeypatch.setattr(language, "LEAST", 5)
    rows = [(same_id, t, lang, s) for _, t, lang, s in _rows(300, 9)]
    fitted = []
    monkeypatch.setattr(language, "ftrl", lambda examples, *a, _ftrl=language.ftrl, **k: fitted.append(examples) or _ftrl(examples, *a, **k))
    monkeypatch.setattr(language, "fold", lambda doc_id, folds: F.lit(0))
    language.fit(table(spark, rows + rows[:50] + rows[:1] * 100), held_out=1)
    assert [len(x) for x in fitted] == [31]  # 9 + 15 + 15, a fifth of them held back


def test_sizes():
    assert language.sample_sizes({"a": 10**6, "b": 10**5, "c": 70}) == {"a": 1965, "b": 1965, "c": 70}
    assert language.sample_sizes({"a": 3000, "b": 900}) == {"a": 3000, "b": 900}
    many = language.sample_sizes({str(i): 1000 + i for i in range(200)})
    assert set(many.values()) == {language.LEAST}
    assert language.sample_sizes({"a": 20}) == {"a": 20}


def test_slices_of_a_very_long_text_count_as_the_whole(monkeypatch):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdeÄÖß"), rng.integers(1, 9))) for _ in range(900)]
    texts = [" ".join(words), "".join(words), "short one", "x" * 997 + " y1", "İΣ" * 700]
    whole = [(r.tolist(), b.tolist(), c.tolist(), n) for r, b, c, n in (next(language.grams([t])) for t in texts)]
    for size in (64, 101, 500):
        monkeypatch.setattr(language, "GROUP_CHARS", size)
        assert [(r.tolist(), b.tolist(), c.tolist(), n) for r, b, c, n in language.grams(texts)] == whole


def test_ftrl_equals_the_textbook_update():
    """Coordinate by coordinate on dense vectors, as the algorithm is published."""
    rng = np.random.default_rng(6)
    k, alpha, beta, l1, l2 = 3, 1.0, 1.0, 0.02, 0.02
    offsets, buckets, values = [0], [], []
    for _ in range(40):
        at = np.sort(rng.choice(30, rng.integers(1, 6), replace=False))
        buckets.append(at)
        values.append(rng.random(len(at)))
        offsets.append(offsets[-1] + len(at))
    labels = rng.integers(0, k, 40)
    examples = language.Examples(np.array(offsets), np.concatenate(buckets), np.concatenate(values), labels)
    got = language.ftrl(examples, k, epochs=2, seed=1)
    z, n = np.zeros((language.BUCKETS + 1, k)), np.zeros((language.BUCKETS + 1, k))

    def weight(i, c):
        if abs(z[i, c]) <= l1:
            return 0.0
        return -(z[i, c] - np.sign(z[i, c]) * l1) / ((beta + n[i, c] ** 0.5) / alpha + l2)

    order = np.random.default_rng(1)
    for _ in range(2):
        for e in order.permutation(40):
            x = [*zip(buckets[e].tolist(), values[e].tolist()), (language.BUCKETS, 1.0)]
            w = {(i, c): weight(i, c) for i, _ in x for c in range(k)}
            score = np.array([sum(v * w[i, c] for i, v in x) for c in range(k)])
            p = np.exp(score - score.max()) / np.exp(score - score.max()).sum()
            for i, v in x:
                for c in range(k):
                    g = v * (p[c] - (labels[e] == c))
                    sigma = ((n[i, c] + g * g) ** 0.5 - n[i, c] ** 0.5) / alpha
                    z[i, c] += g - sigma * w[i, c]
                    n[i, c] += g * g
    seen = sorted({*np.concatenate(buckets).tolist(), language.BUCKETS})
    assert np.allclose(got[seen], [[weight(i, c) for c in range(k)] for i in seen], atol=1e-12)
    assert not np.delete(got, seen, 0).any()
