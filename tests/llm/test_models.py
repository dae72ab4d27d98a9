"""Toxicity and language: held-out accuracy, learning rules and odd tables."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.tables import awkward, prose, table
from tillroll.llm import language, toxicity

INVENTED = [f"zorb{x}" for x in ("ak", "el", "in", "us", "ot")]


def _toxic_rows(n=240):
    rows, labels = [], []
    for i in range(n):
        words = prose(7000 + i, 40).split()
        toxic = i % 4 == 0
        if toxic:
            for j in range(3):
                words[j * 9 + 2] = INVENTED[(i // 4 + j) % 5] if i % 8 else ("moron", "stupid", "loser")[j]
        rows.append((i, " ".join(words), "en", "a"))
        labels.append((i, int(toxic)))
    return rows, labels


def _labels(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_learns_and_scores_held_out(spark):
    rows, labels = _toxic_rows()
    docs = table(spark, rows)
    model = toxicity.fit(docs, _labels(spark, labels))
    score = toxicity.scorer(spark, model)
    got = {r.doc_id: r for r in docs.select("doc_id", score("text").alias("s"), toxicity.fold(F.col("doc_id"), 5).alias("f")).collect()}
    wrong = [i for i, t in labels if got[i].f == 0 and (got[i].s >= 0.5) != (t == 1)]
    assert len(wrong) <= 1
    assert all(0 <= r.s <= 1 for r in got.values())


def test_held_out_labels_do_not_matter(spark):
    rows, labels = _toxic_rows(120)
    docs = table(spark, rows)
    held = {r[0] for r in docs.where(toxicity.fold(F.col("doc_id"), 5) == 0).select("doc_id").collect()}
    flipped = [(i, 1 - t if i in held else t) for i, t in labels]
    texts = [t for _, t, *_ in rows]
    a, b = (toxicity.fit(docs, _labels(spark, x)).scores(texts) for x in (labels, flipped))
    assert np.array_equal(a, b)


@pytest.mark.parametrize("labels", [[], [(0, 0), (4, 0)], [(None, 1), (0, None)], [(0, 1), (0, 0), (1, 0)]])
def test_toxicity_of_awkward_tables(spark, labels):
    docs = table(spark, awkward())
    model = toxicity.fit(docs, _labels(spark, labels))
    got = docs.select(toxicity.scorer(spark, model)("text").alias("s")).collect()
    assert len(got) == len(awkward()) and all(0 <= r.s <= 1 for r in got)
    assert table(spark, []).select(toxicity.scorer(spark, toxicity.fit(table(spark, []), _labels(spark, labels)))("text").alias("s")).count() == 0


def test_isotonic_is_monotone_and_calibrated():
    rng = np.random.default_rng(0)
    s = rng.normal(size=4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-3 * s))).astype(float)
    x, p = toxicity.isotonic(s, y, np.ones(4000))
    assert (np.diff(x) >= 0).all() and (np.diff(p) >= 0).all()
    assert abs(np.interp(0.0, x, p) - 0.5) < 0.1


def _language_rows(n=180):
    letters = {"aa": "abcdefgh", "bb": "ijklmnop", "cc": "äöüßqrst"}
    rng = np.random.default_rng(1)
    return [(i, " ".join("".join(rng.choice(list(letters[lang]), 5)) for _ in range(12)), lang, "s") for i in range(n) for lang in [["aa", "bb", "cc"][i % 3]]]


def test_language_held_out_accuracy_and_odd_texts(spark):
    rows = _language_rows()
    docs = table(spark, rows + [(500, None, "aa", "s"), (501, "12 !?", "bb", "s"), (502, "", None, "s"), (503, "x" * 600_000, None, "s"), (None, rows[0][1], None, None)])
    identify = language.identifier(spark, language.fit(docs))
    got = {r.doc_id: r for r in docs.select("doc_id", identify("text").alias("x"), toxicity.fold(F.col("doc_id"), 3).alias("f")).select("doc_id", "f", "x.*").collect()}
    assert all(got[i].lang_pred == lang for i, _, lang, _ in rows if got[i].f == 1)
    assert [got[i].lang_pred for i in (500, 501, 502)] == ["und"] * 3 and got[500].score == 0
    assert got[None].lang_pred == rows[0][2] and all(0 <= r.score <= 1 for r in got.values())


def test_language_without_learning_rows(spark):
    for rows in ([], [(1, "some text", None, "a"), (2, None, "en", "a")]):
        docs = table(spark, rows)
        got = docs.select(language.identifier(spark, language.fit(docs))("text").alias("x")).select("x.*").collect()
        assert [r.lang_pred for r in got] == ["und"] * len(rows)


def test_ftrl_is_sparse_and_temperature_calibrates():
    rng = np.random.default_rng(0)
    examples = [(np.array([y, 10 + int(rng.integers(50)), language.BUCKETS]), np.array([1.0, 0.5, 1.0]), y) for y in rng.integers(0, 3, 300).tolist()]
    strict = language.ftrl(examples, 3, l1=2.0)
    assert (strict == 0).mean() > 0.99 and (language.ftrl(examples, 3)[:3].argmax(1) == np.arange(3)).all()
    truth = rng.integers(0, 2, 4000)
    noisy = np.where(rng.random(4000) < 0.8, truth, 1 - truth)
    logits = np.stack([-(truth * 2 - 1), truth * 2 - 1], 1) * 5.0
    t = language.fit_temperature(logits, noisy)
    assert abs(language.softmax(np.array([[-5.0, 5.0]]) / t)[0, 1] - 0.8) < 0.03
