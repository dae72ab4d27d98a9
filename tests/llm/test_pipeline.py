"""The pipeline: each stage against what its operator says of its own input."""
from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.tables import OWN, awkward, table
from tests.llm.test_models import _toxic_rows
from tests.llm.test_ngram_join import _brute
from tests.llm.test_mixing import _brute as mixed
from tillroll.llm import language, toxicity
from tillroll.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _write(spark, rows, labels):
    folder = scratch_path(spark, "test-pipeline")
    table(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.fixture(scope="module")
def fixture(spark):
    toxic, labels = _toxic_rows(120)
    rows = [(i + 1000, *r) for i, *r in toxic] + awkward()
    return rows, _write(spark, rows, [(i + 1000, 1, t) for i, t in labels])


def test_stages_against_brute_force(spark, fixture):
    rows, folder = fixture
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    kept = rows
    model = toxicity.fit(docs, labels)
    kept = [r for r, s in zip(kept, model.scores([r[1] or "" for r in kept])) if s < 0.5]
    known = language.fit(table(spark, kept))
    kept = [r for r, lang, s in zip(kept, *known.predict([r[1] for r in kept])) if lang != "und" and s >= corpus_pipeline.LANGUAGE_FROM]
    low = {i: c for i, _, c in _brute(kept, corpus_pipeline.COPY_WORDS, corpus_pipeline.COPY_PERCENT)}
    seen = set()
    kept = [r for r in kept if r[0] is None or low[r[0]] == r[0] and not (r[0] in seen or seen.add(r[0]))]
    copies = Counter()
    sizes = {}
    for i, n, size, taken in mixed(kept)[0]:
        copies[i] += taken // n + (2 * (taken % n) >= n and taken % n > 0) if n else 0
        sizes[i] = n

    got = docs
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = corpus_pipeline.save(stage(spark, got, folder), f"test-{name}")
        counts.append(got.count())
        assert got.columns == docs.columns
    assert counts[0] < len(rows) and counts[2] == len(kept)
    assert Counter(r.doc_id for r in got.collect()) == +copies
    packed = corpus_pipeline.run(spark, folder).collect()
    assert Counter(r.doc_id for r in packed if r.start == 0) == +copies
    assert COLUMNS == docs.columns[:OWN]


def test_empty_tables(spark):
    folder = _write(spark, [], [])
    assert corpus_pipeline.run(spark, folder).count() == 0
