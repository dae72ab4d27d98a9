"""The pipeline's near copies: Jaccard of five-word shingles of 0.8 or more."""
import corpus_pipeline
from tests.llm.tables import awkward, prose, table
from tests.llm.test_ngram_join import _brute


def test_copies_are_those_of_five_words_and_four_fifths(spark):
    """Scattered edits and a part cut off, above 0.80 of five words and below 0.85 of four."""
    base = prose(77, 200).split()
    edited = [f"edit{i}" if i in (20, 70, 120, 170) else w for i, w in enumerate(base)]
    other = prose(78, 200).split()
    rows = awkward(3) + [(900, " ".join(base), "en", "a"), (901, " ".join(edited), "en", "a"),
                         (902, " ".join(other), "en", "a"), (903, " ".join(other[:164]), "en", "a")]
    by_four, by_five = ({i: c for i, _, c in _brute(rows, *rule)} for rule in ((4, 85), (5, 80)))
    assert (by_four[901], by_four[903], by_five[901], by_five[903]) == (901, 903, 900, 902)
    got = [r.doc_id for r in corpus_pipeline.drop_copies(spark, table(spark, rows), "").collect() if r.doc_id is not None]
    assert sorted(got) == sorted(i for i, c in by_five.items() if i == c and i is not None)
