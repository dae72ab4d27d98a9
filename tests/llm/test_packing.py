"""Packing: every id in exactly one piece, sequences without gaps, little padding."""
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.tables import awkward, table
from tillroll.llm import packing


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(0, 400), max_size=12))
def test_plan_holds_every_piece_in_fitting_sequences(histogram):
    entries, sequences = packing.plan(histogram, 32)
    used = np.zeros(sequences, int)
    ends = defaultdict(list)
    for kind, begin, slots, first in entries.tolist():
        ends[kind].append((begin, slots, first))
    for kind, n in histogram.items():
        for rank in range(n):
            begin, slots, first = max(e for e in ends[kind] if e[0] <= rank)
            used[first + (rank - begin) // slots] += kind
    assert (used <= 32).all()
    assert sequences <= 1.5 * sum(k * n for k, n in histogram.items()) / 16 + len(histogram) + 1


def test_column_generation_reaches_the_bound():
    rng = np.random.default_rng(2)
    lengths = np.minimum(rng.lognormal(3.0, 0.9, 40_000), 255).astype(int) + 1
    _, sequences = packing.plan(Counter(lengths.tolist()), 256)
    assert sequences <= lengths.sum() / 256 * 1.01


def test_best_pattern_is_the_best():
    sizes, price = np.array([3, 5, 7]), np.array([0.3, 0.55, 0.75])
    value, counts = packing.best_pattern(price, sizes, 16)
    best = max(a * 0.3 + b * 0.55 + c * 0.75 for a in range(6) for b in range(4) for c in range(3) if 3 * a + 5 * b + 7 * c <= 16)
    assert abs(value - best) < 1e-9 and counts @ sizes <= 16


def test_packed_documents(spark):
    rows = awkward()
    got = packing.pack_documents(table(spark, rows)).collect()
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = Counter()
    for i, t, *_ in rows:
        x = np.array(tok.encode(t or "", add_special_tokens=False).ids + [packing.END_ID], "<u4")
        for a in range(0, len(x), packing.CAPACITY):
            part = x[a:a + packing.CAPACITY]
            ids[i, a, len(part), zlib.crc32(part.tobytes()), len(x)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == ids
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert packing.pack_documents(table(spark, [])).count() == 0
