"""Token counts, ids and id files against the tokenizers library, whole text by whole text."""
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.tables import awkward, table
from tillroll.llm import id_files, range_coder
from tillroll.llm.pretokens import Encoder
from tillroll.llm.token_counts import counter, token_counts
from tillroll.session import scratch_path

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PIECES = ["a", "'", "s", " ", "  ", "\n", "\t", "'s", "'re", "'ll", "t", "1", "23", "!", "é", "Σ", "中", "\u3000", "\u0301", "<|endoftext|>",
          "<|startoftext|>", "İ", "😀", "\u1c89", "Ⅷ", "E\u0301", "it's", "'S", "'LL", "<|", "aaaa", "\r\n", "\x85"]


def _fuzz(n: int = 4000) -> list[str]:
    rnd = random.Random(3)
    return ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 30))) for _ in range(n)]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_ids_equal_the_librarys(path):
    texts = [*_fuzz(), "ab cd " * 300_000 + "x" * 3000, "", "aaaaaaa" * 500]
    ids, counts = Encoder(path).encode(texts)
    expected = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == [len(e) for e in expected]
    assert ids.tolist() == [i for e in expected for i in e]


def test_counts_equal_the_librarys():
    texts = [*_fuzz(), "no-break" * 2000, "ab cd " * 100_000]
    expected = [len(e.ids) for e in Tokenizer.from_file(BYTE).encode_batch(texts, add_special_tokens=False)]
    assert counter(BYTE)(texts).tolist() == expected


def test_token_counts_over_a_table(spark):
    rows = awkward()
    tok = Tokenizer.from_file(BYTE)
    got = sorted((r.doc_id is None, r.doc_id, r.n_tokens) for r in token_counts(table(spark, rows), BYTE).collect())
    assert got == sorted((i is None, i, len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in rows)
    assert token_counts(table(spark, []), BYTE).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 2**32), st.integers(0, 3000), st.sampled_from([2, 40, 700, 65536]))
def test_range_coder_round_trip(seed, n, kinds):
    ids = np.random.default_rng(seed).integers(0, kinds, n)
    ids[n // 2:] = ids[:n - n // 2]  # something for the contexts to predict
    payload, block, words, crcs = range_coder.encode(ids)
    assert (range_coder.decode(payload, block, words, crcs, n) == ids).all()


def test_range_coder_compresses_and_notices_damage():
    ids = np.tile(np.random.default_rng(1).integers(0, 50_000, 9), 9000)
    payload, block, words, crcs = range_coder.encode(ids)
    assert len(payload) < 0.5 * 2 * len(ids)
    broken = bytearray(payload)
    broken[10] ^= 255
    with pytest.raises(ValueError, match="damaged block"):
        range_coder.decode(bytes(broken), block, words, crcs, len(ids))
    with pytest.raises(ValueError, match="65535"):
        range_coder.encode(np.array([70_000]))


def test_id_files_round_trip(spark):
    rows = awkward()
    folder = scratch_path(spark, "test-ids")
    id_files.write(table(spark, rows), folder, BYTE)
    tok = Tokenizer.from_file(BYTE)
    # ascending doc_id, NULL first, repeated ids by text
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    at, expected = 0, []
    for i, t, *_ in order:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [id_files.END_ID]
        expected.append((i, at, len(ids), ids))
        at += len(ids)
    got = sorted((tuple(r) for r in id_files.read(spark, folder).collect()), key=lambda r: r[1])
    assert got == expected
    crc = {r.start: r.ids_crc32 for r in id_files.read(spark, folder, digest=True).collect()}
    assert crc == {s: zlib.crc32(np.array(x, "<u4").tobytes()) for _, s, _, x in expected}


def test_id_files_of_an_empty_table(spark):
    folder = scratch_path(spark, "test-no-ids")
    id_files.write(table(spark, []), folder, BYTE)
    assert id_files.read(spark, folder).count() == 0


def test_range_coder_needs_fewer_bits_than_zlib_on_the_same_blocks():
    """On the documents' ids, block for block, each alone."""
    import pyarrow.parquet as pq

    from tillroll.llm.pretokens import Encoder

    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist()
    ids = np.asarray(Encoder(BYTE).encode([t or "" for t in texts])[0]).astype(np.int64)
    payload, block, words, _ = range_coder.encode(ids)
    plain = [zlib.compress(ids[i:i + block].astype("<u2").tobytes(), 9) for i in range(0, len(ids), block)]
    assert len(plain) == len(words)
    assert len(payload) < 0.9 * sum(map(len, plain))


def test_a_low_byte_that_fills_its_count():
    """Counts of one byte are halved when they are full, in coder and decoder alike."""
    rng = np.random.default_rng(4)
    ids = np.where(rng.random(30_000) < 0.5, 0x1234, 0x1200 + rng.integers(0, 256, 30_000))
    payload, block, words, crcs = range_coder.encode(ids)
    assert (range_coder.decode(payload, block, words, crcs, len(ids)) == ids).all()


def _document_ids() -> np.ndarray:
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist()
    return np.asarray(Encoder(BYTE).encode([t or "" for t in texts])[0]).astype(np.int64)


def test_coding_takes_a_few_times_what_zlib_takes():
    """CPU of coding and decoding a million ids beside zlib's on the same machine."""
    ids = np.tile(_document_ids(), 20)[:1 << 20]
    plain = ids.astype("<u2").tobytes()
    began = time.process_time()
    for i in range(0, len(plain), 8192):
        zlib.compress(plain[i:i + 8192], 9)
    zlibs = time.process_time() - began
    began = time.process_time()
    coded = range_coder.encode(ids)
    assert (range_coder.decode(*coded, len(ids)) == ids).all()
    assert time.process_time() - began < 20 * zlibs


def test_order_0_of_the_chunk_saves_bits():
    ids = _document_ids()
    payload, block, words, _ = range_coder.encode(ids)
    plain = [zlib.compress(ids[i:i + block].astype("<u2").tobytes(), 9) for i in range(0, len(ids), block)]
    assert len(payload) < 0.8 * sum(map(len, plain))


@pytest.mark.parametrize("counts", [[1], [1, 10**7], [1] * 65536, [10**6] + [1] * 65535, [3] * 50_000])
def test_shares_of_order_0(counts):
    """Every id that occurs has a share, all together the whole, and the table is read as written."""
    kinds, share = range_coder.shares(np.repeat(np.arange(65536 - len(counts), 65536), counts))
    assert len(kinds) == len(counts) and share.min() >= 1 and share.sum() == 1 << range_coder.TOTAL
    assert all((a == b).all() for a, b in zip((kinds, share), range_coder._unpack(range_coder._pack(kinds, share))))


@pytest.mark.parametrize("n", [1, 2, range_coder.SHORTEST - 1, range_coder.SHORTEST, range_coder.SHORTEST + 1, 3 * range_coder.SHORTEST])
@pytest.mark.parametrize("kinds", [1, 65536])
def test_blocks_of_all_lengths(n, kinds):
    ids = np.random.default_rng(n).integers(0, kinds, n)
    payload, block, words, crcs = range_coder.encode(ids)
    assert len(words) == -(-n // block) and (range_coder.decode(payload, block, words, crcs, n) == ids).all()


def test_carries_and_rare_ids():
    """Sure predictions that fail, ids of the least share, long runs of the most frequent one."""
    rng = np.random.default_rng(8)
    ids = np.where(rng.random(200_000) < 0.02, rng.integers(0, 65536, 200_000), 7)
    coded = range_coder.encode(ids)
    assert (range_coder.decode(*coded, len(ids)) == ids).all()


@pytest.mark.parametrize("place", [0, 1000, -1, -500])
def test_any_damage_is_noticed(place):
    ids = _document_ids()[:20_000]
    payload, *rest = range_coder.encode(ids)
    broken = bytearray(payload)
    broken[place] ^= 85
    with pytest.raises(ValueError, match="damaged block"):
        range_coder.decode(bytes(broken), *rest, len(ids))
