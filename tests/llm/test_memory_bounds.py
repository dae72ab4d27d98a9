"""What a Python worker holds: batches of bounded bytes, and a memo of pre-tokens without Python objects for each."""
import gc
import random
import tracemalloc

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.tables import awkward, table
from tillroll.llm import common, pretokens

WORD = public_tokenizers.path("word_bpe_49k.json")
BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"


def _words(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choices("etaoinshrdlu", k=9)) for _ in range(n))


@pytest.mark.parametrize("entries, recent", [(1 << 20, 1 << 16), (3000, 100), (2500, 0), (1 << 20, 7)])
def test_ids_with_small_memos(monkeypatch, entries, recent):
    monkeypatch.setattr(pretokens, "MEMO_ENTRIES", entries)
    monkeypatch.setattr(pretokens, "MEMO_RECENT", recent)
    enc, tok = pretokens.Encoder(WORD), Tokenizer.from_file(WORD)
    common_words = _words(0, 50)
    for seed in range(1, 12):
        texts = [_words(seed, 400), common_words, "", _words(seed - 1, 300), "it's 12 <|endoftext|> é"]
        ids, counts = enc.encode(texts)
        expected = [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
        assert counts.tolist() == [len(e) for e in expected]
        assert ids.tolist() == [i for e in expected for i in e]
        assert len(enc.memo) <= entries


def test_room_of_a_remembered_pretoken():
    enc = pretokens.Encoder(WORD)
    enc.encode(["a"])
    gc.collect()
    tracemalloc.start()
    try:
        for seed in range(10):
            enc.encode([_words(seed, 30_000)])
        gc.collect()
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert held < 40e6  # 300,000 of them: 54 MB with a dictionary


@pytest.mark.parametrize("name", ["toxicity", "language", "near_copies", "packing"])
def test_batches_of_a_stage_are_bounded(spark, name):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["rows", "bytes"])

    folder = common.scratch_path(spark, "test-batches")
    table(spark, awkward()).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(0, 1, 1), (1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.conf.unset(BATCHES)
    try:
        dict(corpus_pipeline.STAGES)[name](spark, common.read(spark, folder, "documents"), folder)
        long = spark.range(0, 60, 1, 1).select(F.repeat(F.lit("0123456789"), 30_000).alias("text"))
        got = common.map_batches(long, sizes, "rows long, bytes long").collect()
        assert sum(r["rows"] for r in got) == 60
        assert max(r["bytes"] for r in got) < common.ARROW_BYTES + 600_000  # a text has 300 KB
        spark.conf.set(BATCHES, "1m")  # what the session says stays
        common.bound_batches(spark)
        assert spark.conf.get(BATCHES) == "1m"
    finally:
        spark.conf.unset(BATCHES)
