"""Sharding against the published algorithm, key by key, and slots by counting."""
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.tables import awkward, table
from tillroll.llm import sharding
from tillroll.session import scratch_path


def _jump(key: int, shards: int) -> int:
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def _key(doc_id) -> int:
    return int(hashlib.md5(f"shard|{'' if doc_id is None else doc_id}".encode()).hexdigest()[:16], 16)


def test_jump_equals_the_plain_loop():
    rnd = random.Random(1)
    keys = [0, 1, 2**64 - 1, *(rnd.getrandbits(64) for _ in range(3000))]
    for shards in (1, 2, 7, 8, 9, 100, 5000):
        assert sharding.jump(np.array(keys, np.uint64), shards).tolist() == [_jump(k, shards) for k in keys]
    with pytest.raises(ValueError):
        sharding.jump(np.zeros(1, np.uint64), 0)


def test_an_appended_shard_takes_its_part_and_nothing_else_moves():
    keys = np.random.default_rng(2).integers(0, 2**63, 200_000).astype(np.uint64)
    before = sharding.jump(keys, 8)
    for n in range(8, 12):
        after = sharding.jump(keys, n + 1)
        moved = after != before
        assert (after[moved] == n).all()
        assert abs(moved.mean() - 1 / (n + 1)) < 0.005
        assert abs(np.bincount(after, minlength=n + 1) / len(keys) - 1 / (n + 1)).max() < 0.005
        before = after


def _docs(spark, rows):
    from pyspark.sql import functions as F

    text = F.coalesce("text", F.lit(""))
    return table(spark, rows).select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))


def _check(rows, got):
    expected = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), _jump(_key(i), 8), _jump(_key(i), 9)) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in got) == expected
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("seed", [0, 1])
def test_shards_and_slots(spark, seed):
    rows = awkward(seed)
    got = sharding.with_slots(sharding.assign(_docs(spark, rows))).collect()
    _check(rows, got)
    again = sharding.with_slots(sharding.assign(_docs(spark, rows[::-1]).repartition(5))).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)


def test_hot_keys_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "EXPLODED", 7)
    rows = [(1, f"text {i % 40}", "en", "a") for i in range(200)] + [(2, "the same", "en", "a")] * 100 + [(i, None, None, None) for i in range(50)]
    _check(rows, sharding.with_slots(sharding.assign(_docs(spark, rows))).collect())


def test_written_shards_and_empty_tables(spark):
    rows = [(i, f"t{i}", "en", "a") for i in range(100)]
    folder = scratch_path(spark, "test-shards")
    sharding.write(table(spark, rows), folder)
    got = {r.doc_id: r.shard for r in spark.read.parquet(folder).collect()}
    assert got == {i: _jump(_key(i), 8) for i in range(100)}
    empty = sharding.with_slots(sharding.assign(_docs(spark, [])))
    assert empty.count() == 0 and "slot" in empty.columns
