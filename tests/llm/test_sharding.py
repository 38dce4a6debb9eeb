from collections import defaultdict
from hashlib import md5
from zlib import crc32

import pytest

from medalake.llm import sharding


def jump(key: int, shards: int) -> int:
    at, following = -1, 0
    while following < shards:
        at = following
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        following = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


ROWS = [(i, f"t{i % 7}") for i in range(300)] + [(None, None), (5, "again"), (7, "t0"), (7, "t0")]


@pytest.mark.parametrize("shards", [1, 2, 16])
def test_jump_hash_row_by_row(frame, shards):
    df = frame(ROWS, "doc_id bigint, text string")
    got = sharding.shard_rows(df, "doc_id", ["text"], shards).collect()
    assert len(got) == len(ROWS)
    slots = defaultdict(list)
    for r in got:
        key = int(md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:16], 16)
        assert r.shard == jump(key, shards) and r.grown_shard == jump(key, shards + 1)
        assert r.grown_shard in (r.shard, shards)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_copies_of_a_hot_row_get_slots_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES_PER_BLOCK", 7)
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 3)
    df = spark.range(100).selectExpr("CASE WHEN id < 60 THEN 1 ELSE id END AS k", "'x' AS v")
    got = sharding.shard_rows(df, "k", ["v"], 4).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert sum(map(len, slots.values())) == 100
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_empty_table_and_written_shards(spark, frame, tmp_path):
    assert sharding.shard_rows(frame([], "doc_id bigint, text string"), "doc_id", ["text"]).count() == 0
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string")
    sharding.write_shards(df, f"{tmp_path}/s", shards=4)
    back = spark.read.parquet(f"{tmp_path}/s")
    assert back.count() == len(ROWS) and {r.shard for r in back.collect()} <= {0, 1, 2, 3}
    assert crc32(b"") == 0
