import hashlib
import zlib

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import sharding
from tidemark.llm.shared_files import stored


def plain_jump(key, shards):
    """The law one key at a time, with unbounded whole numbers."""
    held, at = -1, 0
    while at < shards:
        held = at
        key = (key * 2862933555777941757 + 1) % 2**64
        at = int((held + 1) * (float(2**31) / ((key >> 33) + 1)))
    return held


def plain_shard(doc_id, shards):
    digest = hashlib.md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()
    return plain_jump(int(digest[:15], 16), shards)


def test_jump_equals_plain_version_and_moves_only_into_new_shards():
    keys = np.random.default_rng(3).integers(0, 2**63, 3000, dtype=np.uint64)
    before = None
    for shards in (1, 2, 3, 24, 25, 1000):
        found = sharding.jump(keys, shards)
        assert found.tolist()[:300] == [plain_jump(int(k), shards) for k in keys[:300]]
        assert found.min() >= 0 and found.max() < shards
        if before is not None:
            assert (found[found != before[1]] >= before[0]).all()
        before = (shards, found)
    counts = np.bincount(sharding.jump(keys, 24), minlength=24)
    assert counts.min() > 70 and counts.max() < 190
    assert len(sharding.jump(keys[:0], 5)) == 0


def query(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    return sharding.op11_sharding(spark, str(tmp_path)).collect()


def test_query_equals_brute_force(spark, documents, tmp_path):
    texts = ["", None, "é" * 50_000, "same", "same", "x\x00y", "\n"]
    rows = [(i, texts[i % 7]) for i in range(400)] + [(5, "same")] * 40 + [(5, "other")] + [(None, "same")] * 9
    found = query(spark, documents(rows, shard="clash", slot=1, row=2, size="x"), tmp_path)
    assert len(found) == len(rows)
    wanted = sorted(
        (d is None, d or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), plain_shard(d, 24), plain_shard(d, 25))
        for d, t in rows
    )
    assert wanted == sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32, r.shard, r.grown_shard) for r in found)
    assert {r.law for r in found} == {"key"}
    assert all(r.grown_shard in (r.shard, 24) for r in found)
    for shard in range(24):
        slots = sorted(r.slot for r in found if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_empty_table(spark, documents, tmp_path):
    assert query(spark, documents([]), tmp_path) == []


def test_slots_do_not_depend_on_buckets_and_split_large_groups(spark, monkeypatch):
    rows = spark.range(500).withColumn("text", F.lit("a")).unionByName(spark.range(300).select(F.lit(7).cast("long").alias("id"), F.lit("b").alias("text")))
    rows = stored(sharding.assign(rows, 3, "id"), "test")
    one = {(r.id, r.text, r.shard, r.slot) for r in sharding.with_slots(rows, "id").collect()}
    monkeypatch.setattr(sharding, "COPIES_PER_TASK", 16)
    many = {(r.id, r.text, r.shard, r.slot) for r in sharding.with_slots(rows, "id", rows_per_bucket=20).collect()}
    assert one == many and len(one) == 800


def test_written_shards_hold_every_row_once(spark, documents, tmp_path):
    docs = documents([(i, f"text {i}") for i in range(200)] + [(3, None), (None, "n")])
    sharding.write_shards(docs, str(tmp_path / "shards"), 6, files=2)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 202 and back.select("shard").distinct().count() == 6
    assert all(r.shard == plain_shard(r.doc_id, 6) for r in back.select("doc_id", "shard").collect())
    moves = sharding.moved(docs, 6, 8).collect()
    assert 0 < len(moves) < 120 and {r.to_shard for r in moves} <= {6, 7}
