import zlib

from corpus_rows import documents  # noqa: F401
from fleetpulse.llm.sharding import shard_by_bytes


def test_shards_are_contiguous_gapless_and_near_equal(documents):
    texts = [(i, ("é" * (i * 7919 % 97)) if i % 5 else None) for i in range(300)] + [(7, "twice"), (7, "twice"), (None, "no id")]
    rows = shard_by_bytes(documents(*texts), 8).collect()
    assert len(rows) == len(texts)
    rows.sort(key=lambda r: (r.doc.doc_id is None, r.doc.doc_id or 0, r.text_crc32, r["size"], r.shard, r.slot))
    assert [r.shard for r in rows] == sorted(r.shard for r in rows)
    total, load = sum(r["size"] for r in rows), {}
    for r in rows:
        raw = (r.doc.text or "").encode()
        assert r["size"] == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw)
        assert r.slot == load.setdefault(r.shard, [0, 0])[0]
        load[r.shard][0] += 1
        load[r.shard][1] += r["size"]
    assert set(load) == set(range(8))
    assert all(abs(size - total / 8) <= 97 * 2 + 1 for _, size in load.values())


def test_equal_rows_each_get_a_slot(documents):
    rows = shard_by_bytes(documents(*[(1, "same")] * 40), 4).collect()
    assert sorted((r.shard, r.slot) for r in rows) == [(s, i) for s in range(4) for i in range(10)]


def test_no_rows(documents):
    assert shard_by_bytes(documents().limit(0), 4).collect() == []


def test_one_very_long_text(documents):
    rows = shard_by_bytes(documents((1, "a"), (2, "b" * 2_000_000), (3, "")), 16).collect()
    assert {r.doc.doc_id: r.slot for r in rows} == {1: 0, 2: 0, 3: 0}
