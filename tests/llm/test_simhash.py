import random

import pytest
import xxhash

from corpus_rows import documents  # noqa: F401
from fleetpulse.llm import simhash as op
from fleetpulse.llm.components import components


def brute_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\v\f\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, bits=2):
    """Smallest id reachable, for (id, print) rows."""
    group = {}
    for start in {p for _, p in prints}:
        reach, todo = {start}, [start]
        while todo:
            at = todo.pop()
            for other in {p for _, p in prints} - reach:
                if (at ^ other).bit_count() <= bits:
                    reach.add(other)
                    todo.append(other)
        group[start] = min((i for i, p in prints if p in reach and i is not None), default=None)
    return group


def test_groups_equal_brute_force(documents):
    rng = random.Random(3)
    base = [" ".join(rng.choice("alpha beta gamma Delta eps zeta".split()) for _ in range(90)) for _ in range(6)]
    texts = [None, "", " \t\n", "one", "ONE", "two words", "Ünï Öde x", "x" * 500_000, "a b c " * 20_000]
    for text in base:
        for _ in range(12):
            words = text.split()
            words[rng.randrange(90)] = "changed"
            texts.append(" ".join(words))
    texts += base * 2
    rows = list(enumerate(texts)) + [(3, "one"), (None, "one"), (None, "alone without an id")]
    got = op.near_duplicates(documents(*rows)).collect()
    assert len(got) == len(rows)
    prints = [(i, brute_print(t)) for i, t in rows]
    groups = brute_groups(prints)
    assert sorted(str((r.doc.doc_id, r.doc.text, r.fp & (1 << 64) - 1, r.component_id)) for r in got) == sorted(
        str((i, t, p, groups[p])) for (i, t), (_, p) in zip(rows, prints)
    )


@pytest.mark.parametrize("bits", [0, 1, 2])
@pytest.mark.parametrize("crowd", [1, 128])
def test_both_ways_through_a_bucket_lose_no_link(spark, monkeypatch, bits, crowd):
    monkeypatch.setattr(op, "CROWD", crowd)
    rng = random.Random(bits)
    prints = {0, (1 << 64) - 1}
    for _ in range(12):
        centre = rng.getrandbits(64)
        prints |= {centre} | {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(10)}
    frame = spark.createDataFrame([(op._signed(p),) for p in prints], "fp long")
    root = {r.node: r.root for r in components(op.links(frame, bits)).collect()}
    rows = [(op._signed(p), p) for p in prints]
    assert {s: root.get(s, s) for s, _ in rows} == {s: brute_groups(rows, bits)[p] for s, p in rows}


def test_fingerprint_equals_the_engine_hash(spark):
    frame = spark.createDataFrame([("only three words",)], "text string")
    row = frame.selectExpr("xxhash64(text) as h", "text").withColumn("fp", op.fingerprint("text")).first()
    assert row.h == row.fp


def test_no_rows(documents):
    assert op.near_duplicates(documents().limit(0)).collect() == []


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (200, 300)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 200: 200, 300: 200}
