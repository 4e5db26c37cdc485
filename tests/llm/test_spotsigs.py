import hashlib
import random
import re

import pytest

from corpus_rows import documents  # noqa: F401
from fleetpulse.llm import spotsigs as op


def brute(text, anchors=frozenset(op.ANCHORS), chain=op.CHAIN):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    content = [(i, w) for i, w in enumerate(words) if w not in anchors]
    chains = set()
    for i, word in enumerate(words):
        after = [w for j, w in content if j > i][:chain]
        if word in anchors and len(after) == chain:
            chains.add(" ".join([word, *after]))
    if words and not chains:
        chains = {" ".join(["*", *words])}
    return sorted(int(hashlib.md5(c.encode()).hexdigest()[:8], 16) - (1 << 31) for c in chains)


def alike(a, b):
    return 1.0 if not a and not b else len(set(a) & set(b)) / len(set(a) | set(b))


def texts(seed=1):
    rng = random.Random(seed)
    words = ["the", "is", "Und", "der", "house", "Ärger", "x1", "tree,", "runs", "--", "del", "perro"]
    return [None, "", "...", "the", "one", "of the of", "x" * 200_000, "the a1 b2 " * 5000] + [
        " ".join(rng.choice(words) for _ in range(rng.randrange(60))) for _ in range(60)
    ]


def test_query_equals_brute_force(documents, tmp_path, spark):
    rows = [(i * 3 % 71, t) for i, t in enumerate(texts())] + [(5, "same id"), (5, "same id"), (5, "same id"), (None, "no id"), (None, None)]
    documents(*rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = op.op2_fingerprints(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    unique = {(i, t) for i, t in rows if sum(r[0] == i for r in rows) == 1}
    by_id = {i: t or "" for i, t in unique}
    order = sorted({i for i, _ in rows if i is not None}, reverse=True)
    seen = 0
    for r in got:
        if r.doc_id in by_id:
            after = order[order.index(r.doc_id) + 1] if r.doc_id != order[-1] else None
            if after not in by_id:
                continue
            seen += 1
            text, nxt = by_id[r.doc_id], by_id[after]
            half = len(text) // 2
            edited = text[:len(text) - half] + nxt[:half]
            mine, other, new = brute(text), brute(nxt), brute(edited)
            assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert (r.fingerprint, r.edited_fingerprint) == tuple(" ".join(map(str, s)) for s in (mine, new))
            assert r.near_edited == pytest.approx(alike(mine, new)) and r.near_next == pytest.approx(alike(mine, other))
    assert seen > 55
    twins = [r for r in got if r.doc_id == 5]
    assert len({r.fingerprint for r in twins}) <= 2 and sum(r.near_next == 1.0 for r in twins) >= 2


def test_single_row_follows_itself(documents, tmp_path, spark):
    documents((1, "abcdef")).write.parquet(str(tmp_path / "documents.parquet"))
    row = op.op2_fingerprints(spark, str(tmp_path)).first()
    assert row.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and row.near_next == 1.0


def test_no_rows(documents, tmp_path, spark):
    documents().limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert op.op2_fingerprints(spark, str(tmp_path)).collect() == []


def test_near_pairs_equal_brute_force(documents):
    rng = random.Random(9)
    base = [" ".join(f"{rng.choice(op.ANCHORS[:20])} c{rng.randrange(500)} d{rng.randrange(500)}" for _ in range(40)) for _ in range(5)]
    rows = list(enumerate(texts(3)))
    for k, text in enumerate(base):
        for j in range(6):
            words = text.split()
            for _ in range(j):
                words[rng.randrange(120)] = f"new{j}"
            rows.append((1000 + 10 * k + j, " ".join(words)))
    rows += [(2000, base[0]), (None, base[0])]
    members, pairs = op.near_pairs(documents(*rows))
    members = members.collect()
    assert len(members) == len(rows)
    sets = {i: brute(t) for i, t in rows if i is not None}
    of = {r.doc_id: r["class"] for r in members if r.doc_id is not None}
    want = {}
    for a in sets:
        for b in sets:
            if of[a] < of[b] and alike(sets[a], sets[b]) >= 0.8:
                want[of[a], of[b]] = alike(sets[a], sets[b])
    assert {(r.a, r.b): r.similarity for r in pairs.collect()} == pytest.approx(want)
    assert len(want) >= 20 and all((of[a] == of[b]) == (sets[a] == sets[b]) for a in sets for b in sets)
