import zlib

import duckdb
import numpy as np
import pytest

from corpus_rows import documents  # noqa: F401
from fleetpulse.llm import quality as op

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = op.op4_quality(spark, SF).collect()
    labels = dict(duckdb.sql(f"select doc_id, quality from '{SF}/labels.parquet'").fetchall())
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    judged = [r for r in rows if r.held_out and r.doc_id in labels]
    assert len(judged) > 100 and np.mean([r.predicted == labels[r.doc_id] for r in judged]) >= 0.97


def test_score_depends_on_the_text_alone(spark, documents):
    good = [(i, "Plain words make a sentence number %d here. It goes on for a while." % i) for i in range(60)]
    bad = [(100 + i, "BUY!! NOW!! %d!! " % i * 6) for i in range(60)]
    odd = [(500, None), (501, ""), (502, " \n"), (503, "w " * 200_000), (None, "Plain words."), (504, "Plain words."), (504, "Plain words.")]
    labels = spark.createDataFrame(
        [(i, int(i < 100), 0) for i, _ in good + bad] + [(None, 1, 0), (3, None, 0), (4, 7, 0), (5, 1, 0)], "doc_id long, quality int, toxic int"
    )
    docs = documents(*good, *bad, *odd)
    got = op.quality_scores(docs, op.train(docs, labels)).collect()
    assert len(got) == len(good + bad + odd)
    assert all(r.predicted == (r.doc.doc_id < 100) for r in got if r.doc.doc_id is not None and r.doc.doc_id < 200)
    score = {}
    for r in got:
        assert r.score == score.setdefault(r.doc.text or "", r.score) and 0 <= r.score <= 1


def test_without_labels_or_rows(spark, documents):
    docs, none = documents((1, "text")), spark.createDataFrame([], "doc_id long, quality int")
    assert [(r.score, r.predicted) for r in op.quality_scores(docs, op.train(docs, none)).collect()] == [(0.5, 1)]
    empty = docs.limit(0)
    assert op.quality_scores(empty, op.train(empty, none)).collect() == []


def test_pairs_put_good_rows_before_bad_ones():
    random = np.random.default_rng(0)
    good, bad = random.normal(0, 1, (300, len(op.FEATURES))), random.normal(0, 1, (100, len(op.FEATURES)))
    good[:, 3] += 4
    model = op.fit(good, bad, 0.25)
    assert (model.score(good) >= 0.5).mean() > 0.95 and (model.score(bad) < 0.5).mean() > 0.9
    assert np.mean(model.score(np.concatenate([good, bad])) < 0.5) == pytest.approx(0.25, abs=0.02)


@pytest.mark.parametrize("broadcast_bytes", [op.BROADCAST_BYTES, 0])
def test_cut_is_the_quantile_of_all_labelled_scores(spark, documents, monkeypatch, broadcast_bytes):
    monkeypatch.setattr(op, "BROADCAST_BYTES", broadcast_bytes)
    random = np.random.default_rng(1)
    rows = [(i, " ".join("BUY!!" if random.random() < p else f"word{random.integers(50)}" for _ in range(random.integers(5, 40))))
            for i, p in enumerate(random.choice([0.1, 0.2, 0.3, 0.5, 0.6], 600))]
    # A repeated id has two rows; a label without a document and one given twice are among the labels.
    docs = documents(*rows, (3, "BUY!! word1 word2"))
    given = [(i, int(text.count("BUY") * 3 < len(text.split()))) for i, text in rows] + [(7, 0), (9000, 0), (None, 0), (8, 5)]
    model = op.train(docs, spark.createDataFrame(given, "doc_id long, quality int"), bound=40)
    learnt = [(i, q) for i, q in given if i is not None and q in (0, 1) and zlib.crc32(str(i).encode()) % 3 != 1]
    texts = [(i, text) for i, text in [*rows, (3, "BUY!! word1 word2")]]
    pairs = [(text, q) for i, q in learnt for j, text in texts if i == j]
    scores = np.sort(model.strength(np.array([op.features(t) for t, _ in pairs])))
    bad = sum(q == 0 for _, q in pairs)
    assert len(pairs) > 300 and model.cut == pytest.approx((scores[bad - 1] + scores[bad]) / 2, abs=1e-9)
    assert model.spread == pytest.approx(scores.std() / 4)
