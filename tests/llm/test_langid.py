import duckdb
import numpy as np

from corpus_rows import documents  # noqa: F401
from fleetpulse.llm import langid as op

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = op.op10_language(spark, SF).collect()
    lang = dict(duckdb.sql(f"select doc_id, lang from '{SF}/documents.parquet'").fetchall())
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and len(held) > 250
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_texts(documents):
    rows = [(i, "the house and the tree", "en", "s") for i in range(30)] + [(100 + i, "das haus und der baum", "de", "s") for i in range(30)]
    odd = [(200, None, "en", "s"), (201, "", "en", "s"), (202, "12 !?", "de", "s"), (203, "ß" * 200_000, None, "s"), (None, "der baum", None, "s"), (204, "\U00020000", None, "s")]
    docs = documents(*rows, *odd, *rows[:2])
    got = op.identify(docs, op.train(docs)).collect()
    assert len(got) == len(rows) + len(odd) + 2
    for r in got:
        if r.doc.doc_id in (200, 201, 202):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("en", "de") and 0 < r.score <= 1
            if r.doc.doc_id is not None and r.doc.doc_id < 200:
                assert r.lang_pred == r.doc.lang


def test_nothing_learned(documents):
    docs = documents((1, "words", None, "s"))
    assert [r.lang_pred for r in op.identify(docs, op.train(docs)).collect()] == ["und"]
    empty = docs.limit(0)
    assert op.identify(empty, op.train(empty)).collect() == []


def test_document_frequencies_count_every_row(spark):
    frame = spark.createDataFrame([("ab",), ("ab",), ("b",), ("",), ("1",)], "text string").repartition(3)
    seen, total = op.document_frequencies(frame)
    assert total == 3 and seen[op.grams("b")[0][0]] >= 3 and seen.max() == 3


def test_penalties_keep_weights_sparse():
    vectors = [(np.array([k % 2, 5]), np.array([1.0, 0.01])) for k in range(200)]
    weights = op.ftrl(vectors, [k % 2 for k in range(200)], 2, 8)
    assert (weights[:, [2, 3, 4, 6, 7]] == 0).all() and weights[0, 0] > 0 > weights[0, 1]


def test_temperature_calibrates():
    random = np.random.default_rng(1)
    logits = random.normal(0, 1, (4000, 3))
    chance = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
    answers = np.array([random.choice(3, p=p) for p in chance])
    assert abs(op.temperature(logits * 5, answers) - 5) < 0.6
    assert op.temperature(np.zeros((0, 3)), np.zeros(0, int)) == 1.0
