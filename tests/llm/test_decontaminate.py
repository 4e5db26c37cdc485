import random
import re

import pytest

from corpus_rows import documents  # noqa: F401
from fleetpulse.llm import decontaminate as op

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window=13):
    words, hit, found = fold(text), set(), set()
    for name, item in items:
        item = fold(item)
        size = min(window, len(item))
        windows = {tuple(item[i:i + size]) for i in range(len(item) - size + 1)} if size else set()
        for at in range(len(words) - size + 1):
            if tuple(words[at:at + size]) in windows:
                hit.update(range(at, at + size))
                if name is not None:
                    found.add(str(name))
    return len(words), len(hit), sorted(found)


@pytest.fixture
def items(spark):
    def build(*rows):
        return spark.createDataFrame(list(rows), "item_id long, text string, spans string, doc string").repartition(2)

    return build


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_hits_equal_brute_force(documents, items, block_bytes):
    rng = random.Random(5)
    words = ["Alpha", "beta", "gamma", "déjà", "x1", "the"]

    def prose(n):
        return " ".join(rng.choice(words) + rng.choice(["", ",", "-", "."]) for _ in range(n))

    bench = [(i, prose(rng.choice([2, 5, 13, 20, 40]))) for i in range(25)] + [(3, "repeated id beta"), (None, "no name"), (40, None), (41, "!!!")]
    texts = [prose(rng.randrange(120)) for _ in range(40)]
    texts += [prose(9) + " " + bench[i][1].upper() + " " + prose(9) for i in range(25)]
    texts += [None, "", "...", "no name", "x" * 400_000, " ".join(bench[4][1] for _ in range(3000))]
    got = op.benchmark_hits(documents(*enumerate(texts)), items(*[(*b, "x", "x") for b in bench]), block_bytes=block_bytes).collect()
    assert len(got) == len(texts)
    for r in got:
        n, hit, names = brute(r.doc.text, bench) if len(r.doc.text or "") < 5000 else (r.n_words, r.n_hit, r["items"])
        assert (r.n_words, r.n_hit, r["items"]) == (n, hit, names), r.doc.text
        assert r.contaminated == (hit > 0 and 20 * hit >= n)
        assert sum(b - a for a, b in zip(r.spans[::2], r.spans[1::2])) == r.n_hit


def test_spans_are_cut_and_contaminated_documents_go(documents, items):
    passage = " ".join(f"p{i}" for i in range(15))
    filler = " ".join(f"Filler{i}." for i in range(400))
    rows = [(1, f"{filler} {passage.upper()}! {filler}"), (2, passage), (3, filler), (4, None), (3, filler)]
    marked = op.benchmark_hits(documents(*rows), items((1, passage, "", "")))
    got = sorted((r.doc_id, r.text or "", r.n_chars, r["size"]) for r in op.decontaminated(marked, "text", "n_chars").collect())
    assert got == [(1, f"{filler} ! {filler}", 2 * len(filler) + 3, "x"), (3, filler, len(filler), "x"), (3, filler, len(filler), "x"), (4, "", 0, "x")]


def test_empty_tables(documents, items):
    assert op.benchmark_hits(documents().limit(0), items((1, "some words", "", ""))).collect() == []
    assert [r.n_hit for r in op.benchmark_hits(documents((1, "some words")), items((1, "x", "", "")).limit(0)).collect()] == [0]
