import random
import re

import pytest

from corpus_rows import documents  # noqa: F401
from fleetpulse.llm import secrets as op

TESTS = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
}
MORE = {r.kind: (r.pattern, lambda m: True) for r in op.MORE}


def brute(text):
    rules = {**TESTS, **MORE}
    spans = [(m.start(), i, m.end(), kind) for i, (kind, (p, ok)) in enumerate(rules.items()) for m in re.finditer(p, text or "") if ok(m)]
    return sorted(spans)


def test_spans_equal_brute_force(documents):
    rng = random.Random(2)
    parts = [
        "password", "PASSWD", "Secret", "token", "api_key", "ApiKey", "apikey", "=", ":", " ", "  ", '"', "'", "\n", "é", "\U0001F511", "\x01", "\x02",
        "abcdef12", "0123456789abcdef", "0123456789abcdef0123456789abcdef", "AKIA", "AKIA0123456789AB", "ABCDEFGHIJKL", "short", "ghp_", "a" * 36, "eyJ",
        "eyJabcdefghij.eyJabcdefghij.sig_sig_sig", "-----BEGIN RSA PRIVATE KEY-----", "xoxb-1234567890", ".", "-", "=", "AIza" + "b" * 35, "KeK",
    ]
    texts = [None, "", "x" * 300_000, "ab12" * 50_000, "token=" + "a" * 100_000, "password: token:abcdefgh password=token=abcdefgh"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 40))) for _ in range(400)]
    rows = list(enumerate(texts)) + [(8, texts[8]), (None, texts[8])]
    got = op.find_secrets(documents(*rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert [tuple(s) for s in r.spans] == brute(r.doc.text), r.doc.text


def test_queries_from_patterns():
    assert op.trigram_query("[0-9a-f]{32,}") is True
    assert op.trigram_query("AKIA[A-Z0-9]{12,}") == ("and", ("aki", "kia"))
    assert op.grams_of(op.trigram_query("(?i:api_?key)=")) == {"api", "pi_", "i_k", "_ke", "key", "ey=", "pik", "ike"}
    assert op.trigram_query("ab|cdef") is True
    assert op.trigram_query("(abc|def)x*(ghi)+") == ("and", (("or", ("abc", "def")), "ghi"))


@pytest.mark.parametrize("rule", [r for r in (*op.BASE, *op.MORE) if r.kind not in ("hex",)], ids=lambda r: r.kind)
def test_every_other_rule_has_mandatory_trigrams(rule):
    assert op.trigram_query(rule.pattern) is not True


def test_no_rows(documents):
    assert op.find_secrets(documents().limit(0)).collect() == []
