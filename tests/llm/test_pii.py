import random
import re

from corpus_rows import documents  # noqa: F401
from fleetpulse.llm import pii as op


def luhn(digits):
    folded = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, digits[::-1]))]
    return sum(folded) % 10 == 0


def brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    tests = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p.lstrip("0")[:9] or 0) <= 255 for p in m[0].split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    ]
    # A long run of digits alone would take the first two patterns minutes.
    needs, text = ["@", ".", "", ""], text or ""
    return [(k, *m.span()) for k, (p, ok) in enumerate(tests) if needs[k] in text for m in re.finditer(p, text) if ok(m)]


def triples(flat):
    return list(zip(flat[::3], flat[1::3], flat[2::3]))


def test_base_spans_equal_brute_force(documents):
    rng = random.Random(4)
    parts = ["a.b", "@", "mail", ".", "com", " ", "-", "+", "(", ")", "12", "255", "256", "001", "4041894974608795", "4041 8949 7460 8795", "1.2.3.4", "é", "\U0001F4DE", "\n", "+1 (988) 555-2485"]
    texts = [None, "", "9" * 200_000, "1.1.1." + "0" * 5000 + "7", "a@b.c " * 30_000] + ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(500)]
    rows = list(enumerate(texts)) + [(6, texts[6]), (None, texts[6])]
    got = op.find_personal_data(documents(*rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert triples(r.base) == brute(r.doc.text), r.doc.text
        assert r.more == []


def test_long_runs_take_linear_time():
    run = 300_000
    text = "9" * run + " a@b.c " + "x" * run + "@y.z@d.e " + "9" * run + ".1 1.2.3.4.5.6.7.8 a@b c@d.e"
    second, third = run + 7, 2 * run + 16
    after = third + run + 3
    assert op.base_spans(text) == [
        (0, run + 1, run + 6), (0, second, second + run + 4), (0, after + 20, after + 25),
        (1, after, after + 7), (1, after + 8, after + 15),
    ]


def test_contexts_of_known_entities_find_unknown_identifiers(documents):
    known = [(i, f"prose and prose. Contact person: user{i}@mail.example.com more prose 77123 here") for i in range(12)]
    unknown = [(100 + i, f"other words. Contact person: ZX-{i}4711, other words 88123 end") for i in range(4)]
    common = [(200 + i, f"prose of the user{i}@mail.example.com and of the house of the tree") for i in range(12)]
    clean = [(300, "it is of the 123456 kind"), (301, "no number follows: contact person: nobody")]
    rows = known + unknown + common + clean + unknown[:1]
    found = {}
    for r in op.find_personal_data(documents(*rows)).collect():
        assert triples(r.base) == brute(r.doc.text)
        found.setdefault(r.doc.doc_id, []).append([r.doc.text[a:b] for _, a, b in triples(r.more)])
    assert {i: f for i, f in found.items() if any(f)} == {
        100: [["ZX-04711"]] * 2, 101: [["ZX-14711"]], 102: [["ZX-24711"]], 103: [["ZX-34711"]]
    }


def more_of(rows):
    found = {}
    for r in rows.collect():
        assert triples(r.base) == brute(r.doc.text)
        found[r.doc.doc_id] = [r.doc.text[a:b] for _, a, b in triples(r.more)]
    return {i: f for i, f in found.items() if f}


def test_discovered_identifiers_induce_further_patterns(documents):
    known = [(i, f"prose here. Contact person: user{i}@mail.example.com and more") for i in range(12)]
    first = [(100 + i, f"other words. Contact person: ZX-{i}4711, and more") for i in range(8)]
    again = [(200 + i, f"the gate wants badge no ZX-{i}4711 today") for i in range(8)]
    second = [(300 + i, f"the gate wants badge no QQ{i}8822 today") for i in range(4)]
    third = [(400 + i, f"signed by holder of: {code} at noon") for i, code in enumerate(["QQ08822", "QQ18822", "QQ28822", "QQ38822", "RR77001"])]
    # Believed instances alone do not make a pattern that mostly precedes other words.
    loose = [(500 + i, f"it is {'ZX-%d4711' % i if i < 4 else 'nothing'} it is 55555{i}") for i in range(12)]
    want = {100 + i: [f"ZX-{i}4711"] for i in range(8)} | {200 + i: [f"ZX-{i}4711"] for i in range(8)}
    want |= {300 + i: [f"QQ{i}8822"] for i in range(4)} | {400 + i: [f"QQ{i}8822"] for i in range(4)} | {404: ["RR77001"]}
    assert more_of(op.find_personal_data(documents(*known, *first, *again, *second, *third, *loose))) == want
    # Without the e-mails nothing is known, so nothing is found.
    assert more_of(op.find_personal_data(documents(*first, *again, *second, *third))) == {}


def test_candidates_equal_a_walk_over_all_words():
    rng = random.Random(11)
    parts = ["of", "the", "a1234", "(Ab-9912),", "user@mail.com", "<u@x.com>", "+1 555 010 9912", "\u00e9t\u00e9", "x" * 300, "12", "@", "\n", "\x1f", "10.0.0.1"]
    for _ in range(400):
        text = "".join(rng.choice(parts) + rng.choice([" ", "  ", "", "\t"]) for _ in range(rng.randrange(25)))
        spans, want, before = op.base_spans(text), [], []
        starts = {start: end for _, start, end in reversed(spans)}
        for m in re.finditer(r"\S+", text):
            known, word = op._known(m, starts), m[0].strip(op.TRIM)
            at = m.start() + m[0].index(word) if word else 0
            free = all(e <= at or s >= at + len(word) for _, s, e in spans)
            if len(before) >= 2 and (known or (len(word) >= 5 and re.search("[0-9]", word) and free)):
                place = known or (at, at + len(word))
                want.append((" ".join(before[-2:]), text[place[0]:place[1]].lower(), known is not None, *place))
            before.append(m[0].lower())
        assert op.candidates(text, spans) == want, text


def test_a_crowded_bitmap_and_small_counts_give_the_same(documents, monkeypatch):
    rows = [(i, f"words id{i % 3} number: user{i}@x.example.org words id{i % 3} number: QQ{i}99") for i in range(30)]
    want = sorted(str(r) for r in op.find_personal_data(documents(*rows)).collect())
    monkeypatch.setattr(op, "BITMAP_BITS", 1 << 15)
    monkeypatch.setattr(op, "HELD", 1)
    assert sorted(str(r) for r in op.find_personal_data(documents(*rows)).collect()) == want
    assert "QQ" in str(want) and any("more=[4" in w for w in want)


def test_no_rows(documents):
    assert op.find_personal_data(documents().limit(0)).collect() == []


def test_entities_behind_punctuation_are_seeds(documents):
    quoted = ['<user{}@mail.example.com>', '"10.0.0.{}"', '(+1 555 010 99{})', "['user{}@mail.example.com',", '<.user{}@mail.example.com>']
    marks = "abcdefghijkl"  # no digit in the texts with addresses
    known = [(20 * k + i, f"prose and prose. Contact person: {form.format(marks[i] if '@' in form else 10 + i)} end")
             for k, form in enumerate(quoted) for i in range(12)]
    unknown = [(200 + i, f"other words. Contact person: (ZX-{i}4711), other words end") for i in range(4)]
    found = {}
    for r in op.find_personal_data(documents(*known, *unknown)).collect():
        assert triples(r.base) == brute(r.doc.text)
        found[r.doc.doc_id] = [r.doc.text[a:b] for _, a, b in triples(r.more)]
    assert {i: f for i, f in found.items() if f} == {200 + i: [f"ZX-{i}4711"] for i in range(4)}
    assert op.candidates("to me: ((", []) == [] and op._known(op.WORD.match("((("), {3: 9}) == (3, 9)
