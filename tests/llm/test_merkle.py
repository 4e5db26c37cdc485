import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus_rows import documents  # noqa: F401
from fleetpulse.llm import merkle as op


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(*fields):
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def brute(level, fanout):
    """Root, and for each leaf its steps."""
    steps, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for leaf, node in enumerate(at):
            first = node // fanout * fanout
            steps[leaf].append(("".join(level[first:node]), "".join(level[node + 1:first + fanout])))
        level = [sha("".join(level[i:i + fanout])) for i in range(0, len(level), fanout)]
        at = [node // fanout for node in at]
    return level[0], steps


def expected(rows, fanout):
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf_of(r[0], r[3], r[2], r[4], r[1])))
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    done = {n: (sorted(trees[n]), *brute([leaf for *_, leaf in sorted(trees[n])], fanout)) for n in names}
    root, tops = brute([done[n][1] for n in names], fanout)
    out = []
    for n, top in zip(names, tops):
        leaves, subroot, steps = done[n]
        out += [((i if named else None), leaf, subroot, root, tuple(s + top)) for (named, i, leaf), s in zip(leaves, steps)]
    return out


def rows_of(count):
    langs = [None, "", "en", "en", "en", "de", "zz", "é", "1", "0"]
    rows = [(i, f"Text {i} é" * (i % 4), langs[i % len(langs)], None if i % 7 == 0 else f"s{i % 3}") for i in range(count)]
    rows += [(5, "other text", "en", "s"), (5, "other text", "en", "s"), (None, None, "en", None), (None, "no id", None, "s"), (9999, "x" * 300_000, "lone", "s")]
    return [(*r, len(r[1] or "")) for r in rows]


@pytest.mark.parametrize("fanout, levels", [(2, 2), (3, 1), (8, 3)])
def test_proofs_and_roots_equal_brute_force(documents, fanout, levels):
    rows = rows_of(70)
    proofs, log = op.manifest(documents(*[r[:4] for r in rows]), fanout=fanout, levels=levels)
    got = proofs.withColumn("folded", op.fold(F.col("leaf"), F.col("proof"))).collect()
    assert {r.doc["size"] for r in got} == {"x"}
    assert all(r.folded == r.root for r in got)
    found = sorted(((r.doc.doc_id, r.leaf, r.subroot, r.root, tuple((s.before, s.after) for s in r.proof)) for r in got), key=str)
    assert found == sorted(expected(rows, fanout), key=str)

    nodes = {}
    for r in log.collect():
        nodes.setdefault(r.tree, []).append(r)
    for tree in nodes.values():
        # In the order of the log, a node closes the open subtrees of its level below it.
        tree.sort(key=lambda r: r.position)
        assert [r.position for r in tree] == list(range(len(tree)))
        open_nodes = []
        for r in tree:
            if r.level:
                children = open_nodes[-fanout:]
                while children[0].level != r.level - 1 or children[0]["index"] // fanout != r["index"]:
                    children = children[1:]
                assert r.hash == sha("".join(c.hash for c in children))
                del open_nodes[-len(children):]
            open_nodes.append(r)
        assert len(open_nodes) == 1 and open_nodes[0].leaves == sum(1 for r in tree if r.level == 0)


def test_positions_count_subtrees():
    for leaves in (1, 2, 7, 8, 9, 64, 65, 100):
        places, level, width = [], 0, leaves
        while True:
            places += op.position(np.full(width, level), np.arange(width), np.full(width, leaves), 8).tolist()
            if width == 1:
                break
            level, width = level + 1, -(-width // 8)
        assert sorted(places) == list(range(len(places)))


def test_a_changed_text_no_longer_leads_to_the_root(documents):
    proofs, _ = op.manifest(documents(*[(i, f"t{i}") for i in range(20)]), carry=["doc_id"])
    wrong = proofs.withColumn("folded", op.fold(F.sha2(F.lit("wrong").cast("binary"), 256), F.col("proof")))
    assert wrong.filter("folded = root").count() == 0


def test_empty_table_and_lone_row(documents):
    proofs, log = op.manifest(documents().limit(0))
    assert proofs.collect() == [] and log.collect() == []
    proofs, log = op.manifest(documents((1, None)))
    (r,) = proofs.collect()
    assert r.leaf == r.subroot == r.root and r.proof == [] and log.count() == 1
