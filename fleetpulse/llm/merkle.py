"""Merkle manifest of a dataset: a postorder log of hash tree nodes, proofs read from it by position."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.llm.frames import packed_columns, running, small_or_merge, table
from fleetpulse.session import stage

FANOUT = 8
# A builder gets the FANOUT ** BUILDER_LEVELS consecutive nodes below one node, so its work is bounded and aligned.
BUILDER_LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

STEP = "struct<before: string, after: string>"
_STEP = pa.struct([("before", pa.string()), ("after", pa.string())])


def leaf_hash(fields: list[Column]) -> Column:
    """SHA-256, as hex, of the fields one after the other: ``-`` for null, else UTF-8 byte count, colon, value."""
    parts = [F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")), F.lit("-")) for f in fields]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def subtree_size(leaves: np.ndarray, level: np.ndarray, fanout: int = FANOUT) -> np.ndarray:
    """Nodes of a subtree of ``level`` levels above its ``leaves``, which fill it from the left."""
    size = leaves.copy()
    for k in range(1, int(level.max(initial=0)) + 1):
        size += np.where(k <= level, -(-leaves // fanout**k), 0)
    return size


def position(level: np.ndarray, index: np.ndarray, leaves: np.ndarray, fanout: int = FANOUT) -> np.ndarray:
    """Place in the postorder log of node ``index`` of ``level`` in a tree of ``leaves`` leaves.

    All subtrees that end at or before the node's first leaf are written before it, then its
    own subtree, of which it is the last.
    """
    first = index * fanout**level
    before = first.copy()
    power = fanout
    while power <= first.max(initial=0):
        before += first // power
        power *= fanout
    return before + subtree_size(np.minimum(fanout**level, leaves - first), level, fanout) - 1


def _height(leaves: int, fanout: int) -> int:
    level = 0
    while fanout**level < leaves:
        level += 1
    return level


def _sha(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


_LOG = "tree string, leaves long, block long, level int, index long, position long, hash string"


def _builder(base: int, levels: int, fanout: int):
    """Reads nodes of level ``base`` by tree and index, and writes each node above them as soon as its run is complete."""
    span = fanout**levels

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, open_runs, out = None, [], []

        def add(tree: str, leaves: int, block: int, level: int, index: int, digest: str, top: int) -> None:
            out.append((tree, leaves, block, base + level, index, digest))
            if level < top:
                open_runs[level].append(digest)
                if len(open_runs[level]) == fanout:
                    close(tree, leaves, block, level, index, top)

        def close(tree: str, leaves: int, block: int, level: int, index: int, top: int) -> None:
            run, open_runs[level] = open_runs[level], []
            add(tree, leaves, block, level + 1, index // fanout, _sha(run), top)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("tree", "leaves", "index", "hash")]
            for tree, leaves, index, digest in zip(*columns):
                block = index // span
                top = min(levels, _height(leaves, fanout) - base)
                if at != (tree, block):
                    at, open_runs = (tree, block), [[] for _ in range(top)]
                add(tree, leaves, block, 0, index, digest, top)
                if (index + 1) * fanout**base >= leaves:  # the tree's last node: what is open is complete
                    last = index
                    for level in range(top):
                        if open_runs[level]:
                            close(tree, leaves, block, level, last, top)
                        last //= fanout
            if out:
                yield _nodes(out, fanout)
                out = []

    return build


def _nodes(rows: list[tuple], fanout: int) -> pa.RecordBatch:
    tree, leaves, block, level, index, digest = zip(*rows)
    place = position(np.array(level, np.int64), np.array(index, np.int64), np.array(leaves, np.int64), fanout)
    return pa.RecordBatch.from_arrays([
        pa.array(tree, pa.string()), pa.array(leaves, pa.int64()), pa.array(block, pa.int64()), pa.array(level, pa.int32()),
        pa.array(index, pa.int64()), pa.array(place), pa.array(digest, pa.string()),
    ], names=["tree", "leaves", "block", "level", "index", "position", "hash"])


def grow(nodes: DataFrame, fanout: int = FANOUT, levels: int = BUILDER_LEVELS) -> list[DataFrame]:
    """The logs of all trees from their stored leaves (tree, leaves, index, hash), one for every ``levels`` levels.

    Each builder writes the subtree of an aligned run of nodes in the order in which nodes
    complete. What the builders end with are the leaves of the next round, so the rounds
    are the logarithm of the largest tree, whatever the number of trees. A round's log
    repeats the nodes that it starts from, so that a block has all its siblings.
    """
    rounds, base = [], 0
    span = fanout**levels
    while True:
        dealt = nodes.select("tree", "leaves", "index", "hash", F.expr(f"index div {span}").alias("block"))
        ordered = dealt.repartition("tree", "block").sortWithinPartitions("tree", "index")
        log = stage(ordered.mapInArrow(_builder(base, levels, fanout), _LOG), f"merkle_log_{base}")
        rounds.append(log)
        base += levels
        nodes = log.filter((F.col("level") == base) & (F.col("leaves") > fanout**base))
        if nodes.isEmpty():
            return rounds


def _roots(rounds: list[DataFrame], fanout: int) -> DataFrame:
    """(tree, hash) of the last node of each tree."""
    out = None
    for log in rounds:
        reach = F.pow(F.lit(float(fanout)), F.col("level"))
        part = log.filter((F.col("index") == 0) & (reach >= F.col("leaves")) & ((F.col("level") == 0) | (reach / fanout < F.col("leaves"))))
        out = part if out is None else out.unionByName(part)
    # A node between two rounds stands in both logs.
    return out.groupBy("tree").agg(F.max("hash").alias("root"))


def _steps(nodes: DataFrame, log: DataFrame, above: DataFrame, base: int, levels: int, fanout: int) -> DataFrame:
    """``nodes`` (tree, block, leaves, index, ...) with ``root`` and ``proof``: the steps in their block, then those of ``above`` (tree, block, root, proof)."""
    schema = T.StructType([*nodes.schema.fields, T.StructField("root", T.StringType()), *T._parse_datatype_string(f"proof array<{STEP}>").fields])

    def extract(left: pa.Table, right: pa.Table) -> pa.Table:
        head = right.filter(pc.is_null(right["position"])).to_pylist()[0]
        block = right.filter(pc.is_valid(right["position"])).sort_by("position")
        places, digests = block["position"].to_numpy(), block["hash"].to_pylist()
        index, leaves = left["index"].to_numpy(), left["leaves"][0].as_py()
        proofs: list[list] = [[] for _ in range(len(index))]
        for level in range(base, base + min(levels, _height(leaves, fanout) - base)):
            own = index // fanout**(level - base)
            shown = {}
            for run in np.unique(own // fanout).tolist():
                siblings = np.arange(run * fanout, min((run + 1) * fanout, -(-leaves // fanout**level)), dtype=np.int64)
                at = position(np.full(len(siblings), level, np.int64), siblings, np.full(len(siblings), leaves, np.int64), fanout)
                run_digests = [digests[i] for i in np.searchsorted(places, at)]
                for i, sibling in enumerate(siblings.tolist()):
                    shown[sibling] = {"before": "".join(run_digests[:i]), "after": "".join(run_digests[i + 1:])}
            for proof, node in zip(proofs, own.tolist()):
                proof.append(shown[node])
        for proof in proofs:
            proof += head["proof"]
        return left.append_column("root", pa.array([head["root"]] * len(index), pa.string())).append_column("proof", pa.array(proofs, pa.list_(_STEP)))

    kept = log.select("tree", "block", "position", "hash", F.lit(None).cast("string").alias("root"), F.lit(None).cast(f"array<{STEP}>").alias("proof"))
    head = above.select("tree", "block", F.lit(None).cast("long").alias("position"), F.lit(None).cast("string").alias("hash"), "root", "proof")
    return nodes.groupBy("tree", "block").cogroup(kept.unionByName(head).groupBy("tree", "block")).applyInArrow(extract, schema)


def prove(rows: DataFrame, rounds: list[DataFrame], above: DataFrame, fanout: int = FANOUT, levels: int = BUILDER_LEVELS) -> DataFrame:
    """``rows`` (tree, leaves, index, ...) with ``root`` and ``proof``, given each tree's root and the steps above it (tree, root, proof).

    From the last round down, a block is read with the steps above it, and its nodes'
    siblings are addressed by their positions. A proof is made where its row is, and only
    the steps above a block are moved to it.
    """
    span = fanout**levels
    above = above.select("tree", F.lit(0).cast("long").alias("block"), "root", "proof")
    for depth in range(len(rounds) - 1, 0, -1):
        base = depth * levels
        log = rounds[depth]
        held = log.select("tree").distinct()
        # New names, as both sides come from one log.
        starts = log.filter(F.col("level") == base).select(*[F.col(c).alias(c) for c in ("tree", "block", "leaves", "index")])
        through = _steps(starts, log, above.join(held, "tree", "left_semi"), base, levels, fanout)
        below = through.select("tree", F.col("index").alias("block"), "root", "proof")
        above = stage(below.unionByName(above.join(held, "tree", "left_anti")), f"merkle_above_{base}")
    return _steps(rows.withColumn("block", F.expr(f"index div {span}")), rounds[0], above, 0, levels, fanout).drop("block")


def _placed(leaves: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Stored leaves (tree, hash, ...) with ``index`` in their tree's ``order`` and the number of its ``leaves``."""
    numbered, _ = running(leaves, [F.col("tree").asc(), *order], [], name)
    sizes = stage(numbered.groupBy("tree").agg(F.min("row").alias("first"), F.count("*").alias("leaves")), f"{name}_sizes")
    met = numbered.join(small_or_merge(sizes, 200), "tree")
    return stage(met.withColumn("index", F.col("row") - F.col("first")).drop("row", "first"), f"{name}_placed")


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(proof, leaf, lambda digest, step: F.sha2(F.concat(step["before"], digest, step["after"]).cast("binary"), 256))


def siblings_of(proof: Column) -> Column:
    """All digests of a proof, one after the other."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["before"], step["after"])), "")


def manifest(
    docs: DataFrame, *, key: str = "doc_id", tree: str = "lang", fields: tuple[str, ...] = FIELDS, carry: list[str] | None = None,
    fanout: int = FANOUT, levels: int = BUILDER_LEVELS,
) -> tuple[DataFrame, DataFrame]:
    """Hash trees over the rows of each ``tree`` value, one tree over their roots, and a proof for every row.

    Each run of ``fanout`` consecutive nodes, the last perhaps shorter, becomes the hash of
    their hex digests, until one is left. Returns two tables. The proofs: the input row (or
    the columns in ``carry``, so that texts need not be moved) as ``doc`` with ``leaf``,
    ``subroot``, ``root`` and ``proof``, an array of (before, after): the digests beside the
    node, level by level. The log: (tree, leaves, level, index, position, hash) of every
    node below the subroots, by position in the order in which nodes complete.

    A null tree value is a tree of its own and comes first; null ids come before all others;
    equal ids are ordered by their leaf, equal rows in any order, each with its own leaf. A
    null field is told from an empty one. A lone leaf is its tree's root, a lone tree's
    root the root of all. No rows give no rows and an empty log.
    """
    leaves = docs.select(
        packed_columns(docs, carry), F.coalesce(F.concat(F.lit("1"), F.col(tree)), F.lit("0")).alias("tree"),
        F.col(key).alias("id"), leaf_hash([F.col(f) for f in fields]).alias("hash"),
    )
    placed = _placed(leaves, [F.col("id").asc_nulls_first(), F.col("hash").asc()], "merkle_leaves").drop("id")
    rounds = grow(placed, fanout, levels)
    subroots = stage(_roots(rounds, fanout), "merkle_subroots")
    trees = _placed(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("root").alias("hash")), [F.col("of").asc()], "merkle_trees")
    top_rounds = grow(trees, fanout, levels)
    root = _roots(top_rounds, fanout)
    above = prove(trees, top_rounds, root.withColumn("proof", F.expr(f"cast(array() as array<{STEP}>)")), fanout, levels)
    above = stage(above.select(F.col("of").alias("tree"), F.struct(F.col("hash").alias("subroot"), "root").alias("both"), "proof"), "merkle_above")
    # The pair of roots travels as text beside the proof's head.
    proofs = prove(placed, rounds, above.select("tree", F.concat("both.subroot", F.lit(" "), "both.root").alias("root"), "proof"), fanout, levels)
    log = rounds[0]
    for depth, part in enumerate(rounds[1:], 1):
        log = log.unionByName(part.filter(F.col("level") > depth * levels))
    names = F.when(F.col("tree") == "0", F.lit(None)).otherwise(F.substring("tree", 2, 1 << 30)).alias("tree")
    return proofs.select(
        "doc", F.col("hash").alias("leaf"), F.substring_index("root", " ", 1).alias("subroot"), F.substring_index("root", " ", -1).alias("root"), "proof"
    ), log.select(names, "leaves", "level", "index", "position", "hash")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    plain = [F.col(f) for f in FIELDS]
    tampered = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 0
    changed = leaf_hash([*plain[:-1], F.translate("text", _UPPER, _LOWER)])
    proofs, _ = manifest(docs.withColumn("changed", F.when(tampered, changed)), carry=["doc_id", "changed"])
    folded = proofs.select(
        F.col("doc.doc_id").alias("doc_id"), "leaf", "subroot", "root",
        F.sha2(siblings_of(F.col("proof")).cast("binary"), 256).alias("proof_sha256"),
        fold(F.coalesce("doc.changed", "leaf"), F.col("proof")).alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def _tree_sql(group: str, source: str, levels: int, prefix: str) -> tuple[str, str]:
    """CTEs for the levels of trees over ``source`` (group, i, h), and expressions for a leaf's siblings and fold by level."""
    ctes = [f"{prefix}0 as (select {group} as g, i, h, count(*) over (partition by {group}) as n from {source})"]
    for k in range(levels):
        ctes.append(
            f"{prefix}r{k} as (select g, i // 8 as run, any_value(n) as n, list(h order by i) as hs from {prefix}{k} group by g, i // 8)")
        ctes.append(
            f"{prefix}{k + 1} as (select g, i, h, count(*) over (partition by g) as n from (select g, run as i, "
            f"case when n = 1 then hs[1] else sha256(array_to_string(hs, '')) end as h from {prefix}r{k}))")
    return ",\n".join(ctes), f"{prefix}{levels}"


def _oracle(levels: int = 8, top_levels: int = 3) -> str:
    """The trees level by level, enough for 8 ** 8 rows of a language and 8 ** 3 languages."""
    def leaf(text: str) -> str:
        fields = ["doc_id", "source", "lang", "n_chars", text]
        return "sha256(" + " || ".join(f"coalesce(octet_length(encode({f}::varchar))::varchar || ':' || {f}::varchar, '-')" for f in fields) + ")"

    low = f"translate(text, '{_UPPER}', '{_LOWER}')"
    trees, subroots = _tree_sql("lang", "placed", levels, "a")
    tops, roots = _tree_sql("0", "subs", top_levels, "b")

    def climb(prefix: str, count: int, source: str, place: str, group: str) -> tuple[str, str]:
        """CTEs that add to each row of ``source`` the siblings so far (s) and the fold (f), one level each."""
        ctes, last = [], source
        for k in range(count):
            p = f"({place} // {8 ** k}) % 8"
            before, after = f"array_to_string(r.hs[1:{p}], '')", f"array_to_string(r.hs[{p} + 2:], '')"
            ctes.append(
                f"{prefix}c{k} as (select c.* exclude (s, f), c.s || case when r.n = 1 then '' else {before} || {after} end as s, "
                f"case when r.n = 1 then c.f else sha256({before} || c.f || {after}) end as f "
                f"from {last} c join {prefix}r{k} r on r.g is not distinct from {group} and r.run = {place} // {8 ** (k + 1)})")
            last = f"{prefix}c{k}"
        return ",\n".join(ctes), last

    up, last = climb("a", levels, "started", "c.i", "c.lang")
    over, end = climb("b", top_levels, "risen", "c.ti", "0")
    return f"""
with t as (select list(v order by i) as tab from (select i, list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0]::bigint[],
    lambda a, z: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) as v from range(256) r(i))),
marked as (select *, {leaf('text')} as h, xor(list_reduce([4294967295::bigint] || list_transform(regexp_extract_all(hex(encode(coalesce(doc_id::varchar, ''))), '..'),
    lambda x: ('0x' || x)::bigint), lambda a, x: xor(a >> 8, tab[(xor(a, x) & 255) + 1])), 4294967295::bigint) % 3 = 0 as bad from documents, t),
placed as (select doc_id, lang, h, case when bad then {leaf(low)} else h end as f, row_number() over (partition by lang order by doc_id nulls first, h) - 1 as i from marked),
{trees},
subs as (select g as lang, h, row_number() over (order by g nulls first) - 1 as i from {subroots}),
{tops},
started as (select doc_id, lang, i, h as leaf, '' as s, f from placed),
{up},
risen as (select c.*, subs.h as subroot, subs.i as ti from {last} c join subs on subs.lang is not distinct from c.lang),
{over}
select doc_id, leaf, subroot, b.h as root, sha256(s) as proof_sha256, f as folded_root, f = b.h as verified from {end}, {roots} b
"""


ORACLE = _oracle()
