"""Secret scan: Boolean trigram queries derived from each rule, an inverted index, verified candidates."""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as sre
from re import _parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.frames import packed_columns, small_or_merge, table, text_or_empty
from fleetpulse.session import stage


@dataclass(frozen=True)
class Rule:
    """``least`` characters are asked of group ``group``; shorter matches are dropped and not tried again."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# Runs of one class are matched whole, so their least length can stand in the pattern itself.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
# Formats that public services document for their keys, and key files.
MORE = (
    Rule("git", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
)

# A trigram query is True (anything may match), or ("and" | "or", parts), or a trigram.
MAX_STRINGS = 32
MARK, PLAIN = "\x01", "\x02"


# ---- trigram queries from patterns ----


def _all(parts: list):
    parts = list(dict.fromkeys(p for p in parts if p is not True))
    return True if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _any(parts: list):
    if any(p is True for p in parts) or not parts:
        return True
    parts = list(dict.fromkeys(parts))
    return parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _grams(strings: set[str]):
    """What a text must hold if it holds one of the strings."""
    return _any([_all([s[i:i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _exact(items) -> set[str] | None:
    """All strings that a part of a pattern can match, in lower case, or None if they are many."""
    run = {""}
    for kind, value in items:
        if kind is sre.LITERAL:
            more = {chr(value).lower()}
        elif kind is sre.IN and all(k is sre.LITERAL for k, _ in value):
            more = {chr(v).lower() for _, v in value}
        elif kind is sre.SUBPATTERN:
            more = _exact(value[3])
        elif kind is sre.BRANCH:
            parts = [_exact(p) for p in value[1]]
            more = None if any(p is None for p in parts) else set().union(*parts)
        elif kind is sre.MAX_REPEAT and value[1] <= 5:
            one = _exact(value[2])
            more = None if one is None else {""} if value[0] == 0 else set()
            if one is not None:
                power = {""}
                for count in range(1, int(value[1]) + 1):
                    power = {a + b for a in power for b in one}
                    more = more | power if count >= value[0] else more
                    if len(more) > MAX_STRINGS or len(power) > MAX_STRINGS:
                        more = None
                        break
        else:
            return None
        if more is None or len(run) * len(more) > MAX_STRINGS:
            return None
        run = {a + b for a in run for b in more}
    return run


def _query(items):
    found, run = [], {""}
    for item in items:
        kind, value = item
        more = _exact([item])
        if more is not None and len(run) * len(more) <= MAX_STRINGS:
            run = {a + b for a in run for b in more}
            continue
        found.append(_grams(run))
        run = more if more is not None else {""}
        if more is None:
            if kind is sre.SUBPATTERN:
                found.append(_query(value[3]))
            elif kind is sre.BRANCH:
                found.append(_any([_query(p) for p in value[1]]))
            elif kind is sre.MAX_REPEAT and value[0] >= 1:
                found.append(_query(value[2]))
    return _all([*found, _grams(run)])


def trigram_query(pattern: str):
    """The trigrams that any match holds in lower case, as a Boolean query; True if there are none."""
    return _query(_parser.parse(pattern))


def grams_of(query) -> set[str]:
    return set() if query is True else {query} if isinstance(query, str) else set().union(*map(grams_of, query[1]))


def _holds(query, has) -> Column:
    if isinstance(query, str):
        return has(query)
    parts = [_holds(p, has) for p in query[1]]
    out = parts[0]
    for part in parts[1:]:
        out = out & part if query[0] == "and" else out | part
    return out


# ---- index and candidates ----


def postings(texts: DataFrame, grams: set[str]) -> DataFrame:
    """Inverted index (gram, h1, h2) of distinct texts, for the trigrams that some query asks for."""
    low = texts.select("h1", "h2", F.lower("text").alias("low"))
    held = F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in sorted(grams)])
    return low.select("h1", "h2", F.explode(F.array_compact(held)).alias("gram")).distinct()


def candidates(index: DataFrame, queries: dict[str, object]) -> DataFrame:
    """(h1, h2, kinds): texts whose postings satisfy the queries, for rules that have one."""
    grams = sorted(set().union(*map(grams_of, queries.values())))
    flags = index.groupBy("h1", "h2").agg(*[F.max(F.col("gram") == g).alias(f"g{i}") for i, g in enumerate(grams)])
    has = {g: F.col(f"g{i}") for i, g in enumerate(grams)}
    kinds = F.array_compact(F.array(*[F.when(_holds(q, has.__getitem__), F.lit(k)) for k, q in queries.items()]))
    return flags.select("h1", "h2", kinds.alias("kinds")).filter(F.size("kinds") > 0)


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Spans of a rule's matches in code points, end exclusive.

    Matches are set off by a mark that the text no longer holds; the lengths of the pieces
    between marks then add up to the places.
    """
    marked = F.regexp_replace(F.translate(text, MARK, PLAIN), rule.pattern, f"{MARK}$0{MARK}")
    none = F.expr("cast(array() as array<struct<start: int, kind_no: int, end: int>>)")
    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("inside"), none.alias("spans"))

    def step(state: Column, piece: Column) -> Column:
        end = state["at"] + F.char_length(piece)
        span = F.struct(state["at"].alias("start"), F.lit(order).alias("kind_no"), end.alias("end"))
        long_enough = F.char_length(F.regexp_extract(piece, rule.pattern, rule.group)) >= rule.least if rule.least else F.lit(True)
        spans = F.when(state["inside"] & long_enough, F.array_append(state["spans"], span)).otherwise(state["spans"])
        return F.struct(end.alias("at"), (~state["inside"]).alias("inside"), spans.alias("spans"))

    return F.aggregate(F.split(marked, MARK), start, step, lambda state: state["spans"])


def find_secrets(
    docs: DataFrame, *, text: str = "text", carry: list[str] | None = None, base: tuple[Rule, ...] = BASE, more: tuple[Rule, ...] = MORE
) -> DataFrame:
    """Spans of every rule's matches in every text.

    Each rule's pattern gives a Boolean query of lower-case trigrams. Postings of the asked
    trigrams over the distinct texts are stored and intersected; only candidates are verified
    with the pattern. A rule without mandatory trigrams scans every text. Returns the input
    row (or the columns in ``carry``) as ``doc`` with ``spans``, an array of (start, kind_no,
    end, kind) by start, then rule; rules of ``base`` come first.

    A null or empty text has no spans, equal texts share their index entry but each row has
    its result, no rows give no rows.
    """
    rules = [*base, *more]
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q is not True}
    body = text_or_empty(text)
    # Two seeds make a key of 128 bits for a text.
    hashes = [F.xxhash64(body).alias("h1"), F.xxhash64(F.lit(1), body).alias("h2")]
    index = stage(postings(docs.select(body.alias("text"), *hashes), set().union(*map(grams_of, indexed.values()))), "secret_postings")
    found = stage(candidates(index, indexed), "secret_candidates")
    rows = docs.select(packed_columns(docs, carry), body.alias("text"), *hashes)
    # One row per text on the right, so adaptive execution can split a text that many rows share.
    marked = rows.join(small_or_merge(found, 120), ["h1", "h2"], "left")
    nothing = F.expr("cast(array() as array<struct<start: int, kind_no: int, end: int>>)")
    spans = [
        F.when(F.array_contains("kinds", r.kind) if r.kind in indexed else F.rlike("text", F.lit(r.pattern)), _spans(F.col("text"), r, i))
        .otherwise(nothing)
        for i, r in enumerate(rules)
    ]
    names = F.array(*[F.lit(r.kind) for r in rules])
    every = F.transform(F.array_sort(F.flatten(F.array(*spans))), lambda s: F.struct(
        s["start"].alias("start"), s["kind_no"].alias("kind_no"), s["end"].alias("end"), names[s["kind_no"]].alias("kind")
    ))
    return marked.select("doc", every.alias("spans"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"), carry=["doc_id"])

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(order: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind_no"] == order)).cast("long")

    return found.select(
        F.col("doc.doc_id").alias("doc_id"), *[count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE)],
        F.sha2(joined(F.filter("spans", lambda s: s["kind_no"] < len(BASE))).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def _oracle() -> str:
    """Every text scanned with every pattern, without an index."""
    rules = [*BASE, *MORE]

    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    parts = []
    for i, r in enumerate(rules):
        keep = f"len(regexp_extract(p[j], {quoted(r.pattern)}, {r.group})) >= {r.least}"
        parts.append(
            f"select doc_id, {i} as k, '{r.kind}' as kind, coalesce(list_sum(list_transform(p[:j - 1], lambda x: len(x))), 0)::bigint as s, len(p[j]) as n "
            f"from (select doc_id, p, unnest(range(2, len(p), 2)) as j from (select doc_id, string_split(regexp_replace("
            f"replace(coalesce(text, ''), chr(1), chr(2)), {quoted(r.pattern)}, chr(1) || '\\0' || chr(1), 'g'), chr(1)) as p from documents)) where {keep}"
        )
    names = "".join(f", count(*) filter (k = {i}) as n_{r.kind}" for i, r in enumerate(BASE))
    return (
        f"with m as ({' union all '.join(parts)}), "
        f"g as (select doc_id{names}, string_agg(kind || ':' || s || ':' || (s + n), ',' order by s, k) as spans, "
        f"string_agg(kind || ':' || s || ':' || (s + n), ',' order by s, k) filter (k < {len(BASE)}) as base from m group by doc_id) "
        f"select doc_id, {', '.join(f'coalesce(n_{r.kind}, 0)::bigint as n_{r.kind}' for r in BASE)}, "
        "sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from documents left join g using (doc_id)"
    )


ORACLE = _oracle()
