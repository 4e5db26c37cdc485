"""Personal data: exact base patterns, and contexts learned from them that point to further identifiers."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.frames import cut, packed_columns, small_batches, table, text_or_empty
from fleetpulse.session import stage

KINDS = ("email", "ip", "card", "phone", "id")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# The same matches in time linear in the text: a run of characters is entered at its start only.
EMAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP_RUN = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
DIGIT = re.compile(r"[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")
WORD = re.compile(r"\S+")
# What only base entities and identifiers hold: a word without one of these is neither.
CANDIDATE = re.compile(r"[0-9@]")

CONTEXT = 2  # words before an entity that make its pattern
MIN_SEEDS = 3  # different seeds that a pattern must precede
ROUNDS = 3
CONFIDENT = 0.5
LEAST = 5  # characters of an unseen identifier, one of them a digit
BITMAP_BITS = 1 << 25  # 4 MB in each task, whatever the number of patterns
HELD = 100_000  # patterns that a task counts before it hands them on
TRIM = ",.;:!?()[]{}<>\"'"


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(map(int, reversed(digits))):
        if place % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for tail in EMAIL_TAIL.finditer(text):
        start = tail.start()
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < tail.start():
            done = tail.end()
            yield start, done


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the four base kinds by kind, then start; matches that fail a test are dropped, not tried again."""
    spans = []
    if "@" in text:
        spans += [(0, *span) for span in _emails(text)]
    if DIGIT.search(text):
        if "." in text:
            spans += [(1, *m.span()) for m in IP_RUN.finditer(text) if all(len(p := part.lstrip("0")) < 4 and int(p or 0) < 256 for part in m[0].split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = NOT_DIGIT.sub("", m[0])
                if 16 <= len(digits) <= 19 and luhn(digits):
                    spans.append((2, *m.span()))
        if "+" in text:
            spans += [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return spans


def _entity(text: str, start: int, end: int) -> str:
    return text[start:end].lower()


def _known(word: re.Match, starts: dict[int, int]) -> tuple[int, int] | None:
    """Start and end of the first base span before which the word has nothing but ``TRIM``."""
    bare = word.end() - len(word[0].lstrip(TRIM))
    return next(((at, starts[at]) for at in range(word.start(), bare + 1) if at in starts), None)


def _context(text: str, start: int) -> str | None:
    """The ``CONTEXT`` words before a place, lower-cased; None if there are fewer."""
    width = 64
    while True:
        low = max(0, start - width)
        words = text[low:start].rsplit(None, CONTEXT)
        # A piece more than asked for shows that the last ones are whole.
        if len(words) > CONTEXT or low == 0:
            return " ".join(words[-CONTEXT:]).lower() if len(words) >= CONTEXT else None
        width *= 4


def candidates(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[str, str, bool, int, int]]:
    """(pattern, entity, is_seed, start, end) of every word after ``CONTEXT`` words that is a base entity or looks like an identifier."""
    starts = {start: end for _, start, end in reversed(spans)}
    taken = sorted((start, end) for _, start, end in spans)
    out, done, at = [], 0, 0
    for hit in CANDIDATE.finditer(text):
        if hit.start() < done:
            continue
        start = hit.start()
        while start > done and not text[start - 1].isspace():
            start -= 1
        m = WORD.match(text, start)
        done = m.end()
        known = _known(m, starts)
        if known is None:
            word = m[0].strip(TRIM)
            if len(word) < LEAST or not DIGIT.search(word):
                continue
            first = start + m[0].index(word)
            while at < len(taken) and taken[at][1] <= first:
                at += 1
            if at < len(taken) and taken[at][0] < first + len(word):
                continue
        pattern = _context(text, start)
        if pattern is not None:
            place = known or (first, first + len(word))
            out.append((pattern, _entity(text, *place), known is not None, *place))
    return out


def _reachable(edges: DataFrame) -> DataFrame | None:
    """Stored patterns that bootstrapping could reach if it believed every instance; None if there are none.

    Only these are counted in the texts.
    """
    patterns, known = None, 0
    entities = edges.filter("seed").select("entity").distinct()
    while True:
        found = edges.join(entities, "entity", "left_semi").groupBy("pattern").agg(F.count("*").alias("instances"))
        found = cut(found.filter(F.col("instances") >= MIN_SEEDS).select("pattern"))
        count = found.count()
        if count == known:
            return patterns
        patterns, known = found, count
        entities = edges.filter("seed").select("entity").union(edges.join(found, "pattern", "left_semi").select("entity")).distinct()


def _buckets(patterns: DataFrame) -> bytes:
    """Bitmap of the checksums, modulo ``BITMAP_BITS``, that patterns have: of one size however many there are."""
    place = F.crc32(F.encode("pattern", "UTF-8")) % BITMAP_BITS + 1
    parts = patterns.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    bitmap = bytearray(BITMAP_BITS // 8)
    for part in parts.collect():
        low = (part.part - 1) * len(part.bits)
        bitmap[low : low + len(part.bits)] = part.bits
    return bytes(bitmap)


def _totals(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """Stored (pattern, total): how often each pattern occurs in all texts with a word after it.

    One pass over the texts, whatever the number of patterns: tasks hold a bitmap of their
    checksums and count the words that pass it; a join with the patterns drops the others.
    """
    shared = texts.sparkSession.sparkContext.broadcast(_buckets(patterns))

    def rows(often: Counter) -> pd.DataFrame:
        return pd.DataFrame(list(often.items()), columns=["pattern", "times"])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits, often = shared.value, Counter()
        for batch in batches:
            for text in batch["text"]:
                words = text.lower().split()
                # The last word of a text has nothing after it.
                for pattern in map(" ".join, zip(*(words[i:-1] for i in range(CONTEXT)))):
                    place = crc32(pattern.encode()) % BITMAP_BITS
                    if bits[place >> 3] >> (place & 7) & 1:
                        often[pattern] += 1
                if len(often) >= HELD:
                    yield rows(often)
                    often.clear()
        if often:
            yield rows(often)

    counted = texts.mapInPandas(count, "pattern string, times long").groupBy("pattern").agg(F.sum("times").alias("total"))
    return stage(counted.join(patterns.hint("merge"), "pattern", "left_semi"), "pii_totals")


def bootstrap(edges: DataFrame, totals: DataFrame, confident: float = CONFIDENT, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, confidence) of all induced patterns, scored on the graph of patterns and the instances that follow them.

    ``edges`` holds (pattern, entity, seed, n). Base entities score 1, all others 0 at first. In
    each round, instances that score at least ``confident`` induce the patterns that precede
    ``MIN_SEEDS`` different ones of them. A pattern's confidence is the score of what follows
    it, over all of its occurrences, entity or not; an instance's score is 1 minus the product of
    the doubts of its induced patterns. So identifiers that were discovered induce patterns in
    their turn. Scores and the set of patterns only grow; it ends after ``rounds`` rounds
    without a new pattern.
    """
    weighed = stage(edges.join(totals, "pattern"), "pii_weighed")
    entities = cut(weighed.groupBy("entity").agg(F.max(F.col("seed").cast("double")).alias("score")))
    induced, known, quiet = None, 0, 0
    while True:
        scored = weighed.join(entities, "entity")
        found = scored.groupBy("pattern").agg(
            F.count_if(F.col("score") >= confident).alias("believed"),
            F.least(F.lit(1.0), F.sum(F.col("score") * F.col("n")) / F.first("total")).alias("confidence"),
        )
        before = found.withColumn("_was", F.lit(False)) if induced is None else found.join(
            induced.select("pattern", F.lit(True).alias("_was")), "pattern", "left"
        )
        induced = cut(before.filter((F.col("believed") >= MIN_SEEDS) | F.coalesce("_was", F.lit(False))).select("pattern", "confidence"))
        count = induced.count()
        quiet, known = (quiet + 1 if count == known else 0), count
        if quiet >= rounds or not count:
            return induced
        doubt = F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.coalesce("confidence", F.lit(0.0)))))
        entities = cut(weighed.join(induced, "pattern", "left").groupBy("entity").agg(
            F.when(F.max("seed"), F.lit(1.0)).otherwise(1 - F.exp(doubt)).alias("score")
        ))


def find_personal_data(
    docs: DataFrame, *, text: str = "text", carry: list[str] | None = None, confident: float = CONFIDENT
) -> DataFrame:
    """Base spans of every text, and spans of identifiers found by bootstrapped contexts.

    The words before base entities become patterns; patterns are scored by how often a known
    or believed entity follows; identifiers that they make believed become seeds of further
    patterns, see ``bootstrap``. What looks like an identifier after a pattern of at least
    ``confident`` is a span of kind ``id``. Returns the input row (or the columns in
    ``carry``) as ``doc`` with ``base`` and ``more``, flat arrays of kind, start and end in
    code points, by kind, then start.

    The carried columns are stored once with the spans and the candidates; texts are read
    once more for the counts of patterns, if there are any to count. A null or empty text
    has no spans; equal rows each have theirs; no rows give no rows.
    """

    @F.pandas_udf("struct<base: array<int>, found: array<struct<pattern: string, entity: string, seed: boolean, start: int, end: int>>>")
    def read(texts: pd.Series) -> pd.DataFrame:
        spans = [base_spans(t) for t in texts]
        return pd.DataFrame({
            "base": pd.Series([[v for s in each for v in s] for each in spans], dtype=object),
            "found": pd.Series([candidates(t, each) for t, each in zip(texts, spans)], dtype=object),
        })

    body = text_or_empty(text)
    read_once = small_batches(docs).select(packed_columns(docs, carry), read(body).alias("_r"), F.monotonically_increasing_id().alias("row"))
    # Row numbers hold once they are stored.
    rows = stage(read_once.select("row", "doc", "_r.base", "_r.found"), "pii_rows")
    none = F.expr("cast(array() as array<int>)")
    seen = rows.select("row", F.explode("found").alias("e")).select("row", "e.*")
    edges = stage(seen.groupBy("pattern", "entity").agg(F.max("seed").alias("seed"), F.count("*").alias("n")), "pii_edges")
    edges = edges.join(edges.filter("seed").select("entity", F.lit(True).alias("_known")).distinct(), "entity", "left").select(
        "pattern", "entity", F.coalesce("_known", F.lit(False)).alias("seed"), "n"
    )
    patterns = _reachable(edges)
    good = None
    if patterns is not None:
        good = bootstrap(edges, _totals(docs.select(body.alias("text")), patterns), confident).filter(F.col("confidence") >= confident)
    if good is None or good.isEmpty():
        return rows.select("doc", "base", none.alias("more"))
    hits = seen.filter("not seed").join(good.hint("merge"), "pattern").select("row", "start", "end")
    more = stage(hits.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans")), "pii_more")
    flat = F.flatten(F.transform("spans", lambda s: F.array(F.lit(len(KINDS) - 1), s["start"], s["end"])))
    return rows.drop("found").join(more.hint("merge"), "row", "left").select("doc", "base", F.coalesce(flat, none).alias("more"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"), carry=["doc_id"])
    names = F.array(*[F.lit(k) for k in KINDS])

    def joined(flat: Column) -> Column:
        spans = F.transform(F.sequence(F.lit(0), F.size(flat) - 1, F.lit(3)), lambda i: F.concat_ws(
            ":", names[flat[i]], flat[i + 1], flat[i + 2]
        ))
        return F.when(F.size(flat) > 0, F.array_join(spans, ",")).otherwise("")

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda v, i: (i % 3 == 0) & (v == kind))).cast("long")

    return found.select(
        F.col("doc.doc_id").alias("doc_id"), *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:4])],
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.concat("base", "more")).alias("spans"),
    )


def _oracle() -> str:
    """Base spans by plain patterns. No context of the test data is confident, so no span is added."""
    body = "coalesce(text, '')"
    tests = {
        "email": (EMAIL.pattern, "true"),
        "ip": (IP.pattern, "list_bool_and(list_transform(string_split(m, '.'), lambda x: len(ltrim(x, '0')) < 4 and (case when len(ltrim(x, '0')) < 4 then x::bigint else 999 end) < 256))"),
        "card": (CARD.pattern, "len(regexp_replace(m, '[^0-9]', '', 'g')) between 16 and 19 and list_sum(list_transform(range(1, len(regexp_replace(m, '[^0-9]', '', 'g')) + 1), "
                 "lambda i: case when i % 2 = 1 then reverse(regexp_replace(m, '[^0-9]', '', 'g'))[i]::int "
                 "else reverse(regexp_replace(m, '[^0-9]', '', 'g'))[i]::int * 2 - 9 * (reverse(regexp_replace(m, '[^0-9]', '', 'g'))[i]::int > 4)::int end)) % 10 = 0"),
        "phone": (PHONE.pattern, "len(regexp_replace(m, '[^0-9]', '', 'g')) between 8 and 15"),
    }
    parts = [
        f"select doc_id, {k} as k, '{kind}' as kind, s, m from (select doc_id, p[j] as m, coalesce(list_sum(list_transform(p[:j - 1], lambda x: len(x))), 0)::bigint as s "
        f"from (select doc_id, p, unnest(range(2, len(p), 2)) as j from (select doc_id, string_split(regexp_replace(replace({body}, chr(1), chr(2)), '{pattern}', "
        f"chr(1) || '\\0' || chr(1), 'g'), chr(1)) as p from documents))) where {test}"
        for k, (kind, (pattern, test)) in enumerate(tests.items())
    ]
    counts = "".join(f", count(*) filter (k = {k}) as n_{kind}" for k, kind in enumerate(tests))
    return (
        f"with m as ({' union all '.join(parts)}), g as (select doc_id{counts}, "
        "string_agg(kind || ':' || s || ':' || (s + len(m)), ',' order by k, s) as spans from m group by doc_id) "
        f"select doc_id, {', '.join(f'coalesce(n_{kind}, 0)::bigint as n_{kind}' for kind in tests)}, "
        "sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans from documents left join g using (doc_id)"
    )


ORACLE = _oracle()
