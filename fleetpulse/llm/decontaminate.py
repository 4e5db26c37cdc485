"""Find and remove benchmark passages with a generalised suffix automaton of the test items."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.frames import cut, packed_columns, small_batches, table, text_or_empty

WINDOW = 13
MIN_COVERAGE = 20  # contaminated if at least one word in so many is hit
# Items are handled in blocks of at most about this much text, one automaton each, so that what
# a task holds does not grow with the benchmark. A single larger item makes a larger block.
BLOCK_BYTES = 1 << 20

# A-Z to lower case; every other ASCII character that is no letter or digit separates words.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


class SuffixAutomaton:
    """All word sequences that occur in some item, and which items hold each window.

    States carry the length of their longest sequence and a suffix link. ``holds`` lists the
    items in which a state's sequences occur; ``short`` the items shorter than a window that
    end at the state as a whole.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.names = [name for name, _ in items]
        self.lengths = [len(words) for _, words in items]
        holds: list[set[int]] = [set()]
        self.short: list[set[int]] = [set()]
        bigrams = set()
        for at, (_, words) in enumerate(items):
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            bigrams.update(zip(ids, ids[1:]))
            state = 0
            for word in ids:
                state = self._extend(state, word, holds)
                holds[state].add(at)
            if 0 < len(ids) < window:
                self.short[state].add(at)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            holds[self.link[state]] |= holds[state]
        # Only states that hold the sequences of exactly one window are asked for their items.
        self.holds = {
            s: frozenset(holds[s]) for s in range(1, len(self.next))
            if self.length[s] >= window > self.length[self.link[s]]
        }
        # The nearest state up the links, itself included, at which a short item ends.
        self.ends = [-1] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.ends[state] = state if self.short[state] else self.ends[self.link[state]]
        self.least = min((min(n, window) for n in self.lengths if n), default=0)
        size = len(self.vocabulary) + 1
        self.bigrams = np.array(sorted(a * size + b for a, b in bigrams), np.int64)
        self.size = size

    def _extend(self, last: int, word: int, holds: list[set[int]]) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known, holds)
        state = self._add(self.length[last] + 1, {}, -1, holds)
        at = last
        while at != -1 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at == -1:
            self.link[state] = 0
        else:
            known = self.next[at][word]
            same = self.length[known] == self.length[at] + 1
            self.link[state] = known if same else self._split(at, word, known, holds)
        return state

    def _split(self, at: int, word: int, known: int, holds: list[set[int]]) -> int:
        clone = self._add(self.length[at] + 1, dict(self.next[known]), self.link[known], holds)
        self.link[known] = clone
        while at != -1 and self.next[at].get(word) == known:
            self.next[at][word] = clone
            at = self.link[at]
        return clone

    def _add(self, length: int, edges: dict[int, int], link: int, holds: list[set[int]]) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        holds.append(set())
        self.short.append(set())
        return len(self.next) - 1

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words lie in an occurrence of a window, and the named items with such an occurrence.

        A word outside the vocabulary, or next to a word it never follows in an item, ends
        any match. So only stretches without such a break that are as long as the shortest
        window are streamed through the states; the others cannot hold one.
        """
        hit, found = np.zeros(len(words), bool), set()
        if not self.least or len(words) < self.least:
            return hit, found
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, len(words))
        known = ids >= 0
        if not known.any():
            return hit, found
        joined = np.zeros(len(words), bool)  # the word follows on the one before it
        if len(words) > 1 and len(self.bigrams):
            pairs = ids[:-1] * self.size + ids[1:]
            place = np.minimum(np.searchsorted(self.bigrams, pairs), len(self.bigrams) - 1)
            joined[1:] = known[1:] & known[:-1] & (self.bigrams[place] == pairs)
        starts = np.flatnonzero(known & ~joined)
        last = np.zeros(len(words), bool)
        last[:-1] = known[:-1] & ~joined[1:]
        last[-1] = known[-1]
        ends = np.flatnonzero(last) + 1
        long_enough = ends - starts >= self.least
        for start, end in zip(starts[long_enough].tolist(), ends[long_enough].tolist()):
            self._stream(ids[start:end].tolist(), start, hit, found)
        return hit, {name for at in found if (name := self.names[at]) is not None}

    def _stream(self, ids: list[int], start: int, hit: np.ndarray, found: set[int]) -> None:
        state = length = 0
        window = self.window
        for at, word in enumerate(ids, start + 1):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word not in self.next[state]:
                continue
            state = self.next[state][word]
            length += 1
            if length >= window:
                hit[at - window:at] = True
                top = state
                while self.length[self.link[top]] >= window:
                    top = self.link[top]
                found |= self.holds[top]
            end = self.ends[state]
            while end > 0:
                for item in self.short[end]:
                    if self.lengths[item] <= length:
                        hit[at - self.lengths[item]:at] = True
                        found.add(item)
                end = self.ends[self.link[end]]


def _spans(hit: np.ndarray) -> list[int]:
    """Start, end, start, end of the runs of true."""
    return np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))).tolist()


def benchmark_blocks(items: DataFrame, key: str, text: str, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The items' words, in blocks of bounded text, fetched one block at a time."""
    rows = cut(items.select(F.col(key).cast("string").alias("name"), text_or_empty(text).alias("text")))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-2 * total // block_bytes))  # half full on average, as the hash deals unevenly
    for block in range(blocks):
        some = rows.filter(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == block).collect()
        yield [(r.name, words_of(r.text)) for r in sorted(some, key=lambda r: (r.name or "", r.text))]


def benchmark_hits(
    docs: DataFrame, items: DataFrame, *, text: str = "text", item_key: str = "item_id", item_text: str = "text",
    window: int = WINDOW, coverage: int = MIN_COVERAGE, carry: list[str] | None = None, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Mark the words of each document that lie in a passage of a benchmark item.

    A window is ``window`` consecutive words of an item; an item of fewer words is one
    window as a whole. Documents are streamed through the automaton, block of items by
    block; nothing is shuffled. Returns the input row (or the columns in ``carry``) as
    ``doc`` with ``n_words``, ``n_hit``, ``items`` (sorted ids whose windows occur), ``spans``
    (start and end words of the hit runs, flat) and ``contaminated``: hit at all, and at
    least one word in ``coverage``.

    Null and empty texts have no words and are never hit; items without words have no
    window; an item with a null id hits but is not listed; repeated ids are listed once.
    Empty tables give no rows, or no hits.
    """
    rows = small_batches(docs).select(packed_columns(docs, carry), F.col(text).alias("text"))
    last: Column | None = None
    for automaton in (SuffixAutomaton(block, window) for block in benchmark_blocks(items, item_key, item_text, block_bytes)):
        shared = docs.sparkSession.sparkContext.broadcast(automaton)  # bounded by the size of a block
        found = _scanner(shared)(text_or_empty("text"), last if last is not None else F.lit(None).cast(_FOUND))
        rows, last = rows.withColumn("found", found), F.col("found")
    return rows.select(
        "doc", "found.n_words", "found.n_hit", "found.items", "found.spans",
        ((F.col("found.n_hit") > 0) & (coverage * F.col("found.n_hit") >= F.col("found.n_words"))).alias("contaminated"),
    )


_FOUND = "struct<n_words: long, n_hit: long, items: array<string>, spans: array<int>>"


def _scanner(shared):
    @F.pandas_udf(_FOUND)
    def scan(texts: pd.Series, earlier: pd.DataFrame) -> pd.DataFrame:
        automaton, out = shared.value, []
        for text, spans, names in zip(texts, earlier["spans"], earlier["items"]):
            words = words_of(text)
            hit, found = automaton.scan(words)
            if spans is not None:
                for a, b in zip(spans[::2], spans[1::2]):
                    hit[a:b] = True
                found = found.union(names)
            out.append((len(words), int(hit.sum()), sorted(found), _spans(hit)))
        return pd.DataFrame(out, columns=["n_words", "n_hit", "items", "spans"])

    return scan


def _without(text: str | None, spans: list[int] | None) -> str | None:
    """The text but for runs of words, given as start, end, start, end."""
    if text is None or spans is None or not len(spans):
        return text
    words = [m.span() for m in _WORD.finditer(text)]
    keep, at = [], 0
    for a, b in zip(spans[::2], spans[1::2]):
        keep.append(text[at:words[a][0]])
        at = words[b - 1][1]
    return "".join([*keep, text[at:]])


def decontaminated(marked: DataFrame, text: str, length: str | None = None) -> DataFrame:
    """Drop contaminated documents and cut the hit spans out of the others.

    ``length`` names a column that holds the text's characters and is kept right where a
    span was cut. Documents without a hit come through unchanged.
    """

    @F.pandas_udf("string")
    def without(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([_without(t, s) for t, s in zip(texts, spans)], dtype=object)

    kept = marked.filter(~F.col("contaminated"))
    was = F.col(f"doc.`{text}`")
    less = F.when(F.col("n_hit") > 0, without(was, "spans")).otherwise(was)
    kept = kept.select("n_hit", F.col("doc").withField(f"`{text}`", less).alias("doc"))
    if length:
        now = F.when(F.col("n_hit") > 0, F.char_length(F.col(f"doc.`{text}`")).cast("long")).otherwise(F.col(f"doc.`{length}`"))
        kept = kept.withColumn("doc", F.col("doc").withField(f"`{length}`", now))
    return kept.select("doc.*")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return marked.select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


ORACLE = rf"""
with fold as (select unnest(['d', 'b']) as side),
d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
g as (select distinct item_id, least(len(w), {WINDOW}) as n,
        array_to_string(w[unnest(range(1, greatest(len(w) - {WINDOW} + 2, 2))):][:least(len(w), {WINDOW})], ' ') as win
      from b where len(w) > 0),
sizes as (select distinct n from g),
o as (select doc_id, n, pos, array_to_string(w[pos:pos + n - 1], ' ') as win
      from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as pos from d, sizes where len(w) >= n)),
h as (select o.doc_id, o.n, o.pos, g.item_id from o join g on g.n = o.n and g.win = o.win),
hits as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(pos, pos + n)) as p from h) group by doc_id),
items as (select doc_id, count(distinct item_id) as n_items,
            string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids from h group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * n_hit >= len(w) as contaminated
from d left join hits using (doc_id) left join items using (doc_id)
"""
