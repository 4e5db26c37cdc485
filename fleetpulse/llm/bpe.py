"""Byte-pair encoding and decoding: words are cut where no token can lie across, and the fragments encoded one by one."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from fleetpulse.llm.frames import packed_columns, small_batches, table, text_or_empty

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

# A worker remembers the ids of at most twice so many words of at most so many characters.
REMEMBERED, REMEMBERED_LENGTH = 1 << 17, 40
NEVER = 1 << 40  # the rank of a pair that is not merged
SHORT = 32  # symbols up to which pairs are looked through, not kept in a heap

# How the lower-case word vocabulary cuts a text into words. Fixed value of its file.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORD = regex.compile(WORDS.replace(r"\s", r"\p{White_Space}"))
_ASCII_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x09-\x0D\x20a-z0-9]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class _Words(dict):
    """Words to their ids as little-endian bytes, in two generations, so that words met again and again stay."""

    def __init__(self, encode) -> None:
        self.encode, self.older = encode, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = np.array(self.encode(word), "<u4").tobytes()
        if len(word) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    """A byte-level BPE vocabulary in the JSON form of the tokenizers library, which cuts texts into words.

    ``inside`` holds the byte pairs that occur inside some token. Merging can never cross
    any other pair, so a word is cut there and its fragments merge on their own.
    """

    def __init__(self, vocabulary: str) -> None:
        spec = json.loads(vocabulary)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("ignore_merges") or model.get("continuing_subword_prefix"):
            raise ValueError("only byte-level BPE vocabularies that apply all merges are supported")
        self.library = Tokenizer.from_str(vocabulary)
        self.library.no_truncation()
        self.library.no_padding()
        self.ids: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.symbols = byte_symbols()
        if not all(s in self.ids and s + self.suffix in self.ids for s in self.symbols):
            raise ValueError("the vocabulary lacks single bytes")
        pairs = [tuple(pair.split(" ") if isinstance(pair, str) else pair) for pair in model["merges"]]
        self.rank = {(self.ids[a], self.ids[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.made = [self.ids[a + b] for a, b in pairs]
        self.inside: set[tuple[str, str]] = set()
        for token in self.ids:
            bare = token.removesuffix(self.suffix) if self.suffix else token
            self.inside.update(zip(bare, bare[1:]))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        marks = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.marks = re.compile(f"({'|'.join(marks)})") if marks else None
        self.lower_words = self._has_lower_words(spec)
        self.plain, self.odd = set(map(chr, range(128))), {"Σ"}
        self.table = {b: s for b, s in enumerate(self.symbols)}
        self.raw_words = _Words(lambda word: self.word_ids(word.encode().decode("latin-1").translate(self.table)))
        self.cut_words = _Words(self.word_ids)

    @staticmethod
    def _has_lower_words(spec: dict) -> bool:
        """Whether texts are put in composed lower case and cut by ``WORDS``."""
        normal, cuts = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
        steps = [(n["type"], n.get("pattern"), n.get("content")) for n in normal.get("normalizers", [])]
        split = [(c["type"], c.get("pattern"), c.get("behavior"), c.get("invert"), c.get("use_regex"), c.get("add_prefix_space")) for c in cuts.get("pretokenizers", [])]
        return steps == [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)] and split == [
            ("Split", {"Regex": WORDS}, "Removed", True, None, None), ("ByteLevel", None, None, None, False, False)
        ]

    def fragments(self, word: str) -> list[str]:
        """A word of byte symbols, cut between the pairs that lie inside no token."""
        inside, start, out = self.inside, 0, []
        for at, pair in enumerate(zip(word, word[1:]), 1):
            if pair not in inside:
                out.append(word[start:at])
                start = at
        out.append(word[start:])
        return out

    def word_ids(self, word: str) -> list[int]:
        if not word:
            return []
        *parts, last = self.fragments(word)
        out: list[int] = []
        for part in parts:
            out += self._merged([self.ids[c] for c in part])
        return out + self._merged([*(self.ids[c] for c in last[:-1]), self.ids[last[-1] + self.suffix]])

    def _merged(self, ids: list[int]) -> list[int]:
        """Apply the first merge of the vocabulary, at its leftmost place, until none is left."""
        if len(ids) > SHORT:
            return self._merged_long(ids)
        rank, made = self.rank, self.made
        ranks = [rank.get(pair, NEVER) for pair in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == NEVER:
                break
            at = ranks.index(best)
            ids[at:at + 2] = [made[best]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank.get((ids[at - 1], ids[at]), NEVER)
            if at < len(ranks):
                ranks[at] = rank.get((ids[at], ids[at + 1]), NEVER)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same with a heap of pairs over a linked list, so that long fragments take n log n steps."""
        rank, made, n = self.rank, self.made, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank[pair], at) for at, pair in enumerate(zip(ids, ids[1:])) if pair in rank]
        heapq.heapify(heap)
        while heap:
            best, at = heapq.heappop(heap)
            right = after[at]
            if ids[at] < 0 or right >= n or rank.get((ids[at], ids[right])) != best:
                continue  # one of the two has been merged with another
            ids[at], ids[right] = made[best], -1
            after[at] = after[right]
            if after[at] < n:
                before[after[at]] = at
            for a, b in ((before[at], at), (at, after[at])):
                if a >= 0 and b < n and (ids[a], ids[b]) in rank:
                    heapq.heappush(heap, (rank[ids[a], ids[b]], a))
        return [i for i in ids if i >= 0]

    def _as_library(self, char: str) -> bool:
        """Whether Python and the library lower and cut a character alike, as their Unicode versions may differ."""
        lowered = char.lower()
        return self.library.normalizer.normalize_str(char) == lowered and all(
            len(self.library.pre_tokenizer.pre_tokenize_str(probe)) == len(_WORD.findall(probe))
            for c in lowered for probe in (f"a{c}a", f"!{c}!")
        )

    def _segment(self, text: str) -> bytes:
        if self.lower_words:
            if text.isascii():
                return b"".join(map(self.raw_words.__getitem__, _ASCII_WORD.findall(text.lower())))
            chars = set(text)
            for char in chars - self.plain - self.odd:
                (self.plain if self._as_library(char) else self.odd).add(char)
            if chars <= self.plain and unicodedata.is_normalized("NFC", text):
                return b"".join(map(self.raw_words.__getitem__, _WORD.findall(text.lower())))
        if self.library.normalizer is not None:
            text = self.library.normalizer.normalize_str(text)
        if not text:
            return b""
        return b"".join(self.cut_words[word] for word, _ in self.library.pre_tokenizer.pre_tokenize_str(text))

    def encode(self, text: str) -> np.ndarray:
        parts = self.marks.split(text) if self.marks else [text]
        coded = [self._segment(p) if i % 2 == 0 else np.array([self.special[p]], "<u4").tobytes() for i, p in enumerate(parts)]
        return np.frombuffer(b"".join(coded), "<u4").astype(np.int32)


class Decoder:
    """The tokens of a vocabulary by id, and how the tokenizers library joins them."""

    def __init__(self, vocabulary: str) -> None:
        spec = json.loads(vocabulary)
        tokens = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.names = [tokens.get(i) for i in range(max(tokens) + 1)]
        self.joined = Tokenizer.from_str(vocabulary).decoder

    def decode(self, ids: np.ndarray) -> str:
        size, names = len(self.names), self.names
        tokens = [names[i] for i in ids.tolist() if 0 <= i < size and names[i] is not None]
        return " ".join(tokens) if self.joined is None else self.joined.decode(tokens)


@lru_cache(maxsize=2)
def _encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


@lru_cache(maxsize=2)
def _decoder(vocabulary: str) -> Decoder:
    return Decoder(vocabulary)


def _shared(spark: SparkSession, path: str):
    """The vocabulary file, read once on the driver; its size does not depend on the documents."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def encoded(docs: DataFrame, *, text: str = "text", carry: list[str] | None = None, vocabulary: str = VOCABULARY) -> DataFrame:
    """The input row (or the columns in ``carry``) as ``doc`` with ``ids``, the tokens of its whole text.

    The ids are those of the tokenizers library for the file ``vocabulary`` without added
    special tokens; special tokens that stand in a text are found in it. Null and empty
    texts have no ids, equal texts equal ids, no rows give no rows. Nothing is shuffled, and
    the time for a text of any length grows with its length (times a logarithm for a word
    without any cut).
    """
    shared = _shared(docs.sparkSession, vocabulary)

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:  # as an iterator it is not chained to, but run once
        encoder = _encoder(shared.value)
        for texts in batches:
            yield pd.Series([encoder.encode(t) for t in texts], dtype=object)

    return small_batches(docs).select(packed_columns(docs, carry), ids(text_or_empty(text)).alias("ids"))


def decoded(spark: SparkSession, ids: Column | str, *, vocabulary: str = VOCABULARY) -> Column:
    """The text of an array of ids, special tokens included, as the tokenizers library decodes it. Null ids give null."""
    shared = _shared(spark, vocabulary)

    @F.pandas_udf("string")
    def text(rows: pd.Series) -> pd.Series:
        decoder = _decoder(shared.value)
        return pd.Series([None if r is None else decoder.decode(np.asarray(r)) for r in rows], dtype=object)

    return text(ids)


@F.pandas_udf(T.StringType())
def _ids_sha256(rows: pd.Series) -> pd.Series:
    return pd.Series([hashlib.sha256(np.asarray(r).astype("<u4").tobytes()).hexdigest() for r in rows], dtype=object)


@F.pandas_udf(T.StringType())
def _text_sha256(texts: pd.Series) -> pd.Series:
    return pd.Series([hashlib.sha256(t.encode()).hexdigest() for t in texts], dtype=object)


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encoded(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return coded.select(
        F.col("doc.doc_id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), _ids_sha256("ids").alias("ids_sha256"),
        # Decoded and hashed in one worker, so that the decoded texts are not passed on.
        _text_sha256(decoded(spark, "ids")).alias("decoded_sha256"),
    )
