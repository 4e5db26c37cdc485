"""Importance resampling towards target texts: hashed word features scanned with an Aho-Corasick dictionary."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.frames import packed_columns, running, small_batches, table, text_or_empty
from fleetpulse.session import stage

NGRAM = 1  # longest run of words that makes a feature
BUCKETS = 10_000
SEED = "2024"
LEAST_WORDS = 20
PERCENT = 10

# A task's dictionary holds words of at most about this many bytes; any other word is hashed where it stands.
DICTIONARY_BYTES = 1 << 20

# A-Z to lower case; every other ASCII character that is no letter or digit separates words.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_SPACE = 32


def _byte_step(register: np.ndarray) -> np.ndarray:
    """The CRC register after eight zero bits."""
    for _ in range(8):
        register = (register >> 1) ^ np.where(register & 1, 0xEDB88320, 0).astype(np.uint32)
    return register


class _Shift:
    """What a CRC becomes behind as many more bytes as a length says, as four tables of 256 for each length."""

    LONGEST = 64  # tables are kept up to this length

    def __init__(self) -> None:
        self.tables: dict[int, np.ndarray] = {}

    def _matrix(self, length: int) -> np.ndarray:
        """Images of the 32 bits after ``length`` zero bytes, by repeated squaring."""
        out, power, step = np.uint32(1) << np.arange(32, dtype=np.uint32), _byte_step(np.uint32(1) << np.arange(32, dtype=np.uint32)), length
        while step:
            if step & 1:
                out = _apply(power, out)
            power, step = _apply(power, power), step >> 1
        return out

    def __call__(self, crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        out = np.empty_like(crc)
        for length in np.unique(lengths).tolist():
            here = lengths == length
            if length <= self.LONGEST:
                if length not in self.tables:
                    matrix = self._matrix(length)
                    self.tables[length] = np.stack([_apply(matrix, np.arange(256, dtype=np.uint32) << np.uint32(8 * k)) for k in range(4)])
                t, c = self.tables[length], crc[here]
                out[here] = t[0][c & 255] ^ t[1][c >> 8 & 255] ^ t[2][c >> 16 & 255] ^ t[3][c >> 24]
            else:
                out[here] = _apply(self._matrix(length), crc[here])
        return out


def _apply(matrix: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = np.zeros_like(crc)
    for bit in range(32):
        out ^= np.where(crc >> np.uint32(bit) & np.uint32(1), matrix[bit], np.uint32(0))
    return out


class Dictionary:
    """Distinct words between delimiters, each with its CRC-32 and length as payload, as one automaton.

    It learns words that it has met more than once, up to a bound of bytes. Its links are
    built anew when it has met as many other words as it holds, so all builds together cost
    a few times the last one.
    """

    def __init__(self, limit: int = DICTIONARY_BYTES) -> None:
        self.limit, self.bytes = limit, 0
        self.automaton = ahocorasick.Automaton()
        self.crc, self.length = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.met: Counter[bytes] = Counter()
        self.shift = _Shift()

    def scan(self, folded: bytes) -> tuple[np.ndarray, np.ndarray]:
        """CRC and length of every word of a text that begins and ends with a delimiter, in order."""
        letters = np.frombuffer(folded, np.uint8) != _SPACE
        starts = np.flatnonzero(letters[1:] & ~letters[:-1]) + 1
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        crc, length = np.zeros(len(starts), np.uint32), np.zeros(len(starts), np.int64)
        known = np.zeros(len(starts), bool)
        if len(self.crc):
            found = np.fromiter(chain.from_iterable(self.automaton.iter(folded.decode("latin-1"))), np.int64)
            which = found[1::2]
            # A match ends at the delimiter behind its word.
            at = np.searchsorted(starts, found[::2] - self.length[which])
            crc[at], length[at], known[at] = self.crc[which], self.length[which], True
        missing = np.flatnonzero(~known)
        if len(missing):
            ends = (np.flatnonzero(letters[:-1] & ~letters[1:]) + 1)[missing]
            words = [folded[a:b] for a, b in zip(starts[missing].tolist(), ends.tolist())]
            crc[missing] = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
            length[missing] = ends - starts[missing]
            if self.bytes < self.limit:
                self.met.update(words)
        return crc, length

    def learn(self, least: int = 2048) -> None:
        """Take in the words met more than once and forget the others, once ``least`` were met and as many as are known."""
        if len(self.met) < max(least, len(self.crc)):
            return
        new = []
        for word, times in self.met.items():
            if times > 1 and self.bytes + len(word) <= self.limit:
                self.automaton.add_word(f" {word.decode('latin-1')} ", len(self.crc) + len(new))
                new.append(word)
                self.bytes += len(word)
        self.met = Counter()
        if new:
            self.automaton.make_automaton()
            self.crc = np.append(self.crc, np.fromiter(map(zlib.crc32, new), np.uint32, len(new)))
            self.length = np.append(self.length, np.fromiter(map(len, new), np.int64, len(new)))

    def features(self, text: str, ngram: int) -> tuple[int, np.ndarray]:
        """Number of words, and the CRC-32 of all runs of one to ``ngram`` words joined by a space.

        A run's CRC comes from that of the run without its last word, moved on by a space
        and that word's length.
        """
        folded = b" " + text.encode("utf-8", "surrogatepass").translate(_FOLD) + b" "
        crc, length = self.scan(folded)
        runs, out = crc, [crc]
        for n in range(2, min(ngram, len(crc)) + 1):
            # Words n-1, n, ... end the runs of n words.
            spaced = self.shift(runs[:-1], np.ones(len(runs) - 1, np.int64)) ^ np.uint32(zlib.crc32(b" "))
            runs = self.shift(spaced, length[n - 1:]) ^ crc[n - 1:]
            out.append(runs)
        return len(crc), np.concatenate(out)


_COUNTED = "struct<n_words: long, n_features: long, buckets: array<int>, counts: array<long>>"


def _counter(ngram: int, buckets: int, limit: int):
    @F.pandas_udf(_COUNTED)
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        dictionary = Dictionary(limit)
        for texts in batches:
            rows = []
            for text in texts:
                words, crc = dictionary.features(text, ngram)
                own, counts = np.unique(crc % np.uint32(buckets), return_counts=True)
                rows.append((words, len(crc), own.astype(np.int32), counts.astype(np.int64)))
                dictionary.learn()
            yield pd.DataFrame(rows, columns=["n_words", "n_features", "buckets", "counts"])

    return counted


def hashed_features(
    docs: DataFrame, *, text: str = "text", carry: list[str] | None = None, ngram: int = NGRAM, buckets: int = BUCKETS,
    dictionary_bytes: int = DICTIONARY_BYTES, name: str = "features",
) -> DataFrame:
    """Stored rows: ``doc``, ``n_words``, ``n_features`` and the distinct ``buckets`` of the features with their ``counts``."""
    kept = [packed_columns(docs, carry)] if carry is None or carry else []
    rows = small_batches(docs).select(*kept, _counter(ngram, buckets, dictionary_bytes)(text_or_empty(text)).alias("f"))
    return stage(rows.select(*rows.columns[:-1], "f.*"), f"resample_{name}")


def bucket_counts(counted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) summed over all rows: each task sends one vector of ``buckets`` counts."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            own, counts = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("buckets", "counts"))
            np.add.at(total, own, counts)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["bucket", "n"])

    return counted.select("buckets", "counts").mapInArrow(add_up, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain): 1000 times the logarithm of how much likelier the target is to have the bucket, add-one smoothed, floored."""
    spark = source.sparkSession
    both = (
        spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
        .join(bucket_counts(source, buckets).withColumnRenamed("n", "s"), "bucket", "left")
        .join(bucket_counts(target, buckets).withColumnRenamed("n", "t"), "bucket", "left").fillna(0, ["s", "t"])
    )
    both = stage(both, "resample_buckets")  # at most ``buckets`` rows
    totals = both.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    s_total, t_total = float(totals["s"] + buckets), float(totals["t"] + buckets)
    ratio = (F.col("t") + 1).cast("double") * s_total / ((F.col("s") + 1).cast("double") * t_total)
    return both.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).cast("long").alias("gain"))


def importance(
    docs: DataFrame, target: DataFrame, *, key: str = "doc_id", text: str = "text", target_text: str = "text",
    carry: list[str] | None = None, ngram: int = NGRAM, buckets: int = BUCKETS, seed: str = SEED,
    dictionary_bytes: int = DICTIONARY_BYTES,
) -> DataFrame:
    """Weigh every document by how much its features resemble the target's, with a seeded Gumbel draw.

    Returns the input row (or the columns in ``carry``) as ``doc`` with ``n_words``,
    ``n_features``, ``weight`` (the sum of its features' gains) and ``score`` (``weight`` plus
    1000 times a Gumbel variable of the id). The highest scores are a sample without
    replacement by weight.

    Null and empty texts have no features and weigh 0; equal rows weigh the same; a null id
    draws like an empty one. An empty target has the same gain in every bucket that the
    documents lack; no rows give no rows. Texts of any length are read whole.
    """
    counted = hashed_features(docs, text=text, carry=carry, ngram=ngram, buckets=buckets, dictionary_bytes=dictionary_bytes, name="source")
    wanted = hashed_features(target, text=target_text, carry=[], ngram=ngram, buckets=buckets, dictionary_bytes=dictionary_bytes, name="target")
    vector = np.zeros(buckets, np.int64)
    for r in gains(counted, wanted, buckets).collect():  # one row per bucket
        vector[r.bucket] = r.gain
    shared = docs.sparkSession.sparkContext.broadcast(vector)

    @F.pandas_udf("long")
    def weigh(own: pd.Series, counts: pd.Series) -> pd.Series:
        gain = shared.value
        return pd.Series([int((gain[b] * c).sum()) for b, c in zip(own, counts)], dtype="int64")

    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"doc.`{key}`").cast("string"), F.lit("")))
    uniform = (F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long") + 0.5) / 4294967296.0
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))).cast("long")
    weighed = counted.select("doc", "n_words", "n_features", weigh("buckets", "counts").alias("weight"), gumbel.alias("draw"))
    return weighed.select("doc", "n_words", "n_features", "weight", (F.col("weight") + F.col("draw")).alias("score"))


def drawn(scored: DataFrame, *, key: str = "doc_id", percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3 ... for the ``percent`` highest scores of documents with ``least_words`` words, else null.

    Equal scores go to the smaller id, null ids last; equal ids in any order.
    """
    fit = F.col("n_words") >= least_words
    rows = scored.withColumn("fit", fit).withColumn("named", F.col(f"doc.`{key}`"))
    order = [F.col("fit").desc(), F.col("score").desc(), F.col("named").asc_nulls_last()]
    placed, totals = running(rows.withColumn("one", F.col("fit").cast("long")), order, ["one"], "resample_ranks")
    rank = F.when(F.col("row") < totals["one"] * percent // 100, F.col("row") + 1)
    return placed.select(*scored.columns, rank.cast("long").alias("rank"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return drawn(scored).select(F.col("doc.doc_id").alias("doc_id"), "n_features", "weight", "score", "rank")


ORACLE = rf"""
with t as (select list(v order by i) as tab from (select i, list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0]::bigint[],
    lambda a, z: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) as v from range(256) r(i))),
d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word from benchmark),
u as (select doc_id, unnest(w) as word from d),
c as (select word, xor(list_reduce([4294967295::bigint] || list_transform(regexp_extract_all(hex(encode(word)), '..'), lambda x: ('0x' || x)::bigint),
        lambda a, x: xor(a >> 8, tab[(xor(a, x) & 255) + 1])), 4294967295::bigint) % {BUCKETS} as bucket
      from (select word from u union select word from b), t),
s as (select bucket, count(*) as s from u join c using (word) group by bucket),
g as (select bucket, count(*) as t from b join c using (word) group by bucket),
n as (select (select count(*) from u) as us, (select count(*) from b) as ts),
gain as (select bucket, floor(1000.0::double * ln((coalesce(t, 0) + 1)::double * (us + {BUCKETS})::double
        / ((coalesce(s, 0) + 1)::double * (ts + {BUCKETS})::double)))::bigint as gain
      from s full join g using (bucket), n),
weights as (select doc_id, sum(gain)::bigint as weight from u join c using (word) join gain using (bucket) group by doc_id),
scored as (select doc_id, len(w)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
        (coalesce(weight, 0) + floor(-1000.0::double * ln(-ln((('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296.0::double))))::bigint as score
      from d left join weights using (doc_id)),
ranked as (select *, row_number() over (partition by n_features >= {LEAST_WORDS} order by score desc, doc_id) as r,
        {PERCENT} * (count(*) over (partition by n_features >= {LEAST_WORDS})) // 100 as draws from scored)
select doc_id, n_features, weight, score, case when n_features >= {LEAST_WORDS} and r <= draws then r end as rank from ranked
"""
