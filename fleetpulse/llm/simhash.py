"""Near-duplicate groups from SimHash fingerprints within a few bits of each other."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.components import components
from fleetpulse.llm.frames import packed_columns, small_batches, table, text_or_empty
from fleetpulse.session import stage

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 2
# Buckets up to this size are joined pair by pair: half as many pairs as the 65 keys that a
# member of a larger bucket emits instead. Both ways are exact.
CROWD = 128


def simhash(text: str, words: int = SHINGLE_WORDS) -> int:
    """64-bit fingerprint as a signed number: bit i is set if over half the shingle hashes have it.

    A-Z is lower-cased, words are split at ASCII white space, repeated shingles count each
    time; fewer words than a shingle form one, no words give 0.
    """
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined, span = b" ".join(parts), min(words, len(parts))
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    ends = (starts + lengths)[span - 1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        chunk = hashes[at:at + (1 << 15)]
        ones += np.unpackbits(chunk.view(np.uint8).reshape(len(chunk), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint(text: str | Column, words: int = SHINGLE_WORDS) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, words) for t in texts], dtype="int64")

    return of(text_or_empty(text))


def _blocks(bits: int) -> list[int]:
    """Masks that split 64 bits into ``bits`` + 2 blocks: close fingerprints agree on two of them at least."""
    edges = [64 * i // (bits + 2) for i in range(bits + 3)]
    return [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(fingerprints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (a, b) whose components join all distinct fingerprints (column ``fp``, stored) at most ``max_bits`` apart.

    Every pair of blocks gives one key, and fingerprints in reach share a key. Buckets of up
    to ``CROWD`` members are joined with themselves and verified by Hamming distance. Members
    of larger buckets emit their neighbourhood instead: two fingerprints are at most 2 bits
    apart exactly if they share a fingerprint at most 1 bit from both (1 bit: if they are
    equal but for one place), and all that share it hang on the smallest of them, verified
    again. So no bucket makes more than a fixed number of rows per member and no link is lost.
    """
    if max_bits not in (0, 1, 2):
        raise ValueError(f"max_bits must be 0, 1 or 2, got {max_bits}")
    pairs = list(combinations(_blocks(max_bits), 2))
    keyed = fingerprints.select(
        "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(x | y))) for x, y in pairs])).alias("pair", "block")
    )
    shared = keyed.groupBy("pair", "block").agg(F.count("*").alias("members")).filter("members > 1")
    near = stage(keyed.join(shared, ["pair", "block"]), "simhash_buckets")
    few = near.filter(F.col("members") <= CROWD)
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    joined = (
        few.select("pair", "block", F.col("fp").alias("a"))
        .join(few.select("pair", "block", F.col("fp").alias("b")), ["pair", "block"])
        .filter((F.col("a") < F.col("b")) & (apart <= max_bits))
        .select("a", "b")
    )
    flips = [F.lit(_signed(1 << i)) for i in range(64)]
    if max_bits == 2:
        around = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(f) for f in flips])
        places = F.explode(around).alias("key")
    else:
        places = F.explode(F.array(*[
            F.struct(F.lit(i).alias("at"), F.col("fp").bitwiseAND(F.bitwise_not(f)).alias("rest")) for i, f in enumerate(flips)
        ])).alias("key")
    crowded = near.filter(F.col("members") > CROWD).select("fp").distinct().select(F.col("fp").alias("b"), places) \
        if max_bits else near.limit(0).select(F.col("fp").alias("b"), F.col("fp").alias("key"))
    least = crowded.groupBy("key").agg(F.min("b").alias("a"), F.count("*").alias("n")).filter("n > 1")
    starred = crowded.join(least, "key").filter((F.col("a") < F.col("b")) & (apart <= max_bits)).select("a", "b")
    return joined.unionByName(starred)


def near_duplicates(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
    carry: list[str] | None = None,
) -> DataFrame:
    """Group documents whose SimHash fingerprints are linked by steps of at most ``max_bits`` bits.

    Copies collapse to one fingerprint before anything is compared. Returns the input row
    (or the columns in ``carry``) as ``doc`` with ``fp``, ``root`` (the smallest fingerprint of
    the group) and ``component_id`` (its smallest id).

    A null or empty text has fingerprint 0 and is linked like any other; null ids are
    passed over in the minimum, so only a group of null ids has a null ``component_id``.
    Repeated rows come back as often as they went in; no rows give no rows.
    """
    printed = small_batches(docs).select(packed_columns(docs, carry), F.col(key).alias("id"), fingerprint(text, words).alias("fp"))
    if carry is not None:  # narrow rows are stored; with texts in them, hashing twice is cheaper than a copy
        printed = stage(printed, "simhash_docs")
    prints = stage(printed.groupBy("fp").agg(F.min("id").alias("least")), "simhash")
    roots = components(links(prints.select("fp"), max_bits))
    rooted = prints.join(roots, prints["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = stage(rooted.join(ids, "root").select("fp", "root", "component_id"), "simhash_classes")
    # One row per fingerprint on this side, so adaptive execution can split a fingerprint that many documents share.
    return printed.join(classes.hint("merge"), "fp").select("doc", "fp", "root", "component_id")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = near_duplicates(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return grouped.select(
        F.col("doc.doc_id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs``, but of each near-duplicate group only the one with the smallest id.

    Of equal ids the row with the smallest hash stays, of rows equal in every column any one;
    null ids come after all others. Groups are worked out on hashes; texts are shuffled once,
    to meet the rows that stay.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    hashed = docs.select(
        packed_columns(docs), F.col(key).alias("id"), F.col(text).alias("text"),
        F.xxhash64(*columns).alias("h1"), F.xxhash64(F.lit(1), *columns).alias("h2"),
    )
    grouped = near_duplicates(hashed, key="id", text="text", words=words, max_bits=max_bits, carry=["id", "h1", "h2"])
    rows = grouped.select("root", "doc.*").groupBy("root", "id", "h1", "h2").agg(F.count("*").alias("copies"))
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "h1", "h2", "copies"))
    stay = stage(rows.groupBy("root").agg(first.alias("s")).select("s.h1", "s.h2", "s.copies"), "simhash_stay")
    met = hashed.select("doc", "h1", "h2").join(stay.hint("merge"), ["h1", "h2"])
    if stay.filter("copies > 1").isEmpty():
        return met.select("doc.*")
    single = met.filter("copies = 1").select("doc.*")
    return single.unionByName(met.filter("copies > 1").dropDuplicates(["h1", "h2"]).select("doc.*"))
