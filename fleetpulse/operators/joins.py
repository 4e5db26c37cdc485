"""Joins and first-per-key picks that hold up when one key owns much of the data."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fleetpulse.session import stage

# A lookup table of at most this size is broadcast: one copy per executor.
BROADCAST_BYTES = 64 * 1024 * 1024

# Rows in memory against the files they are read from, which are encoded and compressed.
UNPACKED = 5

# Bits of the filter ahead of a large membership join: 8 MB of rows at most.
FILTER_BITS = 1 << 25

# Rows of a stored table that one entry of its marks covers: 64 words of 64 bits.
MARKED_ROWS = 1 << 12


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files and other sources a frame reads, known from listing them; no job runs."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def fits(stored: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a stored table is small enough to broadcast, all of its columns counted, long texts included."""
    return stored_bytes(stored) * UNPACKED <= limit


def lookup_join(
    many: DataFrame, lookup: DataFrame, on: list[str], how: str = "inner", *, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Join rows to a table that holds one row per key (``how`` is inner or left).

    ``lookup`` is a stored table, as the bytes of its files decide the strategy. Small enough, it
    is broadcast and ``many`` is not shuffled. Otherwise both sides are shuffled:
    adaptive execution then splits a partition swollen by a hot key (or, in a left join,
    by NULL keys) into slices by map output, each meeting its own copy of the few lookup
    rows. That needs no second pass to find the hot keys, and unlike a salt computed from
    the row it also spreads exact copies. As long as a partition's share of the lookup could
    be broadcast, tasks look up in it by hash, so the many rows are neither sorted nor
    spilled; a larger lookup is sort-merge joined.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, got {how!r}")
    if fits(lookup, broadcast_bytes):
        return many.join(F.broadcast(lookup), on, how)
    partitions = int(many.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return many.join(lookup.hint("shuffle_hash" if fits(lookup, broadcast_bytes * partitions) else "merge"), on, how)


def with_known(many: DataFrame, lookup: DataFrame, on: list[str], *, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows whose key is in ``lookup``, a stored table; a NULL key is in none.

    If the lookup is too large to broadcast, the distinct keys that it lacks are found first. They
    are few as a rule, so they are broadcast and the rows stay where they are. ``many`` is
    read twice then, so it should be cheap to read.
    """
    if fits(lookup, broadcast_bytes):
        return many.join(F.broadcast(lookup.select(*on)), on, "left_semi")
    present = many.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on]))
    missing = stage(present.select(*on).distinct().join(lookup.select(*on), on, "left_anti"), "missing_keys")
    return present.join(F.broadcast(missing) if fits(missing, broadcast_bytes) else missing, on, "left_anti")


def _bit(on: list[str]) -> Column:
    return F.pmod(F.xxhash64(*on), F.lit(FILTER_BITS))


def key_filter(keys: DataFrame, on: list[str]) -> DataFrame:
    """Stored (_word, _bits): a bitmap of the hashes of all keys, in words of 64 bits.

    It has at most ``FILTER_BITS`` / 64 rows of 16 bytes, however many keys there are.
    """
    bit = _bit(on)
    mark = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(bit, F.lit(64)).cast("int"))
    return stage(keys.groupBy(F.shiftright(bit, 6).alias("_word")).agg(F.bit_or(mark).alias("_bits")), "key_filter")


def possible_members(many: DataFrame, words: DataFrame, on: list[str], flag: str) -> DataFrame:
    """Mark the rows whose key may be one of those in ``words`` (of ``key_filter``); False is certain."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on])
    hit = F.call_function("shiftright", F.col("_bits"), F.pmod(_bit(on), F.lit(64)).cast("int")).bitwiseAND(F.lit(1)) == 1
    marked = many.withColumn("_word", F.when(known, F.shiftright(_bit(on), 6))).join(F.broadcast(words), "_word", "left")
    return marked.withColumn(flag, F.coalesce(hit, F.lit(False))).select(*many.columns, flag)


def _placed(stored: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of a stored table with their place: the file, by hash of its path, and the position in it."""
    return stored.select(*columns, F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def marks_fit(many: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether rows have places in files, and one bit for each row is small enough to broadcast.

    The count comes from file footers; no column is read.
    """
    if not limit:
        return False
    path = F.col("_metadata.file_path")
    try:
        places = many.select(path.alias("_path"), "_metadata.row_index")
    except AnalysisException:  # not a table in files
        return False
    rows, files, hashes = places.agg(F.count(F.lit(1)), F.count_distinct("_path"), F.count_distinct(F.xxhash64("_path"))).first()
    return files == hashes and (rows + files * MARKED_ROWS) / 8 <= limit


def row_marks(many: DataFrame, keys: DataFrame, on: list[str], *, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Stored (_file, _chunk, _words): a bit for each row of the stored table ``many`` whose key is in ``keys`` (unique).

    Keys and places are all that is shuffled, whatever the width of the rows. Chunks without a
    marked row are left out.
    """
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on])
    hits = lookup_join(_placed(many, on).filter(known), keys, on, broadcast_bytes=broadcast_bytes)
    mark = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("_row", F.lit(64)).cast("int"))
    words = hits.groupBy("_file", F.shiftright("_row", 6).alias("_word")).agg(F.bit_or(mark).alias("_bits"))
    chunks = words.groupBy("_file", F.shiftright("_word", 6).alias("_chunk")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.pmod("_word", F.lit(64)).cast("int").alias("at"), "_bits"))).alias("_known")
    )
    filled = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.coalesce(F.try_element_at("_known", i), F.lit(0).cast("bigint")))
    return stage(chunks.select("_file", "_chunk", filled.alias("_words")), "row_marks")


def at_marks(many: DataFrame, marks: DataFrame, flag: str) -> DataFrame:
    """The rows of a stored table, with whether ``row_marks`` marked them."""
    word = F.element_at("_words", (F.pmod(F.shiftright("_row", 6), F.lit(64)) + 1).cast("int"))
    hit = F.call_function("shiftright", word, F.pmod("_row", F.lit(64)).cast("int")).bitwiseAND(F.lit(1)) == 1
    placed = _placed(many, many.columns).withColumn("_chunk", F.shiftright("_row", 12))
    joined = placed.join(F.broadcast(marks), ["_file", "_chunk"], "left")
    return joined.select(*many.columns, F.coalesce(hit, F.lit(False)).alias(flag))


def member_flag(
    many: DataFrame, keys: DataFrame, on: list[str], flag: str, *, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Mark the rows whose key is in ``keys`` (stored, one row per key). A NULL key is no member.

    If there are too many keys to broadcast, a stored table whose marks can be broadcast is marked
    by position, see ``row_marks``: no row of it is shuffled but for its key. Others are
    joined behind ``key_filter``: only rows that may be members are shuffled, the others are done
    where they are read. ``many`` is read twice then, so it should be a stored table.
    """
    members = keys.select(*on, F.lit(True).alias(flag))

    def marked(rows: DataFrame) -> DataFrame:
        joined = lookup_join(rows, members, on, "left", broadcast_bytes=broadcast_bytes)
        return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False))).select(*many.columns, flag)

    if fits(members, broadcast_bytes):
        return marked(many)
    if marks_fit(many, broadcast_bytes):
        return at_marks(many, row_marks(many, members.select(*on), on, broadcast_bytes=broadcast_bytes), flag)
    possible = possible_members(many, key_filter(keys, on), on, "_possible")
    others = possible.filter(~F.col("_possible")).select(*many.columns, F.lit(False).alias(flag))
    return marked(possible.filter("_possible").drop("_possible")).unionByName(others)


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of every key group in the given order; NULL keys form one group.

    Spark limits each group to one row before the shuffle as well, so a hot key sends one
    row per map task. Descending orders should say ``desc_nulls_first`` where an unknown
    value ranks highest.
    """
    rank = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(rank)).filter("_rank = 1").drop("_rank")
