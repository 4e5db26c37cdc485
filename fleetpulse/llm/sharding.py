"""Contiguous shards of near equal bytes, cut from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.frames import packed_columns, running, table, text_or_empty


def shard_by_bytes(
    docs: DataFrame, shards: int = 16, *, key: str = "doc_id", text: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """Deal documents into ``shards`` contiguous runs of the order by id with near equal bytes.

    A document weighs its UTF-8 bytes plus 1. Sorted ranges are summed one by one, the
    range totals give each document its global byte interval, and the document goes to the
    shard that holds the interval's middle, so a shard misses its target by less than one
    document. Returns the input row (or the columns in ``carry``, so that texts need not be
    moved) as ``doc`` with ``size``, ``text_crc32``, ``shard`` (from 0) and ``slot`` (from 0
    without gaps inside the shard).

    A null text weighs 1 and has the CRC of no bytes, a null id sorts last, equal ids are
    ordered by CRC and size, equal rows in any order; each row gets its own slot. Shards
    may stay empty if there are fewer documents than shards or one outweighs a shard. No
    rows give no rows.
    """
    rows = docs.select(
        packed_columns(docs, carry),
        F.col(key).alias("_key"),
        (F.octet_length(text_or_empty(text)) + 1).cast("long").alias("size"),
        F.crc32(text_or_empty(text).cast("binary")).alias("text_crc32"),
    )
    order = [F.col("_key").asc_nulls_last(), F.col("text_crc32").asc(), F.col("size").asc()]
    placed, totals = running(rows, order, ["size"], "shards")
    dealt = placed.withColumn(
        "shard", F.expr(f"cast(((2 * size_before + size) * {shards}) div {2 * max(totals['size'], 1)} as int)")
    )
    first = dealt.groupBy("shard").agg(F.min("row").alias("first"))  # at most one row per shard
    return dealt.join(F.broadcast(first), "shard").select(
        "doc", "size", "text_crc32", "shard", (F.col("row") - F.col("first")).alias("slot")
    )


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = shard_by_bytes(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return dealt.select(
        F.col("doc.doc_id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


# CRC32 is computed byte by byte from its table, as SQL has no function for it.
ORACLE = """
with t as (select list(v order by i) as tab from (select i, list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0]::bigint[],
    lambda a, z: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) as v from range(256) r(i))),
d as (select doc_id, octet_length(encode(coalesce(text, ''))) + 1 as size,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::bigint) as raw from documents),
c as (select doc_id, size, xor(list_reduce([4294967295::bigint] || raw, lambda a, x: xor(a >> 8, tab[(xor(a, x) & 255) + 1])),
    4294967295::bigint) as crc from d, t),
p as (select doc_id, size, crc, sum(size) over (order by doc_id) - size as start, sum(size) over () as total from c),
s as (select *, ((2 * start + size) * 16 // (2 * total))::integer as shard from p)
select doc_id, size::bigint as size, crc::bigint as text_crc32, 'bytes' as law, shard,
  (row_number() over (partition by shard order by doc_id) - 1)::bigint as slot, cast(null as integer) as grown_shard from s
"""
