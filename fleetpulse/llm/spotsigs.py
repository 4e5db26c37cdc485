"""SpotSigs document fingerprints: chains of content words after common-word anchors, compared by pruned Jaccard."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetpulse.llm.frames import packed_columns, table, text_or_empty
from fleetpulse.session import stage

# Common function words of English, German, French and Spanish that anchor a chain.
ANCHORS = (
    "a an and are as at be by for from has have he in is it of on or that the this to was with "
    "als auf das dem den der des die ein eine für ist mit nicht sich und von zu "
    "au aux avec ce dans du en est et la le les ne pas pour que qui sur un une "
    "al como con del el es las lo los no para por se su una y"
).split()
CHAIN = 2  # content words that follow an anchor
SIMILAR = 0.8

WORD = r"[\p{L}\p{N}]+"


def signatures(text: Column, anchors: list[str] = ANCHORS, chain: int = CHAIN) -> Column:
    """The set of spot signatures of a text as sorted 32-bit numbers.

    Words are runs of letters and digits in lower case. Each anchor gives one signature with
    the next ``chain`` words that are no anchors. A text in which no anchor is followed by
    so many has one signature, of all its words; a text without words has none.
    """
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), 0)
    # Arrays are handed on as lambda variables, so that each is computed once.
    return _let(words, lambda ws: _let(
        F.filter(ws, lambda w: ~w.isin(*anchors)),
        lambda content: _let(
            F.filter(F.transform(ws, lambda w, i: F.when(w.isin(*anchors), F.struct(w.alias("w"), i.alias("i")))), lambda s: s.isNotNull()),
            lambda spots: _let(
                # Before the j-th anchor, at word i, there are i - j content words.
                F.filter(
                    F.transform(spots, lambda s, j: F.when(
                        s["i"] - j + chain <= F.size(content),
                        F.concat_ws(" ", s["w"], F.slice(content, s["i"] - j + 1, F.lit(chain))),
                    )),
                    lambda s: s.isNotNull(),
                ),
                lambda chains: F.sort_array(F.array_distinct(F.transform(
                    F.when((F.size(chains) > 0) | (F.size(ws) == 0), chains).otherwise(F.array(F.concat_ws(" ", F.lit("*"), ws))),
                    _number,
                ))),
            ),
        ),
    ))


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _number(signature: Column) -> Column:
    """The first 32 bits of the MD5, as a signed number."""
    return (F.conv(F.substring(F.md5(signature.cast("binary")), 1, 8), 16, 10).cast("long") - (1 << 31)).cast("int")


def fingerprint(signatures_: Column) -> Column:
    return F.array_join(signatures_.cast("array<string>"), " ")


def likeness(a: Column, b: Column, at_least: float = 0.0) -> Column:
    """Jaccard similarity of two signature sets; 0 without comparing them where their sizes rule out ``at_least``.

    Two empty sets are alike.
    """
    few, many = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    return F.when(many == 0, 1.0).when(few < at_least * many, 0.0).otherwise(shared / (F.size(a) + F.size(b) - shared))


def near_pairs(docs: DataFrame, *, key: str = "doc_id", text: str = "text", similar: float = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): documents by class of equal signature sets, and pairs of classes at least ``similar``.

    Classes are partitioned by set length so that only neighbouring partitions can hold
    sets similar enough. Within them classes meet on the rarest of their signatures, of which
    similar sets must share one, are pruned by length and verified by Jaccard. ``members`` is
    (key, class), ``pairs`` is (a, b, similarity) with a < b. Null ids are members like any
    other; texts without words form one class, similar to no other.
    """
    rows = docs.select(F.col(key).alias(key), signatures(text_or_empty(text)).alias("sigs"))
    rows = stage(rows.withColumn("class", F.sha2(fingerprint(F.col("sigs")).cast("binary"), 256)), "spot_docs")
    classes = stage(rows.groupBy("class").agg(F.first("sigs").alias("sigs")), "spot_classes")
    tokens = classes.select("class", F.size("sigs").alias("n"), F.explode("sigs").alias("sig"))
    often = tokens.groupBy("sig").agg(F.count("*").alias("classes"))
    rank = F.row_number().over(W.partitionBy("class").orderBy("classes", "sig"))
    prefix = tokens.join(often, "sig").withColumn("rank", rank).filter(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * similar) + 1)
    part = F.floor(F.log("n") / math.log(1 / similar)).cast("long")
    prefix = stage(prefix.select("class", "n", "sig", part.alias("part")), "spot_prefixes")
    left = prefix.select(F.col("class").alias("a"), F.col("n").alias("na"), "sig", F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"))
    right = prefix.select(F.col("class").alias("b"), F.col("n").alias("nb"), "sig", "part")
    met = left.join(right, ["sig", "part"]).filter(
        (F.col("a") != F.col("b")) & (F.col("na") <= F.col("nb")) & (F.col("na") >= similar * F.col("nb"))
    ).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    similarity = likeness(F.col("x.sigs"), F.col("y.sigs"), similar)
    pairs = (
        met.join(classes.alias("x"), F.col("a") == F.col("x.class")).join(classes.alias("y"), F.col("b") == F.col("y.class"))
        .select("a", "b", similarity.alias("similarity")).filter(F.col("similarity") >= similar)
    )
    return rows.select(key, "class"), pairs


def with_next(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text beside the first half of the next one: (key, text, n_chars, times, next_half, next_sigs).

    Texts follow each other by descending id (null last, equal ids by hash), and the first
    follows the last. Rows equal in id and text are one row that stands ``times`` times.
    Only ids and hashes are sorted; each text is shuffled once by its key, and the halves
    once more to where they are wanted, so no order of texts has to fit anywhere.
    """
    spark = docs.sparkSession
    body = text_or_empty(text)
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(body).alias("h1"), F.xxhash64(F.lit(1), body).alias("h2"), body.alias("text"))
    by = ["id", "h1", "h2"]
    keys = rows.withColumn("n", F.char_length("text")).groupBy(*by).agg(F.count("*").alias("copies"), F.first("n").alias("n"))
    order = [F.col("id").desc_nulls_last(), F.col("h1").asc(), F.col("h2").asc()]
    ranged = keys.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()).withColumn(
        "place", F.monotonically_increasing_id()
    )
    ranged = stage(ranged, "spot_order")
    me = F.struct("id", "h1", "h2")
    # The first key of each range follows the last of the range before it. One row per range.
    firsts = [(r.part, r.first) for r in ranged.groupBy("part").agg(F.min_by(me, "place").alias("first")).orderBy("part").collect()]
    schema = f"part int, follows struct<id: {dict(docs.dtypes)[key]}, h1: long, h2: long>"
    follows = spark.createDataFrame([(p, firsts[(i + 1) % len(firsts)][1]) for i, (p, _) in enumerate(firsts)], schema)
    ahead = F.lead(me).over(W.partitionBy("part").orderBy("place"))
    chained = ranged.withColumn("ahead", ahead).join(F.broadcast(follows), "part").select(
        me.alias("me"), "n", "copies", F.coalesce("ahead", "follows").alias("next")
    )
    # Of equal rows, all but one are followed by themselves.
    wishes = stage(
        chained.select("me", "n", F.explode(F.array_compact(F.array(
            F.struct(F.col("next").alias("next"), F.lit(1).cast("long").alias("times")),
            F.when(F.col("copies") > 1, F.struct(F.col("me").alias("next"), (F.col("copies") - 1).alias("times"))),
        ))).alias("w")).select("me", "n", "w.next", "w.times"),
        "spot_next",
    )
    # A null id must meet itself, so keys are compared as never-null columns.
    shown = [F.col("id").isNull().alias("k0"), F.coalesce(F.col("id").cast("string"), F.lit("")).alias("k1"), F.col("h1").alias("k2"), F.col("h2").alias("k3")]
    at = ["k0", "k1", "k2", "k3"]
    # Both joins read the same columns, so that one shuffle of the texts serves them.
    texts = rows.select(*shown, "text").groupBy(*at).agg(F.first("text").alias("text"))

    def keyed(struct: str) -> list[Column]:
        s = F.col(struct)
        return [s["id"].isNull().alias("k0"), F.coalesce(s["id"].cast("string"), F.lit("")).alias("k1"), s["h1"].alias("k2"), s["h2"].alias("k3")]

    gifts = texts.join(wishes.select(*keyed("next"), "me", "n", "times"), at).select(
        *keyed("me"), F.col("me.id").alias("id"), "times", F.col("n").alias("n_chars"),
        F.substring(F.col("text"), F.lit(1), F.expr("n div 2")).alias("next_half"),
        signatures(F.col("text")).alias("next_sigs"),
    )
    return texts.join(gifts, at).select(F.col("id").alias(key), "text", F.col("n_chars").cast("long").alias("n_chars"), "times", "next_half", "next_sigs")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose second half is the next text's first.

    A null text counts as empty: no characters, no signatures, like any other text without
    words and unlike one with words.
    """
    pairs = with_next(table(spark, sf_dir, "documents"))
    edited = F.concat(F.expr("substring(text, 1, cast(n_chars - n_chars div 2 as int))"), "next_half")
    prints = pairs.withColumn("edited", edited).select(
        "doc_id", "n_chars", "times", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        signatures(F.col("text")).alias("sigs"), signatures(F.col("edited")).alias("edited_sigs"), "next_sigs",
    )
    return prints.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("sigs")).alias("fingerprint"),
        fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
        F.explode(F.expr("sequence(1, cast(times as int))")).alias("copy"),
    ).drop("copy")


def _oracle() -> str:
    anchors = ", ".join(f"'{a}'" for a in ANCHORS)

    def sigs(text: str, name: str) -> str:
        return f"""
{name}_w as (select doc_id, regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+') as ws from e),
{name}_a as (select doc_id, ws, list_filter(ws, lambda w: w not in ({anchors})) as content,
  list_filter(range(1, len(ws) + 1), lambda i: ws[i] in ({anchors})) as spots from {name}_w),
{name}_c as (select doc_id, ws, list_filter(list_transform(range(1, len(spots) + 1),
  lambda j: case when spots[j] - j + {CHAIN} <= len(content) then ws[spots[j]] || ' ' || array_to_string(content[spots[j] - j + 1:spots[j] - j + {CHAIN}], ' ') end),
  lambda s: s is not null) as chains from {name}_a),
{name}_s as (select doc_id, list_sort(list_distinct(list_transform(
  case when len(chains) > 0 or len(ws) = 0 then chains else ['* ' || array_to_string(ws, ' ')] end,
  lambda s: ('0x' || left(md5(s), 8))::bigint - 2147483648))) as sigs from {name}_c)"""

    def near(a: str, b: str) -> str:
        return f"case when len({a}) + len({b}) = 0 then 1.0::double else len(list_intersect({a}, {b}))::double / (len({a}) + len({b}) - len(list_intersect({a}, {b}))) end"

    return f"""
with t as (select doc_id, coalesce(text, '') as text from documents),
n as (select doc_id, text, length(text) as n, coalesce(lead(doc_id) over (order by doc_id desc), max(doc_id) over ()) as next_id from t),
e as (select n.doc_id, n.text, n.n, next_id, left(n.text, n.n - n.n // 2) || left(t.text, n.n // 2) as edited
      from n join t on t.doc_id = next_id),{sigs("text", "x")},{sigs("edited", "y")}
select e.doc_id, n::bigint as n_chars, sha256(edited) as edited_sha256, array_to_string(x.sigs, ' ') as fingerprint,
  array_to_string(y.sigs, ' ') as edited_fingerprint, {near("x.sigs", "y.sigs")} as near_edited, {near("x.sigs", "z.sigs")} as near_next
from e join x_s x using (doc_id) join y_s y using (doc_id) join x_s z on z.doc_id = e.next_id
"""


ORACLE = _oracle()
