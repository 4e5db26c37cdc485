"""Mix sources to target weights with Sainte-Laguë quotas of equal-token blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetpulse.llm.frames import packed_columns, running, small_or_merge, table, text_or_empty
from fleetpulse.session import stage

WEIGHTS = (3, 1, 2)  # by place of the source in code point order, repeating
SHARE = 1.5  # of all words
MOST = 2  # times its own size that a source or a document may be taken
BLOCK_WORDS = 64
SHARDS = 16
SEED = "mix-1"

WORD = r"[^\x20\x09-\x0D]+"


def _source_key(source: Column) -> Column:
    """Text that tells a null source from every other and sorts it last."""
    return F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source))


def _units(size: Column, key: str, text: str, seed: str) -> list[Column]:
    """What puts a document at a seeded place in its source's stream. Equal rows share a place."""
    return [
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary")).alias("place"),
        F.crc32(text_or_empty(text).cast("binary")).alias("tie"),
        size.alias("size"),
    ]


def targets(sources: DataFrame, *, share: float = SHARE, most: int = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(src, source_size, target, words) from stored (src, source_size): weighted shares, none above ``most`` times its size.

    ``words`` are whole words, less than one from the target, and add up to within one of all targets.

    Sources are ordered by how soon they reach their limit, so prefix sums give the one
    water level at which what is left of the total, shared by weight, fills all the others.
    """
    ordered, total = running(sources, [F.col("src").asc()], ["source_size"], "mix_sources")
    weighed = ordered.select(
        "src", "source_size", (F.col("source_size") * most).alias("limit"),
        F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("row") % len(weights) + 1).cast("int")).cast("long").alias("weight"),
    )
    filled, sums = running(weighed, [(F.col("limit") / F.col("weight")).asc(), F.col("src").asc()], ["limit", "weight"], "mix_limits")
    level = (F.lit(share * total["source_size"]) - F.col("limit_before")) / (F.lit(sums["weight"]) - F.col("weight_before"))
    first = filled.filter(F.col("limit") / F.col("weight") >= level).agg(F.min(F.struct("row", level.alias("level"))).alias("first")).first()[0]
    filling = F.lit(first.level if first else float("inf")) * F.col("weight")
    # Where each source begins and ends in a row of all that are not full, in whole words.
    through = F.floor(F.lit(first.level if first else 0.0) * (F.col("weight_before") + F.col("weight")) + 0.5)
    begin = F.floor(F.lit(first.level if first else 0.0) * F.col("weight_before") + 0.5)
    words = F.when(F.col("limit") <= filling, F.col("limit")).otherwise(F.least("limit", through - begin))
    return filled.select("src", "source_size", F.least(F.col("limit").cast("double"), filling).alias("target"), words.cast("long").alias("words"))


def quotas(wanted: DataFrame, blocks: int, shards: int = SHARDS) -> DataFrame:
    """(src, shard, blocks): Sainte-Laguë seats of every source in every shard, for stored (src, target).

    Seats go to the highest quotients target / (2 k + 1), ties to the first source. The
    seats of the first j shards are those of a house of j / ``shards`` of all blocks, and
    since more seats never take one away, the differences are whole quotas of the shards.
    For each house a divisor just too large seats all but a few; only the quotients between
    it and one just too small, at most some two for each source, are ranked.
    """
    whole = wanted.agg(F.sum("target").alias("t"), F.sum(F.when(F.col("target") > 0, 1).otherwise(0)).alias("s")).first()
    votes, parties = float(whole["t"] or 0), int(whole["s"] or 0)
    if not blocks or not votes:
        return wanted.select("src", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(0).cast("long").alias("blocks"))

    def seats(divisor: Column) -> Column:
        return F.floor((F.col("target") / divisor + 1) / 2)

    house = F.expr(f"cast((shard + 1) * {blocks}L div {shards} as bigint)")
    sure = F.when(2 * F.col("house") > parties, seats(F.lit(votes) / (2 * F.col("house") - parties) * (1 + 1e-12))).otherwise(F.lit(0))
    possible = seats(F.lit(votes) / (2 * F.col("house") + parties) * (1 - 1e-12))
    houses = stage(
        wanted.filter("target > 0").select("src", "target", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
        .withColumn("house", house).withColumn("sure", sure.cast("long"))
        .withColumn("possible", F.greatest(possible.cast("long"), F.col("sure"))),
        "mix_houses",
    )
    left = houses.groupBy("shard").agg((F.max("house") - F.sum("sure")).alias("left"))  # one row per shard
    next_ones = houses.filter("possible > sure").select(
        "src", "shard", "target", F.explode(F.expr("sequence(sure, possible - 1)")).alias("k")
    )
    rank = W.partitionBy("shard").orderBy((F.col("target") / (2 * F.col("k") + 1)).desc(), "src", "k")
    won = (
        next_ones.withColumn("rank", F.row_number().over(rank)).join(F.broadcast(left), "shard").filter("rank <= left")
        .groupBy("src", "shard").agg(F.count("*").alias("won"))
    )
    through = houses.join(won, ["src", "shard"], "left").select(
        "src", "shard", (F.col("sure") + F.coalesce("won", F.lit(0))).alias("through")
    )
    earlier = F.lag("through", 1, 0).over(W.partitionBy("src").orderBy("shard"))
    return through.select("src", "shard", (F.col("through") - earlier).alias("blocks"))


def shard_words(wanted: DataFrame, seats: DataFrame, *, block_words: int, shards: int, most: int, seed: str) -> DataFrame:
    """What each shard takes of each source: (src, shard, first, length, take, begin) from (src, source_size, words) and the quotas.

    A source's stream is cut into as many even pools as there are shards, and a shard's
    quota of blocks is taken from its own pool, at most ``most`` times the pool. What the
    quotas of a source then miss of its ``words``, or hold beyond them, is settled in
    words, shard after shard: less than a block or two for a source of many blocks. The
    blocks begin at a place in the pool that is seeded for the source and the shard.
    """
    pools = wanted.select("src", "source_size", "words", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    first = F.expr(f"source_size * shard div {shards}")
    pools = pools.withColumn("first", first).withColumn("length", F.expr(f"source_size * (shard + 1) div {shards}") - F.col("first"))
    limit = F.col("length") * most
    pools = pools.join(seats, ["src", "shard"], "left").withColumn("limit", limit).withColumn(
        "quota", F.least(F.coalesce("blocks", F.lit(0)) * block_words, "limit")
    )
    source, earlier = W.partitionBy("src"), W.partitionBy("src").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    pools = pools.withColumns({  # one row per shard in each window
        "missing": F.col("words") - F.sum("quota").over(source),
        "room": F.coalesce(F.sum(F.col("limit") - F.col("quota")).over(earlier), F.lit(0)),
        "held": F.coalesce(F.sum("quota").over(earlier), F.lit(0)),
    })
    more = F.greatest(F.lit(0), F.least(F.col("missing") - F.col("room"), F.col("limit") - F.col("quota")))
    less = F.greatest(F.lit(0), F.least(-F.col("missing") - F.col("held"), F.col("quota")))
    place = F.md5(F.concat(F.lit(f"{seed}/"), "src", F.lit("/"), F.col("shard").cast("string")).cast("binary"))
    random = F.conv(F.substring(place, 1, 8), 16, 10).cast("long")
    return pools.filter("length > 0").select(
        "src", "source_size", "shard", "first", "length", (F.col("quota") + more - less).alias("take"),
        (random % F.ceil(F.col("length") / block_words) * block_words).alias("begin"),
    )


def _turns(pools: DataFrame) -> DataFrame:
    """(src, start, turns): how often a source's first word is taken, and where in its stream and by how much that changes.

    A pool's take is a number of whole passes and a run around the pool, which makes at most three parts.
    """
    passes, rest = F.expr("take div length"), F.expr("take % length")
    stop = F.col("begin") + rest
    wraps = stop > F.col("length")
    cuts = F.when(wraps, F.array(stop - F.col("length"), F.col("begin"))).otherwise(F.array(F.col("begin"), stop))
    outer, inner = passes + wraps.cast("long"), passes + 1 - wraps.cast("long")
    parts = F.array(
        F.struct(F.lit(0).cast("long").alias("from"), cuts[0].alias("to"), outer.alias("times")),
        F.struct(cuts[0].alias("from"), cuts[1].alias("to"), inner.alias("times")),
        F.struct(cuts[1].alias("from"), F.col("length").alias("to"), outer.alias("times")),
    )
    runs = pools.select("src", "first", F.inline(parts)).filter(F.col("to") > F.col("from")).withColumn("at", F.col("first") + F.col("from"))
    changes = runs.withColumn("delta", F.col("times") - F.lag("times").over(W.partitionBy("src").orderBy("at")))  # some 50 rows in each
    return changes.groupBy("src").agg(
        F.min_by("times", "at").alias("start"),
        F.collect_list(F.when(F.col("delta") != 0, F.struct("at", "delta", "times"))).alias("turns"),
    )


def _inner_turns() -> Column:
    """The changes inside a unit of equal rows, as (at, delta, inside), by the words of one row.

    Equal rows share what is taken of all of them evenly, to the nearest word, whatever the
    number of changes among them: each is taken from its first word on.
    """
    single = F.transform("own", lambda t: F.struct(t["at"].alias("at"), t["delta"].alias("delta"), (t["at"] - F.col("from")).alias("inside")))
    first, last = F.element_at("own", 1), F.element_at("own", -1)
    end, size = F.col("from") + F.col("words"), F.col("unit.size")
    came = first["times"] - first["delta"]
    total = came * F.col("words") + F.aggregate("own", F.lit(0).cast("long"), lambda n, t: n + t["delta"] * (end - t["at"]))
    per_row = F.floor((2 * total + F.col("copies")) / (2 * F.col("copies"))).cast("long")
    whole, rest = F.floor(per_row / size).cast("long"), per_row % size
    more = F.when(rest > 0, 1).otherwise(0).cast("long")
    turn = [
        (F.col("from"), whole + more - came, F.lit(0).cast("long")),
        (F.col("from") + rest * F.col("copies"), -more, rest),
        (end, last["times"] - whole, size),
    ]
    shared = F.array(*[F.struct(at.alias("at"), delta.alias("delta"), inside.alias("inside")) for at, delta, inside in turn])
    return F.when(F.col("copies") == 1, single).otherwise(shared)


def mix(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", carry: list[str] | None = None,
    seed: str = SEED, block_words: int = BLOCK_WORDS, shards: int = SHARDS, share: float = SHARE, most: int = MOST,
    weights: tuple[int, ...] = WEIGHTS,
) -> DataFrame:
    """Take ``share`` times all words, by source as ``weights`` say, no source above ``most`` times its words.

    Each source is one stream of its documents in the order of a seeded hash. Sainte-Laguë
    apportionment gives every source a quota of blocks of ``block_words`` in every shard,
    and ``shard_words`` takes them from the shard's pool of the stream. That is a piecewise
    constant number of times for each word, with some 50 changes in a source; a row finds
    its words by comparing its place with the rows that hold the changes, so texts are not
    shuffled (but where the sources are too many to broadcast their changes), and equal rows
    get equal shares.

    Returns the input row (or the columns in ``carry``) as ``doc`` with ``size`` (its words),
    ``source_size``, ``target``, ``taken``, ``times`` (how often its first word is taken) and
    ``cuts`` (before which words that changes, and by how much). A null text has no words;
    the null source is a source and comes last; a null id is placed like an empty one;
    documents of no words take none; no rows give no rows.
    """
    size = F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")
    measured = docs.select(
        packed_columns(docs, carry), _source_key(F.col(source)).alias("src"), *_units(size, key, text, seed)
    )
    if carry is not None:  # narrow rows are stored; with texts in them, measuring twice is cheaper than a copy
        measured = stage(measured, "mix_docs")
    units = measured.groupBy("src", "place", "tie", "size").agg(F.count("*").alias("copies")).withColumn(
        "words", F.col("size") * F.col("copies")
    )
    order = [F.col("src").asc(), F.col("place").asc(), F.col("tie").asc(), F.col("size").asc()]
    streamed, totals = running(units, order, ["words"], "mix_units")
    sources = stage(streamed.groupBy("src").agg(F.sum("words").alias("source_size"), F.min("words_before").alias("start")), "mix_sizes")
    wanted = stage(targets(sources.select("src", "source_size"), share=share, most=most, weights=weights), "mix_targets")
    blocks = int(share * totals["words"] / block_words + 0.5)
    pools = shard_words(wanted, quotas(wanted, blocks, shards), block_words=block_words, shards=shards, most=most, seed=seed)
    turns = stage(_turns(stage(pools, "mix_pools")), "mix_turns")

    # The row that holds each change. Pools bring together rows and changes that can meet.
    pool = f"(({{0}}) * {shards} + {shards - 1}) div source_size"
    points = turns.select("src", F.inline("turns")).join(sources.select("src", "source_size"), "src").select(
        "src", "at", "delta", "times", F.expr(pool.format("at")).alias("pool")
    )
    spread = streamed.filter("words > 0").join(small_or_merge(sources, 100), "src").withColumn("from", F.col("words_before") - F.col("start"))
    spread = spread.withColumn("pool", F.explode(F.sequence(F.expr(pool.format("from")), F.expr(pool.format("from + words - 1")))))
    found = spread.join(points.hint("merge"), ["src", "pool"]).filter("at >= from and at < from + words")
    unit = F.struct("place", "tie", "size").alias("unit")
    own = found.groupBy("src", unit, "from", "words", "copies").agg(F.sort_array(F.collect_list(F.struct("at", "delta", "times"))).alias("own"))
    held = own.select("src", "unit", F.explode(_inner_turns()).alias("turn")).groupBy("src").agg(
        F.sort_array(F.collect_list(F.struct("turn.at", "turn.delta", "unit", "turn.inside"))).alias("turns")
    )
    plan = wanted.select("src", "source_size", "target").join(turns.select("src", F.col("start").alias("times_first")), "src", "left").join(held, "src", "left")
    plan = stage(plan, "mix_plan")

    mine = F.struct("place", "tie", "size")
    held_at = F.coalesce("turns", F.array().cast(plan.schema["turns"].dataType))
    before = F.transform(held_at, lambda t: F.struct(
        F.when(mine < t["unit"], F.col("size")).when(mine == t["unit"], t["inside"]).otherwise(F.lit(0)).alias("at"), t["delta"].alias("delta")
    ))
    met = measured.join(small_or_merge(plan, 6000), "src").withColumn("before", before)
    zero = F.lit(0).cast("long")
    times = F.coalesce("times_first", zero) + F.aggregate(F.filter("before", lambda b: b["at"] <= 0), zero, lambda n, b: n + b["delta"])
    met = met.withColumn("times", times).withColumn("cuts", F.filter("before", lambda b: (b["at"] > 0) & (b["at"] < F.col("size"))))
    taken = F.col("times") * F.col("size") + F.aggregate("cuts", zero, lambda n, b: n + b["delta"] * (F.col("size") - b["at"]))
    return met.select("doc", "size", "source_size", "target", taken.alias("taken"), "times", "cuts")


def copies(mixed: DataFrame, text: str, length: str | None = None) -> DataFrame:
    """The rows of a mix, as often as they are taken. One taken in part keeps the words that the mix chose.

    ``length`` names a column that holds the text's characters and is kept right.
    """
    none = F.lit(0).cast("long")

    def part(i):
        start = F.when(i == 0, none).otherwise(F.get("cuts", i - 1)["at"])
        end = F.when(i == F.size("cuts"), F.col("size")).otherwise(F.get("cuts", i)["at"])
        times = F.col("times") + F.aggregate(F.slice("cuts", 1, i), none, lambda n, c: n + c["delta"])
        return F.struct(start.alias("from"), end.alias("to"), times.alias("times"))

    parts = F.transform(F.sequence(F.lit(0), F.size("cuts")), part)
    whole = mixed.filter("taken > 0").withColumn("parts", parts).select(
        "doc", "size", "parts", F.explode(F.sequence(F.lit(1).cast("long"), F.array_max(F.transform("parts", lambda p: p["times"])))).alias("copy")
    )
    own = F.filter("parts", lambda p: (p["times"] >= F.col("copy")) & (p["to"] > p["from"]))
    count = F.aggregate(own, none, lambda n, p: n + p["to"] - p["from"])
    whole = whole.withColumn("own", own).withColumn("kept", count).filter("kept > 0")
    pieces = F.regexp_extract_all(F.col(f"doc.`{text}`"), F.lit(r"([\x20\x09-\x0D]*" + WORD + ")"), 1)
    chosen = F.array_join(F.flatten(F.transform("own", lambda p: F.slice(pieces, (p["from"] + 1).cast("int"), (p["to"] - p["from"]).cast("int")))), "")
    cut = F.col("kept") < F.col("size")
    changed = whole.withColumn("doc", F.col("doc").withField(f"`{text}`", F.when(cut, chosen).otherwise(F.col(f"doc.`{text}`"))))
    if length:
        new = F.when(cut, F.char_length(F.col(f"doc.`{text}`")).cast("long")).otherwise(F.col(f"doc.`{length}`"))
        changed = changed.withColumn("doc", F.col("doc").withField(f"`{length}`", new))
    return changed.select("doc.*")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), carry=["doc_id"]).select(
        F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target", "taken"
    )


ORACLE = rf"""
with d as (
  select doc_id, case when source is null then '1' else '0' || source end as src, md5('{SEED}:' || doc_id) as place,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size from documents),
p as (select *, sum(size) over (partition by src order by place) - size as a from d),
s as (select src, sum(size) as l, [3, 1, 2][(row_number() over (order by src) - 1) % 3 + 1] as w from d group by src),
f as (select src, l, w, row_number() over (order by 2.0 * l / w, src) as k,
        ({SHARE} * sum(l) over () - (sum(2 * l) over (order by 2.0 * l / w, src) - 2 * l))
        / (sum(w) over () - (sum(w) over (order by 2.0 * l / w, src) - w)) as level from s),
v as (select arg_min(level, k) as level from f where 2.0 * l / w >= level),
t as (select src, l, least(2.0 * l, v.level * w)::double as target from f, v),
w as (select f.src, f.l, f.w, case when 2 * f.l <= v.level * f.w then 2 * f.l
        else least(2 * f.l, floor(v.level * (b + f.w) + 0.5) - floor(v.level * b + 0.5)) end::bigint as words
      from (select *, sum(w) over (order by k) - w as b from f) f, v),
h as (select j, (j + 1) * (select floor({SHARE} * sum(l) / {BLOCK_WORDS} + 0.5)::bigint from s) // {SHARDS} as house from range({SHARDS}) r(j)),
q as (select src, row_number() over (order by target / (2 * j + 1) desc, src, j) as n
      from (select src, target, unnest(range(0, (target / {BLOCK_WORDS})::bigint + 3)) as j from t)),
b as (select src, j, count(*) as n from q join (select j, house, lag(house, 1, 0) over (order by j) as earlier from h) on n > earlier and n <= house group by src, j),
o as (select w.src, w.l, words, h.j, w.l * h.j // {SHARDS} as p, w.l * (h.j + 1) // {SHARDS} - w.l * h.j // {SHARDS} as len,
        least(coalesce(b.n, 0) * {BLOCK_WORDS}, 2 * (w.l * (h.j + 1) // {SHARDS} - w.l * h.j // {SHARDS})) as quota
      from w cross join h left join b on b.src = w.src and b.j = h.j),
m as (select *, words - sum(quota) over (partition by src) as d, sum(2 * len - quota) over (partition by src order by j) - (2 * len - quota) as room,
        sum(quota) over (partition by src order by j) - quota as held from o),
r as (select src, j, p, len, quota + greatest(0, least(d - room, 2 * len - quota)) - greatest(0, least(-d - held, quota)) as take,
        ('0x' || substr(md5('{SEED}/' || src || '/' || j), 1, 8))::bigint % ceil(len / {BLOCK_WORDS})::bigint * {BLOCK_WORDS} as x
      from m where len > 0),
k as (select doc_id, sum(take // len * (y - z) + greatest(least(y, x + take % len) - greatest(z, x), 0) + greatest(least(y, x + take % len - len) - z, 0)) as taken
      from (select doc_id, take, len, x, greatest(a, r.p) - r.p as z, least(a + size, r.p + len) - r.p as y from p join r on r.src = p.src and a < r.p + len and a + size > r.p)
      group by doc_id)
select doc_id, size::bigint as size, l::bigint as source_size, target, coalesce(taken, 0)::bigint as taken
from p join t using (src) left join k using (doc_id)
"""
