"""Mixing sources to target weights by Sainte-Lague apportionment (DataFrame functions only).

Targets: the mix has as many words as all documents. Sources share it by weight; a source is
held at ``max_repeat`` times its own words and the excess goes to the others by weight
until none is above (water filling, solved in closed form over the source table: sources
saturate in the order of size / weight).

Blocks: the mix is cut into blocks of ``block_words`` words. Each source's integer quota comes from
the Sainte-Lague method (highest quotients target / (2k - 1)). The method never takes a block
back when the mix grows, so the quota of mix shard j is the difference of two
apportionments: every shard has its own integer quotas and they add up to the whole.

Selection: a source's documents stand in seeded order (MD5 of seed and id) and form a stream of blocks, read round and round.
Shard j takes the blocks that follow those of the shards before it, as many as its quota; ``shard_blocks`` names them. All shards
together have taken whole passes over the stream and the leading blocks of one more, so one document per source at most is
taken in part.

Positions in the stream are prefix sums. They are taken per (source, hash bucket), with the buckets
sized to hold a few thousand documents, and added to the buckets' own prefix sums, so a source
holding a third of all rows is spread over many tasks.

Defined cases: NULL or empty text has size 0 and is taken 0 times. NULL source is a source of
its own, last in order. Ties in the seeded order go by id, size and the text's digest; rows equal in these are one text several
times. Texts of any length count whole. An empty table gives an empty result. Other columns than id, source and text are not
read, but for ``materialise``, which carries them along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import WORD, documents, filled, stored

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
BLOCK_WORDS = 64
BLOCKS_PER_SHARD = 1 << 16
SEED = "mix-1"
#: Copies of a text that a task writes from one row.
COPIES = 1024
#: Aim for documents in a prefix-sum bucket.
BUCKET_ROWS = 4096


def sizes(df: DataFrame, seed: str = SEED) -> DataFrame:
    """``(doc_id, source, size, ord, digest)``; ``ord`` is the seeded place, 32 hex digits."""
    return df.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.regexp_count(filled(F.col("text")), F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("ord"),
        F.sha2(filled(F.col("text")), 256).alias("digest"),
    )


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``(source, n_docs, source_size, weight, target)``, one row per source."""
    everything = Window.partitionBy(F.lit(1))
    rank = F.row_number().over(everything.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int")).cast("long")
    # Sources by the fill level at which they are full; before: what the earlier ones hold.
    fill = everything.orderBy((F.col("cap") / F.col("weight")).asc(), "rank")
    earlier = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = F.col("total") - F.coalesce(F.sum("cap").over(earlier), F.lit(0))
    rest_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    return (
        per_source.withColumn("rank", rank)
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * max_repeat)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("rest", rest)
        .withColumn("rest_weight", rest_weight)
        .withColumn("full", F.col("cap") * F.col("rest_weight") <= F.col("weight") * F.col("rest"))
        # The first source that is not full sets the level for all that follow it.
        .withColumn("level_rest", F.max(F.when(~F.col("full"), F.struct(F.col("rest_weight"), F.col("rest")))).over(everything))
        .select(
            "source", "n_docs", "source_size", "weight",
            F.when(F.col("full"), F.col("cap").cast("double"))
            .otherwise((F.col("weight") * F.col("level_rest.rest")).cast("double") / F.col("level_rest.rest_weight"))
            .alias("target"),
        )
    )


def sainte_lague(shares: DataFrame) -> DataFrame:
    """Seats of each source in each house: ``(house, source, quota)`` for rows ``(house, source, target)``.

    With ideal = house * target / total, a source's seats lie within n / 2 * target / total + 1 of
    the ideal (n sources: rounding moves the divisor by n / 2 seats at most). The seats below that
    are sure; only the band around it, 3 n quotients over all sources, is ranked.
    """
    of_house = Window.partitionBy("house")
    share = F.when(F.col("total") > 0, F.col("target") / F.col("total")).otherwise(F.lit(0.0))
    ideal, slack = F.col("house") * share, F.col("n") / 2 * share + 1
    near = (
        shares.select("house", "source", "target")
        .withColumn("total", F.sum("target").over(of_house))
        .withColumn("n", F.count("*").over(of_house))
        .withColumn("sure", F.greatest(F.floor(ideal - slack), F.lit(0)).cast("long"))
        .withColumn("most", F.floor(ideal + slack).cast("long"))
        .withColumn("left", F.col("house") - F.sum("sure").over(of_house))
    )
    seats = near.select("*", F.explode(F.sequence(F.col("sure"), F.col("most"))).alias("k"))
    by_quotient = of_house.orderBy((F.col("target") / (2 * F.col("k") + 1)).desc(), F.asc_nulls_last("source"), "k")
    return (
        seats.withColumn("place", F.row_number().over(by_quotient))
        .groupBy("house", "source")
        .agg((F.max("sure") + F.sum(((F.col("place") <= F.col("left")) & (F.col("target") > 0)).cast("long"))).alias("quota"))
    )


def _blocks(shares: DataFrame, block_words: int) -> DataFrame:
    total = F.sum("source_size").over(Window.partitionBy(F.lit(1)))
    return shares.withColumn("blocks", F.ceil(total / block_words).cast("long"))


def quotas(shares: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Blocks each source gives to the whole mix: ``(source, quota)``."""
    return sainte_lague(_blocks(shares, block_words).withColumn("house", F.col("blocks"))).select("source", "quota")


def shard_quotas(shares: DataFrame, block_words: int = BLOCK_WORDS, per_shard: int = BLOCKS_PER_SHARD) -> DataFrame:
    """Integer quotas of every mix shard: ``(shard, source, blocks)``, one row per shard and source."""
    houses = F.sequence(F.lit(0), F.ceil(F.col("blocks") / per_shard).cast("long"))
    ends = _blocks(shares, block_words).select("source", "target", "blocks", F.explode(houses).alias("end"))
    ends = ends.withColumn("house", F.least(F.col("end") * per_shard, F.col("blocks")))
    before = F.lag("quota", 1).over(Window.partitionBy("source").orderBy("house"))
    return (
        sainte_lague(ends)
        .withColumn("blocks", F.col("quota") - before)
        .where(F.col("blocks").isNotNull())
        .select((F.ceil(F.col("house") / per_shard) - 1).alias("shard"), "source", "blocks")
    )


def shard_blocks(shares: DataFrame, block_words: int = BLOCK_WORDS, per_shard: int = BLOCKS_PER_SHARD) -> DataFrame:
    """The blocks of each source's seeded stream that every shard takes: ``(shard, source, first_block, blocks)``. Block b holds
    the words from b * block_words on of the stream, which starts over at its end."""
    before = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("blocks").over(before), F.lit(0)).alias("first_block")
    return shard_quotas(shares, block_words, per_shard).select("shard", "source", first, "blocks")


def mix(
    df: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_repeat: int = MAX_REPEAT,
    block_words: int = BLOCK_WORDS,
    seed: str = SEED,
    bucket_rows: int = BUCKET_ROWS,
    per_shard: int = BLOCKS_PER_SHARD,
) -> DataFrame:
    """One row per document: ``doc_id, source, size, digest, source_size, target, quota_blocks, taken``."""
    sized = stored(sizes(df, seed), "mix-sizes")
    shares = stored(targets(sized, weights, max_repeat).coalesce(1), "mix-targets")
    # What a source gives is what the shards take of it.
    chosen = stored(shard_blocks(shares, block_words, per_shard), "mix-shards")
    taken = chosen.groupBy(F.col("source").alias("of")).agg(F.max(F.col("first_block") + F.col("blocks")).alias("quota"))
    plan = shares.join(taken, F.col("source").eqNullSafe(F.col("of")), "left").withColumn("quota", F.coalesce("quota", F.lit(0)))
    plan = stored(plan.drop("of").coalesce(1), "mix-quotas")

    # A hash bucket is the leading bits of the seeded order, so buckets follow one another in it.
    lead = F.conv(F.substring("ord", 1, 8), 16, 10).cast("long")
    buckets = F.greatest(F.ceil(F.col("n_docs") / bucket_rows), F.lit(1))
    placed = (
        sized.alias("d").join(plan.alias("p"), F.expr("d.source <=> p.source"))
        .selectExpr("d.*", "p.source_size", "p.n_docs", "p.target", "p.quota")
        .withColumn("bucket", F.floor(lead * buckets / F.lit(1 << 32)).cast("long"))
    )
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
        .select("source", "bucket", F.coalesce(F.sum("bucket_size").over(ahead), F.lit(0)).alias("bucket_start"))
    )
    within = Window.partitionBy("source", "bucket").orderBy("ord", "doc_id", "size", "digest").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))

    words = F.least(F.col("quota") * block_words, F.col("source_size") * max_repeat)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("words") / F.col("source_size"))).otherwise(F.lit(0))
    start = F.col("before") + F.col("bucket_start")
    part = F.least(F.greatest(F.col("words") - F.col("passes") * F.col("source_size") - start, F.lit(0)), F.col("size"))
    return (
        placed.alias("d").join(starts.alias("b"), F.expr("d.source <=> b.source AND d.bucket = b.bucket"))
        .selectExpr("d.*", "b.bucket_start")
        .withColumn("words", words)
        .withColumn("passes", passes)
        .withColumn("part", part)
        .select(
            "doc_id", "source", "size", "digest", "source_size", "target", F.col("quota").alias("quota_blocks"),
            (F.col("passes") * F.col("size") + F.col("part")).cast("long").alias("taken"),
        )
    )


def materialise(df: DataFrame, taken: DataFrame) -> DataFrame:
    """The mix itself: ``df``'s columns, each document once per full take, and a document taken in
    part with its leading words only. ``n_chars`` follows the text if the table has it.
    Rows are matched by id, source and text; those that repeat all three are one row, once per full take of any of them."""
    key = F.expr("id <=> _id AND src <=> _source AND sha = _digest")
    plan = taken.groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("digest").alias("_digest")).agg(
        F.sum("taken").alias("taken"), F.max("size").alias("size"), F.count("*").alias("n_rows")
    )
    plan = stored(plan.where("taken > 0"), "mix-plan")
    own = {c: f"_c{i}" for i, c in enumerate(df.columns)}  # names that none of the columns below has
    rows = df.select(
        *[F.col(f"`{c}`").alias(name) for c, name in own.items()],
        F.col("doc_id").cast("long").alias("id"), F.col("source").cast("string").alias("src"), F.sha2(filled(F.col("text")), 256).alias("sha"),
    )
    chosen = rows.join(plan, key)
    if plan.where("n_rows > 1").take(1):
        once = chosen.where("n_rows > 1").dropDuplicates(["_id", "_source", "_digest"])
        chosen = chosen.where("n_rows = 1").unionByName(once)
    chosen = chosen.withColumn("copies", F.ceil(F.col("taken") / F.col("size")).cast("long"))
    if plan.where(F.col("taken") > COPIES * F.col("size")).take(1):  # a text that stands in very many rows: its copies are dealt out
        runs = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long")))
        many = chosen.where(F.col("copies") > COPIES).withColumn("first", runs).repartition("id", "src", "sha", "first")
        chosen = chosen.withColumn("first", F.lit(0).cast("long")).where(F.col("copies") <= COPIES).unionByName(many)
    else:
        chosen = chosen.withColumn("first", F.lit(0).cast("long"))
    last = F.least(F.col("first") + COPIES, F.col("copies"))
    words = F.least(F.col("taken") - (F.col("copy") - 1) * F.col("size"), F.col("size"))
    each = F.regexp_extract_all(F.col(own["text"]), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    text = F.when(words < F.col("size"), F.array_join(F.slice(each, F.lit(1), words.cast("int")), "")).otherwise(F.col(own["text"]))
    shown = {c: F.col(name) for c, name in own.items()} | {"text": text}
    if "n_chars" in own:
        shown["n_chars"] = F.length(text).cast(df.schema["n_chars"].dataType)
    copied = chosen.withColumn("copy", F.explode(F.sequence(F.col("first") + 1, last)))
    return copied.select(*[value.alias(c) for c, value in shown.items()])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS ord,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM d GROUP BY source),
-- A source is full if the mix, filled to its level, is not yet complete.
f AS (
  SELECT a.source, a.source_size, a.w,
         sum(least(3 * b.source_size * a.w, b.w * 3 * a.source_size)) <= (SELECT sum(source_size) FROM s) * a.w AS is_full
  FROM s a, s b GROUP BY a.source, a.source_size, a.w),
t AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN CAST(3 * source_size AS DOUBLE)
              ELSE CAST(w * (sum(source_size) OVER () - coalesce(sum(3 * source_size) FILTER (WHERE is_full) OVER (), 0)) AS DOUBLE)
                   / sum(w) FILTER (WHERE NOT is_full) OVER () END AS target
  FROM f),
h AS (SELECT CAST(ceil(sum(source_size) / {BLOCK_WORDS}) AS BIGINT) AS house FROM s),
seats AS (
  SELECT source, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, source NULLS LAST, k) AS place
  FROM t, h, LATERAL (SELECT unnest(generate_series(1, house)) AS k) WHERE target > 0),
q AS (
  SELECT t.source, t.source_size, t.target,
         least({BLOCK_WORDS} * (SELECT count(*) FROM seats, h WHERE seats.source IS NOT DISTINCT FROM t.source AND place <= house),
               3 * t.source_size) AS words
  FROM t),
p AS (
  SELECT doc_id, size, source, coalesce(sum(size) OVER (PARTITION BY source ORDER BY ord, doc_id, size
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE
         (words // source_size) * size + least(greatest(words % source_size - start, 0), size) END AS BIGINT) AS taken
FROM p JOIN q ON p.source IS NOT DISTINCT FROM q.source
"""
