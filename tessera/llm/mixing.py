"""Mixing sources to target weights by a low-discrepancy schedule (operator 7).

Targets: the sources, by code point with null last, weigh ``weights`` in turn
and share the size of all documents (words). A target stops at ``max_passes``
times its source's size; the excess is shared again by weight among the others
until none is above. Sorted by size / weight, the sources that stop are the
first ones, so running sums over the source table give the same result.

Schedule: the mix is a row of slots of equal numbers of words. Slot k has the
golden-ratio point ``k * 2654435769 mod 2**32``; the point falls into one
source's part of the cumulative targets. The slots of a source are ranked;
the slot of rank r takes block r of the source, i.e. words r * B up to
(r + 1) * B of its shuffled documents laid end to end (and again from the
start after the last). A source ends with the slot that reaches its target, of
which only the missing words are taken; slots that the points leave it short
of are appended.

Scale: ranks and positions are sums over fixed pieces (runs of slots, ranges
of the shuffle hash) plus a window inside each piece, so a source with a third of
all rows is many windows. Documents meet slots by (source, block), and a hot
source has many blocks. The text is read once, for its word count.

Null texts have size 0, are in the result and are never taken. Empty tables give
no rows. Rows with the same doc_id are documents of their own; the shuffle
depends on doc_id and size alone, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import small, written

WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
SEED = "mix-1"
#: Words of a slot: at most so many, and at most one in MIN_SLOTS of the mix.
SLOT_WORDS = 1024
MIN_SLOTS = 1 << 16
GOLDEN = 2654435769
_CIRCLE = 1 << 32
_CELL = 1 << 20
_RUN = 1 << 16


def count_words(text: Column) -> Column:
    parts = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    return F.size(F.array_remove(parts, "")).cast("bigint")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """(source, no, source_size, target double, words): a row for each source.
    The windows run over the source table, not over documents."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.col("no") - 1, F.lit(len(weights))).cast("int")
    s = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
         .withColumn("no", F.row_number().over(by_name).cast("bigint"))
         .withColumn("weight", F.element_at(F.array(*[F.lit(int(w)).cast("bigint") for w in weights]), turn + 1)))
    whole = Window.partitionBy(F.lit(0))
    order = whole.orderBy(F.col("source_size") / F.col("weight"), "no")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    dec = lambda c: c.cast("decimal(19,0)")
    s = (s.withColumn("all_size", F.sum("source_size").over(whole))
         .withColumn("all_weight", F.sum("weight").over(whole))
         .withColumn("cap", F.col("source_size") * max_passes)
         .withColumn("left_size", F.col("all_size") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
         .withColumn("left_weight", F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0)))
         .withColumn("above", dec(F.col("weight")) * dec(F.col("left_size")) >= dec(F.col("cap")) * dec(F.col("left_weight")))
         .withColumn("stops", F.sum(F.when(F.col("above"), 0).otherwise(1)).over(order) == 0))
    open_size = F.col("all_size") - F.sum(F.when(F.col("stops"), F.col("cap")).otherwise(0)).over(whole)
    open_weight = F.col("all_weight") - F.sum(F.when(F.col("stops"), F.col("weight")).otherwise(0)).over(whole)
    target = F.when(F.col("stops"), F.col("cap").cast("double")).otherwise(
        F.col("weight") * F.col("open_size") / F.col("open_weight"))
    return (s.withColumn("open_size", open_size).withColumn("open_weight", open_weight)
            .select("source", "no", "source_size", target.alias("target"))
            .withColumn("words", F.least(F.round("target").cast("bigint"), F.col("source_size") * max_passes)))


def slot_words(total: int, largest: int = SLOT_WORDS) -> int:
    return max(1, min(largest, total // MIN_SLOTS))


def schedule(sources: DataFrame, block: int) -> DataFrame:
    """(no, rank, slot) for every slot of the mix; rank counts a source's slots from 0."""
    spark = sources.sparkSession
    whole = Window.partitionBy(F.lit(0))
    upto = F.sum("words").over(whole.orderBy("no"))
    total = F.sum("words").over(whole)
    mark = lambda c: F.floor(c / total * _CIRCLE).cast("bigint")
    parts = written(sources.where("words > 0").withColumn("lo", mark(upto - F.col("words"))).withColumn("hi", mark(upto))
                    .withColumn("slots", F.ceil(F.col("words") / block).cast("bigint")), "parts")
    n_slots = parts.agg(F.sum("slots")).first()[0] or 0
    cells = parts.where("hi > lo").select("no", "lo", "hi", F.explode(
        F.sequence(F.floor(F.col("lo") / _CELL), F.floor((F.col("hi") - 1) / _CELL))).alias("cell"))
    points = spark.range(n_slots).select(
        F.col("id").alias("slot"), F.pmod(F.col("id") % (1 << 31) * F.lit(GOLDEN), F.lit(_CIRCLE)).alias("point"))
    drawn = (points.withColumn("cell", F.floor(F.col("point") / _CELL)).join(small(written(cells, "cells")), "cell")
             .where("point >= lo and point < hi")
             .select("no", "slot", F.floor(F.col("slot") / _RUN).alias("run")))
    per_run = drawn.groupBy("no", "run").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("no").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_run.select("no", "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    inside = Window.partitionBy("no", "run").orderBy("slot")
    ranked = (drawn.join(offsets, ["no", "run"])
              .select("no", (F.col("first") + F.row_number().over(inside) - 1).alias("rank"), "slot"))
    kept = ranked.join(small(parts.select("no", "slots")), "no").where("rank < slots").select("no", "rank", "slot")
    have = per_run.groupBy("no").agg(F.sum("n").alias("have"))
    short = (parts.join(have, "no", "left").withColumn("have", F.coalesce("have", F.lit(0)))
             .where("have < slots")
             .select("no", F.explode(F.sequence(F.col("have"), F.col("slots") - 1)).alias("rank"))
             .select("no", "rank", (F.lit(n_slots) + F.col("rank")).alias("slot")))
    return kept.unionByName(short)


def shuffled(sizes: DataFrame, seed: str = SEED) -> DataFrame:
    """``sizes`` (row, doc_id, size, no) with ``at``: the words of the source's
    documents before it, in the order of a hash of doc_id."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = sizes.withColumn("key", key).withColumn("range", F.substring("key", 1, 3))
    sums = rows.groupBy("no", "range").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("no").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("no", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    inside = (Window.partitionBy("no", "range").orderBy("key", "doc_id", "size", "row")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (rows.join(offsets, ["no", "range"])
            .withColumn("at", F.col("first") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .drop("key", "range", "first"))


def mix(documents: DataFrame, weights=WEIGHTS, max_passes: int = MAX_PASSES, seed: str = SEED) -> DataFrame:
    """doc_id, size, source, source_size, target, taken for every row, and its place in the
    schedule: first_slot, last_slot (null if none takes it) and n_slots."""
    sizes = written(documents.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.col("source").cast("string").alias("source"),
        count_words(F.col("text")).alias("size")), "sizes")
    sources = written(source_targets(sizes, weights, max_passes), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    block = slot_words(total)
    slots = schedule(sources, block)
    own = sizes.join(small(sources), sizes["source"].eqNullSafe(sources["source"])).select(
        "row", "doc_id", sizes["source"], "size", "no", "source_size", "target", "words")
    placed = shuffled(own, seed)
    # A document's words in each pass over its source, as far as the source's words reach.
    passes = F.when((F.col("size") > 0) & (F.col("at") < F.col("words")), F.sequence(
        F.lit(0).cast("bigint"), F.floor((F.col("words") - F.col("at") - 1) / F.col("source_size"))))
    begin = F.col("at") + F.col("pass") * F.col("source_size")
    laid = (placed.select("*", F.explode_outer(passes).alias("pass"))
            .withColumn("begin", begin).withColumn("end", F.least(begin + F.col("size"), F.col("words")))
            .select("*", F.explode_outer(F.when(F.col("begin").isNotNull(), F.sequence(
                F.floor(F.col("begin") / block), F.floor((F.col("end") - 1) / block)))).alias("rank")))
    piece = F.least("end", (F.col("rank") + 1) * block) - F.greatest("begin", F.col("rank") * block)
    met = laid.join(slots.select("no", "rank", "slot"), ["no", "rank"], "left")
    return met.groupBy("row").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "size", "source", "source_size", "target")],
        F.coalesce(F.sum(F.when(F.col("slot").isNotNull(), piece)), F.lit(0)).alias("taken"),
        F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot"), F.count("slot").alias("n_slots")).drop("row")


def oracle_sql() -> str:
    """DuckDB SQL for ``mix`` over ``documents``, with the module's slot sizes."""
    return rf"""
WITH s AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS no
  FROM s GROUP BY source),
w AS (SELECT *, CASE (no - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM src),
-- The water level: of all ways to let some sources stop, the one whose level is between them.
c AS (
  SELECT w.*, (SELECT sum(source_size) FROM w) AS total, (SELECT sum(weight) FROM w) AS weights,
    coalesce((SELECT sum(3 * x.source_size) FROM w x WHERE (x.source_size / x.weight, x.no) < (w.source_size / w.weight, w.no)), 0) AS s0,
    coalesce((SELECT sum(x.weight) FROM w x WHERE (x.source_size / x.weight, x.no) < (w.source_size / w.weight, w.no)), 0) AS w0
  FROM w),
f AS (SELECT *, weight * (total - s0) >= 3 * source_size * (weights - w0) AS above FROM c),
g AS (
  SELECT *, NOT EXISTS (SELECT 1 FROM f x WHERE NOT x.above
    AND (x.source_size / x.weight, x.no) <= (f.source_size / f.weight, f.no)) AS stops FROM f),
t AS (
  SELECT source, no, source_size, CASE WHEN stops THEN CAST(3 * source_size AS DOUBLE) ELSE
    CAST(weight * (total - coalesce((SELECT sum(3 * source_size) FROM g WHERE stops), 0)) AS DOUBLE)
    / CAST(weights - coalesce((SELECT sum(weight) FROM g WHERE stops), 0) AS DOUBLE) END AS target FROM g),
u AS (SELECT *, least(CAST(round(target) AS BIGINT), 3 * source_size) AS words FROM t),
p AS (
  SELECT row_number() OVER () AS rid, doc_id, s.source, no, size, source_size, target, words,
    CAST(sum(size) OVER (PARTITION BY s.source ORDER BY md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id, size
      ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS pos
  FROM s JOIN u ON s.source IS NOT DISTINCT FROM u.source),
b AS (SELECT CAST(greatest(1, least({SLOT_WORDS}, coalesce(sum(source_size), 0) // {MIN_SLOTS})) AS BIGINT) AS words FROM src),
-- The schedule: every source's part of the circle, the points that fall into it, and what they leave short.
par AS (
  SELECT no, CAST(floor((upto - words) / total * {_CIRCLE}) AS BIGINT) AS lo, CAST(floor(upto / total * {_CIRCLE}) AS BIGINT) AS hi, slots
  FROM (SELECT no, words, CAST(sum(words) OVER (ORDER BY no) AS BIGINT) AS upto, CAST(sum(words) OVER () AS BIGINT) AS total,
      CAST(ceil(words / (SELECT words FROM b)) AS BIGINT) AS slots FROM u WHERE words > 0)),
points AS (
  SELECT k AS slot, k % 2147483648 * {GOLDEN} % {_CIRCLE} AS point
  FROM range((SELECT coalesce(CAST(sum(slots) AS BIGINT), 0) FROM par)) r(k)),
drawn AS (
  SELECT no, slot, row_number() OVER (PARTITION BY no ORDER BY slot) - 1 AS rank, slots
  FROM points JOIN par ON point >= lo AND point < hi),
slots AS (
  SELECT no, rank, slot FROM drawn WHERE rank < slots
  UNION ALL SELECT no, r.rank, (SELECT count(*) FROM points) + r.rank
  FROM (SELECT no, slots, (SELECT count(*) FROM drawn d WHERE d.no = par.no) AS have FROM par),
    LATERAL (SELECT unnest(range(have, slots)) AS rank) r WHERE have < slots),
laid AS (
  SELECT rid, no, pos + turn * source_size AS first, least(pos + turn * source_size + size, words) AS last
  FROM p, LATERAL (SELECT unnest(range(0, (words - pos - 1) // source_size + 1)) AS turn) WHERE size > 0 AND pos < words),
met AS (
  SELECT rid, min(slot) AS first_slot, max(slot) AS last_slot, count(*) AS n_slots
  FROM (SELECT rid, no, unnest(range(first // (SELECT words FROM b), (last - 1) // (SELECT words FROM b) + 1)) AS rank FROM laid)
  JOIN slots USING (no, rank) GROUP BY rid)
SELECT doc_id, size, source, source_size, target, CAST(CASE WHEN source_size = 0 THEN 0 ELSE
  words // source_size * size + greatest(0, least(words % source_size - pos, size)) END AS BIGINT) AS taken,
  first_slot, last_slot, CAST(coalesce(n_slots, 0) AS BIGINT) AS n_slots
FROM p LEFT JOIN met USING (rid)
"""


ORACLE = oracle_sql()
