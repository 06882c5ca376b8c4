"""Benchmark decontamination by a prefix-filtered set join (operator 2).

Words are runs of ASCII letters and digits (A-Z lower-cased) and of all
characters beyond ASCII. A window is ``window`` consecutive words of an item; an
item of fewer words, but not none, is one window. A document's word is hit when
it lies in an occurrence of any window.

1. *Order by rarity*: occurrences of the items' words are counted over the whole
   corpus.
2. *Prefix*: a window occurs only where all its words do, so a prefix of one
   token, its rarest word (the anchor), is necessary. Only document words that
   are anchors leave their row, each with the words around it.
3. *Bounds*: an anchor at position p stands for a window starting at
   p - offset. The window must start at or after 0, and end within the document.
4. *Verify*: the window's words are compared with the document's.

All steps are DataFrame functions. The anchors are put into the plan as a set
when there are at most ``MAX_INLINE``; more of them are looked up by a join
over all words instead (slower, same rows).

Null or wordless texts have no words, no hits and are not contaminated. Items
without words have no windows. An item without an id hits words but is not
named. Repeated rows each get their result; repeated item_ids count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ascii_lower, small, written

WINDOW = 13
#: A document is contaminated if one word in so many is hit.
HIT_SHARE = 20
MAX_INLINE = 20_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """(words, items): every distinct window and the ids of the items that have it."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w"))
    last = F.greatest(F.size("w") - window, F.lit(0))
    starts = F.when(F.size("w") > 0, F.sequence(F.lit(0), last))
    return (rows.select("item", "w", F.explode(starts).alias("at"))
            .select("item", F.slice("w", F.col("at") + 1, window).alias("words"))
            .groupBy("words").agg(F.collect_set("item").alias("items")))


def word_counts(tokens: DataFrame, wanted: DataFrame) -> DataFrame:
    """(word, n): occurrences in ``tokens`` (w array) of the words in ``wanted``."""
    if wanted.count() <= MAX_INLINE:
        listed = [r["word"] for r in wanted.collect()]
        own = tokens.select(F.explode(F.filter("w", lambda x: x.isin(listed))).alias("word")) if listed \
            else tokens.select(F.explode("w").alias("word")).limit(0)
        return own.groupBy("word").agg(F.count("*").alias("n"))
    return (tokens.select(F.explode("w").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
            .join(wanted, "word", "left_semi"))


def anchored(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Windows with their rarest word and its first place in them."""
    rarity = F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("word"), F.col("offset"))
    return (windows.select("words", "items", F.posexplode("words").alias("offset", "word"))
            .join(counts, "word", "left")
            .groupBy("words").agg(F.min(rarity).alias("rarest"), F.first("items").alias("items"))
            .select("words", "items", F.col("rarest.word").alias("anchor"), F.col("rarest.offset").alias("offset"),
                    F.size("words").alias("length")))


def covered(intervals: Column) -> Column:
    """Words in the union of sorted (start, end) intervals."""
    return F.aggregate(
        intervals, F.struct(F.lit(0).alias("hit"), F.lit(0).alias("upto")),
        lambda acc, x: F.struct(
            (acc["hit"] + F.greatest(F.lit(0), x["end"] - F.greatest(acc["upto"], x["start"]))).alias("hit"),
            F.greatest(acc["upto"], x["end"]).alias("upto")),
        lambda acc: acc["hit"])


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  hit_share: int = HIT_SHARE) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row."""
    tokens = documents.select("doc_id", words(F.col("text")).alias("w"))
    windows = written(item_windows(benchmark, window), "windows")
    vocabulary = written(windows.select(F.explode("words").alias("word")).distinct(), "item-words")
    counts = written(word_counts(tokens, vocabulary), "item-word-counts")
    found = written(anchored(windows, counts), "anchored")
    anchors = found.select("anchor").distinct()
    n_anchors = anchors.count()
    listed = [r["anchor"] for r in anchors.collect()] if n_anchors <= MAX_INLINE else None

    # Each candidate: an anchor's position and up to window - 1 words on either side.
    places = F.transform("w", lambda x, i: F.struct(x.alias("word"), i.alias("at")))
    if listed is not None:
        places = F.filter(places, lambda p: p["word"].isin(listed) if listed else F.lit(False))
    begin = lambda p: F.greatest(p["at"] - (window - 1), F.lit(0))
    around = F.transform(places, lambda p: F.struct(
        p["word"].alias("word"), p["at"].alias("at"),
        F.slice(F.col("w"), begin(p) + 1, 2 * window - 1).alias("near")))
    rows = tokens.select(F.monotonically_increasing_id().alias("row"), "doc_id", "w").select(
        "row", "doc_id", F.size("w").alias("n_words"), F.explode_outer(around).alias("c"))
    start = F.col("c.at") - F.col("offset")
    inside = F.least(F.col("c.at"), F.lit(window - 1)) - F.col("offset")
    occurs = ((start >= 0) & (start + F.col("length") <= F.col("n_words")) &
              (F.when(inside >= 0, F.slice("c.near", F.greatest(inside, F.lit(0)) + 1, F.col("length")))
               == F.col("words")))
    tested = rows.join(small(found), F.col("c.word") == F.col("anchor"), "left")
    hit = F.when(occurs, F.struct(start.alias("start"), (start + F.col("length")).alias("end")))
    result = tested.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").cast("bigint").alias("n_words"),
        F.array_sort(F.collect_set(hit)).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(occurs, F.col("items")))))).alias("items"))
    n_hit = covered(F.col("hits")).cast("bigint")
    return (result.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                          F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (hit_share * F.col("n_hit") >= F.col("n_words"))))


def uncontaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                   hit_share: int = HIT_SHARE) -> DataFrame:
    """The rows of ``documents``, all columns, that are not contaminated."""
    key = F.struct(F.col("doc_id"), F.xxhash64("text").alias("text_hash"))
    judged = decontaminate(documents.select(key.alias("doc_id"), "text"), benchmark, window, hit_share)
    gone = written(judged.where("contaminated").select(
        F.col("doc_id.doc_id").alias("_gone_id"), F.col("doc_id.text_hash").alias("_gone_hash")).distinct(), "contaminated")
    same = F.col("doc_id").eqNullSafe(F.col("_gone_id")) & (F.xxhash64("text") == F.col("_gone_hash"))
    return documents.join(small(gone), same, "left_anti")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
it AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[s + 1 : s + 13], ' ') AS t
  FROM (SELECT item, w, unnest(range(greatest(len(w) - 12, 1))) AS s FROM it WHERE len(w) > 0)),
dw AS (
  SELECT rid, n, s, array_to_string(w[s + 1 : s + n], ' ') AS t
  FROM (SELECT rid, w, n, unnest(range(len(w) - n + 1)) AS s
        FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT rid, s, n, item FROM dw JOIN win USING (n, t)),
words AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT rid, s, n FROM hit)) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT rid, item FROM hit WHERE item IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""
