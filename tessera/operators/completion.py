"""Prefix / suffix word completion with one-character repair, ranked by count.

Semantics (per input word ``w``, lower-cased, in each direction: the words
as written for the head pass, reversed words and reversed input for the
tail pass):

1. ``L`` = length of the longest prefix of ``w`` that is a prefix of some
   dictionary word (a *node*); ``L = 0`` gives nothing.
2. Arms: ``w[:L]``, and also ``w[:L-1]`` when ``1 < L < len(w)`` (the last
   matched character may be a typo). The pass length is ``L-1`` in that case,
   else ``L``.
3. The completions of a prefix ``p`` are the words ``v`` that ``p`` properly
   prefixes with no other dictionary word strictly between ``p`` and ``v``.
   With ``m(v)`` the length of the longest dictionary word properly prefixing
   ``v``, ``v`` completes exactly the prefixes of length ``max(1, m(v))`` to
   ``len(v) - 1`` -- an *index* table built once from the dictionary.
4. Result = head completions, plus tail completions when the tail pass is
   strictly longer than the head pass; ordered by count descending, then word
   descending.

Everything is an equi join on (direction, prefix string): no trie, no
nested-loop or cartesian join, no per-row Python. Both directions travel
through the same joins and aggregates, told apart by a ``dir`` column
(0 = head, 1 = tail), so each step is one shuffle for both.

For a top-``k`` answer the index is cut to the top ``k`` words per prefix
first. This is exact: the top ``k`` of a union of candidate lists lies inside
the union of the top ``k`` of each list. The cut is done in two salted
stages so that a prefix shared by a third of the dictionary is never ranked
in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import prefixes
from tessera.session import cut_lineage

DEFAULT_SALT_BUCKETS = 16
HEAD, TAIL = 0, 1
BOTH = (HEAD, TAIL)


def top_k_per_key(df: DataFrame, key: list[str], order: list[Column], k: int, tiebreak: str,
                  salt_buckets: int = DEFAULT_SALT_BUCKETS) -> DataFrame:
    """Rows with rank <= k within ``key`` under ``order``, exact.

    Stage 1 ranks inside (key, salt) sub-groups, salt = hash of ``tiebreak``,
    keeping k per sub-group; stage 2 ranks the at most ``salt_buckets * k``
    survivors of every key. A hot key is thus split over ``salt_buckets``
    tasks before anything is ranked per key.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(F.col(tiebreak)), F.lit(salt_buckets)))
    w1 = Window.partitionBy(*key, "_salt").orderBy(*order)
    stage1 = salted.withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= k)
    w2 = Window.partitionBy(*key).orderBy(*order)
    return (stage1.drop("_r", "_salt").withColumn("_r", F.row_number().over(w2))
            .where(F.col("_r") <= k).drop("_r"))


def rank_order() -> list[Column]:
    """Count descending, then word descending."""
    return [F.col("cou").desc(), F.col("word").desc()]


@dataclass
class CompletionTables:
    nodes: DataFrame   # (dir, p): every prefix of every oriented dictionary word
    index: DataFrame   # (dir, p, word, cou): p -> its completions (word as written)
    m: DataFrame       # (dir, w, word, cou, m): longest proper dictionary prefix length
    dirs: tuple


def _oriented(df: DataFrame, col: str, out: str, dirs, keep: list[str]) -> DataFrame:
    """(dir, out, keep...) rows: ``col`` as written (head) and reversed (tail).

    One pass over ``df``: each row becomes one row per direction through an
    explode, so the input plan is read once, not once per direction.
    """
    variants = [F.struct(F.lit(d).alias("dir"),
                         (F.col(col) if d == HEAD else F.reverse(F.col(col))).alias(out))
                for d in dirs]
    return (df.select(*keep, F.explode(F.array(*variants)).alias("_o"))
            .select(F.col("_o.dir").alias("dir"), F.col(f"_o.{out}").alias(out), *keep))


def completion_tables(dictionary: DataFrame, k: int | None = None, dirs=BOTH,
                      salt_buckets: int = DEFAULT_SALT_BUCKETS, keep_m: bool = False) -> CompletionTables:
    """Dictionary-side tables (G5, G6). ``dictionary`` must hold one row per
    non-empty word: (word string, cou bigint). ``keep_m`` writes ``m`` once, for a
    caller that reads it beside the index."""
    d = _oriented(dictionary, "word", "w", dirs, ["word", "cou"])
    proper = (d.select("dir", "w", F.explode(prefixes("w", 1, F.length("w") - 1)).alias("x"))
              .select("dir", "w", F.col("x.i").alias("i"), F.col("x.p").alias("p")))
    # m(v): the longest proper prefix of v that is itself a dictionary word. The words are
    # evenly spread and far fewer than their prefixes, so these are probed, not sorted.
    m = (proper.join(d.select("dir", F.col("w").alias("p")).hint("shuffle_hash"), ["dir", "p"], "left_semi")
         .groupBy("dir", "w").agg(F.max("i").alias("m")))
    dm = d.join(m, ["dir", "w"], "left").withColumn("m", F.coalesce(F.col("m"), F.lit(0)))
    dm = cut_lineage(dm) if keep_m else dm
    index = (dm.select("dir", "word", "cou", F.explode(
                prefixes("w", F.greatest(F.lit(1), F.col("m")), F.length("w") - 1)).alias("x"))
             .select("dir", F.col("x.p").alias("p"), "word", "cou"))
    if k is not None:
        index = top_k_per_key(index, ["dir", "p"], rank_order(), k, "word", salt_buckets)
    nodes = (d.select("dir", F.explode(prefixes("w", 1, F.length("w"))).alias("x"))
             .select("dir", F.col("x.p").alias("p")).distinct())
    return CompletionTables(nodes=nodes, index=index, m=dm, dirs=tuple(dirs))


def longest_prefix_match(inputs: DataFrame, t: CompletionTables) -> DataFrame:
    """(dir, q, x, L) for inputs with L >= 1 (G7, G9); ``x`` is q oriented."""
    qx = _oriented(inputs, "q", "x", t.dirs, ["q"])
    qp = (qx.select("dir", "q", "x", F.explode(prefixes("x", 1, F.length("x"))).alias("y"))
          .select("dir", "q", "x", F.col("y.i").alias("i"), F.col("y.p").alias("p")))
    # The prefix is the first key: a sort on the direction first tells no two rows apart.
    return (qp.join(t.nodes, ["p", "dir"], "left_semi")
            .groupBy("dir", "q", "x").agg(F.max("i").alias("L")))


def relaxed_arms(matched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Arms (dir, q, p) and pass length (dir, q, pass) per input."""
    relax = (F.col("L") > 1) & (F.col("L") < F.length("x"))
    arms = (matched.select("dir", "q", "x", F.explode(
                F.when(relax, F.array(F.col("L"), F.col("L") - 1)).otherwise(F.array(F.col("L"))))
                .alias("j"))
            .select("dir", "q", F.substring("x", F.lit(1), F.col("j")).alias("p")))
    passes = matched.select("dir", "q",
                            F.when(relax, F.col("L") - 1).otherwise(F.col("L")).alias("pass"))
    return arms, passes


def prepare_inputs(raw: DataFrame, col: str) -> DataFrame:
    """Distinct, lower-cased, non-empty input words (q)."""
    return (raw.select(F.lower(F.col(col)).alias("q")).where(F.col("q").isNotNull()
            & (F.length("q") > 0)).distinct())


def complete_words(inputs: DataFrame, dictionary: DataFrame, k: int | None = None,
                   tables: CompletionTables | None = None,
                   salt_buckets: int = DEFAULT_SALT_BUCKETS,
                   matched: DataFrame | None = None) -> DataFrame:
    """(q, rank, word, cou): ranked completions of every input word.

    ``inputs`` has a column ``q`` (see ``prepare_inputs``); ``k`` keeps the
    first k per input (None = the whole list). ``matched``: the inputs'
    ``longest_prefix_match`` with ``tables``, if it is at hand.
    """
    t = tables or completion_tables(dictionary, k, BOTH, salt_buckets)
    arms, passes = relaxed_arms(longest_prefix_match(inputs, t) if matched is None else matched)
    # Tail candidates count only where the tail matched strictly longer:
    # one aggregate over both directions' pass lengths.
    use_tail = passes.groupBy("q").agg(
        (F.coalesce(F.max(F.when(F.col("dir") == TAIL, F.col("pass"))), F.lit(0))
         > F.coalesce(F.max(F.when(F.col("dir") == HEAD, F.col("pass"))), F.lit(0)))
        .alias("use_tail"))
    cands = (arms.join(t.index, ["dir", "p"]).join(use_tail, "q")
             .where((F.col("dir") == HEAD) | F.col("use_tail")))
    # A word has one count, so dense_rank over (cou, word) numbers the distinct
    # words 1, 2, ...; duplicates (same word from several arms) share a rank
    # and are dropped after the window, on its partitioning (no new shuffle).
    ranked = cands.withColumn(
        "rank", F.dense_rank().over(Window.partitionBy("q").orderBy(*rank_order())))
    if k is not None:
        ranked = ranked.where(F.col("rank") <= k)
    return ranked.select("q", "rank", "word", "cou").distinct()


def matches_both_ways(ranked: DataFrame, dictionary: DataFrame,
                      tables: CompletionTables | None = None) -> DataFrame:
    """ranked (q, rank, word, cou) + ``both``: the word is a completion of one
    of q's arms in the head pass and in the tail pass (G13). Checked exactly
    per result row (prefix test against the arms and the longest dictionary
    prefix), so it holds also where ``tables`` has its index cut to the top k:
    neither nodes nor ``m`` depend on k."""
    t = tables or completion_tables(dictionary, None, BOTH)
    qs = ranked.select("q").distinct()
    arms, _ = relaxed_arms(longest_prefix_match(qs, t))
    hits = (ranked.select("q", "word").join(arms, "q")
            .join(t.m.select("dir", "word", "w", "m"), ["dir", "word"])
            .where(F.col("w").startswith(F.col("p")) & (F.length("p") < F.length("w"))
                   & (F.length("p") >= F.greatest(F.lit(1), F.col("m"))))
            .groupBy("q", "word").agg(F.countDistinct("dir").alias("_dirs")))
    return (ranked.join(hits, ["q", "word"], "left")
            .select("q", "rank", "word", "cou",
                    (F.coalesce(F.col("_dirs"), F.lit(0)) == 2).alias("both")))


def ranked_words(words: DataFrame, boundaries: DataFrame) -> DataFrame:
    """``boundaries`` (dir, b binary, kept columns) and ``words`` (dir, w, kept columns) in
    one order of bytes per direction: (dir, word?, rank, kept columns), where rank is the
    number of words of the direction before the row.

    Rows are range-partitioned and sorted once; a partition counts its words by itself
    and adds the counts of the partitions before it, which is one row a partition.
    """
    keep_w, keep_b = [[c for c in df.columns if c not in own] for df, own in
                      ((words, ("dir", "w")), (boundaries, ("dir", "b")))]
    rows = words.select("dir", F.encode("w", "UTF-8").alias("b"), F.lit(True).alias("is_word"), *keep_w).unionByName(
        boundaries.select("dir", "b", F.lit(False).alias("is_word"), *keep_b), allowMissingColumns=True)
    # A boundary that equals a word stands before it.
    order = ["dir", "b", "is_word"]
    n = max(1, int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = cut_lineage(rows.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()))
    inside = Window.partitionBy("part", "dir").orderBy("b", "is_word").rowsBetween(Window.unboundedPreceding, -1)
    own = placed.withColumn("before", F.coalesce(F.sum(F.col("is_word").cast("bigint")).over(inside), F.lit(0)))
    counts = placed.groupBy("part", "dir").agg(F.sum(F.col("is_word").cast("bigint")).alias("n"))
    earlier = Window.partitionBy("dir").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "dir", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    return (own.join(F.broadcast(offsets), ["part", "dir"])  # one row a partition and direction
            .select("dir", "is_word", (F.col("before") + F.col("offset")).alias("rank"), *dict.fromkeys(keep_w + keep_b)))


def words_both_ways(arms: DataFrame, t: CompletionTables, words: int | None = None) -> DataFrame:
    """(q, word, cou): every word that completes one of q's ``arms`` in the head
    pass and one in the tail pass (G13), without a limit.

    Words are ranked once as written and once reversed. The words that a prefix begins
    are an interval of ranks, so an input's pair of arms is a rectangle and a word is a
    point. Both meet in the cells of a grid of equal depth: a word is in one cell, a
    rectangle in those it covers. No prefix of a word is formed. ``words``: size of the
    dictionary, if known.
    """
    n = t.m.where(F.col("dir") == t.dirs[0]).count() if words is None else words
    # About as many words a cell as cells an axis has.
    step = max(1, round(n ** (2 / 3) / 2))
    prefix = arms.select("dir", "p").distinct()
    end = F.encode("p", "UTF-8")
    # No UTF-8 text has the byte FF, so p and FF is after all that p begins.
    bounds = prefix.select("dir", "p", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), end.alias("b")),
        F.struct(F.lit(1).alias("side"), F.concat(end, F.lit(b"\xff")).alias("b")))).alias("e")).select(
        "dir", "p", F.col("e.side").alias("side"), F.col("e.b").alias("b"))
    ranked = ranked_words(t.m.select("dir", "w", "word", "cou", "m"), bounds)
    interval = (ranked.where(~F.col("is_word")).groupBy("dir", "p")
                .agg(F.min("rank").alias("lo"), F.max("rank").alias("hi")).where("lo < hi"))
    at = lambda c, d: F.max(F.when(F.col("dir") == d, F.col(c)))
    points = (ranked.where("is_word").groupBy("word", "cou").agg(
        *[at(c, d).alias(f"{c}{d}") for d in BOTH for c in ("rank", "m")])
        .withColumns({f"c{d}": F.floor(F.col(f"rank{d}") / step) for d in BOTH}))
    own = arms.join(interval, ["dir", "p"])
    side = lambda d: own.where(F.col("dir") == d).select(
        "q", F.length("p").alias(f"n{d}"), F.col("lo").alias(f"lo{d}"), F.col("hi").alias(f"hi{d}"))
    cells = lambda d: F.explode(F.sequence(F.floor(F.col(f"lo{d}") / step),
                                           F.floor((F.col(f"hi{d}") - 1) / step))).alias(f"c{d}")
    asked = side(HEAD).join(side(TAIL), "q")
    # Inputs with the same pair of arms share a rectangle.
    shape = [f"{c}{d}" for d in BOTH for c in ("n", "lo", "hi")]
    covered = asked.select(*shape).distinct().select("*", cells(HEAD)).select("*", cells(TAIL))
    inside = [(F.col(f"rank{d}") >= F.col(f"lo{d}")) & (F.col(f"rank{d}") < F.col(f"hi{d}"))
              & (F.col(f"n{d}") >= F.col(f"m{d}")) & (F.col(f"n{d}") < F.length("word")) for d in BOTH]
    found = covered.join(points, ["c0", "c1"]).where(inside[0] & inside[1]).select(*shape, "word", "cou")
    return asked.join(found, shape).select("q", "word", "cou").distinct()
