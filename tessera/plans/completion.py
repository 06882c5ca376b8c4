"""Completion queries.

Large form: dictionary = all tokens of ``documents``, inputs = all distinct
tokens of ``conversations``. ``complete_words`` reports the first ``TOP_K`` words of an
input (the ranking step's ``k``); ``matches_both_ways`` is the whole ranked list of every
input and marks the words that both directions found. Every other step is registered
without a limit, the words found by both directions too (``words_matched_both_ways``).
Keyword form: the last typed token of every conversation turn completed
against the keyword dictionary learned from ``documents``, full ranked list.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import last_token as last_token_expr
from tessera.operators import completion as C
from tessera.operators import keywords as kw
from tessera.plans import completion_sql as S
from tessera.plans.registry import query
from tessera.session import cut_lineage
from tessera.sources.tables import spread, table, text_table

#: ``k`` of the ranking step: how many completions of an input are reported.
TOP_K = 5


def learned_dictionary(spark, sf_dir):
    return kw.token_counts(text_table(spark, sf_dir, "documents", ["text"]), "text")


def conversation_inputs(spark, sf_dir):
    toks = kw.token_counts(text_table(spark, sf_dir, "conversations", ["text"]), "text")
    return C.prepare_inputs(toks, "word")


LARGE_BASE = f"{S.LEARNED_DICT_CTES},\n{S.CONV_INPUT_CTES}"


def _materialized(spark, sf_dir):
    """The learned dictionary feeds every dictionary-side table (prefixes,
    longest proper word prefix, index, nodes): it is written once to the
    shared checkpoint folder instead of re-tokenizing the corpus per use.
    The inputs are read once (both directions come from one explode) and
    only spread. Both are small after de-duplication, and adaptive execution
    packs them into one or two partitions; every word is then exploded into
    its prefixes, so they are spread to the cluster's parallelism first (a
    no-op once they have more partitions than that)."""
    return (spread(conversation_inputs(spark, sf_dir)),
            cut_lineage(spread(learned_dictionary(spark, sf_dir))))


@query("complete_words", S.completion_sql(LARGE_BASE, "learned_dict", TOP_K))
def complete_words(spark, sf_dir):
    inputs, d = _materialized(spark, sf_dir)
    r = C.complete_words(inputs, d, k=TOP_K)
    return r.withColumn("rank", F.col("rank").cast("bigint"))


@query("matches_both_ways", S.completion_sql(LARGE_BASE, "learned_dict", None, both=True))
def matches_both_ways(spark, sf_dir):
    # Both uses of the dictionary tables and of the inputs' matches read them as written.
    inputs, d = _materialized(spark, sf_dir)
    t = C.completion_tables(d, keep_m=True)
    matched = cut_lineage(C.longest_prefix_match(inputs, t))
    r = C.complete_words(inputs, d, tables=t, matched=matched).withColumn("rank", F.col("rank").cast("bigint"))
    arms, _ = C.relaxed_arms(matched)
    both = C.words_both_ways(arms, t, d.count()).select("q", "word", F.lit(True).alias("both"))
    return r.join(both, ["q", "word"], "left").select(
        "q", "rank", "word", "cou", F.coalesce("both", F.lit(False)).alias("both"))


KEYWORD_BASE = (f"{S.COMPLETION_DICT_CTES},\n{S.LAST_TOKEN_CTE},\n"
                "inputs as (select distinct lower(token) as q from last_tokens "
                "where token is not null and length(token) > 0)")


@query("rank_completions", S.completion_sql(KEYWORD_BASE, "completion_dict", None))
def rank_completions(spark, sf_dir):
    saved = kw.keyword_frequency(text_table(spark, sf_dir, "documents", ["text"]), "text", kw.reserved_words(spark))
    d = kw.completion_dictionary(spark, saved)
    typed = table(spark, sf_dir, "conversations").select(last_token_expr("text").alias("token"))
    r = C.complete_words(C.prepare_inputs(typed, "token"), d, k=None)
    return r.withColumn("rank", F.col("rank").cast("bigint"))


def _direction_sql(select: str) -> str:
    return (f"with {LARGE_BASE}{S.direction_ctes('h', 'learned_dict', False)}"
            f"{S.direction_ctes('t', 'learned_dict', True)}\n{select}")


def _direction_label():
    return F.when(F.col("dir") == C.HEAD, "head").otherwise("tail").alias("direction")


@query("prefix_nodes", _direction_sql(
    "select 'head' as direction, p from h_nodes union all select 'tail', p from t_nodes"))
def prefix_nodes(spark, sf_dir):
    t = C.completion_tables(learned_dictionary(spark, sf_dir))
    return t.nodes.select(_direction_label(), "p")


@query("minimal_completions", _direction_sql(
    "select 'head' as direction, p, word, cou from h_index "
    "union all select 'tail', p, word, cou from t_index"))
def minimal_completions(spark, sf_dir):
    t = C.completion_tables(learned_dictionary(spark, sf_dir))
    return t.index.select(_direction_label(), "p", "word", "cou")


def _one_direction(spark, sf_dir, d):
    t = C.completion_tables(learned_dictionary(spark, sf_dir), dirs=(d,))
    return C.longest_prefix_match(conversation_inputs(spark, sf_dir), t)


@query("longest_prefix_match", _direction_sql("select q, L from h_L"))
def longest_prefix_match(spark, sf_dir):
    m = _one_direction(spark, sf_dir, C.HEAD)
    return m.select("q", F.col("L").cast("bigint").alias("L"))


@query("relaxed_match", _direction_sql(
    "select a.q, a.p, s.pass from h_arms a join h_pass s using (q)"))
def relaxed_match(spark, sf_dir):
    arms, passes = C.relaxed_arms(_one_direction(spark, sf_dir, C.HEAD))
    return arms.join(passes, ["dir", "q"]).select("q", "p", F.col("pass").cast("bigint").alias("pass"))


@query("suffix_match", _direction_sql(
    "select a.q, reverse(a.p) as suffix, s.pass from t_arms a join t_pass s using (q)"))
def suffix_match(spark, sf_dir):
    arms, passes = C.relaxed_arms(_one_direction(spark, sf_dir, C.TAIL))
    return arms.join(passes, ["dir", "q"]).select("q", F.reverse("p").alias("suffix"),
                                                  F.col("pass").cast("bigint").alias("pass"))


@query("words_matched_both_ways", _direction_sql(
    "select distinct h.q, h.word, h.cou from h_cand h join t_cand t on t.q = h.q and t.word = h.word"))
def words_matched_both_ways(spark, sf_dir):
    inputs, d = _materialized(spark, sf_dir)
    t = C.completion_tables(d)
    arms, _ = C.relaxed_arms(C.longest_prefix_match(inputs, t))
    return C.words_both_ways(cut_lineage(arms), t, d.count())
