"""Keyword queries over ``documents`` / ``conversations``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import last_token as last_token_expr
from tessera.operators import keywords as kw
from tessera.plans import completion_sql as S
from tessera.plans.registry import query
from tessera.sources.tables import table, text_table


@query("tokenize", f"""with {S.tokens_cte('doc_tokens', 'documents', 'text')}
select word, count(*) as n from doc_tokens group by word""")
def tokenize(spark, sf_dir):
    toks = kw.tokenize(text_table(spark, sf_dir, "documents", ["text"]), "text")
    return toks.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("keyword_filter", f"""with {S.KEYWORDS_CTE}, {S.tokens_cte('doc_tokens', 'documents', 'text')}
select word, count(*) as n from doc_tokens where word in (select word from keywords)
group by word""")
def keyword_filter(spark, sf_dir):
    toks = kw.tokenize(text_table(spark, sf_dir, "documents", ["text"]), "text")
    return (kw.keyword_filter(toks, kw.reserved_words(spark))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


@query("keyword_frequency", f"with {S.KEYWORD_FREQ_CTES}\nselect word, cou from keyword_freq")
def keyword_frequency(spark, sf_dir):
    return kw.keyword_frequency(text_table(spark, sf_dir, "documents", ["text"]), "text", kw.reserved_words(spark))


@query("merge_dictionaries", f"with {S.COMPLETION_DICT_CTES}\nselect word, cou from completion_dict")
def merge_dictionaries(spark, sf_dir):
    saved = kw.keyword_frequency(text_table(spark, sf_dir, "documents", ["text"]), "text", kw.reserved_words(spark))
    return kw.completion_dictionary(spark, saved)


@query("learned_dictionary", f"with {S.LEARNED_DICT_CTES}\nselect word, cou from learned_dict")
def learned_dictionary(spark, sf_dir):
    return kw.token_counts(text_table(spark, sf_dir, "documents", ["text"]), "text")


@query("last_token", f"with {S.LAST_TOKEN_CTE}\nselect conv_id, turn, token from last_tokens")
def last_token(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", last_token_expr("text").alias("token"))
