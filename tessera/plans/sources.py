"""Source queries over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import keywords as kw
from tessera.plans import completion_sql as S
from tessera.plans.registry import query
from tessera.session import scratch_path
from tessera.sources import datagen as G
from tessera.sources import json_events as J
from tessera.sources import text_files as TF
from tessera.sources.tables import table, text_table


@query("json_event_scan", """
select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events""")
def json_event_scan(spark, sf_dir):
    ev = J.parse_json(table(spark, sf_dir, "events"), "props", "k bigint")
    return ev.select("event_id", F.col("parsed.k").alias("k"))


# Damage rule: payloads of 'error' events lose their closing brace.
DAMAGED = "case when event_type = 'error' then substr(props, 1, length(props) - 1) else props end"


@query("json_bad_rows", f"""
select event_id,
       case when json_valid(p) then cast(json_extract_string(p, '$.k') as bigint) end as k,
       not json_valid(p) as bad
from (select event_id, {DAMAGED} as p from events)""")
def json_bad_rows(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", F.expr(DAMAGED).alias("p"))
    parsed = J.parse_json(ev, "p", "k bigint")
    return parsed.select("event_id", F.col("parsed.k").alias("k"),
                         F.col(f"parsed.{J.CORRUPT}").isNotNull().alias("bad"))


# The generator of the reference sample table: user_id INT 1..10, cost DOUBLE
# 1..100, plus a sequence and a short text; one row per order (ids = keys).
GEN_FIELDS = [
    G.Field("order_number", "BIGINT", kind="sequence", min=1),
    G.Field("user_id", "INT", min=1, max=10),
    G.Field("cost", "DOUBLE", min=1, max=100),
    G.Field("tag", "STRING", length=8),
]


# One step of the published generator x -> (1103515245 x + 12345) mod 2^31 from the
# order key plus 7919 times the field's place; a value is its share of 2^31.
@query("datagen_source", """
with steps as (
  select o_orderkey as id, (o_orderkey + 7919) % 2147483648 * 1103515245 + 12345 as u,
    (o_orderkey + 15838) % 2147483648 * 1103515245 + 12345 as c, (o_orderkey + 23757) % 2147483648 * 1103515245 + 12345 as t
  from orders)
select id, id + 1 as order_number, cast(1 + floor((u % 2147483648) / 2147483648 * 10) as integer) as user_id,
  1 + floor((c % 2147483648) / 2147483648 * 1000000) / 1000000 * 99 as cost,
  left(md5(cast(t % 2147483648 as varchar)), 8) as tag
from steps""")
def datagen_source(spark, sf_dir):
    return G.generate_from_ids(table(spark, sf_dir, "orders"), "o_orderkey", GEN_FIELDS)


@query("corpus_lines", """
select doc_id, cast(generate_subscripts(string_split(text, chr(10)), 1) as bigint) as line_no,
       unnest(string_split(text, chr(10))) as line
from documents""")
def corpus_lines(spark, sf_dir):
    return TF.lines_of(text_table(spark, sf_dir, "documents", ["doc_id", "text"]), "text", ["doc_id"])


@query("freq_dict_roundtrip", f"with {S.KEYWORD_FREQ_CTES}\nselect word, cou from keyword_freq")
def freq_dict_roundtrip(spark, sf_dir):
    freq = kw.keyword_frequency(text_table(spark, sf_dir, "documents", ["text"]), "text",
                                kw.reserved_words(spark))
    path = scratch_path(spark, "freq-dict")
    TF.write_freq_dict(freq, path)
    return TF.read_freq_dict(spark, path)


@query("corpus_scan", """
select lang, count(*) as lines, cast(sum(length(line)) as bigint) as chars
from (select lang, unnest(string_split(text, chr(10))) as line from documents)
group by lang""")
def corpus_scan(spark, sf_dir):
    # The documents as a folder tree of text files (one folder per language),
    # then a recursive scan of the whole tree.
    path = scratch_path(spark, "corpus")
    TF.write_corpus(text_table(spark, sf_dir, "documents", ["lang", "text"]), "text", path, "lang")
    lines = TF.corpus_scan(spark, path)
    return (lines.withColumn("lang", F.regexp_extract("file", r"/lang=([^/]+)/", 1))
            .groupBy("lang").agg(F.count(F.lit(1)).alias("lines"),
                                 F.sum(F.length("line")).cast("bigint").alias("chars")))
