"""Metadata-driven table queries over test tables.

At scale the metadata of an estate is itself large; ``lineitem`` stands in as
entity-attribute-value rows: table = order, option key = line number, value =
part key.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import types as TY
from tessera.operators import catalog as CAT
from tessera.plans.registry import query
from tessera.sources.metadata import Metadata
from tessera.sources.tables import table


def lineitem_metadata(spark, sf_dir) -> Metadata:
    """The three metadata tables of the stand-in estate, all derived from one
    reduction of ``lineitem`` to a row per (table, key): table = order, key =
    line number, value = the largest part key of that line."""
    li = table(spark, sf_dir, "lineitem")
    pairs = li.groupBy(
        F.col("l_orderkey").alias("table_id"),
        F.concat(F.lit("line_"), F.col("l_linenumber").cast("string")).alias("key")).agg(
        F.max(F.col("l_partkey").cast("string")).alias("value"))
    dbs = pairs.select("table_id").distinct().select(
        "table_id", F.lit("lineitem").alias("db_name"),
        F.concat(F.lit("order_"), F.col("table_id").cast("string")).alias("table_name"),
        F.lit(None).cast("string").alias("comment"))
    cols = pairs.select("table_id", F.lit(0).alias("schema_root"), F.col("key").alias("schema_name"),
                        F.lit("BIGINT").alias("schema_type"), F.lit(None).cast("string").alias("comment"))
    return Metadata(dbs, pairs, cols)


@query("table_definitions", """
with opts as (select l_orderkey as table_id, 'line_' || l_linenumber as key,
                     max(cast(l_partkey as varchar)) as value
              from lineitem group by 1, 2)
select table_id, 'order_' || table_id as table_name, count(*) as column_count,
       count(*) as option_count, string_agg(key || '=' || value, ',' order by key) as options_text,
       string_agg(key || ' BIGINT', ',' order by key) as columns_text
from opts group by table_id""")
def table_definitions(spark, sf_dir):
    d = CAT.table_definitions(lineitem_metadata(spark, sf_dir))
    return d.select("table_id", "table_name", F.size("columns").cast("bigint").alias("column_count"),
                    F.size(F.map_keys("options")).cast("bigint").alias("option_count"),
                    CAT.options_text(F.col("options")).alias("options_text"),
                    F.array_join(F.transform("columns", lambda c: F.concat(c["schema_name"], F.lit(" "), c["schema_type"])),
                                 ",").alias("columns_text"))


# A nested declaration applied to JSON built from part rows; payloads of parts
# larger than 45 lose their closing brace (misfits set aside).
PART_TREE = ('{"type":"STRUCT","field":['
             '{"name":"tags","type":"ARRAY","next":{"type":"STRING"}},'
             '{"name":"attrs","type":"MAP","key":{"type":"STRING"},"value":{"type":"INTEGER"}},'
             '{"name":"info","type":"STRUCT","field":[{"name":"name","type":"STRING"},'
             '{"name":"price","type":"DECIMAL(12,2)"}]}]}')


@query("nested_json_conformance", """
with j as (select p_partkey, p_size,
    json_object('tags', json_array(p_brand, p_type), 'attrs', json_object('size', p_size),
                'info', json_object('name', p_name, 'price', p_retailprice)) :: varchar as raw
  from part),
d as (select p_partkey, case when p_size > 45 then substr(raw, 1, length(raw) - 1)
    when p_size = 1 then raw || ',"x":2' when p_size = 2 then raw || ',"v":{"tags":["a","b"]}'
    when p_size = 3 then 'null' when p_size = 4 then raw || '}' else raw end as raw
  from j)
select p_partkey,
       case when json_valid(raw) then json_extract_string(raw, '$.tags[1]') end as second_tag,
       case when json_valid(raw) then cast(json_extract(raw, '$.attrs.size') as integer) end as size,
       case when json_valid(raw) then json_extract_string(raw, '$.info.name') end as name,
       case when json_valid(raw) then cast(cast(json_extract(raw, '$.info.price') as double)
            as decimal(12,2)) end as price,
       not json_valid(raw) or raw = 'null' as bad
from d""")
def nested_json_conformance(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    raw = F.to_json(F.struct(
        F.array("p_brand", "p_type").alias("tags"),
        F.create_map(F.lit("size"), F.col("p_size")).alias("attrs"),
        F.struct(F.col("p_name").alias("name"), F.col("p_retailprice").alias("price")).alias("info")))
    j = p.select("p_partkey", "p_size", raw.alias("_raw"))
    # Cut texts, texts with more behind their value, and a bare null do not conform.
    after = {1: ',"x":2', 2: ',"v":{"tags":["a","b"]}', 4: "}"}
    broken = F.when(F.col("p_size") > 45, F.expr("substr(_raw, 1, length(_raw) - 1)")).when(
        F.col("p_size") == 3, "null")
    for size, text in after.items():
        broken = broken.when(F.col("p_size") == size, F.concat("_raw", F.lit(text)))
    j = j.select("p_partkey", broken.otherwise(F.col("_raw")).alias("raw"))
    c = TY.conform_json(j, "raw", PART_TREE)
    v = F.col("value")
    return c.select("p_partkey", F.element_at(v["tags"], 2).alias("second_tag"),
                    v["attrs"]["size"].alias("size"), v["info"]["name"].alias("name"),
                    v["info"]["price"].alias("price"), F.col("value_bad").alias("bad"))


@query("table_overlay", """
select event_id, event_time, make_timestamp((event_time // 1000) * 1000000) as ts
from (select event_id, epoch_us(ts) // 1000 as event_time from events)""")
def table_overlay(spark, sf_dir):
    # The demo overlay: epoch milliseconds, a computed event time and a
    # 5-second watermark on it, over events as the declared table.
    base = table(spark, sf_dir, "events").select(
        "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("event_time"))
    ov = CAT.Overlay(
        computed={"ts": "to_timestamp(from_unixtime(event_time div 1000, 'yyyy-MM-dd HH:mm:ss'))"},
        watermark=("ts", "5 seconds"), columns=["event_time", "ts"])
    view = CAT.table_overlay(base, ov)
    return view.select("event_id", "event_time", F.col("ts").cast("timestamp_ntz").alias("ts"))


# Declared columns of lineitem: some agree, some only cast, one cannot cast,
# one is missing from the data, one is not a supported type.
LINEITEM_DECLARED = [
    ("l_orderkey", "BIGINT"), ("l_linenumber", "BIGINT"), ("l_quantity", "DECIMAL(12, 2)"),
    ("l_returnflag", "INTEGER"), ("l_shipdate", "TIMESTAMP(3)"), ("l_discount", "TINYINT"),
    ("l_comment", "STRING"),
]

_CONFORMANCE_SQL = """
with declared(name, declared) as (values {values}),
resolved as (select name, declared,
  case regexp_extract(upper(trim(declared)), '^([A-Z_]+)', 1)
    when 'BIGINT' then 'bigint' when 'INTEGER' then 'int' when 'STRING' then 'string'
    when 'TIMESTAMP' then 'timestamp_ntz'
    when 'DECIMAL' then 'decimal(' || regexp_extract(declared, '\\(\\s*(\\d+)', 1) || ',' ||
                        regexp_extract(declared, ',\\s*(\\d+)', 1) || ')'
  end as spark_type from declared),
types as (select {type_aggs} from lineitem),
actual_raw as ({type_rows}),
actual as (select name,
  case data_type when 'BIGINT' then 'bigint' when 'INTEGER' then 'int' when 'DOUBLE' then 'double'
    when 'VARCHAR' then 'string' when 'TIMESTAMP' then 'timestamp_ntz' end as actual_type
  from actual_raw),
fails(name, cast_failures) as (
  select 'l_orderkey', count_if(l_orderkey is not null and try_cast(l_orderkey as bigint) is null) from lineitem
  union all select 'l_linenumber', count_if(l_linenumber is not null and try_cast(l_linenumber as bigint) is null) from lineitem
  union all select 'l_quantity', count_if(l_quantity is not null and try_cast(l_quantity as decimal(12,2)) is null) from lineitem
  union all select 'l_returnflag', count_if(l_returnflag is not null and try_cast(l_returnflag as integer) is null) from lineitem
  union all select 'l_shipdate', count_if(l_shipdate is not null and try_cast(l_shipdate as timestamp) is null) from lineitem),
j as (select coalesce(r.name, a.name) as name, r.declared, r.spark_type, a.actual_type
  from resolved r full join actual a on r.name = a.name)
select j.name, j.declared, j.spark_type, j.actual_type, cast(f.cast_failures as bigint) as cast_failures,
  case when j.actual_type is null then 'declared only' when j.declared is null then 'undeclared'
       when j.spark_type is null then 'unsupported declaration'
       when j.spark_type = j.actual_type then 'same'
       when coalesce(f.cast_failures, 0) = 0 then 'castable' else 'cast failures' end as status
from j left join fails f on j.name = f.name
"""


# Column types of the data as DuckDB reports them (typeof over the whole table).
LINEITEM_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                    "l_shipdate"]


@query("schema_conformance", _CONFORMANCE_SQL.format(
    values=", ".join(f"('{n}', '{t}')" for n, t in LINEITEM_DECLARED),
    type_aggs=", ".join(f"any_value(typeof({c})) as {c}" for c in LINEITEM_COLUMNS),
    type_rows=" union all ".join(f"select '{c}' as name, {c} as data_type from types"
                                 for c in LINEITEM_COLUMNS)))
def schema_conformance(spark, sf_dir):
    declared = spark.createDataFrame(LINEITEM_DECLARED, "name string, type_text string")
    return CAT.schema_conformance(spark, table(spark, sf_dir, "lineitem"), declared)


# ---- option rules over the stand-in estate ---------------------------------
# Option rows: the lineitem (table, key) pairs plus one connector key per
# order, named after its status (O -> kafka, F -> datagen, P -> jdbc, which
# is not a known connector).
CONNECTOR_OF_STATUS = "case o_orderstatus when 'O' then 'kafka' when 'F' then 'datagen' else 'jdbc' end"

_ESTATE_SQL = f"""
conn as (
  select l_orderkey as table_id, 'line_' || l_linenumber as key, max(cast(l_partkey as varchar)) as value
  from lineitem group by 1, 2
  union all
  select o_orderkey, 'connector', {CONNECTOR_OF_STATUS} from orders)"""


def estate_options(spark, sf_dir):
    pairs = lineitem_metadata(spark, sf_dir).conn_info
    conn = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("table_id"), F.lit("connector").alias("key"),
        F.expr(CONNECTOR_OF_STATUS).alias("value"))
    return pairs.unionByName(conn)


@query("connector_audit", f"""
with {_ESTATE_SQL}
select table_id, cast(count_if(key = 'connector') as bigint) as connectors,
       max(case when key = 'connector' then value end) as connector,
       case when count_if(key = 'connector') = 0 then 'no connector'
            when count_if(key = 'connector') > 1 then 'several connectors'
            when max(case when key = 'connector' then value end) not in ('kafka', 'datagen')
              then 'unknown connector'
            else 'ok' end as status
from conn group by table_id""")
def connector_audit(spark, sf_dir):
    return CAT.connector_audit(estate_options(spark, sf_dir))


# Of the keys in this estate only the connector's name is one of its own.
_OWN = "'connector'"


@query("option_prefix", f"""
with {_ESTATE_SQL},
c as (select table_id, max(case when key = 'connector' then value end) as connector
      from conn group by table_id)
select conn.table_id,
       case when c.connector = 'kafka' and conn.key not in ({_OWN})
                 and not starts_with(conn.key, 'properties.')
            then 'properties.' || conn.key else conn.key end as key,
       conn.value
from conn left join c on conn.table_id = c.table_id""")
def option_prefix(spark, sf_dir):
    conn = estate_options(spark, sf_dir)
    return CAT.option_prefix(conn, CAT.connector_audit(conn).select("table_id", "connector"))


@query("option_override", f"""
with {_ESTATE_SQL},
u as (select o_orderkey as table_id, 'line_1' as key, o_orderpriority as value from orders)
select coalesce(t.table_id, u.table_id) as table_id, coalesce(t.key, u.key) as key,
       coalesce(u.value, t.value) as value,
       case when u.value is not null then 'user' else 'template' end as source
from conn t full join u on t.table_id = u.table_id and t.key = u.key""")
def option_override(spark, sf_dir):
    # User options (priority as 'line_1') win over the declared ones.
    user = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("table_id"), F.lit("line_1").alias("key"),
        F.col("o_orderpriority").alias("value"))
    return CAT.option_override(estate_options(spark, sf_dir), user)


@query("overlay_options", f"""
with opts as (select l_orderkey as table_id, 'line_' || l_linenumber as key, max(cast(l_partkey as varchar)) as value
              from lineitem group by 1, 2),
u as (select o_orderkey as table_id, 'line_1' as key, o_orderpriority as value from orders
      union all select o_orderkey, 'status', o_orderstatus from orders),
merged as (select table_id, coalesce(o.key, u.key) as key, coalesce(u.value, o.value) as value
           from opts o full join (select u.* from u where table_id in (select table_id from opts)) u using (table_id, key))
select table_id, 'order_' || table_id as table_name, string_agg(key || '=' || value, ',' order by key) as options_text
from merged group by table_id""")
def overlay_options(spark, sf_dir):
    # Every order's table with the options its user adds: some replace, some are new.
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("table_id"), F.explode(F.map_from_arrays(
        F.array(F.lit("line_1"), F.lit("status")), F.array("o_orderpriority", "o_orderstatus"))).alias("key", "value"))
    d = CAT.merged_options(CAT.table_definitions(lineitem_metadata(spark, sf_dir)), orders)
    return d.select("table_id", "table_name", CAT.options_text(F.col("options")).alias("options_text"))
