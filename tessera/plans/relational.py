"""Relational queries (SURVEY group C) bound to the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tessera.operators import joins, relational as rel
from tessera.plans.registry import query
from tessera.sources.tables import table

# Flagship parameters: T1 = lineitem (a, b, c, d), lookup = supplier, age = s_acctbal.
FLAGSHIP_MIN_ACCTBAL = 5000

FLAGSHIP_SQL = f"""
with per_supplier as (
  select l_suppkey, l_returnflag, sum(cast(l_quantity as decimal(18,2))) as quantity,
         sum(cast(l_extendedprice as decimal(18,2))) as price
  from lineitem group by all),
wealthy as (select s_suppkey from supplier where s_acctbal > {FLAGSHIP_MIN_ACCTBAL})
select l_returnflag as b, count(*) as cnt_a, cast(sum(quantity) as double) as sum_c, cast(sum(price) as double) as sum_d
from per_supplier join wealthy on l_suppkey = s_suppkey
group by l_returnflag
"""


@query("flagship_lookup_rollup", FLAGSHIP_SQL)
def flagship_lookup_rollup(spark, sf_dir):
    return rel.flagship_lookup_rollup(
        table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier"),
        a="l_suppkey", b="l_returnflag", c="l_quantity", d="l_extendedprice",
        dim_key="s_suppkey", dim_attr="s_acctbal", min_attr=FLAGSHIP_MIN_ACCTBAL)


@query("scan_all", "select * from nation")
def scan_all(spark, sf_dir):
    return table(spark, sf_dir, "nation")


@query("project_columns", "select o_orderkey as order_number from orders")
def project_columns(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_number"))


@query("project_nested", """
select vec_id, len(embedding) as dims, cast(embedding[1] as double) as first_value,
       cast(embedding[len(embedding)] as double) as last_value
from embeddings""")
def project_nested(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.size("embedding").cast("bigint").alias("dims"),
                    F.element_at("embedding", 1).cast("double").alias("first_value"),
                    F.element_at("embedding", -1).cast("double").alias("last_value"))


@query("project_nested_struct", """
select p_partkey, s.brand as brand, s.size as size, m['type'] as type_name
from (select p_partkey, {'brand': p_brand, 'size': p_size} as s,
             map {'type': p_type, 'name': p_name} as m from part)""")
def project_nested_struct(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.struct(F.col("p_brand").alias("brand"), F.col("p_size").alias("size")).alias("s"),
        F.create_map(F.lit("type"), "p_type", F.lit("name"), "p_name").alias("m"))
    return p.select("p_partkey", F.col("s.brand").alias("brand"), F.col("s").getField("size").alias("size"),
                    F.col("m")["type"].alias("type_name"))


@query("derived_table_star", """
select T.* from (select l_orderkey, l_linenumber, l_suppkey, l_quantity from lineitem) T""")
def derived_table_star(spark, sf_dir):
    return rel.derived_table_star(table(spark, sf_dir, "lineitem"),
                                  ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"])


# Epoch milliseconds of events.ts; DuckDB's epoch_ms rounds, so whole micros // 1000.
EPOCH_SQL = """
select event_id, event_time,
       make_timestamp((event_time // 1000) * 1000000) as ts,
       strftime(make_timestamp((event_time // 1000) * 1000000), '%Y-%m-%d %H:%M:%S') as ts_text
from (select event_id, epoch_us(ts) // 1000 as event_time from events)
"""


@query("epoch_to_timestamp", EPOCH_SQL)
def epoch_to_timestamp(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("event_time"))
    ts = rel.epoch_to_timestamp("event_time")
    return ev.select("event_id", "event_time", ts.cast("timestamp_ntz").alias("ts"),
                     F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("ts_text"))


@query("current_time_columns", """
select event_id, 'timestamp_ntz' as local_type, 'timestamp' as proctime_type, true as local_is_now, true as same_instant
from events""")
def current_time_columns(spark, sf_dir):
    # Wall-clock columns have no fixed values: their types, that they are now, and that
    # both name one instant are checked.
    now = F.lit(dt.datetime.now(dt.timezone.utc))
    local, proctime = F.localtimestamp(), F.current_timestamp()
    return table(spark, sf_dir, "events").select(
        "event_id", F.typeof(local).alias("local_type"), F.typeof(proctime).alias("proctime_type"),
        (F.abs(F.unix_seconds(local.cast("timestamp")) - F.unix_seconds(now)) < 3600).alias("local_is_now"),
        (local.cast("timestamp") == proctime).alias("same_instant"))


@query("filter_compare", "select * from events where user_id = 12")
def filter_compare(spark, sf_dir):
    return table(spark, sf_dir, "events").where(F.col("user_id") == 12)


@query("filter_compare_dimension",
       f"select s_suppkey, s_name, s_acctbal from supplier where s_acctbal > {FLAGSHIP_MIN_ACCTBAL}")
def filter_compare_dimension(spark, sf_dir):
    return (table(spark, sf_dir, "supplier").where(F.col("s_acctbal") > FLAGSHIP_MIN_ACCTBAL)
            .select("s_suppkey", "s_name", "s_acctbal"))


@query("group_sum_two_keys", """
select l_suppkey as a, l_returnflag as b,
       cast(sum(cast(l_quantity as decimal(18,2))) as double) as c,
       cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as d
from lineitem group by l_suppkey, l_returnflag""")
def group_sum_two_keys(spark, sf_dir):
    t = rel.group_sum_two_keys(table(spark, sf_dir, "lineitem"),
                               "l_suppkey", "l_returnflag", "l_quantity", "l_extendedprice")
    return t.select("a", "b", rel.from_cents("c").alias("c"), rel.from_cents("d").alias("d"))


@query("two_level_agg", """
select b, count(a) as cnt_a, cast(sum(c) as double) as sum_c, cast(sum(d) as double) as sum_d
from (select l_returnflag b, l_suppkey a, sum(cast(l_quantity as decimal(18,2))) c,
             sum(cast(l_extendedprice as decimal(18,2))) d
      from lineitem group by l_suppkey, l_returnflag) T
group by b""")
def two_level_agg(spark, sf_dir):
    return rel.two_level_agg(table(spark, sf_dir, "lineitem"),
                             "l_suppkey", "l_returnflag", "l_quantity", "l_extendedprice")


@query("lookup_join", """
select l_orderkey, l_linenumber, l_suppkey, s_name, s_acctbal
from lineitem join supplier on l_suppkey = s_suppkey""")
def lookup_join(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return joins.lookup_join(li, s, li["l_suppkey"] == s["s_suppkey"]).drop("s_suppkey")


# Versions of a customer: every order starts one, valid from its order date,
# carrying the order priority. Facts: line items at their ship date.
VERSIONED_SQL = """
with f as (
  select row_number() over () as fact_id, l_orderkey, l_linenumber, l_shipdate,
         o_custkey as custkey
  from lineitem join orders on l_orderkey = o_orderkey),
v as (select o_custkey, o_orderdate, o_orderkey, o_orderpriority from orders),
m as (
  select f.fact_id, f.l_orderkey, f.l_linenumber, f.custkey,
         arg_max(v.o_orderkey, (v.o_orderdate, v.o_orderkey)) as version_key,
         arg_max(v.o_orderpriority, (v.o_orderdate, v.o_orderkey)) as version_priority
  from f left join v on v.o_custkey = f.custkey and v.o_orderdate <= f.l_shipdate
  group by all)
select l_orderkey, l_linenumber, custkey, version_key, version_priority from m
"""


@query("lookup_join_versioned", VERSIONED_SQL)
def lookup_join_versioned(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    facts = li.join(o.select(F.col("o_orderkey").alias("l_orderkey"),
                             F.col("o_custkey").alias("custkey")), "l_orderkey")
    versions = o.select(F.col("o_custkey").alias("custkey"), "o_orderdate", "o_orderkey",
                        "o_orderpriority")
    r = joins.asof_lookup(facts, versions, key="custkey", fact_time="l_shipdate",
                          valid_from="o_orderdate", order_tiebreak="o_orderkey",
                          payload=["o_orderpriority"])
    return r.select("l_orderkey", "l_linenumber", "custkey",
                    F.col("o_orderkey").alias("version_key"),
                    F.col("o_orderpriority").alias("version_priority"))


@query("group_by_substring", """
select substring(o_orderpriority, 1, 1) as grp, count(*) as cnt from orders group by 1""")
def group_by_substring(spark, sf_dir):
    return rel.group_by_substring(table(spark, sf_dir, "orders"), "o_orderpriority", 1, 1)


@query("rebalance_source", "select o_orderkey, o_custkey, o_totalprice from orders")
def rebalance_source(spark, sf_dir):
    # The requested parallelism follows the cluster (a fixed small number would
    # funnel a large table through a few tasks).
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return rel.rebalance(o)
