"""Streaming queries.

Each query reads a test table with ``readStream`` and returns the batch read of what
the stream has produced: sink files or the state store. The watermark queries and
the lateness audit land the table by arrival first, since their results depend on
what arrives when; their oracles state which rows are late.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import joins
from tessera.operators import relational as rel
from tessera.plans import keys as batch_keys
from tessera.plans import relational as batch_rel
from tessera.plans import writes as batch_writes
from tessera.plans.registry import query
from tessera.session import scratch_path
from tessera.sources.tables import table
from tessera.streaming import stateful as ST
from tessera.streaming import streams as S


def _stream(spark, sf_dir, name, cols):
    return S.file_stream(spark, f"{sf_dir.rstrip('/')}/{name}.parquet").select(*cols)


def _line_stream(spark, sf_dir):
    return _stream(spark, sf_dir, "lineitem", ["l_suppkey", "l_returnflag", "l_quantity", "l_extendedprice"])


@query("stream_group_sum", """
select l_suppkey as a, l_returnflag as b,
       cast(sum(cast(l_quantity as decimal(18,2))) as double) as c,
       cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as d
from lineitem group by l_suppkey, l_returnflag""")
def stream_group_sum(spark, sf_dir):
    sums = rel.group_sum_two_keys(_line_stream(spark, sf_dir), "l_suppkey", "l_returnflag", "l_quantity",
                                  "l_extendedprice")
    t = S.aggregate_state(spark, S.running_aggregate(sums), ["a", "b"], ["c", "d"])
    return t.select("a", "b", rel.from_cents("c").alias("c"), rel.from_cents("d").alias("d"))


@query("stream_flagship", batch_rel.FLAGSHIP_SQL)
def stream_flagship(spark, sf_dir):
    dim = (table(spark, sf_dir, "supplier").where(F.col("s_acctbal") > batch_rel.FLAGSHIP_MIN_ACCTBAL)
           .select(F.col("s_suppkey").alias("_id")))
    li = _line_stream(spark, sf_dir)
    rows = joins.lookup_join(li, dim, li["l_suppkey"] == dim["_id"]).select(
        F.col("l_suppkey").alias("a"), F.col("l_returnflag").alias("g"), rel.cents("l_quantity").alias("c"),
        rel.cents("l_extendedprice").alias("d"))
    with ST.with_state_store(spark):
        changes = S.appended(ST.retractions(rows.withColumn("b", F.col("g")), ["a", "b"]))
    # Second query: the outer aggregate over the changes.
    outer = (S.file_stream(spark, changes.inputFiles()[0].rsplit("/", 1)[0], changes.schema)
             .groupBy(F.col("g").alias("b")).agg(F.sum("sign"), F.sum("c"), F.sum("d")))
    t = S.aggregate_state(spark, S.running_aggregate(outer), ["b"], ["cnt_a", "c", "d"])
    return t.select("b", "cnt_a", rel.from_cents("c").alias("sum_c"), rel.from_cents("d").alias("sum_d"))


@query("stream_lookup_join", """
select l_orderkey, l_linenumber, l_suppkey, s_name, s_acctbal
from lineitem join supplier on l_suppkey = s_suppkey""")
def stream_lookup_join(spark, sf_dir):
    li = _stream(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_suppkey"])
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return S.appended(joins.lookup_join(li, s, li["l_suppkey"] == s["s_suppkey"]).drop("s_suppkey"))


@query("stream_dedup_by_key", """
select distinct l_orderkey, l_linenumber from lineitem""")
def stream_dedup_by_key(spark, sf_dir):
    # The files that are there make one micro-batch, in which nothing is late and no
    # key is forgotten; a key's state goes once the watermark is a day past it.
    li = _stream(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate"])
    return S.appended(S.dedup_stream(li, ["l_orderkey", "l_linenumber"], "l_shipdate", "1 day").select(
        "l_orderkey", "l_linenumber"))


#: When an event arrives: most within the hour, every fifth up to 200 hours late.
_LAG_SECONDS = "case when event_id % 5 = 0 then (event_id * 7919) % 200 * 3600 else event_id % 3600 end"
_BATCH_DAYS = 10


def _windowed(spark, sf_dir, delay, width, by):
    events = _stream(spark, sf_dir, "events", ["event_id", "ts", "event_type", "value"])
    arrived = F.unix_micros(F.col("ts").cast("timestamp")) + F.expr(_LAG_SECONDS) * 1_000_000
    landing = S.land(events, F.floor(arrived / F.lit(_BATCH_DAYS * 86_400_000_000)))
    t = S.closed_windows(landing, "ts", delay, width, by,
                         {"n": F.count(F.lit(1)), "value_cents": F.sum(rel.cents("value"))})
    return t.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), *by, "n",
                    rel.from_cents("value_cents").alias("value"))


def _windowed_sql(delay, unit, by):
    """Windows closed after the last batch, without the rows that came after their
    window was closed: before a batch the watermark is the greatest event time of
    all earlier batches, less the delay."""
    return f"""
with arrived as (select *, date_trunc('{unit}', ts) as window_start, date_trunc('{unit}', ts) + interval 1 {unit} as window_end,
    (epoch_us(ts) + ({_LAG_SECONDS}) * 1000000) // {_BATCH_DAYS * 86_400_000_000} as batch from events),
reached as (select batch, max(max(ts)) over (order by batch rows between unbounded preceding and 1 preceding)
    - interval {delay} as watermark from arrived group by batch),
in_time as (select a.* from arrived a join reached r using (batch)
    where r.watermark is null or window_end > r.watermark)
select window_start, {by} count(*) as n, cast(sum(cast(value as decimal(18,2))) as double) as value
from in_time where window_end <= (select max(ts) - interval {delay} from events)
group by all"""


@query("stream_watermark_delay", _windowed_sql("5 seconds", "day", "event_type,"))
def stream_watermark_delay(spark, sf_dir):
    return _windowed(spark, sf_dir, "5 seconds", "1 day", ["event_type"])


@query("stream_watermark_zero", _windowed_sql("0 seconds", "hour", ""))
def stream_watermark_zero(spark, sf_dir):
    return _windowed(spark, sf_dir, "0 seconds", "1 hour", [])


@query("stream_statement_set", batch_writes.STATEMENT_SET_SQL)
def stream_statement_set(spark, sf_dir):
    orders = _stream(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice"])
    targets = {"finished": scratch_path(spark, "finished"), "open": scratch_path(spark, "open")}
    writer = S.multi_sink_writer(targets, {
        "finished": lambda b: b.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice"),
        "open": lambda b: b.where(F.col("o_orderstatus") != "F").select("o_orderkey", "o_totalprice"),
    })
    S.run_available(writer(orders), scratch_path(spark, "ckpt"))
    return (spark.read.parquet(targets["finished"]).select(
                F.lit("finished").alias("target"), "o_orderkey", "o_totalprice")
            .unionByName(spark.read.parquet(targets["open"]).select(
                F.lit("open").alias("target"), "o_orderkey", "o_totalprice")))


@query("stream_late_row_audit", batch_keys.query_sql("late_row_audit"))
def stream_late_row_audit(spark, sf_dir):
    # Events landed in order of arrival; per-user state holds the latest event time,
    # each row is flagged against it as it arrives.
    events = _stream(spark, sf_dir, "events", ["event_id", "user_id", "ts"]).withColumn(
        "arrival", F.expr(batch_keys.ARRIVAL))
    landing = S.land(events, F.floor(F.col("arrival") / F.lit(400_000)))
    out = scratch_path(spark, "stream-out")
    with ST.with_state_store(spark):
        S.run_landed(landing, lambda s: ST.late_rows_stream(s, "user_id", "event_id", "arrival", "ts", 10 * 86400)
                     .writeStream.outputMode("append").format("parquet").option("path", out))
    ntz = lambda c: F.timestamp_micros(F.col(c)).cast("timestamp_ntz")
    r = spark.read.schema(ST.LATE_SCHEMA).parquet(out)
    return r.select("event_id", F.col("key").alias("user_id"), "arrival", ntz("ts_us").alias("ts"),
                    ntz("watermark_us").alias("watermark"), "late")
