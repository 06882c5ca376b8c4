import datetime as dt
import time

import duckdb
from pyspark.sql import functions as F

from tessera.plans import streams as P
from tessera.session import scratch_path
from tessera.streaming import stateful as ST
from tessera.streaming import streams as S
from tests.conftest import SF001


def written(spark, rows, schema):
    path = scratch_path(spark, "stream-test")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
    return path


def test_the_watermark_drops_some_rows_and_keeps_some_windows_open():
    con = duckdb.connect()
    con.execute(f"create view events as select * from read_parquet('{SF001}/events.parquet')")
    in_time = P._windowed_sql("5 seconds", "day", "event_type,").split("select window_start, event_type")[0]
    total, kept, closed = con.execute(in_time + """select (select count(*) from events), count(*),
        count(*) filter (window_end <= (select max(ts) - interval 5 seconds from events)) from in_time""").fetchone()
    assert 0 < total - kept < total / 4 and 0 < kept - closed


def test_windows_of_a_small_stream(spark):
    at = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    path = written(spark, [(0, at(1), 1), (0, at(2, 30), 1), (1, at(1, 5), 1), (1, at(2, 10), 1), (1, at(4), 1),
                           (2, at(2, 59), 1), (2, at(3, 30), 1), (2, at(9), 1)], "batch int, ts timestamp, v int")
    landing = S.land(S.file_stream(spark, path), F.col("batch"))
    assert landing.batches == [0, 1, 2]
    got = S.closed_windows(landing, "ts", "30 minutes", "1 hour", [], {"n": F.count(F.lit(1))})
    # 01:05 is late in batch 1 (reached 02:30 - 30 min); 02:59 in batch 2 (04:00 - 30 min); 09:00 stays open.
    assert sorted((r.window_start.hour, r.n) for r in got.collect()) == [(1, 1), (2, 2), (3, 1), (4, 1)]


def test_running_aggregate_is_read_from_its_state(spark):
    path = written(spark, [(0, 1, 10), (0, 2, 20), (1, 1, 5), (2, 3, None), (2, 1, -1)], "batch int, k int, v bigint")
    landing = S.land(S.file_stream(spark, path), F.col("batch"))
    checkpoint = S.run_landed(landing, lambda s: s.groupBy("k").agg(F.sum("v"), F.count("*"), F.sum("batch"))
                              .writeStream.outputMode("update").format("noop"))
    got = S.aggregate_state(spark, checkpoint, ["k"], ["s", "n", "b"])
    assert sorted(map(tuple, got.collect())) == [(1, 14, 3, 3), (2, 20, 1, 0), (3, None, 1, 2)]


def test_outer_sums_follow_a_key_that_changes_its_group(spark):
    path = written(spark, [(0, 1, "x", 10, 1), (0, 2, "x", 20, 2), (0, 3, "y", 1, 1), (1, 1, "z", 5, 1),
                           (1, 3, "y", 0, 0), (2, 2, "y", 4, 4)], "batch int, a int, g string, c bigint, d bigint")
    landing = S.land(S.file_stream(spark, path), F.col("batch"))
    out = scratch_path(spark, "changes")
    with ST.with_state_store(spark):
        S.run_landed(landing, lambda s: ST.retractions(s, ["a"]).writeStream.outputMode("append")
                     .format("parquet").option("path", out))
    changes = spark.read.parquet(out)
    # Key 1 moves from x to z and key 2 from x to y; key 3's second row changes nothing.
    assert changes.where("sign = -1").count() == 2
    outer = changes.groupBy("g").agg(F.sum("sign"), F.sum("c"), F.sum("d"))
    assert sorted(r for r in map(tuple, outer.collect()) if r[1]) == [("y", 2, 25, 7), ("z", 1, 15, 2)]
    assert [tuple(r) for r in outer.collect() if not r[1]] == [("x", 0, 0, 0)]


def test_idle_keys_are_forgotten(spark):
    at = lambda h: dt.datetime(2024, 1, 1, h)
    rows = [(0, 1, 7, 0, at(9)), (1, 2, 7, 1, at(1))]
    path = written(spark, rows, "batch int, event_id long, k long, arrival long, ts timestamp")
    late = {}
    for idle in (None, dt.timedelta(milliseconds=200)):
        landing = S.land(S.file_stream(spark, path), F.col("batch"))
        out, checkpoint = scratch_path(spark, "late"), scratch_path(spark, "ckpt")
        for batch in landing.batches:
            with ST.with_state_store(spark):
                q = (ST.late_rows_stream(landing.stream(batch), "k", "event_id", "arrival", "ts", 60, idle)
                     .writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).start())
            # With an expiry the query goes on for as long as state may expire.
            until = time.time() + 60
            while not any(p.numInputRows for p in q.recentProgress) and time.time() < until:
                time.sleep(0.1)
            q.stop()
            time.sleep(0.5)
        late[idle is None] = [r.late for r in spark.read.parquet(out).orderBy("event_id").collect()]
    assert late == {True: [False, True], False: [False, False]}
