import datetime as dt
import random

from tessera.operators import joins
from tessera.operators.joins import asof_lookup, broadcast_if_small


def test_asof_lookup_matches_brute_force(spark):
    rng = random.Random(5)
    t0 = dt.datetime(2024, 1, 1)
    ts = lambda s: t0 + dt.timedelta(seconds=s)
    # key 1 is hot (most rows), versions and facts interleave over many buckets
    versions = [(rng.choice([1, 1, 1, 2, 3]), ts(rng.randrange(0, 5000)), i, f"v{i}") for i in range(300)]
    versions += [(1, ts(100), 9001, "tie-a"), (1, ts(100), 9000, "tie-b")]
    facts = [(i, rng.choice([1, 1, 1, 2, 3, 4]), ts(rng.randrange(0, 5200))) for i in range(800)]
    vdf = spark.createDataFrame(versions, "k int, valid_from timestamp_ntz, vid int, payload string")
    fdf = spark.createDataFrame(facts, "fid int, k int, t timestamp_ntz")
    got = {r.fid: (r.vid, r.payload) for r in asof_lookup(
        fdf, vdf, key="k", fact_time="t", valid_from="valid_from", order_tiebreak="vid",
        payload=["payload"], heavy_rows=50, cuts=7).collect()}
    for fid, k, t in facts:
        cands = [(vf, vid, p) for kk, vf, vid, p in versions if kk == k and vf <= t]
        want = (max(cands)[1], max(cands)[2]) if cands else (None, None)
        assert got[fid] == want, fid


def test_broadcast_if_small_keeps_large_side_plain(spark):
    small, large = spark.range(5), spark.range(50)  # 8 bytes a row
    assert broadcast_if_small(large, 100) is large
    assert broadcast_if_small(small, 100) is not small


def test_asof_lookup_without_keys_or_times(spark):
    t = dt.datetime(2024, 1, 1)
    versions = spark.createDataFrame([(1, None, 1, "never"), (None, t, 2, "no key"), (1, t, 3, "v")],
                                     "k int, valid_from timestamp_ntz, vid int, payload string")
    facts = spark.createDataFrame([(1, 1, None), (2, None, t), (3, 1, t)], "fid int, k int, t timestamp_ntz")
    got = {r.fid: r.payload for r in asof_lookup(
        facts, versions, key="k", fact_time="t", valid_from="valid_from", order_tiebreak="vid",
        payload=["payload"]).collect()}
    assert got == {1: None, 2: None, 3: "v"}


def test_only_a_side_of_bounded_size_is_hinted(spark):
    from pyspark.sql import functions as F
    facts = spark.range(1000).withColumnRenamed("id", "k")
    exploded = spark.range(1).select(F.explode(F.sequence(F.lit(1), F.lit(10_000_000))).alias("k"))
    assert joins.planned_bytes(exploded) < 1000 and not joins.fits_broadcast(exploded)
    assert "ResolvedHint" not in joins.lookup_join(facts, exploded, "k")._jdf.queryExecution().analyzed().toString()
    # The same behind an aggregate or a filter, and behind a join.
    assert not joins.fits_broadcast(exploded.groupBy("k").count().where("k > 5"))
    assert not joins.fits_broadcast(facts.join(facts.withColumnRenamed("k", "j"), F.col("k") % 7 == F.col("j") % 7))
    small = spark.sql("select * from values (1L, 'a'), (2L, 'b') as t(k, v)").where("k > 0").groupBy("k").agg(F.max("v"))
    words = spark.range(1).select(F.explode(F.lit(["a", "b"])).alias("k"))
    assert joins.fits_broadcast(words)
    assert joins.fits_broadcast(small) and joins.fits_broadcast(spark.range(10).withColumnRenamed("id", "k"))
    assert not joins.fits_broadcast(spark.range(100_000_000))


def test_a_hot_key_on_one_instant_is_many_parts(spark):
    from pyspark.sql import functions as F
    t0 = dt.datetime(2024, 1, 1)
    # A third of the rows are one key's; most of those at one instant.
    facts = spark.range(6000).select(
        F.col("id").alias("fid"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 500 + 2).alias("k"),
        F.lit(t0).alias("ft")).withColumn("ft", F.expr("ft + make_interval(0, 0, 0, 0, 0, 0, if(fid % 30 = 0, fid, 100))"))
    versions = spark.createDataFrame([(1, t0 + dt.timedelta(seconds=s), s) for s in (0, 100, 101, 4000)], "k long, vf timestamp, vid int")
    args = dict(key="k", fact_time="ft", valid_from="vf", order_tiebreak="vid", payload=[], heavy_rows=500, cuts=16)
    got = {r.fid: r.vid for r in asof_lookup(facts, versions, **args).collect()}
    want = {}
    for r in facts.collect():
        at = [s for s in (0, 100, 101, 4000) if r.k == 1 and t0 + dt.timedelta(seconds=s) <= r.ft]
        want[r.fid] = max(at) if at else None
    assert got == want and len(got) == 6000
    rows = facts.select(F.col("k").alias("_k"), F.unix_micros("ft").alias("_us"))
    cut = joins.time_cuts(rows, 500, 16).collect()
    assert [r._k for r in cut] == [1] and len(cut[0]._cuts) == 15
    assert len(set(cut[0]._cuts)) < 15  # several cuts on the instant, whose facts are dealt over them
