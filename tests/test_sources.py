import uuid

import pytest
from pyspark.sql import functions as F

from tessera.operators.statement_set import StatementSet
from tessera.session import scratch_path
from tessera.sources import datagen as G
from tessera.sources import json_events as J
from tessera.sources import kafka as K
from tessera.sources import sinks
from tessera.sources import text_files as TF


def test_kafka_option_map():
    opts = {"connector": "kafka", "topic": "test", "format": "json",
            "properties.bootstrap.servers": "test:9092", "properties.group.id": "g",
            "scan.startup.mode": "earliest-offset", "sink.semantic": "exactly-once",
            "scan.topic-partition-discovery.interval": "10s"}
    spark_opts, rows, ignored = K.kafka_options(opts)
    assert spark_opts == {"subscribe": "test", "kafka.bootstrap.servers": "test:9092",
                          "kafka.group.id": "g", "startingOffsets": "earliest"}
    assert rows == {"connector": "kafka", "format": "json"}
    assert sorted(ignored) == ["scan.topic-partition-discovery.interval", "sink.semantic"]
    s, _, _ = K.kafka_options({"topic": "t", "scan.startup.mode": "specific-offsets",
                               "scan.startup.specific-offsets": "partition:0,offset:42;partition:1,offset:300"})
    assert s["startingOffsets"] == '{"t": {"0": 42, "1": 300}}'


@pytest.mark.parametrize("options", [
    {"topic": "t", "scan.startup.mode": "group-offsets"}, {"topic": "t", "scan.startup.mode": "timestamp"},
    {"topic": "a;b", "scan.startup.specific-offsets": "partition:0,offset:1"}])
def test_kafka_options_that_cannot_be_kept_raise(options):
    with pytest.raises(ValueError):
        K.kafka_options(options)


def test_json_bad_rows_split_and_failfast(spark):
    df = spark.createDataFrame([(1, '{"k": 1}'), (2, '{"k": 2')], "id int, p string")
    good, bad = J.split_bad_rows(J.parse_json(df, "p", "k bigint"))
    assert [r.id for r in good.collect()] == [1] and [r.id for r in bad.collect()] == [2]
    with pytest.raises(Exception):
        J.parse_json(df, "p", "k bigint", mode="FAILFAST").collect()


def test_datagen_bounds_and_determinism(spark):
    fields = [G.Field("user_id", "INT", min=1, max=10), G.Field("cost", "DOUBLE", min=1, max=100),
              G.Field("seq", "BIGINT", kind="sequence", min=5), G.Field("s", "STRING", length=6)]
    df = G.datagen(spark, fields, 2000, partitions=4)
    r = df.agg(F.min("user_id"), F.max("user_id"), F.min("cost"), F.max("cost"), F.min("seq"),
               F.max(F.length("s"))).first()
    assert (r[0], r[1]) == (1, 10) and 1 <= r[2] and r[3] <= 100 and r[4] == 5 and r[5] == 6
    assert df.exceptAll(G.datagen(spark, fields, 2000, partitions=2)).count() == 0


def test_datagen_stream_rate(spark):
    fields = [G.Field("user_id", "INT", min=1, max=10)]
    q = (G.datagen_stream(spark, fields, rows_per_second=50).writeStream.format("memory")
         .queryName("gen_rate").start())
    try:
        q.awaitTermination(4)
        q.processAllAvailable()
    finally:
        q.stop()
    got = spark.table("gen_rate")
    assert got.columns == ["id", "ts", "user_id"]
    assert got.count() > 0 and got.where("user_id < 1 or user_id > 10").count() == 0


def test_freq_dict_roundtrip_keeps_quotes(spark):
    d = spark.createDataFrame([('""', 1), ("''", 2), ("select", 9)], TF.DICT_SCHEMA)
    p = scratch_path(spark, "dict")
    TF.write_freq_dict(d, p, files=1)
    assert sorted(TF.read_freq_dict(spark, p).collect()) == sorted(d.collect())


def test_corpus_scan_recursive(spark):
    p = scratch_path(spark, "corpus")
    spark.createDataFrame([("a b",), ("c",)], "value string").coalesce(1).write.text(p + "/x/y")
    got = TF.corpus_scan(spark, p)
    assert sorted(r.line for r in got.collect()) == ["a b", "c"]


def test_statement_set_rules_and_sinks(spark):
    ss = StatementSet(spark)
    with pytest.raises(ValueError):
        ss.add_insert_sql("select 1")
    with pytest.raises(ValueError):
        ss.add_insert_sql("insert into a select 1; insert into b select 2")
    for bad in ("delete from a", "insert into", "create table a as select 1"):
        with pytest.raises(ValueError):
            ss.add_insert_sql(bad)
    df = spark.range(10)
    a, b = scratch_path(spark, "ssa"), scratch_path(spark, "ssb")
    ss.add_insert(a, df).add_insert(b, df.where("id > 4"), overwrite=True)
    assert "insert into" in ss.explain()
    assert ss.execute() == 2 and ss.execute() == 0      # list cleared after execute
    assert spark.read.parquet(a).count() == 10 and spark.read.parquet(b).count() == 5
    sinks.noop_sink(df)


def test_statement_set_takes_what_spark_parses(spark):
    name = f"ss_{uuid.uuid4().hex[:8]}"
    spark.sql(f"create table {name} (x string) using parquet location '{scratch_path(spark, name)}'")
    try:
        ss = StatementSet(spark)
        ss.add_insert_sql(f"insert into {name} select ';' as x")
        ss.add_insert_sql(f"-- a comment; of one line\n/* and another */ INSERT INTO {name} VALUES ('b');")
        ss.add_insert_sql(f"with w as (select 'c' as x) insert into {name} select * from w")
        ss.add_insert_sql(f"from {name} insert into {name} select concat(x, '1') insert into {name} select concat(x, '2') where x = 'b'")
        assert ss.execute() == 4
        assert sorted(r.x for r in spark.table(name).collect()) == [";", ";1", "b", "b1", "b2", "c", "c1"]
    finally:
        spark.sql(f"drop table {name}")


def test_existing_table_keeps_its_partitioning(spark):
    name = f"sink_{uuid.uuid4().hex[:8]}"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string")
    sinks.create_partitioned_table(spark, name, df, ["k"], scratch_path(spark, name))
    try:
        with pytest.raises(ValueError, match="partitioned by"):
            sinks.table_sink(df, name, partition_by=["v"])
        sinks.table_sink(df.select("k", "v"), name, partition_by=["k"])  # columns by name
        assert sorted(map(tuple, spark.table(name).collect())) == [(1, "a"), (1, "a"), (2, "b"), (2, "b")]
        with pytest.raises(ValueError, match="must name"):
            sinks.replace_partition(df, name, {"v": 1})
        sinks.replace_partition(spark.createDataFrame([(7,)], "v int"), name, {"k": "a"})
        sinks.replace_partition(spark.createDataFrame([(8,)], "v int"), name, {"k": None})
        assert sorted(map(tuple, spark.table(name).collect()), key=repr) == [(2, "b"), (2, "b"), (7, "a"), (8, None)]
        for cols in (["z"], ["k", "k"], ["k", "v"]):
            with pytest.raises(ValueError):
                sinks.create_partitioned_table(spark, name + "x", df, cols, scratch_path(spark, name))
    finally:
        spark.sql(f"drop table {name}")


def test_decode_kafka_rows_key_and_value(spark):
    recs = spark.createDataFrame(
        [(b'{"id": 7}', b'{"id": 7, "name": "a", "cost": 1.5}'), (None, b'{"id": 8, "name": "b", "cost": 2.0}')],
        "key binary, value binary")
    opts = {"format": "json", "key.format": "json", "key.fields": "k_id", "key.fields-prefix": "k_",
            "value.fields-include": "EXCEPT_KEY"}
    rows = K.decode_kafka_rows(recs, opts, "k_id bigint, name string, cost double").collect()
    assert [(r.k_id, r.name, r.cost) for r in rows] == [(7, "a", 1.5), (None, "b", 2.0)]
    plain = K.decode_kafka_rows(recs, {"format": "json"}, "id bigint, name string").collect()
    assert [(r.id, r.name) for r in plain] == [(7, "a"), (8, "b")]
    bad = spark.createDataFrame([(None, b'{"id": ')], "key binary, value binary")
    lenient = K.decode_kafka_rows(bad, {"format": "json", "json.ignore-parse-errors": "true"}, "id bigint")
    assert lenient.first().id is None
    with pytest.raises(Exception):
        K.decode_kafka_rows(bad, {"format": "json"}, "id bigint").collect()
    with pytest.raises(ValueError, match="avro"):
        K.decode_kafka_rows(recs, {"format": "avro"}, "id bigint")


def test_generator_options_for_declared_columns(spark):
    cols = [("user_id", "int"), ("cost", "double"), ("ts", "timestamp_ntz"), ("tags", "array<string>")]
    opts = {"fields.user_id.kind": "random", "fields.user_id.min": "1", "fields.user_id.max": "10",
            "fields.cost.min": "1", "fields.cost.max": "100", "rows-per-second": "5"}
    df = G.generate_declared(spark.range(500), "id", cols, opts)
    assert dict(df.dtypes) == {"user_id": "int", "cost": "double", "ts": "timestamp_ntz", "tags": "array<string>"}
    r = df.agg(F.min("user_id"), F.max("user_id"), F.min("cost"), F.max("cost")).first()
    assert r[0] >= 1 and r[1] <= 10 and r[2] >= 1 and r[3] <= 100
    s = G.generate_declared_stream(spark, cols, opts)
    assert s.isStreaming and s.columns == ["user_id", "cost", "ts", "tags"]


def test_partition_replace_and_drop_with_quoted_values(spark):
    name = "parts_quoted_test"
    df = spark.createDataFrame([(1, "it's"), (2, "plain"), (3, "plain")], "v int, k string")
    sinks.create_partitioned_table(spark, name, df, ["k"], scratch_path(spark, name))
    sinks.replace_partitions(spark.createDataFrame([(9, "plain")], "v int, k string"), name)
    sinks.drop_partition(spark, name, {"k": "it's"})
    with pytest.raises(ValueError):
        sinks.drop_partition(spark, name, {"v": "9"})
    with pytest.raises(Exception):
        sinks.drop_partition(spark, name, {"k": "it's"})
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [(9, "plain")]


def test_generator_quotes_odd_names(spark):
    df = G.generate_declared(spark.range(3), "id", [("we`ird", "int"), ("s", "struct<`it's`:string>")])
    assert df.columns == ["we`ird", "s"] and df.first().s["it's"] is not None
