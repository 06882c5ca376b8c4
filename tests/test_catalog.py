import pytest
from pyspark.sql import functions as F

from tessera.functions import types as TY
from tessera.operators import catalog as CAT
from tessera.sources.metadata import metadata_scan
from tests.fixtures import fixture_metadata


def test_simple_type_resolution(spark):
    texts = ["STRING", "BOOLEAN", "BYTE", "BYTES", "SMALLINT", "INTEGER", "INT", "LONG", "BIGINT",
             "FLOAT", "DOUBLE", "DECIMAL(32,2)", "DECIMAL(32, 2)", "DATE", "TIME", "TIMESTAMP(3)",
             "TIMESTAMP", "TINYINT", "INTERVAL", "DECIMAL(2,5)"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: (r.spark_type, r.rule, r.status) for r in TY.resolve_simple_types(df, "t", spark).collect()}
    assert got["DECIMAL(32,2)"] == ("decimal(32,2)", "exact", "ok")
    assert got["DECIMAL(32, 2)"] == ("decimal(32,2)", "exact", "ok")
    assert got["INT"] == ("int", "alias", "ok") and got["BYTES"] == ("binary", "alias", "ok")
    assert got["BYTE"][0] == "binary" and got["LONG"][0] == "bigint"
    assert got["TIMESTAMP(3)"] == ("timestamp_ntz", "exact", "ok")
    assert got["TIMESTAMP"][2] == "missing parameters"
    assert got["TINYINT"][2] == "unsupported" and got["INTERVAL"][2] == "unsupported"
    assert got["DECIMAL(2,5)"][2] == "bad parameters"


def test_nested_type_trees():
    md = {
        '{"type":"ARRAY","next":{"type":"ARRAY","next":{"type":"STRING"}}}': "array<array<string>>",
        '{"type":"MAP","key":{"type":"STRING"},"value":{"type":"MAP","key":{"type":"STRING"},'
        '"value":{"type":"INTEGER"}}}': "map<string,map<string,int>>",
        '{"type":"STRUCT","field":[{"type":"TIME","name":"start_time"},{"type":"STRUCT",'
        '"name":"inside_row","field":[{"type":"STRING","name":"ins"}]}]}':
            "struct<`start_time`:time(0),`inside_row`:struct<`ins`:string>>",
    }
    for tree, ddl in md.items():
        assert TY.tree_to_ddl(tree) == ddl


def test_nested_conformance_sets_misfits_aside(spark):
    tree = '{"type":"STRUCT","field":[{"type":"TIME","name":"t"},{"type":"ARRAY","name":"a","next":{"type":"STRING"}}]}'
    df = spark.createDataFrame([('{"t": "11:47:32", "a": ["x"]}',), ('{"t": "1", "a": [',), (None,)], "raw string")
    rows = TY.conform_json(df, "raw", tree).collect()
    assert rows[0].value.t == "11:47:32" and rows[0].value.a == ["x"] and not rows[0].value_bad
    assert rows[1].value_bad and rows[1].value is None and rows[2].value_bad


def test_definitions_audit_and_options(spark):
    md = fixture_metadata(spark)
    defs = {r.table_name: r for r in CAT.table_definitions(md).collect()}
    assert [c.schema_name for c in defs["datagen_sou"].columns][:2] == ["array_array", "map_map_nested"]
    assert defs["ka_test"].options["topic"] == "test"

    bad = spark.createDataFrame([(3, "format", "json"), (4, "connector", "kafka"), (4, "connector", "x"),
                                 (5, "connector", "jdbc")], "table_id int, key string, value string")
    audit = {r.table_id: r.status for r in CAT.connector_audit(md.conn_info.unionByName(bad)).collect()}
    assert audit == {1: "ok", 2: "ok", 3: "no connector", 4: "several connectors", 5: "unknown connector"}

    conn_of = CAT.connector_audit(md.conn_info).select("table_id", "connector")
    pre = CAT.option_prefix(md.conn_info.unionByName(spark.createDataFrame(
        [(2, "auto.offset.reset", "x")], "table_id int, key string, value string")), conn_of)
    keys = {(r.table_id, r.key) for r in pre.collect()}
    assert (2, "properties.bootstrap.servers") in keys          # already prefixed: unchanged
    assert (2, "properties.auto.offset.reset") in keys and (2, "topic") in keys
    assert (1, "connector") in keys
    # idempotent
    again = {(r.table_id, r.key) for r in CAT.option_prefix(pre, conn_of).collect()}
    assert again == keys

    user = spark.createDataFrame([(2, "properties.group.id", "test")], "table_id int, key string, value string")
    ov = {r.key: (r.value, r.source) for r in CAT.option_override(pre, user).where("table_id = 2").collect()}
    assert ov["properties.group.id"] == ("test", "user") and ov["topic"] == ("test", "template")

    m = spark.createDataFrame([({"a": "1", "b": "2"}, {"b": "3"})], "t map<string,string>, u map<string,string>")
    assert m.select(CAT.map_override(F.col("t"), F.col("u")).alias("m")).first().m == {"a": "1", "b": "3"}


def test_metadata_scan_filters_database(spark):
    md = fixture_metadata(spark)
    other = md.databases.unionByName(spark.createDataFrame([(9, "prod", "x", None)], md.databases.schema))
    from tessera.sources.metadata import Metadata
    got = metadata_scan(spark, "test", tables=Metadata(other, md.conn_info, md.schemas))
    assert sorted(r.table_id for r in got.databases.collect()) == [1, 2]


def test_overlay_and_describe(spark):
    base = spark.createDataFrame([(1646027324, "2020-11-12 00:00:00")], "event_time bigint, for_datetime string")
    ov = CAT.Overlay(computed={"ts": "to_timestamp(from_unixtime(event_time div 1000, 'yyyy-MM-dd HH:mm:ss'))"},
                     watermark=("ts", "5 SECOND"), columns=["event_time"])
    view = CAT.table_overlay(base, ov)
    assert str(view.first().ts) == "1970-01-20 01:13:47"
    desc = {r.name: r for r in CAT.describe_schema(spark, view, ov).collect()}
    assert desc["ts"].extras.startswith("AS to_timestamp") and "INTERVAL '5 SECOND'" in desc["ts"].watermark
    bad = CAT.Overlay(columns=["nope"], watermark=("nope", "1 second"))
    assert CAT.check_overlay(base.columns, bad) == ["unknown column nope", "watermark on unknown column nope"]


def test_register_declared_tables(spark):
    res = {r.table_name: r for r in CAT.register_declared_tables(spark, fixture_metadata(spark), rows=50).collect()}
    assert res["datagen_sou"].status == "registered"
    assert res["ka_test"].status == "kafka package not available"
    t = spark.table("datagen_sou")
    assert t.count() == 50
    types = dict(t.dtypes)
    assert types["array_array"] == "array<array<string>>"
    assert types["map_map_nested"] == "map<string,map<string,int>>"
    assert types["nested_struct"] == "struct<start_time:time(0),inside_row:struct<ins:string>>"
    assert types["price"] == "decimal(32,2)" and types["order_time"] == "timestamp_ntz"
    row = spark.sql("select map_map_nested, nested_struct.inside_row.ins, tags from datagen_sou").first()
    assert len(row.tags) == 2 and len(row.map_map_nested) == 2 and len(row.ins) == 12


def test_unbounded_generated_table_is_a_stream(spark):
    res = {r.table_name: r for r in CAT.register_declared_tables(spark, fixture_metadata(spark)).collect()}
    assert res["datagen_sou"].status == "registered as stream" and spark.table("datagen_sou").isStreaming


def test_text_after_the_value_does_not_conform(spark):
    tree = '{"type":"STRUCT","field":[{"type":"BIGINT","name":"a"}]}'
    raws = ['{"a":1}', '{"a":1},"x":2', '{"a":1},"v":{"a":5}', "null", '{"a":1}}', '{"a":1}]', ' {"a":2} ', None, ""]
    df = spark.createDataFrame(list(enumerate(raws)), "i int, raw string")
    rows = {r.i: r for r in TY.conform_json(df, "raw", tree).collect()}
    assert [i for i in rows if not rows[i].value_bad] == [0, 6] and rows[6].value.a == 2
    listed = TY.conform_json(spark.createDataFrame([("[1,2]",), ("[1],[2]",)], "raw string"), "raw",
                             '{"type":"ARRAY","next":{"type":"BIGINT"}}').collect()
    assert [r.value for r in listed] == [[1, 2], None]


def test_overlay_copies_computed_columns_without_watermark(spark):
    base = spark.createDataFrame([(1646027324,)], "event_time bigint")
    ov = CAT.Overlay(computed={"secs": "event_time div 1000"})
    view = CAT.table_overlay(base, ov)
    assert view.columns == ["event_time", "secs"] and view.first().secs == 1646027
    assert not view.isStreaming


def test_a_declared_table_is_initialised_once_and_its_options_merge(spark):
    tables = CAT.DeclaredTables(spark)
    data = spark.createDataFrame([(1646027324,)], "event_time bigint")
    ov = CAT.Overlay(computed={"ts": "timestamp_millis(event_time)"}, watermark=("ts", "5 seconds"),
                     options={"properties.group.id": "mine", "extra": "1"})
    tables.initialise("once_only", data, {"topic": "t", "properties.group.id": "theirs"}, ov)
    assert tables.options("once_only") == {"topic": "t", "properties.group.id": "mine", "extra": "1"}
    assert spark.table("once_only").columns == ["event_time", "ts"]
    assert {r.name: r.watermark for r in tables.describe("once_only").collect()}["ts"] != ""
    with pytest.raises(ValueError, match="already"):
        tables.initialise("once_only", data, {}, CAT.Overlay())
    with pytest.raises(ValueError, match="unknown column"):
        tables.initialise("other", data, {}, CAT.Overlay(columns=["nope"]))
    spark.catalog.dropTempView("once_only")


def test_one_rule_set_for_type_texts(spark):
    texts = ["BIGINT", "BIGINT(5)", "DECIMAL(32, 2)", "DECIMAL(50,2)", "DECIMAL(5)", "DECIMAL(4,5)", "DECIMAL", "TIMESTAMP(3)",
             "TIMESTAMP(99)", "TIMESTAMP", "TIME", "TIME(0)", "TINYINT", " int ", "BYTES", "STRING(3)", "DECIMAL(3,2,1)", "", "X("]
    rows = TY.resolve_simple_types(spark.createDataFrame([(t,) for t in texts], "t string"), "t", spark).collect()
    for r in rows:
        try:
            own = TY.simple_type_ddl(r.t)
        except ValueError:
            own = None
        assert own == r.spark_type, r
    assert sum(r.spark_type is not None for r in rows) == 7
