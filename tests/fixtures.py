"""Metadata of the declared sample tables."""

from pyspark.sql import SparkSession

from tessera.sources.metadata import COL_SCHEMA, CONN_SCHEMA, DB_SCHEMA, Metadata


def fixture_metadata(spark: SparkSession) -> Metadata:
    """A generated table and a Kafka table."""
    # The declared sample tables.
    dbs = [(1, "test", "datagen_sou", None), (2, "test", "ka_test", None)]
    conn = [(1, "connector", "datagen"), (2, "connector", "kafka"), (2, "format", "json"),
            (2, "properties.bootstrap.servers", "test:9092"),
            (2, "properties.group.id", "test_group1"),
            (2, "scan.startup.mode", "earliest-offset"), (2, "topic", "test")]
    cols = [
        (1, 1, "array_array", '{"type":"ARRAY","next":{"type":"ARRAY","next":{"type":"STRING"}}}', None),
        (1, 1, "map_map_nested", '{"type":"MAP","key":{"type":"STRING"},"value":{"type":"MAP",'
                                 '"key":{"type":"STRING"},"value":{"type":"INTEGER"}}}', None),
        (1, 1, "nested_struct", '{"type":"STRUCT","field":[{"type":"TIME","name":"start_time"},'
                                '{"type":"STRUCT","name":"inside_row","field":[{"type":"STRING",'
                                '"name":"ins"}]}]}', None),
        (1, 0, "order_number", "BIGINT", None),
        (1, 0, "order_time", "TIMESTAMP(3)", None),
        (1, 0, "price", "DECIMAL(32,2)", None),
        (1, 1, "simple_struct", '{"type":"STRUCT","field":[{"type":"TIME","name":"start_time"}]}', None),
        (1, 1, "tags", '{"type":"ARRAY","next":{"type":"STRING"}}', None),
        (2, 0, "event_time", "BIGINT", None),
        (2, 0, "for_datetime", "STRING", None),
    ]
    return Metadata(spark.createDataFrame(dbs, DB_SCHEMA), spark.createDataFrame(conn, CONN_SCHEMA),
                    spark.createDataFrame(cols, COL_SCHEMA))
