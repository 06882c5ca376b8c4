"""Kafka table options -> Structured Streaming Kafka source options (A3).

The declared-table options use one vocabulary, Spark's Kafka source another;
this is the translation, plus the list of options that have no Spark
counterpart (reported, not silently dropped).
"""

from __future__ import annotations

import json
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Options without a Spark source setting: partitions are discovered every
# micro-batch, and the sink is at-least-once.
IGNORED = ("scan.topic-partition-discovery.interval", "sink.semantic")
# Options that shape the rows rather than the connection.
FORMAT_KEYS = ("format", "key.format", "key.fields", "key.fields-prefix", "value.format",
               "value.fields-include", "json.ignore-parse-errors", "connector",
               "sink.parallelism")


def kafka_options(table_options: dict[str, str]) -> tuple[dict[str, str], dict[str, str], list[str]]:
    """(spark_options, row_options, ignored keys) for a declared Kafka table."""
    spark_opts: dict[str, str] = {}
    rows: dict[str, str] = {}
    ignored: list[str] = []
    for k, v in table_options.items():
        if k == "topic":
            spark_opts["subscribe"] = v.replace(";", ",")
        elif k == "topic-pattern":
            spark_opts["subscribePattern"] = v
        elif k.startswith("properties."):
            spark_opts["kafka." + k[len("properties."):]] = v
        elif k == "scan.startup.mode":
            mode = {"earliest-offset": "earliest", "latest-offset": "latest"}.get(v)
            if mode:
                spark_opts["startingOffsets"] = mode
            elif v == "specific-offsets" and "scan.startup.specific-offsets" not in table_options:
                raise ValueError("startup mode specific-offsets without its offsets")
            elif v == "timestamp" and "scan.startup.timestamp-millis" not in table_options:
                raise ValueError("startup mode timestamp without its milliseconds")
            elif v not in ("specific-offsets", "timestamp"):
                # group-offsets too: Spark keeps offsets in its checkpoint, not in the group.
                raise ValueError(f"startup mode {v!r} has no counterpart")
        elif k == "scan.startup.specific-offsets":
            spark_opts["startingOffsets"] = json.dumps(
                _specific_offsets(v, table_options.get("topic", "")))
        elif k == "scan.startup.timestamp-millis":
            spark_opts["startingTimestamp"] = v
        elif k in IGNORED:
            ignored.append(k)
        elif k in FORMAT_KEYS:
            rows[k] = v
        else:
            ignored.append(k)
    return spark_opts, rows, ignored


def _specific_offsets(text: str, topic: str) -> dict:
    """'partition:0,offset:42;partition:1,offset:300' -> {topic: {"0": 42, "1": 300}}."""
    if not topic or ";" in topic:
        raise ValueError(f"specific offsets need exactly one topic, not {topic!r}")
    out: dict[str, int] = {}
    for part in filter(None, text.split(";")):
        kv = dict(p.split(":", 1) for p in part.split(","))
        out[kv["partition"].strip()] = int(kv["offset"])
    return {topic: out}


def decode_kafka_rows(df: DataFrame, table_options: dict[str, str], schema: str) -> DataFrame:
    """Rows of a declared Kafka table from Kafka records (key, value binary).

    ``schema`` is the declared physical schema (DDL). With ``key.format`` =
    json, the ``key.fields`` columns come from the key, stored with the
    ``key.fields-prefix`` in front of their names; ``value.fields-include`` =
    EXCEPT_KEY leaves them out of the value, ALL (default) reads every column
    from the value. Bad JSON fails the job unless ``json.ignore-parse-errors``
    is true (then the row's fields are null).
    """
    from pyspark.sql import types as T
    _, rows, _ = kafka_options(table_options)
    st = T._parse_datatype_string(schema)
    key_fields = [k.strip() for k in rows.get("key.fields", "").split(";") if k.strip()]
    prefix = rows.get("key.fields-prefix", "")
    mode = "PERMISSIVE" if rows.get("json.ignore-parse-errors", "false") == "true" else "FAILFAST"
    value_fmt = rows.get("value.format", rows.get("format"))
    for option, fmt in (("value format", value_fmt), ("key format", rows.get("key.format", "json"))):
        if fmt != "json":
            raise ValueError(f"{option} {fmt!r} is not supported")
    except_key = rows.get("value.fields-include", "ALL").upper() == "EXCEPT_KEY"
    value_fields = [f for f in st.fields if not (except_key and f.name in key_fields)]
    cols = []
    from_key: set[str] = set()
    if key_fields and rows.get("key.format") == "json":
        from_key = set(key_fields)
        kst = T.StructType([T.StructField(f.name[len(prefix):] if f.name.startswith(prefix) else f.name,
                                          f.dataType) for f in st.fields if f.name in key_fields])
        k = F.from_json(F.col("key").cast("string"), kst, {"mode": mode})
        cols += [k[f.name[len(prefix):] if f.name.startswith(prefix) else f.name].alias(f.name)
                 for f in st.fields if f.name in key_fields]
    v = F.from_json(F.col("value").cast("string"), T.StructType(value_fields), {"mode": mode})
    cols += [v[f.name].alias(f.name) for f in value_fields if f.name not in from_key]
    return df.select(*cols)


def kafka_source(spark: SparkSession, table_options: dict[str, str], value_schema: str | None = None,
                 min_partitions: int | None = None) -> DataFrame:
    """Streaming DataFrame of a declared Kafka table (needs the Kafka package on
    the cluster). Records are decoded with ``decode_kafka_rows``; a
    parallelism request maps to ``minPartitions``."""
    opts, _, ignored = kafka_options(table_options)
    if ignored:
        warnings.warn(f"options without a counterpart: {', '.join(sorted(ignored))}", stacklevel=2)
    r = spark.readStream.format("kafka").options(**opts)
    if min_partitions:
        r = r.option("minPartitions", str(min_partitions))
    df = r.load()
    return decode_kafka_rows(df, table_options, value_schema) if value_schema else df
