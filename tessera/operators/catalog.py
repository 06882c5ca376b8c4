"""Metadata-driven tables as Spark jobs over the metadata rows (group B).

Definitions, audits and option rules run over all declared tables at once;
registration then applies a definition to data (computed columns, one
watermark, a key, options).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import types as TY
from tessera.functions.text import sql_ident, sql_string
from tessera.sources.metadata import Metadata

# The registered connectors and, per connector, the option keys
# that are the connector's own (every other key is a client property and gets
# the property prefix).
KNOWN_CONNECTORS = ("kafka", "datagen")
KAFKA_OWN_KEYS = (
    "connector", "sink.semantic", "sink.parallelism", "topic", "format", "topic-pattern",
    "key.format", "key.fields", "key.fields-prefix", "value.format", "value.fields-include",
    "scan.startup.mode", "scan.startup.specific-offsets", "scan.startup.timestamp-millis",
    "scan.topic-partition-discovery.interval", "json.ignore-parse-errors",
)
PROPERTY_PREFIX = "properties."


def option_pairs_unique(conn: DataFrame, key_cols=("table_id", "key")) -> DataFrame:
    """One row per (table, key): the largest value wins (an aggregate, so a
    table with very many option rows is reduced per task first)."""
    return conn.groupBy(*key_cols).agg(F.max("value").alias("value"))


def table_definitions(md: Metadata) -> DataFrame:
    """One row per declared table (B1): sorted columns and an options map.

    Options are reduced to one row per (table, key) before collecting, so a
    table's list is bounded by its number of distinct keys and a map never
    sees a duplicate key.
    """
    cols = (md.schemas.groupBy("table_id").agg(F.array_sort(F.collect_list(F.struct(
        "schema_name", "schema_root", "schema_type"))).alias("columns")))
    opts = (option_pairs_unique(md.conn_info).groupBy("table_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("options")))
    return (md.databases.join(cols, "table_id", "left").join(opts, "table_id", "left")
            .select("table_id", "db_name", "table_name", "columns", "options"))


def options_text(opts: Column) -> Column:
    """'k1=v1,k2=v2' sorted by key: a comparable text of an options map."""
    entries = F.array_sort(F.map_entries(opts))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")


def connector_audit(conn: DataFrame, known=KNOWN_CONNECTORS) -> DataFrame:
    """Per table: connector count and value, status ok | no connector |
    several connectors | unknown connector (B4)."""
    is_conn = F.col("key") == "connector"
    per = conn.groupBy("table_id").agg(
        F.count_if(is_conn).alias("connectors"),
        F.max(F.when(is_conn, F.col("value"))).alias("connector"))
    known_arr = F.array(*[F.lit(k) for k in known])
    status = (F.when(F.col("connectors") == 0, "no connector")
              .when(F.col("connectors") > 1, "several connectors")
              .when(~F.array_contains(known_arr, F.col("connector")), "unknown connector")
              .otherwise("ok"))
    return per.withColumn("status", status)


def option_prefix(conn: DataFrame, connector_of: DataFrame,
                  own_keys: dict[str, tuple] | None = None,
                  prefix: str = PROPERTY_PREFIX) -> DataFrame:
    """Client-property prefix on keys that are not the connector's own.

    Idempotent: a key that already carries the prefix is left alone.
    ``connector_of`` is (table_id, connector); connectors without a rule
    (datagen) keep their keys as they are.
    """
    own_keys = own_keys or {"kafka": KAFKA_OWN_KEYS}
    j = conn.join(connector_of.select("table_id", "connector"), "table_id", "left")
    new_key = F.col("key")
    for name, keys in own_keys.items():
        own = F.array(*[F.lit(k) for k in keys])
        new_key = F.when((F.col("connector") == name) & ~F.array_contains(own, F.col("key"))
                         & ~F.col("key").startswith(prefix), F.concat(F.lit(prefix), F.col("key"))
                         ).otherwise(new_key)
    return j.select("table_id", new_key.alias("key"), "value")


def option_override(template: DataFrame, user: DataFrame, keys=("table_id",)) -> DataFrame:
    """Long form: user options win over template options, key by key."""
    t = template.select(*keys, "key", F.col("value").alias("_t"))
    u = user.select(*keys, "key", F.col("value").alias("_u"))
    return (t.join(u, [*keys, "key"], "full")
            .select(*keys, "key", F.coalesce("_u", "_t").alias("value"),
                    F.when(F.col("_u").isNotNull(), "user").otherwise("template").alias("source")))


def map_override(template: Column, user: Column) -> Column:
    """Map form of B6 (plain map_concat refuses duplicate keys)."""
    kept = F.filter(F.map_entries(template), lambda e: ~F.map_contains_key(user, e["key"]))
    return F.map_from_entries(F.concat(kept, F.map_entries(user)))


@dataclass
class Overlay:
    """What a user adds when registering a declared table."""
    computed: dict[str, str] = field(default_factory=dict)   # name -> SQL expression
    watermark: tuple[str, str] | None = None                 # (column, delay)
    primary_key: list[str] = field(default_factory=list)
    options: dict[str, str] = field(default_factory=dict)
    columns: list[str] = field(default_factory=list)         # columns the user names


def check_overlay(template_cols: list[str], ov: Overlay) -> list[str]:
    """Problems with an overlay: unknown columns, watermark or key on a
    column that does not exist."""
    known = set(template_cols) | set(ov.computed)
    errs = [f"unknown column {c}" for c in ov.columns if c not in known]
    if ov.watermark and ov.watermark[0] not in known:
        errs.append(f"watermark on unknown column {ov.watermark[0]}")
    errs += [f"key on unknown column {c}" for c in ov.primary_key if c not in known]
    return errs


def table_overlay(data: DataFrame, ov: Overlay) -> DataFrame:
    """Declared columns + computed columns (always), then the watermark."""
    errs = check_overlay(data.columns, ov)
    if errs:
        raise ValueError("; ".join(errs))
    out = data
    for name, expr in ov.computed.items():
        out = out.withColumn(name, F.expr(expr))
    if ov.watermark:
        col, delay = ov.watermark
        if dict(out.dtypes)[col] == "timestamp_ntz":
            out = out.withColumn(col, F.col(col).cast("timestamp"))
        out = out.withWatermark(col, delay)
    return out


class DeclaredTables:
    """The declared tables that a user has initialised in a session.

    ``initialise`` puts the computed columns and the watermark of an overlay into a
    view of the table's name and merges the options by key, the user's over the
    declared ones. A table is initialised once.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._done: dict[str, tuple[dict, Overlay]] = {}

    def initialise(self, name: str, data: DataFrame, options: dict[str, str], ov: Overlay) -> DataFrame:
        if name in self._done:
            raise ValueError(f"table {name} has been initialised already")
        view = table_overlay(data, ov)
        view.createOrReplaceTempView(name)
        self._done[name] = ({**options, **ov.options}, ov)
        return view

    def options(self, name: str) -> dict[str, str]:
        """The merged options of an initialised table."""
        return dict(self._done[name][0])

    def describe(self, name: str) -> DataFrame:
        return describe_schema(self.spark, self.spark.table(name), self._done[name][1])


def merged_options(definitions: DataFrame, user: DataFrame, keys=("table_id",)) -> DataFrame:
    """``definitions`` (keys, options map, ...) with the options of ``user`` (keys, key,
    value) put over the declared ones: B6 in map form, for a whole estate."""
    own = option_pairs_unique(user, [*keys, "key"]).groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("_user"))
    none = F.create_map().cast("map<string,string>")
    merged = map_override(F.coalesce("options", none), F.coalesce("_user", none))
    return definitions.join(own, [*keys], "left").withColumn("options", merged).drop("_user")


def describe_schema(spark: SparkSession, data: DataFrame, ov: Overlay | None = None) -> DataFrame:
    """Rows name, type, null, key, extras, watermark of a registered table."""
    ov = ov or Overlay()
    rows = []
    wm_col, wm_delay = ov.watermark or (None, None)
    for f in data.schema.fields:
        rows.append((f.name, f.dataType.simpleString(), f.nullable,
                     "PRI" if f.name in ov.primary_key else "",
                     f"AS {ov.computed[f.name]}" if f.name in ov.computed else "",
                     f"`{f.name}` - INTERVAL '{wm_delay}'" if f.name == wm_col else ""))
    return spark.createDataFrame(rows, "name string, type string, null boolean, key string, "
                                       "extras string, watermark string")


def schema_conformance(spark: SparkSession, data: DataFrame, declared: DataFrame) -> DataFrame:
    """Declared columns (name, type text) against the data's real columns.

    Per column: declared and actual Spark type, status (same | castable |
    declared only | undeclared | unsupported declaration) and how many
    non-null values fail a ``try_cast`` to the declared type -- all counted
    in one aggregate pass over the data.
    """
    resolved = TY.resolve_simple_types(declared, "type_text", spark)
    actual = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in data.schema.fields],
                                   "name string, actual_type string")
    both = resolved.select("name", "type_text", "spark_type", F.col("status").alias("decl_status")) \
        .join(actual, "name", "full")
    # One pass: failure counts for every declared column present in the data.
    decl = {r.name: r.spark_type for r in both.where(
        F.col("actual_type").isNotNull() & F.col("spark_type").isNotNull()).collect()}
    if decl:
        fails = data.agg(*[F.count_if(F.col(sql_ident(n)).isNotNull()
                                      & F.expr(f"try_cast({sql_ident(n)} as {t})").isNull()).alias(n)
                           for n, t in sorted(decl.items())])
        stack = ", ".join(f"{sql_string(n)}, {sql_ident(n)}" for n in sorted(decl))
        fail_rows = fails.selectExpr(f"stack({len(decl)}, {stack}) as (name, cast_failures)")
    else:
        fail_rows = spark.createDataFrame([], "name string, cast_failures bigint")
    status = (F.when(F.col("actual_type").isNull(), "declared only")
              .when(F.col("type_text").isNull(), "undeclared")
              .when(F.col("spark_type").isNull(), "unsupported declaration")
              .when(F.col("spark_type") == F.col("actual_type"), "same")
              .when(F.coalesce(F.col("cast_failures"), F.lit(0)) == 0, "castable")
              .otherwise("cast failures"))
    return (both.join(fail_rows, "name", "left")
            .select("name", F.col("type_text").alias("declared"), "spark_type", "actual_type",
                    F.col("cast_failures").cast("bigint").alias("cast_failures"),
                    status.alias("status")))


def column_ddl(schema_root: int, schema_type: str) -> str:
    """Spark type of one declared column: simple text (root 0) or JSON tree."""
    return TY.simple_type_ddl(schema_type) if schema_root == 0 else TY.tree_to_ddl(schema_type)


def register_declared_tables(spark: SparkSession, md: Metadata, rows: int | None = None,
                             kafka_available: bool = False) -> DataFrame:
    """Make every declared table of ``md`` queryable as a temp view named like
    the table; returns (table_name, connector, status, schema) per table.

    Definitions are metadata (a handful of rows per table), assembled by the
    Spark jobs above and read on the driver to create the views. A generated
    table has its ``number-of-rows``, else ``rows``; with neither it is unbounded
    and becomes a streaming view. Kafka tables need the Kafka package, otherwise
    they are reported and skipped.
    """
    from tessera.sources import datagen as G
    from tessera.sources import kafka as K

    audit = {r.table_id: r for r in connector_audit(md.conn_info).collect()}
    conn_of = connector_audit(md.conn_info).select("table_id", "connector")
    opts = option_prefix(option_pairs_unique(md.conn_info), conn_of)
    defs = table_definitions(Metadata(md.databases, opts, md.schemas)).collect()
    out = []
    for d in defs:
        a = audit.get(d.table_id)
        connector = a.connector if a else None
        cols = [(c.schema_name, column_ddl(c.schema_root, c.schema_type)) for c in (d.columns or [])]
        schema = ", ".join(f"{sql_ident(n)} {t}" for n, t in cols)
        status = a.status if a else "no connector"
        if status == "ok" and connector == "datagen":
            own = dict(d.options or {})
            n = own.get("number-of-rows", rows)
            made = (G.generate_declared_stream(spark, cols, own) if n is None
                    else G.generate_declared(spark.range(int(n)), "id", cols, own))
            made.createOrReplaceTempView(d.table_name)
            status = "registered as stream" if n is None else "registered"
        elif status == "ok" and connector == "kafka":
            if kafka_available:
                K.kafka_source(spark, dict(d.options), value_schema=schema).createOrReplaceTempView(
                    d.table_name)
                status = "registered"
            else:
                status = "kafka package not available"
        out.append((d.table_name, connector, status, schema))
    return spark.createDataFrame(out, "table_name string, connector string, status string, "
                                      "schema string")
