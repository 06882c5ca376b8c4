"""Declared type texts -> Spark types.

Simple types are resolved as DataFrame expressions over many declaration
rows at once (one regex extraction and a join to a small mapping table).
Nested types are JSON type trees; one tree is turned into a DDL string on
the driver (it is a type, not data) and applied to all rows by ``from_json``.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Declared simple type heads and the Spark type each maps to.
# ``P`` / ``S`` stand for the declared precision and scale.
TYPE_HEADS = [
    ("STRING", "string", "exact"),
    ("BOOLEAN", "boolean", "exact"),
    ("BYTE", "binary", "exact"),
    ("BYTES", "binary", "alias"),
    ("SMALLINT", "smallint", "exact"),
    ("INTEGER", "int", "exact"),
    ("INT", "int", "alias"),
    ("LONG", "bigint", "exact"),
    ("BIGINT", "bigint", "exact"),
    ("FLOAT", "float", "exact"),
    ("DOUBLE", "double", "exact"),
    ("DECIMAL", "decimal(P,S)", "exact"),
    ("DATE", "date", "exact"),
    ("TIME", "time(0)", "exact"),
    ("TIMESTAMP", "timestamp_ntz", "exact"),
]
NEEDS_PARAMS = {"DECIMAL": 2, "TIMESTAMP": 1}


def type_heads(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TYPE_HEADS, "head string, spark_template string, rule string")


def resolve_simple_types(decl: DataFrame, type_col: str, spark: SparkSession) -> DataFrame:
    """Adds head, params, spark_type, rule, status to declaration rows (B2).

    status: ok | unsupported | missing parameters | bad parameters. Spaces
    inside the parameter list are accepted; the documented aliases INT and
    BYTES resolve with rule 'alias'.
    """
    t = F.upper(F.trim(F.col(type_col)))
    with_parts = (decl
                  .withColumn("head", F.regexp_extract(t, r"^([A-Z_]+)", 1))
                  .withColumn("_args", F.regexp_extract(t, r"^[A-Z_]+\s*(\((.*)\))?\s*$", 2))
                  .withColumn("_shape_ok", t.rlike(r"^[A-Z_]+\s*(\(\s*\d+\s*(,\s*\d+\s*)?\))?$"))
                  .withColumn("params", F.transform(F.regexp_extract_all(F.col("_args"), F.lit(r"(\d+)"), 1),
                                                    lambda x: x.cast("int"))))
    j = with_parts.join(F.broadcast(type_heads(spark)), "head", "left")
    need = F.coalesce(*[F.when(F.col("head") == h, F.lit(n)) for h, n in NEEDS_PARAMS.items()],
                      F.lit(0))
    p0, p1 = F.element_at("params", 1), F.element_at("params", 2)
    prec_ok = (F.when(F.col("head") == "DECIMAL", (p0 >= 1) & (p0 <= 38) & (p1 >= 0) & (p1 <= p0))
               .when(F.col("head") == "TIMESTAMP", (p0 >= 0) & (p0 <= 9))
               .otherwise(F.lit(True)))
    status = (F.when(F.col("spark_template").isNull(), "unsupported")
              .when(~F.col("_shape_ok"), "bad parameters")
              .when(F.size("params") < need, "missing parameters")
              .when((need == 0) & (F.size("params") > 0) & (F.col("head") != "TIME"), "bad parameters")
              .when(~prec_ok, "bad parameters")
              .otherwise("ok"))
    spark_type = F.when(status == "ok", F.when(
        F.col("head") == "DECIMAL",
        F.format_string("decimal(%d,%d)", p0, p1)).otherwise(F.col("spark_template")))
    return (j.withColumn("status", status).withColumn("spark_type", spark_type)
            .drop("_args", "_shape_ok", "spark_template"))


_SIMPLE = {h: tmpl for h, tmpl, _ in TYPE_HEADS}


_TYPE_TEXT = re.compile(r"([A-Z_]+)\s*(?:\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?")


def simple_type_ddl(text: str) -> str:
    """One simple type text -> Spark DDL type (driver side, for type trees), by the
    rules of ``resolve_simple_types``; what those refuse raises."""
    found = _TYPE_TEXT.fullmatch(text.strip().upper())
    head = found[1] if found else text.split("(", 1)[0].strip().upper()
    if head not in _SIMPLE:
        raise ValueError(f"unsupported type {text!r}")
    if found is None:
        raise ValueError(f"bad parameters in type {text!r}")
    args = [int(a) for a in found.groups()[1:] if a is not None]
    need = NEEDS_PARAMS.get(head, 0)
    if len(args) < need:
        raise ValueError(f"type {text!r} needs {need} parameter(s)")
    refused = args and need == 0 and head != "TIME"
    if head == "DECIMAL":
        refused = not (1 <= args[0] <= 38 and 0 <= args[1] <= args[0])
    if head == "TIMESTAMP":
        refused = args[0] > 9
    if refused:
        raise ValueError(f"bad parameters in type {text!r}")
    return f"decimal({args[0]},{args[1]})" if head == "DECIMAL" else _SIMPLE[head]


def tree_to_ddl(tree: str | dict, time_as_string: bool = False) -> str:
    """JSON type tree (ARRAY/next, MAP/key/value, STRUCT/field[name,type]) -> DDL.

    ``time_as_string`` reads TIME leaves as text, for parsers that refuse TIME.
    """
    node = json.loads(tree) if isinstance(tree, str) else tree
    kind = node["type"].upper()
    if kind == "ARRAY":
        return f"array<{tree_to_ddl(node['next'], time_as_string)}>"
    if kind == "MAP":
        return (f"map<{tree_to_ddl(node['key'], time_as_string)},"
                f"{tree_to_ddl(node['value'], time_as_string)}>")
    if kind == "STRUCT":
        fields = ",".join(f"`{f['name']}`:{tree_to_ddl(f, time_as_string)}" for f in node["field"])
        return f"struct<{fields}>"
    if kind == "TIME" and time_as_string:
        return "string"
    return simple_type_ddl(node["type"])


def conform_json(df: DataFrame, col: str, tree: str | dict, out: str = "value") -> DataFrame:
    """Raw JSON rows read as a declared nested type (B3): adds ``out`` (the
    typed value, null for misfits) and ``out_bad`` (text did not conform).

    A row is one JSON value. It is read once as the only field of an object and
    once as the only element of an array: text after the value fails one of the
    two. A bare ``null`` does not conform.
    """
    ddl = tree_to_ddl(tree, time_as_string=True)
    schema = f"struct<v:{ddl},_corrupt_record:string>"
    wrapped = F.concat(F.lit('{"v":'), F.col(col), F.lit("}"))
    parsed = F.from_json(wrapped, schema, {"mode": "PERMISSIVE",
                                           "columnNameOfCorruptRecord": "_corrupt_record"})
    alone = F.from_json(F.concat(F.lit("["), F.col(col), F.lit("]")), "array<string>")
    bad = (parsed.getField("_corrupt_record").isNotNull() | parsed.getField("v").isNull()
           | ~F.coalesce(F.size(alone) == 1, F.lit(False)))
    return df.withColumn(out, F.when(~bad, parsed.getField("v"))).withColumn(f"{out}_bad", bad)
