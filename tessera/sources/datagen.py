"""Generated rows (A4, D9): per-field arithmetic on a row number.

Every field is a pure integer expression of the row id, so the same rows come
out in batch (``spark.range`` or the ids of a table) and in a stream (the
``rate`` source's ``value``) -- no ``rand()``. Values are taken from the high bits
of a linear congruential step, whose low bits repeat after a few rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Linear congruential step (multiplier, increment, modulus).
LCG_A, LCG_C, LCG_M = 1103515245, 12345, 2147483648


@dataclass(frozen=True)
class Field:
    name: str
    type: str                 # INT, BIGINT, DOUBLE, STRING, DECIMAL(p,s)
    kind: str = "random"      # random | sequence
    min: float = 0
    max: float = 100
    length: int = 8           # STRING length


def _below(r: str, n: int) -> str:
    """``r`` (of 31 bits) scaled to 0 .. n - 1 by its high bits; n up to 2^31."""
    return f"shiftright({r} * {n}L, 31)"


def field_sql(f: Field, idx: int, id_col: str = "id") -> str:
    """SQL text of one generated field."""
    if f.kind == "sequence":
        base = f"({int(f.min)} + {id_col})"
        return f"cast({base} as {f.type})"
    # ids are reduced mod 2^31 first so the product stays inside bigint.
    r = (f"(((({id_col} + {idx * 7919}) % {LCG_M}) * {LCG_A} + {LCG_C}) % {LCG_M})")
    t = f.type.upper()
    if t in ("INT", "INTEGER", "BIGINT", "SMALLINT"):
        span = int(f.max) - int(f.min) + 1
        return f"cast({int(f.min)} + {_below(r, span)} as {t})"
    if t in ("DOUBLE", "FLOAT") or t.startswith("DECIMAL"):
        lo, hi = f"cast({float(f.min)} as double)", f"cast({float(f.max)} as double)"
        v = f"({lo} + cast({_below(r, 1000000)} as double) / 1000000 * ({hi} - {lo}))"
        return f"cast({v} as {t})" if t.startswith("DECIMAL") else v
    if t == "STRING":
        return f"substr(md5(cast({r} as string)), 1, {f.length})"
    raise ValueError(f"unsupported generated type {f.type}")


def generate_from_ids(ids: DataFrame, id_col: str, fields: list[Field]) -> DataFrame:
    """Generated columns for every row of ``ids`` (id column kept)."""
    return ids.select(F.col(id_col).alias("id")).selectExpr(
        "id", *[f"{field_sql(f, i)} as {f.name}" for i, f in enumerate(fields)])


def datagen(spark: SparkSession, fields: list[Field], rows: int,
            partitions: int | None = None) -> DataFrame:
    """Bounded generator: ``rows`` rows split over ``partitions`` tasks."""
    return generate_from_ids(spark.range(0, rows, numPartitions=partitions), "id", fields)


def datagen_stream(spark: SparkSession, fields: list[Field], rows_per_second: int = 5,
                   partitions: int | None = None) -> DataFrame:
    """Unbounded generator on the ``rate`` source (rows-per-second)."""
    r = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
    if partitions:
        r = r.option("numPartitions", partitions)
    s = r.load()
    return s.selectExpr("value as id", "timestamp as ts",
                        *[f"{field_sql(f, i, 'value')} as {f.name}" for i, f in enumerate(fields)])


# ---- declared types (simple or nested) -------------------------------------

def _rand(seed: str) -> str:
    """Pseudo-random non-negative integer below 2^31 from an integer SQL
    expression (same step as ``field_sql``)."""
    return f"(((({seed}) % {LCG_M}) * {LCG_A} + {LCG_C}) % {LCG_M})"


def typed_value_sql(ddl: str, seed: str) -> str:
    """SQL expression generating a value of Spark type ``ddl`` (as printed by
    ``simpleString``: ``array<...>``, ``map<k,v>``, ``struct<a:t,...>``, simple
    types) from integer ``seed``. Nested values hold two elements / entries."""
    t = ddl.strip()
    low = t.lower()
    r = _rand(seed)
    if low.startswith("array<"):
        inner = t[6:-1]
        return f"array({typed_value_sql(inner, f'{seed} * 31 + 1')}, {typed_value_sql(inner, f'{seed} * 31 + 2')})"
    if low.startswith("map<"):
        k, v = _split_top(t[4:-1])
        keys = [typed_value_sql(k, f"{seed} * 37 + {i}") for i in (1, 3)]
        one, two = (f"{key}, {typed_value_sql(v, f'{seed} * 37 + {i}')}" for key, i in zip(keys, (2, 4), strict=True))
        return f"if({keys[0]} <=> {keys[1]}, map({one}), map({one}, {two}))"  # a key stands once
    if low.startswith("struct<"):
        parts = []
        for i, f in enumerate(_split_top(t[7:-1])):
            name, ftype = f.split(":", 1)
            label = name.strip('`').replace("\\", "\\\\").replace("'", "\\'")
            parts.append(f"'{label}', {typed_value_sql(ftype, f'{seed} * 41 + {i + 1}')}")
        return f"named_struct({', '.join(parts)})"
    if low in ("int", "bigint", "smallint"):
        return f"cast({_below(r, 1000)} as {low})"
    if low in ("double", "float"):
        return f"cast(cast({_below(r, 1000000)} as double) / 100 as {low})"
    if low.startswith("decimal"):
        return f"cast(cast({_below(r, 100000000)} as double) / 100 as {low})"
    if low == "string":
        return f"substr(md5(cast({r} as string)), 1, 12)"
    if low == "boolean":
        return f"({_below(r, 2)} = 0)"
    if low == "binary":
        return f"unhex(substr(md5(cast({r} as string)), 1, 8))"
    if low == "date":
        return f"date_add(date'2020-01-01', cast({r} % 3650 as int))"
    if low.startswith("timestamp"):
        return f"cast(timestamp_seconds(1577836800 + {r} % 315360000) as timestamp_ntz)"
    if low.startswith("time"):
        return (f"cast(format_string('%02d:%02d:%02d', cast({r} % 24 as int), "
                f"cast({r} % 60 as int), cast(({r} div 60) % 60 as int)) as time(0))")
    raise ValueError(f"cannot generate values of type {ddl}")


def _split_top(body: str) -> list[str]:
    """Split 'a:int,b:map<string,int>' at top-level commas."""
    out, depth, cur = [], 0, ""
    for ch in body:
        if ch == "<":
            depth += 1
        elif ch == ">":
            depth -= 1
        if ch == "," and depth == 0:
            out.append(cur)
            cur = ""
        else:
            cur += ch
    out.append(cur)
    return out


def _ident(name: str) -> str:
    """A column name as a quoted SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


_SIMPLE_FIELD_TYPES = {"int": "INT", "bigint": "BIGINT", "smallint": "SMALLINT",
                       "double": "DOUBLE", "float": "FLOAT", "string": "STRING"}


def declared_columns_sql(columns: list[tuple[str, str]], options: dict[str, str] | None = None,
                         id_col: str = "id") -> list[str]:
    """SQL of every declared column (name, Spark type DDL).

    Generator options follow the declared-table form
    ``fields.<name>.kind`` (random | sequence), ``fields.<name>.min``,
    ``fields.<name>.max``, ``fields.<name>.length``; they apply to numeric
    and string columns. Other columns get type-driven values.
    """
    options = options or {}
    out = []
    for i, (name, ddl) in enumerate(columns):
        opt = {k[len(f"fields.{name}."):]: v for k, v in options.items()
               if k.startswith(f"fields.{name}.")}
        low = ddl.lower()
        simple = _SIMPLE_FIELD_TYPES.get(low) or (ddl.upper() if low.startswith("decimal") else None)
        if opt and simple:
            f = Field(name, simple, kind=opt.get("kind", "random"),
                      min=float(opt.get("min", 0)), max=float(opt.get("max", 100)),
                      length=int(opt.get("length", 8)))
            out.append(f"{field_sql(f, i, id_col)} as {_ident(name)}")
        else:
            out.append(f"{typed_value_sql(ddl, f'{id_col} + {i * 7919}')} as {_ident(name)}")
    return out


def generate_declared(ids: DataFrame, id_col: str, columns: list[tuple[str, str]],
                      options: dict[str, str] | None = None) -> DataFrame:
    """Rows for declared columns from the ids of a DataFrame: the
    generated-table connector for any declared schema."""
    return ids.select(F.col(id_col).alias("id")).selectExpr(
        *declared_columns_sql(columns, options, "id"))


def generate_declared_stream(spark: SparkSession, columns: list[tuple[str, str]],
                             options: dict[str, str] | None = None) -> DataFrame:
    """Unbounded form: the ``rate`` source at ``rows-per-second``."""
    options = options or {}
    s = (spark.readStream.format("rate")
         .option("rowsPerSecond", int(options.get("rows-per-second", 10000))).load())
    return s.selectExpr(*declared_columns_sql(columns, options, "value"))
