"""JSON payloads read with a declared schema (A1) and bad-row handling (A2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def parse_json(df: DataFrame, col: str, schema: str | T.StructType, mode: str = "PERMISSIVE",
               out: str = "parsed") -> DataFrame:
    """Adds struct ``out`` parsed from JSON text ``col`` under a declared schema.

    PERMISSIVE keeps malformed rows: their fields are null and the raw text
    lands in ``out._corrupt_record``; FAILFAST stops the job on the first bad
    row (the 'do not ignore parse errors' setting).
    """
    st = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if mode == "PERMISSIVE" and CORRUPT not in st.fieldNames():
        st = st.add(CORRUPT, T.StringType())
    opts = {"mode": mode}
    if mode == "PERMISSIVE":
        opts["columnNameOfCorruptRecord"] = CORRUPT
    return df.withColumn(out, F.from_json(F.col(col), st, opts))


def split_bad_rows(parsed: DataFrame, out: str = "parsed") -> tuple[DataFrame, DataFrame]:
    """(good, quarantine): one parse, two filtered views of it."""
    bad = F.col(f"{out}.{CORRUPT}").isNotNull()
    return parsed.where(~bad), parsed.where(bad)


def json_file_stream(spark, path: str, schema: str | T.StructType, max_files: int | None = None):
    """Replay of JSON files as a stream with a declared schema (no inference)."""
    r = spark.readStream.schema(schema).option("mode", "PERMISSIVE")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.json(path)
