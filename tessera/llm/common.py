"""Shared pieces: table access, shared-folder scratch tables, checked broadcast,
Arrow text slices."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import checkpoint_dir

#: Measured bytes up to which a side may be broadcast.
BROADCAST_BYTES = 16 << 20
#: Text bytes that one vectorised step inside a task works on.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` below the shared checkpoint folder and read it back.

    The files are on storage every executor sees, so a lost executor costs a
    re-read and not a recomputation. ``dropped`` removes them after the last use.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Remove tables that ``written`` made, once nothing that is still to run reads them."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all values of a written table, by one aggregate over it: 16 for a number,
    the length of strings and binaries, and for other types twice their JSON text."""
    total = F.lit(0)
    for f in df.schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            total = total + 16 + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
            total = total + 16 * (1 + F.greatest(F.size(c), F.lit(0)))
        elif isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
            total = total + 16 + 2 * F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        else:
            total = total + 16
    return df.agg(F.sum(total.cast("bigint"))).first()[0] or 0


def small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint for a written table of at most ``max_bytes``, measured; a larger
    one joins by shuffle."""
    return F.broadcast(df) if measured_bytes(df) <= max_bytes else df


def fold(label: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(label.cast("string"), F.lit("")).cast("binary")) % modulus


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Texts of one byte a character take the fast built-in."""
    slow = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(slow)


def cluster_parallelism(spark: SparkSession) -> int:
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def text_slices(batch: pa.RecordBatch, column: str = "text",
                max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a batch's text column into runs of whole rows of about ``max_bytes``.

    Yields (first row, end row, UTF-8 bytes, row offsets into them); null is
    empty. A row longer than ``max_bytes`` is a run of its own, never cut.
    """
    texts = batch.column(batch.schema.get_field_index(column))
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type)
    n = len(texts)
    if not n:
        return
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + n + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + max_bytes, side="right")) - 1
        b = min(n, max(b, a + 1))
        yield a, b, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


def strings(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, str]]:
    """(row, text) with null as empty, one Python string at a time."""
    texts = batch.column(batch.schema.get_field_index(column))
    for i in range(len(texts)):
        v = texts[i].as_py()
        yield i, v if v is not None else ""
