"""Structured Streaming forms of the declared-table queries (group D).

* Tables are read where they are with ``readStream`` (``file_stream``).
* Event time: a watermark on a TIMESTAMP column (NTZ columns are cast first).
  Windowed aggregates run in append mode: a window comes out once, when the
  watermark has passed its end, and its state is dropped; rows that arrive for
  it later are late and dropped.
* Arrivals: ``land`` is an ingest stream that lands rows in one folder for each
  arrival batch, and ``run_landed`` runs a query over them as scheduled runs do,
  one batch a run, always from the same checkpoint.
* Running aggregates keep their current result in the state store, and
  ``aggregate_state`` reads it from the query's checkpoint with Spark's state data
  source. No copy of the result is kept beside it.
* Aggregates of aggregates: ``retractions`` turns a changed inner row into its old
  value with sign -1 and its new value with sign +1, so the outer sums add and
  subtract in a second query.
* Several sinks per stream: one ``foreachBatch`` writes all of them, paths
  keyed by batch id so a retried batch replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tessera.session import scratch_path


def file_stream(spark: SparkSession, path: str, schema=None, files_per_batch: int | None = None) -> DataFrame:
    """A parquet file or folder as a stream. All files that are there make one
    micro-batch, or ``files_per_batch`` each."""
    reader = spark.readStream.schema(schema if schema is not None else spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # The file source takes a folder or a pattern, and a single file as the latter.
    return reader.parquet(f"{path.rstrip('/')}*")


def run_available(stream_writer, checkpoint: str) -> StreamingQuery:
    """Process everything available now in micro-batches, then stop."""
    q = stream_writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def appended(stream: DataFrame) -> DataFrame:
    """Run an append-mode stream into parquet files; the batch read of them."""
    spark = stream.sparkSession
    out = scratch_path(spark, "stream-out")
    run_available(stream.writeStream.outputMode("append").format("parquet").option("path", out),
                  scratch_path(spark, "ckpt"))
    return spark.read.schema(stream.schema).parquet(out)


class Landing:
    """Rows of a stream, landed below one folder for each arrival batch."""

    def __init__(self, spark: SparkSession, path: str, schema, batches: list[int]):
        self.spark, self.path, self.schema, self.batches = spark, path, schema, batches

    def stream(self, batch: int) -> DataFrame:
        # As a pattern, of this one folder: a restart also looks at the last run's files,
        # which would not be below a plain path.
        name = str(batch)
        return self.spark.readStream.schema(self.schema).parquet(f"{self.path}/arrived={name[:-1]}[{name[-1]}]")


def land(stream: DataFrame, batch: Column) -> Landing:
    """An ingest stream: ``batch`` (an integer) names the arrival batch of a row."""
    spark = stream.sparkSession
    path = scratch_path(spark, "landing")
    rows = stream.withColumn("arrived", batch.cast("bigint"))
    run_available(rows.writeStream.outputMode("append").format("parquet").partitionBy("arrived").option("path", path),
                  scratch_path(spark, "ckpt"))
    there = spark.read.schema(rows.schema).parquet(path).select("arrived").distinct().collect()
    return Landing(spark, path, stream.schema, sorted(r[0] for r in there))


def run_landed(landing: Landing, to_writer: Callable[[DataFrame], object]) -> str:
    """One run for each arrival batch, in order, each a restart from the checkpoint
    whose path is returned. ``to_writer(stream) -> DataStreamWriter`` (sink and mode set)."""
    checkpoint = scratch_path(landing.spark, "ckpt")
    for batch in landing.batches:
        run_available(to_writer(landing.stream(batch)), checkpoint)
    return checkpoint


def with_event_time(df: DataFrame, col: str, delay: str) -> DataFrame:
    """``WATERMARK FOR col AS col - INTERVAL delay`` (D1; D2 is delay 0)."""
    if dict(df.dtypes)[col] == "timestamp_ntz":
        df = df.withColumn(col, F.col(col).cast("timestamp"))
    return df.withWatermark(col, delay)


def closed_windows(landing: Landing, ts: str, delay: str, width: str, by: list[str],
                   aggregates: dict[str, Column]) -> DataFrame:
    """The windows (window_start, *by, aggregates) that the watermark has closed after
    the last arrival batch; rows that came after their window was closed are dropped."""
    spark = landing.spark
    out = scratch_path(spark, "windows")
    checked = {}

    def writer(stream: DataFrame):
        rows = (with_event_time(stream, ts, delay).groupBy(F.window(ts, width), *by)
                .agg(*[c.alias(n) for n, c in aggregates.items()])
                .select(F.col("window.start").alias("window_start"), *by, *aggregates))
        checked["schema"] = rows.schema
        return rows.writeStream.outputMode("append").format("parquet").option("path", out)

    run_landed(landing, writer)
    if not checked:  # nothing has arrived
        rows = with_event_time(spark.createDataFrame([], landing.schema), ts, "0 seconds")
        return (rows.groupBy(F.window(ts, width), *by).agg(*[c.alias(n) for n, c in aggregates.items()])
                .select(F.col("window.start").alias("window_start"), *by, *aggregates))
    return spark.read.schema(checked["schema"]).parquet(out)


def dedup_stream(df: DataFrame, key: list[str], ts_col: str, delay: str) -> DataFrame:
    """Declared primary key on a stream: the first row per key within the
    watermark delay is kept (D3)."""
    return with_event_time(df, ts_col, delay).dropDuplicatesWithinWatermark(key)


def running_aggregate(aggregate: DataFrame) -> str:
    """Run an update-mode aggregate over what is available; its checkpoint."""
    checkpoint = scratch_path(aggregate.sparkSession, "ckpt")
    run_available(aggregate.writeStream.outputMode("update").format("noop"), checkpoint)
    return checkpoint


def aggregate_state(spark: SparkSession, checkpoint: str, keys: list[str], values: list[str]) -> DataFrame:
    """The current rows of a running aggregate, read from its state store. ``keys`` and
    ``values`` name the grouping columns and aggregates in their order; an aggregate
    must keep one number (sums of integers, counts, minima and maxima do)."""
    state = spark.read.format("statestore").load(checkpoint)
    parts = []
    for struct, names in (("key", keys), ("value", values)):
        fields = state.schema[struct].dataType.fields
        if len(fields) != len(names):
            raise ValueError(f"the state's {struct} has the fields {[f.name for f in fields]}, not {names}")
        # By position: two sums have one field name in the state.
        named = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, fields, strict=True)])
        parts.append(F.col(struct).cast(named).alias(struct))
    return state.select(*parts).select("key.*", "value.*")


def multi_sink_writer(targets: dict[str, str],
                      writers: dict[str, Callable[[DataFrame], DataFrame]]):
    """Writer factory: several outputs of one stream (D8). Each batch is
    persisted once and every writer's rows go to ``<target>/batch_id=<n>``,
    so a retried batch replaces its own output."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, fn in writers.items():
                fn(batch).write.mode("overwrite").parquet(f"{targets[name]}/batch_id={batch_id}")
        finally:
            batch.unpersist()
    return lambda stream: stream.writeStream.foreachBatch(write)
