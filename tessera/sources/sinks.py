"""Sinks: no-op (A5), named tables (A10), partitioned tables."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def noop_sink(df: DataFrame) -> None:
    """Run the whole plan and discard the rows (the black-hole sink)."""
    df.write.format("noop").mode("overwrite").save()


def table_sink(df: DataFrame, target: str, overwrite: bool = False, fmt: str = "parquet",
               partition_by: list[str] | None = None, parallelism: int | None = None) -> None:
    """Append to or overwrite a target: a path (contains '/') or a catalog
    table name. ``parallelism`` sets the number of writing tasks. An existing table
    keeps its format and partitioning: other partition columns are refused, and rows
    are matched to its columns by name."""
    if parallelism:
        df = df.repartition(parallelism)
    w = df.write.mode("overwrite" if overwrite else "append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if "/" in target:
        w.save(target)
    else:
        spark = df.sparkSession
        if spark.catalog.tableExists(target):
            own = partition_keys(spark, target)
            if partition_by and list(partition_by) != own:
                raise ValueError(f"{target} is partitioned by {own}, not by {list(partition_by)}")
            df.select(*spark.table(target).columns).write.insertInto(target, overwrite=overwrite)
        else:
            w.saveAsTable(target)


def partition_keys(spark: SparkSession, table_name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table_name) if c.isPartition]


def check_spec(spark: SparkSession, table_name: str, spec) -> None:
    """A partition spec names every partition column of the table and no other."""
    keys = partition_keys(spark, table_name)
    if set(spec) != set(keys):
        raise ValueError(f"partition spec {sorted(spec)} of {table_name} must name {sorted(keys)}")


def _spec_sql(spec: dict) -> str:
    def literal(v) -> str:
        return "null" if v is None else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    return ", ".join(f"`{k}` = {literal(v)}" for k, v in spec.items())


#: Files of different partitions that a writing task holds open; a task with more
#: partitions than this sorts its remaining rows by partition.
OPEN_FILES = 8


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    """A session setting for one write that takes no such write option."""
    prev = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, prev)


def create_partitioned_table(spark: SparkSession, name: str, df: DataFrame, part_cols: list[str],
                             location: str) -> None:
    """A catalog table over ``location`` partitioned by ``part_cols``, filled
    with ``df`` (E9 create). A task appends each row to its partition's open file, so that
    it needs no memory for all its rows, as the sort by partition of a plain write does."""
    unknown = [c for c in part_cols if c not in df.columns]
    if unknown or len(set(part_cols)) != len(part_cols) or set(part_cols) >= set(df.columns):
        raise ValueError(f"partition columns {part_cols} must be distinct columns of {df.columns}, and not all")
    with _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES)):
        (df.write.mode("overwrite").format("parquet").partitionBy(*part_cols)
         .option("path", location).saveAsTable(name))


def replace_partition(df: DataFrame, table_name: str, spec: dict) -> None:
    """Put the rows of ``df`` in the place of one partition's (E9 replace). The spec
    names every partition column; partition columns of ``df`` are not read. A static
    spec needs no session setting."""
    spark = df.sparkSession
    check_spec(spark, table_name, spec)
    rows = df.select(*[c.name for c in spark.catalog.listColumns(table_name) if not c.isPartition])
    view = f"replaced_{uuid.uuid4().hex}"
    rows.createTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {table_name} PARTITION ({_spec_sql(spec)}) SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def replace_partitions(df: DataFrame, table_name: str) -> None:
    """Overwrite exactly the partitions present in ``df`` (dynamic mode);
    every other partition is left as it is (E9 replace)."""
    # ``insertInto`` takes no write option for this, so the setting is put back after it.
    with _setting(df.sparkSession, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        df.write.insertInto(table_name, overwrite=True)


def drop_partition(spark: SparkSession, table_name: str, spec: dict[str, str]) -> None:
    """Remove one partition of a catalog table (E9 drop). The spec names every
    partition column and no other; a partition that is not there raises."""
    check_spec(spark, table_name, spec)
    spark.sql(f"ALTER TABLE {table_name} DROP PARTITION ({_spec_sql(spec)})")
