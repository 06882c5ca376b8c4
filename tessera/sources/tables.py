"""Parquet test tables (one file per table below a scale-factor folder)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.operators.joins import planned_bytes

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    if name not in TABLE_NAMES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=TABLE_NAMES) -> None:
    """Temp views named like the tables, for ``spark.sql`` texts."""
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Fan a scan out to the cluster's parallelism when it is too small to have
    as many splits.

    A small file scans in one task; per-row work on it (tokenizing, exploding)
    would then run on one core. Inputs of at least one split of
    ``spark.sql.files.maxPartitionBytes`` for each core, by the plan's
    statistics, are returned unchanged (no shuffle). Runs no job.
    """
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return df.repartition(target) if planned_bytes(df) < target * split else df


def text_table(spark: SparkSession, sf_dir: str, name: str, cols: list[str]) -> DataFrame:
    """Only ``cols`` of a text-heavy table, spread for per-row work."""
    return spread(table(spark, sf_dir, name).select(*cols))
