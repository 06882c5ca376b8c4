"""Declared keys and event-time lateness in batch form.

Both are written so that a key holding a third of all rows is still spread:
keep-one is an aggregate (partial per task before the shuffle), and the
running maximum behind the lateness check is computed inside (key, arrival
bucket) partitions with a one-row-per-bucket carry between buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count (D3 check)."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"))
            .where(F.col("rows") > 1))


def keep_one_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key: the smallest by ``order`` then the remaining columns.

    ``min`` over a struct is an ordinary aggregate with a partial step, so
    rows are reduced per map task before the shuffle; no window ranks a whole
    key group in one task. (With string fields Spark runs it sort-based,
    which spills instead of failing on memory.)
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest]).alias("_row")
    kept = df.groupBy(*key).agg(F.min(packed).alias("_row"))
    return kept.select(*key, *[F.col("_row").getField(c).alias(c) for c in order + rest]).select(
        *df.columns)


def prior_max(df: DataFrame, key: str, order: str, value: str, bucket_width: int,
              out: str = "prior_max") -> DataFrame:
    """Adds ``out`` = max(value) over earlier rows (by ``order``) of the same key.

    Rows are placed in (key, floor(order / bucket_width)) partitions; the
    maximum of all earlier buckets comes from a table with one row per
    (key, bucket), so no window spans a whole key.
    """
    b = F.floor(F.col(order) / F.lit(bucket_width))
    x = df.withColumn("_b", b)
    per_bucket = x.groupBy(key, "_b").agg(F.max(value).alias("_bmax"))
    earlier = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.withColumn("_carry", F.max("_bmax").over(earlier)).drop("_bmax")
    inside = Window.partitionBy(key, "_b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    y = x.withColumn("_in", F.max(value).over(inside))
    # A null key is a key of its own, in the windows and here.
    carry = carry.select(F.col(key).alias("_key"), F.col("_b").alias("_bucket"), "_carry")
    same = [y[key].eqNullSafe(carry["_key"]), y["_b"].eqNullSafe(carry["_bucket"])]
    return (y.join(carry, same, "left").drop("_key", "_bucket")
            .withColumn(out, F.greatest(F.col("_in"), F.col("_carry")))
            .drop("_b", "_in", "_carry"))


def late_rows(df: DataFrame, key: str, arrival: str, ts: str, delay: str,
              bucket_width: int = 1 << 16) -> DataFrame:
    """Per row: the watermark its key had reached when it arrived (latest
    event time seen before it minus ``delay``) and whether it is late, i.e.
    at or behind that watermark (D4)."""
    p = prior_max(df, key, arrival, ts, bucket_width, "_seen")
    wm = F.col("_seen") - F.expr(f"INTERVAL {delay}")
    return (p.withColumn("watermark", wm)
            .withColumn("late", F.coalesce(F.col(ts) <= F.col("watermark"), F.lit(False)))
            .drop("_seen"))
