"""Relational operators of the declared-table queries (batch form).

Each function takes DataFrames and returns a DataFrame; nothing is collected.
Money (two decimals) is summed as whole cents in ``bigint``: exact and
order-free like a ``decimal(18,2)`` sum, but without the wide-decimal
arithmetic a decimal sum falls into. A value with more decimals fails the
query instead of being rounded. Cents leave the engine as
``cents / 100.0``, the double nearest to the exact decimal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.joins import DEFAULT_BROADCAST_BYTES, lookup_join

def cents(c: str | Column, decimals: int = 2) -> Column:
    """Amount with so many decimals -> whole units of the last one, as bigint.
    Raises on a value that has more decimals (beyond a double's own error)."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double") * 10 ** decimals
    whole = F.round(x)
    exact = F.abs(x - whole) <= F.greatest(F.lit(1e-6), F.abs(x) * 1e-14)
    return F.when(x.isNull() | exact, whole.cast("bigint")).otherwise(
        F.raise_error(F.lit(f"amount with more than {decimals} decimals")).cast("bigint"))


def from_cents(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c) / F.lit(100.0)


def derived_table_star(df: DataFrame, cols: list[str], alias: str = "T") -> DataFrame:
    """``SELECT T.* FROM (SELECT cols FROM df) T``."""
    return df.select(*cols).alias(alias).select(f"{alias}.*")


def group_sum_two_keys(df: DataFrame, a: str, b: str, c: str, d: str) -> DataFrame:
    """``SELECT b, a, sum(c) c, sum(d) d FROM df GROUP BY a, b``; c, d in cents.

    Partial aggregation runs before the shuffle, so only one row per (a, b)
    and map task crosses the network.
    """
    return (df.groupBy(F.col(a).alias("a"), F.col(b).alias("b"))
            .agg(F.sum(cents(c)).alias("c"), F.sum(cents(d)).alias("d")))


def rollup_by_b(t: DataFrame) -> DataFrame:
    """Outer level: ``SELECT b, count(a), sum(c), sum(d) GROUP BY b``."""
    return t.groupBy("b").agg(
        F.count("a").alias("cnt_a"),
        from_cents(F.sum("c")).alias("sum_c"),
        from_cents(F.sum("d")).alias("sum_d"))


def flagship_lookup_rollup(facts: DataFrame, dim: DataFrame, *, a: str, b: str, c: str,
                           d: str, dim_key: str, dim_attr: str, min_attr: float,
                           max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Aggregate, look up the dimension, filter on it, aggregate again.

    The dimension filter is applied to the dimension before the join (Catalyst
    would push it there too), and only the key column of the dimension is
    carried, so the lookup side is as narrow as it can be.
    """
    t = group_sum_two_keys(facts, a, b, c, d)
    lookup = (dim.where(F.col(dim_attr) > F.lit(min_attr))
              .select(F.col(dim_key).alias("_id")))
    x = lookup_join(t, lookup, t["a"] == lookup["_id"], max_broadcast_bytes=max_broadcast_bytes)
    return rollup_by_b(x.select("a", "b", "c", "d"))


def two_level_agg(df: DataFrame, a: str, b: str, c: str, d: str) -> DataFrame:
    """Aggregate of an aggregate, without a lookup."""
    return rollup_by_b(group_sum_two_keys(df, a, b, c, d))


def group_by_substring(df: DataFrame, col: str, start: int, length: int,
                       out: str = "grp") -> DataFrame:
    return (df.groupBy(F.substring(col, start, length).alias(out))
            .agg(F.count(F.lit(1)).alias("cnt")))


def epoch_to_timestamp(ms_col: str, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """``TO_TIMESTAMP(FROM_UNIXTIME(ms / 1000, fmt))`` with integer division
    (the declared-table engine divides bigints without a fraction)."""
    return F.to_timestamp(F.from_unixtime(F.expr(f"`{ms_col}` div 1000"), fmt), fmt)


def rebalance(df: DataFrame, n: int | None = None) -> DataFrame:
    """Spread a source's rows evenly: into partitions of the advisory size, or
    into ``n`` partitions when the caller sets the parallelism."""
    return df.repartition(n) if n else df.hint("rebalance")
