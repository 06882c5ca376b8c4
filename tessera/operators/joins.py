"""Join strategies: size-checked broadcast lookup and point-in-time lookup.

A dimension is broadcast only when the plan's statistics bound its bytes, which
they do below filters and aggregates but not behind an explode or a join;
beyond the bound the join is left to the planner (sort-merge with AQE, which
can still switch to broadcast at runtime from measured shuffle sizes, and
splits skewed partitions). No job runs while a query is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Planned bytes above which a side is never broadcast by these helpers.
DEFAULT_BROADCAST_BYTES = 64 << 20


#: Plan nodes that give at most the rows of their inputs, so that the statistics of
#: the scans below them bound their size. Through others (an explode, a join) the
#: optimizer's estimate is a guess.
_BOUNDED_NODES = {
    "Project", "Filter", "Aggregate", "Distinct", "Deduplicate", "Sort", "Limit", "GlobalLimit", "LocalLimit", "Sample",
    "Union", "Window", "SubqueryAlias", "View", "LocalRelation", "LogicalRelation", "Relation", "Range", "OneRowRelation",
    "Repartition", "RepartitionByExpression", "RebalancePartitions",
}
#: Elements of a literal list that one row may be exploded into.
_LITERAL_ROWS = 10_000


def planned_bytes(df: DataFrame) -> int:
    """Size of ``df`` by the optimizer's statistics (file sizes of its scans, as
    far as they are known; unknown counts as unbounded). Runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def size_is_bounded(df: DataFrame) -> bool:
    """Whether the statistics bound the size: no node of the plan makes more rows
    than it reads."""
    todo = [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().split(" ")[0] not in _BOUNDED_NODES and not _literal_list(node):
            return False
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return True


def _literal_list(node) -> bool:
    """One row exploded into a short literal list."""
    if node.nodeName() != "Generate":
        return False
    rows = node.child().maxRows()
    values = node.generator().children().apply(0)
    if values.getClass().getSimpleName() != "Literal" or not rows.isDefined() or rows.get() > 1:
        return False
    return values.value() is not None and values.value().numElements() <= _LITERAL_ROWS


def fits_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    return planned_bytes(df) <= max_bytes and size_is_bounded(df)


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint behind a size bound; otherwise the plain side."""
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df


def lookup_join(facts: DataFrame, dim: DataFrame, on, how: str = "inner",
                max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Equi join of facts to a dimension (current version of every key)."""
    return facts.join(broadcast_if_small(dim, max_broadcast_bytes), on, how)


def time_cuts(rows: DataFrame, heavy_rows: int, cuts: int) -> DataFrame:
    """(_k, _cuts): for every key of more than ``heavy_rows`` rows (_k, _us) the times that
    cut its rows into ``cuts`` parts of about equal depth, by a quantile sketch.

    Keys are counted first, so sketches are made for heavy keys only.
    """
    heavy = rows.groupBy("_k").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > heavy_rows)
    ranks = F.array(*[F.lit(i / cuts) for i in range(1, cuts)])
    return (rows.join(heavy.select("_k"), "_k", "left_semi").groupBy("_k")
            .agg(F.kll_sketch_get_quantile_bigint(F.kll_sketch_agg_bigint("_us"), ranks).alias("_cuts")))


def asof_lookup(facts: DataFrame, versions: DataFrame, *, key: str, fact_time: str,
                valid_from: str, order_tiebreak: str, payload: list[str],
                heavy_rows: int = 1 << 20, cuts: int = 64) -> DataFrame:
    """Point-in-time lookup: each fact row gets the latest version of its key
    with ``valid_from <= fact_time`` (ties on ``valid_from`` broken by the
    largest ``order_tiebreak``). Facts without such a version get nulls, and so
    do facts without a key or time; versions without one never hold.

    No pair of rows within a key is ever formed. Facts and versions are merged
    in time order inside (key, part) partitions. A key of more than ``heavy_rows``
    rows has ``cuts`` parts of equal depth, wherever its rows lie in time: facts of
    one instant that several cuts fall on are dealt over the parts between them.
    The version that carries into a part comes from a table of one row a part.
    """
    ver_struct = F.struct(*[F.col(c) for c in [valid_from, order_tiebreak] + payload])
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))

    versions = versions.where(F.col(key).isNotNull() & F.col(valid_from).isNotNull())
    v = versions.select(
        F.col(key).alias("_k"), micros(valid_from).alias("_us"),
        F.col(valid_from).cast("timestamp").alias("_t"), F.lit(0).alias("_tag"),
        F.col(order_tiebreak).alias("_tb"), ver_struct.alias("_v"))
    f = facts.select(
        "*", F.col(key).alias("_k"), micros(fact_time).alias("_us"),
        F.col(fact_time).cast("timestamp").alias("_t"))
    both = f.select("_k", "_us").unionByName(v.select("_k", "_us")).where(F.col("_k").isNotNull() & F.col("_us").isNotNull())
    parts = time_cuts(both, heavy_rows, cuts)
    none = F.array().cast("array<bigint>")
    own = F.coalesce(F.col("_cuts"), none)
    before = F.size(F.filter(own, lambda c: c < F.col("_us")))
    upto = F.size(F.filter(own, lambda c: c <= F.col("_us")))
    # A version stands in the first part that its instant reaches, so every fact of
    # that instant is in its part or in a later one.
    v = v.join(parts, "_k", "left").withColumn("_b", before).drop("_cuts", "_us")
    dealt = before + F.pmod(F.xxhash64(F.monotonically_increasing_id()), upto - before + 1).cast("int")
    anywhere = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1024)).cast("int")
    f = (f.join(parts, "_k", "left").withColumn("_b", F.when(F.col("_k").isNull(), anywhere).otherwise(dealt))
         .drop("_cuts", "_us"))

    # Latest version of every (key, part) that has versions.
    last_in_bucket = (v.groupBy("_k", "_b")
                      .agg(F.max_by("_v", F.struct("_t", "_tb")).alias("_bv")))
    # Version carried into a part from earlier ones: a key has at most ``cuts`` parts.
    numbers = F.explode(F.sequence(F.lit(0), F.size(own))).alias("_b")
    keys = v.select("_k").distinct().join(parts, "_k", "left").select("_k", numbers)
    per_key = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = (keys.join(last_in_bucket, ["_k", "_b"], "left")
             .withColumn("_carry", F.last("_bv", ignorenulls=True).over(per_key))
             .where(F.col("_carry").isNotNull()).select("_k", "_b", "_carry"))

    # Inside a bucket: merge facts and versions in time order (versions first
    # at equal times, since valid_from <= fact_time qualifies).
    fact_cols = facts.columns
    merged = (f.withColumn("_tag", F.lit(1)).withColumn("_tb", F.lit(None).cast(
                  versions.schema[order_tiebreak].dataType)).withColumn("_v", F.lit(None).cast(
                  v.schema["_v"].dataType))
              .unionByName(v, allowMissingColumns=True))
    in_bucket = Window.partitionBy("_k", "_b").orderBy("_t", "_tag", "_tb").rowsBetween(
        Window.unboundedPreceding, 0)
    seen = (merged.withColumn("_seen", F.last("_v", ignorenulls=True).over(in_bucket))
            .where(F.col("_tag") == 1))
    out = seen.join(carry, ["_k", "_b"], "left")
    chosen = F.coalesce(F.col("_seen"), F.col("_carry"))
    return out.select(*[F.col(c) for c in fact_cols],
                      *[chosen.getField(c).alias(c) for c in [valid_from, order_tiebreak] + payload])
