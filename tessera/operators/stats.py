"""Table, column and partition statistics computed from the data, and
partition-spec operations over a table's partition values.

Column statistics are one aggregate pass over all columns (partial
aggregation per task), reshaped to long form with ``stack``. Distinct counts
are HyperLogLog++ sketches inside that pass by default. Exact distinct counts
are separate branches, one per column, each reading only its column and
de-duplicating it with a partial aggregate before the shuffle -- not several
``count(distinct)`` in one aggregate, which Spark plans with an Expand that
copies every input row once per column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import sql_ident, sql_string

_STRINGY = (T.StringType, T.VarcharType, T.CharType)
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)
_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def table_stats(df: DataFrame) -> DataFrame:
    """(row_count, file_count, total_size) of a file-backed table."""
    files = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s"))
    per_file = files.groupBy("f").agg(F.count(F.lit(1)).alias("n"), F.first("s").alias("s"))
    return per_file.agg(F.sum("n").cast("bigint").alias("row_count"),
                        F.count(F.lit(1)).alias("file_count"),
                        F.sum("s").cast("bigint").alias("total_size"))


def partition_file_stats(df: DataFrame, part_cols: list[str]) -> DataFrame:
    """Rows, files and bytes per partition of a file-backed table (E3); summed they are
    the table's (E1)."""
    files = df.groupBy(*part_cols, F.col("_metadata.file_path").alias("_f")).agg(
        F.count(F.lit(1)).alias("n"), F.first("_metadata.file_size").alias("s"))
    return files.groupBy(*part_cols).agg(F.sum("n").alias("row_count"), F.count(F.lit(1)).alias("file_count"),
                                         F.sum("s").alias("total_size"))


def row_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count")


def _stat_columns(df: DataFrame, exact_distinct: bool):
    """Aggregate expressions per column plus the stack() text reshaping them."""
    aggs: list[Column] = []
    rows: list[str] = []
    for i, f in enumerate(df.schema.fields):
        c = F.col(sql_ident(f.name))
        dt = f.dataType
        if not isinstance(dt, _STRINGY + _NUMERIC + _TIMES + (T.BooleanType,)):
            continue  # nested and binary columns: no order, no length
        ndv = F.lit(None) if exact_distinct else F.approx_count_distinct(c)
        num = isinstance(dt, _NUMERIC)
        aggs += [
            F.count(c).alias(f"nn{i}"),
            ndv.cast("bigint").alias(f"nd{i}"),
            (F.min(c).cast("double") if num else F.lit(None).cast("double")).alias(f"mnn{i}"),
            (F.max(c).cast("double") if num else F.lit(None).cast("double")).alias(f"mxn{i}"),
            (F.lit(None).cast("string") if num else F.min(c).cast("string")).alias(f"mns{i}"),
            (F.lit(None).cast("string") if num else F.max(c).cast("string")).alias(f"mxs{i}"),
            (F.avg(F.length(c)) if isinstance(dt, _STRINGY) else F.lit(None).cast("double")).alias(f"al{i}"),
            (F.max(F.length(c)).cast("bigint") if isinstance(dt, _STRINGY)
             else F.lit(None).cast("bigint")).alias(f"ml{i}"),
        ]
        rows.append(f"{sql_string(f.name)}, nn{i}, nd{i}, mnn{i}, mxn{i}, mns{i}, mxs{i}, al{i}, ml{i}")
    stack = (f"stack({len(rows)}, {', '.join(rows)}) as (column_name, non_nulls, ndv, "
             "min_num, max_num, min_str, max_str, avg_len, max_len)")
    return aggs, stack


def column_stats(df: DataFrame, group_cols: list[str] | None = None,
                 exact_distinct: bool = False) -> DataFrame:
    """Long form, one row per (group..., column) (E2, E4 when grouped):
    rows, nulls, distinct values, min and max (numeric as double, others as
    text), average and maximum length of strings."""
    group_cols = group_cols or []
    body = df.drop(*group_cols)
    aggs, stack = _stat_columns(body, exact_distinct)
    total = F.count(F.lit(1)).alias("row_count")
    wide = df.groupBy(*group_cols).agg(total, *aggs) if group_cols else df.agg(total, *aggs)
    long = (wide.selectExpr(*[sql_ident(g) for g in group_cols], "row_count", stack)
            .withColumn("nulls", F.col("row_count") - F.col("non_nulls")))
    if exact_distinct:
        ndv = exact_ndv(df, group_cols, _stat_names(body))
        keys = [*group_cols, "column_name"]
        ndv = ndv.select("ndv", *[F.col(sql_ident(k)).alias(f"_{i}") for i, k in enumerate(keys)])
        same = [F.col(sql_ident(k)).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(keys)]
        long = long.drop("ndv").join(ndv, same, "left")
        long = long.withColumn("ndv", F.coalesce(F.col("ndv"), F.lit(0)).cast("bigint"))
    return long.select(*group_cols, "column_name", "row_count", "nulls", "ndv", "min_num",
                       "max_num", "min_str", "max_str", "avg_len", "max_len")


def _stat_names(df: DataFrame) -> list[str]:
    ok = _STRINGY + _NUMERIC + _TIMES + (T.BooleanType,)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, ok)]


def exact_ndv(df: DataFrame, group_cols: list[str], cols: list[str]) -> DataFrame:
    """(group..., column_name, ndv): exact distinct non-null values per column,
    one pruned, partially aggregated branch per column, unioned in one job."""
    branches = []
    for c in cols:
        v = df.select(*group_cols, F.col(sql_ident(c)).alias("_v")).where(F.col("_v").isNotNull())
        branches.append(v.distinct()
                        .groupBy(*group_cols).agg(F.count(F.lit(1)).alias("ndv"))
                        .withColumn("column_name", F.lit(c)))
    out = branches[0]
    for b in branches[1:]:
        out = out.unionByName(b)
    return out


#: log2 of the buckets of a distinct-count sketch: a standard error of about 0.8 %.
DISTINCT_LOG2 = 14


def stored_stats(df: DataFrame, part_cols: list[str]) -> DataFrame:
    """Statistics that add up (E2, E4): per partition and column, the counts and extremes
    of ``column_stats`` with a HyperLogLog sketch of the distinct values and, for
    numbers, a KLL sketch of the quantiles. One pass over the data; to be written, and
    refreshed for single partitions by ``refreshed_stats``."""
    body = [f for f in df.drop(*part_cols).schema.fields if isinstance(f.dataType, _STRINGY + _NUMERIC + _TIMES)]
    aggs, rows = [F.count(F.lit(1)).alias("row_count")], []
    nothing = F.lit(None)
    for i, f in enumerate(body):
        c, num, text = F.col(sql_ident(f.name)), isinstance(f.dataType, _NUMERIC), isinstance(f.dataType, _STRINGY)
        # The distinct sketch takes integers and texts.
        seen = c if isinstance(f.dataType, (T.IntegerType, T.LongType) + _STRINGY) else c.cast("string")
        low, high = F.min(c), F.max(c)
        aggs += [
            F.count(c).alias(f"nn{i}"),
            (low.cast("double") if num else nothing.cast("double")).alias(f"mnn{i}"),
            (high.cast("double") if num else nothing.cast("double")).alias(f"mxn{i}"),
            (nothing.cast("string") if num else low.cast("string")).alias(f"mns{i}"),
            (nothing.cast("string") if num else high.cast("string")).alias(f"mxs{i}"),
            (F.sum(F.length(c)) if text else nothing.cast("bigint")).alias(f"sl{i}"),
            (F.max(F.length(c)) if text else nothing.cast("int")).alias(f"ml{i}"),
            F.hll_sketch_agg(seen, DISTINCT_LOG2).alias(f"d{i}"),
            (F.kll_sketch_agg_double(c.cast("double")) if num else nothing.cast("binary")).alias(f"q{i}"),
        ]
        rows.append(f"{sql_string(f.name)}, nn{i}, mnn{i}, mxn{i}, mns{i}, mxs{i}, sl{i}, ml{i}, d{i}, q{i}")
    stack = (f"stack({len(rows)}, {', '.join(rows)}) as (column_name, non_nulls, min_num, max_num, min_str, max_str, "
             "sum_len, max_len, distinct_sketch, quantile_sketch)")
    wide = df.groupBy(*part_cols).agg(*aggs)
    return wide.selectExpr(*[sql_ident(p) for p in part_cols], "row_count", stack)


def merged_stats(stored: DataFrame, group_cols: list[str] | None = None,
                 quantiles: tuple[float, ...] = (0.5,)) -> DataFrame:
    """Statistics of the table, or of coarser groups of its partitions, from stored ones
    alone: (group..., column_name, row_count, nulls, ndv, min_num, ..., quantiles).
    ``ndv`` and the quantiles are the sketches' estimates; the rest is exact."""
    group_cols = group_cols or []
    sums = stored.groupBy(*group_cols, "column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("non_nulls").alias("non_nulls"),
        *[f(c).alias(c) for c, f in (("min_num", F.min), ("max_num", F.max), ("min_str", F.min), ("max_str", F.max))],
        F.sum("sum_len").alias("sum_len"), F.max("max_len").cast("bigint").alias("max_len"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("ndv"),
        F.kll_merge_agg_double("quantile_sketch").alias("_q"))
    at = F.array(*[F.lit(float(q)) for q in quantiles])
    has = F.col("max_num").isNotNull()  # a sketch without values has no quantile
    return sums.select(
        *group_cols, "column_name", "row_count", (F.col("row_count") - F.col("non_nulls")).alias("nulls"), "ndv",
        "min_num", "max_num", "min_str", "max_str", (F.col("sum_len") / F.col("non_nulls")).alias("avg_len"), "max_len",
        F.when(has, F.kll_sketch_get_quantile_double(F.when(has, F.col("_q")), at)).alias("quantiles"))


def refreshed_stats(stored: DataFrame, df: DataFrame, part_cols: list[str], spec: dict) -> DataFrame:
    """``stored`` with the rows of one partition (``spec``: every key and its value)
    computed anew from ``df``; the filter on the spec prunes all other partitions."""
    if set(spec) != set(part_cols):
        raise ValueError(f"partition spec {sorted(spec)} must name {sorted(part_cols)}")
    one = F.lit(True)
    for k, v in spec.items():
        one = one & F.col(sql_ident(k)).eqNullSafe(F.lit(v))
    return stored.where(~one).unionByName(stored_stats(df.where(one), part_cols))


def partition_stats(df: DataFrame, part_cols: list[str]) -> DataFrame:
    """Rows per partition value combination."""
    return df.groupBy(*part_cols).agg(F.count(F.lit(1)).alias("row_count"))


#: Spark's folder name of a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def spec_text(part_cols: list[str]) -> Column:
    """'k1=v1/k2=v2' in partition-key order (the path form of a spec)."""
    return F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(NULL_PARTITION)))
                              for c in part_cols])


def list_partitions(df: DataFrame, part_cols: list[str]) -> DataFrame:
    """Every partition spec present in the data (E5): key columns + spec map."""
    specs = df.select(*part_cols).distinct()
    return specs.select(*part_cols, spec_text(part_cols).alias("spec"))


def listed_partitions(spark: SparkSession, table_name: str, partial: dict | None = None) -> DataFrame:
    """Partition specs of a catalog table (E5), or those that contain ``partial`` (E6),
    from the catalog alone: key columns as text (null for the null partition) and
    ``spec``. No file is opened and no row is read. A key that is not a partition key
    matches nothing."""
    keys = [c.name for c in spark.catalog.listColumns(table_name) if c.isPartition]
    known = not partial or set(partial) <= set(keys)
    clause = ""
    if partial and known:
        clause = " PARTITION (" + ", ".join(
            f"{sql_ident(k)} = {'null' if v is None else sql_string(str(v))}" for k, v in partial.items()) + ")"
    rows = spark.sql(f"SHOW PARTITIONS {table_name}{clause}")
    rows = rows if known else rows.limit(0)
    # The catalog gives k1=v1/k2=v2 with special characters of the values as %XX.
    parts = F.split("partition", "/")

    def value(i: int) -> Column:
        text = F.substring_index(parts[i], "=", -1)
        text = F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
        return F.when(text != NULL_PARTITION, text)

    return rows.select(*[value(i).alias(k) for i, k in enumerate(keys)]).withColumn("spec", spec_text(keys))


def partitions_by_partial_spec(parts: DataFrame, part_cols: list[str],
                               partial: dict[str, str]) -> DataFrame:
    """Specs containing every given pair (E6); a key that is not a partition
    key matches nothing."""
    if not set(partial) <= set(part_cols):
        return parts.limit(0)
    cond = F.lit(True)
    for k, v in partial.items():
        cond = cond & (F.col(k).cast("string") == F.lit(str(v)))
    return parts.where(cond)


def partitions_exist(parts: DataFrame, wanted: DataFrame, part_cols: list[str]) -> DataFrame:
    """wanted specs + ``exists`` (E7): a left join to the present specs, with
    the present side reduced to distinct specs first."""
    present = parts.select(*[F.col(c).alias(f"_{c}") for c in part_cols]).distinct().withColumn(
        "exists", F.lit(True))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in part_cols]
    return wanted.join(present, same, "left").select(
        *wanted.columns, F.coalesce(F.col("exists"), F.lit(False)).alias("exists"))


def spec_check(specs: DataFrame, spec_col: str, part_cols: list[str]) -> DataFrame:
    """Full-spec rule (E8): a spec must name every partition key and no other.
    ``spec_col`` is a map<string,string>; adds missing, extra, status."""
    keys = F.array(*[F.lit(c) for c in part_cols])
    given = F.map_keys(F.col(spec_col))
    return (specs.withColumn("missing", F.array_sort(F.array_except(keys, given)))
            .withColumn("extra", F.array_sort(F.array_except(given, keys)))
            .withColumn("status", F.when((F.size("missing") == 0) & (F.size("extra") == 0), "full")
                        .when(F.size("extra") > 0, "unknown key").otherwise("partial")))
