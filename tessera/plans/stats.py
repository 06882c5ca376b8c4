"""Statistics and partition queries (SURVEY group E) over ``lineitem``."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import functions as F

from tessera.operators import stats as st
from tessera.plans.registry import query
from tessera.session import cut_lineage, scratch_path
from tessera.sources import sinks
from tessera.sources.tables import TABLE_NAMES, table

PART_COLS = ["l_returnflag", "l_linestatus"]

# Oracle-side description of lineitem: (column, kind) with kind num/str/time.
LINEITEM_COLS = [
    ("l_orderkey", "num"), ("l_partkey", "num"), ("l_suppkey", "num"), ("l_linenumber", "num"),
    ("l_quantity", "num"), ("l_extendedprice", "num"), ("l_discount", "num"), ("l_tax", "num"),
    ("l_returnflag", "str"), ("l_linestatus", "str"), ("l_shipdate", "time"),
]


# Partition queries run over lineitem with a null partition: line status unknown for returns.
PART_SQL = """(select * replace (case when l_returnflag = 'R' then null else l_linestatus end as l_linestatus)
  from lineitem)"""
_NULL_TEXT = st.NULL_PARTITION


def partitioned(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").withColumn(
        "l_linestatus", F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(F.col("l_linestatus")))


def _col_stats_sql(cols, group: list[str], source: str = "lineitem") -> str:
    g_sel = "".join(f"{g}, " for g in group)
    g_by = f" group by {', '.join(group)}" if group else ""
    parts = []
    for c, kind in cols:
        if c in group:
            continue
        num = kind == "num"
        s = kind == "str"
        parts.append(
            f"select {g_sel}'{c}' as column_name, count(*) as row_count, "
            f"count(*) - count({c}) as nulls, count(distinct {c}) as ndv, "
            f"{f'cast(min({c}) as double)' if num else 'cast(null as double)'} as min_num, "
            f"{f'cast(max({c}) as double)' if num else 'cast(null as double)'} as max_num, "
            f"{'cast(null as varchar)' if num else f'cast(min({c}) as varchar)'} as min_str, "
            f"{'cast(null as varchar)' if num else f'cast(max({c}) as varchar)'} as max_str, "
            f"{f'avg(length({c}))' if s else 'cast(null as double)'} as avg_len, "
            f"{f'cast(max(length({c})) as bigint)' if s else 'cast(null as bigint)'} as max_len "
            f"from {source}{g_by}")
    return "\nunion all ".join(parts)


@query("table_row_counts", "\nunion all ".join(
    f"select '{t}' as table_name, count(*) as row_count from {t}" for t in TABLE_NAMES))
def table_row_counts(spark, sf_dir):
    return reduce(lambda a, b: a.unionByName(b),
                  [st.row_count(table(spark, sf_dir, t), t) for t in TABLE_NAMES])


@query("table_stats", """
select count(*) as row_count, true as has_files, true as has_bytes from lineitem""")
def table_stats(spark, sf_dir):
    # How many files of how many bytes is the layout's business, which SQL views do
    # not show: that there are some is checked.
    t = st.table_stats(table(spark, sf_dir, "lineitem"))
    return t.select("row_count", (F.col("file_count") > 0).alias("has_files"), (F.col("total_size") > 0).alias("has_bytes"))


@query("column_stats", _col_stats_sql(LINEITEM_COLS, []))
def column_stats(spark, sf_dir):
    return st.column_stats(table(spark, sf_dir, "lineitem"), exact_distinct=True)


@contextmanager
def partitioned_table(spark, sf_dir, cols, one_file: bool = False):
    """lineitem as a catalog table; dropped afterwards (an external table: its files stay).
    A large partition is written by several tasks, unless it is to be one file."""
    name = f"lineitem_{uuid.uuid4().hex[:10]}"
    li = partitioned(spark, sf_dir).select(*cols, *PART_COLS)
    li = li.repartition(*PART_COLS) if one_file else li.hint("rebalance", *PART_COLS)
    sinks.create_partitioned_table(spark, name, li, PART_COLS, scratch_path(spark, name))
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE {name}")


@query("partition_stats", f"""
select l_returnflag, l_linestatus, count(*) as row_count, cast(1 as bigint) as file_count, true as has_bytes
from {PART_SQL} group by l_returnflag, l_linestatus""")
def partition_stats(spark, sf_dir):
    # Written with one file a partition, so the file count is known.
    with partitioned_table(spark, sf_dir, ["l_orderkey"], one_file=True) as name:
        t = st.partition_file_stats(spark.table(name), PART_COLS)
        # A row a partition, kept so that the table can go.
        return cut_lineage(t.select(*PART_COLS, "row_count", "file_count", (F.col("total_size") > 0).alias("has_bytes")))


_MERGED_COLS = [(c, k) for c, k in LINEITEM_COLS if c not in PART_COLS]


@query("merged_column_stats", f"""
select column_name, row_count, nulls, min_num, max_num, min_str, max_str, true as ndv_within_3_percent
from ({_col_stats_sql(_MERGED_COLS, [], PART_SQL)})""")
def merged_column_stats(spark, sf_dir):
    # Sketches stored per partition add up to the table's statistics; the distinct
    # estimate is held against the exact count.
    li = partitioned(spark, sf_dir)
    merged = st.merged_stats(st.stored_stats(li, PART_COLS))
    exact = st.exact_ndv(li, [], [c for c, _ in _MERGED_COLS]).withColumnRenamed("ndv", "exact")
    near = F.abs(F.col("ndv") - F.col("exact")) <= 0.03 * F.col("exact")
    return merged.join(exact, "column_name").select(
        "column_name", "row_count", "nulls", "min_num", "max_num", "min_str", "max_str", near.alias("ndv_within_3_percent"))


@query("partition_column_stats", _col_stats_sql(LINEITEM_COLS, PART_COLS, PART_SQL))
def partition_column_stats(spark, sf_dir):
    return st.column_stats(partitioned(spark, sf_dir), PART_COLS, exact_distinct=True)


@query("list_partitions", f"""
select distinct l_returnflag, l_linestatus, 'l_returnflag=' || coalesce(l_returnflag, '{_NULL_TEXT}')
       || '/l_linestatus=' || coalesce(l_linestatus, '{_NULL_TEXT}') as spec
from {PART_SQL}""")
def list_partitions(spark, sf_dir):
    with partitioned_table(spark, sf_dir, ["l_orderkey"]) as name:
        return st.listed_partitions(spark, name)


@query("partitions_by_partial_spec", f"""
select distinct l_returnflag, l_linestatus,
       'l_returnflag=' || l_returnflag || '/l_linestatus=' || l_linestatus as spec
from {PART_SQL} where l_linestatus = 'O'""")
def partitions_by_partial_spec(spark, sf_dir):
    with partitioned_table(spark, sf_dir, ["l_orderkey"]) as name:
        return st.listed_partitions(spark, name, {"l_linestatus": "O"})


@query("partitions_by_null_value", f"""
select distinct l_returnflag, l_linestatus, 'l_returnflag=' || l_returnflag || '/l_linestatus={_NULL_TEXT}' as spec
from {PART_SQL} where l_linestatus is null""")
def partitions_by_null_value(spark, sf_dir):
    with partitioned_table(spark, sf_dir, ["l_orderkey"]) as name:
        return st.listed_partitions(spark, name, {"l_linestatus": None})


@query("partition_exists", f"""
with present as (select distinct l_returnflag, l_linestatus from {PART_SQL}),
wanted as (select distinct l_returnflag, case when o_orderstatus <> 'P' then o_orderstatus end as l_linestatus
           from lineitem join orders on l_orderkey = o_orderkey)
select w.l_returnflag, w.l_linestatus, p.l_returnflag is not null as exists
from wanted w left join present p
  on w.l_returnflag is not distinct from p.l_returnflag
 and w.l_linestatus is not distinct from p.l_linestatus""")
def partition_exists(spark, sf_dir):
    # Wanted specs come from the data: every (return flag, order status) pair
    # seen on an order (pending: null), asked of the (return flag, line status) partitions.
    li = partitioned(spark, sf_dir)
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), status.alias("l_linestatus"))
    wanted = li.select("l_orderkey", "l_returnflag").join(o, "l_orderkey").select(
        "l_returnflag", "l_linestatus").distinct()
    parts = st.list_partitions(li, PART_COLS)
    return st.partitions_exist(parts, wanted, PART_COLS)
