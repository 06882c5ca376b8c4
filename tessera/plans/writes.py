"""Writer queries: write, then read back.

Targets live below the shared checkpoint folder (``spark.checkpoint.dir``)
with a fresh name per run, so reruns and concurrent runs never collide.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessera.operators.statement_set import StatementSet
from tessera.plans.registry import query
from tessera.session import cut_lineage, scratch_path
from tessera.sources import sinks
from tessera.sources.tables import table

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


@query("table_sink", """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders
union all select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders""")
def table_sink(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(*ORDER_COLS)
    path = scratch_path(spark, "orders-sink")
    sinks.table_sink(o, path, overwrite=True)       # first write replaces
    sinks.table_sink(o, path, overwrite=False)      # second appends
    return spark.read.parquet(path)


@query("named_view", """
select s_nationkey, count(*) as suppliers, cast(sum(s_acctbal) as decimal(18,2)) as balance
from supplier group by s_nationkey""")
def named_view(spark, sf_dir):
    source, view = _name("supplier"), _name("supplier_balance")
    table(spark, sf_dir, "supplier").createOrReplaceTempView(source)
    spark.sql(f"""CREATE TEMP VIEW {view} AS
                  SELECT s_nationkey, count(*) AS suppliers,
                         CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS balance
                  FROM {source} GROUP BY s_nationkey""")
    try:
        return spark.sql(f"SELECT * FROM {view}")
    finally:  # the result keeps its plan
        spark.catalog.dropTempView(view)
        spark.catalog.dropTempView(source)


@query("insert_select", "select o_orderkey as order_number from orders")
def insert_select(spark, sf_dir):
    source, name = _name("orders"), _name("out_s")
    path = scratch_path(spark, name)
    table(spark, sf_dir, "orders").createOrReplaceTempView(source)
    spark.sql(f"CREATE TABLE {name} (order_number BIGINT) USING parquet LOCATION '{path}'")
    try:
        spark.sql(f"INSERT INTO {name} SELECT o_orderkey FROM {source}")
        return spark.read.schema(spark.table(name).schema).parquet(path)
    finally:  # the table is an external one: its files stay for the result
        spark.sql(f"DROP TABLE {name}")
        spark.catalog.dropTempView(source)


STATEMENT_SET_SQL = """
select 'finished' as target, o_orderkey, o_totalprice from orders where o_orderstatus = 'F'
union all
select 'open', o_orderkey, o_totalprice from orders where o_orderstatus <> 'F'"""


@query("statement_set", STATEMENT_SET_SQL)
def statement_set(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    a, b = scratch_path(spark, "finished"), scratch_path(spark, "open")
    ss = StatementSet(spark)
    # Each insert scans with its own filter pushed down; no copy of the source is made.
    ss.add_insert(a, o.where(F.col("o_orderstatus") == "F").drop("o_orderstatus"))
    ss.add_insert(b, o.where(F.col("o_orderstatus") != "F").drop("o_orderstatus"), overwrite=True)
    ss.execute()
    return (spark.read.parquet(a).select(F.lit("finished").alias("target"), "*")
            .unionByName(spark.read.parquet(b).select(F.lit("open").alias("target"), "*")))


@query("partition_lifecycle", """
select l_returnflag, l_linestatus, count(*) as row_count,
       cast(sum(cast(q as decimal(18,2))) as double) as quantity
from (select l_returnflag, l_linestatus,
             case when l_returnflag = 'A' and l_linestatus = 'F' then l_quantity * 2
                  else l_quantity end as q
      from lineitem where not (l_returnflag = 'N' and l_linestatus = 'O'))
group by l_returnflag, l_linestatus""")
def partition_lifecycle(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag",
                                                 "l_linestatus")
    name = _name("lineitem_parts")
    sinks.create_partitioned_table(spark, name, li, ["l_returnflag", "l_linestatus"],
                                   scratch_path(spark, name))
    # Replace one partition: its rows again with doubled quantity.
    changed = (li.where((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"))
               .withColumn("l_quantity", F.col("l_quantity") * 2))
    sinks.replace_partition(changed, name, {"l_returnflag": "A", "l_linestatus": "F"})
    sinks.drop_partition(spark, name, {"l_returnflag": "N", "l_linestatus": "O"})
    per_partition = spark.table(name).groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("row_count"),
        (F.sum(F.round(F.col("l_quantity") * 100).cast("bigint")) / 100.0).alias("quantity"))
    out = cut_lineage(per_partition)  # a row a partition, so that the table can go
    spark.sql(f"DROP TABLE {name}")
    return out


@query("rebalanced_write", "select o_orderkey, o_totalprice from orders")
def rebalanced_write(spark, sf_dir):
    # Parallelism set before the sink (one writing task per core of the
    # cluster), rows unchanged.
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    path = scratch_path(spark, "rebalanced")
    sinks.table_sink(o, path, overwrite=True, parallelism=spark.sparkContext.defaultParallelism)
    return spark.read.parquet(path)
