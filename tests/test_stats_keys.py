import pytest
from pyspark.sql import functions as F

from tessera.operators import keys as K
from tessera.operators import stats as st
from tessera.operators.joins import fits_broadcast
from tessera.operators.relational import cents


def test_spec_check_and_partition_ops(spark):
    specs = spark.createDataFrame([({"a": "1", "b": "x"},), ({"a": "1"},), ({"a": "1", "c": "2"},)],
                                  "spec map<string,string>")
    got = [r.status for r in st.spec_check(specs, "spec", ["a", "b"]).collect()]
    assert got == ["full", "partial", "unknown key"]
    df = spark.createDataFrame([("1", "x"), ("1", "y"), ("2", "x")], "a string, b string")
    parts = st.list_partitions(df, ["a", "b"])
    assert st.partitions_by_partial_spec(parts, ["a", "b"], {"zz": "1"}).count() == 0
    assert st.partitions_by_partial_spec(parts, ["a", "b"], {"a": "1"}).count() == 2
    wanted = spark.createDataFrame([("1", "x"), ("3", "x")], "a string, b string")
    ex = {(r.a, r.b): r.exists for r in st.partitions_exist(parts, wanted, ["a", "b"]).collect()}
    assert ex == {("1", "x"): True, ("3", "x"): False}


def test_column_stats_approx_close_to_exact(spark):
    df = spark.range(5000).select((F.col("id") % 97).alias("k"), F.col("id").cast("string").alias("s"))
    ex = {r.column_name: r.ndv for r in st.column_stats(df, exact_distinct=True).collect()}
    ap = {r.column_name: r.ndv for r in st.column_stats(df).collect()}
    assert ex == {"k": 97, "s": 5000}
    assert abs(ap["s"] - 5000) / 5000 < 0.1


def test_keep_one_and_hot_key(spark):
    rows = [(1, i, f"v{i}") for i in range(50)] + [(2, 5, "z"), (2, 3, "y")]
    df = spark.createDataFrame(rows, "k int, o int, v string")
    got = {r.k: (r.o, r.v) for r in K.keep_one_per_key(df, ["k"], ["o"]).collect()}
    assert got == {1: (0, "v0"), 2: (3, "y")}
    assert {r.k: r.rows for r in K.duplicate_keys(df, ["k"]).collect()} == {1: 50, 2: 2}


def test_prior_max_matches_plain_window(spark):
    import random
    rng = random.Random(3)
    rows = [(rng.randrange(3), i, rng.randrange(1000)) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, arrival int, v int")
    got = {r.arrival: r.prior_max for r in K.prior_max(df, "k", "arrival", "v", 37).collect()}
    best = {}
    for k, a, v in sorted(rows, key=lambda r: r[1]):
        assert got[a] == best.get(k), a
        best[k] = max(best.get(k, v), v)


def test_fits_broadcast_bound(spark):
    assert fits_broadcast(spark.range(10), 80) and not fits_broadcast(spark.range(11), 80)


def test_null_partition(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "k string, v int")
    assert {r.k: r.ndv for r in st.column_stats(df, ["k"], exact_distinct=True).collect()} == {"a": 1, None: 2}
    parts = st.list_partitions(df, ["k"])
    assert {r.spec for r in parts.collect()} == {"k=a", "k=__HIVE_DEFAULT_PARTITION__"}
    wanted = spark.createDataFrame([("a",), (None,), ("b",)], "k string")
    assert {r.k: r.exists for r in st.partitions_exist(parts, wanted, ["k"]).collect()} == {
        "a": True, None: True, "b": False}


def test_late_rows_of_a_null_key(spark):
    df = spark.createDataFrame([(None, 0, 100), (None, 70_000, 50), (1, 1, 7)], "k int, arrival long, v long")
    got = {r.arrival: r.prior_max for r in K.prior_max(df, "k", "arrival", "v", 1 << 16).collect()}
    assert got == {0: None, 70_000: 100, 1: None}


def test_amounts_with_more_decimals_raise(spark):
    df = spark.createDataFrame([(1.25, None), (10.1, 2.0)], "a double, b double")
    assert df.select(F.sum(cents("a")), F.sum(cents("b"))).first()[:] == (1135, 200)
    with pytest.raises(Exception, match="more than 2 decimals"):
        df.select(cents(F.col("a") / 100)).collect()


def test_column_stats_odd_names(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "`it's` int, `we``ird` string")
    got = {r.column_name: (r.nulls, r.ndv) for r in st.column_stats(df, exact_distinct=True).collect()}
    assert got == {"it's": (0, 2), "we`ird": (1, 1)}


def test_stored_statistics_add_up_and_are_refreshed_alone(spark):
    from tessera.operators import stats as st
    rows = [(i, i % 3 if i % 10 else None, f"s{i % 70}", float(i % 50)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, p int, s string, x double")
    stored = st.stored_stats(df, ["p"])
    merged = {r.column_name: r for r in st.merged_stats(stored, quantiles=(0.0, 0.5, 1.0)).collect()}
    direct = {r.column_name: r for r in st.column_stats(df.drop("p"), exact_distinct=True).collect()}
    for name, m in merged.items():
        d = direct[name]
        assert (m.row_count, m.nulls, m.min_num, m.max_num, m.min_str, m.max_str, m.avg_len, m.max_len) == (
            d.row_count, d.nulls, d.min_num, d.max_num, d.min_str, d.max_str, d.avg_len, d.max_len)
        assert abs(m.ndv - d.ndv) <= 0.03 * d.ndv
    assert merged["s"].quantiles is None and merged["id"].quantiles[0] == 0 and merged["id"].quantiles[2] == 2999
    assert abs(merged["id"].quantiles[1] - 1500) < 60
    changed = df.where("p is distinct from 1 or id > 100").unionByName(
        spark.createDataFrame([(9999, 1, "new", -5.0)], df.schema))
    again = st.merged_stats(st.refreshed_stats(stored, changed, ["p"], {"p": 1}))
    whole = st.merged_stats(st.stored_stats(changed, ["p"]))
    exact = lambda df: sorted(map(tuple, df.drop("ndv", "quantiles").collect()))
    assert exact(again) == exact(whole) and again.where("column_name = 'id'").first().max_num == 9999
    with pytest.raises(ValueError):
        st.refreshed_stats(stored, df, ["p"], {"q": 1})


def test_partitions_are_listed_without_reading(spark):
    import uuid
    from tessera.operators import stats as st
    from tessera.session import scratch_path
    from tessera.sources import sinks
    name = f"listed_{uuid.uuid4().hex[:8]}"
    df = spark.createDataFrame([(1, "a/b c", 1), (2, "x=+%", 2), (3, None, 2)], "v int, k string, n int")
    sinks.create_partitioned_table(spark, name, df, ["k", "n"], scratch_path(spark, name))
    try:
        listed = st.listed_partitions(spark, name)
        assert sorted(((r.k, r.n) for r in listed.collect()), key=repr) == [("a/b c", "1"), ("x=+%", "2"), (None, "2")]
        assert "Scan parquet" not in listed._jdf.queryExecution().executedPlan().toString()
        assert [r.k for r in st.listed_partitions(spark, name, {"n": 1}).collect()] == ["a/b c"]
        assert [r.n for r in st.listed_partitions(spark, name, {"k": None}).collect()] == ["2"]
        assert st.listed_partitions(spark, name, {"v": 1}).count() == 0
    finally:
        spark.sql(f"drop table {name}")


def test_partitioned_write_needs_no_sort(spark, monkeypatch):
    import uuid
    from pyspark.sql import DataFrameWriter
    from tessera.session import scratch_path
    from tessera.sources import sinks
    name = f"unsorted_{uuid.uuid4().hex[:8]}"
    df = spark.createDataFrame([(i, None if i % 5 == 0 else f"k{i % 5}") for i in range(100)], "v int, k string")
    df.createOrReplaceTempView(f"rows_{name}")
    save, seen = DataFrameWriter.saveAsTable, []

    def plan():
        return spark.sql(f"explain insert into {name} select v, k from rows_{name}").first()[0]

    def saved(writer, table, **options):
        save(writer, table, **options)
        seen.append(plan())
    monkeypatch.setattr(DataFrameWriter, "saveAsTable", saved)
    sinks.create_partitioned_table(spark, name, df, ["k"], scratch_path(spark, name))
    try:
        assert "Sort" not in seen[0] and "Sort" in plan()  # the setting holds for the write alone
        assert {r.k: r.n for r in spark.table(name).groupBy("k").agg(F.count("v").alias("n")).collect()} == {
            k: 20 for k in (None, "k1", "k2", "k3", "k4")}
    finally:
        spark.sql(f"drop table {name}")
        spark.catalog.dropTempView(f"rows_{name}")


def test_large_partition_is_written_by_several_tasks(spark, tmp_path):
    from tessera.plans import stats as plans
    flags = F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R"), F.lit("R")), (F.col("id") % 4 + 1).cast("int"))
    (spark.range(0, 60_000, numPartitions=6).select(F.xxhash64("id").alias("l_orderkey"), flags.alias("l_returnflag"), F.lit("F").alias("l_linestatus"))
     .write.parquet(str(tmp_path / "lineitem.parquet")))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    prev = spark.conf.get(key)
    spark.conf.set(key, "32k")
    try:
        for one_file in (False, True):
            with plans.partitioned_table(spark, str(tmp_path), ["l_orderkey"], one_file) as name:
                files = {r.l_returnflag: r for r in st.partition_file_stats(spark.table(name), plans.PART_COLS).collect()}
                assert {k: r.row_count for k, r in files.items()} == {"A": 15_000, "N": 15_000, "R": 30_000}
                assert all((r.file_count == 1) == one_file for r in files.values())
    finally:
        spark.conf.set(key, prev)
