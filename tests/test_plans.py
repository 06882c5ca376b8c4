"""Physical-plan checks: pushdown, pruning, join strategies."""

import contextlib
import io

import __spark_entry__ as E
from tests.conftest import SF01

Q = E.queries()


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_flagship_pushdown_pruning_broadcast(spark):
    p = plan(Q["flagship_lookup_rollup"](spark, SF01))
    assert "GreaterThan(s_acctbal,5000.0)" in p
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_extendedprice:double,l_returnflag:string>" in p
    assert "BroadcastHashJoin" in p
    # two partial + final aggregates, no sort-based aggregate
    assert p.count("HashAggregate") >= 4 and "SortAggregate" not in p


def test_lookup_and_keyword_filter_broadcast(spark):
    assert "BroadcastHashJoin" in plan(Q["lookup_join"](spark, SF01))
    p = plan(Q["keyword_filter"](spark, SF01))
    assert "BroadcastHashJoin" in p and "LeftSemi" in p


def test_completion_has_no_pairwise_joins(spark):
    for name in ["complete_words", "rank_completions", "prefix_nodes", "minimal_completions",
                 "longest_prefix_match", "relaxed_match", "suffix_match", "matches_both_ways"]:
        p = plan(Q[name](spark, SF01))
        assert "CartesianProduct" not in p and "NestedLoopJoin" not in p, name


def test_asof_and_late_rows_avoid_pairs(spark):
    for name in ["lookup_join_versioned", "late_row_audit", "dedup_by_key"]:
        p = plan(Q[name](spark, SF01))
        assert "CartesianProduct" not in p and "NestedLoopJoin" not in p, name
    # keep-one is an aggregate with a partial step before the shuffle, not a window
    p = plan(Q["dedup_by_key"](spark, SF01))
    assert "Window" not in p and "partial_min" in p


def test_column_stats_no_expand(spark):
    assert "Expand" not in plan(Q["column_stats"](spark, SF01))
