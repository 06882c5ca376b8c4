import contextlib
import io

import pytest

from tessera.session import checkpoint_dir, cut_lineage
from tessera.sources.tables import spread, table
from tests.conftest import SF001


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_spread_only_when_under_split(spark):
    split = 128 << 20
    wide = spark.range(0, 8 * split // 8 + 1)  # 8 bytes a row
    assert spread(wide, 8) is wide
    assert "RoundRobinPartitioning(8)" in _plan(spread(spark.range(0, 1000), 8))


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_cut_lineage_keeps_rows_and_drops_the_scan(spark):
    src = table(spark, SF001, "orders").groupBy("o_orderstatus").count()
    cut = cut_lineage(src)
    assert sorted(cut.collect()) == sorted(src.collect())
    assert "FileScan" not in _plan(cut)
