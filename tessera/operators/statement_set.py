"""Several inserts submitted as one unit.

Inserts are collected, explained together and run in order by ``execute``;
the list is cleared afterwards, whether or not every insert succeeded. What
is an insert is decided by Spark's own parser. Each insert reads its source
with its own columns and filters pushed down; an input that is costly to
compute can be shared instead: it is written once to the shared checkpoint
folder, and every insert reads that copy.
"""

from __future__ import annotations

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession

from tessera.session import cut_lineage
from tessera.sources.sinks import table_sink

#: Parsed statements that insert: one insert, and several from one source.
_INSERTS = {"InsertIntoStatement", "OverwriteByExpression", "AppendData", "InsertIntoDir"}


def insert_count(spark: SparkSession, statement: str) -> int:
    """Inserts in one statement, by Spark's parser (``FROM t INSERT ... INSERT ...``
    holds several); raises on what is not one statement made of inserts."""
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(statement)
    except ParseException as e:
        raise ValueError(f"give one insert at a time, in Spark's SQL: {e.getMessage().splitlines()[0]}") from e
    while plan.nodeName() in ("UnresolvedWith", "WithCTE") and plan.children().size():
        plan = plan.children().apply(0)
    parts = [plan]
    if plan.nodeName() == "Union":
        parts = [plan.children().apply(i) for i in range(plan.children().size())]
    others = [p.nodeName() for p in parts if p.nodeName() not in _INSERTS]
    if others:
        raise ValueError(f"a statement set takes inserts, not {others[0]}")
    return len(parts)


class StatementSet:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._ops: list[tuple] = []

    def share(self, df: DataFrame) -> DataFrame:
        """Materialize an input read by several inserts (one computation)."""
        return cut_lineage(df)

    def add_insert_sql(self, statement: str) -> "StatementSet":
        insert_count(self.spark, statement)
        self._ops.append(("sql", statement))
        return self

    def add_insert(self, target: str, df: DataFrame, overwrite: bool = False) -> "StatementSet":
        self._ops.append(("df", target, df, overwrite))
        return self

    def explain(self) -> str:
        parts = []
        for op in self._ops:
            if op[0] == "sql":
                parts.append(f"== {op[1]} ==\n" + self.spark.sql(f"EXPLAIN {op[1]}").first()[0])
            else:
                op[2].createOrReplaceTempView("_statement_set_explain")
                parts.append(f"== insert into {op[1]} ==\n" + self.spark.sql(
                    "EXPLAIN SELECT * FROM _statement_set_explain").first()[0])
        return "\n".join(parts)

    def execute(self) -> int:
        """Run every insert in order; returns how many ran."""
        try:
            for op in self._ops:
                if op[0] == "sql":
                    self.spark.sql(op[1])
                else:
                    table_sink(op[2], op[1], overwrite=op[3])
            return len(self._ops)
        finally:
            self._ops.clear()
