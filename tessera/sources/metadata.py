"""The three metadata tables that declare tables.

``metadata_scan`` reads them once each -- over JDBC with the database filter
pushed into the query, or from any DataFrames -- instead of one query per
table id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DB_SCHEMA = "table_id int, db_name string, table_name string, comment string"
CONN_SCHEMA = "table_id int, key string, value string"
COL_SCHEMA = ("table_id int, schema_root int, schema_name string, schema_type string, "
              "comment string")


@dataclass
class Metadata:
    databases: DataFrame    # (table_id, db_name, table_name, comment)
    conn_info: DataFrame    # (table_id, key, value)
    schemas: DataFrame      # (table_id, schema_root, schema_name, schema_type, comment)


def metadata_scan(spark: SparkSession, db_name: str, jdbc_url: str | None = None,
                  jdbc_props: dict | None = None, tables: Metadata | None = None,
                  partitions: int = 1) -> Metadata:
    """The metadata of one database: its tables, their options and columns.

    Over JDBC the database filter is part of the pushed query and the two
    child tables are semi-joined to the table ids (one scan each).
    """
    if tables is None:
        if jdbc_url is None:
            raise ValueError("give jdbc_url or tables")
        props = jdbc_props or {}
        read = lambda t: spark.read.jdbc(jdbc_url, t, properties=props)
        tables = Metadata(read("catalog_database"), read("catalog_table_conn_info"),
                          read("catalog_table_schema"))
    dbs = tables.databases.where(F.col("db_name") == db_name)
    ids = dbs.select("table_id")
    return Metadata(
        dbs.select("table_id", "db_name", "table_name", "comment"),
        tables.conn_info.join(ids, "table_id", "left_semi").select("table_id", "key", "value"),
        tables.schemas.join(ids, "table_id", "left_semi").select(
            "table_id", "schema_root", "schema_name", "schema_type", "comment"))
