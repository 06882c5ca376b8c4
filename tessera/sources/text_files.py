"""Text corpora (A7) and tab-separated frequency dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DICT_SCHEMA = "word string, cou bigint"
# Tab-separated, no quoting or escaping: '""' and "''" are words here.
TSV = {"sep": "\t", "quote": "\u0000", "escape": "\u0000", "header": "false"}


def corpus_scan(spark: SparkSession, path: str, line_sep: str = "\n") -> DataFrame:
    """(file, line) for every line of every file below ``path`` (recursive).
    Lines are read separately, so the end of one line never joins the next
    word."""
    return (spark.read.option("recursiveFileLookup", "true").option("lineSep", line_sep).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line")))


def write_corpus(df: DataFrame, text_col: str, path: str, folder_col: str | None = None) -> None:
    """Texts as plain files, one folder per value of ``folder_col``."""
    cols = ([folder_col] if folder_col else []) + [F.col(text_col).alias("value")]
    w = df.select(*cols).write.mode("overwrite").option("lineSep", "\n")
    if folder_col:
        w = w.partitionBy(folder_col)
    w.text(path)


def lines_of(df: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """(keep..., line_no, line): a text column cut into lines, numbered from 1
    (lines stay separate: the end of one line never joins the next word)."""
    return df.select(*keep, F.posexplode(F.split(F.col(text_col), "\n")).alias("pos", "line")) \
        .select(*keep, (F.col("pos") + 1).cast("bigint").alias("line_no"), "line")


def write_freq_dict(df: DataFrame, path: str, files: int | None = None) -> None:
    out = df.select("word", F.col("cou").cast("bigint"))
    if files:
        out = out.coalesce(files)
    out.write.mode("overwrite").options(**TSV).csv(path)


def read_freq_dict(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DICT_SCHEMA).options(**TSV).csv(path)
