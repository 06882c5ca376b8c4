"""Keyword frequency over a text corpus and dictionary merging.

The keyword list is a fixed 553-word dictionary (a public list of SQL
reserved words), so every join against it broadcasts a side whose size is
known in advance. Everything that grows with the data -- tokens, counts --
stays distributed and is pre-aggregated before any shuffle.
"""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import TOKEN_RUN, raw_tokens
from tessera.operators.joins import broadcast_if_small

# ---- fixed values (must equal the reference dictionary) -------------------
# SQL reserved keywords, in their published order; lower-cased on use.
RESERVED_WORDS_TEXT = """
A, ABS, ABSOLUTE, ACTION, ADA, ADD, ADMIN, AFTER, ALL, ALLOCATE, ALLOW, ALTER, ALWAYS,
AND, ANY, ARE, ARRAY, AS, ASC, ASENSITIVE, ASSERTION, ASSIGNMENT, ASYMMETRIC, AT,
ATOMIC, ATTRIBUTE, ATTRIBUTES, AUTHORIZATION, AVG, BEFORE, BEGIN, BERNOULLI, BETWEEN,
BIGINT, BINARY, BIT, BLOB, BOOLEAN, BOTH, BREADTH, BY, BYTES, C, CALL, CALLED,
CARDINALITY, CASCADE, CASCADED, CASE, CAST, CATALOG, CATALOG_NAME, CEIL, CEILING,
CENTURY, CHAIN, CHAR, CHARACTER, CHARACTERISTICS, CHARACTERS, CHARACTER_LENGTH,
CHARACTER_SET_CATALOG, CHARACTER_SET_NAME, CHARACTER_SET_SCHEMA, CHAR_LENGTH, CHECK,
CLASS_ORIGIN, CLOB, CLOSE, COALESCE, COBOL, COLLATE, COLLATION, COLLATION_CATALOG,
COLLATION_NAME, COLLATION_SCHEMA, COLLECT, COLUMN, COLUMNS, COLUMN_NAME,
COMMAND_FUNCTION, COMMAND_FUNCTION_CODE, COMMIT, COMMITTED, CONDITION, CONDITION_NUMBER,
CONNECT, CONNECTION, CONNECTION_NAME, CONSTRAINT, CONSTRAINTS, CONSTRAINT_CATALOG,
CONSTRAINT_NAME, CONSTRAINT_SCHEMA, CONSTRUCTOR, CONTAINS, CONTINUE, CONVERT, CORR,
CORRESPONDING, COUNT, COVAR_POP, COVAR_SAMP, CREATE, CROSS, CUBE, CUME_DIST, CURRENT,
CURRENT_CATALOG, CURRENT_DATE, CURRENT_DEFAULT_TRANSFORM_GROUP, CURRENT_PATH,
CURRENT_ROLE, CURRENT_SCHEMA, CURRENT_TIME, CURRENT_TIMESTAMP,
CURRENT_TRANSFORM_GROUP_FOR_TYPE, CURRENT_USER, CURSOR, CURSOR_NAME, CYCLE, DATA,
DATABASE, DATE, DATETIME_INTERVAL_CODE, DATETIME_INTERVAL_PRECISION, DAY, DEALLOCATE,
DEC, DECADE, DECIMAL, DECLARE, DEFAULT, DEFAULTS, DEFERRABLE, DEFERRED, DEFINED,
DEFINER, DEGREE, DELETE, DENSE_RANK, DEPTH, DEREF, DERIVED, DESC, DESCRIBE, DESCRIPTION,
DESCRIPTOR, DETERMINISTIC, DIAGNOSTICS, DISALLOW, DISCONNECT, DISPATCH, DISTINCT,
DOMAIN, DOUBLE, DOW, DOY, DROP, DYNAMIC, DYNAMIC_FUNCTION, DYNAMIC_FUNCTION_CODE, EACH,
ELEMENT, ELSE, END, END-EXEC, EPOCH, EQUALS, ESCAPE, EVERY, EXCEPT, EXCEPTION, EXCLUDE,
EXCLUDING, EXEC, EXECUTE, EXISTS, EXP, EXPLAIN, EXTEND, EXTERNAL, EXTRACT, FALSE, FETCH,
FILTER, FINAL, FIRST, FIRST_VALUE, FLOAT, FLOOR, FOLLOWING, FOR, FOREIGN, FORTRAN,
FOUND, FRAC_SECOND, FREE, FROM, FULL, FUNCTION, FUSION, G, GENERAL, GENERATED, GET,
GLOBAL, GO, GOTO, GRANT, GRANTED, GROUP, GROUPING, HAVING, HIERARCHY, HOLD, HOUR,
IDENTITY, IMMEDIATE, IMPLEMENTATION, IMPORT, IN, INCLUDING, INCREMENT, INDICATOR,
INITIALLY, INNER, INOUT, INPUT, INSENSITIVE, INSERT, INSTANCE, INSTANTIABLE, INT,
INTEGER, INTERSECT, INTERSECTION, INTERVAL, INTO, INVOKER, IS, ISOLATION, JAVA, JOIN, K,
KEY, KEY_MEMBER, KEY_TYPE, LABEL, LANGUAGE, LARGE, LAST, LAST_VALUE, LATERAL, LEADING,
LEFT, LENGTH, LEVEL, LIBRARY, LIKE, LIMIT, LN, LOCAL, LOCALTIME, LOCALTIMESTAMP,
LOCATOR, LOWER, M, MAP, MATCH, MATCHED, MAX, MAXVALUE, MEMBER, MERGE, MESSAGE_LENGTH,
MESSAGE_OCTET_LENGTH, MESSAGE_TEXT, METHOD, MICROSECOND, MILLENNIUM, MIN, MINUTE,
MINVALUE, MOD, MODIFIES, MODULE, MODULES, MONTH, MORE, MULTISET, MUMPS, NAME, NAMES,
NATIONAL, NATURAL, NCHAR, NCLOB, NESTING, NEW, NEXT, NO, NONE, NORMALIZE, NORMALIZED,
NOT, NULL, NULLABLE, NULLIF, NULLS, NUMBER, NUMERIC, OBJECT, OCTETS, OCTET_LENGTH, OF,
OFFSET, OLD, ON, ONLY, OPEN, OPTION, OPTIONS, OR, ORDER, ORDERING, ORDINALITY, OTHERS,
OUT, OUTER, OUTPUT, OVER, OVERLAPS, OVERLAY, OVERRIDING, PAD, PARAMETER, PARAMETER_MODE,
PARAMETER_NAME, PARAMETER_ORDINAL_POSITION, PARAMETER_SPECIFIC_CATALOG,
PARAMETER_SPECIFIC_NAME, PARAMETER_SPECIFIC_SCHEMA, PARTIAL, PARTITION, PASCAL,
PASSTHROUGH, PATH, PERCENTILE_CONT, PERCENTILE_DISC, PERCENT_RANK, PLACING, PLAN, PLI,
POSITION, POWER, PRECEDING, PRECISION, PREPARE, PRESERVE, PRIMARY, PRIOR, PRIVILEGES,
PROCEDURE, PUBLIC, QUARTER, RANGE, RANK, RAW, READ, READS, REAL, RECURSIVE, REF,
REFERENCES, REFERENCING, REGR_AVGX, REGR_AVGY, REGR_COUNT, REGR_INTERCEPT, REGR_R2,
REGR_SLOPE, REGR_SXX, REGR_SXY, REGR_SYY, RELATIVE, RELEASE, REPEATABLE, RESET, RESTART,
RESTRICT, RESULT, RETURN, RETURNED_CARDINALITY, RETURNED_LENGTH, RETURNED_OCTET_LENGTH,
RETURNED_SQLSTATE, RETURNS, REVOKE, RIGHT, ROLE, ROLLBACK, ROLLUP, ROUTINE,
ROUTINE_CATALOG, ROUTINE_NAME, ROUTINE_SCHEMA, ROW, ROWS, ROW_COUNT, ROW_NUMBER,
SAVEPOINT, SCALE, SCHEMA, SCHEMA_NAME, SCOPE, SCOPE_CATALOGS, SCOPE_NAME, SCOPE_SCHEMA,
SCROLL, SEARCH, SECOND, SECTION, SECURITY, SELECT, SELF, SENSITIVE, SEQUENCE,
SERIALIZABLE, SERVER, SERVER_NAME, SESSION, SESSION_USER, SET, SETS, SIMILAR, SIMPLE,
SIZE, SMALLINT, SOME, SOURCE, SPACE, SPECIFIC, SPECIFICTYPE, SPECIFIC_NAME, SQL,
SQLEXCEPTION, SQLSTATE, SQLWARNING, SQL_TSI_DAY, SQL_TSI_FRAC_SECOND, SQL_TSI_HOUR,
SQL_TSI_MICROSECOND, SQL_TSI_MINUTE, SQL_TSI_MONTH, SQL_TSI_QUARTER, SQL_TSI_SECOND,
SQL_TSI_WEEK, SQL_TSI_YEAR, SQRT, START, STATE, STATEMENT, STATIC, STDDEV_POP,
STDDEV_SAMP, STREAM, STRING, STRUCTURE, STYLE, SUBCLASS_ORIGIN, SUBMULTISET, SUBSTITUTE,
SUBSTRING, SUM, SYMMETRIC, SYSTEM, SYSTEM_USER, TABLE, TABLESAMPLE, TABLE_NAME,
TEMPORARY, THEN, TIES, TIME, TIMESTAMP, TIMESTAMPADD, TIMESTAMPDIFF, TIMEZONE_HOUR,
TIMEZONE_MINUTE, TINYINT, TO, TOP_LEVEL_COUNT, TRAILING, TRANSACTION,
TRANSACTIONS_ACTIVE, TRANSACTIONS_COMMITTED, TRANSACTIONS_ROLLED_BACK, TRANSFORM,
TRANSFORMS, TRANSLATE, TRANSLATION, TREAT, TRIGGER, TRIGGER_CATALOG, TRIGGER_NAME,
TRIGGER_SCHEMA, TRIM, TRUE, TYPE, UESCAPE, UNBOUNDED, UNCOMMITTED, UNDER, UNION, UNIQUE,
UNKNOWN, UNNAMED, UNNEST, UPDATE, UPPER, UPSERT, USAGE, USER, USER_DEFINED_TYPE_CATALOG,
USER_DEFINED_TYPE_CODE, USER_DEFINED_TYPE_NAME, USER_DEFINED_TYPE_SCHEMA, USING, VALUE,
VALUES, VARBINARY, VARCHAR, VARYING, VAR_POP, VAR_SAMP, VERSION, VIEW, WEEK, WHEN,
WHENEVER, WHERE, WIDTH_BUCKET, WINDOW, WITH, WITHIN, WITHOUT, WORK, WRAPPER, WRITE, XML,
YEAR, ZONE
"""
# Punctuation pairs added to the completion dictionary with count 1 each.
PUNCTUATION_PAIRS = ["()", "<>", '""', "''", "{}"]
# ---------------------------------------------------------------------------

RESERVED_WORDS = tuple(w.strip().lower() for w in RESERVED_WORDS_TEXT.split(",") if w.strip())

DICT_SCHEMA = "word string, cou bigint"


def reserved_words(spark: SparkSession) -> DataFrame:
    """(word) -- the keyword dictionary, one row per word. Made from a literal, so
    that the plan knows its size."""
    return spark.range(1).select(F.explode(F.lit(list(RESERVED_WORDS))).alias("word"))


def fixed_counts(spark: SparkSession, words, cou: int = 1) -> DataFrame:
    return spark.createDataFrame([(w, cou) for w in words], DICT_SCHEMA)


def tokenize(df: DataFrame, text_col: str, keep: list[str] | None = None) -> DataFrame:
    """One row per token of ``text_col``, lower-cased (G1); ``keep`` columns
    ride along. Lower-casing runs after the explode, inside whole-stage
    codegen."""
    keep = keep or []
    return (df.select(*keep, F.explode(raw_tokens(text_col)).alias("_t"))
            .select(*keep, F.lower("_t").alias("word")))


def keyword_filter(tokens_df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Tokens that are dictionary words (G2). A dictionary whose planned size is
    small (the fixed keyword list) is broadcast, a learned one joins by shuffle."""
    return tokens_df.join(broadcast_if_small(dictionary.select("word")), "word", "left_semi")


def keyword_frequency(docs: DataFrame, text_col: str, dictionary: DataFrame) -> DataFrame:
    """(word, cou): occurrences of every dictionary word in the corpus plus one,
    words that never occur included with 1 (G3).

    Tokens are filtered against the broadcast dictionary and counted with a
    partial aggregate per task, so at most |dictionary| rows per task reach
    the shuffle, whatever the corpus size.
    """
    counts = keyword_filter(tokenize(docs, text_col), dictionary).groupBy("word").agg(
        F.count(F.lit(1)).alias("n"))
    return (dictionary.select("word").distinct()
            .join(counts, "word", "left")
            .select("word", (F.coalesce(F.col("n"), F.lit(0)) + 1).cast("bigint").alias("cou")))


#: Each byte of a UTF-8 text as its token character in lower case, or as a space (token
#: characters are ASCII).
_SPACED = bytes(ord(chr(i).lower()) if i < 128 and re.fullmatch(TOKEN_RUN, chr(i)) else 32 for i in range(256))


def _counted(batches):
    """(word, n) of each batch of texts, as bytes; the empty word comes between spaces."""
    for batch in batches:
        texts = pa.array([t.as_py().translate(_SPACED) for t in batch.column(0) if t.is_valid], pa.large_binary())
        words = pc.ascii_split_whitespace(texts.cast(pa.large_string())).flatten()
        counts = pc.value_counts(words)
        yield pa.RecordBatch.from_arrays([counts.field("values").cast(pa.string()), counts.field("counts")], ["word", "n"])


def token_counts(docs: DataFrame, text_col: str, min_count: int = 1) -> DataFrame:
    """(word, cou) for every token of the corpus seen ``min_count`` times or more
    -- a dictionary learned from data.

    A task counts the tokens of each batch of its texts instead of making a row of
    every token; the counts are then summed by word."""
    texts = docs.select(F.col(text_col).cast("string").cast("binary"))
    counts = texts.mapInArrow(_counted, "word string, n bigint").where(F.col("word") != "")
    return counts.groupBy("word").agg(F.sum("n").alias("cou")).where(F.col("cou") >= min_count)


def merge_dictionaries(*dicts: DataFrame) -> DataFrame:
    """Counts of the same word summed across dictionaries."""
    u = dicts[0].select("word", F.col("cou").cast("bigint").alias("cou"))
    for d in dicts[1:]:
        u = u.unionByName(d.select("word", F.col("cou").cast("bigint").alias("cou")))
    return u.groupBy("word").agg(F.sum("cou").cast("bigint").alias("cou"))


def completion_dictionary(spark: SparkSession, saved: DataFrame | None = None) -> DataFrame:
    """Keywords (1 each) + punctuation pairs (1 each) + saved counts, summed."""
    parts = [fixed_counts(spark, RESERVED_WORDS), fixed_counts(spark, PUNCTUATION_PAIRS)]
    if saved is not None:
        parts.append(saved)
    return merge_dictionaries(*parts)
