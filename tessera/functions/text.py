"""Column expressions for tokens and typed text (JVM-side, no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: tokens are separated by any character outside this class.
TOKEN_SPLIT = "[^a-zA-Z0-9_]"
TOKEN_RUN = "[a-zA-Z0-9_]+"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def raw_tokens(text: str | Column) -> Column:
    """array<string>: the maximal runs of word characters, as written.

    These are exactly the non-empty pieces of a split on ``TOKEN_SPLIT``;
    extracting the runs skips the empty pieces and is several times faster
    than splitting.
    """
    return F.regexp_extract_all(_c(text), F.lit(TOKEN_RUN), 0)


def tokens(text: str | Column) -> Column:
    """array<string>: lower-cased tokens of ``text``."""
    return F.transform(raw_tokens(text), lambda t: F.lower(t))


def last_token(source: str | Column) -> Column:
    """The word being typed: null if ``source`` ends in a space, else the last
    whitespace-separated piece (trailing whitespace of other kinds ignored)."""
    s = _c(source)
    body = F.regexp_replace(s, r"\s+$", "")
    piece = F.element_at(F.split(body, r"\s"), -1)
    return (F.when(s.endswith(" "), F.lit(None).cast("string"))
            .when(piece == F.lit(""), F.lit(None).cast("string"))
            .otherwise(piece))


def prefixes(word: str | Column, first: Column | int, last: Column | int) -> Column:
    """array<struct<i int, p string>>: prefixes of ``word`` of length first..last
    (empty when first > last, unlike a bare ``sequence``)."""
    w = _c(word)
    lo = F.lit(first) if isinstance(first, int) else first
    hi = F.lit(last) if isinstance(last, int) else last
    seq = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))
    return F.transform(seq, lambda i: F.struct(i.alias("i"), F.substring(w, 1, i).alias("p")))


def sql_ident(name: str) -> str:
    """A column name as a quoted SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def sql_string(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
