"""URL filters by a temporal list join (operator 3).

A list entry (pattern, action, since) is in force from its date until the next
entry of the same pattern. A pattern is a host (with all its subdomains) or a
host and the first segment of a path. A capture is judged by the entries in
force at its fetch time: the most specific pattern that has one decides, and a
capture without any is not blocked.

1. *Validity intervals*: ``lead`` over each pattern's dated entries. Entries of
   one date on one pattern: the last action by name holds.
2. *As-of join*: a capture asks for its path pattern and all suffixes of its
   host. Patterns are equal-joined, the interval holds the fetch time. Intervals
   of a pattern do not overlap, so a capture gets one row at most from each.

A hot host is many captures against one pattern row; the list is broadcast when
its written size allows it, else the join's skewed side is split at run time.

A null or malformed url has no host and is not blocked; a null fetch time
matches nothing. Entries without a date or pattern never hold. Repeated captures
are judged one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import small, table, written


def url_host(url: Column) -> Column:
    """Lower-case host without user, port or final dot; '' when there is none."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(F.lower(F.regexp_replace(host, r"\.$", "")), F.lit(""))


def url_segment(url: Column) -> Column:
    """First segment of the path; '' when there is none."""
    return F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]+)", 1), F.lit(""))


def intervals(entries: DataFrame) -> DataFrame:
    """(pattern, action, since, until): ``until`` is null for the last entry."""
    one = (entries.where("pattern is not null and since is not null")
           .groupBy("pattern", "since").agg(F.max("action").alias("action")))
    later = Window.partitionBy("pattern").orderBy("since")
    return one.select("pattern", "action", "since", F.lead("since").over(later).alias("until"))


def filter_urls(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures`` (page_id, url, fetched) with host, blocked, pattern, since."""
    listed = written(intervals(entries), "url-list")
    host, segment = F.col("host"), F.col("segment")
    labels = F.split("host", r"\.")
    # (rank, pattern): the path pattern first, then the host, then ever shorter suffixes.
    suffixes = F.transform(labels, lambda _, i: F.struct(
        (i + 1).alias("rank"), F.array_join(F.slice(labels, i + 1, F.size(labels)), ".").alias("pattern")))
    asked = F.when(host != "", F.concat(
        F.when(segment != "", F.array(F.struct(F.lit(0).alias("rank"), F.concat(host, F.lit("/"), segment).alias("pattern"))))
        .otherwise(F.array().cast("array<struct<rank:int,pattern:string>>")), suffixes))
    rows = (captures.select(F.monotonically_increasing_id().alias("row"), "page_id", "url", "fetched")
            .select("*", url_host(F.col("url")).alias("host"), url_segment(F.col("url")).alias("segment"))
            .select("row", "page_id", "host", "fetched", F.explode_outer(asked).alias("q"))
            .select("row", "page_id", "host", "fetched", "q.rank", F.col("q.pattern").alias("asked")))
    holds = ((F.col("asked") == F.col("pattern")) & (F.col("fetched") >= F.col("since")) &
             (F.col("until").isNull() | (F.col("fetched") < F.col("until"))))
    best = F.min(F.when(F.col("pattern").isNotNull(), F.struct("rank", "pattern", "action", "since")))
    return (rows.join(small(listed), holds, "left")
            .groupBy("row").agg(*[F.first(c).alias(c) for c in ("page_id", "host", "fetched")], best.alias("b"))
            .select("page_id", "host", "fetched", F.coalesce(F.col("b.action") == "block", F.lit(False)).alias("blocked"),
                    "b.pattern", "b.since"))


def _number(text: Column, first: int) -> Column:
    """Four hex digits of a text's md5 as a number."""
    return F.conv(F.substring(F.md5(text), first, 4), 16, 10).cast("bigint")


def derived_entries(pages: DataFrame) -> DataFrame:
    """A dated list made from the pages' own hosts, parent domains and path
    patterns: about a third are blocked on some day of the year (day numbers),
    two thirds of those allowed again later, some blocked once more."""
    host, segment = url_host(F.col("url")), url_segment(F.col("url"))
    parent = F.substring_index(host, ".", -3)
    named = pages.select(F.explode(F.array(host, parent, F.concat(host, F.lit("/"), segment))).alias("pattern")).where(
        ~F.col("pattern").startswith("/") & ~F.col("pattern").endswith("/") & (F.col("pattern") != "")).distinct()
    first = _number(F.col("pattern"), 5) % 200
    steps = F.when(_number(F.col("pattern"), 1) % 3 == 0, F.concat(
        F.array(F.struct(F.lit("block").alias("action"), first.alias("since"))),
        F.when(_number(F.col("pattern"), 9) % 3 > 0, F.array(
            F.struct(F.lit("allow").alias("action"), (first + 60).alias("since")),
            F.struct(F.lit("block").alias("action"), (first + 60 + _number(F.col("pattern"), 13) % 200).alias("since"))))
        .otherwise(F.array().cast("array<struct<action:string,since:bigint>>"))))
    return named.select("pattern", F.explode(steps).alias("e")).select("pattern", "e.action", "e.since")


def page_captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch day (0 to 364) from a hash of page_id."""
    return pages.select("page_id", "url", (_number(F.col("page_id").cast("string"), 1) % 365).alias("fetched"))


def url_filter_query(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(page_captures(pages), derived_entries(pages))


ORACLE = r"""
WITH p AS (
  SELECT row_number() OVER () AS rid, page_id, ('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 4))::BIGINT % 365 AS fetched,
    lower(regexp_replace(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1), '\.$', '')) AS host,
    regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]+)', 1) AS segment
  FROM pages),
l AS (SELECT *, string_split(host, '.') AS labels FROM p),
named AS (
  SELECT DISTINCT unnest([host, array_to_string(labels[greatest(len(labels) - 2, 1) :], '.'), host || '/' || segment]) AS pattern FROM l),
h AS (
  SELECT pattern, ('0x' || substr(md5(pattern), 1, 4))::BIGINT AS a, ('0x' || substr(md5(pattern), 5, 4))::BIGINT % 200 AS b,
    ('0x' || substr(md5(pattern), 9, 4))::BIGINT AS c, ('0x' || substr(md5(pattern), 13, 4))::BIGINT AS d
  FROM named WHERE pattern <> '' AND pattern NOT LIKE '/%' AND pattern NOT LIKE '%/'),
raw AS (
  SELECT pattern, 'block' AS action, b AS since FROM h WHERE a % 3 = 0
  UNION ALL SELECT pattern, 'allow', b + 60 FROM h WHERE a % 3 = 0 AND c % 3 > 0
  UNION ALL SELECT pattern, 'block', b + 60 + d % 200 FROM h WHERE a % 3 = 0 AND c % 3 > 0),
e AS (SELECT pattern, since, max(action) AS action FROM raw GROUP BY ALL),
asked AS (
  SELECT rid, fetched, 0 AS rank, host || '/' || segment AS pattern FROM l WHERE host <> '' AND segment <> ''
  UNION ALL SELECT rid, fetched, i AS rank, array_to_string(labels[i :], '.')
  FROM (SELECT rid, fetched, labels, unnest(range(1, len(labels) + 1)) AS i FROM l WHERE host <> '')),
met AS (
  SELECT rid, rank, pattern, action, since FROM (
    SELECT rid, rank, pattern, action, since, row_number() OVER (PARTITION BY rid, rank ORDER BY since DESC) AS k
    FROM asked JOIN e USING (pattern) WHERE since <= fetched) WHERE k = 1),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY rank) AS k FROM met) WHERE k = 1)
SELECT page_id, host, fetched, coalesce(action = 'block', false) AS blocked, pattern, since
FROM p LEFT JOIN best USING (rid)
"""
