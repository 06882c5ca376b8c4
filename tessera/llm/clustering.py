"""Centroid clustering with Orchard's search (operator 12).

Vectors of exactly ``width`` usable components are integers ``floor(64 x)``.
Centroids 0, 1, ... start as the vectors with the smallest SHA-256 of
``1:<vec_id>``. A round assigns every vector to its nearest centroid (squared
Euclidean distance, ties to the smaller number) and replaces every non-empty
centroid by the floor of its vectors' mean; empty ones stay. After the rounds,
vectors are assigned once more.

*Search.* Each centroid has a list of the others, sorted by their distance from
it. A vector walks the list of its current centroid; whenever it finds a closer
one it jumps to that one's list. Centroids seen once are marked and not measured
again. It stops where the list's next centroid is strictly further from the
current one than twice the vector's distance: by the triangle inequality all
that follow are strictly further away, ties included.

*On the cluster.* A round is one scan of the vector column; a task sends its
sums for each (centroid, component) only. What reaches the driver, and what is
broadcast, is the centroids. Vectors are never shuffled.

Null vectors, null or non-finite components and other lengths leave a row out.
A row without vec_id hashes the text ``1:``; repeated rows count each, and of
rows with one hash the smaller vector comes first. With fewer vectors than
centroids there are fewer centroids; no vector, no row. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import written
from tessera.llm.vectors import digest_text, integer_vectors, squared_distances, usable, with_vector

CENTROIDS = 16
ROUNDS = 3
SCALE = 64
WIDTH = 64


def neighbour_lists(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the other centroids by distance from each one, their squared distances)."""
    gaps = squared_distances(centroids, centroids)
    k = len(centroids)
    order = np.argsort(gaps, axis=1, kind="stable")
    order = order[order != np.arange(k)[:, None]].reshape(k, k - 1)
    return order, np.take_along_axis(gaps, order, axis=1)


def orchard(v: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest centroid and squared distance of every row of ``v``, number of
    distances measured)."""
    lists, gaps = neighbour_lists(centroids)
    n, k = len(v), len(centroids)
    current = np.zeros(n, np.int64)
    best = ((v - centroids[0]) ** 2).sum(axis=1)
    seen = np.zeros((n, k), bool)
    seen[:, 0] = True
    at = np.zeros(n, np.int64)
    measured = n
    walking = np.arange(n) if k > 1 else np.zeros(0, np.int64)
    while len(walking):
        own, place = current[walking], at[walking]
        go = gaps[own, place] <= 4 * best[walking]
        walking, nearby = walking[go], lists[own, place][go]
        at[walking] += 1
        fresh = ~seen[walking, nearby]
        rows, other = walking[fresh], nearby[fresh]
        seen[rows, other] = True
        d = ((v[rows] - centroids[other]) ** 2).sum(axis=1)
        measured += len(rows)
        closer = (d < best[rows]) | ((d == best[rows]) & (other < current[rows]))
        rows = rows[closer]
        best[rows], current[rows], at[rows] = d[closer], other[closer], 0
        walking = walking[at[walking] < k - 1]
    return current, best, measured


def starting_centroids(rows: DataFrame, k: int, scale: int, width: int) -> np.ndarray:
    """Of the usable vectors the ``k`` with the smallest hash, in hash order."""
    order = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = (rows.where(usable(F.col("v")) & (F.size("v") == width))
             .orderBy(order, "v").limit(k).select("v").toArrow())
    return integer_vectors(first.column("v"), scale, width, exact=True)[1]


def moved(rows: DataFrame, centroids: np.ndarray, scale: int) -> np.ndarray:
    """One round: the centroids after the assignment of all rows."""
    k, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            v = integer_vectors(batch.column(0), scale, width, exact=True)[1]
            cluster, _, _ = orchard(v, centroids)
            order = np.argsort(cluster, kind="stable")
            cuts = np.searchsorted(cluster[order], np.arange(k))
            n = np.bincount(cluster, minlength=k)
            full = n > 0
            if full.any():
                sums[full] += np.add.reduceat(v[order], cuts[full], axis=0)
            counts += n
        own = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(own, width)), pa.array(np.tile(np.arange(width), len(own))),
             pa.array(sums[own].ravel()), pa.array(np.repeat(counts[own], width))],
            ["cluster", "place", "total", "n"])

    # At most k * width rows come back, whatever the number of vectors.
    found = (rows.select("v").mapInArrow(run, "cluster bigint, place bigint, total bigint, n bigint")
             .groupBy("cluster", "place")
             .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect())
    new = centroids.copy()
    for r in found:
        new[r["cluster"], r["place"]] = int(r["total"]) // r["n"]
    return new


def assigned(rows: DataFrame, centroids: np.ndarray, scale: int) -> DataFrame:
    """vec_id, cluster, distance (squared) of every usable row (vec_id, v)."""
    width = centroids.shape[1]
    kind = rows.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, v = integer_vectors(batch.column(1), scale, width, exact=True)
            if len(own):
                cluster, distance, _ = orchard(v, centroids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(own)), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                    ["vec_id", "cluster", "distance"])

    return rows.select("vec_id", "v").mapInArrow(run, f"vec_id {kind}, cluster int, distance bigint")


def cluster_vectors(embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, scale: int = SCALE,
                    width: int = WIDTH) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster and distance of every usable vector; the final centroids)."""
    rows = with_vector(embeddings, "vec_id")
    centroids = starting_centroids(rows, k, scale, width)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(rows, centroids, scale)
    return assigned(rows, centroids, scale), centroids


def clusters(embeddings: DataFrame) -> DataFrame:
    """Contract of op12: vec_id, cluster, distance, inertia of the cluster and of
    all, hash of the cluster's final centroid."""
    found, centroids = cluster_vectors(embeddings)
    found = written(found, "clusters")
    spark = embeddings.sparkSession
    hashes = spark.createDataFrame(
        [(i, hashlib.sha256(digest_text(c).encode()).hexdigest()) for i, c in enumerate(centroids)],
        "cluster int, centroid_sha256 string")
    # One row a centroid, so at most k rows; all of them in one window.
    each = (found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own"))
            .withColumn("total", F.sum("own").over(Window.partitionBy(F.lit(0))))
            .join(F.broadcast(hashes), "cluster"))
    return found.join(F.broadcast(each), "cluster").select(
        "vec_id", "cluster", "distance", F.col("own").cast("bigint").alias("cluster_inertia"),
        F.col("total").cast("bigint").alias("inertia"), "centroid_sha256")


def _oracle() -> str:
    """Brute force in DuckDB SQL: every vector against every centroid, each round."""
    steps = [f"""kept as (select vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)) as v
      from embeddings where embedding is not null and len(embedding) = {WIDTH}
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
             f"""c0 as (select row_number() over (order by sha256('1:' || coalesce(vec_id::varchar, '')), v) - 1 as c, v
      from kept qualify c < {CENTROIDS})"""]
    for i in range(ROUNDS + 1):
        steps.append(f"""a{i} as (select rid, any_value(k.vec_id) as vec_id, any_value(k.v) as v,
          min((list_inner_product(k.v, k.v) + list_inner_product(c.v, c.v)
               - 2 * list_inner_product(k.v, c.v))::bigint * {CENTROIDS} + c.c) as best
          from (select *, row_number() over () as rid from kept) k, c{i} c group by rid)""")
        if i < ROUNDS:
            steps.append(f"""m{i} as (select best % {CENTROIDS} as c, i, floor(sum(v[i]::hugeint) / count(*)) as x
              from a{i}, range(1, {WIDTH + 1}) r(i) group by 1, 2)""")
            steps.append(f"""c{i + 1} as (select c.c, coalesce(l.v, c.v) as v from c{i} c
              left join (select c, list(x order by i) as v from m{i} group by c) l on c.c = l.c)""")
    steps.append(f"""found as (select vec_id, (best % {CENTROIDS})::integer as cluster,
      best // {CENTROIDS} as distance from a{ROUNDS})""")
    return "with " + ",\n".join(s.replace(" as (", " as materialized (", 1) for s in steps) + f"""
    select vec_id, cluster, distance, sum(distance) over (partition by cluster)::bigint as cluster_inertia,
      sum(distance) over ()::bigint as inertia,
      sha256(array_to_string(list_transform(c.v, lambda x: x::bigint), ',')) as centroid_sha256
    from found join c{ROUNDS} c on c.c = cluster"""


ORACLE = _oracle()
