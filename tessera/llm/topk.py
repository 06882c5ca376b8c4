"""Exact top-k inner products by pivot-table elimination (operator 11).

Vectors are integers ``floor(1024 x)``; a query's score with a candidate is their
inner product. Every query row is answered against every row of another vec_id,
exactly, ties to the smaller vec_id.

1. *Pivots*: up to ``PIVOTS`` vectors that are far from each other, out of a
   bounded sample of ``PIVOT_SAMPLE`` rows (those of smallest hash). They decide
   how much is eliminated, never what is found.
2. *Pivot table*: every vector's distances to all pivots. Rows are ordered by
   nearest pivot and distance to it, cut into blocks of at most ``BLOCK_ROWS``, and
   written with each block's least and greatest distance to every pivot.
3. *Queries* get a first k-th best score from their own block, and are packed
   into blocks in the same order.
4. *Block elimination*: ``max_p |d(q, p) - d(x, p)|`` is a lower bound of d(q, x),
   so ``(|q|^2 + |x|^2 - bound^2) / 2`` is an upper bound of the score. With a
   block's ranges in place of d(x, p) it rules out whole blocks.
5. *Search*: in each remaining pair of blocks, a query's candidates are evaluated
   in the order of their bounds, in growing steps, until the next bound is below the
   k-th best score found or known. The pairs' best rows are merged by a ranking
   that each map task cuts to k first.

On the cluster the moved data are blocks: a pair of blocks (about 1 MB) is a row
and meets in one task; no task holds all queries or all candidates.

A null vector, or one that holds nulls or non-finite components, takes no part.
Shorter vectors end in zeros; an empty one scores 0 with all. Rows without vec_id
are candidates, after all others of their score, and no queries. Rows of a
query's vec_id are its own row; repeated candidates count each, repeated queries
(id and vector) once. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import written
from tessera.llm.vectors import integer_vectors, products, squared_distances, usable, width_of, with_vector

SCALE = 1024
TOP = 10
PIVOTS = 32
PIVOT_SAMPLE = 1024
BLOCK_ROWS = 2048
QUERY_ROWS = 256
#: Blocks whose ranges travel in one row.
PAGE_BLOCKS = 1024
#: float32 distances are off by less than this share of the greatest one.
_SLACK = 1e-6
_NONE = -(1 << 62)


def far_pivots(v: np.ndarray, pivots: int) -> np.ndarray:
    """Up to ``pivots`` rows of ``v``, each the one furthest from those before."""
    if not len(v):
        return v
    chosen = [int((v * v).sum(axis=1).argmax())]
    least = squared_distances(v, v[chosen])[:, 0]
    while len(chosen) < pivots and least.max() > 0:
        chosen.append(int(least.argmax()))
        least = np.minimum(least, squared_distances(v, v[chosen[-1:]])[:, 0])
    return v[chosen]


def pivot_distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(squared_distances(v, pivots)).astype(np.float32)


def upper_bounds(query_norm: np.ndarray, norm: np.ndarray, gap: np.ndarray, most: float) -> np.ndarray:
    """Greatest possible scores, given lower bounds ``gap`` of the distances; ``most``
    is the greatest pivot distance that they come from."""
    gap = np.maximum(gap.astype(np.float64) - _SLACK * most, 0.0)
    return np.floor((query_norm + norm - gap * gap * (1 - 1e-12)) / 2) + 1


def best_first(query: dict, block: dict, k: int) -> tuple[list[tuple[int, np.ndarray, np.ndarray]], int]:
    """For each query that finds any: (its place, rows of the block, scores), at most
    ``k`` each and best first; and the number of inner products.

    ``query``: v, norm, far (pivot distances), known (score that k rows reach),
    ids; ``block``: v, norm, far, ids, order (ranks of its vec_ids).
    """
    gap = np.zeros((len(query["v"]), len(block["v"])), np.float32)
    one = np.empty_like(gap)
    for p in range(query["far"].shape[1]):
        np.subtract(query["far"][:, p, None], block["far"][None, :, p], out=one)
        np.abs(one, out=one)
        np.maximum(gap, one, out=gap)
    most = max(query["far"].max(initial=0), block["far"].max(initial=0))
    bounds = upper_bounds(query["norm"][:, None], block["norm"][None, :], gap, float(most))
    found, measured = [], 0
    for i in range(len(query["v"])):
        rows = np.flatnonzero((bounds[i] >= query["known"][i]) & (block["ids"] != query["ids"][i]))
        rows = rows[np.argsort(-bounds[i, rows], kind="stable")]
        limits = bounds[i, rows]
        best, score, at, step = rows[:0], np.zeros(0, np.int64), 0, 4 * k
        while at < len(rows) and (len(best) < k or limits[at] >= score[-1]):
            part = rows[at:at + step]
            best = np.append(best, part)
            score = np.append(score, products(query["v"][i:i + 1], block["v"][part])[0])
            order = np.lexsort((block["order"][best], -score))[:k]
            best, score = best[order], score[order]
            measured += len(part)
            at, step = at + step, 2 * step
        own = score >= query["known"][i]
        if own.any():
            found.append((i, best[own], score[own]))
    return found, measured


def _matrix(blob, width: int, kind=np.int32) -> np.ndarray:
    return np.frombuffer(blob.as_buffer(), kind).reshape(-1, width)


def _ids(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """vec_ids as numbers to compare (null: one that no query has) and their ranks,
    nulls last."""
    missing = values.is_null().to_numpy(zero_copy_only=False)
    ids = values.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.where(missing, _NONE, ids), np.where(missing, np.iinfo(np.int64).max, ids)


def located(rows: DataFrame, pivots: np.ndarray, scale: int, width: int) -> DataFrame:
    """vec_id, asked, v (packed integers), near, far, tie of every usable row: nearest
    pivot, distance to it, and a number that tells equal vectors apart."""
    kind = rows.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, v = integer_vectors(batch.column(3), scale, width)
            if not len(own):
                continue
            d = pivot_distances(v, pivots)
            near = d.argmin(axis=1)
            take = pa.array(own)
            data = v.astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array([r.tobytes() for r in data], pa.binary()),
                 pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near]), batch.column(2).take(take)],
                ["vec_id", "asked", "v", "near", "far", "tie"])

    tied = rows.select("vec_id", "asked", F.xxhash64("vec_id", F.monotonically_increasing_id()).alias("tie"), "v")
    return tied.mapInArrow(run, f"vec_id {kind}, asked boolean, v binary, near int, far float, tie bigint")


def in_order(rows: DataFrame, size: int, n: int) -> DataFrame:
    """Range partitions of about ``size`` of the ``n`` rows, near vectors together."""
    keys = ("near", "far", "tie")
    return rows.repartitionByRange(max(1, -(-n // size)), *keys).sortWithinPartitions(*keys)


def candidate_blocks(rows: DataFrame, pivots: np.ndarray, width: int) -> DataFrame:
    """block, ids, asked, v, low, high (range of the distances to each pivot), norm
    (greatest squared length): the pivot table by blocks of at most BLOCK_ROWS."""
    kind = rows.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        rest: pa.Table | None = None

        def packed(part: pa.Table) -> pa.RecordBatch:
            nonlocal block
            part = part.combine_chunks()
            v = np.frombuffer(b"".join(part.column("v").to_pylist()), np.int32).reshape(len(part), width).astype(np.int64)
            far = pivot_distances(v, pivots)
            lists = [pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()),
                                              pa.concat_arrays(part.column(c).chunks)) for c in ("vec_id", "asked")]
            block += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([block - 1]), *lists, pa.array([v.astype(np.int32).tobytes()], pa.binary()),
                 pa.array([far.tobytes()], pa.binary()), pa.array([far.min(axis=0).tobytes()], pa.binary()),
                 pa.array([far.max(axis=0).tobytes()], pa.binary()), pa.array([int((v * v).sum(axis=1).max())])],
                ["block", "ids", "asked", "v", "far", "low", "high", "norm"])

        for batch in batches:
            part = pa.Table.from_batches([batch])
            rest = part if rest is None else pa.concat_tables([rest, part])
            while len(rest) > BLOCK_ROWS:
                yield packed(rest.slice(0, BLOCK_ROWS))
                rest = rest.slice(BLOCK_ROWS)
        if rest is not None and len(rest):
            yield packed(rest)

    return rows.select("vec_id", "asked", "v").mapInArrow(
        run, f"block bigint, ids array<{kind}>, asked array<boolean>, v binary, far binary, low binary, "
             "high binary, norm bigint")


def seeded_queries(blocks: DataFrame, pivots: int, width: int, k: int) -> DataFrame:
    """vec_id, v, near, far, known: the rows asked for, once each, with the score
    that ``k`` rows of their own block reach (null where it has fewer)."""
    kind = blocks.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                values = batch.column(0)[n].values
                ids, _ = _ids(values)
                asked = np.flatnonzero(batch.column(1)[n].values.fill_null(False).to_numpy(zero_copy_only=False)
                                       & (ids != _NONE))
                if not len(asked):
                    continue
                v = _matrix(batch.column(2)[n], width)
                far = _matrix(batch.column(3)[n], pivots, np.float32)[asked]
                own = v[asked].astype(np.int64)
                known: list[int | None] = []
                for a in range(0, len(asked), QUERY_ROWS):
                    score = products(own[a:a + QUERY_ROWS], v.astype(np.int64))
                    for row, me in zip(score, ids[asked[a:a + QUERY_ROWS]], strict=True):
                        others = row[ids != me]
                        known.append(int(np.partition(others, -k)[-k]) if len(others) >= k else None)
                near = far.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [values.take(pa.array(asked)), pa.array([r.tobytes() for r in v[asked]], pa.binary()),
                     pa.array(near.astype(np.int32)), pa.array(far[np.arange(len(far)), near]),
                     pa.array(known, pa.int64())], ["vec_id", "v", "near", "far", "known"])

    found = blocks.select("ids", "asked", "v", "far").mapInArrow(
        run, f"vec_id {kind}, v binary, near int, far float, known bigint")
    return found.groupBy("vec_id", "v").agg(F.first("near").alias("near"), F.first("far").alias("far"),
                                            F.max("known").alias("known"), F.xxhash64("vec_id", "v").alias("tie"))


def query_blocks(queries: DataFrame, pivots: np.ndarray, width: int) -> DataFrame:
    """query_block, ids, v, far, known of at most QUERY_ROWS queries."""
    kind = queries.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for a in range(0, batch.num_rows, QUERY_ROWS):
                part = batch.slice(a, QUERY_ROWS)
                v = np.frombuffer(b"".join(part.column(1).to_pylist()), np.int32).reshape(part.num_rows, width)
                known = part.column(2).fill_null(_NONE).to_numpy(zero_copy_only=False)
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()),
                                               pa.concat_arrays([part.column(0)]))
                far = pivot_distances(v.astype(np.int64), pivots)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block]), ids, *(pa.array([x.tobytes()], pa.binary()) for x in (v, far, known))],
                    ["query_block", "ids", "v", "far", "known"])
                block += 1

    return queries.select("vec_id", "v", "known").mapInArrow(
        run, f"query_block bigint, ids array<{kind}>, v binary, far binary, known binary")


def block_pairs(queries: DataFrame, blocks: DataFrame, pivots: int, width: int) -> DataFrame:
    """(query_block, block) where some query's bound for the block reaches the score
    it already has."""
    pages = max(1, -(-blocks.count() // PAGE_BLOCKS))
    ranges = blocks.groupBy(F.pmod(F.xxhash64("block"), F.lit(pages)).cast("int").alias("page")).agg(
        F.collect_list(F.struct("block", "low", "high", "norm")).alias("ranges"))
    rows = (queries.select("query_block", "v", "far", "known",
                           F.explode(F.sequence(F.lit(0), F.lit(pages - 1))).alias("page"))
            .join(ranges, "page").select("query_block", "v", "far", "known", "ranges"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                v = _matrix(batch.column(1)[n], width).astype(np.int64)
                far = _matrix(batch.column(2)[n], pivots, np.float32)
                known = _matrix(batch.column(3)[n], 1, np.int64)[:, 0]
                norm = (v * v).sum(axis=1)
                keep = []
                for r in batch.column(4)[n].values.to_pylist():
                    low, high = np.frombuffer(r["low"], np.float32), np.frombuffer(r["high"], np.float32)
                    gap = np.maximum(np.maximum(far - high, low - far), 0).max(axis=1, initial=0)
                    most = float(max(far.max(initial=0), high.max(initial=0)))
                    if (upper_bounds(norm, r["norm"], gap, most) >= known).any():
                        keep.append(r["block"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[n].as_py()] * len(keep), pa.int64()), pa.array(keep, pa.int64())],
                    ["query_block", "block"])

    return rows.mapInArrow(run, "query_block bigint, block bigint")


def searched(pairs: DataFrame, queries: DataFrame, blocks: DataFrame, pivots: int, width: int, k: int) -> DataFrame:
    """asked (number of the query), query_id, vec_id, score: each pair of blocks' best."""
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    rows = (pairs.join(queries.withColumnsRenamed({"ids": "query_ids", "v": "qv", "far": "qfar"}), "query_block")
            .join(blocks.select("block", "ids", "v", "far"), "block")
            .select("query_block", "query_ids", "qv", "qfar", "known", "ids", "v", "far"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                first, asked, qv, qfar, known, values, v, far = (batch.column(c)[n] for c in range(8))
                query = {"v": _matrix(qv, width).astype(np.int64), "far": _matrix(qfar, pivots, np.float32),
                         "known": _matrix(known, 1, np.int64)[:, 0], "ids": _ids(asked.values)[0]}
                ids, order = _ids(values.values)
                block = {"v": _matrix(v, width).astype(np.int64), "far": _matrix(far, pivots, np.float32),
                         "ids": ids, "order": order}
                for side in (query, block):
                    side["norm"] = (side["v"] * side["v"]).sum(axis=1).astype(np.float64)
                found, _ = best_first(query, block, k)
                if not found:
                    continue
                who = np.repeat([i for i, _, _ in found], [len(s) for _, _, s in found])
                rows = np.concatenate([r for _, r, _ in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first.as_py() + who), asked.values.take(pa.array(who)),
                     values.values.take(pa.array(rows)), pa.array(np.concatenate([s for _, _, s in found]))],
                    ["asked", "query_id", "vec_id", "score"])

    return rows.mapInArrow(run, f"asked bigint, query_id {kind}, vec_id {kind}, score bigint")


def exact_top_k(embeddings: DataFrame, asked: Column, k: int = TOP, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: for every row where ``asked`` holds, the ``k``
    rows of another vec_id with the highest scores (all, if there are fewer)."""
    rows = with_vector(embeddings.withColumn("asked", asked), "vec_id", "asked")
    width = max(1, width_of(rows))
    sample = (rows.where(usable(F.col("v"))).orderBy(F.xxhash64("vec_id"), "v").limit(PIVOT_SAMPLE)
              .select("v").toArrow())
    pivots = far_pivots(integer_vectors(sample.column("v"), scale, width)[1], PIVOTS)
    if not len(pivots):  # no usable row
        kind = rows.schema["vec_id"].dataType.simpleString()
        return embeddings.sparkSession.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score bigint")
    n = embeddings.count()
    blocks = written(candidate_blocks(in_order(located(rows, pivots, scale, width), BLOCK_ROWS, n), pivots, width), "blocks")
    seeded = written(seeded_queries(blocks, len(pivots), width, k), "queries")
    queries = written(query_blocks(in_order(seeded, QUERY_ROWS, seeded.count()), pivots, width), "query-blocks")
    pairs = written(block_pairs(queries, blocks, len(pivots), width), "block-pairs")
    found = searched(pairs, queries, blocks, len(pivots), width, k)
    order = Window.partitionBy("asked").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def top_inner_products(embeddings: DataFrame) -> DataFrame:
    """Contract of op11: queries are the rows whose vec_id is divisible by 100."""
    return exact_top_k(embeddings, F.col("vec_id") % 100 == 0)


ORACLE = f"""with kept as (select vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)) as v
      from embeddings where embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    scored as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
      from kept q join kept c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id)
    select query_id, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank, vec_id, score
    from scored qualify rank <= {TOP}"""
