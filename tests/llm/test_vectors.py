"""Operators 11 to 13 against brute force, on awkward and on random vectors."""

import hashlib
from collections import defaultdict
from math import floor, isfinite

import numpy as np
import pytest

from tessera.llm import clustering, codes, topk
from tessera.llm.common import written
from tessera.llm.vectors import integer_vectors, products, usable, with_vector

SCHEMA = "vec_id long, embedding array<float>, label int, v string, code int, score string, near int, cluster int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1, "y", 2, 3) for i, v, label in rows], SCHEMA)


def awkward(width=64, n=230, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.2, (5, width))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 5] + rng.normal(0, 0.05, width)], [None, 1, 2][i % 3])
            for i in range(n)]
    rows += [(300 + i, rows[7][1], 1) for i in range(90)]  # a vector that many rows hold
    rows += [(400, rows[100][1], 1), (None, rows[8][1], None), (500, None, 1), (501, [None] * width, 1),
             (502, [float("nan")] + [0.0] * (width - 1), 2), (503, [float("inf")] * width, 2),
             (504, [1.0, None] + [0.0] * (width - 2), 2), (600, [0.0] * width, 1), (-100, [-0.5] * width, None)]
    return rows


def whole(v, scale, width):
    if v is None or any(x is None or not isfinite(x) for x in v):
        return None
    return [floor(scale * x) for x in v] + [0] * (width - len(v))


def brute_top(rows, k=10):
    width = max((len(v) for _, v, _ in rows if v), default=0)
    kept = [(i, whole(v, 1024, width)) for i, v, _ in rows]
    kept = [(i, v) for i, v in kept if v is not None]
    out = []
    for q, qv in {(i, tuple(v)) for i, v in kept if i is not None and i % 100 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(qv, v)), i is None, i or 0) for i, v in kept if i != q)
        out += [(q, r + 1, None if missing else i, -s) for r, (s, missing, i) in enumerate(scored[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("blocks", [(2048, 256, 1024), (7, 2, 3)])
def test_top_k_is_brute_force(spark, monkeypatch, blocks):
    for name, value in zip(("BLOCK_ROWS", "QUERY_ROWS", "PAGE_BLOCKS"), blocks, strict=True):
        monkeypatch.setattr(topk, name, value)
    rows = awkward()
    found = topk.top_inner_products(table(spark, rows))
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect()), key=repr) == brute_top(rows)


def test_top_k_of_other_lengths_repeats_and_few_rows(spark):
    rows = [(0, [1.0, 2.0], 1), (100, [], 1), (100, [], 1), (3, [0.5], 1), (3, [0.5], 1), (200, [0.1, 0.2, 0.3], 1)]
    assert sorted(map(tuple, topk.top_inner_products(table(spark, rows)).collect()), key=repr) == brute_top(rows)
    assert topk.top_inner_products(table(spark, [])).collect() == []
    assert topk.top_inner_products(table(spark, [(1, [1.0], 1), (100, None, 1)])).collect() == []
    assert topk.top_inner_products(table(spark, [(100, [1.0], 1)])).collect() == []


def test_pivots_eliminate_and_the_order_stops():
    """Far clusters: most candidates are never evaluated."""
    rng = np.random.default_rng(1)
    v = (rng.normal(0, 400, (20, 32))[np.arange(2000) % 20] + rng.normal(0, 20, (2000, 32))).astype(np.int64)
    pivots = topk.far_pivots(v[:500], 32)
    far = topk.pivot_distances(v, pivots)
    block = {"v": v, "far": far, "ids": np.arange(2000), "order": np.arange(2000),
             "norm": (v * v).sum(axis=1).astype(float)}
    query = {c: x[:40] for c, x in block.items()} | {"known": np.full(40, topk._NONE)}
    found, measured = topk.best_first(query, block, 10)
    assert measured < 40 * 2000 / 3
    for i, rows, score in found:
        full = v @ v[i]
        full[i] = -(1 << 60)
        assert sorted(score.tolist(), reverse=True) == sorted(full.tolist(), reverse=True)[:10]


def test_bounds_hold_for_every_pair():
    rng = np.random.default_rng(2)
    v = rng.integers(-3000, 3000, (300, 16))
    far = topk.pivot_distances(v, topk.far_pivots(v, 8))
    gap = np.abs(far[:, None] - far[None]).max(axis=2)
    norm = (v * v).sum(axis=1).astype(float)
    assert (topk.upper_bounds(norm[:, None], norm[None], gap, float(far.max())) >= v @ v.T).all()


def brute_clusters(rows, k=16, rounds=3):
    kept = [(i, whole(v, 64, 64)) for i, v, _ in rows if v is not None and len(v) == 64]
    kept = [(i, v) for i, v in kept if v is not None]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cent = [v for _, v in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cent)) for _, v in kept]

    for _ in range(rounds):
        to = assign()
        for j in range(len(cent)):
            own = [v for (_, v), (_, c) in zip(kept, to) if c == j]
            if own:
                cent[j] = [sum(x) // len(own) for x in zip(*own)]
    to = assign()
    per = defaultdict(int)
    for d, c in to:
        per[c] += d
    return sorted([(i, c, d, per[c], sum(per.values()), hashlib.sha256(",".join(map(str, cent[c])).encode()).hexdigest())
                   for (i, _), (d, c) in zip(kept, to)], key=repr)


def test_clusters_are_brute_force(spark):
    rows = awkward() + [(700, [1.0] * 63, 1), (701, [], 1)] + [(9, awkward()[9][1], 1)] * 3
    found = clustering.clusters(table(spark, rows))
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == brute_clusters(rows)
    few = rows[:3]
    assert sorted(map(tuple, clustering.clusters(table(spark, few)).collect()), key=repr) == brute_clusters(few)
    assert clustering.clusters(table(spark, [])).collect() == []
    assert clustering.clusters(table(spark, [(1, None, 1), (2, [1.0], 1)])).collect() == []


def test_orchard_is_a_full_search_with_ties_and_measures_less():
    rng = np.random.default_rng(4)
    cent = np.concatenate([rng.integers(-3, 4, (12, 3)), rng.integers(-3, 4, (4, 3))[[0, 0, 1, 1]]])
    v = rng.integers(-4, 5, (5000, 3))
    d = ((v[:, None] - cent[None]) ** 2).sum(axis=2)
    cluster, distance, _ = clustering.orchard(v, cent)
    assert (cluster == d.argmin(axis=1)).all() and (distance == d.min(axis=1)).all()
    far = rng.integers(-2000, 2000, (16, 8))
    near = far[rng.integers(0, 16, 4000)] + rng.integers(-20, 20, (4000, 8))
    cluster, _, measured = clustering.orchard(near, far)
    assert measured < 4000 * 16 * 0.7
    assert (cluster == ((near[:, None] - far[None]) ** 2).sum(axis=2).argmin(axis=1)).all()


def brute_codes(rows, parts=16, entries=64, rounds=2):
    width = max((len(v) for _, v, _ in rows if whole(v, 1, 0) is not None), default=0)
    size = max(1, -(-width // parts))
    kept = [(i, label, whole(v, 256, size * parts)) for i, v, label in rows]
    kept = [r for r in kept if r[2] is not None]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    cut = lambda v: [v[p * size:(p + 1) * size] for p in range(parts)]
    books = [[cut(v)[p] for _, _, v in first] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(books[p]))
                 for p, x in enumerate(cut(v))] for _, _, v in kept]

    for _ in range(rounds):
        to = assign()
        for p in range(parts):
            for j in range(len(books[p])):
                own = [cut(v)[p] for (_, _, v), t in zip(kept, to) if t[p][1] == j]
                if own:
                    books[p][j] = [sum(x) // len(own) for x in zip(*own)]
    to = assign()
    errors = [sum(d for d, _ in t) for t in to]
    per = defaultdict(int)
    for (_, label, _), e in zip(kept, errors):
        per[label] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted([(i, "".join(f"{c:02x}" for _, c in t), e, per[label], digest)
                   for (i, label, _), t, e in zip(kept, to, errors)], key=repr)


@pytest.mark.parametrize("sizes", [(16, 65536), (5, 50)])
def test_codes_are_brute_force(spark, monkeypatch, sizes):
    monkeypatch.setattr(codes, "BLOCK", sizes[0])
    monkeypatch.setattr(codes, "CHUNK_ROWS", sizes[1])
    rows = awkward()
    found = codes.vector_codes(table(spark, rows))
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == brute_codes(rows)


def test_codes_of_other_lengths_and_few_rows(spark):
    for rows in ([(1, [0.5] * 20, 1), (2, [], None), (None, [0.1] * 3, 1), (2, [0.2] * 20, 1), (3, [0.9] * 50, 2)],
                 [(4, [], 1)], [(7, [0.1] * 64, None)] * 3):
        assert sorted(map(tuple, codes.vector_codes(table(spark, rows)).collect()), key=repr) == brute_codes(rows)
    assert codes.vector_codes(table(spark, [])).collect() == []


def test_shortlists_keep_the_nearest_and_drop_most():
    rng = np.random.default_rng(6)
    parts = np.concatenate([rng.integers(-60, 60, (3000, 4)), np.full((500, 4), 9)])
    entries = rng.integers(-60, 60, (64, 4))
    blocks = codes.Blocks.of(parts)
    d = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    code, error = blocks.codes(entries)
    assert (code == d.argmin(axis=1)).all() and (error == d.min(axis=1)).all()
    sums, counts = np.zeros((64, 4), np.int64), np.zeros(64, np.int64)
    assert blocks.add_to(entries, sums, counts) < 3500 * 64 * 0.6
    assert (counts == np.bincount(code, minlength=64)).all()
    assert all((sums[e] == parts[code == e].sum(axis=0)).all() for e in range(64))


def test_hilbert_neighbours_are_adjacent():
    side = np.arange(16)
    grid = np.stack(np.meshgrid(side, side, indexing="ij"), axis=-1).reshape(-1, 2)
    walk = grid[np.argsort(codes.hilbert_rank(grid))]
    near = codes.hilbert_rank(grid)
    assert len(set(near.tolist())) == 256
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).mean() > 0.9


def test_both_notions_of_a_usable_vector_agree(spark):
    rows = with_vector(table(spark, awkward() + [(800, [], 1)]), "vec_id")
    kept = {r["vec_id"] for r in rows.where(usable(rows["v"])).collect()}
    own = rows.toArrow()
    at, _ = integer_vectors(own.column("v"), 1, 64)
    assert kept == {own.column("vec_id")[int(i)].as_py() for i in at}


def test_products_are_exact_and_large_components_raise(spark):
    a = np.array([[1 << 26, (1 << 26) + 1, 3]])
    assert products(a, a)[0, 0] == sum(x * x for x in a[0].tolist())
    with pytest.raises(Exception, match="component"):
        clustering.clusters(table(spark, [(1, [1e30] * 64, 1)])).collect()


def test_operators_read_no_other_columns(spark):
    path = written(table(spark, awkward()), "vector-columns")
    plan = path.select("vec_id", "embedding")._jdf.queryExecution().toString()
    assert "label" not in plan.split("== Physical Plan ==")[1]
