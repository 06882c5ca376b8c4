"""Vector code compression with box shortlists (operator 13).

Usable vectors, as integers ``floor(256 x)``, are cut into 16 equal consecutive
parts. Each part position has a codebook of 64 entries, at first that part of the
64 smallest vec_ids. A round assigns every part to its nearest entry (squared
Euclidean distance, ties to the lower index) and replaces each entry by the floor
of its parts' mean; unused entries stay. At the end parts are assigned again.

*Blocks.* A task packs its rows into chunks. For each part position a chunk holds
its parts in Hilbert order, cut into flat blocks of ``BLOCK`` parts, and for each
block the least and greatest components (its box) and the component sums. Chunks
are written once; rounds read them.

*Rounds.* An entry's least distance to a box that exceeds some entry's greatest
distance rules it out for the whole block. What is left, per block, is a
shortlist. A block with one entry on it adds its stored sums without looking at
its parts; the others are measured against their shortlist in exact integers.
Bounds are exact integers too, so the result is that of a full search.

*On the cluster.* Vectors are never shuffled: blocks are made of a task's own
rows, and a round sends a task's sums for each (part, entry) only. The codebooks
(16 x 64 entries) are all that reaches the driver or is broadcast.

A null vector, or one that holds nulls or non-finite components, leaves its row
out. The width is that of the longest vector, up to a multiple of 16; shorter
vectors end in zeros. Rows without vec_id come last in the choice of first
entries, equal ids by their vectors. With fewer than 64 vectors the codebooks
have fewer entries. Repeated rows count each; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import small, written
from tessera.llm.vectors import digest_text, integer_vectors, usable, width_of, with_vector

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Parts of a block, and rows of a chunk (one row of the chunk table).
BLOCK = 16
CHUNK_ROWS = 65536
#: Distances that one kernel call holds.
_KERNEL = 1 << 20


def hilbert_rank(points: np.ndarray) -> np.ndarray:
    """Position of every point (rows of integers) on a Hilbert curve over their box.

    Bits of the curve are found dimension by dimension as published by J. Skilling
    ("Programming the Hilbert curve", 2004), for all points at once. It only
    decides which parts share a block, never a result; beyond 63 dimensions the
    first 63 are used.
    """
    x = points[:, :63].astype(np.int64)
    n, dims = x.shape
    if not n or not dims:
        return np.zeros(n, np.int64)
    bits = min(63 // dims, 10)
    low = x.min(axis=0)
    span = np.maximum(x.max(axis=0) - low, 1)
    x = ((x - low) * ((1 << bits) - 1) // span).T.copy()
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(dims):
            turn = (x[i] & q) != 0
            swap = np.where(turn, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(turn, q - 1, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros(n, np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where(x[dims - 1] & q, q - 1, 0)
        q >>= 1
    x ^= flip
    rank = np.zeros(n, np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            rank = (rank << 1) | ((x[i] >> b) & 1)
    return rank


class Blocks:
    """One part position of a chunk: parts in Hilbert order, in blocks with boxes and sums."""

    def __init__(self, order, parts, low, high, sums):
        self.order, self.parts, self.low, self.high, self.sums = order, parts, low, high, sums
        self.n = len(parts)
        self.sizes = np.minimum(BLOCK, self.n - np.arange(len(low)) * BLOCK)

    @classmethod
    def of(cls, parts: np.ndarray) -> Blocks:
        order = np.argsort(hilbert_rank(parts), kind="stable")
        own = parts[order]
        cuts = np.arange(0, len(own), BLOCK)
        return cls(order, own, np.minimum.reduceat(own, cuts), np.maximum.reduceat(own, cuts),
                   np.add.reduceat(own, cuts))

    def shortlists(self, entries: np.ndarray) -> np.ndarray:
        """blocks x entries: entries that may be nearest to a part of the block."""
        e, low, high = entries[None], self.low[:, None], self.high[:, None]
        outside = np.maximum(low - e, 0) + np.maximum(e - high, 0)
        least = (outside * outside).sum(axis=2)
        far = np.maximum(np.abs(e - low), np.abs(high - e))
        return least <= (far * far).sum(axis=2).min(axis=1)[:, None]

    def nearest(self, entries: np.ndarray, short: np.ndarray, blocks: np.ndarray):
        """Yields (blocks, entry of every part, squared distance) by exact integer
        kernels over the shortlists. A last short block repeats its last part."""
        length = short[blocks].sum(axis=1)
        # Shortlists of like length share a kernel; the shorter repeat their last entry.
        kind = np.ceil(np.log2(np.maximum(length, 1))).astype(int)
        for of in np.unique(kind):
            same, most = blocks[kind == of], int(length[kind == of].max())
            step = max(1, _KERNEL // (BLOCK * most))
            for a in range(0, len(same), step):
                own = same[a:a + step]
                rank = np.argsort(~short[own], axis=1, kind="stable")[:, :most]
                count = short[own].sum(axis=1)
                listed = np.take_along_axis(rank, np.minimum(np.arange(most), count[:, None] - 1), axis=1)
                at = np.minimum(own[:, None] * BLOCK + np.arange(BLOCK), self.n - 1)
                x, e = self.parts[at], entries[listed]
                d = np.zeros((len(own), BLOCK, most), np.int64)
                for c in range(entries.shape[1]):
                    gap = x[:, :, None, c] - e[:, None, :, c]
                    d += gap * gap
                pick = d.argmin(axis=2)  # the first of equals, and lists ascend
                yield (own, np.take_along_axis(listed, pick, axis=1),
                       np.take_along_axis(d, pick[:, :, None], axis=2)[:, :, 0])

    def add_to(self, entries: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> int:
        """Adds the parts to their nearest entries; returns the number of distances measured."""
        short = self.shortlists(entries)
        alone = short.sum(axis=1) == 1
        to = short[alone].argmax(axis=1)
        np.add.at(sums, to, self.sums[alone])
        np.add.at(counts, to, self.sizes[alone])
        blocks = np.flatnonzero(~alone)
        for own, entry, _ in self.nearest(entries, short, blocks):
            real = np.arange(BLOCK) < self.sizes[own][:, None]
            at = (own[:, None] * BLOCK + np.arange(BLOCK))[real]
            to = entry[real]
            counts += np.bincount(to, minlength=len(counts))
            order = np.argsort(to, kind="stable")
            starts = np.flatnonzero(np.append(True, np.diff(to[order]) > 0))
            sums[to[order][starts]] += np.add.reduceat(self.parts[at[order]], starts, axis=0)
        return int((short[blocks].sum(axis=1) * self.sizes[blocks]).sum())

    def codes(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of every part, in the chunk's row order."""
        code, error = np.zeros(self.n, np.int64), np.zeros(self.n, np.int64)
        for own, entry, d in self.nearest(entries, self.shortlists(entries), np.arange(len(self.low))):
            real = np.arange(BLOCK) < self.sizes[own][:, None]
            rows = self.order[(own[:, None] * BLOCK + np.arange(BLOCK))[real]]
            code[rows], error[rows] = entry[real], d[real]
        return code, error


_FIELDS = ("places", "parts", "low", "high", "sums")


def chunk_table(rows: DataFrame, scale: int, parts: int, width: int) -> DataFrame:
    """One row a chunk: its vec_ids and labels, and the blocks of every part position."""
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")}

    def packed(held: list[tuple]) -> pa.RecordBatch:
        v = np.concatenate([m for _, _, m in held])
        size = width // parts
        blocks = [Blocks.of(v[:, p * size:(p + 1) * size]) for p in range(parts)]
        out = []
        for at in (0, 1):
            column = pa.concat_arrays([h[at] for h in held])
            out.append(pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column))
        for cols in ([b.order for b in blocks], [b.parts for b in blocks], [b.low for b in blocks],
                     [b.high for b in blocks]):
            out.append(pa.array([np.stack(cols).astype(np.int32).tobytes()], pa.binary()))
        out.append(pa.array([np.stack([b.sums for b in blocks]).astype(np.int64).tobytes()], pa.binary()))
        return pa.RecordBatch.from_arrays(out, ["ids", "labels", *_FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            own, v = integer_vectors(batch.column(2), scale, width)
            if len(own):
                take = pa.array(own)
                held.append((batch.column(0).take(take), batch.column(1).take(take), v))
            if sum(len(h[2]) for h in held) >= CHUNK_ROWS:
                yield packed(held)
                held = []
        if held:
            yield packed(held)

    return rows.select("vec_id", "label", "v").mapInArrow(
        run, f"ids array<{kinds['vec_id']}>, labels array<{kinds['label']}>, "
             + ", ".join(f"{c} binary" for c in _FIELDS))


def _unpacked(batch: pa.RecordBatch, i: int, parts: int, size: int) -> list[Blocks]:
    raw = {c: batch.column(batch.schema.get_field_index(c))[i].as_buffer() for c in _FIELDS}
    whole = [np.frombuffer(raw["places"], np.int32).reshape(parts, -1)]
    for c, kind in (("parts", np.int32), ("low", np.int32), ("high", np.int32), ("sums", np.int64)):
        whole.append(np.frombuffer(raw[c], kind).reshape(parts, -1, size).astype(np.int64))
    return [Blocks(*(x[p] for x in whole)) for p in range(parts)]


def moved(chunks: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: the codebooks (parts x entries x size) after assigning all parts."""
    parts, entries, size = books.shape
    names = ["part", "entry", "place", "total", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                for p, blocks in enumerate(_unpacked(batch, i, parts, size)):
                    blocks.add_to(books[p], sums[p], counts[p])
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(part, size)), pa.array(np.repeat(entry, size)),
             pa.array(np.tile(np.arange(size), len(part))), pa.array(sums[part, entry].ravel()),
             pa.array(np.repeat(counts[part, entry], size))], names)

    # At most parts * entries * size rows come back, whatever the number of vectors.
    found = (chunks.select(*_FIELDS).mapInArrow(run, ", ".join(f"{c} bigint" for c in names))
             .groupBy(*names[:3]).agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"),
                                      F.sum("n").alias("n")).collect())
    new = books.copy()
    for r in found:
        new[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return new


def encoded(chunks: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code, error of every row of the chunks."""
    parts, _, size = books.shape
    ids, labels = (chunks.schema[c].dataType.elementType.simpleString() for c in ("ids", "labels"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own = batch.slice(i, 1)
                found = [b.codes(books[p]) for p, b in enumerate(_unpacked(batch, i, parts, size))]
                text = np.stack([c for c, _ in found], axis=1).astype(np.uint8).tobytes().hex()
                error = np.sum([e for _, e in found], axis=0)
                width = 2 * parts
                yield pa.RecordBatch.from_arrays(
                    [own.column(0).flatten(), own.column(1).flatten(),
                     pa.array([text[a:a + width] for a in range(0, len(text), width)], pa.string()),
                     pa.array(error)], ["vec_id", "label", "code", "error"])

    return chunks.mapInArrow(run, f"vec_id {ids}, label {labels}, code string, error bigint")


def first_books(rows: DataFrame, entries: int, scale: int, parts: int, width: int) -> np.ndarray:
    """parts x entries x size: the parts of the smallest vec_ids."""
    first = (rows.where(usable(F.col("v"))).orderBy(F.col("vec_id").asc_nulls_last(), "v")
             .limit(entries).select("v").toArrow())
    v = integer_vectors(first.column("v"), scale, width)[1]
    return v.reshape(len(v), parts, width // parts).transpose(1, 0, 2).copy()


def compress(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error of every usable vector; the final codebooks)."""
    rows = with_vector(embeddings, "vec_id", "label")
    width = max(1, -(-width_of(rows) // parts)) * parts
    chunks = written(chunk_table(rows, scale, parts, width), "chunks")
    books = first_books(rows, entries, scale, parts, width)
    for _ in range(rounds if books.size else 0):
        books = moved(chunks, books)
    return encoded(chunks, books), books


def vector_codes(embeddings: DataFrame) -> DataFrame:
    """Contract of op13: vec_id, code, error, error summed over equal labels (nulls
    together), hash of the final codebooks."""
    found, books = compress(embeddings)
    found = written(found, "codes")
    labels = written(found.groupBy("label").agg(
        F.sum(F.col("error").cast("decimal(38,0)")).cast("bigint").alias("label_error"))
        .withColumnRenamed("label", "same"), "labels")
    digest = hashlib.sha256(digest_text(books).encode()).hexdigest()
    return (found.join(small(labels), F.col("label").eqNullSafe(F.col("same")), "left")
            .select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")))


def _oracle() -> str:
    """Brute force in DuckDB SQL: every part against every entry, each round."""
    steps = [f"""kept as (select vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::double)) as v,
      row_number() over (order by vec_id nulls last, embedding) as rid
      from embeddings where embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
             f"""parts as (select rid, p, v[p * len(v) // {PARTS} + 1 : (p + 1) * len(v) // {PARTS}] as x
      from kept, range({PARTS}) r(p))""",
             f"b0 as (select p, rid - 1 as e, x from parts where rid <= {ENTRIES})"]
    for i in range(ROUNDS + 1):
        steps.append(f"""a{i} as (select rid, a.p, any_value(a.x) as x,
          min((list_inner_product(a.x, a.x) + list_inner_product(b.x, b.x)
               - 2 * list_inner_product(a.x, b.x))::bigint * {ENTRIES} + b.e) as best
          from parts a join b{i} b on a.p = b.p group by rid, a.p)""")
        if i < ROUNDS:
            steps.append(f"""m{i} as (select p, best % {ENTRIES} as e, i, floor(sum(x[i]::hugeint) / count(*)) as y
              from a{i}, unnest(range(1, len(x) + 1)) r(i) group by 1, 2, 3)""")
            steps.append(f"""b{i + 1} as (select b.p, b.e, coalesce(l.x, b.x) as x from b{i} b
              left join (select p, e, list(y order by i) as x from m{i} group by p, e) l on b.p = l.p and b.e = l.e)""")
    steps.append(f"""books as (select sha256(string_agg(array_to_string(list_transform(x, lambda y: y::bigint), ','), ','
      order by p, e)) as codebooks_sha256 from b{ROUNDS})""")
    steps.append(f"""found as (select rid, string_agg(printf('%02x', (best % {ENTRIES})::integer), '' order by p) as code,
      sum(best // {ENTRIES})::bigint as error from a{ROUNDS} group by rid)""")
    return "with " + ",\n".join(s.replace(" as (", " as materialized (", 1) for s in steps) + """
    select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, codebooks_sha256
    from found join kept using (rid), books"""


ORACLE = _oracle()
