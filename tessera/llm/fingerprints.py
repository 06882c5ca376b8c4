"""Document fingerprints by a randomised edit embedding (operator 4).

*Embedding.* All texts share one random walk: at step j the embedding takes the
character under the cursor, and a random bit of (j, character) says whether the
cursor moves on. After an edit two walks drift apart and meet again, so a small
edit distance becomes a small Hamming distance between the embeddings. The walk
covers the whole text and ends when the cursor leaves it (about two steps a
character).

*Bit sampling.* A fingerprint has ``SLOTS`` bytes. Slot s holds a hashed byte of
the embedding at one step, the step of slot s with the least random rank among
those before the walk's end. Such a step is a uniform sample of the whole walk, and
two walks of like length sample the same steps. Slots get their first step in one
order, so the number of filled slots tells which they are; those that a short walk
never fills are 0 and count for nothing. ``likeness`` is the share of equal filled
slots among those filled in either text (1 for two empty texts).

*Banding and verification.* Each band is a hash of the first ``BAND_SLOTS`` filled
slots in a random order of its own; texts of less than ``SHORT`` filled slots have
bands of ``SHORT_SLOTS`` besides, or instead when there are few. A document is compared, by its whole fingerprint, with the documents
before it in each of its bands; ``near_id`` is the smallest id of likeness 0.8 or
more among them. It is tried against the first document of the band, and only
where that is unlike it against the others, in ascending order up to the first
that is alike. A large band is cut into blocks whose pairs are tasks of their own.

*Neighbours.* The contract's edited text needs the next document by doc_id. Ids
are dealt by quantiles into ranges that are sorted apart; the first document of
each range is also given to the range before it (that of the first range to the
last), so neighbours meet without a global sort in one task.

A null text is empty; empty texts have one common fingerprint. Rows with equal
doc_id follow each other by a hash of their text; rows without one come first. A
table of one row is its own neighbour.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cluster_parallelism, written
from tessera.llm.words import mix

SLOTS = 128
BANDS = 8
BAND_SLOTS = 6
#: Filled slots below which a text has bands of SHORT_SLOTS; below 3/4 of it, only those.
SHORT = 32
SHORT_SLOTS = 2
NEAR = 0.8
#: Fingerprints of a band compared in one task (with as many others).
BLOCK = 2048
#: Characters embedded at once.
_CHUNK = 8 << 20
#: Steps whose random numbers are kept ready.
_STEPS = 1 << 16
_UNSET_ID = -(1 << 63)


def slot_of(steps: np.ndarray) -> np.ndarray:
    return mix(steps.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)) % np.uint64(SLOTS)


#: First step of each slot, the slots by it, and each slot's place among them.
_FIRST = np.unique(slot_of(np.arange(1 << 14)), return_index=True)[1]
_FILL_ORDER = np.argsort(_FIRST)
_PLACE = np.argsort(_FILL_ORDER)


def _records(steps: np.ndarray, best: np.ndarray) -> np.ndarray:
    """Of consecutive steps those of least rank so far in their slot; ``best``
    (least rank of each slot) is brought up to date."""
    h = mix(steps.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
    slot = (h % np.uint64(SLOTS)).astype(np.int64)
    rank = mix(h)
    order = np.argsort(slot, kind="stable")
    found = np.zeros(len(steps), bool)
    cuts = np.searchsorted(slot[order], np.arange(SLOTS + 1))
    for s in range(SLOTS):
        own = order[cuts[s]:cuts[s + 1]]
        if len(own):
            running = np.minimum.accumulate(np.append(best[s], rank[own]))
            found[own] = running[1:] < running[:-1]
            best[s] = running[-1]
    return found


class Walk:
    """Random bits and sampled steps of the shared walk, made as far as needed."""

    def __init__(self):
        self.best = np.full(SLOTS, np.iinfo(np.uint64).max)
        self.factors: list[np.ndarray] = []
        self.taken: list[np.ndarray] = []

    def block(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.factors) <= i:
            steps = np.arange(len(self.factors) * _STEPS, (len(self.factors) + 1) * _STEPS)
            self.factors.append(((mix(steps.astype(np.uint64) ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32))
                                 | np.uint64(1)).astype(np.uint32))
            self.taken.append(_records(steps, self.best))
        return self.factors[i], self.taken[i]

    def fingerprints(self, texts: list[np.ndarray]) -> np.ndarray:
        """A row of SLOTS bytes for each text (its code points as uint32)."""
        return self.sampled(texts)[0]

    def sampled(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The fingerprints, and the number of filled slots of each."""
        out, filled = np.zeros((len(texts), SLOTS), np.uint8), np.zeros(len(texts), np.int32)
        order = np.argsort([-len(t) for t in texts], kind="stable")
        a = 0
        while a < len(order):  # texts of like length walk together
            b, size = a, 0
            while b < len(order) and (b == a or size + len(texts[order[b]]) < _CHUNK):
                size += len(texts[order[b]]) + 1
                b += 1
            self._walk([texts[i] for i in order[a:b]], out, filled, order[a:b])
            a = b
        return out, filled

    def _walk(self, texts: list[np.ndarray], out: np.ndarray, filled: np.ndarray, rows: np.ndarray) -> None:
        end = np.zeros(1, np.uint32)  # the cursor stays on it: 0 times any factor is 0
        flat = np.concatenate([x for t in texts for x in (t + np.uint32(1), end)])
        at = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        live = np.flatnonzero(flat[at])
        at, rows, i = at[live], rows[live], 0
        while len(at):
            factors, taken = self.block(i)
            for first in range(0, _STEPS, 256):
                for j in range(first, first + 256):
                    c = flat[at]
                    if taken[j]:
                        self._take(out, filled, rows, c, i * _STEPS + j)
                    at += (c * factors[j]) >> np.uint32(31)
                live = flat[at] > 0
                if not live.all():
                    at, rows = at[live], rows[live]
                    if not len(at):
                        return
            i += 1

    @staticmethod
    def _take(out: np.ndarray, filled: np.ndarray, rows: np.ndarray, c: np.ndarray, step: int) -> None:
        slot = int(mix(np.array([step + 0x632BE59BD9B4E019], np.uint64))[0] % np.uint64(SLOTS))
        on = c > 0  # a finished walk keeps what it has
        byte = mix(c[on].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(step)) >> np.uint64(56)
        out[rows[on], slot] = byte.astype(np.uint8)
        if step == _FIRST[slot]:
            filled[rows[on]] += 1


_walk: list[Walk] = []


def shared_walk() -> Walk:
    if not _walk:
        _walk.append(Walk())
    return _walk[0]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the next document."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def dealt(documents: DataFrame, ranges: int) -> DataFrame:
    """(range, copy, doc_id, tie, packed): sorted by the first four, each row of a
    range is followed by its next document; copies close a range. The texts
    travel compressed."""
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    shares = [i / ranges for i in range(1, ranges)]
    bounds = rows.agg(F.percentile_approx("doc_id", shares or [0.5], max(10_000, 20 * ranges))).first()[0] or []
    cuts = np.unique(np.array(bounds, np.int64))
    first = rows.select(F.coalesce("doc_id", F.lit(_UNSET_ID)).alias("id"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, int] = {}
        for batch in batches:
            ids = batch.column(0).to_numpy()
            of = np.searchsorted(cuts, ids, side="left")
            for r in np.unique(of):
                least[int(r)] = min(least.get(int(r), (1 << 63) - 1), int(ids[of == r].min()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(least), pa.int64()), pa.array(list(least.values()), pa.int64())], ["range", "id"])

    # One row a range: bounded by `ranges`.
    heads = first.mapInArrow(number, "range bigint, id bigint").groupBy("range").agg(F.min("id").alias("id")).collect()
    used = sorted((r["range"], r["id"]) for r in heads)
    before = {used[i][1]: used[i - 1][0] for i in range(len(used))}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(_UNSET_ID).to_numpy()
            of = np.searchsorted(cuts, ids, side="left")
            again = np.array([i for i, d in enumerate(ids.tolist()) if d in before], np.int64)
            take = pa.array(np.concatenate([np.arange(len(ids)), again]))
            texts = batch.column(1)
            squeeze = zstandard.ZstdCompressor(level=1).compress
            packed = pa.array([squeeze(texts[i].as_py().encode()) for i in range(len(texts))], pa.binary())
            rest = pa.RecordBatch.from_arrays([batch.column(0), packed, batch.column(2)], ["doc_id", "packed", "tie"]).take(take)
            to = np.concatenate([of, np.array([before[int(ids[i])] for i in again], np.int64)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(to.astype(np.int64)), pa.array(np.arange(len(to)) >= len(ids)), *rest.columns],
                ["range", "copy", "doc_id", "packed", "tie"])

    return (rows.withColumn("tie", F.xxhash64("text"))
            .mapInArrow(deal, "range bigint, copy boolean, doc_id bigint, packed binary, tie bigint")
            .repartitionByRange("range").sortWithinPartitions("range", "copy", F.col("doc_id").asc_nulls_first(), "tie"))


def fingerprint_rows(documents: DataFrame, ranges: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (binary),
    near_edited, near_next, filled (slots of fingerprint) for every row."""
    rows = dealt(documents, ranges or cluster_parallelism(documents.sparkSession))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = shared_walk()
        unpack = zstandard.ZstdDecompressor().decompress
        held: list[tuple] = []  # the last row, until its next document is there

        def done(part: list[tuple]) -> pa.RecordBatch:
            """Rows of ``part`` but the last, which only follows."""
            own = [(i, part[i + 1][3]) for i in range(len(part) - 1) if not part[i][1]]
            changed = [edited(part[i][3], following) for i, following in own]
            prints, filled = walk.sampled([code_points(p[3]) for p in part])
            others, others_filled = walk.sampled([code_points(t) for t in changed])
            at = np.array([i for i, _ in own], np.int64)
            return pa.RecordBatch.from_arrays([
                pa.array([part[i][2] for i in at], pa.int64()),
                pa.array([len(part[i][3]) for i in at], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).digest() for t in changed], pa.binary()),
                pa.array([prints[i].tobytes() for i in at], pa.binary()),
                pa.array([x.tobytes() for x in others], pa.binary()),
                pa.array(row_likeness(prints[at], filled[at], others, others_filled), pa.float64()),
                pa.array(row_likeness(prints[at], filled[at], prints[at + 1], filled[at + 1]), pa.float64()),
                pa.array(filled[at], pa.int32())],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
                 "filled"])

        for batch in batches:
            texts = [unpack(x.as_buffer()).decode() for x in batch.column(3)]
            part = held + list(zip(*[batch.column(i).to_pylist() for i in range(3)], texts, strict=True))
            held = part[-1:]
            if len(part) > 1:
                yield done(part)
        # The last row of a partition closes a range: it is a copy.

    return rows.select("range", "copy", "doc_id", "packed").mapInArrow(
        run, "doc_id bigint, n_chars bigint, edited_sha256 binary, fingerprint binary, "
             "edited_fingerprint binary, near_edited double, near_next double, filled int")


def text_form(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def row_likeness(x: np.ndarray, m: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Likeness of each row of ``x`` (m slots filled) to that of ``y`` (n filled)."""
    both, most = _PLACE < np.minimum(m, n)[:, None], np.maximum(m, n)
    return np.where(most > 0, ((x == y) & both).sum(axis=1) / np.maximum(most, 1), 1.0)


def likeness(x: Column, m: Column, y: Column, n: Column) -> Column:
    """The same of two fingerprint columns."""
    order = F.array(*[F.lit(int(s) + 1) for s in _FILL_ORDER])
    same = F.filter(F.slice(order, F.lit(1), F.least(m, n)),
                    lambda i: F.substring(x, i, F.lit(1)) == F.substring(y, i, F.lit(1)))
    return F.when(F.greatest(m, n) > 0, F.size(same) / F.greatest(m, n)).otherwise(F.lit(1.0))


def band_keys(prints: np.ndarray, filled: np.ndarray, bands: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every band of each fingerprint."""
    order = np.argsort(mix(np.arange(bands * SLOTS, dtype=np.uint64)).reshape(bands, SLOTS), axis=1)
    value = mix((np.arange(1, SLOTS + 1, dtype=np.uint64) << np.uint64(8)) | prints)
    has = _PLACE < filled[:, None]
    rows, keys = [], []
    for size, who in ((slots, filled >= SHORT * 3 // 4), (min(slots, SHORT_SLOTS), filled < SHORT)):
        own = np.flatnonzero(who)
        for band in range(bands):
            picks = has[own][:, order[band]]
            picks &= np.cumsum(picks, axis=1) <= size
            total = np.where(picks, value[own][:, order[band]], np.uint64(0)).sum(axis=1)
            rows.append(own)
            keys.append(mix(total + np.uint64(size * bands + band)).view(np.int64))
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(one: DataFrame, bands: int, slots: int) -> DataFrame:
    """(doc, key) for rows (first, fingerprint, filled)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(a, 2048) for a in range(0, batch.num_rows, 2048)):
                rows, keys = band_keys(_rows(part.column(1)), part.column(2).to_numpy(), bands, slots)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows)), pa.array(keys)], ["doc", "key"])

    return one.select("first", "fingerprint", "filled").mapInArrow(run, "doc bigint, key bigint")


def _rows(prints: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(prints.to_pylist()), np.uint8).reshape(-1, SLOTS)


def _equal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Number of equal slots of each row of ``x`` with each row of ``y``."""
    if len(x) * len(y) <= 256:
        return (x[:, None] == y[None]).sum(axis=2)
    x, y = np.ascontiguousarray(x.T), np.ascontiguousarray(y.T)
    out = np.zeros((x.shape[1], y.shape[1]), np.uint8)
    for s in range(SLOTS):
        out += x[s][:, None] == y[s]
    return out


def first_alike(asked: np.ndarray, asked_filled: np.ndarray, limits: np.ndarray,
                ids: np.ndarray, prints: np.ndarray, filled: np.ndarray, near: float) -> np.ndarray:
    """For each fingerprint of ``asked`` the smallest of ``ids`` (ascending, with
    their ``prints``) below its limit and of likeness ``near``; else its limit."""
    # Unfilled slots equal none.
    asked = np.where(_PLACE < asked_filled[:, None], asked.astype(np.uint16), np.uint16(256))
    prints = np.where(_PLACE < filled[:, None], prints.astype(np.uint16), np.uint16(257))
    found, left, a, size = limits.copy(), np.arange(len(asked)), 0, 8
    while a < len(ids):
        left = left[found[left] > ids[a]]  # the smallest comes first: one hit is enough
        if not len(left):
            break
        part = ids[a:a + size]
        most = np.maximum(np.maximum(asked_filled[left][:, None], filled[a:a + size]), 1)
        hit = (_equal(asked[left], prints[a:a + size]) / most >= near) & (part < found[left][:, None])
        at = hit.argmax(axis=1)
        got = hit[np.arange(len(left)), at]
        found[left[got]] = part[at[got]]
        a, size = a + size, min(2 * size, 256)
    return found


def _compared(rows: DataFrame, near: float) -> DataFrame:
    """(doc, near_id) from rows (key, i, j, asks, doc, upto, filled, fingerprint): within
    each (key, i, j) the rows that ask against those that do not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # the last group, until another one follows
        for batch in chain(batches, [None]):
            if batch is not None:
                part = [np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1),
                        batch.column(3).to_numpy(zero_copy_only=False), *[batch.column(i).to_numpy() for i in (4, 5, 6)],
                        _rows(batch.column(7))]
                held = [np.concatenate(x) for x in zip(held, part, strict=True)] if held else part
            if not held:
                continue
            cuts = np.flatnonzero((held[0][1:] != held[0][:-1]).any(axis=1)) + 1
            cuts = np.concatenate([[0], cuts, [len(held[0])] if batch is None else []]).astype(np.int64)
            docs, near_ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                _, asks, doc, upto, filled, prints = [x[a:b] for x in held]
                m = int(np.searchsorted(asks, True))  # those that ask come last
                found = first_alike(prints[m:], filled[m:], upto[m:], doc[:m], prints[:m], filled[:m], near)
                docs.append(doc[m:][found < upto[m:]])
                near_ids.append(found[found < upto[m:]])
            held = [x[cuts[-1]:] for x in held]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(docs)), pa.array(np.concatenate(near_ids))],
                                             ["doc", "near_id"])

    return (rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "asks", "doc")
            .select("key", "i", "j", "asks", "doc", "upto", "filled", "fingerprint")
            .mapInArrow(run, "doc bigint, near_id bigint"))


def near_documents(prints: DataFrame, bands: int = BANDS, slots: int = BAND_SLOTS, near: float = NEAR,
                   block: int = BLOCK) -> DataFrame:
    """(doc_id, near_id): for documents with an earlier one of like fingerprint in
    one of their bands, the smallest such id."""
    known = (prints.where("doc_id is not null")
             .select("doc_id", "fingerprint", "filled", F.xxhash64("fingerprint", "filled").alias("print")))
    one = written(known.groupBy("print").agg(F.min("doc_id").alias("first"), F.any_value("fingerprint").alias("fingerprint"),
                                             F.any_value("filled").alias("filled")), "prints")
    keyed = _keyed(one, bands, slots)
    heads = keyed.groupBy("key").agg(F.min("doc").alias("head"), F.count("*").alias("n")).where("n > 1")
    rest = written(keyed.join(heads, "key").where("head < doc"), "bands")
    # First against each band's first document, which ends it for most.
    mine = one.select(F.col("first").alias("doc"), F.col("fingerprint").alias("x"), F.col("filled").alias("m"))
    other = one.select(F.col("first").alias("head"), F.col("fingerprint").alias("y"), F.col("filled").alias("k"))
    tried = written(rest.select("doc", "head").distinct().join(mine, "doc").join(other, "head")
                    .select("doc", "head", (likeness(*map(F.col, "xmyk")) >= near).alias("alike")), "heads")
    linked = tried.where("alike").groupBy("doc").agg(F.min("head").alias("near_id"))
    # Those unlike it against the others of the band, as far as these may give a smaller id.
    asking = written(rest.join(tried.where("not alike").select("doc", "head"), ["doc", "head"]).join(linked, "doc", "left")
                     .withColumn("upto", F.coalesce("near_id", "doc")).where("n > 2 and head < upto")
                     .select("key", "doc", "upto", "n"), "asking")
    blocks = asking.groupBy("key").agg(F.ceil(F.count("*") / block).alias("ni"), F.ceil(F.max("n") / block).alias("nj"),
                                       F.max("upto").alias("most"))
    sides = (asking.join(blocks, "key").select("key", "ni", "nj", F.lit(True).alias("asks"), "doc", "upto")
             .union(rest.join(blocks, "key").where("doc < most")
                    .select("key", "ni", "nj", F.lit(False).alias("asks"), "doc", F.col("doc").alias("upto"))))
    at, every = lambda n: F.pmod(F.xxhash64("doc"), F.col(n)), lambda n: F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)
    rows = (sides.join(one.select(F.col("first").alias("doc"), "filled", "fingerprint"), "doc")
            .withColumn("i", F.explode(F.when(F.col("asks"), F.array(at("ni"))).otherwise(every("ni"))))
            .withColumn("j", F.explode(F.when(F.col("asks"), every("nj")).otherwise(F.array(at("nj"))))))
    found = (linked.union(_compared(rows, near)).groupBy(F.col("doc").alias("first")).agg(F.min("near_id").alias("near_id")))
    return (known.select("doc_id", "print").join(one.select("print", "first"), "print").join(found, "first", "left")
            .select("doc_id", F.coalesce("near_id", "first").alias("near_id")).where("near_id < doc_id")
            .groupBy("doc_id").agg(F.min("near_id").alias("near_id")))


def document_fingerprints(documents: DataFrame) -> DataFrame:
    """Contract of op4, with near_id."""
    prints = written(fingerprint_rows(documents), "fingerprints")
    return prints.join(near_documents(prints), "doc_id", "left").select(
        "doc_id", "n_chars", text_form(F.col("edited_sha256")).alias("edited_sha256"),
        text_form(F.col("fingerprint")).alias("fingerprint"),
        text_form(F.col("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next", "near_id")
