"""N-gram Jaccard join by signature trees (operator 5).

A document's set holds the distinct 5-word shingles of its whole text. Documents
link when ``100 * intersection >= 80 * union``; a component's id is its smallest
doc_id. Copies (equal sets) are one class from the start and join once.

1. *Forest.* Any two linked sets share tokens among the first
   ``n - ceil(0.8 n) + 1`` of each (their prefixes), in one order of all tokens
   (tokens of many documents last). So each token is the root of a tree over the
   classes that hold it in their prefix and have a size near to each other, and
   no other trees are needed. Tokens with the same classes are one tree, with a
   weight. How common a token is comes from a lossy count over all texts; the
   order decides only how large the trees get, never what is found.
2. *Near copies.* Every class is compared with one class it shares most trees
   with. Those that link get one label, so a tree over thousands of near copies
   has one label and needs no further work.
3. *Signature trees.* Members of a tree with two labels or more are split by size
   band and, in large trees, into blocks whose pairs are separate tasks. The
   members of a task are the leaves of a signature tree: a node holds the OR of
   its members' bitmaps and their range of sizes. Two nodes are descended into
   only if their sizes, their labels and the largest overlap that their bitmaps
   allow leave room for a link.
4. *Rounds.* The bitmaps are of whole sets: what two of them have in common, and the
   tokens that share a bit, bound the overlap from above, and sets of sizes x, y that
   link share at least ``ceil(0.8 (x + y) / 1.8)``. First they have few bits a token.
   A task gives each member's best partner only, so a round's pairs grow with the
   members and not with their square, and all members of a group find its centre.
   These pairs are verified, links join labels, and the next round looks only at
   classes that still have a partner under another label.
5. *Rest.* What is left gets bitmaps of more bits a token, which rule out nearly all
   sets that do not link; every pair of two labels that remains is verified.
   Nothing is decided without an exact count of the common shingles of two sets.

Null or wordless texts have an empty set and link with nothing. Repeated rows
are copies. A row without a doc_id makes no links of its own; it gets the
component of the rows with the same set, or null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import dropped, small, text_slices, written
from tessera.llm.graph import components, joined
from tessera.llm.words import mix, shingle_sets

SHINGLE_WORDS = 5
THRESHOLD = 80  # of 100
#: Lossy count: tokens of one counting block, and the count that is reported.
COUNT_BLOCK = 1 << 20
COUNT_REPORTED = 4
MIN_HEAVY = 32
#: Bits of the rounds' bitmaps and of the last ones, for each token of a set.
COARSE_BITS = 2
FINE_BITS = 8
#: Rounds of best partners at most; what they leave is verified pair by pair.
ROUNDS = 2
#: A larger tree is cut into blocks of about so many members, or tokens in all.
BLOCK_MEMBERS = 2048
BLOCK_TOKENS = 1 << 25
FANOUT = 8
_U = np.uint64


def prefix_length(n: int, threshold: int = THRESHOLD) -> int:
    """Tokens of which one must be shared: n - ceil(threshold * n / 100) + 1."""
    return n - (threshold * n + 99) // 100 + 1


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _set_key(tokens: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums over a set: equal for equal sets."""
    if not len(tokens):
        return 0, 0
    a, b = mix(tokens).sum(dtype=np.uint64), mix(tokens ^ _U(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def _sets(batch: pa.RecordBatch, k: int):
    for a, _, data, offsets in text_slices(batch):
        for i, tokens in enumerate(shingle_sets(data, offsets, k)):
            yield a + i, tokens


def heavy_tokens(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the tokens that many documents hold.

    Each task counts its documents' tokens in blocks of ``COUNT_BLOCK`` and
    reports those it saw ``COUNT_REPORTED`` times or more, so a token is
    undercounted by less than that for each block. Tokens whose reported sum
    reaches the number of blocks are heavy: at most ``COUNT_BLOCK`` of them
    exist, whatever the corpus size, which bounds what is collected and broadcast.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush():
            tokens, n = np.unique(np.concatenate(held), return_counts=True) if held else (
                np.zeros(0, np.uint64), np.zeros(0, np.int64))
            often = n >= COUNT_REPORTED
            return pa.RecordBatch.from_arrays(
                [pa.array(np.append(_signed(tokens[often]), 0)),
                 pa.array(np.append(n[often], 1).astype(np.int64)),
                 pa.array(np.append(np.zeros(int(often.sum()), bool), True))], ["token", "n", "block"])

        for batch in batches:
            seen = set()
            for _, tokens in _sets(batch, k):
                if len(tokens) and (key := _set_key(tokens)) not in seen:
                    seen.add(key)
                    held.append(tokens)
                    size += len(tokens)
                    if size >= COUNT_BLOCK:
                        yield flush()
                        held, size = [], 0
        yield flush()

    counts = (docs.select("text").mapInArrow(count, "token bigint, n bigint, block boolean")
              .groupBy("block", "token").agg(F.sum("n").alias("n")).where((F.col("n") >= MIN_HEAVY) | F.col("block")))
    counts = written(counts, "heavy")
    blocks = counts.where("block").agg(F.sum("n")).first()[0] or 0
    rows = counts.where(~F.col("block") & (F.col("n") >= max(MIN_HEAVY, blocks))).select("token", "n").toPandas()
    dropped(counts)
    tokens = rows["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], rows["n"].to_numpy(np.int64)[order]


def postings(docs: DataFrame, heavy: tuple[np.ndarray, np.ndarray], k: int, threshold: int) -> DataFrame:
    """doc_id, n, class_id, class_check, prefix, maps of every document: the prefix of its
    set, and the set's coarse bitmaps for its own size band and the next. Both are left
    out (null) for a set that the task has already given."""
    shared = docs.sparkSession.sparkContext.broadcast(heavy)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens_of, counts_of = shared.value
        seen = set()
        for batch in batches:
            n, first, second, prefix, maps = [], [], [], [], []
            for row, tokens in _sets(batch, k):
                key = _set_key(tokens)
                n.append(len(tokens))
                first.append(key[0])
                second.append(key[1])
                if not len(tokens) or key in seen or not batch.column(0)[row].is_valid:
                    prefix.append(None)
                    maps.append(None)
                    continue
                seen.add(key)
                rank = np.zeros(len(tokens), np.int64)
                if len(tokens_of):
                    at = np.minimum(np.searchsorted(tokens_of, tokens), len(tokens_of) - 1)
                    rank = np.where(tokens_of[at] == tokens, counts_of[at], 0)
                own = np.lexsort((tokens, rank))[:prefix_length(len(tokens), threshold)]
                prefix.append(_signed(tokens[own]))
                band = size_band(len(tokens))
                maps.append([bitmap(tokens, bitmap_words(at, COARSE_BITS)).tobytes() for at in (band, band + 1)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(first, pa.int64()),
                 pa.array(second, pa.int64()), pa.array(prefix, pa.list_(pa.int64())),
                 pa.array(maps, pa.list_(pa.binary()))],
                ["doc_id", "n", "class_id", "class_check", "prefix", "maps"])

    return docs.mapInArrow(run, f"doc_id {kind}, n bigint, class_id bigint, class_check bigint, "
                                "prefix array<bigint>, maps array<binary>")


def trees(posted: DataFrame, threshold: int) -> DataFrame:
    """(tree, class_id, n, first, n_first, prev, n_prev, weight): the trees with
    two classes or more. ``first`` is the tree's smallest class and ``prev`` the
    one before; the weight is the number of tokens with the same classes."""
    rows = (posted.where(F.col("prefix").isNotNull())
            .select(F.explode("prefix").alias("token"), "class_id", "n")
            .repartition("token").sortWithinPartitions("token", "n", "class_id"))
    names = ["tree", "class_id", "n", "first", "n_first", "prev", "n_prev", "weight"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}  # tree -> [weight, classes, sizes]
        size = 0
        rest = [np.zeros(0, np.int64)] * 3

        def flush():
            parts = []
            for key, (weight, cls, n) in held.items():
                m = len(cls)
                prev = np.append(0, np.arange(m - 1))
                parts.append((np.full(m, key), cls, n, np.full(m, cls[0]), np.full(m, n[0]), cls[prev], n[prev],
                              np.full(m, weight)))
            cols = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 8
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names)

        def grow(token, cls, n):
            """Whole runs of a token -> trees, cut where sizes are too far apart."""
            new = np.ones(len(token), bool)  # copies from several tasks
            new[1:] = (token[1:] != token[:-1]) | (cls[1:] != cls[:-1])
            token, cls, n = token[new], cls[new], n[new]
            cut = np.ones(len(token), bool)
            cut[1:] = (token[1:] != token[:-1]) | (100 * n[:-1] < threshold * n[1:])
            starts = np.flatnonzero(cut)
            sizes = np.diff(np.append(starts, len(token)))
            sums = np.add.reduceat(mix(cls.view(np.uint64)), starts) if len(starts) else np.zeros(0, np.uint64)
            for at, m, key in zip(starts[sizes > 1], sizes[sizes > 1], sums[sizes > 1].view(np.int64), strict=True):
                own = held.setdefault(int(key), [0, cls[at:at + m], n[at:at + m]])
                own[0] += 1
                yield int(m) if own[0] == 1 else 0

        for batch in batches:
            cols = [np.concatenate([r, batch.column(i).to_numpy(zero_copy_only=False)])
                    for i, r in enumerate(rest)]
            last = int(np.searchsorted(cols[0], cols[0][-1])) if len(cols[0]) else 0
            rest = [c[last:] for c in cols]
            size += sum(grow(*(c[:last] for c in cols))) if last else 0
            if size > 1 << 20:
                yield flush()
                size = 0
        sum(grow(*rest))
        yield flush()

    grown = rows.mapInArrow(run, ", ".join(f"{c} bigint" for c in names))
    return grown.groupBy("tree", "class_id").agg(
        *[F.max(c).alias(c) for c in names[2:-1]], F.sum("weight").alias("weight"))


def near_pairs(grown: DataFrame, threshold: int) -> DataFrame:
    """(a, b): for each class the one, of its trees' first and previous classes,
    with which it was seen to share most tokens, if those are a twentieth of its
    set (near copies share far more of their prefixes, unrelated sets less)."""
    seen = F.array_distinct(F.array(F.struct(F.col("first").alias("b"), F.col("n_first").alias("m")),
                                    F.struct(F.col("prev").alias("b"), F.col("n_prev").alias("m"))))
    votes = (grown.select("class_id", "n", "weight", F.explode(seen).alias("o")).where("class_id <> o.b")
             .groupBy("class_id", "n", F.col("o.b").alias("b"), F.col("o.m").alias("m")).agg(F.sum("weight").alias("votes")))
    sized = 100 * F.least("n", "m") >= threshold * F.greatest("n", "m")
    return (votes.where(sized & (20 * F.col("votes") >= F.col("n")))
            .groupBy(F.col("class_id").alias("a")).agg(F.max(F.struct("votes", "b")).alias("to"))
            .select("a", F.col("to.b").alias("b")))


def class_sets(docs: DataFrame, needed: DataFrame, k: int) -> DataFrame:
    """(class_id, n, tokens binary) of the classes in ``needed`` (doc_id, class_id):
    the text of one document of each is hashed again. Repeated rows give at most one a task."""
    rows = docs.join(small(needed), "doc_id").select("text", "class_id", "class_check")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = set()
        for batch in batches:
            own, check = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            ids, n, blobs = [], [], []
            for i, tokens in _sets(batch, k):
                if own[i] not in given and _set_key(tokens) == (own[i], check[i]):  # not another row with the same doc_id
                    given.add(own[i])
                    ids.append(own[i])
                    n.append(len(tokens))
                    blobs.append(tokens.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(blobs, pa.binary())],
                ["class_id", "n", "tokens"])

    return rows.mapInArrow(run, "class_id bigint, n bigint, tokens binary")


def verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets meet the threshold, counted exactly."""
    left = sets.select(F.col("class_id").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("class_id").alias("b"), F.col("tokens").alias("y"))
    rows = left.join(small(pairs), "a").join(right, "b").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column(2)[i].as_buffer(), np.uint64)
                y = np.frombuffer(batch.column(3)[i].as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= threshold * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(run, "a bigint, b bigint").distinct()


def sets_of(docs: DataFrame, classes: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Written (class_id, n, tokens) of the classes in ``asked`` (class_id)."""
    needed = written(classes.join(asked, "class_id").select(
        F.col("pick.doc_id").alias("doc_id"), "class_id", F.col("pick.class_check").alias("class_check")), "needed")
    sets = written(class_sets(docs, needed, k), "sets")
    dropped(needed)
    return sets


def linked(docs: DataFrame, classes: DataFrame, pairs: DataFrame, k: int, threshold: int) -> DataFrame:
    """Written: those of the written pairs (a, b) of classes that meet the threshold."""
    sets = sets_of(docs, classes, pairs.select(F.explode(F.array("a", "b")).alias("class_id")).distinct(), k)
    links = written(verified(pairs, sets, threshold), "links")
    dropped(sets)
    return links


def bitmap(tokens: np.ndarray, words: int) -> np.ndarray:
    """Token bitmap of ``words`` 64-bit words."""
    out = np.zeros(words, np.uint64)
    at = mix(tokens ^ _U(0x2545F4914F6CDD1D)) % _U(64 * words)
    np.bitwise_or.at(out, (at >> _U(6)).astype(np.int64), _U(1) << (at & _U(63)))
    return out


def size_band(n: int) -> int:
    """Sets of sizes that may link are in one band or in neighbours."""
    return int(np.floor(np.log(n) / np.log(1.25) + 1e-9))


def bitmap_words(band: int, bits: int) -> int:
    """Width of the bitmaps of one size band, for so many bits a token."""
    return max(1, (int(1.25 ** (band + 1)) + 1) * bits // 64)


class SignatureTree:
    """Leaves are members; each node above ORs the bitmaps of ``FANOUT`` nodes
    and holds their least and greatest size, label and spare tokens.

    ``spare``: tokens that share a bit with another token of their set. For two
    sets x, y: overlap <= common bits + spare(x), and likewise with y.
    """

    def __init__(self, bits: np.ndarray, n: np.ndarray, label: np.ndarray, spare: np.ndarray):
        self.levels = [(bits, n, n, label, label, spare)]
        while len(self.levels[-1][0]) > 1:
            b, lo, hi, first, last, s = self.levels[-1]
            cuts = np.arange(0, len(b), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(b, cuts), np.minimum.reduceat(lo, cuts),
                                np.maximum.reduceat(hi, cuts), np.minimum.reduceat(first, cuts),
                                np.maximum.reduceat(last, cuts), np.maximum.reduceat(s, cuts)))

    def may_link(self, other: SignatureTree, level: int, i: np.ndarray, j: np.ndarray, threshold: int) -> np.ndarray:
        """Pairs of nodes whose bounds leave room for a link between two labels."""
        b1, lo1, hi1, first1, last1, s1 = self.levels[min(level, len(self.levels) - 1)]
        b2, lo2, hi2, first2, last2, s2 = other.levels[min(level, len(other.levels) - 1)]
        keep = (100 * hi1[i] >= threshold * lo2[j]) & (100 * hi2[j] >= threshold * lo1[i])
        keep &= ~((first1[i] == last1[i]) & (first2[j] == last2[j]) & (first1[i] == first2[j]))
        i, j = i[keep], j[keep]
        fits = np.zeros(len(i), bool)
        step = max(1, (1 << 21) // b1.shape[1])
        for a in range(0, len(i), step):
            p, q = i[a:a + step], j[a:a + step]
            common = np.bitwise_count(b1[p] & b2[q]).sum(axis=1, dtype=np.int64)
            most = common + np.minimum(s1[p], s2[q])
            overlap = -(-threshold * (lo1[p] + lo2[q]) // (100 + threshold))
            fits[a:a + step] = most >= np.maximum(overlap, 1)
        keep[np.flatnonzero(keep)[~fits]] = False
        return keep

    def join(self, other: SignatureTree, threshold: int) -> tuple[np.ndarray, np.ndarray]:
        """Dual traversal: member pairs (of self, of other) that no bound rules
        out. A tree joined with itself gives every pair once."""
        level = max(len(self.levels), len(other.levels)) - 1
        i = j = np.zeros(1, np.int64)
        while True:
            keep = self.may_link(other, level, i, j, threshold)
            i, j = i[keep], j[keep]
            if level == 0 or not len(i):
                return i, j
            level -= 1
            i, j = self._children(i, level), other._children(j, level)
            i, j = _paired(i, j)
            if self is other:
                once = i <= j if level else i < j
                i, j = i[once], j[once]

    def common(self, other: SignatureTree, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Largest overlap of the bitmaps' tokens that member pairs can have."""
        bits, _, _, _, _, spare = self.levels[0]
        bits2, _, _, _, _, spare2 = other.levels[0]
        out = np.minimum(spare[i], spare2[j])
        step = max(1, (1 << 21) // bits.shape[1])
        for a in range(0, len(i), step):
            p, q = i[a:a + step], j[a:a + step]
            out[a:a + step] += np.bitwise_count(bits[p] & bits2[q]).sum(axis=1, dtype=np.int64)
        return out

    def _children(self, nodes: np.ndarray, level: int):
        """First child and number of children of ``nodes`` one level down."""
        if level >= len(self.levels) - 1:  # this tree has no such level yet: the node stays
            return nodes, np.ones(len(nodes), np.int64)
        first = nodes * FANOUT
        return first, np.minimum(FANOUT, len(self.levels[level][0]) - first)


def _paired(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of children of paired nodes."""
    (fa, na), (fb, nb) = a, b
    n = na * nb
    owner = np.repeat(np.arange(len(n)), n)
    within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return fa[owner] + within // nb[owner], fb[owner] + within % nb[owner]


_SIGNED = "class_id bigint, at int, band int, bits binary, spare bigint"


def _signature_rows(cls: list[int], n: list[int], maps: list[bytes]) -> pa.RecordBatch:
    """Two rows a class; ``maps`` alternate between its own band's bitmap and the next's."""
    band = np.repeat([size_band(m) for m in n], 2).astype(np.int32)
    bits = np.array([np.bitwise_count(np.frombuffer(m, np.uint64)).sum(dtype=np.int64) for m in maps], np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.repeat(np.array(cls, np.int64), 2)), pa.array(band + np.arange(len(band), dtype=np.int32) % 2),
         pa.array(band), pa.array(maps, pa.binary()), pa.array(np.repeat(np.array(n, np.int64), 2) - bits)],
        ["class_id", "at", "band", "bits", "spare"])


def coarse_signatures(posted: DataFrame, grown: DataFrame) -> DataFrame:
    """(class_id, at, band, bits, spare): the coarse bitmaps of the classes in trees, of
    the width of their own size band and of the next one's."""
    rows = (posted.where(F.col("maps").isNotNull()).join(grown.select("class_id").distinct(), "class_id", "left_semi")
            .groupBy("class_id", "n").agg(F.max(F.col("maps")[0]).alias("own"), F.max(F.col("maps")[1]).alias("next")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, n, own, further = (c.to_pylist() for c in batch.columns)
            if cls:
                yield _signature_rows(cls, n, [m for pair in zip(own, further, strict=True) for m in pair])

    return rows.mapInArrow(run, _SIGNED)


def fine_signatures(sets: DataFrame) -> DataFrame:
    """(class_id, at, band, bits, spare): the fine bitmaps of sets (class_id, n, tokens)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, maps = [], []
            for i in range(batch.num_rows):
                tokens = np.frombuffer(batch.column(1)[i].as_buffer(), np.uint64)
                band = size_band(len(tokens))
                n.append(len(tokens))
                maps += [bitmap(tokens, bitmap_words(at, FINE_BITS)).tobytes() for at in (band, band + 1)]
            if n:
                yield _signature_rows(batch.column(0).to_pylist(), n, maps)

    return sets.select("class_id", "tokens").mapInArrow(run, _SIGNED)


_TASK = ["tree", "at", "i", "j"]


def tree_tasks(members: DataFrame, signed: DataFrame) -> DataFrame:
    """The rows of the tasks (tree, at, i, j), together and sorted, from trees
    (tree, class_id, n, label) with two labels or more."""
    band = F.floor(F.log("n") / F.log(F.lit(1.25)) + F.lit(1e-9)).cast("int")  # as size_band
    members = members.withColumn("band", band)
    sizes = members.groupBy("tree").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_MEMBERS, F.sum("n") / BLOCK_TOKENS)).cast("int").alias("blocks"),
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.collect_set("band").alias("bands"))
    # A link joins sizes of one band or of neighbours: task (tree, at, i, j) gets blocks
    # i <= j of band ``at`` and of the one below, if the tree has band ``at``.
    both = F.array("band", F.col("band") + 1)
    mixed = (members.join(sizes.where("lo <> hi").select("tree", "blocks", "bands"), "tree")
             .select("tree", "class_id", "n", "label", "blocks",
                     F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int").alias("block"),
                     F.explode(F.array_intersect(both, "bands")).alias("at")))
    rows = (mixed.join(signed, ["class_id", "at"])
            .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
            .select("tree", "at", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                    "block", "band", "class_id", "n", "label", "bits", "spare"))
    return rows.repartition(*_TASK).sortWithinPartitions(*_TASK, "label", "n", "class_id")


def task_pairs(part: pa.Table, threshold: int) -> Iterator[tuple]:
    """(classes a, classes b, largest overlap) of the pairs that whole tasks cannot rule
    out; rows sorted by task, label, n."""
    tree, at, i, j, block, band, cls, n, label, spare = (
        part.column(c).to_numpy().astype(np.int64) for c in (*_TASK, "block", "band", "class_id", "n", "label", "spare"))
    blobs = part.column("bits").combine_chunks()
    blobs = blobs.chunk(0) if isinstance(blobs, pa.ChunkedArray) else blobs
    offsets = np.frombuffer(blobs.buffers()[1], np.int32)[blobs.offset:blobs.offset + len(blobs) + 1]
    data = np.frombuffer(blobs.buffers()[2], np.uint8)
    new = np.ones(len(tree), bool)
    for c in (tree, at, i, j):
        new[1:] &= c[1:] == c[:-1]
    new[1:] = ~new[1:]
    starts = np.append(np.flatnonzero(new), len(tree))
    for s, e in zip(starts[:-1], starts[1:], strict=True):
        if label[s] == label[e - 1]:  # sorted: one label
            continue
        here, left = band[s:e] == at[s], block[s:e] == i[s]
        if not here.any():
            continue
        bits = data[offsets[s]:offsets[e]].view(np.uint64).reshape(e - s, -1)

        def tree_of(rows: np.ndarray) -> tuple[np.ndarray, SignatureTree] | None:
            own = np.flatnonzero(rows)
            return (own, SignatureTree(bits[own], n[s:e][own], label[s:e][own], spare[s:e][own])) if len(own) else None

        near = tree_of(here & left)
        if i[s] == j[s]:
            sides = [(near, near), (near, tree_of(~here))]
        else:
            other = tree_of(here & ~left)
            sides = [(near, other), (near, tree_of(~here & ~left)), (other, tree_of(~here & left))]
        for x, y in sides:
            if x and y:
                p, q = x[1].join(y[1], threshold)
                if len(p):
                    yield cls[s:e][x[0][p]], cls[s:e][y[0][q]], x[1].common(y[1], p, q)


def _best(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Of rows (class, partner, common) the one of greatest ``common`` for each class,
    ties to the smaller partner."""
    cls, partner, common = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((partner, -common, cls))
    order = order[np.append(True, np.diff(cls[order]) != 0)] if len(order) else order
    return cls[order], partner[order], common[order]


def _whole_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The sorted rows of a partition, cut between tasks."""
    rest: pa.Table | None = None
    for batch in batches:
        part = pa.Table.from_batches([batch])
        part = part if rest is None else pa.concat_tables([rest, part])
        if not part.num_rows:
            continue
        last = np.ones(part.num_rows, bool)
        for c in _TASK:
            col = part.column(c).to_numpy()
            last &= col == col[-1]
        cut = part.num_rows - int(np.argmin(last[::-1])) if not last.all() else 0
        rest = part.slice(cut)
        if cut:
            yield part.slice(0, cut)
    if rest is not None and rest.num_rows:
        yield rest


def best_partners(members: DataFrame, signed: DataFrame, threshold: int) -> DataFrame:
    """(class_id, partner): for every class that may link with one of another label,
    the one with which it may have the largest overlap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for part in _whole_tasks(batches):
            for a, b, common in task_pairs(part, threshold):
                held += [_best([(a, b, common)]), _best([(b, a, common)])]
                size += len(held[-2][0]) + len(held[-1][0])
                if size > 1 << 19:
                    held = [_best(held)]
                    size = len(held[0][0])
        if held:  # one row a class and task
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in _best(held)], ["class_id", "partner", "common"])

    return (tree_tasks(members, signed).mapInArrow(run, "class_id bigint, partner bigint, common bigint")
            .groupBy("class_id").agg(F.max(F.struct("common", "partner")).alias("to"))
            .select("class_id", F.col("to.partner").alias("partner")))


def possible_pairs(members: DataFrame, signed: DataFrame, threshold: int) -> DataFrame:
    """All pairs (a, b) of classes of different labels that the signature trees cannot
    rule out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _whole_tasks(batches):
            pairs = [(np.minimum(a, b), np.maximum(a, b)) for a, b, _ in task_pairs(part, threshold)]
            if pairs:
                both = np.unique(np.stack([np.concatenate(c) for c in zip(*pairs, strict=True)]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["a", "b"])

    return tree_tasks(members, signed).mapInArrow(run, "a bigint, b bigint").distinct()


def across(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ends are not in one component (vertex, root) yet."""
    one = label.select(F.col("vertex").alias("a"), F.col("root").alias("la"))
    two = label.select(F.col("vertex").alias("b"), F.col("root").alias("lb"))
    return (pairs.select("a", "b").join(one, "a", "left").join(two, "b", "left")
            .where(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b"))


def labelled(grown: DataFrame, label: DataFrame, active: DataFrame | None) -> DataFrame:
    """(tree, class_id, n, label) of the members, of the ``active`` classes only."""
    rows = grown if active is None else grown.join(active, "class_id", "left_semi")
    return rows.join(label.withColumnRenamed("vertex", "class_id"), "class_id", "left").select(
        "tree", "class_id", "n", F.coalesce("root", "class_id").alias("label"))


def class_links(docs: DataFrame, posted: DataFrame, classes: DataFrame, grown: DataFrame, k: int,
                threshold: int) -> DataFrame:
    """Written links (a, b) of classes, enough of them for the components: every pair
    that meets the threshold is in one component of them."""
    # Near copies get one label. Exactness does not rest on this, nor on the rounds.
    near = written(near_pairs(grown, threshold), "near")
    links = linked(docs, classes, near, k, threshold)
    dropped(near)
    signed = written(coarse_signatures(posted, grown), "coarse")
    tested = active = None
    for _ in range(ROUNDS):
        label = written(joined(links), "label")
        now = labelled(grown, label, active)
        best = written(best_partners(now, signed, threshold), "best")
        active = best.select("class_id")
        asked = best.select(F.least("class_id", "partner").alias("a"),
                            F.greatest("class_id", "partner").alias("b")).distinct()
        asked = written(asked if tested is None else asked.join(tested, ["a", "b"], "left_anti"), "asked")
        tested = asked if tested is None else tested.union(asked)
        dropped(label)
        if asked.isEmpty():
            break
        new = linked(docs, classes, asked, k, threshold)
        if new.isEmpty():
            break
        links = written(links.union(new), "links")
    dropped(signed)
    label = components(links)  # whole components: a group with one label is not looked at again
    now = written(labelled(grown, label, active), "labelled")
    sets = sets_of(docs, classes, active, k)
    fine = written(fine_signatures(sets), "fine")
    rest = written(across(possible_pairs(now, fine, threshold).join(tested, ["a", "b"], "left_anti"), label), "rest")
    dropped(now, fine)
    links = written(links.union(verified(rest, sets, threshold)), "links")
    dropped(sets, rest)
    return links


def jaccard_groups(documents: DataFrame, k: int = SHINGLE_WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``documents``."""
    docs = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    heavy = heavy_tokens(docs, k)
    posted = written(postings(docs, heavy, k, threshold), "postings")
    # The class's member whose text is hashed again: the first that gave a prefix.
    first = F.min(F.when(F.col("prefix").isNotNull(), F.struct("doc_id", "class_check")))
    members = posted.where("n > 0 and doc_id is not null")
    classes = members.groupBy("class_id").agg(F.min("doc_id").alias("root_doc"), first.alias("pick"))
    grown = written(trees(posted, threshold), "trees")
    links = class_links(docs, posted, classes, grown, k, threshold)
    dropped(grown)
    # Components of classes, then of documents: vertices are the classes' smallest doc ids.
    name = classes.select("class_id", "root_doc")
    links = (links.join(name.select(F.col("class_id").alias("a"), F.col("root_doc").alias("x")), "a")
             .join(name.select(F.col("class_id").alias("b"), F.col("root_doc").alias("y")), "b")
             .select(F.col("x").alias("a"), F.col("y").alias("b")))
    roots = components(links)
    ids = (classes.join(roots, F.col("root_doc") == F.col("vertex"), "left")
           .select("class_id", F.coalesce("root", "root_doc").alias("root_doc")))
    return (posted.select("doc_id", "n", F.when(F.col("n") > 0, F.col("class_id")).alias("class_id"))
            .join(ids, "class_id", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("root_doc", "doc_id").alias("component_id")))


def one_of_each(documents: DataFrame, k: int = SHINGLE_WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``documents``, all columns, with one document of each component:
    the one of smallest doc_id. Of rows with the same doc_id and text one stays. Rows
    without doc_id always stay: nothing names the document that they would repeat."""
    groups = written(jaccard_groups(documents, k, threshold).select("doc_id", "component_id"), "groups")
    # Most documents stay, so the ids that go, or that need a closer look, are joined.
    looked_at = written(groups.where("doc_id is not null").groupBy("doc_id").agg(
        F.min("component_id").alias("root"), F.count("*").alias("n")).where("root <> doc_id or n > 1"), "not-first")
    kept = documents.join(small(looked_at.select("doc_id")), "doc_id", "left_anti")
    repeated = documents.join(small(looked_at.where("root = doc_id").select("doc_id")), "doc_id", "left_semi")
    return kept.unionByName(repeated.dropDuplicates(["doc_id", "text"])).select(*documents.columns)
