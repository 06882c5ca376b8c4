"""Toxic spans by a linear-chain conditional random field (operator 1).

Tokens are runs of letters and digits; each is tagged clean or toxic by a
two-label chain: a token's emission is a sum of weights of its hashed features
(word, beginnings and end), neighbours are tied by transition
weights. Forward-backward marginals give a probability for every token. They
add up to the document's score, and tokens of probability 1/2 or more are its
offending offsets.

Labelled tokens. The labels are per document, so token labels are taken from
them by a test on the training rows: a word, or a beginning of words, counts as
toxic when it occurs in toxic documents in many different surroundings (one
surrounding counts once, so copies of a document add nothing) and next to never
in clean ones, by a likelihood-ratio test whose level allows for the number of
words tried. Tokens of toxic documents with such a feature are labelled toxic,
all others clean.

The model is fitted in one task to a bounded sample of labelled rows, at most
``sample_docs`` toxic and twice as many clean whole documents, of ``sample_chars``
characters in all for the toxic and twice that for the clean. Documents of up to
``max_train_chars`` characters are taken first; longer ones fill what they leave,
and the first document of a class is taken whatever its length. The model is
2**FEATURE_BITS numbers, whatever the corpus size, and is broadcast to score every
whole text. The calibration of its
document scores weighs the two classes as they are among all labelled training
documents, so that the score does not depend on how many of each the sample takes.

Null and empty texts have the score of a text without evidence. With no toxic
or no clean training row every score is 0. Ties and repeated rows score
alike; a document labelled twice is trained on with its greater label, and a
doc_id with several rows once, with its smallest text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import fold
from tessera.llm.words import mix

FEATURE_BITS = 18
SAMPLE_DOCS = 800
SAMPLE_CHARS = 4_000_000
MAX_TRAIN_CHARS = 20_000
#: Likelihood-ratio statistic, and share of toxic surroundings, of a toxic feature.
MIN_RATIO_STATISTIC = 25.0
MIN_TOXIC_SHARE = 0.95
STEPS = 50
LEARNING_RATE = 0.3
L2 = 1e-4
_BLOCK = 64
_KEPT_WORDS = 300_000
_MASK = (1 << FEATURE_BITS) - 1
_TOKEN = re.compile(r"[^\W_]+")


def lowered(text: str) -> str:
    """Lower case that keeps every character's place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(
        c.lower() if len(c.lower()) == 1 else c for c in text)


def tokens_of(text: str) -> list[str]:
    return _TOKEN.findall(lowered(text))


def word_features(word: str) -> list[str]:
    """Features that may carry a toxic label: the word and its beginnings."""
    return ["w" + word, *(str(n) + word[:n] for n in (4, 5, 6) if len(word) >= n)]


def features(word: str) -> list[int]:
    names = [*word_features(word), "e" + word[-3:], "b"]
    return [zlib.crc32(n.encode()) & _MASK for n in names]


class Chains:
    """Token chains of several documents, cut into blocks of ``_BLOCK`` tokens.

    Forward and backward passes walk all blocks at once, token by token. What
    enters a block comes from the products of the 2x2 step matrices of the
    blocks before it in its document, so blocks do not change the marginals.
    """

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths
        blocks = (lengths + _BLOCK - 1) // _BLOCK
        self.n_blocks = int(blocks.sum())
        self.doc = np.repeat(np.arange(len(lengths)), blocks)
        first_block = np.cumsum(blocks) - blocks
        self.rank = np.arange(self.n_blocks) - first_block[self.doc]
        starts = (np.cumsum(lengths) - lengths)[self.doc] + self.rank * _BLOCK
        self.size = np.minimum(_BLOCK, lengths[self.doc] - self.rank * _BLOCK)
        cells = np.arange(_BLOCK)
        # Cell-major, so that one step reads consecutive numbers of all blocks.
        self.inside = cells[:, None] < self.size[None, :]
        self.token = np.where(self.inside, starts[None, :] + cells[:, None], 0)
        by_rank = np.argsort(self.rank, kind="stable")
        cuts = np.searchsorted(self.rank[by_rank], np.arange(int(self.rank.max(initial=-1)) + 2))
        self.levels = [by_rank[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def marginals(self, emission: np.ndarray, step: np.ndarray, start: np.ndarray, pairs: bool = False):
        """(toxic marginal of every token, expected transitions 2x2, expected
        first labels); the last two only with ``pairs``. emission: log weight of
        toxic over clean for each token; step, start: positive weights.

        Messages are kept as the ratio of their toxic to their clean part.
        """
        n = self.n_blocks
        total = int(self.lengths.sum())
        if not total:
            return np.zeros(0), np.zeros((2, 2)), np.zeros(2)
        e = np.exp(np.clip(emission, -50, 50))[self.token]
        (s00, s01), (s10, s11) = step
        opens = self.rank == 0
        # Product of each block's step matrices: needed where another block follows.
        p00, p01, p10, p11 = np.ones(n), np.zeros(n), np.zeros(n), np.ones(n)
        if len(self.levels) > 1:
            for k in range(_BLOCK):
                keep = self.inside[k]
                n00, n01 = p00 * s00 + p01 * s10, (p00 * s01 + p01 * s11) * e[k]
                n10, n11 = p10 * s00 + p11 * s10, (p10 * s01 + p11 * s11) * e[k]
                if k == 0:  # a document's first token is weighted by `start` alone
                    n00[opens], n10[opens] = start[0], start[0]
                    n01[opens] = n11[opens] = start[1] * e[0][opens]
                if k % 4 == 3:
                    size = n00 + n01 + n10 + n11
                    n00, n01, n10, n11 = n00 / size, n01 / size, n10 / size, n11 / size
                for old, new in ((p00, n00), (p01, n01), (p10, n10), (p11, n11)):
                    np.copyto(old, new, where=keep)
        entry, leave = np.zeros(n), np.ones(n)
        for blocks in self.levels[1:]:
            q, r = blocks - 1, entry[blocks - 1]
            entry[blocks] = (p01[q] + r * p11[q]) / np.maximum(p00[q] + r * p10[q], 1e-300)
        for level in range(len(self.levels) - 1, 0, -1):
            q = self.levels[level]
            leave[q - 1] = (p10[q] + p11[q] * leave[q]) / np.maximum(p00[q] + p01[q] * leave[q], 1e-300)
        alpha = np.empty((_BLOCK, n))
        r = entry
        for k in range(_BLOCK):
            r = np.minimum(e[k] * (s01 + r * s11) / (s00 + r * s10), 1e100)
            if k == 0:
                r[opens] = start[1] / start[0] * e[0][opens]
            alpha[k] = r
        probability = np.empty((_BLOCK, n))
        both, firsts = np.zeros((2, 2)), np.zeros(2)
        b = leave
        for k in range(_BLOCK - 1, -1, -1):
            odds = alpha[k] * b
            probability[k] = odds / (1.0 + odds)
            ahead = e[k] * b
            if pairs:
                before = entry if k == 0 else alpha[k - 1]
                counted = self.inside[k] & ~opens if k == 0 else self.inside[k]
                w00, w01, w10, w11 = s00, s01 * ahead, s10 * before, s11 * before * ahead
                size = w00 + w01 + w10 + w11
                for i, j, w in ((0, 0, w00), (0, 1, w01), (1, 0, w10), (1, 1, w11)):
                    both[i, j] += (w / size)[counted].sum()
            if k == 0:
                firsts[1] = probability[0][opens & self.inside[0]].sum()
                firsts[0] = (opens & self.inside[0]).sum() - firsts[1]
            b = np.where(self.inside[k], np.minimum((s10 + s11 * ahead) / (s00 + s01 * ahead), 1e100), b)
        out = np.empty(total)
        out[self.token[self.inside]] = probability[self.inside]
        return out, both, firsts


def toxic_features(words: list[str], ids: np.ndarray, lengths: np.ndarray, labels: np.ndarray) -> set[str]:
    """Words and beginnings that pass the likelihood-ratio test. ``ids``: the tokens of
    all documents as places in ``words``.

    A surrounding is the words on both sides. Distinct (feature, surrounding) pairs are
    counted over sorted 64-bit hashes, so memory is a few numbers a token."""
    totals = [int(lengths[labels == label].sum()) for label in (0, 1)]
    if not all(totals):
        return set()
    ends = np.cumsum(lengths)
    before, after = np.roll(ids, 1) + 1, np.roll(ids, -1) + 1
    full = lengths > 0
    before[(ends - lengths)[full]] = 0
    after[ends[full] - 1] = 0
    odd = np.uint64(0x9E3779B97F4A7C15)
    place = mix(mix(before.astype(np.uint64)) + after.astype(np.uint64) * odd)
    toxic = np.repeat(labels, lengths) == 1
    base = totals[1] / sum(totals)
    found = set()
    for size in (None, 4, 5, 6):  # whole words, then beginnings
        names: dict[str, int] = {}
        own = np.array([-1 if size and len(w) < size else names.setdefault(w[:size], len(names)) for w in words], np.int64)
        feature = own[ids]
        pairs = mix(place + feature.astype(np.uint64) * odd)
        counts = []
        for rows in (np.flatnonzero(~toxic & (feature >= 0)), np.flatnonzero(toxic & (feature >= 0))):
            first = np.unique(pairs[rows], return_index=True)[1]
            counts.append(np.bincount(feature[rows][first], minlength=len(names)))
        k, n = counts[1], counts[0] + counts[1]
        share = k / np.maximum(n, 1)
        passes = (k > 0) & (share >= MIN_TOXIC_SHARE) & (share > base)
        with np.errstate(divide="ignore", invalid="ignore"):
            statistic = 2 * (k * np.log(share / base) + (n - k) * np.log(np.maximum(1 - share, 1e-12) / (1 - base)))
        passes &= statistic >= MIN_RATIO_STATISTIC
        found |= {(str(size) if size else "w") + name for name, i in names.items() if passes[i]}
    return found


class Model:
    """Feature weights, transition and start weights, document calibration."""

    def __init__(self, weights, step, start, calibration):
        self.weights, self.step, self.start, self.calibration = weights, step, start, calibration
        self.emissions: dict[str, float] = {}

    def emission(self, tokens: list[str]) -> np.ndarray:
        new = set(tokens) - self.emissions.keys()
        if len(self.emissions) + len(new) > _KEPT_WORDS:
            self.emissions.clear()
            new = set(tokens)
        for token in new:
            self.emissions[token] = float(self.weights[features(token)].sum())
        return np.fromiter(map(self.emissions.__getitem__, tokens), float, len(tokens))

    def marginals(self, texts: list[list[str]]) -> np.ndarray:
        chains = Chains(np.array([len(t) for t in texts], np.int64))
        return chains.marginals(self.emission(list(chain.from_iterable(texts))), self.step, self.start)[0]

    def score(self, probabilities: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        x = document_features(probabilities, lengths) @ self.calibration
        return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def document_features(p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each document: 1, log odds of its likeliest token, log of 1 + its
    expected number of toxic tokens (of those at 0.05 or more)."""
    out = np.zeros((len(lengths), 3))
    out[:, 0] = 1.0
    owner = np.repeat(np.arange(len(lengths)), lengths)
    most = np.full(len(lengths), 1e-6)
    np.maximum.at(most, owner, p)
    most = np.minimum(most, 1 - 1e-6)
    out[:, 1] = np.log(most / (1 - most)) / 5.0
    out[:, 2] = np.log1p(np.bincount(owner, np.where(p >= 0.05, p, 0.0), len(lengths)))
    return out


def fit(texts: list[str], labels: list[int], totals: tuple[int, int] | None = None) -> Model | None:
    """Train on whole labelled texts; None when a class is missing. ``totals``:
    clean and toxic documents that the texts are a sample of."""
    seen = dict(zip(texts, labels, strict=True))  # equal texts count once
    labels = list(seen.values())
    if not any(labels) or all(labels):
        return None
    vocabulary: dict[str, int] = {}
    split = [np.array([vocabulary.setdefault(t, len(vocabulary)) for t in tokens_of(text)], np.int64) for text in seen]
    lengths = np.array([len(t) for t in split], np.int64)
    ids = np.concatenate(split)
    del split, seen
    words = list(vocabulary)
    bad = toxic_features(words, ids, lengths, np.asarray(labels))
    owner = np.repeat(np.asarray(labels), lengths)
    marked = np.array([not bad.isdisjoint(word_features(t)) for t in words], bool)
    y = (marked[ids] & (owner == 1)).astype(float)
    width = np.fromiter((len(word_features(t)) + 2 for t in words), np.int64, len(words))
    flat = np.fromiter(chain.from_iterable(map(features, words)), np.int64, int(width.sum()))
    of = np.repeat(np.arange(len(words)), width)
    chains = Chains(lengths)
    firsts = np.cumsum(lengths) - lengths
    firsts = firsts[lengths > 0]
    # Observed transitions and first labels.
    a, b = y[:-1].astype(int), y[1:].astype(int)
    inner = np.ones(max(len(y) - 1, 0), bool)
    inner[firsts[firsts > 0] - 1] = False
    observed = np.bincount(a[inner] * 2 + b[inner], minlength=4).reshape(2, 2).astype(float)
    observed_first = np.bincount(y[firsts].astype(int), minlength=2).astype(float)
    weights, trans, start = np.zeros(1 << FEATURE_BITS), np.zeros((2, 2)), np.zeros(2)
    params = [weights, trans, start]
    moments = [(np.zeros_like(x), np.zeros_like(x)) for x in params]
    scale = 1.0 / max(y.sum(), 1.0)
    for t in range(1, STEPS + 1):
        emission = np.bincount(of, weights[flat], len(words))[ids]
        p, pairs, first = chains.marginals(emission, np.exp(trans), np.exp(start), pairs=True)
        token_gap = np.bincount(ids, y - p, len(words))
        gaps = [np.bincount(flat, token_gap[of], len(weights)) * scale, (observed - pairs) * scale,
                (observed_first - first) * scale]
        for x, g, (m, v) in zip(params, gaps, moments, strict=True):
            g = g - L2 * x
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += LEARNING_RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
        trans[:] = np.clip(trans, -8, 8)
    model = Model(weights, np.exp(trans), np.exp(start), np.zeros(3))
    emission = np.bincount(of, weights[flat], len(words))[ids]
    x = document_features(chains.marginals(emission, model.step, model.start)[0], lengths)
    target = np.asarray(labels, float)
    weight = np.ones(len(target))
    if totals is not None:
        share = np.array(totals, float) / sum(totals) * len(target) / np.bincount(labels, minlength=2)
        weight = share[np.asarray(labels)]
    w = np.zeros(3)
    for _ in range(30):  # Newton steps of a ridge logistic regression
        q = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (weight * q * (1 - q))[:, None]).T @ x + np.eye(3) * 0.1
        w += np.linalg.solve(hessian, x.T @ (weight * (target - q)) - 0.1 * w)
    model.calibration = w
    return model


def train(documents: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS,
          max_train_chars: int = MAX_TRAIN_CHARS, sample_chars: int = SAMPLE_CHARS) -> Model | None:
    """Fit to a bounded sample of documents (doc_id, text) that have a label
    (doc_id, toxic). One task fits, the driver receives the model's weights."""
    known = (labels.where(F.col("toxic").isNotNull()).groupBy("doc_id")
             .agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    order = F.xxhash64(F.col("doc_id").cast("string"))
    texts = documents.where(F.col("text").isNotNull()).select("doc_id", "text")
    # Ids and lengths first: only the sample's texts are moved.
    ids = (texts.select("doc_id", F.length("text").alias("chars")).groupBy("doc_id").agg(F.max("chars").alias("chars"))
           .join(known, "doc_id").withColumns({"long": F.col("chars") > max_train_chars, "order": order}))

    # Two rows: the whole table's labelled documents of each class.
    counted = dict(known.join(documents.select("doc_id"), "doc_id", "left_semi").groupBy("toxic").count().collect())
    totals = (counted.get(0, 0), counted.get(1, 0))
    so_far = Window.partitionBy("toxic").orderBy("long", "order", "doc_id")

    def first(label: int, n: int, chars: int) -> DataFrame:
        # At most n rows enter the window.
        rows = ids.where(F.col("toxic") == label).orderBy("long", "order", "doc_id").limit(n)
        return (rows.withColumns({"all": F.sum("chars").over(so_far), "nth": F.row_number().over(so_far)})
                .where((F.col("all") <= chars) | (F.col("nth") == 1)).select("doc_id", "toxic"))

    chosen = first(1, sample_docs, sample_chars).union(first(0, 2 * sample_docs, 2 * sample_chars))
    sample = (texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
              .select(F.lit(0).alias("one"), "doc_id", "text", "toxic"))

    def fit_all(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "text"], kind="stable")
        model = fit(list(group["text"]), [int(t) for t in group["toxic"]], totals)
        if model is None:
            return pd.DataFrame({"feature": [], "weight": []})
        at = np.flatnonzero(np.abs(model.weights) > 1e-6)
        del group
        rest = np.concatenate([model.step.ravel(), model.start, model.calibration])
        return pd.DataFrame({"feature": np.concatenate([at, -1 - np.arange(len(rest))]),
                             "weight": np.concatenate([model.weights[at], rest])})

    # At most 3 * sample_docs rows of 3 * sample_chars characters: one bounded group.
    fitted = (sample.groupBy("one").applyInPandas(fit_all, "feature bigint, weight double")).toPandas()
    if fitted.empty:
        return None
    weights = np.zeros(1 << FEATURE_BITS)
    own = fitted[fitted["feature"] >= 0]
    weights[own["feature"].to_numpy()] = own["weight"].to_numpy()
    rest = fitted[fitted["feature"] < 0].sort_values("feature", ascending=False)["weight"].to_numpy()
    return Model(weights, rest[:4].reshape(2, 2), rest[4:6], rest[6:])


def spans(text: str, p: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) characters of the tokens of probability 1/2 or more."""
    if not (p >= 0.5).any():
        return []
    return [m.span() for m, q in zip(_TOKEN.finditer(lowered(text)), p, strict=True) if q >= 0.5]


def _parts(batch: pa.RecordBatch, model: Model | None):
    """(texts, scores, token marginals and token counts) for runs of rows."""
    texts = batch.column(batch.schema.get_field_index("text"))
    part: list[str] = []
    size = 0
    for i in range(batch.num_rows):
        part.append(texts[i].as_py() or "")
        size += len(part[-1])
        if size <= 1 << 20 and i + 1 < batch.num_rows:
            continue
        if model is None:
            yield part, [0.0] * len(part), np.zeros(0), np.zeros(len(part), np.int64)
        else:
            split = [tokens_of(t) for t in part]
            lengths = np.array([len(t) for t in split], np.int64)
            p = model.marginals(split)
            yield part, model.score(p, lengths).tolist(), p, lengths
        part, size = [], 0


def _share(spark, model: Model | None):
    return spark.sparkContext.broadcast(
        None if model is None else (model.weights, model.step, model.start, model.calibration))


def tag(documents: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score, n_toxic, spans array<struct<start, end>> for every row."""
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = _share(documents.sparkSession, model)
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None if shared.value is None else Model(*shared.value)
        for batch in batches:
            scores: list[float] = []
            found: list[list] = []
            for part, score, p, lengths in _parts(batch, own):
                scores += score
                ends = np.cumsum(lengths)
                found += [spans(t, p[b - n:b]) for t, b, n in zip(part, ends, lengths, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()),
                 pa.array([len(s) for s in found], pa.int64()),
                 pa.array([[{"start": a, "end": b} for a, b in s] for s in found], span_type)],
                ["doc_id", "score", "n_toxic", "spans"])

    return rows.mapInArrow(run, f"doc_id {kind}, score double, n_toxic bigint, "
                                "spans array<struct<start:int,end:int>>")


def untoxic(documents: DataFrame, model: Model | None, below: float = 0.5) -> DataFrame:
    """The rows of ``documents``, all columns, that score less than ``below``."""
    shared = _share(documents.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None if shared.value is None else Model(*shared.value)
        for batch in batches:
            keep = [s < below for _, scores, _, _ in _parts(batch, own) for s in scores]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return documents.mapInArrow(run, documents.schema)


def trained(documents: DataFrame, labels: DataFrame) -> Model | None:
    """The model learned from the rows outside fold 0 of 5."""
    learn = fold(F.col("doc_id"), 5) != 0
    return train(documents.select("doc_id", "text").where(learn), labels.select("doc_id", "toxic").where(learn))


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Contract of op1: learned from labels outside fold 0 of 5, applied to all."""
    return tag(documents, trained(documents, labels)).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_toxic", "spans")
