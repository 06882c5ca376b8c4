"""Language identification by segmentation-marginalised unigrams (operator 10).

Every language has a probability for each piece of one fixed public vocabulary
(the pieces of ``piece_bpe_32k.model``; nothing is learned about which pieces
exist). The probability of a word is the sum over *all* its segmentations into
pieces, computed by a forward pass over the word's characters; a text's log
likelihood is the sum over its words, and the score is the posterior of the
best language.

Training: the piece probabilities are fitted by expectation maximisation
(expected piece counts from forward and backward passes) to the word counts of a
bounded sample of whole documents, at most ``docs_per_lang`` of ``lang_chars``
characters in all for each language. Documents of up to ``max_train_chars``
characters are taken first; longer ones fill what they leave, and a language's first
document is taken whatever its length, so no language is lost. One Spark group fits
one language. The prior is counted over all training rows. The model has at most
(vocabulary size) x (languages) numbers, whatever the corpus size.

Words are maximal runs of letters, lower-cased, marked at their start as in the
vocabulary. A text without a letter, or null, is ``und`` with score 0; so is
every text when there is no training row. Ties between languages go to the
first by name. Repeated rows and extra columns change nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import fold

VOCABULARY = "piece_bpe_32k.model"
DOCS_PER_LANG = 400
MAX_TRAIN_CHARS = 20_000
LANG_CHARS = 8_000_000
EM_ROUNDS = 3
SMOOTHING = 0.05
UNDETERMINED = "und"
#: Probability of one character outside the vocabulary, the same for all languages.
_UNKNOWN = 1e-7
_START = "▁"
_LETTERS = re.compile(r"[^\W\d_]+")
_KEPT_WORDS = 400_000
_WORDS_AT_ONCE = 20_000
#: Longest piece; places after which a long word's weights are rescaled.
_LONGEST = 16
_RESCALE = 32
_BASE = 0x9E3779B97F4A7C15
_vocabularies: dict[str, dict[str, int]] = {}


def vocabulary(name: str = VOCABULARY) -> dict[str, int]:
    """Piece -> number, for the lower-case pieces made of letters."""
    if name not in _vocabularies:
        import public_tokenizers as files
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=files.path(name))
        pieces = {model.id_to_piece(i) for i in range(model.get_piece_size())}
        own = sorted(p for p in pieces if p == _START or
                     (q := p.removeprefix(_START)).isalpha() and q == q.lower() and len(p) <= _LONGEST)
        _vocabularies[name] = {p: i for i, p in enumerate(own)}
    return _vocabularies[name]


def words_of(text: str) -> list[str]:
    """Lower-case words: runs of letters."""
    return _LETTERS.findall(text.lower())


class Pieces:
    """Finds the vocabulary's pieces inside many words at once.

    Substrings are compared by a 64-bit hash of their characters; a character
    position is extended only while what it spells is the beginning of a piece.
    """

    def __init__(self, pieces: list[str]):
        starts = {p[:n] for p in pieces for n in range(1, len(p) + 1)}
        number = {p: i for i, p in enumerate(pieces)}
        order = sorted(((self._spell(p), number.get(p, -1)) for p in starts))
        self.hashes = np.array([h for h, _ in order], np.uint64)
        self.numbers = np.array([i for _, i in order], np.int64)

    @staticmethod
    def _spell(text: str) -> int:
        h = 0
        for c in text:
            h = (h * _BASE + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def lattice(self, words: list[str]) -> Lattice:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
        ends = np.cumsum(sizes)
        word = np.repeat(np.arange(len(words)), sizes)
        at = np.arange(len(chars))
        h = np.zeros(len(chars), np.uint64)
        arcs = []
        length = 0
        while len(at):
            h = h * np.uint64(_BASE) + chars[at + length]
            length += 1
            i = np.searchsorted(self.hashes, h)
            i[i == len(self.hashes)] = 0
            known = self.hashes[i] == h
            at, h, i = at[known], h[known], i[known]
            piece = self.numbers[i]
            whole = piece >= 0
            arcs.append((at[whole], np.full(int(whole.sum()), length), piece[whole]))
            more = at + length < ends[word[at]]
            at, h = at[more], h[more]
        start, length, piece = (np.concatenate(x) for x in zip(*arcs, strict=True))
        # Every word has one node more than characters, so node = character + word number.
        first = ends - sizes
        place = start - first[word[start]]
        order = np.argsort(place, kind="stable")
        source = (start + word[start])[order]
        steps = np.searchsorted(place[order], np.arange(int(sizes.max(initial=0)) + 1))
        return Lattice(sizes, first + np.arange(len(words)), source, source + length[order], piece[order], steps)


class Lattice:
    """All segmentations of many words: arcs from node to node, ordered by the
    place in its word that an arc starts from. ``steps`` cuts them by place."""

    def __init__(self, sizes, first, source, target, piece, steps):
        self.sizes, self.first, self.source, self.target = sizes, first, source, target
        self.piece, self.steps = piece, steps
        self.by_size = np.argsort(-sizes, kind="stable")
        self.longer = np.searchsorted(-sizes[self.by_size], -np.arange(len(steps)), side="left")

    def _at(self, place: int) -> np.ndarray:
        """Words that have a character at ``place``."""
        return self.by_size[:self.longer[place]]

    def forward(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(weight of all ways from a word's start to each node, log of what each
        word's weights were divided by). p: piece probabilities, a column a language."""
        nodes = int((self.sizes + 1).sum())
        alpha = np.zeros((nodes, p.shape[1]))
        alpha[self.first] = 1.0
        shift = np.zeros((len(self.sizes), p.shape[1]))
        for place in range(len(self.steps) - 1):
            words = self._at(place)
            here = self.first[words] + place
            if place % _RESCALE == _RESCALE - 1:
                by = alpha[here]
                shift[words] += np.log(by)
                for ahead in range(_LONGEST + 1):
                    far = self.sizes[words] >= place + ahead
                    alpha[here[far] + ahead] /= by[far]
            alpha[here + 1] += alpha[here] * _UNKNOWN
            a, b = self.steps[place], self.steps[place + 1]
            # Arcs from one place of one word differ in length, so no node is hit twice.
            alpha[self.target[a:b]] += alpha[self.source[a:b]] * p[self.piece[a:b]]
        return alpha, shift

    def expected(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected piece counts (p: one column; words of at most _RESCALE characters)."""
        alpha = self.forward(p[:, None])[0][:, 0]
        beta = np.zeros_like(alpha)
        last = self.first + self.sizes
        beta[last] = 1.0
        for place in range(len(self.steps) - 2, -1, -1):
            here = self.first[self._at(place)] + place
            beta[here] += beta[here + 1] * _UNKNOWN
            a, b = self.steps[place], self.steps[place + 1]
            np.add.at(beta, self.source[a:b], beta[self.target[a:b]] * p[self.piece[a:b]])
        scale = np.zeros_like(alpha)
        np.put(scale, self.first, counts / np.maximum(alpha[last], 1e-300))
        owner = np.repeat(self.first, self.sizes + 1)
        weight = alpha[self.source] * p[self.piece] * beta[self.target] * scale[owner[self.source]]
        return np.bincount(self.piece, weight, len(p))


def fit_pieces(counts: dict[str, int], pieces: dict[str, int], rounds: int = EM_ROUNDS) -> np.ndarray:
    """Piece probabilities from word counts by expectation maximisation.

    Words of ``_RESCALE`` characters or more (none of a language's own words) are
    left out of the fit, never of the scoring."""
    words = sorted(w for w in counts if len(w) < _RESCALE)
    if not words:
        return np.full(len(pieces), 1.0 / len(pieces))
    lattice = Pieces(list(pieces)).lattice(words)
    n = np.array([counts[w] for w in words], float)
    owner = np.repeat(np.arange(len(words)), lattice.sizes + 1)
    seen = np.bincount(lattice.piece, n[owner[lattice.source]] * (lattice.target - lattice.source), len(pieces))
    p = (seen + SMOOTHING) / (seen.sum() + SMOOTHING * len(pieces))
    for _ in range(rounds):
        seen = lattice.expected(p, n)
        p = (seen + SMOOTHING) / (seen.sum() + SMOOTHING * len(pieces))
    return p


class Scorer:
    """Log likelihoods of words under every language, kept for frequent words."""

    def __init__(self, names: list[str], prior: np.ndarray, pieces: list[str], table: np.ndarray):
        self.names, self.prior, self.table = names, prior, table
        self.pieces = Pieces(pieces)
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((1024, len(names)))

    def words(self, words: list[str]) -> np.ndarray:
        """log of the sum over all segmentations: a row a word, a column a language."""
        out = np.zeros((len(words), len(self.names)))
        order = np.argsort(np.fromiter(map(len, words), np.int64, len(words)), kind="stable")
        for a in range(0, len(words), _WORDS_AT_ONCE):  # words of like length share their steps
            part = order[a:a + _WORDS_AT_ONCE]
            lattice = self.pieces.lattice([words[i] for i in part])
            alpha, shift = lattice.forward(self.table)
            out[part] = np.log(alpha[lattice.first + lattice.sizes]) + shift
        return out

    def _learn(self, tokens: list[str]) -> None:
        """Rows of the score table for words not seen lately."""
        new = set(tokens) - self.rows.keys()
        if len(self.rows) + len(new) > _KEPT_WORDS and self.rows:
            self.rows.clear()
            new = set(tokens)
        need = len(self.rows) + len(new)
        if need > len(self.scores) or need < len(self.scores) // 8:
            fresh = np.zeros((max(1024, 2 * need), self.scores.shape[1]))
            fresh[:len(self.rows)] = self.scores[:len(self.rows)]
            self.scores = fresh
        if new:
            at, words = len(self.rows), list(new)
            self.rows.update(zip(words, range(at, need), strict=True))
            self.scores[at:need] = self.words([_START + w for w in words])

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        split = [words_of(t) for t in texts]
        tokens = list(chain.from_iterable(split))
        self._learn(tokens)
        at = np.fromiter(map(self.rows.__getitem__, tokens), np.int64, len(tokens))
        totals = np.zeros((len(texts) + 1, self.scores.shape[1]))
        ends = np.cumsum([len(p) for p in split])
        owner = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
        for c in range(totals.shape[1]):
            totals[:len(texts), c] = np.bincount(owner, self.scores[at, c], len(texts))
        labels, scores = [], np.zeros(len(texts))
        for i in range(len(texts)):
            if not self.names or not any(c.isalpha() for w in split[i] for c in w):
                labels.append(UNDETERMINED)
                continue
            logit = totals[i] + self.prior
            best = int(np.argmax(logit))
            labels.append(self.names[best])
            scores[i] = 1.0 / np.exp(logit - logit[best]).sum()
        return labels, scores


def train(labelled: DataFrame, docs_per_lang: int = DOCS_PER_LANG,
          max_train_chars: int = MAX_TRAIN_CHARS, vocab: str = VOCABULARY, lang_chars: int = LANG_CHARS):
    """(language names, log priors, pieces, piece probabilities) from rows
    doc_id, text, lang. Collects the model only: vocabulary x languages numbers."""
    known = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    names = sorted(sizes)
    pieces = vocabulary(vocab)
    if not names:
        return [], np.zeros(0), list(pieces), np.zeros((len(pieces), 0))
    # The scan keeps about twice as many rows as are wanted; the rank makes the bound exact.
    order = F.xxhash64(F.col("doc_id").cast("string"))
    share = F.create_map(*[F.lit(x) for lang in names
                           for x in (lang, min(1.0, 2.0 * docs_per_lang / sizes[lang]))])
    likely = F.pmod(order, F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)
    by = Window.partitionBy("lang").orderBy("long", "order", "doc_id", "text")
    size = F.length("text")
    # The rank comes first, so at most docs_per_lang rows of a language are summed.
    sample = (known.where(likely).select("doc_id", "lang", "text", order.alias("order"), (size > max_train_chars).alias("long"))
              .withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= docs_per_lang)
              .withColumn("chars", F.sum(size).over(by))
              .where((F.col("chars") <= lang_chars) | (F.col("rank") == 1)).select("lang", "text"))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        own = vocabulary(vocab)
        counts = Counter(_START + w for text in group["text"] for w in words_of(text))
        p = fit_pieces(counts, own)
        return pd.DataFrame({"lang": [group["lang"].iloc[0]], "p": [p.tolist()]})

    fitted = {r["lang"]: r["p"] for r in
              sample.groupBy("lang").applyInPandas(fit, "lang string, p array<double>").collect()}
    names = [n for n in names if n in fitted]
    prior = np.log([sizes[n] for n in names])
    return names, prior, list(pieces), np.array([fitted[n] for n in names]).reshape(len(names), -1).T


def _predictions(batch: pa.RecordBatch, scorer: Scorer) -> tuple[list[str], list[float]]:
    texts = batch.column(batch.schema.get_field_index("text"))
    labels: list[str] = []
    scores: list[float] = []
    part: list[str] = []
    size = 0
    for i in range(batch.num_rows):
        part.append(texts[i].as_py() or "")
        size += len(part[-1])
        if size > 1 << 21 or i + 1 == batch.num_rows:
            a, b = scorer.predict(part)
            labels += a
            scores += b.tolist()
            part, size = [], 0
    return labels, scores


def identify(docs: DataFrame, model) -> DataFrame:
    """doc_id, lang_pred and score for every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value)
        for batch in batches:
            labels, scores = _predictions(batch, scorer)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def identified(docs: DataFrame, model, min_score: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is determined with a
    score of at least ``min_score``. Decided row by row; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value)
        for batch in batches:
            labels, scores = _predictions(batch, scorer)
            yield batch.filter(pa.array([a != UNDETERMINED and b >= min_score
                                         for a, b in zip(labels, scores, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def trained(docs: DataFrame):
    """The model learned from the rows outside fold 2 of 4."""
    return train(docs.where(fold(F.col("doc_id"), 4) != 2).select("doc_id", "text", "lang"))


def language_id(docs: DataFrame) -> DataFrame:
    """Contract of op10: trained on the rows outside fold 2 of 4, applied to all."""
    return identify(docs, trained(docs)).select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")
