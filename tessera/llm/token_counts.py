"""Token counts by overlap resynchronisation (operator 8).

A text of up to ``chunk_chars`` characters is encoded in one piece. A longer one
is encoded in overlapping chunks. Every chunk yields token offsets. Two
neighbouring chunks are spliced at a boundary that

* lies inside their overlap,
* is a token boundary in both encodings, and
* is *stable*: the character before it is no white space and the one at it is.

Such a boundary is a boundary of the vocabulary's own word pattern whatever
stands further left or right: no alternative of the pattern runs from a
non-space character into a space, none looks back, and only a run of white
space looks ahead. No special string holds white space, so none crosses it. The
tokens before it (of the left chunk) and after it (of the right chunk) are
therefore those of the whole text. When the overlap holds no such boundary it is
widened, up to the rest of the text.

Encoder: the byte-level BPE of ``byte_bpe_50k``. Its JSON file (tokenizers) is
what counts are defined by. The rank file holds the same vocabulary and merges
for tiktoken, which is about four times as fast; it is used for texts whose
characters all lie in a range where both libraries' word patterns were compared
(``_PLAIN``); any other text goes to tokenizers itself.

Nulls and empty texts have 0 tokens. Rows are independent, so ties, repeated
rows and extra columns change nothing.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "byte_bpe_50k"
SPECIALS = ("<|endoftext|>",)
CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 1 << 10
TOKEN_LIMIT = 1024
#: Printable ASCII, tab, line ends, and the Latin, Greek and Cyrillic letters.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-¬®-ͯЀ-ҁҊ-ԯ]*\Z")
_STABLE = re.compile(r"(?<=\S)(?=\s)")

Encode = Callable[[str], tuple[int, np.ndarray]]
_encoders: dict[str, tuple] = {}


def _load(vocabulary: str):
    """The two encoders of ``vocabulary``, once in each Python worker."""
    if vocabulary not in _encoders:
        import public_tokenizers as files
        import tiktoken
        from tokenizers import Tokenizer

        exact = Tokenizer.from_file(files.path(f"{vocabulary}.json"))
        with open(files.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        specials = {s: exact.token_to_id(s) for s in SPECIALS}
        fast = tiktoken.Encoding("own", pat_str=files.PATTERN, mergeable_ranks=ranks,
                                 special_tokens=specials)
        lengths = np.zeros(max([*ranks.values(), *specials.values()]) + 1, np.int64)
        for token, rank in ranks.items():
            lengths[rank] = len(token)
        for token, rank in specials.items():
            lengths[rank] = len(token.encode())
        _encoders[vocabulary] = exact, fast, lengths
    return _encoders[vocabulary]


def encode(text: str, vocabulary: str = VOCABULARY) -> np.ndarray:
    """Token ids of one string, special strings in it taken as such."""
    exact, fast, _ = _load(vocabulary)
    if _PLAIN.match(text):
        return np.asarray(fast.encode(text, allowed_special="all"), np.int64)
    return np.asarray(exact.encode(text, add_special_tokens=False).ids, np.int64)


def token_ends(text: str, vocabulary: str = VOCABULARY) -> np.ndarray:
    """End offset (in UTF-8 bytes) of every token: byte-level tokens spell the
    text's bytes, so their lengths add up to its offsets."""
    return np.cumsum(_load(vocabulary)[2][encode(text, vocabulary)])


def _splice(text: str, lo: int, hi: int, left: np.ndarray, left_from: int, right: np.ndarray,
            right_from: int) -> int | None:
    """Last stable character boundary in [lo, hi) which both encodings have as a
    token boundary. left, right: their token ends; *_from: where they begin."""
    marks = [m.start() for m in _STABLE.finditer(text, lo + 1, hi)]
    for p in reversed(marks):
        a, b = len(text[left_from:p].encode()), len(text[right_from:p].encode())
        i, j = np.searchsorted(left, a), np.searchsorted(right, b)
        if i < len(left) and left[i] == a and j < len(right) and right[j] == b:
            return p
    return None


def count_long(text: str, ends: Callable[[str], np.ndarray], chunk: int = CHUNK_CHARS,
               overlap: int = OVERLAP_CHARS) -> int:
    """Tokens of ``text`` from overlapping chunks; ``ends`` gives token ends."""
    total, start = 0, 0  # everything before `start`, a stable boundary, is counted
    stop = min(len(text), chunk)
    left = ends(text[start:stop])
    while stop < len(text):
        wide = overlap
        while True:
            begin = max(start, stop - wide)
            new_stop = min(len(text), begin + max(chunk, 2 * wide))
            right = ends(text[begin:new_stop])
            p = _splice(text, begin, stop, left, start, right, begin)
            if p is not None:
                break
            if begin == start:  # nothing stable between `start` and `stop`: one longer chunk
                left, stop = right, new_stop
                break
            wide *= 2
        if p is not None:
            total += int(np.searchsorted(left, len(text[start:p].encode()), side="right"))
            skip = len(text[begin:p].encode())
            left = right[np.searchsorted(right, skip, side="right"):] - skip
            start, stop = p, new_stop
        elif stop >= len(text):
            break
    return total + len(left)


def count_text(text: str, vocabulary: str = VOCABULARY, chunk: int = CHUNK_CHARS,
               overlap: int = OVERLAP_CHARS) -> int:
    if len(text) <= chunk:
        return len(encode(text, vocabulary))
    return count_long(text, lambda part: token_ends(part, vocabulary), chunk, overlap)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = TOKEN_LIMIT, vocabulary: str = VOCABULARY,
                 chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            n_bytes, n_tokens = [], []
            for i in range(batch.num_rows):
                text = texts[i].as_py() or ""
                n_bytes.append(len(text.encode()))
                n_tokens.append(count_text(text, vocabulary, chunk, overlap))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                 pa.array([n > limit for n in n_tokens], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
