"""License scans by MinHash bands over overlapping text windows (operator 9).

Texts and templates become 5-word shingles (ASCII letters and digits with A-Z
lower-cased, and characters beyond ASCII). Templates of m shingles, m rounded up
to a power of two, are looked for in windows of 2m shingles that start at every
m-th shingle, so every run of m shingles lies inside a window.

*Retrieval.* A window and a template meet in a band if the band's MinHash is the
same. With one row a band the probability that they meet in some band is
1 - (1 - J)**bands. A window holding the share c of a template has
J >= c*m' / (2m + m' - c*m'), where m/2 < m' <= m is the template's own number of
shingles: with c = 0.8 and 64 bands that is at least 1 - 2e-6 (m' = m:
1 - 4e-13), see ``meeting_probability``.
*Verification.* The exact share of the template's shingles that the window
holds must reach ``containment``.

A window is a bounded slice of its text, so very long texts cost no more a word.
Null and wordless texts match nothing; texts and templates of fewer than five
words are one shingle. Templates without words are left out. Repeated rows are
scanned one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import text_slices
from tessera.llm.words import LETTERS, mix, shingles, word_hashes

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
BANDS = 64
#: Shingles hashed at once (times BANDS numbers of 8 bytes).
_AT_ONCE = 1 << 12
_LOW = np.uint64(0xFFFF)
# Public license notices, as their texts are published.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                "and associated documentation files (the \"Software\"), to deal in the Software without "
                "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
                "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
                "Software is furnished to do so, subject to the following conditions:",
}


def meeting_probability(m: int, own: int, containment: float = CONTAINMENT, bands: int = BANDS) -> float:
    """Least probability that a window of 2m shingles that holds the share
    ``containment`` of a template of ``own`` shingles meets it in a band."""
    held = int(np.ceil(containment * own - 1e-9))
    return 1.0 - (1.0 - held / (2 * m + own - held)) ** bands


def _hashes(text: str, k: int) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    words, _ = word_hashes(data, np.array([0, len(data)]), LETTERS)
    return shingles(words, k)


class Templates:
    """Templates grouped by window size, with their MinHash in every band."""

    def __init__(self, templates: dict[str, str], k: int = SHINGLE_WORDS, bands: int = BANDS):
        self.factors = (mix(np.arange(1, bands + 1, dtype=np.uint64)) | np.uint64(1))[:, None]
        self.names = sorted(templates)
        self.sets = [np.unique(_hashes(templates[n], k)) for n in self.names]
        self.sizes: dict[int, list[int]] = {}
        for i, own in enumerate(self.sets):
            if len(own):
                self.sizes.setdefault(1 << (len(own) - 1).bit_length(), []).append(i)
        #: window size -> (band and MinHash in one number, templates)
        self.lookup: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        #: Low 16 bits of all templates' MinHashes: nearly all windows stop here.
        self.low = np.zeros(1 << 16, bool)
        for m, own in self.sizes.items():
            minima = np.concatenate([(self.sets[i] * self.factors).min(axis=1) for i in own])
            self.low[minima & _LOW] = True
            keys = self._keys(np.tile(np.arange(bands), len(own)), minima)
            order = np.argsort(keys, kind="stable")
            self.lookup[m] = keys[order], np.repeat(own, bands)[order]

    @staticmethod
    def _keys(band: np.ndarray, minima: np.ndarray) -> np.ndarray:
        return mix(minima + (band.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))

    def candidates(self, own: np.ndarray) -> set[tuple[int, int, int]]:
        """(m, window, template) that meet in a band. Window w starts at shingle w * m."""
        found: set[tuple[int, int, int]] = set()
        widest = max(self.sizes, default=1)
        step = max(widest, _AT_ONCE // widest * widest)
        for a in range(0, len(own), step):  # one strip more, for windows across the cut
            strips = own[a:a + step + widest] * self.factors
            m = 1
            while True:  # strips of m shingles; two neighbours are a window
                if m in self.sizes:
                    windows = strips[:, :step // m].copy()
                    after = strips[:, 1:step // m + 1]
                    np.minimum(windows[:, :after.shape[1]], after, out=windows[:, :after.shape[1]])
                    band, w = np.nonzero(self.low[windows & _LOW])
                    keys, of = self.lookup[m]
                    asked = self._keys(band, windows[band, w])
                    at = np.searchsorted(keys, asked)
                    for key, i, window in zip(asked, at, w, strict=True):
                        while i < len(keys) and keys[i] == key:
                            found.add((m, a // m + int(window), int(of[i])))
                            i += 1
                if m >= widest:
                    break
                if strips.shape[1] % 2:
                    strips = np.concatenate([strips, strips[:, -1:]], axis=1)
                strips = np.minimum(strips[:, ::2], strips[:, 1::2])
                m *= 2
        return found

    def scan(self, own: np.ndarray, containment: float) -> list[tuple[str, int, float]]:
        """(name, first shingle of the window, share held), the best window of each
        template (the first among equals), by name."""
        best: dict[int, tuple[float, int]] = {}
        for m, w, i in self.candidates(own):
            held = np.isin(self.sets[i], own[w * m:w * m + 2 * m]).sum() / len(self.sets[i])
            if held >= containment - 1e-12 and (i not in best or (-held, w * m) < (-best[i][0], best[i][1])):
                best[i] = held, w * m
        return [(self.names[i], best[i][1], float(best[i][0])) for i in sorted(best)]


def scan_licenses(documents: DataFrame, templates: dict[str, str] | None = None, k: int = SHINGLE_WORDS,
                  containment: float = CONTAINMENT, bands: int = BANDS) -> DataFrame:
    """doc_id, n_shingles, matches array<struct<license, at, share>> for every row."""
    shared = documents.sparkSession.sparkContext.broadcast(dict(TEMPLATES if templates is None else templates))
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    match_type = pa.list_(pa.struct([("license", pa.string()), ("at", pa.int64()), ("share", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(shared.value, k, bands)
        for batch in batches:
            n, found = [], []
            for _, _, data, offsets in text_slices(batch):
                words, counts = word_hashes(data, offsets, LETTERS)
                ends = np.cumsum(counts)
                for i in range(len(counts)):
                    own = shingles(words[ends[i] - counts[i]:ends[i]], k)
                    n.append(len(own))
                    found.append([dict(zip(("license", "at", "share"), m, strict=True))
                                  for m in known.scan(own, containment)] if len(own) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(found, match_type)],
                ["doc_id", "n_shingles", "matches"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_shingles bigint, "
                                "matches array<struct<license:string,at:bigint,share:double>>")


def license_report(documents: DataFrame) -> DataFrame:
    """One row a document: its licenses by name, and where the first one is found."""
    return scan_licenses(documents).select(
        "doc_id", "n_shingles", F.size("matches").cast("bigint").alias("n_licenses"),
        F.array_join(F.col("matches.license"), ",").alias("licenses"),
        F.array_join(F.transform("matches", lambda x: x["at"].cast("string")), ",").alias("windows"))


def _oracle() -> str:
    rows = ", ".join("('%s', '%s')" % (n, t.replace("'", "''")) for n, t in TEMPLATES.items())
    words = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
    return rf"""
WITH t AS (SELECT name, {words} AS w FROM (VALUES {rows}) AS v(name, text)),
ts AS (
  SELECT DISTINCT name, array_to_string(w[s + 1 : s + 5], ' ') AS g
  FROM (SELECT name, w, unnest(range(greatest(len(w) - 4, 1))) AS s FROM t WHERE len(w) > 0)),
tm AS (SELECT name, count(*) AS own, CAST(2 ** ceil(log2(count(*))) AS BIGINT) AS m FROM ts GROUP BY name),
d AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS w FROM documents),
ds AS (
  SELECT rid, s, array_to_string(w[s + 1 : s + 5], ' ') AS g
  FROM (SELECT rid, w, unnest(range(greatest(len(w) - 4, 1))) AS s FROM d WHERE len(w) > 0)),
h AS (SELECT rid, s, g, name, own, m FROM ds JOIN ts USING (g) JOIN tm USING (name)),
win AS (
  SELECT rid, name, own, m, s // m AS k, g FROM h
  UNION ALL SELECT rid, name, own, m, s // m - 1, g FROM h WHERE s >= m),
share AS (SELECT rid, name, k * m AS at_, count(DISTINCT g) / own AS share FROM win GROUP BY rid, name, k, m, own),
best AS (
  SELECT rid, name, arg_min(at_, (-share, at_)) AS at_ FROM share WHERE share >= {CONTAINMENT} - 1e-12 GROUP BY rid, name),
r AS (
  SELECT rid, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names,
    string_agg(CAST(at_ AS VARCHAR), ',' ORDER BY name) AS windows FROM best GROUP BY rid)
SELECT doc_id, CASE WHEN len(w) = 0 THEN 0 ELSE greatest(len(w) - 4, 1) END AS n_shingles,
  CAST(coalesce(n, 0) AS BIGINT) AS n_licenses, coalesce(names, '') AS licenses, coalesce(windows, '') AS windows
FROM d LEFT JOIN r USING (rid)
"""


ORACLE = _oracle()
