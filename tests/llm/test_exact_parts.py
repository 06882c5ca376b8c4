"""The parts that run inside tasks, against plain statements of the same thing."""

import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tessera.llm import fingerprints, language_id, licenses, token_counts, toxicity
from tessera.llm import jaccard_join as J
from tessera.llm.common import text_slices
from tessera.llm.words import LETTERS, shingle_sets, word_hashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_shingle_sets_and_word_kinds():
    rng = random.Random(1)
    texts = ["".join(rng.choice("aAbB zZé.1\n\t\x0b") for _ in range(rng.randint(0, 60))) for _ in range(400)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]).slice(3)
    for size in (1, 64, 1 << 20):
        found, letters = [], []
        for _, _, data, offsets in text_slices(batch, max_bytes=size):
            found += [len(s) for s in shingle_sets(data, offsets, 5)]
            letters += list(word_hashes(data, offsets, LETTERS)[1])
        words = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) for t in texts[3:]]
        assert found == [len({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}) if w else 0 for w in words]
        assert letters == [len(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")) for t in texts[3:]]


def test_equal_words_equal_hashes():
    batch = pa.RecordBatch.from_arrays([pa.array(["a b c d e f", " A\nb  C d e\tf ", "a b c d e g", "ab c d e f"])], ["text"])
    (_, _, data, offsets), = text_slices(batch)
    a, b, c, d = shingle_sets(data, offsets, 5)
    assert list(a) == list(b) and len(np.intersect1d(a, c)) == 1 and not len(np.intersect1d(a, d))


def test_token_counts_equal_the_library():
    exact = token_counts._load("byte_bpe_50k")[0]
    rng = random.Random(2)
    parts = ["the ", "a", "\n", "  ", "x" * 40, "é ", "<|endoftext|>", " don't ", "\U0001F600", "日本語 ", "12345 ", "　", "\u0085"]
    for _ in range(400):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
        want = len(exact.encode(text, add_special_tokens=False).ids)
        assert token_counts.count_text(text, chunk=rng.choice([8, 20, 50]), overlap=rng.choice([1, 3, 9])) == want
        assert token_counts.count_text(text) == want


def test_token_counts_agree_for_every_plain_character():
    exact, fast, _ = token_counts._load("byte_bpe_50k")
    plain = [chr(c) for c in range(0x530) if token_counts._PLAIN.match(chr(c))]
    texts = [t for c in plain for t in (c, f"a{c}b", f" {c} ", c + c, f"1{c}2 ", f"{c}'s")]
    want = [e.ids for e in exact.encode_batch(texts, add_special_tokens=False)]
    assert [fast.encode(t, allowed_special="all") for t in texts] == want


def test_words_sum_over_all_segmentations():
    pieces = ["▁", "▁a", "a", "ab", "b", "ba", "abab", "▁ab"]
    rng = np.random.default_rng(0)
    table = rng.random((len(pieces), 2)) / 10
    scorer = language_id.Scorer(["x", "y"], np.zeros(2), pieces, table)

    def ways(word):
        if not word:
            return [[]]
        out = [[word[0] + "?"] + rest for rest in ways(word[1:])]
        for n in range(1, len(word) + 1):
            if word[:n] in pieces:
                out += [[word[:n]] + rest for rest in ways(word[n:])]
        return out

    words = ["▁a", "▁abab", "▁bzab", "▁ababa"]
    found = scorer.words(words)
    for i, word in enumerate(words):
        for lang in range(2):
            total = sum(math.prod(1e-7 if p.endswith("?") else table[pieces.index(p), lang] for p in way) for way in ways(word))
            assert math.isclose(found[i, lang], math.log(total), rel_tol=1e-9)
    long = "▁" + "ab" * 400  # rescaled on the way
    found = scorer.words([long])[0]
    assert np.isfinite(found).all() and found.min() < -750  # below the least double


def test_expected_counts_follow_the_forward_backward_sum():
    counts = {"▁ab": 3, "▁b": 1}
    p = language_id.fit_pieces(counts, {"▁": 0, "a": 1, "b": 2, "ab": 3, "▁ab": 4}, rounds=5)
    assert math.isclose(p.sum(), 1.0) and p[4] > p[1]


def test_chain_marginals_by_enumeration(monkeypatch):
    monkeypatch.setattr(toxicity, "_BLOCK", 3)
    rng = np.random.default_rng(0)
    lengths = np.array([0, 1, 2, 3, 4, 7, 8, 0, 10, 1])
    e, step, start = rng.normal(size=lengths.sum()) * 2, np.exp(rng.normal(size=(2, 2))), np.exp(rng.normal(size=2))
    p, pairs, first = toxicity.Chains(lengths).marginals(e, step, start, pairs=True)
    at, want_pairs, want_first = 0, np.zeros((2, 2)), np.zeros(2)
    for n in lengths:
        total, m, pp, ff = 0.0, np.zeros(n), np.zeros((2, 2)), np.zeros(2)
        for ys in itertools.product((0, 1), repeat=int(n)) if n else ():
            w = start[ys[0]] * np.exp(sum(e[at + i] for i in range(n) if ys[i]))
            w *= math.prod(step[a, b] for a, b in itertools.pairwise(ys))
            total += w
            m += w * np.array(ys)
            ff[ys[0]] += w
            for a, b in itertools.pairwise(ys):
                pp[a, b] += w
        if n:
            assert np.allclose(m / total, p[at:at + n])
            want_pairs += pp / total
            want_first += ff / total
        at += n
    assert np.allclose(want_pairs, pairs) and np.allclose(want_first, first)


def test_offending_offsets():
    rng = random.Random(4)
    clean = [" ".join(rng.choice(["the", "of", "and", "ran", "home", "blue"]) + str(rng.randint(0, 99)) for _ in range(30))
             for _ in range(120)]
    bad = [t.replace(" ", f" {rng.choice(['scumbag', 'Scumbags'])} ", 1) for t in clean[:60]]
    model = toxicity.fit(clean[60:] + bad, [0] * 60 + [1] * 60)
    text = "the of İ blue SCUMBAG, and home"
    p = model.marginals([toxicity.tokens_of(text)])
    assert [text[a:b] for a, b in toxicity.spans(text, p)] == ["SCUMBAG"]
    assert toxicity.fit(["a"], [0]) is None and toxicity.fit([], []) is None


def test_walk_matches_a_plain_loop():
    m = lambda x: int(fingerprints.mix(np.array([x & (2 ** 64 - 1)], np.uint64))[0])

    def plain(text):
        out, best, i, j = [0] * fingerprints.SLOTS, [1 << 64] * fingerprints.SLOTS, 0, 0
        codes = [ord(c) + 1 for c in text]
        while i < len(codes):
            h = m(j + 0x632BE59BD9B4E019)
            if m(h) < best[h % fingerprints.SLOTS]:
                best[h % fingerprints.SLOTS] = m(h)
                out[h % fingerprints.SLOTS] = m(codes[i] * 0x9E3779B97F4A7C15 + j) >> 56
            factor = (m(j ^ 0xD6E8FEB86659FD93) >> 32) | 1
            i, j = i + (((codes[i] * factor) & 0xFFFFFFFF) >> 31), j + 1
        return bytes(out)

    texts = ["", "a", "ab é 日本", "the quick brown fox " * 30, "\U0001F600" * 300]
    prints = fingerprints.Walk().fingerprints([fingerprints.code_points(t) for t in texts])
    assert [p.tobytes() for p in prints] == [plain(t) for t in texts]


def test_small_edits_stay_near():
    rng = random.Random(6)
    base = "".join(rng.choice("abcdefghijklmnop ") for _ in range(5000))
    near = base[:1000] + "X" + base[1000:3000] + base[3003:]
    far = "".join(rng.choice("abcdefghijklmnop ") for _ in range(5000))
    a, b, c = fingerprints.Walk().fingerprints([fingerprints.code_points(t) for t in (base, near, far)])
    assert (a == b).mean() > 0.75 and (a == c).mean() < 0.3


def test_signature_tree_loses_no_link(monkeypatch):
    monkeypatch.setattr(J, "FANOUT", 3)
    rng = np.random.default_rng(2)
    sets = []
    for _ in range(25):
        base = rng.integers(0, 1 << 62, rng.integers(1, 60)).astype(np.uint64)
        for _ in range(rng.integers(1, 6)):
            sets.append(np.unique(np.concatenate([base[rng.random(len(base)) > 0.08], rng.integers(0, 1 << 62, 1).astype(np.uint64)])))
    n = np.array([len(s) for s in sets])
    bits = np.stack([J.bitmap(s, 2) for s in sets])
    spare = n - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    links = set()
    for i, j in itertools.combinations(range(len(sets)), 2):
        common = len(np.intersect1d(sets[i], sets[j]))
        if 100 * common >= 80 * (n[i] + n[j] - common):
            links.add((i, j))
    for order in (np.arange(len(sets)), np.argsort(n, kind="stable")):
        tree = J.SignatureTree(bits[order], n[order], np.arange(len(sets)), spare[order])
        found = {tuple(sorted(p)) for p in zip(*(order[x].tolist() for x in tree.join(tree, 80)), strict=True)}
        assert links and links <= found and len(found) < len(sets) ** 2 / 8
    half = J.SignatureTree(bits[:20], n[:20], np.arange(20), spare[:20])
    rest = J.SignatureTree(bits[20:], n[20:], np.arange(20, len(sets)), spare[20:])
    across = {(i, j + 20) for i, j in zip(*(x.tolist() for x in half.join(rest, 80)), strict=True)}
    assert {(i, j) for i, j in links if i < 20 <= j} <= across


def test_words_of_like_structure_have_hashes_of_their_own():
    """A word of 1,024 letters by the Thue-Morse rule and its complement collide under any
    polynomial modulo 2**64; words of all lengths hash alike wherever they stand."""
    one = "a"
    for _ in range(10):
        one += one.translate(str.maketrans("ab", "ba"))
    words = [one, one.translate(str.maketrans("ab", "ba"))]
    words += ["".join(c) for n in (1, 2, 3) for c in itertools.product("ab\x00", repeat=n)]
    words += [c * n for c in "ab" for n in range(4, 70)]

    def hashes(texts):
        parts = [t.encode() for t in texts]
        return word_hashes(np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)]))[0].tolist()

    alone = hashes(words)
    assert len(set(alone)) == len(set(words))
    assert hashes([" " + " ".join(w.upper() for w in words) + " end"])[:-1] == alone


def test_size_bands_agree_in_both_engines(spark):
    sizes = [*range(1, 5000), *(int(1.25 ** k) + d for k in range(38, 70) for d in (-1, 0, 1))]
    band = F.floor(F.log("n") / F.log(F.lit(1.25)) + F.lit(1e-9)).cast("int")
    got = spark.createDataFrame([(n,) for n in sizes], "n bigint").select(band.alias("b")).collect()
    assert [r.b for r in got] == [J.size_band(n) for n in sizes]


def test_prefix_holds_a_shared_token():
    for n in range(1, 400):
        assert n - J.prefix_length(n) + 1 >= 0.8 * n - 1e-9 > n - J.prefix_length(n) - 1e-9 or n < 5


def test_license_windows():
    known = licenses.Templates(licenses.TEMPLATES)
    assert min(licenses.meeting_probability(m, len(known.sets[i])) for m, own in known.sizes.items() for i in own) > 1 - 1e-11
    assert licenses.meeting_probability(64, 33) > 1 - 3e-6
    rng = random.Random(7)
    for at in (0, 1, 50, 5000, 9000):
        words = [f"v{rng.randint(0, 10 ** 6)}" for _ in range(at)] + licenses.TEMPLATES["MIT-text"].split() + ["end"] * 40
        text = " ".join(words)
        (name, first, share), = known.scan(licenses._hashes(text, 5), 0.8)
        assert name == "MIT-text" and first <= at < first + 64 and share >= 0.8
