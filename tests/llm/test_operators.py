"""Operators on awkward tables (nulls, empty and long texts, ties, repeated rows,
clashing extra columns, empty tables) and against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import chat, decontamination, fingerprints, graph, language_id, licenses, mixing, token_counts, toxicity
from tessera.llm import jaccard_join as J
from tessera.llm import url_filters as U
from tests.llm.cases import awkward_documents, empty_documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF01 = "/root/testdata/sf0.01"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def duck(sql, **tables):
    con = duckdb.connect()
    for name, rows in tables.items():
        con.register(name, rows)
    res = con.execute(sql)
    return [d[0] for d in res.description], res.fetchall()


def against_sql(df, sql, **tables):
    cols, want = duck(sql, **tables)
    assert rows_of(df.select(*cols)) == sorted(want, key=repr)


def frame(df, **kinds):
    """A DuckDB-readable copy: pyarrow keeps nulls and types."""
    return df.toArrow()


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_groups(rows):
    sets = {d: shingle_set(t) for d, t in rows if d is not None}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for d, s in sets.items():
        for t in s:
            holders.setdefault(t, []).append(d)
    for d, s in sets.items():
        for e, k in Counter(e for t in s for e in holders[t] if e < d).items():
            if 100 * k >= 80 * (len(s) + len(sets[e]) - k):
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d)) for d in sets}


def test_token_counts_take_anything(spark):
    docs, rows = awkward_documents(spark)
    exact = token_counts._load("byte_bpe_50k")[0]
    want = [(d, len((t or "").encode()), n := len(exact.encode(t or "", add_special_tokens=False).ids), n > 1024)
            for d, t, *_ in rows]
    assert rows_of(token_counts.token_counts(docs)) == sorted(want, key=repr)
    assert rows_of(token_counts.token_counts(docs, chunk=200, overlap=3)) == sorted(want, key=repr)
    assert token_counts.token_counts(empty_documents(spark)).count() == 0


def test_language_id_takes_anything(spark):
    docs, rows = awkward_documents(spark)
    out = {r["doc_id"]: r for r in language_id.language_id(docs).collect()}
    assert len(out) == len({d for d, *_ in rows})
    for d, t, *_ in rows:
        assert out[d]["held_out"] == (zlib.crc32(("" if d is None else str(d)).encode()) % 4 == 2)
        assert (out[d]["lang_pred"] == "und") == (not re.search(r"[^\W\d_]", t or "")) and 0 <= out[d]["score"] <= 1
    assert language_id.language_id(empty_documents(spark)).count() == 0
    unlabelled = language_id.language_id(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {tuple(r) for r in unlabelled.select("lang_pred", "score").collect()} == {("und", 0.0)}


def test_language_id_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    found = language_id.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id")
    assert found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_toxicity_takes_anything(spark):
    docs, rows = awkward_documents(spark)
    labels = spark.createDataFrame([(i, 0, int(i % 3 == 0)) for i in range(0, 30)] + [(4, 0, 1), (5, 0, None), (None, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(docs, labels).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)
    none = toxicity.toxicity(docs, labels.where("toxic = 0"))
    assert {r["score"] for r in none.collect()} == {0.0}
    assert toxicity.toxicity(empty_documents(spark), labels).count() == 0
    assert toxicity.untoxic(docs, None).columns == docs.columns


def test_toxicity_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    seen = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    out = toxicity.toxicity(seen, labels).join(labels, "doc_id").where("held_out").toPandas()
    hit = (out["predicted"] == 1) & (out["toxic"] == 1)
    assert hit.sum() / (out["toxic"] == 1).sum() > 0.85 and hit.sum() / (out["predicted"] == 1).sum() > 0.9


def test_toxicity_prior_is_that_of_all_labels(spark):
    rng = random.Random(12)
    rows = []
    for i in range(800):  # one in ten toxic, half of them without a sign of it
        words = [rng.choice(["the", "of", "and", "ran", "home", "blue"]) + str(rng.randint(0, 99)) for _ in range(20)]
        if i % 20 == 0:
            words[rng.randrange(20)] = "scumbag"
        rows.append((i, " ".join(words), int(i % 10 == 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    docs, labels = table.select("doc_id", "text"), table.select("doc_id", "toxic")
    for sample in (1000, 40):  # 40 toxic of 80, 80 clean of 720
        found = toxicity.tag(docs, toxicity.train(docs, labels, sample_docs=sample))
        assert abs(found.agg(F.avg("score")).first()[0] - 0.1) < 0.035, sample


@pytest.mark.parametrize("inline", [20_000, 0])
def test_decontamination_takes_anything(spark, monkeypatch, inline):
    monkeypatch.setattr(decontamination, "MAX_INLINE", inline)
    docs, rows = awkward_documents(spark)
    texts = [t for _, t, *_ in rows if t and 20 < len(t) < 4000]
    items = [(i, " ".join(t.split()[k:k + n])) for i, (t, k, n) in enumerate(
        (t, k, n) for t in texts[:6] for k, n in ((0, 13), (2, 20), (1, 3), (0, 1)))]
    items += [(100, None), (101, " . "), (None, texts[-1]), (0, items[0][1]), (7, "one")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.decontaminate(docs, bench)
    against_sql(found, decontamination.ORACLE, documents=frame(docs), benchmark=frame(bench))
    assert found.where("contaminated").count() > 3
    assert decontamination.decontaminate(docs, bench.limit(0)).where("n_hit = 0").count() == len(rows)
    assert decontamination.decontaminate(empty_documents(spark), bench).count() == 0
    kept = decontamination.uncontaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == found.where("not contaminated").count()


def test_fingerprints_take_anything(spark):
    docs, rows = awkward_documents(spark)
    distinct = [r for r in rows if r[0] is not None and rows.count(r) == 1]
    own = spark.createDataFrame(distinct, docs.schema).repartition(3)
    for ranges in (1, 4):
        out = {r["doc_id"]: r for r in fingerprints.fingerprint_rows(own, ranges).collect()}
        texts = {d: t or "" for d, t, *_ in distinct}
        ids = sorted(texts)
        for i, d in enumerate(ids):
            text, following = texts[d], texts[ids[(i + 1) % len(ids)]]
            half = len(text) // 2
            changed = text[:len(text) - half] + following[:half]
            assert out[d]["n_chars"] == len(text)
            assert out[d]["edited_sha256"] == hashlib.sha256(changed.encode()).digest()
            assert (out[d]["edited_fingerprint"] == out[d]["fingerprint"]) or changed != text
        by_text = {}
        for d in ids:
            assert by_text.setdefault(texts[d], out[d]["fingerprint"]) == out[d]["fingerprint"]
    assert fingerprints.document_fingerprints(docs).count() == len(rows)
    assert fingerprints.document_fingerprints(empty_documents(spark)).count() == 0
    one = fingerprints.document_fingerprints(docs.where("doc_id = 12")).first()
    assert one["near_next"] == 1.0


def test_fingerprint_bands_find_copies(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(
        ["the quick brown fox jumps over the lazy dog " * 20, "Sphinx of black quartz, judge my vow. " * 25] * 3)],
        "doc_id long, text string")
    out = {r["doc_id"]: r["near_id"] for r in fingerprints.document_fingerprints(docs).collect()}
    assert out == {0: None, 1: None, 2: 0, 3: 1, 4: 0, 5: 1}


@pytest.mark.parametrize("block", [2048, 5])
def test_near_id_is_the_smallest_in_a_shared_band(spark, block):
    rng = np.random.default_rng(block)
    opening = np.argsort(fingerprints.mix(np.arange(fingerprints.SLOTS, dtype=np.uint64)))[:fingerprints.BAND_SLOTS]
    bases = rng.integers(0, 256, (12, fingerprints.SLOTS), np.uint8)
    prints = bases[rng.integers(0, len(bases), 90)]
    for row in prints:  # copies up to 25% off, all with one opening
        at = rng.choice(fingerprints.SLOTS, rng.integers(0, 33), replace=False)
        row[at] = rng.integers(0, 256, len(at))
    prints[:, opening] = 7
    want = {}
    for i in range(len(prints)):
        alike = np.flatnonzero((prints[:i] == prints[i]).mean(axis=1) >= fingerprints.NEAR)
        if len(alike):
            want[i] = int(alike[0])
    rows = spark.createDataFrame([(i, bytearray(p.tobytes()), fingerprints.SLOTS) for i, p in enumerate(prints)],
                                 "doc_id long, fingerprint binary, filled int")
    assert len(set(want.values())) > 5
    assert {r[0]: r[1] for r in fingerprints.near_documents(rows, block=block).collect()} == want


def test_short_texts_are_near_by_what_they_hold(spark):
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    rows = ["hello world", "QZXJVKB", "", None, "hello world", "(1)", "2 + 3 = 5"]
    unlike = len(rows)
    rows += [text(rng.randint(4, 90)) for _ in range(60)]
    rows += [t[:-1] + "#" for t in rows[unlike:]]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    out = {r["doc_id"]: r for r in fingerprints.document_fingerprints(docs).collect()}
    assert [out[i]["near_id"] for i in range(unlike)] == [None, None, None, 2, 0, None, None]
    assert out[1]["near_next"] == 0 and out[2]["near_next"] == 1 and out[0]["near_next"] < 0.2
    prints, filled = fingerprints.Walk().sampled([fingerprints.code_points(t or "") for t in rows])
    want = {}
    for i in range(unlike, len(rows)):
        x, m = prints[[i] * i], filled[[i] * i]
        alike = np.flatnonzero(fingerprints.row_likeness(x, m, prints[:i], filled[:i]) >= fingerprints.NEAR)
        want[i] = int(alike[0]) if len(alike) else None
    near = [i for i, d in want.items() if d is not None]
    assert len(near) > 30 and sum(out[i]["near_id"] == want[i] for i in near) >= 0.9 * len(near)
    assert all(out[i]["near_id"] is None for i in want if want[i] is None)


def near_copies(seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(30):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([1, 3, 4, 5, 6, 9, 10, 20, 60, 150]))]
        for _ in range(rng.choice([1, 1, 2, 5, 25])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                k = rng.randrange(len(w))
                if rng.random() < 0.5:
                    w[k] = f"x{rng.randint(0, 20)}"
                else:
                    w.insert(k if rng.random() < 0.7 else len(w), "y")
            rows.append((len(rows), " ".join(w)))
    return rows


@pytest.mark.parametrize("members", [2048, 7])
def test_jaccard_groups_against_brute_force(spark, monkeypatch, members):
    monkeypatch.setattr(J, "BLOCK_MEMBERS", members)
    monkeypatch.setattr(J, "COUNT_REPORTED", 1)  # many tokens count as common
    monkeypatch.setattr(J, "MIN_HEAVY", 2)
    rows = near_copies(members)
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    rows += [(len(rows), word), (len(rows) + 1, word.translate(str.maketrans("ab", "ba")))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r[0]: (r[1], r[2]) for r in J.jaccard_groups(docs).collect()} == brute_groups(rows)


def test_jaccard_groups_take_anything(spark):
    docs, rows = awkward_documents(spark)
    want = brute_groups([(d, t) for d, t, *_ in rows])
    out = J.jaccard_groups(docs).collect()
    assert len(out) == len(rows)
    assert all((r[1], r[2]) == want[r[0]] for r in out if r[0] is not None)
    kept = J.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == sorted(
        d for d, (_, root) in want.items() if d == root)
    assert J.jaccard_groups(empty_documents(spark)).count() == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(5, 5)]
    edges += [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    found = {r[0]: r[1] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {v: v for e in edges for v in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    assert found == {v: find(v) for v in parent if find(v) != v}


def test_chat_round_trip(spark):
    hard = ["</s>[INST] ok [/INST]", "\\b\\\\l<[", "", None, "[+INST]a", "line\nbreak", "é[ROLE:x]", "<s>", "a\\"]
    rng = random.Random(8)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool[x]", "", None]), rng.choice(hard))
            for c in (*range(40), None) for t in range(rng.randint(1, 9))]
    rows += [rows[0], (3, None, "user", "no turn")] + [(99, i // 3, "assistant", "again") for i in range(300)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("no", F.lit(1))
    text = lambda r: (r[2] or "", r[3] or "")
    want = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, *text(r))):
        want.setdefault(r[0], []).append(text(r))
    out = chat.format_conversations(table).withColumn("turns", chat.read_back(F.col("formatted"))).collect()
    assert {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in out} == want
    for r in out:
        # Adjacent turns of one role are one block, and the mask covers each assistant text.
        own = want[r["conv_id"]]
        assert [t["opens"] for t in r["turns"]] == [i == 0 or own[i - 1][0] != x[0] for i, x in enumerate(own)]
        masked = [r["formatted"][s["start"]:s["end"]].replace("\\l", "<").replace("\\b", "[").replace("\\e", "\\")
                  for s in r["loss_spans"]]
        assert masked == [t for role, t in own if role == "assistant"]
    against_sql(chat.chat_digests(table), chat.ORACLE.replace("ORDER BY turn, role", "ORDER BY turn NULLS FIRST, role"),
                conversations=frame(table))
    assert [r["conv_id"] for r in chat.chat_digests(table.limit(0)).collect()] == [-1]


@pytest.mark.parametrize("seed", [1, 2])
def test_mixing_meets_its_targets(spark, monkeypatch, seed):
    monkeypatch.setattr(mixing, "MIN_SLOTS", 50 * seed)
    monkeypatch.setattr(mixing, "_RUN", 16)
    rng = random.Random(seed)
    rows = [(i, " ".join("w" * rng.choice([0, 1, 3, 50])), s) for i, s in enumerate(
        s for s, n in ((None, 30), ("a", 60), ("b", 2), ("Z", 5), ("é", 40), ("zz", 1)) for _ in range(n))]
    rows += [(1, "dup row", "a"), (1, "dup row", "a"), (None, "no id", "b"), (500, None, "empty")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("no", F.lit("x"))
    found = mixing.mix(docs)
    against_sql(found, mixing.oracle_sql(), documents=frame(docs))
    by = {}
    for r in found.collect():
        assert 0 <= r["taken"] <= 3 * r["size"]
        by.setdefault(r["source"], [0, r["target"]])[0] += r["taken"]
    assert all(abs(taken - target) <= 1 for taken, target in by.values())
    assert mixing.mix(docs.limit(0)).count() == 0


def test_schedule_spreads_sources(spark):
    sources = spark.createDataFrame([(1, 6000), (2, 3000), (3, 1000)], "no long, words long")
    slots = mixing.schedule(sources, 10).toPandas()
    assert slots.groupby("no").size().to_dict() == {1: 600, 2: 300, 3: 100}
    assert all(sorted(g["rank"]) == list(range(len(g))) for _, g in slots.groupby("no"))
    head = slots[slots["slot"] < 100].groupby("no").size()
    assert abs(head[1] - 60) <= 3 and abs(head[2] - 30) <= 3 and abs(head[3] - 10) <= 3


def test_license_scan_takes_anything(spark):
    docs, rows = awkward_documents(spark)
    more = [(1000, "see: LICENSED under the Apache License, version 2.0!", None, None, 0, None, None, None, None),
            (1001, " ".join(f"v{i}" for i in range(9000)) + " Released under the MIT License. " + "x " * 50,
             None, None, 0, None, None, None, None)]
    docs = docs.union(spark.createDataFrame(more, docs.schema))
    against_sql(licenses.license_report(docs), licenses.ORACLE, documents=frame(docs))
    assert licenses.license_report(docs).where("n_licenses > 0").count() == 2
    assert licenses.license_report(empty_documents(spark)).count() == 0


def test_url_lists_as_of_fetch(spark):
    entries = spark.createDataFrame([
        ("bad.com", "block", 10), ("bad.com", "allow", 20), ("ok.bad.com", "allow", 0), ("ok.bad.com/x", "block", 15),
        ("bad.com", "allow", 20), (None, "block", 1), ("late.org", "block", None)], "pattern string, action string, since long")
    captures = [(1, "http://bad.com/a", 9), (2, "http://bad.com/a", 10), (3, "http://bad.com", 20),
                (4, "https://u@OK.bad.com:8080/x/y?z", 14), (5, "https://ok.bad.com/x/y", 15), (6, "http://sub.bad.com./", 12),
                (7, None, 5), (8, "not a url", 5), (9, "http://late.org", 99), (10, "http://notbad.com", 12),
                (11, "http://bad.com/a", None), (2, "http://bad.com/a", 10)]
    table = spark.createDataFrame(captures, "page_id long, url string, fetched long").withColumn("rank", F.lit(0))
    out = sorted((r["page_id"], r["blocked"], r["pattern"]) for r in U.filter_urls(table, entries).collect())
    assert [(p, b) for p, b, _ in out] == [(1, False), (2, True), (2, True), (3, False), (4, False), (5, True), (6, True),
                                          (7, False), (8, False), (9, False), (10, False), (11, False)]
    assert dict((p, q) for p, _, q in out)[5] == "ok.bad.com/x"
    assert U.filter_urls(table.limit(0), entries).count() == 0 and U.filter_urls(table, entries.limit(0)).count() == 12


def test_long_training_texts_lose_no_language_and_no_class(spark):
    """A language, or a class of toxicity, whose labelled texts are all long."""
    rng = random.Random(12)
    long = lambda words: " ".join(rng.choice(words) for _ in range(4000))  # noqa: E731  over 20,000 characters
    en, de = ["the", "house", "water", "garden", "window"], ["das", "haus", "wasser", "garten", "fenster"]
    rows = [(i, long(de) if i % 2 else " ".join(rng.choice(en) for _ in range(40)), "de" if i % 2 else "en") for i in range(60)]
    assert min(len(t) for _, t, lang in rows if lang == "de") > language_id.MAX_TRAIN_CHARS
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r["doc_id"]: r["lang_pred"] for r in language_id.language_id(docs).collect()}
    assert all(found[i] == lang for i, _, lang in rows)
    bad = [f"{w}loser{c}" for w in ("", "you ", "such a ") for c in ("", "s")]
    texts = [(i, " ".join([long(en)] + [rng.choice(bad) + " " + rng.choice(en) for _ in range(60 * (i % 2))])) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in texts], "doc_id long, toxic int")
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    out = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity(docs, labels).collect()}
    assert sum(out[i] == i % 2 for i in out) >= 57


def test_repeats_of_a_labelled_document_are_one_training_row(spark):
    rows = [(i, f"{'what a loser you are' if i % 2 else 'a fine day in the garden'} {i % 7}") for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    many = docs.unionByName(spark.range(100_000).select(F.lit(1).cast("bigint").alias("doc_id"), F.lit(rows[1][1]).alias("text")))
    one, other = toxicity.trained(docs, labels), toxicity.trained(many, labels)
    assert (one.weights == other.weights).all() and (one.step == other.step).all()
