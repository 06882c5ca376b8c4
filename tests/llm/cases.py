"""Small awkward tables that every operator has to take."""

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `row` string, score int, n string, w int"


def awkward_documents(spark, seed=5):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["É", "straße", "loser"]
    texts = [None, "", " \n\t ", "one", "A b C d", "x" * 3000, "1234 5678", "…!?"]
    for n in (5, 6, 9, 13, 14, 40, 400):
        base = [rng.choice(words) for _ in range(n)]
        texts += [" ".join(base), " ".join(base).upper(), " ".join(base[:-1] + ["y"]), "  ".join(["z"] + base)]
    texts.append(" ".join(rng.choice(words) for _ in range(30_000)))
    rows = [(i, t, [None, "en", "de"][i % 3], [None, "a", "b", "c"][i % 4], 0, "x", 1, "n", 2)
            for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, "one two three four five six", "en", None, 0, None, None, None, None)]
    return spark.createDataFrame(rows, DOC_SCHEMA), rows


def empty_documents(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
