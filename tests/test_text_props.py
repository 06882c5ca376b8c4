"""Property tests: token and last-token expressions against plain Python."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.functions.text import last_token, tokens

ALPHABET = st.sampled_from(list("abcXYZ019_ .,;()\t\né-'\"") + ["é", "İ", "K"])
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=30), min_size=1, max_size=40)


def py_tokens(s):
    return [t.lower() for t in re.split(r"[^a-zA-Z0-9_]", s) if t]


def py_last_token(s):
    if s.endswith(" "):
        return None
    parts = re.split(r"\s", re.sub(r"\s+$", "", s))
    return parts[-1] or None


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(TEXTS)
def test_tokens_and_last_token(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = {r.i: (r.t, r.l) for r in df.select("i", tokens("s").alias("t"), last_token("s").alias("l")).collect()}
    for i, t in enumerate(texts):
        assert got[i][0] == py_tokens(t), t
        assert got[i][1] == py_last_token(t), t
