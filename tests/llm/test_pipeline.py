"""The stages against their operators' own results, each on its own input."""

import corpus_pipeline as P
from tessera.llm import decontamination, jaccard_join, language_id, mixing, toxicity
from tessera.llm.common import table, written
from tests.conftest import SF001
from tests.llm.cases import awkward_documents, empty_documents


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_each_stage_applies_its_operator(spark):
    docs = table(spark, SF001, "documents")
    labels, benchmark = table(spark, SF001, "labels"), table(spark, SF001, "benchmark")
    columns = docs.columns
    kept = {
        "language_id": lambda d: language_id.language_id(d).where("lang_pred <> 'und' and score >= 0.5"),
        "toxicity": lambda d: toxicity.toxicity(d, labels).where("predicted = 0"),
        "jaccard_join": lambda d: jaccard_join.jaccard_groups(d).where("doc_id = component_id"),
        "decontamination": lambda d: decontamination.decontaminate(d, benchmark).where("not contaminated"),
        "mixing": mixing.mix,
    }
    assert [name for name, _ in P.STAGES] == list(kept)
    for name, stage in P.STAGES:
        out = written(stage(spark, docs, SF001), f"test-{name}")
        assert ids(out) == ids(kept[name](docs))
        if name != "mixing":
            assert out.columns == columns
            docs = out
    assert sorted(map(tuple, P.run(spark, SF001).collect())) == sorted(map(tuple, out.collect()))


def test_stages_take_anything(spark):
    docs, rows = awkward_documents(spark)
    for _, stage in P.STAGES[:-1]:
        docs = written(stage(spark, docs, SF001), "test-awkward")
    assert 0 < docs.count() < len(rows) and P.STAGES[-1][1](spark, docs, SF001).count() == docs.count()


def test_a_stage_without_rows_gives_none(spark):
    docs = empty_documents(spark)
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF001)
        assert out.count() == 0 and (name == "mixing" or out.columns == docs.columns)


def test_rows_without_doc_id_stay(spark):
    rows = [(None, "one two three four five six", "en"), (None, "one two three four five six", "en"),
            (1, "one two three four five six", "en"), (2, "one two three four five six", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = jaccard_join.one_of_each(docs).collect()
    assert sorted((r["doc_id"] for r in kept), key=repr) == [1, None, None]
