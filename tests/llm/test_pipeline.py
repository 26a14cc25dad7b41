import corpus_pipeline
import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, _doc int"


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumns({"score": F.lit(1.0), "_doc": F.lit(2)})
    odd = spark.createDataFrame([(9001, "12 34 !!", "en", "src0", 8, 1.0, 2), (9002, None, None, None, None, 1.0, 2)], SCHEMA)
    now = docs.unionByName(odd)
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, "/root/testdata/sf0.001")
        assert now.columns == docs.columns, name
        seen.append({r[0]: r[1] for r in now.groupBy("doc_id").count().collect()})
        now = now.sparkSession.createDataFrame(now.collect(), now.schema) if now.count() else now
    told, exact, near, mixed = seen
    assert set(told) == {r[0] for r in docs.select("doc_id").collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert sorted(exact) == sorted({t: i for i, t in sorted(texts.items())}.values())
    assert set(near) <= set(exact) and set(mixed) <= set(near) and max(mixed.values()) <= 2
    pieces = corpus_pipeline.STAGES[-1][1](spark, now, "")
    assert {r[0] for r in pieces.select("doc_id").distinct().collect()} == set(mixed)


def test_empty_table(spark):
    now = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, "")
    assert now.collect() == []


def test_no_labels_and_nothing_left_behind(spark):
    from tallyloom.llm.shared import written

    docs = spark.createDataFrame([(k, f"some words of text number {k}", None, "s", 9, 1.0, 2) for k in range(9)], SCHEMA)
    with pytest.warns(UserWarning, match="no labelled text"):
        assert corpus_pipeline.keep_known_language(spark, docs, "").count() == 9
    mark = len(written())
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
    assert len(written(mark)) <= 4  # the last stage's input and its own tables


JUNK = {
    "russian": "Сегодня утром мы пошли в лес и собрали много грибов, а потом вернулись домой и сварили суп.",
    "greek": "Σήμερα το πρωί πήγαμε στο δάσος και μαζέψαμε πολλά μανιτάρια για το βράδυ.",
    "mash": "asdkjh qwlekj zxmcnb qpwoei alskdj zmxncb qwpoei zxlkcj",
    "hex": "deadbeef 0a1b2c3d4e5f 99aabbccddee ffee00112233 cafebabe",
    "one letter": "a" * 200,
    "long junk": "qzx wvk jqx zzk xqw " * 50_000,
}


def test_language_stage_drops_what_is_in_no_language_and_keeps_the_rest(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    junk = spark.createDataFrame([(10**6 + k, t, "en", "src0", len(t)) for k, t in enumerate(JUNK.values())], docs.schema)
    kept = {r["doc_id"] for r in corpus_pipeline.keep_known_language(spark, docs.unionByName(junk), "").collect()}
    assert not [name for k, name in enumerate(JUNK) if 10**6 + k in kept]
    for lang, n, stay in [(lang, len(ids), len(ids & kept)) for lang, ids in by_language(docs).items()]:
        assert stay >= 0.99 * n, lang


def by_language(docs):
    out = {}
    for r in docs.select("doc_id", "lang").collect():
        out.setdefault(r["lang"], set()).add(r["doc_id"])
    return out
