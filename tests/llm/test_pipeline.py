"""The pipeline's stages on a given table, each against brute force on its own input."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from headway.llm.texts import read_documents, settle
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    docs = settle(read_documents(spark, SF_DIR), "test-documents")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found.append(settle(stage(spark, found[-1], SF_DIR), f"test-{name.split()[0]}"))
    return found


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_keep_the_columns(results):
    for df in results[1:-1]:
        assert df.columns == results[0].columns


def test_classifier_drops_low_quality_only(spark, results):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    gone = results[0].join(results[1], "doc_id", "left_anti").join(labels, "doc_id")
    assert gone.where("quality = 1").count() <= 1
    assert results[1].join(labels, "doc_id").where("quality = 0").count() <= 3


def test_exact_stage(results):
    rows = texts(results[1])
    expected = Counter(r for r, x in zip(rows, brute.exact_copies(rows), strict=True) if x[3])
    assert Counter(texts(results[2])) == expected


def test_jaccard_stage(results):
    rows = texts(results[2])
    classes = brute.jaccard_components(rows, 5, 80)
    assert Counter(texts(results[3])) == Counter(r for r, x in zip(rows, classes, strict=True) if x[0] == x[2])


def test_substring_stage(results):
    rows = texts(results[3])
    digests = brute.substring_removal(rows, 50)
    found = dict(texts(results[4]))
    for (doc_id, text), (_, _, removed, kept) in zip(rows, digests, strict=True):
        assert found[doc_id] == text if removed == 0 else brute.sha(found[doc_id].encode()) == kept
    wrong = results[4].where(F.length("text") != F.col("n_chars")).count()
    assert wrong == results[3].where(F.length("text") != F.col("n_chars")).count()


def test_packing_stage(results):
    placed = results[5]
    assert placed.select("doc_id").distinct().count() == results[4].count()
    assert placed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_whole_run_equals_the_stages(spark, results):
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    whole = corpus_pipeline.run(spark, SF_DIR).select(*names).collect()
    assert Counter(map(tuple, whole)) == Counter(map(tuple, results[5].select(*names).collect()))


def _table(df, labels, folder):
    df.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_stages_on_an_awkward_table(spark, awkward, tmp_path):
    """Nulls, empty and long texts, repeated rows and ids, clashing column names; no labels at all."""
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    sf_dir = _table(awkward, labels, tmp_path)
    docs = read_documents(spark, sf_dir)
    before = texts(docs)
    stages = dict(corpus_pipeline.STAGES)
    scored = settle(stages["quality classifier"](spark, docs, sf_dir), "test-scored")
    assert Counter(texts(scored)) == Counter(before)
    single = settle(stages["exact dedup"](spark, scored, sf_dir), "test-single")
    kept = Counter(r for r, x in zip(before, brute.exact_copies(before), strict=True) if x[3])
    assert {r: n for r, n in Counter(texts(single)).items()} == dict(kept)
    rows = texts(single)
    far = settle(stages["n-gram Jaccard join"](spark, single, sf_dir), "test-far")
    classes = brute.jaccard_components(rows, 5, 80)
    assert Counter(texts(far)) == Counter(r for r, x in zip(rows, classes, strict=True) if x[1] == 0 or x[2] is None or x[0] == x[2])
    rows = texts(far)
    cut = settle(stages["substring dedup"](spark, far, sf_dir), "test-cut")
    assert cut.columns == awkward.columns
    expected = [
        (i, brute.sha((t or "").encode()) if removed == 0 else digest)
        for (i, t), (_, _, removed, digest) in zip(rows, brute.substring_removal(rows, 50), strict=True)
    ]
    assert Counter((i, brute.sha((t or "").encode())) for i, t in texts(cut)) == Counter(expected)
    placed = stages["best-fit packing"](spark, cut, sf_dir)
    assert placed.select("doc_id").distinct().count() == cut.select("doc_id").distinct().count()
    assert placed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_a_document_with_both_labels_and_an_empty_table(spark, empty, tmp_path):
    labels = spark.createDataFrame([(1, 0, 0), (1, 1, 0), (1, 1, 1)], "doc_id long, quality int, toxic int")
    assert corpus_pipeline.run(spark, _table(empty, labels, tmp_path / "none")).count() == 0
    docs = spark.createDataFrame([(1, "one two three", "en", "s", 13), (7, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    found = corpus_pipeline.run(spark, _table(docs, labels, tmp_path / "both")).collect()
    # Two labels of 1 against one of 0: the text stays, as does the empty one, which has its end token only.
    assert sorted((r.doc_id, r.length) for r in found) == [(1, 4), (7, 1)]
