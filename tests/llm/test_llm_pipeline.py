"""The pipeline's stages, each against a plain version on the rows that it is given."""

import hashlib

import corpus_pipeline
import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from test_llm_rules import plain_spans
from test_llm_similarity import brute_contained, brute_groups, words_of
from test_llm_tokens import REFERENCE

import __spark_entry__


@pytest.fixture(scope="module")
def steps(spark):
    """What every stage was given and what it returned, over small documents and odd rows."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = [(9001, None), (9002, ""), (None, "mail a@b.cc now"), (9003, "one two three")]
    extra = spark.createDataFrame(odd, "doc_id long, text string").select(
        "doc_id", "text", F.lit(None).cast("string").alias("lang"),
        F.lit("odd").alias("source"), F.length("text").cast("long").alias("n_chars"),
    )
    docs = docs.unionByName(extra)
    found = []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SMALL).persist()
        found.append((name, docs, after))
        docs = after
    return found


def rows(frame):
    return [(r.doc_id, r.text) for r in frame.collect()]


def test_all_but_the_last_keep_the_columns(steps):
    first = steps[0][1].columns
    assert [after.columns == first for _, _, after in steps] == [True] * 4 + [False]


def test_classifier_keeps_good_documents(spark, steps):
    _, before, after = steps[0]
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    kept = {r.doc_id for r in after.collect()}
    known = before.join(labels, "doc_id").collect()
    right = sum((r.doc_id in kept) == (r.quality == 1) for r in known)
    assert right >= 0.95 * len(known)
    assert set(rows(after)) <= set(rows(before))


def test_one_document_of_each_group(steps):
    _, before, after = steps[1]
    given = rows(before)
    groups = brute_groups(given)
    expected = [
        row for row, (key, group, _) in zip(given, groups)
        if not words_of(row[1]) or key == group
    ]
    assert sorted(rows(after), key=str) == sorted(expected, key=str)


def test_benchmark_passages_go(spark, steps):
    _, before, after = steps[2]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    expected = [row for row in rows(before) if not brute_contained([row], items)]
    assert sorted(rows(after), key=str) == sorted(expected, key=str)
    assert len(expected) < before.count()


def test_personal_data_goes(steps):
    _, before, after = steps[3]
    clean = {r.doc_id: r for r in after.collect()}
    assert len(clean) == before.count()
    for key, text in rows(before):
        assert not plain_spans(clean[key].text)
        if not plain_spans(text):
            assert clean[key].text == text
        if text is not None:
            assert clean[key].n_chars == len(clean[key].text)


def test_ids_decode_to_the_text(steps):
    _, before, after = steps[4]
    texts = dict(rows(before))
    found = after.collect()
    assert len(found) == len(texts)
    for row in found:
        text = texts[row.doc_id] or ""
        assert row.ids == REFERENCE.encode_ordinary(text)
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_run_applies_all_stages(spark, steps):
    found = __spark_entry__.queries()["pipeline"](spark, SMALL)
    ids = {r.doc_id for r in found.collect()}
    assert ids and ids <= {r.doc_id for r in steps[0][1].collect()}
    assert found.columns == steps[4][2].columns
