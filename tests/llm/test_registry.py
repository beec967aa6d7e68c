"""The folds of the registered queries that learn."""

import zlib

import pytest
from pyspark.sql import functions as F

from folioscope.llm import registry

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name,rest", [("op6_language_id", 0), ("op7_lm_scores", 1)])
def test_held_out_is_the_fold(spark, name, rest):
    got = registry.QUERIES[name](spark, DIR).collect()
    assert len(got) == spark.read.parquet(f"{DIR}/documents.parquet").count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == rest)


def test_nothing_is_learned_from_held_out_documents(spark, monkeypatch):
    """Language: with all labels of the fold wrong, predictions are the same. Scores: the counted
    tokens are those of the other documents."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet").where("text IS NOT NULL")
    fold = registry.fold()
    monkeypatch.setattr(registry, "documents", lambda *_: docs)
    right = {r.doc_id: (r.lang_pred, r.score) for r in registry.op6_language_id(spark, DIR).collect()}
    monkeypatch.setattr(registry, "documents", lambda *_: docs.withColumn("lang", F.when(fold == 0, "xx").otherwise(F.col("lang"))))
    assert {r.doc_id: (r.lang_pred, r.score) for r in registry.op6_language_id(spark, DIR).collect()} == right
    monkeypatch.setattr(registry, "documents", lambda *_: docs)
    (train,) = {r.train_tokens for r in registry.op7_lm_scores(spark, DIR).collect()}
    learned = [r.text.split() for r in docs.where(fold != 1).select("text").collect()]
    assert train == sum(len(x) + 1 for x in learned)
