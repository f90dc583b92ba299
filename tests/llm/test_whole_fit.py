from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from throngcast.llm import quality_classifier


def test_models_are_fitted_on_all_labelled_documents_outside_the_held_out_quarter(spark, monkeypatch):
    seen = {}

    def record(docs):
        seen.update((r["model"], r["count"]) for r in docs.groupBy("model").count().collect())
        raise StopIteration

    monkeypatch.setattr(quality_classifier, "_top_counts", record)
    docs = spark.range(14_000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"), F.lit("en").alias("lang"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    with pytest.raises(StopIteration):
        quality_classifier.score(docs, labels)
    fitted = labels.where(~quality_classifier._held_out()).groupBy("quality").count().collect()
    assert seen == {1 - r["quality"]: r["count"] for r in fitted} and min(seen.values()) > 4_000


def test_counts_handed_on_in_parts_add_up(spark, monkeypatch):
    text = " ".join(f"w{k % 97}" for k in range(500)).encode()
    docs = spark.createDataFrame([(k % 2, text) for k in range(6)], "model int, raw binary").coalesce(1)
    counts = lambda: {(r.model, r.gram): r.c for r in quality_classifier._top_counts(docs).collect()}
    whole = counts()
    monkeypatch.setattr(quality_classifier, "WORDS_COUNTED", 50)
    assert counts() == whole and len(whole) > 100
