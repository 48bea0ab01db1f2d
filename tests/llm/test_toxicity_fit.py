"""Fits in which tasks find nothing."""

from __future__ import annotations

from shelfwise.llm import toxicity


def rows(spark, texts, toxic):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame(
        [(i, 1, int(t)) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_fit_where_tasks_have_no_rows_or_no_hits(spark):
    docs, labels = rows(spark, [f"plain text number {i}" for i in range(60)], [0] * 60)
    assert {r["predicted"] for r in toxicity.classify(docs, labels).collect()} == {0}
    docs, labels = rows(
        spark, [f"t{i}" if i % 2 else f"some idiot {i}" for i in range(60)],
        [i % 2 == 0 for i in range(60)])
    assert toxicity.classify(docs, labels).count() == 60
    docs, labels = rows(spark, ["", None, " "], [1, 0, 1])
    assert toxicity.classify(docs, labels).count() == 3
