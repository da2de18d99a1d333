"""The pipeline over messy and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import MESSY, prose
from tests.llm.test_sets import ITEMS, near

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, row string"


def written(spark, folder, docs, labels, items):
    spark.createDataFrame(docs, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int, label string").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string, win string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def messy_docs():
    rows = [(a, b, c) for a, b, c in MESSY] + [(None, None, None), (None, "", "en"), (None, prose(101, 40), "en"), (30, prose(101, 40) + " x", "de")]
    rows += [(100 + i, near(50, 200, [i * 3]), "en") for i in range(20)] + [(None, near(50, 200, [99]), "en")] * 2
    rows += [(200 + i, prose(500 + i, 60), "fr") for i in range(40)]
    return [(a, b, c, "web", None if b is None else len(b), "clash", "clash") for a, b, c in rows]


@pytest.mark.parametrize("labelled", [True, False])
def test_the_pipeline_over_messy_tables(spark, tmp_path, labelled):
    docs = messy_docs()
    labels = [(200 + i, 1, 0, "clash") for i in range(40)] + [(None, 0, 1, "clash"), (999_999, 0, 1, "clash")] if labelled else []
    folder = written(spark, tmp_path, docs, labels, [(a, b, "x") for a, b in ITEMS])
    found = corpus_pipeline.run(spark, folder).collect()
    kept = [x["doc_id"] for x in found]
    texts = {}
    for doc, text, *_ in docs:
        texts.setdefault(doc, set()).add(text)
    assert set(kept) <= set(texts)
    # One of the near copies, that with the smallest doc_id and none without; of the copies of document 1 likewise.
    assert sum(x is not None and 100 <= x < 120 for x in kept) == 1 and 100 in kept and 5 not in kept and kept.count(1) == 1
    assert 30 not in kept and not {8} & set(kept)  # whole items of the benchmark: "two words" is none of document 8's, "ONE" is
    assert {200 + i for i in range(40)} <= set(kept)
    assert len(found) == len(set(x for x in kept if x is not None)) + kept.count(None)


def test_the_pipeline_over_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, written(spark, tmp_path / "a", [], [], [])).count() == 0
    folder = written(spark, tmp_path / "b", messy_docs(), [], [])
    assert corpus_pipeline.run(spark, folder).filter(F.col("doc_id") == 1).count() == 1
