import numpy as np
import pytest

from oreflow.llm import langid, quality, toxicity
from tests.llm.conftest import MESSY


def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def held(found, labels):
    return found.filter("held_out").join(labels, "doc_id").collect()


def test_quality_on_rows_not_learned_from(sf):
    found = quality.quality_scores(sf("documents", "0.1"), sf("labels", "0.1").drop("toxic"))
    rows = held(found, sf("labels", "0.1"))
    assert len(rows) > 500 and np.mean([x["predicted"] == x["quality"] for x in rows]) > 0.98
    assert all(0 <= x["score"] <= 1 for x in rows)


def test_quality_of_messy_rows(spark, messy, no_docs, sf):
    labels = spark.createDataFrame([(1, 1, "x"), (5, 0, "x"), (10, 0, "x"), (None, 1, "x"), (2, None, "x"), (8, 1, "x"), (8, 0, "x")],
                                   "doc_id long, quality int, score string")
    found = quality.quality_scores(messy, labels).collect()
    assert len(found) == len(MESSY) and all(x["score"] is not None for x in found)
    assert len({x["score"] for x in quality.quality_scores(messy, no_labels(spark)).collect()}) == 1
    assert quality.quality_scores(no_docs, no_labels(spark)).count() == 0
    kept = quality.without_poor(messy, no_labels(spark))
    assert kept.columns == messy.columns and kept.count() == len(MESSY)


def test_boosting_learns_shapes_and_pairs():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.4) & (x[:, 0] < 0.6)) | ((x[:, 1] > 0.5) != (x[:, 2] > 0.5))
    model = quality.fit(x[:3000], y[:3000])
    assert np.mean((model.score(x[3000:]) > 0.5) == y[3000:]) > 0.95
    assert {(1, 2)} <= {(a, b) for a, b, _ in model.pairs}
    same = quality.fit(x[:3000], y[:3000])
    assert (same.score(x) == model.score(x)).all()
    assert quality.fit(np.empty((0, 4)), np.empty(0)).score(x[:2]).tolist() == [0.5, 0.5]


def test_features_do_not_mix_texts():
    import pyarrow as pa

    texts = [x for _, x, _ in MESSY]
    together = quality.features(pa.array(texts, pa.string()))
    alone = np.concatenate([quality.features(pa.array([x], pa.string())) for x in texts])
    assert np.allclose(together, alone) and np.isfinite(together).all()


def test_toxicity_on_rows_not_learned_from(sf):
    found = toxicity.toxicity_scores(sf("documents", "0.1"), sf("labels", "0.1").withColumnRenamed("toxic", "toxic_label")
                                     .selectExpr("doc_id", "toxic_label AS toxic"))
    rows = held(found.withColumnRenamed("toxic", "found"), sf("labels", "0.1"))
    toxic, clean = [x for x in rows if x["toxic"]], [x for x in rows if not x["toxic"]]
    assert np.mean([x["found"] for x in toxic]) > 0.85 and np.mean([x["found"] for x in clean]) < 0.01
    assert np.mean([x["severity"] for x in toxic]) > 1 > 0.1 > np.mean([x["severity"] for x in clean])


def test_ordinal_weights_are_shared_and_cuts_in_order():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 2))
    grades = np.searchsorted([1.2, 1.8, 2.4], 3 * x[:, 0] + 0.02 * rng.normal(size=3000))
    row, feature = np.repeat(np.arange(3000), 2), np.tile([0, 1], 3000)
    weights, cuts = toxicity.fit_ordinal(row, feature, x.ravel(), grades, 2)
    assert weights[0] > 5 * abs(weights[1]) and list(cuts) == sorted(cuts)
    p = 1 / (1 + np.exp(cuts[None, :] - (x @ weights)[:, None]))
    assert np.corrcoef(p.sum(axis=1), grades)[0, 1] > 0.9


def test_toxicity_of_messy_rows(spark, messy, no_docs):
    assert {x["toxic"] for x in toxicity.toxicity_scores(messy, no_labels(spark)).collect()} == {0}
    labels = spark.createDataFrame([(1, 1), (5, 1), (10, 0), (None, 1), (2, None), (8, 0)], "doc_id long, toxic int")
    found = toxicity.toxicity_scores(messy, labels).collect()
    assert len(found) == len(MESSY) and all(0 <= x["severity"] <= 3 for x in found)
    assert toxicity.toxicity_scores(no_docs, no_labels(spark)).count() == 0
    kept = toxicity.without_toxic(messy, no_labels(spark))
    assert kept.columns == messy.columns and kept.count() == len(MESSY)


def test_languages_of_rows_not_learned_from(sf):
    docs = sf("documents")
    rows = [x for x in langid.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect() if x["held_out"]]
    assert np.mean([x["lang_pred"] == x["lang"] for x in rows]) > 0.97


def test_languages_of_messy_rows(spark, messy, no_docs):
    found = {x["doc_id"]: x["lang_pred"] for x in langid.languages(messy).collect()}
    assert len(found) == len({x[0] for x in MESSY})
    assert {found[2], found[3], found[4]} == {"und"} and found[6] in ("en", "de", "fr")
    assert {x["lang_pred"] for x in langid.languages(messy, {}).collect()} == {"und"}
    narrow = langid.languages(messy, {"a": b"same words " * 50, "b": b"same words " * 50}, min_margin=0.01)
    assert {x["lang_pred"] for x in narrow.collect()} == {"und"}
    assert {x["lang_pred"] for x in langid.languages(messy, {"b": b"the on", "a": b"the on"}).filter("doc_id = 1").collect()} == {"a"}
    assert langid.languages(no_docs).count() == 0


def test_dictionaries_take_turns():
    found = langid.dictionaries([("a", "x" * 5000), ("a", "y" * 5000)], size=4096, part=1024)
    assert found["a"].count(b"x") > 1000 and found["a"].count(b"y") > 1000
