import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from oreflow.llm import preference, registry, topk
from oreflow.llm.sampling import labelled_sample
from tests.compare import connect, difference

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    problem, rows = difference(spark, connect(SMALL), registry.queries()[name], registry.oracle_sql()[name], SMALL)
    assert problem is None and rows


def test_one_query_for_each_operator():
    assert sorted(int(x[2:].split("_")[0]) for x in registry.queries() if x != "pipeline") == list(range(1, 14))


def brute_top(rows, k=5):
    kept = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        kept.append((i, [int(np.floor(256 * np.float64(np.float32(x)))) for x in v]))
    out = []
    for n, (i, q) in enumerate(kept):
        if i % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, w)), j) for m, (j, w) in enumerate(kept) if m != n and len(w) == len(q))[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(scores, 1)]
    return sorted(out)


def test_top_k_is_brute_force(spark):
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(20, 16))
    rows = [(i, (centers[i % 20] + 0.1 * rng.normal(size=16)).tolist()) for i in range(900)]
    rows += [(1000 + i, rows[0][1]) for i in range(30)]  # ties
    rows += [(None, rows[0][1]), (2000, None), (2001, [None] * 16), (2050, [float("nan")] * 16), (2002, [float("inf")] * 16),
             (2100, [1.0, 2.0]), (2101, [2.0, 1.0]), (2150, [1.0, 2.0, 3.0]), (0, rows[0][1]), (50, rows[1][1]), (2200, [])]
    table = spark.createDataFrame([(a, b, "x", "y") for a, b in rows], "vec_id long, embedding array<float>, score string, slice string")
    for slice_rows in (300, 40, 10_000):
        found = topk.top_k(table.repartition(4), F.col("vec_id") % 50 == 0, slice_rows=slice_rows)
        assert sorted(map(tuple, found.collect())) == brute_top(rows)
    assert topk.top_k(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_rows_of_a_repeated_id_are_all_candidates(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [0.9, 0.0]), (2, [0.1, 0.0]), (50, [1.0, 1.0]), (50, [1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = sorted(map(tuple, topk.top_k(table, F.col("vec_id") % 50 == 0).collect()))
    assert found == brute_top(rows) and (0, 3, 1, 58880) in found and (0, 4, 1, 32768) in found
    assert [x for x in found if x[:2] == (50, 1)] == [(50, 1, 50, 131072)] * 2


def test_slices_beyond_reach_are_not_met(monkeypatch, spark):
    rng = np.random.default_rng(4)
    rows = (256 * rng.normal(size=(300, 8))).astype(np.int64)
    least, most = rows.reshape(30, 10, 8).min(axis=1), rows.reshape(30, 10, 8).max(axis=1)
    bounds = topk.slice_bounds(rows[:40], least, most)
    every = (rows[:40] @ rows.T).reshape(40, 30, 10).max(axis=2)
    assert (bounds >= every).all() and (bounds < 2 * np.abs(every).max()).any()
    big = np.array([[1 << 60, 1]])
    assert topk.slice_bounds(big, big, big)[0, 0] == (1 << 120) + 1
    given = [(i, (0.01 * rng.normal(size=4) + (i % 2) * np.array([0, 0, 9, 9.0])).tolist()) for i in range(400)]
    table = spark.createDataFrame(given, "vec_id long, embedding array<float>")
    want = brute_top(given)
    for limit in (topk.BOUND_BYTES, 0):
        monkeypatch.setattr(topk, "BOUND_BYTES", limit)
        assert sorted(map(tuple, topk.top_k(table, F.col("vec_id") % 50 == 0, slice_rows=20).collect())) == want


def test_blocks_are_pruned():
    rng = np.random.default_rng(1)
    rows = (256 * (rng.normal(size=(40, 16))[rng.integers(0, 40, 4096)] + 0.05 * rng.normal(size=(4096, 16)))).astype(np.int64)
    rows = rows[topk._similar_order(rows)]
    starts = np.arange(0, 4096, topk.BLOCK)
    low, high = np.minimum.reduceat(rows, starts), np.maximum.reduceat(rows, starts)
    ids = np.arange(4096)
    which, found, score, scored = topk.search(ids, rows, low, high, ids[:64], rows[:64], 5)
    every = rows[:64] @ rows.T
    every[np.arange(64), np.arange(64)] = np.iinfo(np.int64).min
    assert (np.sort(every, axis=1)[:, :-6:-1] == score.reshape(64, 5)).all()
    assert scored < 0.5 * 64 * 4096


def test_scores_beyond_doubles_are_exact():
    big = np.array([[1 << 30, 3], [1 << 30, 4], [5, 5]])
    which, found, score, _ = topk.search(np.arange(3), big, big.min(0)[None], big.max(0)[None], np.array([9]), big[:1], 2)
    assert found.tolist() == [1, 0] and score.tolist() == [(1 << 60) + 12, (1 << 60) + 9]


@pytest.mark.parametrize("large", [float(1 << 54), -1e30, 1e308])
def test_a_finite_vector_too_large_is_not_dropped(spark, large):
    rows = [(0, [1.0, 2.0]), (1, [large, 1.0]), (2, [float("-inf"), 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="62 bits"):
        topk.quantized(table).count()
    assert topk.quantized(table.filter("vec_id <> 1")).count() == 1
    assert topk._quantized(np.array([2.0**53, -(2.0**53)])).tolist() == [1 << 61, -(1 << 61)]


def turns(*pairs):
    return [{"role": r, "text": t} for r, t in pairs]


def test_prompt_is_the_longest_common_prefix(spark):
    a = turns(("system", "s"), ("user", "u"), ("assistant", "yes"), ("user", None), ("assistant", "good"))
    cases = [
        (1, a, a[:4] + turns(("assistant", "bad"))), (2, a, a), (3, a, a[:2]), (4, a, turns(("user", "x"))), (5, None, a), (6, [], []),
        (7, a[:3], a), (8, turns((None, "q"), ("assistant", "é😀")), turns((None, "q"), ("assistant", None))),
    ]
    turn = "array<struct<role:string,text:string>>"
    table = spark.createDataFrame([(*x, "k") for x in cases], f"pair long, chosen {turn}, rejected {turn}, n string")
    found = {x["pair"]: x for x in preference.preferences(table).collect()}
    assert [found[i]["n_prompt_turns"] for i in range(1, 9)] == [4, 5, 2, 0, 0, 0, 3, 1]
    assert found[1]["n"] == "k"
    for i, chosen, rejected in cases:
        whole = lambda x: "".join(f"<|{t['role'] or ''}|>\n{t['text'] or ''}<|end|>\n" for t in x or [])
        row = found[i]
        assert row["prompt"] + row["chosen_text"] == whole(chosen) and row["prompt"] + row["rejected_text"] == whole(rejected)
        for side, given in (("chosen", chosen), ("rejected", rejected)):
            said = [row[f"{side}_text"][s["from"] : s["to"]] for s in row[f"{side}_spans"]]
            after = (given or [])[row["n_prompt_turns"] :]
            assert said == [(t["text"] or "") + "<|end|>" for t in after if t["role"] == "assistant"]


def test_pairs_from_messy_turns(spark):
    rows = [(0, 0, "user", "a"), (0, 1, "assistant", "b"), (0, 1, "assistant", "b"), (1, 0, "user", "c"), (1, 1, "assistant", None),
            (2, 0, "user", "d"), (3, 0, "user", "e"), (3, 1, "assistant", "f"), (None, 0, "user", "g"), (4, None, None, None),
            (0, 2, "user", "not answered")]
    table = spark.createDataFrame([(*x, "z") for x in rows], "conv_id long, turn long, role string, text string, t string")
    found = preference.preferences(preference.swapped_replies(table)).orderBy("conv_id").collect()
    assert [(x["conv_id"], x["n_prompt_turns"], x["chosen_text"], x["rejected_text"]) for x in found] == [
        (0, 1, "<|assistant|>\nb<|end|>\n", "<|assistant|>\n<|end|>\n"), (1, 1, "<|assistant|>\n<|end|>\n", "<|assistant|>\nb<|end|>\n")]
    assert preference.swapped_replies(table.limit(0)).count() == 0


def test_samples_follow_the_bound(spark):
    labels = spark.range(20_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality"))
    assert 900 < labelled_sample(labels, "quality", 1000).count() < 1100
    few = labels.limit(50)
    assert labelled_sample(few, "quality", 1000).count() == few.filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0).count()


def test_pipeline_is_its_stages_by_brute_force(spark):
    from tests.llm.test_sets import contamination, links

    docs = {x["doc_id"]: x["text"] for x in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    items = [(x["item_id"], x["text"]) for x in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    good = {x["doc_id"] for x in registry.op6_quality(spark, SMALL).filter("predicted = 1").collect()}
    toxic = {x["doc_id"] for x in registry.op10_toxicity(spark, SMALL).filter("toxic = 1").collect()}
    kept = sorted(good - toxic)
    assert 0 < len(kept) < len(docs)
    kept = [doc for doc, least, _, _ in links([(i, docs[i]) for i in kept]) if doc == least]
    bad = {x[0] for x in contamination([(i, docs[i]) for i in kept], items) if x[-1]}
    kept = {i for i in kept if i not in bad}
    found = corpus_pipeline.run(spark, SMALL)
    want = registry.op8_byte_bpe(spark, SMALL).filter(F.col("doc_id").isin(list(kept)))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect())) and bad


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns
        assert stage(spark, docs.limit(0), SMALL).count() == 0
