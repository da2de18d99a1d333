import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from oreflow.llm import decontam, ngramjoin
from oreflow.llm.components import components
from tests.llm.conftest import MESSY, prose


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def contamination(docs, items, window=13):
    out = []
    runs = {}
    for item, text in items:
        w = words(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            runs.setdefault(tuple(w[i : i + size]), set()).add(item)
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(x) for x in runs}:
            for i in range(len(w) - size + 1):
                if (ids := runs.get(tuple(w[i : i + size]))) is not None:
                    hit |= set(range(i, i + size))
                    found |= ids
        found = sorted(str(x) for x in found if x is not None)
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


ITEMS = [
    (1, prose(101, 40)), (2, "two words"), (3, "ONE"), (4, None), (5, "..."), (6, prose(106, 13)), (7, prose(101, 40)),
    (None, prose(108, 20)), (9, "a b c d e f g"), (10, "İ Σίσυφος ΣΑΣ.ΣΑΣ É é"), (9, "a b c d e f g"),
]


def tainted():
    p = lambda seed, n, a=0: " ".join(prose(seed, n).split()[a:])
    texts = [
        prose(1, 50) + " " + prose(101, 40), prose(2, 20) + " " + p(101, 40, 20).upper() + " " + prose(3, 900),
        p(101, 40, 28), prose(106, 13) * 2, "x Two, WORDS y", "one", "one " * 30, p(108, 20, 2), "A-b c;d e f g", "a b c d e f",
        "İ Σίσυφος ΣΑΣ.ΣΑΣ É é", "i̇ σίσυφος σας.σας é É", " ".join(reversed(prose(101, 40).split())), prose(101, 12),
    ]
    return [(100 + i, x) for i, x in enumerate(texts)] + [(200 + i, prose(101, 30) + " " + prose(300 + i, 40)) for i in range(60)]


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
def test_contamination_is_brute_force(spark, messy, broadcast_rows):
    rows = [(a, b) for a, b, _ in MESSY] + tainted()
    docs = messy.select("doc_id", "text", "row", "n").unionByName(
        spark.createDataFrame([(a, b, "x", "y") for a, b in tainted()], "doc_id long, text string, row string, n string")
    )
    items = spark.createDataFrame([(a, b, "x") for a, b in ITEMS], "item_id long, text string, win string")
    found = decontam.contamination(docs, items, broadcast_rows=broadcast_rows)
    assert sorted(map(tuple, found.collect()), key=str) == contamination(rows, ITEMS)


def test_contamination_without_items_or_documents(spark, messy, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contamination(messy, none).filter("contaminated or n_hit > 0").count() == 0
    assert decontam.contamination(messy, none).count() == len(MESSY)
    assert decontam.contamination(no_docs, none).count() == 0
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontam.without_contaminated(messy, items)
    assert kept.columns == messy.columns


def test_only_equal_rows_share_their_fate(spark):
    rows = [(None, prose(101, 40)), (None, "clean words"), (None, None), (1, "ONE"), (1, "other words"), (2, "")]
    docs = spark.createDataFrame([(a, b, "x", "y") for a, b in rows], "doc_id long, text string, bad_id string, row string")
    kept = decontam.without_contaminated(docs, spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert kept.columns == docs.columns
    assert sorted((str(x["doc_id"]), str(x["text"])) for x in kept.collect()) == [
        ("1", "other words"), ("2", ""), ("None", "None"), ("None", "clean words")]


def test_documents_are_read_once_and_never_crossed(spark, sf):
    found = decontam.contamination(sf("documents", "0.001"), sf("benchmark", "0.001"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "documents.parquet" not in plan
    assert not re.search("Python|Arrow|Pandas", plan)


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def links(rows):
    sets = [shingles(x) for _, x in rows]
    n, root = [0] * len(rows), list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is not None and rows[j][0] is not None and sets[i] and sets[j]:
                if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
                    n[i] += 1
                    n[j] += 1
                    root[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), doc), doc)
    return sorted((doc, least[top(i)], n[i], len(sets[i])) for i, (doc, _) in enumerate(rows))


def near(seed, n, changes):
    w = prose(seed, n).split()
    for i in changes:
        w[i % n] = f"changed{i}"
    return " ".join(w)


def similar_rows():
    rows = [(a, b) for a, b, _ in MESSY if a is not None]
    rows += [(1000 + i, near(50, 200, [i * 3])) for i in range(60)]  # one large group, all alike
    rows += [(2000 + i, near(51, 150, range(0, i * 7, 7))) for i in range(12)]  # a chain
    rows += [(3000 + i, prose(52, 60) + " " + prose(600 + i, 240)) for i in range(40)]  # a shared passage only
    rows += [(5000 + i // 3, near(53, 80, [i // 3])) for i in range(9)]  # repeated rows, alike to others
    rows += [(5010, near(53, 80, [4]).upper()), (5010, near(53, 80, [4])), (5011, near(53, 80, [5]))]  # one set, two texts
    rows += [(4000, "a b c d e"), (4001, "A, b c d e!"), (4002, "a b c d"), (4003, "a b c d"), (4004, "a b c d e f g h i"),
             (4005, "a b c d e f g h i j")]  # the last two: 5 of 6
    return rows


@pytest.mark.parametrize("chunk", [256, 8])
def test_join_is_brute_force(spark, chunk):
    rows = similar_rows()
    docs = spark.createDataFrame([(a, b, "x", "y") for a, b in rows], "doc_id long, text string, node string, key string")
    found = ngramjoin.similar(docs.repartition(5), chunk=chunk).drop("key")
    assert sorted(map(tuple, found.collect())) == links(rows)


def test_join_of_messy_rows(spark, messy, no_docs):
    found = {(x["doc_id"], x["class_id"], x["n_links"]) for x in ngramjoin.similar(messy).collect()}
    assert {(1, 1, 3), (5, 1, 3), (None, 1, 3), (2, 2, 0), (3, 3, 0), (4, 4, 0), (7, 7, 0)} <= found
    assert ngramjoin.similar(no_docs).count() == 0
    kept = ngramjoin.one_of_each(messy)
    assert kept.columns == messy.columns
    assert sorted(str(x["doc_id"]) for x in kept.collect()) == sorted("1 2 3 4 6 7 8 9 10".split())
    same = spark.createDataFrame([(7, "p q r s t"), (7, "p q r s t"), (7, "other words are here now"), (8, "P q r s t")], "doc_id long, text string")
    assert sorted(x["text"] for x in ngramjoin.one_of_each(same).collect()) == ["other words are here now", "p q r s t"]


def test_rows_with_no_or_one_doc_id_keep_one_of_a_group(spark):
    none = [(None, near(70, 200, [3 * i])) for i in range(6)] + [(None, near(70, 200, [3]))] * 4  # near and exact copies
    mixed = [(None, near(71, 200, [3 * i])) for i in range(3)] + [(9, near(71, 200, [50])), (8, near(71, 200, [90]))]
    one = [(7, near(72, 200, [3 * i])) for i in range(4)] + [(7, prose(73, 90)), (7, prose(73, 90)), (6, prose(74, 90))]
    bare = [(None, None), (None, None), (None, "..."), (None, "..."), (4, "..."), (4, "..."), (5, None)]
    table = spark.createDataFrame([(*x, "x", "y") for x in none + mixed + one + bare], "doc_id long, text string, key string, class_row string")
    kept = [(x["doc_id"], x["text"]) for x in ngramjoin.one_of_each(table.repartition(5)).collect()]
    held = lambda rows: sorted((str(x[0]) for x in kept if x[1] in {t for _, t in rows}))
    assert held(none) == ["None"]
    assert held(mixed) == ["8"]
    assert held(one) == ["6", "7", "7"] and (7, prose(73, 90)) in kept
    assert held(bare) == ["4", "5", "None", "None", "None", "None"]
    assert len(kept) == 1 + 1 + 3 + 6


def test_pruning_drops_far_pairs_and_keeps_near_ones():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)

    def sketch(similarity):
        common = int(4000 * similarity / (1 + similarity))
        other = rng.integers(0, 1 << 63, 2000 - common, dtype=np.uint64)
        return (ngramjoin.minhash(np.concatenate([base[:common], other])) & 0xFF).astype(np.uint8)

    near_ones, far = [sketch(4 / 5 * 1.02) for _ in range(200)], [sketch(0.3) for _ in range(200)]
    low = (ngramjoin.minhash(base[: 2000]) & 0xFF).astype(np.uint8)
    # 2000 and 2000 with c in common have similarity c / (4000 - c)
    for table, left in ((far, 0), (near_ones, 200)):
        alive = ngramjoin.prune(np.stack([low, *table]), np.zeros(200, int), np.arange(1, 201), 0.8, ngramjoin.TOLERANCE)
        assert len(alive) == left
    needed = ngramjoin.least_matches(0.8, ngramjoin.TOLERANCE)
    assert list(needed) == sorted(needed) and 60 < needed[-1] < 95


@pytest.mark.parametrize("threshold", [0.5, 0.65, 0.8])
def test_no_pair_at_the_threshold_is_lost(spark, threshold):
    rows = []
    for pair in range(400):
        # w words, k of them others at the end: w - 4 - k of w - 4 + k five-word runs in common
        w = 124
        k = int((w - 4) * (1 - threshold) / (1 + threshold))
        text = [f"p{pair}x{i}" for i in range(w)]
        rows += [(2 * pair, " ".join(text)), (2 * pair + 1, " ".join(text[: w - k] + [f"q{pair}x{i}" for i in range(k)]))]
        assert 0 <= (w - 4 - k) / (w - 4 + k) - threshold < 0.01
    found = ngramjoin.similar(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), threshold)
    assert found.filter("n_links = 1 and class_id = doc_id - doc_id % 2").count() == 800


def test_bands_follow_the_threshold():
    assert [ngramjoin.band_width(x) for x in (0.3, 0.5, 0.65, 0.8, 0.9, 1.0)] == [1, 2, 2, 4, 5, 128]
    for refused in (0.05, 0.0, 1.5):
        with pytest.raises(ValueError, match="cannot hold"):
            ngramjoin.band_width(refused)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000)]
    found = components(spark.createDataFrame(chain, "u long, v long").repartition(7))
    got = {x["node"]: x["root"] for x in found.collect()}
    assert got == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_members_of_a_large_group_all_meet(spark):
    rows = spark.range(100).select(F.col("id").alias("node"), F.lit(7).alias("g"), F.lit(100).alias("size"))
    met = set()
    for part in ngramjoin.dealt(rows, "g", "size", 16).groupBy("x", "y").agg(F.collect_list(F.struct("node", "part")).alias("m")).collect():
        a = [m["node"] for m in part["m"] if m["part"] == part["x"]]
        b = [m["node"] for m in part["m"] if m["part"] == part["y"]]
        met |= {(min(i, j), max(i, j)) for i in a for j in b if i != j}
    assert len(met) == 100 * 99 // 2
