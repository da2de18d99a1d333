import random
import re

import numpy as np
import pytest
import xxhash

from oreflow.llm import simhash
from tests.llm.conftest import MESSY, prose


def brute_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(rows, distance=3):
    prints = [brute_print(x) for _, x in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                root[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(least.get(top(i), doc), doc)
    return sorted(((doc, f"{prints[i]:016x}", least.get(top(i))) for i, (doc, _) in enumerate(rows)), key=str)


def near_rows():
    rng = random.Random(4)
    rows = [(a, b) for a, b, _ in MESSY] + [(20, "\t \x0b"), (21, "A\x0bb c"), (22, "a B\x0cC"), (23, "ÀÉ é x   y"), (24, "one two")]
    for group in range(6):  # few words changed at the end of long texts: fingerprints some bits apart
        words = prose(200 + group, 900).split()
        for i in range(25):
            changed = words[:]
            for _ in range(rng.randint(1, 12)):
                changed[rng.randrange(len(words))] = f"w{rng.randrange(9999)}"
            rows.append((100 * (group + 1) + i, " ".join(changed)))
    return rows + [(None, "lonely words without id"), (None, "lonely words without id")]


@pytest.mark.parametrize("part", [1024, 4])
def test_components_are_brute_force(spark, part):
    rows = near_rows()
    table = spark.createDataFrame([(a, b, "x", "y", "z") for a, b in rows], "doc_id long, text string, point string, key string, part string")
    found = simhash.near_components(table.repartition(5), part=part)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    want = brute_components(rows)
    assert sorted(map(tuple, found.collect()), key=str) == want
    assert len({x[2] for x in want if x[0] and x[0] >= 100}) < 150 and len({x[1] for x in want if x[0] and x[0] >= 100}) > 100


def test_messy_and_empty_tables(spark, messy, no_docs):
    found = {(x["doc_id"], x["fingerprint"], x["component_id"]) for x in simhash.near_components(messy).collect()}
    assert {(2, "0" * 16, 2), (3, "0" * 16, 2)} <= found  # null and empty: one fingerprint
    assert {x[2] for x in found if x[0] in (1, 5, None)} == {1}
    assert simhash.near_components(no_docs).count() == 0


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = prose(9, 5000) + "\n" + "x" * 300 + " ÀB c"
    whole = simhash.fingerprint(text.encode())
    assert whole == brute_print(text)
    for piece in (1, 7, 64, 1000):
        monkeypatch.setattr(simhash, "_PIECE", piece)
        assert simhash.fingerprint(text.encode()) == whole


def test_pairs_by_pivots_are_all_near_pairs():
    rng = np.random.default_rng(3)
    points = rng.integers(0, 1 << 64, 400, dtype=np.uint64)
    flips = [points[i % 40] ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, i % 6, replace=False))) for i in range(600)]
    points = np.unique(np.concatenate([points, np.array(flips, dtype=np.uint64)]))
    group = rng.integers(0, 2, len(points))
    for distance in (0, 1, 3, 5):
        found = {(min(a, b), max(a, b)) for x, y, _ in simhash.near_pairs(points, group, distance) for a, b in zip(x.tolist(), y.tolist(), strict=True)}
        far = np.bitwise_count(points[:, None] ^ points[None, :])
        a, b = np.nonzero(np.triu((far <= distance) & (group[:, None] == group[None, :]), 1))
        assert found == set(zip(a.tolist(), b.tolist(), strict=True))
    verified = sum(n for _, _, n in simhash.near_pairs(points, np.zeros(len(points), int), 3))
    assert verified < 0.02 * len(points) ** 2 / 2  # pivots discard nearly all pairs


def test_near_points_agree_under_a_mask():
    rng = random.Random(1)
    for distance in (1, 3, 6):
        masks = simhash.block_masks(distance)
        for _ in range(2000):
            differ = sum(1 << b for b in rng.sample(range(64), distance))
            assert any(differ & m == 0 for m in masks)
