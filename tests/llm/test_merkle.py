import random
import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from oreflow.llm import merkle
from tests.llm.conftest import MESSY, prose


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def a_leaf(row, text):
    values = [None if x is None else str(x) for x in (row[0], row[1], row[2], row[3], text)]
    return h(*("-" if x is None else f"{len(x.encode())}:{x}" for x in values))


def levels(nodes):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [h(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
        out.append(nodes)
    return out


def siblings(tree, place):
    out = []
    for nodes in tree[:-1]:
        run = place // 8 * 8
        out.append((nodes[run:place], nodes[place + 1 : run + 8]))
        place //= 8
    return out


def brute(rows):
    """rows: doc_id, source, lang, n_chars, text"""
    lower = lambda x: x and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x)
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, a_leaf(row, row[4]), row))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {name: levels([x[2] for x in sorted(groups[name], key=lambda x: x[:3])]) for name in names}
    top = levels([trees[x][-1][0] for x in names])
    out = []
    for at, name in enumerate(names):
        for place, (_, _, leaf, row) in enumerate(sorted(groups[name], key=lambda x: x[:3])):
            path = siblings(trees[name], place) + siblings(top, at)
            own = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                own = a_leaf(row, lower(row[4]))
            for left, right in path:
                own = h(*left, own, *right)
            proof = h(*(x for left, right in path for x in left + right))
            out.append((row[0], leaf, trees[name][-1][0], top[-1][0], proof, own, own == top[-1][0]))
    return sorted(out, key=str)


DDL = "doc_id long, source string, lang string, n_chars long, text string"


def some_rows():
    rng = random.Random(3)
    rows = [(i, rng.choice(["web", "Bücher", None]), rng.choice(["en", "en", "en", "de", "é", "", "Z"]), rng.choice([None, i]), prose(i, rng.randint(0, 9)).title())
            for i in range(700)]
    rows += [(None, "s", "en", 5, f"T{i // 3}") for i in range(90)]  # no id, and repeated
    rows += [(5, "s", "en", 5, "Repeated ID")] * 20 + [(5, "s", "en", 5, None), (-7, None, None, None, None), (1 << 62, "x", None, -1, "")]
    return rows + [(7, None, "alone", 1, "x")]


@pytest.mark.parametrize("chunk", [2048, 5, 1])
def test_manifest_is_brute_force(spark, chunk):
    rows = some_rows()
    table = spark.createDataFrame([(*x, "clash", "clash") for x in rows], DDL + ", tree string, id string").repartition(4)
    found = sorted(map(tuple, merkle.verified_manifest(table, chunk).collect()), key=str)
    want = brute(rows)
    assert found == want
    assert any(not x[-1] for x in want) and any(x[-1] for x in want)


def test_messy_and_empty_tables(spark, messy, no_docs):
    more = lambda x: x.withColumns({"source": F.lit("s"), "n_chars": F.length("text")})
    found = merkle.verified_manifest(more(messy)).collect()
    texts = [(a, "s", c, None if b is None else len(b), b) for a, b, c in MESSY]
    assert sorted(map(tuple, found), key=str) == brute(texts)
    assert merkle.verified_manifest(more(no_docs)).count() == 0
    one = more(messy).filter("doc_id = 6")
    assert [x["verified"] for x in merkle.verified_manifest(one).collect()] == [True]


def test_proofs_lead_to_the_roots(spark):
    rows = some_rows()
    trees, top = merkle.manifest(spark.createDataFrame(rows, DDL))
    roots = {x["tree"]: x["subroot"] for x in trees.roots.collect()}
    proofs = merkle.proofs(trees).collect()
    assert len(proofs) == len(rows)
    for x in proofs:
        path = [(y["left"].encode(), y["right"].encode()) for y in x["path"]]
        assert merkle.folded(x["leaf"].encode(), path).decode() == roots[x["tree"]]
    above = merkle.proofs(top).collect()
    assert [x["id"] for x in sorted(above, key=lambda x: x["id"].encode())] == sorted(roots, key=str.encode)


def test_a_chunk_asks_for_no_node_that_it_makes():
    rng = random.Random(5)
    for total in (1, 2, 8, 9, 64, 65, 700):
        tree = levels([h(str(i)) for i in range(total)])
        start = rng.randrange(total)
        for places in ([start], sorted(rng.sample(range(total), min(total, 20))), range(start, total)):
            known = np.array(list(places))
            asked = list(merkle.missing_nodes(known, total))
            assert len(asked) == merkle.height(total) == len(tree) - 1
            have = set(known.tolist())
            for level, missing in asked:
                missing = set(missing.tolist())
                runs = {x // 8 for x in have}
                assert not missing & have  # nothing twice
                assert have | missing == {x for r in runs for x in range(8 * r, min(8 * r + 8, len(tree[level])))}  # and nothing else
                have = runs


def test_outer_nodes_make_every_tree():
    for total, cuts in ((1, []), (9, [3]), (64, [8, 16, 24]), (700, [1, 63, 64, 65, 400]), (70, [69])):
        leaves = [h(str(i)).encode() for i in range(total)]
        have = {}
        for a, b in zip([0, *cuts], [*cuts, total], strict=True):
            for level, place, node in merkle.outer_nodes(a, total, b"".join(leaves[a:b])):
                assert (level, place) not in have
                have[level, place] = node
        tree = levels([x.decode() for x in leaves])
        assert all(tree[level][place].encode() == node for (level, place), node in have.items())
        covered = sorted(i for level, place in have for i in range(place * 8**level, min((place + 1) * 8**level, total)))
        assert covered == list(range(total))
