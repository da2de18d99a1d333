import random

import pytest

from oreflow.sources.ship import ship_package

SYLLABLES = "an er on the ing re tion st ou ble ha ver lé ß ño".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


#: Nulls, empty and wordless texts, copies, a repeated row, a very long text, special strings.
MESSY = [
    (1, prose(1, 120), "en"), (2, None, "en"), (3, "", None), (4, "!!! ... \n\n ", "en"), (5, prose(1, 120), "en"),
    (5, prose(1, 120), "en"), (None, prose(1, 120), "en"), (6, prose(6, 30_000), "de"), (7, "x" * 70_000, None),
    (8, "one two", "en"), (9, "<|endoftext|> </s> <s> ▁ \0 Ünï ​ 日本語", "en"), (10, prose(10, 12), "fr"),
]
#: Columns whose names the operators use themselves.
DDL = "doc_id long, text string, lang string"
CLASHING = ["row", "node", "n", "key", "score", "x", "label", "shard", "digest", "w", "h", "part", "size", "ids", "id", "md5", "bad_id", "class_id"]


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def messy(spark):
    rows = [(*row, *(["clash"] * len(CLASHING))) for row in MESSY]
    return spark.createDataFrame(rows, DDL + "".join(f", {x} string" for x in CLASHING)).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DDL)


@pytest.fixture(scope="session")
def sf(spark):
    return lambda name, scale="0.01": spark.read.parquet(f"/root/testdata/sf{scale}/{name}.parquet")
