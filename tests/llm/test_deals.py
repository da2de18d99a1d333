"""Hot doc_ids, many languages, and rows scored once more by plain Python."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from oreflow.llm import langid, quality, tokenfile, toxicity
from tests.llm.conftest import prose
from tests.llm.test_sets import words


def test_rows_of_one_doc_id_spread_over_shards_and_keep_their_place(spark, tmp_path):
    rows = [(None if i % 2 else i // 40, prose(i, 5)) for i in range(4000)]
    table = lambda order: spark.createDataFrame([rows[i] for i in order], "doc_id long, text string").repartition(7)
    order = np.random.default_rng(1).permutation(4000).tolist()
    found = []
    for number, given in enumerate((table(range(4000)), table(order))):
        out = str(tmp_path / str(number))
        tokenfile.write_token_shards(given, out, shards=8)
        files = spark.read.parquet(out).select("shard", F.size("doc_ids").alias("n")).groupBy("shard").sum("n").collect()
        assert len(files) == 8 and max(x[1] for x in files) < 1000
        found.append(sorted(map(tuple, tokenfile.read_token_shards(spark, out).collect()), key=str))
    assert found[0] == found[1] and len({x[1] for x in found[0]}) == 4000
    spans = sorted((start, start + n, doc) for doc, start, n, _ in found[0])
    assert [a for a, _, _ in spans[1:]] == [b for _, b, _ in spans[:-1]]
    place = lambda doc: -1 if doc is None else doc
    assert [place(doc) for _, _, doc in spans] == sorted(place(doc) for doc, _ in rows)


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_the_sample_is_cut_to_its_turns(spark):
    rows = [(i, prose(i, 400 + 97 * (i % 9)), ("a", "b", "c")[i % 3]) for i in range(300)] + [(1000, "x" * 600_000, "long"), (1002, "yy " * 90, "long")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    kept = [(lang, text[: langid.SAMPLE_CHARS]) for i, text, lang in sorted(rows) if not held_out(i)]
    assert langid.learn(docs, per_lang=1000, size=20_000, part=512) == langid.dictionaries(kept, 20_000, 512)
    sizes = [5000, 100, 700]
    assert langid._turns(sizes, 1500, 512) == 2 and langid._turns(sizes, 10**6, 512) == 10 and langid._turns([], 5, 5) == 0
    with pytest.raises(ValueError, match="more than 2 languages"):
        langid.learn(docs, most=2)


# --- scores by plain Python ------------------------------------------------------------------------------------


def test_languages_are_the_smallest_of_all_sizes(sf):
    docs = sf("documents", "0.001")
    content = langid.learn(docs)
    found = {x["doc_id"]: x for x in langid.languages(docs, content).collect()}
    held = {lang: zstandard.ZstdCompressionDict(x, dict_type=zstandard.DICT_TYPE_RAWCONTENT) for lang, x in content.items()}
    for row in docs.collect():
        got, text = found[row["doc_id"]], row["text"] or ""
        if not any(c.isalpha() for c in text):
            assert got["lang_pred"] == "und" and got["score"] == 0
            continue
        data = re.sub(r"[\W\d_]+", " ", text.lower()).encode()
        sizes = {}
        for lang in sorted(held):
            made = zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=held[lang], write_checksum=False, write_content_size=False, write_dict_id=False)
            sizes[lang] = sum(len(made.compress(data[i : i + langid.PIECE_BYTES])) for i in range(0, len(data), langid.PIECE_BYTES))
        best = min(sizes, key=sizes.get)
        assert got["lang_pred"] == best
        weights = [math.exp(max(-50.0, -langid.SHARPNESS * (x - sizes[best]))) for x in sizes.values()]
        assert got["score"] == pytest.approx(1 / sum(weights), abs=1e-9)


def plain_features(text):
    data, w = (text or "").encode(), words(text)
    raw = re.findall(rb"[0-9A-Za-z\x80-\xff]+", data)
    grams = [tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    count = lambda allowed: sum(b in allowed for b in data)
    letters = count(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
    marks = count(bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in "!,.:;?"))
    lines, n, size = data.count(b"\n"), len(w), max(len(data), 1)
    per_word = lambda x: x / max(n, 1)
    return [
        math.log1p(n), per_word(sum(map(len, raw))), per_word(sum(len(x) > 14 for x in raw)), per_word(sum(len(x) == 1 for x in raw)),
        per_word(len(set(w))), len(set(grams)) / max(len(grams), 1), per_word(sum(a == b for a, b in zip(w, w[1:], strict=False))),
        per_word(max(Counter(w).values(), default=0)), count(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ") / max(letters, 1), count(b"0123456789") / size,
        count(b"!,.:;?") / size, marks / size, sum(b >= 128 for b in data) / size, data.count(b" ") / size, lines / size,
        n / (lines + 1), n / (count(b".!?") + 1), per_word(marks),
    ]


def plain_score(model, x):
    bin_of = lambda value, edges: sum(value >= e for e in edges)
    total = model.constant + sum(t[bin_of(v, e)] for v, e, t in zip(x, model.edges, model.tables, strict=True))
    total += sum(t[bin_of(x[a], model.coarse[a]), bin_of(x[b], model.coarse[b])] for a, b, t in model.pairs)
    return 1 / (1 + math.exp(-max(-30, min(30, total))))


def test_quality_is_the_sum_of_its_tables(spark, sf):
    docs, labels = sf("documents", "0.001"), sf("labels", "0.001")
    model = quality.learn(quality.written(quality.feature_rows(docs), "test-features"), labels)
    assert model.edges
    texts = {x["doc_id"]: x["text"] for x in docs.collect()}
    for row in quality.quality_scores(docs, labels).collect():
        assert row["score"] == pytest.approx(plain_score(model, plain_features(texts[row["doc_id"]])), abs=1e-9)
        assert row["predicted"] == (row["score"] >= 0.3) and row["held_out"] == held_out(row["doc_id"])


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(6)
    x = rng.uniform(size=(3000, 5))
    y = ((x[:, 1] > 0.5) != (x[:, 3] > 0.5)).astype(int)
    model = quality.fit(x, y)
    assert model.pairs[0][:2] == (1, 3)
    scores = model.score(x)
    assert scores[:200].tolist() == pytest.approx([plain_score(model, row) for row in x[:200].tolist()], abs=1e-9)
    assert np.mean((scores > 0.5) == y) > 0.9


WHOLE = (1 << 64) - 1


def mixed(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & WHOLE
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & WHOLE
    return x ^ (x >> 31)


def slot_hash(data):
    return mixed((sum((b + 1) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, b in enumerate(data)) + len(data)) & WHOLE)


def test_toxicity_is_the_sum_of_its_weights(sf):
    docs, labels = sf("documents", "0.001"), sf("labels", "0.001")
    model = toxicity.learn(docs, labels)
    assert len(model.slots) and (np.diff(model.cuts) > 0).all()
    weight = dict(zip(model.slots.tolist(), model.weights.tolist(), strict=True))
    texts = {x["doc_id"]: x["text"] for x in docs.collect()}
    cache = {}
    for row in toxicity.toxicity_scores(docs, labels).collect():
        times = Counter()
        for word in words(texts[row["doc_id"]]):
            if word not in cache:
                data = word.encode()
                cache[word] = [slot_hash(data) % toxicity.SLOTS] + [
                    mixed((slot_hash(data[:n]) + kind) & WHOLE) % toxicity.SLOTS for kind, n in enumerate(toxicity.BEGINNINGS, 1) if len(data) > n]
            times.update(s for s in cache[word] if s in weight)
        total = sum(weight[s] * math.log1p(n) for s, n in times.items())
        p = [1 / (1 + math.exp(max(-30, min(30, c - total)))) for c in model.cuts]
        assert (row["severity"], row["p_toxic"]) == (pytest.approx(sum(p), abs=1e-9), pytest.approx(p[0], abs=1e-9))
        assert row["toxic"] == (row["p_toxic"] >= toxicity.CUT)


def test_scores_do_not_look_at_other_columns(sf):
    docs, labels = sf("documents", "0.001"), sf("labels", "0.001")
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.concat(F.lit("other"), "source"), "n_chars": F.lit(7).cast("bigint")})
    content = langid.learn(docs)
    for score in (lambda d: quality.quality_scores(d, labels), lambda d: toxicity.toxicity_scores(d, labels), lambda d: langid.languages(d, content)):
        assert sorted(map(tuple, score(docs).collect())) == sorted(map(tuple, score(other).collect()))


def test_labels_of_held_out_rows_teach_nothing(sf):
    docs, labels = sf("documents", "0.001"), sf("labels", "0.001")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    turned = labels.withColumns({x: F.when(held, 1 - F.col(x)).otherwise(F.col(x)).cast(labels.schema[x].dataType) for x in ("quality", "toxic")})
    for score in (quality.quality_scores, toxicity.toxicity_scores):
        assert sorted(map(tuple, score(docs, labels).collect())) == sorted(map(tuple, score(docs, turned).collect()))
