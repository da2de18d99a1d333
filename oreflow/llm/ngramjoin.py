"""Similarity join of documents by the Jaccard similarity of their word n-grams, with Bayesian candidate pruning.

1. Every text is read once and reduced to a digest of its shingle set, MinHash values, and keys of bands of these.
   Equal sets are one class of copies from then on; only their representatives are compared.
2. Representatives that share a band are candidates.  Their MinHash values are compared a few at a time, and a pair
   is dropped as soon as the posterior probability that its similarity reaches the threshold falls below a
   tolerance.  What survives ties representatives into clusters.
3. Within a cluster every pair is pruned the same way, and the rest is verified on the words themselves.

No pair is ever a row: a task compares the members of a part of a band or cluster, at most ``CHUNK`` against
``CHUNK`` of them, and gives out one tie or one sum for each member.  A larger band or cluster is dealt out as pairs
of parts, so that every pair of members still meets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.components import components
from oreflow.llm.groups import binary_bytes, whole_groups
from oreflow.llm.joins import checked
from oreflow.llm.text import Words, mix, per_slice, shingle_hashes, text_bytes
from oreflow.sources.scratch import written

SHINGLE = 5
THRESHOLD = 0.8
HASHES = 128
MISSED = 1e-7  # most of the pairs at the threshold that may share no band
STEP = 16  # values compared at a time
TOLERANCE = 1e-8
CHUNK = 256
_PAIRS_AT_ONCE = 1 << 19
_rng = np.random.default_rng(0x5EED)
_XOR = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)[:, None]
_TIMES = (_rng.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1))[:, None]


def minhash(hashes: np.ndarray) -> np.ndarray:
    """For each of ``HASHES`` permutations, the smallest image of a set of hashes."""
    low = (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)[None, :]
    out = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, low.shape[1], 2048):
        np.minimum(out, ((low[:, i : i + 2048] ^ _XOR) * _TIMES).min(axis=1), out=out)
    return out


def band_width(threshold: float) -> int:
    """The most values a band may hold if at the threshold no more than ``MISSED`` of all pairs are to differ in every band."""
    fits = [r for r in range(1, HASHES + 1) if (1 - threshold**r) ** (HASHES // r) <= MISSED]
    if not 0 < threshold <= 1 or not fits:
        raise ValueError(f"{HASHES} MinHash values cannot hold pairs of similarity {threshold}")
    return max(fits)


def band_keys(values: np.ndarray, width: int) -> np.ndarray:
    """A key for each band of a row of values; bands at different places have different keys."""
    count = values.shape[1] // width
    parts = values[:, : count * width].astype(np.uint64).reshape(len(values), count, width)
    out = np.arange(count, dtype=np.uint64)[None, :] + np.uint64(1)
    for i in range(width):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return out.view(np.int64)


SKETCH_DDL = "doc_id long, key string, n int, digest binary, sketch binary, bands array<long>"


def sketches(docs: DataFrame, shingle: int = SHINGLE, width: int | None = None) -> DataFrame:
    """``key`` is the text's MD5.  A text's shingle set as its size, a digest, the low bytes of its MinHash values, and its band keys."""
    width = width or band_width(THRESHOLD)

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(*text_bytes(piece.column("text")))
        hashes, first = shingle_hashes(words.hashes(), words.first, shingle)
        n, digests, values = [], [], np.zeros((len(piece), HASHES), dtype=np.uint32)
        for i in range(len(piece)):
            own = np.unique(hashes[first[i] : first[i + 1]])
            n.append(len(own))
            digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
            values[i] = minhash(own)
        keys = band_keys(values, width)
        counts = np.where(np.array(n, dtype=np.int64) > 0, keys.shape[1], 0)
        ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[counts > 0].ravel()))
        low = [x.tobytes() for x in (values & np.uint32(0xFF)).astype(np.uint8)]
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id").cast(pa.int64()), piece.column("key"), pa.array(n, pa.int32()), pa.array(digests, pa.binary()),
             pa.array(low, pa.binary()), bands],
            names=["doc_id", "key", "n", "digest", "sketch", "bands"],
        )

    keyed = docs.select("doc_id", F.md5(F.col("text").cast("binary")).alias("key"), "text")
    return keyed.mapInArrow(per_slice(work), SKETCH_DDL)


@cache
def least_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """For 16, 32, ... values compared, the matches below which reaching the threshold is less likely than the tolerance.

    With a uniform prior on the similarity s, and a value's low byte matching with probability s + (1 - s) / 256.
    """
    s = (np.arange(1 << 14) + 0.5) / (1 << 14)
    p = s + (1 - s) / 256
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        for m in range(n + 1):
            log = m * np.log(p) + (n - m) * np.log1p(-p)
            weight = np.exp(log - log.max())
            if weight[s >= threshold].sum() >= tolerance * weight.sum():
                break
        out.append(m)
    return tuple(out)


def prune(sketch: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float, tolerance: float) -> np.ndarray:
    """Which pairs of rows are still likely enough after all values; most are dropped after the first few."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), dtype=np.int32)
    for step, least in enumerate(least_matches(threshold, tolerance)):
        part = slice(step * STEP, (step + 1) * STEP)
        matches += (sketch[a[alive], part] == sketch[b[alive], part]).sum(axis=1, dtype=np.int32)
        keep = matches >= least
        alive, matches = alive[keep], matches[keep]
    return alive


def ties(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``size`` things, the smallest that pairs tie it to."""
    root = np.arange(size)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            break
    return root


def dealt(rows: DataFrame, key: str, size: str, chunk: int = CHUNK) -> DataFrame:
    """Rows with ``part`` and, for each pair of parts of its group that a row belongs to, ``x`` <= ``y``.

    A group of up to ``chunk`` members is one part.
    """
    parts = F.ceil(F.col(size) / chunk).cast("int")
    placed = rows.withColumn("part", F.pmod(F.xxhash64("node", F.lit("part")), F.greatest(parts, F.lit(1))).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1))
    spread = placed.withColumn("other", others)
    return spread.select(
        *rows.columns, "part", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y")
    ).repartition(key, "x", "y").sortWithinPartitions(key, "x", "y")


def _meetings(part: np.ndarray, x: np.ndarray, y: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows that meet in each group, some at a time: all of one part, or one part's with the other's."""
    sizes = np.diff(first)
    alone = x[first[:-1]] == y[first[:-1]]
    for size in np.unique(sizes[alone]):
        if size < 2:
            continue
        starts = first[:-1][alone & (sizes == size)]
        i, j = np.triu_indices(size, 1)
        step = max(1, _PAIRS_AT_ONCE // len(i))
        for k in range(0, len(starts), step):
            some = starts[k : k + step, None]
            yield (some + i).ravel(), (some + j).ravel()
    for start, stop in zip(first[:-1][~alone], first[1:][~alone], strict=True):
        own = np.arange(start, stop)
        left, right = own[part[own] == x[start]], own[part[own] == y[start]]
        if len(left) and len(right):
            step = max(1, _PAIRS_AT_ONCE // len(right))
            for k in range(0, len(left), step):
                some = left[k : k + step]
                yield np.repeat(some, len(right)), np.tile(right, len(some))


def _sketch_matrix(column: pa.ChunkedArray) -> np.ndarray:
    data, _ = binary_bytes(column)
    return data.reshape(len(column), HASHES)


def _tie_bands(threshold: float, tolerance: float) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, first in whole_groups(batches, ["band", "x", "y"]):
            node, own = np.unique(table.column("node").to_numpy(), return_inverse=True)
            sketch = _sketch_matrix(table.column("sketch"))
            part, x, y = (table.column(c).to_numpy() for c in ("part", "x", "y"))
            left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for a, b in _meetings(part, x, y, first):
                alive = prune(sketch, a, b, threshold, tolerance)
                pairs = np.unique(own[a[alive]] * len(node) + own[b[alive]])
                left.append(pairs // len(node))
                right.append(pairs % len(node))
            root = ties(len(node), np.concatenate(left), np.concatenate(right))
            tied = np.flatnonzero(root != np.arange(len(node)))
            yield pa.RecordBatch.from_arrays([pa.array(node[tied]), pa.array(node[root[tied]])], names=["u", "v"])

    return run


def exact_shingles(words: Words, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of every text's distinct shingles, by the words themselves, and where each text's begin."""
    numbers: dict[bytes, int] = {}
    data = words.data.tobytes()
    each = zip(words.starts.tolist(), words.ends.tolist(), strict=True)
    ids = np.fromiter((numbers.setdefault(data[a:b], len(numbers) + 1) for a, b in each), np.int64, len(words.starts))
    counts = words.counts
    n = np.where(counts >= shingle, counts - shingle + 1, (counts > 0).astype(counts.dtype))
    begin = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(begin[-1]) + np.repeat(words.first[:-1] - begin[:-1], n)
    last = np.repeat(words.first[1:], n)
    ids = np.concatenate([ids, np.zeros(shingle, dtype=np.int64)])
    gram = ids[at]
    for i in range(1, shingle):  # a run and the next word, numbered anew: never more numbers than runs
        gram = np.unique(gram, return_inverse=True)[1] * (len(numbers) + 1) + np.where(at + i < last, ids[at + i], 0)
    gram = np.unique(gram, return_inverse=True)[1]
    owner = np.repeat(np.arange(len(n)), n)
    size = int(gram.max()) + 1 if len(gram) else 1
    pairs = np.unique(owner * size + gram)
    return pairs % size, np.searchsorted(pairs // size, np.arange(len(n) + 1))


def _verify(threshold: float, tolerance: float, shingle: int) -> Callable:
    def verified(table: pa.Table, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of rows of one group whose similarity reaches the threshold."""
        part, x, y = (table.column(c).to_numpy() for c in ("part", "x", "y"))
        grams, begin = exact_shingles(Words(*binary_bytes(table.column("text"))), shingle)
        n = np.diff(begin)
        held = np.zeros(int(grams.max()) + 1 if len(grams) else 1, dtype=bool)
        left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for a, b in _meetings(part, x, y, np.array([0, len(table)])):
            alive = prune(sketch, a, b, threshold, tolerance)
            order = alive[np.argsort(a[alive], kind="stable")]
            a, b = a[order], b[order]
            for i, lo, hi in zip(*_runs(a), strict=True):
                held[grams[begin[i] : begin[i + 1]]] = True
                partners = b[lo:hi]
                stops = np.concatenate([[0], np.cumsum(n[partners])])
                at = np.arange(stops[-1]) + np.repeat(begin[partners] - stops[:-1], n[partners])
                total = np.concatenate([[0], np.cumsum(held[grams[at]])])
                common = total[stops[1:]] - total[stops[:-1]]
                held[grams[begin[i] : begin[i + 1]]] = False
                good = partners[common / np.maximum(n[i] + n[partners] - common, 1) >= threshold]
                left.append(np.full(len(good), i))
                right.append(good)
        return np.concatenate(left), np.concatenate(right)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, first in whole_groups(batches, ["root", "x", "y"], rows=1):
            for start, stop in zip(first[:-1], first[1:], strict=True):
                group = table.slice(start, stop - start)
                # A doc_id's texts with equal sets, such as by case alone, stand for one node.
                group = group.take(np.sort(np.unique(group.column("node").to_numpy(), return_index=True)[1]))
                node, copies = group.column("node").to_numpy(), group.column("copies").to_numpy()
                a, b = verified(group, _sketch_matrix(group.column("sketch")))
                links = np.bincount(a, copies[b], len(node)) + np.bincount(b, copies[a], len(node))
                root = ties(len(node), a, b)
                some = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[some]), pa.array(node[root[some]]), pa.array(links[some].astype(np.int64))],
                    names=["u", "v", "links"],
                )

    return run


def _runs(values: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.empty(0, np.int64)
    return values[starts].tolist(), starts.tolist(), np.append(starts[1:], len(values)).tolist() if len(starts) else []


def _same(rows: DataFrame, pairs: DataFrame) -> Column:
    """Whether doc_id and text of a row are those of a pair of doc_id and ``key``; nulls are equal."""
    return rows["doc_id"].eqNullSafe(pairs["doc_id"]) & F.md5(rows["text"].cast("binary")).eqNullSafe(pairs["key"])


def _once(rows: DataFrame, again: DataFrame) -> DataFrame:
    """Rows without repeats of the same doc_id and text; ``again`` holds those pairs of them that occur more than once."""
    if again.isEmpty():
        return rows
    some = checked(again)
    return rows.join(some, _same(rows, again), "left_anti").unionByName(
        rows.join(some, _same(rows, again), "left_semi").dropDuplicates(["doc_id", "text"])
    )


def similar(
    docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, tolerance: float = TOLERANCE, chunk: int = CHUNK
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, class_id, n_links, n_shingles``, and ``key``, the MD5 of the text.

    Two rows are linked when the Jaccard similarity of their sets of ``shingle``-word runs is at least ``threshold``;
    bands are as wide as it allows, and one too low for the values (below about 0.12) is an error.  A text of fewer words
    is one run, a very long one is read whole.  ``n_links`` counts
    the other rows linked to this one, copies included; ``class_id`` is the smallest doc_id that links lead to.  Null
    and wordless texts have no links and are their own class.  Repeated rows are copies of each other.  A row
    without doc_id shares the class of its copies but has no other links.  Other columns are not read.
    """
    return _classed(docs, threshold, shingle, tolerance, chunk, nameless=False).drop("class_row")


def _classed(docs: DataFrame, threshold: float, shingle: int, tolerance: float, chunk: int, nameless: bool) -> DataFrame:
    """The rows of ``similar`` with ``class_row``, which tells classes apart whatever their doc_ids; null without words.

    ``nameless`` compares rows without doc_id like all others.  A class of only such rows has no ``class_id``.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    drawn = sketches(plain, shingle, band_width(threshold))
    drawn = written(drawn.select(F.monotonically_increasing_id().alias("row"), "*"), "join-sketches")
    named: Column = F.col("row") if nameless else F.when(F.col("doc_id").isNotNull(), F.col("row"))
    sets = written(
        drawn.filter("n > 0").groupBy("digest").agg(
            F.min(named).alias("node"), F.min_by("doc_id", named).alias("node_doc"), F.min("doc_id").alias("least_doc"),
            F.count("*").alias("copies"),
        ),
        "join-sets",
    )
    nodes = written(
        drawn.drop("doc_id", "digest", "n").withColumnRenamed("row", "node").join(sets.filter("node is not null"), "node"),
        "join-nodes",
    )

    banded = nodes.select("node", F.explode("bands").alias("band"))
    shared = written(banded.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1"), "join-bands")
    members = written(banded.join(shared, "band"), "join-members")
    candidates = members.join(nodes.select("node", "sketch"), "node")
    tied = dealt(candidates, "band", "size", chunk).mapInArrow(_tie_bands(threshold, tolerance), "u long, v long")
    clusters = written(components(tied), "join-clusters")

    sizes = written(clusters.groupBy("root").agg(F.count("*").alias("size")), "join-cluster-sizes")
    inside = clusters.join(sizes, "root").join(
        nodes.select("node", "node_doc", "key", "sketch", "copies"), "node"
    )
    inside = written(inside, "join-inside")
    wanted = written(inside.select(F.col("node_doc").alias("doc_id"), "key").distinct(), "join-wanted")
    few = checked(wanted)
    asked = drawn["doc_id"].eqNullSafe(wanted["doc_id"]) & (drawn["key"] == wanted["key"])
    repeated = drawn.select("doc_id", "key").join(few, asked, "left_semi").groupBy("doc_id", "key").count().filter("count > 1")
    texts = _once(plain.join(few, _same(plain, wanted), "left_semi"), written(repeated.select("doc_id", "key"), "join-repeated"))
    # An id may stand for several texts, and so may its absence: a text is met by both.
    texts = texts.select(F.col("doc_id").alias("text_doc"), F.md5(F.col("text").cast("binary")).alias("text_key"), "text")
    right = inside.join(texts, F.col("node_doc").eqNullSafe(F.col("text_doc")) & (F.col("key") == F.col("text_key")))
    right = right.drop("node_doc", "key", "text_doc", "text_key")
    found = written(
        dealt(right, "root", "size", chunk).mapInArrow(_verify(threshold, tolerance, shingle), "u long, v long, links long"),
        "join-found",
    )
    links = found.groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    joined = components(found.select("u", "v"))
    roots = joined.join(nodes.select("node", "least_doc"), "node")
    least = roots.groupBy("root").agg(F.min("least_doc").alias("class_doc"))
    linked = joined.join(least, "root").join(links, "node").select("node", "root", "class_doc", "links")
    classes = written(sets.join(linked, "node", "left"), "join-classes").select(
        "digest", F.coalesce("root", "node").alias("class_row"), F.coalesce("class_doc", "least_doc").alias("class_doc"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    rows = drawn.select("doc_id", "key", F.when(F.col("n") > 0, F.col("digest")).alias("digest"), F.col("n").alias("n_shingles"))
    return rows.join(classes, "digest", "left").select(
        "doc_id", F.coalesce("class_doc", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.col("n_shingles").cast("long").alias("n_shingles"), "key", "class_row",
    )


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class: that with the class's smallest doc_id, of its texts that of the smallest MD5.

    Rows without a doc_id are compared like all others; one of them stays only if no row of its class has a doc_id.  Of
    repeated rows one stays.  Null and wordless texts without a doc_id all stay.
    """
    columns = ["doc_id", "class_row", "key"]
    found = written(_classed(docs, threshold, SHINGLE, TOLERANCE, CHUNK, nameless=True).select(columns), "join-similar")
    member = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key")
    ends = found.filter("class_row is not null").groupBy("class_row").agg(F.min(member).alias("head"), F.max(member).alias("last"))
    several = written(ends.filter("head != last").select("class_row", "head"), "join-several")
    others = found.join(checked(several), "class_row").filter(member != F.col("head"))
    gone = written(others.select("doc_id", "key").distinct(), "join-gone")
    kept = docs.join(checked(gone), _same(docs, gone), "left_anti")
    # Rows with neither doc_id nor words are no copies of each other.
    known = found.filter("doc_id is not null or class_row is not null")
    again = written(known.groupBy("doc_id", "key").count().filter("count > 1").select("doc_id", "key"), "join-again")
    return _once(kept, again)


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
placed AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS p FROM d WHERE len(w) > 0),
g AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS gram FROM placed),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  GROUP BY ALL),
link AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE c::DOUBLE / (x.n + y.n - c) >= 0.8),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
class AS (SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a),
degree AS (SELECT a AS doc_id, count(*) AS n_links FROM link GROUP BY a)
SELECT d.doc_id, class_id, coalesce(n_links, 0)::BIGINT AS n_links, coalesce(n.n, 0)::BIGINT AS n_shingles
FROM d JOIN class USING (doc_id) LEFT JOIN degree USING (doc_id) LEFT JOIN n USING (doc_id)
"""
