"""Near-duplicates by SimHash fingerprints, found with pivot distance tables.

Texts become 64-bit fingerprints, equal ones a single *point*.  Two points at most ``DISTANCE`` bits apart have nearly
equal Hamming distances to any third fingerprint, so every point gets a table of its distances to ``PIVOTS`` fixed
reference fingerprints, and a pair is discarded when any coordinate of the two tables differs by more than
``DISTANCE``.  Survivors are verified bit by bit.  The first coordinate orders a task's points, so that a point is held
only against those in its window.

Distances to pivots are spread too narrowly around 32 to deal points out to tasks.  For that 64 bits are cut into
``DISTANCE + 2`` blocks: a pair that differs in ``DISTANCE`` bits is equal in two of them, and meets under their key.  No
pair is ever a row: a task gives out one tie for each point of a group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.components import components
from oreflow.llm.groups import whole_groups
from oreflow.llm.joins import checked
from oreflow.llm.ngramjoin import ties
from oreflow.llm.text import per_slice
from oreflow.sources.scratch import written

SHINGLE = 3
DISTANCE = 3
SEED = 42
PIVOTS = 32
PART = 1024  # points of a group that one task holds against those of another part
_PIECE = 1 << 20
_PAIRS_AT_ONCE = 1 << 19
_SPACE = b" \t\n\x0b\x0c\r"
_REFERENCE = np.random.default_rng(0x51D).integers(0, 1 << 64, PIVOTS, dtype=np.uint64)


# --- fingerprints ----------------------------------------------------------------------------------------


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces of about ``_PIECE`` bytes that end before a space; a longer word stays whole."""
    start = 0
    while start < len(text):
        stop = start + _PIECE
        while stop < len(text) and text[stop] not in _SPACE:
            stop += 1
        yield text[start:stop]
        start = stop


def shingle_digests(text: bytes, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """XXH64 of all runs of ``size`` words, A-Z in lower case, joined by a space; fewer words are one run, none no run."""
    held: list[bytes] = []
    several = False
    for piece in _pieces(text):
        held += piece.lower().split()
        if len(held) >= size:
            several = True
            runs = zip(*(held[i:] for i in range(size)), strict=False)
            yield np.array([xxhash.xxh64_intdigest(b" ".join(x), SEED) for x in runs], dtype=np.uint64)
            held = held[len(held) - size + 1 :]
    if held and not several:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(held), SEED)], dtype=np.uint64)


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """A bit is 1 where over half of the shingles' hashes have it; 0 for a text without words."""
    ones, n = np.zeros(64, dtype=np.int64), 0
    for hashes in shingle_digests(text, size):
        ones += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, point`` of every row: the fingerprint's 64 bits as a long.  A null text has no words."""

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        texts = pc.fill_null(piece.column("text").cast(pa.large_binary()), b"")
        points = np.fromiter((fingerprint(x.as_buffer().to_pybytes(), size) for x in texts), np.uint64, len(piece))
        return pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(points.view(np.int64))], names=["doc_id", "point"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return plain.mapInArrow(per_slice(work), "doc_id long, point long")


# --- links -----------------------------------------------------------------------------------------------


def block_masks(distance: int) -> list[int]:
    """Masks of any two of ``distance + 2`` blocks of the 64 bits: points that near agree under one of them."""
    edges = [64 * i // (distance + 2) for i in range(distance + 3)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return [a | b for a, b in combinations(blocks, 2)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _met(points: DataFrame, distance: int, part: int) -> DataFrame:
    """``key, part, x, y, point``: a group shares a key; one of over ``part`` points is dealt out as pairs of parts."""
    keys = [F.xxhash64(F.lit(i), F.col("point").bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(block_masks(distance))]
    keyed = points.select("point", F.explode(F.array(*keys)).alias("key"))
    large = written(keyed.groupBy("key").agg(F.count("*").alias("size")).filter(F.col("size") > part), "simhash-large")
    parts = F.coalesce(F.ceil(F.col("size") / part), F.lit(1)).cast("int")
    own: Column = F.pmod(F.xxhash64("point", F.lit("part")), parts).cast("int")
    spread = keyed.join(checked(large), "key", "left").select(
        "key", "point", own.alias("part"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other")
    )
    met = spread.select("key", "part", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"), "point")
    return met.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")


def near_pairs(points: np.ndarray, group: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Some at a time, the rows of pairs of one group at most ``distance`` bits apart, and how many pairs were verified."""
    tables = np.bitwise_count(points[:, None] ^ _REFERENCE[None, :]).astype(np.int16)
    order = np.lexsort((tables[:, 0], group))
    points, tables = points[order], tables[order]
    place = group[order].astype(np.int64) * 256 + tables[:, 0]
    last = np.searchsorted(place, place + distance, side="right")
    count = last - np.arange(len(place)) - 1
    ends = np.cumsum(count)
    start = 0
    while start < len(place):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + _PAIRS_AT_ONCE, side="right")))
        n = count[start:stop]
        a = np.repeat(np.arange(start, stop), n)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
        for i in range(0, PIVOTS, 8):
            keep = (np.abs(tables[a, i : i + 8] - tables[b, i : i + 8]) <= distance).all(axis=1)
            a, b = a[keep], b[keep]
        good = np.bitwise_count(points[a] ^ points[b]) <= distance
        yield order[a[good]], order[b[good]], len(a)
        start = stop


def _tie(distance: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, first in whole_groups(batches, ["key", "x", "y"]):
            points = table.column("point").to_numpy()
            every, own = np.unique(points, return_inverse=True)
            group = np.repeat(np.arange(len(first) - 1), np.diff(first))
            root = np.arange(len(every))
            for a, b, _ in near_pairs(points.view(np.uint64), group, distance):
                # Each piece's pairs are folded into the ties so far.
                left, right = np.concatenate([own[a], np.arange(len(root))]), np.concatenate([own[b], root])
                root = ties(len(every), left, right)
            tied = np.flatnonzero(root != np.arange(len(every)))
            yield pa.RecordBatch.from_arrays([pa.array(every[tied]), pa.array(every[root[tied]])], names=["u", "v"])

    return run


def near_components(docs: DataFrame, distance: int = DISTANCE, size: int = SHINGLE, part: int = PART) -> DataFrame:
    """Per row ``doc_id, fingerprint, component_id``: fingerprints at most ``distance`` bits apart are linked.

    ``component_id`` is the smallest doc_id that links lead to, the row's own included.  Null, empty and wordless texts
    have the fingerprint zero and are linked like others.  A row without doc_id links others and shares their component,
    whose id is null where no row has one.  Repeated rows and equal texts share a fingerprint.  Texts are read whole, in
    pieces.  Other columns are not read.
    """
    rows = written(fingerprints(docs, size), "simhash-rows")
    points = written(rows.groupBy("point").agg(F.min("doc_id").alias("least")), "simhash-points")
    tied = _met(points.select("point"), distance, part).mapInArrow(_tie(distance), "u long, v long")
    linked = written(components(tied), "simhash-linked").withColumnRenamed("node", "point")
    smallest = linked.join(points, "point").groupBy("root").agg(F.min("least").alias("smallest"))
    # A component's smallest doc_id may be null although the point has one only if none of its points has one.
    named = points.join(linked.join(smallest, "root"), "point", "left").select("point", F.coalesce("smallest", "least").alias("component_id"))
    return rows.join(written(named, "simhash-components"), "point").select(
        "doc_id", F.lpad(F.lower(F.hex("point")), 16, "0").alias("fingerprint"), "component_id"
    )
