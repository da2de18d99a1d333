"""Vectors as short codes: a codebook for each part of the components, fitted by k-means with norm-of-sum bounds.

A pass over the vectors assigns every part to its nearest entry.  Between passes a vector keeps, for each part, the
entry, a lower bound on the distance to the other entries of each group of entries, and the round in which that
bound was measured, its stamp.  All codebooks since the first are retained.  So a later pass lowers a bound by the true
net displacement of entries between stamp and now, the norm of the sum of their steps, which is never more than the
sum of the steps' norms.  Only groups whose lowered bound does not exceed the distance to the part's own entry are
scanned again, exactly.

All is integer arithmetic: bounds decide only what need not be looked at, so codes equal those of a full search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.joins import checked
from oreflow.sources.scratch import written

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
GROUPS = 8  # groups of entries with a bound of their own
_MOST = 1 << 26
_SLACK = 1 + 1e-9  # far above the rounding of a square root, far below a difference that matters


# --- vectors ---------------------------------------------------------------------------------------------


def whole_numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows of a list column are whole, and their components floor(256 x) with where each row's begin."""
    offsets = np.asarray(column.offsets).astype(np.int64)
    values = column.values
    missing = np.asarray(values.is_null())
    plain = np.nan_to_num(values.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64), nan=np.nan, posinf=np.nan, neginf=np.nan)
    bad = np.concatenate([[0], np.cumsum(missing | np.isnan(plain))])
    whole = ~np.asarray(column.is_null()) & (bad[offsets[1:]] == bad[offsets[:-1]])
    sizes = np.where(whole, np.diff(offsets), 0)
    begin = np.concatenate([[0], np.cumsum(sizes[whole])])
    at = np.arange(begin[-1]) + np.repeat(offsets[:-1][whole] - begin[:-1], sizes[whole])
    scaled = np.floor(plain[at] * SCALE)
    if (np.abs(scaled) >= _MOST).any():
        raise OverflowError("256 times a component may not reach 2^26")
    return whole, scaled.astype("<i4"), begin


def _kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        whole, numbers, begin = whole_numbers(batch.column("vector"))
        rows = batch.filter(pa.array(whole))
        vectors = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer((4 * begin).astype(np.int32)), pa.py_buffer(numbers)])
        yield pa.RecordBatch.from_arrays([rows.column("vec_id"), rows.column("label"), vectors], names=["vec_id", "label", "vector"])


def kept_vectors(vectors: DataFrame, column: str) -> DataFrame:
    """``vec_id, label, vector`` of rows whose vector is not null and holds only finite components, as 32-bit integers."""
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col(column).cast("array<double>").alias("vector"))
    return plain.mapInArrow(_kept, f"vec_id long, label {plain.schema['label'].dataType.simpleString()}, vector binary")


# --- codebooks and bounds --------------------------------------------------------------------------------


def near_groups(book: np.ndarray, most: int) -> list[list[np.ndarray]]:
    """For each part its entries in up to ``most`` groups of neighbours: halves along the widest component, and so on."""

    def halves(entries: np.ndarray, points: np.ndarray, into: int) -> list[np.ndarray]:
        if into < 2 or len(entries) < 2:
            return [np.sort(entries)]
        widest = np.ptp(points[entries], axis=0).argmax() if points.shape[1] else 0
        order = entries[np.argsort(points[entries, widest], kind="stable")] if points.shape[1] else entries
        middle = len(entries) // 2
        return halves(order[:middle], points, into // 2) + halves(order[middle:], points, into - into // 2)

    return [halves(np.arange(len(points)), points, most) for points in book]


def displacements(history: list[np.ndarray], groups: list[list[np.ndarray]]) -> np.ndarray:
    """By stamp, part and group: how far an entry of the group has moved at most since then, as the crow flies."""
    moved = [np.sqrt(((history[-1] - book).astype(np.float64) ** 2).sum(axis=2)) * _SLACK for book in history]
    return np.stack([np.stack([[x[part, g].max() for g in each] for part, each in enumerate(groups)]) for x in moved])


class State(NamedTuple):
    """Of some vectors, by part: entry, squared distance to it, and by group a lower bound and its stamp."""

    code: np.ndarray
    error: np.ndarray
    low: np.ndarray
    stamp: np.ndarray
    scanned: int  # groups looked at, over all vectors and parts


def _squares(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances: in doubles while these hold every sum, else in 64-bit integers."""
    most = max(np.abs(x).max(initial=0), np.abs(book).max(initial=0))
    kind = np.float64 if 4 * max(x.shape[1], 1) * int(most) ** 2 < 1 << 53 else np.int64
    x, book = x.astype(kind), book.astype(kind)
    found = (x * x).sum(axis=1)[:, None] - 2 * (x @ book.T) + (book * book).sum(axis=1)[None, :]
    return found.astype(np.int64)


def _below(distances: np.ndarray) -> np.ndarray:
    """As 16-bit floats, rounded down; what is beyond these becomes their largest."""
    return np.nextafter(np.clip(distances, -60_000, 60_000).astype(np.float16), np.float16(-np.inf))


def assign(vectors: np.ndarray, history: list[np.ndarray], groups: list[list[np.ndarray]], old: State | None) -> State:
    """Every part's nearest entry of the last codebook, ties to the lower index."""
    now, book = len(history) - 1, history[-1]
    n, parts, size = len(vectors), book.shape[0], book.shape[2]
    code, error = np.zeros((n, parts), np.uint8), np.zeros((n, parts), np.int64)
    count = len(groups[0])
    low, stamp = np.zeros((n, parts, count), np.float16), np.full((n, parts, count), now, np.uint8)
    moved, scanned = displacements(history, groups), 0
    every = np.arange(n)
    for part in range(parts):
        x = vectors[:, part * size : (part + 1) * size].astype(np.int64)
        if old is None:
            best, nearest = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
            need = np.ones((n, count), bool)
        else:
            nearest = old.code[:, part].astype(np.int64)
            best = ((x - book[part, nearest]) ** 2).sum(axis=1)
            lowered = old.low[:, part].astype(np.float64) - moved[old.stamp[:, part], part, np.arange(count)]
            need = lowered <= np.sqrt(best.astype(np.float64))[:, None] * _SLACK
            low[:, part], stamp[:, part] = old.low[:, part], old.stamp[:, part]
        first_entry, first_best = nearest, best
        seen = []
        for i, group in enumerate(groups[part]):
            rows = np.flatnonzero(need[:, i])
            scanned += len(rows)
            far = _squares(x[rows], book[part, group])
            least = far.argmin(axis=1) if len(rows) else np.empty(0, np.int64)
            entry, square = group[least], far[np.arange(len(rows)), least]
            better = (square < best[rows]) | ((square == best[rows]) & (entry < nearest[rows]))
            best, nearest = best.copy(), nearest.copy()
            best[rows[better]], nearest[rows[better]] = square[better], entry[better]
            far[np.arange(len(rows)), least] = np.iinfo(np.int64).max
            second = far.min(axis=1, initial=np.iinfo(np.int64).max)
            seen.append((rows, entry, square, second))
        for i, (rows, entry, square, second) in enumerate(seen):
            low[rows, part, i] = _below(np.sqrt(np.where(entry == nearest[rows], second, square).astype(np.float64)))
            stamp[rows, part, i] = now
        if old is not None:
            # An entry that was left belongs to the others of its group from now on.
            home = np.zeros(book.shape[1], np.int64)
            for i, group in enumerate(groups[part]):
                home[group] = i
            group = home[first_entry]
            left = (first_entry != nearest) & ~need[every, group]
            rows, at = every[left], group[left]
            low[rows, part, at] = _below(np.minimum(lowered[rows, at], np.sqrt(first_best[rows].astype(np.float64))))
            stamp[rows, part, at] = now
        code[:, part], error[:, part] = nearest, best
    return State(code, error, low, stamp, scanned)


STATE_DDL = "code binary, error long, low binary, stamp binary, scanned long"


def _bytes(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    each = rows[0].nbytes if len(rows) else 0
    return pa.Array.from_buffers(
        pa.binary(), len(rows), [None, pa.py_buffer((np.arange(len(rows) + 1) * each).astype(np.int32)), pa.py_buffer(rows)]
    )


def _matrix(column: pa.Array, kind: type, *shape: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), *shape)


def _assigned(history: list[np.ndarray], groups: list[list[np.ndarray]]) -> Callable:
    parts, _, size = history[-1].shape
    count = len(groups[0])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            vectors = _matrix(batch.column("vector"), "<i4", parts * size)
            old = None
            if "code" in batch.schema.names:
                read = lambda name, kind, *shape: _matrix(batch.column(name), kind, parts, *shape)  # noqa: B023, E731
                old = State(read("code", np.uint8), None, read("low", np.float16, count), read("stamp", np.uint8, count), 0)
            found = assign(vectors, history, groups, old)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in ("vec_id", "label", "vector")), _bytes(found.code), pa.array(found.error.sum(axis=1)),
                 _bytes(found.low), _bytes(found.stamp), pa.array([found.scanned] + [0] * (len(batch) - 1), pa.int64())],
                names=["vec_id", "label", "vector", "code", "error", "low", "stamp", "scanned"],
            )

    return run


def _summed(shape: tuple[int, int, int]) -> Callable:
    parts, entries, size = shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(shape, np.int64), np.zeros(shape[:2], np.int64)
        for batch in batches:
            vectors = _matrix(batch.column("vector"), "<i4", parts, size).astype(np.int64)
            code = _matrix(batch.column("code"), np.uint8, parts)
            for part in range(parts):
                np.add.at(total[part], code[:, part], vectors[:, part])
                count[part] += np.bincount(code[:, part], minlength=entries)
        part, entry = np.nonzero(count)
        sums = pa.ListArray.from_arrays(pa.array((np.arange(len(part) + 1) * size).astype(np.int32)), pa.array(total[part, entry].ravel()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry]), sums], names=["part", "entry", "n", "sums"]
        )

    return run


def _means(rows: DataFrame, book: np.ndarray) -> np.ndarray:
    """The next codebook: floors of the means of each entry's parts; an entry without parts stays as it is."""
    parts = rows.select("vector", "code").mapInArrow(_summed(book.shape), "part int, entry int, n long, sums array<long>")
    counts = parts.groupBy("part", "entry").agg(F.sum("n").alias("n"))
    each = parts.select("part", "entry", F.posexplode("sums").alias("place", "value"))
    sums = each.groupBy("part", "entry", "place").agg(F.sum("value").alias("total"))
    out = book.copy()
    # At most a row for every number of a codebook, whatever the table's size.
    for part, entry, place, total, n in sums.join(counts, ["part", "entry"]).select("part", "entry", "place", "total", "n").collect():
        out[part, entry, place] = total // n
    return out


class Codes(NamedTuple):
    """``rows``: ``vec_id, label, code, error, scanned``; ``books``: the codebooks of all rounds, by part, entry, position."""

    rows: DataFrame
    books: list[np.ndarray]


def compressed(
    vectors: DataFrame, column: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, groups: int = GROUPS
) -> Codes:
    """Codes of the vectors, one byte a part, and the codebooks.

    Left out are rows whose vector is null or holds a null or a component that is not finite; a component of 2^18 or
    more is an error.  The first codebook has the parts of the vectors of the ``entries`` smallest vec_ids, of equal
    ids the least vector first; a row without vec_id is coded, but is none of them.  The vector of the smallest vec_id sets
    the length: rows of another length, and all rows if it cannot be cut into equal parts or there is no vec_id, have a
    null code and error.  Repeated rows count as often as they occur.  Columns other than ``vec_id``, ``label`` and
    the vector are not read.
    """
    if not 0 < entries <= 256:
        raise ValueError("codes are bytes: from 1 to 256 entries")
    rows = written(kept_vectors(vectors, column), "codes-vectors")
    named = rows.filter("vec_id is not null").orderBy("vec_id", "vector")
    first = named.first()
    length = len(first["vector"]) if first else 0
    fits = F.length("vector") == length if first and length // 4 % parts == 0 else F.lit(False)
    seeds = [np.frombuffer(x["vector"], "<i4") for x in named.filter(fits).limit(entries).collect()]
    odd = rows.filter(~fits).select("vec_id", "label", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"),
                                    F.lit(0).cast("long").alias("scanned"))
    if not seeds:
        return Codes(odd, [])
    book = np.stack(seeds).astype(np.int64).reshape(len(seeds), parts, -1).transpose(1, 0, 2)
    some = near_groups(book, groups)
    history, now = [book], rows.filter(fits)
    base = f"vec_id long, label {rows.schema['label'].dataType.simpleString()}, vector binary"
    for _ in range(rounds):
        now = written(now.mapInArrow(_assigned(history, some), f"{base}, {STATE_DDL}"), "codes-state")
        history.append(_means(now, history[-1]))
    now = written(now.mapInArrow(_assigned(history, some), f"{base}, {STATE_DDL}").drop("vector", "low", "stamp"), "codes")
    return Codes(now.select(*odd.columns).unionByName(odd), history)


def restored(codes: DataFrame, book: np.ndarray) -> DataFrame:
    """``vec_id, vector``: the components that a code stands for, null for a null code."""
    parts, _, size = book.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [None if x is None else (book[np.arange(parts), np.frombuffer(x, np.uint8)].ravel() / SCALE) for x in batch.column("code").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(values, pa.list_(pa.float64()))], names=["vec_id", "vector"])

    return codes.select("vec_id", "code").mapInArrow(run, "vec_id long, vector array<double>")


def books_digest(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def vector_codes(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Per kept row ``vec_id, code, error, label_error, codebooks_sha256``; see ``compressed``.

    ``code`` has two hex digits a part; ``label_error`` sums the errors of equal labels, null labels together, and counts a null
    error as 0.  Without a codebook its digest is null.
    """
    found = compressed(vectors, column)
    labels = written(found.rows.groupBy("label").agg(F.coalesce(F.sum("error"), F.lit(0)).alias("label_error")), "codes-labels")
    of_label = checked(labels.withColumnRenamed("label", "of_label"))
    rows = found.rows.join(of_label, F.col("label").eqNullSafe(F.col("of_label")))
    digest = F.lit(books_digest(found.books[-1]) if found.books else None).cast("string")
    return rows.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", digest.alias("codebooks_sha256"))


SQL = r"""
WITH v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS (SELECT vec_id, label, p, q[p * (len(q) // 16) + 1:(p + 1) * (len(q) // 16)] AS q FROM v, range(16) AS r(p)),
c0 AS (
  SELECT p, dense_rank() OVER (ORDER BY vec_id) - 1 AS e, q AS c FROM x
  WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT 64)),
a0 AS (
  SELECT vec_id, p, any_value(q) AS q, min(struct_pack(d := list_inner_product(q, q) - 2 * list_inner_product(q, c) + list_inner_product(c, c), e := e)) AS m
  FROM x JOIN c0 USING (p) GROUP BY vec_id, p),
s1 AS (
  SELECT p, e, list(floor(t / n) ORDER BY i) AS c FROM (
    SELECT p, m.e AS e, i, sum(q[i]) AS t, count(*) AS n FROM a0, range(1, 65) AS r(i) WHERE i <= len(q) GROUP BY p, m.e, i)
  GROUP BY p, e),
c1 AS (SELECT p, e, coalesce(s1.c, c0.c) AS c FROM c0 LEFT JOIN s1 USING (p, e)),
a1 AS (
  SELECT vec_id, p, any_value(q) AS q, min(struct_pack(d := list_inner_product(q, q) - 2 * list_inner_product(q, c) + list_inner_product(c, c), e := e)) AS m
  FROM x JOIN c1 USING (p) GROUP BY vec_id, p),
s2 AS (
  SELECT p, e, list(floor(t / n) ORDER BY i) AS c FROM (
    SELECT p, m.e AS e, i, sum(q[i]) AS t, count(*) AS n FROM a1, range(1, 65) AS r(i) WHERE i <= len(q) GROUP BY p, m.e, i)
  GROUP BY p, e),
c2 AS (SELECT p, e, coalesce(s2.c, c1.c) AS c FROM c1 LEFT JOIN s2 USING (p, e)),
a2 AS (
  SELECT vec_id, p, any_value(label) AS label, min(struct_pack(d := list_inner_product(q, q) - 2 * list_inner_product(q, c) + list_inner_product(c, c), e := e)) AS m
  FROM x JOIN c2 USING (p) GROUP BY vec_id, p),
f AS (
  SELECT vec_id, any_value(label) AS label, string_agg(lpad(lower(to_hex(m.e)), 2, '0'), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error
  FROM a2 GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, (
    SELECT sha256(string_agg(array_to_string(list_transform(c, lambda y: y::BIGINT::VARCHAR), ','), ',' ORDER BY p, e)) FROM c2) AS codebooks_sha256
FROM f
"""
