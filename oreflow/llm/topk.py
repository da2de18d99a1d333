"""Exact top-k by integer inner product, with block-at-a-time pruning.

The dimensions are the terms.  The index cuts the rows into slices and, within a slice, into blocks of similar rows.
A block holds the greatest and least value of every term and a forward index, its rows' values.  No row of a block
can score more than the sum of each term's best product with the query, so a query takes a slice's blocks by
falling bound and stops once the bound is below its k-th best score.

A first pass holds every query against one slice, which gives it a k-th score to reach.  In the second it meets the
other slices, but for those whose own maxima cannot reach that score, and gives out only rows that do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.sources.local import local_rows
from oreflow.sources.scratch import written

SCALE = 256
TOP = 5
BLOCK = 64
SLICE_ROWS = 65536
LEAST_ROWS = 4096  # of a slice, where a table is so small that there are cores without one
QUERY_ROWS = 65536
TILE_BYTES = 1 << 25  # of a slice's or a set of queries' 64-bit values, so that wide vectors meet fewer at a time
BOUND_BYTES = 1 << 26  # of the slices' maxima that queries are held against before they are dealt out
AT_ONCE = 256
_WHOLE = 1 << 62


def _quantized(values: np.ndarray) -> np.ndarray | None:
    if not np.isfinite(values).all():
        return None
    with np.errstate(over="ignore"):
        scaled = np.floor(values.astype(np.float64) * SCALE)
    if not (np.abs(scaled) < _WHOLE).all():
        raise OverflowError("256 times a component may not fit into 62 bits")
    return scaled.astype(np.int64)


def _quantize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, dims, rows = [], [], []
        for vec_id, values in zip(batch.column("vec_id").to_pylist(), batch.column("vector"), strict=True):
            values = values.values
            if vec_id is None or values is None or values.null_count:
                continue
            found = _quantized(values.to_numpy(zero_copy_only=False))
            if found is not None:
                ids.append(vec_id)
                dims.append(len(found))
                rows.append(found.astype("<i8").tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(rows, pa.binary())], names=["vec_id", "dim", "vector"]
        )


def quantized(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id, dim, vector``: floor(256 x) of every component, as 64-bit integers.

    Left out are rows without an id, and vectors that are null or hold a null or a component that is not finite.  A
    finite component beyond 62 bits is an error.  Rows that share an id are rows like any others.
    """
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).alias("vector"))
    return plain.mapInArrow(_quantize, "vec_id long, dim int, vector binary")


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(len(column), dim)


def _similar_order(rows: np.ndarray) -> np.ndarray:
    """Rows by the nearest of some of them, and by closeness to it: neighbours get similar term values."""
    pivots = rows[:: max(1, len(rows) // max(1, len(rows) // BLOCK))].astype(np.float64)
    unit = lambda x: x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    near = unit(rows.astype(np.float64)) @ unit(pivots).T
    best = near.argmax(axis=1)
    return np.lexsort((-near[np.arange(len(rows)), best], best))


INDEX_DDL = "dim int, slice int, ids binary, rows binary, forward binary, low binary, high binary, least binary, most binary"


def _build(key: tuple, table: pa.Table) -> pa.Table:
    dim = key[0].as_py()
    rows, ids, numbers = _matrix(table.column("vector"), dim), table.column("vec_id").to_numpy(), table.column("row").to_numpy()
    order = _similar_order(rows) if dim else np.argsort(ids)
    rows, ids, numbers = rows[order], ids[order], numbers[order]
    starts = np.arange(0, len(rows), BLOCK)
    low, high = (f.reduceat(rows, starts, axis=0) if dim else rows[starts] for f in (np.minimum, np.maximum))
    every = (ids, numbers, rows, low, high, low.min(axis=0), high.max(axis=0))
    values = [dim, key[1].as_py(), *(x.astype("<i8").tobytes() for x in every)]
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 7]
    names = [x.split()[0] for x in INDEX_DDL.split(", ")]
    return pa.table([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)


def exact_kind(a: np.ndarray, b: np.ndarray, dim: int) -> type:
    """A type in which inner products of rows of a and b are exact."""
    most = dim * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    if most >= 1 << 63:
        raise OverflowError("a score may not fit into 64 bits")
    return np.float64 if most < 1 << 53 else np.int64


def search(
    ids: np.ndarray,
    rows: np.ndarray,
    low: np.ndarray,
    high: np.ndarray,
    query_ids: np.ndarray,
    queries: np.ndarray,
    k: int,
    numbers: np.ndarray | None = None,
    reach: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query number, id, score) of each query's best k rows but its own, and how many rows were scored.

    ``numbers`` are what ``query_ids`` tells rows apart by, the ids unless given; rows below ``reach`` need not be found.
    """
    numbers = ids if numbers is None else numbers
    kind = exact_kind(rows, queries, rows.shape[1])
    rows, low, high, queries = (x.astype(kind) for x in (rows, low, high, queries))
    bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    order = np.argsort(-bounds, axis=1, kind="stable")
    none = np.iinfo(np.int64).min
    score, found = np.full((len(queries), k), none), np.full((len(queries), k), np.iinfo(np.int64).max)
    alive, scored = np.arange(len(queries)), 0
    for place in range(order.shape[1]):
        block = order[alive, place]
        # A bound equal to the k-th score may hide a smaller id.
        bound = bounds[alive, block].astype(np.int64)
        keep = (score[alive, -1] == none) | (bound >= score[alive, -1])
        keep &= True if reach is None else bound >= reach[alive]
        alive, block = alive[keep], block[keep]
        if not len(alive):
            break
        for number in np.unique(block):
            who = alive[block == number]
            part = slice(number * BLOCK, min((number + 1) * BLOCK, len(rows)))
            got = (queries[who] @ rows[part].T).astype(np.int64)
            scored += got.size
            got[numbers[part][None, :] == query_ids[who][:, None]] = none
            every = np.concatenate([score[who], got], axis=1)
            names = np.concatenate([found[who], np.broadcast_to(ids[part], got.shape)], axis=1)
            best = np.lexsort((names, ~every), axis=1)[:, :k]  # ~x falls as x rises, and cannot overflow
            score[who], found[who] = np.take_along_axis(every, best, 1), np.take_along_axis(names, best, 1)
    which, rank = np.nonzero((score != none) if reach is None else (score != none) & (score >= reach[:, None]))
    return which, found[which, rank], score[which, rank], scored


FOUND_DDL = "query long, query_id long, vec_id long, score long"


def _search(k: int):
    def run(key: tuple, index: pa.Table, queries: pa.Table) -> pa.Table:
        out = [[np.empty(0, np.int64)] for _ in range(4)]
        if len(index) and len(queries):
            dim = key[0].as_py()
            read = lambda name: np.frombuffer(index.column(name)[0].as_py(), "<i8")
            ids, numbers = read("ids"), read("rows")
            rows, low, high = (read(x).reshape(-1, dim) if dim else np.zeros((n, 0), np.int64)
                               for x, n in (("forward", len(ids)), ("low", -(-len(ids) // BLOCK)), ("high", -(-len(ids) // BLOCK))))
            matrix, asked, names = _matrix(queries.column("vector"), dim), queries.column("row").to_numpy(), queries.column("vec_id").to_numpy()
            reach = queries.column("reach").to_numpy()
            for i in range(0, len(names), AT_ONCE):
                part = slice(i, i + AT_ONCE)
                which, found, score, _ = search(ids, rows, low, high, asked[part], matrix[part], k, numbers, reach[part])
                for x, y in zip(out, (asked[part][which], names[part][which], found, score), strict=True):
                    x.append(y)
        return pa.table([pa.array(np.concatenate(x)) for x in out], names=["query", "query_id", "vec_id", "score"])

    return run


def _dealt(count: int, each: int) -> int:
    return max(1, -(-count // each))


def slice_bounds(queries: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """No row of a slice scores more: by query and slice, in Python's integers where 64 bits might not do."""
    kind = object if queries.shape[1] * int(np.abs(queries).max(initial=0)) * int(max(np.abs(least).max(initial=0), np.abs(most).max(initial=0))) >= 1 << 53 else np.float64
    queries, least, most = (x.astype(kind) for x in (queries, least, most))
    return np.maximum(queries, 0) @ most.T + np.minimum(queries, 0) @ least.T


def _reachable(maxima: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]):
    """Queries with the slices other than their first whose maxima reach their score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                some = batch.filter(pa.array(dims == dim))
                numbers, least, most = maxima[dim]
                for start in range(0, len(some), AT_ONCE):
                    part = some.slice(start, AT_ONCE)
                    bounds = slice_bounds(_matrix(part.column("vector"), dim), least, most)
                    first, reach = part.column("slice").to_numpy(), part.column("reach").to_numpy()
                    who, at = np.nonzero((bounds >= reach[:, None]) & (numbers[None, :] != first[:, None]))
                    rows = part.take(pa.array(who))
                    yield pa.RecordBatch.from_arrays(
                        [*(rows.column(x) for x in ("row", "vec_id", "dim", "vector", "reach", "set")), pa.array(numbers[at].astype(np.int32))],
                        names=["row", "vec_id", "dim", "vector", "reach", "set", "slice"],
                    )

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = TOP, column: str = "embedding", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that ``is_query`` picks, its best ``k`` other rows of all.

    Exact: ties go to the smaller id, fewer than k rows give fewer ranks.  See ``quantized`` for rows that take no
    part; rows of different length do not meet.  A row is told apart by its place and not by its id, so of several rows
    with one id each is a query and a candidate of the others.  Slices and sets of queries hold at most about
    ``slice_rows`` and ``QUERY_ROWS`` rows, and fewer of wide vectors.
    """
    rows = written(quantized(vectors, column), "topk-vectors").select(F.monotonically_increasing_id().alias("row"), "*")
    asked = rows.filter(is_query)
    widths = rows.groupBy("dim").agg(F.count("*").alias("n"), F.count_if(is_query).alias("asked"))
    spark = rows.sparkSession
    busy = 2 * spark.sparkContext.defaultParallelism
    dealt = [
        (dim, max(_dealt(n, _tile(slice_rows, dim)), min(busy, n // LEAST_ROWS)), _dealt(some, _tile(QUERY_ROWS, dim)))
        for dim, n, some in widths.collect()
    ]
    counts = F.broadcast(local_rows(spark, dealt, "dim INT, slices INT, sets INT"))
    cut = F.pmod(F.xxhash64("row"), F.col("slices")).cast("int")
    placed = rows.join(counts, "dim").withColumn("slice", cut)
    index = written(placed.groupBy("dim", "slice").applyInArrow(_build, INDEX_DDL), "topk-index")
    # A query's first slice is its own: dealt by a hash, so any is as good.
    queries = asked.join(counts, "dim").withColumn("slice", cut).withColumn("set", F.pmod(F.xxhash64("row", F.lit("set")), F.col("sets")).cast("int"))
    columns = ["row", "vec_id", "dim", "vector", "reach", "set", "slice"]
    least = F.lit(np.iinfo(np.int64).min)

    def meet(some: DataFrame) -> DataFrame:
        keys = ["dim", "slice", "set"]
        # Slices are as many as there are sets that meet them.
        wanted = index.drop("least", "most").join(counts.select("dim", "sets"), "dim")
        left = wanted.withColumn("set", F.explode(F.sequence(F.lit(0), F.col("sets") - 1))).drop("sets")
        return left.groupBy(*keys).cogroup(some.groupBy(*keys)).applyInArrow(_search(k), FOUND_DDL)

    first = written(meet(queries.withColumn("reach", least).select(*columns)), "topk-first")
    kth = first.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
    reach = kth.select(F.col("query").alias("row"), F.when(F.col("n") >= k, F.col("kth")).alias("kth"))
    ready = queries.join(reach, "row", "left").withColumn("reach", F.coalesce("kth", least)).select(*columns)
    found = first.unionByName(meet(_further(ready, index, dealt)))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _tile(rows: int, dim: int) -> int:
    return max(1, min(rows, TILE_BYTES // (8 * max(dim, 1))))


def _further(queries: DataFrame, index: DataFrame, dealt: list[tuple[int, int, int]]) -> DataFrame:
    """Queries with each slice beyond their first that could hold a row they want; with all of them if there are so many
    slices that their maxima are no small table."""
    if sum(16 * dim * slices for dim, slices, _ in dealt) > BOUND_BYTES:
        sizes = F.broadcast(local_rows(queries.sparkSession, [x[:2] for x in dealt], "dim INT, slices INT"))
        every = queries.join(sizes, "dim").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        return every.filter("other != slice").drop("slice", "slices").withColumnRenamed("other", "slice")
    maxima: dict[int, tuple] = {}
    for dim in sorted({x[0] for x in dealt}):
        own = index.filter(F.col("dim") == dim).select("slice", "least", "most").collect()
        read = lambda name: np.stack([np.frombuffer(x[name], "<i8") for x in own])  # noqa: B023, E731
        maxima[dim] = (np.array([x["slice"] for x in own]), read("least"), read("most"))
    return queries.mapInArrow(_reachable(maxima), "row long, vec_id long, dim int, vector binary, reach long, set int, slice int")


SQL = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.row, a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.row <> b.row AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
