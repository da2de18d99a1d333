"""Merkle manifest of a dataset, with a proof for every row made by octopus multiproofs.

Rows are the leaves of one tree per group, the groups' subroots the leaves of a last tree.  A tree's leaves lie in
order in *chunks*, the leaf partitions: written rows of up to ``CHUNK`` leaves.  A chunk hashes what lies wholly
inside it and gives out only the nodes whose parent does not; the few nodes that cross chunks are hashed from
these, level by level.  Both together are the store, a few dozen nodes for each chunk.

For the proofs each chunk works out the minimal union of nodes that its leaves need and cannot make themselves, the
arms that reach into other chunks, and fetches these once from the store.  From its leaves and what it fetched it
derives all shared interiors, and expands the proof of each leaf on its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.llm.joins import checked
from oreflow.sources.scratch import written

ARITY = 8
CHUNK = 2048
STEP = 4
_HEX = 64  # bytes of a digest as text
_RUN = ARITY * _HEX
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(data: bytes) -> bytes:
    return sha256(data).hexdigest().encode()


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(x) for x in values]).cast("binary"), 256)


# --- levels of a tree ------------------------------------------------------------------------------------


def height(total: int) -> int:
    """How often nodes are joined until one remains."""
    levels = 0
    while total > 1:
        total, levels = -(-total // ARITY), levels + 1
    return levels


def joined(nodes: bytes) -> bytes:
    """The parents of nodes that begin with a run; the last run may be shorter."""
    return b"".join(digest(nodes[i : i + _RUN]) for i in range(0, len(nodes), _RUN))


def outer_nodes(start: int, total: int, nodes: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(level, place, digest) of nodes that leaves from ``start`` on make, and whose parent they do not make."""
    level, stop = 0, start + len(nodes) // _HEX
    while total > 1:
        first = -(-start // ARITY)
        last = -(-stop // ARITY) if stop == total else stop // ARITY
        inside = range(first * ARITY, min(last * ARITY, total)) if first < last else range(0)
        for place in (*range(start, inside.start), *range(inside.stop, stop)) if inside else range(start, stop):
            at = (place - start) * _HEX
            yield level, place, nodes[at : at + _HEX]
        if not inside:
            return
        nodes = joined(nodes[(inside.start - start) * _HEX : (inside.stop - start) * _HEX])
        start, stop, total, level = first, last, -(-total // ARITY), level + 1
    yield level, 0, nodes


def missing_nodes(places: np.ndarray, total: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each level, the places of the siblings that leaves at ``places`` need and neither are nor make."""
    level = 0
    while total > 1:
        runs = np.unique(places // ARITY)
        every = (runs[:, None] * ARITY + np.arange(ARITY)).ravel()
        yield level, np.setdiff1d(every[every < total], places, assume_unique=True)
        places, total, level = runs, -(-total // ARITY), level + 1


Path = list[tuple[bytes, bytes]]


def folded(node: bytes, path: Path) -> bytes:
    """The root that a node and the siblings left and right of it on every level lead to."""
    for left, right in path:
        node = digest(left + node + right)
    return node


class Branch:
    """All that a chunk's leaves and the fetched nodes make: each level's nodes in whole runs."""

    def __init__(self, start: int, total: int, nodes: bytes, fetched: Iterable[tuple[int, int, bytes]]):
        arms: dict[int, list] = {}
        for level, place, node in fetched:
            arms.setdefault(level, []).append((place, node))
        self.levels: list[tuple[int, bytes]] = []  # the first place and the nodes from there on
        level = 0
        while total > 1:
            own, beside = range(start, start + len(nodes) // _HEX), sorted(arms.get(level, ()))
            left = b"".join(x for place, x in beside if place < own.start)
            nodes = left + nodes + b"".join(x for place, x in beside if place >= own.stop)
            first = own.start // ARITY * ARITY
            if len(nodes) != _HEX * (min(-(-own.stop // ARITY) * ARITY, total) - first):
                raise ValueError("a chunk lacks nodes that it asked for")
            self.levels.append((first, nodes))
            nodes = joined(nodes)
            start, total, level = first // ARITY, -(-total // ARITY), level + 1
        self.root = nodes

    def path(self, place: int) -> Path:
        out = []
        for first, nodes in self.levels:
            run = place // ARITY * ARITY
            own = (place - first) * _HEX
            begin = (run - first) * _HEX
            out.append((nodes[begin:own], nodes[own + _HEX : begin + _RUN]))
            place //= ARITY
        return out

    def siblings(self, start: int, stop: int, above: bytes) -> list[bytes]:
        """The joined siblings of each leaf's whole proof; ``above`` are those beyond this tree."""
        found, before = [above], 0
        for level in range(len(self.levels) - 1, -1, -1):
            first, nodes = self.levels[level]
            size = ARITY**level
            here = []
            for place in range(start // size, -(-stop // size)):
                run, own = (place // ARITY * ARITY - first) * _HEX, (place - first) * _HEX
                here.append(nodes[run:own] + nodes[own + _HEX : run + _RUN] + found[place // ARITY - before])
            found, before = here, start // size
        return found if self.levels else [above]


# --- as Spark jobs ---------------------------------------------------------------------------------------


def _pack(chunk: int) -> Callable:
    """Sorted leaves as rows of up to ``chunk`` leaves of one tree."""

    def row(tree: str, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        text = lambda name: pa.array(["".join(table.column(name).to_pylist()).encode()], pa.binary())
        ids = pa.concat_arrays(table.column("id").chunks)
        return pa.RecordBatch.from_arrays(
            [pa.array([tree]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), text("leaf"), text("seen")],
            names=["tree", "ids", "leaves", "seen"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        tree = None
        for batch in batches:
            trees = np.array(batch.column("tree").to_pylist(), dtype=object)
            change = np.flatnonzero(trees[1:] != trees[:-1]) + 1 if len(trees) else []
            for start, stop in zip([0, *change], [*change, len(trees)], strict=True):
                while start < stop:
                    size = sum(map(len, held))
                    if held and (trees[start] != tree or size == chunk):
                        yield row(tree, held)
                        held, size = [], 0
                    tree, take = trees[start], min(stop - start, chunk - size)
                    held.append(batch.slice(start, take))
                    start += take
        if held:
            yield row(tree, held)

    return run


def _placed(chunks: DataFrame) -> DataFrame:
    """``chunk, tree, start, n, total``: where in its tree each chunk begins.  Chunks are counted by the partition that
    wrote them first, so no window holds more than a partition's chunks or a tree's partitions."""
    counts = chunks.select("chunk", F.shiftright("chunk", 33).alias("part"), "tree", F.size("ids").cast("long").alias("n"))
    parts = counts.groupBy("part", "tree").agg(F.sum("n").alias("own"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "part", "tree", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("before"), F.sum("own").over(whole).alias("total")
    )
    inside = Window.partitionBy("part", "tree").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("inner", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return counts.join(parts, ["part", "tree"]).select(
        "chunk", "tree", (F.col("before") + F.col("inner")).alias("start"), "n", "total"
    )


NODE_DDL = "tree string, level int, place long, node string, top int"


def _outer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for tree, start, total, leaves in zip(*(batch.column(x).to_pylist() for x in ("tree", "start", "total", "leaves")), strict=True):
            rows = [(tree, level, place, node.decode(), height(total)) for level, place, node in outer_nodes(start, total, leaves)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int32()), strict=True)],
                names=["tree", "level", "place", "node", "top"],
            )


def _crossed(low: int) -> Callable:
    """The nodes up to level ``low + STEP`` that those of one subtree of that height make."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        tree, top = rows[0]["tree"], rows[0]["top"]
        levels: dict[int, dict[int, str]] = {}
        for row in rows:
            levels.setdefault(row["level"], {})[row["place"]] = row["node"]
        made = []
        for level in range(low, min(low + STEP, top)):
            runs: dict[int, list[str]] = {}
            here = levels.get(level, {})
            for place in sorted(here):
                runs.setdefault(place // ARITY, []).append(here[place])
            for place, nodes in runs.items():
                node = digest("".join(nodes).encode()).decode()
                levels.setdefault(level + 1, {})[place] = node
                made.append({"tree": tree, "level": level + 1, "place": place, "node": node, "top": top})
        kinds = [("tree", pa.string()), ("level", pa.int32()), ("place", pa.int64()), ("node", pa.string()), ("top", pa.int32())]
        return pa.Table.from_pylist(made, pa.schema(kinds))

    return run


def _store(chunks: DataFrame) -> DataFrame:
    """The nodes at the edges of chunks and all that cross them, up to each tree's root.

    ``STEP`` levels are joined at a time, by subtrees of at most ``ARITY ** STEP`` nodes.
    """
    edges = written(chunks.select("tree", "start", "total", "leaves").mapInArrow(_outer, NODE_DDL), "merkle-edges")
    store, made = edges, None
    for low in range(0, edges.agg(F.max("top")).first()[0] or 0, STEP):
        here = edges.filter(F.col("level").between(low, low + STEP - 1))
        here = here if made is None else here.unionByName(made.filter(F.col("level") == low))
        above = F.floor(F.col("place") / F.pow(F.lit(ARITY), low + STEP - F.col("level"))).cast("long")
        crossing = here.filter("level < top").groupBy("tree", above.alias("above")).applyInArrow(_crossed(low), NODE_DDL)
        made = written(crossing, "merkle-crossing")
        store = store.unionByName(made)
    return store


def _missing(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(x).to_pylist() for x in ("chunk", "tree", "start", "n", "total")), strict=True)
        out = [
            (chunk, tree, level, place)
            for chunk, tree, start, n, total in rows
            for level, places in missing_nodes(np.arange(start, start + n), total)
            for place in places.tolist()
        ]
        columns = list(zip(*out, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.string(), pa.int32(), pa.int64()), strict=True)],
            names=["chunk", "tree", "level", "place"],
        )


class Forest(NamedTuple):
    """``chunks``: ``chunk, tree, ids, leaves, seen, start, n, total, arms``; ``roots``: ``tree, subroot``."""

    chunks: DataFrame
    roots: DataFrame


def forest(leaves: DataFrame, chunk: int = CHUNK) -> Forest:
    """The trees of ``tree, id, leaf, seen``; leaves ascend by id, nulls first, then by the leaf.  ``seen`` goes along."""
    kind = leaves.schema["id"].dataType.simpleString()
    ordered = leaves.repartitionByRange("tree", "id", "leaf").sortWithinPartitions("tree", "id", "leaf")
    packed = ordered.mapInArrow(_pack(chunk), f"tree string, ids array<{kind}>, leaves binary, seen binary")
    packed = written(packed.select(F.monotonically_increasing_id().alias("chunk"), "*"), "merkle-chunks")
    places = written(_placed(packed), "merkle-places")
    chunks = packed.drop("tree").join(checked(places), "chunk")
    store = _store(chunks)
    asked = places.mapInArrow(_missing, "chunk long, tree string, level int, place long")
    fetched = asked.join(store.drop("top"), ["tree", "level", "place"])
    arms = fetched.groupBy("chunk").agg(F.collect_list(F.struct("level", "place", "node")).alias("arms"))
    roots = store.filter("level = top").select("tree", F.col("node").alias("subroot"))
    return Forest(chunks.join(arms, "chunk", "left"), roots)


PATH_DDL = "array<struct<left:string,right:string>>"


def _branches(batch: pa.RecordBatch) -> Iterator[tuple[dict, Branch]]:
    for row in batch.to_pylist():
        fetched = ((x["level"], x["place"], x["node"].encode()) for x in row["arms"] or ())
        yield row, Branch(row["start"], row["total"], row["leaves"], fetched)


def _hex(nodes: bytes) -> list[bytes]:
    return [nodes[i : i + _HEX] for i in range(0, len(nodes), _HEX)]


def _paths(kind: pa.DataType) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, branch in _branches(batch):
                paths = [branch.path(row["start"] + i) for i in range(row["n"])]
                path = [[{"left": a.decode(), "right": b.decode()} for a, b in x] for x in paths]
                path_type = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["tree"]] * row["n"]), pa.array(row["ids"], kind), pa.array([x.decode() for x in _hex(row["leaves"])]),
                     pa.array(path, path_type)],
                    names=["tree", "id", "leaf", "path"],
                )

    return run


def proofs(trees: Forest) -> DataFrame:
    """``tree, id, leaf, path``: each leaf's proof in its tree, from the bottom: the siblings left and right of it."""
    kind = trees.chunks.schema["ids"].dataType.elementType
    arrow = {"bigint": pa.int64(), "string": pa.string()}[kind.simpleString()]
    return trees.chunks.mapInArrow(_paths(arrow), f"tree string, id {kind.simpleString()}, leaf string, path {PATH_DDL}")


CHECKED_DDL = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, branch in _branches(batch):
            above = [(x["left"].encode(), x["right"].encode()) for x in row["path"]]
            start, n, root = row["start"], row["n"], row["root"]
            leaves, seen = _hex(row["leaves"]), _hex(row["seen"])
            shared = folded(branch.root, above).decode()
            beyond = b"".join(a + b for a, b in above)
            proof = [sha256(x).hexdigest() for x in branch.siblings(start, start + n, beyond)]
            # A leaf as it was leads to the interiors that all of the chunk's leaves share.
            fold = [
                shared if a == b else folded(b, [*branch.path(start + i), *above]).decode()
                for i, (a, b) in enumerate(zip(leaves, seen, strict=True))
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], pa.int64()), pa.array([x.decode() for x in leaves]), pa.array([row["subroot"]] * n),
                 pa.array([root] * n), pa.array(proof), pa.array(fold), pa.array([x == root for x in fold])],
                names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
            )


def manifest(docs: DataFrame, chunk: int = CHUNK) -> tuple[Forest, Forest]:
    """The trees of ``docs``, one per lang, and the tree of their subroots.

    Leaves are digests of the columns ``FIELDS``; others are not read, so their names may be any.  A null is a value
    of its own in every column, and null langs are the first group.  Texts are hashed whole, whatever their length.
    Equal doc_ids follow each other by their leaf, repeated rows are leaves of their own.  An empty table has neither
    trees nor root.
    """
    return _trees(_leaves(docs, F.lit(None).cast("boolean")), chunk)


def _leaves(docs: DataFrame, lower: Column) -> DataFrame:
    values = {x: F.col(x) for x in FIELDS}
    own = leaf(*values.values())
    changed = values | {"text": F.translate("text", _UPPER, _LOWER)}
    # Null first, then by the bytes of the name.
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    rows = docs.select(*FIELDS).select(
        tree.alias("tree"), F.col("doc_id").cast("long").alias("id"), own.alias("leaf"), F.when(lower, leaf(*changed.values())).alias("seen")
    )
    return rows.withColumn("seen", F.coalesce("seen", "leaf"))


def _trees(leaves: DataFrame, chunk: int) -> tuple[Forest, Forest]:
    trees = forest(written(leaves, "merkle-leaves"), chunk)
    tops = trees.roots.select(
        F.lit("").alias("tree"), F.col("tree").alias("id"), F.col("subroot").alias("leaf"), F.col("subroot").alias("seen")
    )
    return trees, forest(tops, chunk)


def verified_manifest(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Per row ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``, as ``manifest`` builds the trees.

    The proof is a leaf's siblings joined from the bottom, left to right, through its group's tree and that of the
    subroots.  It is held against the row with the text's A-Z in lower case where the CRC-32 of the doc_id is a multiple
    of 3, else against the row itself.  A row without doc_id is not changed.
    """
    trees, top = _trees(_leaves(docs, F.crc32(F.col("doc_id").cast("string")) % 3 == 0), chunk)
    root = top.roots.first()
    above = proofs(top).select(
        F.col("id").alias("tree"), F.col("leaf").alias("subroot"), "path", F.lit(root and root["subroot"]).cast("string").alias("root")
    )
    return trees.chunks.join(above, "tree").mapInArrow(_verify, CHECKED_DDL)


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, row_number() OVER () AS k, list_reduce(
      list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
        lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, v: CASE WHEN v >= 0 THEN xor(c, v) ELSE xor(c >> 1, (c & 1) * 3988292384) END) AS crc,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM documents),
l AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM (
    SELECT doc_id, k, coalesce('=' || lang, '') AS tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
      CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS changed
    FROM d)),
node AS (
  SELECT tree, 0 AS level, place, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM l
  UNION ALL
  SELECT tree, level + 1, place // 8, sha256(string_agg(h, '' ORDER BY place)), any_value((n + 7) // 8) FROM node WHERE n > 1
  GROUP BY tree, level, place // 8),
sub AS (SELECT tree, h AS subroot, level AS top, row_number() OVER (ORDER BY encode(tree)) - 1 AS place FROM node WHERE n = 1),
upper AS (
  SELECT 0 AS level, place, subroot AS h, count(*) OVER () AS n FROM sub
  UNION ALL
  SELECT level + 1, place // 8, sha256(string_agg(h, '' ORDER BY place)), any_value((n + 7) // 8) FROM upper WHERE n > 1
  GROUP BY level, place // 8),
every AS (
  SELECT tree, level, place, h FROM node WHERE n > 1
  UNION ALL
  SELECT s.tree, s.top + u.level, u.place, u.h FROM sub s JOIN upper u ON u.n > 1),
walk AS (
  SELECT k, l.tree, 0 AS level, l.place, '' AS proof, coalesce(changed, leaf) AS h FROM l
  UNION ALL
  SELECT k, tree, level + 1, next // 8, proof || sides, h FROM (
    SELECT w.k, w.tree, w.level, CASE WHEN w.level = any_value(s.top) THEN any_value(s.place) ELSE w.place END AS next,
      w.proof, coalesce(string_agg(e.h, '' ORDER BY e.place)
        FILTER (e.place <> CASE WHEN w.level = s.top THEN s.place ELSE w.place END), '') AS sides,
      sha256(string_agg(CASE WHEN e.place = CASE WHEN w.level = s.top THEN s.place ELSE w.place END THEN w.h ELSE e.h END, ''
        ORDER BY e.place)) AS h
    FROM walk w JOIN sub s ON s.tree = w.tree JOIN every e
      ON e.tree = w.tree AND e.level = w.level AND e.place // 8 = CASE WHEN w.level = s.top THEN s.place ELSE w.place END // 8
    GROUP BY w.k, w.tree, w.level, w.place, w.proof, w.h)),
last AS (SELECT k, max_by(proof, level) AS proof, max_by(h, level) AS folded_root FROM walk GROUP BY k)
SELECT l.doc_id, l.leaf, s.subroot, u.h AS root, sha256(w.proof) AS proof_sha256, w.folded_root, w.folded_root = u.h AS verified
FROM l JOIN last w ON w.k = l.k JOIN sub s ON s.tree = l.tree JOIN upper u ON u.n = 1
"""
