"""Token ids of documents in shard files: tokenized, ordered by document, packed with Simple-8b, read back.

A shard is one file written by Spark's committer, so a lost task leaves nothing half-written in any store.  Its
rows are groups of whole documents in ascending order, each group a Simple-8b stream of about ``GROUP_IDS`` ids
with the offsets of its blocks and a directory of its documents.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from oreflow.llm import simple8b
from oreflow.llm.text import slices
from oreflow.sources.scratch import scratch_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
GROUP_IDS = 1 << 18
KEPT_UNITS = 1 << 20
KEPT_CHARS = 1 << 25


class UnitEncoder:
    """Ids of whole texts by the tokenizers library, which sees each unit of text once.

    The normalizer turns white space into spaces, the pattern drops them, and no match of it holds both a letter
    and a stop; special strings hold neither white space nor a stop.  So a text may be cut at white space and
    between a letter and a stop, and its ids are those of the units, one after the other.  Anything else between
    white space is a unit as a whole.  A run of letters is one match, which goes to the library's model directly.
    Lower-casing letter by letter, as the normalizer does, may come first where no special string can arise.
    """

    _letter, _stop = "A-Za-zÀ-ÖØ-öø-ÿ", ".,!?;:"
    _units = re.compile(
        rf"[{_letter}]++(?=[{_stop} \t\n\r]|\Z)|[{_stop}]++(?=[{_letter} \t\n\r]|\Z)|[^ \t\n\r]+"
    ).findall
    _word = re.compile(rf"[{_letter}]+").fullmatch

    def __init__(self, path: str, kept: int = KEPT_UNITS):
        self.tokenizer = Tokenizer.from_file(path)
        self.kept = kept
        letters = [chr(x) for x in range(256) if self._word(chr(x))]
        self.alphabet = str.maketrans({x: self._as_bytes(x) for x in letters})
        probe = "".join(letters)
        self.direct = self._model(probe) == self.tokenizer.encode(probe, add_special_tokens=False).ids
        self._forget()

    def _as_bytes(self, text: str) -> str:
        return "".join(x for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text))

    def _model(self, word: str) -> list[int]:
        low = word.lower()
        return [x.id for x in self.tokenizer.model.tokenize(low if low.isascii() else low.translate(self.alphabet))]

    def _forget(self) -> None:
        self.number = _Numbers()
        self.chars = 0
        self.ids = np.empty(0, dtype=np.uint32)
        self.begin = np.zeros(1, dtype=np.int64)

    def _learn(self, units: list[str]) -> None:
        """Have the library encode units that have got the next numbers."""
        found = [self._model(x) if self.direct and self._word(x) else None for x in units]
        rest = [i for i, x in enumerate(found) if x is None]
        got = self.tokenizer.encode_batch([units[i] for i in rest], add_special_tokens=False)
        for i, x in zip(rest, got, strict=True):
            found[i] = x.ids
        self.chars += sum(map(len, units))
        counts = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        ids = np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=counts.sum())
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(counts)])
        self.ids = np.concatenate([self.ids, ids])

    @staticmethod
    def _lower(text: str) -> str:
        if "<|" in text:
            return text
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return text
        return text.lower()

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, how many each has)."""
        if len(self.number) > self.kept or self.chars > KEPT_CHARS:
            self._forget()
        split = [self._units(self._lower(x)) for x in texts]
        per_text = np.concatenate([[0], np.cumsum(np.fromiter(map(len, split), dtype=np.int64, count=len(split)))])
        known = len(self.number)
        units = np.fromiter(map(self.number.__getitem__, chain.from_iterable(split)), dtype=np.int64, count=per_text[-1])
        if len(self.number) > known:
            self._learn(list(islice(self.number, known, None)))
        begin = self.begin[units]
        sizes = self.begin[units + 1] - begin
        stops = np.concatenate([[0], np.cumsum(sizes)])
        out = self.ids[np.arange(stops[-1]) + np.repeat(begin - stops[:-1], sizes)]
        return out, np.diff(stops[per_text])


class _Numbers(dict):
    """Numbers from 0 in the order in which keys are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = out = len(self)
        return out


@cache
def encoder(path: str) -> UnitEncoder:
    return UnitEncoder(path)


SHARD_BYTES = 32 << 20  # of text
MOST_SHARDS = 20_000  # beyond which shards grow; a shard is written in groups, so its size is no matter of memory
GROUP_DDL = (
    "shard int, group int, doc_ids array<long>, doc_ends array<long>, n_ids long, words binary, offsets binary,"
    " escaped_at array<long>, escaped array<long>"
)


def _group(shard: int, number: int, docs: list, ends: list[int], ids: list[np.ndarray]) -> pa.RecordBatch:
    packed = simple8b.pack(np.concatenate(ids) if ids else np.empty(0, np.uint64))
    row = [shard, number, docs, ends, packed.count, packed.words.astype("<u8").tobytes(),
           packed.offsets.astype("<i8").tobytes(), packed.escaped_at.tolist(), packed.escaped.astype(np.int64).tolist()]
    kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.binary(),
             pa.list_(pa.int64()), pa.list_(pa.int64())]
    names = [x.strip().split(" ")[0] for x in GROUP_DDL.split(",")]
    return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=names)


def _pack_shards(path: str, end_id: int, group_ids: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, state = encoder(path), {"shard": None, "number": 0, "docs": [], "ends": [], "ids": [], "n": 0}

        def flush() -> Iterator[pa.RecordBatch]:
            if state["docs"]:
                yield _group(state["shard"], state["number"], state["docs"], state["ends"], state["ids"])
                state.update(number=state["number"] + 1, docs=[], ends=[], ids=[], n=0)

        for batch in batches:
            for piece in slices(batch):
                ids, counts = encode([x or "" for x in piece.column("text").to_pylist()])
                at = 0
                shards, docs = piece.column("shard").to_pylist(), piece.column("doc_id").to_pylist()
                for shard, doc, count in zip(shards, docs, counts.tolist(), strict=True):
                    if shard != state["shard"] or state["n"] + count >= group_ids:
                        yield from flush()
                    if shard != state["shard"]:
                        state.update(shard=shard, number=0)
                    state["ids"] += [ids[at : at + count], np.array([end_id], dtype=np.uint32)]
                    state["n"] += count + 1
                    state["docs"].append(doc)
                    state["ends"].append(state["n"])
                    at += count
        yield from flush()

    return run


def write_token_shards(
    docs: DataFrame, out: str, path: str | None = None, end_id: int = END_ID, group_ids: int = GROUP_IDS, shards: int | None = None
) -> None:
    """Write the ids of every text, each followed by ``end_id``, in ascending order of doc_id and then of the text's hash.

    Null text: as empty, the end id alone.  Null doc_ids come first.  Other columns are not read.  Shard i comes before
    shard i + 1; texts are dealt out by ranges of that order before they are tokenized, so nothing is tokenized twice, ids
    are never shuffled, and rows of one doc_id, or of none, spread over shards like others.  Equal tables give equal files.
    Their number follows the bytes of the texts.  Very long texts are encoded whole, each in a slice of its own.
    """
    path = path or public_tokenizers.path(TOKENIZER)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if shards is None:
        size = plain.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        shards = min(max(1, -(-size // SHARD_BYTES)), MOST_SHARDS)
    ordered = (
        plain.withColumn("hash", F.xxhash64("text"))
        .repartitionByRange(shards, "doc_id", "hash")
        .sortWithinPartitions("doc_id", "hash", "text")
    )
    placed = ordered.select(F.spark_partition_id().alias("shard"), "doc_id", "text")
    placed.mapInArrow(_pack_shards(path, end_id, group_ids), GROUP_DDL).write.parquet(out)


def _unpacked(row: dict) -> simple8b.Packed:
    return simple8b.Packed(
        row["n_ids"], np.frombuffer(row["words"], "<u8"), np.frombuffer(row["offsets"], "<i8"),
        np.asarray(row["escaped_at"], dtype=np.int64), np.asarray(row["escaped"], dtype=np.int64).view(np.uint64),
    )


DOCUMENT_DDL = "shard int, group int, doc_id long, at long, n_tokens long, ids_crc32 long"


def _read_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            ids = simple8b.unpack(_unpacked(row)).astype("<u4")
            ends = np.asarray(row["doc_ends"], dtype=np.int64)
            begins = np.concatenate([[0], ends[:-1]])
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begins, ends, strict=True)]
            n = len(ends)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, row["shard"], np.int32)), pa.array(np.full(n, row["group"], np.int32)),
                 pa.array(row["doc_ids"], pa.int64()), pa.array(begins), pa.array(ends - begins), pa.array(crc, pa.int64())],
                names=["shard", "group", "doc_id", "at", "n_tokens", "ids_crc32"],
            )


def read_token_shards(spark: SparkSession, out: str) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``; start counts the ids of all before it.

    What lies before a group is summed from the groups' sizes: within a shard, and over the shards' totals.
    """
    files = spark.read.schema(GROUP_DDL).parquet(out)
    sizes = files.select("shard", "group", "n_ids")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    totals = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n"))  # one row a shard
    base = totals.select("shard", F.coalesce(F.sum("n").over(before.orderBy("shard")), F.lit(0)).alias("base"))
    inner = F.coalesce(F.sum("n_ids").over(before.partitionBy("shard").orderBy("group")), F.lit(0))
    first = sizes.select("shard", "group", inner.alias("inner")).join(base, "shard")
    first = first.select("shard", "group", (F.col("base") + F.col("inner")).alias("first"))
    rows = files.mapInArrow(_read_groups, DOCUMENT_DDL)
    return rows.join(first, ["shard", "group"]).select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_ids(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write shards below the shared folder and read them back."""
    out = scratch_path(docs.sparkSession, "token-shards")
    write_token_shards(docs, out, path)
    return read_token_shards(docs.sparkSession, out)

