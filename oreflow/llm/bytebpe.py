"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from oreflow.llm.text import per_slice

RANKS = "byte_bpe_multi_50k.tiktoken"
LONG = 1 << 16
# An ASCII letter, digit or full stop and then a space or line end: no match of the pattern holds both, no match
# that ends there looks ahead, and none that begins there looks back.  So texts may be cut there.
_CUT = regex.compile(r"(?<=[A-Za-z0-9.])(?=[ \n])")


@cache
def encoding(path: str, pattern: str = public_tokenizers.PATTERN) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, most: int = LONG) -> Iterator[str]:
    """A long text in pieces of about ``most`` characters, cut where no match can cross."""
    start = 0
    while len(text) - start > most:
        cut = _CUT.search(text, start + most)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode(bpe: tiktoken.Encoding, text: str, most: int = LONG) -> np.ndarray:
    """Token ids as little-endian unsigned 32-bit integers; special strings are ordinary text."""
    parts = [np.asarray(bpe.encode_ordinary(piece), dtype="<u4") for piece in pieces(text, most)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def byte_bpe_ids(docs: DataFrame, path: str | None = None, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with a column of token ids.  A null or empty text has none; repeated rows stay repeated."""
    path = path or public_tokenizers.path(RANKS)
    kept = [x for x in docs.columns if x != ids]

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        bpe = encoding(path)
        rows = [encode(bpe, x or "").tolist() for x in piece.column(text).to_pylist()]
        columns = [piece.column(x) for x in kept] + [pa.array(rows, pa.list_(pa.int32()))]
        return pa.RecordBatch.from_arrays(columns, names=[*kept, ids])

    plain = docs.select(*kept)
    schema = T.StructType([*plain.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    return plain.mapInArrow(per_slice(work, text), schema)


def byte_bpe_text(rows: DataFrame, path: str | None = None, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with the raw bytes of their ids.  Bytes, not text: ids cut at will need not be whole characters."""
    path = path or public_tokenizers.path(RANKS)
    kept = [x for x in rows.columns if x != out]

    def run(batches):
        for batch in batches:
            bpe = encoding(path)
            found = [bpe.decode_bytes(x or []) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(x) for x in kept] + [pa.array(found, pa.binary())], names=[*kept, out]
            )

    plain = rows.select(*kept)
    return plain.mapInArrow(run, T.StructType([*plain.schema.fields, T.StructField(out, T.BinaryType())]))


DIGEST_DDL = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_bpe_digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: number of ids, SHA-256 of the ids as little-endian 32-bit integers and of the decoded bytes.

    Null text: as empty.  Repeated rows: one row each.  A null doc_id stays null.  Other columns are not read.  Very long
    texts are encoded whole, cut where no match of the pattern can reach across.
    """
    path = path or public_tokenizers.path(RANKS)

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        bpe = encoding(path)
        n, of_ids, of_text = [], [], []
        for value in piece.column("text").to_pylist():
            ids = encode(bpe, value or "")
            n.append(len(ids))
            of_ids.append(hashlib.sha256(ids.tobytes()).hexdigest())
            of_text.append(hashlib.sha256(bpe.decode_bytes(ids.tolist())).hexdigest())
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(of_ids), pa.array(of_text)],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return docs.select("doc_id", "text").mapInArrow(per_slice(work), DIGEST_DDL)
