"""Language by compression: the language whose dictionary makes a text smallest.

Each language has a zstandard raw-content dictionary cut from texts of that language.  Letters only, in lower case
and spaced where anything else stood, are compressed: case, marks and digits tell little.  That is done in
pieces, each by every dictionary afresh, so that a long text does not become its own dictionary; all of it counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.sampling import held_out, placed_below, share
from oreflow.llm.text import per_slice
from oreflow.sources.scratch import written

UNKNOWN = "und"
DICTIONARY_BYTES = 1 << 17
SAMPLE_DOCS = 200
SAMPLE_CHARS = 2 * DICTIONARY_BYTES
PIECE_BYTES = 2048
PART_BYTES = 2048  # of a text, that it gives to a dictionary at a turn
MOST_LANGUAGES = 256
LEVEL = 6
SHARPNESS = 0.25  # of the score: nats for a byte
_LETTER = regex.compile(r"\p{L}").search
_OTHER = re.compile(r"[\W\d_]+").sub


def plain(text: str) -> bytes:
    return _OTHER(" ", text.lower()).encode()


def _cut(data: bytes, size: int) -> list[bytes]:
    return [data[i : i + size] for i in range(0, len(data), size)]


def _turns(sizes: list[int], size: int, part: int) -> int:
    """How many parts of a text are looked at when texts of these sizes give a part in turn until ``size`` bytes are there."""
    total = turn = 0
    while total < size and any(x > turn * part for x in sizes):
        total += sum(min(part, x - turn * part) for x in sizes if x > turn * part)
        turn += 1
    return turn


def _in_turn(texts: list[bytes], size: int, part: int) -> bytes:
    parts = [_cut(x, part) for x in texts]
    chosen, total, turn = [], 0, 0
    while total < size and any(len(x) > turn for x in parts):
        for x in parts:
            if len(x) > turn and total < size:
                chosen.append(x[turn])
                total += len(x[turn])
        turn += 1
    return b" ".join(chosen)[:size]


def dictionaries(texts: list[tuple[str, str]], size: int = DICTIONARY_BYTES, part: int = PART_BYTES) -> dict[str, bytes]:
    """From (language, text) pairs, content of at most ``size`` bytes for each language, taken in turn from its texts."""
    own: dict[str, list[bytes]] = {}
    for lang, text in texts:
        own.setdefault(lang, []).append(plain(text))
    return {lang: _in_turn(own[lang], size, part) for lang in sorted(own)}


class Compressors:
    def __init__(self, content: tuple[tuple[str, bytes], ...], level: int = LEVEL):
        self.names = [name for name, _ in content]
        self.each = []
        for _, data in content:
            held = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=level)
            made = zstandard.ZstdCompressor(
                dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False
            )
            self.each.append(made.compress)

    def sizes(self, data: bytes, piece: int = PIECE_BYTES) -> list[int]:
        parts = _cut(data, piece) or [b""]
        return [sum(len(compress(x)) for x in parts) for compress in self.each]

    def decide(self, text: str | None, min_margin: float) -> tuple[str, float, float]:
        """(language, score, margin); the margin is how much larger the second smallest is, as a share."""
        if not text or not _LETTER(text) or not self.names:
            return UNKNOWN, 0.0, 0.0
        sizes = np.array(self.sizes(plain(text)), dtype=float)
        best = int(sizes.argmin())
        score = 1 / np.exp(np.clip(-SHARPNESS * (sizes - sizes[best]), -50, 0)).sum()
        margin = np.partition(sizes, 1)[1] / sizes[best] - 1 if len(sizes) > 1 else 1.0
        return (self.names[best] if margin >= min_margin else UNKNOWN), float(score), float(margin)


@lru_cache(4)
def compressors(content: tuple[tuple[str, bytes], ...]) -> Compressors:
    return Compressors(content)


def _plain_texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = pa.array([plain(x) for x in batch.column("text").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("doc_id"), found], names=["lang", "doc_id", "plain"])


def learn(
    docs: DataFrame, per_lang: int = SAMPLE_DOCS, size: int = DICTIONARY_BYTES, part: int = PART_BYTES, most: int = MOST_LANGUAGES
) -> dict[str, bytes]:
    """Dictionaries from about ``per_lang`` documents of each language, of the learning fold, chosen by a hash of the id.

    A document counts once, however often it is repeated, and gives at most ``SAMPLE_CHARS`` characters to choose from.
    More than ``most`` languages are an error, as they would be with a column of something else.  The driver gets the
    sizes of the sample, and of each text only the turns it has in its dictionary: ``size`` bytes a language and a part a text.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    counts = known.groupBy("lang").count().limit(most + 1).collect()
    if len(counts) > most:
        raise ValueError(f"more than {most} languages to learn")
    if not counts:
        return {}
    below = F.coalesce(*[F.when(F.col("lang") == row["lang"], share(row["count"], per_lang)) for row in counts])
    chosen = known.filter(placed_below(below)).select("lang", "doc_id", F.left("text", F.lit(SAMPLE_CHARS)).alias("text"))
    sample = chosen.groupBy("lang", "doc_id").agg(F.min("text").alias("text"))
    kind = sample.schema["doc_id"].dataType.simpleString()
    sample = written(sample.mapInArrow(_plain_texts, f"lang string, doc_id {kind}, plain binary"), "languages-sample")
    sizes: dict[str, list[int]] = {}
    for row in sample.select("lang", F.octet_length("plain").alias("n")).collect():
        sizes.setdefault(row["lang"], []).append(row["n"])
    keep = F.coalesce(*[F.when(F.col("lang") == x, _turns(n, size, part) * part) for x, n in sizes.items()])
    texts: dict[str, list[bytes]] = {}
    for row in sample.select("lang", "doc_id", F.substring("plain", F.lit(1), keep).alias("plain")).orderBy("lang", "doc_id").collect():
        texts.setdefault(row["lang"], []).append(bytes(row["plain"]))
    return {lang: _in_turn(texts[lang], size, part) for lang in sorted(texts)}


DDL = "doc_id long, lang_pred string, score double, margin double"


def languages(docs: DataFrame, content: dict[str, bytes] | None = None, min_margin: float = 0.0) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, lang_pred, score, margin``.

    ``lang_pred`` is a learned value; ``und`` for a text that is null, has no letter, or whose margin is below
    ``min_margin``, and for all if nothing was learned.  Ties go to the language first by name.  Repeated rows: one row each.
    Very long texts are scored whole, in pieces.
    Only the text enters a prediction; other columns are not read.
    """
    held = tuple(sorted((learn(docs) if content is None else content).items()))

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        decide = compressors(held).decide
        found = [decide(x, min_margin) for x in piece.column("text").to_pylist()]
        lang, score, margin = zip(*found, strict=True) if found else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id").cast(pa.int64()), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
             pa.array(margin, pa.float64())],
            names=["doc_id", "lang_pred", "score", "margin"],
        )

    found = docs.select("doc_id", "text").mapInArrow(per_slice(work), DDL)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "margin")


