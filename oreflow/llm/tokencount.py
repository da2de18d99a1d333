"""Token counts by SentencePiece: pre-tokens that are single vocabulary entries are counted without merging.

The model is split where no merge can happen.  What is used about a vocabulary is proved from it when it is
loaded (``prove``); where a proof fails the texts go to the library whole.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from oreflow.llm.text import per_slice

MODEL = "piece_bpe_32k.model"
KEPT_COUNTS = 1 << 20
KEPT_CHARS = 1 << 25
_SPACE = "▁"
_LETTER, _STOPS = "[A-Za-zÀ-ÖØ-öø-ÿ]", ".,;:!?"


class TokenCounter:
    """Exact numbers of tokens of whole texts, without begin or end tokens."""

    def __init__(self, path: str, kept: int = KEPT_COUNTS):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.kept = kept
        self.single: dict[str, int] = {}
        self.counts: dict[str, int] = {}
        self.chars = 0
        self.exact_split = self.prove()

    def prove(self) -> bool:
        """Prove offline, from the vocabulary and probes of the library, that texts may be split and how.

        Split before a space that follows another character, on both sides of a line end, and between a letter
        and a stop.  Sound if no entry holds a space mark after another character, a line end, or a stop after
        a letter: then no merge crosses.  Also needed: spaces are kept and only turned into marks, and one mark
        is put before a text.
        Then every entry that the library encodes alone as one token is noted as such.
        """
        m = self.model
        entries = [m.id_to_piece(i) for i in range(m.get_piece_size())
                   if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
        if any(re.search(f"[^{_SPACE}]{_SPACE}|\n|{_LETTER}[{_STOPS}]", x) for x in entries):
            return False
        probes = {"a  b": "▁a|▁|▁b", "\n": "▁|<0x0A>", "a\na": "▁a|<0x0A>|a", " ": "▁▁", "a ": "▁a|▁", "": ""}
        if any("|".join(m.encode(x, out_type=str)) != y for x, y in probes.items()):
            return False
        # As it stands after a space: the library's mark for the text's start is that space.
        alone = [x for x in entries if x.startswith(_SPACE) and len(x) > 1 and not x.startswith(_SPACE * 2)]
        found = m.encode([x[1:] for x in alone], num_threads=1)
        self.single = {x.replace(_SPACE, " "): 1 for x, ids in zip(alone, found, strict=True) if len(ids) == 1}
        self.counts = dict(self.single)
        return True

    # A pre-token is spaces and letters up to a stop, space or line end; or any characters up to a space or line
    # end; or spaces; or one line end.
    _split = re.compile(rf" *{_LETTER}++(?=[{_STOPS} \n]|\Z)| *[^ \n]+| +|\n").findall

    def _learn(self, fresh: list[str]) -> None:
        """Counts of pre-tokens not seen before, by the library.

        One that begins with a space is encoded without it, as the library puts a mark there.  Any other is encoded
        after a line end, with which nothing merges; the mark and the line end before it are two tokens.
        """
        self.chars += sum(map(len, fresh))
        spaced = [x for x in fresh if x[0] == " " and x != " "]
        self.counts.update(zip(spaced, map(len, self.model.encode([x[1:] for x in spaced], num_threads=1)), strict=True))
        self.counts[" "] = 1
        other = [x for x in fresh if x[0] != " "]
        found = map(len, self.model.encode(["\n" + x for x in other], num_threads=1))
        self.counts.update((x, n - 2) for x, n in zip(other, found, strict=True))

    def __call__(self, texts: list[str]) -> list[int]:
        # A mark or a zero byte in a text was in no proof: such texts go to the library whole.
        plain = [bool(x) and self.exact_split and "\0" not in x and _SPACE not in x for x in texts]
        split = [self._split(" " + x) if y else [] for x, y in zip(texts, plain, strict=True)]
        fresh = set().union(*split)
        if len(self.counts) + len(fresh) > self.kept or self.chars > KEPT_CHARS:
            self.counts, self.chars = dict(self.single), 0
        self._learn([x for x in fresh if x not in self.counts])
        known = self.counts.__getitem__
        return [
            sum(map(known, parts)) if y else len(self.model.encode(x)) if x else 0
            for x, y, parts in zip(texts, plain, split, strict=True)
        ]


@cache
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


COUNT_DDL = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 4096) -> DataFrame:
    """Per document: UTF-8 bytes, tokens, and whether there are more than ``limit``.

    Null text: as empty, no tokens.  Repeated rows: one row each.  A null doc_id stays null.  Other columns are
    not read.  Very long texts are counted whole, each in a slice of its own.
    """
    path = path or public_tokenizers.path(MODEL)

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        texts = [x or "" for x in piece.column("text").to_pylist()]
        n = np.asarray(counter(path)(texts), dtype=np.int64)
        size = np.asarray([len(x.encode()) for x in texts], dtype=np.int64)
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id").cast(pa.int64()), pa.array(size), pa.array(n), pa.array(n > limit)],
            names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )

    return docs.select("doc_id", "text").mapInArrow(per_slice(work), COUNT_DDL)
