"""Quality as a generalised additive model with pairwise interactions.

Cyclic boosting: feature after feature, again and again, a shallow tree over that feature's bins is fitted to the
current gradient and a small part of it added to the feature's lookup table; then the same for the pairs of
features that explain most of what is left.  A score is a sum of table entries, one for each feature and pair.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.sampling import held_out, labelled_sample
from oreflow.llm.text import Words, per_slice, shingle_hashes, text_bytes
from oreflow.sources.scratch import written

FEATURES = (
    "log_words", "mean_word", "long_words", "one_letter_words", "distinct_words", "distinct_trigrams", "repeated_next",
    "top_word", "upper", "digits", "stops", "other_marks", "non_ascii", "spaces", "line_ends", "words_per_line",
    "words_per_stop", "marks_per_word",
)
SAMPLE = 20_000
CUT = 0.3

_UPPER = np.zeros(256, bool); _UPPER[65:91] = True  # noqa: E702
_LETTER = np.zeros(256, bool); _LETTER[65:91] = _LETTER[97:123] = True  # noqa: E702
_DIGIT = np.zeros(256, bool); _DIGIT[48:58] = True  # noqa: E702
_STOP = np.zeros(256, bool); _STOP[[33, 44, 46, 58, 59, 63]] = True  # noqa: E702
_MARK = np.zeros(256, bool); _MARK[33:48] = _MARK[58:65] = _MARK[91:97] = _MARK[123:127] = True  # noqa: E702
_MARK &= ~_STOP


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(np.float64)


def _per_text(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each text and how often its most frequent one occurs."""
    n = len(first) - 1
    owner = np.repeat(np.arange(n, dtype=np.uint64), np.diff(first))
    keys = np.sort((owner << np.uint64(40)) | (hashes >> np.uint64(24)))
    if not len(keys):
        return np.zeros(n), np.zeros(n)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    who = (keys[starts] >> np.uint64(40)).astype(np.int64)
    top = np.zeros(n)
    np.maximum.at(top, who, np.diff(np.append(starts, len(keys))))
    return np.bincount(who, minlength=n).astype(float), top


def features(column: pa.Array) -> np.ndarray:
    """A row of ``FEATURES`` for each text; of the whole text, 0 where there is nothing to measure."""
    data, offsets = text_bytes(column)
    words = Words(data, offsets)
    n_bytes, n_words = np.diff(offsets).astype(float), words.counts.astype(float)
    hashes = words.hashes()
    length = np.concatenate([[0], np.cumsum(words.ends - words.starts)])
    distinct, top = _per_text(hashes, words.first)
    grams, gram_first = shingle_hashes(hashes, words.first, 3)
    distinct_grams, _ = _per_text(grams, gram_first)
    same = np.zeros(len(hashes) + 1, bool)
    same[1:-1] = hashes[1:] == hashes[:-1]
    same[words.first] = False
    per_word = lambda x: x / np.maximum(n_words, 1)
    per_byte = lambda x: x / np.maximum(n_bytes, 1)
    sizes = words.ends - words.starts
    letters, marks = _sums(_LETTER[data], offsets), _sums(_MARK[data], offsets)
    lines, stops = _sums(data == 10, offsets), _sums(_STOP[data], offsets)
    ends = _sums((data == 46) | (data == 33) | (data == 63), offsets)
    columns = [
        np.log1p(n_words),
        per_word((length[words.first[1:]] - length[words.first[:-1]]).astype(float)),
        per_word(_sums(sizes > 14, words.first)),
        per_word(_sums(sizes == 1, words.first)),
        per_word(distinct),
        distinct_grams / np.maximum(np.diff(gram_first), 1),
        per_word(_sums(same[:-1], words.first)),
        per_word(top),
        _sums(_UPPER[data], offsets) / np.maximum(letters, 1),
        per_byte(_sums(_DIGIT[data], offsets)),
        per_byte(stops),
        per_byte(marks),
        per_byte(_sums(data >= 128, offsets)),
        per_byte(_sums(data == 32, offsets)),
        per_byte(lines),
        n_words / (lines + 1),
        n_words / (ends + 1),
        per_word(marks),
    ]
    return np.stack(columns, axis=1)


@dataclass
class AdditiveModel:
    """Bin edges of each feature, a table of log odds for each feature and for some pairs, and a constant."""

    constant: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1."""
        total = np.full(len(x), self.constant)
        if self.edges and len(x):
            fine, coarse = self.bins(x, self.edges), self.bins(x, self.coarse)
            for j, table in enumerate(self.tables):
                total += table[fine[:, j]]
            for a, b, table in self.pairs:
                total += table[coarse[:, a], coarse[:, b]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(values: np.ndarray, most: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, most + 1)[1:-1]))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float, least: float) -> np.ndarray:
    """A value for each bin: the best cut of any leaf is made until there are enough leaves."""
    cuts = [0, len(g)]
    G, H = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    worth = lambda a, b: (G[b] - G[a]) ** 2 / (H[b] - H[a] + ridge)
    while len(cuts) <= leaves:
        best = (1e-9, None)
        for a, b in zip(cuts, cuts[1:], strict=False):
            at = np.arange(a + 1, b)
            at = at[(H[at] - H[a] >= least) & (H[b] - H[at] >= least)]
            if len(at):
                gain = worth(a, at) + worth(at, b) - worth(a, b)
                if gain.max() > best[0]:
                    best = (gain.max(), at[gain.argmax()])
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.empty(len(g))
    for a, b in zip(cuts, cuts[1:], strict=False):
        out[a:b] = (G[b] - G[a]) / (H[b] - H[a] + ridge)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float, least: float) -> tuple[np.ndarray, float]:
    """The best cut of both features at once, as a table, and its gain."""
    box = lambda t: np.pad(t, ((1, 0), (1, 0))).cumsum(0).cumsum(1)
    G, H = box(g), box(h)
    m, n = g.shape
    if m < 2 or n < 2:
        return np.zeros_like(g), 0.0
    i, j = np.arange(1, m)[:, None], np.arange(1, n)[None, :]
    corners = lambda T: (T[i, j], T[i, n] - T[i, j], T[m, j] - T[i, j], T[m, n] - T[i, n] - T[m, j] + T[i, j])
    gs, hs = corners(G), corners(H)
    gain = sum(a**2 / (b + ridge) for a, b in zip(gs, hs, strict=True)) - G[m, n] ** 2 / (H[m, n] + ridge)
    gain = np.where(np.minimum.reduce(hs) >= least, gain, 0)
    p, q = np.unravel_index(gain.argmax(), gain.shape)
    out = np.zeros_like(g)
    values = [a[p, q] / (b[p, q] + ridge) for a, b in zip(gs, hs, strict=True)]
    out[: p + 1, : q + 1], out[: p + 1, q + 1 :], out[p + 1 :, : q + 1], out[p + 1 :, q + 1 :] = values
    return (out, float(gain[p, q])) if gain[p, q] > 0 else (np.zeros_like(g), 0.0)


def fit(
    x: np.ndarray, y: np.ndarray, rounds: int = 150, pair_rounds: int = 50, n_pairs: int = 10, bins: int = 48,
    coarse: int = 10, rate: float = 0.1, leaves: int = 3, ridge: float = 1.0, least: float = 0.5,
) -> AdditiveModel:
    """Deterministic for given rows.  Without both labels the model is a constant: their share, or a half."""
    y = np.asarray(y, dtype=float)
    base = y.mean() if len(y) else 0.5
    model = AdditiveModel(float(np.log((base + 1e-4) / (1 - base + 1e-4))))
    if not len(y) or not 0 < base < 1:
        return model
    model.edges = [_edges(x[:, j], bins) for j in range(x.shape[1])]
    model.coarse = [_edges(x[:, j], coarse) for j in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    fine, rough = model.bins(x, model.edges), model.bins(x, model.coarse)
    total = np.full(len(y), model.constant)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j, table in enumerate(model.tables):
            g, h = slopes()
            size = len(table)
            step = rate * _tree(np.bincount(fine[:, j], g, size), np.bincount(fine[:, j], h, size), leaves, ridge, least)
            table += step
            total += step[fine[:, j]]

    shape = [len(e) + 1 for e in model.coarse]
    cell = lambda a, b: rough[:, a] * shape[b] + rough[:, b]

    def pair_step(a: int, b: int, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
        at, size = cell(a, b), shape[a] * shape[b]
        grid = (shape[a], shape[b])
        return _quadrants(np.bincount(at, g, size).reshape(grid), np.bincount(at, h, size).reshape(grid), ridge, least)

    g, h = slopes()
    gains = sorted(((-pair_step(a, b, g, h)[1], a, b) for a, b in combinations(range(x.shape[1]), 2)))
    model.pairs = [(a, b, np.zeros((shape[a], shape[b]))) for gain, a, b in gains[:n_pairs] if gain < 0]
    for _ in range(pair_rounds):
        for a, b, table in model.pairs:
            g, h = slopes()
            step = rate * pair_step(a, b, g, h)[0]
            table += step
            total += step[rough[:, a], rough[:, b]]
    return model


FEATURE_DDL = "doc_id long, x array<double>"


def feature_rows(docs: DataFrame) -> DataFrame:
    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        x = features(piece.column("text"))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
        return pa.RecordBatch.from_arrays([piece.column("doc_id").cast(pa.int64()), lists], names=["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(per_slice(work), FEATURE_DDL)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), len(FEATURES))


def learn(rows: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> AdditiveModel:
    """Fit on about ``sample`` labelled rows of the learning fold, one for each doc_id, however often it is repeated.

    Their features come to the driver, no texts do.
    """
    chosen = written(labelled_sample(labels, "quality", sample), "quality-sample")
    once = rows.join(chosen, "doc_id").groupBy("doc_id").agg(F.min("x").alias("x"), F.min("label").alias("label"))
    table = once.orderBy("doc_id").toArrow()
    if not table.num_rows:
        return fit(np.empty((0, len(FEATURES))), np.empty(0))
    return fit(_matrix(table.column("x").combine_chunks()), table.column("label").to_numpy())


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, cut: float = CUT) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, score, predicted``.

    Null text: as empty; it gets a score too.  Repeated rows: one row each; a doc_id counts once in the fit.  Without
    labels every score is the same.  Nothing but the text enters a score; other columns are not read.  Very long texts are
    measured whole, each in a slice of its own.
    """
    rows = written(feature_rows(docs), "quality-features")
    model = learn(rows, labels, sample)

    def work(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(model.score(_matrix(batch.column("x"))))], names=["doc_id", "score"]
            )

    scored = rows.mapInArrow(work, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def without_poor(docs: DataFrame, labels: DataFrame, source: DataFrame | None = None, cut: float = CUT) -> DataFrame:
    """``docs`` without those whose score is below ``cut``; learned from ``source``, or from ``docs`` themselves."""
    chosen = written(labelled_sample(labels, "quality", SAMPLE), "quality-sample")
    sampled = (docs if source is None else source).join(chosen, "doc_id", "left_semi")
    model = learn(written(feature_rows(sampled), "quality-features"), labels)
    names = docs.columns

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        keep = model.score(features(piece.column("text"))) >= cut
        return piece.filter(pa.array(keep))

    return docs.select(*names).mapInArrow(per_slice(work), docs.schema)
