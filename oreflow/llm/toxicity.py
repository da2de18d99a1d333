"""Toxicity as a severity grade, by cumulative-link ordinal regression over sparse text features.

Features are words and the beginnings of words, hashed.  All thresholds share one weight per feature:
P(grade >= k) = 1 / (1 + exp(cut_k - w.x)) with cuts in ascending order.  The expected severity is the sum of
these probabilities.

``labels.toxic`` marks rows only as toxic or not, so the grades to learn from are made: 0 for rows that are not,
and 1, 2, 3 for toxic rows by thirds of the share of their words that tell toxic rows from others.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.sampling import held_out, labelled_sample
from oreflow.llm.text import Spans, Words, mix, per_slice, text_bytes
from oreflow.sources.scratch import written

SAMPLE = 20_000
GRADES = 3
SLOTS = 1 << 20
BEGINNINGS = (5, 6, 7, 8)  # bytes
FEATURES = 8192
CUT = 0.3


def sparse_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, feature slot) of every word and beginning of a word, and the words of each text."""
    words = Words(*text_bytes(column))
    owner = np.repeat(np.arange(len(column)), words.counts)
    spans = Spans(words.data)
    size = words.ends - words.starts
    texts, slots = [owner], [spans.hashes(words.starts, words.ends)]
    for kind, length in enumerate(BEGINNINGS, 1):
        longer = np.flatnonzero(size > length)
        texts.append(owner[longer])
        slots.append(mix(spans.hashes(words.starts[longer], words.starts[longer] + length) + np.uint64(kind)))
    return np.concatenate(texts), (np.concatenate(slots) & np.uint64(SLOTS - 1)).astype(np.int64), words.counts


def _found(column: pa.Array, place: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Selected features only: (text, feature, occurrences) without repeats, and the words of each text."""
    text, slot, words = sparse_features(column)
    feature = place[slot]
    hit = np.flatnonzero(feature >= 0)
    pairs, times = np.unique(text[hit] * max(size, 1) + feature[hit], return_counts=True)
    return pairs // max(size, 1), pairs % max(size, 1), times, words


@dataclass
class OrdinalModel:
    slots: np.ndarray  # of the selected features
    weights: np.ndarray
    cuts: np.ndarray

    @cached_property
    def place(self) -> np.ndarray:
        out = np.full(SLOTS, -1, dtype=np.int32)
        out[self.slots] = np.arange(len(self.slots))
        return out

    def at_least(self, column: pa.Array) -> np.ndarray:
        """P(grade >= k) for each text and k = 1, 2, ..."""
        text, feature, times, _ = _found(column, self.place, len(self.slots))
        total = np.bincount(text, self.weights[feature] * np.log1p(times), minlength=len(column))
        return 1 / (1 + np.exp(np.clip(self.cuts[None, :] - total[:, None], -30, 30)))


def fit_ordinal(
    rows: np.ndarray, features: np.ndarray, values: np.ndarray, grades: np.ndarray, n_features: int,
    grades_top: int = GRADES, steps: int = 400, rate: float = 0.05, ridge: float = 2e-4,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and cuts by full-batch Adam.  Cuts are a first one and positive gaps, so they stay in order."""
    n, w = len(grades), np.zeros(n_features)
    shares = np.array([(grades >= k).mean() if n else 0 for k in range(1, grades_top + 1)])
    first = -np.log((shares + 1e-3) / (1 - shares + 1e-3))
    c = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 0.05))])

    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in (w, c)]
    for t in range(1, steps + 1):
        cuts = np.concatenate([c[:1], c[0] + np.cumsum(np.exp(c[1:]))])
        total = np.bincount(rows, w[features] * values, minlength=n)
        # P(>= k) is one chain of probabilities; the likelihood of a grade is a difference of two of them.
        p = 1 / (1 + np.exp(np.clip(cuts[None, :] - total[:, None], -30, 30)))
        edge = np.concatenate([np.ones((n, 1)), p, np.zeros((n, 1))], axis=1)
        lik = np.maximum(edge[np.arange(n), grades] - edge[np.arange(n), grades + 1], 1e-9)
        slope = p * (1 - p) / lik[:, None]
        lower = np.where(np.arange(1, grades_top + 1) == grades[:, None], slope, 0)
        upper = np.where(np.arange(1, grades_top + 1) == grades[:, None] + 1, slope, 0)
        by_cut = lower - upper  # of the log likelihood, by total - cut
        g_total = by_cut.sum(axis=1)
        g_w = np.bincount(features, g_total[rows] * values, minlength=n_features) / n - ridge * w
        g_cut = -by_cut.sum(axis=0) / n
        g_c = np.concatenate([[g_cut.sum()], np.exp(c[1:]) * np.cumsum(g_cut[::-1])[::-1][1:]])
        for p_, g_, (m, v) in ((w, g_w, moments[0]), (c, g_c, moments[1])):
            m += 0.1 * (g_ - m)
            v += 0.001 * (g_**2 - v)
            p_ += rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)

    return w, np.concatenate([c[:1], c[0] + np.cumsum(np.exp(c[1:]))])


def _feature_counts(sample: DataFrame) -> DataFrame:
    """For each slot, the texts that hold it: all and toxic ones; added up in each task first."""

    def run(batches):
        every, toxic = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
        work = per_slice(lambda x: x)
        for piece in work(batches):
            text, slot, _ = sparse_features(piece.column("text"))
            label = np.asarray(piece.column("label"))
            pairs = np.unique(text * SLOTS + slot)
            slot = pairs % SLOTS
            every += np.bincount(slot, minlength=SLOTS)
            toxic += np.bincount(slot[label[pairs // SLOTS] > 0], minlength=SLOTS)
        held = np.flatnonzero(every)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held), pa.array(every[held]), pa.array(toxic[held])], names=["slot", "n", "n_toxic"]
        )

    counts = sample.mapInArrow(run, "slot long, n long, n_toxic long")
    return counts.groupBy("slot").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic"))


def _selected(counts: pa.Table, n: int, n_toxic: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots whose shares among toxic and other texts differ most for their noise, which of them mark toxicity, and
    the log odds by which each one's values are scaled, so that the ridge weighs least on the clearest."""
    slot, every, toxic = (counts.column(x).to_numpy() for x in ("slot", "n", "n_toxic"))
    other = every - toxic
    a, b = (toxic + 0.5) / (n_toxic + 1), (other + 0.5) / (n - n_toxic + 1)
    odds = np.log(a / (1 - np.minimum(a, 1 - 1e-9))) - np.log(b / (1 - np.minimum(b, 1 - 1e-9)))
    z = odds / np.sqrt(1 / (toxic + 0.5) + 1 / (other + 0.5))
    order = np.lexsort((slot, -np.abs(z)))[:most]
    order = order[np.abs(z[order]) > 2]
    return slot[order], z[order] > 3, np.abs(odds[order])


def learn(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> OrdinalModel:
    """Fit on about ``most`` labelled rows of the learning fold, one for each doc_id, however often it is repeated.

    Their texts stay on the executors: slots are chosen from summed counts, and only occurrences of the chosen
    ones come to the driver.
    """
    chosen = written(labelled_sample(labels, "toxic", most), "toxicity-sample")
    labelled = docs.select("doc_id", "text").join(chosen, "doc_id")
    once = labelled.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))
    sample = written(once, "toxicity-texts")
    n, n_toxic = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < n_toxic < n:
        cut = -30.0 if n and n_toxic == n else 30.0
        return OrdinalModel(np.empty(0, np.int64), np.empty(0), np.full(GRADES, cut))
    slots, marks, scale = _selected(_feature_counts(sample).toArrow(), n, n_toxic, FEATURES)
    place = OrdinalModel(slots, np.zeros(len(slots)), np.zeros(GRADES)).place

    def rows(piece: pa.RecordBatch) -> pa.RecordBatch:
        text, feature, times, words = _found(piece.column("text"), place, len(slots))
        first = np.searchsorted(text, np.arange(len(words) + 1)).astype(np.int32)
        of = lambda x: pa.ListArray.from_arrays(pa.array(first), pa.array(x.astype(np.int32)))
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), piece.column("label"), pa.array(words.astype(np.int64)), of(feature), of(times)],
            names=["doc_id", "label", "words", "feature", "times"],
        )

    ddl = "doc_id long, label int, words long, feature array<int>, times array<int>"
    typed = sample.select(F.col("doc_id").cast("long").alias("doc_id"), "label", "text")
    table = typed.mapInArrow(per_slice(rows), ddl).orderBy("doc_id").toArrow().combine_chunks()
    feature, times = (table.column(x).combine_chunks() for x in ("feature", "times"))
    row = np.repeat(np.arange(len(feature)), feature.value_lengths().to_numpy())
    feature, times = feature.flatten().to_numpy(), times.flatten().to_numpy()
    label, words = table.column("label").to_numpy(), table.column("words").to_numpy()
    density = np.bincount(row, np.where(marks[feature], times, 0), minlength=len(label)) / np.maximum(words, 1)
    thirds = np.quantile(density[label > 0], [1 / 3, 2 / 3])
    grades = np.where(label > 0, 1 + np.searchsorted(thirds, density, side="left"), 0)
    weights, cuts = fit_ordinal(row, feature, np.log1p(times) * scale[feature], grades, len(slots))
    return OrdinalModel(slots, weights * scale, cuts)


SCORE_DDL = "doc_id long, severity double, p_toxic double"


def toxicity_scores(docs: DataFrame, labels: DataFrame, cut: float = CUT, most: int = SAMPLE) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, severity, p_toxic, toxic``.

    ``severity`` is the expected grade, 0 to 3; ``toxic`` is 1 where P(grade >= 1) is at least ``cut``.  Null or
    wordless texts have no feature and get the score of one.  Repeated rows: one row each.  Without toxic labels
    nothing is toxic.  Only the text enters a score; other columns are not read.  Very long texts are scored whole.
    """
    model = learn(docs, labels, most)

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        p = model.at_least(piece.column("text"))
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id").cast(pa.int64()), pa.array(p.sum(axis=1)), pa.array(p[:, 0].copy())],
            names=["doc_id", "severity", "p_toxic"],
        )

    scored = docs.select("doc_id", "text").mapInArrow(per_slice(work), SCORE_DDL)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "severity", "p_toxic", (F.col("p_toxic") >= cut).cast("int").alias("toxic")
    )


def without_toxic(docs: DataFrame, labels: DataFrame, source: DataFrame | None = None, cut: float = CUT) -> DataFrame:
    """``docs`` without toxic ones; learned from ``source``, or from ``docs`` themselves."""
    model = learn(docs if source is None else source, labels)
    names = docs.columns

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        return piece.filter(pa.array(model.at_least(piece.column("text"))[:, 0] < cut))

    return docs.select(*names).mapInArrow(per_slice(work), docs.schema)
