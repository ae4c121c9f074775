"""Quality by Bradley-Terry pairwise ranking.

A document's score is linear in features of its bytes, words and lines. Preference
pairs (a document labelled good over one labelled bad) fit it by logistic loss on
feature differences, and the quantile of the bad share among the fitted scores is
the threshold. All pairs of all labelled documents count, with whole texts: the loss of
a document depends on the other kind's scores only, so that a histogram of these stands
for all its pairs, and each Newton step takes two passes that executors sum up.
Documents are scored in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tricycle.llm.labelled import fold, known_labels, labelled, summed, unpacked
from tricycle.llm.words import slices, text_bytes, word_hashes
from tricycle.plans.order import numbered
from tricycle.plans.shared import materialize

FOLDS, HELD = 5, 0
STEPS = 15  # of Newton's method at most
CONVERGED = 1e-4  # of the loss: a step that should lower it by less is taken whole, as the last
RIDGE = 1e-4
LENGTHS = (1.0, 0.5, 0.25, 0.125, 1 / 64)  # of a step that are tried
# Scores at which the loss of a pair is tabulated; a score counts for the two beside it.
GRID = np.linspace(-64, 64, 1025)
COARSE = 8  # scores of the grid that share a sum of features, for the curvature only
READ_ROWS = 2_000  # features in memory at a time
CUT = 0.3  # the score of the threshold

# Byte classes: space, line end, a-z, A-Z, digits, sentence marks, other ASCII, other.
_CLASSES = np.full(256, 6, np.uint8)
_CLASSES[[9, 11, 12, 32]] = 0
_CLASSES[[10, 13]] = 1
_CLASSES[97:123] = 2
_CLASSES[65:91] = 3
_CLASSES[48:58] = 4
_CLASSES[[33, 39, 40, 41, 44, 45, 46, 58, 59, 63]] = 5
_CLASSES[128:] = 7
KINDS = 8
_MARKS = np.frombuffer(b"!?.,;:|%$#&*<>{}=/_~@^+", np.uint8)


def features(texts: pa.Array) -> np.ndarray:
    """One row for each text: shares of byte classes, of pairs of classes, of marks a
    word, and how words and lines are long and repeat. A text without words has zeros.
    """
    data, offsets = text_bytes(texts)
    words, bounds = word_hashes(texts)
    out = np.zeros((len(offsets) - 1, KINDS + KINDS * KINDS + len(_MARKS) + 12))
    for k in range(len(out)):
        own = data[offsets[k] : offsets[k + 1]]
        tokens = words[bounds[k] : bounds[k + 1]]
        if not len(tokens):
            continue
        kinds = _CLASSES[own]
        share = np.bincount(kinds, minlength=KINDS) / len(own)
        steps = np.bincount(kinds[:-1].astype(np.int64) * KINDS + kinds[1:], minlength=KINDS * KINDS) / len(own)
        count = np.bincount(own, minlength=256)
        marks = np.sqrt(count[_MARKS] / len(tokens))
        _, often = np.unique(tokens, return_counts=True)
        repeats = (tokens[1:] == tokens[:-1]).mean() if len(tokens) > 1 else 0.0
        breaks = np.flatnonzero(own == 10)
        edges = np.concatenate(([0], breaks + 1, [len(own) + 1]))
        length = np.diff(edges)
        lines = [hash(own[a : b - 1].tobytes()) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        size = len(own) / len(tokens)
        shape = [
            np.log1p(len(tokens)),
            np.log1p(len(own)),
            size,
            len(often) / len(tokens),
            (often == 1).sum() / len(tokens),
            often.max() / len(tokens),
            ((often / len(tokens)) ** 2).sum(),
            repeats,
            np.log1p(len(length)),
            np.log1p(length.mean()),
            len(set(lines)) / len(lines),
            1.0 if own[-1] in b".!?" else 0.0,
        ]
        out[k] = np.concatenate((share, steps, marks, shape))
    return out


@dataclass
class QualityModel:
    """Weights of standardised features; ``cut`` is the threshold, ``slope`` the scale."""

    weights: np.ndarray | None
    mean: np.ndarray
    scale: np.ndarray
    cut: float
    slope: float
    rate: float

    def ranks(self, texts: pa.Array) -> np.ndarray:
        spread = np.clip((features(texts) - self.mean) / self.scale, -8, 8)
        return (spread * self.weights).sum(axis=1)

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.rate)
        x = self.slope * (self.ranks(texts) - self.cut) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features and labels of ``labelled`` rows, some at a time."""
    for batch in slices(batches, READ_ROWS):
        if batch.num_rows:
            x = np.array([unpacked(row.as_py(), np.float64) for row in batch.column("found")])
            yield x, batch.column("label").to_numpy(zero_copy_only=False)


def _standardised(batches: Iterator[pa.RecordBatch], mean: np.ndarray, scale: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for x, label in _read(batches):
        yield np.clip((x - mean) / scale, -8, 8), label


def _on_grid(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of the grid below each score, and how much of the way to the next it is."""
    at = np.clip((scores - GRID[0]) / (GRID[1] - GRID[0]), 0, len(GRID) - 1 - 1e-9)
    return at.astype(np.int64), at - np.floor(at)


def _histogram(scores: np.ndarray) -> np.ndarray:
    at, part = _on_grid(scores)
    return np.bincount(at, 1 - part, len(GRID)) + np.bincount(at + 1, part, len(GRID))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def preference_weights(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, counts: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Weights ``w`` that maximise the likelihood ``sigmoid(w . (good - bad))`` of all pairs
    of ``labelled`` rows, with a small ridge, by Newton's method. ``counts`` has the number
    of bad and of good ones.
    """
    size, n_grid = len(mean), len(GRID)
    apart = GRID[:, None] - GRID[None, :]  # of a bad score (row) from a good one
    missed, loss = _sigmoid(apart), np.logaddexp(0, apart)
    curve = missed * (1 - missed)
    cells = n_grid // COARSE + 1

    def histograms(tried: list[np.ndarray]) -> np.ndarray:
        """By weights, label and place of the grid, as shares of the label's documents."""

        def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            total = np.zeros((len(tried), 2, n_grid))
            for x, label in _standardised(batches, mean, scale):
                for k, w in enumerate(tried):
                    scores = x @ w
                    for kind in (0, 1):
                        total[k, kind] += _histogram(scores[label == kind])
            return total.ravel()

        return summed(rows, partial).reshape(len(tried), 2, n_grid) / counts[:, None]

    def slopes(w: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradient and curvature of the loss at ``w``, whose scores have these shares."""
        push = [missed @ shares[1], -(shares[0] @ missed)]  # on a bad, on a good document, by score
        bend = [curve @ shares[1], shares[0] @ curve]

        def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            gradient, own, sums = np.zeros(size), np.zeros((size, size)), np.zeros((2, cells, size))
            for x, label in _standardised(batches, mean, scale):
                at, part = _on_grid(x @ w)
                for kind in (0, 1):
                    which = label == kind
                    k, r, some = at[which], part[which], x[which]
                    between = lambda f: (f[k] * (1 - r) + f[k + 1] * r) / counts[kind]  # noqa: B023, E731
                    gradient += between(push[kind]) @ some
                    own += (some * between(bend[kind])[:, None]).T @ some
                    np.add.at(sums[kind], np.rint((k + r) / COARSE).astype(np.int64), some / counts[kind])
            return np.concatenate((gradient, own.ravel(), sums.ravel()))

        found = summed(rows, partial)
        gradient, own, sums = np.split(found, (size, size + size * size))
        bad, good = sums.reshape(2, cells, size)
        crossed = bad.T @ curve[::COARSE, ::COARSE] @ good
        return gradient + RIDGE * w, own.reshape(size, size) - crossed - crossed.T + RIDGE * np.eye(size)

    def cost(w: np.ndarray, shares: np.ndarray) -> float:
        return float(shares[0] @ loss @ shares[1] + RIDGE / 2 * w @ w)

    w = np.zeros(size)
    (shares,) = histograms([w])
    for _ in range(steps):
        gradient, bent = slopes(w, shares)
        values, axes = np.linalg.eigh(bent)
        step = -axes @ ((axes.T @ gradient) / np.maximum(values, RIDGE / 10))
        if -(gradient @ step) < 2 * CONVERGED:
            return w + step
        tried = [w + length * step for length in LENGTHS]
        found = histograms(tried)
        costs = [cost(t, f) for t, f in zip(tried, found, strict=True)]
        best = int(np.argmin(costs))
        if costs[best] >= cost(w, shares):
            break
        w, shares = tried[best], found[best]
    return w


def fit(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, held: int = HELD) -> QualityModel:
    """A model from all labelled documents that are not held out. With labels of one kind,
    or none, every text's score is that label (or 0).
    """
    rows = materialize(labelled(docs, known_labels(labels, "quality", folds, held), features), "quality")
    size = len(features(pa.array([""]))[0])

    def moments(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(2 + 2 * size)
        for x, label in _read(batches):
            total += np.concatenate((np.bincount(label, minlength=2), x.sum(axis=0), (x * x).sum(axis=0)))
        return total

    found = summed(rows, moments) if rows.head(1) else np.zeros(2 + 2 * size)
    counts, n = found[:2], found[:2].sum()
    if not counts.all():
        return QualityModel(None, np.zeros(0), np.ones(0), 0.0, 1.0, float(counts[1] / n) if n else 0.0)
    mean = found[2 : 2 + size] / n
    scale = np.sqrt(np.maximum(found[2 + size :] / n - mean**2, 0)) + 1e-6
    weights = preference_weights(rows, mean, scale, counts)

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, label in _standardised(batches, mean, scale):
            yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(x @ weights, pa.float64())], ["label", "rank"])

    ranks = materialize(rows.mapInArrow(ranked, "label int, rank double"), "ranks")
    n_bad, n_good = (int(c) for c in counts)
    # The quantile at the bad share; between its two scores.
    cut = np.mean(_at_places(ranks, ("rank",), [n_bad - 1, n_bad]))
    middle = [(n_bad - 1) // 2, n_bad // 2, n_bad + (n_good - 1) // 2, n_bad + n_good // 2]
    ends = _at_places(ranks, ("label", "rank"), middle)
    slope = 4.0 / max(float(np.mean(ends[2:]) - np.mean(ends[:2])), 1e-6)
    return QualityModel(weights, mean, scale, float(cut), slope, float(counts[1] / n))


def _at_places(ranks: DataFrame, order: tuple[str, ...], places: list[int]) -> list[float]:
    """The ranks at these places of the whole table in that order."""
    rows = numbered(ranks, *order).where(F.col("place").isin(places)).collect()
    at = {r.place: r.rank for r in rows}
    return [at[p] for p in places]


def quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: good is likelier) and ``good`` (``CUT`` or
    more). Null, empty and wordless texts have one score, that of zero features;
    repeated rows are scored alike. Columns of these two names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = cloudpickle.loads(shared.value)
        for batch in slices(batches):
            texts = batch.column("text")
            found = known.scores(texts) if len(texts) else np.empty(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*batch.schema.names, "score"])

    own = [c for c in docs.columns if c.lower() not in ("score", "good")]
    kept = docs.select(*[F.col(c).cast("string").alias(c) if c == "text" else F.col(c) for c in own])
    scored = kept.mapInArrow(score, kept.limit(0).select("*", F.lit(0.0).alias("score")).schema)
    return scored.withColumn("good", F.col("score") >= CUT)


def held_out(doc_id: str = "doc_id"):
    return fold(doc_id, FOLDS) == HELD
