"""Toxicity by a convolutional text classifier.

A word is the sum of hashed embeddings: two of the word and two of each prefix, so
that a collision carries only part of a meaning. Filters of several widths slide
over the words, each keeps its maximum over the text, and a logistic layer scores
the maxima. Fitted on every labelled document, with whole texts: executors each fit
a copy of the network to a shard of the documents, in numpy, the copies are averaged,
and the next round starts from the average. Documents are scored in Arrow batches.
Thresholds are calibrated by language, which is no input of the score.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tricycle.llm.labelled import fold, known_labels, labelled, summed_shards, unpacked
from tricycle.llm.words import NOT_ALPHANUMERIC, mix, slices, text_bytes, word_hashes
from tricycle.plans.shared import materialize

FOLDS, HELD = 4, 2
# Documents, and packed bytes of texts, that a task fits on together, about.
SHARD_DOCUMENTS = 4_000
SHARD_BYTES = 16 << 20
BUCKETS = 1 << 17
DIMENSION = 8
WIDTHS = (1, 2, 3)
FILTERS = 8  # of each width
PREFIXES = (4, 5)
TAIL = max(WIDTHS)  # empty words behind each text, so that any text has a window
ROUNDS = 2  # after each the shards' networks are averaged
EPOCHS = 3  # of each round
CALIBRATING = 5  # one document in so many calibrates, the others are fitted on
SCORE_STEP, SCORE_MOST = 1 / 1024, 32.0  # to which scores are rounded for thresholds
CUT = 0.3  # the score at and above which a document counts as toxic
BATCH_WORDS = 1 << 17  # scored at a time
READ_TEXTS = 64  # hashed at a time
LANGUAGE_LABELS = 50  # of the rarer kind, at which a language's own cut counts half


@dataclass
class Network:
    """Weights. ``filters`` has for each width an array (width, dimension, filters)."""

    embeddings: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    output: np.ndarray
    offset: float

    @staticmethod
    def new(seed: int = 1) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        return Network(
            draw(BUCKETS, DIMENSION),
            [draw(w, DIMENSION, FILTERS) for w in WIDTHS],
            [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
            draw(FILTERS * len(WIDTHS)),
            0.0,
        )

    def vector(self) -> np.ndarray:
        """All weights in one row."""
        parts = [self.embeddings, *self.filters, *self.biases, self.output]
        return np.concatenate([*(x.ravel() for x in parts), np.array([self.offset])]).astype(np.float32)

    def moved(self, by: np.ndarray | int) -> Network:
        """A copy whose ``vector`` differs by so much."""
        places = self.vector() + by
        at = 0

        def taken(like: np.ndarray) -> np.ndarray:
            nonlocal at
            at += like.size
            return places[at - like.size : at].reshape(like.shape).astype(np.float32)

        return Network(
            taken(self.embeddings), [taken(x) for x in self.filters], [taken(x) for x in self.biases], taken(self.output), float(places[-1])
        )

    def pooled(self, rows: np.ndarray, bounds: np.ndarray, places: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
        """The maximum of each filter in each text, and if asked for the first word of
        the window that has it. ``rows`` are word vectors with ``TAIL`` zero rows behind
        each text, where ``bounds`` has the texts' first rows.
        """
        n = len(rows) - TAIL + 1
        maxima, at = [], []
        for weight, bias in zip(self.filters, self.biases, strict=True):
            value = rows[:n] @ weight[0]
            for k in range(1, len(weight)):
                value += rows[k : n + k] @ weight[k]
            for k in range(1, len(weight)):
                reaching = bounds[1:] - k  # into the next text
                value[reaching[reaching < n]] = -np.inf
            best = np.maximum.reduceat(value, bounds[:-1], axis=0)
            maxima.append(best + bias)
            if places:
                ends = np.append(bounds[1:-1], n)
                at.append(np.stack([a + value[a:b].argmax(axis=0) for a, b in zip(bounds[:-1], ends, strict=True)]))
        return np.concatenate(maxima, axis=1), at


def word_rows(texts: pa.Array) -> list[np.ndarray]:
    """Embedding rows of each text's words, (words, 2 + 2 * prefixes)."""
    found = []
    for start in range(0, len(texts), READ_TEXTS):
        words, bounds, *prefixes = word_hashes(texts.slice(start, READ_TEXTS), PREFIXES, NOT_ALPHANUMERIC)
        ids = np.empty((len(words), 2 + 2 * len(PREFIXES)), np.int32)
        for k, hashes in enumerate((words, *prefixes)):
            salted = mix(hashes + np.uint64(k))
            ids[:, 2 * k] = salted % np.uint64(BUCKETS)
            ids[:, 2 * k + 1] = (salted >> np.uint64(32)) % np.uint64(BUCKETS)
        found += np.split(ids, bounds[1:-1])
    return found


def _padded(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of the texts with gaps behind each: rows of ids, whether a row is a
    word, and the first row of each text (and the end).
    """
    starts = np.concatenate(([0], np.cumsum([len(t) + TAIL for t in texts])))
    real = np.zeros(starts[-1], bool)
    rows = np.zeros((starts[-1], 2 + 2 * len(PREFIXES)), np.int32)
    for text, a in zip(texts, starts[:-1], strict=True):
        rows[a : a + len(text)] = text
        real[a : a + len(text)] = True
    return rows, real, starts


def _vectors(network: Network, rows: np.ndarray, real: np.ndarray) -> np.ndarray:
    total = np.zeros((len(rows), DIMENSION), np.float32)
    for k in range(rows.shape[1]):
        total += network.embeddings[rows[:, k]]
    total[~real] = 0
    return total


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def logits(network: Network, texts: Iterable[np.ndarray]) -> np.ndarray:
    """The score of each text's ``word_rows`` before calibration; a text without words has
    the one of an all-zero word.
    """
    out, held, size = [np.empty(0)], [], 0

    def score() -> np.ndarray:
        padded, real, starts = _padded(held)
        maxima, _ = network.pooled(_vectors(network, padded, real), starts)
        return np.maximum(maxima, 0) @ network.output + network.offset

    for text in texts:
        held.append(text)
        size += len(text)
        if size >= BATCH_WORDS or len(held) == READ_TEXTS:
            out.append(score())
            held, size = [], 0
    if held:
        out.append(score())
    return np.concatenate(out)


def _whole(texts: pa.Array) -> list[np.ndarray]:
    """The bytes of each text, for ``labelled`` to keep: far fewer than its ``word_rows``."""
    data, offsets = text_bytes(texts)
    return [data[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _read(rows: pa.Table) -> list[np.ndarray]:
    """``word_rows`` of each of ``labelled`` rows whose texts were kept by ``_whole``."""
    found = rows["found"]
    return [
        r
        for begin in range(0, len(found), READ_TEXTS)
        for r in word_rows(
            pa.array([unpacked(t.as_py(), np.uint8).tobytes() for t in found[begin : begin + READ_TEXTS]], pa.binary()).cast(pa.string())
        )
    ]


def started(counts: np.ndarray, totals: np.ndarray, seed: int = 1) -> Network:
    """The network that a fit starts from. ``counts`` has for each label the number of its
    texts in which a row of the embeddings is met, ``totals`` the number of its texts.

    The first dimension of the embeddings starts from how much more often a row is
    met in label-1 texts, shrunk where it is rare, and one filter of width 1 reads it.
    """
    network = Network.new(seed)
    shrink = 10 * counts.sum(axis=0).clip(1) ** 0.25
    rates = [(c + shrink * 0.5) / (max(n, 1) + shrink) for c, n in zip(counts, totals, strict=True)]
    network.embeddings[:, 0] = np.clip(np.log(rates[1] / rates[0]), -2, 2).astype(np.float32) * 0.3
    network.filters[0][0, 0, 0], network.output[0] = 1.0, 1.0
    rate = totals[1] / totals.sum()
    network.offset = float(np.log(max(rate, 1e-3) / max(1 - rate, 1e-3)) - 1)
    return network


def trained(
    start: Network, read: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, rate: float = 0.05, batch: int = 32, seed: int = 1
) -> Network:
    """``start`` fitted further by Adagrad on logistic loss, in a fixed order of
    mini-batches of ``word_rows``.
    """
    network, rng = start.moved(0), np.random.default_rng(seed)
    parameters = [network.embeddings, *network.filters, *network.biases, network.output]
    squares = [np.full_like(x, 1e-3) for x in parameters]
    offset_square = 1e-3

    def step(k: int, gradient: np.ndarray, where=slice(None)) -> None:
        squares[k][where] += gradient**2
        parameters[k][where] -= rate * gradient / np.sqrt(squares[k][where])

    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for begin in range(0, len(order), batch):
            which = order[begin : begin + batch]
            rows, real, starts = _padded([read[k] for k in which])
            vectors = _vectors(network, rows, real)
            maxima, at = network.pooled(vectors, starts, places=True)
            active = np.maximum(maxima, 0)
            error = (_sigmoid(active @ network.output + network.offset) - labels[which]) / len(which)
            back = (error[:, None] * network.output) * (maxima > 0)
            touched, moved = [], []
            for w, weight in enumerate(network.filters):
                part = back[:, w * FILTERS : (w + 1) * FILTERS]
                gradient = np.zeros_like(weight)
                for k in range(len(weight)):
                    place = at[w] + k
                    gradient[k] = np.einsum("bfd,bf->df", vectors[place], part)
                    to_word = part[:, :, None] * weight[k].T[None]
                    hit = real[place] & (part != 0)
                    touched.append(rows[place[hit]])
                    moved.append(to_word[hit])
                step(1 + w, gradient)
                step(1 + len(WIDTHS) + w, part.sum(axis=0))
            step(len(parameters) - 1, active.T @ error)
            offset_square += float(error.sum()) ** 2
            network.offset -= rate * float(error.sum()) / offset_square**0.5
            moved = np.concatenate(moved)
            touched = np.concatenate(touched)
            if len(touched):
                unique, inverse = np.unique(touched, return_inverse=True)
                place, each = inverse.ravel(), np.repeat(moved, touched.shape[1], axis=0)
                gradient = np.stack([np.bincount(place, each[:, d], len(unique)) for d in range(DIMENSION)], axis=1)
                step(0, gradient.astype(np.float32), unique)
    return network


def best_cut(scores: np.ndarray, labels: np.ndarray, counts: np.ndarray | None = None) -> float:
    """The score that separates the labels with the best F1, in the middle of its gap.
    ``counts`` has how often each score with its label is there (once).
    """
    counts = np.ones(len(scores)) if counts is None else counts
    order = np.argsort(-scores, kind="stable")
    hits = np.cumsum((labels * counts)[order])
    f1 = 2 * hits / (np.cumsum(counts[order]) + hits[-1])
    # Equal scores fall on one side.
    ranked = scores[order]
    last = np.append(ranked[1:] != ranked[:-1], True)
    best = int(np.argmax(np.where(last, f1, -1)))
    return float(ranked[best] + ranked[min(best + 1, len(ranked) - 1)]) / 2


def language_shift(scores: np.ndarray, labels: np.ndarray, cut: float, counts: np.ndarray | None = None) -> float:
    """How far a language's cut lies from the common one: that of its own texts, shrunk by
    how few labels of its rarer kind there are, and so none without any.
    """
    counts = np.ones(len(scores)) if counts is None else counts
    rarer = min((labels * counts).sum(), ((1 - labels) * counts).sum())
    return float((best_cut(scores, labels, counts) - cut) * rarer / (rarer + LANGUAGE_LABELS)) if rarer else 0.0


@dataclass
class ToxicityModel:
    """A network with its cut, which has score ``CUT``, and cuts by language."""

    network: Network | None
    cut: float
    by_language: dict[str, float]
    rate: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), self.rate)
        rows = (r for begin in range(0, len(texts), READ_TEXTS) for r in word_rows(texts.slice(begin, READ_TEXTS)))
        return _sigmoid(logits(self.network, rows) - self.cut + np.log(CUT / (1 - CUT)))


def fit(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, held: int = HELD, shard: int = SHARD_DOCUMENTS) -> ToxicityModel:
    """A model from all labelled documents that are not held out: one in ``CALIBRATING``, by
    a hash of the id, calibrates the thresholds, and the network is fitted on all others.
    With labels of one kind, or none, every text's score is that label (or 0).

    Documents are dealt by a hash of the id into shards of about ``shard``, so that reruns
    agree and a task's memory is bounded; the driver gets sums over them only.
    """
    known = known_labels(labels, "toxic", folds, held).where("label IN (0, 1)")
    calibrates = F.expr(f"pmod(xxhash64('calibrates', doc_id), {CALIBRATING}) = 0")
    rows = materialize(labelled(docs, known, _whole).withColumn("calibrates", calibrates), "toxic")
    totals, size = np.zeros((2, 2)), 0
    for r in rows.groupBy("calibrates", "label").agg(F.count("*").alias("n"), F.sum(F.length("found")).alias("size")).collect():
        totals[int(r.calibrates), r.label] = r.n
        size += r.size
    by_label = totals.sum(axis=0)
    if not by_label.all():
        return ToxicityModel(None, 0.0, {}, float(by_label[1] / by_label.sum()) if by_label.sum() else 0.0)
    shards = 1 + int(max((by_label.sum() - 1) // shard, size // SHARD_BYTES))
    rows = rows.withColumn("shard", F.expr(f"int(pmod(xxhash64(doc_id), {shards}))"))
    fitting = calibrating = rows
    if totals.all():
        fitting, calibrating = rows.where("NOT calibrates"), rows.where("calibrates")
        by_label = totals[0]
    network = _network(fitting, by_label, shards)
    cut, by_language = _cuts(calibrating, network)
    return ToxicityModel(network, cut, by_language, float(totals[:, 1].sum() / totals.sum()))


def _network(rows: DataFrame, totals: np.ndarray, shards: int) -> Network:
    """A network fitted on ``labelled`` rows with their ``shard``, ``totals`` with each label."""

    def met(own: pa.Table) -> np.ndarray:
        counts = np.zeros((2, BUCKETS))
        for text, label in zip(_read(own), own["label"].to_pylist(), strict=True):
            seen = np.zeros(BUCKETS, bool)
            seen[text] = True
            counts[label] += seen
        return counts.ravel()

    network = started(summed_shards(rows, shards, met).reshape(2, BUCKETS), totals)
    n = totals.sum()
    for turn in range(ROUNDS):
        shared = rows.sparkSession.sparkContext.broadcast(cloudpickle.dumps(network))

        def moved(own: pa.Table, shared=shared, turn=turn) -> np.ndarray:
            start = cloudpickle.loads(shared.value)
            after = trained(start, _read(own), own["label"].to_numpy().astype(np.float64), seed=1 + turn)
            return (after.vector() - start.vector()) * np.float32(len(own) / n)

        network = network.moved(summed_shards(rows, shards, moved))
        shared.unpersist()
    return network


def _cuts(rows: DataFrame, network: Network) -> tuple[float, dict[str, float]]:
    """The cut of all ``labelled`` rows with their ``shard``, and scores that are the cuts of
    languages. Scores are counted in steps of ``SCORE_STEP``, so that a table of bounded
    size stands for all of them.
    """
    shared = rows.sparkSession.sparkContext.broadcast(cloudpickle.dumps(network))

    def scored(own: pa.Table) -> pa.Table:
        own = own.sort_by("doc_id")
        found = np.clip(logits(cloudpickle.loads(shared.value), _read(own)), -SCORE_MOST, SCORE_MOST)
        return pa.table({"lang": own["lang"], "label": own["label"], "score": np.rint(found / SCORE_STEP) * SCORE_STEP})

    scores = rows.groupBy("shard").applyInArrow(scored, "lang string, label int, score double")
    scores = materialize(scores.groupBy("lang", "label", "score").agg(F.count("*").alias("n")), "scores")

    def columns(table: pa.Table) -> list[np.ndarray]:
        return [table[c].to_numpy().astype(np.float64) for c in ("score", "label", "n")]

    score, label, n = columns(scores.groupBy("label", "score").agg(F.sum("n").alias("n")).toArrow())
    cut = best_cut(score, label, n)

    def shifted(own: pa.Table) -> pa.Table:
        score, label, n = columns(own)
        return pa.table({"lang": own["lang"][:1], "shift": [language_shift(score, label, cut, n)]})

    shifts = scores.where("lang <> ''").groupBy("lang").applyInArrow(shifted, "lang string, shift double").collect()
    return cut, {r.lang: float(_sigmoid(np.array(r.shift + np.log(CUT / (1 - CUT))))) for r in sorted(shifts)}


def toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: toxic is likelier), ``threshold`` of the
    row's language (``CUT`` for others and null) and ``rejected``.

    Null, empty and wordless texts have one score, that of no word; repeated rows are
    scored alike. Columns of these three names are replaced, others passed on.
    """
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = cloudpickle.loads(shared.value)
        for batch in slices(batches):
            texts = batch.column("text")
            found = known.scores(texts) if len(texts) else np.empty(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*batch.schema.names, "score"])

    own = [c for c in docs.columns if c.lower() not in ("score", "threshold", "rejected")]
    kept = docs.select(*[F.col(c).cast("string").alias(c) if c == "text" else F.col(c) for c in own])
    schema = kept.limit(0).select("*", F.lit(0.0).alias("score")).schema
    scored = kept.mapInArrow(score, schema)
    limits = F.lit(CUT)
    if "lang" in own and model.by_language:
        cases = [F.when(F.col("lang") == name, F.lit(cut)) for name, cut in model.by_language.items()]
        limits = F.coalesce(*cases, F.lit(CUT))
    return scored.withColumn("threshold", limits).withColumn("rejected", F.col("score") >= F.col("threshold"))


def held_out(doc_id: str = "doc_id"):
    return fold(doc_id, FOLDS) == HELD
