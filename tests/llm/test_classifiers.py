"""Quality and toxicity: held-out accuracy on texts with known traits."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import EDGES
from pyspark.sql import functions as F

from tricycle.llm import quality, toxicity
from tricycle.llm.labelled import labelled_sample, unpacked

BAD = ["grumblefoot", "snarkwort", "blistermouth"]


def corpus(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{k}" for k in range(800)]
    rows, labels = [], []
    for k in range(n):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(15, 200))]
        toxic, good = rng.random() < 0.3, rng.random() < 0.7
        if toxic:
            w[rng.randrange(len(w))] = rng.choice(BAD) + rng.choice(["", "s", "ing"])
        if not good:
            w = [f"{x}!!" for x in w] if rng.random() < 0.5 else [x for x in w for _ in range(4)]
        rows.append((k, " ".join(w), rng.choice(["en", "de"]), "s"))
        labels.append((k, int(good), int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def known(spark, docs_of):
    rows, labels = corpus(1200, 5)
    return docs_of(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


def accuracy(scored, labels, column, held_out):
    truth = {i: (q, t)[column] for i, q, t in labels}
    rows = scored.where(held_out()).select("doc_id", "score").collect()
    assert len(rows) > 150 and all(0 <= r.score <= 1 for r in rows)
    return sum((r.score >= 0.3) == bool(truth[r.doc_id]) for r in rows) / len(rows)


def test_quality_held_out(known):
    docs, table, labels = known
    model = quality.fit(docs, table)
    assert accuracy(quality.quality(docs, model), labels, 0, quality.held_out) >= 0.97


def test_toxicity_held_out(known):
    docs, table, labels = known
    model = toxicity.fit(docs, table)
    found = toxicity.toxicity(docs, model)
    assert accuracy(found, labels, 1, toxicity.held_out) >= 0.95
    again = toxicity.toxicity(docs, toxicity.fit(docs, table))
    assert {r.doc_id: r.score for r in found.collect()} == {r.doc_id: r.score for r in again.collect()}
    assert all(r.rejected == (r.score >= r.threshold) for r in found.collect())


def test_held_out_labels_are_not_read(known):
    docs, table, labels = known
    size = lambda texts: [np.array([len(t)]) for t in texts.to_pylist()]
    found, known, _ = labelled_sample(docs, table, "toxic", 4, 2, 10_000, size)
    free = {i: t for i, _, t in labels if zlib.crc32(str(i).encode()) % 4 != 2}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert [unpacked(f, np.int64)[0] for f in found] == [len(texts[i]) for i in sorted(free)]
    assert known.tolist() == [free[i] for i in sorted(free)]
    _, known, _ = labelled_sample(docs, table, "toxic", 4, 2, 100, size)
    assert (known == 0).sum() == (known == 1).sum() == 100


def test_texts_of_a_repeated_id_do_not_depend_on_their_order(spark, docs_of):
    rows = [(1, "some text", "en", "s"), (1, "another text", "de", "s"), (2, "", None, "s")]
    table = spark.createDataFrame([(1, 1, 1), (2, 0, 0)], "doc_id long, quality int, toxic int")
    take = lambda texts: [np.frombuffer((t or "").encode(), np.uint8) for t in texts.to_pylist()]
    one, two = (labelled_sample(docs_of(r), table, "toxic", 4, 9, 10, take) for r in (rows, rows[::-1]))
    assert one[0] == two[0] and one[2].tolist() == two[2].tolist() and len(one[0]) == 2


def test_language_cuts_are_shrunk_towards_the_common_one():
    rng = np.random.default_rng(2)
    for n, least, most in ((1, 0, 0.15), (50, 0.75, 1.25), (5000, 1.9, 2.05)):
        scores = np.concatenate((rng.uniform(1, 1.99, n), rng.uniform(2.01, 3, n)))
        labels = np.repeat([0.0, 1.0], n)
        assert least <= toxicity.language_shift(scores, labels, 0.0) <= most
    assert toxicity.language_shift(np.array([5.0, 6.0]), np.zeros(2), 1.0) == 0


def test_scores_equal_plain_loops(known):
    """Each text's score from the fitted weights, word by word and window by window."""
    docs, table, _ = known
    model = toxicity.fit(docs, table)
    net = model.network
    for text in ["a grumblefoot here", "", "one", " ".join(["ba1 co2 de3"] * 40)]:
        (rows,) = toxicity.word_rows(pa.array([text]))
        vectors = [sum(net.embeddings[i] for i in word) for word in rows] + [np.zeros(toxicity.DIMENSION)] * toxicity.TAIL
        total = net.offset
        for w, weight in enumerate(net.filters):
            for f in range(toxicity.FILTERS):
                value = max(
                    sum(float(vectors[p + k] @ weight[k][:, f]) for k in range(len(weight)))
                    for p in range(max(1, len(vectors) - toxicity.TAIL + 1))
                )
                total += max(value + net.biases[w][f], 0) * net.output[w * toxicity.FILTERS + f]
        expected = 1 / (1 + math.exp(-(total - model.cut + math.log(0.3 / 0.7))))
        assert model.scores(pa.array([text]))[0] == pytest.approx(expected, abs=1e-4)
    ranker = quality.fit(docs, table)
    texts = ["Some words, and more words.", "x!! y!! z!!", ""]
    for text, x, found in zip(texts, quality.features(pa.array(texts)), ranker.scores(pa.array(texts)), strict=True):
        rank = sum(w * min(8, max(-8, (v - m) / s)) for w, v, m, s in zip(ranker.weights, x, ranker.mean, ranker.scale, strict=True))
        assert found == pytest.approx(1 / (1 + math.exp(-(ranker.slope * (rank - ranker.cut) + math.log(quality.CUT / (1 - quality.CUT))))))


@pytest.mark.parametrize("module, score", [(quality, quality.quality), (toxicity, toxicity.toxicity)])
def test_edges(known, clashing, nothing, spark, module, score):
    docs, table, _ = known
    model = module.fit(docs, table)
    found = score(clashing, model)
    assert set(found.columns) >= set(clashing.columns)
    rows = found.collect()
    assert len(rows) == len(EDGES) and all(0 <= r.score <= 1 for r in rows)
    assert len({round(r.score, 6) for r in rows if not (r.text or "").strip()}) == 1
    assert score(nothing, model).collect() == []
    # Labels of one kind, null ones, none, and of other documents.
    schema = "doc_id long, quality int, toxic int"
    for labels, expected in (
        ([], 0.0),
        ([(None, 1, 1), (1, None, None)], 0.0),
        ([(0, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1), (3, None, 1)], 1.0),
        ([(10**9, 1, 1), (10**9 + 1, 0, 0)], 0.0),
    ):
        model = module.fit(docs, spark.createDataFrame(labels, schema))
        assert {r.score for r in score(clashing, model).collect()} == {expected}


def test_quality_is_fitted_on_all_pairs_of_all_labels(spark, known):
    """With some wrong labels, the loss over every pair is flat at the weights, and the cut is
    the quantile of all.
    """
    docs, _, labels = known
    rng = random.Random(3)
    labels = [(i, q if rng.random() < 0.8 else 1 - q, t) for i, q, t in labels]
    model = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    free = [(texts[i], q) for i, q, _ in labels if zlib.crc32(str(i).encode()) % 5]
    x = quality.features(pa.array([t for t, _ in free]))
    assert model.mean == pytest.approx(x.mean(axis=0)) and model.scale == pytest.approx(x.std(axis=0) + 1e-6, abs=1e-6)
    x = np.clip((x - model.mean) / model.scale, -8, 8)
    good, bad = (x[[q == kind for _, q in free]] for kind in (1, 0))
    missed = 1 / (1 + np.exp((good @ model.weights)[:, None] - (bad @ model.weights)[None, :]))
    assert missed.size > 100_000
    gradient = (missed.sum(axis=0) @ bad - missed.sum(axis=1) @ good) / missed.size + 1e-4 * model.weights
    assert np.abs(gradient).max() < 2e-4
    below = np.sort(x @ model.weights)
    assert model.cut == pytest.approx((below[len(bad) - 1] + below[len(bad)]) / 2, abs=1e-6)


def test_toxicity_is_fitted_on_every_label(spark, docs_of):
    """A word of the 100 toxic documents whose hashed ids are largest, of 2,000, and of no other
    is known to the model.
    """
    rng = random.Random(9)
    free = [i for i in range(3600) if zlib.crc32(str(i).encode()) % 4 != 2]
    toxic = free[:2000]
    late = {r.i for r in spark.createDataFrame([(i,) for i in toxic], "i long").orderBy(F.xxhash64("i")).collect()[-100:]}
    rows = []
    for i in free:
        w = [f"w{rng.randrange(300)}" for _ in range(12)]
        if i in set(toxic):
            w[rng.randrange(12)] = "grumblefoot" if i in late else "snarkwort"
        rows.append((i, " ".join(w), "en", "s"))
    labels = [(i, 1, int(i in set(toxic))) for i in free]
    model = toxicity.fit(docs_of(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    found = model.scores(pa.array(["w1 w2 grumblefoot w3 w4", "w1 w2 snarkwort w3 w4", "w1 w2 w5 w3 w4"]))
    assert found[0] >= 0.3 and found[1] >= 0.3 and found[2] < 0.3


def test_toxicity_of_many_shards(known):
    """Shards that are averaged, and added up in two turns, find the same; reruns agree."""
    docs, table, labels = known
    model = toxicity.fit(docs, table, shard=12)
    assert accuracy(toxicity.toxicity(docs, model), labels, 1, toxicity.held_out) >= 0.95
    again = toxicity.fit(docs.repartition(5), table.repartition(3), shard=12)
    assert again.network.vector().tobytes() == model.network.vector().tobytes()
    assert (again.cut, again.by_language) == (model.cut, model.by_language)


def test_scores_counted_have_the_cut_of_scores_listed():
    rng = np.random.default_rng(4)
    scores, labels = rng.integers(0, 40, 500) / 8.0, (rng.random(500) < 0.4) * 1.0
    pairs, n = np.unique(np.stack([scores, labels]), axis=1, return_counts=True)
    assert toxicity.best_cut(pairs[0], pairs[1], n) == toxicity.best_cut(scores, labels)
    assert toxicity.language_shift(pairs[0], pairs[1], 1.0, n) == toxicity.language_shift(scores, labels, 1.0)


def test_the_driver_gets_no_labelled_texts(spark, docs_of, monkeypatch):
    """What a fit collects does not follow the labelled documents, here 14 MB of texts."""
    rng = random.Random(6)
    rows = [(i, " ".join(f"{rng.randrange(10**9):x}" for _ in range(4500)) + (" snarkwort" if i % 3 else ""), "en", "s") for i in range(400)]
    table = spark.createDataFrame([(i, 1, int(i % 3 > 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    docs, got = docs_of(rows), []
    kind = type(docs)
    arrow, collect = kind.toArrow, kind.collect
    monkeypatch.setattr(kind, "toArrow", lambda self: got.append(arrow(self)) or got[-1])
    monkeypatch.setattr(kind, "collect", lambda self: got.append(collect(self)) or got[-1])
    toxicity.fit(docs, table)
    sizes = [x.nbytes if isinstance(x, pa.Table) else 100 * len(x) for x in got]
    assert got and sum(sizes) < 14_000_000 and max(sizes) < 5_000_000
