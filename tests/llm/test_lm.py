import random
import zlib

import numpy as np
import pytest
from brute import Model, words
from conftest import EDGES

from tricycle.llm.lm import STRENGTH, _packed, _packed_keys, _unpacked, _unpacked_keys, held_out, language_scores


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


@pytest.mark.parametrize("order", [1, 2, 3])
def test_equals_brute_force(docs_of, order):
    rng = random.Random(order)
    rows = [
        (k, " ".join(rng.choice("a b c d e the of zz".split()) for _ in range(rng.randrange(0, 1300 if k < 3 else 25))), "en", "s")
        for k in range(60)
    ]
    rows += [r for r in EDGES if r[0] not in (6, 7)]
    model = Model([r[1] for r in rows if not held(r[0])], order, STRENGTH)
    found = language_scores(docs_of(rows, clashing=True), held_out(), order, bucket_bytes=800).collect()
    assert len(found) == len(rows)
    expected = sorted(
        (str(i), held(i), len(words(t)) + 1, sum(model.counts[0][w] > 0 for w in [*words(t), "<end>"]), model.base(t), model.score(t))
        for i, t, *_ in rows
    )
    mine = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.base_score, r.score) for r in found)
    for a, b in zip(mine, expected, strict=True):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], abs=1e-8)
    assert {r.train_tokens for r in found} == {model.total}


@pytest.mark.parametrize("bits", [1, 7, 20])
def test_keys_and_counts_travel_whole(bits):
    rng = np.random.default_rng(bits)
    for part in (0, (1 << bits) - 1):
        low = part << (64 - bits)
        keys = rng.integers(0, 1 << (64 - bits), 1_500_000, np.uint64) + np.uint64(low)
        near = keys[:1000] ^ np.uint64(1)  # alike but for the last bit
        ends = np.array([low, low + (1 << (64 - bits)) - 1], np.uint64)
        for some in (np.unique(np.concatenate([keys, near, ends])), ends, keys[:1], keys[:0]):
            assert np.array_equal(_unpacked_keys(_packed_keys(some, part, bits), part, bits), some)
    for counts in ([], [0, 0], [1, 255], [256, 0], [2**40, 3], [2**63]):
        assert _unpacked(_packed(np.array(counts, np.uint64))).tolist() == counts


def test_a_million_bigrams_in_one_part(docs_of):
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(20_000)]
    rows = [(k, " ".join(rng.choices(vocabulary, k=30_000)), "en", "s") for k in range(96)]
    model = Model([r[1] for r in rows if not held(r[0])], 2, STRENGTH)
    assert len(model.counts[1]) > 2_000_000  # and the least number of parts is two
    found = {r.doc_id: r for r in language_scores(docs_of(rows), held_out(), 2, bucket_bytes=1 << 30).collect()}
    some = [k for k, *_ in rows if held(k)][:2] + [k for k, *_ in rows if not held(k)][:2]
    for k in some:
        assert found[k].score == pytest.approx(model.score(rows[k][1]), rel=1e-9)


def test_probabilities_add_up_to_one(docs_of):
    rows = [(k, t, "en", "s") for k, t in enumerate(["a b a", "a a c", "b", ""])]
    model = Model([t for _, t, *_ in rows], 2, STRENGTH)
    # One share is left for all unknown words together.
    for context in ((), ("a",), ("zz",), ("<end>",)):
        known = sum(model.probability(context, w) for w in model.counts[0])
        assert known + model.probability(context, "unknown") == pytest.approx(1)


def test_edges(edges, nothing):
    assert language_scores(nothing, held_out()).collect() == []
    found = language_scores(edges, held_out()).collect()
    assert len(found) == len(EDGES)
    assert {r.n_tokens for r in found if r.doc_id == 6} == {30_001}
    from pyspark.sql import functions as F

    untrained = language_scores(edges, F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens, r.score) for r in untrained} == {(0, 0, 0.0)}
