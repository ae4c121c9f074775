import hashlib
import random

import pytest
from brute import words
from conftest import EDGES

from tricycle.llm.mixing import _planned, mixed, sampled_mix, source_targets


def targets(sizes, weights=(5, 2, 1), share=1.5, limit=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(limit * sizes[s] for s in full)
        weighed = sum(w for s, w in weight.items() if s not in full)
        target = {s: limit * sizes[s] if s in full else rest * weight[s] / weighed for s in names}
        over = {s for s in names if s not in full and target[s] > limit * sizes[s]}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize("slices", [4096, 2])
def test_targets_and_taken_words(docs_of, slices):
    rng = random.Random(slices)
    rows = [(k, " ".join(["w"] * rng.randrange(1, 60)), "en", rng.choice(["a", "a", "a", "a", "b", "c", None, "é"])) for k in range(1500)]
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    expected = targets(sizes)
    found = {r.doc_id: r for r in sampled_mix(docs_of(rows), slices=slices).collect()}
    taken = {}
    for doc_id, text, _, source in rows:
        r = found[doc_id]
        assert r.size == len(words(text)) and r.source_size == sizes[source]
        assert r.target == pytest.approx(expected[source]) and r.taken == r.copies * r.size <= 2 * r.size
        taken[source] = taken.get(source, 0) + r.taken
    assert all(abs(taken[s] - expected[s]) <= 30 for s in sizes)
    again = {r.doc_id: r.taken for r in sampled_mix(docs_of(rows[::-1]), slices=slices).collect()}
    assert again == {k: r.taken for k, r in found.items()}


def expected(sizes, target, limit=2):
    """Copies in proportion to bit lengths, up to the limit, that make the target."""
    low, high = 0.0, float(limit)
    for _ in range(200):
        level = (low + high) / 2
        made = sum(n * min(limit, level * max(1, n.bit_length())) for n in sizes)
        low, high = (level, high) if made < target else (low, level)
    return lambda n: min(limit, level * max(1, n.bit_length()))


def number(doc_id):
    return (int(hashlib.md5(f"{doc_id}:".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)


@pytest.mark.parametrize("slices", [4096, 3])
def test_documents_have_probabilities_of_their_own(docs_of, slices):
    rng = random.Random(5)
    rows = [(k, " ".join(["w"] * int(2 ** rng.uniform(0, 9))), "en", rng.choice("aaabb")) for k in range(1200)]
    found = {r.doc_id: r for r in _planned(docs_of(rows), (5, 2, 1), 1.5, 2.0, slices).collect()}
    by_rank = {}
    for source in "ab":
        own = {i: len(words(t)) for i, t, _, s in rows if s == source}
        target = found[min(own)].target
        copies = expected(own.values(), target)
        odds, rest = {}, target
        for i, n in own.items():
            whole = int(copies(n) + 1e-9)
            p = copies(n) - whole
            assert (found[i].certain, found[i].p) == (whole, pytest.approx(p, abs=1e-9))
            rest -= whole * n
            if p > 1e-9:
                odds[i] = number(i) / (1 - number(i)) / (p / (1 - p))
        assert len({round(found[i].p, 6) for i in odds}) > 3  # unequal
        taken, ranked = set(), sorted(odds, key=odds.get)
        for i in ranked:
            if own[i] - rest > rest:
                break
            taken.add(i)
            rest -= own[i]
        assert {i for i in own if found[i].copies > found[i].certain} == taken
        by_rank[source] = ranked
    assert any(order != sorted(order, key=number) for order in by_rank.values())


def test_longer_documents_are_likelier(docs_of):
    rows = [(k, " ".join(["w"] * (4 if k % 2 else 400)), "en", "a") for k in range(3000)]
    mix = sampled_mix(docs_of(rows), share=0.5).collect()
    short, long = (sum(r.copies for r in mix if r.size == n) for n in (4, 400))
    assert short / long == pytest.approx(3 / 9, rel=0.15)  # bit lengths


def test_rows_of_one_id_and_different_texts(docs_of):
    rows = [(k // 2, " ".join(["w"] * (3 if k % 2 else 300)), "en", "a") for k in range(200)]
    table = docs_of(rows)
    plan = sorted((r.doc_id, r.size, r.copies) for r in sampled_mix(table, share=0.7).collect() if r.copies)
    assert plan == sorted((r.doc_id, r.size, r.copies) for r in mixed(table, share=0.7).collect())


def test_edges(edges, clashing, nothing):
    for table in (edges, clashing):
        found = sampled_mix(table).collect()
        assert len(found) == len(EDGES)
        assert {r.taken for r in found if r.size == 0} == {0}
    kept = mixed(clashing)
    assert set(clashing.columns) <= set(kept.columns) and {r.copies for r in kept.collect()} <= {1, 2}
    assert sampled_mix(nothing).collect() == [] and mixed(nothing).collect() == []


def test_targets_of_no_and_of_empty_sources(spark):
    schema = "source string, source_size long"
    assert source_targets(spark.createDataFrame([], schema)).collect() == []
    found = {r.source: r.target for r in source_targets(spark.createDataFrame([("a", 0), ("b", 10), (None, 0)], schema)).collect()}
    assert found == {"a": 0, "b": 15, None: 0}
