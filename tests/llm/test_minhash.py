import random

import pytest
from brute import components, shingles
from conftest import EDGES

from tricycle.llm import components as stars
from tricycle.llm.minhash import deduplicated, linked_sets, near_duplicates


def families(seed, count=40):
    """Texts in families of near copies, some only linked through others."""
    rng = random.Random(seed)
    rows, doc_id = [], 0
    for f in range(count // 8):
        text = [f"f{f}w{rng.randrange(400)}" for _ in range(80)]
        for _ in range(8):
            rows.append((doc_id, " ".join(text), "en", "s"))
            doc_id += rng.randrange(1, 3)
            for _ in range(rng.randrange(3)):
                text[rng.randrange(80)] = f"x{rng.randrange(10**6)}"
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [512, 3])
def test_components_equal_brute_force(docs_of, block):
    rows = families(block)
    expected = components([r[:2] for r in rows])
    found = near_duplicates(docs_of(rows), block=block).collect()
    assert {r.doc_id: r.component_id for r in found} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    assert len(set(expected.values())) < len(expected)


def test_edges(edges, clashing, nothing):
    expected = components([r[:2] for r in EDGES])
    for table in (edges, clashing):
        found = near_duplicates(table).collect()
        assert len(found) == len(EDGES)
        for r in found:
            assert r.component_id == expected.get(r.doc_id)
            assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)
        assert {r.n_shingles for r in found if r.doc_id == 6} == {len(shingles(EDGES[6][1]))}
    assert near_duplicates(nothing).collect() == []
    assert deduplicated(nothing).collect() == []


@pytest.mark.parametrize("turn", range(3))
def test_every_text_of_a_repeated_id_is_linked(docs_of, turn):
    """Documents 20 and 30 are each near another text of document 8."""
    texts = {name: [f"{name}{k}" for k in range(60)] for name in "abc"}
    near = {name: " ".join(w[:-1] + ["changed"]) for name, w in texts.items()}
    rows = [(8, " ".join(texts["a"])), (8, " ".join(texts["b"])), (20, near["a"]), (30, near["b"]), (8, " ".join(texts["c"])), (5, near["c"]), (40, "else")]
    rows = [(i, t, "en", "s") for i, t in rows]
    found = near_duplicates(docs_of(rows[turn:] + rows[:turn])).collect()
    assert {r.doc_id: r.component_id for r in found} == {5: 5, 8: 5, 20: 5, 30: 5, 40: 40}
    assert {r.component_id for r in near_duplicates(docs_of([r for r in rows if r[0] in (8, 20, 30)])).collect()} == {8}


def test_one_row_of_each_group_stays(edges):
    kept = deduplicated(edges)
    assert kept.columns == edges.columns
    ids = [r.doc_id for r in kept.collect()]
    expected = components([r[:2] for r in EDGES])
    assert sorted(i for i in ids if i is not None) == sorted(set(expected.values()))
    assert ids.count(None) == 2


def test_link_threshold_is_exact():
    import numpy as np

    base = np.arange(100, dtype=np.uint64)
    assert linked_sets(base, base[:75], 75) and not linked_sets(base, base[:74], 75)


def test_components_of_a_path_a_star_and_loops(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    found = {r.node: r.component for r in stars.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == dict.fromkeys(range(41), 0) | dict.fromkeys(range(100, 130), 100) | {200: 200, 201: 200}
    assert stars.components(spark.createDataFrame([], "u long, v long")).collect() == []
