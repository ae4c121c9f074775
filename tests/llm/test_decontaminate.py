from brute import bench_words, contaminated
from conftest import EDGES

from tricycle.llm.decontaminate import contamination, decontaminated

ITEM = "Which of these words was the last one that the old man wrote"
ITEMS = [(1, ITEM), (2, "one"), (3, None), (4, " ,. "), (10, ITEM), (None, "near the door"), (10, ITEM)]
ROWS = [
    (20, f"Before. {ITEM.upper()}! After it.", "en", "a"),
    (21, f"{ITEM} and once more: {ITEM}", "en", "a"),
    (22, "which of these words was the last one that the young man wrote", "en", "a"),
    (23, "which of these words was the last one", "en", "a"),
]


def test_equals_brute_force(spark, docs_of):
    rows = ROWS + EDGES
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    for broadcast in (1000, 0):
        found = contamination(docs_of(rows, clashing=True), benchmark, broadcast_windows=broadcast).collect()
        expected = []
        for doc_id, text, *_ in rows:
            hit, items = contaminated(text, ITEMS)
            rest = [w for k, w in enumerate(bench_words(text)) if k not in hit]
            expected.append((doc_id, len(bench_words(text)), len(hit), items, rest))
        mine = [(r.doc_id, r.n_words, r.n_hit, r["items"], bench_words(r.cleaned)) for r in found]
        assert sorted(mine, key=str) == sorted(expected, key=str)
        for r in found:
            assert r.n_hit == sum(s.after - s.first for s in r.spans)
            assert all(a.after < b.first for a, b in zip(r.spans, r.spans[1:], strict=False))


def test_documents_are_removed_whole(spark, docs_of):
    table = docs_of(ROWS + EDGES, clashing=True)
    kept = decontaminated(table, spark.createDataFrame([(1, ITEM)], "item_id long, text string"))
    assert kept.columns == table.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(map(str, ids)) == sorted(map(str, [23, *[r[0] for r in EDGES]]))


def test_empty_tables(spark, edges, nothing):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert contamination(nothing, empty).collect() == []
    assert {r.n_hit for r in contamination(edges, empty).collect()} == {0}
    assert decontaminated(edges, empty).count() == len(EDGES)


def test_passages_of_items_without_an_id_are_removed(spark, docs_of):
    docs = docs_of(ROWS + EDGES)
    benchmark = spark.createDataFrame([(None, "near the door"), (1, ITEM), (None, ITEM)], "item_id long, text string")
    removed = {1, 2, 20, 21, 22}
    for broadcast in (1000, 0):
        ids = [r.doc_id for r in decontaminated(docs, benchmark, broadcast_windows=broadcast).collect()]
        assert sorted(map(str, ids)) == sorted(str(r[0]) for r in ROWS + EDGES if r[0] not in removed)
