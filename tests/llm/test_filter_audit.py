import random
from itertools import permutations

import pytest
from brute import words_as_written
from conftest import EDGES

from tricycle.llm.filter_audit import audit, dictionary, failures, matrix


def fails(rows):
    """The filters that each row fails."""
    out = []
    for doc_id, text, _, source in rows:
        t = text or ""
        w = words_as_written(t)
        f = set()
        f |= {"A"} if len(w) < 50 else set()
        f |= {"B"} if 100 * len(set(w)) < 65 * len(w) else set()
        f |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t) else set()
        f |= {"D"} if any(c in "#$%&*|" for c in t) else set()
        smaller = any(r[0] is not None and doc_id is not None and r[0] < doc_id and (r[1] or "") == t for r in rows)
        f |= {"E"} if smaller else set()
        out.append((source or "", doc_id, f))
    return out


def brute(rows, labels):
    failed = fails(rows)
    good = {i for i, quality, _ in labels if quality == 1} - {None}
    toxic = {i for i, _, t in labels if t == 1} - {None}
    found = {}
    for part in {p for p, _, _ in failed}:
        own = [(i, f) for p, i, f in failed if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, x in enumerate(order, 1):
                out = [(i, f) for i, f in left if x in f]
                left = [(i, f) for i, f in left if x not in f]
                shapley[x] += len(out)
                found[part, order, step] = (
                    len(left),
                    len(out),
                    sum(x in f for _, f in own) - len(out),
                    sum(f == {x} for _, f in own),
                    sum(i in good for i, _ in out),
                    sum(i in toxic for i, _ in out),
                )
        for order in map("".join, permutations("ABCDE")):
            for step, x in enumerate(order, 1):
                found[part, order, step] += (shapley[x],)
    return found


def as_dict(rows):
    names = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    return {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in rows}


def corpus(n=400, seed=4):
    rng = random.Random(seed)
    vocabulary = ["w%d" % k for k in range(60)] + ["Été", "NASA", "a#b", "100%", "日本", "W1", "w1"]
    rows = []
    for k in range(n):
        size = rng.choice([0, 1, 49, 50, 51, 80, 200])
        text = rng.choice([" ", "\t", "\n", "  "]).join(rng.choices(vocabulary, k=size))
        if rng.random() < 0.3 and rows:
            text = rng.choice(rows)[1]
        if rng.random() < 0.1:
            text = (text or "x").upper()
        rows.append((rng.choice([k, k, k, None, 3]), text if rng.random() < 0.95 else None, "en", rng.choice(["a", "a", "", None, "é"])))
    labels = [(rng.randrange(n), rng.choice([0, 1, None, 2]), rng.choice([0, 1, None])) for _ in range(n)] + [(None, 1, 1)]
    return rows, labels


@pytest.mark.parametrize("size, bits", [(1 << 24, 63), (700, 63), (700, 5)])
def test_audit_against_brute_force(spark, docs_of, size, bits):
    rows, labels = corpus()
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert as_dict(audit(docs_of(rows), table, size, bits).collect()) == brute(rows, labels)


def test_edges(spark, edges, clashing, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 1), (7, 1, 1)], "doc_id long, quality int, toxic int")
    expected = brute(EDGES, [(1, 1, 0), (6, 0, 1), (7, 1, 1)])
    assert as_dict(audit(edges, labels).collect()) == expected
    assert as_dict(audit(clashing, labels.withColumns({c: labels.doc_id for c in ("part", "mask", "n")})).collect()) == expected
    assert audit(nothing, labels).collect() == []
    assert {r.good_lost for r in audit(edges, labels.limit(0)).collect()} == {0}


@pytest.mark.parametrize("bits", [63, 3])
def test_matrix_has_every_word_of_every_text(docs_of, bits):
    rows, _ = corpus(120)
    docs = docs_of(rows)
    coded = dictionary(docs, 900, bits).collect()
    by_code = {r.code: bytes(r.word).decode() for r in coded}
    assert len(by_code) == len(coded)  # codes are exact, also where hashes clash
    found = []
    for shard in matrix(docs, 900, bits).collect():
        for k, doc_id in enumerate(shard.doc_ids):
            a, b = shard.bounds[k], shard.bounds[k + 1]
            found.append((doc_id, tuple(sorted((by_code[c], n) for c, n in zip(shard.codes[a:b], shard.counts[a:b], strict=True)))))
    expected = []
    for doc_id, text, *_ in rows:
        w = words_as_written(text or "")
        expected.append((doc_id, tuple(sorted((x, w.count(x)) for x in set(w)))))
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_failures_mark_each_row(docs_of):
    rows, _ = corpus(100, seed=8)
    expected = sorted((p, i, sum(1 << "ABCDE".index(x) for x in f)) for p, i, f in fails(rows) if i is not None)
    found = failures(docs_of(rows), 500).where("doc_id IS NOT NULL").collect()
    assert sorted((r.part, r.doc_id, r.mask) for r in found) == expected
