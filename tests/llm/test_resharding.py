import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tricycle.llm.registered import op13_flow_resharding
from tricycle.llm.resharding import cheapest_transfers, even_capacities, resharded, rewrite_shards, with_slots

SCHEMA = "id long, old_shard int, size long, shard string, place_id string, bytes string, parts string"


def table(spark, rows):
    return spark.createDataFrame([(i, s, z, "x", "x", "x", "x") for i, s, z in rows], SCHEMA)


def least_cost(supply, capacity, cost):
    """All ways, unit by unit."""
    best = {tuple([0] * len(capacity)): 0}
    for i, s in enumerate(supply):
        for _ in range(s):
            after = {}
            for used, c in best.items():
                for j in range(len(capacity)):
                    if used[j] < capacity[j]:
                        key = used[:j] + (used[j] + 1,) + used[j + 1 :]
                        after[key] = min(after.get(key, 1e9), c + cost[i][j])
            best = after
    return min(best.values(), default=0)


@pytest.mark.parametrize("seed", range(12))
def test_transfers_cost_the_least(seed):
    rng = random.Random(seed)
    n, m = rng.randrange(1, 5), rng.randrange(1, 5)
    supply = [rng.randrange(0, 5) for _ in range(n)]
    capacity = [rng.randrange(0, 4) for _ in range(m)]
    capacity[0] += max(0, sum(supply) - sum(capacity))
    cost = np.array([[rng.randrange(0, 6) for _ in range(m)] for _ in range(n)], float)
    flow = cheapest_transfers(supply, capacity, cost)
    assert all(sum(f for (i, _), f in flow.items() if i == k) == supply[k] for k in range(n))
    assert all(sum(f for (_, j), f in flow.items() if j == k) <= capacity[k] for k in range(m))
    assert sum(cost[i][j] * f for (i, j), f in flow.items()) == least_cost(supply, capacity, cost)


def test_too_little_capacity():
    with pytest.raises(ValueError):
        cheapest_transfers([3], [1, 1], np.zeros((1, 2)))


@pytest.mark.parametrize("block_rows", [4096, 10])
def test_shards_are_even_and_the_fewest_bytes_move(spark, block_rows):
    rng = random.Random(block_rows)
    rows = [(k, rng.choice([0, 0, 0, 1, 2, 9, None]), rng.choice([0, 1, 5, 20, 90, 400])) for k in range(1200)]
    rows += [(5, 0, 90)] * 300 + [(6, 1, None)]
    found = with_slots(resharded(table(spark, rows), 6, block_rows=block_rows), slice_rows=50).collect()
    assert Counter((r.id, r.old_shard, r["size"]) for r in found) == Counter(rows)
    sizes, slots, old = Counter(), defaultdict(list), Counter()
    for r in found:
        sizes[r.shard] += r["size"] or 0
        slots[r.shard].append(r.slot)
        old[r.old_shard] += r["size"] or 0
    total = sum(sizes.values())
    assert set(sizes) == set(range(6)) and max(sizes.values()) - min(sizes.values()) <= 2 * 400
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    capacity = even_capacities(total, 6)
    optimum = total - sum(min(old.get(k, 0), capacity[k]) for k in range(6))
    moved = sum(r["size"] or 0 for r in found if r.shard != r.old_shard)
    assert moved <= optimum + 6 * 400


def test_capacities_and_costs(spark):
    rows = [(k, k % 3, 10) for k in range(300)]
    found = resharded(table(spark, rows), [0, 1000, 2500]).groupBy("shard").agg(F.sum("size").alias("n")).collect()
    assert {r.shard: r.n for r in found} == {1: 1000, 2: 2000}
    # A cheap neighbour takes what the shard cannot keep.
    cost = np.array([[0, 1, 5], [1, 0, 1], [5, 1, 0]], float)
    found = resharded(table(spark, rows), [500, 1500, 1000], cost=cost)
    moved = found.where("old_shard <> shard").groupBy("old_shard", "shard").agg(F.sum("size").alias("n")).collect()
    assert {(r.old_shard, r.shard): r.n for r in moved} == {(0, 1): 500}


def test_edges(spark):
    assert with_slots(resharded(table(spark, []), 3)).collect() == []
    found = resharded(table(spark, [(None, None, None), (1, 0, 0), (2, 1, 0)]), 2)
    assert len(found.collect()) == 3 and found.columns == ["id", "old_shard", "size", "bytes", "parts", "place_id", "shard"]
    one = with_slots(resharded(table(spark, [(1, 7, 1 << 40)]), 2)).collect()
    assert [(r.shard, r.slot) for r in one] in ([(0, 0)], [(1, 0)])


def test_files_are_kept_moved_or_split(spark, tmp_path):
    folder, out = str(tmp_path / "old"), str(tmp_path / "new")
    rows = spark.range(1000).selectExpr("id", "int(if(id < 700, 0, if(id < 900, 1, 2))) AS shard", "repeat('x', int(id % 7)) AS path", "'r' AS __text")
    rows.repartition(7, "id").write.partitionBy("shard").parquet(folder)
    size = F.length("path") + 10
    files = rewrite_shards(spark, folder, out, 4, size).collect()
    read = lambda shard: sorted(
        r.id for f in files if f.shard == shard for r in spark.read.parquet(f.path).select("id").collect() if not f.rewritten
    ) + sorted(r.id for r in spark.read.parquet(out).where(f"shard = {shard}").select("id").collect())
    by_shard = {s: read(s) for s in range(4)}
    assert sorted(i for ids in by_shard.values() for i in ids) == list(range(1000))
    sizes = [sum(10 + i % 7 for i in ids) for ids in by_shard.values()]
    assert max(sizes) - min(sizes) <= 64
    assert sum(f.n_rows for f in files) == 1000 and {f.rewritten for f in files} == {True, False}
    # A file is either as it was or split, and few are split.
    assert len({f.path for f in files if not f.rewritten}) >= 21 - 6
    kept = [f for f in files if not f.rewritten and f"shard={f.shard}/" in f.path]
    assert kept


def test_query_lays_out_the_whole_table(spark):
    small = "/root/testdata/sf0.001"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    found = op13_flow_resharding(spark, small).collect()
    assert sorted(r.doc_id for r in found) == sorted(docs)
    assert all(r["size"] == len((docs[r.doc_id].text or "").encode()) + 16 for r in found)
    sizes = Counter()
    for r in found:
        sizes[r.shard] += r["size"]
    spread = max(sizes.values()) - min(sizes.values())
    assert set(sizes) == set(range(40)) and spread <= max(r["size"] for r in found)
