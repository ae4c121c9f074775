"""Moving rows between shards so that the fewest bytes move.

Old shards have sizes, new shards have capacities, and a transfer costs its bytes unless
the shard keeps them. The cheapest transfers are a minimum-cost flow between shards, of
which there are few, however many rows they have. A shard's rows are cut into blocks and
laid out in order; each transfer takes a run of them. Only the few blocks in which one
transfer ends and the next begins are split by rows. Rows learn their new shard from a
broadcast table with a row for each transfer, and none is shuffled but those of split
blocks.
"""

from __future__ import annotations

import heapq
import json

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tricycle.plans import materialize

# Rows of a block that may be split; the rows of a split block are one task's work.
BLOCK_ROWS = 4096
# Rows whose places in a shard one task counts.
SLICE_ROWS = 20_000
# Old times new shards: the transfers, and what the flow holds.
MOST_TRANSFERS = 1_000_000


# ---------------------------------------------------------------- flow between shards


def cheapest_transfers(supply: list[int], capacity: list[int], cost: np.ndarray) -> dict[tuple[int, int], int]:
    """How much each old shard sends to each new one at the least total cost, all of the
    supply within the capacity: successive shortest augmenting paths, with potentials that
    keep reduced costs from becoming negative.
    """
    n, m = len(supply), len(capacity)
    if sum(supply) > sum(capacity):
        raise ValueError("the capacity is less than what there is to place")
    left, room = np.array(supply, object), np.array(capacity, object)
    flow = np.zeros((n, m), object)
    of_old, of_new = np.zeros(n), cost.min(axis=0, initial=0.0) if n else np.zeros(m)
    while left.any():
        # Distances from any old shard with something left: over to a new one, or back
        # along a transfer that can be undone.
        far_old = np.where(left > 0, 0.0, np.inf)
        far_new, from_old, from_new = np.full(m, np.inf), np.full(m, -1), np.full(n, -1)
        done_old, done_new = np.zeros(n, bool), np.zeros(m, bool)
        while True:
            a = np.where(done_old, np.inf, far_old)
            b = np.where(done_new, np.inf, far_new)
            i, j = int(a.argmin()) if n else 0, int(b.argmin())
            if min(a[i], b[j]) == np.inf:
                break
            if a[i] <= b[j]:
                done_old[i] = True
                reached = far_old[i] + np.maximum(cost[i] + of_old[i] - of_new, 0)
                better = ~done_new & (reached < far_new)
                far_new[better], from_old[better] = reached[better], i
            else:
                done_new[j] = True
                if room[j] > 0:
                    break
                reached = far_new[j] + np.maximum(of_new[j] - cost[:, j] - of_old, 0)
                better = ~done_old & (flow[:, j] > 0) & (reached < far_old)
                far_old[better], from_new[better] = reached[better], j
        end, most = j, far_new[j]
        of_old += np.minimum(far_old, most)
        of_new += np.minimum(far_new, most)
        path, j = [], end
        while True:
            i = int(from_old[j])
            path.append((i, j, 1))
            if from_new[i] < 0:
                break
            j = int(from_new[i])
            path.append((i, j, -1))
        amount = min([left[i], room[end], *(flow[x, y] for x, y, sign in path if sign < 0)])
        left[i] -= amount
        room[end] -= amount
        for x, y, sign in path:
            flow[x, y] += sign * amount
    return {(i, j): int(flow[i, j]) for i in range(n) for j in range(m) if flow[i, j] > 0}


def even_capacities(total: int, count: int) -> list[int]:
    """``total`` in ``count`` parts that differ by one at most."""
    return [total // count + (k < total % count) for k in range(count)]


# ---------------------------------------------------------------- rows


def resharded(
    rows: DataFrame,
    capacities: int | list[int],
    block: Column | None = None,
    cost: np.ndarray | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``rows``, which have columns ``old_shard INT`` and ``size LONG``, with ``shard INT``.

    ``capacities`` are the sizes that shards 0, 1, ... shall have, or a number of shards
    of even sizes. ``cost[i][j]`` is what a unit costs that moves from the ``i``-th of the
    old shards, in order of their numbers, to shard ``j``; by default 0 for the shard of
    the same number and 1 for others. The sums of ``size`` are the flow's but for rows at
    the ends of transfers, of which each goes where most room is left.

    ``block`` says which rows go together where no transfer ends (such as those of a
    file); by default rows are dealt into blocks of about ``block_rows``. A block is one
    task's work where it is split. A null or negative size counts as 0, a null old shard is
    one more old shard, from which all moves. Repeated rows are placed each. Further
    columns are passed on, but ``shard`` and ``place_id`` are replaced; an empty table
    gives an empty result.
    """
    spark = rows.sparkSession
    kept = [c for c in rows.columns if c.lower() not in ("shard", "place_id")]
    rows = rows.select(
        F.struct(*kept).alias("row"),
        F.monotonically_increasing_id().alias("place_id"),
        F.coalesce(F.col("old_shard"), F.lit(-1)).cast("int").alias("old"),
        F.greatest(F.coalesce(F.col("size"), F.lit(0)), F.lit(0)).cast("long").alias("size"),
        *([block.alias("block")] if block is not None else []),
    )
    rows = materialize(rows, "reshard-rows")
    shards = rows.groupBy("old").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).orderBy("old")
    shards = shards.limit(MOST_TRANSFERS).collect()  # a row for each old shard
    if isinstance(capacities, int):
        capacities = even_capacities(sum(r.bytes for r in shards), capacities)
    if len(shards) * len(capacities) > MOST_TRANSFERS:
        raise ValueError(f"more than {MOST_TRANSFERS} pairs of old and new shards")
    if cost is None:
        new = np.arange(len(capacities))
        cost = np.array([(new != r["old"]).astype(float) for r in shards]).reshape(-1, len(capacities))
    flow = cheapest_transfers([r.bytes for r in shards], capacities, cost)
    # Runs of each old shard's bytes; the first and the last are open, for blocks without
    # size at the ends.
    pieces = []
    for i, r in enumerate(shards):
        own = sorted((j for k, j in flow if k == i), key=lambda j: (cost[i][j], j)) or [int(np.argmin(cost[i]))]
        ends = np.cumsum([0, *(flow.get((i, j), 0) for j in own)]).tolist()
        ends[0], ends[-1] = -1, 1 << 62
        pieces += [(r["old"], j, low, high) for j, low, high in zip(own, ends[:-1], ends[1:], strict=True)]
    pieces = spark.createDataFrame(pieces, "old int, piece int, low long, high long")
    if block is None:
        number = F.lit(1)
        for r in shards:
            if r.n > block_rows:
                number = F.when(F.col("old") == r["old"], 1 + r.n // block_rows).otherwise(number)
        rows = rows.withColumn("block", F.pmod(F.xxhash64("place_id"), number))
    return _placed(rows, pieces).select("row.*", "place_id", "shard")


def _placed(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """Rows with the shard of the piece that their block lies in, or of split blocks the
    one that the row is dealt to.
    """
    sums = rows.groupBy("old", "block").agg(F.sum("size").alias("bytes"))
    order = Window.partitionBy("old").orderBy("block")
    laid = sums.withColumn("stop", F.sum("bytes").over(order)).withColumn("start", F.col("stop") - F.col("bytes"))
    meets = "start < high AND if(bytes > 0, stop > low, start >= low)"
    met = laid.join(F.broadcast(pieces), "old").where(meets)
    met = met.groupBy("old", "block").agg(
        F.collect_list(
            F.struct("piece", F.expr("least(stop, high) - greatest(start, low)").alias("amount"))
        ).alias("parts")
    )
    met = materialize(met, "reshard-blocks")
    # Blocks inside one piece are runs of the shard's blocks: a row for each transfer.
    whole = met.where("size(parts) = 1").selectExpr("old", "block", "parts[0].piece AS shard")
    split = met.where("size(parts) > 1").select("old", "block", "parts")
    number = Window.partitionBy("old").orderBy("block")
    runs = (
        whole.withColumn("new", (~F.lag("shard").over(number).eqNullSafe(F.col("shard"))).cast("int"))
        .withColumn("run", F.sum("new").over(number))
        .groupBy("old", "run")
        .agg(F.first("shard").alias("shard"), F.min("block").alias("low"), F.max("block").alias("high"))
        .drop("run")
    )
    dealt = (
        rows.join(F.broadcast(split), ["old", "block"])
        .select("place_id", "old", "block", "size", F.to_json("parts").alias("parts"))
        .groupBy("old", "block")
        .applyInPandas(_dealt, "place_id long, shard int")
    )
    inside = rows.join(F.broadcast(split.select("old", "block")), ["old", "block"], "left_anti").join(
        F.broadcast(runs.withColumnRenamed("old", "o")),
        F.expr("old = o AND block BETWEEN low AND high"),
    )
    others = rows.join(F.broadcast(split.select("old", "block")), ["old", "block"], "left_semi").join(dealt, "place_id")
    return inside.select(*rows.columns, "shard").unionByName(others.select(*rows.columns, "shard"))


def _dealt(frame: pd.DataFrame) -> pd.DataFrame:
    """The rows of a split block, the largest first, each to the part with most room."""
    parts = [(p["piece"], p["amount"]) for p in json.loads(frame.parts.iloc[0])]
    heap = [(-amount, k) for k, (_, amount) in enumerate(sorted(parts))]
    shards = [shard for shard, _ in sorted(parts)]
    heapq.heapify(heap)
    frame = frame.sort_values(["size", "place_id"], ascending=[False, True])
    found = []
    for size in frame["size"].tolist():
        room, k = heap[0]
        heapq.heapreplace(heap, (room + size, k))
        found.append(shards[k])
    return pd.DataFrame({"place_id": frame["place_id"].to_numpy(), "shard": np.array(found, np.int32)})


def with_slots(placed: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``placed`` with ``slot LONG``: the places 0, 1, ... of each shard's rows. They are
    numbered in slices of about ``slice_rows``, after the sizes of earlier slices.
    """
    placed = materialize(placed, "placed")
    counts = placed.groupBy("shard").count()
    cut = counts.select("shard", F.expr(f"1 + count div {slice_rows}").alias("__slices"))
    sliced = placed.join(F.broadcast(cut), "shard").withColumn("__slice", F.expr("pmod(xxhash64(place_id), __slices)"))
    sizes = sliced.groupBy("shard", "__slice").count()
    order = Window.partitionBy("shard").orderBy("__slice")
    before = sizes.select("shard", "__slice", (F.sum("count").over(order) - F.col("count")).alias("__before"))
    own = Window.partitionBy("shard", "__slice").orderBy("place_id")
    return (
        sliced.withColumn("__own", F.row_number().over(own))
        .join(before, ["shard", "__slice"])
        .select(*placed.columns, (F.col("__before") + F.col("__own") - 1).alias("slot"))
    )


def text_size(text: Column | str, overhead: int) -> Column:
    """UTF-8 bytes of a text, 0 for null, and ``overhead``."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.octet_length(column), F.lit(0)).cast("long") + overhead


# ---------------------------------------------------------------- files


def rewrite_shards(
    spark: SparkSession, folder: str, out: str, capacities: int | list[int], size: Column
) -> DataFrame:
    """Reshard the Parquet files under ``folder/shard=N/`` and write those rows that must.

    Files are the blocks: a file goes to one new shard as it is, unless a transfer ends in
    it. Returns ``(shard, path, n_rows, rewritten)``, the files of the new shards: kept
    and moved ones under their present path, and the rows of split files anew under
    ``out/shard=N/``, once. ``folder`` stays as it is. ``size`` is the size of a row.

    Files without rows are in no shard; a table without rows gives an empty result.
    """
    read = spark.read.option("basePath", folder).parquet(folder)
    data = [c for c in read.columns if c != "shard"]
    path, row = F.col("_metadata.file_path").alias("__path"), F.col("_metadata.row_index").alias("__row")
    table = read.select(F.col("shard").alias("old_shard"), path, row, size.alias("size"))
    placed = materialize(resharded(table, capacities, block=F.col("__path")), "reshard-placed")
    files = placed.groupBy("__path", "shard").agg(F.count("*").alias("n_rows"))
    several = files.groupBy("__path").agg(F.count("*").alias("n")).where("n > 1").select("__path")
    several = materialize(several, "split-files")  # at most one for each transfer
    whole = files.join(F.broadcast(several), "__path", "left_anti")
    target = placed.join(F.broadcast(several), "__path", "left_semi").select("__path", "__row", "shard")
    # Only the split files are read again, in full.
    paths = [r["__path"] for r in several.collect()]
    split = spark.read.option("basePath", folder).parquet(*paths) if paths else read.limit(0)
    moved = split.select(*data, path, row).join(target, ["__path", "__row"]).select(*data, "shard")
    moved.write.partitionBy("shard").parquet(out)
    written = spark.read.schema(moved.schema).parquet(out).select("shard", path)
    written = written.groupBy("__path", "shard").agg(F.count("*").alias("n_rows"))
    columns = "shard", F.col("__path").alias("path"), "n_rows"
    return whole.select(*columns, F.lit(False).alias("rewritten")).unionByName(
        written.select(*columns, F.lit(True).alias("rewritten"))
    )
