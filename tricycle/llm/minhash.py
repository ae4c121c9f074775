"""Near-duplicate documents by MinHash.

Signatures are minima of universal hash functions over a text's word shingles.
Texts that agree in all rows of a band meet in a bucket; there each is compared
with the bucket's smallest member, and what that leaves unconnected is compared
inside blocks of bounded size. A pair whose signatures agree well enough is confirmed
on the full shingle sets, and confirmed links are joined into components by
alternating large-star and small-star.

Equal sets are folded first, so copies cost one row each. With 32 bands of 4 rows a
pair at the threshold of 0.75 shares no bucket with probability 6e-6, and its
signatures fall below the margin with probability 2e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tricycle.llm.components import components, joined_components
from tricycle.llm.words import mix, shingle_hashes, slices, small_batches, word_hashes
from tricycle.plans import materialize

SHINGLE_WORDS = 5
THRESHOLD = 75  # percent of the union that two sets share
BANDS = 32
ROWS = 4
MARGIN = 0.17  # 4.5 standard deviations of the estimate at the threshold
BLOCK = 512  # members of a bucket that are compared with each other at once
# Ids of candidate texts that are broadcast; beyond it the lookup is a shuffle join.
BROADCAST_IDS = 1_000_000


def universal_functions(count: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """``count`` functions ``x -> (a * x + b) mod 2**64``, of which the upper 32 bits
    are a universal hash of a 32-bit ``x``.
    """
    drawn = np.random.default_rng(seed).integers(0, 1 << 64, (2, count), np.uint64)
    return drawn[0] | np.uint64(1), drawn[1]


def signature(shingles: np.ndarray, functions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The minimum of each function over a non-empty set, as 32-bit integers."""
    a, b = (x[:, None] for x in functions)
    least = np.full(len(a), np.iinfo(np.uint64).max)
    low = shingles & np.uint64(0xFFFFFFFF)
    for start in range(0, len(low), 2048):
        hashed = a * low[None, start : start + 2048]
        hashed += b
        np.minimum(least, hashed.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def _digest(shingles: np.ndarray) -> tuple[int | None, int | None]:
    """128 bits that tell different sets apart; null for the empty set."""
    if not len(shingles):
        return None, None
    return tuple(
        int(mix(shingles ^ np.uint64(salt)).sum(dtype=np.uint64).astype(np.int64)) for salt in (0, 0xA5A5A5A5A5A5A5A5)
    )


def _sign(batches: Iterator[pa.RecordBatch], size: int, count: int) -> Iterator[pa.RecordBatch]:
    functions = universal_functions(count)
    for batch in slices(batches):
        sets = shingle_hashes(*word_hashes(batch.column("text")), size)
        high, low = zip(*map(_digest, sets), strict=True) if sets else ((), ())
        signed = [signature(s, functions).tobytes() if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(high, pa.int64()),
                pa.array(low, pa.int64()),
                pa.array(signed, pa.binary()),
            ],
            ["doc_id", "n_shingles", "high", "low", "signature"],
        )


def signatures(docs: DataFrame, size: int = SHINGLE_WORDS, count: int = BANDS * ROWS) -> DataFrame:
    """``(doc_id, n_shingles, high, low, signature)`` of each document: the size of its
    shingle set, 128 bits that tell different sets apart, and its minima. The last
    three are null for a text without words.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        lambda batches: _sign(batches, size, count),
        "doc_id long, n_shingles long, high long, low long, signature binary",
    )


def band_keys(groups: DataFrame, bands: int, rows: int) -> DataFrame:
    """``(bucket, band, node)``: one row for each band of each signature."""

    def keys(batches):
        factors = mix(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
        for batch in batches:
            if not batch.num_rows:
                continue
            minima = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32)
            minima = minima.reshape(batch.num_rows, bands, rows).astype(np.uint64)
            keyed = mix((mix(minima + np.uint64(1)) * factors).sum(axis=2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64))
            band = np.tile(np.arange(bands, dtype=np.int32), batch.num_rows)
            nodes = np.repeat(batch.column("node").to_numpy(), bands)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keyed.ravel().astype(np.int64)), pa.array(band), pa.array(nodes)], ["bucket", "band", "node"]
            )

    return groups.select("node", "signature").mapInArrow(keys, "bucket long, band int, node long")


def _likely(pairs: DataFrame, groups: DataFrame, least: float) -> DataFrame:
    """Pairs ``(a, b)`` whose signatures agree in a share of ``least`` rows or more."""
    one = groups.select(F.col("node").alias("a"), F.col("signature").alias("one"))
    two = groups.select(F.col("node").alias("b"), F.col("signature").alias("two"))

    def agree(one: pd.Series, two: pd.Series) -> pd.Series:
        if not len(one):
            return pd.Series([], dtype="float64")
        width = len(one.iloc[0])
        first = np.frombuffer(b"".join(one), np.uint32).reshape(-1, width // 4)
        second = np.frombuffer(b"".join(two), np.uint32).reshape(-1, width // 4)
        return pd.Series((first == second).mean(axis=1))

    share = F.pandas_udf(agree, "double")
    return pairs.join(one, "a").join(two, "b").where(share("one", "two") >= least).select("a", "b")


def _shingle_sets(nodes: DataFrame, groups: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """``(node, shingles)``: the sorted shingle hashes of each node, 8 bytes each, from the
    texts of its smallest document; of several such texts from those with the node's set.
    """
    nodes = materialize(groups.select("node", "doc_id", "high", "low").join(nodes.distinct(), "node", "left_semi"), "nodes")
    lookup = F.broadcast(nodes) if nodes.count() <= BROADCAST_IDS else nodes

    def sets(batches):
        for batch in slices(batches):
            found = shingle_hashes(*word_hashes(batch.column("text")), size)
            wanted = zip(batch.column("high").to_pylist(), batch.column("low").to_pylist(), strict=True)
            own = pa.array([_digest(s) == w for s, w in zip(found, wanted, strict=True)], pa.bool_())
            packed = pa.array([s.tobytes() for s in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("node"), packed], ["node", "shingles"]).filter(own)

    full = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .join(lookup, "doc_id")
        .select("node", "high", "low", "text")
        .mapInArrow(sets, "node long, shingles binary")
        .dropDuplicates(["node"])
    )
    return materialize(full, "shingles")


def linked_sets(one: np.ndarray, two: np.ndarray, threshold: int) -> bool:
    """Whether two sorted sets share ``threshold`` percent of their union or more."""
    if 100 * min(len(one), len(two)) < threshold * max(len(one), len(two)):
        return False
    shared = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * shared >= threshold * (len(one) + len(two) - shared)


def _confirmed(pairs: DataFrame, groups: DataFrame, docs: DataFrame, size: int, threshold: int) -> DataFrame:
    """Pairs ``(a, b)`` whose full shingle sets are linked."""
    full = _shingle_sets(pairs.select(F.col("a").alias("node")).union(pairs.select("b")), groups, docs, size)

    def check(one: pd.Series, two: pd.Series) -> pd.Series:
        both = zip(one, two, strict=True)
        return pd.Series(
            [linked_sets(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), threshold) for a, b in both], dtype="bool"
        )

    checked = F.pandas_udf(check, "boolean")
    return (
        pairs.join(full.toDF("a", "one"), "a").join(full.toDF("b", "two"), "b").where(checked("one", "two")).select("a", "b")
    )


def _across(
    shared: DataFrame,
    groups: DataFrame,
    labels: DataFrame,
    docs: DataFrame,
    size: int,
    threshold: int,
    least: float,
    rows: int,
    block: int,
) -> DataFrame:
    """Links ``(a, b)`` between nodes that share a bucket but, so far, no component.

    A bucket's members are dealt into blocks of about ``block``, and two blocks at a
    time meet in a task, so that no task holds a whole large bucket. There each pair
    is looked at in the first band that it shares, if signatures agree well enough and
    no other link has connected it, and confirmed on the full sets.
    """
    member = (
        shared.join(labels, "node", "left")
        .select("bucket", "band", "node", F.coalesce("component", "node").alias("component"))
    )
    mixed = (
        member.groupBy("bucket")
        .agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high")
        .select("bucket", F.expr(f"int(1 + (n - 1) div {block})").alias("blocks"))
    )
    member = materialize(member.join(mixed, "bucket"), "mixed")
    full = _shingle_sets(member.select("node"), groups, docs, size)
    cells = (
        member.join(groups.select("node", "signature"), "node")
        .join(full, "node")
        .withColumn("own", F.expr("int(pmod(xxhash64(node), blocks))"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select(
            "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
            "own", "band", "node", "component", "signature", "shingles",
        )
    )

    def compare(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("node", ignore_index=True)
        signs = np.frombuffer(b"".join(frame.signature), np.uint32).reshape(len(frame), -1)
        band, need = int(frame.band[0]), least * signs.shape[1]
        earlier = signs[:, : band * rows].reshape(len(frame), band, rows)
        sets = [np.frombuffer(x, np.uint64) for x in frame.shingles]
        own, node = frame.own.to_numpy(), frame.node.to_numpy()
        root, part = np.unique(frame.component.to_numpy(), return_inverse=True)
        found = []
        for k in range(len(frame)):
            # Within one block each pair once, between two blocks only across.
            other = np.arange(k + 1, len(frame))
            other = other[(part[other] != part[k]) & ((own[other] != own[k]) | (key[1] == key[2]))]
            other = other[~(earlier[other] == earlier[k]).all(axis=2).any(axis=1)]
            agree = (signs[other] == signs[k]).sum(axis=1)
            other = other[agree >= need][np.argsort(-agree[agree >= need], kind="stable")]
            for m in other:
                if part[m] != part[k] and linked_sets(sets[k], sets[m], threshold):
                    found.append((node[k], node[m]))
                    part[part == part[m]] = part[k]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return cells.groupBy("bucket", "i", "j").applyInPandas(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    threshold: int = THRESHOLD,
    size: int = SHINGLE_WORDS,
    bands: int = BANDS,
    rows: int = ROWS,
    margin: float = MARGIN,
    block: int = BLOCK,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for each row of ``docs``.

    Documents are linked whose sets of distinct ``size``-word shingles share
    ``threshold`` percent of their union or more. ``component_id`` is the smallest
    doc_id that can be reached over links, ``kept`` marks the document that has it.

    Null, empty and blank texts have no shingles, are linked with nothing and kept.
    A text of fewer than ``size`` words is one shingle. Rows with the same doc_id are
    one document to the links, which is linked by the texts of all of them, and are all
    returned. A null doc_id is linked with
    nothing: its component is null and it is kept. Other columns are ignored; an
    empty table gives an empty result.
    """
    with small_batches(docs.sparkSession):
        signed, members, labels = _labelled(docs, threshold, size, bands, rows, margin, block)
    placed = (
        members.join(labels, "node", "left").select("high", "low", F.coalesce("component", "node").alias("component"))
    )
    return (
        signed.select("doc_id", "n_shingles", "high", "low")
        .join(placed, ["high", "low"], "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _with_nodes(groups: DataFrame) -> DataFrame:
    """The distinct sets with a number ``node`` of their own: the smallest id of a document
    that has the set or, of several sets with the same smallest document, for all but one
    a number above all ids. These are linked with the document's other sets, so that they
    are never the smallest node of a component.
    """
    sets = F.struct("high", "low")
    several = groups.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min(sets).alias("first")).where("n > 1")
    others = groups.select("doc_id", "high", "low").join(several, "doc_id").where(sets != F.col("first"))
    above = groups.agg(F.max("doc_id")).first()[0]
    numbers = materialize(others.select("high", "low", F.monotonically_increasing_id().alias("number")), "other-sets")
    if numbers.isEmpty():
        return groups.withColumn("node", F.col("doc_id"))
    own = F.coalesce(F.col("number") + F.lit(above) + 1, F.col("doc_id"))
    return materialize(groups.join(numbers, ["high", "low"], "left").withColumn("node", own).drop("number"), "groups")


def _labelled(
    docs: DataFrame, threshold: int, size: int, bands: int, rows: int, margin: float, block: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signatures of the documents, nodes of their sets, and components of the nodes."""
    signed = materialize(signatures(docs, size, bands * rows), "signatures")
    linked = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    folded = linked.groupBy("high", "low").agg(F.min("doc_id").alias("doc_id"), F.first("signature").alias("signature"))
    groups = _with_nodes(materialize(folded, "groups"))
    least = threshold / 100 - margin

    keys = materialize(band_keys(groups, bands, rows), "bands")
    heads = keys.groupBy("bucket").agg(F.min("node").alias("head"), F.max("node").alias("last")).where("head < last")
    shared = materialize(keys.join(heads, "bucket").select("bucket", "band", "node", "head"), "shared")

    members = groups.select("high", "low", "node")
    # Different texts under one doc_id are one document to the links.
    repeated = (
        linked.select("doc_id", F.struct("high", "low").alias("text"))
        .groupBy("doc_id").agg(F.min("text").alias("one"), F.max("text").alias("two")).where("one <> two")
    )
    same = (
        linked.join(repeated.select("doc_id"), "doc_id", "left_semi").join(members, ["high", "low"])
        .select("doc_id", "node").distinct()
    )
    # A star around the smallest of a document's sets, whose node is its id or a smaller one.
    centre = same.groupBy("doc_id").agg(F.min("node").alias("a"))
    same = same.join(centre, "doc_id").where("a <> node").select("a", F.col("node").alias("b"))

    close = shared.where("head < node").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    likely = materialize(_likely(close, groups, least), "likely")
    first = materialize(_confirmed(likely, groups, docs, size, threshold).union(same), "confirmed")
    labels = materialize(components(first), "labels")

    second = materialize(_across(shared, groups, labels, docs, size, threshold, least, rows, block), "across")
    return signed, members, joined_components(labels, second)


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """One document of each component of ``near_duplicates``, with all its columns: the
    one with the smallest doc_id. Of rows with that doc_id one stays, in order of a hash
    of the text; rows with a null doc_id and documents without words all stay.
    """
    kept = near_duplicates(docs, **options).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    place = F.row_number().over(Window.partitionBy("kept_id").orderBy(F.xxhash64(F.col("doc.text")), F.col("doc.text")))
    rows = docs.select(F.col("doc_id").cast("long").alias("kept_id"), F.struct("*").alias("doc"))
    named = rows.join(kept, "kept_id", "left_semi").withColumn("place", place).where("place = 1").select("doc.*")
    return named.union(docs.where("doc_id IS NULL"))
