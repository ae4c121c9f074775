"""Labelled documents, and sums over them, for fitting classifiers on all of them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tricycle.llm.words import slices
from tricycle.plans.bitmap import bits_for, key_bitmap, maybe_among

READ_TEXTS = 64  # reduced at a time
CHUNK = 8_192  # numbers of a sum that a task adds up
FAN = 64  # shards whose vectors a task adds up at a time


def packed(values: np.ndarray) -> bytes:
    """The bytes of an array, compressed, after their number."""
    data = values.tobytes()
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.decompress(data[8:], size, "zstd", asbytes=True), kind) if size else np.empty(0, kind)


def fold(doc_id: Column | str, folds: int) -> Column:
    """``crc32`` of the id as text, modulo ``folds``; a null id counts as empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % folds


def known_labels(labels: DataFrame, label: str, folds: int, held: int) -> DataFrame:
    """``(doc_id, label)`` of every labelled document that is not held out.

    Labels of held-out documents (``fold`` is ``held``) are never looked at, nor are
    null labels; a doc_id with several labels has the largest.
    """
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold("doc_id", folds) != held))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col(label).cast("int")).alias("label"))
    )


def labelled(docs: DataFrame, known: DataFrame, reduced: Callable[[pa.Array], Iterable[np.ndarray]]) -> DataFrame:
    """``(doc_id, label, lang, found)``: what ``reduced`` makes of the whole text of each
    document of ``known``, one array of a fixed type for each text, packed (``unpacked``
    restores it), with its language (null as empty).

    Of several rows with an id it is the one whose text and language are smallest. The
    language is empty where ``docs`` has no such column. A bitmap of the ids drops most
    other documents where they are; texts are reduced by the executors.
    """
    language = F.col("lang").cast("string") if "lang" in docs.columns else F.lit("")
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.coalesce(language, F.lit("")).alias("lang"),
    ).where("doc_id IS NOT NULL")
    if bits := bits_for(known.count()):
        texts = maybe_among(texts, ["doc_id"], key_bitmap(known, ["doc_id"], bits), bits)
    one = texts.join(known, "doc_id").groupBy("doc_id", "label").agg(F.min(F.struct("text", "lang")).alias("one"))

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, READ_TEXTS):
            if batch.num_rows:
                found = [packed(a) for a in reduced(batch.column("text"))]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("doc_id", "label", "lang")), pa.array(found, pa.binary())],
                    ["doc_id", "label", "lang", "found"],
                )

    whole = one.select("doc_id", "label", "one.text", "one.lang")
    return whole.mapInArrow(reduce, "doc_id long, label int, lang string, found binary")


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    folds: int,
    held: int,
    per_class: int,
    reduced: Callable[[pa.Array], Iterable[np.ndarray]],
) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """``labelled`` rows of at most ``per_class`` documents with each label, to look at: their
    packed arrays, labels and languages. The documents are those whose hashed ids are
    smallest, in order of their ids, so that reruns agree. Nothing is fitted on it.
    """
    known = known_labels(labels, label, folds, held)
    of_label = [known.where(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for v in (0, 1)]
    table = labelled(docs, of_label[0].union(of_label[1]), reduced).toArrow().sort_by("doc_id")
    return table["found"].to_pylist(), table["label"].to_numpy().astype(np.float64), np.array(table["lang"].to_pylist(), object)


def summed(rows: DataFrame, partial: Callable[[Iterator[pa.RecordBatch]], np.ndarray]) -> np.ndarray:
    """The sum of what ``partial`` makes of the rows of each task, a vector of floats of one
    length. Vectors are cut into chunks, which executors add up in the order of tasks; the
    driver gets one vector.
    """

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = partial(batches)
        parts = [vector[a : a + CHUNK].tobytes() for a in range(0, len(vector), CHUNK)]
        task = [TaskContext.get().partitionId()] * len(parts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(task, pa.int32()), pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())],
            ["task", "chunk", "part"],
        )

    def added(table: pa.Table) -> pa.Table:
        table = table.sort_by("task")
        total = np.zeros(len(table["part"][0].as_py()) // 8)
        for part in table["part"]:
            total += np.frombuffer(part.as_py())
        return pa.table({"chunk": table["chunk"][:1], "part": pa.array([total.tobytes()], pa.binary())})

    parts = rows.mapInArrow(of_task, "task int, chunk int, part binary").groupBy("chunk")
    total = parts.applyInArrow(added, "chunk int, part binary").toArrow().sort_by("chunk")
    return np.concatenate([np.empty(0), *(np.frombuffer(p.as_py()) for p in total["part"])])


def summed_shards(rows: DataFrame, shards: int, partial: Callable[[pa.Table], np.ndarray]) -> np.ndarray:
    """The sum of what ``partial`` makes of the rows of each ``shard`` (0 to ``shards`` - 1),
    in order of their ids: vectors of one length and type. At least one row is expected.

    Vectors are cut into packed chunks, which executors add up, ``FAN`` shards at a time
    and in their order, so that the sum does not depend on how rows lie in tasks; the
    driver gets one vector.
    """

    def of_shard(table: pa.Table) -> pa.Table:
        vector = partial(table.sort_by("doc_id"))
        starts = range(0, len(vector), CHUNK)
        return pa.table(
            {
                "shard": pa.array([table["shard"][0].as_py()] * len(starts), pa.int32()),
                "chunk": pa.array(range(len(starts)), pa.int32()),
                "kind": pa.array([vector.dtype.str] * len(starts)),
                "part": pa.array([packed(vector[a : a + CHUNK]) for a in starts], pa.binary()),
            }
        )

    def added(table: pa.Table) -> pa.Table:
        table = table.sort_by("shard")
        kind = np.dtype(table["kind"][0].as_py())
        total = np.sum([unpacked(p.as_py(), kind).astype(np.float64) for p in table["part"]], axis=0).astype(kind)
        first = table.slice(0, 1).set_column(0, "shard", pa.array([table["shard"][0].as_py() // FAN], pa.int32()))
        return first.set_column(3, "part", pa.array([packed(total)], pa.binary()))

    schema = "shard int, chunk int, kind string, part binary"
    parts = rows.groupBy("shard").applyInArrow(of_shard, schema)
    while True:
        parts = parts.groupBy("chunk", F.expr(f"shard div {FAN}")).applyInArrow(added, schema)
        shards = -(-shards // FAN)
        if shards == 1:
            break
    total = parts.toArrow().sort_by("chunk")
    return np.concatenate([unpacked(p.as_py(), np.dtype(k.as_py())) for p, k in zip(total["part"], total["kind"], strict=True)])
