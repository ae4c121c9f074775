"""How filters overlap, and what each one removes in every order of applying them.

The words of the texts are a sparse document-term matrix. Words are encoded by one
dictionary for the whole table, and every slice of rows is a shard in compressed sparse
row form (CSR). Row sums are the numbers of words and nonzero counts those of distinct
words, which decide two of the filters; flags of the others are attached to the rows. A
row of the table is then a set of filters that it fails, and counts of the 32 sets of
each part give all orders.

The code of a word is a 63-bit hash. Words of the dictionary that share a hash get codes
of their own, below zero, so that codes are exact and yet no occurrence of a word has to
meet the dictionary in a shuffle. Shuffled are the distinct words of each shard once, a
digest of each text and counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tricycle.llm.words import small_batches, text_bytes
from tricycle.plans import looked_up, materialize

FILTERS = "ABCDE"
ORDERS = ["".join(order) for order in permutations(FILTERS)]
LEAST_WORDS = 50
LEAST_DISTINCT = 65  # percent of the words
MOST_UPPER = 5  # percent of the characters
SYMBOLS = b"#$%&*|"
SHARD_BYTES = 1 << 23  # of text, or one text that is longer
HASH_BITS = 63
# Words with a hash that other words have, sent to all tasks: about n * n / 2 ** 63 of n.
CLASHES = 1_000_000
# Texts with copies, sent to all tasks with their smallest ids; others are shuffled.
HOT_TEXTS = 100_000

_BYTES = np.arange(256)
_SPACE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_FIRST = (_BYTES & 0xC0) != 0x80  # bytes that begin a character
_SYMBOL = np.isin(_BYTES, list(SYMBOLS))


# ---------------------------------------------------------------- the document-term matrix


def _shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``size`` bytes of text, or of one longer text."""
    held, total = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(np.diff(text_bytes(batch.column("text"))[1]))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, before + size - total, "right")), start + (not held))
            if stop > start:
                held.append(batch.slice(start, stop - start))
                total += int(ends[stop - 1] - before)
            start = stop
            if total >= size or start < batch.num_rows:
                yield _joined(held)
                held, total = [], 0
    if held:
        yield _joined(held)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _before(marked: np.ndarray) -> np.ndarray:
    """How many are marked before each place, and in all."""
    found = np.zeros(len(marked) + 1, np.int32 if len(marked) < 1 << 31 else np.int64)
    np.cumsum(marked, out=found[1:])
    return found


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of texts, dictionary-encoded within the shard, and their rows."""
    gap = _SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = np.flatnonzero(~gap & (edge[:-1] | np.concatenate(([True], gap[:-1]))[: len(gap)]))
    kept = _before(~gap)
    bounds = np.append(kept[begins], kept[-1]).astype(np.int64)
    words = pa.Array.from_buffers(
        pa.large_binary(), len(begins), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(data[~gap].tobytes())]
    )
    return words.dictionary_encode(), np.searchsorted(offsets, begins, "right") - 1


def _hash(word: bytes, bits: int) -> int:
    return xxhash.xxh3_64_intdigest(word) >> (64 - bits)


def csr(texts: pa.Array, clashes: dict[bytes, int], bits: int = HASH_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A shard of the matrix: where each row begins, and for each entry the code of the
    word and how often the row has it.
    """
    data, offsets = text_bytes(texts)
    words, rows = _words(data, offsets)
    codes = np.array([clashes.get(w) or _hash(w, bits) for w in words.dictionary.to_pylist()], np.int64)
    local = words.indices.to_numpy().astype(np.int64)
    width = max(len(codes), 1)
    entries, counts = np.unique(rows * width + local, return_counts=True)
    bounds = np.searchsorted(entries // width, np.arange(len(texts) + 1))
    return bounds, codes[entries % width] if len(entries) else codes[:0], counts


def dictionary(docs: DataFrame, size: int = SHARD_BYTES, bits: int = HASH_BITS) -> DataFrame:
    """``(word BINARY, code LONG)``: each distinct word of the texts once, as its bytes."""

    def distinct(batches):
        for shard in _shards(batches, size):
            words = _words(*text_bytes(shard.column("text")))[0].dictionary.cast(pa.binary())
            codes = pa.array([_hash(w, bits) for w in words.to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([words, codes], ["word", "code"])

    texts = docs.select(F.col("text").cast("string").alias("text"))
    with small_batches(docs.sparkSession):
        hashed = materialize(texts.mapInArrow(distinct, "word binary, code long").distinct(), "dictionary")
    clashes = _clashes(hashed)
    if not clashes:
        return hashed
    own = docs.sparkSession.createDataFrame([*clashes.items()], "word binary, own long")
    return hashed.join(F.broadcast(own), "word", "left").select("word", F.coalesce("own", "code").alias("code"))


def _clashes(hashed: DataFrame) -> dict[bytes, int]:
    """Words whose hash another word has, with codes below zero."""
    shared = hashed.groupBy("code").count().where("count > 1").select("code")
    rows = hashed.join(shared, "code", "left_semi").select("word").limit(CLASHES + 1).collect()
    if len(rows) > CLASHES:
        raise ValueError(f"more than {CLASHES} words share a hash of too few bits")
    return {word: -1 - k for k, word in enumerate(sorted(bytes(r.word) for r in rows))}


def matrix(docs: DataFrame, size: int = SHARD_BYTES, bits: int = HASH_BITS) -> DataFrame:
    """The document-term matrix: a row for each shard, with the ids of its documents
    (``doc_ids``), where each document's entries begin (``bounds``, one more than
    documents), and for each entry the word's ``code`` and ``count``.
    """
    clashes = _known_clashes(docs, size, bits)

    def build(batches):
        for shard in _shards(batches, size):
            found = [batch_list(x) for x in csr(shard.column("text"), clashes, bits)]
            ids = pa.array([shard.column("doc_id").to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *found], ["doc_ids", "bounds", "codes", "counts"])

    def batch_list(values: np.ndarray) -> pa.Array:
        return pa.array([values.astype(np.int64)], pa.list_(pa.int64()))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(build, "doc_ids array<long>, bounds array<long>, codes array<long>, counts array<long>")


def _known_clashes(docs: DataFrame, size: int, bits: int) -> dict[bytes, int]:
    negative = dictionary(docs, size, bits).where("code < 0").collect()
    return {bytes(r.word): r.code for r in negative}


# ---------------------------------------------------------------- filters


def failures(docs: DataFrame, size: int = SHARD_BYTES, bits: int = HASH_BITS) -> DataFrame:
    """``(doc_id, part, mask)`` of each row: bit ``k`` of the mask is set where the row
    fails filter ``k``. See ``audit``.
    """
    clashes = _known_clashes(docs, size, bits)

    def flag(batches):
        for shard in _shards(batches, size):
            texts = shard.column("text")
            bounds, _, counts = csr(texts, clashes, bits)
            n_words = np.diff(np.concatenate(([0], np.cumsum(counts)))[bounds])
            n_distinct = np.diff(bounds)
            data, offsets = text_bytes(texts)
            upper, first, symbol = (
                np.diff(_before(kind[data])[offsets]) for kind in (_UPPER, _FIRST, _SYMBOL)
            )
            failed = (
                n_words < LEAST_WORDS,
                100 * n_distinct < LEAST_DISTINCT * n_words,
                100 * upper > MOST_UPPER * first,
                symbol > 0,
            )
            mask = sum(f.astype(np.int32) << k for k, f in enumerate(failed))
            columns = [shard.column(c) for c in ("doc_id", "part", "digest")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(mask, pa.int32())], ["doc_id", "part", "digest", "mask"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        text.alias("text"),
    )
    schema = "doc_id long, part string, digest binary, mask int"
    with small_batches(docs.sparkSession):
        flagged = materialize(rows.mapInArrow(flag, schema), "flags")
    copies = (
        flagged.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("smallest"))
        .where("n > 1")
    )
    found = looked_up(flagged, ["digest"], copies, "n", HOT_TEXTS)
    return found.selectExpr("doc_id", "part", "mask + if(coalesce(smallest < doc_id, false), 16, 0) AS mask")


def outcomes() -> dict[str, np.ndarray]:
    """For each order and step (rows) and each set of failed filters (columns) whether a
    document is kept, removed, redundant, or failing this filter only.
    """
    masks = np.arange(1 << len(FILTERS))
    found = {name: [] for name in ("kept", "removed", "redundant", "unique_fails")}
    for order in ORDERS:
        gone = np.zeros(len(masks), bool)
        for letter in order:
            bit = 1 << FILTERS.index(letter)
            fails = masks & bit > 0
            found["removed"].append(fails & ~gone)
            found["redundant"].append(fails & gone)
            found["unique_fails"].append(masks == bit)
            gone = gone | fails
            found["kept"].append(~gone)
    return {name: np.array(rows).astype(np.int64) for name, rows in found.items()}


def audit(docs: DataFrame, labels: DataFrame, size: int = SHARD_BYTES, bits: int = HASH_BITS) -> DataFrame:
    """For each part, order of the five filters and step what that step does.

    Filters remove a text: A of under 50 words, B of which under 65 % of the words are
    distinct, C of which over 5 % of the characters are A-Z, D with one of ``#$%&*|``, E
    that equals the text of a row with a smaller doc_id. Columns: ``part`` (the source,
    null as the empty string), ``filter_order``, ``step`` from 1, and counts of documents:
    ``kept`` after the step, ``removed`` by it, ``redundant`` (failing, but removed
    before), ``unique_fails`` (failing this filter only), ``good_lost`` and ``toxic_lost``
    (removed here and labelled so), ``shapley`` (what the step's filter removes, summed
    over all orders).

    A null text is an empty one: it fails A, and E beside another one. A null doc_id
    is neither smaller nor larger than others, so that its text never fails E, and has no
    labels. Repeated rows count each and do not fail E for each other. Labels other than
    1 and null labels count as 0; of several labels of a doc_id the largest counts.
    Further columns are ignored; an empty table gives an empty result.
    """
    marked = failures(docs, size, bits).groupBy("doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    known = (
        labels.where("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(*(F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0))).alias(c) for c in ("quality", "toxic")))
    )
    sets = (
        marked.join(known, "doc_id", "left")
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"),
            *(F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in ("quality", "toxic")),
        )
        .groupBy("part")
        .agg(F.collect_list(F.struct("mask", "n", "quality", "toxic")).alias("sets"))  # at most 32
    )
    schema = (
        "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long,"
        " good_lost long, toxic_lost long, shapley long"
    )

    def expand(batches):
        table = outcomes()
        names = np.repeat(ORDERS, len(FILTERS))
        steps = np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS))
        letters = np.array([FILTERS.index(c) for order in ORDERS for c in order])
        for batch in batches:
            for part, found in zip(batch.column("part").to_pylist(), batch.column("sets").to_pylist(), strict=True):
                n, good, toxic = np.zeros((3, 1 << len(FILTERS)), np.int64)
                for s in found:
                    n[s["mask"]], good[s["mask"]], toxic[s["mask"]] = s["n"], s["quality"], s["toxic"]
                counts = [table[c] @ n for c in ("kept", "removed", "redundant", "unique_fails")]
                removed = np.bincount(letters, counts[1], len(FILTERS)).astype(np.int64)
                counts += [table["removed"] @ good, table["removed"] @ toxic, removed[letters]]
                columns = [pa.array([part] * len(steps)), pa.array(names.tolist()), pa.array(steps), *map(pa.array, counts)]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in schema.split(", ")])

    return sets.mapInArrow(expand, schema)
