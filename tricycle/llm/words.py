"""Words of texts, as SQL and as numpy hashes of Arrow batches.

A word is a run of bytes outside ``\\x20`` and ``\\x09-\\x0D``; only A-Z are
lower-cased. A null text has no words, like an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER_SQL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Bytes of text hashed at a time; a piece ends between words.
PIECE_BYTES = 1 << 20

_BYTES = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_SPACE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
# Bytes that are neither letters nor digits of ASCII nor part of other characters.
NOT_ALPHANUMERIC = (_BYTES < 48) | ((_BYTES > 57) & (_BYTES < 97)) | ((_BYTES > 122) & (_BYTES < 128))
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def lower_ascii(text: Column | str) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.translate(text, UPPER, LOWER_SQL)


def word_count(text: Column | str) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1024) -> Iterator[None]:
    """Jobs that are run inside send at most ``rows`` rows at a time to Python, as texts
    are long; the session's own setting is put back afterwards.
    """
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows, so that what is made of long
    texts stays small beside them.
    """
    for batch in batches:
        for start in range(0, max(batch.num_rows, 1), rows):
            yield batch.slice(start, rows)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and where each text starts; one offset more than texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    binary = texts.fill_null("").cast(pa.large_string()).cast(pa.large_binary())
    offsets = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + len(binary) + 1]
    data = binary.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(offsets) else data[:0], offsets - offsets[0]


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about ``PIECE_BYTES`` that no word crosses."""
    start, end = 0, len(data)
    while start < end:
        stop = min(start + PIECE_BYTES, end)
        while stop < end:
            space = np.flatnonzero(_SPACE[data[start:stop]])
            text = offsets[np.searchsorted(offsets, stop, "right") - 1]
            cut = max(start + space[-1] + 1 if len(space) else start, text)
            if cut > start:
                stop = int(cut)
                break
            stop = min(stop + PIECE_BYTES, end)
        yield start, stop
        start = stop


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2 ** 64."""
    found = _powers.__dict__.get("found")
    if found is None or len(found[0]) < n:
        size = max(n, PIECE_BYTES) + 1
        ones = np.ones(size, np.uint64)
        found = []
        for base in (_BASE, _INVERSE):
            steps = ones.copy()
            steps[1:] = np.uint64(base)
            found.append(np.cumprod(steps))
        _powers.found = found
    return found


def word_hashes(
    texts: pa.Array, prefixes: tuple[int, ...] = (), gaps: np.ndarray = _SPACE
) -> tuple[np.ndarray, ...]:
    """A 64-bit hash of each lower-cased word, text after text, and where each text
    starts among them (one offset more than texts). Words are equal if and, but for
    a collision of 64 bits, only if their hashes are.

    For each length in ``prefixes`` the hashes of the words' first so many bytes
    follow. ``gaps`` marks the bytes between words.
    """
    data, offsets = text_bytes(texts)
    hashes, starts = [[] for _ in range(1 + len(prefixes))], []
    for start, stop in _pieces(data, offsets):
        piece = _LOWER[data[start:stop]]
        space = gaps[piece]
        first = np.zeros(len(piece) + 1, bool)
        inside = offsets[(offsets >= start) & (offsets <= stop)] - start
        first[inside] = True
        first[0] = first[-1] = True
        word = ~space
        begins = np.flatnonzero(word & (np.concatenate(([True], space[:-1])) | first[:-1]))
        ends = np.flatnonzero(word & (np.concatenate((space[1:], [True])) | first[1:])) + 1
        power, inverse = _powers(len(piece))
        total = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * power[: len(piece)], out=total[1:])
        for k, length in enumerate((None, *prefixes)):
            after = ends if length is None else np.minimum(ends, begins + length)
            found = (total[after] - total[begins]) * inverse[begins]
            hashes[k].append(mix(found + (after - begins).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        starts.append(begins + start)
    if not starts:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64), *([np.empty(0, np.uint64)] * len(prefixes))
    words, *more = map(np.concatenate, hashes)
    return words, np.searchsorted(np.concatenate(starts), offsets).astype(np.int64), *more


def shingle_hashes(hashes: np.ndarray, bounds: np.ndarray, size: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``size`` words. A text
    with fewer words has one, of all of them; one without words has none.
    """
    factors = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    n = len(hashes)
    runs = np.zeros(max(0, n - size + 1), np.uint64)
    for k in range(size):
        runs += hashes[k : k + len(runs)] * factors[k]
    runs = mix(runs + np.uint64(size))
    found = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= size:
            own = np.sort(runs[a : b - size + 1])
            found.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif b > a:
            short = (hashes[a:b] * factors[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            found.append(mix(np.array([short])))
        else:
            found.append(runs[:0])
    return found
