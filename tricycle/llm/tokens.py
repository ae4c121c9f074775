"""Token counts of a byte-level BPE, by finite-state transducers.

Two transducers replace the library's encoder. The first splits a text into pieces
(words with their leading space, numbers, marks, white space, contractions): it reads
character classes, and its transitions say where pieces start. A batch of texts is cut
into chunks of characters; for each chunk the map from entry to exit state is found for
all states at once, the maps are composed by a parallel prefix scan, and a second pass
from the now known entry states emits the starts.

The second counts the tokens of a piece. It reads bytes, each transition is annotated
with the change of the token count, and it is determinised as it is needed: a state
holds, for each unfinished token, its place in the vocabulary's trie, the last token
before it and how many tokens follow. The last token of a prefix is the one that ends
there and stays apart from the token before it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tricycle.llm.words import _powers, mix

LIMIT = 512
CHUNK = 64  # characters of a chunk
PIECE_CHARS = 1 << 19  # handled at a time
STATES = 150_000  # of the counting transducer that are kept; beyond it starts anew
PIECES = 300_000  # whose counts are kept between texts, likewise

# Character classes.
SPACE, BLANK, LETTER, SHORT, R, V, L, E, NUMBER, MARK, QUOTE, END = range(12)
# States of the splitter: a piece has ended; in letters, numbers, marks; white space of
# one character (a space or another) or more (ending in a space or another); a quote
# that may begin a contraction, and it with r, v or l.
ENDED, LETTERS, NUMBERS, MARKS, ONE_SPACE, ONE_BLANK, SPACES, BLANKS, QUOTED, QUOTED_R, QUOTED_V, QUOTED_L = range(12)
_STARTS, _STARTED_BEFORE = 1, 2  # output: a piece starts here; at the character before


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and output for each state and class (12 by 12)."""
    after, output = np.zeros((12, 12), np.uint8), np.zeros((12, 12), np.uint8)
    fresh = {
        SPACE: ONE_SPACE, BLANK: ONE_BLANK, NUMBER: NUMBERS, MARK: MARKS, QUOTE: QUOTED, END: ENDED,
        **dict.fromkeys((LETTER, SHORT, R, V, L, E), LETTERS),
    }
    letters = (LETTER, SHORT, R, V, L, E)

    def put(state: int, kind: int, target: int, out: int) -> None:
        after[state, kind], output[state, kind] = target, out

    for state in range(12):
        for kind, target in fresh.items():
            put(state, kind, target, _STARTS)
    for kind in letters:
        put(LETTERS, kind, LETTERS, 0)
    put(NUMBERS, NUMBER, NUMBERS, 0)
    for kind in (MARK, QUOTE):
        put(MARKS, kind, MARKS, 0)
        put(QUOTED, kind, MARKS, 0)
    for state in (ONE_SPACE, ONE_BLANK, SPACES, BLANKS):
        put(state, SPACE, SPACES, 0)
        put(state, BLANK, BLANKS, 0)
        # The last white space before another character is apart from those before
        # it; a space joins what follows, unless the text ends.
        for kind, target in fresh.items():
            if kind not in (SPACE, BLANK, END):
                joins = state in (ONE_SPACE, SPACES)
                target = MARKS if joins and kind == QUOTE else target
                many = _STARTED_BEFORE if state in (SPACES, BLANKS) else 0
                put(state, kind, target, many | (0 if joins else _STARTS))
    put(QUOTED, SHORT, ENDED, 0)
    for kind, state, last in ((R, QUOTED_R, E), (V, QUOTED_V, E), (L, QUOTED_L, L)):
        put(QUOTED, kind, state, 0)
        for other in range(12):  # no contraction: the letter began a piece
            put(state, other, after[LETTERS, other], output[LETTERS, other] | _STARTED_BEFORE)
        put(state, last, ENDED, 0)
    return after, output


def class_table() -> np.ndarray:
    """The class of each code point."""
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    table = np.full(0x110000, MARK, np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", BLANK)):
        found = "".join(regex.findall(pattern, points))
        table[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    for kind, own in ((SPACE, " "), (SHORT, "stmd"), (R, "r"), (V, "v"), (L, "l"), (E, "e"), (QUOTE, "'")):
        table[[ord(c) for c in own]] = kind
    return table


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary: printable ones for
    themselves, the others follow from code point 256 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class CountingTransducer:
    """Counts the BPE tokens of byte strings."""

    def __init__(self, merges: list[tuple[bytes, bytes]], limit: int = STATES):
        self.limit = limit
        self.tokens = [bytes([b]) for b in range(256)]
        number = {t: k for k, t in enumerate(self.tokens)}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            merged = number.setdefault(a + b, len(self.tokens))
            if merged == len(self.tokens):
                self.tokens.append(a + b)
            self.merges[number[a], number[b]] = (rank, merged)
        # The trie: (node, byte) to node; the token that ends at a node; inner nodes.
        self.child: dict[int, int] = {}
        self.ends: list[int] = [-1]
        self.inner: list[bool] = [True]
        for k, token in enumerate(self.tokens):
            if self.encode(token) != [k]:
                continue  # merges never make it
            node = 0
            for b in token:
                key = node << 8 | b
                if key not in self.child:
                    self.inner[node] = True
                    self.child[key] = len(self.ends)
                    self.ends.append(-1)
                    self.inner.append(False)
                node = self.child[key]
            self.ends[node] = k
        self.apart: dict[tuple[int, int], bool] = {}
        self.reset()

    def reset(self) -> None:
        """Only the initial state: before any byte, with no token before."""
        start = ((0, -1, 0),)
        self.states: list[tuple] = [start]
        self.numbers = {start: 0}
        self.steps: dict[int, int] = {}  # state and byte to next state and count + 128

    def encode(self, text: bytes) -> list[int]:
        """Tokens by applying the merges in order of rank, leftmost first."""
        parts = list(text)
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda k: self.merges.get((parts[k], parts[k + 1]), (1 << 60,))[0])
            merge = self.merges.get((parts[best], parts[best + 1]))
            if merge is None:
                break
            parts[best : best + 2] = [merge[1]]
        return parts

    def stay_apart(self, one: int, two: int) -> bool:
        """Whether both tokens are left as they are when they meet."""
        found = self.apart.get((one, two))
        if found is None:
            if len(self.apart) >= 4 * self.limit:
                self.apart.clear()
            found = self.encode(self.tokens[one] + self.tokens[two]) == [one, two]
            self.apart[one, two] = found
        return found

    def step(self, state: int, byte: int) -> int:
        """Determinise one transition."""
        live, last, change = [], -1, 0
        for node, before, behind in self.states[state]:
            node = self.child.get(node << 8 | byte, -1)
            if node < 0:
                continue
            live.append((node, before, behind))
            token = self.ends[node]
            if token >= 0 and last < 0 and (before < 0 or self.stay_apart(before, token)):
                last, change = token, 1 - behind
        reached = (
            *((node, before, behind + change) for node, before, behind in live if self.inner[node]),
            (0, last, 0),
        )
        number = self.numbers.get(reached)
        if number is None:
            number = self.numbers[reached] = len(self.states)
            self.states.append(reached)
        packed = number << 8 | (change + 128)
        self.steps[state << 8 | byte] = packed
        return packed

    def count(self, piece: bytes) -> int:
        if len(self.states) > self.limit:
            self.reset()
        state, total, steps = 0, 0, self.steps
        for byte in piece:
            packed = steps.get(state << 8 | byte)
            if packed is None:
                packed = self.step(state, byte)
            state, total = packed >> 8, total + (packed & 255) - 128
        return total


class TokenCounter:
    """Both transducers for the text of a ``tokenizers`` file and a class table."""

    def __init__(self, file: str, classes: np.ndarray):
        content = json.loads(file)
        letters = byte_letters()
        to_bytes = lambda text: bytes(letters[c] for c in text)
        merges = [m.split(" ") if isinstance(m, str) else m for m in content["model"]["merges"]]
        self.counting = CountingTransducer([(to_bytes(a), to_bytes(b)) for a, b in merges])
        self.special = [t["content"] for t in content.get("added_tokens", []) if t["special"]]
        self.classes = classes
        self.known: dict[int, int] = {}  # hashes of pieces to their tokens
        self.after, self.output = splitter()

    def piece_starts(self, kinds: np.ndarray) -> np.ndarray:
        """Whether a piece starts at each character of a stream of classes that begins
        and ends apart from others.
        """
        n = len(kinds)
        chunks = max(1, -(-n // CHUNK))
        padded = np.full(chunks * CHUNK, END, np.uint8)
        padded[:n] = kinds
        table = padded.reshape(chunks, CHUNK).T.astype(np.intp)  # one row a step
        flat_after, flat_output = self.after.ravel(), self.output.ravel()
        # All entry states at once, step by step.
        states = np.tile(np.arange(12, dtype=np.uint8)[:, None], (1, chunks))
        for kind in table:
            states = flat_after[states * np.intp(12) + kind]
        # Composition of the chunks' maps by doubling: maps[:, k] is that of chunks 0 to k.
        maps, width = states, 1
        while width < chunks:
            maps = maps.copy()
            maps[:, width:] = np.take_along_axis(maps[:, width:], maps[:, :-width].astype(np.intp), axis=0)
            width *= 2
        state = np.concatenate(([ENDED], maps[ENDED, :-1])).astype(np.uint8)
        out = np.empty((CHUNK, chunks), np.uint8)
        for k, kind in enumerate(table):
            at = state * np.intp(12) + kind
            out[k] = flat_output[at]
            state = flat_after[at]
        out = out.T.ravel()[:n]
        starts = (out & _STARTS) > 0
        starts[:-1] |= (out[1:] & _STARTED_BEFORE) > 0
        return starts & (kinds != END)

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text; special tokens in it count one each."""
        found = np.zeros(len(texts), np.int64)
        segments, owners = [], []
        for k, text in enumerate(texts):
            parts = [text]
            for special in self.special:
                if special in text:
                    parts = [p for part in parts for p in part.split(special)]
            found[k] = len(parts) - 1
            segments += parts
            owners += [k] * len(parts)
        begin = 0
        while begin < len(segments):
            end, size = begin, 0
            while end < len(segments) and (end == begin or size + len(segments[end]) <= PIECE_CHARS):
                size += len(segments[end])
                end += 1
            np.add.at(found, np.array(owners[begin:end]), self._segment_counts(segments[begin:end]))
            begin = end
        return found

    def _segment_counts(self, segments: list[str]) -> np.ndarray:
        # A line feed behind each segment keeps places; it is read as the end.
        data = np.frombuffer("\n".join([*segments, ""]).encode(), np.uint8)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        first = data[lead].astype(np.uint32)
        point = first.copy()
        for size, low, mask in ((2, 0xC0, 0x1F), (3, 0xE0, 0x0F), (4, 0xF0, 0x07)):
            at = np.flatnonzero((first >= low) & (first < (0xE0, 0xF0, 0x100)[size - 2]))
            if len(at):
                value = first[at] & mask
                for k in range(1, size):
                    value = value << 6 | (data[lead[at] + k] & 0x3F)
                point[at] = value
        kinds = self.classes[point]
        ends = np.cumsum([len(s) + 1 for s in segments]) - 1
        kinds[ends] = END
        starts = np.flatnonzero(self.piece_starts(kinds))
        if not len(starts):
            return np.zeros(len(segments), np.int64)
        begins = lead[starts]
        # A piece ends where the next starts or its segment ends.
        segment = np.searchsorted(ends, starts)
        stops = np.minimum(np.append(begins[1:], len(data)), lead[ends[segment]])
        power, inverse = _powers(len(data))
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=total[1:])
        hashes = mix((total[stops] - total[begins]) * inverse[begins] + (stops - begins).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        unique, place, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > PIECES:
            self.known.clear()
        raw, count, known = data.tobytes(), self.counting.count, self.known
        each = np.empty(len(place), np.int64)
        for k, (key, a, b) in enumerate(zip(unique.tolist(), begins[place].tolist(), stops[place].tolist(), strict=True)):
            found = known.get(key)
            if found is None:
                found = known[key] = count(raw[a:b])
            each[k] = found
        return np.bincount(segment, each[which], len(segments)).astype(np.int64)


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of each row: UTF-8 bytes and tokens of
    the whole text under the byte-level BPE in the ``tokenizers`` file ``path``, which
    the driver reads. A special token in a text counts as one, and none are added.

    Null and empty texts have 0 of either. Repeated rows and null ids are rows like
    others; other columns are ignored.
    """
    with open(path, encoding="utf-8") as file:
        # Workers keep what they make of it in the same dictionary.
        known = {"file": file.read(), "classes": class_table()}
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        if "counter" not in known:
            known["counter"] = TokenCounter(known["file"], known["classes"])
        counter = known["counter"]
        for batch in batches:
            texts = batch.column("text").fill_null("")
            sizes = texts.cast(pa.binary())
            n_bytes = np.diff(np.frombuffer(sizes.buffers()[1], np.int32)[sizes.offset : sizes.offset + len(sizes) + 1])
            found = [counter.counts(texts.slice(k, 1024).to_pylist()) for k in range(0, len(texts), 1024)]
            found = np.concatenate(found) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_bytes.astype(np.int64)), pa.array(found)], ["doc_id", "n_bytes", "n_tokens"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
