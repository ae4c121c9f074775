"""Language-model scores by a weighted backoff automaton.

N-grams of the training texts are smoothed towards their shorter contexts (a Dirichlet
prior of a given strength at each order, add-one at the last) and become an automaton:
contexts are states, n-grams are arcs, and a failure arc leads from a context to its
longest proper suffix with a weight. One left-to-right traversal carries the state
through a text and adds up log-probabilities.

The model is as large as the corpus, so it is never in one place. Texts are dealt into
buckets of bounded size; each sends the n-grams that occur in it, with their training
counts, to the parts of the model, which add them up and send back the totals; from
these each bucket builds the piece of the automaton that its texts can reach. N-grams
travel as packed arrays, combined within a bucket: sorted 64-bit keys as their
differences, whole, so that two n-grams share a key only if their hashes are equal (in
``n * n / 2 ** 65`` of cases for ``n`` n-grams).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tricycle.llm.labelled import fold
from tricycle.llm.words import mix, word_hashes
from tricycle.plans import materialize

FOLDS, HELD = 7, 2
ORDER = 2
STRENGTH = 2_000.0  # by the likelihood of held-out texts
BUCKET_BYTES = 6_000_000  # of text in a bucket
RUN = 512  # words of a text that are traversed in step with other runs
END = np.uint64(0x5EED0FE2D0C5E2D1)  # the end of a text, and the context of its first word
ROW_BYTES = 32  # that a row counts beside its text, so that blank texts fill buckets, too


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words, each text closed by ``END``, and where texts start."""
    words, bounds = word_hashes(texts)
    return np.insert(words, bounds[1:], END), bounds + np.arange(len(bounds))


def _grams(tokens: np.ndarray, bounds: np.ndarray, order: int) -> list[np.ndarray]:
    """For each order from 1 a key of the n-gram that ends at each place; 0 where the
    text has too few words before it. A text begins in the context ``END``.
    """
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[bounds[:-1]] = END
    place = np.arange(len(tokens)) - np.repeat(bounds[:-1], np.diff(bounds))
    found = [tokens]
    for n in range(2, order + 1):
        shorter = found[-1]
        previous = np.empty_like(shorter)
        previous[1:] = shorter[:-1]
        previous[bounds[:-1]] = END
        longer = mix(previous * np.uint64(0x9FB21C651E98DF25) + mix(tokens + np.uint64(n)))
        longer[longer == 0] = np.uint64(1)
        longer[place < n - 2] = 0
        found.append(longer)
    return found


def _distinct(keys: np.ndarray, trained: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys (0 first, if there), counts at training places, and each
    place's index.
    """
    unique, which = np.unique(keys, return_inverse=True)
    return unique, np.bincount(which, trained, len(unique)).astype(np.int64), which


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 in as many bytes each as the largest needs; that width first."""
    values = np.ascontiguousarray(values, "<u8")
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + values.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8, offset=1).reshape(-1, data[0])
    values = np.zeros((len(raw), 8), np.uint8)
    values[:, : data[0]] = raw
    return values.view("<u8").ravel()


def _packed_keys(keys: np.ndarray, part: int, bits: int) -> bytes:
    """Sorted keys of one part, the range of all that begin with its ``bits``, as differences."""
    return _packed(np.diff(keys, prepend=np.uint64(part << (64 - bits))))


def _unpacked_keys(data: bytes, part: int, bits: int) -> np.ndarray:
    return np.uint64(part << (64 - bits)) + np.cumsum(_unpacked(data), dtype=np.uint64)


class Automaton:
    """The part of the model that some texts can reach.

    ``keys``, ``counts`` and ``which`` have for each order the distinct n-grams, their
    training counts and each place's index; ``total`` and ``kinds`` are the training
    tokens and distinct ones. State 0 is the empty context.
    """

    def __init__(self, keys, counts, which, bounds, total: int, kinds: int, strength: float):
        order = len(keys)
        self.width = len(keys[0])
        unigram = (counts[0] + 1) / (total + kinds + 1)
        self.root = np.log10(unigram)
        first = [np.zeros(0, np.int64)] * order  # a place of each n-gram
        for n in range(order):
            first[n] = np.full(len(keys[n]), -1)
            first[n][which[n][::-1]] = np.arange(len(which[n]))[::-1]
        is_start = np.zeros(len(which[0]), bool)
        is_start[bounds[:-1]] = True
        end = int(np.searchsorted(keys[0], END))
        # States: 0, then every n-gram below the order that training texts have.
        self.state = []
        size = 1
        for n in range(order - 1):
            known = (counts[n] > 0) & (keys[n] != 0)
            self.state.append(np.where(known, size + np.cumsum(known) - 1, 0))
            size += int(known.sum())
        self.failure, self.weight = np.zeros(size, np.int64), np.zeros(size)
        for n in range(order - 1):
            known = self.state[n] > 0
            own, at = self.state[n][known], first[n][known]
            self.weight[own] = np.log10(strength / (counts[n][known] + strength))
            self.failure[own] = self.state[n - 1][which[n - 1][at]] if n else 0
        # Where a word without its own n-gram leads from state 0.
        self.entered = self.state[0] if self.state else np.zeros(self.width, np.int64)
        self.start = self.entered[end]
        arcs, values, targets = [], [], []
        shorter = unigram
        for n in range(1, order):
            probability = np.zeros(len(keys[n]))
            known = (counts[n] > 0) & (keys[n] != 0)
            at = first[n][known]
            word = which[0][at]
            # The context is the (n)-gram before; at a text's start that is the end.
            starts = is_start[at]
            context = np.where(starts, end, which[n - 1][at - 1]) if n == 1 else which[n - 1][at - 1]
            suffix = which[n - 1][at]
            probability[known] = (counts[n][known] + strength * shorter[suffix]) / (counts[n - 1][context] + strength)
            target = self.state[n][known.nonzero()[0]] if n < order - 1 else self.state[n - 1][suffix]
            arcs.append(self.state[n - 1][context] * self.width + word)
            values.append(np.log10(probability[known]))
            targets.append(target)
            shorter = probability
        arcs = np.concatenate(arcs) if arcs else np.empty(0, np.int64)
        sort = np.argsort(arcs, kind="stable")
        self.arcs = arcs[sort]
        self.values = (np.concatenate(values) if values else np.empty(0))[sort]
        self.targets = (np.concatenate(targets) if targets else np.empty(0, np.int64))[sort]

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states and log10 probabilities when texts in ``state`` read ``word``."""
        value, after = np.zeros(len(state)), np.zeros(len(state), np.int64)
        pending, at = np.arange(len(state)), state
        while len(pending):
            arc = at * self.width + word[pending]
            found = np.minimum(np.searchsorted(self.arcs, arc), max(len(self.arcs) - 1, 0))
            hit = (self.arcs[found] == arc) if len(self.arcs) else np.zeros(len(arc), bool)
            hit &= at > 0
            value[pending[hit]] += self.values[found[hit]]
            after[pending[hit]] = self.targets[found[hit]]
            last = ~hit & (at == 0)
            value[pending[last]] += self.root[word[pending[last]]]
            after[pending[last]] = self.entered[word[pending[last]]]
            fails = ~hit & (at > 0)
            value[pending[fails]] += self.weight[at[fails]]
            pending, at = pending[fails], self.failure[at[fails]]
        return after, value

    def traverse(self, words: np.ndarray, bounds: np.ndarray, warm: int) -> np.ndarray:
        """The log10 probability of each text. Long texts are cut into runs of ``RUN``
        words; a run first reads the ``warm`` words before it, unscored, and is then in
        the state of a traversal from the start.
        """
        sizes = np.diff(bounds)
        runs = -(-sizes // RUN)
        text = np.repeat(np.arange(len(sizes)), runs)
        number = np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs)
        begin = bounds[text] + number * RUN
        length = np.minimum(RUN, bounds[text + 1] - begin)
        state = np.where(number == 0, self.start, 0)
        for back in range(warm, 0, -1):
            on = np.flatnonzero(number > 0)
            state[on], _ = self.step(state[on], words[begin[on] - back])
        order = np.argsort(-length, kind="stable")
        begin, state = begin[order], state[order]
        left = np.searchsorted(-length[order], -np.arange(RUN), "left")  # runs longer than k
        score = np.zeros(len(order))
        for k in range(int(length.max()) if len(length) else 0):
            state, value = self.step(state[: left[k]], words[begin[: left[k]] + k])
            score[: left[k]] += value
        return np.bincount(text[order], score, len(sizes))


def language_scores(
    docs: DataFrame,
    held_out,
    order: int = ORDER,
    strength: float = STRENGTH,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of each row.

    The model learns from the rows where the condition ``held_out`` does not hold.
    ``score`` is its log10 probability of the whole text with its end, ``base_score``
    that of add-one single words; ``n_known`` tokens occur in training,
    ``train_tokens`` is their number there.

    Null, empty and blank texts have one token, the end. Repeated rows count as often
    in training and are scored alike; a null doc_id is a row like others, and counts as
    its condition says (null: it does not hold). Other columns are ignored; an empty
    table gives an empty result, and without training rows every token is unknown.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    size = rows.agg(F.sum(F.octet_length("text") + F.lit(ROW_BYTES))).first()[0] or 0
    buckets = 1 + size // bucket_bytes
    bits = max(1, int(np.ceil(np.log2(buckets))))  # parts of the model: a power of two
    rows = rows.withColumn("bucket", F.expr(f"int(pmod(xxhash64(doc_id, text), {buckets}))"))

    def read(table: pa.Table):
        tokens, bounds = _tokens(table.column("text").combine_chunks())
        held = table.column("held_out").to_numpy()
        trained = np.repeat(~held, np.diff(bounds)).astype(np.float64)
        return tokens, bounds, held, [_distinct(g, trained) for g in _grams(tokens, bounds, order)]

    def part_bounds(keys: np.ndarray) -> np.ndarray:
        return np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        *_, grams = read(table)
        out = {"part": [], "bucket": [], "n": [], "keys": [], "counts": []}
        for n, (keys, counts, _) in enumerate(grams):
            cuts = part_bounds(keys)
            for part in np.flatnonzero(np.diff(cuts)):
                own = slice(cuts[part], cuts[part + 1])
                out["part"].append(int(part))
                out["bucket"].append(key[0].as_py())
                out["n"].append(n)
                out["keys"].append(_packed_keys(keys[own], int(part), bits))
                out["counts"].append(_packed(counts[own]))
        return pa.table(out, schema=asked)

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        out = {"bucket": [], "n": [], "part": [], "totals": [], "tokens": [], "kinds": []}
        orders = table.column("n").to_numpy()
        for n in np.unique(orders):
            own = table.filter(pa.array(orders == n))
            keys = [_unpacked_keys(k, key[0].as_py(), bits) for k in own.column("keys").to_pylist()]
            counts = [_unpacked(c) for c in own.column("counts").to_pylist()]
            unique, which = np.unique(np.concatenate(keys), return_inverse=True)
            totals = np.bincount(which, np.concatenate(counts), len(unique)).astype(np.int64)
            cut = np.cumsum([0, *map(len, keys)])
            for k, bucket in enumerate(own.column("bucket").to_pylist()):
                out["bucket"].append(bucket)
                out["n"].append(int(n))
                out["part"].append(key[0].as_py())
                out["totals"].append(_packed(totals[which[cut[k] : cut[k + 1]]]))
                # Once for each part and order: what it has in training.
                out["tokens"].append(int(totals.sum()) if k == 0 and n == 0 else 0)
                out["kinds"].append(int((totals > 0).sum()) if k == 0 and n == 0 else 0)
        return pa.table(out, schema=answered)

    asked = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
    answered = pa.schema(
        [("bucket", pa.int32()), ("n", pa.int32()), ("part", pa.int32()), ("totals", pa.binary()), ("tokens", pa.int64()), ("kinds", pa.int64())]
    )
    requests = rows.groupBy("bucket").applyInArrow(ask, "part int, bucket int, n int, keys binary, counts binary")
    replies = requests.groupBy("part").applyInArrow(
        answer, "bucket int, n int, part int, totals binary, tokens long, kinds long"
    )
    replies = materialize(replies, "totals")
    total, kinds = replies.agg(F.sum("tokens"), F.sum("kinds")).first()
    total, kinds = total or 0, kinds or 0

    def score(key: tuple, table: pa.Table, totals: pa.Table) -> pa.Table:
        tokens, bounds, held, grams = read(table)
        totals = totals.sort_by([("n", "ascending"), ("part", "ascending")])
        orders = totals.column("n").to_numpy()
        counts = []
        for n in range(order):
            own = totals.column("totals").filter(pa.array(orders == n)).to_pylist()
            counts.append(np.concatenate([_unpacked(t) for t in own]).astype(np.int64))
        keys, which = [g[0] for g in grams], [g[2] for g in grams]
        automaton = Automaton(keys, counts, which, bounds, total, kinds, strength)
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        known = np.bincount(text, counts[0][which[0]] > 0, len(bounds) - 1)
        base = np.bincount(text, automaton.root[which[0]], len(bounds) - 1)
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "held_out": pa.array(held),
                "n_tokens": pa.array(np.diff(bounds)),
                "n_known": pa.array(known.astype(np.int64)),
                "train_tokens": pa.array(np.full(len(held), total, np.int64)),
                "base_score": pa.array(base),
                "score": pa.array(automaton.traverse(which[0], bounds, order - 1)),
            }
        )

    return (
        rows.groupBy("bucket")
        .cogroup(replies.select("bucket", "n", "part", "totals").groupBy("bucket"))
        .applyInArrow(
            score,
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        )
    )


def held_out(doc_id: str = "doc_id"):
    return fold(doc_id, FOLDS) == HELD
