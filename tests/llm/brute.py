"""Plain Python versions of the operators, for small tables."""

import collections
import math
import re


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def words_as_written(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def shingles(text, size=5):
    w = words(text)
    if len(w) >= size:
        return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)}
    return {tuple(w)} if w else set()


def components(rows, percent=75):
    """Component of each (doc_id, text); ids repeat for one document."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[k + 1 :]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return {i: root(i) for i in parent}


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def contaminated(text, items, size=10):
    """Hit word places and items."""
    found, names, w = set(), set(), bench_words(text)
    for item, content in items:
        b = bench_words(content)
        n = min(size, len(b))
        windows = {tuple(b[k : k + n]) for k in range(len(b) - n + 1)} if n else set()
        for k in range(len(w) - n + 1):
            if tuple(w[k : k + n]) in windows:
                found.update(range(k, k + n))
                names.add(str(item))
    return found, sorted(names - {"None"})


class Model:
    """Dirichlet-smoothed n-grams of the training texts."""

    def __init__(self, texts, order, strength):
        self.order, self.strength = order, strength
        self.counts = [collections.Counter() for _ in range(order)]
        for text in texts:
            w = ["<end>", *words(text), "<end>"]
            self.counts[0].update(w[1:])
            for n in range(2, order + 1):
                self.counts[n - 1].update(tuple(w[k : k + n]) for k in range(len(w) - n + 1))
        self.total, self.kinds = sum(self.counts[0].values()), len(self.counts[0])

    def probability(self, context, word):
        if not context:
            return (self.counts[0][word] + 1) / (self.total + self.kinds + 1)
        seen = self.counts[0][context[0]] if len(context) == 1 else self.counts[len(context) - 1][context]
        less = self.probability(context[1:], word)
        if not seen:
            return less
        return (self.counts[len(context)][(*context, word)] + self.strength * less) / (seen + self.strength)

    def score(self, text):
        w = ["<end>", *words(text), "<end>"]
        parts = (self.probability(tuple(w[max(0, k - self.order + 1) : k]), w[k]) for k in range(1, len(w)))
        return sum(map(math.log10, parts))

    def base(self, text):
        return sum(math.log10(self.probability((), w)) for w in [*words(text), "<end>"])
