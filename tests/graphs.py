"""Small graphs with known answers, and brute force over edge lists."""

from __future__ import annotations

import random
from collections import Counter

FOLLOWERS24 = [
    (1, 11553), (1, 8762940), (1, 25), (1, 8762941), (1, 688136), (1, 8762942), (3, 718952), (3, 3109655),
    (3, 562897), (3, 6), (3, 7), (3, 12852), (2, 25), (3, 90259), (3, 8762941), (3, 645510), (3, 427258),
    (3, 45567), (3, 1374301), (3, 38253), (3, 79994), (3, 16), (95, 25), (3, 25),
]
TRI10 = [(1, 2), (2, 3), (4, 2), (2, 4), (3, 1), (2, 5), (5, 9), (9, 2), (3, 6), (6, 2)]
TRI10_ENDS = [
    (2, 3), (3, 1), (3, 6), (3, 9), (3, 4), (4, 1), (4, 6), (4, 9), (5, 1), (5, 6), (5, 9), (5, 4),
    (1, 2), (6, 2), (9, 2), (2, 3), (2, 5),
]
TRI7 = [(1, 2), (2, 3), (4, 8), (3, 5), (2, 4), (3, 1), (9, 8)]
TRI8 = [(1, 2), (2, 5), (5, 9), (2, 3), (3, 1), (2, 1), (9, 11), (11, 5)]
DUP = [(1, 2), (1, 2), (2, 3), (3, 1)]
LOOP_PAIR = [(1, 2), (2, 1), (1, 1)]
LOOP_ONLY = [(1, 1)]

# graph: two-paths, then (closed paths, triangles) per semantics
KNOWN = {
    "followers24": (FOLLOWERS24, {"bag": (0, 0), "semi": (0, 0), "walk": (0, 0), "cycle": (0, 0)}),
    "tri10": (TRI10, {"bag": (9, 3), "semi": (9, 3), "walk": (9, 3), "cycle": (9, 3)}),
    "tri7": (TRI7, {"bag": (3, 1), "semi": (3, 1), "walk": (3, 1), "cycle": (3, 1)}),
    "tri8": (TRI8, {"bag": (6, 2), "semi": (6, 2), "walk": (6, 2), "cycle": (6, 2)}),
    "dup": (DUP, {"bag": (6, 2), "semi": (5, 1), "walk": (5, 1), "cycle": (3, 1)}),
    "loop_pair": (LOOP_PAIR, {"bag": (2, 0), "semi": (2, 0), "walk": (4, 1), "cycle": (0, 0)}),
    "loop_only": (LOOP_ONLY, {"bag": (0, 0), "semi": (0, 0), "walk": (1, 0), "cycle": (0, 0)}),
    "empty": ([], {"bag": (0, 0), "semi": (0, 0), "walk": (0, 0), "cycle": (0, 0)}),
}


def random_edges(seed: int, nodes: int = 9, edges: int = 45) -> list[tuple[int, int]]:
    """Duplicates and self-loops likely; node 0 touches about a third of the edges."""
    rng = random.Random(seed)

    def node():
        return 0 if rng.random() < 0.2 else rng.randrange(nodes)

    return [(node(), node()) for _ in range(edges)]


def paths(edges, keep_degenerate=False) -> Counter:
    return Counter(
        (x, y, z) for x, y in edges for y2, z in edges if y2 == y and (keep_degenerate or x != z)
    )


def closed(edges, semantics) -> Counter:
    times = Counter(edges)
    found = Counter()
    for (x, y, z), n in paths(edges, keep_degenerate=semantics == "walk").items():
        closing = times[(z, x)] if semantics == "bag" else min(times[(z, x)], 1)
        if closing:
            found[(x, y, z)] = n * closing
    return found


def cycles(edges) -> Counter:
    links = {(a, b) for a, b in edges if a != b}
    return Counter(
        (x, y, z) for x, y in links for y2, z in links if y2 == y and (z, x) in links and x < y and x < z
    )


def bag(df) -> Counter:
    return Counter(tuple(row) for row in df.collect())
