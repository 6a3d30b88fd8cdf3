"""Crossing edges by the sweep against all pairs, and on a long ring."""

import time
from fractions import Fraction

import numpy as np

from gridloom.operators import validity as V


def plain(ring):
    n = len(ring) - 1
    seg = [(ring[k], ring[k + 1]) for k in range(n)]

    def orient(a, b, c):
        v = (Fraction(b[0]) - a[0]) * (Fraction(c[1]) - a[1]) - (Fraction(b[1]) - a[1]) * (Fraction(c[0]) - a[0])
        return (v > 0) - (v < 0)

    def on(a, b, c):
        return min(a[0], b[0]) <= c[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= c[1] <= max(a[1], b[1])

    for i in range(n):
        for j in range(i + 2, n):
            if i == 0 and j == n - 1:
                continue
            (a, b), (c, d) = seg[i], seg[j]
            o = orient(a, b, c), orient(a, b, d), orient(c, d, a), orient(c, d, b)
            if (o[0] != o[1] and o[2] != o[3]) or (o[0] == 0 and on(a, b, c)) or (o[1] == 0 and on(a, b, d)) or (o[2] == 0 and on(c, d, a)) or (o[3] == 0 and on(c, d, b)):
                yield i, j


def swept(rings):
    start = np.concatenate([[0], np.cumsum([len(r) for r in rings])])
    x, y = (np.array([p[k] for r in rings for p in r], float) for k in (0, 1))
    return sorted((int(r), int(i), int(j)) for got in V.sweep_crossings(x, y, start) for r, i, j in zip(*got, strict=True))


def test_against_all_pairs(monkeypatch):
    r = np.random.default_rng(6)
    rings = [[], [(0, 0)], [(0, 0), (1, 1)]]
    for size, width in ((5, 4), (30, 6), (80, 100), (150, 12)):
        for _ in range(6):
            pts = [tuple(p) for p in r.integers(0, width, (size, 2)).tolist()]
            rings.append(pts + pts[:1])
    want = sorted((k, i, j) for k, ring in enumerate(rings) for i, j in plain(ring))
    assert len(want) > 1000
    for few, run in ((64, 1 << 20), (3, 7)):
        monkeypatch.setattr(V, "FEW", few)
        monkeypatch.setattr(V, "RUN", run)
        assert swept(rings) == want


def test_a_million_short_edges_and_a_long_one():
    n = 1_000_000
    x, y = np.append(np.arange(n, dtype=float), 0.0), np.append(np.arange(n) % 2 + 1.0, 1.0)
    y[n // 2] = -3.0  # dips through the closing edge
    y[n - 1] = 0.0
    x, y = np.append(np.delete(x, n), x[0]), np.append(np.delete(y, n), y[0])
    began = time.process_time()
    found = [(int(i), int(j)) for got in V.sweep_crossings(x, y, np.array([0, len(x)])) for _, i, j in zip(*got, strict=True)]
    assert sorted(found) == [(n // 2 - 1, n - 1), (n // 2, n - 1)] and time.process_time() - began < 60
