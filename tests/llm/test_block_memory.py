"""Memory and links of a block of near copies in one worker."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np

from reviewgrove.llm import near_dedup


def block(n, size, changed, seed=5):
    """Classes ``rep, sketch, group, side, shingles``: copies of one set, each with some members of its own."""
    rng = random.Random(seed)
    factors = near_dedup.multipliers()
    base = [rng.getrandbits(64) for _ in range(size)]
    rows = []
    for rep in range(n):
        own = np.unique(np.array([rng.getrandbits(64) if rng.random() < changed else h for h in base], np.uint64))
        sketch = near_dedup.mixed(near_dedup.signature(own, factors)).astype(np.uint8).tobytes()
        rows.append((rep, sketch, rep, 0, own.astype("<u8").tobytes()))
    return rows


def groups(n, edges):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_memory_of_a_block_of_near_copies():
    rows = block(700, 200, 0.03)
    near_dedup.confirm(rows[:3], 80)
    tracemalloc.start()
    try:
        links = near_dedup.confirm(rows, 80)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert groups(700, links) == [0] * 700
    # 244,650 pairs.
    assert peak < 48 * 244_650


def test_links_of_a_block_are_those_of_brute_force(monkeypatch):
    monkeypatch.setattr(near_dedup, "PAIRS_AT_ONCE", 7)
    for changed in (0.03, 0.09, 0.105, 0.12, 0.3):
        rows = [*block(60, 80, changed), *[(rep + 60, *row[1:2], rep + 60, 0, row[4]) for rep, row in enumerate(block(20, 150, changed, 6))]]
        sets = [set(np.frombuffer(row[4], "<u8").tolist()) for row in rows]
        similar = [(i, j) for i in range(80) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
        assert groups(80, near_dedup.confirm(rows, 80)) == groups(80, similar)
