"""Regions and families a little larger than a task takes: any two of their pieces are a block, in one pass."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewgrove.llm import near_dedup


def copies(family, members, changed, rng):
    """Texts of 100 words of which ``changed`` are replaced."""
    texts = []
    for member in range(members):
        own = [f"f{family}w{i}" for i in range(100)]
        for i in rng.sample(range(100), changed):
            own[i] = f"u{family}-{member}-{i}"
        texts.append(" ".join(own))
    return texts


def groups(texts):
    sets = [set(text.split()) for text in texts]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize(("members", "is_few"), [((7, 3, 8), True), ((7, 24, 2), False)])
def test_groups_and_written_tables(spark, monkeypatch, members, is_few):
    """Groups are those of brute force; the tables of further passes are written for what has many pieces only."""
    monkeypatch.setattr(near_dedup, "REGION", 4)
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    monkeypatch.setattr(near_dedup, "HUBS", 1)
    written, stage = [], near_dedup.stage
    monkeypatch.setattr(near_dedup, "stage", lambda df, name: written.append(name) or stage(df, name))
    rng = random.Random(3)
    # With eleven words changed most pairs of a family are a little under the threshold.
    texts = [text for k, n in enumerate(members) for text in copies(k, n, (2, 11, 5)[k], rng)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(rows, 1, 80).collect()}
    assert found == dict(enumerate(groups(texts)))
    assert is_few != bool({"crowded-regions", "deeper-regions", "to-meet", "remaining-blocks"} & {*written})


@pytest.mark.parametrize("load", [0.2, 1.0, 1.3, 1.9, 2.0])
def test_any_two_of_a_unit_meet(spark, load):
    rows = spark.createDataFrame([(unit, 100 * unit + i) for unit in range(2) for i in range(40)], "unit long, rep long")
    blocks = {}
    for r in near_dedup.paired(rows, "unit", F.lit(load)).collect():
        blocks.setdefault(r.block, []).append((r.rep, r.side))
    met = Counter()
    for own in blocks.values():
        assert len(own) == len({rep for rep, _ in own}) and len({rep // 100 for rep, _ in own}) == 1
        met.update((min(a, b), max(a, b)) for k, (a, i) in enumerate(own) for b, j in own[:k] if i == 0 or i != j)
    assert met == Counter({(100 * unit + i, 100 * unit + j): 1 for unit in range(2) for j in range(40) for i in range(j)})
    assert max(Counter(rep for own in blocks.values() for rep, _ in own).values()) <= near_dedup.ORDERS


def test_agreement_is_the_share_of_equal_values():
    rng = np.random.default_rng(1)
    many = rng.integers(0, 3, (50, near_dedup.HASHES), np.uint8)
    many[7] = many[0]
    assert near_dedup.agreement(many[0], many).tolist() == (many == many[0]).mean(axis=1).tolist()
    assert near_dedup.agreement(many[0], many[:0]).tolist() == []
