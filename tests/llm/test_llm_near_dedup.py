from __future__ import annotations

import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from helpers import documents, prose
from pyspark.sql import functions as F

from loadledger.llm import near_dedup
from loadledger.llm.components import components


def shingles(text, length):
    words = [w.decode() for w in near_dedup.words_of(text)]
    if not words:
        return frozenset()
    if len(words) < length:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[n : n + length]) for n in range(len(words) - length + 1))


def brute(docs, length, percent):
    """doc_id -> (set size, least doc_id reachable)"""
    sets = {i: shingles(t, length) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * len(sets[a] | sets[b]):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: (len(s), find(i)) for i, s in sets.items()}


def edited(text, rng, times):
    words = text.split()
    for _ in range(times):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def corpus():
    rng = random.Random(4)
    texts = []
    for n in range(12):
        base = prose(n, rng.randint(40, 200))
        texts.append(base)
        texts += [edited(base, rng, k) for k in (1, 2, 3, 4, 6, 9)]
    # a large group in which copies of copies drift apart, exact copies, and shared passages
    text = prose(99, 150)
    for _ in range(60):
        texts.append(text)
        text = edited(text, rng, 2)
    texts += [texts[3].upper()] * 5 + ["  " + texts[3] + "\n"] * 5
    shared = prose(500, 60)
    texts += [f"{shared} {prose(600 + n, 15)}" for n in range(40)]
    texts += [None, "", " \t\n", "one", "ONE", "one two", "one  two", "\xa0", prose(700, 30_000)]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("length", "percent"), [(3, 85), (5, 80)])
def test_equals_brute_force(spark, length, percent):
    docs = corpus()
    found = near_dedup.near_copies(documents(spark, docs), length, percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute(docs, length, percent)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)
    assert len(found) == len(docs)


def test_buckets_of_several_components_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    # many rows per band would find too little; few make large mixed buckets
    monkeypatch.setattr(near_dedup, "rows_per_band", lambda percent, hashes=128, miss=1e-6: 1)
    docs = [d for d in corpus()[:110] if len(d[1] or "") < 10_000]
    found = near_dedup.near_copies(documents(spark, docs), 3, 85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute(docs, 3, 85)


def test_sequential_verification():
    # the posterior after n matches of n never rules a pair out; few matches do
    assert near_dedup.least_matches(16, 85) <= 8
    assert near_dedup.least_matches(128, 85) > 80
    assert all(near_dedup.least_matches(n, 80) <= near_dedup.least_matches(n, 85) for n in (16, 64, 128))
    rng = np.random.default_rng(0)
    a = rng.integers(0, 60_000, (4, 128)).astype(np.uint16)
    b = a.copy()
    b[1, ::2] += 1
    b[2, ::9] += 1
    sizes = np.array([10, 10, 10, 10])
    assert near_dedup.surviving(a, b, sizes, np.array([10, 10, 10, 20]), 85, 1e-6).tolist() == [0, 2]


def test_band_sizes_meet_the_miss_probability():
    for percent in (60, 80, 85, 95):
        r = near_dedup.rows_per_band(percent)
        assert (1 - (percent / 100) ** r) ** (128 // r) <= 1e-6


def test_nulls_repeats_and_empty_tables(spark):
    docs = [(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (7, None), (7, None), (None, None), (None, "solo"), (3, "solo")]
    found = near_dedup.near_copies(documents(spark, docs), 3, 85).collect()
    seen = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0, r["kept"]) for r in found)
    assert seen == sorted(
        [(1, 3, 1, True)] * 2 + [(0, 3, 1, False), (7, 0, 7, True), (7, 0, 7, True), (0, 0, 0, True), (0, 1, 3, False), (3, 1, 3, True)])
    assert near_dedup.near_copies(documents(spark, [])).collect() == []


def test_one_of_each_group_stays(spark):
    docs = corpus()
    frame = documents(spark, docs)
    stay = near_dedup.without_near_copies(frame)
    assert stay.columns == frame.columns
    expected = brute(docs, 5, 80)
    assert sorted(r["doc_id"] for r in stay.collect()) == sorted(i for i, (_, low) in expected.items() if low == i)
    again = documents(spark, [(2, prose(1)), (2, prose(1)), (2, prose(2)), (5, prose(1)), (None, ""), (None, "")])
    assert sorted((r["doc_id"] or 0, r["text"]) for r in near_dedup.without_near_copies(again).collect()) == sorted(
        [(2, prose(1)), (2, prose(2)), (0, "")])
    assert near_dedup.without_near_copies(documents(spark, [])).collect() == []


def test_components(spark):
    rng = random.Random(1)
    edges = [(n, n + 1) for n in range(200)] + [(1000, n) for n in range(1001, 1200)] + [(5000, 5000), (7, 3), (2001, 2000)]
    rng.shuffle(edges)
    found = components(spark.createDataFrame(edges, "u bigint, v bigint"))
    groups = defaultdict(set)
    for r in found.collect():
        groups[r["root"]].add(r["node"])
    assert dict(groups) == {0: set(range(201)), 1000: set(range(1000, 1200)), 2000: {2000, 2001}}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []


def test_a_hot_group_makes_few_pairs(spark):
    """Candidates grow with the members of a bucket, not with their square."""
    rng = random.Random(2)
    base = prose(1, 200)
    docs = documents(spark, [edited(base, rng, 1) for _ in range(150)])
    nodes = near_dedup.signed_documents(docs, 3, 85)
    bands = nodes.select("node", F.explode("bands").alias("band"))
    centers = bands.groupBy("band").agg(F.min("node").alias("center"))
    pairs = bands.join(centers, "band").filter("node <> center").select("node", "center").distinct().count()
    assert pairs <= 150 * 25
    found = near_dedup.near_copies(docs, 3, 85)
    assert found.select("component_id").distinct().count() == 1
