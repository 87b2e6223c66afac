from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from helpers import DOCUMENT, documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from loadledger.llm import exact_dedup, golomb


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 2**50), max_size=80))
def test_golomb_round_trip(values):
    held = np.array(sorted(values), np.int64)
    assert golomb.decode(golomb.encode(held)).tolist() == held.tolist()


def test_golomb_code_is_near_the_bound():
    rng = np.random.default_rng(1)
    held = np.unique(rng.integers(0, 1 << 36, 50_000))
    # mean gap 2**20.4; the code may take some 1.6 bits more than its logarithm
    assert 8 * len(golomb.encode(held)) / len(held) < np.log2((1 << 36) / 50_000) + 1.7


def test_an_owner_marks_what_two_senders_or_one_twice_hold():
    lists = {1: [3, 5, 9], 2: [5, 7], 3: [8]}
    twice = {3: [True]}
    rows = [
        (s, 0, golomb.encode(np.array(v)), np.packbits(twice.get(s, [False] * len(v))).tobytes())
        for s, v in lists.items()
    ]
    answer = exact_dedup.marks_of(pd.DataFrame(rows, columns=["sender", "owner", "code", "repeated"]))
    found = {
        r.sender: np.unpackbits(np.frombuffer(r.marks, np.uint8), count=len(lists[r.sender])).tolist()
        for r in answer.itertuples()
    }
    assert found == {1: [0, 1, 0], 2: [1, 0], 3: [1]}


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    found = []
    for doc_id, text in rows:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256((text or "").encode()).hexdigest()
        found.append((doc_id, keep, len(ids), doc_id == keep, sha))
    return sorted(found, key=repr)


def pairs():
    texts = [prose(n) for n in range(30)]
    rows = [(n, t) for n, t in enumerate(texts)]
    rows += [(100 + n, texts[n % 7]) for n in range(40)]
    rows += [(200, None), (201, ""), (202, None), (203, " "), (None, texts[1]), (None, "only here")]
    rows += [(300, "é" * 400_000), (301, "é" * 400_000), (302, "é" * 399_999)]
    rows += [(5, texts[5]), (139, texts[4]), (139, texts[4])]  # rows given twice
    return rows


def test_equals_brute_force(spark):
    rows = pairs()
    found = exact_dedup.exact_copies(documents(spark, rows).repartition(5))
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows)


def test_hot_group_over_many_partitions(spark):
    rows = [(n, "the same" if n % 3 else prose(n, 5)) for n in range(3000)]
    found = exact_dedup.exact_copies(documents(spark, rows).repartition(12))
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("bits", [1, 3])
def test_fingerprints_that_agree_by_chance_change_nothing(spark, monkeypatch, bits):
    monkeypatch.setattr(exact_dedup, "fingerprint_bits", lambda rows: bits)
    rows = pairs()
    found = exact_dedup.exact_copies(documents(spark, rows).repartition(3))
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows)


def test_only_marked_texts_are_shuffled(spark):
    rows = [(n, prose(n)) for n in range(400)]
    frame = spark.createDataFrame([(n, len(t)) for n, t in rows], "fp long, n long")
    marked = exact_dedup.suspects(frame.repartition(4), 400)
    assert marked.count() == 0
    again = frame.filter("fp < 20").union(frame)
    assert {r[0] for r in exact_dedup.suspects(again.repartition(4), 420).collect()} == set(range(20))


def test_empty_table(spark):
    nothing = spark.createDataFrame([], DOCUMENT)
    assert exact_dedup.exact_copies(nothing).collect() == []
    assert exact_dedup.without_copies(nothing).collect() == []


def test_kept_rows_have_all_columns(spark):
    docs = documents(spark, pairs())
    left = exact_dedup.without_copies(docs)
    assert left.columns == docs.columns
    texts = [r["text"] or "" for r in left.collect()]
    assert len(texts) == len(set(texts)) == len({t or "" for _, t in pairs()})
