from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from helpers import CLASHING, DOCUMENT, documents, prose

from loadledger.llm import ranked_search

ITEM = "item_id bigint, text string"


def terms(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(docs, items, k=10):
    held = [(i, Counter(terms(t))) for i, t in docs]
    lengths = [sum(c.values()) for _, c in held]
    holders, total = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(t for _, c in held for t in c)
    asked = defaultdict(set)
    for item_id, text in items:
        asked[item_id] |= set(terms(text))
    found = []
    for item_id, wanted in asked.items():
        scores = []
        for row, (doc_id, counts) in enumerate(held):
            score = 0
            for t in wanted & set(counts):
                w = math.floor(1000 * math.log((2 * holders + 2) / (2 * df[t] + 1)))
                m = 10 + (90 * lengths[row] * holders) // total
                score += w * ((1_000_000_000 * counts[t]) // (1000 * counts[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scores)[:k], 1):
            found.append((item_id, rank, doc_id, -score))
    return sorted(found, key=repr)


def given(spark, docs, items, **options):
    table = documents(spark, docs).repartition(5)
    names = [n for n in CLASHING if n != "item_id"]
    asked = spark.createDataFrame(items, ITEM).selectExpr("*", *[f"'x' AS `{n}`" for n in names], "'y' AS doc_id")
    found = ranked_search.search(spark, table, asked, **options)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=repr)


def corpus():
    docs = [(n, prose(n, 20 + n)) for n in range(60)]
    docs += [(100 + n, docs[7][1]) for n in range(15)]  # equal scores
    docs += [(200, None), (201, ""), (202, " -- "), (None, docs[7][1]), (None, docs[8][1]), (7, docs[7][1])]
    docs += [(203, "Straße ÄÖ été Été straße"), (204, "tail " * 100_000 + docs[3][1])]
    items = [(n, prose(n + 5, 12)) for n in range(6)]
    items += [(10, docs[7][1]), (11, None), (12, ""), (13, "no such term anywhere zzz"), (14, "straße ÉTÉ été")]
    items += [(10, docs[3][1]), (10, docs[3][1]), (None, docs[8][1]), (15, "tail"), (16, "bel " * 50)]
    return docs, items


@pytest.mark.parametrize("options", [{}, {"shard_docs": 7, "owners": 3}, {"k": 3, "block_items": 4, "owners": 1}])
def test_equals_brute_force(spark, options):
    docs, items = corpus()
    assert given(spark, docs, items, **options) == brute(docs, items, options.get("k", 10))


def test_empty_tables(spark):
    docs, items = corpus()
    assert given(spark, [], items) == []
    assert given(spark, docs, []) == []
    assert given(spark, [(1, None), (2, "..")], items) == []


def test_a_term_in_every_document(spark):
    rng = random.Random(3)
    docs = [(n, "common " * rng.randint(1, 9) + prose(n, 9)) for n in range(300)]
    items = [(1, "common"), (2, "common " + docs[5][1])]
    assert given(spark, docs, items, shard_docs=50) == brute(docs, items)


def test_owners_only_drop_what_cannot_return(spark):
    """Through three owners, each bundle keeps the best, whatever was dropped on the way."""
    rng = np.random.default_rng(2)
    for _ in range(30):
        n, k = 40, 4
        terms = np.zeros(6, ranked_search.TERM)
        terms["tid"], terms["owner"] = range(6), np.repeat(range(3), 2)
        terms["w"] = np.sort(rng.integers(0, 60, 6))[::-1]
        rows = [(r, t, int(rng.integers(1, 5))) for r in range(n) for t in range(6) if rng.random() < 0.4]
        frame = pd.DataFrame(rows, columns=["rid", "tid", "tf"])
        frame["m"], frame["doc_id"] = 20 + frame["rid"] % 3, frame["rid"] * 2
        bundle = pd.DataFrame(
            [(0, 1, terms.tobytes(), b"", b"", b"")], columns=["shard", "iid", "terms", "rids", "ids", "scores"]
        )
        for owner in range(3):
            mine = frame[frame["tid"].isin(terms["tid"][terms["owner"] == owner])]
            bundle = ranked_search.add_owner(owner, k)(bundle, mine)
        best = next(ranked_search.best_of(k)(iter([bundle])))
        sums = Counter()
        for rid, tid, tf, m, _ in frame.itertuples(index=False):
            sums[rid] += int(terms["w"][tid]) * ((10**9 * tf) // (1000 * tf + 8 * m))
        expected = sorted(((-s, r) for r, s in sums.items() if s > 0))[:k]
        assert list(zip(best["score"], best["rid"])) == [(-s, r) for s, r in expected]


def test_the_terms_of_a_block_meet_no_pairs_of_items_and_documents(spark):
    docs, items = corpus()
    terms_ = ranked_search.item_terms(spark.createDataFrame(items, ITEM)).select("term").distinct()
    numbered = terms_.selectExpr("monotonically_increasing_id() AS tid", "term")
    plan = ranked_search.postings_of(documents(spark, docs), numbered)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert spark.createDataFrame([], DOCUMENT).count() == 0
