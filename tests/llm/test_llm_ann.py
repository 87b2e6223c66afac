from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from itertools import islice

from loadledger.llm import ann

TABLE = "vec_id bigint, embedding array<float>, label int, point string, bucket string, score string, rank int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "x", "x", 0) for i, v in rows], TABLE)


def brute(rows, every, k):
    """query -> [(vec_id, score)]; ties to the smaller id."""
    out = {}
    sound = [(i, np.array(v, float)) for i, v in rows]
    for q, v in sound:
        if q % every == 0:
            near = sorted(((-float((v * x).sum()), i) for i, x in sound if i != q))[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


def results(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        own = out.setdefault(r["query_id"], [])
        assert r["rank"] == len(own) + 1
        own.append((r["vec_id"], r["score"]))
    return out


def recall(found, truth):
    hit = sum(len({i for i, _ in found.get(q, [])} & {i for i, _ in t}) for q, t in truth.items())
    return hit / sum(map(len, truth.values()))


@pytest.mark.parametrize("scale", [False, True], ids=["unit", "norms"])
def test_recall_against_brute_force(spark, scale):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if scale:  # the largest product is not the least angle
        x *= rng.uniform(0.5, 3, (1500, 1))
    rows = [(n, v.astype(np.float32).tolist()) for n, v in enumerate(x)]
    truth = brute(rows, 20, 20)
    found = results(ann.search(table(spark, rows).repartition(4)))
    assert set(found) == set(truth) and all(len(f) == 20 for f in found.values())
    assert recall(found, truth) >= 0.9
    vectors = dict(rows)
    for q, near in found.items():
        a = np.array(vectors[q], float)
        for i, score in near:
            assert score == pytest.approx(float((a * np.array(vectors[i], float)).sum()), abs=1e-12)
        assert near == sorted(near, key=lambda n: (-n[1], n[0]))


def test_copies_and_ties(spark):
    rng = np.random.default_rng(4)
    hot = rng.normal(size=8).tolist()
    rows = [(n, hot) for n in range(0, 300)] + [(300 + n, rng.normal(size=8).tolist()) for n in range(60)]
    rows = [(i, np.array(v, np.float32).tolist()) for i, v in rows]
    truth = brute(rows, 20, 20)
    found = results(ann.search(table(spark, rows + rows[:10])))
    assert {q: [i for i, _ in n] for q, n in found.items() if q < 300} == {q: [i for i, _ in n] for q, n in truth.items() if q < 300}
    assert recall(found, truth) >= 0.9


def test_many_vectors_with_one_score_go_by_id(spark, monkeypatch):
    monkeypatch.setattr(ann, "_calibrated", lambda *_: 500)  # reaches every cell
    pairs = [[float(n in (a, b)) for n in range(16)] for a in range(16) for b in range(a)]
    rows = [(0, [1.0] * 16)] + [(3 * n + 1, v) for n, v in enumerate(pairs[::-1])]
    assert results(ann.search(table(spark, rows[::-1]), every=1000)) == brute(rows, 1000, 20)


def test_the_first_of_equal_scores_are_best():
    scores = np.random.default_rng(4).integers(0, 4, (50, 30)).astype(float)
    for keep in (1, 7, 29, 30, 40):
        wanted = np.sort(np.argsort(-scores, 1, kind="stable")[:, :keep], 1)
        assert (np.sort(ann._best(scores, keep), 1) == wanted).all()


def test_a_large_bucket_is_split(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART_VALUES", 320)
    monkeypatch.setattr(ann, "PART_QUERIES", 3)
    rng = np.random.default_rng(5)
    centre = rng.normal(size=8)
    rows = [(n, (centre + 1e-3 * rng.normal(size=8)).astype(np.float32).tolist()) for n in range(400)]
    truth = brute(rows, 20, 20)
    found = results(ann.search(table(spark, rows)))
    assert recall(found, truth) >= 0.9


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0, None]),
            (7, [1.0, 2.0, 3.0]), (8, []), (9, [4.0]), (None, [9.0, 9.0]), (20, [2.0, 1.0]), (40, None)]
    found = results(ann.search(table(spark, rows)))
    assert found == {0: [(20, 2.0), (1, 0.5)], 20: [(0, 2.0), (1, 1.5)]}


def test_few_rows(spark):
    assert ann.search(table(spark, [])).collect() == []
    assert ann.search(table(spark, [(0, [1.0, 2.0])])).collect() == []
    assert ann.search(table(spark, [(1, [1.0, 2.0]), (3, [2.0, 1.0])])).collect() == []
    assert results(ann.search(table(spark, [(0, [1.0, 2.0]), (3, [2.0, 1.0])]), k=5)) == {0: [(3, 4.0)]}


@settings(max_examples=50, deadline=None)
@given(st.lists(st.floats(-5, 5), min_size=1, max_size=3))
def test_probes_come_in_order_of_estimated_success(place):
    place = np.array(place)
    home = np.floor(place)
    inside = place - home

    def cost(bucket):
        total = 0.0
        for f, d in zip(inside, np.array(bucket) - home):
            total += (d - f) ** 2 if d > 0 else (-d - 1 + f) ** 2 if d < 0 else 0
        return total

    order = list(islice(ann.probe_order(place), 40))
    assert order[0] == tuple(home.astype(int)) and len(set(order)) == len(order)
    costs = [cost(b) for b in order]
    assert all(a <= b + 1e-9 for a, b in zip(costs, costs[1:]))
    # nothing cheaper was left out
    span = range(-2, 3)
    grid = np.stack(np.meshgrid(*[span] * len(place)), -1).reshape(-1, len(place)) + home
    cheaper = sum(cost(b) < costs[-1] - 1e-9 for b in grid)
    assert cheaper <= len(order)


def test_queries_with_too_few_candidates_are_completed_exactly(spark, monkeypatch):
    monkeypatch.setattr(ann, "_calibrated", lambda *_: 1)  # hardly reaches beyond the own bucket
    rng = np.random.default_rng(8)
    rows = [(n, v.astype(np.float32).tolist()) for n, v in enumerate(rng.normal(size=(300, 12)))]
    found = results(ann.search(table(spark, rows)))
    assert set(found) == {n for n in range(0, 300, 20)} and all(len(f) == 20 for f in found.values())


def test_all_vectors_are_compared_where_probes_would_not_do(spark, monkeypatch):
    monkeypatch.setattr(ann, "MOST_PROBES", 1)
    monkeypatch.setattr(ann, "PART_VALUES", 200)
    rng = np.random.default_rng(9)
    rows = [(n, v.astype(np.float32).tolist()) for n, v in enumerate(rng.normal(size=(300, 6)))]
    found, truth = results(ann.search(table(spark, rows), k=7)), brute(rows, 20, 7)
    assert {q: [i for i, _ in f] for q, f in found.items()} == {q: [i for i, _ in t] for q, t in truth.items()}


def test_vectors_of_each_length_are_searched_among_their_own(spark):
    rng = np.random.default_rng(10)
    rows = [(n, rng.normal(size=2 + n % 2).astype(np.float32).tolist()) for n in range(0, 63)]
    rows += [(20, [1.0, 2.0, 3.0])]  # asks with the shorter of its vectors
    found = results(ann.search(table(spark, rows), k=3))
    for n in (0, 20, 40, 60):
        own = [(i, v) for i, v in rows if len(v) == 2]
        assert [i for i, _ in found[n]] == [i for i, _ in brute(own, 20, 3)[n]]
    asked = ann.search(table(spark, [(0, [1.0]), (1, [2.0]), (2, [1.0, 1.0]), (20, [1.0, 2.0])]))
    assert results(asked) == {0: [(1, 2.0)], 20: [(2, 3.0)]}
