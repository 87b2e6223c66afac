from __future__ import annotations

import re
from itertools import permutations

import pytest
from helpers import CLASHING, DOCUMENT

from loadledger.llm import filter_audit

LABEL = "doc_id bigint, quality int, toxic int"


def test_lattice_counts_are_those_of_the_orders():
    edges = filter_audit.lattice()
    assert len(edges) == 80
    assert all(e.orders == len(e.steps) for e in edges)
    assert sum(e.orders for e in edges) == 120 * 5
    orders = {order for e in edges for order, _ in e.steps}
    assert orders == {"".join(p) for p in permutations("ABCDE")}
    for e in edges:
        for order, step in e.steps:
            assert 1 << "ABCDE".index(order[step - 1]) == e.bit
            assert sum(1 << "ABCDE".index(f) for f in order[: step - 1]) == e.state


def failed(doc_id, text, rows):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    capitals = len(re.findall("[A-Z]", text))
    tests = {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * capitals > 2 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
        "E": doc_id is not None
        and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows),
    }
    return {f for f, broken in tests.items() if broken}


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    parts = {}
    for doc_id, text, source in rows:
        fails = failed(doc_id, text or "", rows)
        parts.setdefault(source or "", []).append((fails, doc_id in good, doc_id in toxic))
    found = {}
    for part, docs in parts.items():
        sums = dict.fromkeys("ABCDE", 0)
        lines = {}
        for order in permutations("ABCDE"):
            left = docs
            gone = []
            for step, f in enumerate(order, 1):
                out = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                sums[f] += len(out)
                lines["".join(order), step] = (
                    f, len(left), len(out), sum(f in d[0] for d in gone),
                    sum(d[0] == {f} for d in docs), sum(d[1] for d in out), sum(d[2] for d in out),
                )
                gone += out
        for (order, step), (f, *figures) in lines.items():
            found[part, order, step] = (*figures, sums[f])
    return found


def table(spark, rows, clash=True):
    docs = spark.createDataFrame(
        [(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCUMENT
    )
    names = [n for n in (*CLASHING, "part", "failed", "state", "bit", "docs") if clash]
    return docs.selectExpr("*", *[f"'x' AS `{n}`" for n in names])


def measured(found):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in found.collect()}


def many():
    plain = " ".join(f"word{n}" for n in range(250))
    texts = [
        plain, plain, plain.upper(), plain + " 100%", "same " * 300, "same " * 300, "", None,
        "short", "é" * 300, "X" * 10, "a\x0bb\x0cc\rd\te\nf" * 60, plain + "$" + "Q" * 200,
    ]
    rows = [(n, t, f"s{n % 3}" if n % 5 else None) for n, t in enumerate(texts * 3)]
    rows += [(0, plain, "s0"), (0, plain, "s0"), (None, plain, "s1"), (None, plain, "s1")]
    rows += [(900, "tok " * 300_000, "long"), (901, "tok " * 300_000, "long")]
    return rows


LABELS = [(0, 1, 0), (1, 1, 1), (2, 0, 1), (4, 1, None), (5, None, 1), (5, 1, 0), (None, 1, 1), (13, 1, 1)]


def test_equals_brute_force(spark):
    rows = many()
    labels = spark.createDataFrame(LABELS, LABEL).selectExpr("*", "'x' AS docs", "1 AS good")
    found = filter_audit.audit_documents(spark, table(spark, rows).repartition(4), labels)
    known = [(i, q, t) for i, q, t in LABELS if i is not None]
    assert measured(found) == brute(rows, known)


def test_copies_across_parts_and_partitions(spark):
    rows = [(n, "copied text", f"s{n % 4}") for n in range(400)] + [(1000, "copied text", "late")]
    found = measured(filter_audit.audit_documents(spark, table(spark, rows).repartition(8), spark.createDataFrame([], LABEL)))
    assert found == brute(rows, [])
    assert found["s0", "EABCD", 1][:2] == (1, 99) and found["s1", "EABCD", 1][:2] == (0, 100)


def test_empty_table(spark):
    nothing = spark.createDataFrame([], DOCUMENT)
    assert filter_audit.audit_documents(spark, nothing, spark.createDataFrame(LABELS, LABEL)).count() == 0


@pytest.mark.parametrize("filters", ["A", "XYZ"])
def test_other_numbers_of_filters(spark, filters):
    counts = spark.createDataFrame([("p", 1, 4, 1, 0)], "part string, failed int, docs long, good long, toxic long")
    found = filter_audit.audit(spark, counts, filters).collect()
    assert len({r["filter_order"] for r in found}) * len(filters) == len(found)
    first = filters[0]
    orders = len({r["filter_order"] for r in found})
    for row in found:
        is_first = row["filter_order"][row["step"] - 1] == first
        assert row["shapley"] == (4 * orders if is_first else 0)
