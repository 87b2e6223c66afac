from __future__ import annotations

import hashlib
import random

import pytest
from helpers import by_id, documents, prose
from pyspark.sql import functions as F

from loadledger.llm import order_minhash as omh


def expected_edit(ordered):
    """doc_id -> (n_chars, edited text, next doc_id) for documents in order."""
    out = {}
    for n, (doc_id, text) in enumerate(ordered):
        _, following = ordered[(n + 1) % len(ordered)]
        cut = len(text) // 4
        out[doc_id] = (len(text), text[: len(text) - cut] + following[:cut])
    return out


TEXTS = [prose(n, 5 + 9 * n) for n in range(14)] + ["", "é🙂中文" * 9, "abc", " \n ", prose(3, 32), "x" * 30_000, prose(77, 9_000)]


@pytest.fixture(scope="module")
def found(spark):
    docs = [(10 * n + 5, t) for n, t in enumerate(TEXTS)]
    random.Random(1).shuffle(docs)
    return by_id(omh.fingerprints(documents(spark, docs).repartition(6)))


def test_edited_texts(found):
    ordered = [(10 * n + 5, t) for n, t in enumerate(TEXTS)]
    for doc_id, (n_chars, edited) in expected_edit(ordered).items():
        row = found[doc_id]
        assert (row["n_chars"], row["edited_sha256"]) == (n_chars, hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
    assert len(found) == len(TEXTS)


def test_equal_texts_have_equal_fingerprints(found):
    assert found[35]["fingerprint"] == found[185]["fingerprint"]
    assert len({r["fingerprint"] for r in found.values()}) == len(set(TEXTS))
    # a text that the edit leaves as it was
    assert found[145]["near_edited"] == 1.0 and found[145]["edited_fingerprint"] == found[145]["fingerprint"]


def test_an_edited_text_is_nearer_than_the_next_one(found):
    longer = [r for r in found.values() if r["n_chars"] > 500]
    assert all(r["near_edited"] > r["near_next"] for r in longer if r["doc_id"] != 195)
    assert sum(r["near_next"] for r in longer) / len(longer) < 0.05


def reference(text):
    """The signature in plain Python, but for the hash function: lists of chosen k-mers."""
    import re

    units = re.findall(omh.UNIT, text)
    kmers = [tuple(units[n : n + omh.K]) for n in range(max(1, len(units) - omh.K + 1))]
    seen, numbered = {}, []
    for at, kmer in enumerate(kmers):
        seen[kmer] = seen.get(kmer, -1) + 1
        numbered.append((kmer, seen[kmer], at))
    return numbered


def prints(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "n bigint, text string")
    return [r["fp"] for r in omh.with_fingerprint(df, "text", "fp").orderBy("n").collect()]


def same(a, b):
    return sum(a[8 * n : 8 * n + 8] == b[8 * n : 8 * n + 8] for n in range(omh.SKETCHES)) / omh.SKETCHES


def test_order_and_repeats_count(spark):
    base = prose(1, 400).rstrip(".").split()
    halves = base[200:] + base[:200]
    backwards = base[::-1]
    once, twice = " ".join(base), " ".join(base + base)
    a, b, c, d, e = prints(spark, [once, " ".join(halves), " ".join(backwards), twice, once])
    assert a == e
    # the same k-mers, but half of the pairs change their order; set overlap alone would be near 1
    assert 0.2 < same(a, b) < 0.85
    assert same(a, c) < 0.1
    # occurrence numbers tell a doubled text from a single one
    assert same(a, d) < 0.6


def test_likeness_follows_the_overlap(spark):
    rng = random.Random(5)
    base = prose(2, 1500).split()
    texts = [" ".join(base)]
    for share in (0.02, 0.1, 0.3):
        words = [w if rng.random() > share else f"q{rng.randrange(10**6)}" for w in base]
        texts.append(" ".join(words))
    a, *others = prints(spark, texts)
    near = [same(a, b) for b in others]
    assert near[0] > near[1] > near[2] and near[0] > 0.7 and near[2] < 0.45


def test_numbering_matches_plain_python(spark):
    """Distinct numbered k-mers are as many as there are k-mers, whatever repeats."""
    text = "a b a b a b c a b c a b " * 30 + prose(3, 50)
    df = spark.createDataFrame([(text,)], "text string")
    units = df.select(F.regexp_extract_all("text", F.lit(omh.UNIT), F.lit(0)).alias("u")).first()["u"]
    numbered = reference(text)
    assert len(units) - omh.K + 1 == len(numbered) == len({n[:2] for n in numbered})
    longer, shorter = prints(spark, [text, text[: len(text) // 2]])
    assert 0 <= same(longer, shorter) < 1


def test_units_start_at_every_place_of_a_long_run(spark):
    text = "ab word12 ninechars \t🙂🙃🙂é中🙂🙃🙂🙂 x"
    df = spark.createDataFrame([(text,)], "text string")
    units = df.select(F.regexp_extract_all("text", F.lit(omh.UNIT), F.lit(1)).alias("u")).first()["u"]
    assert units == ["ab", "word12", "ninechar", "inechars", "🙂🙃🙂é中🙂🙃🙂", "🙃🙂é中🙂🙃🙂🙂", "x"]


@pytest.mark.parametrize("alphabet", ["".join(map(chr, range(0x4E00, 0x5E00))), "ABCDabcdefghij0123456789+/", "".join(map(chr, range(0x1F300, 0x1F5FF)))])
def test_a_shift_inside_a_text_without_blanks_changes_little(spark, alphabet):
    rng = random.Random(6)
    text, other = ("".join(rng.choice(alphabet) for _ in range(2000)) for _ in range(2))
    texts = [text, "q" + text, text[1:], text[:900] + "q" + text[900:], other]
    first, *near, far = prints(spark, texts)
    assert all(same(first, p) > 0.85 for p in near)
    assert same(first, far) < 0.1


def test_repeats_nulls_and_empty_tables(spark):
    docs = [(1, "a b c d"), (1, "a b c d"), (2, None), (2, "other text"), (None, "zz zz")]
    rows = omh.fingerprints(documents(spark, docs)).collect()
    assert len(rows) == 5
    assert len({tuple(r) for r in rows if r["doc_id"] == 1}) == 1
    null = next(r for r in rows if r["doc_id"] is None)
    # a null doc_id comes first; its next document is 1
    assert null["edited_sha256"] == hashlib.sha256(b"zz za").hexdigest()
    assert omh.fingerprints(documents(spark, [])).collect() == []
    alone = omh.fingerprints(documents(spark, [(4, "one two three")])).first()
    assert alone["near_next"] == 1.0


def test_no_python_in_the_plan(spark):
    plan = omh.fingerprints(documents(spark, ["a b", "c d"], clash=False))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
