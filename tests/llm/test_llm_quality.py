from __future__ import annotations

import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from helpers import by_id, documents, prose

from loadledger.llm import quality

LABEL = "doc_id bigint, quality int, toxic int, text string, score string"


def bad(seed):
    rng = random.Random(seed)
    words = prose(seed, 60).split()
    kinds = (
        lambda: " ".join(w.upper() + "!!" for w in words),
        lambda: " ".join(w + rng.choice(["%%%", "***", "$$$"]) for w in words),
        lambda: " | ".join(words),
        lambda: " ".join(w for w in words[:6] for _ in range(20)),
    )
    return kinds[seed % 4]()


def labelled(spark, n=400):
    texts, labels = [], []
    for k in range(n):
        good = k % 3 != 0
        texts.append(prose(k, 60) if good else bad(k))
        if k % 10 != 9:
            labels.append((k, int(good), 0, "x", "x"))
    return documents(spark, texts), spark.createDataFrame(labels, LABEL)


@pytest.fixture(scope="module")
def judged(spark):
    docs, labels = labelled(spark)
    return by_id(quality.judge_documents(docs, labels))


def test_held_out_accuracy(judged):
    assert len(judged) == 400
    held = {i: r for i, r in judged.items() if r["held_out"]}
    assert set(held) == {i for i in judged if zlib.crc32(str(i).encode()) % 3 == 1}
    right = [r["predicted"] == int(i % 3 != 0) for i, r in held.items()]
    assert sum(right) / len(right) >= 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in judged.values())


def test_held_out_labels_teach_nothing(spark, judged):
    docs, labels = labelled(spark)
    flipped = labels.selectExpr(
        "doc_id", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1, 1 - quality, quality) AS quality", "toxic")
    again = by_id(quality.judge_documents(docs, flipped))
    assert {i: r["score"] for i, r in again.items()} == {i: r["score"] for i, r in judged.items()}


def test_only_the_text_counts(spark):
    docs, labels = labelled(spark, 90)
    model = quality.learn(docs, labels)
    moved = docs.selectExpr("doc_id + 100000 AS doc_id", "text", "'zz' AS lang", "'zz' AS source")
    mine = sorted(r["score"] for r in quality.scored(docs, model).collect())
    assert mine == sorted(r["score"] for r in quality.scored(moved, model).collect())


def test_nulls_empties_repeats_and_long_texts(spark):
    docs, labels = labelled(spark, 90)
    model = quality.learn(docs, labels)
    long = " ".join(prose(n, 200) for n in range(400))
    odd = documents(spark, [None, "", " \n", (5, long), (5, long), (None, "text")])
    found = quality.scored(odd, model).collect()
    assert len(found) == 6 and all(0 <= r["score"] <= 1 for r in found)
    empty = [r["score"] for r in found if not (r["text"] or "").strip()]
    assert len(empty) == 3 and len(set(empty)) == 1
    assert len(list(quality.word_numbers(long, quality.WordIds(model.names)))) > 1
    by_text = {r["text"]: r["score"] for r in found}
    for text in (long, "text"):
        assert by_text[text] == pytest.approx(plain_score(text, model), abs=1e-4)


def plain_vector(word, model):
    """A word's vector, told once more from its definition."""
    own = np.zeros(quality.DIMENSIONS)
    mark = xxhash.xxh3_64_intdigest(word.encode()) >> 16
    for n in range(6):
        byte = mark >> (8 * n) & 255
        own[10 * n + (byte >> 1) % 10] = -1 if byte & 1 else 1
    if word in model.names:
        return model.vectors[model.names.index(word)]
    return model.vectors[model.names.index(quality.class_of(word))] + own / np.sqrt(6)


def plain_score(text, model):
    """Score of a text word by word: vectors, mean, spread, network, temperature."""
    words, vectors = re.findall(r"\w+|[^\w\s]+", text), []
    for n, word in enumerate(words):
        said = word in words[max(0, n - 4) : n]
        signs = not (word[0].isalnum() or word[0] == "_")
        vectors.append(model.vectors[0] if said and not signs else plain_vector(word, model))
    x = np.concatenate([np.mean(vectors, 0), np.std(vectors, 0)])
    net = model.network
    hidden = [max(0.0, float(((x - net.mean) / net.scale) @ net.w1[:, h] + net.b1[h])) for h in range(len(net.b1))]
    logit = sum(a * b for a, b in zip(hidden, net.w2)) + net.b2
    return 1 / (1 + math.exp(-logit / net.temperature))


def test_scores_equal_a_plain_forward_pass(spark):
    docs, labels = labelled(spark, 120)
    model = quality.learn(docs, labels)
    assert model.network is not None and model.names[0] == "<again>"
    for row in quality.scored(docs, model).limit(40).collect():
        assert row["score"] == pytest.approx(plain_score(row["text"], model), abs=2e-3)


def test_a_repeat_is_seen_across_a_chunk_border(monkeypatch):
    ids = quality.WordIds([*quality.CLASSES])
    text = "one two three four one five six seven eight six nine " * 3
    whole = [n.tolist() for n, _ in quality.word_numbers(text, ids)]
    monkeypatch.setattr(quality, "CHUNK_WORDS", 4)
    parts = [n.tolist() for n, _ in quality.word_numbers(text, ids)]
    assert len(parts) > 5 and sum(parts, []) == sum(whole, [])
    assert whole[0][4] == 0 and whole[0][9] == 0


def test_words_beyond_the_vocabulary_count():
    vectors = np.ones((len(quality.CLASSES), quality.DIMENSIONS), np.float32)
    ids = quality.WordIds([*quality.CLASSES])
    one, other = (quality.pooled(word, ids, vectors) for word in ("apple", "pear"))
    assert not np.allclose(one, other)


def test_the_sample_is_bounded_whatever_repeats(spark):
    docs, labels = labelled(spark, 30)
    many = docs.unionByName(docs.filter("doc_id < 2").crossJoin(spark.range(500)).drop("id"))
    assert quality.labelled_sample(many, labels, "quality", 10).count() == 10


def test_without_labels_every_score_is_the_prior(spark):
    docs = documents(spark, ["a", None])
    none = spark.createDataFrame([], LABEL)
    assert {r["score"] for r in quality.judge_documents(docs, none).collect()} == {0.5}
    assert quality.judge_documents(documents(spark, []), none).collect() == []
    odd = spark.createDataFrame([(None, 1, 0, "", ""), (0, None, 0, "", ""), (0, 0, 0, "", ""), (0, 1, 0, "", ""), (1, 7, 0, "", "")], LABEL)
    assert {r["score"] for r in quality.judge_documents(docs, odd).collect()} == {0.5}


def test_accepted_keeps_columns(spark):
    docs, labels = labelled(spark)
    model = quality.learn(docs, labels)
    stay = quality.accepted(docs, model)
    assert stay.columns == docs.columns
    kept = {r["doc_id"] for r in stay.collect()}
    good = {k for k in range(400) if k % 3 != 0}
    assert len(good - kept) <= 4 and len(kept - good) <= 6


def test_temperature_and_training():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 6))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    net = quality.train(x, y)
    assert ((net.probability(x) >= 0.5) == (y > 0)).mean() > 0.9
    sure = np.where(y > 0, 8.0, -8.0)
    sure[:150] *= -1  # a quarter wrong: probabilities must come down
    assert quality.best_temperature(sure, y) > 4
