"""Small tables for the tests of the llm folder."""

from __future__ import annotations

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that the operators use for columns of their own.
CLASHING = (
    "score", "predicted", "held_out", "node", "row_key", "band", "component_id", "kept", "piece", "start",
    "length", "bin", "offset", "spans", "fp", "k1", "k2", "next", "key", "digest", "rank", "_id", "_key", "row", "h",
)


def documents(spark, texts, clash=True, first=0):
    """Documents numbered from ``first``; a pair gives its own doc_id."""
    rows = []
    for n, entry in enumerate(texts, first):
        doc_id, text = entry if isinstance(entry, tuple) else (n, entry)
        rows.append((doc_id, text, "en", "src", len(text or "")))
    found = spark.createDataFrame(rows, DOCUMENT)
    if clash:
        found = found.selectExpr("*", *[f"'x' AS `{name}`" for name in CLASHING])
    return found


def prose(seed: int, words: int = 120) -> str:
    """Plain words, different for each seed."""
    import random

    rng = random.Random(seed)
    parts = ["an", "bel", "cor", "dun", "el", "fi", "gra", "hum", "is", "jo", "kel", "lo", "mir", "nos", "or"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(words)]
    return " ".join(made) + "."


def by_id(df, key="doc_id"):
    return {row[key]: row.asDict() for row in df.collect()}
