"""Exact copies by an exchange of Golomb-coded fingerprints.

Each partition hashes its texts, sorts the distinct fingerprints and sends them,
Golomb-coded, to the owners of their ranges. An owner finds the fingerprints
that more than one sender holds and answers each sender with a bitmap over the
list it sent. Only texts whose fingerprint is marked are shuffled, and compared
byte for byte; no other text leaves its partition.

A fingerprint has only some bits more than the number of rows needs, so a
message costs about ten bits a text. Fingerprints that agree by chance cost
nothing but a comparison of bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadledger.llm import golomb
from loadledger.llm.tables import shuffle_partitions, stage

MORE_BITS = 8  # bits beyond those that count the rows: one text in 256 is marked by chance
OWNER_HASHES = 1 << 21  # fingerprints that an owner takes on, at most about
SENDER_ROWS = 1 << 20  # rows whose fingerprints make one message list
FILTER_BITS = 25  # the bitmap that scans are filtered by has two to this power bits
HOT_SHARE = 1000  # a class with more than one row in so many is joined apart

MESSAGE = "sender long, owner int, code binary, repeated binary"
MARKS = "sender long, owner int, marks binary"


def fingerprint_bits(rows: int) -> int:
    return min(62, max(1, rows).bit_length() + MORE_BITS)


def _senders(parts: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Fingerprints of a task in lists of bounded length."""
    held, n = [], 0
    for part in parts:
        held.append(part.column(0).to_numpy(zero_copy_only=False))
        n += len(held[-1])
        if n >= SENDER_ROWS:
            yield np.concatenate(held)
            held, n = [], 0
    if n:
        yield np.concatenate(held)


def send(fingerprints: DataFrame, shift: int) -> DataFrame:
    """Messages: per sender and owner the sorted distinct fingerprints, coded, with a bitmap of
    those that the sender itself holds more than once."""

    def messages(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        schema = pa.schema(
            [("sender", "int64"), ("owner", "int32"), ("code", "binary"), ("repeated", "binary")]
        )
        for number, found in enumerate(_senders(parts)):
            values, counts = np.unique(found, return_counts=True)
            owners = values >> shift
            starts = np.flatnonzero(np.diff(owners, prepend=-1))
            rows = []
            for a, b in zip(starts, [*starts[1:], len(values)]):
                code = golomb.encode(values[a:b] - (owners[a] << shift))
                repeated = np.packbits(counts[a:b] > 1).tobytes()
                rows.append((task << 32 | number, int(owners[a]), code, repeated))
            columns = [pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return fingerprints.mapInArrow(messages, MESSAGE)


def marks_of(messages: pd.DataFrame) -> pd.DataFrame:
    """An owner's answer: per sender a bitmap of the fingerprints that are held twice anywhere."""
    lists = [golomb.decode(code) for code in messages["code"]]
    values = np.concatenate(lists)
    order = np.argsort(values, kind="stable")
    same = np.diff(values[order]) == 0
    shared = np.zeros(len(values), bool)
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    rows, at = [], 0
    for sender, owner, own, held in zip(
        messages["sender"], messages["owner"], messages["repeated"], lists
    ):
        twice = np.unpackbits(np.frombuffer(own, np.uint8), count=len(held)).astype(bool)
        marks = shared[at : at + len(held)] | twice
        at += len(held)
        if marks.any():
            rows.append((sender, owner, np.packbits(marks).tobytes()))
    return pd.DataFrame(rows, columns=["sender", "owner", "marks"])


def marked(answered: DataFrame, shift: int) -> DataFrame:
    """``fp`` of what the bitmaps mark in the messages (owner, code, marks)."""

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for owner, code, marks in zip(*(c.to_pylist() for c in part.columns)):
                values = golomb.decode(code)
                chosen = np.unpackbits(np.frombuffer(marks, np.uint8), count=len(values))
                found = values[chosen.astype(bool)] + (owner << shift)
                yield pa.RecordBatch.from_arrays([pa.array(found, "int64")], names=["fp"])

    return answered.select("owner", "code", "marks").mapInArrow(read, "fp long")


def suspects(fingerprints: DataFrame, rows: int) -> DataFrame:
    """Fingerprints (``fp``) that occur more than once, by the exchange; a repeated one may come again."""
    spark = fingerprints.sparkSession
    bits = fingerprint_bits(rows)
    owners = max(shuffle_partitions(spark), -(-rows // OWNER_HASHES))
    shift = max(0, bits - (owners - 1).bit_length())
    messages = stage(send(fingerprints.select("fp"), shift), "exchange")
    answers = messages.groupBy("owner").applyInPandas(marks_of, MARKS)
    return marked(messages.join(answers, ["sender", "owner"]), shift)


def _word() -> F.Column:
    return F.expr(f"CAST((fp & {(1 << FILTER_BITS) - 1}) >> 6 AS INT)")


def exact_copies(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, keep_id, group_size, kept, text_sha256), one per row of ``docs``.

    Rows whose texts have the same bytes form a group; a null text counts as
    empty. ``keep_id`` is the greatest doc_id of the group, ``group_size`` its
    number of rows, ``kept`` whether the row's doc_id is that one. A null doc_id
    is never kept beside others, and is where the group has no other. A row given several times
    is counted each time, and all its repetitions are kept or none. Other
    columns are not read; an empty table gives no rows; texts may have any length.
    """
    source = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    hashed = source.select("doc_id", F.xxhash64("text").alias("h"), F.sha2("text", 256).alias("text_sha256"))
    ledger = stage(hashed, "ledger")
    rows = ledger.count()
    bits = fingerprint_bits(rows)
    short = F.expr(f"shiftrightunsigned(h, {64 - bits}) AS fp")

    # Marked fingerprints as a bitmap: 2**19 words at most, whatever the number of rows. A full one
    # would let every text pass to the comparison, and still be right.
    words = (
        suspects(ledger.select(short), rows)
        .groupBy(_word().alias("word"))
        .agg(F.expr("bit_or(1L << CAST(fp & 63 AS INT)) AS held"))
    )
    words = stage(words, "marks")
    texts = source.select("doc_id", "text", F.xxhash64("text").alias("h")).select("doc_id", "text", short)
    passed = texts.withColumn("word", _word()).join(F.broadcast(words), "word")
    passed = passed.filter("(held >> CAST(fp & 63 AS INT)) & 1 = 1")

    # Equal bytes meet here; a text that many rows hold folds to one row a task first.
    classes = (
        passed.groupBy("text")
        .agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("greatest"))
        .filter("n > 1")
        .select(F.sha2("text", 256).alias("text_sha256"), "n", "greatest")
    )
    classes = stage(classes, "classes")
    return _with_classes(ledger.select("doc_id", "text_sha256"), classes, rows)


def _with_classes(ledger: DataFrame, classes: DataFrame, rows: int) -> DataFrame:
    """Ledger rows with their class. Fewer than HOT_SHARE classes can be hot; they are broadcast,
    and their rows are dealt out evenly in the join with all other classes."""
    is_hot = F.col("n") * HOT_SHARE > F.lit(rows)
    hot = classes.filter(is_hot).select(
        "text_sha256", F.col("n").alias("hot_n"), F.col("greatest").alias("hot_greatest")
    )
    cold = classes.filter(~is_hot).withColumn("salt", F.lit(0).cast("long"))
    first = ledger.join(F.broadcast(hot), "text_sha256", "left")
    salt = F.when(F.col("hot_n").isNotNull(), 1 + F.monotonically_increasing_id()).otherwise(F.lit(0))
    both = first.withColumn("salt", salt.cast("long")).join(cold, ["text_sha256", "salt"], "left")
    size = F.coalesce("hot_n", "n", F.lit(1)).cast("long")
    keep = (
        F.when(F.col("hot_n").isNotNull(), F.col("hot_greatest"))
        .when(F.col("n").isNotNull(), F.col("greatest"))
        .otherwise(F.col("doc_id"))
    )
    found = both.select("doc_id", keep.alias("keep_id"), size.alias("group_size"), "text_sha256")
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, the one with the greatest doc_id, with all its columns."""
    kept = exact_copies(docs).filter("kept").select("doc_id", "text_sha256").distinct()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.withColumn("_sha", F.sha2(text, 256))
    same = F.col("d.doc_id").cast("long").eqNullSafe(F.col("k.doc_id"))
    found = keyed.alias("d").join(
        kept.alias("k"), same & (F.col("d._sha") == F.col("k.text_sha256")), "left_semi"
    )
    return found.dropDuplicates(["doc_id", "_sha"]).drop("_sha")
