"""Order MinHash fingerprints, in DataFrame expressions only.

A text is cut into units: words, and of a longer run without white space all
parts of UNIT_CHARS characters, one from each place on, so that units do not
depend on where the run begins. Every run of K units is a k-mer, numbered by how often it occurred before, so that repeats count. A sketch
selects the numbered k-mers whose hashes come first in its own order, lists them
as they stand in the text, and hashes that list. Two texts agree in a sketch
when they share its k-mers and have them in the same order, which falls with
their edit distance, not only with their overlap.

The order of sketch j is that of the hashes read upwards from a starting point
c(j), and around. The hash is uniform, so each such order is as good as a fresh
hash function, but one sort serves all sketches: the selected k-mers are the
ones that follow c(j).

Hash and position travel in one long: the upper bits hold the hash, the lower
POSITION_BITS the position, and sorting longs is all that Spark has to do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadledger.llm.tables import shuffle_partitions, stage

UNIT_CHARS = 8
# Matches nothing by itself, at every place where a unit starts, but not inside a surrogate pair; group 1 is the unit.
UNIT = rf"(?![\uDC00-\uDFFF])(?=((?<!\S)\S{{1,{UNIT_CHARS}}}|\S{{{UNIT_CHARS}}}))"
K = 2  # units in a k-mer
SELECTED = 2  # k-mers in a sketch
SKETCHES = 32
POSITION_BITS = 28
_LOW = (1 << POSITION_BITS) - 1
_STEPS = [1 << b for b in range(POSITION_BITS - 1, -1, -1)]


def _high(value: Column) -> Column:
    return value.bitwiseAND(F.lit(~_LOW))


def _low(value: Column) -> Column:
    return value.bitwiseAND(F.lit(_LOW))


def _steps() -> Column:
    return F.array(*map(F.lit, _STEPS))


def _numbered(sorted_: Column, value: Column, at: Column) -> Column:
    """Hash of a k-mer with its number of earlier occurrences; its position stays.

    Equal k-mers stand side by side, by position; how many of them come before
    is found by steps of falling size.
    """
    first = _high(value)
    before = F.aggregate(
        _steps(),
        F.lit(0),
        lambda n, step: F.when(F.get(sorted_, at - n - step) >= first, n + step).otherwise(n),
    )
    repeated = F.get(sorted_, at - F.lit(1)) >= first
    own = F.when(repeated, F.xxhash64(first, before)).otherwise(F.xxhash64(first))
    return _high(own).bitwiseOR(_low(value))


def _sketch(sorted_: Column, count: Column, start: Column) -> Column:
    """Hash of the k-mers that follow ``start``, in text order."""
    below = F.aggregate(
        _steps(),
        F.lit(0),
        lambda n, step: F.when(F.get(sorted_, n + step - F.lit(1)) < start, n + step).otherwise(n),
    )

    def by_position(t: Column) -> Column:
        found = F.get(sorted_, F.pmod(t, count))
        turned = F.shiftleft(_low(found), 64 - POSITION_BITS)
        return turned.bitwiseOR(F.shiftrightunsigned(found, POSITION_BITS))

    chosen = F.sort_array(
        F.transform(F.sequence(below, below + F.least(F.lit(SELECTED), count) - F.lit(1)), by_position)
    )
    # Positions put the list in order; only the hashes are part of the sketch.
    hashes = F.transform(chosen, lambda v: v.bitwiseAND(F.lit((1 << (64 - POSITION_BITS)) - 1)))
    return F.xxhash64(hashes, start)


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the fingerprint of a non-null text column: SKETCHES hashes as hex digits.

    A text without units (empty, or white space only) is hashed as it is.
    """
    others = df.columns
    units = df.withColumn("_units", F.regexp_extract_all(F.col(text), F.lit(UNIT), F.lit(1)))
    kmers = units.withColumn(
        "_sorted",
        F.sort_array(
            F.transform(
                F.slice("_units", F.lit(1), F.greatest(F.size("_units") - F.lit(K - 1), F.lit(1))),
                lambda u, i: _high(
                    F.xxhash64(u, *[F.get("_units", i + F.lit(n)) for n in range(1, K)])
                ).bitwiseOR(i.cast("long")),
            )
        ),
    ).drop("_units")
    numbered = kmers.withColumn(
        "_sorted",
        F.sort_array(F.transform("_sorted", lambda v, i: _numbered(F.col("_sorted"), v, i))),
    ).withColumn("_count", F.size("_sorted"))
    starts = F.transform(F.sequence(F.lit(1), F.lit(SKETCHES)), lambda j: F.xxhash64(j))
    sketches = F.transform(
        starts,
        lambda c: F.when(
            F.col("_count") > 0, _sketch(F.col("_sorted"), F.col("_count"), c)
        ).otherwise(F.xxhash64(F.col(text), c)),
    )
    digits = F.transform(
        sketches, lambda s: F.lpad(F.lower(F.hex(s.bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")
    )
    return numbered.select(*others, F.array_join(digits, "").alias(name))


def likeness(a: str, b: str) -> Column:
    """Share of sketches that agree."""
    places = F.sequence(F.lit(0), F.lit(SKETCHES - 1))
    same = F.filter(
        places,
        lambda n: F.substring(a, n * F.lit(8) + F.lit(1), F.lit(8))
        == F.substring(b, n * F.lit(8) + F.lit(1), F.lit(8)),
    )
    return F.size(same) / F.lit(float(SKETCHES))


def _following(narrow: DataFrame) -> DataFrame:
    """Each row of (doc_id, k1, k2, n_chars, fp) with the next one's k1, k2 and fp; the last gets the first."""
    spark = narrow.sparkSession
    ranged = narrow.repartitionByRange(shuffle_partitions(spark), "doc_id", "k2")
    placed = stage(ranged.withColumn("part", F.spark_partition_id()), "omh-order")
    following = F.struct("doc_id", "k2", "k1", "fp")
    inside = Window.partitionBy("part").orderBy("doc_id", "k2")
    heads = placed.groupBy("part").agg(F.min(following).alias("head"))
    # One row per partition is all that is brought together here.
    across = Window.orderBy("part")
    edges = heads.select(
        "part",
        F.coalesce(
            F.lead("head").over(across),
            F.first("head").over(across.rowsBetween(Window.unboundedPreceding, 0)),
        ).alias("edge"),
    )
    led = placed.withColumn("next", F.lead(following).over(inside))
    return led.join(edges, "part").select(
        "doc_id", "k1", "k2", "n_chars", "fp", F.coalesce("next", "edge").alias("next")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of their edited texts.

    The edited text ends in the beginning of the next document instead of the
    last quarter of its own. Documents follow one another by doc_id, a null
    first, those of one doc_id by a hash of their text; equal rows have the same
    next document, which is another one. A single document is its own next. A
    null text counts as empty. Returns one row per input row with (doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next). Texts may have any length; a run of n characters without a blank gives up to n units.
    Other columns are not read; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    k1, k2 = F.coalesce(doc_id, F.lit(0)), F.xxhash64(doc_id, text)
    base = docs.select(k1.alias("k1"), k2.alias("k2"), text.alias("text"))
    own = docs.select(doc_id.alias("doc_id"), k1.alias("k1"), k2.alias("k2"), text.alias("text"))
    printed = with_fingerprint(own, "text", "fp")
    packed = F.unhex("fp").alias("fp")  # half the size while it travels
    narrow = printed.select("doc_id", "k1", "k2", F.length("text").alias("n_chars"), packed)
    ordered = stage(_following(stage(narrow, "omh").dropDuplicates(["doc_id", "k2"])), "omh-next")

    quarter = F.floor(F.col("n_chars") / F.lit(4)).cast("int")
    wanted = ordered.select(
        F.col("next.k1").alias("k1"),
        F.col("next.k2").alias("k2"),
        F.struct("k1", "k2", "doc_id", "n_chars", "fp", F.col("next.fp").alias("next_fp")).alias("of"),
    )
    heads = base.join(wanted, ["k1", "k2"]).select(
        "of.*", F.substring("text", F.lit(1), F.floor(F.col("of.n_chars") / F.lit(4)).cast("int")).alias("head")
    )
    heads = heads.dropDuplicates(["k1", "k2"])  # a next document that is repeated
    whole = base.join(heads, ["k1", "k2"]).select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.lower(F.hex("fp")).alias("fp"),
        F.lower(F.hex("next_fp")).alias("next_fp"),
        F.concat(F.substring("text", F.lit(1), F.col("n_chars") - quarter), "head").alias("edited"),
    )
    return with_fingerprint(whole, "edited", "edited_fp").select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.col("fp").alias("fingerprint"),
        F.col("edited_fp").alias("edited_fingerprint"),
        likeness("fp", "edited_fp").alias("near_edited"),
        likeness("fp", "next_fp").alias("near_next"),
    )
