"""Near copies by MinHash, with sequential Bayesian verification.

Texts with the same words collapse to one node first. Signatures are cut into
bands; nodes that agree in a band are candidates. Their signatures are compared
in batches: given m matches among n hashes, the posterior probability that the
similarity reaches the threshold is a binomial tail, and a pair is dropped as
soon as that falls below the chosen miss probability. What survives is compared
on full shingle sets, so every link is exact.

A bucket with many nodes is not compared pair by pair. Its nodes are compared
with the least of them; only where the bucket then still holds nodes of several
components are those outside its largest one compared with all others, in
blocks that fit one task. Pairs within one component need no link of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadledger.llm.components import components
from loadledger.llm.tables import stage

HASHES = 128
MISS = 1e-6
BATCH = 16  # hashes compared before a pair is judged again
BLOCK = 512  # nodes of a bucket that one block holds
WORD_CACHE = 200_000
_CHUNK = 4096
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))
SIGNED = "doc_id long, row_key long, node binary, n_shingles long, bands array<long>, sig binary"


def rows_per_band(percent: int, hashes: int = HASHES, miss: float = MISS) -> int:
    """Most rows with which a pair at the threshold still meets in some band, but for ``miss``."""
    fits = [r for r in range(1, hashes + 1) if (1 - (percent / 100) ** r) ** (hashes // r) <= miss]
    return max(fits, default=1)


def least_matches(n: int, percent: int, miss: float = MISS) -> int:
    """Fewest matches among ``n`` hashes that leave a pair a posterior above ``miss``.

    With a uniform prior the similarity is Beta(m + 1, n - m + 1) after m
    matches; that it reaches t is as likely as at most m successes in n + 1.
    """
    t, below = percent / 100, 0.0
    for m in range(n + 1):
        below += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        if below >= miss:
            return m
    return n


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_words = _Words()


def words_of(text: str | None) -> list[bytes]:
    """Words in lower case (A-Z only), cut at ASCII white space."""
    return (text or "").encode().lower().split()


def shingle_set(words: list[bytes], length: int) -> np.ndarray:
    """Sorted hashes of the distinct runs of ``length`` words; of all words if there are fewer."""
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < length:
        whole = xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))
        return np.array([whole], np.uint64)
    ids = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    n = len(words) - length + 1
    mixed = np.zeros(n, np.uint64)
    for k in range(length):
        mixed = (mixed ^ ids[k : k + n]) * _MIX[0]
        mixed ^= mixed >> np.uint64(29)
    mixed *= _MIX[1]
    return np.unique(mixed ^ (mixed >> np.uint64(32)))


def _coefficients(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    odd = rng.integers(0, 1 << 32, hashes, dtype=np.uint32) | np.uint32(1)
    return odd[:, None], rng.integers(0, 1 << 32, hashes, dtype=np.uint32)[:, None]


def signature(shingles: np.ndarray, odd: np.ndarray, add: np.ndarray) -> np.ndarray:
    """Least value of each hash function over a non-empty set."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(odd), 0xFFFFFFFF, np.uint32)
    for start in range(0, len(short), _CHUNK):
        values = short[None, start : start + _CHUNK] * odd
        values += add
        np.minimum(best, values.min(1), out=best)
    return best


def band_keys(sig: np.ndarray, rows: int) -> list[int]:
    """A signed 64-bit key per band."""
    data = sig.tobytes()
    step = 4 * rows
    keys = [
        xxhash.xxh3_64_intdigest(data[n * step : (n + 1) * step], seed=n + 1)
        for n in range(len(sig) // rows)
    ]
    return [k - (1 << 64) if k >> 63 else k for k in keys]


def row_key() -> Column:
    """Tells rows of ``documents`` apart; equal doc_id and text give equal keys."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def signed_documents(docs: DataFrame, length: int, percent: int, hashes: int = HASHES) -> DataFrame:
    """Node, set size, band keys and signature of every document. No words: no node."""
    rows = rows_per_band(percent, hashes)

    def sign(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd, add = _coefficients(hashes)
        for part in parts:
            for start in range(0, len(part), 1000):
                ids, keys, texts = (c.slice(start, 1000) for c in part.columns)
                nodes, sizes, bands, sigs = [], [], [], []
                for text in texts:
                    words = words_of(text.as_py())
                    found = shingle_set(words, length)
                    sizes.append(len(found))
                    if not len(found):
                        nodes.append(None), bands.append(None), sigs.append(None)
                        continue
                    sig = signature(found, odd, add)
                    nodes.append(xxhash.xxh3_128_digest(b" ".join(words)))
                    bands.append(band_keys(sig, rows))
                    sigs.append(sig.astype(np.uint16).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        keys,
                        pa.array(nodes, "binary"),
                        pa.array(sizes, "int64"),
                        pa.array(bands, pa.list_(pa.int64())),
                        pa.array(sigs, "binary"),
                    ],
                    ["doc_id", "row_key", "node", "n_shingles", "bands", "sig"],
                )

    text = F.col("text").cast("string")
    narrow = docs.select(F.col("doc_id").cast("long"), row_key().alias("row_key"), text)
    return narrow.mapInArrow(sign, SIGNED)


def surviving(
    a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, percent: int, miss: float
) -> np.ndarray:
    """Indices of the pairs (rows of a and b) that no batch of hashes rules out."""
    least = np.minimum(size_a, size_b) * 100 >= np.maximum(size_a, size_b) * percent
    alive = np.flatnonzero(least)
    matches = np.zeros(len(alive), np.int64)
    for start in range(0, a.shape[1], BATCH):
        if not len(alive):
            break
        stop = min(start + BATCH, a.shape[1])
        matches += (a[alive, start:stop] == b[alive, start:stop]).sum(1)
        keep = matches >= least_matches(stop, percent, miss)
        alive, matches = alive[keep], matches[keep]
    return alive


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), -1)


def plausible_pairs(pairs: DataFrame, nodes: DataFrame, percent: int, miss: float) -> DataFrame:
    """The pairs (u, v) of nodes that sequential verification lets through."""

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if not len(part):
                continue
            sizes = part.column("size_u").to_numpy(), part.column("size_v").to_numpy()
            kept = surviving(_matrix(part.column("sig_u")), _matrix(part.column("sig_v")), *sizes, percent, miss)
            yield part.select(["u", "v"]).take(pa.array(kept))

    own = nodes.select("node", "n_shingles", "sig")
    left = own.select(F.col("node").alias("u"), F.col("n_shingles").alias("size_u"), F.col("sig").alias("sig_u"))
    right = own.select(F.col("node").alias("v"), F.col("n_shingles").alias("size_v"), F.col("sig").alias("sig_v"))
    met = pairs.join(left, "u").join(right, "v").select("u", "v", "size_u", "size_v", "sig_u", "sig_v")
    return met.mapInArrow(compare, "u binary, v binary")


def node_texts(chosen: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, text) of the nodes in ``chosen``: the text of one of their documents."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("key")
    reps = nodes.select("node", F.col("rep").alias("doc_id")).join(chosen, "node", "left_semi")
    texts = docs.select(key, F.col("text").cast("string")).join(reps.select("node", key), "key")

    def own(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Without texts of another node, where a doc_id is repeated."""
        for part in parts:
            pairs = zip(part.column(0), part.column(1))
            same = [xxhash.xxh3_128_digest(b" ".join(words_of(t.as_py()))) == n.as_py() for n, t in pairs]
            yield part.filter(pa.array(same, pa.bool_()))

    texts = texts.select("node", "text").mapInArrow(own, "node binary, text string")
    return stage(texts.dropDuplicates(["node"]), "near-texts")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def exact_links(
    pairs: DataFrame, nodes: DataFrame, docs: DataFrame, length: int, percent: int
) -> DataFrame:
    """The pairs (u, v) whose full shingle sets reach the threshold."""
    texts = node_texts(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct(), nodes, docs)

    def verify(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[bytes, np.ndarray] = {}

        def set_of(node: bytes, text: pa.StringScalar) -> np.ndarray:
            if node not in sets:
                if len(sets) >= 64:
                    sets.pop(next(iter(sets)))
                sets[node] = shingle_set(words_of(text.as_py()), length)
            return sets[node]

        for part in parts:
            kept = []
            for n, (u, v) in enumerate(zip(part.column("u").to_pylist(), part.column("v").to_pylist())):
                if similar(set_of(u, part.column("text_u")[n]), set_of(v, part.column("text_v")[n]), percent):
                    kept.append(n)
            yield part.select(["u", "v"]).take(pa.array(kept, pa.int64()))

    both = pairs.join(texts.select(F.col("node").alias("u"), F.col("text").alias("text_u")), "u")
    both = both.join(texts.select(F.col("node").alias("v"), F.col("text").alias("text_v")), "v")
    return both.select("u", "v", "text_u", "text_v").mapInArrow(verify, "u binary, v binary")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _rooted(df: DataFrame, roots: DataFrame, column: str, name: str) -> DataFrame:
    """Add the component of a node column; a node without links is its own."""
    found = roots.select(F.col("node").alias(column), F.col("root").alias("_root"))
    joined = df.join(found, column, "left").withColumn(name, F.coalesce("_root", column))
    return joined.drop("_root")


BLOCK_ROW = "band long, i long, j long, node binary, comp binary, rest boolean, n_shingles long, bands array<long>, sig binary"


class _Block:
    """Rows of one block of a bucket: nodes outside its largest component, and those they face."""

    def __init__(self, table: pa.Table) -> None:
        self.band = table.column("band")[0].as_py()
        self.rest = np.asarray(table.column("rest").to_pylist(), bool)
        self.node = table.column("node").to_pylist()
        self.size = table.column("n_shingles").to_numpy()
        bands = table.column("bands").combine_chunks().flatten().to_numpy()
        self.bands = bands.reshape(len(self.node), -1)
        self.sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint16).reshape(len(self.node), -1)
        numbers: dict[bytes, int] = {}
        comps = table.column("comp").to_pylist()
        self.comp = np.array([numbers.setdefault(c, len(numbers)) for c in comps])

    def plausible(self, percent: int, miss: float) -> Iterator[tuple[int, np.ndarray]]:
        """Each node outside and the rows it faces that no batch of hashes rules out.

        A pair that shares several bands is looked at in the first of them only.
        The components may change between two nodes.
        """
        others = np.flatnonzero(~self.rest)
        for one in np.flatnonzero(self.rest):
            facing = others[self.comp[others] != self.comp[one]]
            first = (self.bands[facing] == self.bands[one]).argmax(1)
            facing = facing[self.bands[one, first] == self.band] if len(facing) else facing
            own = np.full(len(facing), one)
            kept = surviving(self.sig[own], self.sig[facing], self.size[own], self.size[facing], percent, miss)
            if len(kept):
                yield one, facing[kept]


def links_across(
    members: DataFrame,
    roots: DataFrame,
    nodes: DataFrame,
    docs: DataFrame,
    length: int,
    percent: int,
    miss: float,
) -> DataFrame:
    """Links (u, v) between different components within a bucket.

    Signatures are compared in blocks first, and only nodes with a plausible
    partner go on, with their texts, to the exact comparison in the same blocks.
    Neither step gives out pairs: the first gives nodes, the second links that
    join components, of which a block has fewer than nodes.
    """
    placed = _rooted(members, roots, "node", "comp")
    parts = placed.groupBy("band", "comp").agg(F.count(F.lit(1)).alias("c"))
    buckets = parts.groupBy("band").agg(
        F.sum("c").alias("n"),
        F.count(F.lit(1)).alias("comps"),
        F.max(F.struct("c", "comp")).alias("main"),
    )
    buckets = buckets.filter("comps > 1").select(
        "band",
        F.col("main.comp").alias("main"),
        F.ceil(F.col("n") / BLOCK).alias("all_blocks"),
        F.ceil((F.col("n") - F.col("main.c")) / BLOCK).alias("rest_blocks"),
    )
    rows = placed.join(buckets, "band").select("*", (F.col("comp") != F.col("main")).alias("outside"))

    def dealt(df: DataFrame, i: Column, j: Column, rest: bool) -> DataFrame:
        out = df.withColumn("i", i).withColumn("j", j)
        return out.select("band", "i", "j", "node", "comp", F.lit(rest).alias("rest"))

    def spread(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1).cast("array<long>"))

    every = dealt(rows, spread("rest_blocks"), F.pmod(F.xxhash64("node"), "all_blocks"), False)
    outside = rows.filter("outside")
    rest = dealt(outside, F.pmod(F.xxhash64("node", F.lit(1)), "rest_blocks"), spread("all_blocks"), True)
    own = nodes.select("node", "n_shingles", "bands", "sig")
    blocks = every.unionByName(rest).join(own, "node")

    def promising(table: pa.Table) -> pa.Table:
        block = _Block(table)
        touched = np.zeros(len(block.node), bool)
        for one, facing in block.plausible(percent, miss):
            touched[one] = True
            touched[facing] = True
        return table.filter(pa.array(touched))

    names = [c.split()[0] for c in BLOCK_ROW.split(", ")]
    keys = names[:3]
    due = blocks.select(*names).groupBy(*keys).applyInArrow(promising, BLOCK_ROW)
    due = stage(due, "near-across")
    texts = node_texts(due.select("node").distinct(), nodes, docs)

    def verify(table: pa.Table) -> pa.Table:
        block = _Block(table)
        sets: dict[int, np.ndarray] = {}

        def set_of(row: int) -> np.ndarray:
            if row not in sets:
                sets[row] = shingle_set(words_of(table.column("text")[row].as_py()), length)
            return sets[row]

        u, v = [], []
        for one, facing in block.plausible(percent, miss):
            for other in facing:
                if block.comp[other] != block.comp[one] and similar(set_of(one), set_of(other), percent):
                    u.append(block.node[one])
                    v.append(block.node[other])
                    block.comp[block.comp == block.comp[other]] = block.comp[one]
        return pa.table({"u": pa.array(u, "binary"), "v": pa.array(v, "binary")})

    met = due.join(texts, "node").select(*names, "text")
    return met.groupBy(*keys).applyInArrow(verify, "u binary, v binary")


def near_copies(
    docs: DataFrame, length: int = 5, percent: int = 80, hashes: int = HASHES, miss: float = MISS
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, row_key, group) per document.

    ``group`` tells components apart, ``row_key`` rows of one doc_id.

    ``length`` words make a shingle; documents are linked when their sets of
    shingles share ``percent`` of their union or more. Every row gets a result
    row, repeated ones too. A null, empty or blank text has no shingles, no
    links, and its own doc_id as component. Null doc_ids count in no minimum: a
    group of nothing else has a null component. ``kept`` says that doc_id and
    component are the same. A text of any length counts as a whole; an empty table gives
    no rows. Other columns are not read.
    """
    signed = stage(signed_documents(docs, length, percent, hashes), "near-signed")
    worded = signed.filter("node IS NOT NULL")
    first = [F.first(c).alias(c) for c in ("n_shingles", "bands", "sig")]
    nodes = stage(worded.groupBy("node").agg(F.min("doc_id").alias("rep"), *first), "near-nodes")

    bands = nodes.select("node", F.explode("bands").alias("band"))
    buckets = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("center"))
    members = stage(bands.join(buckets.filter("n > 1"), "band"), "near-members")
    stars = _ordered(members.select(F.col("node").alias("u"), F.col("center").alias("v")).filter("u <> v"))
    tried = stage(plausible_pairs(stars, nodes, percent, miss), "near-tried")
    links = stage(exact_links(tried, nodes, docs, length, percent), "near-links")
    roots = components(links)

    # A bucket of two has had its only pair compared.
    mixed = members.filter("n > 2").select("band", "node")
    more = links_across(mixed, roots, nodes, docs, length, percent, miss)
    bridges = _rooted(_rooted(more, roots, "u", "a"), roots, "v", "b")
    joined = components(bridges.select(F.col("a").alias("u"), F.col("b").alias("v")))

    placed = _rooted(_rooted(nodes.select("node", "rep"), roots, "node", "comp"), joined, "comp", "final")
    least = placed.groupBy("final").agg(F.min("rep").alias("component_id"))
    named = placed.join(least, "final").select("node", "component_id", F.col("final").alias("group"))
    out = signed.select("doc_id", "row_key", "node", "n_shingles").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        "row_key",
        "group",
    )


def without_near_copies(
    docs: DataFrame, length: int = 5, percent: int = 80, hashes: int = HASHES, miss: float = MISS
) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group of near copies, as it was.

    That is the row with the group's least doc_id; of several such rows the one
    with the least key. Rows without words are in no group and all stay, but a
    row repeated in doc_id and text stays once.
    """
    judged = near_copies(docs, length, percent, hashes, miss).filter("kept")
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(0))
    rows = F.min(F.struct("row_key", "doc_id")).alias("first")
    grouped = judged.filter("n_shingles > 0").groupBy("group").agg(rows).select("first.doc_id", "first.row_key")
    single = judged.filter("n_shingles = 0").select("doc_id", "row_key").distinct()
    stay = grouped.unionByName(single).select(key.alias("_id"), F.col("row_key").alias("_key"))
    wrapped = docs.select(F.struct(*docs.columns).alias("row"), key.alias("_id"), row_key().alias("_key"))
    # The join leaves rows sorted by both keys, so this window costs no shuffle.
    again = Window.partitionBy("_id", "_key").orderBy("_key")
    found = wrapped.join(stay, ["_id", "_key"]).withColumn("_n", F.row_number().over(again))
    return found.filter("_n = 1").select("row.*")
