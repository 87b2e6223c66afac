"""Nearest neighbours by inner product with multiprobe p-stable hashing.

Vectors get one more coordinate so that all have the same length; the largest
inner product is then the least distance. Each table projects a vector on a few
Gaussian directions and cuts these into cells; the cells together are its
bucket. A query visits its own bucket and perturbed ones, in the order of how
likely they hold a neighbour: the sum of squared distances to the cells' borders.
Candidates of all tables are merged and ranked by the exact product.

Equal vectors are one point with many ids, of which a search needs the least
k + 1 only, so copies cost nothing. The number of probes comes from a sample
of queries whose true neighbours are found by brute force.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadledger.llm.tables import shuffle_partitions, stage

TABLES = 6
CELL = 2.0  # width of a cell in standard deviations of a projection
TARGET = 0.95  # share of the sample's neighbours that the probes must reach
SAMPLE = 64  # queries that the number of probes is set on
MOST_PROBES = 20_000
# Points that one part of a table holds, in numbers of their vectors. A query gets
# its best from each part that it visits, so larger parts give fewer rows to merge.
PART_VALUES = 1 << 22
PART_QUERIES = 8192  # queries that one task answers
SPARE = 4  # candidates kept beyond k for exact ranking


def projections_for(n: int) -> int:
    """Directions per table, with the logarithm of the number of points."""
    return int(np.clip(round(0.65 * np.log2(max(n, 1) / 100)), 2, 20)) if n > 100 else 2


@dataclass
class Hashes:
    """The p-stable functions of all tables."""

    directions: np.ndarray  # tables, coordinates + 1, projections
    shifts: np.ndarray  # tables, projections
    length: float  # the greatest norm, and that of every lengthened vector

    @staticmethod
    def drawn(dims: int, count: int, length: float, tables: int = TABLES) -> Hashes:
        rng = np.random.default_rng(17)
        directions = rng.normal(size=(tables, dims + 1, count))
        return Hashes(directions, rng.uniform(0, 1, (tables, count)), length)

    def places(self, x: np.ndarray, queries: bool) -> np.ndarray:
        """Position of each vector along each direction, in cells: rows, tables, projections."""
        rest = np.zeros(len(x)) if queries else np.sqrt(np.maximum(self.length**2 - (x * x).sum(1), 0))
        if queries:  # only a query's direction counts
            x = x * (self.length / np.linalg.norm(x, axis=1, keepdims=True))
        longer = np.concatenate([x, rest[:, None]], 1)
        return np.einsum("nd,tdk->ntk", longer, self.directions) / (CELL * self.length) + self.shifts


def probe_order(place: np.ndarray) -> Iterator[tuple[int, ...]]:
    """Buckets around a position, the likeliest first, without end.

    A step of j cells along one direction costs the squared distance to the
    border that it crosses last; costs add up over directions.
    """
    home = np.floor(place).astype(np.int64)
    inside = place - home
    steps = []  # per direction, its own cell first, then others by their cost
    for own in inside:
        near = [(0.0, 0)]
        for j in range(1, 9):
            near += [((j - 1 + (1 - own)) ** 2, j), ((j - 1 + own) ** 2, -j)]
        steps.append(sorted(near, key=lambda step: (step[0], abs(step[1]))))
    start = (0,) * len(steps)
    heap, seen = [(0.0, start)], {start}
    while heap:
        cost, at = heapq.heappop(heap)
        yield tuple(int(home[d] + steps[d][i][1]) for d, i in enumerate(at))
        for d, i in enumerate(at):
            if i + 1 < len(steps[d]):
                after = (*at[:d], i + 1, *at[d + 1 :])
                if after not in seen:
                    seen.add(after)
                    heapq.heappush(heap, (cost - steps[d][i][0] + steps[d][i + 1][0], after))


def _keys(cells: Iterable[Iterable[int]]) -> pa.Array:
    """Buckets as 64-bit keys. Two that share a key would be searched together, no more."""
    data = (np.array(c, np.int64).tobytes() for c in cells)
    return pa.array(np.array([xxhash.xxh3_64_intdigest(d) for d in data], np.uint64).view(np.int64))


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def usable(table: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, embedding) rows that take part: finite and not zero."""
    v = F.col("embedding")
    sound = (
        v.isNotNull()
        & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    own = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))
    return own.filter("vec_id IS NOT NULL").filter(F.coalesce(sound, F.lit(False)))


def _points(rows: DataFrame, keep: int) -> DataFrame:
    """(point, embedding, ids): equal vectors once, with their least ids."""
    ranked = rows.distinct().withColumn(
        "rank", F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    )
    groups = ranked.filter(F.col("rank") <= keep).groupBy("embedding")
    points = groups.agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    name = F.concat_ws(":", F.col("ids")[0], F.xxhash64("embedding"))
    return points.select(name.alias("point"), "embedding", "ids")


def _least_id(point: str) -> int:
    return int(point.partition(":")[0])


def _best(scores: np.ndarray, keep: int) -> np.ndarray:
    """Columns of the ``keep`` greatest scores in each row, the first ones among equals."""
    if scores.shape[1] <= keep:
        return np.tile(np.arange(scores.shape[1]), (len(scores), 1))
    last = -np.partition(-scores, keep - 1, 1)[:, keep - 1 : keep]
    above, level = scores > last, scores == last
    taken = above | (level & (np.cumsum(level, 1) <= keep - above.sum(1, keepdims=True)))
    return np.nonzero(taken)[1].reshape(len(scores), keep)


def _exact(query: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Products of one query with several points; the same whatever stands beside them."""
    return (points * query).sum(1)


def _calibrated(points: DataFrame, queries: DataFrame, hashes: Hashes, k: int) -> int:
    """Probes per table that reach TARGET of the true neighbours of sampled queries.

    0 where MOST_PROBES would not: then no number of probes is worth its visits.
    """
    sample = queries.orderBy(F.xxhash64("point"), "point").limit(SAMPLE)
    rows = sample.select("point", "embedding").collect()
    if not rows:
        return 1
    asked = np.array([r["embedding"] for r in rows], np.float64)
    names = [r["point"] for r in rows]

    def nearest(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if not len(part):
                continue
            x, own = _vectors(part.column(1)), part.column(0).to_pylist()
            products = asked @ x.T
            place = {name: n for n, name in enumerate(own)}
            for n, name in enumerate(names):
                if name in place:
                    products[n, place[name]] = -np.inf
            best = _best(products, k)
            which, score = np.repeat(np.arange(len(names)), best.shape[1]), np.take_along_axis(products, best, 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(which), pa.array(score.ravel()), part.column(1).take(pa.array(best.ravel()))],
                ["asked", "score", "embedding"],
            )

    kind = points.schema["embedding"].dataType.simpleString()
    found = points.select("point", "embedding").mapInArrow(nearest, f"asked long, score double, embedding {kind}")
    order = Window.partitionBy("asked").orderBy(F.desc("score"))
    near = found.filter("score > '-Infinity'").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).collect()
    if not near:
        return 1
    cells = np.floor(hashes.places(np.array([r["embedding"] for r in near], np.float64), False)).astype(np.int64)
    starts = hashes.places(asked, True)
    never = np.iinfo(np.int64).max
    first = np.full(len(near), never)
    by_query: dict[int, list[int]] = {}
    for n, r in enumerate(near):
        by_query.setdefault(r["asked"], []).append(n)
    for query, own in by_query.items():
        for t in range(len(hashes.directions)):
            wanted: dict[tuple, list[int]] = {}
            for n in own:
                wanted.setdefault(tuple(cells[n, t].tolist()), []).append(n)
            for rank, bucket in enumerate(probe_order(starts[query, t])):
                for n in wanted.pop(bucket, ()):
                    first[n] = min(first[n], rank)
                # Later probes matter only while some neighbour is not yet reached sooner.
                if not wanted or rank >= max(first[n] for n in own) or rank >= MOST_PROBES:
                    break
    needed = int(np.quantile(first, TARGET, method="higher"))
    return needed + 1 if needed < MOST_PROBES else 0


RESULT = "query_id long, rank int, vec_id long, score double"


def search(
    table: DataFrame, every: int = 20, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of each query, nearest first.

    Queries are the rows whose id is divisible by ``every``; a query's own id is
    no candidate. Ties go to the smaller id. Rows that are equal in id and vector
    count once; an id with several vectors is a candidate with each, and such a
    query is answered for its least point. Null ids, and vectors that are null,
    zero or not finite, take no part. Vectors of different lengths have no product; a query's
    candidates are those of its own length. A query whose probes found fewer than
    ``k`` is compared with all vectors, as are all queries where no
    reasonable number of probes would do. Other columns are not read. An empty table
    gives no rows.
    """
    rows = usable(table, vec_id, embedding)
    sizes = [r[0] for r in rows.select(F.size("embedding")).distinct().collect()]
    asks = F.col("vec_id") % every == 0
    if len(sizes) > 1:  # an id with vectors of several lengths asks with the shortest
        shortest = F.min(F.size("embedding")).over(Window.partitionBy("vec_id"))
        asks = asks & (F.size("embedding") == shortest)
    rows = rows.withColumn("asks", asks)
    parts = [_search(rows.filter(F.size("embedding") == size), k) for size in sorted(sizes)]
    found = parts[0] if parts else table.sparkSession.createDataFrame([], RESULT)
    for more in parts[1:]:
        found = found.unionByName(more)
    return found


def _search(rows: DataFrame, k: int) -> DataFrame:
    """``search`` among vectors of one length; ``asks`` marks the queries."""
    spark = rows.sparkSession
    asking, rows = rows.filter("asks").drop("asks"), rows.drop("asks")
    points = stage(_points(rows, k + 1), "ann-points")
    asking = stage(
        asking.distinct().join(points.select("point", "embedding"), "embedding")
        .groupBy("vec_id").agg(F.min(F.struct("point", "embedding")).alias("p"))
        .select(F.col("vec_id").alias("query_id"), "p.point", "p.embedding"),
        "ann-asking",
    )
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    facts = points.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("ids")).alias("ids"), F.max(norm).alias("length"), F.max(F.size("embedding")).alias("dims")).first()
    if not facts["n"]:
        return spark.createDataFrame([], RESULT)
    queries = asking.groupBy("point").agg(F.first("embedding").alias("embedding"))
    queries = stage(queries, "ann-queries")
    hashes = Hashes.drawn(facts["dims"], projections_for(facts["n"]), facts["length"])
    probes = _calibrated(points, queries, hashes, k)

    def cells(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if not len(part):
                continue
            found = np.floor(hashes.places(_vectors(part.column(1)), False)).astype(np.int64)
            for t in range(found.shape[1]):
                keys = _keys(found[:, t])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.full(len(part), t, np.int32)), keys], ["point", "table", "bucket"]
                )

    def visits(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for n in range(len(part)):
                own = part.slice(n, 1)
                starts = hashes.places(_vectors(own.column(1)), True)[0]
                for t, start in enumerate(starts):
                    keys = _keys(islice(probe_order(start), probes))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([own.column(0)[0].as_py()] * len(keys)), pa.array(np.full(len(keys), t, np.int32)), keys],
                        ["point", "table", "bucket"],
                    )

    placed = stage(
        points.select("point", "embedding").mapInArrow(cells, "point string, table int, bucket long"), "ann-cells"
    )
    buckets = placed.groupBy("table", "bucket").agg(F.count(F.lit(1)).alias("n"))
    part_rows = max(1, PART_VALUES // facts["dims"])
    parts_ = max(1, -(-facts["n"] // part_rows))
    # A bucket is dealt to one part of its table, a large one to several.
    buckets = stage(buckets.select("table", "bucket", F.ceil(F.col("n") / part_rows).alias("blocks")), "ann-buckets")
    part_of = F.pmod(F.xxhash64("table", "bucket", "block"), F.lit(parts_))
    dealt = placed.join(buckets, ["table", "bucket"]).withColumn("block", F.pmod(F.xxhash64("point"), "blocks"))
    dealt = dealt.select("table", part_of.alias("part"), "point", "bucket")

    # What a query visits is much more than the query: queries are dealt out evenly first.
    even = queries.repartition(shuffle_partitions(spark), F.xxhash64("point"))
    wanted = even.mapInArrow(visits, "point string, table int, bucket long").join(buckets, ["table", "bucket"])
    wanted = wanted.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1).cast("array<long>")))
    wanted = wanted.select("point", "table", part_of.alias("part"), "bucket").distinct()
    wanted = stage(wanted.groupBy("table", "part", "point").agg(F.collect_list("bucket").alias("buckets")), "ann-visits")
    keep = k + 1 + SPARE

    def answer(held: pa.Table, asked: pa.Table) -> pa.Table:
        # By least id, so that the first of several points with the same score is the one to keep.
        points_held = held.column("point").to_pylist()
        held = held.take(sorted(range(len(points_held)), key=lambda n: (_least_id(points_held[n]), points_held[n])))
        names, x = np.array(held.column("point").to_pylist(), object), _vectors(held.column("embedding").combine_chunks())
        where: dict[int, list[int]] = {}
        for n, bucket in enumerate(held.column("bucket").to_pylist()):
            where.setdefault(bucket, []).append(n)
        q = _vectors(asked.column("embedding").combine_chunks())
        visitors: dict[int, list[int]] = {}
        for n, own in enumerate(asked.column("buckets").to_pylist()):
            for bucket in own:
                if bucket in where:
                    visitors.setdefault(bucket, []).append(n)
        found: list[list[np.ndarray]] = [[] for _ in range(len(q))]
        for bucket, who in visitors.items():
            members = np.array(where[bucket])
            for first in range(0, len(who), 1024):
                some = who[first : first + 1024]
                products = q[some] @ x[members].T
                best = _best(products, keep)
                score = np.take_along_axis(products, best, 1)
                for n, row, own in zip(some, members[best], score):
                    found[n].append(np.stack([own, row]))
        queries_, points_, scores_ = [], [], []
        asked_names = asked.column("point").to_pylist()
        for n, parts in enumerate(found):
            if not parts:
                continue
            both = np.concatenate(parts, 1)
            order = np.lexsort((both[1], -both[0]))[:keep]
            rows_ = both[1, order].astype(np.int64)
            queries_ += [asked_names[n]] * len(rows_)
            points_ += names[rows_].tolist()
            scores_ += _exact(q[n], x[rows_]).tolist()
        return pa.table({"query": pa.array(queries_, "string"), "point": pa.array(points_, "string"), "score": pa.array(scores_, "float64")})

    keys = ["table", "part", "share"]

    def met(dealt: DataFrame, wanted: DataFrame) -> DataFrame:
        """(query, point, score) of the best that queries find in the parts they visit."""
        loads = wanted.groupBy("table", "part").agg(F.ceil(F.count(F.lit(1)) / PART_QUERIES).alias("shares"))
        left = dealt.join(loads, ["table", "part"]).join(points.select("point", "embedding"), "point")
        left = left.withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1).cast("array<long>")))
        right = wanted.join(loads, ["table", "part"]).join(queries, "point")
        right = right.withColumn("share", F.pmod(F.xxhash64("point"), "shares"))
        left = left.select(*keys, "point", "bucket", "embedding")
        right = right.select(*keys, "point", "buckets", "embedding")
        both = left.groupBy(*keys).cogroup(right.groupBy(*keys))
        return both.applyInArrow(answer, "query string, point string, score double")

    least = F.substring_index("point", ":", 1).cast("long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), least, F.col("point"))

    def near(found: DataFrame) -> DataFrame:
        """(query, score, vec_id): points become ids, least first; one more than k, as a query's own id goes."""
        merged = found.groupBy("query", "point").agg(F.max("score").alias("score"))
        merged = merged.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= keep).drop("n")
        ids = merged.join(points.select("point", "ids"), "point").select("query", "score", F.explode("ids").alias("vec_id"))
        by_id = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
        best = ids.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
        return best.withColumn("n", F.row_number().over(by_id)).filter(F.col("n") <= k + 1).drop("n")

    # Where every vector is one bucket, a visit to all of its parts is an exact search, in blocks.
    all_dealt = points.select(
        F.lit(0).alias("table"), F.pmod(F.xxhash64("point"), F.lit(parts_)).alias("part"), "point",
        F.lit(0).cast("long").alias("bucket"),
    )

    def compared(some: DataFrame) -> DataFrame:
        every_part = F.explode(F.sequence(F.lit(0), F.lit(parts_ - 1)).cast("array<long>")).alias("part")
        visiting = some.select("point", F.lit(0).alias("table"), every_part, F.array(F.lit(0).cast("long")).alias("buckets"))
        return near(met(all_dealt, visiting))

    if probes:
        probed = stage(near(met(dealt, wanted)), "ann-near")
        enough = probed.groupBy("query").count().filter(F.col("count") >= min(k + 1, facts["ids"]))
        short = stage(queries.join(enough, queries["point"] == enough["query"], "left_anti").select("point"), "ann-short")
        if not short.isEmpty():
            probed = probed.join(short, probed["query"] == short["point"], "left_anti").unionByName(compared(short))
    else:
        probed = compared(queries.select("point"))
    out = asking.select("query_id", F.col("point").alias("query")).join(probed, "query").filter("vec_id <> query_id")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = out.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")
