"""Packing documents into sequences of a fixed number of tokens.

Bounded-space online best fit: a packer holds a fixed number of open bins in a
bitset keyed by their free space. A piece goes to the open bin that it fills
most; where none has room a new one opens, and at the limit the fullest closes
first. Every scan task packs what it reads as it reads it. What its last open
bins hold is packed again together with that of other tasks, in fewer and
fewer packers, so that half-empty bins remain in the last packer only.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadledger.llm.bpe import Encoder, MergeList
from loadledger.llm.tables import stage

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECE}, bin long, offset long, left_open boolean"
OPEN_BINS = 1024
PART_CHARS = 1 << 17  # text handed to the library at a time, at most twice as much
PACKER_PIECES = 20_000  # pieces of left-over bins that one packer takes on


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: all but the first have ``size``."""
    pieces = -(-n // size)
    first = n - (pieces - 1) * size
    return [(0, first), *((first + k * size, size) for k in range(pieces - 1))] if n else []


class Packer:
    """Open bins of one task. Closed bins are handed to ``close``."""

    def __init__(self, size: int, open_bins: int, close: Callable[[list, bool], None]) -> None:
        self.size, self.limit, self.close = size, open_bins, close
        self.occupied = 0  # bit f: some open bin has f tokens of free space
        self.bins: list[list[list]] = [[] for _ in range(size + 1)]
        self.count = 0

    def add(self, length: int, row: object) -> None:
        """Put a piece into the open bin with the least room that is enough."""
        fitting = self.occupied >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            held = self._take(free)
        else:
            if self.count >= self.limit:  # the lowest bit is the fullest bin
                self.close(self._take((self.occupied & -self.occupied).bit_length() - 1), False)
            free, held = self.size, []
        held.append((row, self.size - free))
        if free == length:
            self.close(held, False)
            return
        self.bins[free - length].append(held)
        self.occupied |= 1 << (free - length)
        self.count += 1

    def _take(self, free: int) -> list:
        held = self.bins[free].pop()
        if not self.bins[free]:
            self.occupied &= ~(1 << free)
        self.count -= 1
        return held

    def finish(self) -> None:
        """Hand over the bins that are still open."""
        while self.occupied:
            self.close(self._take((self.occupied & -self.occupied).bit_length() - 1), True)


def _pack_stream(
    pieces: Iterator[list[tuple]], level: int, size: int, open_bins: int
) -> Iterator[pa.RecordBatch]:
    """Bins of the pieces of one task as rows; a bin's rows leave when it closes."""
    out: list[tuple] = []
    task, number = TaskContext.get().partitionId(), 0
    schema = pa.schema(
        [("doc_id", "int64"), ("piece", "int32"), ("start", "int64"), ("length", "int64")]
        + [("ids_crc32", "int64"), ("bin", "int64"), ("offset", "int64"), ("left_open", "bool")]
    )

    def close(held: list, left_open: bool) -> None:
        nonlocal number
        name = level << 56 | task << 32 | number
        number += 1
        out.extend((*row, name, offset, left_open) for row, offset in held)

    def batch() -> pa.RecordBatch:
        columns = zip(*out) if out else [()] * len(schema)
        arrays = [pa.array(list(c), f.type) for c, f in zip(columns, schema)]
        out.clear()
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    packer = Packer(size, open_bins, close)
    for rows in pieces:
        for row in rows:
            packer.add(row[3], row)
        if len(out) >= 10_000:
            yield batch()
    packer.finish()
    yield batch()


# Fixed value: PRETOKEN for a compiled library, whose possessive repeats do not go back.
COMPILED = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


class LibraryEncoder:
    """Text to packed ids by a compiled library, which gives the same ids.

    A text is handed over in parts that begin at lone blanks between visible
    characters. Where there is none for long, the transducer finds the parts.
    """

    def __init__(self, merges: MergeList) -> None:
        ranks = {merges.bytes_of[i]: i for i in (*merges.byte_id, *merges.made)}
        library = tiktoken.Encoding(
            "merges", pat_str=COMPILED, mergeable_ranks=ranks, special_tokens=merges.special
        )
        self.encode, self.special = library.encode_to_numpy, set(merges.special)
        self.plain = Encoder(merges)

    def blocks(self, texts: Iterable[str]) -> Iterator[tuple[int, bytes]]:
        """Number of a text and packed ids, in order; long texts come in several blocks."""
        for number, text in enumerate(texts):
            yield number, b""
            start = 0
            while start < len(text):
                end = self._boundary(text, start + PART_CHARS)
                if end is None:
                    rest = text[start:]
                    yield from ((number, packed) for _, packed in self.plain.blocks([rest]))
                    break
                ids = self.encode(text[start:end], allowed_special=self.special)
                yield number, ids.astype("<u4", copy=False).tobytes()
                start = end

    @staticmethod
    def _boundary(text: str, at: int) -> int | None:
        """Where the part that goes up to about ``at`` ends; None where there is no sure place."""
        if at >= len(text):
            return len(text)
        stop = min(len(text) - 1, at + PART_CHARS)
        while 0 < (at := text.find(" ", at, stop)):
            if not (text[at - 1].isspace() or text[at + 1].isspace()):
                return at
            at += 1
        return None


@lru_cache(maxsize=2)
def packing_encoder(path: str) -> Encoder | LibraryEncoder:
    """The compiled library where it ranks merges as the list does: by ids that rise with them."""
    merges = MergeList(path)
    rising = merges.made == sorted(merges.made) and max(merges.byte_id) <= merges.made[0]
    plain = not any(" " in name for name in merges.special)
    return LibraryEncoder(merges) if rising and plain else Encoder(merges)


def document_pieces(
    parts: Iterator[pa.RecordBatch], path: str, size: int, end_id: int
) -> Iterator[list[tuple]]:
    """Pieces of (doc_id, text) rows: the tokens of a document and the end token, cut to size."""
    encoder, end = packing_encoder(path), np.array([end_id], "<u4").tobytes()

    def pieces(doc_id: int | None, ids: bytes) -> list[tuple]:
        ids += end
        return [
            (doc_id, n, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]))
            for n, (start, length) in enumerate(cut(len(ids) // 4, size))
        ]

    for part in parts:
        doc_ids = part.column(0).to_pylist()
        held, last = [], 0
        for number, packed in encoder.blocks(t or "" for t in part.column(1).to_pylist()):
            if number != last:
                yield pieces(doc_ids[last], b"".join(held))
                held, last = [], number
            held.append(packed)
        if doc_ids:
            yield pieces(doc_ids[last], b"".join(held))


def pack_documents(
    docs: DataFrame, path: str, size: int = 2048, end_id: int = 0, open_bins: int = OPEN_BINS
) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    Every row of ``docs`` is packed, repeated ones each on their own; a null or
    empty text is the end token alone, a null doc_id stays null. Other columns
    are not read. An empty table gives no rows. Which sequence holds a piece
    depends on how the input is split into tasks, the pieces do not.
    """
    spark = docs.sparkSession

    def first(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _pack_stream(document_pieces(parts, path, size, end_id), 0, size, open_bins)

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    done = stage(narrow.mapInArrow(first, PACKED), "packing")
    levels = [done]
    level, packers = 1, None
    while packers != 1:
        left = levels[-1].filter("left_open")
        n = max(1, -(-left.count() // PACKER_PIECES))
        packers = n if packers is None else max(1, min(n, packers // 2))
        levels[-1] = levels[-1].filter("NOT left_open")
        levels.append(_repack(spark, left, level, packers, size, open_bins))
        level += 1
    rows = levels[0]
    for more in levels[1:]:
        rows = rows.unionByName(more)
    return rows.select(
        *[c.split()[0] for c in PIECE.split(", ")],
        F.col("bin").alias("sequence_id"),
        "offset",
    )


def _repack(
    spark: SparkSession, left: DataFrame, level: int, packers: int, size: int, open_bins: int
) -> DataFrame:
    """Pack the pieces of left-over bins again; a fixed order keeps reruns alike."""

    def again(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (list(zip(*(c.to_pylist() for c in p.columns))) for p in parts)
        return _pack_stream(rows, level, size, open_bins)

    names = [c.split()[0] for c in PIECE.split(", ")]
    mixed = F.xxhash64("doc_id", "piece", "bin")
    dealt = left.repartition(packers, mixed)
    # The longest pieces first; small ones then fill what those leave.
    ordered = dealt.sortWithinPartitions(F.desc("length"), "doc_id", "piece", "bin", "offset")
    return stage(ordered.select(*names).mapInArrow(again, PACKED), "packing")
