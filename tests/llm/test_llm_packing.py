from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from helpers import documents, prose
from tokenizers import Tokenizer

from loadledger.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def bins_of(lengths, size, limit):
    closed = []
    packer = packing.Packer(size, limit, lambda held, left: closed.append((held, left)))
    for n, length in enumerate(lengths):
        packer.add(length, n)
        assert packer.count <= limit
    packer.finish()
    assert packer.count == 0 and packer.occupied == 0
    return closed


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=60), st.integers(1, 8))
def test_bins_hold_every_piece_once_without_gaps(lengths, limit):
    seen = []
    for held, _ in bins_of(lengths, 32, limit):
        at = 0
        for row, offset in held:
            assert offset == at
            at += lengths[row]
            seen.append(row)
        assert at <= 32
    assert sorted(seen) == list(range(len(lengths)))


def test_best_fit_and_fullest_first():
    # 20 and 12 fill a bin; 25 leaves least room for 7
    closed = bins_of([20, 25, 12, 7], 32, 8)
    assert [[r for r, _ in held] for held, _ in closed] == [[0, 2], [1, 3]]
    # with two open bins the fuller one makes room
    closed = bins_of([20, 25, 30], 32, 2)
    assert [([r for r, _ in held], left) for held, left in closed] == [([1], False), ([2], True), ([0], True)]


def test_cut():
    assert packing.cut(5, 4) == [(0, 1), (1, 4)]
    assert packing.cut(8, 4) == [(0, 4), (4, 4)]
    assert packing.cut(3, 4) == [(0, 3)]


def check(rows, texts, size):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    for n, text in enumerate(texts):
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) - (-(-len(ids) // size) - 1) * size
        cuts = [0, *range(first, len(ids) + 1, size)]
        expected = [
            (k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        assert sorted(by_doc[n]) == expected
    total = sum(r["length"] for r in rows)
    return len(by_sequence), -(-total // size)


def test_documents(spark):
    texts = [prose(n, 1 + 13 * (n % 30)) for n in range(150)] + [None, "", "x", prose(7, 3000), prose(7, 3000)]
    docs = documents(spark, texts).repartition(5)
    used, least = check(packing.pack_documents(docs, PATH, size=256).collect(), texts, 256)
    assert used <= least * 1.05 + 1


def test_few_open_bins_and_more_levels(spark, monkeypatch):
    monkeypatch.setattr(packing, "PACKER_PIECES", 10)
    texts = [prose(n, 5 + n % 40) for n in range(120)]
    docs = documents(spark, texts).repartition(6)
    used, least = check(packing.pack_documents(docs, PATH, size=256, open_bins=4).collect(), texts, 256)
    assert used <= least * 1.3 + 1


def test_repeated_rows_nulls_and_empty_tables(spark):
    docs = documents(spark, [(1, "a b"), (1, "a b"), (None, "c")])
    found = packing.pack_documents(docs, PATH).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in found) == [(0, 2), (1, 3), (1, 3)]
    assert len({(r["sequence_id"], r["offset"]) for r in found}) == 3
    assert packing.pack_documents(documents(spark, []), PATH).collect() == []


PIECES = ["a", "The", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", "\u2028", "\u3000", "\ufeff",
          "e\u0301", "中文", "'s", "'LL", "'", "''s", "!!", "12", "²", "½", "٣", "🙂", "<|endoftext|>", "<|endof", "\x00", "don't "]


def library_ids(text):
    encoder = packing.packing_encoder(PATH)
    assert isinstance(encoder, packing.LibraryEncoder)
    return np.frombuffer(b"".join(p for _, p in encoder.blocks([text])), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=16).map("".join) | st.text(max_size=60))
def test_compiled_ids_are_those_of_the_library(text):
    assert library_ids(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_compiled_ids_around_every_kind_of_character():
    import sys

    chars = [chr(c) for c in range(0, min(sys.maxunicode, 0x3100)) if not 0xD800 <= c < 0xE000]
    for before, after in (("a", " b"), (" ", "a"), ("!", " \n")):
        text = "".join(f"{before}{c}{after}" for c in chars)
        assert library_ids(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_long_texts_in_parts(monkeypatch):
    monkeypatch.setattr(packing, "PART_CHARS", 500)
    for text in ("word and word " * 900, "x" * 4000, " " * 3000 + "a b" * 300, "ab cd " * 200 + "-" * 3000 + " e f" * 99,
                 "a <|endoftext|> b " * 200, "\n a" * 900):
        assert library_ids(text) == LIBRARY.encode(text, add_special_tokens=False).ids
