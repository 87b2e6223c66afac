"""Spans found in texts, and how a table of them is put into words."""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Sequence

Span = tuple[str, int, int]  # kind, start, end


def worded(spans: Iterable[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def digest_of(spans: Iterable[Span]) -> str:
    return hashlib.sha256(worded(spans).encode()).hexdigest()


def by_start(spans: Iterable[Span], kinds: Sequence[str]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], kinds.index(s[0]), s[2]))


def by_kind(spans: Iterable[Span], kinds: Sequence[str]) -> list[Span]:
    return sorted(spans, key=lambda s: (kinds.index(s[0]), s[1], s[2]))


class Cover:
    """Places that spans hold, to ask whether another span shares a character with them.

    Spans that overlap are merged, so that a question takes one search; adding a
    span at the end, as in a scan by start, takes no longer.
    """

    def __init__(self, spans: Iterable[Span] = ()) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for _, start, end in sorted(spans, key=lambda s: s[1:]):
            self.add(start, end)

    def holds(self, start: int, end: int) -> bool:
        at = bisect_right(self.ends, start)
        return at < len(self.ends) and self.starts[at] < end

    def add(self, start: int, end: int) -> None:
        low, high = bisect_right(self.ends, start), bisect_left(self.starts, end)
        if low < high:
            start, end = min(start, self.starts[low]), max(end, self.ends[high - 1])
        self.starts[low:high], self.ends[low:high] = [start], [end]
