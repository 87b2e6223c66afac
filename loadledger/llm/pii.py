"""Personal data by rules, and by a semi-Markov conditional random field.

The rules give the base spans, which always stay. Stretches of text that could
hold personal data are cut into atoms, and every run of atoms that is short
enough is a candidate segment of every type. Features look at the segment as a
whole: its shape, digits, checksum, and what stands on both sides. Dynamic
programming over the atoms chooses the best segmentation, that is boundaries and
types together; entities of it that no base span touches are added.

The field learns from stretches in a bounded sample of documents, labelled by
the rules, and from made-up numbers and look-alikes.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from math import exp, inf, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadledger.llm.spans import Cover, Span, by_kind, digest_of, worded
from loadledger.llm.tables import sampled_texts

KINDS = ("email", "ip", "card", "phone")

# The base rules. An email's local part is read backwards from the
# sign and a number from its first digit, which finds the same and stays linear.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

SAMPLE = 2000  # documents whose stretches are learned from
PER_DOCUMENT = 4  # stretches taken from each
MADE = 400  # made-up stretches
LONGEST = 64  # characters of an entity
MOST_ATOMS = 24  # atoms of an entity
_HIT = re.compile(r"[0-9@]+")
_ATOM = re.compile(r"[A-Za-z]+|[0-9]+|.", re.DOTALL)
_NEAR = frozenset(" ().-")
_AROUND = LOCAL | frozenset("()")


def luhn(digits: str) -> bool:
    total = 0
    for n, c in enumerate(reversed(digits)):
        value = int(c) * (1 + n % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def base_spans(text: str) -> list[Span]:
    """What the rules find, by kind and start."""
    found: list[Span] = [("email", *span) for span in emails(text)]
    if not _DIGIT.search(text):
        return found
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of a text that could hold personal data: digits or a sign and what is joined to them."""
    out: list[tuple[int, int]] = []
    for match in _HIT.finditer(text):
        low, high = match.span()
        floor, roof = max(0, low - LONGEST), min(len(text), high + LONGEST)
        while low > floor and text[low - 1] in _AROUND:
            low -= 1
        while high < roof and text[high] in _AROUND:
            high += 1
        gap = out and low - out[-1][1]
        if out and (gap <= 0 or gap <= 2 and all(c in _NEAR for c in text[out[-1][1] : low])):
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return [(low, high) for low, high in out if _worth(text[low:high])]


def _worth(part: str) -> bool:
    """Whether a part has a sign, or the digits of some kind of number."""
    digits = len(_DIGIT.findall(part))
    return "@" in part or digits >= 7 or digits >= 4 and part.count(".") >= 3


def _side(c: str) -> str:
    if not c:
        return "none"
    if c.isdigit():
        return "digit"
    return "letter" if c.isalpha() else "space" if c.isspace() else c


_RUNS = re.compile(r"([A-Za-z])[A-Za-z]*|[0-9]+")


@lru_cache(maxsize=1 << 16)
def features(part: str, before: str, after: str) -> tuple[str, ...]:
    """What a segment as a whole looks like."""
    digits = "".join(_DIGIT.findall(part))
    shape = _RUNS.sub(lambda m: "a" if m[1] else "9", part)
    n = len(digits)
    found = [
        "bias",
        f"shape={shape}" if len(shape) <= 24 else "shape=long",
        f"digits={n if n < 20 else 'many'}",
        f"groups={'-'.join(str(len(g)) for g in re.findall('[0-9]+', part)[:6])}",
        f"before={_side(before)}",
        f"after={_side(after)}",
        f"length={min(len(part) // 4, 12)}",
        f"first={_side(part[0])}",
        f"letters={any(c.isalpha() for c in part)}",
    ]
    if "@" in part:
        found.append(f"mail={len(list(emails(part))) == 1 and next(emails(part)) == (0, len(part))}")
    if 13 <= n <= 19:
        found.append(f"luhn={luhn(digits)}")
    quads = part.split(".")
    if len(quads) == 4 and all(q.isdigit() for q in quads):
        found.append(f"octets={all(map(_small, quads))}")
    if part[0] == "+":
        found.append(f"plus={9 <= n <= 15}")
    return tuple(found)


@dataclass
class Stretch:
    """Atoms of a stretch and its candidate segments as (first atom, end atom, features)."""

    edges: list[int]
    segments: list[tuple[int, int, tuple[str, ...]]]

    @staticmethod
    def of(part: str, before: str = "", after: str = "") -> Stretch:
        whole = before + part + after
        edges = [m.start() for m in _ATOM.finditer(part)] + [len(part)]
        shift, segments = len(before), []
        # An entity begins and ends where no letter or digit goes on.
        opens = [i for i, e in enumerate(edges[:-1]) if not whole[max(0, e + shift - 1) : e + shift].isalnum()]
        ends = [i for i, e in enumerate(edges) if not whole[e + shift : e + shift + 1].isalnum()]
        closing = set(ends)
        for i in opens:
            if not (part[edges[i]].isalnum() or part[edges[i]] in "+("):
                continue
            for j in range(i + 1, min(i + MOST_ATOMS, len(edges) - 1) + 1):
                size = edges[j] - edges[i]
                if size > LONGEST:
                    break
                inner = part[edges[i] : edges[j]]
                if j in closing and inner[-1].isalnum() and _worth(inner):
                    left = whole[max(0, edges[i] + shift - 1) : edges[i] + shift]
                    right = whole[edges[j] + shift : edges[j] + shift + 1]
                    segments.append((i, j, features(inner, left, right)))
        return Stretch(edges, segments)


# What can stand before an entity: none in its stretch, or the last one's kind.
LAST = ("none", *KINDS)


@dataclass
class Field:
    """Weights of (kind, feature); a lone atom outside all entities weighs nothing.

    Features tell of a whole segment, and of which kind the entity before it is,
    however many atoms outside lie between the two.
    """

    weights: dict[tuple[str, str], float] = field(default_factory=lambda: defaultdict(float))

    def scores(self, found: tuple[str, ...]) -> list[float]:
        get = self.weights.get
        return [sum(get((kind, f), 0.0) for f in found) for kind in KINDS]

    def moves(self) -> list[list[float]]:
        """Weight of each kind after each of LAST."""
        return [[self.weights.get((kind, f"last={last}"), 0.0) for kind in KINDS] for last in LAST]

    def best(self, stretch: Stretch) -> list[Span]:
        """Kinds and atom ranges of the segmentation with the greatest score."""
        moves, kinds = self.moves(), range(len(KINDS))
        # A segment that costs more than it and what follows it can gain is in no best one.
        entry = [max(row[k] for row in moves) for k in kinds]
        onward = [max(moves[k + 1][m] - min(row[m] for row in moves) for m in kinds) for k in kinds]
        ending: dict[int, list[tuple[int, int, float]]] = {}
        known: dict[tuple[str, ...], list[float]] = {}  # segments of one look, as in long lists
        for i, j, found in stretch.segments:
            own = known.get(found)
            if own is None:
                own = known[found] = self.scores(found)
            for k in kinds:
                if own[k] + entry[k] + onward[k] > 0:
                    ending.setdefault(j, []).append((i, k, own[k]))
        n = len(stretch.edges) - 1
        total = [[0.0] + [-inf] * len(KINDS)]
        chosen: list[list[tuple[int, int] | None]] = [[None] * len(LAST)]
        for j in range(1, n + 1):
            now, back = list(total[j - 1]), [None] * len(LAST)
            for i, k, score in ending.get(j, ()):
                for last, before in enumerate(total[i]):
                    if before + moves[last][k] + score > now[k + 1]:
                        now[k + 1], back[k + 1] = before + moves[last][k] + score, (i, last)
            total.append(now)
            chosen.append(back)
        out, j, last = [], n, max(range(len(LAST)), key=total[n].__getitem__)
        while j > 0:
            step = chosen[j][last]
            if step is None:
                j -= 1
            else:
                out.append((KINDS[last - 1], step[0], j))
                j, last = step
        return out[::-1]

    def _sums(self, stretch: Stretch) -> tuple[list, list[list[float]], list[list[float]], float]:
        """Scored segments, sums of all segmentations before and after each place, and of all."""
        n, moves = len(stretch.edges) - 1, self.moves()
        scored = [(i, j, found, self.scores(found)) for i, j, found in stretch.segments]
        ending, starting = defaultdict(list), defaultdict(list)
        for one in scored:
            ending[one[1]].append(one)
            starting[one[0]].append(one)
        forward = [[0.0] + [-inf] * len(KINDS)]
        for j in range(1, n + 1):
            now = list(forward[j - 1])
            if ending[j]:
                for k in range(len(KINDS)):
                    more = [f + moves[p][k] + own[k] for i, _, _, own in ending[j] for p, f in enumerate(forward[i])]
                    now[k + 1] = _sum([now[k + 1], *more])
            forward.append(now)
        backward = [[0.0] * len(LAST)] * (n + 1)
        for i in range(n - 1, -1, -1):
            if starting[i]:
                backward[i] = [
                    _sum([stay, *(backward[j][k + 1] + move[k] + own[k] for _, j, _, own in starting[i] for k in range(len(KINDS)))])
                    for stay, move in zip(backward[i + 1], moves)
                ]
            else:
                backward[i] = backward[i + 1]
        return scored, forward, backward, _sum(forward[n])

    def likelihood(self, stretch: Stretch, gold: set[Span]) -> float:
        """Log likelihood of the gold segmentation."""
        scored, _, _, every = self._sums(stretch)
        held, moves = {(i, j): own for i, j, _, own in scored}, self.moves()
        total, last = 0.0, 0
        for kind, i, j in sorted(gold, key=lambda g: g[1]):
            k = KINDS.index(kind)
            total += held[i, j][k] + moves[last][k]
            last = k + 1
        return total - every

    def slopes(self, stretch: Stretch, gold: set[Span]) -> Iterator[tuple[tuple[str, ...], str, float]]:
        """(features, kind, slope of the log likelihood) of segments and of what precedes them."""
        scored, forward, backward, every = self._sums(stretch)
        moves, after, last = self.moves(), {}, 0
        for kind, i, j in sorted(gold, key=lambda g: g[1]):
            after[kind, i, j], last = last, KINDS.index(kind) + 1
        chances = [[0.0] * len(KINDS) for _ in LAST]
        for i, j, found, own in scored:
            for k, kind in enumerate(KINDS):
                each = [
                    exp(min(0.0, f + moves[p][k] + own[k] + backward[j][k + 1] - every)) if f > -inf else 0.0
                    for p, f in enumerate(forward[i])
                ]
                for p, chance in enumerate(each):
                    chances[p][k] += chance
                yield found, kind, ((kind, i, j) in gold) - sum(each)
        for p, last_kind in enumerate(LAST):
            for k, kind in enumerate(KINDS):
                seen = sum(g[0] == kind and before == p for g, before in after.items())
                yield (f"last={last_kind}",), kind, seen - chances[p][k]

    def learn(self, stretch: Stretch, gold: set[Span], rate: float, decay: float) -> None:
        """One step up the log likelihood of the gold segmentation."""
        for found, kind, slope in list(self.slopes(stretch, gold)):
            if abs(slope) > 1e-4:
                for name in found:
                    key = (kind, name)
                    self.weights[key] += rate * (slope - decay * self.weights[key])


def _sum(values: list[float]) -> float:
    top = max(values)
    if top == -inf:
        return top
    return top + log(sum(exp(v - top) for v in values))


def _made(rng: np.random.Generator) -> tuple[str, list[Span]]:
    """A made-up stretch and the entity in it, if it holds one."""

    def number(n: int) -> str:
        return "".join(str(d) for d in rng.integers(0, 10, n))

    def card(groups: tuple[int, ...], by: str) -> str:
        body = number(sum(groups) - 1)
        digits = next(body + str(c) for c in range(10) if luhn(body + str(c)))
        cut = np.cumsum((0, *groups))
        return by.join(digits[a:b] for a, b in zip(cut, cut[1:]))

    octet = lambda: str(rng.integers(0, 256))
    entity = (
        lambda: ("phone", f"+{rng.integers(1, 99)} ({number(3)}) {number(3)}-{number(4)}"),
        lambda: ("phone", f"({number(3)}) {number(3)}-{number(4)}"),
        lambda: ("phone", f"+{number(11)}"),
        lambda: ("phone", f"+{rng.integers(1, 99)}-{number(3)}-{number(3)}-{number(4)}"),
        lambda: ("card", card((4, 4, 4, 4), ["", " ", "-"][rng.integers(3)])),
        lambda: ("card", card((4, 6, 5), ["", " ", "-"][rng.integers(3)])),
        lambda: ("ip", ".".join(octet() for _ in range(4))),
        lambda: ("email", f"user.{number(2)}@host{number(1)}.example.org"),
        lambda: ("email", f"a_{number(3)}@example.com"),
    )
    other = (
        lambda: f"20{number(2)}-0{rng.integers(1, 10)}-1{number(1)}",
        lambda: f"{number(2)}.0{rng.integers(1, 10)}.20{number(2)} 1{number(1)}:{number(2)}",
        lambda: f"{rng.integers(1, 10)},{number(3)},{number(3)}.{number(2)}",
        lambda: f"{number(8)}-{number(6)}",
        lambda: f"{rng.integers(256, 999)}.{number(3)}.{rng.integers(256, 999)}.{number(3)}",
        lambda: f"v{number(1)}.{number(2)}.{number(1)}.{number(4)}",
        lambda: f"978-{number(1)}-{number(2)}-{number(6)}-{number(1)}",
        lambda: next(x for x in iter(lambda: number(16), "") if not luhn(x)),
        lambda: f"{number(10)}",
        lambda: f"{number(3)} {number(3)} {number(3)} {number(3)}",
    )
    if rng.random() < 0.5:
        kind, text = entity[rng.integers(len(entity))]()
        return text, [(kind, 0, len(text))]
    return other[rng.integers(len(other))](), []


def gold_of(stretch: Stretch, spans: list[Span]) -> set[Span]:
    """Character spans as segments of atoms; a span that is no candidate is left out."""
    place = {e: n for n, e in enumerate(stretch.edges)}
    known = {(i, j) for i, j, _ in stretch.segments}
    found = ((kind, place.get(s, -1), place.get(e, -1)) for kind, s, e in spans)
    return {(kind, i, j) for kind, i, j in found if (i, j) in known}


def fit(examples: list[tuple[str, str, str, list[Span]]], rounds: int = 12) -> Field:
    """Fit to (stretch, character before, character after, spans)."""
    rng = np.random.default_rng(23)
    rows = [(Stretch.of(part, before, after), spans) for part, before, after, spans in examples]
    for _ in range(MADE):
        part, spans = _made(rng)
        rows.append((Stretch.of(part, " ", " "), spans))
    ready = [(s, gold_of(s, spans)) for s, spans in rows if s.segments]
    learned = Field()
    for n in range(rounds):
        for k in rng.permutation(len(ready)):
            learned.learn(*ready[k], rate=0.5 / (1 + n), decay=1e-4)
    learned.weights = dict(learned.weights)
    return learned


def _apart(spans: list[Span]) -> list[Span]:
    """Spans that no earlier kind or place overlaps: what a segmentation can hold."""
    out, held = [], Cover()
    for span in spans:
        if not held.holds(span[1], span[2]):
            out.append(span)
            held.add(span[1], span[2])
    return out


def learn(docs: DataFrame, documents: int = SAMPLE) -> Field:
    """Fit the field to stretches of a bounded sample of documents, labelled by the rules.

    The sample is the ``documents`` rows with digits or a sign and the least
    hashes; each gives at most PER_DOCUMENT stretches.
    """

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = []
            for text in part.column(0).to_pylist():
                base = _apart(base_spans(text))
                rng = np.random.default_rng(zlib.crc32(text.encode()))
                found = stretches(text)
                for n in rng.permutation(len(found))[:PER_DOCUMENT]:
                    low, high = found[n]
                    own = [(k, s - low, e - low) for k, s, e in base if low <= s and e <= high]
                    rows.append((text[low:high], text[max(0, low - 1) : low], text[high : high + 1], worded(own)))
            columns = zip(*rows) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), "string") for c in columns], ["part", "before", "after", "spans"]
            )

    sample = sampled_texts(docs, documents, "[0-9@]")
    found = sample.mapInArrow(read, "part string, before string, after string, spans string").distinct()
    examples = []
    for part, before, after, spans in sorted(map(tuple, found.collect())):
        own = [s.split(":") for s in spans.split(",") if s]
        examples.append((part, before, after, [(k, int(s), int(e)) for k, s, e in own]))
    return fit(examples)


def all_spans(text: str, learned: Field) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans) of a text, both by kind and start."""
    base = base_spans(text)
    extra: list[Span] = []
    held = Cover(base)
    if _HIT.search(text):
        for low, high in stretches(text):
            before, after = text[max(0, low - 1) : low], text[high : high + 1]
            stretch = Stretch.of(text[low:high], before, after)
            for kind, i, j in learned.best(stretch):
                start, end = low + stretch.edges[i], low + stretch.edges[j]
                if not held.holds(start, end):
                    extra.append((kind, start, end))
    return by_kind(base, KINDS), by_kind(base + extra, KINDS)


def find_personal_data(docs: DataFrame, learned: Field) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) per row of ``docs``.

    Spans count code points. The numbers count base spans. A null text is
    empty and has none; repeated rows are read each on their own. A text of any length is
    read whole, in time that goes with its length. An empty table gives no rows. Other columns
    are not read.
    """

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [all_spans(t.as_py() or "", learned) for t in part.column(1)]
            counts = [[sum(s[0] == k for s in base) for base, _ in found] for k in KINDS]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    *(pa.array(c, "int64") for c in counts),
                    pa.array([digest_of(base) for base, _ in found], "string"),
                    pa.array([worded(spans) for _, spans in found], "string"),
                ],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    numbers = ", ".join(f"n_{k} long" for k in KINDS)
    return narrow.mapInArrow(scan, f"doc_id long, {numbers}, base_sha256 string, spans string")
