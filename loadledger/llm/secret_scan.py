"""Secrets by rules, and by a character network over every further candidate.

The rules give the base spans, which always stay. Every other run of key-like
characters is a candidate: a convolutional network reads it with what stands
around it, and adds it where its calibrated probability reaches a threshold
chosen so that a set share of labelled secrets is found. A long run is read in
overlapping windows; it is as likely a secret as the likeliest of them.

The labelled findings that the network learns from are of two sorts: what the
rules find or refuse in a bounded sample of documents, and made-up secrets and
look-alikes of well-known forms, set into contexts from the same sample. A run
that the rules refuse but that has a well-known form teaches nothing.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from string import ascii_letters, digits

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadledger.llm.spans import Cover, Span, by_start, digest_of, worded
from loadledger.llm.tables import sampled_texts

# The base rules.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "other")
_NAMES = ("passw", "secret", "token", "apikey", "api_key")

# What the forms of made_secret begin with or follow on.
KNOWN = re.compile(
    r"(?<![a-z0-9])(gh[oprsu]_|xox[abprs]-|sk-|eyj|bearer\x20+|(aws_access|private_key|credential|key)\x20*[:=]\x20*)"
    r"[a-z0-9_+/-]{20,}",
    re.IGNORECASE | re.ASCII,
)
CANDIDATE = re.compile(r"[A-Za-z0-9_+/=-]{16,}")
# Texts that may hold something to learn from, in the words of Spark's expressions.
LIKELY = r"(?i:passw(?:or)?d|secret|token|api_?key)[\"']?\x20*[:=]|AKIA[A-Z0-9]{16}|[A-Za-z0-9_+/=-]{16}"
DOCUMENTS = 300  # documents whose contexts and findings are learned from
PER_DOCUMENT = 8  # findings, and places for made-up ones, taken from each
MADE = 1600  # made-up findings, secrets and look-alikes in turn
MADE_INSIDE = 800  # the same as parts of longer runs
BEFORE, INSIDE, AFTER = 20, 44, 8
WIDTH = BEFORE + INSIDE + AFTER
STEP = INSIDE // 4  # between the windows of a run longer than INSIDE
LEARNED_WINDOWS = 16  # windows of one finding to learn from, spread over it
RECALL = 0.95  # share of labelled secrets that the threshold must let through
EMBEDDING, FILTERS, SPAN = 12, 24, 5
SEED = 5
BATCH = 4096  # windows that the network reads at a time

_ALPHABET = ascii_letters + digits + "_+/=-.:;,'\"@#$%&*!?()[]{}<>|\\~^` \n"
_CODE = {c: n + 2 for n, c in enumerate(_ALPHABET)}
_CODES = len(_ALPHABET) + 2  # 0 stands for nothing there, 1 for any other character


def base_spans(text: str) -> list[Span]:
    """What the rules find, by start."""
    found: list[Span] = []
    lower = text.lower()
    if any(name in lower for name in _NAMES):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return by_start(found, KINDS)


def candidates(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """Key-like runs with letters and digits that no base span touches."""
    out, held = [], Cover(base)
    for match in CANDIDATE.finditer(text):
        run = match.group()
        if any(c.isdigit() for c in run) and any(c.isalpha() for c in run):
            if not held.holds(*match.span()):
                out.append(match.span())
    return out


def windows(start: int, end: int) -> Iterator[tuple[int, int]]:
    """Overlapping parts of a run, each of at most INSIDE characters, that hold all of it."""
    last = max(start, end - INSIDE)
    for at in range(start, last, STEP):
        yield at, at + INSIDE
    yield last, end


def of_known_form(text: str, start: int, end: int) -> bool:
    """Whether a run holds what looks like a key of a well-known form."""
    return bool(KNOWN.search(text[max(0, start - BEFORE) : end]))


def encoded(text: str, start: int, end: int) -> np.ndarray:
    """Codes of what stands before a window, of the window and of what stands after it."""
    run = text[start:end]
    before = text[max(0, start - BEFORE) : start].rjust(BEFORE, "\0")
    after = text[end : end + AFTER].ljust(AFTER, "\0")
    codes = [0 if c == "\0" else _CODE.get(c, 1) for c in before + run.ljust(INSIDE, "\0") + after]
    return np.array(codes, np.int16)


def learned(text: str, start: int, end: int) -> np.ndarray:
    """Codes of a run to learn from, one row per window."""
    parts = list(windows(start, end))
    return np.stack([encoded(text, *part) for part in parts[:: -(-len(parts) // LEARNED_WINDOWS)]])


@dataclass
class CharNetwork:
    """Embedding, one convolution, greatest value over all places, one linear layer."""

    embed: np.ndarray
    kernel: np.ndarray
    shift: np.ndarray
    out: np.ndarray
    bias: float
    temperature: float = 1.0
    threshold: float = 1.0

    def _features(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        e = self.embed[codes]
        windows = np.lib.stride_tricks.sliding_window_view(e, SPAN, axis=1)
        flat = windows.transpose(0, 1, 3, 2).reshape(len(codes), WIDTH - SPAN + 1, SPAN * EMBEDDING)
        active = np.maximum(flat @ self.kernel + self.shift, 0)
        return flat, active, active.max(1)

    def logits(self, codes: np.ndarray) -> np.ndarray:
        parts = [
            self._features(codes[n : n + BATCH])[2] @ self.out + self.bias
            for n in range(0, len(codes), BATCH)
        ]
        return np.concatenate(parts) if parts else np.zeros(0)

    def likeliest(self, findings: list[np.ndarray]) -> np.ndarray:
        """Codes of the likeliest window of each finding."""
        logits = self.logits(np.concatenate(findings))
        ends = np.cumsum([len(f) for f in findings])
        return np.stack([f[logits[e - len(f) : e].argmax()] for f, e in zip(findings, ends)])

    def probability(self, codes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(codes) / self.temperature, -40, 40)))


def split(count: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Findings held out, one in four, and those to fit to."""
    order = rng.permutation(count)
    return order[::4], np.setdiff1d(order, order[::4])


def train(findings: list[np.ndarray], y: np.ndarray, epochs: int = 10, rate: float = 5e-3) -> CharNetwork:
    """Fit by Adam to the likeliest window of each finding; every fourth one sets temperature and threshold instead."""
    rng = np.random.default_rng(SEED)
    held, used = split(len(findings), rng)
    net = CharNetwork(
        rng.normal(0, 0.5, (_CODES, EMBEDDING)).astype(np.float32),
        rng.normal(0, np.sqrt(2 / (SPAN * EMBEDDING)), (SPAN * EMBEDDING, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        rng.normal(0, np.sqrt(1 / FILTERS), FILTERS).astype(np.float32),
        0.0,
    )
    net.embed[0] = 0
    moments: dict[str, list] = {n: [0.0, 0.0] for n in ("embed", "kernel", "shift", "out", "bias")}
    step = 0
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(used), max(1, len(used) // 32)):
            step += 1
            codes = net.likeliest([findings[n] for n in batch])
            flat, active, top = net._features(codes)
            p = 1 / (1 + np.exp(-np.clip(top @ net.out + net.bias, -40, 40)))
            error = ((p - y[batch]) / len(batch)).astype(np.float32)
            back = np.outer(error, net.out) * (top > 0)
            place = active.argmax(1)
            rows = np.arange(len(batch))[:, None]
            chosen = flat[rows, place]  # batch, filters, span * embedding
            slopes = {
                "kernel": np.einsum("bf,bfk->kf", back, chosen),
                "shift": back.sum(0),
                "out": top.T @ error,
                "bias": float(error.sum()),
                "embed": np.zeros_like(net.embed),
            }
            to_flat = back[:, :, None] * net.kernel.T[None]
            for k in range(SPAN):
                np.add.at(
                    slopes["embed"],
                    np.take_along_axis(codes, place + k, 1),
                    to_flat[:, :, k * EMBEDDING : (k + 1) * EMBEDDING],
                )
            slopes["embed"][0] = 0
            for name, slope in slopes.items():
                m = moments[name]
                m[0] = 0.9 * m[0] + 0.1 * slope
                m[1] = 0.999 * m[1] + 0.001 * slope**2
                move = rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8)
                setattr(net, name, getattr(net, name) - move)
    codes = net.likeliest([findings[n] for n in held])
    net.temperature = _temperature(net.logits(codes), y[held])
    p = np.sort(net.probability(codes)[y[held] > 0])
    # The greatest threshold that keeps the set share of held-out secrets.
    net.threshold = float(p[int(np.floor((1 - RECALL) * len(p)))]) if len(p) else 1.0
    return net


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    choices = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
    loss = [np.mean(np.logaddexp(0, np.where(y > 0, -logits, logits) / t)) for t in choices]
    return float(choices[int(np.argmin(loss))])


_UPPER, _LOWER = ascii_letters[26:], ascii_letters[:26]
_HEX = digits + "abcdef"


def made_secret(rng: np.random.Generator) -> tuple[str, str]:
    """(what introduces it, secret) in one of several well-known forms."""

    def some(alphabet: str, n: int) -> str:
        return "".join(alphabet[i] for i in rng.integers(0, len(alphabet), n))

    mixed = ascii_letters + digits
    forms = (
        lambda: ("", "ghp_" + some(mixed, 36)),
        lambda: ("", "xoxb-" + some(digits, 12) + "-" + some(mixed, 24)),
        lambda: ("", "sk-" + some(mixed, 40)),
        lambda: ("Authorization: Bearer ", some(mixed + "_-", int(rng.integers(24, 44)))),
        lambda: ("aws_access = ", some(mixed + "+/", 40)),
        lambda: ("private_key: ", some(mixed + "+/", int(rng.integers(32, 60))) + "=="),
        lambda: ("credential=", some(mixed, int(rng.integers(20, 40)))),
        lambda: ("key: ", some(_HEX.upper(), int(rng.integers(32, 41)))),
        lambda: ("", "eyJ" + some(mixed, int(rng.integers(30, 60)))),
    )
    return forms[int(rng.integers(len(forms)))]()


def made_lookalike(rng: np.random.Generator, words: list[str]) -> tuple[str, str]:
    """(what introduces it, key-like run that is no secret)."""

    def word() -> str:
        return words[int(rng.integers(len(words)))].lower() if words else "word"

    def number(n: int) -> str:
        return "".join(digits[i] for i in rng.integers(0, 10, n))

    def hexes(n: int) -> str:
        return "".join(_HEX[i] for i in rng.integers(0, 16, n))

    forms = (
        lambda: ("", f"{word()}-{word()}-{word()}-{number(2)}"),
        lambda: ("", f"{word()}_{word()}_{word()}{number(1)}"),
        lambda: ("see /", f"{word()}/{word()}/{word()}/{number(3)}"),
        lambda: ("", f"2024-0{number(1)}-1{number(1)}T1{number(1)}-30-00Z"),
        lambda: ("id ", "-".join(hexes(n) for n in (8, 4, 4, 4, 12))),
        lambda: ("", f"{word()}{word()}{word()}{word()}{number(2)}"),
        lambda: ("sha1 ", f"{hexes(7)}-{word()}-{word()}"),
        lambda: ("", f"{word().upper()}-{word().upper()}-{word().upper()}{number(2)}"),
        lambda: ("", f"{word()}{number(1)}{word()}-{word()}{number(1)}{word()}"),
        lambda: ("", f"----------------{number(2)}{word()}----------------"),
    )
    return forms[int(rng.integers(len(forms)))]()


def made_inside(rng: np.random.Generator, words: list[str], run: str) -> tuple[str, str]:
    """What makes a longer run of ``run``: (parts of a path or name before it, parts after it)."""
    plain = [w.lower() for w in words if w.isascii()] or ["word"]

    def part() -> str:
        number = str(int(rng.integers(1, 3000))) if rng.random() < 0.3 else ""
        return plain[int(rng.integers(len(plain)))] + number

    def parts(characters: int) -> str:
        out = part()
        while len(out) < characters:
            out += "/_-="[int(rng.choice(4, p=[0.5, 0.2, 0.2, 0.1]))] + part()
        return out

    before, after = rng.integers(0, 70, 2).tolist()
    after = max(after, INSIDE - len(run) - before)
    return (f"{parts(before)}/" if before > 5 else "", f"/{parts(after)}" if after > 5 else "")


def findings(text: str, rng: np.random.Generator) -> Iterator[tuple[int | None, bytes, str, str]]:
    """What one sampled text gives to learn from: (label, codes, "", "") of what the
    rules confirm or do not, and (null, b"", before, after) of places chosen at random.
    """
    base = base_spans(text)
    places = []
    for kind, start, end in base:
        lead = re.match(r"[^:=]*[:=]\x20*[\"']?", text[start:end])[0] if kind == "assign" else ""
        places.append((1, start + len(lead), end))
    places += [(0, *span) for span in candidates(text, base) if not of_known_form(text, *span)]
    for n in rng.permutation(len(places))[:PER_DOCUMENT]:
        label, start, end = places[n]
        yield label, learned(text, start, end).tobytes(), "", ""
    for at in rng.integers(0, len(text) + 1, PER_DOCUMENT).tolist():
        at = text.rfind(" ", 0, at) + 1
        yield None, b"", text[max(0, at - 40) : at], text[at : at + 20]


def labelled_findings(rows: list[tuple]) -> tuple[list[np.ndarray], np.ndarray]:
    """Codes and labels of what ``findings`` gave, and of made-up findings set into its places."""
    rng = np.random.default_rng(3)
    real = [r for r in rows if r[0] is not None]
    contexts = [(r[2], r[3]) for r in rows if r[0] is None] or [("", "")]
    codes = [np.frombuffer(r[1], np.int16).reshape(-1, WIDTH) for r in real]
    labels = [r[0] for r in real]
    words = sorted({w for c in contexts for w in " ".join(c).split() if w.isalpha() and len(w) > 2})
    for n in range(MADE + MADE_INSIDE):
        before, after = contexts[n % len(contexts)]
        lead, run = made_secret(rng) if n % 2 else made_lookalike(rng, words)
        if n >= MADE:
            first, last = made_inside(rng, words, run)
            lead, run = ("" if first else lead), first + run + last
        start = len(before + lead)
        codes.append(learned(f"{before}{lead}{run} {after}", start, start + len(run)))
        labels.append(n % 2)
    return codes, np.array(labels, np.float32)


def learning_rows(docs: DataFrame, documents: int) -> list[tuple]:
    """``findings`` of a bounded sample: a third of any documents, for their surroundings, the
    others of documents that may hold findings."""

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for text in part.column(0).to_pylist():
                rng = np.random.default_rng(zlib.crc32(text.encode()))
                columns = zip(*findings(text, rng))
                kinds = ("int32", "binary", "string", "string")
                arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, ["label", "codes", "before", "after"])

    plain = documents // 3
    sample = sampled_texts(docs, plain).unionByName(sampled_texts(docs, documents - plain, LIKELY)).distinct()
    found = sample.mapInArrow(read, "label int, codes binary, before string, after string")
    return sorted(map(tuple, found.collect()), key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


def learn(docs: DataFrame, documents: int = DOCUMENTS) -> CharNetwork:
    """Fit the network to findings in a bounded sample of documents, and to made-up ones.

    The sample is ``documents`` rows, those with the least hashes of their sort; each gives at
    most PER_DOCUMENT findings and as many places.
    """
    return train(*labelled_findings(learning_rows(docs, documents)))


def all_spans(texts: list[str], net: CharNetwork) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text; windows of candidates of all texts are read together."""
    bases = [base_spans(t) for t in texts]
    found = [candidates(t, b) for t, b in zip(texts, bases)]
    places = ((n, span, part) for n, spans in enumerate(found) for span in spans for part in windows(*span))
    extra: list[set[Span]] = [set() for _ in texts]
    while some := list(islice(places, BATCH)):
        p = net.probability(np.stack([encoded(texts[n], *part) for n, _, part in some]))
        for (n, span, _), keep in zip(some, p >= net.threshold):
            if keep:
                extra[n].add(("other", *span))
    return [(base, by_start([*base, *more], KINDS)) for base, more in zip(bases, extra)]


def find_secrets(docs: DataFrame, net: CharNetwork) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) per row of ``docs``.

    Spans count code points. The numbers count base spans. A null text is
    empty and has none; repeated rows are read each on their own. A text of any length is
    read whole, in time that goes with its length, however many findings it holds. An
    empty table gives no rows. Other columns are not read.
    """

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for start in range(0, len(part), 500):
                ids = part.column(0).slice(start, 500)
                texts = [t.as_py() or "" for t in part.column(1).slice(start, 500)]
                found = all_spans(texts, net)
                counts = [[sum(s[0] == k for s in base) for base, _ in found] for k in KINDS[:3]]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        *(pa.array(c, "int64") for c in counts),
                        pa.array([digest_of(base) for base, _ in found], "string"),
                        pa.array([worded(spans) for _, spans in found], "string"),
                    ],
                    ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
                )

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(
        scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def redacted(text: str, spans: list[Span], mark: str = "[secret]") -> str:
    """The text with every span replaced; overlapping spans become one mark."""
    out, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: (s[1], s[2])):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def without_secrets(docs: DataFrame, net: CharNetwork, column: str = "text") -> DataFrame:
    """``docs`` with all secrets in a text column replaced; null stays null."""

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        plain = texts.to_pylist()
        found = all_spans([t or "" for t in plain], net)
        return pa.array(
            [t if t is None or not spans else redacted(t, spans) for t, (_, spans) in zip(plain, found)],
            pa.string(),
        )

    return docs.withColumn(column, clean(F.col(column).cast("string")))
