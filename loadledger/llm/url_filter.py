"""URL rules as regular expressions, found by their rarest literal token.

A URL can only match a rule whose literal tokens it holds. Each rule is filed
under the one that is rarest among all URLs, so a URL's own tokens fetch few
candidates, and only those run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = r"[A-Za-z0-9]+"
_LOWER = str.maketrans(ascii_uppercase, ascii_lowercase)


@dataclass(frozen=True)
class Rule:
    """A verdict for URLs whose host and path match a pattern.

    ``literals`` are tokens, bounded by other characters, that every match
    holds. ``name`` is null for rules of the method's own. Of several matches
    the one with the greatest ``weight`` decides, then the earlier rule.
    """

    pattern: str
    verdict: str
    literals: tuple[str, ...] = ()
    name: str | None = None
    weight: tuple[int, int] = (0, 0)


def prefix_rule(host: str, path: str, verdict: str) -> Rule:
    """A rule for a host, its subdomains, and paths that start with ``path``; the longest wins."""
    whole = [m for m in re.finditer(TOKEN, host + path) if m.end() < len(host + path)]
    return Rule(
        rf"(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}",
        verdict,
        tuple(m.group() for m in whole),
        host + path,
        (len(host + path), len(host)),
    )


# Rules that a URL comes to where no named rule fits: hosts and folders that
# carry no text to learn from.
OWN_RULES = (
    Rule(r"(?:[^/]*\.)?ads\.", "block", ("ads",)),
    Rule(r"[^/]*/(?:.*/)?login/", "block", ("login",)),
    Rule(r"[^/]*/(?:.*/)?tracking/", "block", ("tracking",)),
)


def split_url(url: str | None) -> tuple[str, str]:
    """Host in lower case and path; both empty without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    host = re.match(r"[^/?#]*", rest).group()
    return host.translate(_LOWER), re.match(r"[^?#]*", rest[len(host) :]).group()


def literal_counts(urls: DataFrame, rules: Sequence[Rule]) -> dict[str, int]:
    """How many URLs hold each literal; as many rows as the rules have literals.

    The literals, which the rules bound, are a broadcast table that the URLs' tokens meet.
    """
    wanted = sorted({t for rule in rules for t in rule.literals})
    if not wanted:
        return {}
    tokens = F.array_distinct(F.regexp_extract_all("url", F.lit(TOKEN), F.lit(0)))
    lower = F.transform(tokens, lambda t: F.translate(t, ascii_uppercase, ascii_lowercase))
    each = urls.select(F.explode(F.array_union(tokens, lower)).alias("token"))
    known = urls.sparkSession.createDataFrame([(t,) for t in wanted], "token string")
    found = each.join(F.broadcast(known), "token").groupBy("token").count()
    return {row["token"]: row["count"] for row in found.collect()}


class RuleIndex:
    """Rules by their rarest literal; a pattern is compiled when a URL first comes to it."""

    def __init__(self, rules: Sequence[Rule], counts: dict[str, int]) -> None:
        self.by_token: dict[str, list[int]] = {}
        self.always: list[int] = []
        self.rules = rules
        self.compiled: dict[int, re.Pattern] = {}
        for number, rule in enumerate(rules):
            if rule.literals:
                rarest = min(rule.literals, key=lambda t: (counts.get(t, 0), t))
                self.by_token.setdefault(rarest, []).append(number)
            else:
                self.always.append(number)
        self.tokens = re.compile(TOKEN).findall

    def _matches(self, number: int, subject: str) -> bool:
        pattern = self.compiled.get(number)
        if pattern is None:
            pattern = self.compiled[number] = re.compile(self.rules[number].pattern, re.DOTALL)
        return pattern.match(subject) is not None

    def judge(self, host: str, path: str) -> tuple[str | None, str | None]:
        """(rule name, verdict) of the rule that decides, nulls where none matches."""
        subject = host + path
        numbers = set(self.always)
        for token in set(self.tokens(subject)):
            numbers.update(self.by_token.get(token, ()))
        hits = [(self.rules[n].weight, -n, self.rules[n]) for n in numbers if self._matches(n, subject)]
        if not hits:
            return None, None
        best = max(hits, key=lambda h: h[:2])[2]
        return best.name, best.verdict


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], own_rules: Sequence[Rule] = OWN_RULES, default: str = "allow"
) -> DataFrame:
    """(page_id, host, path, rule, verdict) per row of ``pages``.

    Named rules come before the method's own; where neither matches ``default``
    holds. A null url, or one without ``://``, has an empty host and path. Of rules with
    equal weight the earlier one decides. Urls may have any length. Rows
    are judged one by one, repeated ones too; an empty table gives no rows; other columns are not read.
    """
    urls = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"))
    counts = literal_counts(urls, [*rules, *own_rules])

    def judged(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named, own = RuleIndex(rules, counts), RuleIndex(own_rules, counts)
        for part in parts:
            rows = []
            for url in part.column(1).to_pylist():
                host, path = split_url(url)
                name, verdict = named.judge(host, path)
                verdict = verdict or own.judge(host, path)[1] or default
                rows.append((host, path, name, verdict))
            columns = zip(*rows) if rows else [()] * 4
            arrays = [pa.array(list(c), pa.string()) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *arrays], ["page_id", "host", "path", "rule", "verdict"]
            )

    return urls.mapInArrow(judged, "page_id long, host string, path string, rule string, verdict string")
