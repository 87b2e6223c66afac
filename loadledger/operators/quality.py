"""Quality rules as counts of violations, and the gate that acts on them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from loadledger.contract import (
    DAILY_SCHEMA,
    DAY_KEY,
    HOUR_KEY,
    HOURLY_SCHEMA,
    LAST_HOUR,
    READING_KEY,
    SeriesContract,
)
from loadledger.functions.columns import period_sql, sql_list, sql_text


class QualityError(ValueError):
    """A quality rule found violations."""


@dataclass(frozen=True)
class Rule:
    """Rows for which the SQL condition ``broken`` is true violate the rule; null does not."""

    name: str
    broken: str


def any_missing(names: Sequence[str], numbers: Sequence[str] = ()) -> str:
    """Null in any column, or NaN in any of the numeric ones."""
    nulls = [f"`{n}` IS NULL" for n in (*names, *numbers)]
    return " OR ".join([*nulls, *[f"isnan(`{n}`)" for n in numbers]])


def domain_rules(contract: SeriesContract) -> list[Rule]:
    rules = []
    if contract.respondents is not None:
        known = sql_list(contract.respondents)
        rules.append(Rule("respondent in domain", f"respondent NOT IN ({known})"))
    rules.append(Rule("type in domain", f"type NOT IN ({sql_list(contract.types)})"))
    return rules


def record_rules(contract: SeriesContract) -> list[Rule]:
    """Rules for decoded records."""
    required = any_missing([*READING_KEY, "value_units"], numbers=["value"])
    unit = Rule("unit in domain", f"value_units <> {sql_text(contract.unit)}")
    return [Rule("required fields", required), *domain_rules(contract), unit]


def latest_rules(contract: SeriesContract) -> list[Rule]:
    """Rules for readings that are about to be pivoted."""
    kind = Rule("type in domain", f"type NOT IN ({sql_list(contract.types)})")
    return [Rule("required fields", any_missing(READING_KEY, numbers=["value"])), kind]


def hourly_rules() -> list[Rule]:
    """All columns are required; an hour lacking one measure type breaks this too."""
    return [Rule("actual and forecast paired", any_missing(HOURLY_SCHEMA.names))]


def daily_rules(contract: SeriesContract) -> list[Rule]:
    return [
        Rule("required fields", any_missing(DAILY_SCHEMA.names)),
        Rule("complete days", f"hour_count <> {contract.hours_per_day}"),
    ]


def checkpoint_rules() -> list[Rule]:
    """State must name the last hour of a day."""
    blank = "last_uploaded_hour IS NULL OR last_uploaded_hour = ''"
    hour = period_sql("last_uploaded_hour")
    return [
        Rule("checkpoint present", blank),
        Rule("checkpoint parses", f"NOT ({blank}) AND {hour} IS NULL"),
        Rule("checkpoint ends a day", f"hour({hour}) <> {LAST_HOUR}"),
    ]


def _as_rows(counts: DataFrame, names: Sequence[str], first: int) -> DataFrame:
    """One-row counts ``r0, r1, …`` to rows (ordinal, check, violations)."""
    entries = ", ".join(
        f"{first + i}, {sql_text(name)}, CAST(coalesce(r{i}, 0) AS BIGINT)"
        for i, name in enumerate(names)
    )
    return counts.selectExpr(f"stack({len(names)}, {entries}) AS (ordinal, check, violations)")


def quality_report(
    df: DataFrame,
    rules: Sequence[Rule],
    unique: Sequence[str] = (),
    unique_name: str = "unique key",
    first: int = 1,
) -> DataFrame:
    """Rows (ordinal, check, violations), in the order the gate applies them.

    All row rules fold into one aggregate. The uniqueness check joins in: rows
    fold per key on the map side, and the same pass sums the broken rows, so
    the input is read once however many rules there are.
    """
    broken = [
        F.expr(f"sum(CASE WHEN {rule.broken} THEN 1 ELSE 0 END) AS r{i}")
        for i, rule in enumerate(rules)
    ]
    names = [rule.name for rule in rules]
    if not unique:
        return _as_rows(df.agg(*broken), names, first)
    per_key = df.groupBy(*unique).agg(F.expr("count(*) AS n"), *broken)
    repeated = F.expr(f"sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS r{len(rules)}")
    sums = [F.expr(f"sum(r{i}) AS r{i}") for i in range(len(rules))]
    return _as_rows(per_key.agg(*sums, repeated), [*names, unique_name], first)


def not_empty_report(df: DataFrame, name: str, first: int = 0) -> DataFrame:
    """One violation when there is no row at all."""
    empty = F.expr("CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS r0")
    return _as_rows(df.agg(empty), [name], first)


NAMED = 5  # rows that a message names; the reports themselves hold all


Finding = tuple[int, str, int]  # ordinal, check, violations


def enforce(report: DataFrame, culprits: dict[str, DataFrame] | None = None) -> None:
    """Raise for the first broken rule. A report has one row per rule, so it is small.

    ``culprits`` gives, by check, the rows that break it; the message names the
    first of them.
    """
    broken = report.filter(F.col("violations") > 0).orderBy("ordinal").limit(1).collect()
    enforce_findings([(r["ordinal"], r["check"], r["violations"]) for r in broken], culprits)


def enforce_findings(
    findings: Sequence[Finding], culprits: dict[str, DataFrame] | None = None
) -> None:
    """``enforce`` for a report that is at hand already."""
    broken = min((f for f in findings if f[2] > 0), default=None)
    if broken is None:
        return
    _, check, violations = broken
    message = f"{check}: {violations} violations"
    rows = (culprits or {}).get(check)
    if rows is not None:
        first = rows.orderBy(*rows.columns).limit(NAMED).collect()
        message += f" (first: {'; '.join(' '.join(map(str, r)) for r in first)})"
    raise QualityError(message)


class Watch:
    """Rules that are checked on rows on their way through a write.

    ``numbered`` goes before the rows are dealt out for writing, ``watched`` after
    it, in the stage that writes. There a task's counts enter once however often
    it is tried, and the gate needs no second look at what was written.
    """

    NTH = "_nth"

    def __init__(
        self,
        rules: Sequence[Rule] = (),
        unique: Sequence[str] = (),
        unique_name: str = "unique key",
        first: int = 1,
        tallied: str | None = None,
    ) -> None:
        self.rules, self.unique, self.first, self.tallied = rules, unique, first, tallied
        self.names = [rule.name for rule in rules] + ([unique_name] if unique else [])
        self.observation = Observation()

    def numbered(self, df: DataFrame) -> DataFrame:
        """The rows of a key numbered, so that the second of each tells a repeated key."""
        if not self.unique:
            return df
        same = Window.partitionBy(*self.unique).orderBy(*self.unique)
        return df.withColumn(self.NTH, F.row_number().over(same))

    def watched(self, df: DataFrame, tallies: Sequence[str] = ()) -> DataFrame:
        """Count what breaks each rule, and the rows for each of the values of the tallied column."""
        tests = [rule.broken for rule in self.rules] + ([f"{self.NTH} = 2"] if self.unique else [])
        tests += [f"{self.tallied} = {sql_text(value)}" for value in tallies]
        counts = [
            F.expr(f"sum(CASE WHEN {test} THEN 1 ELSE 0 END)").alias(f"r{i}")
            for i, test in enumerate(tests)
        ]
        self._tallies = list(tallies)
        counts.append(F.count(F.lit(1)).alias("rows"))
        return df.observe(self.observation, *counts).drop(self.NTH)

    def _count(self, name: str) -> int:
        return self.observation.get.get(name) or 0

    def findings(self) -> list[Finding]:
        """The report, once the rows are written."""
        return [(self.first + i, name, self._count(f"r{i}")) for i, name in enumerate(self.names)]

    def tally(self) -> dict[str, int]:
        """Rows by value of the tallied column, once they are written."""
        at = len(self.names)
        return {value: self._count(f"r{at + i}") for i, value in enumerate(self._tallies)}

    def rows(self) -> int:
        return self._count("rows")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.filter(F.col("row_count") > 1)


def incomplete_days(daily: DataFrame, contract: SeriesContract) -> DataFrame:
    """Days whose number of hours is wrong."""
    wrong = daily.filter(F.col("hour_count") != contract.hours_per_day)
    return wrong.select(*DAY_KEY, "hour_count")


def unpaired_hours(hourly: DataFrame) -> DataFrame:
    """Hours that miss a required column, with the names of what is missing."""
    missing = F.array_compact(
        F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in HOURLY_SCHEMA.names])
    )
    listed = hourly.select(*HOUR_KEY, F.array_join(missing, ",").alias("missing_columns"))
    return listed.filter(F.col("missing_columns") != "")


def date_range(bounds: DataFrame, first: str = "first_date", last: str = "last_date") -> DataFrame:
    """Every date from first to last, for each row of ``bounds``."""
    rest = [name for name in bounds.columns if name not in (first, last)]
    dates = F.sequence(F.col(first), F.col(last), F.expr("interval 1 day"))
    return bounds.select(*rest, F.explode(dates).alias("date"))


def expected_grid(days: DataFrame, contract: SeriesContract) -> DataFrame:
    """All readings that the days (date, respondent) should have."""
    hourly = days.selectExpr(
        "date", "respondent", f"explode(sequence(0, {contract.hours_per_day - 1})) AS hour"
    )
    return hourly.selectExpr(
        "concat(date_format(date, 'yyyy-MM-dd'), 'T', lpad(hour, 2, '0')) AS period",
        "respondent",
        f"explode(array({sql_list(contract.types)})) AS type",
    )


def coverage_gaps(
    actual: DataFrame, expected: DataFrame, keys: Sequence[str] = READING_KEY
) -> DataFrame:
    """Keys on one side only, as ``missing`` or ``unexpected``.

    Both sides go through one aggregate instead of two anti joins, and rows of
    one key fold together before they move.
    """
    sides = expected.selectExpr(*keys, "1 AS e", "0 AS a").unionByName(
        actual.selectExpr(*keys, "0 AS e", "1 AS a")
    )
    found = sides.groupBy(*keys).agg(F.expr("max(e) AS e"), F.expr("max(a) AS a"))
    return found.filter("e <> a").selectExpr(
        *keys, "CASE WHEN a = 0 THEN 'missing' ELSE 'unexpected' END AS gap"
    )


def audit_days(records: DataFrame, contract: SeriesContract) -> DataFrame:
    """Per declared day: records, nulls, duplicates, missing and unexpected keys.

    ``records`` carries the declared ``date`` next to the reading key and
    ``value``. Whether a key belongs to its day can be told from the row alone,
    so no grid is joined.
    """
    fits = f"to_date({period_sql()}) = date AND type IN ({sql_list(contract.types)})"
    if contract.respondents is not None:
        fits += f" AND respondent IN ({sql_list(contract.respondents)})"
    keys = records.groupBy("date", *READING_KEY).agg(
        F.expr("count(*) AS n"), F.expr("sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS nulls")
    )
    judged = keys.selectExpr("*", f"coalesce({fits}, false) AS fits")
    per_day = judged.groupBy(*DAY_KEY).agg(
        F.expr("sum(n) AS records"),
        F.expr("sum(nulls) AS null_values"),
        F.expr("count(CASE WHEN n > 1 THEN 1 END) AS duplicate_keys"),
        F.expr("count(CASE WHEN NOT fits THEN 1 END) AS unexpected_keys"),
        F.expr(f"{contract.records_per_day} - count(CASE WHEN fits THEN 1 END) AS missing_keys"),
    )
    return per_day.selectExpr(
        "*", "null_values + duplicate_keys + unexpected_keys + missing_keys = 0 AS is_valid"
    )
