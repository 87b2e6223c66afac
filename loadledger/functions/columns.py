"""Column expressions. All of them are built-in functions, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadledger.contract import ABS_TOLERANCE, EXACT, NEWEST, PERIOD_FORMAT, REL_TOLERANCE


def column(name: Column | str) -> Column:
    return F.col(name) if isinstance(name, str) else name


def sql_text(value: str) -> str:
    """A string literal for SQL expressions."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def sql_list(values: Sequence[str]) -> str:
    return ", ".join(sql_text(value) for value in values)


def period_sql(period: str = "period") -> str:
    """SQL for ``parse_period``."""
    return f"try_to_timestamp({period}, {sql_text(PERIOD_FORMAT)})"


def exact_sum_sql(value: str) -> str:
    """SQL for ``exact_sum``."""
    return f"sum(CAST({value} AS {EXACT}))"


def safe_numeric(raw: Column | str) -> Column:
    """Text to double; text that is no number gives null instead of an error."""
    return column(raw).try_cast("double")


def parse_period(period: Column | str) -> Column:
    """Hour text such as ``2026-09-26T00`` to a timestamp; null when malformed."""
    return F.try_to_timestamp(column(period), F.lit(PERIOD_FORMAT))


def period_date(period: Column | str) -> Column:
    return F.to_date(parse_period(period))


def normalize_hour(text: Column | str) -> Column:
    """``2026-09-26T05:00:00Z``, ``2026-09-26 05:00`` and ``2026-09-26T05`` to one key."""
    spaced = F.replace(column(text), F.lit("T"), F.lit(" "))
    return F.substring(F.replace(spaced, F.lit("Z"), F.lit("")), 1, 13)


def normalize_date(text: Column | str) -> Column:
    return F.substring(column(text).cast("string"), 1, 10)


def first_present(
    df: DataFrame, candidates: Sequence[str], numeric: bool = False, strict: bool = True
) -> Column:
    """First non-empty value among the candidate columns that ``df`` has.

    ``strict`` fails the row in which every candidate is empty, or whose number
    does not parse; otherwise such a row gives null.
    """
    found = [F.col(f"`{name}`").cast("string") for name in candidates if name in df.columns]
    if not found:
        raise KeyError(f"none of {list(candidates)} among {df.columns}")
    text = F.coalesce(*[F.when(c != "", c) for c in found])
    if not strict:
        return safe_numeric(text) if numeric else text
    message = F.lit(f"no value in any of {list(candidates)}")
    text = F.coalesce(text, F.raise_error(message).cast("string"))
    return text.cast("double") if numeric else text


def close_sql(
    a: str, b: str, abs_tol: float = ABS_TOLERANCE, rel_tol: float = REL_TOLERANCE
) -> str:
    """SQL for ``is_close``."""
    allowed = f"greatest({abs_tol}D, {rel_tol}D * greatest(abs({a}), abs({b})))"
    return f"({a} = {b} OR abs({a} - {b}) <= {allowed})"


def is_close(
    a: str, b: str, abs_tol: float = ABS_TOLERANCE, rel_tol: float = REL_TOLERANCE
) -> Column:
    """Equal within the absolute or the relative tolerance, whichever is wider."""
    return F.expr(close_sql(a, b, abs_tol, rel_tol))


def is_newer(source: str, target: str, order: Sequence[str] = NEWEST) -> Column:
    """Whether the row aliased ``source`` comes after the one aliased ``target``.

    Compares column by column; a null on either side never counts as newer.
    """
    newer = "false"
    for name in reversed(order):
        mine, theirs = f"{source}.`{name}`", f"{target}.`{name}`"
        newer = f"({mine} > {theirs} OR ({mine} = {theirs} AND {newer}))"
    return F.expr(f"coalesce({newer}, false)")


def content_fingerprint(content: Column | str) -> Column:
    """SHA-256 of the bytes, as lower-case hex."""
    return F.sha2(column(content), 256)


def exact_sum(name: Column | str) -> Column:
    """Sum whose result does not depend on the order of the rows (still a decimal)."""
    return F.sum(column(name).cast(EXACT))
