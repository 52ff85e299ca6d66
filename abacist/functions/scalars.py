"""Column expressions: safe casts, ages, dates, text tests, rule tables and exact money aggregates.

Every function returns a ``Column`` built from JVM expressions, so it stays inside whole-stage code
generation and filters built from it still reach the scan where Spark allows it.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_cast(c: ColumnOrName, type_name: str) -> Column:
    """Cast that gives null where the text does not parse."""
    return as_col(c).try_cast(type_name)


def safe_divide(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Quotient, null when the divisor is zero."""
    return F.try_divide(as_col(a), as_col(b))


def strip_quotes(c: ColumnOrName) -> Column:
    return F.trim(as_col(c), F.lit('"'))


def first_int(c: ColumnOrName) -> Column:
    """First run of digits in a text, null when there is none."""
    return F.nullif(F.regexp_extract(as_col(c), r"\d+", 0), F.lit("")).cast("long")


def iso_date(c: ColumnOrName) -> Column:
    """Date part of an ISO date-time text."""
    return F.split(as_col(c), "T")[0].try_cast("date")


def two_digit_date(c: ColumnOrName, century: str = "19") -> Column:
    """``yyMMdd`` text or number to a date; the century is given, not guessed."""
    text = F.lpad(F.substring(as_col(c).cast("string"), 1, 6), 6, "0")
    return F.to_date(F.concat(F.lit(century), text), "yyyyMMdd")


def days_before(as_of: date | ColumnOrName, n: int) -> Column:
    return F.date_sub(F.lit(as_of) if isinstance(as_of, date) else as_col(as_of), n)


def date_of(y: int, m: int, d: int) -> Column:
    return F.make_date(F.lit(y), F.lit(m), F.lit(d))


def compact_date(c: ColumnOrName) -> Column:
    """Date shown as 24JAN2011."""
    return F.upper(F.date_format(as_col(c), "ddMMMyyyy"))


def days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    return F.datediff(as_col(end), as_col(start))


def age_in_years(birth: ColumnOrName, as_of: ColumnOrName) -> Column:
    """Days over 365, one decimal."""
    return F.round(F.datediff(as_col(as_of), as_col(birth)) / F.lit(365), 1)


def age_brought_forward(age: ColumnOrName, known_on: ColumnOrName, as_of: ColumnOrName) -> Column:
    """Age known on one day, moved to a later day and floored to whole years."""
    return F.floor(as_col(age) + F.months_between(as_col(as_of), as_col(known_on)) / 12)


def calendar_years(birth: ColumnOrName, as_of: ColumnOrName) -> Column:
    return F.year(as_col(as_of)) - F.year(as_col(birth))


def later(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Later of two timestamps; a null side is ignored."""
    return F.greatest(as_col(a), as_col(b))


def finite_or_zero(c: ColumnOrName) -> Column:
    c = as_col(c)
    return F.when(F.abs(c) == F.lit(math.inf), F.lit(0.0)).otherwise(c)


def round_all(names: Iterable[str], places: int = 0) -> dict[str, Column]:
    """``withColumns`` argument that rounds each named column, half away from zero."""
    return {n: F.round(F.col(n), places) for n in names}


def text_match(c: ColumnOrName, text: str, mode: str = "contains") -> Column:
    """Literal text test: ``exact``, ``contains`` or ``prefix``; no character is a wildcard."""
    c = as_col(c)
    if mode == "exact":
        return c == F.lit(text)
    if mode == "contains":
        return c.contains(text)
    if mode == "prefix":
        return c.startswith(text)
    raise ValueError(f"unknown mode {mode!r}")


def any_match(tests: Sequence[tuple[str, str, str]]) -> Column:
    """True when one of the (column, mode, text) tests holds."""
    return reduce(lambda a, b: a | b, (text_match(c, text, mode) for c, mode, text in tests))


def case_map(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """First rule that holds gives the value."""
    out = F
    for cond, value in rules:
        out = out.when(cond, value if isinstance(value, Column) else F.lit(value))
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def if_else(cond: Column, a: object, b: object) -> Column:
    return case_map([(cond, a)], b)


def map_value(c: ColumnOrName, mapping: Mapping[str, object]) -> Column:
    """Value for a key from a short fixed mapping, null for other keys."""
    c = as_col(c)
    return case_map([(c == F.lit(k), v) for k, v in mapping.items()])


def units(c: ColumnOrName, scale: int) -> Column:
    """An amount as whole units of its decimal place ``scale``; further places are rounded."""
    return F.rint(as_col(c) * F.lit(float(10**scale))).cast("long")


EXACT = "decimal(38,18)"
"""Type of exact totals: 20 digits before the point and 18 behind it."""


def exact_total(c: ColumnOrName) -> Column:
    """Sum of numbers, added as decimals.

    Double sums depend on the order in which partitions are merged, so a retried task can change
    the last digits. Decimal sums do not, and a total of more than 20 digits before the point raises.
    Each number counts with all digits that it prints; only those behind the 18th place are rounded,
    which numbers of at least 0.1 do not have.
    """
    return F.sum(as_col(c).cast(EXACT))


SMALL, PLAIN, LARGE = (1e-30, 1e-9), (1e-9, 1e15), (1e15, 1e30)
"""Absolute values that are added as decimals with 34, 18 and 3 places."""


def is_plain(c: ColumnOrName) -> Column:
    size = F.abs(as_col(c))
    return (size < PLAIN[1]) & ((size >= PLAIN[0]) | (size == 0))


def total_parts(c: ColumnOrName) -> tuple[Column, Column]:
    """``exact_total`` of the plain numbers and ``exact_sum`` of all others, null without any: totals that are added up again."""
    c = as_col(c)
    return exact_total(F.when(is_plain(c), c)), exact_sum(F.when(~is_plain(c), c))


def exact_sum(c: ColumnOrName) -> Column:
    """Sum as double that does not depend on the order of the rows.

    Numbers of ``PLAIN`` size and zeros are an ``exact_total``; smaller and larger ones have decimal totals of
    their own with 34 and 3 places, and only what lies beyond these is added as doubles. The totals, each exact,
    are then added in a fixed order. NaN and infinite numbers decide the sum as in ``F.sum``.
    """
    c = as_col(c)
    size = F.abs(c)

    def total(cond: Column, type_: str) -> Column:
        return F.sum(F.when(cond, c.cast(type_)))

    def within(span: tuple[float, float]) -> Column:
        return (size >= span[0]) & (size < span[1])

    plain = total(is_plain(c), EXACT).cast("double")
    beyond = (size < math.inf) & ((size >= LARGE[1]) | (size < SMALL[0]) & (size > 0))
    others = [total(within(SMALL), "decimal(38,34)"), total(within(LARGE), "decimal(38,3)"), total(beyond, "double")]
    not_finite = total(size >= math.inf, "double")
    whole = reduce(lambda a, b: a + b, (F.coalesce(t.cast("double"), F.lit(0.0)) for t in [*others, plain]))
    some = reduce(lambda a, b: a | b, (t.isNotNull() for t in others))
    return F.coalesce(not_finite, F.when(some, whole).otherwise(plain))


def exact_mean(c: ColumnOrName) -> Column:
    """Exact sum over the count; null for no rows."""
    return F.try_divide(exact_sum(c), F.count(as_col(c)))
