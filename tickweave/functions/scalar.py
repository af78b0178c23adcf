"""Column expressions for the reference's one-line numeric/text helpers.

All are built-in Spark expressions (codegen'd, ANSI-safe): logs are NULL for
non-positive input instead of -inf/NaN, divisions by zero give NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ln1p(x: str | Column) -> Column:
    """ln(x + 1); NULL where x + 1 <= 0."""
    v = _c(x) + F.lit(1.0)
    return F.when(v > 0, F.ln(v))


def log10_pos(x: str | Column) -> Column:
    """log10(x); NULL where x <= 0."""
    return F.when(_c(x) > 0, F.log10(_c(x)))


def expm1(x: str | Column) -> Column:
    """exp(x) - 1, the inverse of ln1p."""
    return F.exp(_c(x)) - F.lit(1.0)


def safe_div(a: str | Column, b: str | Column) -> Column:
    """a / b, NULL when b is 0 or NULL (ANSI mode would throw)."""
    return F.try_divide(_c(a), F.nullif(_c(b), F.lit(0.0)))


def r6(x: str | Column) -> Column:
    """Round a computed double to 6 places (oracle comparisons)."""
    return F.round(_c(x), 6)


def parse_money(x: str | Column) -> Column:
    """'$1,234.50' -> 1234.5; unparseable text -> NULL."""
    return F.regexp_replace(_c(x), r"[$,\s]", "").try_cast("double")


def parse_day(x: str | Column, fmt: str = "MMM d, yyyy") -> Column:
    """Day text (e.g. 'Sep 22, 2021') -> date; unparseable -> NULL."""
    return F.try_to_timestamp(_c(x), F.lit(fmt)).cast("date")


def slug(x: str | Column) -> Column:
    """Lower-case, spaces to dashes (currency name -> URL/path component)."""
    return F.regexp_replace(F.lower(F.trim(_c(x))), r"\s+", "-")


def epoch_to_ts(x: str | Column) -> Column:
    """Epoch seconds (number or text) -> timestamp (session time zone UTC)."""
    return F.timestamp_seconds(_c(x).try_cast("bigint"))


def date_text(x: str | Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(_c(x), fmt)


def idiv(a: str | Column, b: str | Column | int) -> Column:
    """Integral division (SQL ``div``), exact for bigint; NULL divisor -> NULL."""
    bb = F.lit(b) if isinstance(b, int) else _c(b)
    return F.call_function("div", _c(a), bb)
