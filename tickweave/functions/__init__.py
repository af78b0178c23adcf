"""Scalar column functions (JVM-side expressions only)."""

from tickweave.functions.scalar import (
    date_text,
    epoch_to_ts,
    expm1,
    idiv,
    ln1p,
    log10_pos,
    parse_day,
    parse_money,
    r6,
    safe_div,
    slug,
)

__all__ = [
    "ln1p",
    "idiv",
    "log10_pos",
    "expm1",
    "safe_div",
    "r6",
    "parse_money",
    "parse_day",
    "slug",
    "epoch_to_ts",
    "date_text",
]
