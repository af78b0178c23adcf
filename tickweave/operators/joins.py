"""Positional joins. The reference has no join call; these are the joins it
does by hand (zip by position, attach fitted stats, score with actual)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickweave.schema import KEY


def zip_by_position(a: DataFrame, b: DataFrame, key: str = KEY, a_cols=("x",), b_cols=("y",)) -> DataFrame:
    """Rows of two sequenced frames with the same (series, pos). A hash
    join on (series, pos): the position spreads a hot series over all tasks."""
    left = a.select(key, "pos", *a_cols)
    right = b.select(key, "pos", *b_cols)
    return left.join(right, [key, "pos"])

