"""Statistics of whole texts in DataFrame functions (used by op5 and op9).

Each step is a projection of its own whose columns are used more than once by
the next, so that no array is computed again inside a lambda. Names begin with
``prefix``, so columns of the input cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import SPACE_CLASS

WINDOW = 8
WORD = r"[^\x20\x09-\x0D]"


def share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def with_words(df: DataFrame, text: str, prefix: str) -> DataFrame:
    """Adds t (the text, never null) and w (its words)."""
    df = df.withColumn(f"{prefix}t", F.coalesce(F.col(text).cast("string"), F.lit("")))
    return df.withColumn(f"{prefix}w", F.array_remove(F.split(f"{prefix}t", SPACE_CLASS), ""))


def with_counts(df: DataFrame, prefix: str) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines and n_dup_lines."""
    t, w = F.col(f"{prefix}t"), F.col(f"{prefix}w")
    df = df.withColumn(f"{prefix}lines", F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD)))
    lines = F.col(f"{prefix}lines")
    return df.withColumns({
        f"{prefix}n_words": F.size(w).cast("long"),
        f"{prefix}word_chars": F.length(F.array_join(w, "")).cast("long"),
        f"{prefix}n_symbols": F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long"),
        f"{prefix}n_lines": F.size(lines).cast("long"),
        f"{prefix}n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
    }).drop(f"{prefix}lines")


def with_repeats(df: DataFrame, prefix: str) -> DataFrame:
    """Adds n_repeat_words: words inside windows of eight words that the text
    has twice or more. Windows are told apart by their 64-bit hash; texts
    without an equal pair (nearly all) stop after one pass."""
    w = F.col(f"{prefix}w")
    none = F.array().cast("array<bigint>")
    df = df.withColumn(f"{prefix}h", F.when(F.size(w) >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))).otherwise(none))
    h = F.col(f"{prefix}h")
    pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    df = df.withColumn(f"{prefix}s", F.when(F.size(F.array_distinct(h)) < F.size(h), pairs))
    s = F.col(f"{prefix}s")
    twice = F.transform(s, lambda x, k: F.when((x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]), x["i"]))
    df = df.withColumn(f"{prefix}p", F.when(s.isNotNull(), F.array_sort(F.filter(twice, lambda i: i.isNotNull()))))
    p = F.col(f"{prefix}p")
    covered = F.transform(p, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - i, F.lit(WINDOW))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    df = df.withColumn(f"{prefix}n_repeat_words", F.coalesce(F.when(p.isNotNull(), total), F.lit(0).cast("long")))
    return df.drop(f"{prefix}h", f"{prefix}s", f"{prefix}p")
