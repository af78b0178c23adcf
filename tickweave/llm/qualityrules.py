"""Quality rules: a learned decision list over statistics of the text.

Sequential covering: a rule is grown as a conjunction of threshold conditions
by information gain on two thirds of the labelled rows that pass the base rule,
pruned on the rest, and kept if it is precise; the rows that it covers are taken
out and the next rule is grown, from another condition if one was not precise. The list is emitted as one ordered Spark ``when`` expression.
DataFrame functions only; the driver sees a bounded sample of labelled
statistics (``LABELLED_ROWS``, a parameter of the fit).

Defined results: a null or empty text has no words and fails the base rule;
repeated rows and null ids are judged row by row; without labels of both kinds
the list is empty and only the base rule speaks; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm.common import label_sample, labelled_texts
from tickweave.llm.textstats import share, with_counts, with_repeats, with_words

LABELLED_ROWS = 20_000
P = "__op5_"


def with_stats(df: DataFrame, text: str) -> DataFrame:
    df = with_repeats(with_counts(with_words(df, text, P), P), P)
    w, n = F.col(f"{P}w"), F.col(f"{P}n_words")
    chars, lines = F.col(f"{P}word_chars"), F.col(f"{P}n_lines")
    return df.withColumns({
        f"{P}mean_word": share(chars, n),
        f"{P}symbol_share": share(F.col(f"{P}n_symbols"), chars),
        f"{P}dup_line_share": share(F.col(f"{P}n_dup_lines"), lines),
        f"{P}repeat_share": share(F.col(f"{P}n_repeat_words"), n),
        f"{P}distinct_share": share(F.size(F.array_distinct(w)), n),
        f"{P}words_a_line": share(n, lines),
    }).drop(f"{P}t", f"{P}w")


FEATURES = ("n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "words_a_line")


@dataclass(frozen=True)
class Condition:
    feature: int
    above: bool
    cut: float

    def holds(self, x: tuple) -> bool:
        return x[self.feature] > self.cut if self.above else x[self.feature] <= self.cut

    def expression(self) -> Column:
        c = F.col(f"{P}{FEATURES[self.feature]}")
        return c > self.cut if self.above else c <= self.cut

    def __str__(self) -> str:
        return f"{FEATURES[self.feature]} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def _masks(rows: list[tuple], cuts: int) -> dict[Condition, int]:
    """For each candidate condition, the rows that it covers as a bit set."""
    out = {}
    for f in range(len(rows[0])):
        order = sorted(range(len(rows)), key=lambda i: rows[i][f])
        values = [rows[i][f] for i in order]
        wanted = {values[min(len(values) - 1, k * len(values) // cuts)] for k in range(cuts)}
        low, full = 0, (1 << len(rows)) - 1
        for place, i in enumerate(order):
            low |= 1 << i
            if values[place] in wanted and (place + 1 == len(values) or values[place + 1] > values[place]):
                out[Condition(f, False, values[place])] = low
                out[Condition(f, True, values[place])] = full ^ low
    return out


def _merged(rule: Rule) -> Rule:
    """The rule without conditions that a narrower one on the same side of the same
    statistic implies."""
    kept: dict[tuple[int, bool], Condition] = {}
    for c in rule:
        old = kept.get((c.feature, c.above))
        if old is None or (c.cut > old.cut if c.above else c.cut < old.cut):
            kept[c.feature, c.above] = c
    return tuple(kept.values())


def learn(rows: list[tuple], bad: list[bool], cuts: int = 64, most_conditions: int = 3, most_rules: int = 12,
          precision: float = 0.95, least: int = 5) -> list[Rule]:
    """Rules whose rows are bad. ``rows``: statistics in the order of FEATURES.
    A rule is taken if at least ``precision`` of its rows are bad. One that misses
    that ends nothing: its first condition is set aside and another rule is grown."""
    if not rows or all(bad) or not any(bad):
        return []
    masks = _masks(rows, cuts)
    full = (1 << len(rows)) - 1
    is_bad = sum(1 << i for i, b in enumerate(bad) if b)
    prune = sum(1 << i for i in range(0, len(rows), 3))
    left, rules, aside = full, [], set()

    def counts(mask: int) -> tuple[int, int]:
        return (mask & is_bad).bit_count(), (mask & ~is_bad).bit_count()

    def covered(rule: Rule, within: int) -> int:
        for c in rule:
            within &= masks[c]
        return within

    while len(rules) < most_rules:
        now, rule = left & ~prune, ()
        p, n = counts(now)
        while n and p and len(rule) < most_conditions:
            best, gain = None, 0.0
            for c, m in masks.items():
                if not rule and c in aside:
                    continue
                q, k = counts(now & m)
                if q >= least and (g := q * (math.log2(q / (q + k)) - math.log2(p / (p + n)))) > gain + 1e-9:
                    best, gain = c, g
            if best is None:
                break
            rule, now = (*rule, best), now & masks[best]
            p, n = counts(now)
        if not rule:
            break
        first = rule[0]

        def worth(r: Rule) -> float:
            q, k = counts(covered(r, left & prune))
            return (q - k) / (q + k) if q + k else -1.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        rule = _merged(rule)
        p, n = counts(covered(rule, left))
        if p < least or p < precision * (p + n):
            aside.add(first)
            continue
        rules.append(rule)
        aside.clear()
        left &= ~covered(rule, full)
    return rules


def base_failed(p: str = P) -> Column:
    n, rep = F.col(f"{p}n_words"), F.col(f"{p}n_repeat_words")
    return (n < 20) | (100 * rep > 30 * n)


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS) -> list[Rule]:
    """The decision list for ``labels.quality``, from rows outside the held-out fold
    that pass the base rule: only those are left for the list to judge."""
    sample = label_sample(spark, labels, "quality", labelled_rows)
    rows = labelled_texts(docs, sample, labelled_rows)
    stats = with_stats(rows, "text").select("doc_id", *[F.col(f"{P}{f}").cast("double").alias(f) for f in FEATURES], "y", base_failed().alias("failed"))
    seen = sorted(tuple(r)[:-1] for r in stats.collect() if not r["failed"])
    return learn([r[1:-1] for r in seen], [r[-1] == 0 for r in seen])


def verdict(rules: list[Rule]) -> Column:
    """The list as an ordered conditional expression: true for good."""
    e = F.when(F.lit(False), F.lit(False))
    for rule in rules:
        cond = F.lit(True)
        for c in rule:
            cond = cond & c.expression()
        e = e.when(cond, F.lit(False))
    return e.otherwise(F.lit(True))


def judge(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """doc_id, the base counts, base_failed and kept of every row."""
    rows = with_stats(docs.select(F.col("doc_id"), F.col(text).alias("text")), "text")
    failed = base_failed()
    return rows.select("doc_id", *[F.col(f"{P}{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                       failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"))
