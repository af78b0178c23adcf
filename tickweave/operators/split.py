"""Splits: chronological cuts, last-k, time strata, stratified holdout, hash split.

All are narrow (position arithmetic on a sequenced frame) except the
stratified holdout, which finds a hash threshold per stratum (no window over a
whole stratum).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickweave.functions.scalar import idiv

from tickweave.plans.small import bounded_broadcast
from tickweave.schema import KEY, TIE


def ordered_split(
    sdf: DataFrame,
    cuts: Sequence[float] = (0.9, 0.95),
    names: Sequence[str] = ("train", "val", "test"),
    out: str = "split",
) -> DataFrame:
    """Pos < int(n*cut1) -> names[0], < int(n*cut2) -> names[1], ...
    (C11: truncation of the double product, like Python ``int(n*.9)``)."""
    if len(names) != len(cuts) + 1:
        raise ValueError("need one more name than cuts")
    expr: Column = F.lit(names[-1])
    for cut, name in reversed(list(zip(cuts, names))):
        bound = F.floor(F.col("n").cast("double") * F.lit(float(cut)))
        expr = F.when(F.col("pos") < bound, F.lit(name)).otherwise(expr)
    return sdf.withColumn(out, expr)


def last_k_split(sdf: DataFrame, k: int, names: Sequence[str] = ("train", "test"), out: str = "split") -> DataFrame:
    """The last k rows of each series are the test split."""
    return sdf.withColumn(out, F.when(F.col("pos") >= F.col("n") - F.lit(k), names[1]).otherwise(names[0]))


def time_strata(sdf: DataFrame, k: int = 12, out: str = "stratum") -> DataFrame:
    """K equal strata of n div k rows, the remainder joins the last
    (not ntile). With n < k all rows fall in stratum k-1."""
    size = idiv("n", k)
    return sdf.withColumn(
        out,
        F.when(size == 0, F.lit(k - 1)).otherwise(F.least(idiv("pos", F.greatest(size, F.lit(1))), F.lit(k - 1))),
    )


def allocated(sizes: DataFrame, frac: float, key: str = KEY, stratum: str = "stratum") -> DataFrame:
    """W13, exact allocation: ``sizes`` (key, stratum, size) with ``held``, how many
    rows of each stratum are held out, by largest remainders. Of n rows of a series
    ceil(frac * n) are held out in all; the others are shared out in proportion,
    whole parts first, the rest to the strata with the largest remainders (of equal
    ones to the first)."""
    series = Window.partitionBy(key)  # one row a stratum
    n = F.sum("size").over(series)
    kept = n - F.ceil(n.cast("double") * F.lit(float(frac))).cast("bigint")
    x = sizes.withColumns({"_n": n, "_kept": kept})
    x = x.withColumns({"_whole": idiv(F.col("size") * F.col("_kept"), F.col("_n")), "_over": F.col("size") * F.col("_kept") % F.col("_n")})
    place = F.row_number().over(series.orderBy(F.desc("_over"), stratum))
    more = (place <= F.col("_kept") - F.sum("_whole").over(series)).cast("bigint")
    return x.withColumn("held", F.col("size") - F.col("_whole") - more).select(*sizes.columns, "held")


def stratified_holdout(
    sdf: DataFrame,
    frac: float = 0.1111,
    stratum: str = "stratum",
    key: str = KEY,
    tie: str = TIE,
    out: str = "holdout",
    digits: int = 3,
    allocate: str = "share",
) -> DataFrame:
    """In every (series, stratum) mark the round(frac * size) rows with
    the smallest md5(tie) as holdout (a deterministic stratified shuffle); with
    ``allocate`` = "total" as many as ``allocated`` says, so that a series' total is
    the asked share of its rows.
    ``tie`` is unique; rows that share one are marked together.

    Exact and skew-safe. The hash's leading ``digits`` hex digits cut a stratum
    into 16^digits buckets, whatever its size. Bucket counts give each stratum's
    boundary bucket; only its rows (a 4,096th) are ranked, which gives one
    threshold (hash, tie) per stratum. One scan then labels every row by comparing
    it with its threshold.
    """
    x = sdf.select(F.struct(key, stratum).alias("_g"), F.col(tie).alias("_tie"), F.md5(F.col(tie).cast("string")).alias("_h"))
    x = x.withColumn("_b", F.substring("_h", 1, digits))
    counts = x.groupBy("_g", "_b").agg(F.count(F.lit(1)).alias("_c"))
    whole = Window.partitionBy("_g")  # at most 16^digits rows
    before = F.sum("_c").over(whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_c")
    m = F.round(F.sum("_c").over(whole).cast("double") * F.lit(float(frac))).cast("bigint")
    if allocate == "total":
        sizes = counts.groupBy("_g").agg(F.sum("_c").alias("size")).select(F.col("_g")[key].alias(key), F.col("_g")[stratum].alias(stratum), "size")
        held = allocated(sizes, frac, key, stratum).select(F.struct(key, stratum).alias("_g"), F.col("held").alias("_held"))
        counts, m = counts.join(bounded_broadcast(held), "_g"), F.col("_held")
    edge = counts.select("_g", "_b", "_c", before.alias("_before"), m.alias("_m"))
    edge = edge.filter((F.col("_before") < F.col("_m")) & (F.col("_before") + F.col("_c") >= F.col("_m")))
    edge = edge.select("_g", "_b", (F.col("_m") - F.col("_before")).alias("_left"))
    rk = F.row_number().over(Window.partitionBy("_g").orderBy("_h", "_tie"))
    last = x.join(bounded_broadcast(edge), ["_g", "_b"]).withColumn("_r", rk).filter("_r = _left")
    last = bounded_broadcast(last.select("_g", F.struct("_h", "_tie").alias("_last")))
    own = F.struct(F.md5(F.col(tie).cast("string")).alias("_h"), F.col(tie).alias("_tie"))
    marked = sdf.withColumn("_g", F.struct(key, stratum)).join(last, "_g", "left")
    return marked.withColumn(out, F.coalesce(own <= F.col("_last"), F.lit(False))).select(*sdf.columns, out)


def split_chain(windows: DataFrame, cut: float = 0.9, k: int = 12, frac: float = 0.1111, key: str = KEY, tie: str = "window_id",
                out: str = "split") -> DataFrame:
    """W9 + W12 + W13 over windows (or any sequenced rows): the first int(cut * n) of
    each series are training and validation, the rest test; of the first, k time
    strata give ``frac`` of their rows, exactly allocated, to the validation."""
    first = F.floor(F.col("n").cast("double") * F.lit(float(cut))).cast("bigint")
    head = windows.filter(F.col("pos") < first).withColumn("n", first)
    held = stratified_holdout(time_strata(head, k, "_stratum"), frac, "_stratum", key, tie, "_held", allocate="total")
    name = F.when(F.col("_held"), "val").otherwise("train")
    back = held.select(*[c for c in windows.columns if c != "n"], name.alias(out))
    rest = windows.filter(F.col("pos") >= first).select(*[c for c in windows.columns if c != "n"], F.lit("test").alias(out))
    return back.unionByName(rest)


def hash_bucket(tie: str, digits: int = 7) -> Column:
    """The first ``digits`` hex digits of md5(tie) as a number."""
    return F.conv(F.substring(F.md5(F.col(tie).cast("string")), 1, digits), 16, 10).cast("bigint")


def hash_split(
    df: DataFrame,
    portion: float,
    tie: str = TIE,
    names: Sequence[str] = ("train", "test"),
    out: str = "split",
    digits: int = 7,
) -> DataFrame:
    """M7: deterministic random split (C17): bucket = first ``digits`` hex
    digits of md5(tie); bucket < portion * 16^digits -> names[0]. Unlike
    ``randomSplit`` it does not change with partitioning."""
    return df.withColumn(out, F.when(hash_bucket(tie, digits) < F.lit(portion * 16.0**digits), names[0]).otherwise(names[1]))
