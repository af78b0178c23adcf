"""Registered queries: one per operator of the inventory, each with the
equivalent DuckDB SQL used as an independent oracle.

Every query reads the driver tables (``events`` via the tick adapter, or
``lineitem``) in full. Computed doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.functions.scalar import (
    date_text,
    epoch_to_ts,
    expm1,
    ln1p,
    log10_pos,
    parse_money,
    r6,
    slug,
)
from tickweave.operators import corr as C
from tickweave.operators import metrics as M
from tickweave.operators import position as P
from tickweave.operators import scale as S
from tickweave.operators import split as SP
from tickweave.operators import stats as ST
from tickweave.operators import transform as TR
from tickweave.operators import windows as W
from tickweave.operators.joins import zip_by_position
from tickweave.plans.sequence import sequence
from tickweave.sources.events import load_table, ticks_from_events

BASE = "click"  # base series of the correlation sweeps
HOURLY = 12  # every-12th row: 5-minute ticks -> hourly

_SEQ_CACHE: dict[tuple, DataFrame] = {}


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequenced tick table of ``sf_dir``; its cut points are sampled once per
    session and data directory (a lazy plan, nothing is written)."""
    raw = ticks_from_events(spark, sf_dir)
    # replaced files change the key: their times and sizes are part of it
    meta = load_table(spark, sf_dir, "events").select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    stamp = meta.distinct().agg(F.count("*"), F.sum(F.xxhash64(*meta.columns).cast("decimal(38,0)"))).first()
    key = (spark.sparkContext.applicationId, sf_dir, *stamp)
    df = _SEQ_CACHE.get(key)
    if df is not None:
        return df
    df = sequence(raw)
    _SEQ_CACHE[key] = df
    return df


def raw_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_from_events(spark, sf_dir)


def hourly(spark: SparkSession, sf_dir: str, drop_first: int = 0) -> DataFrame:
    return P.every_nth(ticks(spark, sf_dir), HOURLY, drop_first)


FEATS = ("price", "volume", "market_cap")


# ---------------------------------------------------------------- queries
def q_w1_position(spark, d):
    return ticks(spark, d).select("event_id", "currency", "pos", "n")


def q_w2_every_nth(spark, d):
    return hourly(spark, d).select("event_id", "currency", r6("price").alias("price"), "pos", "n")


def q_w2_every_nth_drop1(spark, d):
    return hourly(spark, d, 1).select("event_id", "currency", "pos", "n")


def q_p3_one_currency(spark, d):
    return raw_ticks(spark, d).filter(F.col("currency") == BASE).select("event_id", "dt", r6("price").alias("price"))


def q_p4_currencies(spark, d):
    return raw_ticks(spark, d).filter(F.col("currency").isin("click", "view")).select("event_id", "currency")


def q_p2_typed(spark, d):
    ev = load_table(spark, d, "events")
    j = ev.select("event_id", F.get_json_object("props", "$.k").alias("k_text"))
    return TR.typed(j, {"k_text": "bigint"}).select("event_id", F.col("k_text").alias("k"))


def q_p7_derived(spark, d):
    return raw_ticks(spark, d).select(
        "event_id",
        r6(F.col("price") * F.col("volume")).alias("turnover"),
        r6(ln1p("market_cap")).alias("log_mcap"),
    )


def q_p9_rescale(spark, d):
    x = TR.rescale(raw_ticks(spark, d), "price", 1000, "price_k")
    x = TR.rescale(x, "price_k", 1 / 1000, "price_back")
    return x.select("event_id", r6("price_k").alias("price_k"), r6("price_back").alias("price_back"))


def q_p10_row_at(spark, d):
    return P.row_at(ticks(spark, d), 100).select("currency", "event_id", r6("price").alias("price"))


def q_p11_stack(spark, d):
    s = TR.stack_features(TR.log1p_features(raw_ticks(spark, d)))
    return s.select("event_id", F.posexplode("features").alias("k", "v")).select(
        "event_id", F.col("k").cast("bigint").alias("k"), r6("v").alias("v")
    )


def q_s9_money(spark, d):
    li = load_table(spark, d, "lineitem")
    txt = F.concat(F.lit("$"), F.format_number("l_extendedprice", 2))
    return li.select("l_orderkey", "l_linenumber", txt.alias("money_text")).select(
        "l_orderkey", "l_linenumber", "money_text", parse_money("money_text").alias("amount")
    )


def q_f1_log1p(spark, d):
    x = TR.log1p_features(raw_ticks(spark, d), suffix="_ln")
    return x.select("event_id", *[r6(f"{c}_ln").alias(f"{c}_ln") for c in FEATS])


def q_f2_log10(spark, d):
    return raw_ticks(spark, d).select("event_id", r6(log10_pos("price")).alias("log10_price"))


def q_f3_expm1(spark, d):
    return raw_ticks(spark, d).select("event_id", r6(expm1(ln1p("price"))).alias("price_back"))


def q_f5_epoch(spark, d):
    ev = load_table(spark, d, "events")
    e = F.unix_seconds(F.col("ts").cast("timestamp"))
    return ev.select("event_id", e.alias("epoch"), date_text(epoch_to_ts(e)).alias("ts_text"))


def q_f6_dates(spark, d):
    ev = load_table(spark, d, "events")
    day = F.to_date("ts")
    return ev.select(
        "event_id", day.alias("d_"), F.date_add(day, 1).alias("next_d"),
        F.unix_date(day).cast("bigint").alias("epoch_day"),
    )


def q_f7_slug(spark, d):
    ev = load_table(spark, d, "events").select("event_type").distinct()
    return ev.select(
        F.col("event_type").alias("currency"),
        slug(F.concat(F.initcap("event_type"), F.lit("  Coin"))).alias("slug"),
        F.replace(F.col("event_type"), F.lit("i"), F.lit("1")).alias("replaced"),
    )


def q_f9_flatten(spark, d):
    w = W.sliding_windows(hourly(spark, d), FEATS, n_in=35, n_out=3)
    f = W.flatten_windows(w, FEATS)
    return f.select("currency", "window_id", F.col("k").cast("bigint").alias("k"), r6("v").alias("v"))


def q_a1_count(spark, d):
    return raw_ticks(spark, d).groupBy("currency").agg(F.count(F.lit(1)).alias("n"))


def q_a2_sum_avg(spark, d):
    x = ST.count_sum_avg(raw_ticks(spark, d), "price")
    return x.select("currency", "n", r6("total").alias("total"), r6("average").alias("average"))


def _round_all(df: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    return df.select(*keep, *[r6(c).alias(c) for c in df.columns if c not in keep])


def q_a3_stats(spark, d):
    return _round_all(S.column_stats(raw_ticks(spark, d), FEATS, ddof=1), ("currency",))


def q_a4_stats_pop(spark, d):
    return _round_all(S.column_stats(raw_ticks(spark, d), FEATS, ddof=0), ("currency",))


def q_a5_robust_stats(spark, d):
    return _round_all(S.robust_stats(raw_ticks(spark, d), FEATS), ("currency",))


def q_a6_minmax(spark, d):
    return _round_all(S.minmax_stats(raw_ticks(spark, d), FEATS), ("currency",))


def q_a7_pair_corr(spark, d):
    return _round_all(ST.pair_corr(raw_ticks(spark, d), "price", "volume"), ("currency",))


def q_a8_corr_sweep(spark, d):
    sw = C.corr_sweep(C.daily_mean(raw_ticks(spark, d)), BASE)
    return sw.select("coin", "n", r6("corr").alias("corr"))


def q_a8_corr_changes(spark, d):
    """A8 over M16's daily changes, ranked (T4): what the reference correlates."""
    ch = C.daily_change(raw_ticks(spark, d)).withColumnRenamed("chg", "v")
    sw = C.corr_sweep(ch, BASE).withColumn("corr", r6("corr"))
    return C.rank_by_corr(sw, 3).select("coin", "corr", "rank")


def q_a7_pair_corr_nulls(spark, d):
    """A7 with NULL cells on both sides: only whole pairs count."""
    t = raw_ticks(spark, d)
    t = t.withColumn("price", F.when(F.col("event_id") % 7 != 0, F.col("price")))
    t = t.withColumn("volume", F.when(F.col("event_id") % 5 != 0, F.col("volume")))
    return _round_all(ST.pair_corr(t, "price", "volume"), ("currency",))


def q_t4_rank_corr(spark, d):
    sw = C.corr_sweep(C.daily_mean(raw_ticks(spark, d)), BASE).withColumn("corr", r6("corr"))
    top = C.rank_by_corr(sw, 3)
    return top.select("coin", "corr", "rank")


def q_p6_trim_sentinel(spark, d):
    s = ticks(spark, d)
    # each series ends at its own sentinel, 5 * len(name) rows before its end
    end = F.col("n") - F.lit(5) * F.length("currency")
    s = s.withColumn("v", F.when(F.col("pos") == end, F.lit(C.SENTINEL)).otherwise(F.col("price")))
    out = C.sentinel_corr(s, BASE, "v")
    return out.select("coin", "n", r6("corr").alias("corr"))


def q_a9_blocks(spark, d):
    b = W.blocks(ticks(spark, d), 32, ("volume", "market_cap"), "price")
    return b.select(
        # mean of 32 two-decimal prices has 7 decimals: round to 8 to avoid ties
        "currency", "block_id", F.round("y", 8).alias("y"), F.size("x").cast("bigint").alias("rows"),
        r6(F.col("x")[0]["volume"]).alias("first_vol"), r6(F.col("x")[31]["volume"]).alias("last_vol"),
    )


def _metrics_out(m: DataFrame, keys) -> DataFrame:
    return m.select(*keys, "n", *[r6(c).alias(c) for c in ("mse", "rmse", "mae", "mean_error")])


def _ranked_out(c: DataFrame) -> DataFrame:
    return c.select("model", "n", *[r6(x).alias(x) for x in ("mse", "rmse", "mae", "mean_error")],
                    F.col("rank").cast("bigint").alias("rank"))


def q_a10_metrics(spark, d):
    return _metrics_out(M.regression_metrics(M.persistence_scores(ticks(spark, d))), ("currency",))


def q_a11_mean_error(spark, d):
    return _metrics_out(M.regression_metrics(M.window_mean_scores(ticks(spark, d))), ("currency",))


def q_a12_r2(spark, d):
    r = M.r2_by_horizon(M.persistence_scores(ticks(spark, d)))
    return r.select("currency", r6("r2").alias("r2"), F.col("horizons").cast("bigint").alias("horizons"))


def q_a17_compare(spark, d):
    s = ticks(spark, d)
    c = M.compare_models(M.persistence_scores(s), M.window_mean_scores(s))
    return _ranked_out(c)


def q_a13_acf(spark, d):
    a = ST.acf(ticks(spark, d), "price", 10)
    return a.select("currency", F.col("lag").cast("bigint").alias("lag"),
                    *[r6(c).alias(c) for c in ("acf", "band95", "band99")])


def q_a13_acf_all(spark, d):
    """A13 at every lag of every series (what the autocorrelation plot draws)."""
    from tickweave.operators.acf import acf_all

    return acf_all(ticks(spark, d), "price").select("currency", "lag", *[r6(c).alias(c) for c in ("acf", "band95", "band99")])


def q_a14_adf(spark, d):
    a = ST.adf(ticks(spark, d), "price")
    return a.select("currency", r6("gamma").alias("gamma"), r6("t_stat").alias("t_stat"), "nobs")


def q_a14_adf_lag1(spark, d):
    """A14 with one lagged difference, and the autocovariances 0..3 that M11's
    likelihood starts from beside it."""
    from tickweave.operators.acf import autoproducts
    from tickweave.operators.unitroot import adf_test

    s = ticks(spark, d)
    t = adf_test(s, "price", lags=1).select("currency", r6("gamma").alias("gamma"), r6("t_stat").alias("t_stat"), "nobs")
    c = autoproducts(s, "price", 3).groupBy("currency").agg(*[r6(F.max(F.when(F.col("lag") == h, F.col("product")))).alias(f"product{h}") for h in range(4)])
    return t.join(c, "currency")


def _long_windows(w: DataFrame, n_in: int, n_out: int) -> DataFrame:
    xs = F.transform("x", lambda r: r["price"])
    allv = F.concat(xs, F.col("y"))
    return w.select("currency", "window_id", F.posexplode(allv).alias("h", "v")).select(
        "currency", "window_id", F.col("h").cast("bigint").alias("h"), r6("v").alias("v")
    )


def q_w3_windows_long(spark, d):
    return _long_windows(W.sliding_windows(hourly(spark, d), FEATS, n_in=35, n_out=3), 35, 3)


def q_w3_windows_explode(spark, d):
    x = W.windows_long(hourly(spark, d), "price", 38)
    return x.select("currency", "window_id", F.col("h").cast("bigint").alias("h"), r6("v").alias("v"))


def q_w4_windows_60_1(spark, d):
    w = W.sliding_windows(hourly(spark, d), ("price",), n_in=60, n_out=1)
    return w.groupBy("currency").agg(
        F.count(F.lit(1)).alias("n_windows"), r6(F.avg(F.col("y")[0])).alias("mean_y")
    )


def q_w6_pct_change(spark, d):
    x = TR.pct_change(ticks(spark, d), "price")
    return x.select("event_id", r6("pct_change").alias("pct_change"))


def q_w6_stored(spark, d):
    """W6 over stored positions: written once as a bucketed table of blocks, read
    without an exchange."""
    from tickweave.plans.stored import store_positions
    from tickweave.session import scratch_path

    path = scratch_path(spark, "positions")
    stored = store_positions(ticks(spark, d), f"positions_{path.rsplit('-', 1)[-1]}", before=1, after=0, path=path)
    return TR.pct_change(stored).select("event_id", r6("pct_change").alias("pct_change"))


def q_w7_log_return(spark, d):
    x = TR.log_return(ticks(spark, d), "price")
    return x.select("event_id", r6("log_return").alias("log_return"))


def q_w8_diff2(spark, d):
    x = TR.difference(ticks(spark, d), "price", 2, "diff2")
    return x.select("event_id", r6("diff2").alias("diff2"))


def q_w9_split_counts(spark, d):
    x = SP.ordered_split(ticks(spark, d), (0.9, 0.95))
    return x.groupBy("currency", "split").agg(F.count(F.lit(1)).alias("rows"))


def q_w10_last_k(spark, d):
    return SP.last_k_split(ticks(spark, d), 235).select("event_id", "split")


def q_w11_slice(spark, d):
    return P.slice_rows(ticks(spark, d), -1000, -100).select("event_id", "currency", "pos", "n")


def q_t2_first_n(spark, d):
    return P.first_n(ticks(spark, d), 100).select("event_id", "currency", "pos")


def q_t3_last_n(spark, d):
    return P.last_n(ticks(spark, d), 300).select("event_id", "currency", "pos")


def q_w12_strata(spark, d):
    x = SP.time_strata(ticks(spark, d), 12)
    return x.groupBy("currency", F.col("stratum").cast("bigint").alias("stratum")).agg(F.count(F.lit(1)).alias("rows"))


def q_w13_holdout(spark, d):
    x = SP.stratified_holdout(SP.time_strata(ticks(spark, d), 12), 0.1111)
    return x.filter("holdout").select("currency", "event_id", F.col("stratum").cast("bigint").alias("stratum"))


def q_w13_holdout_exact(spark, d):
    """W13 with the exact allocation: the series' total is the asked share."""
    x = SP.stratified_holdout(SP.time_strata(ticks(spark, d), 12), 0.1111, allocate="total")
    return x.filter("holdout").select("currency", "event_id", F.col("stratum").cast("bigint").alias("stratum"))


def q_w13_split_chain(spark, d):
    """W9 + W12 + W13 chained over 35 -> 3 windows: the first 90% in 12 strata,
    .1111 of them for validation, the rest test."""
    w = W.sliding_windows(hourly(spark, d), ("price",), n_in=35, n_out=3).select("currency", "window_id", "pos", "n")
    return SP.split_chain(w).select("currency", "window_id", "split")


def q_w14_align(spark, d):
    w = W.sliding_windows(hourly(spark, d), FEATS, n_in=35, n_out=3)
    a = W.align_horizons(w, 35)
    return a.select("currency", "window_id", F.col("horizon").cast("bigint").alias("horizon"), "target_pos",
                    r6("value").alias("value"))


def q_t1_sorted_limit(spark, d):
    return P.first_rows(raw_ticks(spark, d), 100).select("event_id", "dt", "currency")


def q_t5_repartition(spark, d):
    x = P.repartitioned(raw_ticks(spark, d), 7)
    return x.agg(
        F.count(F.lit(1)).alias("n"),
        r6(ST.guarded_corr("price", "volume")).alias("corr"),
        r6(F.sum("price")).alias("total"),
        r6(F.avg("price")).alias("average"),
    )


def q_j1_zip(spark, d):
    s = ticks(spark, d)
    a = s.select("currency", "pos", r6(ln1p("price")).alias("x"))
    b = s.select("currency", (F.col("pos") - 1).alias("pos"), r6("price").alias("y")).filter("pos >= 0")
    return zip_by_position(a, b)


def q_j3_with_stats(spark, d):
    s = raw_ticks(spark, d)
    st = S.column_stats(s, ("price",))
    return S.with_stats(s, st).select("event_id", r6("price_mean").alias("price_mean"), r6("price_sd").alias("price_sd"))


def q_j4_missing_days(spark, d):
    return C.missing_days(raw_ticks(spark, d), "2023-12-31", "2024-01-31").select("currency", "d_")


def _scaled_out(df: DataFrame, suffix: str, extra=()) -> DataFrame:
    return df.select("event_id", *extra, *[r6(f"{c}{suffix}").alias(f"{c}{suffix}") for c in FEATS])


def q_m1_zscore(spark, d):
    return _scaled_out(S.zscore(raw_ticks(spark, d), FEATS, ddof=1, suffix="_z"), "_z")


def q_m2_zscore_split(spark, d):
    s = SP.ordered_split(ticks(spark, d), (0.8,), ("train", "test"))
    z = S.zscore(s, FEATS, by=("currency", "split"), ddof=0, suffix="_z")
    return _scaled_out(z, "_z", ("split",))


def q_m3_robust(spark, d):
    return _scaled_out(S.robust_scale(raw_ticks(spark, d), FEATS, suffix="_r"), "_r")


def q_m4_chain(spark, d):
    return _scaled_out(S.scale_chain(raw_ticks(spark, d), FEATS, suffix="_s"), "_s")


def q_m5_inverse(spark, d):
    lg = TR.log1p_features(raw_ticks(spark, d), ("price",), suffix="_ln")
    st = S.minmax_stats(lg, ("price_ln",))
    sc = S.scale_chain(lg, ("price_ln",), suffix="_s", stats=st)
    back = S.inverse_scale(sc, st, "price_ln_s", feature="price_ln", out="price_back")
    return back.select("event_id", r6("price_ln_s").alias("price_scaled"), r6("price_back").alias("price_back"))


def q_m7_hash_split(spark, d):
    return SP.hash_split(raw_ticks(spark, d), 0.7).select("event_id", "split")


def q_m16_daily_wide(spark, d):
    w = C.daily_change_wide(raw_ticks(spark, d))  # one column for every series there is
    return w.select("d_", *[r6(F.col(f"`{c}`")).alias(c) for c in w.columns if c != "d_"])


def q_m16_daily_sparse(spark, d):
    """M16 by series dictionary and sparse day vectors, in long form."""
    t = raw_ticks(spark, d)
    names = C.series_dictionary(t)
    long = C.daily_change_sparse(t, names).select("d_", F.inline(F.arrays_zip("idx", "chg")))
    return long.join(names, "idx").select("d_", "currency", F.col("idx").cast("bigint").alias("idx"), r6("chg").alias("chg"))


def q_m17_label(spark, d):
    return C.movement_label(raw_ticks(spark, d))


def q_a15_accuracy(spark, d):
    """Accuracy of a momentum call (tomorrow moves like today) per series."""
    from pyspark.sql import Window

    lab = C.movement_label(raw_ticks(spark, d))
    w = Window.partitionBy("currency").orderBy("d_")  # daily table: #days rows per series
    pred = lab.withColumn("prediction", F.lag("move").over(w)).filter(F.col("prediction").isNotNull())
    acc = M.accuracy(pred, "move", "prediction", by=("currency",))
    return acc.select("currency", r6("accuracy").alias("accuracy"), "n")


SWEEP_PARTITIONS = (1, 8, 18)


def q_m14_partition_sweep(spark, d):
    """The stats job (corr + count + sum + avg) after repartition(n) for
    several n; values must not depend on n (timings are in bench.py)."""
    out = None
    for n in SWEEP_PARTITIONS:
        t = P.repartitioned(raw_ticks(spark, d), n)
        r = t.agg(
            r6(ST.guarded_corr("price", "volume")).alias("corr"), F.count(F.lit(1)).alias("n"),
            r6(F.sum("volume")).alias("total"), r6(F.avg("volume")).alias("average"),
        ).withColumn("partitions", F.lit(n).cast("bigint"))
        out = r if out is None else out.unionByName(r)
    return out


def q_m18_prep(spark, d):
    """Load, filter one currency, every-12th row."""
    t = raw_ticks(spark, d).filter(F.col("currency") == BASE)
    return P.every_nth(sequence(t), HOURLY).select("event_id", "pos", r6("price").alias("price"))


def _round_trip(spark, d, fmt: str):
    from tickweave.session import scratch_path
    from tickweave.sources import files as FS

    path = scratch_path(spark, f"ticks-{fmt}")
    FS.write_ticks(raw_ticks(spark, d), path, fmt, layout=True)
    back = FS.read_ticks_csv(spark, path) if fmt == "csv" else FS.read_ticks_json(spark, path)
    return back.select("event_id", "currency", F.col("dt").cast("timestamp_ntz").alias("dt"),
                       r6("price").alias("price"), r6("volume").alias("volume"))


def point_docs(spark, d) -> DataFrame:
    """Point-map documents rendered from the ticks: one per series and day, the
    last tick of every second; at most 86,400 points in a document."""
    t = raw_ticks(spark, d).withColumn("epoch", F.unix_seconds(F.col("dt").cast("timestamp")))
    v = F.array("price", "volume", "market_cap")
    last = t.groupBy("currency", F.to_date("dt").alias("d_"), "epoch").agg(F.max_by(v, F.struct("dt", "event_id")).alias("v"))
    point = F.struct(F.col("epoch").cast("string"), F.struct("v"))
    docs = last.groupBy("currency", "d_").agg(F.map_from_entries(F.collect_list(point)).alias("points"))
    return docs.select("currency", F.to_json(F.struct(F.struct("points").alias("data"))).alias("value"))


def write_point_docs(docs: DataFrame, path: str) -> None:
    """One file a document, in a folder a series."""
    docs.write.partitionBy("currency").option("maxRecordsPerFile", 1).mode("append").text(path)


def _points_out(t: DataFrame) -> DataFrame:
    return t.select("currency", F.col("dt").cast("timestamp_ntz").alias("dt"), *[r6(c).alias(c) for c in FEATS])


def q_s3_point_json(spark, d):
    """S3 + F8 + F10: point-map files written and scanned back."""
    from tickweave.session import scratch_path
    from tickweave.sources.files import read_point_json

    path = scratch_path(spark, "points")
    write_point_docs(point_docs(spark, d), path)
    return _points_out(read_point_json(spark, path))


def q_s7_ingest(spark, d):
    """Point files of one series ingested, the others added, ingested again,
    and once more with nothing new."""
    from tickweave.session import scratch_path
    from tickweave.streaming import ingest_new

    src, dst, seen = (scratch_path(spark, f"ingest-{x}") for x in ("src", "dst", "seen"))
    docs = point_docs(spark, d)
    write_point_docs(docs.filter(F.col("currency") == BASE), src)
    ingest_new(spark, src, dst, seen)
    write_point_docs(docs.filter(F.col("currency") != BASE), src)
    ingest_new(spark, src, dst, seen)
    ingest_new(spark, src, dst, seen)
    return _points_out(spark.read.parquet(dst))


def q_s5_results(spark, d):
    """The correlation sweep's lines written, appended once more, read back."""
    from tickweave.session import scratch_path
    from tickweave.sources.files import write_result

    path = scratch_path(spark, "results")
    sweep = C.corr_sweep(C.daily_mean(raw_ticks(spark, d)), BASE).select("coin", "corr")
    write_result(sweep, path)
    write_result(sweep, path)
    return spark.read.schema("coin string, corr double").csv(path).select("coin", r6("corr").alias("corr"))


def q_s6_windows(spark, d):
    """Windows written by split, read back, one row per value."""
    from tickweave.session import scratch_path
    from tickweave.sources.files import write_windows

    path = scratch_path(spark, "windows")
    w = W.sliding_windows(hourly(spark, d), FEATS, n_in=35, n_out=3)
    w = SP.ordered_split(w, (0.9, 0.95))
    write_windows(w, path)
    w = spark.read.schema(w.schema).parquet(path)
    values = F.concat(F.transform("x", lambda r: r["price"]), F.col("y"))
    return w.select("currency", "split", "window_id", F.posexplode(values).alias("h", "v")).select(
        "currency", "split", "window_id", F.col("h").cast("bigint").alias("h"), r6("v").alias("v"))


def q_s1_csv_round_trip(spark, d):
    """S1 + S4: ticks written as the reference CSV (sorted sink), scanned back."""
    return _round_trip(spark, d, "csv")


def q_s2_json_round_trip(spark, d):
    """S2 + S4: the same through JSON lines."""
    return _round_trip(spark, d, "json")


def q_m11_arima_order(spark, d):
    """(d, p, q) per series of the hourly price series (rows-only check)."""
    from tickweave.operators import arima as AR

    models = AR.arima_fit(hourly(spark, d), "price")
    return models.select("currency", "d", "p", "q", r6("aic").alias("aic"), "nobs")


def q_m11_adf_d(spark, d):
    """The tests behind d, with lags by the series' length: statistic and
    p-value of the levels (rows-only: lag lengths beyond plain SQL)."""
    from tickweave.operators.unitroot import adf_test

    t = adf_test(hourly(spark, d), "price", trend=True, max_d=2)
    return t.select("currency", "d", "lags", *[r6(c).alias(c) for c in ("gamma", "t_stat", "p_value")], "nobs")


def q_m12_arima_forecast(spark, d):
    """100-step forecast per series from the chosen order."""
    from tickweave.operators import arima as AR

    s = hourly(spark, d)
    return AR.arima_forecast(AR.arima_fit(s, "price"), s, "price", steps=100).select(
        "currency", "step", r6("forecast").alias("forecast"))


def q_m8_movement_rf(spark, d):
    """M8: random-forest up/down classifier over the train-portion sweep."""
    from tickweave.operators import ml

    return ml.movement_sweep(ml.movement_frame(raw_ticks(spark, d), BASE, "view"))


def q_m8_split_sizes(spark, d):
    """M8's training and test sets: sizes and labels for every train portion."""
    from tickweave.operators import ml

    return ml.movement_split_sizes(ml.movement_frame(raw_ticks(spark, d), BASE, "view"))


def _model_windows(spark, d):
    s = P.every_nth(ticks(spark, d), HOURLY, drop_first=1)
    s = TR.log1p_features(s, FEATS)
    s = S.scale_chain(s, FEATS)
    w = W.sliding_windows(s, FEATS, n_in=35, n_out=3)
    return SP.ordered_split(w, (0.9, 0.95))


def q_m9_rf_forecast(spark, d):
    """M9 + A10: random-forest multi-horizon forecast, test metrics per series."""
    from tickweave.operators import ml

    sc = ml.rf_forecast(_model_windows(spark, d), FEATS, n_out=3, num_trees=100, max_depth=10)
    return _metrics_out(M.regression_metrics(sc), ("currency",))


def q_m10_rf_grid(spark, d):
    """3-fold grid search over depth, trees and leaf size for each horizon,
    mean cross-validated rmse per grid point: the reference's grid, with depths
    as far as Spark goes (30)."""
    from tickweave.operators import ml

    w = _model_windows(spark, d).filter("split = 'train'")
    return ml.rf_grid(w, FEATS, n_out=3, depths=(10, 20, 30), trees=(200, 400, 600, 800, 1000), min_leaf=(1, 2, 3))


def q_j5_score_join(spark, d):
    """J5 + W14: persistence predictions joined with actuals taken from the
    35->3 windows' aligned targets, by (series, window, horizon); metrics."""
    s = ticks(spark, d)
    pred = M.persistence_scores(s).select("currency", "window_id", "horizon", "predicted")
    act = W.align_horizons(W.sliding_windows(s, ("price",), n_in=35, n_out=3), 35).select(
        "currency", "window_id", "horizon", F.col("value").alias("actual"))
    return _metrics_out(M.regression_metrics(M.score_join(pred, act)), ("currency",))


def q_m6_fit_on_train(spark, d):
    """Min-max fitted on the train split only, applied to every row."""
    s = SP.ordered_split(ticks(spark, d), (0.8,), ("train", "test"))
    sc = S.minmax_scale(s, ("price",), suffix="_s", fit_on=F.col("split") == "train")
    return sc.select("event_id", "split", r6("price_s").alias("price_s"))


def q_a11_rmse_usd(spark, d):
    """A11 + M5: persistence forecast on the ln(x+1), chain-scaled price,
    predictions and actuals scaled back to USD before the metrics; the rmse of the
    scaled values beside them."""
    s = TR.log1p_features(ticks(spark, d), ("price",), suffix="_ln")
    st = S.minmax_stats(s, ("price_ln",))
    sc = S.scale_chain(s, ("price_ln",), suffix="_s", stats=st)
    scores = M.persistence_scores(sc, "price_ln_s")
    scores = scores.withColumns({"scaled_p": F.col("predicted"), "scaled_a": F.col("actual")})
    usd = M.to_usd(scores, st, "price_ln")
    e = F.col("scaled_p") - F.col("scaled_a")
    scaled = usd.groupBy("currency").agg(r6(F.sqrt(F.avg(e * e))).alias("rmse_scaled"))
    return _metrics_out(M.regression_metrics(usd), ("currency",)).join(scaled, "currency")


def q_a17_compare_models(spark, d):
    """A17 over the model jobs: persistence, random forest and ridge regression
    on the same test windows, ranked by rmse (rows-only: fitted models)."""
    from tickweave.operators import ml

    w = ml.stored_windows(_model_windows(spark, d), FEATS)
    rf = ml.rf_forecast(w, FEATS, n_out=3, num_trees=100, max_depth=10)
    ridge = ml.linear_forecast(w, FEATS, n_out=3)
    c = M.compare_models(M.window_persistence_scores(w, "price"), rf, ridge)
    return _ranked_out(c)


def ohlc_pages(spark, d) -> DataFrame:
    """One HTML page per series and month holding its daily OHLC table (header row of
    <th>, one <tr> of 7 <td> per day, money as '$1,234.56'), derived from the
    tick table: the shape of the reference's scraped history pages."""
    t = raw_ticks(spark, d)
    o = F.struct(F.col("dt"), F.col("event_id"))
    daily = t.groupBy("currency", F.to_date("dt").alias("d_")).agg(
        F.min_by("price", o).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
        F.max_by("price", o).alias("close"), F.sum("volume").alias("value"),
        F.max_by("market_cap", o).alias("market_cap"),
    )

    def money(c):
        return F.concat(F.lit("<td>$"), F.format_number(c, 2), F.lit("</td>"))

    row = F.concat(
        F.lit("<tr><td>"), F.date_format("d_", "MMM d, yyyy"), F.lit("</td>"),
        *[money(c) for c in ("open", "high", "low", "close", "value", "market_cap")], F.lit("</tr>"),
    )
    header = "<tr>" + "".join(f"<th>{h}</th>" for h in ("Date", "Open", "High", "Low", "Close", "Volume",
                                                        "Market Cap")) + "</tr>"
    # one page per series and month: at most 31 rows per group
    pages = daily.groupBy("currency", F.trunc("d_", "month").alias("_month")).agg(
        F.array_sort(F.collect_list(F.struct("d_", row.alias("r")))).alias("_rows"))
    return pages.select(
        F.xxhash64("currency", "_month").alias("page_id"), "currency",
        F.concat(F.lit("<html><body><table><thead>" + header + "</thead><tbody>"),
                 F.array_join(F.transform("_rows", lambda x: x["r"]), ""), F.lit("</tbody></table></body></html>")
                 ).alias("html"),
    )


def q_s8_html_rows(spark, d):
    """S8 + S9: daily rows parsed back out of HTML table pages."""
    from tickweave.sources.html import html_table_rows

    rows = html_table_rows(ohlc_pages(spark, d))
    return rows.select("currency", F.col("day").alias("d_"), "open", "high", "low", "close", "value", "market_cap")


def flagship(spark: SparkSession, d: str, step: int = HOURLY) -> DataFrame:
    """Prep pipeline over every series: every-nth (drop first), ln(x+1), chain
    scaling, 35->3 sliding windows, chronological .90/.95 split of windows;
    per (currency, split): window count and mean target."""
    s = P.every_nth(ticks(spark, d), step, drop_first=1)
    s = TR.log1p_features(s, FEATS)
    s = S.scale_chain(s, FEATS)
    w = W.sliding_windows(s, FEATS, n_in=35, n_out=3)
    w = SP.ordered_split(w, (0.9, 0.95))
    return w.groupBy("currency", "split").agg(
        F.count(F.lit(1)).alias("n_windows"),
        r6(F.avg(F.aggregate("y", F.lit(0.0), lambda a, b: a + b) / F.lit(3.0))).alias("mean_target"),
    )


def q_prep_flagship(spark, d):
    return flagship(spark, d)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    k[2:]: v for k, v in sorted(globals().items()) if k.startswith("q_") and callable(v)
}


def reset_cache() -> None:
    """Forget memoised sequenced tables (benchmarks time each query whole)."""
    _SEQ_CACHE.clear()
