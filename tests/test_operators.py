"""Operator properties: partitions of the input, counts,
scaler algebra, round trips, exact quantiles, partition independence."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001, SF01, make_ticks
from tickweave.operators import metrics as M
from tickweave.operators import position as P
from tickweave.operators import scale as S
from tickweave.operators import split as SP
from tickweave.operators import stats as ST
from tickweave.operators import transform as TR
from tickweave.operators import windows as W
from tickweave.plans import sequence
from tickweave.sources.events import ticks_from_events

FEATS = ("price", "volume", "market_cap")


@pytest.fixture(scope="module")
def seq01(spark):
    return sequence(ticks_from_events(spark, SF01)).cache()


def test_every_nth_count_is_ceil(seq01):
    n = {r["currency"]: r["n"] for r in seq01.groupBy("currency").agg(F.max("n").alias("n")).collect()}
    for step in (1, 5, 12):
        got = {r["currency"]: (r["c"], r["m"]) for r in
               P.every_nth(seq01, step).groupBy("currency").agg(F.count("*").alias("c"), F.max("n").alias("m")).collect()}
        for c, total in n.items():
            assert got[c][0] == math.ceil(total / step) == got[c][1]


def test_window_count_and_content(seq01, small_blocks):
    h = P.every_nth(seq01, 12)
    w = W.sliding_windows(h, FEATS, n_in=35, n_out=3)
    per = {r["currency"]: r["c"] for r in w.groupBy("currency").agg(F.count("*").alias("c")).collect()}
    ns = {r["currency"]: r["n"] for r in h.groupBy("currency").agg(F.max("n").alias("n")).collect()}
    for c, n in ns.items():
        assert per.get(c, 0) == max(n - 37, 0)
    # content equals the no-shuffle explode form
    a = w.select("currency", "window_id", F.posexplode(F.concat(F.transform("x", lambda r: r["price"]), "y")))
    b = W.windows_long(h, "price", 38)
    assert a.count() == b.count()
    assert a.exceptAll(b.select("currency", "window_id", F.col("h").alias("pos"), F.col("v").alias("col"))).count() == 0


def test_windows_shorter_series_give_none(spark):
    df = make_ticks(spark, [("a", i, i, float(i), 1.0, 1.0) for i in range(10)])
    w = W.sliding_windows(sequence(df, chunks=2), FEATS, n_in=35, n_out=3)
    assert w.count() == 0


def test_splits_partition_input(seq01):
    s = SP.ordered_split(seq01, (0.9, 0.95))
    assert s.count() == seq01.count()
    assert s.filter(F.col("split").isNull()).count() == 0
    k = SP.last_k_split(seq01, 235)
    assert k.filter("split = 'test'").count() == 5 * 235


def test_strata_and_holdout_against_brute_force(seq01):
    st = SP.time_strata(seq01, 12)
    ho = SP.stratified_holdout(st, 0.1111, digits=1).toPandas()
    assert len(ho) == seq01.count()
    pdf = st.select("currency", "stratum", "event_id").toPandas()
    import hashlib

    pdf["h"] = pdf.event_id.map(lambda e: hashlib.md5(str(e).encode()).hexdigest())
    exp = set()
    for _, g in pdf.groupby(["currency", "stratum"]):
        m = int(math.floor(len(g) * 0.1111 + 0.5))
        exp |= set(g.sort_values(["h", "event_id"]).event_id.head(m))
    assert set(ho[ho.holdout].event_id) == exp


def test_chain_equals_minmax_and_inverse_round_trip(spark):
    raw = ticks_from_events(spark, SF001)
    lg = TR.log1p_features(raw, FEATS)
    rb = S.robust_scale(lg, FEATS, suffix="_r")
    chained = S.minmax_scale(rb, [f"{c}_r" for c in FEATS], suffix="_s").select("event_id", *[f"{c}_r_s" for c in FEATS])
    plain = S.scale_chain(lg, FEATS, suffix="_s").select("event_id", *[f"{c}_s" for c in FEATS])
    j = chained.join(plain, "event_id").toPandas()
    for c in FEATS:
        assert np.allclose(j[f"{c}_r_s"], j[f"{c}_s"], atol=1e-12)
    st = S.minmax_stats(lg, ("price",))
    back = S.inverse_scale(S.scale_chain(lg, ("price",), suffix="_s"), st, "price_s", "price", out="p").toPandas()
    assert np.allclose(back.p, raw.toPandas().set_index("event_id").loc[back.event_id].price.to_numpy(), atol=1e-9)


def test_exact_quantiles_match_numpy(spark):
    df = make_ticks(spark, [("a", i, i, float((i * 37) % 101), 1.0, 1.0) for i in range(203)]
                    + [("b", i, 1000 + i, 5.0, 1.0, 1.0) for i in range(3)])
    q = S.exact_quantiles(df, ("price",), (0.0, 0.25, 0.5, 0.75, 1.0)).toPandas().set_index("currency")
    vals = np.array([float((i * 37) % 101) for i in range(203)])
    assert np.allclose(q.loc["a", ["q0", "q1", "q2", "q3", "q4"]].to_numpy(dtype=float),
                       np.percentile(vals, [0, 25, 50, 75, 100]))
    assert q.loc["b", "q2"] == 5.0


def test_constant_column_scales_to_zero(spark):
    df = make_ticks(spark, [("a", i, i, 3.0, float(i), 1.0) for i in range(20)])
    z = S.zscore(df, ("price",), suffix="_z").agg(F.max(F.abs("price_z"))).first()[0]
    mm = S.minmax_scale(df, ("price",), suffix="_s").agg(F.max(F.abs("price_s"))).first()[0]
    assert z == 0.0 and mm == 0.0
    c = ST.pair_corr(df, "price", "volume").first()["corr"]
    assert c is None


def test_result_independent_of_partitioning(spark):
    raw = ticks_from_events(spark, SF01)
    a = ST.count_sum_avg(P.repartitioned(raw, 1), "price", by=None).first()
    b = ST.count_sum_avg(P.repartitioned(raw, 13), "price", by=None).first()
    assert a["n"] == b["n"] and abs(a["total"] - b["total"]) < 1e-6


def test_metrics_against_numpy(seq01):
    sc = M.persistence_scores(seq01).toPandas()
    m = M.regression_metrics(M.persistence_scores(seq01)).toPandas().set_index("currency")
    for c, g in sc.groupby("currency"):
        e = g.predicted - g.actual
        assert math.isclose(m.loc[c, "mse"], (e ** 2).mean(), rel_tol=1e-9)
        assert math.isclose(m.loc[c, "mae"], e.abs().mean(), rel_tol=1e-9)


def test_adf_separates_random_walk_from_noise(spark):
    rng = np.random.default_rng(1)
    walk = np.cumsum(rng.normal(size=600))
    noise = rng.normal(size=600)
    rows = [("walk", i, i, float(v), 1.0, 1.0) for i, v in enumerate(walk)] + [
        ("noise", i, 10_000 + i, float(v), 1.0, 1.0) for i, v in enumerate(noise)]
    a = ST.adf(sequence(make_ticks(spark, rows), chunks=3)).toPandas().set_index("currency")
    assert a.loc["noise", "t_stat"] < -10 and a.loc["walk", "t_stat"] > -2.86


def test_acf_matches_pandas_definition(spark):
    rng = np.random.default_rng(2)
    x = np.cumsum(rng.normal(size=300))
    df = make_ticks(spark, [("s", i, i, float(v), 1.0, 1.0) for i, v in enumerate(x)])
    a = ST.acf(sequence(df, chunks=4), "price", 5).toPandas().sort_values("lag")
    z = x - x.mean()
    c0 = (z ** 2).sum()
    exp = [(z[: len(z) - h] * z[h:]).sum() / c0 for h in range(1, 6)]
    assert np.allclose(a.acf.to_numpy(), exp)


def test_duckdb_oracle_smoke_on_sf001(spark):
    """The registered flagship on sf0.001 equals its SQL (stride 12 here)."""
    import __spark_entry__ as e

    got = e.queries()["prep_flagship"](spark, SF001).toPandas()
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{SF001}/events.parquet'")
    exp = con.execute(e.oracle_sql()["prep_flagship"]).df()
    assert len(got) == len(exp)


def test_augmented_adf_matches_least_squares(spark):
    rng = np.random.default_rng(11)
    x = np.cumsum(rng.normal(size=400)) + 50
    df = make_ticks(spark, [("s", i, i, float(v), 1.0, 1.0) for i, v in enumerate(x)])
    a = ST.adf(sequence(df, chunks=3), "price", lags=2).first()
    dy = np.diff(x)
    rows = range(3, len(x))  # t with y_{t-1}, dy_{t-1}, dy_{t-2} defined
    X = np.array([[1.0, x[t - 1], dy[t - 2], dy[t - 3]] for t in rows])
    y = np.array([dy[t - 1] for t in rows])
    b, *_ = np.linalg.lstsq(X, y, rcond=None)
    resid = y - X @ b
    s2 = resid @ resid / (len(y) - X.shape[1])
    se = np.sqrt(np.diag(np.linalg.inv(X.T @ X)) * s2)
    assert a["nobs"] == len(y)
    assert abs(a["gamma"] - b[1]) < 1e-8 and abs(a["t_stat"] - b[1] / se[1]) < 1e-6
    a0 = ST.adf(sequence(df, chunks=3), "price").first()
    assert a0["nobs"] == len(x) - 1


def test_exact_allocation_by_largest_remainders(spark):
    import math

    rng = np.random.default_rng(1)
    for frac in (0.1111, 0.25, 0.0, 1.0):
        sizes = [(f"s{i}", k, int(rng.integers(1, 40))) for i in range(4) for k in range(int(rng.integers(1, 13)))]
        got = SP.allocated(spark.createDataFrame(sizes, "currency string, stratum int, size long"), frac).collect()
        for name in {s[0] for s in sizes}:
            mine = sorted((k, n) for s, k, n in sizes if s == name)
            total = sum(n for _, n in mine)
            kept = total - math.ceil(frac * total)
            whole = {k: n * kept // total for k, n in mine}
            order = sorted(mine, key=lambda x: (-(x[1] * kept % total), x[0]))
            for k, _ in order[:kept - sum(whole.values())]:
                whole[k] += 1
            assert {r.stratum: r.held for r in got if r.currency == name} == {k: n - whole[k] for k, n in mine}


def test_split_chain_over_windows(seq01):
    w = W.sliding_windows(seq01, ("price",), n_in=5, n_out=2)
    got = SP.split_chain(w.select("currency", "window_id", "pos", "n")).toPandas()
    sizes = {r.currency: r.n for r in w.select("currency", "n").distinct().collect()}
    for name, g in got.groupby("currency"):
        n = sizes[name]
        first = int(n * 0.9)
        assert sorted(g.window_id) == list(range(n)) and set(g[g.split == "test"].window_id) == set(range(first, n))
        assert (g.split == "val").sum() == int(np.ceil(0.1111 * first))
        strata = g[g.split == "val"].window_id // (first // 12)
        assert strata.clip(upper=11).nunique() == 12


def test_daily_sparse_beyond_the_pivot(spark):
    from tickweave.operators import corr as C

    n = 20_000  # the pivot stops at 10,000 series
    days = spark.range(n).select(F.format_string("s%05d", "id").alias("currency"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k"), "id")
    t = days.filter("k < 2 or id % 2 = 0").select(
        "currency", F.timestamp_seconds(F.col("k") * 86_400).alias("dt"), F.col("id").alias("event_id"), (F.col("id") + 1.0 + F.col("k")).alias("price"))
    names = C.series_dictionary(t)
    assert names.count() == n and names.agg(F.max("idx")).first()[0] == n - 1
    wide = C.daily_change_sparse(t, names)
    rows = {str(r.d_): r for r in wide.collect()}
    assert [len(rows[d].idx) for d in sorted(rows)] == [n, n // 2] and list(rows["1970-01-02"].idx) == list(range(n))
    few = {str(r.d_): tuple(r)[1:] for r in C.sparse_columns(wide, names, ["s00003", "s00004", "none"]).collect()}
    assert np.allclose(few["1970-01-02"][:2], [5 / 4 - 1, 6 / 5 - 1]) and few["1970-01-02"][2] is None
    assert few["1970-01-03"][0] is None and abs(few["1970-01-03"][1] - (7 / 6 - 1)) < 1e-12
