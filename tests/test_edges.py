"""Edge cases: empty frames, one-row series, series
shorter than a window or block, NULL and zero prices, sentinel in row 1."""

import pytest

from tests.conftest import make_ticks
from tickweave.operators import corr as C
from tickweave.operators import metrics as M
from tickweave.operators import position as P
from tickweave.operators import scale as S
from tickweave.operators import split as SP
from tickweave.operators import stats as ST
from tickweave.operators import transform as TR
from tickweave.operators import windows as W
from tickweave.plans import sequence

FEATS = ("price", "volume", "market_cap")


@pytest.fixture(scope="module")
def tiny(spark):
    rows = [("one", 0, 1, 5.0, 1.0, 1.0)]
    rows += [("zero", i, 100 + i, float(i % 3), 1.0, 1.0) for i in range(9)]  # prices 0,1,2,0,...
    return sequence(make_ticks(spark, rows), chunks=3).cache()


def test_empty_frame_flows_through(spark):
    s = sequence(make_ticks(spark, []), chunks=2)
    assert P.every_nth(s, 12).count() == 0
    assert W.sliding_windows(s, FEATS).count() == 0
    assert W.blocks(s, 4).count() == 0
    assert S.column_stats(s).count() == 0
    assert ST.acf(s, "price", 3).count() == 0
    assert TR.pct_change(s).count() == 0


def test_one_row_series(tiny):
    one = tiny.filter("currency = 'one'")
    r = one.first()
    assert r["pos"] == 0 and r["n"] == 1
    assert P.every_nth(one, 12).first()["n"] == 1
    assert P.every_nth(one, 12, drop_first=1).count() == 0
    assert TR.log_return(one).first()["log_return"] is None
    st = S.column_stats(one, ("price",)).first()
    assert st["price_mean"] == 5.0 and st["price_sd"] is None
    z = S.zscore(one, ("price",), suffix="_z").first()["price_z"]
    assert z == 0.0  # undefined (NULL) sd divides by 1, like a zero sd (C7)


def test_zero_prices_are_guarded(tiny):
    z = tiny.filter("currency = 'zero'")
    pc = {r["pos"]: r["pct_change"] for r in TR.pct_change(z).collect()}
    assert pc[0] is None and pc[1] is None and pc[2] == 1.0  # 1/0 -> NULL, not an error
    lr = {r["pos"]: r["log_return"] for r in TR.log_return(z).collect()}
    assert lr[3] is None and lr[1] is None  # ln(0/2), ln(1/0) -> NULL
    lg = TR.log10_features(z, ("price",), suffix="_l").filter("pos = 0").first()["price_l"]
    assert lg is None


def test_short_series_blocks_and_windows(tiny):
    assert W.blocks(tiny, 32).count() == 0
    b = W.blocks(tiny.filter("currency = 'zero'"), 4).orderBy("block_id").collect()
    assert [r["block_id"] for r in b] == [0, 1] and b[0]["y"] == 0.75
    w = W.sliding_windows(tiny, FEATS, n_in=5, n_out=3)
    assert w.count() == 2  # 9 - 8 + 1 for 'zero', none for 'one'


def test_splits_of_tiny_series(tiny):
    s = SP.ordered_split(tiny, (0.9, 0.95)).filter("currency = 'one'").first()["split"]
    assert s == "test"  # int(1*0.9) = 0, so the only row is past every cut
    st = SP.time_strata(tiny, 12).filter("currency = 'zero'").select("stratum").distinct().collect()
    assert [r[0] for r in st] == [11]  # fewer rows than strata: all in the last


def test_sentinel_in_first_row(spark):
    rows = [("base", i, i, 100000.0 if i == 5 else float(i), 1.0, 1.0) for i in range(10)]
    rows += [("alt", i, 100 + i, 100000.0 if i == 0 else float(i * 2), 1.0, 1.0) for i in range(10)]
    s = sequence(make_ticks(spark, rows), chunks=2)
    out = {r["coin"]: r for r in C.sentinel_corr(s, "base", "price").collect()}
    assert "alt" not in out  # its series ends before row 0: no aligned rows
    assert out["base"]["n"] == 5 and abs(out["base"]["corr"] - 1.0) < 1e-12


def test_null_prices_do_not_break_stats(spark):
    rows = [("a", i, i, None if i % 4 == 0 else float(i), 1.0, 1.0) for i in range(20)]
    s = sequence(make_ticks(spark, rows), chunks=2)
    st = S.minmax_stats(s, ("price",)).first()
    assert st["price_min"] == 1.0 and st["price_max"] == 19.0
    q = S.robust_stats(s, ("price",)).first()
    assert q["price_med"] is not None
    m = M.regression_metrics(M.persistence_scores(s, n_in=3, n_out=1))
    assert m.count() == 1


def test_wide_sentinel_table_cases(spark):
    """D4 fixture: sentinel in the first row, the last row, none; a constant column."""
    import numpy as np

    rng = np.random.default_rng(9)
    n = 30
    base = rng.normal(size=n)
    cols = {
        "Btc": list(base[:-1]) + [100000.0],               # sentinel in the last row
        "Eth": list(base * 2 + 1),                           # no sentinel, perfectly correlated
        "Ada": [100000.0] + list(rng.normal(size=n - 1)),    # sentinel in the first row
        "Flat": [3.0] * n,                                   # constant column
    }
    rows = [tuple([str(cols[c][i]) for c in cols] + [i + 1]) for i in range(n)]
    wide = spark.createDataFrame(rows, "Btc string, Eth string, Ada string, Flat string, Index int")
    long = C.wide_to_long(wide)
    out = {r["coin"]: r for r in C.sentinel_corr(long, "Btc", "chg").collect()}
    assert out["Btc"]["n"] == n - 1 and abs(out["Btc"]["corr"] - 1.0) < 1e-12
    assert out["Eth"]["n"] == n - 1 and abs(out["Eth"]["corr"] - 1.0) < 1e-12
    assert "Ada" not in out
    assert out["Flat"]["corr"] is None


def test_broadcast_only_under_the_bound(spark):
    from tickweave.plans.small import bounded_broadcast
    from tickweave.session import BROADCAST_ROWS_CONF

    df = spark.range(100).withColumnRenamed("id", "k")
    big = spark.range(1000).withColumnRenamed("id", "k")
    spark.conf.set(BROADCAST_ROWS_CONF, "10")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = big.join(bounded_broadcast(df), "k")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        spark.conf.set(BROADCAST_ROWS_CONF, "1000")
        plan = big.join(bounded_broadcast(df), "k")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan
    finally:
        spark.conf.unset(BROADCAST_ROWS_CONF)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
