"""Synthetic truth for the model jobs: AR(2) order recovery, separable
movement labels, MLP loss decrease, forecast shape."""

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SF01, make_ticks
from tickweave.operators import arima as A
from tickweave.operators import metrics as M
from tickweave.operators import ml
from tickweave.operators import split as SP
from tickweave.operators import windows as W
from tickweave.plans import sequence


def _ar2(n, seed):
    rng = np.random.default_rng(seed)
    x = np.zeros(n)
    e = rng.normal(size=n)
    for t in range(2, n):
        x[t] = 0.5 * x[t - 1] - 0.3 * x[t - 2] + e[t]
    return x


def test_arima_recovers_ar2_and_forecasts(spark):
    rows = [("ar", i, i, float(v), 1.0, 1.0) for i, v in enumerate(_ar2(3000, 3))]
    walk = np.cumsum(np.random.default_rng(4).normal(size=1500))
    rows += [("walk", i, 10_000 + i, float(v), 1.0, 1.0) for i, v in enumerate(walk)]
    s = sequence(make_ticks(spark, rows), chunks=4)
    models = A.arima_fit(s, "price")
    m = models.toPandas().set_index("currency")
    assert m.loc["ar", "d"] == 0 and m.loc["walk", "d"] == 1
    assert m.loc["ar", "p"] >= 2
    coef = m.loc["ar", "coef"]
    if m.loc["ar", "p"] == 2 and m.loc["ar", "q"] == 0:
        assert abs(coef[1] - 0.5) < 0.08 and abs(coef[2] + 0.3) < 0.08
    fc = A.arima_forecast(models, s, "price", steps=10).toPandas()
    assert len(fc) == 20 and fc.forecast.notna().all()


def test_movement_sweep_on_separable_label(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=400)
    frame = spark.createDataFrame([(i, float(v), float(v > 0)) for i, v in enumerate(x)],
                                  "t_ long, base_chg double, label double")
    out = ml.movement_sweep(frame, portions=(0.5, 0.8), num_trees=5).toPandas()
    assert len(out) == 2 and (out.accuracy > 0.9).all()
    assert (out.n_train + out.n_test == 400).all()


def test_movement_frame_from_events(spark):
    from tickweave.sources.events import ticks_from_events

    f = ml.movement_frame(ticks_from_events(spark, SF01), "click", "view")
    assert f.count() > 100 and set(f.columns) == {"t_", "base_chg", "label"}


def test_rf_and_ridge_forecasts(spark):
    rng = np.random.default_rng(6)
    v = np.sin(np.arange(400) / 5.0) + 0.05 * rng.normal(size=400)
    s = sequence(make_ticks(spark, [("s", i, i, float(x), 1.0, 1.0) for i, x in enumerate(v)]), chunks=3)
    w = SP.ordered_split(W.sliding_windows(s, ("price",), n_in=10, n_out=2), (0.8, 0.9))
    ridge = ml.linear_forecast(w, ("price",), n_out=2)
    assert ridge.count() == 2 * w.filter("split = 'test'").count()
    rf = ml.rf_forecast(w, ("price",), n_out=2, num_trees=20)
    r = rf.groupBy().agg(F.avg((F.col("predicted") - F.col("actual")) ** 2).alias("mse")).first()["mse"]
    assert r < 0.1


def test_select_d_with_augmented_test(spark):
    rng = np.random.default_rng(12)
    walk = np.cumsum(rng.normal(size=800))
    twice = np.cumsum(np.cumsum(rng.normal(size=800)))
    rows = [("ar", i, i, float(v), 1.0, 1.0) for i, v in enumerate(_ar2(800, 13))]
    rows += [("walk", i, 10_000 + i, float(v), 1.0, 1.0) for i, v in enumerate(walk)]
    rows += [("i2", i, 20_000 + i, float(v), 1.0, 1.0) for i, v in enumerate(twice)]
    s = sequence(make_ticks(spark, rows), chunks=4)
    d = {r["currency"]: r["d"] for r in A.select_d(s, "price", lags=3).collect()}
    assert d == {"ar": 0, "walk": 1, "i2": 2}


def test_arima_orders_on_known_series(spark):
    rows = []

    def add(name, values):
        k = len(rows)
        rows.extend((name, i, k + i, float(x), 1.0, 1.0) for i, x in enumerate(values))

    y = _ar2(2000, 3)
    for level in (0, 10**6, 10**9):
        add(f"ar{level}", y + level)
    e = np.random.default_rng(5).normal(size=2001)
    add("ma", e[1:] + 0.8 * e[:-1])
    add("walk", np.cumsum(np.random.default_rng(6).normal(size=1500)))
    add("constant", np.full(500, 7.0))
    add("short", _ar2(9, 1))
    s = sequence(make_ticks(spark, rows), chunks=4)
    models = A.arima_fit(s, "price")
    got = {r["currency"]: r for r in models.collect()}
    for level in (0, 10**6, 10**9):
        r = got[f"ar{level}"]
        assert (r["d"], r["p"], r["q"]) == (0, 2, 0)
        assert abs(r["coef"][1] - 0.5) < 0.06 and abs(r["coef"][2] + 0.3) < 0.06
    assert (got["ma"]["d"], got["ma"]["p"], got["ma"]["q"]) == (0, 0, 1)
    assert abs(got["ma"]["coef"][1] - 0.8) < 0.1
    assert got["walk"]["d"] == 1 and got["constant"]["d"] == 0
    assert got["short"]["p"] is None and got["short"]["nobs"] == 0
    ahead = {r["currency"]: r["forecast"] for r in A.arima_forecast(models, s, steps=1).collect()}
    assert abs(ahead["constant"] - 7.0) < 1e-9 and ahead["short"] is None
    assert abs(ahead["ar1000000"] - ahead["ar0"] - 10**6) < 1e-3


def test_arima_order_of_a_series_is_its_own(spark):
    """A long series beside short ones changes nothing for them."""
    short = {f"s{n}": _ar2(n, n) for n in (34, 36, 40, 60, 100)}

    def fitted(series):
        rows = [(name, i, 1000 * j + i, float(x), 1.0, 1.0) for j, (name, v) in enumerate(series.items()) for i, x in enumerate(v)]
        s = sequence(make_ticks(spark, rows), chunks=4)
        models = A.arima_fit(s, "price")
        ahead = {r["currency"]: r["forecast"] for r in A.arima_forecast(models, s, steps=3).collect() if r["step"] == 3}
        return {r["currency"]: (r["d"], r["p"], r["q"], r["nobs"], r["aic"], ahead[r["currency"]]) for r in models.collect()}

    together = fitted({**short, "long": _ar2(400, 2)})
    assert together["long"][1] is not None and together["s36"][1] is not None
    for name, values in short.items():
        alone = fitted({name: values})[name]
        assert alone[:4] == together[name][:4], name
        assert alone[1] is not None and np.allclose(alone[4:], together[name][4:]), name


def test_models_share_stored_windows(spark):
    """Written once; the same scores as from the windows themselves."""
    rng = np.random.default_rng(16)
    v = np.sin(np.arange(300) / 5.0) + 0.05 * rng.normal(size=300)
    s = sequence(make_ticks(spark, [("s", i, i, float(x), float(i), 1.0) for i, x in enumerate(v)]), chunks=3)
    w = SP.ordered_split(W.sliding_windows(s, ("volume", "price"), n_in=10, n_out=2), (0.8, 0.9))
    runs = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def counted(i):
        runs.add(1)
        return True

    n = w.count()
    stored = ml.stored_windows(w.filter(counted("window_id")), ("volume", "price"))
    assert runs.value == n == stored.count()
    for feature in ("volume", "price"):
        a, b = [sorted(map(tuple, M.window_persistence_scores(x, feature).collect()), key=repr) for x in (w.filter(F.size("y") == 2), stored)]
        assert a == b and len(a) == 2 * w.filter("split = 'test'").count()
    ml.rf_forecast(stored, ("volume", "price"), n_out=2, num_trees=2).collect()
    ml.linear_forecast(stored, ("volume", "price"), n_out=2).collect()
    assert runs.value == n  # no model computed the windows again
    for model in (lambda x: ml.rf_forecast(x, ("price",), n_out=2, num_trees=5), lambda x: ml.linear_forecast(x, ("price",), n_out=2)):
        plain = W.sliding_windows(s, ("price",), n_in=10, n_out=2)
        plain = SP.ordered_split(plain, (0.8, 0.9))
        a, b = [{(r.window_id, r.horizon): (r.actual, r.predicted) for r in model(x).collect()} for x in (plain, ml.stored_windows(plain, ("price",)))]
        assert a.keys() == b.keys() and all(np.allclose(a[k], b[k]) for k in a)


def test_models_without_windows(spark):
    none = spark.createDataFrame([], "currency string, window_id long, split string, y array<double>, x array<struct<price:double>>")
    assert ml.rf_forecast(none, ("price",)).count() == 0
    assert ml.rf_grid(none, ("price",)).count() == 0
