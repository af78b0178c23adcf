"""Autocorrelation over all lags against plain sums."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001, make_ticks
from tickweave.operators import acf as A
from tickweave.operators import stats as ST
from tickweave.plans import sequence
from tickweave.sources.events import ticks_from_events


def plain(x, most=None):
    z = np.asarray(x, float) - np.mean(x)
    return {h: float((z[:-h] * z[h:]).sum() / (z * z).sum()) for h in range(1, min(most or len(z), len(z) - 1) + 1)}


def test_cross_products_are_sums():
    r = np.random.default_rng(1)
    for n, m in ((1, 1), (5, 3), (4, 9), (16, 16)):
        a, b = r.normal(size=n), r.normal(size=m)
        want = [sum(a[t] * b[t + k] for t in range(n) if 0 <= t + k < m) for k in range(-(n - 1), m)]
        assert np.allclose(A.cross_products(a, b), want)


@pytest.mark.parametrize("rows,most", [(7, None), (7, 20), (64, 3), (65_536, None), (1, 5)])
def test_all_lags_over_block_edges(spark, rows, most):
    r = np.random.default_rng(2)
    series = {"a": np.cumsum(r.normal(size=150)), "b": r.normal(size=31) + 1e6, "two": np.array([1.0, 2.0]), "one": np.array([3.0])}
    ticks = [(name, i, 1000 * k + i, float(x), 1.0, 1.0) for k, (name, v) in enumerate(series.items()) for i, x in enumerate(v)]
    got = {}
    for row in A.acf_all(sequence(make_ticks(spark, ticks), chunks=4), max_lag=most, rows=rows).collect():
        got.setdefault(row.currency, {})[row.lag] = row.acf
    assert got.keys() == {"a", "b", "two"}
    for name, found in got.items():
        want = plain(series[name], most)
        assert found.keys() == want.keys() and all(abs(found[h] - want[h]) < 1e-9 for h in want)


def test_same_as_the_lag_columns(spark):
    s = sequence(ticks_from_events(spark, SF001))
    few = {(r.currency, r.lag): r for r in ST.acf(s, "price", 10).collect()}
    many = {(r.currency, r.lag): r for r in A.acf_all(s, "price", 5_000, rows=50).collect()}
    assert few.keys() <= many.keys() and len(many) > 5 * len(few)
    for k, r in few.items():
        assert np.allclose([r.acf, r.band95, r.band99], [many[k].acf, many[k].band95, many[k].band99])


def test_constant_and_missing_values(spark):
    ticks = [("c", i, i, 5.0, 1.0, 1.0) for i in range(9)] + [("m", i, 100 + i, None if i == 3 else float(i * i), 1.0, 1.0) for i in range(9)]
    s = sequence(make_ticks(spark, ticks), chunks=2)
    got = A.acf_all(s, rows=4).toPandas()
    assert got[got.currency == "c"].acf.isna().all() and len(got) == 16
    few = ST.acf(s, "price", 8).filter("currency = 'm'").orderBy("lag").toPandas()
    assert np.allclose(got[got.currency == "m"].sort_values("lag").acf, few.acf)
    assert A.acf_all(s.filter(F.lit(False))).count() == 0
