"""Randomised property check: positions and lags from chunked sequencing and
block halos equal a pandas groupby on random series layouts (random series
sizes incl. empty and one-row, duplicate timestamps, random chunk and block
counts)."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import make_ticks
from tickweave.plans import lagged, sequence

rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 40), st.floats(-5, 5, allow_nan=False)),
    min_size=0,
    max_size=120,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, chunks=st.integers(1, 7), block=st.integers(1, 9), lag=st.integers(1, 4))
def test_positions_and_lags_match_pandas(spark, rows, chunks, block, lag):
    data = [(c, t, i, float(v), 0.0, 0.0) for i, (c, t, v) in enumerate(rows)]
    s = sequence(make_ticks(spark, data), chunks=chunks)
    got = lagged(s, {"lg": ("price", lag), "ld": ("price", -lag)}, rows=block).select(
        "event_id", "pos", "n", "lg", "ld").toPandas().set_index("event_id").sort_index()
    pdf = pd.DataFrame(data, columns=["currency", "t", "event_id", "price", "v", "m"]).sort_values(
        ["currency", "t", "event_id"])
    g = pdf.groupby("currency")
    pdf["pos"] = g.cumcount()
    pdf["n"] = g["price"].transform("size")
    pdf["lg"] = g["price"].shift(lag)
    pdf["ld"] = g["price"].shift(-lag)
    exp = pdf.set_index("event_id").sort_index()
    assert len(got) == len(exp)
    if len(exp):
        assert (got.pos.to_numpy() == exp.pos.to_numpy()).all()
        assert (got.n.to_numpy() == exp.n.to_numpy()).all()
        for c in ("lg", "ld"):
            a, b = got[c].astype(float), exp[c].astype(float)
            assert ((a == b) | (a.isna() & b.isna())).all()


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, n_in=st.integers(1, 5), n_out=st.integers(1, 3), stride=st.integers(1, 3),
       block=st.integers(1, 8))
def test_sliding_windows_match_numpy(spark, rows, n_in, n_out, stride, block):
    import numpy as np

    from tickweave.operators.windows import sliding_windows
    from tickweave.session import BLOCK_ROWS_CONF

    data = [(c, t, i, float(v), float(i), 0.0) for i, (c, t, v) in enumerate(rows)]
    spark.conf.set(BLOCK_ROWS_CONF, str(block))
    try:
        s = sequence(make_ticks(spark, data), chunks=3)
        w = sliding_windows(s, ("price", "volume"), n_in=n_in, n_out=n_out, stride=stride).collect()
    finally:
        spark.conf.unset(BLOCK_ROWS_CONF)
    got = {(r["currency"], r["window_id"]): ([x["price"] for x in r["x"]], list(r["y"])) for r in w}
    pdf = pd.DataFrame(data, columns=["currency", "t", "event_id", "price", "v", "m"]).sort_values(
        ["currency", "t", "event_id"])
    exp = {}
    size = n_in + n_out
    for c, g in pdf.groupby("currency"):
        p = g.price.to_numpy()
        if len(p) >= size:
            for k, win in enumerate(np.lib.stride_tricks.sliding_window_view(p, size)[::stride]):
                exp[(c, k)] = (list(win[:n_in]), list(win[n_in:]))
    assert got == exp


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 30),
                               st.one_of(st.none(), st.integers(-5, 5).map(float))), min_size=1, max_size=80),
       probs=st.lists(st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]), min_size=1, max_size=3))
def test_exact_quantiles_match_numpy(spark, rows, probs):
    import numpy as np

    from tickweave.operators.scale import exact_quantiles

    data = [(c, t, i, v, 0.0, 0.0) for i, (c, t, v) in enumerate(rows)]
    q = exact_quantiles(make_ticks(spark, data), ("price",), probs).collect()
    got = {r["currency"]: [r[f"q{i}"] for i in range(len(probs))] for r in q}
    exp = {}
    for c in {c for c, _, _ in rows}:
        vals = np.array([v for cc, _, v in rows if cc == c and v is not None])
        if len(vals):
            exp[c] = list(np.percentile(vals, [100 * p for p in probs]))
    assert set(got) == set(exp)
    for c in exp:
        assert np.allclose(got[c], exp[c])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(sizes=st.lists(st.integers(0, 90), min_size=1, max_size=3), frac=st.sampled_from([0.1, 0.1111, 0.3, 0.5]),
       digits=st.integers(1, 3), k=st.integers(1, 5))
def test_stratified_holdout_matches_brute_force(spark, sizes, frac, digits, k):
    import hashlib
    import math

    from tickweave.operators.split import stratified_holdout, time_strata

    data, eid = [], 0
    for si, n in enumerate(sizes):
        for t in range(n):
            data.append((f"s{si}", t, eid, 1.0, 0.0, 0.0))
            eid += 1
    s = time_strata(sequence(make_ticks(spark, data), chunks=2), k)
    got = {r["event_id"] for r in stratified_holdout(s, frac, digits=digits).filter("holdout").collect()}
    pdf = s.select("currency", "stratum", "event_id").toPandas()
    exp = set()
    for _, g in pdf.groupby(["currency", "stratum"]):
        m = int(math.floor(len(g) * frac + 0.5))
        key = g.event_id.map(lambda e: hashlib.md5(str(e).encode()).hexdigest())
        exp |= set(g.assign(h=key).sort_values(["h", "event_id"]).event_id.head(m))
    assert got == exp


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, step=st.integers(1, 5), drop=st.integers(0, 2),
       start=st.one_of(st.none(), st.integers(-8, 8)), stop=st.one_of(st.none(), st.integers(-8, 8)),
       k=st.integers(1, 6))
def test_every_nth_slices_blocks_match_python(spark, rows, step, drop, start, stop, k):
    from pyspark.sql import functions as F

    from tickweave.operators.position import every_nth, slice_rows
    from tickweave.operators.windows import blocks

    data = [(c, t, i, float(v), float(i), 0.0) for i, (c, t, v) in enumerate(rows)]
    s = sequence(make_ticks(spark, data), chunks=3)
    pdf = pd.DataFrame(data, columns=["currency", "t", "event_id", "price", "volume", "m"]).sort_values(
        ["currency", "t", "event_id"])
    series = {c: list(g.event_id) for c, g in pdf.groupby("currency")}

    nth = every_nth(s, step, drop)
    got = {(r["currency"], r["pos"]): (r["event_id"], r["n"]) for r in nth.collect()}
    exp = {}
    for c, ids in series.items():
        kept = ids[::step][drop:]
        exp.update({(c, p): (e, len(kept)) for p, e in enumerate(kept)})
    assert got == exp

    sl = slice_rows(s, start, stop)
    got = {(r["currency"], r["pos"]): (r["event_id"], r["n"]) for r in sl.collect()}
    exp = {}
    for c, ids in series.items():
        part = ids[start:stop]
        exp.update({(c, p): (e, len(part)) for p, e in enumerate(part)})
    assert got == exp

    b = blocks(s, k, ("volume",), "price").select("currency", "block_id", F.transform("x", lambda r: r["volume"]))
    got = {(r[0], r[1]): [int(v) for v in r[2]] for r in b.collect()}
    exp = {}
    for c, ids in series.items():
        for j in range(len(ids) // k):
            exp[(c, j)] = ids[j * k:(j + 1) * k]
    assert got == exp


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, cut1=st.sampled_from([0.5, 0.8, 0.9]), k=st.integers(1, 12), last=st.integers(0, 10))
def test_splits_and_strata_match_python(spark, rows, cut1, k, last):
    from tickweave.operators.split import last_k_split, ordered_split, time_strata

    data = [(c, t, i, float(v), 0.0, 0.0) for i, (c, t, v) in enumerate(rows)]
    s = sequence(make_ticks(spark, data), chunks=2)
    out = time_strata(last_k_split(ordered_split(s, (cut1, 0.95)), last, out="lk"), k)
    got = {r["event_id"]: (r["split"], r["lk"], r["stratum"]) for r in out.collect()}
    pdf = pd.DataFrame(data, columns=["currency", "t", "event_id", "price", "v", "m"]).sort_values(
        ["currency", "t", "event_id"])
    exp = {}
    for _, g in pdf.groupby("currency"):
        n = len(g)
        size, rem = n // k, n % k
        classes = [i for i in range(k) for _ in range(size)] + [k - 1] * rem  # reference rule
        for p, e in enumerate(g.event_id):
            split = "train" if p < int(n * cut1) else "val" if p < int(n * 0.95) else "test"
            exp[e] = (split, "test" if p >= n - last else "train", classes[p])
    assert got == exp


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 30), st.integers(0, 4).map(float)),
                     max_size=80),
       d=st.integers(1, 3), block=st.integers(1, 6))
def test_returns_and_differences_match_pandas(spark, rows, d, block):
    import numpy as np

    from tickweave.operators.transform import difference, log_return, pct_change
    from tickweave.session import BLOCK_ROWS_CONF

    data = [(c, t, i, v, 0.0, 0.0) for i, (c, t, v) in enumerate(rows)]
    spark.conf.set(BLOCK_ROWS_CONF, str(block))
    try:
        s = sequence(make_ticks(spark, data), chunks=2)
        out = log_return(pct_change(difference(s, "price", d, "dd")))
        got = out.select("event_id", "dd", "pct_change", "log_return").toPandas().set_index("event_id").sort_index()
    finally:
        spark.conf.unset(BLOCK_ROWS_CONF)
    pdf = pd.DataFrame(data, columns=["currency", "t", "event_id", "price", "v", "m"]).sort_values(
        ["currency", "t", "event_id"])
    g = pdf.groupby("currency")["price"]
    prev = g.shift(1)
    pdf["dd"] = g.transform(lambda x: x.diff(1) if d == 1 else x.diff().diff() if d == 2 else x.diff().diff().diff())
    ratio = pdf.price / prev.where(prev != 0)
    pdf["pct_change"] = ratio - 1
    pdf["log_return"] = np.log(ratio.where(ratio > 0))
    exp = pdf.set_index("event_id").sort_index()
    for c in ("dd", "pct_change", "log_return"):
        a, b = got[c].astype(float), exp[c].astype(float)
        assert ((np.isclose(a, b)) | (a.isna() & b.isna())).all(), c


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 40), st.floats(-3, 3, allow_nan=False)),
                     min_size=1, max_size=80),
       lags=st.integers(1, 4), block=st.integers(1, 6))
def test_acf_matches_definition(spark, rows, lags, block):
    import numpy as np

    from tickweave.operators.stats import acf
    from tickweave.session import BLOCK_ROWS_CONF

    data = [(c, t, i, float(v), 0.0, 0.0) for i, (c, t, v) in enumerate(rows)]
    spark.conf.set(BLOCK_ROWS_CONF, str(block))
    try:
        got = {(r["currency"], r["lag"]): r["acf"] for r in acf(sequence(make_ticks(spark, data), chunks=2),
                                                                  "price", lags).collect()}
    finally:
        spark.conf.unset(BLOCK_ROWS_CONF)
    pdf = pd.DataFrame(data, columns=["currency", "t", "event_id", "price", "v", "m"]).sort_values(
        ["currency", "t", "event_id"])
    exp = {}
    for c, g in pdf.groupby("currency"):
        z = g.price.to_numpy() - g.price.mean()
        c0 = (z * z).sum()
        for h in range(1, lags + 1):
            s = (z[: len(z) - h] * z[h:]).sum() if len(z) > h else 0.0
            exp[(c, h)] = None if c0 == 0 else s / c0
    assert set(got) == set(exp)
    for k, v in exp.items():
        assert (got[k] is None and v is None) or (v is not None and got[k] is not None and np.isclose(got[k], v))
