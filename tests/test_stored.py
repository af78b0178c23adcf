"""Stored positions: the same results without an exchange of the ticks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001, make_ticks
from tickweave.operators import stats as ST
from tickweave.operators import transform as TR
from tickweave.plans import sequence
from tickweave.plans.neighbors import lagged, own_rows
from tickweave.plans.stored import store_positions
from tickweave.sources.events import ticks_from_events


@pytest.fixture
def table(spark, tmp_path):
    spark.sql(f"create database if not exists stored_test location '{tmp_path}'")
    yield "stored_test.ticks"
    spark.sql("drop database stored_test cascade")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_positional_queries_over_the_table_need_no_exchange(spark, table):
    s = sequence(ticks_from_events(spark, SF001))
    stored = store_positions(s, table, before=12, after=12, buckets=4, rows=40)
    assert own_rows(stored).count() == s.count() and stored.count() > s.count()
    near = {"back": ("price", 3), "ahead": ("price", -10)}
    want = {r.event_id: (r.back, r.ahead) for r in lagged(s, near).collect()}
    got = lagged(stored, near)
    assert {r.event_id: (r.back, r.ahead) for r in got.collect()} == want
    assert "Exchange" not in plan(got) and "Bucketed: true" in plan(got)

    change = TR.pct_change(stored)  # W6
    assert "Exchange" not in plan(change)
    assert sorted(map(str, change.select("event_id", "pct_change").collect())) == sorted(map(str, TR.pct_change(s).select("event_id", "pct_change").collect()))

    few, same = ST.acf(stored, "price", 10), ST.acf(s, "price", 10)  # A13
    planned = plan(few)
    a, b = ({(r.currency, r.lag): r.acf for r in x.collect()} for x in (few, same))
    assert a.keys() == b.keys() and np.allclose([a[k] for k in a], [b[k] for k in a])
    # the one exchange is that of the partial sums
    assert planned.count("Exchange hashpartitioning") == 1 and "partial_sum" in planned.split("Exchange hashpartitioning")[1]


def test_a_halo_that_is_too_small_is_refused(spark, table):
    s = sequence(make_ticks(spark, [("a", i, i, float(i), 1.0, 1.0) for i in range(50)]))
    stored = store_positions(s, table, before=2, after=0, buckets=2, rows=10)
    assert lagged(stored, {"x": ("price", 2)}).filter(F.col("x") == F.col("price") - 2).count() == 48
    with pytest.raises(ValueError, match="halo"):
        lagged(stored, {"x": ("price", 3)})
