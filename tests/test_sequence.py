"""Positions and halos: equal to single-task window functions, any chunking."""

import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF01, make_ticks
from tickweave.plans import lagged, sequence
from tickweave.sources.events import ticks_from_events

EV = f"'{SF01}/events.parquet'"


def _oracle_pos():
    return duckdb.sql(
        f"select event_id, row_number() over (partition by event_type order by ts, event_id) - 1 as pos, "
        f"count(*) over (partition by event_type) as n from {EV}"
    ).df()


@pytest.mark.parametrize("chunks", [1, 3, 16])
def test_positions_match_row_number(spark, chunks):
    s = sequence(ticks_from_events(spark, SF01), chunks=chunks)
    got = s.select("event_id", "pos", "n").toPandas().merge(_oracle_pos(), on="event_id")
    assert len(got) == 10000
    assert (got.pos_x == got.pos_y).all() and (got.n_x == got.n_y).all()


def test_hot_series_is_split_over_chunks(spark):
    # one series holds ~90% of rows: it must span many chunks, not one task
    rows = [("hot", i, i, 1.0, 1.0, 1.0) for i in range(900)] + [("cold", i, 10_000 + i, 1.0, 1.0, 1.0)
                                                                  for i in range(100)]
    s = sequence(make_ticks(spark, rows), chunks=8)
    per = s.groupBy("currency").agg(F.countDistinct("_chunk").alias("c"), F.max("pos").alias("m")).collect()
    d = {r["currency"]: r for r in per}
    assert d["hot"]["c"] >= 6 and d["hot"]["m"] == 899 and d["cold"]["m"] == 99


def test_duplicate_timestamps_break_ties_by_event_id(spark):
    rows = [("a", 10, 3, 3.0, 0.0, 0.0), ("a", 10, 1, 1.0, 0.0, 0.0), ("a", 5, 9, 0.5, 0.0, 0.0), ("a", 10, 2, 2.0, 0.0, 0.0)]
    s = sequence(make_ticks(spark, rows), chunks=3).orderBy("pos").select("event_id").collect()
    assert [r[0] for r in s] == [9, 1, 2, 3]


def test_empty_frame(spark):
    s = sequence(make_ticks(spark, []), chunks=2)
    assert s.count() == 0


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_lag_lead_across_blocks(spark, block):
    s = sequence(ticks_from_events(spark, SF01), chunks=5)
    got = lagged(s, {"l1": ("price", 1), "l4": ("price", 4), "f3": ("price", -3)}, rows=block).toPandas()
    exp = duckdb.sql(
        f"select event_id, lag(value, 1) over w as l1, lag(value, 4) over w as l4, lead(value, 3) over w as f3 "
        f"from {EV} window w as (partition by event_type order by ts, event_id)"
    ).df()
    m = got.merge(exp, on="event_id")
    assert len(m) == 10000
    for c in ("l1", "l4", "f3"):
        assert np.allclose(m[c + "_x"].astype(float), m[c + "_y"].astype(float), equal_nan=True)


def test_multi_column_series_key(spark, small_blocks):
    from pyspark.sql import Window

    rows = [(f"c{i % 2}", f"x{i % 3}", i, i, float(i * i % 17)) for i in range(300)]
    df = spark.createDataFrame(rows, "currency string, venue string, epoch long, event_id long, price double")
    df = df.select("currency", "venue", F.timestamp_seconds("epoch").alias("dt"), "event_id", "price")
    s = sequence(df, key=["currency", "venue"], chunks=5)
    got = lagged(s, {"l2": ("price", 2)}, key=["currency", "venue"]).select("event_id", "pos", "n", "l2")
    w = Window.partitionBy("currency", "venue").orderBy("dt", "event_id")
    exp = df.select(
        "event_id",
        (F.row_number().over(w) - 1).cast("bigint").alias("pos"),
        F.count(F.lit(1)).over(Window.partitionBy("currency", "venue")).alias("n"),
        F.lag("price", 2).over(w).alias("l2"),
    )
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_task_retries_give_the_same_positions():
    """Every map task fails once and is retried; positions stay exact."""
    import os
    import subprocess
    import sys

    here = os.path.dirname(os.path.abspath(__file__))
    out = subprocess.run([sys.executable, os.path.join(here, "retry_job.py"), SF01],
                         capture_output=True, text=True, timeout=600)
    assert "RETRY_OK" in out.stdout, out.stdout[-2000:] + out.stderr[-2000:]


@pytest.mark.parametrize("chunks", [1, 7, 64])
def test_odd_keys_and_values(spark, chunks):
    """NULL keys, NaN, infinities, signed zeros, text that JSON escapes, map columns."""
    import random

    from pyspark.sql import Window

    rng = random.Random(1)
    vals = [None, float("nan"), float("inf"), -float("inf"), 0.0, -0.0] + [rng.gauss(0, 1) for _ in range(50)]
    rows = [(rng.choice([None, "a", "", 'b"x\\']), rng.choice(vals), rng.choice([None, "é", "z", "a,b"]), i) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, x double, y string, id long").withColumn("m", F.create_map(F.lit("a"), "x"))
    s = sequence(df, key="k", order=("x", "y", "id"), chunks=chunks).select("id", "pos", "n")
    w = Window.partitionBy("k").orderBy("x", "y", "id")
    exp = df.select("id", (F.row_number().over(w) - 1).cast("bigint").alias("pos"),
                    F.count("*").over(Window.partitionBy("k")).alias("n"))
    assert s.exceptAll(exp).count() == 0 and exp.exceptAll(s).count() == 0


def test_positions_write_nothing_and_shuffle_rows_once(spark):
    from tickweave.session import checkpoint_root

    before = set(os.listdir(checkpoint_root(spark)))
    s = sequence(ticks_from_events(spark, SF01), chunks=8)
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert s.count() == 10000
    assert set(os.listdir(checkpoint_root(spark))) == before
    # the rows' exchange, the counts' and the offsets': no more
    assert plan.count("Exchange hashpartitioning") == 3 and "rangepartitioning" not in plan


def test_quantiles_where_brackets_miss(spark, monkeypatch):
    """Brackets of no width around coarse approximations, ties, NULLs and a
    series of one value: still exact."""
    from tickweave.operators import scale

    monkeypatch.setattr(scale, "SKETCH_K", 8)
    monkeypatch.setattr(scale, "BRACKET", 0.0)
    rows = [("a", i, i, float((i * 37) % 101), 1.0, 1.0) for i in range(500)]
    rows += [("b", i, 1000 + i, 5.0, 1.0, 1.0) for i in range(30)] + [("c", i, 2000 + i, None, 1.0, 1.0) for i in range(3)]
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)
    got = {r["currency"]: r for r in scale.exact_quantiles(make_ticks(spark, rows), ("price",), probs).collect()}
    want = np.quantile([r[3] for r in rows if r[0] == "a"], probs)
    assert np.allclose([got["a"][f"q{i}"] for i in range(len(probs))], want)
    assert all(got["b"][f"q{i}"] == 5.0 for i in range(len(probs))) and "c" not in got
