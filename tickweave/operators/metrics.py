"""Forecast scores and error metrics.

A score frame has one row per (model, series, window, horizon) with actual
and predicted values. Baseline forecasters here are built-in expressions over
block windows; model forecasts (ml, arima) produce the same frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickweave.plans.neighbors import block_window, lagged, with_neighbors
from tickweave.schema import KEY


def _origins(s: DataFrame, n_in: int, n_out: int) -> DataFrame:
    """Rows that end a full input window and have all n_out targets."""
    return s.filter((F.col("pos") >= n_in - 1) & (F.col("pos") + n_out <= F.col("n") - 1))


def persistence_scores(sdf: DataFrame, col: str = "price", n_in: int = 35, n_out: int = 3, key: str = KEY) -> DataFrame:
    """Predict the last input value for every horizon 1..n_out."""
    s = _origins(lagged(sdf, {f"_f{h}": (col, -h) for h in range(1, n_out + 1)}, key), n_in, n_out)
    return s.select(
        F.lit("persistence").alias("model"),
        key,
        (F.col("pos") - (n_in - 1)).alias("window_id"),
        F.posexplode(F.array(*[F.col(f"_f{h}") for h in range(1, n_out + 1)])).alias("_i", "actual"),
        F.col(col).alias("predicted"),
    ).select("model", key, "window_id", (F.col("_i") + 1).alias("horizon"), "actual", "predicted")


def window_mean_scores(sdf: DataFrame, col: str = "price", n_in: int = 35, n_out: int = 3, key: str = KEY) -> DataFrame:
    """Predict the mean of the n_in input values for every horizon."""
    nb = with_neighbors(sdf, key, before=n_in - 1, after=n_out)
    w = block_window(key)
    nb = nb.withColumn("_m", F.avg(col).over(w.rowsBetween(-(n_in - 1), 0)))
    for h in range(1, n_out + 1):
        nb = nb.withColumn(f"_f{h}", F.lead(col, h).over(w))
    s = _origins(nb.filter("_own"), n_in, n_out)
    return s.select(
        F.lit("window_mean").alias("model"),
        key,
        (F.col("pos") - (n_in - 1)).alias("window_id"),
        F.posexplode(F.array(*[F.col(f"_f{h}") for h in range(1, n_out + 1)])).alias("_i", "actual"),
        F.col("_m").alias("predicted"),
    ).select("model", key, "window_id", (F.col("_i") + 1).alias("horizon"), "actual", "predicted")


def window_persistence_scores(windows: DataFrame, feature: str = "price", split: str | None = "test",
                              key: str = KEY) -> DataFrame:
    """Persistence forecast on a window frame (x, y): every horizon predicts
    the last input value of ``feature``; optionally one split only."""
    w = windows if split is None else windows.filter(F.col("split") == split)
    return w.select(
        F.lit("persistence").alias("model"), key, "window_id",
        F.element_at(F.col("x"), -1)[feature].alias("predicted"),
        F.posexplode("y").alias("_i", "actual"),
    ).select("model", key, "window_id", (F.col("_i") + 1).alias("horizon"), "actual", "predicted")


def to_usd(scores: DataFrame, stats: DataFrame, feature: str, key: str = KEY) -> DataFrame:
    """M5 on a score frame: undo min-max (the chain, C8/C9) and ln(x+1) on
    both actual and predicted, so metrics come out in USD (A11)."""
    from tickweave.operators.scale import inverse_scale

    s = inverse_scale(scores, stats, ("actual", "predicted"), feature, key, out=("_a", "_p"))
    return s.drop("actual", "predicted").withColumnRenamed("_a", "actual").withColumnRenamed("_p", "predicted")


def score_join(pred: DataFrame, actual: DataFrame, keys: Sequence[str] = (KEY, "window_id", "horizon")) -> DataFrame:
    """Predictions next to actuals by (series, window, horizon); a hash
    join on the full key, so no series lands in one task."""
    return pred.join(actual, list(keys))


def regression_metrics(scores: DataFrame, by: Sequence[str] = (KEY,)) -> DataFrame:
    """Mse, rmse, mae and the signed mean error avg(pred - actual)
    (C14: what one notebook prints as "MAE")."""
    e = F.col("predicted") - F.col("actual")
    return scores.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(e * e).alias("mse"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(e).alias("mean_error"),
    )


def r2_by_horizon(scores: DataFrame, by: Sequence[str] = (KEY,)) -> DataFrame:
    """R2 per horizon, 1 - SSE / SST, then the uniform average over
    horizons (sklearn multi-output ``score``)."""
    e = F.col("predicted") - F.col("actual")
    per_h = scores.groupBy(*by, "horizon").agg(
        (F.lit(1.0) - F.try_divide(F.sum(e * e), F.nullif(F.var_pop("actual") * F.count("actual"), F.lit(0.0)))).alias("r2")
    )
    return per_h.groupBy(*by).agg(F.avg("r2").alias("r2"), F.count(F.lit(1)).alias("horizons"))


def compare_models(*scores: DataFrame) -> DataFrame:
    """Metrics per model over the union of score frames, ranked by rmse."""
    u = scores[0]
    for s in scores[1:]:
        u = u.unionByName(s)
    m = regression_metrics(u, by=("model",))
    # one row per model: a global order over a handful of rows
    return m.withColumn("rank", F.rank().over(Window.orderBy(F.col("rmse").asc_nulls_last(), F.col("model"))))


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction",
             by: Sequence[str] | None = None) -> DataFrame:
    """Share of rows where the prediction equals the label (per group)."""
    aggs = [F.avg((F.col(prediction) == F.col(label)).cast("double")).alias("accuracy"),
            F.count(F.lit(1)).alias("n")]
    return pred.groupBy(*by).agg(*aggs) if by else pred.agg(*aggs)
