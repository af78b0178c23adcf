"""Quality classifier: regularised quadratic discriminant.

Each class has a Gaussian over transformed document statistics, its covariance
shrunk towards the pooled one and that towards its diagonal. The score is the
difference of the two log densities, from Mahalanobis distances through cached
Cholesky factors, calibrated to a probability by logistic regression on it.

The fit uses a bounded sample of labelled rows (``LABELLED_ROWS``) outside the
held-out fold; statistics are DataFrame functions over the whole text, the
score a vectorised function of the statistics alone.

Defined results: a null or empty text has the statistics of no words and gets a
score like any other; null ids and repeated rows are scored row by row; without
two rows of both labels the score is the share of good labels (0.5 if none); an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm.common import held_out, label_sample, labelled_texts
from tickweave.llm.textstats import share, with_counts, with_words

LABELLED_ROWS = 20_000
THRESHOLD = 0.3
FEATURES = 9
P = "__op9_"


def with_features(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: the transformed statistics as array<double>."""
    df = with_counts(with_words(df, text, P), P)
    t, w, n = F.col(f"{P}t"), F.col(f"{P}w"), F.col(f"{P}n_words")
    chars, lines = F.col(f"{P}word_chars"), F.col(f"{P}n_lines")
    rare = lambda x: F.log(x + 0.002)
    ends = F.length(F.regexp_replace(t, r"[^.,;:!?]+", ""))
    digits = F.length(F.regexp_replace(t, r"[^0-9]+", ""))
    features = F.array(
        F.log1p(n), F.log1p(share(chars, n)), rare(share(F.col(f"{P}n_symbols"), chars)),
        rare(share(F.col(f"{P}n_dup_lines"), lines)), share(F.log1p(F.size(F.array_distinct(w))), F.log1p(n)),
        rare(share(F.size(F.array_distinct(w)), n)), rare(share(ends, n)), F.log1p(share(n, lines)), rare(share(digits, chars)),
    )
    return df.withColumn(out, features).drop(*[f"{P}{c}" for c in ("t", "w", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines")])


@dataclass
class Model:
    means: list[np.ndarray]
    factors: list[np.ndarray]  # inverse Cholesky factors, one a class
    log_norm: list[float]
    slope: float
    offset: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log density of good minus log density of bad, priors included."""
        z = [((x - m) @ f.T) for m, f in zip(self.means, self.factors)]
        return (self.log_norm[1] - 0.5 * (z[1] ** 2).sum(1)) - (self.log_norm[0] - 0.5 * (z[0] ** 2).sum(1))

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(x), self.offset)
        m = np.clip(self.margin(x), -50, 50)
        return 1 / (1 + np.exp(-np.clip(self.slope * m + self.offset, -500, 500)))


def train(x: np.ndarray, y: np.ndarray, to_pooled: float = 0.1, to_diagonal: float = 0.1) -> Model:
    if min((y == 0).sum(), (y == 1).sum()) < 2:
        return Model([], [], [], 0.0, float(y.mean()) if len(y) else 0.5)
    parts = [x[y == k] for k in (0, 1)]
    own = [np.cov(p.T, bias=True) for p in parts]
    pooled = sum(c * len(p) for c, p in zip(own, parts)) / len(x)
    model = Model([], [], [], 1.0, 0.0)
    for c, p in zip(own, parts):
        lam = to_pooled + (1 - to_pooled) * min(1.0, x.shape[1] / len(p))  # more for small classes
        c = (1 - lam) * c + lam * pooled
        c = (1 - to_diagonal) * c + to_diagonal * np.diag(np.diag(c)) + 1e-4 * np.eye(len(c))
        low = np.linalg.cholesky(c)
        model.means.append(p.mean(0))
        model.factors.append(np.linalg.inv(low))
        model.log_norm.append(float(np.log(len(p) / len(x)) - np.log(np.diag(low)).sum()))
    m = np.clip(model.margin(x), -50, 50)
    a, b = 1.0, 0.0  # Newton steps of a slightly ridged logistic regression
    for _ in range(25):
        q = 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))
        g, h = q - y, np.maximum(q * (1 - q), 1e-6)
        grad = np.array([(g * m).sum() + 1e-2 * a, g.sum() + 1e-2 * b])
        hess = np.array([[(h * m * m).sum() + 1e-2, (h * m).sum()], [(h * m).sum(), h.sum() + 1e-2]])
        da, db = np.linalg.solve(hess, grad)
        a, b = a - np.clip(da, -1, 1), b - np.clip(db, -1, 1)
    model.slope, model.offset = float(max(a, 1e-3)), float(b)
    return model


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS) -> Model:
    sample = label_sample(spark, labels, "quality", labelled_rows)
    rows = labelled_texts(docs, sample, labelled_rows)
    seen = sorted(with_features(rows, "text", "x").select("x", "y").collect())
    return train(np.array([r[0] for r in seen], float).reshape(len(seen), FEATURES), np.array([r[1] for r in seen], float))


def with_score(docs: DataFrame, model: Model, out: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with the score of each row as column ``out``."""

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(x.to_numpy()))) if len(x) else pd.Series([], dtype=float)

    return with_features(docs, text, f"{P}x").withColumn(out, score(F.col(f"{P}x"))).drop(f"{P}x")


def predicted(score: Column) -> Column:
    return (score >= THRESHOLD).cast("int")


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    rows = with_score(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted(F.col("score")).alias("predicted"))


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject."""
    return with_score(docs, model, f"{P}score").filter(F.col(f"{P}score") >= THRESHOLD).drop(f"{P}score")
