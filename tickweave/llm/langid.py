"""Language identification by interpolated Kneser-Ney character models.

One model of order four a language, fitted on a bounded sample of rows
(``SAMPLE_ROWS`` in all, shared evenly by the languages; whole texts). The
n-grams of an order are kept as one sorted array of 64-bit hashes with their
interpolated probabilities and one of contexts with their back-off weights. A
text goes to the language of lowest cross-entropy a character. A fifth of the
sample is set aside to calibrate: the score is a logistic function of the
margin over the second language, and a text is rejected (``accepted`` false)
if its cross-entropy is beyond what texts of that language have there.

Texts are lower-cased and everything but letters and marks becomes one space.
Defined results: a null text or one without a letter is ``und`` with score 0
and not accepted; without any learnable row every text is ``und``; ties go to
the language that sorts first; null ids and repeated rows are predicted row by
row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import held_out

ORDER = 4
SAMPLE_ROWS = 4_000
CHUNK = 1 << 20  # characters scored at once
CACHE = 1 << 20  # n-grams whose scores a task keeps
UNIFORM = 1 / 65_536  # below the unigrams
_MIX = np.uint64(0x9E3779B97F4A7C15)
_OTHER = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")


def normal(text: str | None) -> str:
    """Letters and marks in lower case, words apart by one space; empty without a letter."""
    t = (text or "").lower()
    return _OTHER.sub(" ", t).strip(" ") if _LETTER.search(t) else ""


def codes(t: str) -> np.ndarray:
    return np.frombuffer((" " * (ORDER - 1) + t + " ").encode("utf-32-le"), "<u4").astype(np.uint64)


def hashes(c: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams that end at each place from ORDER - 1 on. ``c``: codes, last axis."""
    m = c.shape[-1] - (ORDER - 1)
    h = np.full((*c.shape[:-1], m), n, np.uint64)
    for k in range(ORDER - n, ORDER):
        h = (h + c[..., k:k + m]) * _MIX
        h = h ^ (h >> np.uint64(29))
    return h * _MIX


def contexts(c: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n characters before the last one of each n-gram place."""
    m = c.shape[-1] - (ORDER - 1)
    h = np.full((*c.shape[:-1], m), n + 16, np.uint64)
    for k in range(ORDER - 1 - n, ORDER - 1):
        h = (h + c[..., k:k + m]) * _MIX
        h = h ^ (h >> np.uint64(29))
    return h * _MIX


def _find(keys: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
    return at, (keys[at] == h if len(keys) else np.zeros(len(h), bool))


@dataclass
class KneserNey:
    """Of one language: per order sorted hashes and log probabilities, and
    sorted context hashes and log back-off weights."""

    grams: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    backs: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    unseen: float = 0.0

    @classmethod
    def fit(cls, chars: np.ndarray, counts: np.ndarray) -> KneserNey:
        """From distinct ORDER-grams (rows of code points) and their counts."""
        own = {ORDER: (chars, counts.astype(float))}
        for n in range(ORDER - 1, 0, -1):  # continuation counts: in how many longer ones
            longer = own[n + 1][0]
            _, first, times = np.unique(hashes(longer, n)[:, 0], return_index=True, return_counts=True)
            own[n] = (longer[first], times.astype(float))
        model = cls()
        for n in range(1, ORDER + 1):
            c, k = own[n]
            once, twice = (k == 1).sum(), (k == 2).sum()
            d = min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.1
            key, which, types = np.unique(contexts(c, n - 1)[:, 0], return_inverse=True, return_counts=True)
            total = np.bincount(which, k)
            back = d * types / total
            lower = np.exp(model.log_p(c, n - 1)) if n > 1 else UNIFORM
            p = np.maximum(k - d, 0) / total[which] + back[which] * lower
            if n == 1:
                model.unseen = float(np.log(back[0] * UNIFORM))
            h = hashes(c, n)[:, 0]
            order = np.argsort(h)
            model.grams.append((h[order], np.log(p)[order]))
            model.backs.append((key, np.log(back)))
        return model

    def log_p(self, c: np.ndarray, upto: int = ORDER) -> np.ndarray:
        """Log probability of the last character of each row of ``c``."""
        out = np.full(len(c), self.unseen)
        for n in range(1, upto + 1):
            if n > 1:
                at, has = _find(self.backs[n - 1][0], contexts(c, n - 1)[:, 0])
                out = np.where(has, out + self.backs[n - 1][1][at], out)
            at, has = _find(self.grams[n - 1][0], hashes(c, n)[:, 0])
            out = np.where(has, self.grams[n - 1][1][at], out)
        return out


class Scorer:
    """Sums of log probabilities a text and language, with a cache of n-grams."""

    def __init__(self, models: list[KneserNey]):
        self.models = models
        self.clear()

    def clear(self) -> None:
        self.keys, self.values = np.zeros(0, np.uint64), np.zeros((len(self.models), 0), np.float64)
        self.slot = np.zeros(1 << 20, np.int32)

    def places(self, c: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Where the n-grams are in the cache, after adding those that are not."""
        shift = np.uint64(44)
        if len(self.keys):
            at = self.slot[h >> shift]
            miss = np.flatnonzero(self.keys[at] != h)
            slow, has = _find(self.keys, h[miss])
            at[miss] = slow
            new = miss[~has]
        else:
            at, new = np.zeros(len(h), np.int32), np.arange(len(h))
        if len(new):
            if len(self.keys) > CACHE:
                self.clear()
                return self.places(c, h)
            fresh, first = np.unique(h[new], return_index=True)
            rows = new[first][:, None] + np.arange(ORDER)
            values = np.stack([m.log_p(c[rows]) for m in self.models])
            keys = np.concatenate([self.keys, fresh])
            order = np.argsort(keys)
            self.keys, self.values = keys[order], np.concatenate([self.values, values], 1)[:, order]
            self.slot[self.keys >> shift] = np.arange(len(self.keys))
            return _find(self.keys, h)[0]
        return at

    def sums(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(languages x texts) sums, and how many characters each text has. The
        texts are cut into chunks with the characters before them as context."""
        out, sizes = np.zeros((len(self.models), len(texts))), np.zeros(len(texts), np.int64)
        held, owners, size = [], [], 0

        def flush() -> None:
            c = np.concatenate(held)
            h = hashes(c, ORDER)
            own = np.repeat(np.arange(len(held)), [len(x) for x in held])
            good = own[ORDER - 1:] == own[:len(own) - ORDER + 1]  # not across two pieces
            at = self.places(c, h)[good]
            starts = np.concatenate([[0], np.cumsum([len(x) - ORDER + 1 for x in held])[:-1]])
            for k in range(len(self.models)):
                np.add.at(out[k], owners, np.add.reduceat(self.values[k][at], starts))

        for i, t in enumerate(texts):
            if not t:
                continue
            c = codes(t)
            sizes[i] = len(c) - ORDER + 1
            for a in range(0, len(c) - ORDER + 1, CHUNK):
                piece = c[a:a + CHUNK + ORDER - 1]
                if size + len(piece) > 2 * CHUNK and held:
                    flush()
                    held, owners, size = [], [], 0
                held.append(piece)
                owners.append(i)
                size += len(piece)
        if held:
            flush()
        return out, sizes


@dataclass
class LangId:
    langs: list[str]
    models: list[KneserNey]
    limits: np.ndarray  # highest cross-entropy accepted, by language
    slope: float = 1.0
    offset: float = 0.0

    def predict(self, scorer: Scorer, texts: list[str | None]) -> pd.DataFrame:
        clean = [normal(t) for t in texts]
        none = np.array([not t for t in clean]) if self.langs else np.ones(len(clean), bool)
        if not self.langs or none.all():
            return pd.DataFrame({"lang_pred": ["und"] * len(clean), "score": np.zeros(len(clean)), "accepted": np.zeros(len(clean), bool)})
        sums, sizes = scorer.sums(clean)
        entropy = -sums / np.maximum(sizes, 1)
        best = entropy.argmin(0)
        low = entropy.min(0)
        gap = margin(entropy, sizes)
        score = 1 / (1 + np.exp(-np.clip(self.slope * gap + self.offset, -30, 30)))
        names = np.array(self.langs, dtype=object)[best]
        return pd.DataFrame({"lang_pred": np.where(none, "und", names), "score": np.where(none, 0.0, score),
                             "accepted": ~none & (low <= self.limits[best])})


def margin(entropy: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How far the second language is behind, more for longer texts."""
    if len(entropy) < 2:
        return np.log1p(sizes)
    low = np.partition(entropy, 1, axis=0)
    return (low[1] - low[0]) * np.log1p(sizes)


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> LangId:
    """Models from ``lang`` and ``text`` of the rows outside the held-out fold."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    rows = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}  # one row a language
    if not sizes:
        return LangId([], [], np.zeros(0))
    each = max(1, sample_rows // len(sizes))
    share = docs.sparkSession.createDataFrame([(k, min(1.0, each / n)) for k, n in sizes.items()], "lang string, share double")
    chosen = F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(1 << 30)) < F.col("share") * (1 << 30)
    rows = rows.join(F.broadcast(share), "lang").filter(chosen).select("lang", "text", (fold == 1).alias("calibrates"))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for lang, part in f[~f["calibrates"]].groupby("lang"):
                for i in range(0, len(part), 256):
                    cs = [codes(t) for t in map(normal, part["text"].iloc[i:i + 256]) if t]
                    if cs:
                        grams = np.concatenate([np.lib.stride_tricks.sliding_window_view(c, ORDER) for c in cs])
                        _, first, times = np.unique(hashes(grams, ORDER)[:, 0], return_index=True, return_counts=True)
                        text = grams[first].astype("<u4").tobytes().decode("utf-32-le")
                        yield pd.DataFrame({"lang": lang, "gram": [text[k:k + ORDER] for k in range(0, len(text), ORDER)], "n": times})

    grams = rows.mapInPandas(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    grams = grams.sort_values(["lang", "gram"])
    langs, models = [], []
    for lang, part in grams.groupby("lang", sort=True):
        chars = np.frombuffer("".join(part["gram"]).encode("utf-32-le"), "<u4").astype(np.uint64).reshape(-1, ORDER)
        langs.append(lang)
        models.append(KneserNey.fit(chars, part["n"].to_numpy()))
    model = LangId(langs, models, np.full(len(langs), np.inf))
    return _calibrated(model, rows.filter("calibrates").select("lang", "text")) if langs else model


def _calibrated(model: LangId, rows: DataFrame) -> LangId:
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        scorer = Scorer(m.models)
        for f in frames:
            clean = [normal(t) for t in f["text"]]
            sums, sizes = scorer.sums(clean)
            entropy = -sums / np.maximum(sizes, 1)
            yield pd.DataFrame({"best": entropy.argmin(0), "low": entropy.min(0), "gap": margin(entropy, sizes), "size": sizes,
                                "right": [m.langs[b] == x for b, x in zip(entropy.argmin(0), f["lang"])]})

    seen = rows.mapInPandas(measure, "best long, low double, gap double, size long, right boolean").filter("size > 0").toPandas()
    seen = seen.sort_values(list(seen.columns))
    for k in range(len(model.langs)):
        low = seen.loc[(seen["best"] == k) & seen["right"], "low"]
        if len(low) >= 5:
            model.limits[k] = low.quantile(0.995) + 3 * low.std(ddof=0)
    x, y = seen["gap"].to_numpy(), seen["right"].to_numpy(float)
    a, b = 1.0, 0.0
    for _ in range(30 if len(x) else 0):  # Newton steps of a ridged logistic regression
        q = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = np.maximum(q * (1 - q), 1e-6)
        hess = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.1]])
        da, db = np.linalg.solve(hess, [((q - y) * x).sum() + 0.1 * a, (q - y).sum() + 0.1 * b])
        a, b = a - np.clip(da, -1, 1), b - np.clip(db, -1, 1)
    model.slope, model.offset = float(max(a, 1e-3)), float(b)
    return model


def predict(docs: DataFrame, model: LangId) -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, accepted boolean")
    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        scorer = Scorer(m.models)
        for s in batches:
            parts = [m.predict(scorer, s.iloc[i:i + 512].tolist()) for i in range(0, len(s), 512)]
            yield pd.concat(parts) if parts else m.predict(scorer, [])

    rows = docs.select("doc_id", guess(F.col("text").cast("string")).alias("g"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "g.lang_pred", "g.score", "g.accepted")
