"""Quality scores from a regularised quadratic discriminant over transformed statistics of a document.

Each class gets a Gaussian whose covariance is shrunk towards the pooled one and towards a multiple of the identity.
The Cholesky factors of both are computed once and shipped with the model; a score is the logistic function of the
difference of the two log densities (Mahalanobis distances and log determinants) plus the log prior odds.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tables import carried, restored, row_key, saved

_SPACE, _LOWER, _UPPER, _DIGIT, _MARK, _SYMBOL, _OTHER = range(7)
_CLASS = np.full(256, _OTHER, np.int64)
_CLASS[:128] = _SYMBOL
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[[ord(c) for c in ".,;:'\"()-?!"]] = _MARK
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[ord("A") : ord("Z") + 1] = _UPPER
_CLASS[ord("a") : ord("z") + 1] = _LOWER

#: Added to both sides of a share, so that one odd character of a short text or line doesn't look like a habit.
_PRIOR = 4.0
N_FEATURES = 16


def _odds(part, whole, share: float = 0.02):
    """Log odds of a share, drawn towards ``share`` for small wholes."""
    p = (part + _PRIOR * share) / (whole + _PRIOR)
    return np.log(p / (1 - p + 1e-3))


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a whole text. NULL counts as the empty text."""
    raw = (text or "").encode()
    data = np.frombuffer(raw, np.uint8)
    kind = _CLASS[data]
    line = np.cumsum(data == 10) - (data == 10)
    per = np.bincount(line * 7 + kind, minlength=7 * (int(line[-1]) + 1 if len(data) else 1)).reshape(-1, 7).astype(float)
    total = per.sum(0)
    solid, letters = total[1:].sum(), total[_LOWER] + total[_UPPER]
    words = raw.split()
    n = len(words)
    size = np.fromiter(map(len, words), float, n)
    repeats = sum(map(eq, words, words[1:]))
    counts = Counter(words)
    lines = raw.split(b"\n")
    line_repeats = [(sum(map(eq, w, w[1:])), len(w)) for w in (x.split() for x in lines)]
    long_lines = [x for x in lines if len(x) > 40]
    solids = per[:, 1:].sum(1)
    return [
        float(np.log1p(n)),
        float(np.log((size.sum() + 5 * _PRIOR) / (n + _PRIOR))),
        float(np.log1p(np.sqrt(((size - size.mean()) ** 2).sum() / (n + _PRIOR)))) if n else 0.0,
        float(_odds(total[_UPPER], letters)),
        float(_odds(total[_SYMBOL], solid)),
        float(_odds(total[_DIGIT], solid)),
        float(_odds(total[_MARK], solid)),
        float(_odds(total[_OTHER], solid)),
        float(np.log((len(counts) + _PRIOR) / (n + _PRIOR)) / np.log(n + 10)),
        float(_odds(repeats, n)),
        float(_odds(max(counts.values(), default=0), n, 0.05)),
        float(_odds(sum(len(x) for x in long_lines) - sum(len(x) for x in set(long_lines)), len(raw))),
        float(_odds(per[:, _UPPER], per[:, _UPPER] + per[:, _LOWER]).max()),
        float(_odds(per[:, _SYMBOL], solids).max()),
        float(max(_odds(r, m) for r, m in line_repeats)),
        float(np.log1p(n / len(lines))),
    ]


def measured(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """``(doc, k1, k2, x)`` per row: the id, the row's key and the statistics of its text."""

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["doc", "k1", "k2"]].assign(x=[statistics(t) for t in batch["text"]])

    held = docs.select(carried(doc).alias("doc"), *row_key(doc, text), F.col(text).alias("text"))
    found = held.mapInPandas(measure, "doc string, k1 long, k2 long, x array<double>")
    return found.select(restored(docs, doc), "k1", "k2", "x")


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and log constants of the two classes, after scaling."""

    centre: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, np.ndarray]
    factors: tuple[np.ndarray, np.ndarray]
    constants: tuple[float, float]

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.centre) / self.scale
        log = [c - 0.5 * (((z - m) @ f.T) ** 2).sum(1) for m, f, c in zip(self.means, self.factors, self.constants)]
        return 1 / (1 + np.exp(-np.clip(log[1] - log[0], -40, 40)))


def fit(examples: DataFrame, pooled: float = 0.3, ridge: float = 0.05) -> Discriminant | float:
    """Fit on ``(label, x)``. Only sums of products, a few hundred numbers per class, come to the driver.

    With one class only, the answer is that label for every text; with none it is 0.5.
    """

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for label, own in batch.groupby("label"):
                z = np.column_stack([np.ones(len(own)), np.array(own["x"].to_list())])
                sums[label] = sums.get(label, 0) + z.T @ z
        for label, s in sums.items():
            i, j = np.indices(s.shape)
            yield pd.DataFrame({"label": int(label), "i": i.ravel(), "j": j.ravel(), "s": s.ravel()})

    parts = examples.mapInPandas(moments, "label int, i int, j int, s double")
    found = parts.groupBy("label", "i", "j").agg(F.sum("s").alias("s")).toPandas()
    sums = {int(c): own.pivot(index="i", columns="j", values="s").to_numpy() for c, own in found.groupby("label")}
    if set(sums) != {0, 1}:
        return float(next(iter(sums))) if len(sums) == 1 else 0.5
    n = {c: s[0, 0] for c, s in sums.items()}
    mean = {c: s[0, 1:] / n[c] for c, s in sums.items()}
    spread = {c: s[1:, 1:] / n[c] - np.outer(mean[c], mean[c]) for c, s in sums.items()}
    weight = {c: n[c] / (n[0] + n[1]) for c in n}
    within = weight[0] * spread[0] + weight[1] * spread[1]
    centre = weight[0] * mean[0] + weight[1] * mean[1]
    scale = np.sqrt(np.maximum(np.diag(within), 1e-6))
    means, factors, constants = [], [], []
    for c in (0, 1):
        cov = ((1 - pooled) * spread[c] + pooled * within) / np.outer(scale, scale)
        cov = (1 - ridge) * cov + ridge * np.trace(cov) / len(cov) * np.eye(len(cov))
        lower = np.linalg.cholesky(cov)
        means.append((mean[c] - centre) / scale)
        factors.append(np.linalg.inv(lower))
        constants.append(float(np.log(weight[c]) - np.log(np.diag(lower)).sum()))
    return Discriminant(centre, scale, tuple(means), tuple(factors), tuple(constants))


def held_out(doc: str) -> Column:
    """Every fifth document by the checksum of its id is kept away from learning. A NULL id is not held out."""
    return F.coalesce(F.crc32(F.col(doc).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def quality_scores(
    docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", label: str = "quality", threshold: float = 0.3,
    keys: bool = False,
) -> DataFrame:
    """One row ``(doc, held_out, score, predicted)`` per input row.

    The model learns from all labelled rows that are not held out; ids, labels and other columns are no inputs of a
    score. NULL texts score as empty ones. A NULL label is ignored; of an id with several labels each counts. Rows
    with the same id are scored each on its own text; ``keys`` adds the ``row_key`` of id and text.
    """
    rows = saved(measured(docs, doc, text), "statistics")
    named = labels.select(F.col(doc).alias("labelled"), F.col(label).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & ~held_out("labelled")
    )
    model = fit(rows.join(named, rows[doc] == named["labelled"]).select("label", "x"))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array(batch["x"].to_list()).reshape(len(batch), -1)
            s = model.scores(x) if isinstance(model, Discriminant) else np.full(len(batch), model)
            yield batch[["doc", "k1", "k2"]].assign(score=np.round(s, 9))

    found = rows.select(carried(doc).alias("doc"), "k1", "k2", "x").mapInPandas(score, "doc string, k1 long, k2 long, score double")
    return found.select(restored(docs, doc), "k1", "k2", "score").select(
        doc, held_out(doc).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *(["k1", "k2"] if keys else [])
    )
