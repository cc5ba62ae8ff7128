"""Document quality by a regularised quadratic discriminant.

Every text is reduced to a fixed vector of transformed statistics (logs
and smoothed log ratios).  For each class, mean and covariance come from
sums that Spark aggregates over all labelled training rows; covariances
are shrunk towards the pooled diagonal.  A document's score is the
difference of the two log densities, each a Mahalanobis distance through
the inverse of the class's cached Cholesky factor, passed through a
logistic curve fitted to a histogram of the training rows' differences.
The driver holds two means, two small matrices and that histogram.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starledger.llm.common import fresh, shared_table, text_of, with_bitmap

THRESHOLD = 0.3
RIDGE = 1e-2
BINS = 400
CLIP = 200.0
STATS = ("words", "word_length", "upper", "digit", "stop", "odd", "shout", "distinct", "top_word", "adjacent",
         "lines", "line_copies", "longest", "entropy", "odd_words", "upper_words")

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[128:] = True  # bytes of letters beyond ASCII
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:'\"()-"]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ODD = ~(_LETTER | _DIGIT | _STOP | _SPACE)


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one whole text (null: empty)."""
    data = (text or "").encode("utf-8", "surrogatepass")
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    letters, upper = int(count[_LETTER].sum()), int(count[_UPPER].sum())
    visible = len(data) - int(count[_SPACE].sum())
    words = data.split()
    n = len(words)
    seen = Counter(words)
    most = max(seen.values(), default=0)
    adjacent = sum(map(bytes.__eq__, words, words[1:])) if most > 1 else 0
    lines = data.split(b"\n")
    share = count[count > 0] / max(1, len(data))
    odd_ends = sum(1 for w in seen if _ODD[w[-1]])
    capital = sum(1 for w in seen if len(w) > 1 and w.isupper())
    ratio = lambda part, whole: math.log((part + 0.5) / (whole + 1.0))
    return [
        math.log1p(n), math.log((visible + 1.0) / (n + 1.0)), ratio(upper, letters), ratio(int(count[_DIGIT].sum()), visible),
        ratio(int(count[_STOP].sum()), visible), ratio(int(count[_ODD].sum()), visible), ratio(int(count[33] + count[63]), visible),
        ratio(len(seen), n), ratio(most, n), ratio(adjacent, n), ratio(len(lines), n), ratio(len(set(lines)), len(lines)),
        math.log1p(max(map(len, seen), default=0)), float(-(share * np.log(share)).sum()), ratio(odd_ends, len(seen)),
        ratio(capital, len(seen)),
    ]


def statistics_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x): the statistics of every row."""
    def run(batches):
        for batch in batches:
            x = [statistics(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["id", "x"])

    narrow = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"id {kind}, x array<double>")


@dataclass
class Model:
    """Two Gaussians and the curve that maps their difference to a score."""

    mean: list[np.ndarray]
    whiten: list[np.ndarray]      # inverse of the Cholesky factor, per class
    log_det: list[float]
    log_prior: list[float]
    slope: float = 1.0
    offset: float = 0.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 minus that of class 0, with priors."""
        side = []
        for k in (0, 1):
            z = (x - self.mean[k]) @ self.whiten[k].T
            side.append(self.log_prior[k] - 0.5 * ((z * z).sum(axis=1) + self.log_det[k]))
        return np.clip(side[1] - side[0], -CLIP, CLIP)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * self.difference(x) + self.offset, -60, 60)))


def shrunk(cov: np.ndarray, pooled: np.ndarray, n: float) -> np.ndarray:
    """Covariance shrunk towards the pooled diagonal; the weight is the
    oracle-approximating one in the scale where that diagonal is one."""
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-12))
    s = cov / scale[:, None] / scale[None, :]
    p = len(s)
    tr, tr2 = np.trace(s), np.trace(s @ s)
    below = (n + 1 - 2 / p) * (tr2 - tr * tr / p)
    rho = 1.0 if below <= 0 else min(1.0, max(0.0, ((1 - 2 / p) * tr2 + tr * tr) / below))
    s = (1 - rho) * s + rho * np.eye(p) * max(tr / p, RIDGE) + RIDGE * np.eye(p)
    return s * scale[:, None] * scale[None, :]


def fit(rows: DataFrame) -> Model | None:
    """Model from (x, label) rows with label 0 or 1, all of them; None if
    a class has no rows."""
    p = len(STATS)
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    sums = [F.sum(F.get("x", F.lit(i))).alias(f"s{i}") for i in range(p)]
    sums += [F.sum(F.get("x", F.lit(i)) * F.get("x", F.lit(j))).alias(f"c{i}_{j}") for i, j in pairs]
    got = {r["label"]: r for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), *sums).collect()}
    if set(got) != {0, 1}:
        return None
    n, mean, cov = [], [], []
    for k in (0, 1):
        r = got[k]
        n.append(float(r["n"]))
        mean.append(np.array([r[f"s{i}"] for i in range(p)]) / n[k])
        c = np.zeros((p, p))
        for i, j in pairs:
            c[i, j] = c[j, i] = r[f"c{i}_{j}"] / n[k]
        cov.append(c - np.outer(mean[k], mean[k]))
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / sum(n)
    whiten, log_det = [], []
    for k in (0, 1):
        factor = np.linalg.cholesky(shrunk(cov[k], pooled, n[k]))
        whiten.append(np.linalg.inv(factor))
        log_det.append(2.0 * float(np.log(np.diag(factor)).sum()))
    model = Model(mean, whiten, log_det, [math.log(n[k] / sum(n)) for k in (0, 1)])

    def differences(batches):
        for batch in batches:
            x = np.array(batch.column(0).to_pylist(), float).reshape(batch.num_rows, p)
            place = np.floor((model.difference(x) + CLIP) / (2 * CLIP) * (BINS - 1e-9)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(place), batch.column(1)], ["bin", "label"])

    histogram = (rows.select("x", "label").mapInArrow(differences, "bin long, label int")
                 .groupBy("bin", "label").agg(F.count(F.lit(1)).alias("n")).collect())
    model.slope, model.offset = _logistic([((r["bin"] + 0.5) / BINS * 2 * CLIP - CLIP, r["label"], r["n"]) for r in histogram])
    return model


def _logistic(points: list[tuple[float, int, int]], rounds: int = 60) -> tuple[float, float]:
    """Slope and offset of a logistic curve through (difference, label,
    count), by damped Newton steps with a weak pull to slope 1, offset 0."""
    d, y, n = (np.array(v, float) for v in zip(*sorted(points)))
    w, pull = np.array([0.2, 0.0]), np.array([1e-3, 1e-3]) * n.sum()
    x = np.stack([d, np.ones_like(d)], axis=1)
    loss = lambda w: float((n * np.logaddexp(0, np.where(y > 0, -1, 1) * (x @ w))).sum() + 0.5 * (pull * (w - [1, 0]) ** 2).sum())
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -60, 60)))
        grad = x.T @ (n * (q - y)) + pull * (w - [1, 0])
        hess = (x * (n * q * (1 - q))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(hess, grad)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(step).max() < 1e-9:
            break
    return max(1e-3, float(w[0])), float(w[1])


def train(docs: DataFrame, labels: DataFrame, use: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> tuple[DataFrame, Model | None]:
    """The statistics of all rows of ``docs`` (a shared table) and the
    model of the labelled ones for which ``use`` (over ``id``) holds."""
    x = shared_table(statistics_table(docs, id_col, text_col), "quality-statistics")
    marks = labels.select(labels[id_col].alias("id"), labels[label_col].try_cast("int").alias("label")).where("label IN (0, 1)")
    return x, fit(x.where(use).join(marks, "id").select("x", "label"))


def scored(x: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """(id, score, predicted) per row; without a model the score is 0.5."""
    def run(batches):
        for batch in batches:
            v = np.array(batch.column(1).to_pylist(), float).reshape(batch.num_rows, len(STATS))
            s = model.score(v) if model else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["id", "score", "predicted"])

    kind = x.schema["id"].dataType.simpleString()
    return x.mapInArrow(run, f"id {kind}, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``held_out``, ``score`` (0
    to 1, higher: label 1 likelier), ``predicted`` (1 if ``score`` reaches
    ``threshold``).

    ``held_out`` is a condition over the column ``id``; rows for which it
    holds, or is null, teach nothing.  Only the text enters a score; null
    is empty, and empty texts are scored like others.  Labels other than 0
    and 1 are ignored; if a class has none, every score is 0.5.  A label
    counts once per pair of rows it joins.  Repeated rows give repeated
    result rows; extra columns are ignored."""
    held = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(True))
    x, model = train(docs, labels, ~held, id_col, text_col, label_col)
    return scored(x, model, threshold).select(F.col("id").alias(id_col), held.alias("held_out"), "score", "predicted")


def drop_rejected(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier, taught by all labels, does
    not reject; all columns, in one pass without a shuffle.

    To learn, statistics are taken only of rows that a bitmap of the
    labelled ids lets through (where both ids are of one type)."""
    taught = docs.select(docs[id_col], docs[text_col])
    if docs.schema[id_col].dataType == labels.schema[id_col].dataType:
        known = shared_table(labels.select(F.xxhash64(labels[id_col]).alias("place")), "quality-labelled")
        taught = with_bitmap(taught, F.xxhash64(taught[id_col]), known, *(mark := fresh(taught, "labelled")))
        taught = taught.where(F.col(mark[0])).drop(mark[0])
    _, model = train(taught, labels, F.lit(True), id_col, text_col, label_col)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            v = np.array([statistics(t.as_py()) for t in batch.column(at)], float).reshape(batch.num_rows, len(STATS))
            keep = model.score(v) >= threshold if model else np.full(batch.num_rows, True)
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
