"""Toxicity: cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wicketflow.llm.common import append_columns
from wicketflow.session import stage

WORD = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 18
#: Labelled rows of each grade that a model is fitted on, at most.
SAMPLE = 6_000


def features(text: str | None, buckets: int = BUCKETS) -> np.ndarray:
    """The hashed words of a text and their first five letters, each once, in any case."""
    words = set(WORD.findall((text or "").lower()))
    words |= {"^" + w[:5] for w in words if len(w) >= 5}
    made = {zlib.crc32(w.encode()) % buckets for w in words}
    return np.fromiter(sorted(made), np.int32, len(made))


@dataclass(frozen=True)
class OrdinalModel:
    """P(grade <= k) = logistic(threshold_k - score); the score shares its weights across
    all thresholds."""

    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        return np.array([self.weights[r].sum(dtype=np.float64) for r in rows])

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each row and threshold."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -500, 500)))


def fit(rows: list[np.ndarray], grades: np.ndarray, buckets: int = BUCKETS,
        penalty: float = 4e-4, rounds: int = 250, rate: float = 0.08) -> OrdinalModel:
    """Maximum likelihood with a squared penalty, by full-batch Adam from zero.

    `grades` are 0, 1, ... without a gap. Thresholds are the first one and the logarithms of
    the gaps, so they stay in order. Each grade weighs as much as any other in sum. Without
    rows, or with grade 0 alone, there is no threshold to cross: all texts have severity 0.
    """
    grades = np.asarray(grades, np.int64)
    levels = int(grades.max()) + 1 if len(grades) else 0
    if levels < 2:
        return OrdinalModel(np.zeros(buckets, np.float32), np.zeros(0))
    sizes = np.array([len(r) for r in rows])
    flat = np.concatenate(rows) if sizes.sum() else np.zeros(0, np.int64)
    used, columns = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), sizes)
    weight = 1.0 / np.bincount(grades, minlength=levels)[grades] / levels
    w = np.zeros(len(used))
    raw = np.concatenate(([-(levels - 2) / 2], np.zeros(levels - 2)))  # first, log gaps
    state = [np.zeros(len(w) + len(raw)) for _ in range(2)]
    for step in range(1, rounds + 1):
        gaps = np.exp(raw[1:])
        theta = raw[0] + np.concatenate(([0.0], np.cumsum(gaps)))
        score = np.bincount(owner, w[columns], len(rows)) if len(flat) else np.zeros(len(rows))
        edges = np.concatenate(([-np.inf], theta, [np.inf]))
        high, low = (_logistic(edges[grades + k] - score) for k in (1, 0))
        inside = np.maximum(high - low, 1e-12)
        dh, dl = high * (1 - high) / inside, low * (1 - low) / inside
        slope = weight * (dh - dl)  # of the loss by the score
        grad_w = np.bincount(columns, slope[owner], len(w)) + penalty * w
        grad_t = (np.bincount(grades, -weight * dh, levels)[:-1]
                  + np.bincount(grades, weight * dl, levels)[1:])
        tail = np.cumsum(grad_t[::-1])[::-1]
        grad = np.concatenate((grad_w, tail[:1], tail[1:] * gaps))
        state[0] = 0.9 * state[0] + 0.1 * grad
        state[1] = 0.999 * state[1] + 0.001 * grad * grad
        move = rate * state[0] / (1 - 0.9 ** step) / (
            np.sqrt(state[1] / (1 - 0.999 ** step)) + 1e-10)
        w -= move[:len(w)]
        raw -= move[len(w):]
    weights = np.zeros(buckets, np.float32)
    weights[used] = w
    return OrdinalModel(weights, raw[0] + np.concatenate(([0.0], np.cumsum(np.exp(raw[1:])))))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str,
                    bound: int = SAMPLE) -> tuple[list[np.ndarray], np.ndarray]:
    """Features and labels of at most `bound` labelled rows of each label value.

    The rows with the smallest hashed keys are taken, so the sample does not depend on how
    the tables are laid out. Labels that are null or name no document are left out; of a
    document labelled twice the larger label counts. All label values are taken; they are
    grades, of which there are few. No labels give no rows.
    """
    marks = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
             .groupBy(F.col(key).alias("key")).agg(F.max(label).alias("label")))
    order = Window.partitionBy("label").orderBy(F.xxhash64("key", F.lit(11)), "key")
    picked = stage(marks.withColumn("rank", F.row_number().over(order))
                   .where(F.col("rank") <= bound).drop("rank"), "sample")
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(picked, "key")
    made = append_columns(texts.select("text", "label"), "text", lambda: lambda ts: [
        [features(t).tobytes() for t in ts]], [T.StructField("bag", T.BinaryType())])
    rows = made.select("label", "bag").collect()  # the bounded sample
    rows.sort(key=lambda r: (r.label, bytes(r.bag)))
    return ([np.frombuffer(r.bag, np.int32) for r in rows],
            np.array([r.label for r in rows], np.int64))


def severity_grades(rows: list[np.ndarray], toxic: np.ndarray,
                    buckets: int = BUCKETS) -> np.ndarray:
    """Grades for labels, of which all above 0 are toxic: 0 is clean; 1 and 2 are the toxic
    rows with fewer and with more marked words than the median toxic row.

    A word is marked if it is far more frequent in toxic than in clean rows (a smoothed
    log-odds over 2). Without two different counts all toxic rows have grade 1.
    """
    toxic = (np.asarray(toxic) > 0).astype(np.int64)
    counts = [np.bincount(np.concatenate([r for r, y in zip(rows, toxic) if y == v]
                                         or [np.zeros(0, np.int64)]), minlength=buckets)
              for v in (0, 1)]
    n = np.maximum(np.bincount(toxic, minlength=2)[:2], 1)
    odds = (np.log((counts[1] + 1) / (n[1] + 2)) - np.log((counts[0] + 1) / (n[0] + 2)))
    marked = (odds > 2) & (counts[1] >= 5)
    strength = np.array([marked[r].sum() for r in rows])
    own = strength[toxic == 1]
    if not len(own) or own.min() == own.max():
        return (toxic == 1).astype(np.int64)
    middle = min(np.median(own), own.max() - 1)
    return np.where(toxic == 1, 1 + (strength > middle), 0)


def predict(df: DataFrame, model: OrdinalModel, text: str = "text") -> DataFrame:
    """`df` with `expected_severity`, the sum of P(grade > k), and `severity`, the most
    probable grade.

    Each row is scored alone: nothing is shuffled, equal rows get equal scores, whole texts
    count. Null and empty texts have the score of no words. Other columns pass through. An
    empty table stays empty.
    """

    def compute(texts: list[str | None]) -> list[list]:
        above = model.above(model.score([features(t, len(model.weights)) for t in texts]))
        share = np.diff(np.concatenate((np.ones((len(texts), 1)), above,
                                        np.zeros((len(texts), 1))), axis=1), axis=1) * -1
        return [above.sum(axis=1).tolist(), share.argmax(axis=1).tolist()]

    return append_columns(df, text, lambda: compute, [
        T.StructField("expected_severity", T.DoubleType()),
        T.StructField("severity", T.LongType())])
