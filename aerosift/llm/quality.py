"""Quality classifier: random Fourier features, ridge scores, isotonic calibration.

1. A task turns each whole text into ``STATISTICS`` numbers (byte and word
   classes, lengths, repetition). The small table of statistics is written once.
2. Means and deviations over the labelled training rows scale the statistics.
   ``FEATURES`` random cosines approximate a Gaussian kernel on them.
3. Normal equations: tasks emit partial sums of X'X and X'y, cut into rows of
   the matrix, which are summed per row number; the driver solves one system
   of FEATURES + 1 unknowns (its size does not depend on the data).
4. Ridge scores of a third of the training folds, which the ridge does not see,
   are counted in ``BINS`` bins; pool-adjacent-violators over those counts gives
   a monotone map from ridge score to probability.

Labels, language, source and id are never inputs of a score. Rows whose fold
(crc32 of the id as text, modulo 4) is 2 are never learned from.

Defined results: a null text scores as the empty text. A null doc_id is in no
fold: it is scored, never learned from, and its ``held_out`` is null. Repeated
rows are scored alike; a document with several labels, or several rows with
its id, is learned from once per pair. Null labels are ignored. Without usable
labels of both kinds every score is the share of label 1 (0.5 without any
label). An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import fold, one_row_per_doc, sum_rows

STATISTICS = 20
FEATURES = 192
RIDGE = 1e-3
BINS = 2000
THRESHOLD = 0.7
_SEED = 20240117

#: Byte classes for the statistics: 0 other, 1 lower, 2 upper, 3 digit, 4 white space, 5 sentence
#: punctuation, 6 symbol, 7 UTF-8 lead or continuation byte.
_CLASS = np.zeros(256, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 7
_CLASS[[32, 9, 10, 11, 12, 13]] = 4
_CLASS[list(b".,;:'\"()-?")] = 5
_CLASS[list(b"!#$%&*+/<=>@[\\]^_`{|}~")] = 6


def statistics(body: bytes) -> list[float]:
    """The statistics of one whole text (UTF-8)."""
    n = len(body)
    if n == 0:
        return [0.0] * STATISTICS
    codes = np.frombuffer(body, np.uint8)
    share = np.bincount(_CLASS[codes], minlength=8) / n
    seen = np.bincount(codes, minlength=256)
    p = seen[seen > 0] / n
    words = body.split()
    n_words = len(words)
    distinct = set(words)
    lengths = np.fromiter(map(len, words), np.int64, n_words) if n_words else np.zeros(1)
    lines = body.split(b"\n")
    distinct_lines = len(set(lines))
    w = max(n_words, 1)
    return [
        math.log1p(n), math.log1p(n_words), *share[1:8].tolist(),
        float(-(p * np.log2(p)).sum()), float(lengths.mean()), float(lengths.std()),
        len(distinct) / w, len(distinct) / math.sqrt(w), distinct_lines / len(lines), math.log1p(n / len(lines)),
        sum(map(bytes.isupper, words)) / w, float((lengths > 20).sum()) / w, float((lengths < 3).sum()) / w,
        body.count(b". ") / w,
    ]


def _measure(batches):
    for batch in batches:
        texts = batch.column(1)
        rows = np.array([statistics(t.as_buffer().to_pybytes()) for t in texts], np.float32).reshape(-1, STATISTICS)
        vec = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), STATISTICS).cast(pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays([batch.column(0), vec], ["doc_id", "stats"])


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, stats) for each row."""
    return one_row_per_doc(docs, doc_id, text).mapInArrow(_measure, "doc_id long, stats array<float>")


class Model:
    """Scaling, random cosines, ridge weights and calibration steps; a few kB of numbers."""

    def __init__(self, mean, scale, weights=None, edges=None, values=None, default=0.5):
        rng = np.random.default_rng(_SEED)
        self.mean, self.scale, self.default = np.asarray(mean), np.asarray(scale), default
        self.omega = rng.normal(size=(STATISTICS, FEATURES)) / math.sqrt(STATISTICS)
        self.phase = rng.uniform(0, 2 * math.pi, FEATURES)
        self.weights, self.edges, self.values = weights, edges, values

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        x = np.sqrt(2 / FEATURES) * np.cos(z @ self.omega + self.phase)
        return np.hstack([x, np.ones((len(x), 1))])

    def ridge(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(stats), self.default)
        return np.interp(self.ridge(stats), self.edges, self.values)


def isotonic(position: np.ndarray, ones: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators on counted bins -> (positions, non-decreasing shares)."""
    blocks: list[list[float]] = []   # mean position, ones, total
    for x, one, n in zip(position, ones, total):
        blocks.append([x, one, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            x2, one2, n2 = blocks.pop()
            b = blocks[-1]
            b[0] = (b[0] * b[2] + x2 * n2) / (b[2] + n2)
            b[1], b[2] = b[1] + one2, b[2] + n2
    at = np.array([b[0] for b in blocks])
    return at, np.array([(b[1] + 0.5) / (b[2] + 1) for b in blocks])


def _stats_matrix(column) -> np.ndarray:
    return np.asarray(column.values.to_numpy(zero_copy_only=False), np.float64).reshape(-1, STATISTICS)


def fit(stats: DataFrame, labels: DataFrame) -> Model:
    """Fit on all labelled rows of the training folds (``stats``: doc_id, stats)."""
    lab = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y")).where(
        "doc_id IS NOT NULL AND y IN (0, 1)")
    train = stats.join(lab.where(fold(F.col("doc_id"), 4) != 2), "doc_id").select("doc_id", "stats", "y")
    per = [F.col("stats")[i].cast("double") for i in range(STATISTICS)]
    row = train.agg(F.count("*").alias("n"), F.sum("y").alias("ones"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(per)],
                    *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(per)]).first()
    n, ones = row["n"], row["ones"] or 0
    if n == 0 or ones in (0, n):
        return Model(np.zeros(STATISTICS), np.ones(STATISTICS), default=ones / n if n else 0.5)
    model = Model([row[f"m{i}"] for i in range(STATISTICS)], [max(row[f"s{i}"], 1e-6) for i in range(STATISTICS)])
    # of the three training folds one is left to the calibration, by another digit of the same hash
    third = F.floor(F.crc32(F.col("doc_id").cast("string").cast("binary")) / 4) % 3

    def normal(batches):
        total = None
        for batch in batches:
            x = model.features(_stats_matrix(batch.column(0)))
            y = batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
            part = np.hstack([x.T @ x, (x.T @ y)[:, None], (x.sum(0))[:, None]])
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)),
                                              pa.array(list(total), pa.list_(pa.float64()))], ["i", "v"])

    sums = sum_rows(train.where(third != 0).select("stats", "y").mapInArrow(normal, "i int, v array<double>"))
    rows = {r["i"]: r["v"] for r in sums.collect()}      # FEATURES + 1 rows
    if not rows:
        return Model(np.zeros(STATISTICS), np.ones(STATISTICS), default=ones / n)
    a = np.array([rows[i] for i in range(FEATURES + 1)])
    gram, xy, m = a[:, :FEATURES + 1], a[:, FEATURES + 1], a[FEATURES, FEATURES]
    penalty = RIDGE * m * np.eye(FEATURES + 1)
    penalty[-1, -1] = 1e-9 * m
    model.weights = np.linalg.solve(gram + penalty, xy)

    def ridge(batches):
        for batch in batches:
            s = model.ridge(_stats_matrix(batch.column(0)))
            bin_ = np.clip(np.floor((s + 0.5) / 2 * BINS), 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bin_), pa.array(s), batch.column(1)], ["bin", "s", "y"])

    counted = train.where(third == 0).select("stats", "y").mapInArrow(ridge, "bin int, s double, y int").groupBy("bin").agg(
        F.avg("s").alias("s"), F.sum("y").alias("ones"), F.count("*").alias("n")).orderBy("bin").collect()   # <= BINS rows
    if counted:
        model.edges, model.values = isotonic(np.array([r["s"] for r in counted]), np.array([float(r["ones"]) for r in counted]),
                                             np.array([float(r["n"]) for r in counted]))
    else:
        model.edges, model.values = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted."""
    stats = materialize(measure(docs, doc_id, text), "quality-stats")
    model = fit(stats, labels)

    def score(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.score(_stats_matrix(batch.column(1))))], ["doc_id", "score"])

    scored = stats.mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                         F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
