"""Quality of texts: random Fourier features, ridge regression, isotonic calibration.

A text becomes a short vector of document statistics. ``COMPONENTS`` random cosines of it
approximate a Gaussian kernel (Rahimi and Recht); their draw is fixed by ``SEED``, and the
statistics are standardised by means and deviations summed over the labelled rows. Each partition
adds up its part of the normal equations, whose size does not depend on the rows; the parts are
summed block by block over the cluster and one ridge system is solved. Raw scores are calibrated
by isotonic regression (pool adjacent violators) on a fixed grid of raw scores, whose counts are
grouped by Spark, on a fold of the labelled rows that the ridge fit has not seen.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from stallkeeper.llm.common import map_batches, new_stage, values

COMPONENTS = 256
SEED = 20240229
WIDTH = 4.0  # of the kernel, in standard deviations of the statistics
RIDGE = 1e-3  # per labelled row
# Raw scores are calibrated in so many steps between -0.5 and 1.5.
STEPS = 1000
# Labelled rows whose remainder here is 0 calibrate, the others fit.
CALIBRATION_PARTS = 4
# Partial sums of the partitions are added up in so many groups first.
SALTS = 32

_MARKS = re.compile(r"[^\w\s]")
_REPEATED_MARKS = re.compile(r"([^\w\s])\1")
_NUMBERS = re.compile(r"\d")
_CAPITALS = re.compile(r"[^\W\d_a-zß-öø-ÿ]")
STATISTICS = 16


def statistics_of(text: str | None) -> list[float]:
    """What is known of a whole text: shares and logarithms, all zero for an empty one."""
    if not text or not text.strip():
        return [0.0] * STATISTICS
    n = len(text)
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    counts = Counter(words)
    marks = _MARKS.findall(text)
    kinds = Counter(marks)
    w = len(words)
    stops = kinds["."] + kinds["?"] + kinds["!"]
    same = sum(a == b for a, b in zip(words, words[1:]))
    return [
        np.log1p(w),
        float(lengths.mean()),
        float(lengths.std()),
        len(_CAPITALS.findall(text)) / n,
        len(_NUMBERS.findall(text)) / n,
        len(marks) / n,
        len(_REPEATED_MARKS.findall(text)) / w,
        kinds["!"] / w,
        kinds["|"] / w,
        stops / w,
        sum(kinds[c] for c in "#$%&*@^~<>{}[]=+\\/") / w,
        len(counts) / w**0.8,
        max(counts.values()) / w,
        same / w,
        len(set(lines)) / len(lines),
        np.log1p(n / len(lines)),
    ]


@dataclass(frozen=True)
class QualityModel:
    """Everything a score needs; its size does not depend on the rows it was fitted on."""

    mean: np.ndarray
    deviation: np.ndarray
    weights: np.ndarray
    steps: np.ndarray  # calibrated score of each step of raw scores

    def raw(self, statistics: np.ndarray) -> np.ndarray:
        return features((statistics - self.mean) / self.deviation) @ self.weights

    def score(self, statistics: np.ndarray) -> np.ndarray:
        return self.steps[step_of(self.raw(statistics))]


def features(x: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised statistics, and a constant."""
    draw = np.random.default_rng(SEED)
    directions = draw.normal(size=(STATISTICS, COMPONENTS - 1)) / WIDTH
    phases = draw.uniform(0, 2 * np.pi, COMPONENTS - 1)
    waves = np.cos(np.clip(x, -8, 8) @ directions + phases) * np.sqrt(2 / (COMPONENTS - 1))
    return np.concatenate((waves, np.ones((len(x), 1))), axis=1)


def step_of(raw: np.ndarray) -> np.ndarray:
    return np.clip((np.asarray(raw) + 0.5) / 2 * STEPS, 0, STEPS - 1).astype(np.int64)


def isotonic(weight: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Rising shares of positives by step, by pooling adjacent violators; one prior row of each
    kind is spread over the steps, so no score is certain and an empty fit gives one half."""
    weight = weight + 2 / len(weight)
    positive = positive + 1 / len(positive)
    blocks: list[list[float]] = []  # weight, positives, steps
    for w, p in zip(weight.tolist(), positive.tolist()):
        blocks.append([w, p, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.concatenate([np.full(int(n), p / w) for w, p, n in blocks])


def _summed(parts: DataFrame, names: list[str]) -> dict[tuple, np.ndarray]:
    """Vectors (bytes of doubles) added up by name: first within salts, then the salts."""

    def add(keys: list[str]):
        def run(group):
            total = sum(np.frombuffer(v, "<f8") for v in group["vector"])
            return group[keys].head(1).assign(vector=total.tobytes())

        return run, ", ".join(f"{k} int" for k in keys) + ", vector binary"

    for keys in ([*names, "salt"], names):
        run, schema = add(keys)
        parts = parts.groupBy(*keys).applyInPandas(run, schema)
    return {tuple(r[n] for n in names): np.frombuffer(r["vector"]) for r in parts.collect()}


def fit_quality(labelled: DataFrame) -> QualityModel:
    """Fit on ``id, text, label`` rows (label 0 or 1); rows with a null label do not count.

    Texts may be null or empty, rows may repeat. Without any row, every score is one half. Only
    statistics are written, so a caller may bound the labelled rows or not.
    """
    stage = new_stage(labelled.sparkSession)
    narrow = labelled.where("label is not null").select(
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"),
        "text",
        F.col("label").cast("double").alias("label"),
    )

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            keys = values(batch, "id")
            yield {
                "calibrates": [
                    zlib.crc32(b"calibration " + k.encode()) % CALIBRATION_PARTS == 0 for k in keys
                ],
                "label": batch.column(2),
                "x": [statistics_of(t) for t in values(batch, "text")],
            }

    measured = stage(
        map_batches(narrow, measure, "calibrates boolean, label double, x array<double>"), "x"
    )
    fitting = measured.where("not calibrates")

    def matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        x = np.array(values(batch, "x"), float).reshape(-1, STATISTICS)
        return x, np.array(values(batch, "label"), float)

    def moments(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        total = np.zeros(1 + 2 * STATISTICS)
        for batch in batches:
            x, _ = matrix(batch)
            total += np.concatenate(([len(x)], x.sum(0), (x * x).sum(0)))
        salt = TaskContext.get().partitionId() % SALTS
        yield {"i": [0], "salt": [salt], "vector": [total.tobytes()]}

    parts = "i int, salt int, vector binary"
    found = _summed(map_batches(fitting, moments, parts), ["i"])
    total = found.get((0,), np.zeros(1 + 2 * STATISTICS))
    rows = max(total[0], 1)
    mean = total[1 : 1 + STATISTICS] / rows
    deviation = np.sqrt(np.maximum(total[1 + STATISTICS :] / rows - mean * mean, 0))
    deviation[deviation < 1e-9] = 1.0

    def equations(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        """A row of the normal equations and its right side per vector."""
        total = np.zeros((COMPONENTS, COMPONENTS + 1))
        for batch in batches:
            x, y = matrix(batch)
            z = features((x - mean) / deviation)
            total[:, :-1] += z.T @ z
            total[:, -1] += z.T @ y
        salt = TaskContext.get().partitionId() % SALTS
        yield {
            "i": list(range(COMPONENTS)),
            "salt": [salt] * COMPONENTS,
            "vector": [row.tobytes() for row in total],
        }

    found = _summed(map_batches(fitting, equations, parts), ["i"])
    sums = np.stack([found.get((i,), np.zeros(COMPONENTS + 1)) for i in range(COMPONENTS)])
    penalty = np.full(COMPONENTS, RIDGE * rows)
    penalty[-1] = 1e-9 * rows
    weights = np.linalg.solve(sums[:, :-1] + np.diag(penalty), sums[:, -1])

    uncalibrated = QualityModel(mean, deviation, weights, np.zeros(STEPS))

    def steps(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        count = np.zeros((2, STEPS))
        for batch in batches:
            x, y = matrix(batch)
            at = step_of(uncalibrated.raw(x))
            np.add.at(count, (0, at), 1)
            np.add.at(count, (1, at), y)
        used = np.flatnonzero(count[0])
        yield {"step": used, "n": count[0, used], "positive": count[1, used]}

    counted = map_batches(measured.where("calibrates"), steps, "step long, n double, positive double")
    count = np.zeros((2, STEPS))
    for r in counted.groupBy("step").agg(F.sum("n").alias("n"), F.sum("positive").alias("p")).collect():
        count[:, r["step"]] = r["n"], r["p"]
    return QualityModel(mean, deviation, weights, isotonic(count[0], count[1]))


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text", score: str = "score"):
    """All columns of ``docs`` and a ``score`` from 0 to 1; null and empty texts get one too.

    A column named like the new one is replaced.
    """
    rows = docs.drop(score)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            x = np.array([statistics_of(t) for t in values(batch, text)]).reshape(-1, STATISTICS)
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            yield columns | {score: model.score(x) if len(x) else []}

    schema = T.StructType(rows.schema.fields + T.StructType.fromDDL(f"`{score}` double").fields)
    return map_batches(rows, run, schema)
