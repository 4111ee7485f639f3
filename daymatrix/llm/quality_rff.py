"""Quality classifier: random Fourier features, ridge regression, isotonic scores.

Every document is reduced to a few statistics.  Random Fourier features of the
standardised statistics approximate a Gaussian kernel.  Each partition sums its part
of the normal equations, the parts are summed by row of the matrix, and the solved
ridge scores are calibrated by an isotonic fit on labelled documents the ridge has
not seen.  What the driver receives is one matrix and one histogram, both of a fixed
size whatever the number of documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf, pandas_udf

from daymatrix.llm.text import keep_nothing
from daymatrix.session import materialize

FEATURES = 256
GAMMA = 0.05
RIDGE = 1e-3
BINS = 1024
SEED = 7


def _byte_classes() -> np.ndarray:
    """Byte -> class: 0 other letters, 1 lower, 2 upper, 3 digit, 4 space, 5 line end,
    6 full stop or comma, 7 question or exclamation mark, 8 bar, 9 other marks."""
    kind = np.zeros(256, dtype=np.int64)
    for code in range(128):
        c = chr(code)
        if c.islower():
            kind[code] = 1
        elif c.isupper():
            kind[code] = 2
        elif c.isdigit():
            kind[code] = 3
        elif c == "\n":
            kind[code] = 5
        elif c.isspace():
            kind[code] = 4
        elif c in ".,":
            kind[code] = 6
        elif c in "!?":
            kind[code] = 7
        elif c == "|":
            kind[code] = 8
        else:
            kind[code] = 9
    return kind


_KIND = _byte_classes()
N_STATS = 20


def statistics(text: str | None) -> list[float]:
    """Statistics of one text; a text without words has zeros."""
    if not text:
        return [0.0] * N_STATS
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [0.0] * N_STATS
    share = np.bincount(_KIND, weights=np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256), minlength=10) / len(raw)
    n = len(words)
    distinct = set(words)
    lines = [x for x in raw.split(b"\n") if x]
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=n)
    marked = sum(1 for w in distinct if not (w[-1:].isalnum() or w[-1] > 127 or w[-1:] in b".,"))
    same = sum(a == b for a, b in pairwise(words))
    pairs = len(set(pairwise(words)))
    return [
        *np.sqrt(share[1:]).tolist(),
        float(np.log1p(n)) / 10,
        len(distinct) / n,
        len(distinct) / n**0.8,
        same / n,
        pairs / max(1, n - 1),
        marked / len(distinct),
        len(set(lines)) / len(lines),
        float(sizes.mean()) / 10,
        float(sizes.std()) / 10,
        min(1.0, n / len(lines) / 100),
        float(share[0]),
    ]


def statistics_column(text: Column) -> Column:
    """Statistics of texts that stay in Arrow but for the one at hand."""

    @arrow_udf("array<float>")
    def of(texts: pa.Array) -> pa.Array:
        keep_nothing()
        return pa.array([np.asarray(statistics(t.as_py()), dtype=np.float32) for t in texts], pa.list_(pa.float32()))

    return of(text)


@dataclass(frozen=True)
class Model:
    """Everything that turns a text into a score; a few thousand numbers."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -8, 8)
        z = np.cos(x @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([z, np.ones((len(x), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def scores(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.knots, self.levels)

    def score_column(self, text: Column) -> Column:
        model = self

        @arrow_udf("double")
        def score(texts: pa.Array) -> pa.Array:
            keep_nothing()
            if not len(texts):
                return pa.array([], pa.float64())
            return pa.array(model.scores(np.array([statistics(t.as_py()) for t in texts])), pa.float64())

        return score(text)


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted least-squares non-decreasing fit by pooling adjacent violators."""
    blocks: list[list[float]] = []
    for v, w in zip(values, weights):
        blocks.append([v * w, w, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, w2, n = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += w2
            blocks[-1][2] += n
    return np.concatenate([np.full(int(n), s / w) for s, w, n in blocks]) if blocks else np.zeros(0)


def _normal_rows(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y summed over the partitions of (stats, label)."""
    size = len(model.phases) + 1

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            if len(batch):
                z = model.features(np.stack(batch["stats"].to_numpy()).astype(float))
                total += z.T @ np.hstack([z, batch[["label"]].to_numpy(dtype=float)])
        yield pd.DataFrame({"i": np.arange(size), "row": list(total)})

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": rows["i"][:1], "row": [np.sum(np.stack(rows["row"].to_numpy()), axis=0)]})

    schema = "i int, row array<double>"
    summed = rows.mapInPandas(part, schema).groupBy("i").applyInPandas(add, schema).collect()
    total = np.zeros((size, size + 1))
    for i, row in summed:
        total[i] = row
    return total[:, :-1], total[:, -1]


def constant(value: float) -> Model:
    """Scores every text alike; used where there is nothing to learn from."""
    zero = np.zeros(1)
    return Model(
        np.zeros(N_STATS), np.ones(N_STATS), np.zeros((N_STATS, 1)), zero, np.zeros(2), zero, np.array([value])
    )


def fit(
    docs: DataFrame, labels: DataFrame, label: str, fold: Column, calibration: Column,
    features: int = FEATURES, gamma: float = GAMMA, ridge: float = RIDGE, seed: int = SEED,
) -> Model:
    """Model of ``label`` (0/1) learnt from the labelled rows in ``fold``.

    ``calibration`` (a part of the fold) marks the rows the isotonic fit uses and the
    ridge does not.  Both are conditions on doc_id.  Null or other labels are ignored,
    as are ids labelled differently; without rows of both labels all scores are the
    share of ones, 0.5 without any.
    """
    marks = (
        labels.where(fold & F.col(label).isin(0, 1))
        .groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("__other"))
        .where(F.col("label") == F.col("__other")).select("doc_id", "label")
    )
    stats = docs.where(fold).select("doc_id", statistics_column(F.col("text")).alias("stats"))
    rows = materialize(stats.join(marks, "doc_id").withColumn("later", calibration), "stats")
    seen = rows.groupBy("label").count().collect()
    total = sum(r["count"] for r in seen)
    if len(seen) < 2:
        return constant(seen[0]["label"] * 1.0 if seen else 0.5)
    moments = rows.select(
        *[F.avg(F.get("stats", F.lit(i))).alias(f"m{i}") for i in range(N_STATS)],
        *[F.stddev_pop(F.get("stats", F.lit(i))).alias(f"s{i}") for i in range(N_STATS)],
    ).first()
    spread = np.array([moments[f"s{i}"] for i in range(N_STATS)])
    random = np.random.default_rng(seed)
    model = Model(
        np.array([moments[f"m{i}"] for i in range(N_STATS)]),
        np.where(spread > 1e-6, spread, 1.0),
        random.normal(size=(N_STATS, features)) * np.sqrt(2 * gamma),
        random.uniform(0, 2 * np.pi, size=features),
        np.zeros(features + 1),
        np.zeros(1),
        np.zeros(1),
    )
    early, later = rows.where(~F.col("later")), rows.where("later")
    if early.select("label").distinct().count() < 2 or later.select("label").distinct().count() < 2:
        early = later = rows  # too few labels to spare some for the calibration
    matrix, right = _normal_rows(early, model)
    weights = np.linalg.solve(matrix + ridge * np.trace(matrix) / len(matrix) * np.eye(len(matrix)), right)
    model = Model(**(model.__dict__ | {"weights": weights}))
    return _calibrated(model, later)


def _calibrated(model: Model, rows: DataFrame) -> Model:
    """The model with an isotonic fit of labels over ``BINS`` bins of raw scores,
    joined by straight lines so that the order of raw scores is kept."""

    @pandas_udf("double")
    def raw(stats: pd.Series) -> pd.Series:
        return pd.Series(model.raw(np.stack(stats.to_numpy()).astype(float)) if len(stats) else [], dtype=float)

    edges = F.least(F.greatest(F.floor((F.col("raw") + 0.5) * (BINS / 2)), F.lit(0)), F.lit(BINS - 1))
    bins = (
        rows.select(raw("stats").alias("raw"), "label").groupBy(edges.alias("bin"))
        .agg(F.avg("raw").alias("x"), F.sum("label").alias("ones"), F.count("*").alias("n")).collect()
    )
    bins.sort(key=lambda r: r.x)
    n = np.array([r.n for r in bins], dtype=float)
    levels = isotonic(np.array([r.ones for r in bins]) / n, n)
    x = np.array([r.x for r in bins])
    # One knot per level, at its weighted centre; ends lie outside for a strict order.
    knots, heights = [], []
    for level in np.unique(levels):
        some = levels == level
        knots.append(float(np.average(x[some], weights=n[some])))
        heights.append(float(level))
    low, high = min(knots[0], -2.0) - 1, max(knots[-1], 3.0) + 1
    tiny = 1e-3
    inner = [tiny + h * (1 - 2 * tiny) for h in heights]
    return Model(**(model.__dict__ | {"knots": np.array([low, *knots, high]), "levels": np.array([0.0, *inner, 1.0])}))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every document, whole texts of any length.

    Null texts count as empty ones, whose statistics are all zero.  Repeated rows are
    reported each, equal texts with equal scores; an empty table gives no rows.  Other
    columns are ignored.
    """
    return docs.select("doc_id", model.score_column(F.col("text")).alias("score"))
