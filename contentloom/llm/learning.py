"""What the two text classifiers share: bounded samples of labelled rows, and training helpers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, remainder

FOLDS = 5


def labelled_sample(
    docs: DataFrame, labels: DataFrame, target: str, most_rows: int, most_bytes: int, seed: int
) -> DataFrame:
    """A bounded number of rows (columns of ``docs`` and ``label`` 0 or 1) to learn from.

    Rows with a NULL id or label, or whose id has remainder 0, are left out. Each of the two labels
    gives about half of the sample, or all its rows if there are fewer, in the order of a hash of the
    id, until they have half of ``most_bytes`` of text; texts above a sixteenth of that are passed
    over. An id counts once for each of its labels, however often either table repeats it; of
    several texts one is chosen by a hash of the text, so the same tables give the same sample.
    """
    known = labels.select("doc_id", F.col(target).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & (remainder(F.col("doc_id"), FOLDS) != 0)
    )
    known = known.distinct()
    counts = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    share = F.lit(0.0)
    for label, n in counts.items():
        share = F.when(F.col("label") == label, min(1.0, most_rows / 2 / n)).otherwise(share)
    draw = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 20)) / float(1 << 20)
    names = docs.columns
    one = F.min_by(F.struct(*names), F.struct(F.xxhash64("text"), F.xxhash64(F.lit(seed), "text")))
    drawn = docs.join(F.broadcast(known.where(draw < share)), "doc_id").groupBy("doc_id", "label")
    drawn = cut_lineage(drawn.agg(one.alias("row")).select("label", "row.*"))
    # A row for each of the few drawn, without its text.
    sizes = drawn.select("doc_id", "label", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"))
    upto = F.sum("size").over(Window.partitionBy("label").orderBy(draw, "doc_id"))
    fits = sizes.where(F.col("size") <= most_bytes // 32).withColumn("upto", upto)
    kept = fits.where(F.col("upto") <= most_bytes // 2).select("doc_id", "label")
    return drawn.join(F.broadcast(kept), ["doc_id", "label"])


def gathered(features: DataFrame, *columns: str) -> list[list]:
    """Columns of a bounded table on the driver, in an order that does not depend on tasks."""
    table = features.toArrow()
    table = table.sort_by([(c, "ascending") for c in ("doc_id", "label")])
    return [table.column(c).to_pylist() for c in columns]


class Adagrad:
    """Steps that shrink where gradients have been large; rows of a table can be stepped alone."""

    def __init__(self, shape: tuple[int, ...], rate: float):
        self.rate, self.seen = rate, np.full(shape, 1e-6, np.float32)

    def step(self, values: np.ndarray, gradient: np.ndarray, rows=slice(None)) -> None:
        self.seen[rows] += gradient * gradient
        values[rows] -= self.rate * gradient / np.sqrt(self.seen[rows])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def calibrated(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through the scores, by Newton's method.

    Targets are smoothed by the class sizes, so separable scores keep a finite slope.
    """
    positive, negative = weights[labels == 1].sum(), weights[labels == 0].sum()
    goal = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    x = np.stack([scores, np.ones_like(scores)], 1)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(x @ at)
        slope = x.T @ (weights * (p - goal)) + 1e-3 * (at - [1.0, 0.0])
        bend = (x * (weights * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(bend, slope)
        at = at - np.clip(move, -1, 1)
        if abs(move).max() < 1e-6:
            break
    return (float(at[0]), float(at[1])) if at[0] > 0 else (1.0, 0.0)


def batches_of(order: np.ndarray, size: int) -> Iterator[np.ndarray]:
    for i in range(0, len(order), size):
        yield order[i : i + size]


def binary_lists(rows: list[np.ndarray]) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())
