"""Bounded labelled samples and a small logistic calibrator."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, per_class: int, max_chars: int) -> tuple[list[tuple[bytes, int]], dict[int, int]]:
    """At most ``per_class`` labelled texts of each class, in the order of a hash of their id.

    The ids are drawn before the texts are touched, so the table that is broadcast to the text scan
    has at most ``2 * per_class`` rows whatever the size of the corpus. Repeated labels of an id are
    averaged and a tie counts as 1; repeated documents of an id count once (the least text by hash).
    Texts of more than ``max_chars`` characters are scored like all others but not learned from.
    Returns the texts, and how many labelled ids each class has in all.
    """
    ids = labels.filter(usable & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    ids = ids.groupBy("doc_id").agg(F.when(F.avg(label) >= 0.5, 1).otherwise(0).alias("y"))
    totals = {int(r["y"]): int(r["n"]) for r in ids.groupBy("y").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64("doc_id")
    drawn = [ids.filter(F.col("y") == y).orderBy(order, "doc_id").limit(per_class).collect() for y in (0, 1)]
    rows = [(int(r["doc_id"]), int(r["y"])) for part in drawn for r in part]
    if not rows:
        return [], totals
    small = F.broadcast(docs.sparkSession.createDataFrame(rows, "doc_id long, y int"))
    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull() & (F.length("text") <= max_chars)).join(small, "doc_id")
    got = texts.groupBy("doc_id", "y").agg(F.min_by(F.col("text").cast("binary"), F.xxhash64("text")).alias("t")).collect()
    got.sort(key=lambda r: r["doc_id"])
    rng = np.random.default_rng(7)
    return [(bytes(got[i]["t"]), int(got[i]["y"])) for i in rng.permutation(len(got))], totals


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1.0, rounds: int = 60) -> dict[str, list[float]]:
    """Weighted ridge logistic regression by Newton steps on standardised columns."""
    if len(y) == 0 or y.min() == y.max():
        rate = (float((w * y).sum()) + 1) / (float(w.sum()) + 2) if len(y) else 0.5
        return {"mean": [0.0] * x.shape[1], "scale": [1.0] * x.shape[1], "beta": [float(np.log(rate / (1 - rate))), *[0.0] * x.shape[1]]}
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.hstack([np.ones((len(x), 1)), (x - mean) / scale])
    beta, pen = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
    pen[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve((z * (w * p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(pen), z.T @ (w * (y - p)) - pen * beta)
        beta = beta + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return {"mean": mean.tolist(), "scale": scale.tolist(), "beta": beta.tolist()}


def probability(model: dict[str, list[float]], x: np.ndarray) -> np.ndarray:
    beta = np.asarray(model["beta"])
    t = beta[0] + ((x - np.asarray(model["mean"])) / np.asarray(model["scale"])) @ beta[1:]
    return 1 / (1 + np.exp(-np.clip(t, -30, 30)))
