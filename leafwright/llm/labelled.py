"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Documents of more characters are not taken into samples, which so have a bounded size.
SAMPLE_CHARS = 60_000


def remainder(divisor: int, key: str = "doc_id") -> Column:
    """crc32 of the key's text modulo ``divisor``; null keys count as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % divisor


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: dict[int, int], divisor: int, held_out: int) -> DataFrame:
    """One row of docs with its label for each of at most ``rows[y]`` documents of each label y outside the held-out part.

    Documents are taken in the order of a hash of their id. The ids are at most ``sum(rows)``, so they are
    broadcast, and only the rows of those are shuffled. Of rows that share an id the least counts; those of
    more than ``SAMPLE_CHARS`` characters don't, so a sample has ``sum(rows) * SAMPLE_CHARS`` characters at most. ``docs``
    has doc_id and text among its columns.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where(F.col("doc_id").isNotNull() & (remainder(divisor) != held_out))
    parts = [usable.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for y, n in rows.items()]
    chosen = parts[0]
    for part in parts[1:]:
        chosen = chosen.unionByName(part)
    chosen = chosen.groupBy("doc_id").agg(F.min("label").alias("label"))
    short = docs.drop("label").where(F.coalesce(F.char_length("text"), F.lit(0)) <= SAMPLE_CHARS)
    one = short.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min(F.struct(*[c for c in short.columns if c != "doc_id"])).alias("row"))
    return one.select("doc_id", "label", "row.*")


def platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a logistic curve through scores with labels, by Newton steps on smoothed targets."""
    n1, n0 = y.sum(), (1 - y).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -60, 60)))
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - target) * z).sum(), (p - target).sum()])
        h = np.array([[(w * z * z).sum() + 1e-6, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        step *= min(1, 2 / max(1e-9, abs(step).max()))
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-9:
            break
    return float(a), float(b)
