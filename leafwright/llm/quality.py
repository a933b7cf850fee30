"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A document's features are its words, hashed to buckets and scaled to unit length, and
its structure: shares of character classes, repeated and distinct words, word and line
lengths, size, each as a value and as a bin. The metadata is the document's stated
length against the real one. Every pair of features interacts through the product of
their low-rank factors; with the identity

    sum over pairs <v_i, v_j> x_i x_j = 1/2 sum over factors ((sum v x)^2 - sum v^2 x^2)

a document is scored in time linear in its features.

Training takes at most ``TRAIN_ROWS`` labelled documents of each class, outside the held-out part.
Null and empty texts have no words and get the score of their structure. Each row is
scored alone; other columns are ignored. A table without labels gives a model that
scores everything by its prior of one half.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.llm.common import BLANK_SPLIT, mapped, pieces, read_table, scan_words
from leafwright.llm.labelled import remainder, sample

#: Labelled documents of each class that training takes at most.
TRAIN_ROWS = {0: 2500, 1: 3500}
DIVISOR, HELD_OUT = 4, 2
THRESHOLD = 0.7
WORD_BITS = 14
BINS = 12
RANK = 8

_CLASSES = ["other", "upper", "lower", "digit", "blank", "line", "stop", "shout", "pipe", "symbol", "wide"]
_CLASS = np.zeros(256, np.int64)
_CLASS[0x41:0x5B] = 1
_CLASS[0x61:0x7B] = 2
_CLASS[0x30:0x3A] = 3
_CLASS[[0x20, 0x09]] = 4
_CLASS[0x0A] = 5
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = 6
_CLASS[ord("!")] = 7
_CLASS[ord("|")] = 8
_CLASS[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{}~"]] = 9
_CLASS[0x80:] = 10
STATS = [*_CLASSES, "repeated", "distinct", "word_size", "wordy", "capital", "ended", "line_size", "stated"]
SIZE = (1 << WORD_BITS) + len(STATS) * (BINS + 1)


@dataclass
class Sparse:
    """Rows of sparse features: row r has entries start[r] to start[r + 1]."""

    start: np.ndarray
    index: np.ndarray
    value: np.ndarray

    def __len__(self) -> int:
        return len(self.start) - 1

    def take(self, rows: np.ndarray) -> Sparse:
        size = self.start[rows + 1] - self.start[rows]
        start = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.start[rows] - start[:-1], size) + np.arange(start[-1])
        return Sparse(start, self.index[at], self.value[at])

    def sums(self, x: np.ndarray) -> np.ndarray:
        """Sum of x over each row's entries; every row has some."""
        return np.add.reduceat(x, self.start[:-1], axis=0)


def features(text: pa.Array, stated: np.ndarray) -> Sparse:
    """Features of each text; ``stated`` is its stated length or NaN."""
    words = scan_words(text, BLANK_SPLIT, lower=False)
    n, doc = len(text), words.doc
    count = np.diff(words.first).astype(float)
    bucket = (words.hash & np.uint64((1 << WORD_BITS) - 1)).astype(np.int64)
    pair, times = np.unique((doc << WORD_BITS) | bucket, return_counts=True)
    owner, index = pair >> WORD_BITS, pair & ((1 << WORD_BITS) - 1)
    value = np.log1p(times)
    value /= np.sqrt(np.bincount(owner, value * value, n))[owner]
    bytes_of = np.asarray(pc.binary_length(text).fill_null(0), np.int64)
    size = bytes_of.astype(float)
    owner_of_byte = np.repeat(np.arange(n), bytes_of)
    share = np.bincount(owner_of_byte * 16 + _CLASS[words.data], minlength=16 * n).reshape(n, 16)[:, : len(_CLASSES)] / np.maximum(size, 1)[:, None]
    some = np.maximum(count, 1)
    same = np.zeros(len(doc), bool)
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (doc[1:] == doc[:-1])
    first, last = words.data[words.start], words.data[words.end - 1]
    per_word = lambda x: np.bincount(doc, x, n) / some
    chars = np.asarray(pc.utf8_length(text).fill_null(0), float)
    stats = np.column_stack([
        np.sqrt(share),
        per_word(same),
        np.bincount(owner, minlength=n) / some,
        np.minimum(per_word(words.end - words.start) / 20, 1),
        np.minimum(np.log1p(count) / 12, 1),
        per_word(_CLASS[first] == 1),
        per_word((_CLASS[last] != 2) & (_CLASS[last] != 10)),
        np.minimum(np.log1p(size / (1 + share[:, 5] * size)) / 10, 1),
        np.where(np.isnan(stated), 0, np.minimum(np.abs(np.nan_to_num(stated) - chars) / np.maximum(chars, 1), 1)),
    ])
    base = 1 << WORD_BITS
    k = np.arange(len(STATS)) * (BINS + 1)
    binned = base + k[None, :] + 1 + np.minimum((stats * BINS).astype(np.int64), BINS - 1)
    rows = np.concatenate([owner, np.repeat(np.arange(n), 2 * len(STATS))])
    index = np.concatenate([index, np.concatenate([np.broadcast_to(base + k, stats.shape), binned], axis=1).ravel()])
    value = np.concatenate([value, np.concatenate([stats, np.full(stats.shape, 0.5)], axis=1).ravel()])
    order = np.argsort(rows, kind="stable")
    return Sparse(np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]), index[order].astype(np.int32), value[order].astype(np.float32))


class FactorisationMachine:
    def __init__(self, size: int = SIZE, rank: int = RANK, seed: int = 3):
        r = np.random.default_rng(seed)
        self.bias = np.zeros(1, np.float32)
        self.w = np.zeros(size, np.float32)
        self.v = r.normal(0, 0.02, (size, rank)).astype(np.float32)
        self.fitted = False

    def logits(self, x: Sparse) -> np.ndarray:
        v = self.v[x.index] * x.value[:, None]
        s = x.sums(v)
        return self.bias[0] + x.sums(self.w[x.index] * x.value) + 0.5 * ((s * s).sum(1) - x.sums((v * v).sum(1)))

    def score(self, x: Sparse) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -60, 60).astype(float)))

    def fit(self, x: Sparse, y: np.ndarray, rounds: int = 8, batch: int = 128, rate: float = 0.06, decay: float = 1e-5, seed: int = 4) -> None:
        """Adagrad on the logistic loss, touching only the features of each batch."""
        r = np.random.default_rng(seed)
        self.fitted = True
        seen = [np.full_like(p, 1e-3) for p in (self.bias, self.w, self.v)]
        for _ in range(rounds):
            order = r.permutation(len(x))
            for lo in range(0, len(order), batch):
                rows = order[lo : lo + batch]
                part = x.take(rows)
                v = self.v[part.index]
                s = part.sums(v * part.value[:, None])
                d = ((self.score(part) - y[rows]) / len(rows)).astype(np.float32)
                size = np.diff(part.start)
                each = np.repeat(d, size) * part.value
                touched, at = np.unique(part.index, return_inverse=True)
                gv = np.zeros((len(touched), self.v.shape[1]), np.float32)
                whole = each[:, None] * (np.repeat(s, size, axis=0) - v * part.value[:, None])
                for f in range(gv.shape[1]):
                    gv[:, f] = np.bincount(at, whole[:, f], len(touched))
                gw = np.bincount(at, each, len(touched)).astype(np.float32)
                for p, g, acc, index in ((self.bias, np.array([d.sum()]), seen[0], slice(None)), (self.w, gw, seen[1], touched), (self.v, gv, seen[2], touched)):
                    g = g + decay * p[index]
                    acc[index] += g * g
                    p[index] -= rate * g / np.sqrt(acc[index])


def _given(docs: DataFrame) -> DataFrame:
    stated = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), stated.alias("n_chars"))


def _stated(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column(2).fill_null(np.nan), float)


def train(docs: DataFrame, labels: DataFrame, rows: dict[int, int] = TRAIN_ROWS) -> FactorisationMachine:
    """Fits a machine; executors make the features of the sampled documents, the driver receives those only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                x = features(part.column(1), _stated(part))
                cut = lambda a: [a[lo:hi].tobytes() for lo, hi in zip(x.start[:-1], x.start[1:], strict=True)]
                yield pa.record_batch([part.column(0), part.column(3), pa.array(cut(x.index), pa.binary()), pa.array(cut(x.value.astype(np.float16)), pa.binary())], names=["doc_id", "label", "index", "value"])

    given = sample(_given(docs), labels, "quality", rows, DIVISOR, HELD_OUT).select("doc_id", "text", "n_chars", "label")
    found = sorted(mapped(given, run, "doc_id long, label int, index binary, value binary").collect())
    machine = FactorisationMachine()
    if found:
        index = [np.frombuffer(x["index"], np.int32) for x in found]
        start = np.concatenate([[0], np.cumsum([len(x) for x in index])])
        value = np.concatenate([np.frombuffer(x["value"], np.float16) for x in found]).astype(np.float32)
        machine.fit(Sparse(start, np.concatenate(index), value), np.array([x["label"] for x in found], float))
    return machine


def score(docs: DataFrame, machine: FactorisationMachine) -> DataFrame:
    """(doc_id, score): the probability that each whole text is of good quality."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                found = sent.value.score(features(part.column(1), _stated(part)))
                yield pa.record_batch([part.column(0), pa.array(found)], names=["doc_id", "score"])

    return mapped(_given(docs), run, "doc_id long, score double")


def accepted(docs: DataFrame, machine: FactorisationMachine, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of documents, as they are, that score the threshold or more."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)
    stated = docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                said = np.asarray(part.column(stated).cast(pa.float64()).fill_null(np.nan), float) if stated is not None else np.full(part.num_rows, np.nan)
                yield part.filter(pa.array(sent.value.score(features(part.column(text), said)) >= threshold))

    return mapped(docs, run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = score(docs, train(docs, read_table(spark, sf_dir, "labels")))
    return found.select("doc_id", (remainder(DIVISOR) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op6_quality": query}
