"""Embedding near-dedup by Euclidean p-stable hashing with exact cosine checks.

Vectors are scaled to unit length and rounded to integers, and so are the Gaussian
directions of the projections. All sums stay under 2**53, so a projection is the same
number on every machine and in every batch. Each table names the cells of some projections,
shifted and cut at ``WIDTH``, and so buckets the vectors of each label.

Unit vectors of cosine c are d = sqrt(2 - 2 c) apart, and a projection keeps them in one
cell with probability p(d) = 1 - 2 N(-WIDTH/d) - 2 d / (sqrt(2 pi) WIDTH) (1 - exp(-WIDTH^2 / 2 d^2)):
0.90 at the threshold of 0.93, 0.63 at right angles. The number of projections in a table follows the
number of vectors in the largest label, so that a bucket gets ``CROWD`` vectors at right angles or fewer, and is ``HASHES``
at least, with which a table keeps 1 pair in 10,000 of those; the number of tables is then such that a pair at the threshold
shares some bucket but for ``MISS``. Tables hold ids; only vectors of buckets with two or more are looked at.

Equal vectors of a label are one class first, so copies are never compared. Buckets are
cut into blocks, whose pairs are compared by matrix products in double precision; a pair
that meets in several tables counts in the first one only. What leaves a block is a row
for each vector with links, not its pairs.

Vectors that are null, empty, zero or hold null or non-finite components, and rows without
a label or a vec_id, link with nothing; vectors of different length don't link. Rows that share a
vec_id are one vector if they are equal, and are not linked with each other otherwise.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.llm.common import checkpointed, groups, least_labels, mapped, mix, read_table
from leafwright.llm.components import components

THRESHOLD = 0.93
WIDTH, HASHES = 3.0, 20
#: Vectors at right angles that a bucket may gather, and odds of missing a pair at the threshold.
CROWD, MISS = 64, 3e-5
#: Vectors in a block; a bucket of more is compared block by block.
BLOCK = 1024
_SCALE = 1 << 14


def same_cell(cosine: float) -> float:
    """Odds that a projection keeps two unit vectors of a cosine in one cell."""
    d = math.sqrt(max(0.0, 2 - 2 * cosine))
    if not d:
        return 1.0
    return math.erf(WIDTH / d / math.sqrt(2)) - 2 * d / (math.sqrt(2 * math.pi) * WIDTH) * (1 - math.exp(-(WIDTH**2) / (2 * d * d)))


@dataclass(frozen=True)
class Tables:
    """Number of tables and of projections in each."""

    hashes: int
    tables: int

    @classmethod
    def for_size(cls, n: int, threshold: float) -> Tables:
        """For n vectors in the largest label."""
        hashes = max(HASHES, math.ceil(math.log(max(1, n) / CROWD) / -math.log(same_cell(0.0))))
        return cls(hashes, max(1, math.ceil(math.log(MISS) / math.log1p(-(min(1 - 1e-9, same_cell(threshold)) ** hashes)))))


@lru_cache(maxsize=4)
def _projections(dimensions: int, size: Tables) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng([17, dimensions])
    directions = np.rint(r.normal(size=(size.tables * size.hashes, dimensions)).T * _SCALE)
    return np.ascontiguousarray(directions), np.floor(r.random(size.tables * size.hashes) * WIDTH * _SCALE * _SCALE)


def buckets(unit: np.ndarray, size: Tables, tables: int | None = None) -> np.ndarray:
    """The bucket of each unit vector in each table, or the first ones, as a 64-bit name."""
    directions, shift = _projections(unit.shape[1], size)
    n = size.tables if tables is None else tables
    k = n * size.hashes
    cell = np.floor((np.rint(unit * _SCALE) @ directions[:, :k] + shift[:k]) / (WIDTH * _SCALE * _SCALE)).astype(np.int64).view(np.uint64).reshape(len(unit), n, size.hashes)
    name = np.broadcast_to(np.arange(1, n + 1, dtype=np.uint64), (len(unit), n))
    for h in range(size.hashes):
        name = mix(name * np.uint64(0x9E3779B97F4A7C15) + cell[:, :, h])
    return name


def _unit(column: pa.Array) -> np.ndarray:
    raw = np.asarray(column.flatten(), np.float64).reshape(len(column), -1)
    return raw / np.sqrt((raw * raw).sum(1))[:, None]


def classes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (vec_id, class_id), and classes (class_id, label, embedding, copies) of the usable ones."""
    value = "array<double>" if dict(vectors.dtypes)["embedding"] == "array<double>" else "array<float>"
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast(value).alias("embedding"))
    sound = "label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL AND size(embedding) > 0 AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists(embedding, x -> x <> 0)"
    usable = given.where(sound).select("*", *(F.xxhash64(F.lit(k), "label", "embedding").alias(k) for k in ("print", "print2")))
    found = usable.groupBy("print", "print2", "label", "embedding").agg(F.min("vec_id").alias("class_id"), F.count_distinct("vec_id").alias("copies"))
    classes = checkpointed(found)
    members = usable.select("vec_id", "print", "print2").join(classes.select("print", "print2", "class_id"), ["print", "print2"]).select("vec_id", "class_id").distinct()
    return members, classes.select("class_id", "label", "embedding", "copies", F.size("embedding").alias("dimensions"))


def _hashed(classes: DataFrame, size: Tables) -> DataFrame:
    """(t, bucket, class_id): the bucket of each class in each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length in np.unique(np.asarray(batch.column(3))).tolist():
                part = batch.filter(pa.array(np.asarray(batch.column(3)) == length))
                for lo in range(0, part.num_rows, 1024):
                    cut = part.slice(lo, 1024)
                    label = np.array([hash_text(x) for x in cut.column(1).to_pylist()], np.uint64)
                    names = mix(buckets(_unit(cut.column(2)), size) + (label + np.uint64(length))[:, None])
                    n = size.tables
                    yield pa.record_batch([pa.array(np.tile(np.arange(n, dtype=np.int32), cut.num_rows)), pa.array(names.ravel().view(np.int64)), pa.array(np.repeat(np.asarray(cut.column(0)), n))], names=["t", "bucket", "class_id"])

    return mapped(classes.select("class_id", "label", "embedding", "dimensions"), run, "t int, bucket long, class_id long")


def hash_text(x: str) -> int:
    import hashlib

    return int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little")


def _blocks(hashed: DataFrame, classes: DataFrame) -> DataFrame:
    """Vectors of buckets with two or more, dealt to pairs of blocks: (t, bucket, i, j, side, ...)."""
    counts = checkpointed(hashed.groupBy("t", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    shared = checkpointed(hashed.join(counts, ["t", "bucket"]))
    rows = shared.join(classes.select("class_id", "embedding", "copies"), "class_id").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    own = rows.withColumn("block", F.pmod(F.xxhash64("class_id"), "blocks").cast("int"))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select("t", "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).cast("int").alias("side"), "class_id", "embedding", "copies")


def linked(classes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(class_id, n, root): for each block that links a class, the copies linked there and the least class joined."""
    largest = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    size = Tables.for_size(largest, threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, 4):
            if rows.num_rows < 2:
                continue
            t, within = rows["t"][0].as_py(), rows["i"][0].as_py() == rows["j"][0].as_py()
            order = np.argsort(np.asarray(rows["class_id"]), kind="stable")
            rows = rows.take(pa.array(order)).combine_chunks()
            ids, side, copies = (np.asarray(rows[c]) for c in ("class_id", "side", "copies"))
            unit = _unit(rows["embedding"].combine_chunks() if isinstance(rows["embedding"], pa.ChunkedArray) else rows["embedding"])
            a, b = np.nonzero(np.triu(unit @ unit.T >= threshold, 1))
            keep = ids[a] != ids[b]
            if not within:
                keep &= side[a] != side[b]
            a, b = a[keep], b[keep]
            if not len(a):
                continue
            met = np.zeros(len(a), bool)
            if t:
                held, at = np.unique(np.concatenate([a, b]), return_inverse=True)
                names = buckets(unit[held], size, t)
                for lo in range(0, len(a), 4096):
                    x, y = at[lo : min(len(a), lo + 4096)], at[len(a) + lo : len(a) + lo + 4096]
                    met[lo : lo + 4096] = (names[x] == names[y]).any(1)
            root = least_labels(len(ids), a, b)
            a, b = a[~met], b[~met]
            n = np.bincount(a, copies[b], len(ids)) + np.bincount(b, copies[a], len(ids))
            some = np.flatnonzero((n > 0) | (root != np.arange(len(ids))))
            yield pa.record_batch([pa.array(ids[some]), pa.array(n[some].astype(np.int64)), pa.array(ids[root[some]])], names=["class_id", "n", "root"])

    dealt = _blocks(checkpointed(_hashed(classes, size)), classes)
    dealt = dealt.repartition("t", "bucket", "i", "j").sortWithinPartitions("t", "bucket", "i", "j")
    return mapped(dealt, run, "class_id long, n long, root long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: vec_id, n_links, component_id and whether it stays."""
    members, classes = classes_of(vectors)
    found = checkpointed(linked(classes, threshold))
    counts = found.groupBy("class_id").agg(F.sum("n").alias("n"))
    groups_of = components(found.select("class_id", "root")).withColumnRenamed("id", "class_id")
    of_class = checkpointed(classes.select("class_id", "copies").join(counts, "class_id", "left").join(groups_of, "class_id", "left").select("class_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "class_id").alias("component_id")))
    of_vector = members.join(of_class, "class_id").groupBy("vec_id").agg(F.sum("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).join(of_vector, "vec_id", "left")
    return rows.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))


def brute_force(rows: list[tuple]) -> dict[int, tuple[int, int]]:
    """vec_id -> (n_links, component_id) by the rule as it is written, for tests; rows are (vec_id, vector, label)."""
    good = [(k, np.asarray(x, float), y) for k, x, y in rows if y is not None and x is not None and len(x) and all(v is not None for v in x) and np.isfinite(np.asarray(x, float)).all() and np.any(np.asarray(x, float) != 0)]
    links: dict[int, set] = {k: set() for k, _, _ in rows}
    for i, (k, x, y) in enumerate(good):
        for m, z, w in good[:i]:
            if y == w and len(x) == len(z) and k != m and x @ z / np.sqrt(x @ x) / np.sqrt(z @ z) >= THRESHOLD:
                links[k].add(m)
                links[m].add(k)
    out = {}
    for k in links:
        seen, todo = {k}, [k]
        while todo:
            for m in links[todo.pop()] - seen:
                seen.add(m)
                todo.append(m)
        out[k] = (len(links[k]), min(seen))
    return out


QUERIES = {"op3_embedding_dedup": query}
ORACLE_SQL = {
    "op3_embedding_dedup": r"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e, sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS size FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
good AS (SELECT * FROM v WHERE size > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_inner_product(a.e, b.e) / a.size / b.size >= 0.93),
reach(vec_id, root) USING KEY (vec_id) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT l.b, min(r.root) FROM reach r JOIN links l ON l.a = r.vec_id JOIN recurring.reach o ON o.vec_id = l.b WHERE r.root < o.root GROUP BY l.b)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, r.root AS component_id, r.root = e.vec_id AS kept
FROM embeddings e JOIN reach r ON r.vec_id = e.vec_id LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = e.vec_id
""",
}
