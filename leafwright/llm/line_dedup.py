"""Line dedup that can be undone: exact reference counts, with sharded cuckoo filters in front.

State (all tables hold 128-bit line-key hashes, dealt to shards by the hash):

* postings (h1, h2, doc_id): each key of each document, once;
* references (h1, h2, n_docs, last_doc): exact count of documents and the largest doc_id;
* filters (shard, filter): cuckoo filters of the keys that are held by enough documents to be
  dropped. A key enters its shard's filter when its count reaches the minimum and
  leaves it when deletions take the count below.

The distinct keys are first asked of their shards' filters, each shard in a task of its own, which rules
out most keys; whatever passes is looked up in the exact table, so false positives of the
filters never decide. The number of shards follows the number of distinct keys, of which a shard
gets about ``SHARD_KEYS``; as a key is asked once, however many documents hold it, no shard is hot.

Null and empty texts are one empty line. Keys shorter than ``min_chars`` never count.
Rows that share a doc_id are one document; those whose doc_id is null are one too, smaller than
any other, which delete() can't name. Columns other than doc_id and text are ignored by decide().
"""

from __future__ import annotations

import math
import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.llm.common import checkpointed, mix, read_table

MIN_CHARS = 20
MIN_DOCS = 3
#: Shards at least, and distinct keys in one from which there are more.
SHARDS, SHARD_KEYS = 64, 1 << 18

_KEYS = f"""
transform(split(coalesce(text, ''), '\\n', -1), x -> translate(trim(BOTH ' \\t\\n\\u000b\\u000c\\r' FROM x),
 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))""".strip()
_HASHED = "named_struct('h1', xxhash64(k), 'h2', xxhash64('line', k))"


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; each key has two buckets, either computable from the other.

    A full filter gets a successor of twice its size, so shards grow without limit.
    Every copy of a key that was inserted can be deleted again.
    """

    SLOTS = 4
    KICKS = 500

    def __init__(self, capacity: int = 256, tables: list[np.ndarray] | None = None):
        self.tables = tables or [self._table(capacity)]
        self._random = np.random.default_rng(7)

    @classmethod
    def _table(cls, capacity: int) -> np.ndarray:
        buckets = 1 << max(4, int(np.ceil(np.log2(max(1, capacity) / cls.SLOTS / 0.9))))
        return np.zeros((buckets, cls.SLOTS), np.uint16)

    @staticmethod
    def _prints(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        spread = mix(keys.view(np.uint64))
        prints = (spread >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        return prints, spread, mix(prints.astype(np.uint64))

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, first, other = self._prints(np.ascontiguousarray(keys))
        found = np.zeros(len(prints), bool)
        for table in self.tables:
            mask = np.uint64(len(table) - 1)
            a = first & mask
            b = a ^ (other & mask)
            found |= (table[a] == prints[:, None]).any(1) | (table[b] == prints[:, None]).any(1)
        return found

    def insert(self, keys: np.ndarray) -> None:
        if len(keys) and not self._put(self.tables[-1], keys):
            size = 2 * self.tables[-1].size
            while True:
                self.tables.append(self._table(max(size, len(keys))))
                if self._put(self.tables[-1], keys):
                    return
                del self.tables[-1]
                size *= 2

    def _put(self, table: np.ndarray, keys: np.ndarray) -> bool:
        """Puts all keys into a table; False, and the table as it was, if they find no room."""
        before = table.copy()
        prints, first, other = self._prints(np.ascontiguousarray(keys))
        mask = np.uint64(len(table) - 1)
        at = (first & mask).astype(np.int64)
        prints, at = self._settled(table, prints, at)
        if len(prints):
            at ^= (mix(prints.astype(np.uint64)) & mask).astype(np.int64)
            prints, at = self._settled(table, prints, at)
        for _ in range(self.KICKS):
            if not len(prints):
                return True
            # One print of each full bucket takes the place of another, which goes to its other bucket.
            _, turn = np.unique(at, return_index=True)
            bucket, slot = at[turn], self._random.integers(self.SLOTS, size=len(turn))
            prints[turn], table[bucket, slot] = table[bucket, slot], prints[turn]
            at[turn] ^= (mix(prints[turn].astype(np.uint64)) & mask).astype(np.int64)
            prints, at = self._settled(table, prints, at)
        if len(prints):
            table[:] = before
        return not len(prints)

    @staticmethod
    def _settled(table: np.ndarray, prints: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fills free slots of the wanted buckets, and returns what is left."""
        order = np.argsort(at, kind="stable")
        ranked = at[order]
        lead = np.append(True, ranked[1:] != ranked[:-1])
        rank = np.arange(len(ranked)) - np.maximum.accumulate(np.where(lead, np.arange(len(ranked)), 0))
        free = table[ranked] == 0
        fits = rank < free.sum(1)
        # The rank-th free slot of the bucket.
        slot = ((np.cumsum(free[fits], axis=1) == rank[fits, None] + 1) & free[fits]).argmax(1)
        table[ranked[fits], slot] = prints[order[fits]]
        left = order[~fits]
        return prints[left], at[left]

    def delete(self, keys: np.ndarray) -> None:
        prints, first, other = self._prints(np.ascontiguousarray(keys))
        for table in reversed(self.tables):
            mask = np.uint64(len(table) - 1)
            left = np.arange(len(prints))
            while len(left):
                a = (first[left] & mask).astype(np.int64)
                pair = np.stack([a, a ^ (other[left] & mask).astype(np.int64)], axis=1)
                held = (table[pair] == prints[left, None, None]).reshape(len(left), -1)
                some = held.any(1)
                left, pair, slot = left[some], pair[some], held[some].argmax(1)
                place = pair[np.arange(len(left)), slot // self.SLOTS] * self.SLOTS + slot % self.SLOTS
                place, turn = np.unique(place, return_index=True)
                table.reshape(-1)[place] = 0
                prints[left[turn]] = 0  # no key has this print, so it is found nowhere else
                left = np.delete(left, turn)

    def to_bytes(self) -> bytes:
        return b"".join([struct.pack("<I", len(self.tables)), *(struct.pack("<Q", len(t)) for t in self.tables), *(t.tobytes() for t in self.tables)])

    @classmethod
    def from_bytes(cls, raw: bytes) -> CuckooFilter:
        n = struct.unpack_from("<I", raw)[0]
        sizes = struct.unpack_from(f"<{n}Q", raw, 4)
        at, tables = 4 + 8 * n, []
        for size in sizes:
            tables.append(np.frombuffer(raw, np.uint16, size * cls.SLOTS, at).reshape(-1, cls.SLOTS).copy())
            at += 2 * size * cls.SLOTS
        return cls(tables=tables)


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, doc_id): the distinct keys of each document."""
    keys = F.expr(f"array_distinct(transform(filter({_KEYS}, k -> char_length(k) >= {int(min_chars)}), k -> {_HASHED}))")
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return found.select("doc_id", F.explode(keys).alias("key")).select("key.h1", "key.h2", "doc_id").distinct()


def _shard(shards: int):
    return F.pmod("h2", F.lit(shards)).cast("int").alias("shard")


@dataclass
class LineIndex:
    """One version of the state; insert() and delete() return the next one."""

    postings: DataFrame
    references: DataFrame
    filters: DataFrame
    min_docs: int = MIN_DOCS
    min_chars: int = MIN_CHARS
    shards: int = SHARDS

    @classmethod
    def empty(cls, spark: SparkSession, **settings) -> LineIndex:
        make = lambda schema: spark.createDataFrame([], schema)
        return cls(make("h1 long, h2 long, doc_id long"), make("h1 long, h2 long, n_docs long, last_doc long"), make("shard int, filter binary"), **settings)

    @staticmethod
    def _count(postings: DataFrame) -> DataFrame:
        return postings.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc"))

    @classmethod
    def build(cls, docs: DataFrame, **settings) -> LineIndex:
        """The state after inserting all documents into an empty index."""
        index = cls.empty(docs.sparkSession, **settings)
        index.postings = checkpointed(line_keys(docs, index.min_chars))
        index.references = checkpointed(cls._count(index.postings))
        index.shards = cls._shards_for(index.references)
        index.filters = index._filters()
        return index

    @staticmethod
    def _shards_for(references: DataFrame) -> int:
        return max(SHARDS, 1 << math.ceil(math.log2(references.count() / SHARD_KEYS + 1)))

    def _filters(self) -> DataFrame:
        """The filters of this version's exact table, made anew."""
        crossing = self.references.where(F.col("n_docs") >= self.min_docs).select(_shard(self.shards), "h1", F.lit(1).alias("step"))
        return self._refiltered(self.empty(crossing.sparkSession).filters, crossing)

    def insert(self, docs: DataFrame) -> LineIndex:
        """Takes documents in; what is in already stays as it is."""
        known = self.postings.unionByName(line_keys(docs, self.min_chars)).distinct()
        postings = checkpointed(known)
        return self._next(line_keys(docs, self.min_chars), postings)

    def delete(self, docs: DataFrame) -> LineIndex:
        """Takes documents out again; only their doc_id is used."""
        gone = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
        delta = checkpointed(self.postings.join(gone, "doc_id", "left_semi").select("h1", "h2", "doc_id"))
        return self._next(delta, checkpointed(self.postings.join(gone, "doc_id", "left_anti").select("h1", "h2", "doc_id")))

    def _next(self, delta: DataFrame, postings: DataFrame) -> LineIndex:
        touched = delta.select("h1", "h2").distinct()
        recounted = self._count(postings.join(touched, ["h1", "h2"], "left_semi"))
        references = checkpointed(self.references.join(touched, ["h1", "h2"], "left_anti").unionByName(recounted))
        enough = lambda df, name: df.where(F.col("n_docs") >= self.min_docs).select("h1", "h2", F.lit(1).alias(name))
        both = touched.join(enough(self.references, "was"), ["h1", "h2"], "left").join(enough(references, "now"), ["h1", "h2"], "left")
        step = F.coalesce("now", F.lit(0)) - F.coalesce("was", F.lit(0))
        crossing = both.select(_shard(self.shards), "h1", step.alias("step")).where("step <> 0")
        index = LineIndex(postings, references, self.filters, self.min_docs, self.min_chars, self._shards_for(references))
        index.filters = self._refiltered(self.filters, crossing) if index.shards == self.shards else index._filters()
        return index

    @staticmethod
    def _refiltered(filters: DataFrame, crossing: DataFrame) -> DataFrame:
        """Filters after the keys of ``crossing`` (shard, h1, step) entered (1) or left (-1) their shards."""

        def run(key: tuple, old: pa.Table, new: pa.Table) -> pa.Table:
            h1, step = np.asarray(new["h1"], np.int64), np.asarray(new["step"])
            held = CuckooFilter.from_bytes(old["filter"][0].as_py()) if old.num_rows else CuckooFilter(len(h1))
            held.delete(h1[step < 0])
            held.insert(h1[step > 0])
            return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "filter": pa.array([held.to_bytes()], pa.binary())})

        grouped = filters.groupBy("shard").cogroup(crossing.groupBy("shard"))
        return checkpointed(grouped.applyInArrow(run, "shard int, filter binary"))

    def possible(self) -> DataFrame:
        """(h1, h2): the distinct keys that their shards' filters may hold."""

        def run(filters: pa.Table, keys: pa.Table) -> pa.Table:
            held = CuckooFilter.from_bytes(filters["filter"][0].as_py()) if filters.num_rows else CuckooFilter()
            return keys.select(["h1", "h2"]).filter(pa.array(held.contains(np.asarray(keys["h1"], np.int64))))

        keys = self.references.select(_shard(self.shards), "h1", "h2")
        return self.filters.groupBy("shard").cogroup(keys.groupBy("shard")).applyInArrow(run, "h1 long, h2 long")

    def dropped(self) -> DataFrame:
        """(doc_id, dropped): for each document that loses lines, their keys."""
        enough = checkpointed(self.possible().join(self.references.where(F.col("n_docs") >= self.min_docs), ["h1", "h2"]).select("h1", "h2", "last_doc"))
        lost = self.postings.join(enough, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
        return lost.groupBy("doc_id").agg(F.collect_set(F.struct("h1", "h2")).alias("dropped"))

    def _judged(self, docs: DataFrame) -> DataFrame:
        """Each row of docs with its lines and those that stay."""
        lost = self.dropped().withColumnRenamed("doc_id", "lost_id")
        joined = docs.join(lost.hint("shuffle_hash"), docs["doc_id"].cast("long").eqNullSafe(F.col("lost_id")), "left")
        marked = f"zip_with(lines, {_KEYS}, (line, k) -> IF(char_length(k) >= {int(self.min_chars)} AND array_contains(dropped, {_HASHED}), NULL, line))"
        stay = F.when(F.col("dropped").isNull(), F.col("lines")).otherwise(F.expr(f"filter({marked}, x -> x IS NOT NULL)"))
        return joined.withColumn("lines", F.expr("split(coalesce(text, ''), '\\n', -1)")).withColumn("stay", stay)

    def decide(self, docs: DataFrame) -> DataFrame:
        """doc_id, n_lines, n_dropped and kept, the text of the lines that stay; a row for each row of docs."""
        given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        return self._judged(given).select("doc_id", F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("stay")).cast("long").alias("n_dropped"), F.array_join("stay", "\n").alias("kept"))

    def rewrite(self, docs: DataFrame) -> DataFrame:
        """The rows of docs with the text of the lines that stay; a null text stays null."""
        given = docs.select(*[F.col(c).alias(f"in_{c}") for c in docs.columns], F.col("doc_id"), F.col("text").cast("string").alias("text"))
        text = F.when(F.col("text").isNotNull(), F.array_join("stay", "\n"))
        return self._judged(given).select(*[text.alias(c) if c == "text" else F.col(f"in_{c}").alias(c) for c in docs.columns])


def digests(docs: DataFrame) -> DataFrame:
    found = LineIndex.build(docs).decide(docs)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read_table(spark, sf_dir, "documents"))


QUERIES = {"op4_line_dedup": query}
ORACLE_SQL = {
    "op4_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, l.line AS line, l.n AS n,
    translate(trim(l.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM documents, unnest(string_split(coalesce(text, ''), chr(10))) WITH ORDINALITY AS l(line, n)),
keys AS (SELECT key, count(DISTINCT doc_id) AS n_docs, max(doc_id) AS last_doc FROM lines WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT l.*, k.key IS NOT NULL AND l.doc_id <> k.last_doc AS gone FROM lines l LEFT JOIN keys k ON l.key = k.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
}
