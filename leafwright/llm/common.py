"""What the operators share: table access, Arrow batches in bounded pieces, and word scanning in numpy."""

from __future__ import annotations

import ctypes
import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Text bytes that are scanned at a time; a longer single text is a piece of its own.
PIECE_BYTES = 512 << 10


#: Bytes that Spark and a Python worker exchange at a time.
BATCH_BYTES = 8 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_libc = ctypes.CDLL(None)


def release() -> None:
    """Hands freed memory back to the machine; else a worker keeps its highest use for good."""
    pa.default_memory_pool().release_unused()
    trim = getattr(_libc, "malloc_trim", None)
    if trim is not None:
        trim(0)


_resident: dict[str, list] = {}


def resident(maxsize: int) -> Callable:
    """lru_cache for what a worker keeps between the tasks of one operator, by the module that defines it."""

    def wrap(make: Callable) -> Callable:
        cached = lru_cache(maxsize=maxsize)(make)
        _resident.setdefault(make.__module__, []).append(cached)
        return cached

    return wrap


def keep_only(module: str) -> None:
    """Drops what other modules' operators keep here: Spark's workers outlive a stage, and would carry the models of all."""
    for owner, found in _resident.items():
        if owner != module:
            for cached in found:
                cached.cache_clear()


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """df.mapInArrow over batches of bounded size, by workers that give memory back after each and hold no other operator's models."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    module = run.__module__

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            del batch
            release()

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only(module)
        release()
        return run(settled(batches))

    return df.mapInArrow(alone, schema)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares; one of this machine stands in where the session has none, and only if it runs on this machine alone."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "/tmp/leafwright-shared"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared store, in whatever file system it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cuts the lineage by writing the rows to the shared folder, from which any executor can reread them."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def flat(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def pieces(batch: pa.RecordBatch, text: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each; rows are never cut."""
    n = batch.num_rows
    if not n:
        return
    sizes = np.asarray(pc.binary_length(batch.column(text)).fill_null(0), dtype=np.int64)
    total = np.cumsum(sizes)
    at = 0
    while at < n:
        base = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one run of UTF-8 bytes, and n + 1 offsets; null counts as empty."""
    column = pa.array(column.fill_null("")) if column.null_count else column
    large = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def byte_table(word_bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.fromiter(word_bytes, int)] = True
    return table


#: `[^\x20\x09-\x0D]+`, over UTF-8 bytes.
BLANK_SPLIT = byte_table(b for b in range(256) if b != 0x20 and not 0x09 <= b <= 0x0D)
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, over UTF-8 bytes with A-Z already in lower case.
ALNUM_SPLIT = byte_table(b for b in range(256) if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n; kept, as every piece needs them."""
    if len(_powers[0]) < n:
        size = max(n, PIECE_BYTES + 1)
        for k, base in enumerate((_BASE, _INVERSE)):
            run = np.full(size, base, np.uint64)
            run[0] = 1
            _powers[k] = np.cumprod(run, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64's finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


LONG_WORD = 256


@dataclass
class Words:
    """Words of a piece: byte ranges in ``data``, 64-bit hashes, and for each document its first word's index."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def text(self, k: int) -> bytes:
        return self.data[self.start[k] : self.end[k]].tobytes()


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def scan_words(column: pa.Array, table: np.ndarray, lower: bool, hashed: bool = True) -> Words:
    """Maximal runs of the table's bytes in each text, with A-Z in lower case first if asked."""
    data, at = text_bytes(column)
    if lower:
        data = _LOWER[data]
    inside = table[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = at[(at > 0) & (at < len(data))]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, at, "left")
    words = Words(data, start, end, np.zeros(0, np.uint64), first)
    if hashed:
        up, down = powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
        value = (total[end] - total[start]) * down[start]
        value += (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        words.hash = mix(value)
        for k in np.flatnonzero(end - start > LONG_WORD):
            words.hash[k] = int.from_bytes(hashlib.blake2b(words.text(k), digest_size=8).digest(), "little")
    return words


def window_hash(values: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    value = mix(values ^ np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    factor = np.uint64(0xC2B2AE3D27D4EB4F)
    out, weight = np.zeros(n, np.uint64), np.uint64(1)
    with np.errstate(over="ignore"):
        for k in range(width):
            out += value[k : k + n] * weight
            weight = weight * factor
    return mix(out)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows with equal values in the first ``keys`` columns, from batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for k in range(keys):
            values = np.asarray(batch.column(k))
            change[1:] |= values[1:] != values[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            part = batch.slice(lo, hi - lo)
            key = tuple(part.column(k)[0].as_py() for k in range(keys))
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def least_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For n nodes in ascending order and links a-b between them, the least node that each reaches."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


class SortedMemo:
    """Rows by 64-bit key in sorted arrays, a few bytes an entry: a large part, and a small one that joins it now and then.

    A worker keeps one between batches; beyond ``limit`` entries it starts anew.
    """

    def __init__(self, limit: int, **dtypes: np.dtype):
        self.limit, self.dtypes = limit, {"key": np.dtype(np.uint64)} | dtypes
        self.clear()

    def clear(self) -> None:
        self.parts = [{k: np.zeros(0, t) for k, t in self.dtypes.items()} for _ in range(2)]

    def find(self, keys: np.ndarray, **same: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Which keys are known, with all of ``same`` equal too, and the columns of their rows."""
        known = np.zeros(len(keys), bool)
        out = {k: np.zeros(len(keys), t) for k, t in self.dtypes.items() if k != "key"}
        for part in self.parts:
            if len(part["key"]):
                at = np.minimum(np.searchsorted(part["key"], keys), len(part["key"]) - 1)
                here = (part["key"][at] == keys) & np.logical_and.reduce([part[k][at] == v for k, v in same.items()] or [True])
                known |= here
                for k in out:
                    out[k][here] = part[k][at[here]]
        return known, out

    def add(self, keys: np.ndarray, **columns: np.ndarray) -> bool:
        """Adds rows of sorted keys that are not known; False if the memo was full and is empty now."""
        main, recent = self.parts
        if len(main["key"]) + len(recent["key"]) + len(keys) > self.limit:
            self.clear()
            return False
        recent = self._merged(recent, {"key": keys} | columns)
        if len(recent["key"]) > max(50_000, len(main["key"]) // 4):
            main, recent = self._merged(main, recent), {k: v[:0] for k, v in recent.items()}
        self.parts = [main, recent]
        return True

    def _merged(self, a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        where = np.searchsorted(a["key"], b["key"])
        return {k: np.insert(a[k], where, b[k].astype(t)) for k, t in self.dtypes.items()}
