"""Token-id files: independent zstandard frames with a trailing seek table.

A file holds documents in ascending key order:

* one zstandard frame (or several, for a document beyond ``FRAME_IDS`` ids) per
  document: its ids as little-endian unsigned integers of 2 or 4 bytes, with the
  frame's own content checksum;
* a skippable frame (magic 0x184D2A50) with the document index: id width, number of
  documents, keys as int64, frames of each document as uint32;
* a skippable frame (magic 0x184D2A5E) with the seek table of the zstandard seekable
  format: for each frame compressed size, decompressed size and the low 32 bits of
  the xxHash64 of its content; then number of frames, descriptor, 0x8F92EAB1.

A reader takes the tail, then fetches and decompresses only the frames asked for.
Any zstandard decoder can read a whole file, as skippable frames hold no content.

Documents are dealt to files by ranges of the key, so files and the documents in them
are in key order. Files go to the folder that the cluster shares, under a name of
their own until complete, so a task that runs twice leaves one whole file.

Null text counts as empty: only the end id. Null keys come first; rows with equal
keys follow each other in the order of their texts. An empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.llm.common import mapped, pieces, read_table, shared_dir
from leafwright.llm.pretokens import PieceMemo, scan

DEFAULT_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2
FRAME_IDS = 1 << 24
LEVEL = 3
#: Text bytes that are encoded at a time.
ENCODED_BYTES = 512 << 10
#: Distinct pieces that a worker remembers, at some 30 bytes each, before it starts anew.
MEMO_PIECES = 1_000_000

INDEX_MAGIC, SEEK_MAGIC, END_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
_FOOTER = struct.Struct("<IBI")
_HEAD = struct.Struct("<II")
_INDEX = struct.Struct("<BQ")
_NULL_KEY = np.iinfo(np.int64).min


class PieceEncoder:
    """The tokenizers library over each distinct piece once; pieces are encoded separately by the vocabulary's own rule.

    As in the library, the name of an added token in a text is that token, and what stands between
    such names is encoded by itself; with ``names_as_text`` it is ordinary text. Texts that
    hold an added token with options of its own (such as stripping blanks) go to the library whole.
    """

    def __init__(self, path: str, names_as_text: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = names_as_text
        added = {} if names_as_text else self.tokenizer.get_added_tokens_decoder()
        self.added = {x.content: k for k, x in added.items()}
        self.plain = not any(x.single_word or x.lstrip or x.rstrip or x.normalized for x in added.values())
        self.names = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.memo = PieceMemo(self.dtype, MEMO_PIECES)

    def _ids(self, fresh: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False)]

    def _parts(self, text: str) -> list[str | int]:
        """Runs of ordinary text and ids of the added tokens between them."""
        if self.names is None or not self.names.search(text):
            return [text]
        if not self.plain:
            return list(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return [self.added.get(x, x) for x in self.names.split(text) if x]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text with the end id, in the encoder's id width."""
        parts = [self._parts(x or "") for x in texts]
        ids, at = self.memo.encode(scan([x for own in parts for x in own if isinstance(x, str)]), self._ids)
        out, k, end = [], 0, np.asarray([END_ID], self.dtype).tobytes()
        for own in parts:
            found = []
            for x in own:
                if isinstance(x, str):
                    found.append(ids[at[k] : at[k + 1]].tobytes())
                    k += 1
                else:
                    found.append(np.asarray([x], self.dtype).tobytes())
            out.append(b"".join([*found, end]))
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def encode_documents(docs: DataFrame, text: str = "text", key: str = "doc_id", tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """(key, width, ids): each whole text's ids and the end id, packed at ``width`` bytes an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for batch in batches:
            for part in pieces(batch, limit=ENCODED_BYTES):
                ids = own.encode_all(part.column(1).to_pylist())
                width = pa.array(np.full(len(ids), own.dtype.itemsize, np.int32))
                yield pa.record_batch([part.column(0), width, pa.array(ids, pa.binary())], names=["key", "width", "ids"])

    given = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return mapped(given, run, "key long, width int, ids binary")


class FrameWriter:
    """Writes one file to any open binary sink."""

    def __init__(self, sink, width: int):
        self.sink, self.width = sink, width
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
        self.keys: list[int] = []
        self.frames_of: list[int] = []
        self.seek: list[tuple[int, int, int]] = []
        self.n_ids = 0

    def add(self, key: int | None, ids: bytes) -> None:
        step = FRAME_IDS * self.width
        cut = [ids[i : i + step] for i in range(0, len(ids), step)] or [b""]
        for content in cut:
            frame = self.packer.compress(content)
            self.sink.write(frame)
            self.seek.append((len(frame), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        self.keys.append(_NULL_KEY if key is None else key)
        self.frames_of.append(len(cut))
        self.n_ids += len(ids) // self.width

    def close(self) -> None:
        index = _INDEX.pack(self.width, len(self.keys)) + np.asarray(self.keys, "<i8").tobytes() + np.asarray(self.frames_of, "<u4").tobytes()
        self.sink.write(_HEAD.pack(INDEX_MAGIC, len(index)) + index)
        table = np.asarray(self.seek, "<u4").reshape(-1, 3).tobytes()
        self.sink.write(_HEAD.pack(SEEK_MAGIC, len(table) + _FOOTER.size) + table + _FOOTER.pack(len(self.seek), 0x80, END_MAGIC))


@dataclass
class FrameReader:
    """Random access to one file; checks every frame that it opens against the seek table."""

    source: pa.NativeFile

    def __post_init__(self) -> None:
        size = self.source.size()
        self.source.seek(size - _FOOTER.size)
        n, descriptor, magic = _FOOTER.unpack(self.source.read(_FOOTER.size))
        if magic != END_MAGIC or not descriptor & 0x80:
            raise ValueError("not a token file with checksums")
        at = size - _FOOTER.size - 12 * n
        self.source.seek(at)
        self.seek = np.frombuffer(self.source.read(12 * n), "<u4").reshape(-1, 3)
        self.offset = np.concatenate([[0], np.cumsum(self.seek[:, 0], dtype=np.int64)])
        self.source.seek(int(self.offset[-1]))
        magic, length = _HEAD.unpack(self.source.read(_HEAD.size))
        index = self.source.read(length)
        self.width, docs = _INDEX.unpack_from(index)
        self.keys = np.frombuffer(index, "<i8", docs, _INDEX.size)
        frames = np.frombuffer(index, "<u4", docs, _INDEX.size + 8 * docs)
        self.frame = np.concatenate([[0], np.cumsum(frames, dtype=np.int64)])
        self.unpacker = zstandard.ZstdDecompressor()

    def document(self, k: int) -> np.ndarray:
        """Ids of the k-th document; no other document is read."""
        out = []
        for f in range(int(self.frame[k]), int(self.frame[k + 1])):
            self.source.seek(int(self.offset[f]))
            content = self.unpacker.decompress(self.source.read(int(self.seek[f, 0])))
            if len(content) != self.seek[f, 1] or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.seek[f, 2]:
                raise ValueError(f"frame {f} is damaged")
            out.append(content)
        return np.frombuffer(b"".join(out), f"<u{self.width}")

    def lookup(self, key: int) -> list[np.ndarray]:
        """Ids of the documents with a key, found by binary search in the index."""
        lo, hi = np.searchsorted(self.keys, [key, key], "left")[0], np.searchsorted(self.keys, key, "right")
        return [self.document(k) for k in range(int(lo), int(hi))]


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def write_files(encoded: DataFrame, folder: str) -> list[tuple[int, str, int, int]]:
    """Writes the rows of encode_documents(), a file for each partition, and returns (file number, path, documents, ids) for each file."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        writer = sink = None
        part = TaskContext.get().partitionId()
        store, root = filesystem(folder)
        name = f"{root}/part-{part:06d}.zst"
        trial = f"{root}/.part-{part:06d}-{uuid.uuid4().hex}"
        for batch in batches:
            for key, width, ids in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if writer is None:
                    sink = store.open_output_stream(trial)
                    writer = FrameWriter(sink, width)
                writer.add(key, ids)
        if writer is not None:
            writer.close()
            sink.close()
            store.move(trial, name)
            yield pa.record_batch([pa.array([part], pa.int64()), pa.array([name]), pa.array([len(writer.keys)], pa.int64()), pa.array([writer.n_ids], pa.int64())], names=["part", "path", "n_docs", "n_ids"])

    store, root = filesystem(folder)
    store.create_dir(root, recursive=True)
    found = mapped(encoded, run, "part long, path string, n_docs long, n_ids long").collect()
    return sorted(tuple(x) for x in found)


def in_key_order(docs: DataFrame, text: str = "text", key: str = "doc_id", files: int | None = None) -> DataFrame:
    """(key, text) dealt to ``files`` ranges of the key and sorted in each.

    Texts are dealt before they are encoded: finding the ranges reads the input once
    more, and reading is cheap where encoding is not.
    """
    given = docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text))
    n = files or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return given.repartitionByRange(n, key).sortWithinPartitions(key, text)


def read_digests(spark: SparkSession, files: list[tuple[int, str, int, int]], folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the files."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(folder)
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with store.open_input_file(path) as source:
                    reader = FrameReader(source)
                    at = base
                    for lo in range(0, len(reader.keys), 4096):
                        rows = []
                        for k in range(lo, min(lo + 4096, len(reader.keys))):
                            ids = reader.document(k).astype("<u4")
                            key = int(reader.keys[k])
                            rows.append((None if key == _NULL_KEY else key, at, len(ids), zlib.crc32(ids.tobytes())))
                            at += len(ids)
                        yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    starts = np.concatenate([[0], np.cumsum([x[3] for x in files])]).tolist()
    rows = [(x[1], start) for x, start in zip(files, starts, strict=False)]
    given = spark.createDataFrame(rows, "path string, base long").repartition(max(1, len(rows)))
    return mapped(given, run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/token_files/{uuid.uuid4().hex}"
    files = write_files(encode_documents(in_key_order(read_table(spark, sf_dir, "documents"))), folder)
    return read_digests(spark, files, folder)


QUERIES = {"op5_token_files": query}
