"""Byte-level BPE encoding and decoding.

Each piece of a text is mapped byte by byte to Latin-1 and run once through an
Aho-Corasick automaton of all tokens, which gives the longest token at every
position. The encoder takes the longest token and falls back to shorter ones, or
one token back, until every adjacent pair is compatible: two tokens may stand side
by side only if the merge rules would not have joined anything across their border.
A sequence whose pairs are all compatible is the one that the merges produce. Dead
ends are marked by position, so no position is left twice and time is linear in the
piece. Pair checks and the ids of pieces are memoised.

Null text counts as empty: no tokens. Rows are independent, so repeated rows give
repeated results; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.llm.common import mapped, pieces, read_table, resident
from leafwright.llm.pretokens import PieceMemo, scan

DEFAULT_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Distinct pieces, at some 30 bytes each, and adjacent pairs that a worker remembers before it starts anew.
MEMO_PIECES = 600_000
MEMO_PAIRS = 1 << 16


class ByteBpe:
    """Encoder and decoder for a vocabulary of byte strings with merge ranks as ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        size = max(ranks.values()) + 1
        self.token = [b""] * size
        self.prefix = [-1] * size
        self.halves: list[tuple[int, int]] = [(i, i) for i in range(size)]
        self.joined: dict[tuple[int, int], int] = {}
        self.automaton = ahocorasick.Automaton()
        for word, rank in ranks.items():
            self.token[rank] = word
            self.automaton.add_word(word.decode("latin-1"), (len(word), rank))
        self.automaton.make_automaton()
        for word, rank in sorted(ranks.items(), key=lambda x: x[1]):
            for n in range(len(word) - 1, 0, -1):
                if (shorter := ranks.get(word[:n])) is not None:
                    self.prefix[rank] = shorter
                    break
            if len(word) > 1 and (halves := self._halves(word, rank)):
                self.halves[rank] = halves
                self.joined[halves] = rank
        self.pairs: dict[int, bool] = {}
        self.memo = PieceMemo(np.dtype("<u4"), MEMO_PIECES)

    def _halves(self, word: bytes, rank: int) -> tuple[int, int] | None:
        """The pair whose merge makes a token: what its bytes come to under all earlier merges."""
        if len(word) == 2:
            return self.ranks[word[:1]], self.ranks[word[1:]]
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 2:
            best, at = rank, -1
            for i in range(len(parts) - 1):
                if (found := self.ranks.get(parts[i] + parts[i + 1], rank)) < best:
                    best, at = found, i
            if at < 0:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges, run over both tokens' bytes, would leave exactly these two."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        limit = len(self.token)
        while True:
            if self.joined.get((left, right), limit) < limit:
                return False
            # Undo the later of the two merges: before it, its inner half stood at the border.
            left_whole, right_whole = self.halves[left][0] == left, self.halves[right][0] == right
            if left_whole and right_whole:
                return True
            if not left_whole and (right_whole or left > right):
                limit, left = left, self.halves[left][1]
            else:
                limit, right = right + 1, self.halves[right][0]

    def encode_piece(self, piece: str) -> list[int]:
        raw = piece.encode()
        whole = self.ranks.get(raw)
        if whole is not None:
            return [whole]
        n = len(raw)
        longest = [-1] * n
        for last, (length, rank) in self.automaton.iter(raw.decode("latin-1")):
            at = last - length + 1  # matches come by end, so a later one at the same start is longer
            longest[at] = rank
        token, prefix, compatible = self.token, self.prefix, self.compatible
        dead = bytearray(n + 1)
        out: list[int] = []
        at, trial = 0, longest[0]
        while at < n:
            end = at + len(token[trial])
            if not dead[end] and (not out or compatible(out[-1], trial)):
                out.append(trial)
                at = end
                trial = longest[at] if at < n else -1
            elif prefix[trial] >= 0:
                trial = prefix[trial]
            else:
                dead[at] = 1
                trial = out.pop()
                at -= len(token[trial])
        return out

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        ids, at = self.memo.encode(scan([x or "" for x in texts]), lambda fresh: [self.encode_piece(x) for x in fresh])
        return [ids[lo:hi].tobytes() for lo, hi in zip(at[:-1], at[1:], strict=True)]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def read_ranks(lines: bytes) -> dict[bytes, int]:
    return {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines.splitlines())}


@resident(maxsize=2)
def load(path: str) -> ByteBpe:
    """A worker's own encoder; vocabulary files are installed with the tokenizer package on every machine."""
    with open(path, "rb") as file:
        return ByteBpe(read_ranks(file.read()))


def encode_documents(docs: DataFrame, text: str = "text", key: str = "doc_id", ranks: str = DEFAULT_RANKS) -> DataFrame:
    """(key, ids): the ids of each whole text as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(ranks)
        for batch in batches:
            for part in pieces(batch):
                ids = bpe.encode_all(part.column(1).to_pylist())
                yield pa.record_batch([part.column(0), pa.array(ids, pa.binary())], names=["key", "ids"])

    given = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return mapped(given, run, "key long, ids binary").withColumnRenamed("key", key)


def decode_documents(encoded: DataFrame, key: str = "doc_id", ranks: str = DEFAULT_RANKS) -> DataFrame:
    """(key, ids, decoded): the bytes that each row's ids stand for; null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(ranks)
        for batch in batches:
            for part in pieces(batch, "ids"):
                ids = part.column(1)
                decoded = [bpe.decode(x or b"") for x in ids.to_pylist()]
                yield pa.record_batch([part.column(0), ids, pa.array(decoded, pa.binary())], names=["key", "ids", "decoded"])

    given = encoded.select(F.col(key).cast("long").alias("key"), "ids")
    return mapped(given, run, "key long, ids binary, decoded binary").withColumnRenamed("key", key)


def round_trips(docs: DataFrame, text: str = "text", key: str = "doc_id", ranks: str = DEFAULT_RANKS) -> DataFrame:
    """(key, ids, decoded): encode_documents() and decode_documents() in one pass, by one worker with one encoder a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(ranks)
        for batch in batches:
            for part in pieces(batch):
                ids = bpe.encode_all(part.column(1).to_pylist())
                decoded = [bpe.decode(x) for x in ids]
                yield pa.record_batch([part.column(0), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())], names=["key", "ids", "decoded"])

    given = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return mapped(given, run, "key long, ids binary, decoded binary").withColumnRenamed("key", key)


def digests(docs: DataFrame, ranks: str = DEFAULT_RANKS) -> DataFrame:
    """Per document: number of ids, SHA-256 of the ids, and of the bytes they decode to."""
    decoded = round_trips(docs, ranks=ranks)
    return decoded.select(
        "doc_id",
        F.expr("CAST(length(ids) / 4 AS BIGINT)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read_table(spark, sf_dir, "documents"))


QUERIES = {"op8_byte_bpe": query}
