"""Substring dedup by recompression: windows of words that also start earlier lose their words.

Rounds of recompression shorten the word sequence of every document: the first names each run
of one word, and each round names adjacent pairs of a symbol from the left half of all
names and one from the right half. A name is a hash of what it stands for, and so is
the half that it belongs to in a round: every executor gives equal content the same
name without asking. Whether a symbol arises depends only on the words in a small
span around it, which the rounds keep track of; so wherever those words stand, in any
document, the symbol stands too.

Each window picks, among the symbols whose span lies within it, the one of least name. Equal
windows pick equal symbols. Neighbouring windows mostly pick the same one, so a document
becomes about one row for eight words: the symbol's name, a hash of all words that
its windows cover, and the place. A window without such a symbol is its own symbol.

Then, in Spark: names that stand once are dropped; rows of equal name and words keep
their first place and lose the others; only where one name stands among different words
are its windows compared one by one, by two 64-bit hashes. Copies fold into one row for
each task before any shuffle, and texts are dealt out once, by document.

Null and empty texts have no words. A document of fewer words than a window loses none.
Rows that share a doc_id count as one document, whose rows are judged by their starts.
Rows with a null doc_id stand before all others. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.llm.common import BLANK_SPLIT, checkpointed, mapped, mix, pieces, read_table, scan_words, window_hash

WINDOW = 20
ROUNDS = 2
#: Text bytes that are scanned at a time.
SCAN_BYTES = 512 << 10
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_NONE = np.uint64((1 << 64) - 1)


def _salt(number: int) -> np.uint64:
    return np.uint64(number * int(_B) & (1 << 64) - 1)


def _named(kind: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(mix(a + _salt(kind)) * _A + b)


class Symbols:
    """Symbols of several documents in order: name, words [start, end), and the span [lo, hi) of words that settles them.

    A symbol that only the edge of its document settles has a span that leaves the document.
    """

    def __init__(self, words: np.ndarray, first: np.ndarray):
        n = len(words)
        self.name = words
        self.start, self.end = np.arange(n), np.arange(n) + 1
        self.lo, self.hi = self.start.copy(), self.end.copy()
        self.doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        self.first = first

    def _around(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Whether a symbol has a neighbour before and after it, and how far the spans of those reach."""
        before, after = np.zeros(len(self.doc), bool), np.zeros(len(self.doc), bool)
        same = self.doc[1:] == self.doc[:-1]
        before[1:], after[:-1] = same, same
        left, right = self.first[self.doc] - 1, self.first[self.doc + 1] + 1
        left[1:][same] = self.lo[:-1][same]
        right[:-1][same] = self.hi[1:][same]
        return before, after, left, right

    def _fold(self, lead: np.ndarray, name: np.ndarray) -> None:
        """Joins each lead with the symbols after it up to the next lead."""
        at = np.flatnonzero(lead)
        last = np.append(at[1:], len(lead)) - 1
        self.name, self.start, self.end, self.lo, self.hi, self.doc = name, self.start[at], self.end[last], np.minimum.reduceat(self.lo, at), np.maximum.reduceat(self.hi, at), self.doc[at]

    def name_runs(self) -> None:
        before, _, left, right = self._around()
        self.lo, self.hi = np.minimum(self.lo, left), np.maximum(self.hi, right)
        lead = np.ones(len(self.name), bool)
        lead[1:] = ~(before[1:] & (self.name[1:] == self.name[:-1]))
        at = np.flatnonzero(lead)
        length = np.diff(np.append(at, len(lead)))
        self._fold(lead, np.where(length > 1, _named(1, self.name[at], length.astype(np.uint64)), self.name[at]))

    def name_pairs(self, number: int) -> None:
        before, after, left, right = self._around()
        first_half = (mix(self.name + _salt(number)) & np.uint64(1)).astype(bool)
        joins = np.zeros(len(self.name), bool)  # with the next one
        joins[:-1] = after[:-1] & first_half[:-1] & ~first_half[1:]
        joined = np.zeros(len(self.name), bool)  # with the one before
        joined[1:] = joins[:-1]
        alone = ~joins & ~joined
        self.hi = np.where(alone & first_half, np.maximum(self.hi, right), self.hi)
        self.lo = np.where(alone & ~first_half, np.minimum(self.lo, left), self.lo)
        at = np.flatnonzero(~joined)
        name = self.name[at]
        two = joins[at]
        name[two] = _named(2 + number, self.name[at[two]], self.name[at[two] + 1])
        self._fold(~joined, name)


def recompressed(words: np.ndarray, first: np.ndarray, rounds: int = ROUNDS) -> Symbols:
    symbols = Symbols(words, first)
    if len(words):
        symbols.name_runs()
        for number in range(1, rounds + 1):
            symbols.name_pairs(number)
    return symbols


def _span_hash(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums from which the hash of any run of words is a difference, and the inverse powers that shift it home."""
    n = len(values)
    up, down = np.full(n + 1, _A | np.uint64(1), np.uint64), np.full(n + 1, np.uint64(pow(int(_A) | 1, -1, 1 << 64)), np.uint64)
    up[0] = down[0] = 1
    up, down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up[:-1], out=total[1:])
    return total, down


def anchors(words: np.ndarray, first: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """(document, first window, number of windows, name, print) for each symbol that windows pick."""
    size = np.diff(first)
    number = np.maximum(size - window + 1, 0)
    doc = np.repeat(np.arange(len(size)), number)
    start = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number) + first[doc]
    if not len(start):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    symbols = recompressed(words, first)
    total, down = _span_hash(words)
    lo, hi = np.maximum(symbols.lo, 0), np.minimum(symbols.hi, len(words))
    # A symbol stands for itself together with the words that settle it.
    name = _named(9, (total[hi] - total[lo]) * down[lo], symbols.name)
    a, b = np.searchsorted(symbols.lo, start, "left"), np.searchsorted(symbols.hi, start + window, "right")
    best, pick = np.full(len(start), _NONE), np.full(len(start), -1)
    for k in range(int((b - a).max(initial=0))):
        own = np.flatnonzero(a + k < b)
        value = name[a[own] + k]
        less = value < best[own]
        best[own[less]], pick[own[less]] = value[less], a[own[less]] + k
    lead = np.ones(len(start), bool)
    lead[1:] = (pick[1:] != pick[:-1]) | (pick[1:] < 0) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(lead)
    count = np.diff(np.append(at, len(start)))
    begin, end = start[at], start[at] + count + window - 1
    covered = (total[end] - total[begin]) * down[begin]
    place = np.where(pick[at] >= 0, symbols.start[pick[at]] - begin, 0).astype(np.uint64)
    covered = _named(10, covered, place * np.uint64(1 << 20) + count.astype(np.uint64))
    return doc[at], begin - first[doc[at]], count, np.where(pick[at] >= 0, best[at], _named(11, covered, covered)), covered


def anchor_rows(docs: DataFrame) -> DataFrame:
    """(name, print, doc_id, place) of every document; place is the first window and, in the last byte, their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, limit=SCAN_BYTES):
                words = scan_words(part.column(1), BLANK_SPLIT, lower=False)
                doc, start, count, name, covered = anchors(words.hash, words.first)
                yield pa.record_batch([pa.array(name.view(np.int64)), pa.array(covered.view(np.int64)), part.column(0).take(pa.array(doc)), pa.array(start << 8 | count)], names=["name", "print", "doc_id", "place"])

    return mapped(docs, run, "name long, print long, doc_id long, place long")


def _window_rows(listed: DataFrame) -> DataFrame:
    """(h1, h2, doc_id, place) of each window listed in (doc_id, text, places)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column(2).is_valid())
            for part in pieces(batch, limit=SCAN_BYTES):
                words = scan_words(part.column(1), BLANK_SPLIT, lower=False)
                h1, h2 = window_hash(words.hash, WINDOW, 1), window_hash(words.hash, WINDOW, 2)
                places = part.column(2)
                owner = np.repeat(np.arange(part.num_rows), np.diff(np.asarray(places.offsets)))
                value = np.asarray(places.flatten())
                count = value & 0xFF
                row = np.repeat(owner, count)
                start = np.repeat(value >> 8, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                inside = start + WINDOW <= np.diff(words.first)[row]  # another row of the same doc_id may be shorter
                row, start = row[inside], start[inside]
                at = words.first[row] + start
                yield pa.record_batch([pa.array(h1[at].view(np.int64)), pa.array(h2[at].view(np.int64)), part.column(0).take(pa.array(row)), pa.array(start << 8 | 1)], names=["h1", "h2", "doc_id", "place"])

    return mapped(listed, run, "h1 long, h2 long, doc_id long, place long")


def _dealt(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(doc_id, text, places) of every document; the exchange of texts is the same for each caller, so it is made once."""
    listed = places.groupBy("doc_id").agg(F.collect_list("place").alias("places")).withColumnRenamed("doc_id", "of_id")
    return docs.join(listed.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(listed["of_id"]), "left").select("doc_id", "text", "places")


def repeated(docs: DataFrame) -> DataFrame:
    """(doc_id, text, places): each document with the windows that also start earlier, as runs of windows."""
    found = anchor_rows(docs)
    # Read from the shared folder, both sides of the join are plain exchanges, so a name that is everywhere is split.
    often = checkpointed(found.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name"))
    again = checkpointed(found.join(often, "name"))
    least = F.min(F.struct("doc_id", "place"))
    prints = checkpointed(again.groupBy("name", "print").agg(least.alias("lead"), F.count(F.lit(1)).alias("n")))
    copies = again.join(prints.where("n > 1"), ["name", "print"]).where(~F.struct("doc_id", "place").eqNullSafe(F.col("lead"))).select("doc_id", "place")
    mixed = prints.groupBy("name").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("name")
    unsure = prints.join(mixed, "name").select("lead.doc_id", "lead.place")
    windows = _window_rows(_dealt(docs, unsure))
    firsts = windows.groupBy("h1", "h2").agg(least.alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = windows.join(firsts, ["h1", "h2"]).where(~F.struct("doc_id", "place").eqNullSafe(F.col("lead"))).select("doc_id", "place")
    return _dealt(docs, copies.unionByName(later))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each whole text without the words of repeated windows, joined by spaces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                n, gone, kept = [], [], []
                for text, places in zip(part.column(1).to_pylist(), part.column(2), strict=True):
                    words = (text or "").encode().split()  # bytes split at exactly \x20 and \x09-\x0D
                    removed = 0
                    if places.is_valid:
                        value = np.asarray(places.values)
                        start = value >> 8
                        edge = np.zeros(len(words) + 1, np.int64)
                        np.add.at(edge, np.minimum(start, len(words)), 1)
                        np.add.at(edge, np.minimum(start + (value & 0xFF) + WINDOW - 1, len(words)), -1)
                        covered = np.cumsum(edge[:-1]) > 0
                        removed = int(covered.sum())
                        words = [words[k] for k in np.flatnonzero(~covered).tolist()]
                    n.append(len(words) + removed)
                    gone.append(removed)
                    kept.append(b" ".join(words))
                yield pa.record_batch([part.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary())], names=["doc_id", "n_words", "n_removed", "kept"])

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return mapped(repeated(given), run, "doc_id long, n_words long, n_removed long, kept binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(rows: list[tuple]) -> dict[int, tuple[int, int, str]]:
    """doc_id -> (n_words, n_removed, kept_sha256) by the rule as it is written, for tests."""
    split = {k: (x or "").encode().split() for k, x in rows}
    seen: set = set()
    out = {}
    for k in sorted(split):
        w, gone = split[k], set()
        for i in range(len(w) - WINDOW + 1):
            window = tuple(w[i : i + WINDOW])
            if window in seen:
                gone.update(range(i, i + WINDOW))
            seen.add(window)
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out[k] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out


QUERIES = {"op1_substring_dedup": query}
ORACLE_SQL = {
    "op1_substring_dedup": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
win AS (SELECT doc_id, i, sha256(array_to_string(words[i:i + 19], ' ')) AS h FROM w, unnest(range(1, len(words) - 18)) AS t(i)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS k FROM win) WHERE k > 1),
edges AS (SELECT doc_id, i AS place, 1 AS step FROM later UNION ALL SELECT doc_id, i + 20, -1 FROM later),
steps AS (SELECT doc_id, place, sum(step) AS step FROM edges GROUP BY ALL),
level AS (SELECT doc_id, place, sum(step) OVER (PARTITION BY doc_id ORDER BY place) AS open, lead(place) OVER (PARTITION BY doc_id ORDER BY place) AS until FROM steps),
gone AS (SELECT doc_id, list({'a': place, 'b': until} ORDER BY place) AS runs FROM (SELECT doc_id, place, until FROM level WHERE open > 0) GROUP BY doc_id),
kept AS (SELECT w.doc_id, words, CASE WHEN runs IS NULL THEN words ELSE flatten(list_transform(range(0, len(runs) + 1),
    lambda k: words[CASE WHEN k = 0 THEN 1 ELSE runs[k].b END : CASE WHEN k = len(runs) THEN len(words) ELSE runs[k + 1].a - 1 END])) END AS stay
  FROM w LEFT JOIN gone g ON g.doc_id = w.doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - len(stay))::BIGINT AS n_removed, sha256(array_to_string(stay, ' ')) AS kept_sha256 FROM kept
""",
}
