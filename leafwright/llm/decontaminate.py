"""Benchmark decontamination by a distributed positional inverted index.

The index is cut by documents: each row is a segment, about half a megabyte of text, with
the sorted terms of its documents and, for each term, the sorted positions at which it
stands. It is stored in the shared folder and can be searched again; every later step
reads postings, not texts.

How often each term stands in the whole index is counted over the stored lists, and each
phrase is filed under its rarest term; a phrase with a term that stands nowhere is done.
Within a segment only the phrases filed under a term of that segment are asked, so its work
follows its own terms and not the number of phrases. Such a phrase's lists are looked up;
if any is empty it is done; otherwise the shortest list, shifted by its term's place in
the phrase, gives the candidate starts, which are intersected with the other lists,
shifted likewise, from rare to frequent. No posting is shuffled, and one very frequent term
costs no more than its own lists, which rarer terms cut first.

Phrases are not broadcast: they are written to the shared folder in blocks of bounded
size, and each task reads a block once for all segments of a batch.

Words: A-Z in lower case, then runs of ASCII letters, digits and anything beyond ASCII.
Null and empty texts have no words and no hits. Items without words or id are not
searched; rows that share an item id are one item. A document is a row.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.llm.common import ALNUM_SPLIT, flat, mapped, pieces, read_table, resident, scan_words, shared_dir

WINDOW = 8
#: An item counts towards contamination from this many items on.
MIN_ITEMS = 2
#: Phrases in a block of the query set.
BLOCK_PHRASES = 100_000
#: Segments in a row group of the stored index, which a reader holds at a time.
GROUP_SEGMENTS = 16
#: How many words a proximity match may lie to either side of its phrase's leading word.
SLACK = 2 * WINDOW
#: Candidate starts that are intersected at a time.
CANDIDATES = 1 << 20

SEGMENT = "keys binary, first binary, terms binary, counts binary, positions binary"


def build_index(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row a segment: document keys with a null flag, first word of each, sorted terms, list lengths, positions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                words = scan_words(part.column(1), ALNUM_SPLIT, lower=True)
                order = np.argsort(words.hash, kind="stable")
                ranked = words.hash[order]
                edges = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.zeros(0, np.int64)
                counts = np.diff(np.append(edges, len(ranked))).astype("<u4")
                keys = np.asarray(part.column(0).fill_null(0), "<i8").tobytes() + np.asarray(part.column(0).is_valid()).tobytes()
                row = [keys, words.first.astype("<i8").tobytes(), ranked[edges].astype("<u8").tobytes(), counts.tobytes(), order.astype("<u4").tobytes()]
                yield pa.record_batch([pa.array([x], pa.binary()) for x in row], names=["keys", "first", "terms", "counts", "positions"])

    given = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return mapped(given, run, SEGMENT)


def stored_index(index: DataFrame) -> DataFrame:
    """The same segments, written to the shared folder and read back from there."""
    spark = index.sparkSession
    folder = f"{shared_dir(spark)}/postings/{uuid.uuid4().hex}"
    index.write.option("compression", "zstd").option("parquet.enable.dictionary", "false").option("parquet.block.row.count.limit", GROUP_SEGMENTS).parquet(folder)
    return spark.read.schema(index.schema).parquet(folder)


def term_counts(index: DataFrame) -> DataFrame:
    """(term, n): how often each term stands in the whole index; a batch is summed before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, counts = (np.frombuffer(b"".join(c.to_pylist()), kind) for c, kind in zip(batch.columns, ("<u8", "<u4"), strict=True))
            order = np.argsort(terms, kind="stable")
            ranked = terms[order]
            edges = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.zeros(0, np.int64)
            n = np.add.reduceat(counts[order].astype(np.int64), edges) if len(ranked) else np.zeros(0, np.int64)
            yield pa.record_batch([pa.array(ranked[edges].view(np.int64)), pa.array(n)], names=["term", "n"])

    return mapped(index.select("terms", "counts"), run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


@dataclass
class Segment:
    """A segment in memory; ``listed`` holds every posting as term rank and position, in order."""

    keys: list
    first: np.ndarray
    terms: np.ndarray
    starts: np.ndarray
    positions: np.ndarray
    listed: np.ndarray

    @classmethod
    def read(cls, keys: bytes, first: bytes, terms: bytes, counts: bytes, positions: bytes) -> Segment:
        n = len(first) // 8 - 1
        ids, valid = np.frombuffer(keys, "<i8", n).tolist(), np.frombuffer(keys, bool, n, 8 * n).tolist()
        length, at = np.frombuffer(counts, "<u4").astype(np.int64), np.frombuffer(positions, "<u4")
        rank = np.repeat(np.arange(len(length), dtype=np.uint64) << np.uint64(32), length)
        starts = np.concatenate([[0], np.cumsum(length)])
        return cls([k if v else None for k, v in zip(ids, valid, strict=True)], np.frombuffer(first, "<i8"), np.frombuffer(terms, "<u8"), starts, at, rank | at)

    def ranks(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each term and the length of its list; 0 where the segment lacks it."""
        if not len(self.terms):
            return np.zeros(terms.shape, np.int64), np.zeros(terms.shape, np.int64)
        rank = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return rank, np.where(self.terms[rank] == terms, self.starts[rank + 1] - self.starts[rank], 0)

    def doc_of(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, position, "right") - 1

    def holds(self, rank: np.ndarray, position: np.ndarray) -> np.ndarray:
        wanted = (rank.astype(np.uint64) << np.uint64(32)) | position.astype(np.uint64)
        at = np.minimum(np.searchsorted(self.listed, wanted), len(self.listed) - 1)
        return self.listed[at] == wanted

    def candidates(self, rank: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(phrase, position) over the lists of one term for each phrase, in bounded runs; a longer list is cut."""
        total = np.cumsum(counts)
        n = int(total[-1]) if len(total) else 0
        for lo in range(0, n, CANDIDATES):
            k = np.arange(lo, min(n, lo + CANDIDATES))
            phrase = np.searchsorted(total, k, "right")
            yield phrase, self.positions[self.starts[rank[phrase]] + k - (total[phrase] - counts[phrase])].astype(np.int64)

    def phrases(self, terms: np.ndarray, length: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(phrase, start) of every exact occurrence; terms is padded to the right, length has the true lengths."""
        rank, counts = self.ranks(terms)
        inside = np.arange(terms.shape[1])[None, :] < length[:, None]
        alive = np.flatnonzero(((counts > 0) | ~inside).all(1))
        rank, counts, size = rank[alive], np.where(inside, counts, 1 << 40)[alive], length[alive]
        order = np.argsort(counts, axis=1, kind="stable")
        pick = np.arange(len(alive))
        rarest = order[:, 0]
        for phrase, position in self.candidates(rank[pick, rarest], counts[pick, rarest]):
            start = position - rarest[phrase]
            keep = (start >= 0) & (start + size[phrase] <= self.first[-1])
            phrase, start = phrase[keep], start[keep]
            keep = self.doc_of(start) == self.doc_of(start + size[phrase] - 1)
            phrase, start = phrase[keep], start[keep]
            for step in range(1, terms.shape[1]):
                place = order[phrase, step]
                keep = (place >= size[phrase]) | self.holds(rank[phrase, place], np.where(place < size[phrase], start + place, 0))
                phrase, start = phrase[keep], start[keep]
            yield alive[phrase], start

    def near(self, terms: np.ndarray, length: np.ndarray, lead: np.ndarray, slack: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(phrase, position of its leading term) where every term stands within ``slack`` words of it in the same document."""
        rank, counts = self.ranks(terms)
        inside = np.arange(terms.shape[1])[None, :] < length[:, None]
        alive = np.flatnonzero(((counts > 0) | ~inside).all(1))
        rank, counts, size, lead = rank[alive], np.where(inside, counts, 1 << 40)[alive], length[alive], lead[alive]
        pick = np.arange(len(alive))
        listed = counts[pick, lead]
        counts[pick, lead] = 0
        order = np.argsort(counts, axis=1, kind="stable")
        for phrase, position in self.candidates(rank[pick, lead], listed):
            for step in range(1, terms.shape[1]):
                place = order[phrase, step]
                doc = self.doc_of(position)
                lo, hi = np.maximum(position - slack, self.first[doc]), np.minimum(position + slack, self.first[doc + 1] - 1)
                shifted = rank[phrase, place].astype(np.uint64) << np.uint64(32)
                keep = (place >= size[phrase]) | (np.searchsorted(self.listed, shifted | lo.astype(np.uint64)) < np.searchsorted(self.listed, shifted | hi.astype(np.uint64), "right"))
                phrase, position = phrase[keep], position[keep]
            yield alive[phrase], position


def phrases_of(items: DataFrame, text: str = "text", key: str = "item_id", window: int = WINDOW) -> DataFrame:
    """(item, length, terms): the distinct windows of each item; one window of fewer words for a shorter item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = scan_words(batch.column(1), ALNUM_SPLIT, lower=True)
            values = words.hash.view(np.int64).tolist()
            out = set()
            for k, item in enumerate(batch.column(0).to_pylist()):
                own = values[words.first[k] : words.first[k + 1]]
                out.update((item, tuple(own[at : at + window])) for at in range(max(1, len(own) - window + 1) if own else 0))
            rows = sorted(out)
            yield pa.record_batch([pa.array([x[0] for x in rows], pa.string()), pa.array([len(x[1]) for x in rows], pa.int32()), pa.array([x[1] for x in rows], pa.list_(pa.int64()))], names=["item", "length", "terms"])

    given = items.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("item"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return mapped(given, run, "item string, length int, terms array<long>").distinct()


def led_by_rarest(phrases: DataFrame, index: DataFrame) -> DataFrame:
    """Phrases all of whose terms stand in the index, with ``lead``: the place of the term that is rarest in all of it, the first of ties."""
    each = phrases.select("item", "length", "terms", F.posexplode("terms").alias("place", "term"))
    met = each.join(term_counts(index), "term").groupBy("item", "length", "terms").agg(F.min(F.struct("n", "place")).alias("rarest"), F.count(F.lit(1)).alias("met"))
    return met.where(F.col("met") == F.col("length")).select("item", "length", "terms", F.col("rarest.place").alias("lead"))


def stored_phrases(phrases: DataFrame) -> str:
    """Writes the phrases in blocks to the shared folder; returns the folder. Without ``lead`` a phrase is filed under its first term."""
    folder = f"{shared_dir(phrases.sparkSession)}/phrases/{uuid.uuid4().hex}"
    led = phrases if "lead" in phrases.columns else phrases.withColumn("lead", F.lit(0))
    led.write.option("maxRecordsPerFile", BLOCK_PHRASES).parquet(folder)
    return folder


@dataclass
class Block:
    """Phrases in the order of their leading terms: items, true lengths, terms padded to the right, places and values of the leading terms."""

    items: list[str]
    length: np.ndarray
    terms: np.ndarray
    lead: np.ndarray
    leading: np.ndarray

    def asked(self, terms: np.ndarray) -> np.ndarray:
        """Phrases whose leading term is one of the terms given."""
        lo, hi = np.searchsorted(self.leading, terms, "left"), np.searchsorted(self.leading, terms, "right")
        n = hi - lo
        return np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


@resident(maxsize=4)
def _block(folder: str, path: str) -> Block:
    store, _ = pafs.FileSystem.from_uri(folder)
    rows = pq.read_table(path, filesystem=store)
    length, lead = np.asarray(rows["length"], np.int64), np.asarray(rows["lead"], np.int64)
    terms = np.zeros((len(length), int(length.max(initial=1))), np.uint64)
    terms[np.arange(terms.shape[1]) < length[:, None]] = np.asarray(flat(rows["terms"]).flatten()).view(np.uint64)
    leading = terms[np.arange(len(length)), lead]
    order = np.argsort(leading, kind="stable")
    items = rows["item"].to_pylist()
    return Block([items[k] for k in order.tolist()], length[order], terms[order], lead[order], leading[order])


@resident(maxsize=4)
def _blocks(folder: str) -> list[str]:
    store, root = pafs.FileSystem.from_uri(folder)
    return sorted(x.path for x in store.get_file_info(pafs.FileSelector(root)) if x.path.endswith(".parquet"))


def _segments(batch: pa.RecordBatch) -> list[Segment]:
    return [Segment.read(*row) for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)]


def _note(found: list[set], doc: np.ndarray, phrase: np.ndarray, items: list[str]) -> None:
    for d, p in np.unique(np.stack([doc, phrase]), axis=1).T.tolist():
        found[d].add(items[p])


def _listed(found: list[set]) -> pa.Array:
    return pa.array([sorted(x) for x in found], pa.list_(pa.string()))


def search(index: DataFrame, phrases: str, slack: int | None = None) -> DataFrame:
    """(doc_id, n_words, n_hit, items, near) of every document: words inside an occurrence, and the items that occur, sorted.

    With ``slack``, near lists the items that ``search_near`` finds; without, it is empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segments = _segments(batch)
            edges = [np.zeros(int(x.first[-1]) + 1, np.int64) for x in segments]
            found, close = ([[set() for _ in x.keys] for x in segments] for _ in range(2))
            for path in _blocks(phrases):
                block = _block(phrases, path)
                for segment, edge, items, near in zip(segments, edges, found, close, strict=True):
                    own = block.asked(segment.terms)
                    for phrase, start in segment.phrases(block.terms[own], block.length[own]) if len(own) else ():
                        np.add.at(edge, start, 1)
                        np.add.at(edge, start + block.length[own[phrase]], -1)
                        _note(items, segment.doc_of(start), own[phrase], block.items)
                    for phrase, position in segment.near(block.terms[own], block.length[own], block.lead[own], slack) if len(own) and slack is not None else ():
                        _note(near, segment.doc_of(position), own[phrase], block.items)
            for segment, edge, items, near in zip(segments, edges, found, close, strict=True):
                hit = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
                yield pa.record_batch(
                    [pa.array(segment.keys, pa.int64()), pa.array(np.diff(segment.first)), pa.array(np.diff(hit[segment.first]).astype(np.int64)), _listed(items), _listed(near)],
                    names=["doc_id", "n_words", "n_hit", "items", "near"],
                )

    return mapped(index, run, "doc_id long, n_words long, n_hit long, items array<string>, near array<string>")


def search_near(index: DataFrame, phrases: str, slack: int = SLACK) -> DataFrame:
    """(doc_id, items): items of which a window's words all stand within ``slack`` words of its leading one, in any order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segments = _segments(batch)
            found = [[set() for _ in x.keys] for x in segments]
            for path in _blocks(phrases):
                block = _block(phrases, path)
                for segment, items in zip(segments, found, strict=True):
                    own = block.asked(segment.terms)
                    for phrase, position in segment.near(block.terms[own], block.length[own], block.lead[own], slack) if len(own) else ():
                        _note(items, segment.doc_of(position), own[phrase], block.items)
            for segment, items in zip(segments, found, strict=True):
                yield pa.record_batch([pa.array(segment.keys, pa.int64()), _listed(items)], names=["doc_id", "items"])

    return mapped(index, run, "doc_id long, items array<string>")


def occurrences(docs: DataFrame, phrases: DataFrame, slack: int | None = None) -> DataFrame:
    """``search`` over a stored index of the documents, phrases filed under their rarest terms."""
    index = stored_index(build_index(docs))
    return search(index, stored_phrases(led_by_rarest(phrases, index)), slack)


def report(docs: DataFrame, items: DataFrame, slack: int | None = None) -> DataFrame:
    """Per document: words, hit words, items that occur and whether they are enough to call it contaminated.

    With ``slack`` also n_near: items with a window of which all words stand within that many words of its rarest
    (in all documents; the first of ties), in any order.
    """
    found = occurrences(docs, phrases_of(items), slack)
    n = F.size("items").cast("long")
    near = [] if slack is None else [F.size("near").cast("long").alias("n_near")]
    return found.select("doc_id", "n_words", "n_hit", n.alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n >= MIN_ITEMS).alias("contaminated"), *near)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), SLACK)


def _split(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({k: k + 32 for k in range(65, 91)}))


def brute_near(docs: list[tuple], items: list[tuple], slack: int) -> list[int]:
    """n_near of each document by the rule as it is written, for tests."""
    split = [_split(text) for _, text in docs]
    often = Counter(w for own in split for w in own)
    windows = {(str(k), tuple(w[i : i + WINDOW])) for k, x in items if (w := _split(x)) and k is not None for i in range(max(1, len(w) - WINDOW + 1))}
    out = []
    for own in split:
        seen = set()
        for item, phrase in windows:
            lead = min(phrase, key=lambda w: often[w])
            if any(w == lead and set(phrase) <= set(own[max(0, at - slack) : at + slack + 1]) for at, w in enumerate(own)):
                seen.add(item)
        out.append(len(seen))
    return out


def brute_force(docs: list[tuple], items: list[tuple]) -> list[tuple]:
    """The report by the rule as it is written, for tests."""
    windows = {(k, tuple(w[i : i + WINDOW])) for k, x in items if (w := _split(x)) and k is not None for i in range(max(1, len(w) - WINDOW + 1))}
    by_first: dict = {}
    for k, w in windows:
        by_first.setdefault(w[0], []).append((str(k), w))
    out = []
    for key, text in docs:
        w = _split(text)
        hit, seen = set(), set()
        for at, word in enumerate(w):
            for item, phrase in by_first.get(word, ()):
                if tuple(w[at : at + len(phrase)]) == phrase:
                    hit.update(range(at, at + len(phrase)))
                    seen.add(item)
        out.append((key, len(w), len(hit), len(seen), hashlib.sha256(",".join(sorted(seen)).encode()).hexdigest(), len(seen) >= MIN_ITEMS))
    return out


QUERIES = {"op9_decontaminate": query}
ORACLE_SQL = {
    "op9_decontaminate": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
q AS (SELECT DISTINCT item_id, array_to_string(w[i:i + least(len(w), 8) - 1], ' ') AS phrase, least(len(w), 8) AS n
  FROM b, unnest(range(1, greatest(len(w) - 7, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM q),
pos AS (SELECT doc_id, s.n AS n, i, array_to_string(w[i:i + s.n - 1], ' ') AS phrase FROM d, sizes s, unnest(range(1, len(w) - s.n + 2)) AS t(i)),
occ AS (SELECT a.doc_id, q.item_id, a.i, a.n FROM pos a JOIN q ON a.n = q.n AND a.phrase = q.phrase),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM occ, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM occ) GROUP BY doc_id),
often AS (SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM d) GROUP BY word),
leads AS (SELECT item_id, phrase, word FROM (SELECT item_id, phrase, p.word AS word, row_number() OVER (PARTITION BY item_id, phrase ORDER BY o.n, p.place) AS k
  FROM q, unnest(list_zip(string_split(phrase, ' '), range(len(string_split(phrase, ' '))))) AS t(z), (SELECT z[1] AS word, z[2] AS place) AS p JOIN often o ON o.word = p.word) WHERE k = 1),
spots AS (SELECT doc_id, w[i] AS word, i FROM d, unnest(range(1, len(w) + 1)) AS t(i)),
near AS (SELECT s.doc_id, count(DISTINCT l.item_id::VARCHAR) AS n_near FROM leads l JOIN spots s ON s.word = l.word JOIN d ON d.doc_id = s.doc_id
  WHERE list_has_all(d.w[greatest(1, s.i - 16):s.i + 16], string_split(l.phrase, ' ')) GROUP BY s.doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(i.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(i.listed, '')) AS items_sha256, coalesce(i.n_items, 0) >= 2 AS contaminated, coalesce(r.n_near, 0)::BIGINT AS n_near
FROM d LEFT JOIN hits h ON d.doc_id = h.doc_id LEFT JOIN items i ON d.doc_id = i.doc_id LEFT JOIN near r ON d.doc_id = r.doc_id
""",
}
