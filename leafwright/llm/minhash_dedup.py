"""MinHash near-dedup with odd sketches.

A document's set holds the hashes of its distinct shingles of five words (all words as one
shingle if there are fewer). Documents of equal sets form a class, and only a class's
smallest doc_id goes on. Its MinHash samples make bands of ``ROWS``, and are folded into an
odd sketch: each sample flips one bit. Two sketches differ in about as many bits as
samples differ, and from the population count z of their XOR over n bits

    samples that differ = -n / 4 ln(1 - 2 z / n),   similarity = 1 - that / samples

which is most precise where similarities are high. Within a band's bucket, pairs whose
estimate is at most ``MARGIN`` points under the threshold tie their documents to one candidate group. A group's full
sets then meet, in pairs of blocks, and links are confirmed by exact intersection sizes.

The threshold sets the number of bands: a pair of just that similarity shares some band
but for ``MISS``. 0.85 takes 20 bands, 0.80 takes 28. Of the samples of such a pair, so many
differ that they fall under the margin with odds of 1.3e-8 at 0.85 and 1e-9 at 0.80. Candidates are never capped: a large bucket or group is dealt to
blocks, which are compared pairwise in separate tasks; what leaves a block is one row
for each document that joins another, not the pairs.

Null and empty texts have empty sets, are linked with nothing and stay. Rows that share a
doc_id are one document for grouping; a null doc_id is linked with nothing.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.llm.common import BLANK_SPLIT, checkpointed, groups, least_labels, mapped, mix, pieces, read_table, scan_words, window_hash
from leafwright.llm.components import components

SHINGLE = 5
#: A link: PERCENT * union <= 100 * intersection.
PERCENT = 85
BANDS, ROWS = 20, 4
#: Odds of missing a pair at the threshold; sets the number of bands for other thresholds.
MISS = 4e-7
SKETCH_WORDS = 16
#: Estimates count from so many points under the threshold.
MARGIN = 25
#: Documents in a block of a bucket.
BUCKET_BLOCK = 512
#: Cells of a block's document-by-shingle matrix that are multiplied at a time.
CELLS = 1 << 22


def bands_for(percent: int) -> int:
    """Bands that a pair of similarity ``percent`` misses with odds of ``MISS`` at most."""
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** ROWS))


@lru_cache(maxsize=4)
def _hashing(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and shifts of n samples."""
    r = np.random.default_rng(23)
    return r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), r.integers(0, 1 << 63, n, dtype=np.uint64)


def shingle_sets(text: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = scan_words(text, BLANK_SPLIT, lower=True)
    spans = window_hash(words.hash, SHINGLE)
    out = []
    for lo, hi in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if hi - lo >= SHINGLE:
            out.append(np.unique(spans[lo : hi - SHINGLE + 1]))
        else:
            out.append(window_hash(words.hash[lo:hi], hi - lo, seed=hi - lo + 2) if hi > lo else np.zeros(0, np.uint64))
    return out


def samples(sets: list[np.ndarray], bands: int = BANDS) -> np.ndarray:
    """MinHash samples of each set; the sets hold some hash each."""
    values = np.concatenate(sets)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    factor, shift = _hashing(bands * ROWS)
    out = np.empty((len(sets), bands * ROWS), np.uint64)
    for k in range(bands * ROWS):
        out[:, k] = np.minimum.reduceat((values ^ shift[k]) * factor[k], at)
    return out


def sketch(least: np.ndarray) -> np.ndarray:
    """The odd sketch of each row of samples, as 64-bit words."""
    bit = (mix(least ^ mix(np.arange(1, least.shape[1] + 1, dtype=np.uint64))[None, :]) % np.uint64(64 * SKETCH_WORDS)).astype(np.int64)
    flips = np.zeros((len(least), 64 * SKETCH_WORDS), np.uint8)
    np.add.at(flips, (np.arange(len(least))[:, None], bit), 1)
    return np.packbits(flips & 1, axis=1, bitorder="little").view("<u8")


def estimate(a: np.ndarray, b: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """Estimated similarity of each sketch of a with each of b."""
    n = 64 * SKETCH_WORDS
    differ = np.zeros((len(a), len(b)), np.int32)
    for k in range(SKETCH_WORDS):
        differ += np.bitwise_count(a[:, k, None] ^ b[None, :, k])
    odd = np.log(np.maximum(1 - 2 * np.arange(n + 1) / n, 1e-9)) * (-n / 4)
    return 1 - odd[differ] / (bands * ROWS)


def signatures(docs: DataFrame, n_bands: int = BANDS) -> DataFrame:
    """(doc_id, n_shingles, print, print2, bands, sketch) of each row; bands and sketch are null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                sets = shingle_sets(part.column(1))
                size = np.array([len(s) for s in sets], np.int64)
                some = np.flatnonzero(size)
                prints = [np.array([f(s) for s in sets], np.uint64).view(np.int64) for f in (lambda s: s.sum(dtype=np.uint64), lambda s: mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))]
                bands, sketches = [None] * len(sets), [None] * len(sets)
                if len(some):
                    least = samples([sets[k] for k in some], n_bands)
                    names = np.zeros((len(some), n_bands), np.uint64)
                    for r in range(ROWS):
                        names = mix(names * np.uint64(0x9E3779B97F4A7C15) + least[:, r::ROWS])
                    folded = sketch(least)
                    for row, k in enumerate(some.tolist()):
                        bands[k], sketches[k] = names[row].view(np.int64), folded[row].tobytes()
                columns = [part.column(0), pa.array(size), *map(pa.array, prints), pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.binary())]
                yield pa.record_batch(columns, names=["doc_id", "n_shingles", "print", "print2", "bands", "sketch"])

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return mapped(given, run, "doc_id long, n_shingles long, print long, print2 long, bands array<long>, sketch binary")


def _dealt(rows: DataFrame, keys: list[str], blocks, columns: list[str]) -> DataFrame:
    """Rows of groups, once for each pair of blocks that their block belongs to; ``blocks`` is the number in a group."""
    own = rows.withColumn("blocks", blocks.cast("int")).withColumn("block", F.pmod(F.xxhash64("doc_id"), "blocks").cast("int"))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keyed = dealt.select(*keys, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), *columns)
    return keyed.repartition(*keys, "i", "j").sortWithinPartitions(*keys, "i", "j")


def candidate_links(kept: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, root): documents tied to another one by a band and a high estimate."""
    n_bands, likely = bands_for(percent), (percent - MARGIN) / 100

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, 4):
            ids = np.asarray(rows["doc_id"])
            folded = np.frombuffer(b"".join(rows["sketch"].to_pylist()), "<u8").reshape(len(ids), -1)
            order = np.argsort(ids, kind="stable")
            ids, folded = ids[order], folded[order]
            a, b = np.nonzero(np.triu(estimate(folded, folded, n_bands) >= likely, 1))
            root = least_labels(len(ids), a, b)
            some = np.flatnonzero(root != np.arange(len(ids)))
            if len(some):
                yield pa.record_batch([pa.array(ids[some]), pa.array(ids[root[some]])], names=["doc_id", "root"])

    banded = kept.select("doc_id", F.posexplode("bands").alias("band", "name"))
    counts = checkpointed(banded.groupBy("band", "name").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    shared = checkpointed(banded.join(counts, ["band", "name"]))
    rows = shared.join(kept.select("doc_id", "sketch"), "doc_id")
    dealt = _dealt(rows, ["band", "name"], F.ceil(F.col("n") / BUCKET_BLOCK), ["doc_id", "sketch"])
    return mapped(dealt, run, "doc_id long, root long")


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by a product of the document-by-shingle matrix taken in slices of shingles."""
    size = np.array([len(s) for s in sets])
    values, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), size)
    shared = np.bincount(inverse) > 1
    column = np.cumsum(shared) - 1
    keep = shared[inverse]
    owner, column = owner[keep], column[inverse[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.float64)
    n = int(shared.sum())
    step = max(64, CELLS // max(1, len(sets)))
    for lo in range(0, n, step):
        a, b = np.searchsorted(column, [lo, lo + step])
        matrix = np.zeros((len(sets), min(step, n - lo)), np.float32)
        matrix[owner[a:b], column[a:b] - lo] = 1
        out += matrix @ matrix.T
    return out


def confirmed_links(docs: DataFrame, members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, root): links that hold on the full sets, among the members (doc_id, component_id) of candidate groups."""

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                yield pa.record_batch([part.column(0), part.column(2), part.column(3), pa.array([s.tobytes() for s in shingle_sets(part.column(1))], pa.binary())], names=["doc_id", "grouped", "n", "hashes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, 3):
            ids = np.asarray(rows["doc_id"])
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            raw = rows["hashes"].to_pylist()
            sets = [np.frombuffer(raw[k], np.uint64) for k in order.tolist()]
            if len(sets) < 2:
                continue
            both = intersections(sets)
            size = np.array([len(s) for s in sets])
            a, b = np.nonzero(np.triu((100 * both >= percent * (size[:, None] + size[None, :] - both)) & (both > 0), 1))
            root = least_labels(len(ids), a, b)
            some = np.flatnonzero(ids[root] != ids)
            if len(some):
                yield pa.record_batch([pa.array(ids[some]), pa.array(ids[root[some]])], names=["doc_id", "root"])

    counts = checkpointed(members.groupBy("component_id").agg(F.count(F.lit(1)).alias("n")))
    sized = checkpointed(members.join(counts, "component_id").select("doc_id", F.col("component_id").alias("grouped"), "n"))
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hashed = mapped(given.join(sized.hint("shuffle_hash"), "doc_id").select("doc_id", "text", "grouped", "n"), sets_of, "doc_id long, grouped long, n long, hashes binary")
    blocks = F.greatest(F.least(F.ceil(F.col("n") / 64), F.lit(32)), F.ceil(F.col("n") / 1024))
    return mapped(_dealt(hashed, ["grouped"], blocks, ["doc_id", "hashes"]), run, "doc_id long, root long")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id and whether it stays; ``percent`` is the least similarity of a link."""
    signed = checkpointed(signatures(docs, bands_for(percent)))
    usable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = checkpointed(usable.groupBy("print", "print2", "n_shingles").agg(F.min("doc_id").alias("class_id")))
    leads = classes.select("class_id", "print", "print2")
    members = usable.select("doc_id", "print", "print2").join(leads, ["print", "print2"]).select("doc_id", "class_id").distinct()
    kept = checkpointed(usable.join(leads, ["print", "print2"]).where("doc_id = class_id").select("doc_id", "bands", "sketch").dropDuplicates(["doc_id"]))
    likely = components(candidate_links(kept, percent)).withColumnRenamed("id", "doc_id")
    found = components(confirmed_links(docs, checkpointed(likely), percent))
    of_class = found.select(F.col("id").alias("class_id"), "component_id")
    of_doc = members.join(of_class, "class_id", "left").groupBy("doc_id").agg(F.min(F.coalesce("component_id", "class_id")).alias("component_id"))
    rows = signed.select("doc_id", "n_shingles").join(of_doc, "doc_id", "left")
    return rows.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def brute_force(rows: list[tuple], percent: int = PERCENT) -> dict[int, tuple[int, int, bool]]:
    """doc_id -> (n_shingles, component_id, kept) by the rule as it is written, for tests."""
    lower = {k: k + 32 for k in range(65, 91)}
    sets = {}
    for k, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        sets[k] = {tuple(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)} or ({tuple(w)} if w else set())
    root = {k: k for k in sets}

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    holders: dict = {}
    for k, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(k)
    shared: dict = {}
    for ks in holders.values():
        for i, a in enumerate(ks):
            for b in ks[:i]:
                shared[a, b] = shared.get((a, b), 0) + 1
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {k: (len(s), find(k), find(k) == k) for k, s in sets.items()}


QUERIES = {"op10_minhash_dedup": query}
ORACLE_SQL = {
    "op10_minhash_dedup": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, md5_number(array_to_string(words[i:i + 4], ' ')) AS h FROM w, unnest(range(1, greatest(len(words) - 4, least(len(words), 1)) + 1)) AS t(i)),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
half AS (SELECT a, b FROM shared x JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * x.n >= 85 * (p.n + q.n - x.n)),
links AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
reach(doc_id, root) USING KEY (doc_id) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT l.b, min(r.root) FROM reach r JOIN links l ON l.a = r.doc_id JOIN recurring.reach o ON o.doc_id = l.b WHERE r.root < o.root GROUP BY l.b)
SELECT d.doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, r.root AS component_id, r.root = d.doc_id AS kept FROM documents d JOIN reach r ON r.doc_id = d.doc_id LEFT JOIN sizes z ON z.doc_id = d.doc_id
""",
}
