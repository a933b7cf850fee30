"""Each operator against its rule as written, over texts that are null, empty, odd, long, equal and nearly equal."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from leafwright.llm import byte_bpe, decontaminate, embedding_dedup, line_dedup, minhash_dedup, pretokens, secret_scan, substring_dedup, token_files
from leafwright.llm.common import least_labels, shared_dir
from leafwright.llm.components import components


def by_id(frame) -> dict:
    return {r["doc_id"]: tuple(r)[1:] for r in frame.collect()}


def test_substring_dedup(docs, rows):
    from pyspark.sql import functions as F

    found = by_id(substring_dedup.remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)))
    assert found == substring_dedup.brute_force([r[:2] for r in rows])


def test_recompression_depends_on_its_span_only():
    r = np.random.default_rng(1)
    words = r.integers(0, 4, 3000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    first = np.array([0, 1000, 1000, 3000])
    symbols = substring_dedup.recompressed(words, first)
    assert (np.diff(symbols.lo) >= 0).all() and (np.diff(symbols.hi) >= 0).all()
    assert symbols.start[0] == 0 and (symbols.start[1:] == symbols.end[:-1]).all() and symbols.end[-1] == 3000
    for k in range(0, len(symbols.name), 7):
        lo, hi = symbols.lo[k], symbols.hi[k]
        if lo < 0 or hi > 1000 and symbols.doc[k] == 0 or hi > 3000 or lo < first[symbols.doc[k]]:
            continue
        around = np.concatenate([r.integers(5, 9, 10).astype(np.uint64), words[lo:hi], r.integers(5, 9, 10).astype(np.uint64)])
        again = substring_dedup.recompressed(around, np.array([0, len(around)]))
        assert (symbols.name[k], symbols.start[k] - lo + 10) in set(zip(again.name, again.start, strict=True))


def test_secret_scan(docs, rows):
    found = by_id(secret_scan.digests(docs).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256"))
    assert found == {r[0]: secret_scan.brute_force(r[1]) for r in rows}
    assert found[18][:2] == (2, 1) and found[19][2] == 1


def test_secret_candidates_are_whole_runs():
    head, letters = "abcdefghijklmnopqrstuvwxyzABCDEFGH1234567890", "QwErTyUiOpAsDfGhJkLzXcVbNmQwErTyUiOpAsDf"
    for run in (head, letters, "a" * 16):
        assert secret_scan.further_spans(f"key {run}, etc.", []) == [(4, 4 + len(run))]
    assert secret_scan.further_spans("key " + "a" * 15, []) == []
    assert secret_scan.further_spans(f"my_client_key={letters}", []) == [(14, 54)]
    assert secret_scan.further_spans(f"see {letters} {letters}", [(4, 10, "assign")]) == [(45, 85)]


def test_views_show_every_character():
    for n in (1, 39, 40, 41, 60, 61, 400):
        text = "before " + "".join(chr(33 + k % 90) for k in range(n)) + " after"
        rows = secret_scan.views(text, 7, 7 + n)
        inside = [bytes(r[secret_scan.BEFORE : secret_scan.BEFORE + secret_scan.INSIDE]).rstrip(b"\0").decode() for r in rows]
        places = [7 if k == 0 else text.index(x, 0) for k, x in enumerate(inside)] if n <= 90 else [7 + k * 20 for k in range(len(inside) - 1)] + [7 + n - 40]
        assert {p + k for p, x in zip(places, inside, strict=True) for k in range(len(x))} == set(range(7, 7 + n))
        assert bytes(rows[0][: secret_scan.BEFORE]).lstrip(b"\0") == b"before " and bytes(rows[-1][-secret_scan.AFTER :]).rstrip(b"\0") == b" after"


def test_secret_network_on_unseen_findings():
    net = secret_scan.train()
    x, y = secret_scan.labelled_findings(2000, 99)
    found = net.probability(x) >= net.threshold
    assert found[y > 0].mean() >= 0.94 and found[y == 0].mean() <= 0.01


def test_secret_network_gradient():
    net = secret_scan.CharCnn()
    found, y = secret_scan.labelled_findings(8, 3)
    x, y = np.concatenate(found), np.repeat(y, [len(v) for v in found])
    g = net._gradient(x, y)
    loss = lambda: float(np.mean(np.log1p(np.exp(-np.where(y > 0, 1, -1) * net._forward(x)[4]))))
    for name in ("w", "v", "b"):
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        old = net.p[name][at]
        net.p[name][at] = old + 1e-5
        high = loss()
        net.p[name][at] = old - 1e-5
        low = loss()
        net.p[name][at] = old
        assert abs((high - low) / 2e-5 - g[name][at]) < 1e-4


def test_embedding_dedup(spark):
    r = np.random.default_rng(2)
    base = r.normal(size=(6, 16))
    vectors = [(k, (base[k % 6] + r.normal(size=16) * (0.02 if k % 3 else 0.4)).astype(np.float32).tolist(), k % 2) for k in range(60)]
    vectors += [(100, vectors[0][1], 0), (101, vectors[0][1], 0), (102, vectors[0][1], None), (103, None, 0), (104, [0.0] * 16, 0), (105, [float("nan")] + [1.0] * 15, 0), (106, [None] + [1.0] * 15, 0), (107, [1.0, 2.0], 0), (108, [2.0, 4.0], 0), (109, [], 0), (110, [float("inf")] * 16, 1)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS n", "2 AS class_id", "3 AS bucket")
    found = {x[0]: (x[1], x[2]) for x in embedding_dedup.near_duplicates(frame).collect()}
    assert found == embedding_dedup.brute_force([(k, None if v is None else [x if x is None else float(np.float32(x)) for x in v], y) for k, v, y in vectors])
    twice = embedding_dedup.near_duplicates(frame.union(frame.where("vec_id = 0"))).where("vec_id = 0").collect()
    assert len(twice) == 2 and {x[1] for x in twice} == {found[0][0]}


def test_embedding_blocks(spark, monkeypatch):
    r = np.random.default_rng(3)
    base = r.normal(size=8)
    vectors = [(k, (base + r.normal(size=8) * 0.35).tolist(), 1) for k in range(80)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int")
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    found = {x[0]: (x[1], x[2]) for x in embedding_dedup.near_duplicates(frame).collect()}
    want = embedding_dedup.brute_force(vectors)
    links = sum(x[0] for x in want.values())
    assert sum(x[0] for x in found.values()) >= 0.999 * links and links > 100


def test_line_dedup(docs, rows):
    found = by_id(line_dedup.digests(docs))
    count = {}
    lower = {k: k + 32 for k in range(65, 91)}
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(lower)
    for k, text, *_ in rows:
        for x in {key(x) for x in (text or "").split("\n")}:
            count.setdefault(x, set()).add(k)
    for k, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 20 and len(count[key(x)]) >= 3 and k != max(count[key(x)]))]
        assert found[k] == (len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    assert found[20][1] == found[21][1] == 1 and found[22][1] == 0


def test_line_keys_lose_blanks_and_no_letters(spark):
    """Lines of 20 and 21 code points with f at an end, lines that differ by a form feed, lines that differ by an f."""
    lines = ["f" + "a" * 19, "b" * 19 + "f", "f" + "c" * 20, "d" * 20 + "f", "F" + "e" * 18 + "f", "f" + "g" * 18, "\x0c" + "h" * 20, "\x0c" + "i" * 19]
    rows = [(k, "\n".join(lines)) for k in range(3)]
    rows += [(3 + k, end + "for all that is said in here" + end) for k, end in enumerate(["", "\x0c", "\x0c \x0c"])]
    rows += [(6 + k, x) for k, x in enumerate(["for one and the same line", "or one and the same line", "for one and the same linef"])]
    found = by_id(line_dedup.digests(spark.createDataFrame(rows, "doc_id long, text string")))
    assert [found[k][1] for k in range(9)] == [6, 6, 0, 1, 1, 0, 0, 0, 0]


def test_line_dedup_can_be_undone(spark, docs):
    whole = line_dedup.LineIndex.build(docs)
    half = line_dedup.LineIndex.build(docs.where("doc_id % 2 = 0"))
    grown = half.insert(docs.where("doc_id % 2 = 1"))
    state = lambda index: sorted(map(tuple, index.references.collect()))
    assert state(grown) == state(whole)
    assert state(grown.delete(docs.where("doc_id % 2 = 1"))) == state(half)
    assert by_id(grown.decide(docs)) == by_id(whole.decide(docs))
    assert whole.delete(docs).references.count() == 0
    assert by_id(line_dedup.LineIndex.empty(spark).insert(docs).decide(docs)) == by_id(whole.decide(docs))


def test_line_dedup_in_more_shards(spark, docs, monkeypatch):
    want = by_id(line_dedup.digests(docs))
    monkeypatch.setattr(line_dedup, "SHARDS", 1)
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 4)
    whole = line_dedup.LineIndex.build(docs)
    assert whole.shards >= 8 and by_id(line_dedup.digests(docs)) == want
    grown = line_dedup.LineIndex.build(docs.where("doc_id < 2")).insert(docs)
    assert grown.shards == whole.shards and by_id(grown.decide(docs)) == by_id(whole.decide(docs))


def test_line_dedup_rows_of_one_document(spark):
    """Rows that share a doc_id are one document, and so are those without one."""
    line = "a line that is long enough"
    rows = [(1, line), (1, line), (1, line + "\nx"), (2, line + "\n" + line), (None, line), (None, "y\n" + line)]
    found = line_dedup.digests(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS h1", "'s' AS shard", "2 AS last_doc")).collect()
    assert sorted((r["doc_id"] or 0, r["n_lines"], r["n_dropped"]) for r in found) == [(0, 1, 1), (0, 2, 1), (1, 1, 1), (1, 1, 1), (1, 2, 1), (2, 2, 0)]
    twice = line_dedup.digests(spark.createDataFrame(rows[:4], "doc_id long, text string")).collect()
    assert all(r["n_dropped"] == 0 for r in twice)


def test_cuckoo_filter():
    r = np.random.default_rng(4)
    keys = r.integers(-(2**62), 2**62, 5000)
    held = line_dedup.CuckooFilter(64)
    held.insert(keys)
    held = line_dedup.CuckooFilter.from_bytes(held.to_bytes())
    held.insert(keys[:40])
    held.delete(keys[:40])
    assert held.contains(keys).all() and len(held.tables) > 1
    assert held.contains(r.integers(-(2**62), 2**62, 20000)).mean() < 0.01
    held.delete(keys[:2500])
    assert held.contains(keys[2500:]).all() and held.contains(keys[:2500]).mean() < 0.01


def test_token_files(spark, docs, rows, tmp_path):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    folder = str(tmp_path / "tokens")
    files = token_files.write_files(token_files.encode_documents(token_files.in_key_order(docs, files=3)), folder)
    found = by_id(token_files.read_digests(spark, files, folder))
    at, want = 0, {}
    for k, text, *_ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, token_files.END_ID]
        want[k] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert found == want
    store, _ = token_files.filesystem(folder)
    with store.open_input_file(files[0][1]) as source:
        reader = token_files.FrameReader(source)
        ids = reader.lookup(5)[0] if 5 in reader.keys else reader.document(0)
        assert ids[-1] == token_files.END_ID
    import zstandard

    with open(files[0][1], "rb") as f:
        raw = f.read()
    content = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert len(content) // 2 == files[0][3]
    damaged = bytearray(raw)
    damaged[8] ^= 0xFF
    (tmp_path / "bad.zst").write_bytes(bytes(damaged))
    with store.open_input_file(str(tmp_path / "bad.zst")) as source, pytest.raises(Exception):  # noqa: B017
        token_files.FrameReader(source).document(0)


def test_byte_bpe(docs, rows):
    bpe = byte_bpe.load(byte_bpe.DEFAULT_RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    found = by_id(byte_bpe.digests(docs))
    for k, text, *_ in rows:
        ids = np.array(library.encode_ordinary(text or ""), "<u4")
        assert found[k] == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def test_byte_bpe_on_random_bytes():
    import random

    bpe = byte_bpe.load(byte_bpe.DEFAULT_RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    r = random.Random(8)
    for _ in range(1500):
        text = "".join(r.choice("aaaaeinrst  \n0'-_éß它\U0001f600") for _ in range(60))
        assert np.frombuffer(bpe.encode(text), "<u4").tolist() == library.encode_ordinary(text)
        assert bpe.decode(bpe.encode(text)) == text.encode()


def twins() -> tuple[str, str]:
    """Two words of 1,024 letters that agree in every polynomial hash modulo 2**64 with an odd base."""
    swap, word = str.maketrans("ab", "ba"), "a"
    for _ in range(10):
        word += word.translate(swap)
    return word, word.translate(swap)


def test_pieces_with_equal_hashes_keep_their_ids(monkeypatch):
    a, b = twins()
    texts = [a, b, f"x {b} y {a}", f"{a}{b}", a]
    bpe = byte_bpe.load(byte_bpe.DEFAULT_RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    tokenizer, own = Tokenizer.from_file(token_files.DEFAULT_TOKENIZER), token_files.PieceEncoder(token_files.DEFAULT_TOKENIZER)
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in bpe.encode_all(texts)] == [library.encode_ordinary(x) for x in texts]
        assert [np.frombuffer(x, "<u2").tolist() for x in own.encode_all(texts)] == [[*tokenizer.encode(x, add_special_tokens=False).ids, 2] for x in texts]
    whole = pretokens.scan

    def crowded(given):
        found = whole(given)
        found.hash = found.hash % np.uint64(7)
        return found

    monkeypatch.setattr(byte_bpe, "scan", crowded)
    fresh = byte_bpe.ByteBpe(bpe.ranks)
    short = [f"w{k} it's {k * 7919} the theirs" for k in range(60)]
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in fresh.encode_all(short)] == [library.encode_ordinary(x) for x in short]


def test_token_ids_of_added_tokens_are_the_librarys():
    tokenizer, own = Tokenizer.from_file(token_files.DEFAULT_TOKENIZER), token_files.PieceEncoder(token_files.DEFAULT_TOKENIZER)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  y\n", "<|endoftext", "", " <|endoftext|>'s  ", "plain"]
    assert [np.frombuffer(x, "<u2").tolist() for x in own.encode_all(texts)] == [[*tokenizer.encode(x, add_special_tokens=False).ids, 2] for x in texts]
    assert np.frombuffer(own.encode_all(texts[:1])[0], "<u2").tolist() == [64, 220, 50256, 275, 2]
    tokenizer.encode_special_tokens = True
    as_text = token_files.PieceEncoder(token_files.DEFAULT_TOKENIZER, names_as_text=True)
    assert [np.frombuffer(x, "<u2").tolist() for x in as_text.encode_all(texts)] == [[*tokenizer.encode(x, add_special_tokens=False).ids, 2] for x in texts]


def test_pieces_in_numpy_are_those_of_the_pattern(rows):
    import random

    r = random.Random(9)
    texts = [x[1] or "" for x in rows] + ["".join(r.choice("ab '\n\t éſ12²_-€½中\x1c\x85strelvmd") for _ in range(30)) for _ in range(3000)]
    found = pretokens.scan(texts)
    for k, text in enumerate(texts):
        own = [found.piece(i) for i in range(found.first[k], found.first[k + 1])]
        assert own == pretokens._PATTERN.findall(text) == pretokens.split(text)


def test_decontaminate(spark, docs, rows):
    words = rows[16][1].split()
    items = [(1, " ".join(words[100:130])), (2, "one"), (3, rows[5][1].upper()), (4, None), (5, "..."), (6, " ".join(words[40:47])), (6, " ".join(words[500:520])), (None, rows[6][1]), (7, "gamma gamma nowhere to be found at all here")]
    found = by_id(decontaminate.report(docs, spark.createDataFrame(items, "item_id long, text string")))
    assert found == {x[0]: x[1:] for x in decontaminate.brute_force([r[:2] for r in rows], items)}
    assert found[4][2] == 1 and found[16][4]


def test_decontaminate_near(spark, docs, rows):
    words = rows[16][1].split()
    mixed = words[200:203] + words[205:208] + words[203:205]
    items = spark.createDataFrame([(1, " ".join(mixed)), (2, "words that do not occur")], "item_id long, text string")
    index = decontaminate.build_index(docs)
    found = dict(decontaminate.search_near(index, decontaminate.stored_phrases(decontaminate.phrases_of(items)), 10).collect())
    assert found[16] == ["1"] and found[4] == []


def test_minhash_dedup(docs, rows):
    found = by_id(minhash_dedup.near_duplicates(docs))
    assert found == minhash_dedup.brute_force([r[:2] for r in rows])


def test_minhash_groups_in_blocks(spark, monkeypatch):
    import random

    r = random.Random(6)
    words = [f"w{r.randint(0, 400)}" for _ in range(150)]
    texts = []
    for k in range(200):
        own = list(words)
        for _ in range(k % 9):
            own[r.randrange(len(own))] = f"v{r.randint(0, 10**6)}"
        texts.append((k, " ".join(own)))
    monkeypatch.setattr(minhash_dedup, "BUCKET_BLOCK", 16)
    found = by_id(minhash_dedup.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")))
    assert found == minhash_dedup.brute_force(texts)


def test_odd_sketch_estimates():
    r = np.random.default_rng(12)
    for share in (0.98, 0.9, 0.8):
        a = np.unique(r.integers(0, 2**63, 2000, dtype=np.uint64))
        n = int(len(a) * 2 * share / (1 + share))
        b = np.unique(np.concatenate([a[:n], r.integers(0, 2**63, len(a) - n, dtype=np.uint64)]))
        folded = minhash_dedup.sketch(minhash_dedup.samples([a, b]))
        assert abs(minhash_dedup.estimate(folded[:1], folded[1:])[0, 0] - share) < 0.15


def test_components(spark):
    r = np.random.default_rng(13)
    pairs = [(int(a), int(b)) for a, b in r.integers(0, 300, (220, 2))] + [(k, k + 1) for k in range(1000, 1060)] + [(2000, k) for k in range(2001, 2040)]
    found = dict(components(spark.createDataFrame([*pairs, (None, 3), (4, 4)], "a long, b long")).collect())
    ids = sorted({x for p in pairs for x in p if p[0] != p[1]})
    place = {k: i for i, k in enumerate(ids)}
    good = [p for p in pairs if p[0] != p[1]]
    label = least_labels(len(ids), np.array([place[a] for a, _ in good]), np.array([place[b] for _, b in good]))
    assert found == {k: ids[label[i]] for i, k in enumerate(ids)}


def test_empty_tables(spark, none):
    assert substring_dedup.remove_repeats(none).count() == 0
    assert secret_scan.digests(none).count() == 0
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    assert line_dedup.digests(none).count() == 0
    assert byte_bpe.digests(none).count() == 0
    assert minhash_dedup.near_duplicates(none).count() == 0
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.report(none, items).count() == 0
    folder = f"{shared_dir(spark)}/none"
    files = token_files.write_files(token_files.encode_documents(token_files.in_key_order(none)), folder)
    assert files == [] and token_files.read_digests(spark, files, folder).count() == 0


def test_no_items(spark, docs, rows):
    found = by_id(decontaminate.report(docs, spark.createDataFrame([], "item_id long, text string")))
    assert len(found) == len(rows) and not any(x[1] for x in found.values())


def test_odd_columns_and_ids(spark, odd_docs):
    n = odd_docs.count()
    for frame in (substring_dedup.remove_repeats(odd_docs), secret_scan.digests(odd_docs), line_dedup.digests(odd_docs), byte_bpe.digests(odd_docs), minhash_dedup.near_duplicates(odd_docs)):
        assert len(frame.collect()) == n
    folder = f"{shared_dir(spark)}/odd"
    files = token_files.write_files(token_files.encode_documents(token_files.in_key_order(odd_docs)), folder)
    found = token_files.read_digests(spark, files, folder).collect()
    assert len(found) == n and sum(x["doc_id"] is None for x in found) == 1


def test_decontaminate_asks_phrases_under_their_rarest_term(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_PHRASES", 3)
    words = rows[16][1].split()
    items = [(1, " ".join(words[100:130])), (2, "one"), (3, rows[12][1]), (4, " ".join(words[40:47])), (5, "gamma gamma nowhere to be found at all here")]
    index = decontaminate.stored_index(decontaminate.build_index(docs))
    counts = dict(decontaminate.term_counts(index).collect())
    split = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1] or "")) for r in rows]
    assert sum(counts.values()) == sum(map(len, split)) and len(counts) == len({w for x in split for w in x})
    phrases = decontaminate.phrases_of(spark.createDataFrame(items, "item_id long, text string"))
    led = decontaminate.led_by_rarest(phrases, index)
    for x in led.collect():
        n = [counts[t] for t in x["terms"]]
        assert x["lead"] == n.index(min(n))
    assert "5" not in {x["item"] for x in led.collect()}
    found = {x["doc_id"]: x["items"] for x in decontaminate.search(index, decontaminate.stored_phrases(led)).collect()}
    wanted = {x[0]: x[3] for x in decontaminate.brute_force([r[:2] for r in rows], items)}
    assert {k: len(v) for k, v in found.items()} == wanted and any(wanted.values())


def test_decontaminate_odd_columns_and_ids(spark, odd_docs, rows):
    items = spark.createDataFrame([(1, rows[5][1]), (1, rows[5][1]), (None, rows[6][1])], "item_id long, text string").selectExpr("*", "1 AS terms", "2 AS lead", "3 AS item")
    found = decontaminate.report(odd_docs, items).collect()
    assert len(found) == odd_docs.count() and sum(x["doc_id"] is None for x in found) == 1
    hit = [x for x in found if x["doc_id"] == 5]
    assert len(hit) == 3 and all(x["n_hit"] == x["n_words"] and x["n_items"] == 1 for x in hit)


def test_decontaminate_counts_near_items(spark, docs, rows):
    words = rows[16][1].split()
    mixed = words[200:203] + words[205:208] + words[203:205]
    items = [(1, " ".join(mixed)), (2, "words that do not occur"), (3, rows[12][1]), (4, " ".join(words[300:303] + words[900:905])), (5, "one"), (None, "one"), (6, None)]
    found = by_id(decontaminate.report(docs, spark.createDataFrame(items, "item_id long, text string"), 10))
    wanted = decontaminate.brute_near([r[:2] for r in rows], items, 10)
    assert [found[r[0]][-1] for r in rows] == wanted and found[4][-1] == 1 and wanted[16]
