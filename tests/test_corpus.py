"""Corpus, import, text and citation operators, the incremental build, and the entry points."""

import importlib
import sys

import pytest
from pyspark.sql import functions as F

from leafwright.operators import citations, corpus, imports, text, views
from leafwright.operators.articles import article_tables, parsed
from leafwright.sources import files, jats
from leafwright.streaming.build import build_available


@pytest.mark.parametrize(("said", "url", "basis"), [
    ("", "https://creativecommons.org/licenses/by/4.0/", "CC BY"), ("CC BY 4.0", "", "CC BY"), ("cc-by", "", "CC BY"), ("", "https://creativecommons.org/licenses/by-nc/4.0/", "NC"), ("CC BY, NonCommercial", "", "NC"),
    ("", "https://creativecommons.org/licenses/by-nd/4.0", "ND"), ("all rights reserved", "", "undetermined"), ("", "", "none"), (None, None, "none"), ("accby", "", "undetermined"), ("CC BY-SA", "", "CC BY"),
])
def test_licences(spark, said, url, basis):
    frame = spark.createDataFrame([(said, url)], "t string, u string")
    assert frame.select(corpus.licence_basis(F.col("t"), F.col("u"))).first()[0] == basis


def test_verified_downloads(spark):
    import hashlib

    body = b"<?xml version='1.0'?><article/>"
    known = spark.createDataFrame([("a", hashlib.sha256(body).hexdigest()), ("b", "0")], "article_id string, sha256 string")
    got = spark.createDataFrame([("a", "text/xml", body), ("b", "application/xml", body), ("a", "text/html", body), ("c", "text/xml", body)], "article_id string, content_type string, content binary")
    assert [r["accepted"] for r in corpus.verified(got, known).orderBy("article_id", "content_type").collect()] == [False, True, False, False]


def test_moves(spark):
    wrong = spark.createDataFrame([("a", "public", "private")], "article_id string, root string, wanted string")
    stored = spark.createDataFrame([("a", "raw", "a.xml", "public"), ("a", "cache", "k1", "public"), ("a", "raw", "a.xml", "private"), ("b", "raw", "b.xml", "public")], "article_id string, kind string, name string, root string")
    plan = corpus.planned_moves(wrong, stored)
    assert {(r["kind"], r["name"]) for r in plan.collect()} == {("raw", "a.xml"), ("cache", "k1")}
    cache = spark.createDataFrame([("k1", "public"), ("k2", "public"), ("k3", "public"), ("k4", "private")], "cache_key string, root string")
    owned = spark.createDataFrame([("b", "k2"), ("a", "k1")], "article_id string, cache_key string")
    cleared = spark.createDataFrame([("b", True), ("a", False)], "article_id string, redistributable boolean")
    assert [r["cache_key"] for r in corpus.orphaned_cache(cache, owned, cleared, plan).collect()] == ["k3"]


def test_roots(spark):
    frame = spark.createDataFrame([("/d/private/raw/x.xml", None), ("/d/raw/y.xml", "private"), ("/d/raw/z.xml", None)], "path string, existing string")
    assert [r[0] for r in frame.select(files.root_of(F.col("path"), "/d/private/raw", F.col("existing"))).collect()] == ["private", "private", "public"]
    assert frame.select(files.folder(F.lit("private"), "cache", F.lit("k"))).first()[0] == "private/cache/enrich/k"


ARTICLE = {
    "title": "T & U", "doi": "10.5/q", "year": 2010, "authors": ["J. K. Huard", "Solo"], "sourceUrl": "http://x/?a=1&b",
    "sections": [
        {"title": "Abstract", "type": "abstract", "paragraphs": ["Short < text."], "subsections": [{"paragraphs": ["Below."]}]},
        {"title": "1. Methods", "paragraphs": ["As in [ 1 , 2 ] and [9]. See Table 1 and Table 7.", "Table 1 . Doses.", "| a | b |\n|---|---|\n| 1 | 2 |", "|x|\n|--|"], "subsections": [{"title": "Flow", "type": "other", "paragraphs": ["Done."]}]},
    ],
}
RECORDS = [{"index": 1, "text": "Cytotherapy, 7 (2005), pp. 393-395", "doi": "10.1/a", "pubmed": {"title": "Found", "authors": ["Le Blanc K", "Horwitz E M"], "journal": "C", "year": "2005"}}, {"index": 2, "text": "Plain", "pmid": "44"}, {"index": "x"}]


def test_import():
    made = imports.article_xml(ARTICLE, RECORDS)
    a = jats.parse_article(made)
    assert a["article_id"] == "10-5-q" and a["meta"]["pub_date"] == "2010-00-00"
    assert [(x["surname"], x["given_names"]) for x in a["meta"]["authors"]] == [("Huard", "J. K."), ("Solo", None)]
    by_id = {p["paragraph_id"]: p for p in a["paragraphs"]}
    assert by_id["abs-p1"]["text"] == "Short < text." and by_id["abs-p2"]["text"] == "Below."
    first = by_id["s1-p1"]
    assert first["text"] == "As in [1,2] and [9]. See Table 1 and Table 7." and first["ref_ids"] == ["B1", "B2"] and first["table_ids"] == ["tbl1"]
    assert [t["xml_id"] for t in a["tables"]] == ["tbl1", "tblx2"] and a["tables"][0]["caption"] == "Doses." and a["tables"][0]["header_rows"] == 1
    assert (a["references"][0]["authors"], a["references"][0]["volume"], a["references"][0]["pages"], a["references"][0]["doi"]) == (["Le Blanc, K", "Horwitz, E M"], "7", "393–395", "10.1/a")
    assert (a["references"][1]["raw"], a["references"][1]["pmid"]) == ("Plain", "44")
    assert made.count("<xref ") == 3


def test_pipe_tables_agree(spark):
    cases = ["| a | b |\n|---|:--:|\n| 1 | 2 |", "|a|\n|-|", "| a |", "x | y\n|--|--|", "|--|--|\n| only | body |", "| a |\r\n| -- |\r\n\r\n| b |", "|--|\n|--|", ""]
    found = spark.createDataFrame([(k, c) for k, c in enumerate(cases)], "k int, t string").select("k", imports.pipe_table(F.col("t")).alias("t")).orderBy("k").collect()
    for r, case in zip(found, cases, strict=True):
        want = imports.plain_table(case)
        assert (None if r["t"] is None else (r["t"]["rows"], r["t"]["header_rows"])) == want


def test_import_columns(spark):
    frame = spark.createDataFrame([("[ 4 , 5–7 ] x [a] [ ]", '{"sections":[{}]}'), ("none", '{"records":[1]}'), ("[12]", "{}")], "t string, j string")
    assert [r[0] for r in frame.select(imports.citation_numbers(F.col("t"))).collect()] == [[4, 5, 7], [], [12]]
    assert [r[0] for r in frame.select(imports.kind_of(F.col("j"))).collect()] == ["body", "references", "error"]
    blocks = spark.createDataFrame([("a", "s", 1, "see Table 2 and Table 3, notTable 2")], "article_id string, section_id string, ord int, text string")
    known = spark.createDataFrame([("a", 2)], "article_id string, number long")
    assert [r["number"] for r in imports.table_mentions(blocks, known).collect()] == [2]


@pytest.mark.parametrize(("value", "want"), [("short text", ["short text"]), ("aa bb cc dd", ["aa bb", "cc dd"]), ("aaaaaaaaaaaaaaa b", ["aaaaaaaaaaaaaaa", "b"]), ("  ", []), (None, [])])
def test_chunks(spark, value, want):
    limit = 10 if value == "short text" else 6
    assert spark.createDataFrame([(value,)], "t string").select(text.chunks(F.col("t"), limit)).first()[0] == want


def test_names_and_links(spark):
    row = spark.createDataFrame([("a/b.tif", "a/b", "b.png", "PMC12", "10.1/x")], "a string, b string, c string, p string, d string").select(
        *(text.display_name(F.col(c)) for c in "abc"), text.article_link(F.col("p"), F.col("d")), text.article_link(F.lit(None), F.col("d")), text.reference_link(F.lit("7"), F.col("d")), text.image_link(F.col("p"), F.lit("x.jpg")), text.doi_slug(F.lit("https://doi.org/10.1/a.b")), text.doi_slug(F.lit(None).cast("string"))
    ).first()
    assert tuple(row) == ("a/b.jpg", "a/b.jpg", "b.png", "https://pmc.ncbi.nlm.nih.gov/articles/PMC12/", "https://doi.org/10.1/x", "https://pubmed.ncbi.nlm.nih.gov/7/", "https://pmc.ncbi.nlm.nih.gov/articles/instance/12/bin/x.jpg", "10-1-a-b", "unknown")


def test_ranges(spark):
    cases = [("5", "8", "–", [6, 7]), ("5", "6", " - ", []), ("5", "8", ",", None), ("8", "5", "-", None), ("1", "40", "-", None), ("2a", "5", "-", None)]
    frame = spark.createDataFrame(cases, "a string, b string, s string, want array<long>")
    for r in frame.select("want", citations.range_numbers(F.col("a"), F.col("b"), F.col("s")).alias("got")).collect():
        assert r["got"] == r["want"]


def test_overlaps(spark):
    frame = spark.createDataFrame([([(0, 5), (0, 3), (4, 9), (5, 5), (5, 7), (20, 21)],), ([],)], "s array<struct<start:int,end:int>>")
    found = [[tuple(x) for x in r[0]] for r in frame.select(citations.without_overlap(F.col("s"))).collect()]
    assert found == [[(0, 5), (5, 7), (20, 21)], []]


def test_report_texts(spark):
    row = spark.range(1).select(views.short_authors(F.array(*map(F.lit, "abcd"))), views.reference_title(F.lit(None).cast("string"), F.lit("raw")), citations.separator(F.lit(" , ")), citations.separator(F.lit(" - "))).first()
    assert tuple(row) == ("a, b, c et al.", "raw", ", ", "–")


def test_labels_of_many_collisions(spark):
    n = 700
    rows = spark.range(1, n + 1).select("id", F.lit("Ito 2021").alias("label"))
    found = [r["label"] for r in views.collision_suffix(rows, "label", "id").orderBy("id").collect()]
    assert found == [f"Ito 2021{chr(96 + k)}" for k in range(1, n + 1)]
    assert [r[0] for r in spark.createDataFrame([(c,) for c in (97, 0xFEFF, 0x10FFFF)], "c int").select(views.code_point(F.col("c"))).collect()] == ["a", "\ufeff", "\U0010ffff"]


def test_speech(spark):
    rows = spark.createDataFrame([("a", "p1", 0, "One here. " + "word " * 80 + "end.")], "article_id string, paragraph_id string, ord int, text string")
    parts = views.speech_units(rows).first()["parts"]
    assert parts[0] == "One here. " + ("word " * 46).strip() or all(len(p) <= 240 for p in parts)


def test_stored_tables(spark, tmp_path):
    from leafwright.operators import annotate

    manifest = spark.createDataFrame([("b", "x"), ("A", "y"), ("a", None)], "article_id string, doi string")
    files.write_manifest(manifest, str(tmp_path / "m"))
    files.write_manifest(manifest, str(tmp_path / "m"))
    again = files.read_manifest(spark, str(tmp_path / "m"), "article_id string, doi string")
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, manifest.collect()), key=str)
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "m.json").write_text("{not json")
    assert files.read_manifest(spark, str(tmp_path / "bad"), "article_id string").count() == 0
    with pytest.raises(Exception):  # noqa: B017
        files.read_manifest(spark, str(tmp_path / "bad"), "article_id string", strict=True).collect()
    assert [r["doi"] for r in files.by_id(again, "A").collect()] == ["y"]
    assert files.article_rows(spark, str(tmp_path / "m"), "article_id string").count() == 3
    paths = spark.createDataFrame([("b.xml",), ("B.xml",), ("a.xml",)], "path string")
    assert [r[0] for r in files.in_file_order(paths).collect()] == ["B.xml", "a.xml", "b.xml"]
    at = F.lit("2024-05-06 07:08:09.5").cast("timestamp")
    one = annotate.stamped(spark.createDataFrame([("p", "k", 1)], "pass string, cache_key string, v int"), at)
    two = annotate.stamped(spark.createDataFrame([("p", "k", 2), ("p", "j", 3)], "pass string, cache_key string, v int"), at + F.expr("INTERVAL 1 SECOND"))
    assert one.first()["saved_at"] == "2024-05-06T07:08:09.500Z"
    assert {(r["cache_key"], r["v"]) for r in annotate.latest(one.unionByName(two)).collect()} == {("k", 2), ("j", 3)}


def test_overlays(spark):
    rows = [("a [1] b", [(3, 4, "ref")]), ("a [1] b", []), ("a [1] b", None), (None, [(0, 1, "x")]), ("&ab", [(1, 2, "x"), (1, 3, "y")]), ("[1]", [(1, 2, "ref"), (0, 1, "x")])]
    frame = spark.createDataFrame(rows, "t string, d array<struct<start:int,end:int,kind:string>>")
    found = [r[0] for r in frame.select(views.overlaid(F.col("t"), F.col("d"))).collect()]
    assert found == ['a <mark class="ref">[1]</mark> b', "a [1] b", "a [1] b", None, '&amp;<mark class="y">ab</mark>', '<mark class="x">[</mark><mark class="ref">1</mark>]']


def test_incremental_build(spark, tmp_path):
    source, target, check = tmp_path / "in", tmp_path / "out", tmp_path / "check"
    source.mkdir()
    xml = lambda k: f"<article><front><article-meta><article-id pub-id-type='doi'>10.1/{k}</article-id></article-meta></front><body><sec><title>Results</title><p>Text {k}.</p></sec></body></article>"
    (source / "a.xml").write_text(xml(1))
    build_available(spark, str(source), str(target), str(check))
    (source / "b.xml").write_text(xml(2))
    (source / "copy.xml").write_text(xml(1))
    build_available(spark, str(source), str(target), str(check))
    build_available(spark, str(source), str(target), str(check))
    built = spark.read.parquet(f"{target}/articles")
    assert sorted(r["article_id"] for r in built.collect()) == ["10-1-1", "10-1-2"]
    assert spark.read.parquet(f"{target}/paragraphs").count() == 2


def test_json_files(spark, tmp_path):
    (tmp_path / "rows.json").write_text('{"id": "a", "n": 1}\nnot json\n{"id": "b"}\n')
    found = files.read_json_rows(spark, str(tmp_path / "rows.json"), "id string, n int")
    assert sorted(r["id"] for r in found.collect()) == ["a", "b"]
    files.write_events(found, str(tmp_path / "events"))
    assert spark.read.json(str(tmp_path / "events")).count() == 2
    one = spark.createDataFrame([("x", "<article><body><p>Hi.</p></body></article>", "h")], "path string, text string, sha256 string")
    files.write_article_json(article_tables(parsed(one))["articles"], str(tmp_path / "articles"))
    assert '"article_id":"x"' in spark.read.text(str(tmp_path / "articles")).first()["value"]


def test_entry_points(spark, monkeypatch):
    entry = importlib.import_module("__spark_entry__")
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    real = importlib.util.find_spec
    monkeypatch.setattr(entry, "find_spec", lambda name: None if name in ("leafwright.llm", "corpus_pipeline") else real(name))
    bare = entry.queries()
    assert "sentences" in bare and "pipeline" not in bare and not any(k.startswith("op1") for k in bare)
    assert "corpus_pipeline" not in entry.oracle_sql() and sys.modules


def test_views_over_annotated_rows(spark):
    rows = spark.createDataFrame([("a", "p1", "results", "result", "g", "p"), ("a", "p2", "methods", "method", "g", "p"), ("a", "p3", "results", None, None, None)], "article_id string, paragraph_id string, section_type string, role string, gist string, plain string")
    found = lambda **k: [r["paragraph_id"] for r in views.filtered_paragraphs(rows, **k).orderBy("paragraph_id").collect()]
    assert found() == ["p1", "p2"] and found(section="results") == ["p1"] and found(role="method") == ["p2"] and found(paragraph_id="p3") == []
    assert {r["name"]: r["n"] for r in views.work_counts({"x": rows, "y": rows.limit(1)}).collect()} == {"x": 3, "y": 1}
    names = spark.createDataFrame([("Zw",), ("huard",), ("Éa",)], "article_id string")
    assert [r[0] for r in corpus.in_order(names).collect()] == ["Éa", "huard", "Zw"]
    heads = article_tables(parsed(spark.createDataFrame([("x", "<article><body><p>Hi.</p></body></article>", "h")], "path string, text string, sha256 string")))["articles"]
    runs = spark.createDataFrame([("unknown", "paragraph", 2)], "article_id string, pass string, applied long")
    row = views.overview(heads, runs).first()
    assert row["passes"] == "not enriched" and row["authors"] == "" and row["n_warnings"] > 0
