"""Article XML to tables: structure, spans, references, and what goes wrong."""

import pytest

from leafwright.functions.headings import section_type, section_type_column
from leafwright.functions.vocabulary import title_patterns
from leafwright.operators import sections, text, views
from leafwright.operators.articles import article_tables, parsed, resolved_authors
from leafwright.operators.citations import first_mentions, mark_buckets, never_mentioned
from leafwright.plans import article_queries, catalogue
from leafwright.sources import files, jats

XML = """<?xml version="1.0" encoding="UTF-8"?>
<article xmlns:xlink="http://www.w3.org/1999/xlink" article-type="research-article"><front>
<journal-meta><journal-title-group><journal-title>Bones</journal-title></journal-title-group><publisher><publisher-name>MDPI</publisher-name></publisher></journal-meta>
<article-meta><article-id pub-id-type="doi">10.1/bone.5</article-id><article-id pub-id-type="pmid">77</article-id>
<title-group><article-title>A title
  over lines</article-title></title-group>
<contrib-group><contrib contrib-type="author" corresp="yes"><contrib-id contrib-id-type="orcid">0000-1</contrib-id><name><surname>Ito</surname><given-names>K.</given-names></name><xref ref-type="aff" rid="a1 a2">1</xref></contrib>
<contrib contrib-type="editor"><name><surname>No</surname></name></contrib><contrib><collab>The Group</collab></contrib>
<aff id="a1"><label>1</label>First Place</aff><aff id="a2"><label>2</label>Second Place</aff></contrib-group>
<pub-date pub-type="ppub"><year>2020</year></pub-date><pub-date pub-type="epub"><day>7</day><month>3</month><year>2021</year></pub-date>
<permissions><license><license-p>Open, <ext-link xlink:href="https://creativecommons.org/licenses/by/4.0/">CC BY</ext-link>.</license-p></license></permissions>
<abstract abstract-type="graphical"><p>No.</p></abstract><abstract><p>First fact (<italic>p</italic> = 0.01). Second   <sup>+</sup> fact.</p></abstract>
<kwd-group><kwd>bone</kwd></kwd-group><funding-group><award-group><funding-source>Fund</funding-source><award-id>9</award-id></award-group><funding-statement>Thanks.</funding-statement></funding-group></article-meta></front>
<body><p>Loose one.</p><sec id="i"><title>1. Introduction</title><p/><p>Known [<xref ref-type="bibr" rid="B1 B2">1,2</xref>]. See <xref ref-type="fig" rid="f1">Figure 1</xref>.</p></sec>
<sec><title>Methods</title><sec><title>2.1 Flow</title><p>We used <inline-formula><tex-math>a+b</tex-math></inline-formula>. <list><list-item><p>one item</p></list-item><list-item><p>two item</p></list-item></list></p></sec>
<sec><title>Statistical analysis</title><p>Tested.<fig id="f1"><label>Figure 1</label><caption><p>Cap.</p></caption><graphic xlink:href="g1.tif"/></fig></p></sec></sec>
<sec sec-type="results"><title>What we saw</title><p>Table text <xref ref-type="table" rid="t1">Table 1</xref>.</p>
<table-wrap id="t1"><label>Table 1</label><table><tbody><tr><td>x</td><td>1</td></tr></tbody><thead><tr><th>Name</th><th>n</th></tr></thead></table><table-wrap-foot><fn><p>Note.</p></fn></table-wrap-foot></table-wrap></sec>
<sec><title>Discussion</title><sec><title>Limitations</title><p>Few.</p></sec></sec><sec sec-type="display-objects"><title>Empty</title></sec></body>
<back><ack><p>Thank you.</p></ack><notes notes-type="coi-statement"><title>Interests</title><p>None.</p></notes><app-group><app><title>More</title><p>Extra.</p></app></app-group><sec sec-type="supplementary-material"><p>Skip.</p></sec>
<ref-list><ref id="B1"><label>1.</label><element-citation><name><surname>Li</surname><given-names>A.</given-names></name><article-title>Old</article-title><source>J</source><year>1999</year><volume>3</volume><fpage>1</fpage><lpage>9</lpage><pub-id pub-id-type="doi">10.2/x</pub-id></element-citation></ref>
<ref id="B2"><mixed-citation>Plain, 2000.</mixed-citation><pub-id pub-id-type="pmid">5</pub-id></ref></ref-list></back></article>"""


@pytest.fixture(scope="module")
def article():
    return jats.parse_article(XML)


def test_metadata(article):
    meta = article["meta"]
    assert article["article_id"] == "10-1-bone-5" and article["flavor"] == "mdpi-jats"
    assert (meta["title"], meta["pub_date"], meta["license_url"]) == ("A title over lines", "2021-03-07", "https://creativecommons.org/licenses/by/4.0/")
    assert [a["full"] for a in meta["authors"]] == ["K. Ito", "The Group"]
    assert meta["authors"][0]["affiliations"] == ["First Place", "Second Place"] and meta["authors"][0]["corresponding"] and meta["authors"][0]["orcid"] == "0000-1"
    assert meta["funding"] == ["Fund — 9", "Thanks."] and meta["keywords"] == ["bone"]


def test_sections(article):
    found = [(s["section_id"], s["type"], s["parent_id"]) for s in article["sections"]]
    assert found == [
        ("abs", "abstract", None), ("s0", "other", None), ("s1", "introduction", None), ("s2", "methods", None), ("s2-1", "methods", "s2"), ("s2-2", "methods", "s2"),
        ("s3", "results", None), ("s4", "discussion", None), ("s4-1", "limitations", "s4"), ("b1", "acknowledgements", None), ("b2", "conflicts", None), ("b3", "supplementary", None),
    ]
    assert [p["paragraph_id"] for p in article["paragraphs"]][:3] == ["abs-p1", "s0-p1", "s1-p2"]
    assert article["warnings"] == ["paragraphs outside sections: s0"]


def test_spans(article):
    for p in article["paragraphs"]:
        assert "  " not in p["text"] and p["text"] == p["text"].strip()
        assert all(0 <= m["start"] < m["end"] <= len(p["text"]) for m in p["marks"])
        assert " ".join(p["text"][s["start"] : s["end"]] for s in p["sentences"]) == p["text"]
    by_id = {p["paragraph_id"]: p for p in article["paragraphs"]}
    marked = lambda k: [(m["type"], by_id[k]["text"][m["start"] : m["end"]]) for m in by_id[k]["marks"]]
    assert by_id["abs-p1"]["text"] == "First fact (p = 0.01). Second + fact." and marked("abs-p1") == [("italic", "p"), ("sup", "+")]
    assert by_id["s1-p2"]["ref_ids"] == ["B1", "B2"] and by_id["s1-p2"]["fig_ids"] == ["f1"]
    assert marked("s2-1-p1") == [("formula", "a+b"), ("list-item", "one item"), ("list-item", "two item")] and len(by_id["s2-1-p1"]["sentences"]) == 3
    assert by_id["s2-2-p1"]["text"] == "Tested."


def test_items(article):
    assert article["figures"] == [{"xml_id": "f1", "label": "Figure 1", "caption": "Cap.", "graphics": ["g1.tif"]}]
    table = article["tables"][0]
    assert table["rows"] == [["Name", "n"], ["x", "1"]] and table["header_rows"] == 1 and table["footnotes"] == ["Note."]
    one, two = article["references"]
    assert (one["authors"], one["pages"], one["doi"], one["raw"]) == (["Li, A."], "1–9", "10.2/x", None)
    assert (two["raw"], two["pmid"]) == ("Plain, 2000.", "5")


def test_text_never_moves():
    built = jats.SpanText()
    for piece in ("  a", " ", "  b ", "\n", "c  ", "", " d"):
        built.add(piece)
    assert built.text() == "a b c d" and built.length == 7


def test_what_is_no_article():
    for bad in ("", "<html/>", "no markup"):
        with pytest.raises(ValueError):
            jats.parse_article(bad)
    assert jats.parse_article("<article/>")["warnings"][:2] == ["no doi", "no title"]


def test_what_is_not_well_formed_is_mended_with_a_warning():
    broken = XML.replace("<sup>+</sup>", "<sup>+").replace("</italic> = 0.01", "</italic></bold> = 0.01 &amp; &odd;", 1)
    found = jats.parse_article(broken)
    whole = jats.parse_article(XML)
    assert found["warnings"][0].startswith("not well-formed") and found["meta"]["doi"] == whole["meta"]["doi"]
    assert [p["text"] for p in found["paragraphs"]][1:] == [p["text"] for p in whole["paragraphs"]][1:]
    assert found["paragraphs"][0]["text"].startswith("First fact (p = 0.01 & &odd;). Second +")
    cut = jats.parse_article(XML[: XML.index("<back>")])
    assert [p["paragraph_id"] for p in cut["paragraphs"]] == [p["paragraph_id"] for p in whole["paragraphs"] if p["paragraph_id"][0] != "b"]


def test_title_column_is_the_parsers_rule(spark):
    titles = ["1. Introduction", "Background", "Patients and methods", "Methodology", "2.3 Study design", "Results and Discussion", "Case 2", "Limitation", "émethods", "Data availability statement", "Other thing", "", None]
    rows = [(t, s, n, p) for t in titles for s in (None, "Intro", "bogus", "COI_statement") for n in (1, 2) for p in (None, "results")]
    frame = spark.createDataFrame(rows, "title string, sec string, level int, parent string")
    from pyspark.sql import functions as F

    found = frame.select("*", section_type_column(F.col("title"), F.col("sec"), F.col("level"), F.col("parent")).alias("type")).collect()
    assert all(r["type"] == section_type(r["title"], r["sec"], r["level"], r["parent"]) for r in found)
    assert len(title_patterns()) == 25


def test_both_readers_give_the_same_article():
    assert jats._read_plain(XML) is not None
    known = jats.parse_article(XML)
    for other in (
        XML.replace("<article ", '<article xmlns="urn:a" '),  # a default namespace
        XML.replace("<abstract>", '<abstract xmlns:xl="http://www.w3.org/1999/xlink">'),  # two prefixes of one namespace
        XML.replace("<article ", "<!DOCTYPE article [<!ENTITY e 'x'>]><article "),
    ):
        assert jats._read_plain(other) is None and jats.parse_article(other) == known
    assert jats.parse_article(XML.replace("xmlns:xlink", "xmlns:xl").replace("xlink:href", "xl:href"))["figures"][0]["graphics"] == []
    deep = "<article><body><sec><title>a</title><p>b</p></sec></body><back>" + "<x>" * 2000 + "</x>" * 2000 + "</back></article>"
    with pytest.raises(RecursionError):
        jats.parse_article(deep)


def test_parsed_for_some_columns(spark):
    given = spark.createDataFrame([("a.xml", XML, "h"), ("b.xml", "<other/>", "i")], "path string, text string, sha256 string")
    whole, some = article_tables(parsed(given)), article_tables(parsed(given, "sections", "tables"))
    assert set(some) == {"articles", "sections", "tables"} and some["articles"].columns == ["article_id"]
    assert all(some[k].collect() == whole[k].collect() for k in ("sections", "tables"))
    assert [r["error"] is None for r in parsed(given, "references").orderBy("error").collect()] == [True, False]


def test_large_tables_are_dealt_before_documents_are_made(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(article_queries, "TASK_ARTICLES", 10)
    rows = article_queries._parsed(spark, sf, "sections")
    n = spark.read.parquet(f"{sf}/part.parquet").count()
    assert rows.rdd.getNumPartitions() == -(-n // 10)
    shuffled = [line for line in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "content" in line or "Repartition" in line]
    assert "Repartition" in shuffled[-1], "documents are made above the shuffle"


@pytest.mark.parametrize("name", ["article_floats", "article_placement", "page_neighbours", "paragraph_places", "page_speech", "shown_figures", "article_authors", "article_marks", "overviews"])
def test_article_queries_keep_nothing_in_memory(spark, name):
    spark.catalog.clearCache()
    found = catalogue.queries()[name](spark, "/root/testdata/sf0.001")
    assert found.count() > 0 and spark._jsparkSession.sharedState().cacheManager().isEmpty()
    stored = name not in ("article_authors", "article_marks", "overviews")
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == (0 if stored else 1)
    assert not stored or "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_files_to_tables(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.xml").write_text("﻿  " + XML)
    (tmp_path / "b.nxml").write_text("<!DOCTYPE html><html></html>")
    (tmp_path / "c.jats").write_text("junk <article/>")
    (tmp_path / "d.xml").write_text("<other/>")
    (tmp_path / "e.txt").write_text(XML)
    (tmp_path / ".hidden.xml").write_text(XML)
    rows = files.checked(files.xml_files(spark, str(tmp_path)))
    errors = {r["path"].rsplit("/", 1)[-1]: r["error"] for r in rows.collect()}
    assert errors == {"a.xml": None, "b.nxml": "HTML, not XML", "c.jats": "text before the XML declaration: junk", "d.xml": "no article element"}
    tables = article_tables(parsed(rows).cache())
    assert {k: v.count() for k, v in tables.items()} == {"articles": 1, "sections": 12, "paragraphs": 10, "sentences": 14, "figures": 1, "tables": 1, "references": 2, "authors": 2, "build_report": 4}
    assert {r["status"]: r["n"] for r in views.build_report(tables["build_report"]).collect()} == {"ok": 1, "error": 3}
    assert sections.with_text(tables["sections"], tables["paragraphs"]).count() == 12
    assert sections.audited(tables["sections"], tables["articles"]).first()["warnings"] == []
    counts = sections.summary(tables["paragraphs"]).first()
    assert (counts["n_paragraphs"], counts["n_body_paragraphs"]) == (10, 9)
    homes = first_mentions(tables["paragraphs"], tables["figures"], "fig_ids")
    assert [tuple(r) for r in homes.collect()] == [("10-1-bone-5", "f1", "s1-p2")]
    assert never_mentioned(tables["figures"], homes).count() == 0
    from pyspark.sql import functions as F

    buckets = tables["paragraphs"].select(mark_buckets(F.col("marks"), "bibr").alias("m"), "ref_ids").collect()
    assert all(r["m"] == r["ref_ids"] for r in buckets)
    pages = views.pages(tables["articles"], tables["sections"], tables["references"], tables["figures"].limit(0))
    assert [(r["page"], r["kind"]) for r in pages.orderBy("page").collect()] == [(0, "overview"), (1, "section"), (2, "section"), (3, "section"), (4, "section"), (5, "section"), (6, "back"), (7, "references")]
    assert views.neighbours(pages).where("page = 0").first()["following"] == "other"
    placed = {r["paragraph_id"]: r["page"] for r in views.paragraph_pages(pages, tables["paragraphs"]).collect()}
    assert placed["abs-p1"] == 0 and placed["s2-2-p1"] == 3 and placed["b3-p1"] == 6
    assert views.library(tables["articles"], spark.createDataFrame([], "article_id string, pass string")).first()["label"] == "Ito 2021"
    assert views.with_placed(tables["paragraphs"], homes, tables["figures"]).where("shown IS NOT NULL").count() == 1


def test_affiliations(spark):
    authors = spark.createDataFrame([("x", 0, ["a", "zz"]), ("x", 1, []), ("y", 0, []), ("y", 1, ["b"])], "article_id string, ord int, rids array<string>")
    places = spark.createDataFrame([("x", "a", "A"), ("x", "c", "C"), ("y", "b", "B")], "article_id string, id string, affiliation string")
    found = {(r[0], r[1]): r[2] for r in resolved_authors(authors, places).collect()}
    assert found == {("x", 0): ["A"], ("x", 1): [], ("y", 0): ["B"], ("y", 1): ["B"]}


def test_normalised_text(spark):
    from pyspark.sql import functions as F

    raw = ["a  b", "﻿x ", "", None, "n\tm\x0bk"]
    found = [r[0] for r in spark.createDataFrame([(x,) for x in raw], "t string").select(text.normalised(F.col("t"))).collect()]
    assert found == [None if x is None else jats.normalised(x) for x in raw]
