"""Queries of the article path: XML and JSON documents made of a table's columns, parsed, and compared with SQL over the same columns.

Each row of ``part`` is an article whose structure follows from its size; each row of ``supplier`` is an article in JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.operators import articles, citations, imports, sections, views
from leafwright.plans.registered import query
from leafwright.session import table
from leafwright.sources import files

def _k() -> Column:
    return F.col("p_partkey").cast("string")


def _z() -> Column:
    return F.col("p_size")


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _if(condition: Column, *parts: str | Column) -> Column:
    return F.when(condition, _text(*parts)).otherwise(F.lit(""))


def _number(c: Column) -> Column:
    return c.cast("string")


def _each(n: Column, make) -> Column:
    """make(j) for j from 1 to n, one after the other."""
    return F.array_join(F.transform(F.sequence(F.lit(1), n), make), "")


def _front() -> Column:
    publisher = F.element_at(F.array(*map(F.lit, ("MDPI AG", "Frontiers Media", "Elsevier BV", "House"))), _z() % 4 + 1)
    licence = F.when(_z() % 2 == 0, _text('<license xlink:href="https://creativecommons.org/licenses/by/4.0/"><license-p>Open ', _k(), "</license-p></license>")).otherwise(
        F.lit('<license><license-p>See <ext-link xlink:href="https://creativecommons.org/licenses/by-nc/4.0/">here</ext-link>.</license-p></license>')
    )
    aff = F.when(_z() % 9 == 0, F.lit("zz")).otherwise(F.lit("a1 a2"))
    abstract = F.when(_z() % 8 == 0, _text("<abstract><sec><title>Aim</title><p>Aim ", _k(), ".</p></sec><sec><title>End</title><p>End.</p></sec></abstract>")).otherwise(
        _text("<abstract><p>First ", _k(), " (<italic>p</italic> = 0.01). Second   <sup>+</sup> fact.</p></abstract>")
    )
    return _text(
        "<front><journal-meta><journal-title-group><journal-title>", F.col("p_brand"), "</journal-title></journal-title-group><publisher><publisher-name>", publisher, "</publisher-name></publisher></journal-meta>",
        '<article-meta><article-id pub-id-type="doi">10.1/', _k(), "</article-id>", _if(_z() % 6 == 0, '<article-id pub-id-type="pmc">PMC', _k(), "</article-id>"),
        "<title-group><article-title>  ", F.col("p_name"), "\n  of <italic>", F.col("p_type"), "</italic> </article-title></title-group>",
        '<contrib-group><contrib contrib-type="author"', _if(_z() % 2 == 1, ' corresp="yes"'), '><contrib-id contrib-id-type="orcid">0000-', _k(), "</contrib-id><name><surname>", F.col("p_brand"),
        '</surname><given-names>A. B.</given-names></name><xref ref-type="aff" rid="', aff, '">1</xref></contrib><contrib contrib-type="editor"><name><surname>No</surname></name></contrib>',
        "<contrib><collab>Group ", _number(_z()), '</collab></contrib><aff id="a1"><label>1</label>First ', _k(), '</aff><aff id="a2">Second</aff></contrib-group>',
        '<pub-date pub-type="ppub"><year>2020</year></pub-date>', _if(_z() % 3 == 0, '<pub-date pub-type="epub"><day>7</day><month>', _number(_z() % 12 + 1), "</month><year>2021</year></pub-date>"),
        "<permissions>", licence, '</permissions><abstract abstract-type="graphical"><p>No.</p></abstract>', abstract,
        "<kwd-group>", _each(_z() % 3 + 1, lambda j: _text("<kwd>key ", _number(j), "</kwd>")), "</kwd-group>",
        "<funding-group><award-group><funding-source>Fund</funding-source><award-id>", _k(), "</award-id></award-group><funding-statement>Thanks.</funding-statement></funding-group></article-meta></front>",
    )


def _body() -> Column:
    last = F.when(_z() % 2 == 0, F.lit("<sec><title>Discussion</title><sec><title>Limitations</title><p>Few.</p></sec></sec>")).otherwise(F.lit('<sec sec-type="display-objects"><title>Empty</title></sec>'))
    return _text(
        "<body>", _if(_z() % 7 == 0, "<p>Loose ", _k(), ".</p>"),
        '<sec id="i"><title>1. Introduction</title><p/><p>Known [<xref ref-type="bibr" rid="B1 B2">1,2</xref>]. See <xref ref-type="fig" rid="f1">Figure 1</xref> of ', F.col("p_name"), ".</p></sec>",
        "<sec><title>Methods</title><sec><title>2.1 Flow</title><p>We used <inline-formula><tex-math>a+", _k(), "</tex-math></inline-formula>. <list>",
        _each(_z() % 3 + 1, lambda j: _text("<list-item><p>item ", _number(j), "</p></list-item>")), "</list></p></sec></sec>",
        '<sec sec-type="results"><title>What we saw</title><p>Table text <xref ref-type="table" rid="t1">Table 1</xref>.</p>',
        '<fig id="f1"><label>Figure 1</label><caption><p>Cap ', _k(), '.</p></caption><graphic xlink:href="g', _k(), '.tif"/></fig>',
        '<table-wrap id="t1"><label>Table 1</label><table><tbody>', _each(_z() % 3 + 1, lambda j: _text("<tr><td>x", _number(j), "</td><td>", _k(), "</td></tr>")),
        "</tbody><thead><tr><th>Name</th><th>n</th></tr></thead></table><table-wrap-foot><fn><p>Note.</p></fn></table-wrap-foot></table-wrap></sec>", last, "</body>",
    )


def _back() -> Column:
    def reference(j: Column) -> Column:
        n = _number(j)
        full = _text("<element-citation><name><surname>Li", n, "</surname><given-names>A.</given-names></name><article-title>Old ", n, "</article-title><source>J</source><year>", _number(1990 + j), "</year><volume>", n,
                     "</volume><fpage>", n, "</fpage><lpage>", _number(j + 8), '</lpage><pub-id pub-id-type="doi">10.2/', _k(), ".", n, "</pub-id></element-citation>")
        plain = _text("<mixed-citation>Plain ", n, ', 2000.</mixed-citation><pub-id pub-id-type="pmid">', _k(), n, "</pub-id>")
        return _text('<ref id="B', n, '"><label>', n, ".</label>", F.when(j % 2 == 1, full).otherwise(plain), "</ref>")

    return _text("<back><ack><p>Thanks ", _number(_z()), ".</p></ack>", _if(_z() % 2 == 0, '<notes notes-type="coi-statement"><title>Interests</title><p>None.</p></notes>'), "<ref-list>", _each(_z() % 4 + 1, reference), "</ref-list></back>")


# Articles that one task makes and parses.
TASK_ARTICLES = 10_000


def _dealt(rows: DataFrame, key: str) -> DataFrame:
    """Rows of a table dealt to all cores, and to more tasks as it grows. A small table is one input split, and a row is far smaller than the document made of it."""
    n = -(-rows.count() // TASK_ARTICLES)
    return rows.repartition(max(n, rows.sparkSession.sparkContext.defaultParallelism), key)


def _parsed(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    kind = F.when(_z() % 5 == 0, F.lit("case-report")).otherwise(F.lit("research-article"))
    xml = _text('<?xml version="1.0" encoding="UTF-8"?><article xmlns:xlink="http://www.w3.org/1999/xlink" article-type="', kind, '">', _front(), _body(), _back(), "</article>")
    part = _dealt(table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"), "p_partkey")
    return articles.parsed(files.checked(part.select(_text("x/", _k(), ".xml").alias("path"), F.encode(xml, "UTF-8").alias("content"))), *columns)


def _tables(spark: SparkSession, sf: str, *columns: str) -> dict[str, DataFrame]:
    """The tables that come from these columns of the parsed articles; each use of one parses."""
    return articles.article_tables(_parsed(spark, sf, *columns))


def _stored_tables(spark: SparkSession, sf: str, *columns: str) -> dict[str, DataFrame]:
    """The same for plans that use several tables or one several times: all are read from one parse."""
    return articles.article_tables(files.stored(_parsed(spark, sf, *columns)))


_ARTICLES = "a AS (SELECT p_partkey AS k, '10-1-' || p_partkey AS article_id, p_size AS z, p_name, p_brand, p_type FROM part)"


@query(f"""WITH {_ARTICLES} SELECT article_id, '10.1/' || k AS doi, CASE WHEN z % 6 = 0 THEN 'PMC' || k END AS pmcid, p_name || ' of ' || p_type AS title, p_brand AS journal,
  CASE WHEN z % 3 = 0 THEN '2021-' || lpad((z % 12 + 1)::VARCHAR, 2, '0') || '-07' ELSE '2020-00-00' END AS pub_date, CASE WHEN z % 5 = 0 THEN 'case-report' ELSE 'research-article' END AS article_type,
  CASE WHEN z % 2 = 0 THEN 'https://creativecommons.org/licenses/by/4.0/' ELSE 'https://creativecommons.org/licenses/by-nc/4.0/' END AS license_url, CASE WHEN z % 2 = 0 THEN 'Open ' || k ELSE 'See here.' END AS license_text,
  array_to_string(list_transform(range(1, z % 3 + 2), lambda j: 'key ' || j), '|') AS keywords, 'Fund — ' || k || '|Thanks.' AS funding,
  CASE WHEN z % 6 = 0 THEN 'pmc-jats' ELSE ['mdpi-jats', 'frontiers-jats', 'elsevier-jats', 'jats'][z % 4 + 1] END AS flavor,
  array_to_string(list_filter([CASE WHEN z % 7 = 0 THEN 'paragraphs outside sections: s0' END, CASE WHEN z % 5 <> 0 AND z % 2 = 1 THEN 'missing section: discussion' END], lambda x: x IS NOT NULL), '|') AS warnings FROM a""")
def article_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Metadata, flavor and warnings of articles."""
    found = _tables(spark, sf, "meta", "warnings", "flavor")["articles"]
    joined = [F.array_join(c, "|").alias(c) for c in ("keywords", "funding", "warnings")]
    return found.select("article_id", "doi", "pmcid", "title", "journal", "pub_date", "article_type", "license_url", "license_text", "flavor", *joined)


_SECTIONS = f"""{_ARTICLES}, s AS (
  SELECT article_id, z, x.r AS r, x.id AS section_id, x.title AS title, x.level AS level, x.type AS type, x.parent AS parent_id, x.part AS part FROM a, (VALUES
    (0, 'abs', 'Abstract', 1, 'abstract', NULL, 'abstract'), (1, 'abs-1', 'Aim', 1, 'abstract', NULL, 'abstract'), (2, 'abs-2', 'End', 1, 'abstract', NULL, 'abstract'),
    (3, 's0', NULL, 1, 'other', NULL, 'sections'), (4, 's1', '1. Introduction', 1, 'introduction', NULL, 'sections'), (5, 's2', 'Methods', 1, 'methods', NULL, 'sections'),
    (6, 's2-1', '2.1 Flow', 2, 'methods', 's2', 'sections'), (7, 's3', 'What we saw', 1, 'results', NULL, 'sections'), (8, 's4', 'Discussion', 1, 'discussion', NULL, 'sections'),
    (9, 's4-1', 'Limitations', 2, 'limitations', 's4', 'sections'), (10, 'b1', NULL, 1, 'acknowledgements', NULL, 'sections'), (11, 'b2', 'Interests', 1, 'conflicts', NULL, 'sections')) AS x(r, id, title, level, type, parent, part)
  WHERE (r <> 0 OR z % 8 <> 0) AND (r NOT IN (1, 2) OR z % 8 = 0) AND (r <> 3 OR z % 7 = 0) AND (r NOT IN (8, 9, 11) OR z % 2 = 0))"""


@query(f"WITH {_SECTIONS} SELECT article_id, section_id, title, level::INT AS level, type, parent_id, part, row_number() OVER (PARTITION BY article_id ORDER BY r) - 1 AS ord FROM s")
def article_sections(spark: SparkSession, sf: str) -> DataFrame:
    """Sections in reading order, empty ones left out."""
    return _tables(spark, sf, "sections")["sections"].select("article_id", "section_id", "title", "level", "type", "parent_id", "part", "ord")


_PARAGRAPHS = f"""{_ARTICLES}, t AS (SELECT article_id, k, z, p_name, unnest([
    {{'r': 0, 's': 'abs', 'p': 'abs-p1', 'texts': ['First ' || k || ' (p = 0.01).', 'Second + fact.'], 'refs': '', 'figs': '', 'tabs': ''}},
    {{'r': 1, 's': 'abs-1', 'p': 'abs-1-p1', 'texts': ['Aim ' || k || '.'], 'refs': '', 'figs': '', 'tabs': ''}}, {{'r': 2, 's': 'abs-2', 'p': 'abs-2-p1', 'texts': ['End.'], 'refs': '', 'figs': '', 'tabs': ''}},
    {{'r': 3, 's': 's0', 'p': 's0-p1', 'texts': ['Loose ' || k || '.'], 'refs': '', 'figs': '', 'tabs': ''}},
    {{'r': 4, 's': 's1', 'p': 's1-p2', 'texts': ['Known [1,2].', 'See Figure 1 of ' || p_name || '.'], 'refs': 'B1|B2', 'figs': 'f1', 'tabs': ''}},
    {{'r': 6, 's': 's2-1', 'p': 's2-1-p1', 'texts': list_concat(['We used a+' || k || '.'], list_transform(range(1, z % 3 + 2), lambda j: 'item ' || j)), 'refs': '', 'figs': '', 'tabs': ''}},
    {{'r': 7, 's': 's3', 'p': 's3-p1', 'texts': ['Table text Table 1.'], 'refs': '', 'figs': '', 'tabs': 't1'}}, {{'r': 9, 's': 's4-1', 'p': 's4-1-p1', 'texts': ['Few.'], 'refs': '', 'figs': '', 'tabs': ''}},
    {{'r': 10, 's': 'b1', 'p': 'b1-p1', 'texts': ['Thanks ' || z || '.'], 'refs': '', 'figs': '', 'tabs': ''}}, {{'r': 11, 's': 'b2', 'p': 'b2-p1', 'texts': ['None.'], 'refs': '', 'figs': '', 'tabs': ''}}]) AS x FROM a),
p AS (SELECT article_id, k, z, x.r AS r, x.s AS section_id, x.p AS paragraph_id, x.texts AS texts, array_to_string(x.texts, ' ') AS text, x.refs AS ref_ids, x.figs AS fig_ids, x.tabs AS table_ids FROM t
  WHERE (x.r <> 0 OR z % 8 <> 0) AND (x.r NOT IN (1, 2) OR z % 8 = 0) AND (x.r <> 3 OR z % 7 = 0) AND (x.r NOT IN (9, 11) OR z % 2 = 0))"""


@query(f"WITH {_PARAGRAPHS} SELECT article_id, section_id, paragraph_id, text, ref_ids, fig_ids, table_ids, row_number() OVER (PARTITION BY article_id ORDER BY r) - 1 AS ord FROM p")
def article_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    """Paragraphs in reading order, with the ids that they name."""
    joined = [F.array_join(c, "|").alias(c) for c in ("ref_ids", "fig_ids", "table_ids")]
    return _tables(spark, sf, "paragraphs")["paragraphs"].select("article_id", "section_id", "paragraph_id", "text", *joined, "ord")


@query(f"""WITH {_PARAGRAPHS}, m AS (SELECT article_id, paragraph_id, text, unnest(CASE r
    WHEN 0 THEN [{{'type': 'italic', 'said': 'p', 'at': instr(text, '(p =')}}, {{'type': 'sup', 'said': '+', 'at': instr(text, '+') - 1}}]
    WHEN 4 THEN [{{'type': 'xref', 'said': '1,2', 'at': instr(text, '[')}}, {{'type': 'xref', 'said': 'Figure 1', 'at': instr(text, 'Figure') - 1}}]
    WHEN 6 THEN list_concat([{{'type': 'formula', 'said': 'a+' || k, 'at': 8}}], list_transform(range(1, z % 3 + 2), lambda j: {{'type': 'list-item', 'said': 'item ' || j, 'at': instr(text, 'item ' || j) - 1}}))
    WHEN 7 THEN [{{'type': 'xref', 'said': 'Table 1', 'at': 11}}] ELSE [] END) AS x FROM p)
SELECT article_id, paragraph_id, x.type AS type, x.at::INT AS start, (x.at + length(x.said))::INT AS "end", x.said AS said FROM m""")
def article_marks(spark: SparkSession, sf: str) -> DataFrame:
    """Marks of inline elements as spans of the text."""
    each = _tables(spark, sf, "paragraphs")["paragraphs"].select("article_id", "paragraph_id", "text", F.explode("marks").alias("m"))
    return each.select("article_id", "paragraph_id", "m.type", "m.start", "m.end", F.expr("substring(text, m.start + 1, m.end - m.start)").alias("said"))


@query(f"""WITH {_PARAGRAPHS}, e AS (SELECT article_id, paragraph_id, texts, unnest(range(1, len(texts) + 1)) AS n FROM p)
SELECT article_id, paragraph_id, paragraph_id || '-s' || n AS sentence_id, texts[n] AS sentence,
  (CASE WHEN n = 1 THEN 0 ELSE length(array_to_string(texts[1:n - 1], ' ')) + 1 END)::INT AS start FROM e""")
def article_sentences(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences, with citations and list items taken into account."""
    return _tables(spark, sf, "paragraphs")["sentences"].select("article_id", "paragraph_id", "sentence_id", "sentence", "start")


@query(f"""WITH {_ARTICLES} SELECT article_id, 'f1' AS xml_id, 'Figure 1' AS label, 'Cap ' || k || '.' AS caption, 'g' || k || '.tif' AS content, 0::INT AS header_rows, '' AS footnotes FROM a
UNION ALL SELECT article_id, 't1', 'Table 1', NULL, 'Name;n|' || array_to_string(list_transform(range(1, z % 3 + 2), lambda j: 'x' || j || ';' || k), '|'), 1, 'Note.' FROM a""")
def article_floats(spark: SparkSession, sf: str) -> DataFrame:
    """Figures, and tables with header rows first."""
    found = _stored_tables(spark, sf, "figures", "tables")
    figures = found["figures"].select("article_id", "xml_id", "label", "caption", F.array_join("graphics", "|").alias("content"), F.lit(0).alias("header_rows"), F.lit("").alias("footnotes"))
    rows = F.array_join(F.transform("rows", lambda r: F.array_join(r, ";")), "|")
    return figures.unionByName(found["tables"].select("article_id", "xml_id", "label", "caption", rows.alias("content"), "header_rows", F.array_join("footnotes", "|").alias("footnotes")))


@query(f"""WITH {_ARTICLES}, r AS (SELECT *, unnest(range(1, z % 4 + 2)) AS j FROM a)
SELECT article_id, 'B' || j AS xml_id, j || '.' AS label, CASE WHEN j % 2 = 1 THEN 'Li' || j || ', A.' ELSE '' END AS authors, CASE WHEN j % 2 = 1 THEN 'Old ' || j END AS title, CASE WHEN j % 2 = 1 THEN 'J' END AS source,
  CASE WHEN j % 2 = 1 THEN (1990 + j)::VARCHAR END AS year, CASE WHEN j % 2 = 1 THEN j::VARCHAR END AS volume, CASE WHEN j % 2 = 1 THEN j || '–' || (j + 8) END AS pages,
  CASE WHEN j % 2 = 1 THEN '10.2/' || k || '.' || j END AS doi, CASE WHEN j % 2 = 0 THEN k::VARCHAR || j END AS pmid, CASE WHEN j % 2 = 0 THEN 'Plain ' || j || ', 2000.' END AS raw, (j - 1)::INT AS ord FROM r""")
def article_references(spark: SparkSession, sf: str) -> DataFrame:
    """References, structured and plain."""
    return _tables(spark, sf, "references")["references"].select("article_id", "xml_id", "label", F.array_join("authors", "|").alias("authors"), "title", "source", "year", "volume", "pages", "doi", "pmid", "raw", F.col("ord").cast("int").alias("ord"))


@query(f"""WITH {_ARTICLES} SELECT article_id, 0::INT AS ord, 'A. B. ' || p_brand AS "full", p_brand AS surname, '0000-' || k AS orcid, CASE WHEN z % 9 = 0 THEN '' ELSE 'First ' || k || '|Second' END AS affiliations, z % 2 = 1 AS corresponding FROM a
UNION ALL SELECT article_id, 1, 'Group ' || z, NULL, NULL, '', false FROM a""")
def article_authors(spark: SparkSession, sf: str) -> DataFrame:
    """Authors and where they work."""
    return _tables(spark, sf, "meta")["authors"].select("article_id", F.col("ord").cast("int").alias("ord"), "full", "surname", "orcid", F.array_join("affiliations", "|").alias("affiliations"), "corresponding")


@query("""
WITH a AS (SELECT p_partkey AS k, p_size AS z FROM part), r AS (SELECT k, unnest(CASE WHEN z % 9 = 0 THEN ['zz'] WHEN z % 4 = 1 THEN [] ELSE ['a2', 'a1'] END) AS rid FROM a),
n AS (SELECT k, z, CASE WHEN z % 4 = 1 THEN ['Only ' || k] ELSE ['First ' || k, 'Second'] END AS places FROM a)
SELECT k AS article_id, CASE WHEN len(places) = 1 THEN places[1] WHEN z % 9 = 0 THEN '' ELSE 'Second|First ' || k END AS affiliations FROM n
""")
def resolved_affiliations(spark: SparkSession, sf: str) -> DataFrame:
    """Affiliations by id, or the only one there is."""
    part = table(spark, sf, "part")
    rids = F.when(_z() % 9 == 0, F.array(F.lit("zz"))).when(_z() % 4 == 1, F.array().cast("array<string>")).otherwise(F.array(F.lit("a2"), F.lit("a1")))
    authors = part.select(F.col("p_partkey").alias("article_id"), F.lit(0).alias("ord"), rids.alias("rids"))
    one = part.where(_z() % 4 == 1).select(F.col("p_partkey").alias("article_id"), F.lit("a1").alias("id"), _text("Only ", _k()).alias("affiliation"))
    two = part.where(_z() % 4 != 1).select(F.col("p_partkey").alias("article_id"), F.explode(F.array(F.struct(F.lit("a1").alias("id"), _text("First ", _k()).alias("affiliation")), F.struct(F.lit("a2").alias("id"), F.lit("Second").alias("affiliation")))).alias("x")).select("article_id", "x.*")
    return articles.resolved_authors(authors, one.unionByName(two)).select("article_id", F.array_join("affiliations", "|").alias("affiliations"))


@query(f"""WITH {_PARAGRAPHS} SELECT article_id, count(*) AS n_paragraphs, count(*) FILTER (r > 2) AS n_body_paragraphs, sum(CASE WHEN r > 2 THEN len(string_split(text, ' ')) ELSE 0 END)::BIGINT AS n_body_words FROM p GROUP BY article_id""")
def article_summaries(spark: SparkSession, sf: str) -> DataFrame:
    """Paragraphs and words by article."""
    return sections.summary(_tables(spark, sf, "paragraphs")["paragraphs"])


@query(f"WITH {_ARTICLES} SELECT article_id, 'f1' AS xml_id, 's1-p2' AS paragraph_id FROM a UNION ALL SELECT article_id, 't1', 's3-p1' FROM a")
def article_placement(spark: SparkSession, sf: str) -> DataFrame:
    """Where figures and tables of parsed articles are named first."""
    found = _stored_tables(spark, sf, "paragraphs", "figures", "tables")
    return citations.first_mentions(found["paragraphs"], found["figures"], "fig_ids").unionByName(citations.first_mentions(found["paragraphs"], found["tables"], "table_ids"))


_HEADS = ("<article>", "﻿  <article>", "junk <article>", "<!DOCTYPE html><html>", "<other>", '<?xml version="1.0" encoding="latin-1"?><article>')


@query(f"""WITH h AS (SELECT p_partkey AS k, p_size % {len(_HEADS)} AS h, ['<article>', '<article>', '<article>', '<!DOCTYPE html><html>', '<other>', '<?xml version="1.0" encoding="latin-1"?><article>'][p_size % {len(_HEADS)} + 1] || p_name AS text FROM part)
SELECT k AS path, sha256(text) AS sha256, CASE h WHEN 2 THEN 'text before the XML declaration: junk' WHEN 3 THEN 'HTML, not XML' WHEN 4 THEN 'no article element' END AS error, CASE h WHEN 5 THEN 'declared as latin-1' END AS encoding_warning FROM h""")
def checked_files(spark: SparkSession, sf: str) -> DataFrame:
    """What files are fit to be parsed: byte order marks, text before the declaration, other documents (A2)."""
    head = F.element_at(F.array(*map(F.lit, _HEADS)), _z() % len(_HEADS) + 1)
    given = table(spark, sf, "part").select(F.col("p_partkey").alias("path"), F.encode(F.concat(head, "p_name"), "UTF-8").alias("content"))
    return files.checked(given).select("path", "sha256", "error", "encoding_warning")


# ------------------------------------------------------------------ import


def _imported(spark: SparkSession, sf: str) -> DataFrame:
    """Each supplier as a JSON article with two reference records."""
    k, n = F.col("s_suppkey").cast("string"), F.col("s_nationkey")
    pipes = _text("| a | b |\n|---|---|\n| ", k, " | 2 |")
    said = F.array(
        _text("As in [ 1 , 2 ] and [9-12] of ", F.col("s_name"), ". See Table 1 and Table 7."),
        F.when(n % 2 == 0, F.lit("Table 1 . Doses.")).otherwise(F.lit("No caption.")), pipes,
    )
    lower = F.struct(F.lit("Flow").alias("title"), F.lit("other").alias("type"), F.array(F.lit("Done & dusted.")).alias("paragraphs"))
    body = F.array(
        F.struct(F.lit("Abstract").alias("title"), F.lit("abstract").alias("type"), F.array(_text("Short < ", k)).alias("paragraphs"), F.array().cast("array<struct<title:string,type:string,paragraphs:array<string>>>").alias("subsections")),
        F.struct(F.lit("1. Methods").alias("title"), F.lit(None).cast("string").alias("type"), said.alias("paragraphs"), F.array(lower).alias("subsections")),
    )
    article = F.to_json(F.struct(_text("T & ", k).alias("title"), _text("10.5/", k).alias("doi"), (2000 + n).alias("year"), F.array(_text("J. K. ", F.col("s_name"))).alias("authors"), body.alias("sections")))
    one = F.struct(F.lit(1).alias("index"), _text("C, ", F.col("s_nationkey").cast("string"), " (2005), pp. 393-395").alias("text"), F.struct(F.lit("Found").alias("title"), F.array(F.lit("Le Blanc K")).alias("authors")).alias("pubmed"))
    two = F.struct(F.lit(2).alias("index"), _text("Plain ", k).alias("text"), F.lit(None).cast("struct<title:string,authors:array<string>>").alias("pubmed"))
    supplier = _dealt(table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey"), "s_suppkey")
    given = supplier.select(_text("j/", k, ".json").alias("path"), article.alias("body"), F.to_json(F.struct(F.array(one, two).alias("records"))).alias("references"))
    return imports.imported(given)


@query("""
WITH s AS (SELECT s_suppkey AS k, s_nationkey AS n, s_name FROM supplier)
SELECT '10-5-' || k AS article_id, 'abs-p1' AS paragraph_id, 'Short < ' || k AS text, '' AS ref_ids, '' AS table_ids FROM s
UNION ALL SELECT '10-5-' || k, 's1-p1', 'As in [1,2] and [9-12] of ' || s_name || '. See Table 1 and Table 7.', 'B1|B2', CASE WHEN n % 2 = 0 THEN 'tbl1' ELSE '' END FROM s
UNION ALL SELECT '10-5-' || k, 's1-p2', 'No caption.', '', '' FROM s WHERE n % 2 = 1
UNION ALL SELECT '10-5-' || k, 's1-1-p1', 'Done & dusted.', '', '' FROM s
""")
def imported_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    """Paragraphs of articles from JSON, with links to the references and tables that exist."""
    joined = [F.array_join(c, "|").alias(c) for c in ("ref_ids", "table_ids")]
    return articles.article_tables(articles.parsed(_imported(spark, sf)))["paragraphs"].select("article_id", "paragraph_id", "text", *joined)


@query("""
WITH s AS (SELECT s_suppkey AS k, s_nationkey AS n FROM supplier)
SELECT '10-5-' || k AS article_id, CASE WHEN n % 2 = 0 THEN 'tbl1' ELSE 'tblx1' END AS xml_id, CASE WHEN n % 2 = 0 THEN 'Table 1' END AS label, CASE WHEN n % 2 = 0 THEN 'Doses.' END AS caption, 'a;b|' || k || ';2' AS content FROM s
UNION ALL SELECT '10-5-' || k, 'B1', '1.', 'Found', 'Le Blanc, K|' || n || '|393–395' FROM s
UNION ALL SELECT '10-5-' || k, 'B2', '2.', NULL, 'Plain ' || k FROM s
""")
def imported_items(spark: SparkSession, sf: str) -> DataFrame:
    """Tables and references of articles from JSON."""
    found = articles.article_tables(articles.parsed(_imported(spark, sf)))
    rows = F.array_join(F.transform("rows", lambda r: F.array_join(r, ";")), "|")
    references = found["references"].select("article_id", "xml_id", "label", F.col("title").alias("caption"), F.coalesce("raw", F.concat_ws("|", F.array_join("authors", ";"), "volume", "pages")).alias("content"))
    return found["tables"].select("article_id", "xml_id", "label", "caption", rows.alias("content")).unionByName(references)


@query("SELECT 'j/' || s_suppkey || '.json' AS path, CASE WHEN s_nationkey % 2 = 0 THEN 3 ELSE 2 END::BIGINT AS xrefs, 1::BIGINT AS tables, 'T & ' || s_suppkey AS title, (2000 + s_nationkey) || '-00-00' AS pub_date, 'J. K.' AS given_names, s_name AS surname FROM supplier")
def imported_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Links and tables of imported articles, and their heads."""
    made = _imported(spark, sf)
    counts = imports.import_counts(F.col("text"))
    found = articles.parsed(made).select("path", "meta")
    return made.select("path", counts["xrefs"].alias("xrefs"), counts["tables"].alias("tables")).join(found, "path").select("path", "xrefs", "tables", "meta.title", "meta.pub_date", F.col("meta.authors")[0]["given_names"].alias("given_names"), F.col("meta.authors")[0]["surname"].alias("surname"))


@query("SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 'body' WHEN 1 THEN 'references' ELSE 'error' END AS kind FROM nation")
def import_kinds(spark: SparkSession, sf: str) -> DataFrame:
    """What JSON documents are."""
    said = F.when(F.col("n_nationkey") % 3 == 0, '{"sections":[{}],"records":[1]}').when(F.col("n_nationkey") % 3 == 1, '{"records":[1],"sections":[]}').otherwise('{"other":1}')
    return table(spark, sf, "nation").select("n_nationkey", imports.kind_of(said).alias("kind"))


# ------------------------------------------------------------------ reading


_SQL_PAGES = f"""{_SECTIONS}, top AS (SELECT article_id, r, section_id, CASE WHEN section_id LIKE 'b%' THEN 'tail' END AS tail, coalesce(title, type) AS label, count(*) FILTER (section_id LIKE 'b%') OVER (PARTITION BY article_id) AS n_tail FROM s WHERE level = 1 AND part = 'sections'),
pages AS (SELECT article_id, 0 AS k, 'Abstract' AS label, NULL AS section_id FROM a UNION ALL SELECT article_id, r, label, section_id FROM top WHERE tail IS NULL OR n_tail = 1
  UNION ALL SELECT article_id, min(r), 'Back matter', 'b' FROM top WHERE tail IS NOT NULL AND n_tail > 1 GROUP BY article_id UNION ALL SELECT article_id, 99, 'References', NULL FROM a),
n AS (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY k) - 1 AS page FROM pages)"""


def _pages(found: dict[str, DataFrame]) -> DataFrame:
    return views.pages(found["articles"], found["sections"], found["references"], found["articles"].limit(0))


@query(f"WITH {_SQL_PAGES} SELECT article_id, page, label, lag(label) OVER w AS previous, lead(label) OVER w AS following FROM n WINDOW w AS (PARTITION BY article_id ORDER BY page)")
def page_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of parsed articles with the ones beside them."""
    return views.neighbours(_pages(_stored_tables(spark, sf, "sections", "references"))).select("article_id", "page", "label", "previous", "following")


_SQL_PLACES = _SQL_PAGES + ", " + _PARAGRAPHS.removeprefix(_ARTICLES + ", ") + """, placed AS (SELECT p.*, n.page AS page FROM p JOIN n ON n.article_id = p.article_id AND (CASE WHEN p.r < 3 THEN n.k = 0 ELSE n.section_id = string_split(p.section_id, '-')[1] OR n.section_id = 'b' AND p.section_id LIKE 'b%' END))"""


@query(f"WITH {_SQL_PLACES} SELECT article_id, paragraph_id, page FROM placed")
def paragraph_places(spark: SparkSession, sf: str) -> DataFrame:
    """The page of each paragraph (K6)."""
    found = _stored_tables(spark, sf, "sections", "references", "paragraphs")
    return views.paragraph_pages(_pages(found), found["paragraphs"])


@query(f"""WITH {_SQL_PLACES}, said AS (SELECT article_id, page, r, 1 AS rank, text FROM placed
  UNION ALL SELECT s.article_id, q.page, s.r, 0, s.title FROM s JOIN (SELECT DISTINCT article_id, page, string_split(section_id, '-')[1] AS top, section_id FROM placed) q ON q.article_id = s.article_id
    AND (CASE WHEN s.part = 'abstract' THEN q.section_id = s.section_id ELSE q.top = string_split(s.section_id, '-')[1] END) WHERE s.title IS NOT NULL)
SELECT article_id, page, row_number() OVER (PARTITION BY article_id, page ORDER BY r, rank) AS place, text FROM (SELECT DISTINCT article_id, page, r, rank, text FROM said)""")
def page_speech(spark: SparkSession, sf: str) -> DataFrame:
    """What is read out on each page: titles, then sentences."""
    found = _stored_tables(spark, sf, "sections", "references", "paragraphs")
    said = views.page_speech(_pages(found), found["sections"], found["paragraphs"])
    return said.select("article_id", "page", F.col("place").cast("long").alias("place"), F.array_join("parts", " ").alias("text"))


@query(f"""WITH {_PARAGRAPHS} SELECT article_id, paragraph_id, CASE WHEN paragraph_id = 's1-p2' THEN 'f1:Figure 1' END AS shown FROM p""")
def shown_figures(spark: SparkSession, sf: str) -> DataFrame:
    """Paragraphs with the figures that are shown behind them."""
    found = _stored_tables(spark, sf, "paragraphs", "figures")
    homes = citations.first_mentions(found["paragraphs"], found["figures"], "fig_ids")
    return views.with_placed(found["paragraphs"], homes, found["figures"]).select("article_id", "paragraph_id", F.array_join(F.transform("shown", lambda x: F.concat_ws(":", x["xml_id"], x["label"])), "|").alias("shown"))


@query(f"""WITH {_ARTICLES} SELECT article_id, p_name || ' of ' || p_type AS title, 'A. B. ' || p_brand || ', Group ' || z AS authors, CASE WHEN z % 3 = 0 THEN 'paragraph: ' || z || CASE WHEN z % 2 = 0 THEN ' · sentence: 1' ELSE '' END ELSE 'not enriched' END AS passes,
  ((z % 7 = 0)::INT + (z % 5 <> 0 AND z % 2 = 1)::INT)::BIGINT AS n_warnings FROM a""")
def overviews(spark: SparkSession, sf: str) -> DataFrame:
    """Heads of articles with what each pass has applied."""
    part = table(spark, sf, "part").where(_z() % 3 == 0)
    key = _text("10-1-", _k()).alias("article_id")
    records = part.select(key, F.lit("paragraph").alias("pass"), _z().alias("applied")).unionByName(part.where(_z() % 2 == 0).select(key, F.lit("sentence").alias("pass"), F.lit(1).alias("applied")))
    return views.overview(_tables(spark, sf, "meta", "warnings")["articles"], records).select("article_id", "title", "authors", "passes", "n_warnings")


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN 'a <mark class="ref">[1,2]</mark> &lt;b&gt; <mark class="hedge">may</mark> be' ELSE '<mark class="hedge">a [1</mark>,2] &lt;b&gt; may be' END AS shown FROM lineitem""")
def overlays(spark: SparkSession, sf: str) -> DataFrame:
    """Text with its decorations as marks; overlaps are dropped from the left, brackets go into the mark."""
    d = lambda a, b, kind: F.struct(F.lit(a).alias("start"), F.lit(b).alias("end"), F.lit(kind).alias("kind"))
    given = F.when(F.col("l_linenumber") % 2 == 0, F.array(d(12, 15, "hedge"), d(3, 6, "ref"), d(4, 5, "ref"), d(15, 99, "ref"))).otherwise(F.array(d(0, 4, "hedge"), d(3, 6, "ref"), d(8, 8, "ref")))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", views.overlaid(F.lit("a [1,2] <b> may be"), given).alias("shown"))
