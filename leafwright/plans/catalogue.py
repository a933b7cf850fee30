"""Named queries over the driver's tables and the SQL that must agree with them.

The tables hold no journal articles, so each query lays the operator's own columns over
one of them: lines are paragraphs, orders are articles, line items are spans, pages cite
what they link to. All run over whole tables.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.functions.headings import section_type_column
from leafwright.functions.vocabulary import PRICES, SOURCE_HEDGES, SUMMARY_HEDGES, TITLE_RULES
from leafwright.operators import annotate, citations, corpus, imports, sections, text, views
from leafwright.plans import article_queries  # noqa: F401 - puts its queries down
from leafwright.plans.registered import QUERIES, SQL, Query, query
from leafwright.session import table
from leafwright.sources import files

def queries() -> dict[str, Query]:
    """All queries of this package but those of the document operators."""
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


def _paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    return text.line_paragraphs(table(spark, sf, "documents"))


#: The blanks that occur in SQL's own class, and the rest of the model's, spelled out.
_SQL_BLANK = r"[\t\n\v\f\r \x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]+"
_SQL_LINES = f"""lines AS (SELECT doc_id, l.n AS ord, trim(regexp_replace(l.line, '{_SQL_BLANK}', ' ', 'g')) AS text
  FROM documents, unnest(string_split(documents.text, chr(10))) WITH ORDINALITY AS l(line, n))"""


def _sql_any(terms: tuple[str, ...]) -> str:
    body = "|".join(t.replace(r"\w", "[A-Za-z0-9_]").replace(r"\s", "[ ]") for t in terms)
    return f"(?i)(^|[^A-Za-z0-9_])({body})($|[^A-Za-z0-9_])"


# ------------------------------------------------------------------ text


@query()
def sentences(spark: SparkSession, sf: str) -> DataFrame:
    """Per document: paragraphs, sentences and their characters."""
    found = text.sentences(_paragraphs(spark, sf), "doc_id")
    return found.groupBy("doc_id").agg(F.count_distinct("paragraph_id").alias("n_paragraphs"), F.count(F.lit(1)).alias("n_sentences"), F.sum(F.length("sentence")).alias("n_chars"), F.max(F.length("sentence")).cast("long").alias("longest"))


@query(f"WITH {_SQL_LINES} SELECT doc_id, ord, 'p' || ord AS paragraph_id, sha256(text) AS text_sha256, length(text)::BIGINT AS n_chars FROM lines WHERE text <> ''")
def paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as normalised paragraphs."""
    return _paragraphs(spark, sf).select("doc_id", "ord", "paragraph_id", F.sha2("text", 256).alias("text_sha256"), F.length("text").cast("long").alias("n_chars"))


@query("SELECT sha256(text) AS sha256, count(*) AS n, min(doc_id) AS first FROM documents GROUP BY ALL")
def equal_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct texts by hash."""
    return text.distinct_by_hash(table(spark, sf, "documents"))


@query(f"""
WITH RECURSIVE w AS (SELECT doc_id, trim(regexp_replace(text, '{_SQL_BLANK}', ' ', 'g')) AS text FROM documents),
cut AS (
  SELECT doc_id, 0 AS chunk, '' AS piece, text AS rest FROM w WHERE text <> ''
  UNION ALL
  SELECT doc_id, chunk + 1, piece, ltrim(substr(rest, length(piece) + 1)) FROM (SELECT doc_id, chunk, rest, regexp_extract(rest, '^([^ ].{{0,239}})( |$)|^[^ ]+', 0).rtrim() AS piece FROM cut WHERE rest <> ''))
SELECT doc_id, chunk::BIGINT AS chunk, length(piece)::BIGINT AS n_chars FROM cut WHERE chunk > 0
""")
def utterances(spark: SparkSession, sf: str) -> DataFrame:
    """Texts in pieces of whole words up to 240 characters."""
    cut = table(spark, sf, "documents").select("doc_id", F.posexplode(text.chunks(F.col("text"))).alias("k", "piece"))
    return cut.select("doc_id", (F.col("k") + 1).cast("long").alias("chunk"), F.length("piece").cast("long").alias("n_chars"))


@query("SELECT doc_id, sha256(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')) AS escaped_sha256 FROM documents")
def escaped(spark: SparkSession, sf: str) -> DataFrame:
    """Text as XML."""
    return table(spark, sf, "documents").select("doc_id", F.sha2(text.xml_escaped(F.col("text")), 256).alias("escaped_sha256"))


@query(r"SELECT page_id, CASE WHEN url = '' THEN 'unknown' ELSE regexp_replace(regexp_replace(url, '^https?://(dx\.)?doi\.org/', ''), '[^a-zA-Z0-9]+', '-', 'g') END AS slug FROM pages")
def slugs(spark: SparkSession, sf: str) -> DataFrame:
    """Ids made of addresses."""
    return table(spark, sf, "pages").select("page_id", text.doi_slug(F.col("url")).alias("slug"))


@query("""
SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN p_type || '.jpg' WHEN 1 THEN p_type || '.jpg' WHEN 2 THEN p_type || '.png' ELSE p_type || '.jpg' END AS name FROM part
""")
def display_names(spark: SparkSession, sf: str) -> DataFrame:
    """Graphics under names that can be shown."""
    ending = F.element_at(F.array(F.lit(".tif"), F.lit(".TIFF"), F.lit(".png"), F.lit("")), F.col("p_size") % 4 + 1)
    return table(spark, sf, "part").select("p_partkey", text.display_name(F.concat("p_type", ending)).alias("name"))


@query("""
SELECT c_custkey, c_mktsegment || ' ' || substr(c_name, 1, 8) AS surname,
  CASE c_nationkey % 3 WHEN 0 THEN 'A. B.' WHEN 1 THEN 'J.' ELSE NULL END AS given,
  substr(c_name, 1, 8) AS last_surname, CASE c_nationkey % 2 WHEN 0 THEN 'E M' ELSE NULL END AS last_given FROM customer
""")
def author_names(spark: SparkSession, sf: str) -> DataFrame:
    """Names with leading and with trailing initials."""
    lead = F.element_at(F.array(F.lit("A. B. "), F.lit("J. "), F.lit("")), F.col("c_nationkey") % 3 + 1)
    name = F.substring("c_name", 1, 8)
    first = text.initials_first(F.concat(lead, "c_mktsegment", F.lit(" "), name))
    last = text.initials_last(F.concat(name, F.element_at(F.array(F.lit(" E M"), F.lit("")), F.col("c_nationkey") % 2 + 1)))
    return table(spark, sf, "customer").select("c_custkey", first["surname"].alias("surname"), first["given"].alias("given"), last["surname"].alias("last_surname"), last["given"].alias("last_given"))


# ------------------------------------------------------------------ classification


def _sql_rule(pattern: str) -> str:
    body = pattern
    return "(?i)" + body.replace("{b}", "(^|[^A-Za-z0-9_])").replace("{e}", "($|[^A-Za-z0-9_])").replace(r"\s", "[ ]").replace("'", "''")


_TITLES = ("1. Introduction", "2.1 Study Design", "Materials and Methods", "3 Results", "Case Report", "Discussion", "Strengths and limitations", "4.2. Experimental set-up", "Conflicts of Interest", "Flow Cytometry", "Background", "Data availability")
_SQL_TITLE = "[" + ", ".join(f"'{t}'" for t in _TITLES) + f"][(p_partkey % {len(_TITLES)})::INT + 1]"


def _sql_section() -> str:
    bare = r"trim(regexp_replace(title, '^[ ]*[0-9]+(\.[0-9]+)*\.?[ ]*', ''))"
    rules = []
    for pattern, kind, strong in TITLE_RULES:
        # Two edges that meet share one character, which a pattern without look-around cannot; the titles here have no such case.
        hit = f"regexp_matches({bare}, '{_sql_rule(pattern)}')"
        rules.append(f"WHEN {hit}{'' if strong else ' AND NOT (level > 1 AND parent IS NOT NULL)'} THEN '{kind}'")
    return f"""SELECT p_partkey, CASE WHEN sec_type = 'intro' THEN 'introduction' WHEN sec_type = 'ack' THEN 'acknowledgements' {' '.join(rules)}
      WHEN level > 1 AND parent IS NOT NULL THEN parent ELSE 'other' END AS type
    FROM (SELECT p_partkey, {_SQL_TITLE} AS title, (1 + p_size % 2) AS level, CASE p_size % 3 WHEN 0 THEN 'results' WHEN 1 THEN 'discussion' END AS parent,
      CASE p_size % 11 WHEN 0 THEN 'intro' WHEN 1 THEN 'ack' WHEN 2 THEN 'unknown' END AS sec_type FROM part)"""


@query(_sql_section())
def section_types(spark: SparkSession, sf: str) -> DataFrame:
    """Section types from @sec-type, title, level and parent."""
    title = F.element_at(F.array(*map(F.lit, _TITLES)), (F.col("p_partkey") % len(_TITLES) + 1).cast("int"))
    parent = F.when(F.col("p_size") % 3 == 0, "results").when(F.col("p_size") % 3 == 1, "discussion")
    sec = F.when(F.col("p_size") % 11 == 0, "intro").when(F.col("p_size") % 11 == 1, "ack").when(F.col("p_size") % 11 == 2, "unknown")
    return table(spark, sf, "part").select("p_partkey", section_type_column(title, sec, 1 + F.col("p_size") % 2, parent).alias("type"))




@query("""
WITH t AS (SELECT l_orderkey, list(CASE l_linenumber WHEN 1 THEN 'introduction' WHEN 2 THEN 'methods' WHEN 3 THEN 'results' WHEN 4 THEN 'discussion' ELSE 'other' END) AS types FROM lineitem GROUP BY l_orderkey),
a AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'case-report' ELSE 'research-article' END AS article_type, coalesce(types, []) AS types FROM orders LEFT JOIN t ON l_orderkey = o_orderkey)
SELECT o_orderkey, (CASE WHEN article_type = 'case-report' THEN 0 ELSE len(list_filter(['introduction', 'methods', 'results', 'discussion'], lambda x: NOT list_contains(types, x))) END)::BIGINT AS n_missing,
  2 * len(list_filter(types, lambda x: x = 'other')) > len(types) AS mostly_other FROM a
""")
def structure_audit(spark: SparkSession, sf: str) -> DataFrame:
    """What articles lack, with orders as articles and their items as sections (D3)."""
    kinds = F.array(*map(F.lit, ("introduction", "methods", "results", "discussion")))
    secs = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("article_id"), F.coalesce(F.try_element_at(kinds, F.col("l_linenumber")), F.lit("other")).alias("type"), F.lit(1).alias("level"), F.lit("sections").alias("part"), F.lit("s1").alias("section_id"))
    arts = table(spark, sf, "orders").select(F.col("o_orderkey").alias("article_id"), F.when(F.col("o_orderstatus") == "F", "case-report").otherwise("research-article").alias("article_type"))
    found = sections.audited(secs, arts)
    missing = F.size(F.filter("warnings", lambda w: w.startswith("missing"))).cast("long")
    return found.select(F.col("article_id").alias("o_orderkey"), missing.alias("n_missing"), F.exists("warnings", lambda w: w.startswith("most")).alias("mostly_other"))


@query(f"""WITH {_SQL_LINES}, j AS (SELECT doc_id, ord, lower(' ' || text) AS s FROM lines WHERE text <> '')
SELECT doc_id, ord, CASE WHEN regexp_matches(s, 'by-nc|noncommercial|non-commercial') THEN 'NC' WHEN regexp_matches(s, 'by-nd|noderiv') THEN 'ND'
  WHEN regexp_matches(s, 'creativecommons[.]org/licenses/by/|(^|[^a-z0-9_])cc[ -]?by($|[^a-z0-9_])') THEN 'CC BY' WHEN trim(s) = '' THEN 'none' ELSE 'undetermined' END AS basis FROM j""")
def licence_judgement(spark: SparkSession, sf: str) -> DataFrame:
    """Licence of each line."""
    return _paragraphs(spark, sf).select("doc_id", "ord", corpus.licence_basis(F.col("text"), F.lit("")).alias("basis"))


_ROLE = ("method", "result", "interpretation")


@query(f"""
WITH t AS (SELECT conv_id, turn, 'This may ' || role || ' and was ' || CASE turn % 3 WHEN 0 THEN 'indicated' WHEN 1 THEN 'found' ELSE 'not yet shown' END || '.' AS plain,
  CASE WHEN turn % 2 = 0 THEN 'Results suggest an effect. ' ELSE 'Maybe. ' END || text AS source, ['method', 'result', 'interpretation'][(conv_id % 3)::INT + 1] AS kind, turn % 5 = 0 AS bare FROM conversations)
SELECT conv_id, turn, regexp_matches(source, '{_sql_any(SOURCE_HEDGES)}') AS source_hedge, regexp_matches(CASE WHEN bare THEN 'It was found.' ELSE plain END, '{_sql_any(SOURCE_HEDGES + SUMMARY_HEDGES)}') AS summary_hedge,
  kind <> 'method' AND regexp_matches(source, '{_sql_any(SOURCE_HEDGES)}') AND NOT regexp_matches(CASE WHEN bare THEN 'It was found.' ELSE plain END, '{_sql_any(SOURCE_HEDGES + SUMMARY_HEDGES)}') AS lost FROM t
""")
def hedge_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Hedges in sources and summaries, and those that a summary loses."""
    from leafwright.functions.vocabulary import SOURCE_HEDGE, SUMMARY_HEDGE

    turns = table(spark, sf, "conversations")
    said = F.element_at(F.array(F.lit("indicated"), F.lit("found"), F.lit("not yet shown")), (F.col("turn") % 3 + 1).cast("int"))
    plain = F.when(F.col("turn") % 5 == 0, F.lit("It was found.")).otherwise(F.concat(F.lit("This may "), "role", F.lit(" and was "), said, F.lit(".")))
    source = F.concat(F.when(F.col("turn") % 2 == 0, "Results suggest an effect. ").otherwise("Maybe. "), "text")
    kind = F.element_at(F.array(*map(F.lit, _ROLE)), (F.col("conv_id") % 3 + 1).cast("int"))
    return turns.select("conv_id", "turn", source.rlike(SOURCE_HEDGE).alias("source_hedge"), plain.rlike(SUMMARY_HEDGE).alias("summary_hedge"), annotate.hedge_lost(kind, source, plain).alias("lost"))


# ------------------------------------------------------------------ citations and placement


def _cited(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as articles, items as paragraphs that cite their part and their supplier."""
    item = table(spark, sf, "lineitem")
    return item.select(
        F.col("l_orderkey").alias("article_id"), F.concat(F.lit("p"), F.col("l_linenumber").cast("string")).alias("paragraph_id"), F.col("l_linenumber").cast("long").alias("ord"),
        F.array(F.concat(F.lit("f"), (F.col("l_partkey") % 5).cast("string")), F.concat(F.lit("f"), (F.col("l_suppkey") % 7).cast("string"))).alias("fig_ids"),
    )


def _figures(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("article_id"), F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(4)), lambda k: F.concat(F.lit("f"), k.cast("string")))).alias("ord", "xml_id"))


_SQL_CITED = """named AS (SELECT l_orderkey AS article_id, l_linenumber AS ord, 'f' || unnest([l_partkey % 5, l_suppkey % 7]) AS xml_id FROM lineitem),
figs AS (SELECT o_orderkey AS article_id, 'f' || unnest(range(0, 5)) AS xml_id FROM orders),
home AS (SELECT n.article_id, n.xml_id, 'p' || min(ord) AS paragraph_id FROM named n JOIN figs f ON n.article_id = f.article_id AND n.xml_id = f.xml_id GROUP BY ALL)"""


@query(f"WITH {_SQL_CITED} SELECT * FROM home")
def first_mention(spark: SparkSession, sf: str) -> DataFrame:
    """The first paragraph that names each figure."""
    return citations.first_mentions(_cited(spark, sf), _figures(spark, sf), "fig_ids")


@query(f"WITH {_SQL_CITED.split('home AS')[0].rstrip().rstrip(',')} SELECT article_id, xml_id FROM figs EXCEPT SELECT article_id, xml_id FROM named")
def orphans(spark: SparkSession, sf: str) -> DataFrame:
    """Figures that no paragraph names."""
    return citations.unnamed(_figures(spark, sf), _cited(spark, sf), "fig_ids").select("article_id", "xml_id")


@query(f"WITH {_SQL_CITED} SELECT n.article_id, n.ord::BIGINT AS ord, n.xml_id, f.xml_id IS NOT NULL AS resolved FROM named n LEFT JOIN figs f ON n.article_id = f.article_id AND n.xml_id = f.xml_id")
def cited_targets(spark: SparkSession, sf: str) -> DataFrame:
    """Each id that a paragraph names, and whether it exists."""
    known = _figures(spark, sf).select("article_id", "xml_id", F.lit(True).alias("known"))
    return citations.cited(_cited(spark, sf), known, "fig_ids").select("article_id", "ord", "xml_id", F.col("known").isNotNull().alias("resolved"))


@query("""
WITH refs AS (SELECT l_orderkey AS article_id, coalesce(CASE WHEN l_linenumber % 2 = 0 THEN l_linenumber END, l_linenumber)::BIGINT AS number, 'r' || l_linenumber AS xml_id, l_linenumber AS k FROM lineitem),
pairs AS (SELECT l_orderkey AS article_id, l_linenumber::BIGINT AS a, (l_linenumber + l_quantity)::BIGINT AS b, l_linenumber % 3 <> 0 AS dash FROM lineitem),
inner_numbers AS (SELECT article_id, a, b, unnest(range(a + 1, b)) AS number FROM pairs WHERE dash AND b > a AND b - a <= 30)
SELECT i.article_id, i.a, i.b, i.number, min(r.xml_id) AS xml_id FROM inner_numbers i LEFT JOIN refs r ON r.article_id = i.article_id AND r.number = i.number GROUP BY i.article_id, i.a, i.b, i.number
""")
def citation_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers inside citation ranges, and the references they stand for."""
    item = table(spark, sf, "lineitem")
    label = F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.col("l_linenumber").cast("string"), F.lit(".")))
    refs = item.select(F.col("l_orderkey").alias("article_id"), label.alias("label"), F.concat(F.lit("r"), F.col("l_linenumber").cast("string")).alias("xml_id"), (F.col("l_linenumber") - 1).cast("long").alias("ord"))
    last = (F.col("l_linenumber") + F.col("l_quantity")).cast("long")
    pairs = item.select(F.col("l_orderkey").alias("article_id"), F.col("l_linenumber").cast("string").alias("first"), last.cast("string").alias("last"), F.when(F.col("l_linenumber") % 3 == 0, ", ").when(F.col("l_linenumber") % 3 == 1, " - ").otherwise("–").alias("between"))
    found = citations.opened_ranges(pairs.withColumn("between", citations.separator(F.col("between"))).distinct(), refs)
    return found.select("article_id", F.col("first").cast("long").alias("a"), F.col("last").cast("long").alias("b"), "number", "xml_id")


@query("""
WITH RECURSIVE spans AS (SELECT l_orderkey, (l_partkey % 50)::BIGINT AS a, (l_partkey % 50 + l_quantity % 12)::BIGINT AS b, l_linenumber AS n FROM lineitem),
ranked AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY a, b DESC, n) AS k FROM spans),
swept AS (SELECT l_orderkey, a, b, k, b > a AS kept, CASE WHEN b > a THEN b ELSE -1 END AS reach FROM ranked WHERE k = 1
  UNION ALL SELECT r.l_orderkey, r.a, r.b, r.k, r.a >= s.reach AND r.b > r.a, CASE WHEN r.a >= s.reach AND r.b > r.a THEN r.b ELSE s.reach END FROM swept s JOIN ranked r ON r.l_orderkey = s.l_orderkey AND r.k = s.k + 1)
SELECT l_orderkey, count(*)::BIGINT AS n_kept, sum(b - a)::BIGINT AS covered FROM swept WHERE kept GROUP BY l_orderkey
""")
def kept_decorations(spark: SparkSession, sf: str) -> DataFrame:
    """Spans that stay when overlaps are dropped from the left."""
    item = table(spark, sf, "lineitem")
    start = (F.col("l_partkey") % 50).cast("long")
    span = F.struct(start.alias("start"), (start + F.col("l_quantity").cast("long") % 12).alias("end"))
    kept = item.groupBy("l_orderkey").agg(citations.without_overlap(F.collect_list(span)).alias("kept"))
    return kept.where(F.size("kept") > 0).select("l_orderkey", F.size("kept").cast("long").alias("n_kept"), F.aggregate("kept", F.lit(0).cast("long"), lambda t, s: t + s["end"] - s["start"]).alias("covered"))


@query("""
WITH d AS (SELECT l_orderkey, l_linenumber, 3 * l_linenumber AS a, 3 * l_linenumber + 1 AS b, CASE WHEN max(l_returnflag) = 'R' THEN 'hedge' ELSE 'ref' END AS kind FROM lineitem GROUP BY l_orderkey, l_linenumber),
m AS (SELECT *, lag(kind) OVER w AS was, substr('a b , x– ; ab, c - z,,d', lag(b) OVER w + 1, a - lag(b) OVER w) AS gap FROM d WINDOW w AS (PARTITION BY l_orderkey ORDER BY a, b)),
r AS (SELECT *, sum(CASE WHEN was = 'ref' AND kind = 'ref' AND regexp_matches(gap, '^[ ,;–—-]*$') THEN 0 ELSE 1 END) OVER (PARTITION BY l_orderkey ORDER BY a, b) AS run FROM m)
SELECT l_orderkey, run::BIGINT AS run, count(*) AS n FROM r GROUP BY ALL
""")
def citation_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbouring citations with only separators between them."""
    kind = F.when(F.col("flag") == "R", "hedge").otherwise("ref")
    items = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_returnflag").alias("flag"))
    marks = items.select("l_orderkey", (3 * F.col("l_linenumber")).alias("start"), (3 * F.col("l_linenumber") + 1).alias("end"), kind.alias("kind"), F.lit("a b , x– ; ab, c - z,,d").alias("text"))
    return citations.citation_runs(marks, ["l_orderkey"]).groupBy("l_orderkey", "run").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ annotation


def _units(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as articles and turns as paragraphs with a few sentences of one character."""
    spans = F.transform(F.sequence(F.lit(1), F.col("turn").cast("int") % 4 + 1), lambda k: F.struct(F.concat(F.lit("p"), F.col("turn").cast("string"), F.lit("-s"), k.cast("string")).alias("sentence_id"), (k - 1).alias("start"), k.alias("end")))
    kind = F.element_at(F.array(*map(F.lit, ("abstract", "methods", "results", "funding"))), (F.col("turn") % 4 + 1).cast("int"))
    return table(spark, sf, "conversations").select(F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("article_id"), F.concat(F.lit("p"), F.col("turn").cast("string")).alias("paragraph_id"), F.col("turn").alias("ord"), kind.alias("section_type"), F.col("role").alias("section_title"), "text", spans.alias("sentences"))


_SQL_UNITS = """u AS (SELECT 'c' || conv_id AS article_id, 'p' || turn AS paragraph_id, turn AS ord, (turn % 4 + 1)::BIGINT AS n, ['abstract', 'methods', 'results', 'funding'][(turn % 4)::INT + 1] AS section_type,
  substr(sha256('{"model":"m","promptVersion":"paragraph-1","text":' || to_json(text)::VARCHAR || ',"sentences":[' || array_to_string(list_transform(range(1, turn % 4 + 2), lambda k: '[' || (k - 1) || ',' || k || ']'), ',') || ']}'), 1, 32) AS cache_key FROM conversations)"""


@query(f"WITH {_SQL_UNITS} SELECT article_id, paragraph_id, cache_key FROM u WHERE section_type <> 'funding'")
def cache_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Units of the paragraph pass with their content keys."""
    return annotate.units(_units(spark, sf), annotate.PARAGRAPH, "m").select("article_id", "paragraph_id", "cache_key")


@query(f"""WITH RECURSIVE {_SQL_UNITS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY ord) AS k FROM u WHERE section_type <> 'funding'),
packed AS (SELECT article_id, paragraph_id, k, n AS used, 0 AS batch FROM ranked WHERE k = 1
  UNION ALL SELECT r.article_id, r.paragraph_id, r.k, CASE WHEN p.used + r.n > 4 THEN r.n ELSE p.used + r.n END, p.batch + CASE WHEN p.used + r.n > 4 THEN 1 ELSE 0 END FROM packed p JOIN ranked r ON r.article_id = p.article_id AND r.k = p.k + 1)
SELECT article_id, paragraph_id, batch::BIGINT AS batch FROM packed""")
def batches(spark: SparkSession, sf: str) -> DataFrame:
    """Units in batches of at most four sentences (G1)."""
    return annotate.batched(annotate.units(_units(spark, sf), annotate.PARAGRAPH, "m"), 4).select("article_id", "paragraph_id", "batch")


def _cache(spark: SparkSession, sf: str) -> DataFrame:
    known = annotate.units(_units(spark, sf), annotate.PARAGRAPH, "m").where("ord % 3 = 0")
    return known.select(F.lit("paragraph").alias("pass"), "cache_key", F.when(F.col("ord") % 6 == 0, "result").otherwise("no such role").alias("role"), F.lit("g").alias("gist"), F.lit("p").alias("plain"), F.lit(None).cast(annotate.RESULT.rsplit("sentences ", 1)[1]).alias("sentences"))


@query(f"""WITH {_SQL_UNITS}, good AS (SELECT DISTINCT cache_key FROM u WHERE section_type <> 'funding' AND ord % 3 = 0 AND ord % 6 = 0),
 bad AS (SELECT DISTINCT cache_key FROM u WHERE section_type <> 'funding' AND ord % 3 = 0 AND ord % 6 <> 0)
SELECT article_id, count(*) AS n_units, sum(n)::BIGINT AS n_sentences, count(*) FILTER (cache_key IN (SELECT cache_key FROM good)) AS n_cached FROM u WHERE section_type <> 'funding' GROUP BY article_id""")
def cache_probe(spark: SparkSession, sf: str) -> DataFrame:
    """Hits and misses of the cache; entries that don't validate are misses."""
    looked = annotate.probed(annotate.units(_units(spark, sf), annotate.PARAGRAPH, "m"), _cache(spark, sf), annotate.PARAGRAPH)
    return annotate.estimate(looked, annotate.PARAGRAPH).select("article_id", "n_units", "n_sentences", "n_cached")


def _paragraph_caller(_: str, batch: list[dict]) -> str:
    """Answers that are good, missing, of an unknown role, given twice, empty, or of an unknown paragraph, by the turn's number."""
    rows = []
    for u in batch:
        good = {"id": u["paragraph_id"], "role": ("method", "result", "claim")[u["ord"] % 3], "gist": f" gist {u['ord']} ", "plain": "It was found." if u["ord"] % 2 else f"May be {u['ord']}."}
        case = u["ord"] % 7
        rows += [] if case == 1 else [good | {"role": "no such"}] if case == 2 else [good, good | {"gist": "again"}] if case == 3 else [good | {"plain": "  "}] if case == 4 else [good]
        rows += [good | {"id": f"x{u['ord']}"}] if case == 5 else []
    return json.dumps({"paragraphs": rows})


_SQL_ANSWERS = f"""{_SQL_UNITS}, c AS (SELECT conv_id, 'c' || conv_id AS article_id, 'p' || turn AS paragraph_id, turn, text FROM conversations),
r AS (SELECT c.article_id, c.paragraph_id, turn, turn % 7 AS kase, section_type <> 'funding' AS asked, ['method', 'result', 'claim'][(turn % 3)::INT + 1] AS role, CASE WHEN turn % 2 = 1 THEN 'It was found.' ELSE 'May be ' || turn || '.' END AS plain,
  regexp_matches(c.text, '{_sql_any(SOURCE_HEDGES)}') AS hedges FROM c JOIN u ON u.article_id = c.article_id AND u.ord = c.turn),
g AS (SELECT *, asked AND kase NOT IN (1, 2, 4) AS good FROM r), w AS (SELECT *, good AND role <> 'method' AND hedges AND turn % 2 = 1 AS lost FROM g)"""


@query(f"""WITH {_SQL_ANSWERS} SELECT article_id, paragraph_id, good AS applied, CASE WHEN good THEN role END AS role, CASE WHEN good THEN 'gist ' || turn END AS gist, CASE WHEN good THEN plain END AS plain, CASE WHEN lost THEN paragraph_id || ': source hedges, summary does not' ELSE '' END AS warned FROM w""")
def annotated(spark: SparkSession, sf: str) -> DataFrame:
    """A whole run of the paragraph pass, row by row: units, batches, calls, validation, merge."""
    run = annotate.annotate(_units(spark, sf), _cache(spark, sf).limit(0), annotate.PARAGRAPH, "m", _paragraph_caller)
    return run.paragraphs.select("article_id", "paragraph_id", "applied", "role", "gist", "plain", F.array_join("merge_warnings", "|").alias("warned"))


@query(f"""WITH {_SQL_ANSWERS} SELECT article_id, 'paragraph' AS pass, 'm' AS model, 'paragraph-1' AS prompt_version, count(*) FILTER (good) AS applied, 0::BIGINT AS cached,
  sum(CASE WHEN NOT asked THEN 0 WHEN kase IN (2, 4) THEN 2 WHEN kase IN (1, 3, 5) THEN 1 ELSE 0 END + CASE WHEN lost THEN 1 ELSE 0 END)::BIGINT AS n_warnings FROM w GROUP BY article_id""")
def annotation_records(spark: SparkSession, sf: str) -> DataFrame:
    """What a run notes for each article."""
    run = annotate.annotate(_units(spark, sf), _cache(spark, sf).limit(0), annotate.PARAGRAPH, "m", _paragraph_caller)
    return run.record.select("article_id", "pass", "model", "prompt_version", "applied", F.col("cached").cast("long").alias("cached"), F.size("warnings").cast("long").alias("n_warnings"))


@query(f"WITH {_SQL_ANSWERS} SELECT DISTINCT u.cache_key FROM w JOIN u ON u.article_id = w.article_id AND u.paragraph_id = w.paragraph_id WHERE good")
def annotation_cache(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that a run adds to an empty cache: complete answers only."""
    return annotate.annotate(_units(spark, sf), _cache(spark, sf).limit(0), annotate.PARAGRAPH, "m", _paragraph_caller).cache.select("cache_key")


def _sentence_caller(_: str, batch: list[dict]) -> str:
    """Every sentence but the last of each third paragraph, with one quote that is there and one that leaves the sentence."""
    rows = []
    for u in batch:
        for k, s in enumerate(u["sentences"]):
            if u["ord"] % 3 != 1 or k + 1 < len(u["sentences"]):
                said = u["text"][s["start"] : s["end"]]
                stats = [{"quote": said, "metric": "m", "value": 1.5, "unit": 7, "p": True}, {"quote": u["text"][s["start"] : s["end"] + 30] + "#", "value": 2}]
                rows.append({"id": s["sentence_id"], "certainty": "hedged" if u["ord"] % 2 else "bogus" if k == 2 else "measured", "hedges": [f" {said} ", "zzz no such text", 5], "stats": stats})
    return json.dumps({"sentences": rows})


@query(r"""
WITH u AS (SELECT 'c' || conv_id AS article_id, 'p' || turn AS paragraph_id, turn, text, ['abstract', 'methods', 'results', 'funding'][(turn % 4)::INT + 1] AS section_type, unnest(range(1, turn % 4 + 2)) AS k FROM conversations),
s AS (SELECT *, section_type IN ('abstract', 'results') AND NOT (turn % 3 = 1 AND k = turn % 4 + 1) AND (turn % 2 = 1 OR k <> 3) AS answered, regexp_replace(substr(text, k, 1), '^\s+$', '') <> '' AS there FROM u)
SELECT article_id, paragraph_id, paragraph_id || '-s' || k AS sentence_id, CASE WHEN answered THEN CASE WHEN turn % 2 = 1 THEN 'hedged' ELSE 'measured' END END AS certainty,
  CASE WHEN answered AND there THEN (k - 1) || '-' || k ELSE '' END AS hedges, CASE WHEN answered AND there THEN 'm:1.5:' || (k - 1) || '-' || k ELSE '' END AS stats FROM s
""")
def annotated_sentences(spark: SparkSession, sf: str) -> DataFrame:
    """A whole run of the sentence pass: quotes become spans, those outside their sentence are dropped."""
    run = annotate.annotate(_units(spark, sf), _cache(spark, sf).limit(0), annotate.SENTENCE, "m", _sentence_caller)
    each = run.paragraphs.select("article_id", "paragraph_id", F.explode("sentences").alias("s"))
    span = lambda x: F.concat_ws("-", x["start"].cast("string"), x["end"].cast("string"))
    stats = F.transform("s.stats", lambda x: F.concat_ws(":", x["metric"], x["value"].cast("string"), x["unit"], x["p"].cast("string"), span(x)))
    none = F.lit("")
    return each.select("article_id", "paragraph_id", "s.sentence_id", "s.certainty", F.coalesce(F.array_join(F.transform("s.hedges", span), "|"), none).alias("hedges"), F.coalesce(F.array_join(stats, "|"), none).alias("stats"))


@query(r"""
WITH q AS (SELECT doc_id, text, length(text) // 3 AS a, 2 * length(text) // 3 AS b, regexp_replace(substr(text, length(text) // 3 + 1 + (doc_id % 5)::INT, 6), '^\s+|\s+$', '', 'g') AS bare FROM documents),
f AS (SELECT *, instr(substr(text, a + 1), bare) AS pos FROM q), g AS (SELECT *, (a + pos - 1)::BIGINT AS start, bare <> '' AND pos > 0 AND a + pos - 1 + length(bare) <= b AS good FROM f)
SELECT doc_id, CASE WHEN good THEN start END AS start, CASE WHEN good THEN start + length(bare) END AS "end" FROM g
""")
def quote_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Quotes found verbatim inside a span."""
    docs = table(spark, sf, "documents")
    a, b = F.floor(F.length("text") / 3).cast("int"), F.floor(2 * F.length("text") / 3).cast("int")
    quote = F.substring(F.col("text"), a + 1 + (F.col("doc_id") % 5).cast("int"), F.lit(6))
    found = docs.select("doc_id", annotate.quote_span_column(F.col("text"), a, b, quote).alias("span"))
    return found.select("doc_id", F.col("span.start").cast("long").alias("start"), F.col("span.end").cast("long").alias("end"))


_SQL_PRICES = ", ".join(f"('{k}', {a}, {b})" for k, (a, b) in PRICES.items())


@query(f"""WITH p(model, i, o) AS (VALUES {_SQL_PRICES}), t AS (SELECT CASE role WHEN 'user' THEN 'small' WHEN 'assistant' THEN 'large' ELSE 'unlisted' END AS model, sum(length(text))::BIGINT AS input_tokens, sum(turn)::BIGINT AS output_tokens FROM conversations GROUP BY 1)
SELECT t.model, input_tokens, output_tokens, (input_tokens * i + output_tokens * o) / 1e6 AS cost FROM t LEFT JOIN p ON p.model = t.model""")
def usage_cost(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens and price by tier."""
    tier = F.when(F.col("role") == "user", "small").when(F.col("role") == "assistant", "large").otherwise("unlisted")
    return annotate.cost(table(spark, sf, "conversations").select(tier.alias("model"), F.length("text").cast("long").alias("input_tokens"), F.col("turn").alias("output_tokens")))


# ------------------------------------------------------------------ corpus


def _manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as papers on record."""
    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey")
    return table(spark, sf, "customer").select(
        F.concat(F.lit("a"), key).alias("article_id"), F.concat(F.lit("10.1/X"), key).alias("doi"), F.when(nation % 2 == 0, F.concat(F.lit("PMC"), key)).alias("pmcid"), F.lit(None).cast("string").alias("pmid"), F.col("c_name").alias("title"),
        F.lit(None).cast("string").alias("first_author"), F.lit(None).cast("string").alias("journal"), F.lit(None).cast("string").alias("year"), F.lit(None).cast("string").alias("license_url"), F.lit(None).cast("string").alias("license_text"),
        (nation % 3 == 0).alias("redistributable"), F.when(nation % 5 == 0, "manual").otherwise("CC BY").alias("license_basis"), F.when(nation % 4 != 0, F.concat(key, F.lit(".xml"))).alias("file"), F.lit("0").alias("sha256"), F.lit(None).cast("string").alias("fetch"),
    )


def _found(spark: SparkSession, sf: str) -> DataFrame:
    base = _manifest(spark, sf)
    new = base.where("cast(substring(article_id, 2) AS long) % 3 <> 0").withColumn("title", F.concat(F.lit("new "), "title")).withColumn("redistributable", F.lit(False)).withColumn("license_basis", F.lit("NC"))
    return new.unionByName(new.where("cast(substring(article_id, 2) AS long) % 7 = 1").withColumn("article_id", F.concat(F.lit("b"), "article_id")))


_SQL_MANIFEST = "m AS (SELECT 'a' || c_custkey AS article_id, c_custkey AS k, c_name AS title, c_nationkey AS n, c_nationkey % 3 = 0 AS redistributable, CASE WHEN c_nationkey % 5 = 0 THEN 'manual' ELSE 'CC BY' END AS license_basis FROM customer)"


@query(f"""WITH {_SQL_MANIFEST}, f0 AS (SELECT * FROM m WHERE k % 3 <> 0),
f AS (SELECT article_id, 'new ' || title AS title FROM f0 UNION ALL SELECT 'b' || article_id, 'new ' || title FROM f0 WHERE k % 7 = 1)
SELECT coalesce(f.article_id, m.article_id) AS article_id, coalesce(f.title, m.title) AS title,
  CASE WHEN f.article_id IS NULL OR m.license_basis = 'manual' THEN m.redistributable ELSE false END AS redistributable, CASE WHEN f.article_id IS NULL OR m.license_basis = 'manual' THEN m.license_basis ELSE 'NC' END AS license_basis
FROM m FULL JOIN f ON f.article_id = m.article_id""")
def manifest_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Found entries over known ones; decisions by hand stay."""
    return corpus.upserted(_manifest(spark, sf), _found(spark, sf)).select("article_id", "title", "redistributable", "license_basis")


@query(f"""WITH {_SQL_MANIFEST}, a AS (SELECT article_id, CASE WHEN k % 2 = 0 THEN 'public' ELSE 'private' END AS root FROM m UNION ALL SELECT 'x' || article_id, 'public' FROM m WHERE k % 10 = 0)
SELECT a.article_id, a.root, CASE WHEN coalesce(m.redistributable, false) THEN 'public' ELSE 'private' END AS wanted FROM a LEFT JOIN m ON m.article_id = a.article_id WHERE a.root <> CASE WHEN coalesce(m.redistributable, false) THEN 'public' ELSE 'private' END""")
def misplaced(spark: SparkSession, sf: str) -> DataFrame:
    """Articles under the wrong root; without an entry, private is right."""
    known = _manifest(spark, sf)
    even = F.substring("article_id", 2, 20).cast("long")
    arts = known.select("article_id", F.when(even % 2 == 0, "public").otherwise("private").alias("root")).unionByName(known.where(even % 10 == 0).select(F.concat(F.lit("x"), "article_id").alias("article_id"), F.lit("public").alias("root")))
    return corpus.misplaced(arts, known)


@query(f"""WITH {_SQL_MANIFEST}, s AS (SELECT article_id, k, n, redistributable, k % 4 = 0 AS j, n % 4 <> 0 AND k % 4 < 2 AND redistributable AS x FROM m)
SELECT article_id, CASE WHEN j THEN 'ready' WHEN x THEN 'buildable' WHEN NOT redistributable AND n % 2 = 0 AND n % 4 <> 0 THEN 'fetchable' ELSE 'manual' END AS status FROM s""")
def paper_status(spark: SparkSession, sf: str) -> DataFrame:
    """What can be done with each paper on record."""
    known = _manifest(spark, sf)
    key = F.substring("article_id", 2, 20).cast("long")
    return corpus.with_status(known, known.where(key % 4 == 0).select("article_id"), known.where((key % 4 < 2) & F.col("file").isNotNull()).select("file", F.lit("public").alias("root"))).select("article_id", "status")


@query(f"""WITH {_SQL_MANIFEST}, asked AS (SELECT lower('10.1/x' || k) AS wanted FROM m WHERE k % 5 = 0 UNION SELECT lower(article_id) FROM m WHERE k % 7 = 0 UNION SELECT 'nothing'),
keys AS (SELECT article_id, unnest([lower(article_id), lower('10.1/X' || k), CASE WHEN n % 2 = 0 THEN 'pmc' || k END]) AS wanted FROM m WHERE NOT redistributable)
SELECT a.wanted, k.article_id FROM asked a LEFT JOIN keys k ON k.wanted = a.wanted""")
def paper_selection(spark: SparkSession, sf: str) -> DataFrame:
    """Private papers by id, DOI or PMCID in any case."""
    known = _manifest(spark, sf)
    key = F.substring("article_id", 2, 20).cast("long")
    asked = known.where(key % 5 == 0).select(F.col("doi").alias("key")).unionByName(known.where(key % 7 == 0).select(F.upper("article_id").alias("key"))).unionByName(spark.createDataFrame([("nothing",)], "key string"))
    return corpus.selected(known, asked)


@query(f"WITH {_SQL_MANIFEST} SELECT count(*) AS n, count(*) FILTER (k % 4 = 0) AS present, count(*) FILTER (k % 4 <> 0) AS missing, count(*) FILTER (redistributable) AS tracked, count(*) FILTER (NOT redistributable) AS excluded FROM m")
def manifest_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Papers by presence and licence."""
    known = _manifest(spark, sf)
    return corpus.totals(known, known.where("cast(substring(article_id, 2) AS long) % 4 = 0"))


@query("""
WITH o AS (SELECT doc_id, text, CASE WHEN doc_id % 7 = 0 THEN text || '!' ELSE text END AS new_text, CASE WHEN doc_id % 3 <> 0 THEN 'result' END AS role FROM documents WHERE doc_id % 11 <> 0)
SELECT d.doc_id, CASE WHEN o.new_text = o.text THEN o.role END AS role, coalesce(o.new_text = o.text AND o.role IS NOT NULL, false) AS carried,
  CASE WHEN o.new_text = o.text AND d.doc_id % 5 <> 0 THEN 'measured' END AS certainty FROM documents d LEFT JOIN o ON o.doc_id = d.doc_id
""")
def carry_forward(spark: SparkSession, sf: str) -> DataFrame:
    """Annotations that outlive a rebuild: same text, and for sentences same spans (E5)."""
    docs = table(spark, sf, "documents")
    key = F.col("doc_id").cast("string")
    rows = lambda df, body, role, end, certainty: df.select(
        "doc_id", key.alias("article_id"), F.lit("p1").alias("paragraph_id"), body.alias("text"), role.alias("role"), F.lit(None).cast("string").alias("gist"), F.lit(None).cast("string").alias("plain"),
        F.array(F.struct(F.lit("s1").alias("sentence_id"), F.lit(0).alias("start"), end.alias("end"), certainty.alias("certainty"), F.lit(None).cast(annotate.SPANS).alias("hedges"), F.lit(None).cast(annotate.STATS).alias("stats"))).alias("sentences"),
    )
    none = F.lit(None).cast("string")
    old = rows(docs.where("doc_id % 11 <> 0"), F.col("text"), F.when(F.col("doc_id") % 3 != 0, "result"), F.lit(5), F.lit("measured"))
    new = rows(docs, F.when((F.col("doc_id") % 7 == 0) & (F.col("doc_id") % 11 != 0), F.concat("text", F.lit("!"))).otherwise(F.col("text")), none, F.when(F.col("doc_id") % 5 == 0, 6).otherwise(5), none)
    return corpus.carried(old.drop("doc_id"), new).select("doc_id", "role", "carried", F.col("sentences")[0]["certainty"].alias("certainty"))


@query(f"""WITH {_SQL_UNITS}, c AS (SELECT article_id, cache_key, CAST(substr(article_id, 2) AS BIGINT) AS k FROM u), cleared AS (SELECT DISTINCT cache_key FROM c WHERE k % 2 = 0)
SELECT DISTINCT cache_key FROM c WHERE cache_key NOT IN (SELECT cache_key FROM cleared)""")
def orphaned_cache(spark: SparkSession, sf: str) -> DataFrame:
    """Public cache entries that no cleared article claims."""
    found = _units(spark, sf)
    records = found.select("article_id", F.lit("m").alias("model"), F.lit("paragraph-1").alias("prompt_version")).distinct()
    owned = corpus.owned_cache_keys(found, records)
    cleared = records.select("article_id", (F.substring("article_id", 2, 20).cast("long") % 2 == 0).alias("redistributable"))
    stored = corpus.keys_for(found, "m", "paragraph-1").select("cache_key", F.lit("public").alias("root")).distinct()
    return corpus.orphaned_cache(stored, owned, cleared).select("cache_key")


@query("""
WITH f AS (SELECT doc_id, sha256(text) AS sha256 FROM documents), known AS (SELECT sha256(text) AS sha256 FROM documents WHERE doc_id % 2 = 0)
SELECT doc_id FROM f WHERE sha256 NOT IN (SELECT sha256 FROM known)
""")
def new_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files whose content was never built (A1, A2, Q16)."""
    docs = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))
    return files.only_new(docs, docs.where("doc_id % 2 = 0")).select("doc_id")


@query("""
WITH r AS (SELECT o_orderkey % 5000 AS k, o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'private' ELSE 'public' END AS root FROM orders), n AS (SELECT k, root, min(o_orderkey) AS o_orderkey FROM r GROUP BY k, root)
SELECT k, arg_min(root, CASE root WHEN 'public' THEN 0 ELSE 1 END) AS root FROM n GROUP BY k
""")
def preferred_root(spark: SparkSession, sf: str) -> DataFrame:
    """One row a key over both roots, the public one first."""
    orders = table(spark, sf, "orders").select((F.col("o_orderkey") % 5000).alias("k"), "o_orderstatus")
    rows = files.over_roots({"public": orders.where("o_orderstatus <> 'F'").select("k").distinct(), "private": orders.where("o_orderstatus = 'F'").select("k").distinct()})
    return files.preferred(rows, "k").select("k", "root")


@query("""
WITH c AS (SELECT c_custkey AS k, c_nationkey AS n FROM customer WHERE c_nationkey % 3 <> 1), w AS (SELECT k, CASE WHEN n % 3 = 0 THEN 'private' ELSE 'public' END AS root, CASE WHEN n % 3 = 0 THEN 'public' ELSE 'private' END AS wanted FROM c)
SELECT k AS article_id, x.kind AS kind, x.kind || k AS name, root, wanted FROM w, (VALUES ('raw', 'public'), ('cache', 'private'), ('cache', 'public')) AS x(kind, held) WHERE x.held = root
""")
def moves(spark: SparkSession, sf: str) -> DataFrame:
    """Artifacts that go with a misplaced article."""
    nation, key = F.col("c_nationkey"), F.col("c_custkey").alias("article_id")
    wrong = table(spark, sf, "customer").where(nation % 3 != 1).select(key, F.when(nation % 3 == 0, "private").otherwise("public").alias("root"), F.when(nation % 3 == 0, "public").otherwise("private").alias("wanted"))
    held = F.array(*[F.struct(F.lit(kind).alias("kind"), F.concat(F.lit(kind), F.col("c_custkey").cast("string")).alias("name"), F.lit(root).alias("root")) for kind, root in (("raw", "public"), ("cache", "private"), ("cache", "public"))])
    stored = table(spark, sf, "customer").select(key, F.explode(held).alias("x")).select("article_id", "x.*")
    return corpus.planned_moves(wrong, stored)


@query("SELECT p_partkey AS article_id, 'f' || (p_size % 3) AS xml_id, CASE WHEN p_size % 3 = 1 THEN 'l' || p_partkey || '.jpg' END AS files FROM part")
def carried_files(spark: SparkSession, sf: str) -> DataFrame:
    """Local files of figures that a rebuild keeps."""
    part = table(spark, sf, "part")
    old = part.select(F.col("p_partkey").alias("article_id"), F.lit("f1").alias("xml_id"), F.array(F.concat(F.lit("l"), F.col("p_partkey").cast("string"), F.lit(".jpg"))).alias("files"))
    new = part.select(F.col("p_partkey").alias("article_id"), F.concat(F.lit("f"), (F.col("p_size") % 3).cast("string")).alias("xml_id"), F.lit(None).cast("array<string>").alias("files"))
    return corpus.carried_figures(old.unionByName(old), new).select("article_id", "xml_id", F.array_join("files", "|").alias("files"))


@query("""
SELECT CASE event_id % 3 WHEN 0 THEN 'paragraph' ELSE 'sentence' END AS pass, user_id AS cache_key, max(event_id)::BIGINT AS event_id, strftime(max(TIMESTAMP '2024-01-01 00:00:00' + INTERVAL (event_id) SECOND), '%Y-%m-%dT%H:%M:%S') || '.000Z' AS saved_at FROM events GROUP BY ALL
""")
def latest_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Of the cache's entries for a key, the one saved last; moments as UTC text."""
    kind = F.when(F.col("event_id") % 3 == 0, "paragraph").otherwise("sentence")
    at = F.timestamp_add("SECOND", F.col("event_id").cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp"))
    rows = table(spark, sf, "events").select(kind.alias("pass"), F.col("user_id").alias("cache_key"), "event_id")
    return annotate.latest(annotate.stamped(rows, at))


@query(f"""WITH RECURSIVE {_SQL_UNITS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY ord) AS k FROM u WHERE section_type <> 'funding'),
packed AS (SELECT article_id, paragraph_id, k, n AS used, 0 AS batch FROM ranked WHERE k = 1
  UNION ALL SELECT r.article_id, r.paragraph_id, r.k, CASE WHEN p.used + r.n > 4 THEN r.n ELSE p.used + r.n END, p.batch + CASE WHEN p.used + r.n > 4 THEN 1 ELSE 0 END FROM packed p JOIN ranked r ON r.article_id = p.article_id AND r.k = p.k + 1)
SELECT article_id, paragraph_id, batch::BIGINT AS batch FROM packed WHERE batch < 2""")
def limited_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The first two batches of each article."""
    return annotate.batched(annotate.units(_units(spark, sf), annotate.PARAGRAPH, "m"), 4, 2).select("article_id", "paragraph_id", "batch")


@query("SELECT 10 + p_size % 3 AS number, 'x' || p_partkey AS article_id, 's' AS section_id, 1 AS ord FROM part WHERE p_size % 3 <> 2")
def table_mentions(spark: SparkSession, sf: str) -> DataFrame:
    """Mentions of tables that exist."""
    part = table(spark, sf, "part")
    key = F.concat(F.lit("x"), F.col("p_partkey").cast("string")).alias("article_id")
    blocks = part.select(key, F.lit("s").alias("section_id"), F.lit(1).alias("ord"), F.concat(F.lit("see Table  "), (10 + F.col("p_size") % 3).cast("string"), F.lit(", notTable 11 and Table 99")).alias("text"))
    known = part.select(key, F.explode(F.array(F.lit(10).cast("long"), F.lit(11).cast("long"))).alias("number"))
    return imports.table_mentions(blocks, known).select(F.col("number").cast("int").alias("number"), "article_id", "section_id", "ord")


# ------------------------------------------------------------------ import


@query("""
SELECT n_nationkey, 3::BIGINT AS n_rows, 1::BIGINT AS header_rows, n_name AS cell, 'Table ' || n_regionkey AS label, 'tbl' || n_regionkey AS table_id FROM nation WHERE n_nationkey % 2 = 0
""")
def imported_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Pipe tables with the caption before them."""
    nation = table(spark, sf, "nation")
    body = F.concat(F.lit("| name | region |\n|---|:--:|\n| "), "n_name", F.lit(" | x |\r\n| y |  "), F.col("n_regionkey").cast("string"), F.lit(" |"))
    block = lambda k, value: nation.select(F.col("n_nationkey").cast("string").alias("article_id"), F.lit("s1").alias("section_id"), F.lit(k).alias("ord"), value.alias("text"))
    rows = block(1, F.lit("Some text.")).unionByName(block(2, F.concat(F.lit("Table  "), F.col("n_regionkey").cast("string"), F.lit(" . Names.")))).unionByName(block(3, F.when(F.col("n_nationkey") % 2 == 0, body).otherwise(F.lit("| no | rule |\n| a | b |"))))
    found = imports.with_tables(rows).where("table IS NOT NULL")
    return found.select(F.col("article_id").cast("int").alias("n_nationkey"), F.size("table.rows").cast("long").alias("n_rows"), F.col("table.header_rows").cast("long").alias("header_rows"), F.col("table.rows")[1][0].alias("cell"), "label", "table_id")


@query("SELECT o_orderkey, o_custkey % 90 AS volume, o_orderkey % 900 AS fpage, o_orderkey % 900 + 5 AS lpage FROM orders WHERE o_orderkey % 2 = 0")
def reference_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Volume and pages out of plain citations; other forms give none."""
    orders = table(spark, sf, "orders")
    page = F.col("o_orderkey") % 900
    said = F.when(F.col("o_orderkey") % 2 == 0, F.format_string("Cell, %d (2005), pp. %d-%d", F.col("o_custkey") % 90, page, page + 5)).otherwise(F.lit("Cell 2005, 7, 3-9"))
    got = imports.reference_fields(said)
    return orders.select("o_orderkey", got["volume"].cast("long").alias("volume"), got["fpage"].cast("long").alias("fpage"), got["lpage"].cast("long").alias("lpage")).where("volume IS NOT NULL")


# ------------------------------------------------------------------ views


@query("""
WITH l AS (SELECT s_suppkey, n_name || ' ' || (1990 + s_suppkey % 4) AS label, s_suppkey % 400 AS k FROM supplier JOIN nation ON n_nationkey = s_nationkey),
n AS (SELECT *, count(*) OVER (PARTITION BY label) AS n, row_number() OVER (PARTITION BY label ORDER BY s_suppkey) AS r FROM l)
SELECT s_suppkey, CASE WHEN n > 1 THEN label || chr((96 + r)::INT) ELSE label END AS label FROM n
""")
def library_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Author and year, told apart where they collide."""
    named = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    labelled = named.select("s_suppkey", F.concat("n_name", F.lit(" "), (1990 + F.col("s_suppkey") % 4).cast("string")).alias("label"))
    return views.collision_suffix(labelled, "label", "s_suppkey")


@query("SELECT coalesce(CASE WHEN event_type <> 'view' THEN event_type END, '?') AS value, count(*) AS n FROM events GROUP BY 1")
def role_distribution(spark: SparkSession, sf: str) -> DataFrame:
    """Counts by role, null as ? (F1, H4)."""
    return views.distribution(table(spark, sf, "events").select(F.when(F.col("event_type") != "view", F.col("event_type")).alias("role")), "role")


@query("""
WITH c AS (SELECT CASE WHEN user_id % 4 <> 0 THEN ['measured', 'supported', 'hedged'][(event_id % 3)::INT + 1] END AS certainty FROM events),
n AS (SELECT k.rank, k.certainty, count(c.certainty) AS n FROM (VALUES (0, 'measured'), (1, 'supported'), (2, 'hedged'), (3, 'speculative')) AS k(rank, certainty) LEFT JOIN c ON c.certainty = k.certainty GROUP BY ALL)
SELECT rank, certainty, n, floor(n / sum(n) OVER () * 50 + 0.5)::BIGINT AS bar FROM n
""")
def certainty_distribution(spark: SparkSession, sf: str) -> DataFrame:
    """Counts by certainty in its order, with bars of fifty; what has none doesn't count (F2)."""
    label = F.element_at(F.array(*map(F.lit, ("measured", "supported", "hedged"))), (F.col("event_id") % 3 + 1).cast("int"))
    return views.certainty_distribution(table(spark, sf, "events").select(F.when(F.col("user_id") % 4 != 0, label).alias("certainty")))


@query("""
WITH s AS (SELECT l_orderkey AS article_id, l_linenumber AS ord, CASE WHEN min(l_quantity) < 10 THEN 'funding' WHEN min(l_quantity) < 20 THEN 'other' ELSE 'results' END AS type FROM lineitem GROUP BY l_orderkey, l_linenumber),
b AS (SELECT *, coalesce(ord >= min(CASE WHEN type = 'funding' THEN ord END) OVER (PARTITION BY article_id), false) AS tail FROM s),
c AS (SELECT *, count(*) FILTER (tail) OVER (PARTITION BY article_id) AS n_tail FROM b),
p AS (SELECT article_id, 1 AS rank, ord, 'section' AS kind, type AS label, 1 AS n FROM c WHERE NOT tail OR n_tail = 1
  UNION ALL SELECT article_id, 1, min(ord), 'back', 'Back matter', count(*) FROM c WHERE tail AND n_tail > 1 GROUP BY article_id
  UNION ALL SELECT o_orderkey, 0, 0, 'overview', 'Overview', 0 FROM orders
  UNION ALL SELECT o_orderkey, 2, 0, 'references', 'References', 0 FROM orders WHERE o_orderstatus = 'F')
SELECT article_id, (row_number() OVER (PARTITION BY article_id ORDER BY rank, ord) - 1)::BIGINT AS page, kind, label, n::BIGINT AS n_sections FROM p
""")
def reading_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of an article, back matter on one."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("article_id"), "o_orderstatus")
    kind = F.when(F.col("l_quantity") < 10, "funding").when(F.col("l_quantity") < 20, "other").otherwise("results")
    items = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_quantity").alias("l_quantity"))
    secs = items.select(F.col("l_orderkey").alias("article_id"), F.concat(F.lit("s"), F.col("l_linenumber").cast("string")).alias("section_id"), F.lit(None).cast("string").alias("title"), kind.alias("type"), F.lit(1).alias("level"), F.lit("sections").alias("part"), F.col("l_linenumber").cast("long").alias("ord"))
    found = views.pages(orders, secs, orders.where("o_orderstatus = 'F'"), orders.limit(0))
    return found.select("article_id", "page", "kind", "label", F.size("section_ids").cast("long").alias("n_sections"))


@query("""
SELECT l_orderkey, l_linenumber, substr('abcdefghijklmnopqrstuvwxyz', 1, l_linenumber) || '«' || substr('abcdefghijklmnopqrstuvwxyz', l_linenumber + 1, 2) || '»' || substr('abcdefghijklmnopqrstuvwxyz', l_linenumber + 3, 5) || '«' || substr('abcdefghijklmnopqrstuvwxyz', l_linenumber + 8, 1) || '»' || substr('abcdefghijklmnopqrstuvwxyz', l_linenumber + 9, 20) AS marked FROM lineitem
""")
def marked_hedges(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences with their hedges marked; spans outside are skipped."""
    n = F.col("l_linenumber")
    span = lambda a, b: F.struct(a.alias("start"), b.alias("end"))
    hedges = F.array(span(n, n + 2), span(n + 7, n + 8), span(n + 30, n + 31))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", views.marked_hedges(F.lit("abcdefghijklmnopqrstuvwxyz"), F.lit(0), F.lit(26), hedges).alias("marked"))


@query("""
WITH a AS (SELECT l_orderkey, list('A' || l_suppkey ORDER BY l_linenumber, l_suppkey) AS authors FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, array_to_string(authors[1:3], ', ') || CASE WHEN len(authors) > 3 THEN ' et al.' ELSE '' END AS shown FROM a
""")
def short_authors(spark: SparkSession, sf: str) -> DataFrame:
    """The first three authors (H5)."""
    listed = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey"))), lambda x: F.concat(F.lit("A"), x["l_suppkey"].cast("string"))).alias("authors"))
    return listed.select("l_orderkey", views.short_authors(F.col("authors")).alias("shown"))


@query("SELECT CASE WHEN l_returnflag = 'R' THEN 'error' ELSE 'ok' END AS status, count(*) AS n, count(*) FILTER (l_tax > 0.04) AS n_warned FROM lineitem GROUP BY 1")
def build_status(spark: SparkSession, sf: str) -> DataFrame:
    """Files of a build by status, and those with warnings."""
    return views.build_report(table(spark, sf, "lineitem").select(F.when(F.col("l_returnflag") == "R", "error").otherwise("ok").alias("status"), (F.col("l_tax") > 0.04).cast("int").alias("n_warnings")))


@query("""
SELECT o_orderkey, count(l_orderkey) AS n_figures, sum(l_linenumber % 3)::BIGINT AS n_graphics, sum(CASE WHEN l_tax > 0.04 THEN 1 ELSE 0 END)::BIGINT AS n_files FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey
""")
def figure_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Images of articles and how many are at hand."""
    names = F.slice(F.array(F.lit("a.tif"), F.lit("b.tif")), F.lit(1), F.col("l_linenumber") % 3)
    figures = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("article_id"), names.alias("graphics"), F.when(F.col("l_tax") > 0.04, F.array(F.lit("a.jpg"))).alias("files"))
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("article_id"))
    return views.figure_totals(figures.join(orders, "article_id", "left_semi")).withColumnRenamed("article_id", "o_orderkey")


@query("""
WITH r AS (SELECT conv_id, turn, role, substr(text, 1, 12) AS said, CASE turn % 4 WHEN 0 THEN 'measured' WHEN 1 THEN 'supported' WHEN 2 THEN 'hedged' END AS certainty FROM conversations)
SELECT conv_id, turn, certainty, CASE WHEN length(said) >= 4 THEN '«' || substr(said, 1, 4) || '»' || substr(said, 5) ELSE said END AS sentence FROM r WHERE role = 'user' AND certainty IS NOT NULL
""")
def hedged_sentences(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences of a section that have a certainty, hedges marked."""
    label = F.when(F.col("turn") % 4 == 0, "measured").when(F.col("turn") % 4 == 1, "supported").when(F.col("turn") % 4 == 2, "hedged")
    sentence = F.struct(F.lit("s1").alias("sentence_id"), F.lit(0).alias("start"), F.least(F.lit(12), F.length("text")).alias("end"), label.alias("certainty"), F.array(F.struct(F.lit(0).alias("start"), F.lit(4).alias("end"))).alias("hedges"), F.lit(None).cast(annotate.STATS).alias("stats"))
    rows = table(spark, sf, "conversations").select(F.col("conv_id").alias("article_id"), F.col("turn").alias("paragraph_id"), F.col("role").alias("section_type"), "text", F.array(sentence).alias("sentences"))
    return views.filtered_sentences(rows, section="user").select(F.col("article_id").alias("conv_id"), F.col("paragraph_id").alias("turn"), "certainty", "sentence")


@query("""
SELECT conv_id, turn, ['method', 'result', 'interpretation'][(turn % 3)::INT + 1] AS role FROM conversations WHERE turn % 2 = 0 AND role = 'user' AND turn % 3 = 1
""")
def report_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    """Annotated paragraphs of a section type and a role."""
    label = F.element_at(F.array(*map(F.lit, _ROLE)), (F.col("turn") % 3 + 1).cast("int"))
    rows = table(spark, sf, "conversations").select(F.col("conv_id").alias("article_id"), F.col("turn").alias("paragraph_id"), F.col("role").alias("section_type"), label.alias("role"), F.when(F.col("turn") % 2 == 0, "g").alias("gist"), F.lit(None).cast("string").alias("plain"))
    return views.filtered_paragraphs(rows, section="user", role="result").select(F.col("article_id").alias("conv_id"), F.col("paragraph_id").alias("turn"), "role")


@query("""
WITH d AS (SELECT l_orderkey, l_linenumber, unnest(['r' || l_partkey % 9, 'r' || l_suppkey % 9]) AS xml_id FROM lineitem),
r AS (SELECT 'r' || k AS xml_id, CASE WHEN k % 3 = 0 THEN 'https://pubmed.ncbi.nlm.nih.gov/' || k || '/' WHEN k % 3 = 1 THEN 'https://doi.org/10.1/' || k END AS link FROM range(0, 6) t(k))
SELECT l_orderkey, l_linenumber, d.xml_id, r.link FROM d LEFT JOIN r ON r.xml_id = d.xml_id
""")
def citation_links(spark: SparkSession, sf: str) -> DataFrame:
    """Where citations lead, also of marks that name several references."""
    name = lambda c: F.concat(F.lit("r"), (F.col(c) % 9).cast("string"))
    marks = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.lit("x").alias("article_id"), F.concat(name("l_partkey"), F.lit("  "), name("l_suppkey")).alias("rid"))
    k = F.col("id").cast("string")
    refs = spark.range(6).select(F.lit("x").alias("article_id"), F.concat(F.lit("r"), k).alias("xml_id"), F.when(F.col("id") % 3 == 0, k).alias("pmid"), F.when(F.col("id") % 3 < 2, F.concat(F.lit("10.1/"), k)).alias("doi"))
    return views.citation_links(marks, refs).select("l_orderkey", "l_linenumber", "xml_id", "link")


@query()
def spoken(spark: SparkSession, sf: str) -> DataFrame:
    """Speech units of all paragraphs."""
    units = views.speech_units(_paragraphs(spark, sf).select(F.col("doc_id").alias("article_id"), "paragraph_id", "ord", "text"))
    return units.groupBy("article_id").agg(F.sum(F.size("parts")).alias("n_parts"), F.max(F.array_max(F.transform("parts", lambda p: F.length(p)))).cast("long").alias("longest"))
