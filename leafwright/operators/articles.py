"""Articles from XML: one parsing pass, then flat tables by native explodes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

MARK = "struct<type:string,start:int,end:int,rid:string,ref_type:string,href:string>"
SPAN = "struct<start:int,end:int>"
STAT = "struct<metric:string,value:double,unit:string,ci:array<double>,p:double,n:double,comparison:string,start:int,end:int>"
AUTHOR = "struct<surname:string,given_names:string,full:string,orcid:string,affiliations:array<string>,corresponding:boolean>"
META = (
    "struct<doi:string,pmid:string,pmcid:string,title:string,journal:string,issn:string,publisher:string,year:string,pub_date:string,volume:string,issue:string,fpage:string,"
    f"article_type:string,keywords:array<string>,authors:array<{AUTHOR}>,license_url:string,license_text:string,funding:array<string>>"
)
SECTION = "struct<section_id:string,xml_id:string,title:string,level:int,type:string,parent_id:string,part:string,path:array<int>,ord:long>"
PARAGRAPH = (
    f"struct<paragraph_id:string,xml_id:string,text:string,marks:array<{MARK}>,ref_ids:array<string>,fig_ids:array<string>,table_ids:array<string>,"
    "sentences:array<struct<sentence_id:string,start:int,end:int>>,section_id:string,section_type:string,section_title:string,part:string,ord:long>"
)
FIGURE = "struct<xml_id:string,label:string,caption:string,graphics:array<string>>"
TABLE = "struct<xml_id:string,label:string,caption:string,rows:array<array<string>>,header_rows:int,footnotes:array<string>>"
REFERENCE = "struct<xml_id:string,label:string,authors:array<string>,title:string,source:string,year:string,volume:string,pages:string,doi:string,pmid:string,raw:string>"
SCHEMA = (
    f"path string, sha256 string, article_id string, meta {META}, sections array<{SECTION}>, paragraphs array<{PARAGRAPH}>, figures array<{FIGURE}>, tables array<{TABLE}>, "
    f"references array<{REFERENCE}>, warnings array<string>, flavor string, error string"
)

# Articles that go to Spark in one Arrow batch.
BATCH = 64


def parsed(files: DataFrame, *columns: str) -> DataFrame:
    """One row a file with (path, text, sha256[, error]); files that can't be read or parsed keep a row with the error.

    If columns are named, only those, the article's id and the error are given. Filters on path and hash belong below this: the parser is opaque to the optimiser.
    """
    fields = [f for f in StructType.fromDDL(SCHEMA) if not columns or f.name in (*columns, "article_id", "error")]
    schema, names = to_arrow_schema(StructType(fields)), tuple(f.name for f in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from leafwright.sources.jats import parse_article

        def article(row: dict) -> dict:
            out = {"path": row["path"], "sha256": row["sha256"], "error": row["error"]}
            if row["error"] is None:
                try:
                    out |= parse_article(row["text"], row["path"].rsplit("/", 1)[-1].rsplit(".", 1)[0], names)
                except (ValueError, RecursionError) as e:
                    out["error"] = str(e)
            return out

        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                yield pa.RecordBatch.from_pylist([article(row) for row in batch.slice(at, BATCH).to_pylist()], schema=schema)

    given = files.select("path", "sha256", "text", "error" if "error" in files.columns else F.lit(None).cast("string").alias("error"))
    return given.mapInArrow(run, StructType(fields))


def article_tables(parsed_articles: DataFrame) -> dict[str, DataFrame]:
    """Flat tables keyed by article_id: articles, sections, paragraphs, sentences, figures, tables, references, authors, build_report.

    Of rows that were parsed for some columns only, articles has those that are there, and tables without their column are left out.
    """
    good, there = parsed_articles.where("error IS NULL"), set(parsed_articles.columns)
    rows = lambda name: good.select("article_id", F.posexplode(name).alias("_ord", "x")).select("article_id", "x.*", *(["_ord"] if name in ("figures", "tables", "references") else []))
    found = {"articles": good.select("article_id", *[c for c in ("meta.*", "warnings", "flavor", "path", "sha256") if c.split(".")[0] in there])}
    if "sections" in there:
        found["sections"] = rows("sections")
    if "paragraphs" in there:
        found["paragraphs"] = rows("paragraphs")
        sentences = found["paragraphs"].select("article_id", "paragraph_id", "section_type", "part", F.col("ord").alias("paragraph_ord"), "text", F.posexplode("sentences").alias("ord", "s"))
        found["sentences"] = sentences.select("article_id", "paragraph_id", "section_type", "part", "paragraph_ord", "s.sentence_id", "ord", "s.start", "s.end", F.expr("substring(text, s.start + 1, s.end - s.start)").alias("sentence"))
    found |= {k: rows(k).withColumnRenamed("_ord", "ord") for k in ("figures", "tables", "references") if k in there}
    if "meta" in there:
        found["authors"] = good.select("article_id", F.posexplode("meta.authors").alias("ord", "a")).select("article_id", "ord", "a.*")
    if {"path", "paragraphs", "warnings"} <= there:
        found["build_report"] = parsed_articles.select("path", "article_id", F.when(F.col("error").isNull(), "ok").otherwise("error").alias("status"), F.size("paragraphs").alias("n_paragraphs"), F.size("warnings").alias("n_warnings"), "error")
    return found


def resolved_authors(authors: DataFrame, affiliations: DataFrame) -> DataFrame:
    """Affiliations of authors (article_id, ord, rids) from (article_id, id, affiliation): by id; if nobody's id is known and
    the article has one affiliation, it is everybody's."""
    named = authors.select("article_id", "ord", F.posexplode_outer("rids").alias("place", "id")).join(affiliations, ["article_id", "id"], "left")
    own = named.groupBy("article_id", "ord").agg(F.transform(F.array_sort(F.collect_list(F.when(F.col("affiliation").isNotNull(), F.struct("place", "affiliation")))), lambda x: x["affiliation"]).alias("affiliations"))
    single = affiliations.groupBy("article_id").agg(F.count(F.lit(1)).alias("n"), F.min("affiliation").alias("only")).where("n = 1").drop("n")
    found = own.join(single, "article_id", "left")
    return found.select("article_id", "ord", F.when((F.size("affiliations") == 0) & F.col("only").isNotNull(), F.array("only")).otherwise(F.col("affiliations")).alias("affiliations"))
