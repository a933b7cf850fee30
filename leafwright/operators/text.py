"""Text operators: normalisation, paragraphs from lines, sentences, chunks, escaping, names of files and articles."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafwright.functions.sentences import sentence_spans
from leafwright.functions.vocabulary import BLANK

SPANS = "array<struct<start:int,end:int>>"
_SPAN_TYPE = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def normalised(text: Column) -> Column:
    """Blanks of every kind collapse to one space; none at the ends."""
    return F.trim(F.regexp_replace(text, BLANK + "+", " "))


def line_paragraphs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ord, paragraph_id, text): each line as a paragraph; numbers count empty lines, which are left out."""
    lines = docs.select(key, F.posexplode(F.split(F.col(text), "\n")).alias("ord", "text"))
    number = (F.col("ord") + 1).cast("long")
    return lines.select(key, number.alias("ord"), F.concat(F.lit("p"), number.cast("string")).alias("paragraph_id"), normalised(F.col("text")).alias("text")).where("text <> ''")


@F.pandas_udf(_SPAN_TYPE)
def _spans(text: pd.Series) -> pd.Series:
    return text.map(lambda x: [{"start": a, "end": b} for a, b in sentence_spans(x)])


@F.pandas_udf(_SPAN_TYPE)
def _spans_with(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for text, breaks, citations in batches:
        yield pd.Series([
            [{"start": a, "end": b} for a, b in sentence_spans(t, [] if b is None else list(b), [] if c is None else [(x["start"], x["end"]) for x in c])]
            for t, b, c in zip(text, breaks, citations, strict=True)
        ])


def sentence_spans_column(text: Column, breaks: Column | None = None, citations: Column | None = None) -> Column:
    """Sentence spans; ``breaks`` are offsets that begin one, ``citations`` spans that may follow a full stop."""
    if breaks is None and citations is None:
        return _spans(text)
    return _spans_with(text, breaks if breaks is not None else F.array().cast("array<int>"), citations if citations is not None else F.array().cast(SPANS))


def span_text(text: Column, start: Column, end: Column) -> Column:
    """The text of a half-open, 0-based span."""
    return F.substring(text, start + 1, end - start)


def sentences(paragraphs: DataFrame, *keys: str) -> DataFrame:
    """One row for each sentence of paragraphs with ``paragraph_id`` and ``text``; ids are the paragraph's with -s1 on."""
    spans = paragraphs.select(*keys, "paragraph_id", "text", F.posexplode(sentence_spans_column(F.col("text"))).alias("k", "span"))
    return spans.select(
        *keys, "paragraph_id", F.concat_ws("-s", "paragraph_id", (F.col("k") + 1).cast("string")).alias("sentence_id"), (F.col("k") + 1).cast("long").alias("ord"),
        F.col("span.start").alias("start"), F.col("span.end").alias("end"), span_text(F.col("text"), F.col("span.start"), F.col("span.end")).alias("sentence"),
    )


def chunks(text: Column, limit: int = 240) -> Column:
    """Greedy packing of whole words into pieces of at most ``limit`` characters; a longer word is a piece of its own."""
    # The longest run of up to ``limit`` characters that ends before a blank or at the end, else one whole word.
    cut = F.regexp_extract_all(normalised(text), F.lit(f"([^ ].{{0,{limit - 1}}}(?= |$)|[^ ]+)"), F.lit(1))
    return F.coalesce(cut, F.array().cast("array<string>"))


def xml_escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def doi_slug(doi: Column, fallback: Column | str = "unknown") -> Column:
    """An article's id from its DOI."""
    bare = F.regexp_replace(doi, r"^https?://(dx\.)?doi\.org/", "")
    other = F.lit(fallback) if isinstance(fallback, str) else fallback
    return F.when(F.coalesce(doi, F.lit("")) == "", other).otherwise(F.regexp_replace(bare, "[^a-zA-Z0-9]+", "-"))


def display_name(href: Column) -> Column:
    """A graphic's name as browsers can show it: .tif, .tiff and nothing become .jpg."""
    name = F.element_at(F.split(href, "/"), -1)
    bare = F.regexp_replace(href, r"(?i)\.tiff?$", "")
    return F.when(name.rlike(r"(?i)\.tiff?$") | ~name.rlike(r"^.+\.[^.]*$"), F.concat(bare, F.lit(".jpg"))).otherwise(href)


def article_link(pmcid: Column, doi: Column) -> Column:
    """Where an article can be read."""
    return F.when(pmcid.isNotNull(), F.concat(F.lit("https://pmc.ncbi.nlm.nih.gov/articles/"), pmcid, F.lit("/"))).when(doi.isNotNull(), F.concat(F.lit("https://doi.org/"), doi))


def reference_link(pmid: Column, doi: Column) -> Column:
    """Where a reference can be read, PubMed first."""
    return F.when(pmid.isNotNull(), F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), F.url_encode(pmid), F.lit("/"))).when(doi.isNotNull(), F.concat(F.lit("https://doi.org/"), doi))


def image_link(pmcid: Column, name: Column) -> Column:
    return F.concat(F.lit("https://pmc.ncbi.nlm.nih.gov/articles/instance/"), F.regexp_replace(pmcid, "(?i)^PMC", ""), F.lit("/bin/"), name)


def initials_first(name: Column) -> Column:
    """'J. K. Huard' as a struct of surname and given: leading initials go to given, one word at least stays."""
    parts = F.split(normalised(name), " ")
    n = F.aggregate(F.transform(parts, lambda p: p.rlike(r"^[A-Z](\.[A-Z]?)*\.?$")), F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda a, hit: F.struct((a["n"] + (a["on"] & hit).cast("int")).alias("n"), (a["on"] & hit).alias("on")), lambda a: a["n"])
    n = F.least(n, F.size(parts) - 1)
    given = F.array_join(F.slice(parts, F.lit(1), n), " ")
    return F.struct(F.array_join(F.slice(parts, n + 1, F.size(parts)), " ").alias("surname"), F.when(given != "", given).alias("given"))


def initials_last(name: Column) -> Column:
    """'Le Blanc K' as a struct of surname and given: trailing capitals of up to three letters go to given."""
    parts = F.reverse(F.split(normalised(name), " "))
    n = F.aggregate(F.transform(parts, lambda p: p.rlike("^[A-Z]{1,3}$")), F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda a, hit: F.struct((a["n"] + (a["on"] & hit).cast("int")).alias("n"), (a["on"] & hit).alias("on")), lambda a: a["n"])
    n = F.least(n, F.size(parts) - 1)
    given = F.array_join(F.reverse(F.slice(parts, F.lit(1), n)), " ")
    return F.struct(F.array_join(F.reverse(F.slice(parts, n + 1, F.size(parts))), " ").alias("surname"), F.when(given != "", given).alias("given"))


def distinct_by_hash(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(sha256, n, first): equal texts with their number and smallest key."""
    return docs.groupBy(F.sha2(text, 256).alias("sha256")).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first"))
