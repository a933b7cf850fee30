"""Section tables: empty subtrees, structure audit, report counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwright.functions.vocabulary import FREE_FORM_TYPES, REQUIRED_TYPES


def with_text(sections: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """Sections that hold text, themselves or below them: ids are paths, so a paragraph's prefixes are its ancestors."""
    parts = F.split("section_id", "-")
    prefix = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "-"))
    held = paragraphs.select("article_id", F.explode(prefix).alias("section_id")).distinct()
    return sections.join(held, ["article_id", "section_id"], "left_semi")


def structure_warnings(types: Column, article_type: Column) -> Column:
    """What the top-level types of an article lack, as an array of messages."""
    free = F.coalesce(article_type.isin(*FREE_FORM_TYPES), F.lit(False))
    missing = [F.when(~free & ~F.array_contains(types, k) & (F.lit(k not in ("methods", "results")) | ~F.array_contains(types, "case")), F.lit(f"missing section: {k}")) for k in REQUIRED_TYPES]
    other = F.size(F.filter(types, lambda t: t == "other"))
    most = F.when(2 * other > F.size(types), F.format_string("most sections are other: %d/%d", other, F.size(types)))
    return F.filter(F.array(*missing, most), lambda x: x.isNotNull())


def audited(sections: DataFrame, articles: DataFrame) -> DataFrame:
    """(article_id, warnings) from top-level body sections; back sections don't count."""
    top = sections.where("level = 1 AND part = 'sections' AND NOT startswith(section_id, 'b')")
    types = top.groupBy("article_id").agg(F.collect_list("type").alias("types"))
    found = articles.join(types, "article_id", "left")
    return found.select("article_id", structure_warnings(F.coalesce("types", F.array().cast("array<string>")), F.col("article_type")).alias("warnings"))


def summary(paragraphs: DataFrame) -> DataFrame:
    """Per article: paragraphs with and without the abstract, and words of the body."""
    body = F.col("part") == "sections"
    words = F.size(F.split("text", r"\s+"))
    return paragraphs.groupBy("article_id").agg(F.count(F.lit(1)).alias("n_paragraphs"), F.count_if(body).alias("n_body_paragraphs"), F.sum(F.when(body, words).otherwise(0)).alias("n_body_words"))
