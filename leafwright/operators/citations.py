"""References, figures and tables in paragraphs: lookups, first mention, runs, ranges and overlaps.

Tables here have article_id, and paragraphs a document order in ``ord``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MAX_RANGE = 30


def cited(paragraphs: DataFrame, targets: DataFrame, ids: str = "ref_ids") -> DataFrame:
    """Each id that a paragraph names, in order, with its target if there is one."""
    named = paragraphs.select("article_id", "paragraph_id", "ord", F.posexplode(ids).alias("place", "xml_id"))
    return named.join(targets, ["article_id", "xml_id"], "left")


def first_mentions(paragraphs: DataFrame, targets: DataFrame, ids: str) -> DataFrame:
    """(article_id, xml_id, paragraph_id): the first paragraph that names each existing target; a partial aggregate, no sort."""
    named = paragraphs.select("article_id", "paragraph_id", "ord", F.explode(ids).alias("xml_id"))
    first = named.groupBy("article_id", "xml_id").agg(F.min_by("paragraph_id", F.struct("ord", "paragraph_id")).alias("paragraph_id"))
    return first.join(targets.select("article_id", "xml_id").distinct(), ["article_id", "xml_id"], "left_semi")


def never_mentioned(targets: DataFrame, mentions: DataFrame) -> DataFrame:
    """Targets without an id or without a mention."""
    return targets.join(mentions.select("article_id", "xml_id").distinct(), ["article_id", "xml_id"], "left_anti")


def unnamed(targets: DataFrame, paragraphs: DataFrame, ids: str) -> DataFrame:
    """Targets that no paragraph names, straight from the named ids; targets without an id are among them."""
    named = paragraphs.select("article_id", F.explode(ids).alias("xml_id")).distinct()
    return targets.join(named, ["article_id", "xml_id"], "left_anti")


def numbered(references: DataFrame) -> DataFrame:
    """(article_id, number, xml_id): a reference's number is its label's digits, else its place; the first of a number wins."""
    digits = F.regexp_replace(F.coalesce("label", F.lit("")), "[^0-9]", "")
    number = F.coalesce(F.when(digits != "", digits.try_cast("long")), F.col("ord") + 1)
    return references.select("article_id", number.alias("number"), "xml_id", "ord").groupBy("article_id", "number").agg(F.min_by("xml_id", "ord").alias("xml_id"))


def separator(text: Column) -> Column:
    """What stands between two citations, tidied: blanks go, hyphens become dashes, commas and semicolons get a blank."""
    bare = F.regexp_replace(F.regexp_replace(text, r"\s+", ""), "-", "–")
    return F.when(bare.isin(",", ";"), F.concat(bare, F.lit(" "))).otherwise(bare)


def range_numbers(first: Column, last: Column, between: Column) -> Column:
    """The numbers inside a range such as 5-8 (here 6, 7); null where it is no range that can be opened."""
    whole = lambda c: F.when(F.trim(c).rlike(r"^[0-9]+$"), F.trim(c).try_cast("long"))
    a, b = whole(first), whole(last)
    opens = separator(between).rlike("^[–—-]$") & (b > a) & (b - a <= MAX_RANGE)
    return F.when(opens, F.filter(F.sequence(a, F.greatest(a, F.when(opens, b).otherwise(a))), lambda n: (n > a) & (n < b)))


def opened_ranges(pairs: DataFrame, references: DataFrame) -> DataFrame:
    """Rows of pairs (article_id, first, last, between) for each number inside, with the reference it stands for if any."""
    inner = pairs.withColumn("number", F.explode(range_numbers(F.col("first"), F.col("last"), F.col("between"))))
    return inner.join(numbered(references), ["article_id", "number"], "left")


def without_overlap(spans: Column) -> Column:
    """Greedy choice of spans by start, longest first, each beginning at or after the end of the last one kept."""
    ranked = F.array_sort(spans, lambda x, y: F.when(x["start"] != y["start"], x["start"] - y["start"]).otherwise(y["end"] - x["end"]).cast("int"))
    empty = F.slice(spans, 1, 0)

    def step(kept: Column, s: Column) -> Column:
        fits = (F.size(kept) == 0) | (s["start"] >= F.coalesce(F.try_element_at(kept, F.lit(-1))["end"], F.lit(0)))
        return F.when(fits & (s["end"] > s["start"]), F.array_append(kept, s)).otherwise(kept)

    return F.aggregate(ranked, empty, step)


def citation_runs(decorations: DataFrame, keys: list[str]) -> DataFrame:
    """``run``: neighbours in a paragraph belong to one run while both are references and only blanks, commas, semicolons
    or dashes stand between; needs start, end, kind and ``text`` of the paragraph."""
    order = W.partitionBy(*keys).orderBy("start", "end")
    gap = F.substring("text", F.lag("end").over(order) + 1, F.col("start") - F.lag("end").over(order))
    joins = (F.lag("kind").over(order) == "ref") & (F.col("kind") == "ref") & gap.rlike(r"^[\s,;–—-]*$")
    return decorations.withColumn("breaks", (~F.coalesce(joins, F.lit(False))).cast("long")).withColumn("run", F.sum("breaks").over(order.rowsBetween(W.unboundedPreceding, 0))).drop("breaks")


def mark_buckets(marks: Column, ref_type: str) -> Column:
    """Distinct ids of a kind of cross-reference in first-seen order; one mark may name several."""
    own = F.filter(marks, lambda m: (m["type"] == "xref") & (m["ref_type"] == ref_type) & m["rid"].isNotNull())
    return F.array_distinct(F.filter(F.flatten(F.transform(own, lambda m: F.split(m["rid"], r"\s+"))), lambda r: r != ""))
