"""Reading views: index, pages, first-mention placement, speech units, distributions and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafwright.functions.vocabulary import BACK_TYPES, CERTAINTY
from leafwright.operators.text import chunks, normalised, sentence_spans_column, span_text, xml_escaped


def code_point(n: Column) -> Column:
    """The character of a code point; Spark's char() knows 256 and begins anew."""
    # The mark in front keeps the reader from taking the character itself, U+FEFF, for one.
    return F.decode(F.unhex(F.concat(F.lit("0000FEFF"), F.lpad(F.hex(n), 8, "0"))), "UTF-32")


def collision_suffix(rows: DataFrame, label: str, *order: str) -> DataFrame:
    """Appends a, b, ..., z and the code points after it to labels that several rows share, in a fixed order."""
    same = W.partitionBy(label)
    n, k = F.count(F.lit(1)).over(same), F.row_number().over(same.orderBy(*order))
    return rows.withColumn("_n", n).withColumn("_k", k).withColumn(label, F.when(F.col("_n") > 1, F.concat(label, code_point(F.lit(96) + F.col("_k")))).otherwise(F.col(label))).drop("_n", "_k")


def library(articles: DataFrame, records: DataFrame) -> DataFrame:
    """(article_id, label, title, journal, year, passes): author and year, told apart where needed, by label."""
    first = F.try_element_at(F.col("authors"), F.lit(1))
    who = F.coalesce(first["surname"], F.element_at(F.split(first["full"], r"\s+"), -1), F.lit("Unknown"))
    labelled = articles.withColumn("label", F.concat_ws(" ", who, F.coalesce("year", F.lit("n.d."))))
    passes = records.groupBy("article_id").agg(F.sort_array(F.collect_set("pass")).alias("passes"))
    out = collision_suffix(labelled, "label", "article_id").join(passes, "article_id", "left")
    return out.select("article_id", "label", F.coalesce("title", F.lit("(untitled)")).alias("title"), "journal", "year", F.coalesce("passes", F.array().cast("array<string>")).alias("passes")).orderBy(F.collate("label", "UNICODE"))


def pages(articles: DataFrame, sections: DataFrame, references: DataFrame, orphans: DataFrame) -> DataFrame:
    """(article_id, page, kind, label, section_ids): overview, a page a section up to the first back section, the rest on one
    page, references, and what no paragraph mentions."""
    top = sections.where("level = 1 AND part = 'sections'")
    per = W.partitionBy("article_id")
    start = F.min(F.when(F.col("type").isin(*BACK_TYPES), F.col("ord"))).over(per)
    tail = F.coalesce(F.col("ord") >= start, F.lit(False))
    split = top.withColumn("tail", tail).withColumn("n_tail", F.count_if(tail).over(per))
    name = F.coalesce("title", "type")
    own = split.where("NOT tail OR n_tail = 1").select("article_id", F.lit(1).alias("rank"), "ord", F.lit("section").alias("kind"), name.alias("label"), F.array("section_id").alias("section_ids"))
    back = split.where("tail AND n_tail > 1").groupBy("article_id").agg(F.min("ord").alias("ord"), F.transform(F.array_sort(F.collect_list(F.struct("ord", "section_id"))), lambda x: x["section_id"]).alias("section_ids"))
    none = F.array().cast("array<string>")
    has_abstract = sections.where("part = 'abstract'").select("article_id").distinct().withColumn("a", F.lit(1))
    over = articles.select("article_id").join(has_abstract, "article_id", "left")
    parts = [
        over.select("article_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("ord"), F.lit("overview").alias("kind"), F.when(F.col("a").isNotNull(), "Abstract").otherwise("Overview").alias("label"), none.alias("section_ids")),
        own,
        back.select("article_id", F.lit(1).alias("rank"), "ord", F.lit("back").alias("kind"), F.lit("Back matter").alias("label"), "section_ids"),
        references.select("article_id").distinct().select("article_id", F.lit(2).alias("rank"), F.lit(0).cast("long").alias("ord"), F.lit("references").alias("kind"), F.lit("References").alias("label"), none.alias("section_ids")),
        orphans.select("article_id").distinct().select("article_id", F.lit(3).alias("rank"), F.lit(0).cast("long").alias("ord"), F.lit("orphans").alias("kind"), F.lit("Figures & Tables").alias("label"), none.alias("section_ids")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("article_id", (F.row_number().over(per.orderBy("rank", "ord")) - 1).cast("long").alias("page"), "kind", "label", "section_ids")


def neighbours(page_rows: DataFrame) -> DataFrame:
    order = W.partitionBy("article_id").orderBy("page")
    return page_rows.withColumn("previous", F.lag("label").over(order)).withColumn("following", F.lead("label").over(order))


def paragraph_pages(page_rows: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """(article_id, paragraph_id, page): the abstract stands on the overview, sections with all below them on their page."""
    top = F.when(F.col("part") == "abstract", F.lit(None)).otherwise(F.split("section_id", "-")[0])
    placed = page_rows.select("article_id", "page", F.explode_outer("section_ids").alias("top"), "kind")
    body = paragraphs.where("part = 'sections'").withColumn("top", top).join(placed.where("top IS NOT NULL"), ["article_id", "top"])
    front = paragraphs.where("part = 'abstract'").join(placed.where("kind = 'overview'"), "article_id")
    return body.select("article_id", "paragraph_id", "page").unionByName(front.select("article_id", "paragraph_id", "page"))


def speech_units(paragraphs: DataFrame, limit: int = 240, *more: str) -> DataFrame:
    """(article_id, paragraph_id, ord, parts) and more columns: sentences in order, long ones in pieces of whole words."""
    spans = sentence_spans_column(F.col("text"))
    said = F.transform("spans", lambda s: span_text(F.col("text"), s["start"], s["end"]))
    source = F.when(F.size("said") > 0, F.col("said")).otherwise(F.array("text"))
    return paragraphs.withColumn("spans", spans).withColumn("said", said).select("article_id", "paragraph_id", "ord", *more, F.flatten(F.transform(source, lambda x: chunks(x, limit))).alias("parts"))


def page_speech(page_rows: DataFrame, sections: DataFrame, paragraphs: DataFrame, limit: int = 240) -> DataFrame:
    """(article_id, page, ord, place, parts): what is read out on each page, in order: each section's title, then its paragraphs' sentences."""
    # Pages are found for sections, which are narrow; texts are joined once.
    placed = page_rows.select("article_id", "page", "kind", F.explode_outer("section_ids").alias("top"))
    own = sections.select("article_id", "section_id", F.col("ord").alias("section_ord"), "title", "part")
    body = own.where("part = 'sections'").withColumn("top", F.split("section_id", "-")[0]).join(placed.where("top IS NOT NULL").drop("kind"), ["article_id", "top"]).drop("top")
    front = own.where("part = 'abstract'").join(placed.where("kind = 'overview'").select("article_id", "page"), "article_id")
    # A title without text of its own is read where the text below it is: on the page of its top-level section. The abstract's have none below.
    front = front.join(paragraphs.where("part = 'abstract'").select("article_id", "section_id").distinct(), ["article_id", "section_id"], "left_semi")
    homes = body.unionByName(front)
    heads = homes.where(normalised(F.coalesce("title", F.lit(""))) != "").select("article_id", "page", "section_ord", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("ord"), chunks(F.col("title"), limit).alias("parts"))
    said = speech_units(paragraphs, limit, "section_id").join(homes.select("article_id", "section_id", "section_ord", "page"), ["article_id", "section_id"])
    spoken = said.select("article_id", "page", "section_ord", F.lit(1).alias("rank"), "ord", "parts")
    number = F.row_number().over(W.partitionBy("article_id", "page").orderBy("section_ord", "rank", "ord"))
    return heads.unionByName(spoken).withColumn("place", number).select("article_id", "page", "place", "parts")


def overlaid(text: Column, decorations: Column) -> Column:
    """Text as XML with its decorations (start, end, kind) as marks. Of those that overlap the ones to the left stay; a
    pair of square brackets right around a reference goes into its mark."""
    ranked = F.array_sort(decorations, lambda x, y: F.when(x["start"] != y["start"], x["start"] - y["start"]).when(x["end"] != y["end"], y["end"] - x["end"]).otherwise(0).cast("int"))
    piece = lambda a, b: xml_escaped(F.substring(text, a + 1, F.greatest(b - a, F.lit(0))))
    start = F.struct(F.lit(0).alias("done"), F.lit("").alias("out"))

    def step(acc: Column, d: Column) -> Column:
        around = (d["kind"] == "ref") & (F.substring(text, d["start"], F.lit(1)) == "[") & (F.substring(text, d["end"] + 1, F.lit(1)) == "]") & (d["start"] > acc["done"])
        a, b = d["start"] - around.cast("int"), d["end"] + around.cast("int")
        fits = (d["start"] >= acc["done"]) & (d["end"] > d["start"]) & (d["end"] <= F.length(text))
        shown = F.concat(acc["out"], piece(acc["done"], a), F.lit('<mark class="'), d["kind"], F.lit('">'), piece(a, b), F.lit("</mark>"))
        return F.struct(F.when(fits, b).otherwise(acc["done"]).alias("done"), F.when(fits, shown).otherwise(acc["out"]).alias("out"))

    return F.coalesce(F.aggregate(ranked, start, step, lambda acc: F.concat(acc["out"], piece(acc["done"], F.length(text)))), xml_escaped(text))


def with_placed(paragraphs: DataFrame, mentions: DataFrame, targets: DataFrame) -> DataFrame:
    """Paragraphs with the figures or tables whose first mention they hold."""
    shown = mentions.join(targets.select("article_id", "xml_id", "label"), ["article_id", "xml_id"]).groupBy("article_id", "paragraph_id").agg(F.sort_array(F.collect_list(F.struct("xml_id", "label"))).alias("shown"))
    return paragraphs.join(shown, ["article_id", "paragraph_id"], "left")


def distribution(rows: DataFrame, column: str) -> DataFrame:
    """(value, n): counts with null as '?', most frequent first."""
    return rows.groupBy(F.coalesce(F.col(column), F.lit("?")).alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value")


def certainty_distribution(sentences: DataFrame) -> DataFrame:
    """(certainty, n, bar) for every label in its order, also those without sentences; bar is the share of fifty."""
    labels = sentences.sparkSession.createDataFrame([(k, c) for k, c in enumerate(CERTAINTY)], "rank int, certainty string")
    counts = sentences.where("certainty IS NOT NULL").groupBy("certainty").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(W.partitionBy())
    filled = F.broadcast(labels).join(counts, "certainty", "left").na.fill(0, ["n"])
    return filled.select("rank", "certainty", "n", F.when(total > 0, F.floor(F.col("n") / total * 50 + 0.5)).otherwise(0).cast("long").alias("bar")).orderBy("rank")


def marked_hedges(text: Column, start: Column, end: Column, hedges: Column) -> Column:
    """A sentence with its hedges between « and »; spans that leave it are skipped. From right to left, so offsets hold."""
    ranked = F.array_sort(F.coalesce(hedges, F.slice(hedges, 1, 0)), lambda x, y: (y["start"] - x["start"]).cast("int"))

    def step(acc: Column, h: Column) -> Column:
        a, b = h["start"] - start, h["end"] - start
        fits = (a >= 0) & (b <= F.length(acc)) & (a < b)
        return F.when(fits, F.concat(F.substring(acc, F.lit(1), a), F.lit("«"), F.substring(acc, a + 1, b - a), F.lit("»"), F.substring(acc, b + 1, F.length(acc)))).otherwise(acc)

    return F.coalesce(F.aggregate(ranked, span_text(text, start, end), step), span_text(text, start, end))


def build_report(report: DataFrame) -> DataFrame:
    """(status, n, n_warned) of a build."""
    return report.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("n_warnings") > 0).alias("n_warned"))


def short_authors(authors: Column) -> Column:
    """The first three, and 'et al.' if there are more."""
    return F.concat(F.array_join(F.slice(authors, 1, 3), ", "), F.when(F.size(authors) > 3, F.lit(" et al.")).otherwise(F.lit("")))


def reference_title(title: Column, raw: Column) -> Column:
    """What a reference shows: its title, else the beginning of its raw text."""
    return F.coalesce(title, F.substring(raw, 1, 200), F.lit(""))


def filtered_paragraphs(paragraphs: DataFrame, section: str | None = None, role: str | None = None, paragraph_id: str | None = None) -> DataFrame:
    """Annotated paragraphs of a section type, a role or an id."""
    out = paragraphs.where("gist IS NOT NULL OR plain IS NOT NULL")
    for column, value in (("section_type", section), ("role", role), ("paragraph_id", paragraph_id)):
        out = out if value is None else out.where(F.col(column) == value)
    return out


def filtered_sentences(paragraphs: DataFrame, section: str | None = None, paragraph_id: str | None = None, certainty: str | None = None) -> DataFrame:
    """Sentences of annotated paragraphs, one a row, with their marked text; certainty is tested last."""
    out = paragraphs
    for column, value in (("section_type", section), ("paragraph_id", paragraph_id)):
        out = out if value is None else out.where(F.col(column) == value)
    each = out.select("article_id", "paragraph_id", "text", F.explode("sentences").alias("s")).where("s.certainty IS NOT NULL")
    each = each if certainty is None else each.where(F.col("s.certainty") == certainty)
    marked = marked_hedges(F.col("text"), F.col("s.start"), F.col("s.end"), F.col("s.hedges"))
    return each.select("article_id", "paragraph_id", "s.sentence_id", "s.certainty", marked.alias("sentence"), F.coalesce(F.size("s.stats"), F.lit(0)).alias("n_stats"))


def figure_totals(figures: DataFrame) -> DataFrame:
    """(article_id, n_figures, n_graphics, n_files): how many images an article has and how many are at hand."""
    size = lambda c: F.when(F.col(c).isNull(), 0).otherwise(F.size(c))
    return figures.groupBy("article_id").agg(F.count(F.lit(1)).alias("n_figures"), F.sum(size("graphics")).cast("long").alias("n_graphics"), F.sum(size("files")).cast("long").alias("n_files"))


def work_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, n) of each table."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def overview(articles: DataFrame, records: DataFrame) -> DataFrame:
    """An article's head: authors, addresses, what each pass has applied, number of warnings."""
    passes = records.groupBy("article_id").agg(F.array_join(F.array_sort(F.collect_list(F.concat("pass", F.lit(": "), F.col("applied").cast("string")))), " · ").alias("passes"))
    return articles.join(passes, "article_id", "left").select(
        "article_id", F.coalesce("title", F.lit("")).alias("title"), F.array_join(F.transform("authors", lambda a: a["full"]), ", ").alias("authors"), "journal", "year", "doi", "pmcid",
        F.coalesce("passes", F.lit("not enriched")).alias("passes"), F.size("warnings").cast("long").alias("n_warnings"),
    )


def citation_links(decorations: DataFrame, references: DataFrame) -> DataFrame:
    """Citations (article_id, rid, ...) with where they lead; a mark that names several references gives a row for each, and one
    that leads nowhere a null link."""
    from leafwright.operators.text import reference_link

    each = decorations.withColumn("xml_id", F.explode_outer(F.filter(F.split("rid", r"\s+"), lambda r: r != "")))
    known = references.select("article_id", "xml_id", reference_link(F.col("pmid"), F.col("doi")).alias("link"))
    return each.join(known, ["article_id", "xml_id"], "left")
