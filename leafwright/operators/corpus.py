"""The corpus: licences, manifest, placement between a public and a private root, carry-forward. Unknown means private."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwright.operators.annotate import cache_key
from leafwright.operators.text import article_link

MANIFEST = ("article_id", "doi", "pmcid", "pmid", "title", "first_author", "journal", "year", "license_url", "license_text", "redistributable", "license_basis", "file", "sha256", "fetch")
MANUAL = "manual"


def licence_basis(text: Column, url: Column) -> Column:
    """NC, ND, CC BY, none or undetermined; only CC BY may be passed on."""
    both = F.lower(F.concat(F.coalesce(url, F.lit("")), F.lit(" "), F.coalesce(text, F.lit(""))))
    some = lambda *words: reduce(or_, (both.contains(w) for w in words))
    return (
        F.when(some("by-nc", "noncommercial", "non-commercial"), F.lit("NC"))
        .when(some("by-nd", "noderiv"), F.lit("ND"))
        .when(some("creativecommons.org/licenses/by/") | both.contains("cc") & both.rlike(r"(?<![a-z0-9_])cc[\s-]?by(?![a-z0-9_])"), F.lit("CC BY"))
        .when(F.trim(both) == "", F.lit("none"))
        .otherwise(F.lit("undetermined"))
    )


def manifest_rows(articles: DataFrame) -> DataFrame:
    """Manifest entries as the articles themselves say."""
    basis = licence_basis(F.col("license_text"), F.col("license_url"))
    first = F.try_element_at(F.col("authors"), F.lit(1))
    return articles.select(
        "article_id", "doi", "pmcid", "pmid", "title", F.coalesce(first["surname"], first["full"]).alias("first_author"), "journal", "year", "license_url",
        F.substring("license_text", 1, 200).alias("license_text"), (basis == "CC BY").alias("redistributable"), basis.alias("license_basis"), F.col("path").alias("file"), "sha256", article_link(F.col("pmcid"), F.col("doi")).alias("fetch"),
    )


def upserted(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """Entries of both: what is found replaces what is known, what is not found stays, and a licence set by hand is kept."""
    old, new = manifest.alias("o"), found.alias("n")
    joined = old.join(new, F.col("o.article_id") == F.col("n.article_id"), "full_outer")
    is_new = F.col("n.article_id").isNotNull()
    by_hand = F.coalesce(F.col("o.license_basis") == MANUAL, F.lit(False))
    pick = lambda c: F.when(is_new & ~(by_hand & F.lit(c in ("redistributable", "license_basis"))), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)
    return joined.select(*map(pick, MANIFEST))


def misplaced(articles: DataFrame, manifest: DataFrame) -> DataFrame:
    """(article_id, root, wanted) of articles that stand under the wrong root; without an entry, private is right."""
    entry = manifest.select("article_id", "redistributable")
    wanted = F.when(F.coalesce("redistributable", F.lit(False)), F.lit("public")).otherwise(F.lit("private"))
    return articles.select("article_id", "root").join(entry, "article_id", "left").select("article_id", "root", wanted.alias("wanted")).where("root <> wanted")


def owned_cache_keys(paragraphs: DataFrame, records: DataFrame) -> DataFrame:
    """(article_id, cache_key): a key for each paragraph with sentences under every model and version that its article's records name."""
    seen = records.groupBy("article_id").agg(F.collect_set("model").alias("models"), F.collect_set("prompt_version").alias("versions"))
    under = paragraphs.where(F.size("sentences") > 0).join(seen, "article_id")
    each = under.withColumn("model", F.explode("models")).withColumn("prompt_version", F.explode("versions"))
    spans = F.transform("sentences", lambda s: F.array(s["start"], s["end"]))
    body = F.to_json(F.struct("model", F.col("prompt_version").alias("promptVersion"), "text", spans.alias("sentences")))
    return each.select("article_id", F.substring(F.sha2(body, 256), 1, 32).alias("cache_key")).distinct()


def planned_moves(misplacements: DataFrame, artifacts: DataFrame) -> DataFrame:
    """(article_id, kind, name, root, wanted) of each stored artifact (article_id, kind, name, root) of a misplaced article."""
    return artifacts.join(misplacements, ["article_id", "root"]).select("article_id", "kind", "name", "root", "wanted")


def orphaned_cache(cache: DataFrame, owned: DataFrame, manifest: DataFrame, planned: DataFrame | None = None) -> DataFrame:
    """Public cache entries that no article cleared for the public claims; what is planned to move already is left out."""
    cleared = manifest.where("redistributable").select("article_id")
    claimed = owned.join(cleared, "article_id", "left_semi").select("cache_key").distinct()
    left = cache.where("root = 'public'").join(claimed, "cache_key", "left_anti")
    return left if planned is None else left.join(planned.where("kind = 'cache'").select(F.col("name").alias("cache_key")).distinct(), "cache_key", "left_anti")


def fetchable(pmcid: Column, file: Column, sha256: Column) -> Column:
    """Whether the paper's XML can be fetched and verified without help."""
    return F.coalesce(F.regexp_replace(pmcid, "(?i)^PMC", "").rlike("^[0-9]+$") & (file != "") & (sha256 != ""), F.lit(False))


def with_status(manifest: DataFrame, built: DataFrame, raw: DataFrame) -> DataFrame:
    """Adds has_json, has_xml and status: ready, buildable, fetchable or manual. ``built`` has article_id, ``raw`` file and root."""
    home = F.when(F.col("redistributable"), F.lit("public")).otherwise(F.lit("private"))
    json = built.select("article_id").distinct().withColumn("has_json", F.lit(True))
    xml = raw.select("file", F.col("root").alias("home")).distinct().withColumn("has_xml", F.lit(True))
    joined = manifest.withColumn("home", home).join(json, "article_id", "left").join(xml, ["file", "home"], "left").na.fill(False, ["has_json", "has_xml"])
    status = F.when(F.col("has_json"), F.lit("ready")).when(F.col("has_xml"), F.lit("buildable")).when(~F.col("redistributable") & fetchable(F.col("pmcid"), F.col("file"), F.col("sha256")), F.lit("fetchable")).otherwise(F.lit("manual"))
    return joined.withColumn("status", status).drop("home")


def selected(manifest: DataFrame, keys: DataFrame) -> DataFrame:
    """(wanted, article_id) for each key asked for, by id, DOI or PMCID in any case among papers that stay private; a null
    article_id is an unknown key. Nothing asked for means all of them."""
    private = manifest.where("NOT redistributable").select("article_id", F.explode(F.array_distinct(F.filter(F.transform(F.array("article_id", "doi", "pmcid"), lambda x: F.lower(x)), lambda x: x.isNotNull()))).alias("wanted"))
    return keys.select(F.lower("key").alias("wanted")).distinct().join(private, "wanted", "left").select("wanted", "article_id")


def verified(downloads: DataFrame, manifest: DataFrame) -> DataFrame:
    """Adds ``accepted`` to (article_id, content_type, content): XML of an article, and exactly the bytes on record."""
    head = F.lower(F.decode(F.substring("content", 1, 1500), "UTF-8"))
    good = F.lower("content_type").contains("xml") & head.contains("<article") & ~head.contains("<html")
    expected = manifest.select("article_id", F.col("sha256").alias("expected"))
    return downloads.join(expected, "article_id", "left").withColumn("accepted", F.coalesce(good & (F.sha2("content", 256) == F.col("expected")), F.lit(False)))


def totals(manifest: DataFrame, built: DataFrame) -> DataFrame:
    """Papers by presence and by whether they may be passed on."""
    here = manifest.join(built.select("article_id").distinct().withColumn("here", F.lit(True)), "article_id", "left")
    return here.agg(F.count(F.lit(1)).alias("n"), F.count("here").alias("present"), F.count_if(F.col("here").isNull()).alias("missing"), F.count_if("redistributable").alias("tracked"), F.count_if(~F.col("redistributable")).alias("excluded"))


def carried(old: DataFrame, new: DataFrame) -> DataFrame:
    """New paragraphs with the annotations of old ones of the same id and the very same text; sentence annotations only where
    the spans agree too. Both sides have sentences with certainty, hedges and stats."""
    spans = lambda c: F.transform(c, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    before = old.select("article_id", "paragraph_id", "text", F.col("role").alias("_role"), F.col("gist").alias("_gist"), F.col("plain").alias("_plain"), F.col("sentences").alias("_sentences"))
    joined = new.drop("role", "gist", "plain").join(before, ["article_id", "paragraph_id", "text"], "left")
    same = F.coalesce(spans(F.col("_sentences")) == spans(F.col("sentences")), F.lit(False))
    kept = F.zip_with("sentences", "_sentences", lambda s, o: s.withField("certainty", o["certainty"]).withField("hedges", o["hedges"]).withField("stats", o["stats"]))
    out = joined.withColumn("sentences", F.when(same, kept).otherwise(F.col("sentences")))
    return out.select(*[c for c in new.columns if c not in ("role", "gist", "plain")], F.col("_role").alias("role"), F.col("_gist").alias("gist"), F.col("_plain").alias("plain"), F.coalesce("_role", "_gist", "_plain").isNotNull().alias("carried"))


def carried_figures(old: DataFrame, new: DataFrame) -> DataFrame:
    """Figures with the local files that were known for the same id."""
    files = old.select("article_id", "xml_id", "files").dropDuplicates(["article_id", "xml_id"])
    return new.drop("files").join(files, ["article_id", "xml_id"], "left")


def keys_for(paragraphs: DataFrame, model: str, version: str) -> DataFrame:
    return paragraphs.select("article_id", "paragraph_id", cache_key(model, version, F.col("text"), F.col("sentences")).alias("cache_key"))


def in_order(manifest: DataFrame) -> DataFrame:
    """The manifest by id as readers sort it, not by code."""
    return manifest.orderBy(F.collate("article_id", "UNICODE"), "article_id")
