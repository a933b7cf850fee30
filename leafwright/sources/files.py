"""Files: article XML with its checks, stored tables over a public and a private root, NDJSON events."""

from __future__ import annotations

import re
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

XML_ENDINGS = r"(?i)\.(xml|nxml|jats)$"
ROOTS = ("public", "private")
# Folder of each kind of artifact under a root.
FOLDERS = {"articles": "articles", "raw": "raw", "figures": "figures", "cache": "cache/enrich"}


def xml_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of article files under a folder, at any depth, without hidden ones."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.where(name.rlike(XML_ENDINGS) & ~F.col("path").rlike(r"/\.[^/]*")).select("path", "content")


def checked(files: DataFrame) -> DataFrame:
    """(path, text, sha256, error, encoding_warning): byte order mark and leading blanks go; what is no article gets an error."""
    text = F.regexp_replace(F.decode("content", "UTF-8"), "^﻿", "")
    at = F.instr(text, "<")
    junk = F.when(at > 1, F.trim(F.substring(text, F.lit(1), at - 1)))
    body = F.when(at > 1, F.substring(text, at, F.length(text))).otherwise(text)
    head = F.lower(F.substring("text", 1, 1500))
    error = (
        F.when(F.regexp_replace(F.coalesce("junk", F.lit("")), r"\s", "") != "", F.concat(F.lit("text before the XML declaration: "), F.substring("junk", 1, 40)))
        .when(head.contains("<!doctype html") | head.contains("<html"), F.lit("HTML, not XML"))
        .when(~head.contains("<article"), F.lit("no article element"))
    )
    encoding = F.regexp_extract("text", r"(?i)^<\?xml[^>]*encoding=[\"']([^\"']+)[\"']", 1)
    odd = F.when((encoding != "") & ~encoding.rlike("(?i)^utf-?8$"), F.concat(F.lit("declared as "), encoding))
    return files.select("path", body.alias("text"), junk.alias("junk")).select("path", "text", F.sha2("text", 256).alias("sha256"), error.alias("error"), odd.alias("encoding_warning"))


def only_new(files: DataFrame, known: DataFrame, force: bool = False) -> DataFrame:
    """Files whose hash is not among the known ones, before any parsing."""
    return files if force else files.join(known.select("sha256").distinct(), "sha256", "left_anti")


def stored(rows: DataFrame) -> DataFrame:
    """Rows that a plan reads several times, written once to the shared folder (spark.checkpoint.dir), from which any task reads the columns it needs.
    A session on one machine without one uses the temp folder; a cluster without one keeps the rows by persist(). Their joins are merges: a compressed
    file of long rows looks small enough to be broadcast when its rows are not."""
    spark = rows.sparkSession
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            return rows.persist().hint("merge")
        shared = "/tmp/leafwright-shared"
    path = f"{shared.rstrip('/')}/articles-{uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path).hint("merge")


def over_roots(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of all roots with the root they come from."""
    parts = [df.withColumn("root", F.lit(root)) for root, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def preferred(rows: DataFrame, key: str = "article_id", roots: tuple[str, ...] = ROOTS) -> DataFrame:
    """One row a key: that of the first root that has it."""
    rank = F.array_position(F.array(*map(F.lit, roots)), F.col("root"))
    order = W.partitionBy(key).orderBy(rank)
    return rows.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def root_of(path: Column, private_raw: str, existing: Column) -> Column:
    """Where a file's article belongs: private if the file is under the private folder, else where the article is, else public."""
    prefix = private_raw.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(prefix)), F.lit("private")).otherwise(F.coalesce(existing, F.lit("public")))


def folder(root: Column, kind: str, name: Column) -> Column:
    return F.concat_ws("/", root, F.lit(FOLDERS[kind]), name)


def read_json_rows(spark: SparkSession, path: str, schema: str, multiline: bool = False) -> DataFrame:
    """JSON records or documents; what can't be read is left out."""
    return spark.read.schema(schema).option("multiLine", multiline).option("mode", "DROPMALFORMED").json(path)


def write_events(events: DataFrame, path: str) -> None:
    """One JSON object a line; absent fields are left out."""
    events.write.mode("append").json(path)


def write_article_json(articles: DataFrame, path: str) -> None:
    """One JSON document a row, in a folder for each article."""
    articles.select("article_id", F.to_json(F.struct(*articles.columns)).alias("value")).write.mode("overwrite").partitionBy("article_id").text(path)


def in_file_order(files: DataFrame) -> DataFrame:
    """Files by path, as their code points sort."""
    return files.orderBy("path")


def by_id(rows: DataFrame, article_id: str, key: str = "article_id") -> DataFrame:
    """The rows of one article; over stored tables the filter reaches the scan."""
    return rows.where(F.col(key) == article_id)


def article_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Stored articles, one JSON document each, read anew each time; documents that can't be read or have no id are left out."""
    return read_json_rows(spark, path, schema).where(F.col("article_id").isNotNull())


def write_manifest(manifest: DataFrame, path: str) -> None:
    """The manifest by id, one JSON object a line; what was there is replaced."""
    manifest.orderBy(F.collate("article_id", "UNICODE"), "article_id").coalesce(1).write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """A stored manifest; a damaged one is an empty manifest, or fails if ``strict``."""
    mode = "FAILFAST" if strict else "DROPMALFORMED"
    return spark.read.schema(schema).option("mode", mode).json(path)
