"""Incremental build: arriving article files become table rows, known content is skipped, annotations are carried forward.

The stream runs until what is there is done (available now). A batch is written under its
own number, so a batch that runs twice overwrites itself; only new content is parsed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.operators.articles import article_tables, parsed
from leafwright.sources.files import XML_ENDINGS, checked, only_new

TABLES = ("articles", "sections", "paragraphs", "figures", "tables", "references", "build_report")


def known_hashes(spark: SparkSession, target: str) -> DataFrame:
    """Hashes of everything that earlier runs have built."""
    store = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/articles")
    exists = store.getFileSystem(spark._jsc.hadoopConfiguration()).exists(store)
    return spark.read.parquet(f"{target}/articles").select("sha256") if exists else spark.createDataFrame([], "sha256 string")


def build_batch(files: DataFrame, target: str, batch: int, force: bool = False) -> None:
    """Parses what is new among (path, content) and writes each table's rows of the batch."""
    spark = files.sparkSession
    fresh = only_new(checked(files), known_hashes(spark, target), force).dropDuplicates(["sha256"])
    rows = parsed(fresh).persist()
    try:
        for name, table in article_tables(rows).items():
            if name in TABLES:
                table.write.mode("overwrite").parquet(f"{target}/{name}/batch={batch}")
    finally:
        rows.unpersist()


def build_available(spark: SparkSession, source: str, target: str, checkpoint: str, force: bool = False) -> None:
    """Builds every file under the source folder that the stream has not seen yet."""
    stream = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("recursiveFileLookup", "true").load(source)
    files = stream.where(F.col("path").rlike(XML_ENDINGS)).select("path", "content")
    query = files.writeStream.foreachBatch(lambda df, k: build_batch(df, target, k, force)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def arrivals(spark: SparkSession, events: str, schema: str, minutes: int = 10) -> DataFrame:
    """A stream of job events counted by kind in windows of event time; late ones are taken for as long again."""
    stream = spark.readStream.schema(schema).json(events)
    return stream.withWatermark("ts", f"{minutes} minutes").groupBy(F.window("ts", f"{minutes} minutes"), "type").agg(F.count(F.lit(1)).alias("n"))
