"""Session defaults used by tests, the benchmark and interactive work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "leafwright", cpus: str | int = "*", **conf: str) -> SparkSession:
    """A local session with adaptive execution on; a cluster's own session is used as it is."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables: a Parquet file or folder in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
